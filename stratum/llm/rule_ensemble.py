"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted trees are fitted to statistics of a bounded sample of labelled documents. Every path from a
root to a node is a rule, a conjunction of comparisons. Logistic regression with an L1 penalty gives
weights to the rules, most of them 0. What is left is a Spark column expression, so scoring is one
pass of built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm import trees
from stratum.llm.common import SPACE, WORD, text_of
from stratum.llm.labelled import sampled_ids

STATS = (
    "words",
    "word_length",
    "distinct_words",
    "symbols",
    "bars",
    "marks",
    "upper",
    "digits",
    "lines",
    "longest_line_words",
)


def text_stats(text: Column) -> Column:
    """A struct of the statistics of a whole text; all of them are 0 for an empty one."""
    chars = F.length(text)
    tokens = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    words = F.size(tokens)
    letters = F.length(F.regexp_replace(text, SPACE + "+", ""))

    def share(pattern: str) -> Column:
        return F.coalesce(F.try_divide(F.length(F.regexp_replace(text, pattern, "")), chars), F.lit(0.0))

    values = {
        "words": words.cast("double"),
        "word_length": F.coalesce(F.try_divide(letters, words), F.lit(0.0)),
        "distinct_words": F.coalesce(F.try_divide(F.size(F.array_distinct(tokens)), words), F.lit(0.0)),
        "symbols": share(r"[^#*$%&<>]+"),
        "bars": share(r"[^|]+"),
        "marks": share(r"[^!?]+"),
        "upper": share(r"[^A-Z]+"),
        "digits": share(r"[^0-9]+"),
        "lines": F.coalesce(F.try_divide(F.length(F.regexp_replace(text, r"[^\n]+", "")), words), F.lit(0.0)),
        "longest_line_words": F.coalesce(
            F.array_max(F.transform(F.split(text, "\n"), lambda x: F.regexp_count(x, F.lit(WORD)))), F.lit(0)
        ).cast("double"),
    }
    return F.struct(*[values[s].cast("double").alias(s) for s in STATS])


Rule = tuple[tuple[int, bool, float], ...]  # (feature, whether it must be above, cut)


def tree_rules(model: trees.Boosted) -> list[Rule]:
    """The distinct paths of all trees, each with one comparison per feature and direction."""
    seen: dict[Rule, None] = {}

    def walk(tree: trees.Tree, node: int, path: dict) -> None:
        if path:
            seen.setdefault(tuple(sorted((f, above, cut) for (f, above), cut in path.items())))
        if node < len(tree.feature) and tree.feature[node] >= 0:
            f, cut = int(tree.feature[node]), float(tree.cut[node])
            low = min(cut, path.get((f, False), np.inf))
            high = max(cut, path.get((f, True), -np.inf))
            walk(tree, 2 * node + 1, path | {(f, False): low})
            walk(tree, 2 * node + 2, path | {(f, True): high})

    for tree in model.trees:
        walk(tree, 0, {})
    return list(seen)


def fires(rules: Sequence[Rule], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for i, rule in enumerate(rules):
        for f, above, cut in rule:
            out[:, i] *= (x[:, f] > cut) == above
    return out


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Intercept and weights that minimise mean logistic loss + penalty * sum |weight| (FISTA)."""
    n, k = z.shape
    a = np.hstack([np.ones((n, 1)), z])
    # Lipschitz constant of the gradient from a few power iterations
    v = np.ones(k + 1)
    for _ in range(30):
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v) or 1.0
    step = 1 / max(0.25 * float(v @ (a.T @ (a @ v))) / max(n, 1), 1e-12)
    w, ahead, t = np.zeros(k + 1), np.zeros(k + 1), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ ahead, -40, 40)))
        new = ahead - step * (a.T @ (p - y)) / max(n, 1)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return float(w[0]), w[1:]


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]

    def score(self, stats: Column) -> Column:
        """Probability of label 1 from a struct of statistics."""

        def holds(rule: Rule) -> Column:
            parts = [stats[STATS[f]] > cut if above else stats[STATS[f]] <= cut for f, above, cut in rule]
            return reduce(lambda a, b: a & b, parts)

        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))

    def describe(self) -> list[str]:
        return [
            f"{w:+.3f} if " + " and ".join(f"{STATS[f]} {'>' if above else '<='} {cut:g}" for f, above, cut in rule)
            for w, rule in sorted(zip(self.weights, self.rules, strict=True), key=lambda x: -abs(x[0]))
        ]


def fit_rules(x: np.ndarray, y: np.ndarray, penalty: float = 0.002, trees_fitted: int = 30, depth: int = 3) -> RuleEnsemble:
    """From statistics (rows x STATS) and 0/1 labels. One class only gives a constant score."""
    if not len(y):
        return RuleEnsemble(0.0, (), ())
    if y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleEnsemble(float(np.log(share / (1 - share))), (), ())
    model = trees.fit(x, y, trees=trees_fitted, depth=depth, rows_per_tree=0.7, seed=3)
    rules = tree_rules(model)
    z = fires(rules, x)
    # Rules that hold for the same rows say the same; the shortest one stays.
    same: dict[bytes, int] = {}
    for i in sorted(range(len(rules)), key=lambda i: len(rules[i])):
        same.setdefault(z[:, i].astype(bool).tobytes(), i)
    keep = [i for i in same.values() if 0 < z[:, i].sum() < len(y)]
    intercept, weights = lasso_logistic(z[:, keep], y.astype(float), penalty)
    live = [j for j in np.argsort(-np.abs(weights), kind="stable") if abs(weights[j]) > 1e-6]
    return RuleEnsemble(intercept, tuple(rules[keep[j]] for j in live), tuple(float(weights[j]) for j in live))


def train_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = 20_000
) -> RuleEnsemble:
    """Fit on at most ``sample`` labelled documents outside the held-out fold.

    The sample's ids (bounded, so broadcast) pick their texts in one pass; only statistics, ten
    numbers a row, reach the driver: of at most twice ``sample`` rows if ids repeat. Rows without an id
    or a label teach nothing. Without any row to learn from there are no rules and every score is 0.5.
    """
    chosen = sampled_ids(labels, id_col, label_col, sample)
    rows = (
        docs.select(F.col(f"`{id_col}`").alias("own_id"), text_of(text_col).alias("text"))
        .join(F.broadcast(chosen), F.col("own_id") == F.col("sample_id"))
        .select("own_id", "label", text_stats(F.col("text")).alias("s"))
        .orderBy(F.xxhash64("own_id"), "own_id")
        .limit(2 * sample)  # ids may repeat
        .select("label", "s.*")
        .toPandas()
    )
    return fit_rules(rows[list(STATS)].to_numpy(float), rows["label"].to_numpy(float))


def score_quality(
    docs: DataFrame, model: RuleEnsemble, text_col: str = "text", out: str = "score"
) -> DataFrame:
    """``docs`` with the score (0 to 1, higher: better) in a column that is replaced if it exists.

    Null and empty texts have statistics of 0 and are scored like any other text. A score follows from
    the whole text alone, so equal rows have equal scores. An empty table gives an empty one.
    """
    return docs.withColumn(out, model.score(text_stats(text_of(text_col))))
