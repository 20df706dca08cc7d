"""Toxicity by non-negative positive-unlabelled learning.

Documents confirmed as toxic are the positives; a sample of all documents, toxic ones among them and
no label looked at, is the unlabelled set. With the class prior pi the risk of calling everything
unlabelled negative is corrected by the positives hidden in it:

    pi * E_pos[loss(f, +)] + max(0, E_unl[loss(f, -)] - pi * E_pos[loss(f, -)])

and where the second part turns negative, which is overfitting, a step goes the other way.

The features are words and their beginnings, hashed. Runs of letters beyond 32 bytes, as in scripts
without spaces, count by the beginnings at each of their characters too, so all of a run is read. Those that positives hold more often than
documents at large are kept. A document's score is a logistic function of the weights of the
features it holds anywhere in its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stratum.llm.common import map_arrow, settle
from stratum.llm.labelled import sampled_ids
from stratum.llm.textbytes import IS_LETTER, Hashes, Slice, slices, words

BITS = 18
BEGINNINGS = (4, 5, 6)  # bytes
# Words longer than this many bytes, and words of scripts written without spaces, where a run of letters
# is a clause, count by what begins at each of their characters, too. Those scripts (Chinese, Japanese,
# Thai, Khmer and others) have letters of three bytes, those of two bytes divide words by spaces.
LONGEST_WORD = 32
THREE_BYTES = 0xE0
KEEP = 8192  # features of a model
PLACES = 1 << 19  # bytes of long words looked at together


def _features(part: Slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, feature) arrays, with repetitions, one pair per kind of feature."""
    runs = words(part, IS_LETTER)
    hashes = Hashes(part.data)
    doc = np.repeat(np.arange(len(part.offsets) - 1), np.diff(runs.per_doc))
    length = runs.ends - runs.starts
    for kind, size in enumerate((0, *BEGINNINGS)):
        use = length > size
        starts = runs.starts[use]
        ends = runs.ends[use] if size == 0 else starts + size
        yield doc[use], _feature(hashes.of(starts, ends), kind)
    beyond = np.zeros(len(part.data) + 1, np.int32)
    np.cumsum(part.data >= THREE_BYTES, out=beyond[1:], dtype=np.int32)
    long = (length > LONGEST_WORD) | (beyond[runs.ends] > beyond[runs.starts])
    first, last, doc = runs.starts[long], runs.ends[long], doc[long]
    until = np.cumsum(last - first)
    for lo in range(0, int(until[-1]) if len(until) else 0, PLACES):
        place = np.arange(lo, min(lo + PLACES, until[-1]))
        run = np.searchsorted(until, place, "right")
        at = last[run] - (until[run] - place)
        inner = (at > first[run]) & (part.data[at] & 0xC0 != 0x80)  # UTF-8 characters begin here
        run, at = run[inner], at[inner]
        for kind, size in enumerate(BEGINNINGS, 1):
            use = last[run] - at >= size
            yield doc[run[use]], _feature(hashes.of(at[use], at[use] + size), kind)


def _feature(h: np.ndarray, kind: int) -> np.ndarray:
    return ((h >> np.uint64(20 + kind)) & np.uint64(2**BITS - 1)).astype(np.int64)


def _distinct_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch.column(1)):
            n = len(part.offsets) - 1
            key = [np.zeros(0, np.int64)]
            key += [(d << BITS) | f for d, f in _features(part)]
            key = np.unique(np.concatenate(key))
            at = np.searchsorted(key >> BITS, np.arange(n + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array((key & (2**BITS - 1)).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(part.first, n), lists], names=["label", "features"]
            )


@dataclass(frozen=True)
class ToxicityModel:
    bias: float
    weights: np.ndarray  # float32 per hashed feature; 0: not used

    def margins(self, part: Slice) -> np.ndarray:
        n = len(part.offsets) - 1
        live = self.weights != 0
        key = [np.zeros(0, np.int64)]
        for doc, feature in _features(part):
            hit = live[feature]
            key.append((doc[hit] << BITS) | feature[hit])
        key = np.unique(np.concatenate(key))
        return self.bias + np.bincount(key >> BITS, self.weights[key & (2**BITS - 1)], n)


def _holders(rows: list[np.ndarray]) -> np.ndarray:
    """How many documents hold each feature; no copy of all features is made."""
    count = np.zeros(2**BITS, np.int64)
    for r in rows:
        count[r] += 1  # distinct within a document
    return count


def _bounded(prior: float) -> float:
    return float(np.clip(prior, 1e-3, 0.999))


def _worthwhile(
    count_p: np.ndarray, n_p: int, count_u: np.ndarray, n_u: int, prior: float, keep: int
) -> np.ndarray:
    """The features that positives hold more often than documents at large, at most ``keep``."""
    in_p = (count_p + 0.5) / (n_p + 1)
    # How often negatives hold it: unlabelled less the positives among them.
    in_n = np.maximum(count_u / n_u - prior * count_p / n_p, 0) / (1 - prior)
    lift = np.log(in_p / (in_n + 1 / n_u))
    least = max(4, n_p // 100)
    worth = np.where((count_p >= least) & (lift > np.log(2)), in_p * lift, 0)
    chosen = np.argsort(-worth, kind="stable")[:keep]
    return chosen[worth[chosen] > 0]


def fit_nnpu(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    keep: int = KEEP,
    steps: int = 1200,
    rate: float = 0.05,
    ridge: float = 1e-4,
) -> ToxicityModel:
    """From the distinct hashed features of each document. Without positives the score is low."""
    size = 2**BITS
    weights = np.zeros(size, np.float32)
    prior = _bounded(prior)
    if not positive or not unlabelled:
        return ToxicityModel(float(np.log(prior / (1 - prior))), weights)
    chosen = _worthwhile(_holders(positive), len(positive), _holders(unlabelled), len(unlabelled), prior, keep)
    place = np.full(size, -1)
    place[chosen] = np.arange(len(chosen))

    def matrix(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        columns = [place[r] for r in rows]
        columns = [c[c >= 0] for c in columns]
        return np.repeat(np.arange(len(rows)), [len(c) for c in columns]), np.concatenate(columns)

    (dp, cp), (du, cu) = matrix(positive), matrix(unlabelled)
    k = len(chosen)
    w, b = np.zeros(k), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(k + 1), np.zeros(k + 1)

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    for t in range(1, steps + 1):
        fp = b + np.bincount(dp, w[cp], len(positive))
        fu = b + np.bincount(du, w[cu], len(unlabelled))
        # logistic loss: d/df loss(f, +) = s - 1, d/df loss(f, -) = s
        sp, su = sigmoid(fp), sigmoid(fu)
        negative_risk = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        if negative_risk >= 0:
            gp, gu = prior * ((sp - 1) - sp) / len(positive), su / len(unlabelled)
        else:
            gp, gu = prior * sp / len(positive), -su / len(unlabelled)
        g = np.append(
            np.bincount(cp, gp[dp], k) + np.bincount(cu, gu[du], k) + ridge * w, gp.sum() + gu.sum()
        )
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        move = rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        w -= move[:-1]
        b -= move[-1]
    weights[chosen] = w
    return ToxicityModel(float(b), weights)


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    positives: int = 3000,
    unlabelled: int = 8000,
    prior_sample: int = 20_000,
) -> ToxicityModel:
    """Fit on at most ``positives`` toxic and ``unlabelled`` other texts outside the held-out fold.

    The class prior is the share of toxic ones among at most ``prior_sample`` labelled rows. The
    ids of the samples are bounded and broadcast to pick the texts in one pass. An id repeated in
    ``docs`` gives one text, the smallest. How many documents hold each feature is counted before
    anything reaches the driver, and then only the features the fit keeps do: at most 8,192 for each of
    the sampled texts, some 360 MB were every text to hold all of them.
    """
    sampled = sampled_ids(labels, id_col, label_col, prior_sample)
    prior = sampled.agg(F.avg(F.col("label").cast("double"))).first()[0] or 0.0
    toxic = sampled_ids(labels.filter(F.col(f"`{label_col}`") == 1), id_col, label_col, positives)
    other = sampled_ids(docs, id_col, None, unlabelled)
    # A document can be in both samples.
    chosen = toxic.select("sample_id", F.lit(1).alias("label")).unionByName(
        other.select("sample_id", F.lit(0).alias("label"))
    )
    texts = docs.select(
        F.col(f"`{id_col}`").alias("own_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).join(F.broadcast(chosen), F.col("own_id") == F.col("sample_id"))
    texts = texts.groupBy("sample_id", "label").agg(F.min("text").alias("text"))
    held = settle(
        map_arrow(texts.select("label", "text"), _distinct_features, "label int, features array<int>"), "features"
    )
    size = {r["label"]: r["n"] for r in held.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    holders = (
        held.select("label", F.explode("features").alias("feature"))
        .groupBy("label", "feature")
        .agg(F.count(F.lit(1)).alias("n"))
        .toArrow()
    )
    count = np.zeros((2, 2**BITS), np.int64)
    count[holders.column("label").to_numpy(), holders.column("feature").to_numpy()] = holders.column("n").to_numpy()
    used = np.zeros(2**BITS, bool)
    if size.get(1) and size.get(0):
        used[_worthwhile(count[1], size[1], count[0], size[0], _bounded(prior), KEEP)] = True

    def keep_used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat, at = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            at = np.concatenate([[0], np.cumsum(used[flat])])[at].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(flat[used[flat]]))],
                names=["label", "features"],
            )

    rows = map_arrow(held, keep_used, "label int, features array<int>").toArrow()
    label = rows.column("label").to_numpy()
    lists = rows.column("features").combine_chunks()
    at, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    sets = [flat[at[i] : at[i + 1]] for i in range(len(label))]
    return fit_nnpu(
        [s for s, y in zip(sets, label, strict=True) if y == 1], [s for s, y in zip(sets, label, strict=True) if y == 0], prior
    )


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, text_col: str = "text", out: str = "score"
) -> DataFrame:
    """``docs`` with the score (0 to 1, higher: likelier toxic) as the last column.

    A column named ``out`` is replaced. Null and empty texts hold no feature and get the score of
    the intercept. A score follows from the whole text alone, so equal rows have equal scores. An empty
    table gives an empty one.
    """
    rest = [c for c in docs.columns if c.lower() != out.lower()]
    kept = docs.select(*[F.col(f"`{c}`") for c in rest])
    at = rest.index(text_col)
    names = [*rest, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [model.margins(part) for part in slices(batch.column(at))]
            margin = np.concatenate(margins) if margins else np.zeros(0)
            score = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=names)

    schema = StructType([*kept.schema.fields, StructField(out, DoubleType())])
    return map_arrow(kept, run, schema)
