"""Quality rules per document, and verdicts per host from the rates at which its documents fail.

A document's counts are column expressions over its whole text, and each rule is a condition over
them. For each rule the failures of a host are summed up to a rate. A host with few documents says
little about itself, so the rate is shrunk towards the rates of the other hosts by a beta prior, whose
two parameters are estimated from these others (method of moments). A host that exceeds the others'
mean by a number of their standard deviations under any rule is turned down with all its documents.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import SPACE, let, settle, text_of

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def repeated_window_words(words: Column, n: int = 3) -> Column:
    """How many words lie in a window of n words that the text holds twice or more.

    Windows are sorted by their hash (64 bits) and position, so equal ones are neighbours; a window
    with an equal neighbour counts. In the order of positions each such window adds the words
    that the one before doesn't cover. The work is n log n in the words of the text.
    """

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.slice(hashes, 1, F.greatest(F.size(hashes) - (n - 1), F.lit(0))),
            lambda h, i: F.struct(
                F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, n)]).alias("h"), i.alias("i")
            ),
        )

    def doubled(ordered: Column) -> Column:
        return F.filter(
            F.transform(
                ordered,
                lambda x, k: F.when(
                    (x["h"] == F.get(ordered, k - 1)["h"]) | (x["h"] == F.get(ordered, k + 1)["h"]),
                    x["i"],
                ),
            ),
            lambda i: i.isNotNull(),
        )

    ordered = F.sort_array(let(F.transform(words, lambda w: F.xxhash64(w)), windows))
    covered = F.aggregate(
        F.sort_array(let(ordered, doubled)),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-n).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(n), i - acc["last"])).alias("n"), i.alias("last")
        ),
        lambda acc: acc["n"],
    )
    return covered


def rule_counts(text: Column) -> dict[str, Column]:
    """The counts of a text that isn't null, all of them long."""
    words = words_of(text)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(text, SPACE + "+", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_window_words(words).cast("long"),
    }


def base_failed(min_words: int = 50, repeat_percent: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words")
    )


def rule_failures() -> dict[str, Column]:
    """What a document fails by; hosts are judged by each of these."""
    return {
        "short": F.col("n_words") < 50,
        "repeated_words": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
        "repeated_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "word_length": (F.col("word_chars") < 3 * F.col("n_words"))
        | (F.col("word_chars") > 10 * F.col("n_words")),
    }


def host_verdicts(
    counted: DataFrame,
    host: str,
    rules: Mapping[str, Column],
    deviations: float = 4.0,
    least: float = 0.05,
    strong: float = 2.0,
) -> DataFrame:
    """Per host: documents, the shrunk rate of each rule, the rules it is turned down by, and whether.

    The prior of a host comes from the others: its mean is the mean of their rates, its strength follows
    from how much these vary beyond what their sizes explain, and is ``strong`` at least; if they don't
    vary so, the prior is as strong as they are large on average. The host is turned down by a rule if
    its shrunk rate exceeds the mean by over ``deviations`` standard deviations of the prior, which
    count as ``least`` at least. A single host has no others and is not turned down.
    """
    hosts = counted.groupBy(F.col(f"`{host}`").alias("host")).agg(
        F.count(F.lit(1)).alias("host_docs"),
        *[F.count_if(failed).alias(f"failed_{name}") for name, failed in rules.items()],
    )
    rate = {name: F.col(f"failed_{name}") / F.col("host_docs") for name in rules}
    totals = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum(1 / F.col("host_docs")).alias("inverses"),
        F.sum("host_docs").alias("all_docs"),
        *[F.sum(r).alias(f"sum_{name}") for name, r in rate.items()],
        *[F.sum(r * r).alias(f"squares_{name}") for name, r in rate.items()],
    )
    others = F.col("hosts") - 1
    inverse = F.try_divide(F.col("inverses") - 1 / F.col("host_docs"), others)
    docs = F.try_divide(F.col("all_docs") - F.col("host_docs"), others)
    shrunk, beyond = {}, {}
    for name, r in rate.items():
        mean = F.try_divide(F.col(f"sum_{name}") - r, others)
        squares = F.col(f"squares_{name}") - r * r - others * mean * mean
        variance = F.greatest(F.coalesce(F.try_divide(squares, others - 1), F.lit(0.0)), F.lit(0.0))
        # Var(rate) = m (1 - m) (inverse + (1 - inverse) / (s + 1)), solved for the strength s
        spread = F.greatest(mean * (1 - mean), F.lit(0.0))
        excess = F.try_divide(variance, spread) - inverse
        strength = F.when(excess > 0, F.greatest(F.lit(strong), (1 - inverse) / excess - 1))
        strength = F.coalesce(strength, F.greatest(F.lit(strong), docs))
        shrunk[name] = (F.col(f"failed_{name}") + mean * strength) / (F.col("host_docs") + strength)
        deviation = F.greatest(F.sqrt(spread / (strength + 1)), F.lit(least))
        beyond[name] = F.coalesce(shrunk[name] - mean > deviations * deviation, F.lit(False))
    # One row of sums; the join has no key and no pairs beyond one per host.
    judged = hosts.join(F.broadcast(totals)).select(
        "host",
        "host_docs",
        F.struct(*[r.alias(name) for name, r in shrunk.items()]).alias("host_rates"),
        F.filter(
            F.array(*[F.when(b, F.lit(name)) for name, b in beyond.items()]), lambda x: x.isNotNull()
        ).alias("host_failed"),
    )
    return judged.withColumn("host_rejected", F.size("host_failed") > 0)


def host_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """Per row of ``docs``: id, host, the counts, base_failed, the host's rates and verdict, and kept.

    Null texts have no words, so they fail. A null host is a host. Repeated rows count each.
    An empty table gives an empty one. Other columns are not read.
    """
    text = text_of(text_col)
    counted = docs.select(
        F.col(f"`{id_col}`").alias(id_col),
        F.col(f"`{host_col}`").cast("string").alias("host"),
        *[c.alias(name) for name, c in rule_counts(text).items()],
    ).withColumn("base_failed", base_failed())
    counted = settle(counted, "counts")  # read twice, and small without the texts
    verdicts = host_verdicts(counted, "host", rule_failures()).withColumnRenamed("host", "of")
    return counted.join(verdicts, F.col("host").eqNullSafe(F.col("of"))).drop("of").withColumn(
        "kept", ~F.col("base_failed") & ~F.col("host_rejected")
    )
