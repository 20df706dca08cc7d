import math
import random
import re
import zlib

import numpy as np
import pytest

from stratum.llm import queries, rule_ensemble, textbytes, toxicity, trees
from stratum.llm.labelled import held_out


def held_out_rows(spark, rows, label):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    joined = rows.join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", label).collect()
    for r in joined[:200]:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    return [r for r in joined if r["held_out"]]


def balanced(rows, label):
    right = {y: [r["predicted"] == y for r in rows if r[label] == y] for y in (0, 1)}
    return [sum(v) / len(v) for v in right.values()]


@pytest.mark.parametrize(
    "query, label, least", [(queries.op3_rule_ensemble, "quality", 0.97), (queries.op10_toxicity, "toxic", 0.9)]
)
def test_held_out_accuracy(spark, query, label, least):
    result = query(spark, "/root/testdata/sf0.1")
    rows = held_out_rows(spark, result, label)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert min(balanced(rows, label)) >= least


def test_training_sees_no_held_out_label(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(500)], "doc_id long, quality int, toxic int")
    from stratum.llm.labelled import sampled_ids

    ids = [r["sample_id"] for r in sampled_ids(labels, "doc_id", "quality", 300).collect()]
    assert len(ids) == 300 and all(zlib.crc32(str(i).encode()) % 5 for i in ids)


def test_rules_compile_to_the_scores_they_were_fitted_with(spark):
    docs = spark.createDataFrame(
        [(i, ("clean words in a line " * (i % 7 + 1)) if i % 2 else "BAD %% $$ ## !! " * (i % 5 + 1)) for i in range(400)],
        "doc_id long, text string",
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    model = rule_ensemble.train_quality(docs, labels)
    assert model.rules and model.describe()
    rows = rule_ensemble.score_quality(docs, model).collect()
    assert all((r["score"] > 0.5) == bool(r["doc_id"] % 2) for r in rows)


def test_lasso_drops_useless_rules():
    rng = np.random.default_rng(1)
    z = rng.integers(0, 2, (800, 6)).astype(float)
    y = (z[:, 2] > 0).astype(float)
    _, weights = rule_ensemble.lasso_logistic(z, y, 0.02)
    assert weights[2] > 1 and np.abs(np.delete(weights, 2)).max() < 0.05


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = trees.fit(x, y, trees=30, depth=3)
    assert ((model.margin(x) > 0) == y).mean() > 0.95


def test_positive_unlabelled_risk_finds_hidden_positives():
    rng = np.random.default_rng(3)

    def doc(toxic):
        common = rng.integers(0, 5000, 60)
        return np.unique(np.append(common, rng.integers(6000, 6010, 3)) if toxic else common)

    positive = [doc(True) for _ in range(300)]
    truth = rng.random(2000) < 0.2
    unlabelled = [doc(t) for t in truth]
    model = toxicity.fit_nnpu(positive, unlabelled, 0.2)
    score = np.array([model.bias + model.weights[d].sum() for d in unlabelled])
    assert ((score > 0) == truth).mean() > 0.98


def test_odd_rows_and_empty_training(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    quality = rule_ensemble.train_quality(odd_documents, labels)
    toxic = toxicity.train_toxicity(odd_documents, labels)
    for scored in (rule_ensemble.score_quality(odd_documents, quality), toxicity.score_toxicity(odd_documents, toxic)):
        assert sorted(scored.columns) == sorted(odd_documents.columns)  # score is replaced
        rows = scored.collect()
        assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_toxicity(no_documents, toxic).count() == 0
    assert rule_ensemble.score_quality(no_documents, quality).count() == 0
    assert odd_documents.filter(held_out("doc_id")).filter("doc_id is null").count() == 0


def test_toxic_terms_late_in_a_run_without_spaces_count(spark):
    rng = random.Random(8)
    script = [chr(0x4E00 + i) for i in range(900)]
    term = chr(0x6E00) + chr(0x6E01) + chr(0x6E02)

    def text(toxic):
        run = "".join(rng.choices(script, k=60))
        return run[:40] + term + run[40:] if toxic else run

    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(1200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train_toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    scored = toxicity.score_toxicity(table, model).filter(held_out("doc_id")).collect()
    assert len(scored) > 150
    assert sum((r["score"] >= 0.5) != bool(r["toxic"]) for r in scored) <= 0.02 * len(scored)


@pytest.mark.parametrize("length", [3, 6, 9, 10, 12, 30])
def test_toxic_terms_in_short_runs_of_a_script_without_spaces_count(spark, length):
    rng = random.Random(length)
    script = [chr(0x4E00 + i) for i in range(900)]
    term = chr(0x6E00) + chr(0x6E01) + chr(0x6E02)

    def text(toxic):
        clauses = ["".join(rng.choices(script, k=length)) for _ in range(7)]
        if toxic:  # as late in a clause as it fits
            at = max(0, length - 4)
            clauses[rng.randrange(7)] = "".join(rng.choices(script, k=at)) + term + rng.choice(script)
        return rng.choice([" ", ", "]).join(clauses)

    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(1200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train_toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    scored = toxicity.score_toxicity(table, model).filter(held_out("doc_id")).collect()
    assert sum((r["score"] >= 0.5) != bool(r["toxic"]) for r in scored) <= 0.02 * len(scored)


def plain_stats(text):
    words = re.findall(r"[^ \t-\r]+", text)
    n, chars = max(len(words), 1), max(len(text), 1)
    share = lambda some: sum(c in some for c in text) / chars
    upper, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    return {
        "words": len(words), "word_length": sum(map(len, words)) / n, "distinct_words": len(set(words)) / n,
        "symbols": share("#*$%&<>"), "bars": share("|"), "marks": share("!?"), "upper": share(upper),
        "digits": share(digits), "lines": text.count("\n") / n if words else 0.0,
        "longest_line_words": max(len(re.findall(r"[^ \t-\r]+", x)) for x in text.split("\n")),
    }


def test_quality_query_equals_rules_applied_one_by_one(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = rule_ensemble.train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert model.rules
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in queries.op3_rule_ensemble(spark, sf_dir).collect():
        stats = plain_stats(texts[r["doc_id"]])
        total = model.intercept
        for rule, weight in zip(model.rules, model.weights):
            if all((stats[rule_ensemble.STATS[f]] > cut) == above for f, above, cut in rule):
                total += weight
        score = 1 / (1 + math.exp(-total))
        assert r["score"] == pytest.approx(score, abs=1e-9) and r["predicted"] == (score >= 0.3)


def plain_feature(raw, kind):
    """The hashed feature of some letters, in whole numbers of Python."""
    x = sum(int(textbytes._BYTE_VALUE[textbytes.LOWER[b]]) * pow(textbytes._BASE, i, 1 << 64) for i, b in enumerate(raw))
    x = (x + len(raw) * 0xD6E8FEB86659FD93) % (1 << 64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> shift)) * factor % (1 << 64)
    return ((x ^ (x >> 31)) >> (20 + kind)) & (2**toxicity.BITS - 1)


def plain_features(text):
    found = set()
    for run in re.findall(rb"[A-Za-z\x80-\xff]+", text.encode()):
        found.add(plain_feature(run, 0))
        inner = len(run) > 32 or max(run) >= 0xE0
        starts = [i for i in range(len(run)) if i == 0 or (inner and run[i] & 0xC0 != 0x80)]
        for kind, size in enumerate((4, 5, 6), 1):
            for i in starts:
                if len(run) - i > size or (i and len(run) - i == size):
                    found.add(plain_feature(run[i : i + size], kind))
    return found


def test_toxicity_query_equals_weights_added_one_by_one(spark, tmp_path):
    rng = random.Random(21)
    words = ["kind", "gentle", "überall", "nasty", "nastiest", "漢字仮名交", "q" * 40, "été", "a", "ab-cd", "ไทยไม่มีช่องว่าง"]
    rows = [(i, " ".join(rng.choices(words[:3] + words[5:] + (words[3:5] if i % 3 == 0 else []), k=12))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "1 2 3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int("nast" in (t or ""))) for i, t in rows], "doc_id long, quality int, toxic int")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    labels.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    model = toxicity.train_toxicity(docs, labels)
    assert np.count_nonzero(model.weights)
    texts = dict(rows)
    for r in queries.op10_toxicity(spark, str(tmp_path)).collect():
        margin = model.bias + sum(float(model.weights[f]) for f in plain_features(texts[r["doc_id"]] or ""))
        score = 1 / (1 + math.exp(-margin))
        assert r["score"] == pytest.approx(score, abs=1e-5) and r["predicted"] == (r["score"] >= 0.5)


def test_training_takes_one_text_of_a_repeated_id(spark, monkeypatch):
    rows = [(i, f"{'nasty' if i % 4 == 0 else 'kind'} words {i}", int(i % 4 == 0)) for i in range(400)]
    repeated = next(i for i in range(0, 400, 4) if zlib.crc32(str(i).encode()) % 5)
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    copies = spark.createDataFrame([(repeated, f"zz{i} other") for i in range(2000)], "doc_id long, text string")
    taken = []
    fit = toxicity.fit_nnpu
    monkeypatch.setattr(toxicity, "fit_nnpu", lambda p, u, prior: taken.append((p, u)) or fit(p, u, prior))
    model = toxicity.train_toxicity(table.select("doc_id", "text").union(copies), table.select("doc_id", "toxic"))
    (positive, unlabelled), = taken
    trained = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(400))
    assert len(unlabelled) == trained and len(positive) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(0, 400, 4))
    assert set(np.concatenate(unlabelled)) <= set(np.flatnonzero(model.weights))
