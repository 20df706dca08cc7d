"""Line dedup, fill-in-middle and hard negatives against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratum.llm import fill_in_middle, hard_negatives, line_index
from stratum.llm.textbytes import slices

SPACES = " \t\n\v\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def line_rows():
    draw = random.Random(7)
    common = ["The Licence of this text is as follows", "größe über alles und noch viel länger", "short line"]
    common += [f"a line number {i} that some documents share" for i in range(30)]
    rows = []
    for i in range(400):
        lines = draw.choices(common, k=draw.randrange(8)) + [f"a line of document {i} alone and no other"]
        lines += [""] * draw.randrange(3) + draw.choices(["   \t ", "ÄÖ" * 10, "ä" * 19, "x" * 20], k=2)
        draw.shuffle(lines)
        lines = [draw.choice(["", " ", "\t\r"]) + (x.upper() if draw.random() < 0.2 and x.isascii() else x) for x in lines]
        rows.append((i // 2 if i % 40 < 2 else i + 1000, "\n".join(lines)))
    rows += [(5, None), (6, ""), (None, "\n".join(common)), (None, "\n".join(common[:5])), rows[3], rows[3]]
    rows += [(7, "\n"), (8, "x" * 20 + "\n" + "y" * 700_000), (9, "\n".join(common * 2000) + "\n")]
    return rows


def expected_lines(rows, min_docs=3, min_chars=20):
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(SPACES).translate(LOWER)
            if len(key) >= min_chars:
                holders.setdefault(key, set()).add(-1 if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            held = holders.get(line.strip(SPACES).translate(LOWER), ())
            if len(held) < min_docs or max(held) == (-1 if i is None else i):
                kept.append(line)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_lines", [0, 100, 5000])
def test_repeated_lines_equal_brute_force(spark, hot_lines):
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = line_index.drop_repeated_lines(docs, hot_lines=hot_lines)
    assert found.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected_lines(rows)


def test_lines_of_odd_tables(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    clashing = odd_documents.withColumns({"holder": F.lit(1), "LOST": F.lit(2), "N_Lines": F.lit(3), "row": F.lit("r")})
    found = line_index.drop_repeated_lines(clashing)
    assert found.columns == [*odd_documents.columns, "holder", "LOST", "row", "n_lines", "n_dropped"]
    assert {(r["holder"], r["LOST"], r["row"]) for r in found.collect()} == {(1, 2, "r")}
    got = sorted((tuple(r) for r in found.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)
    assert got == expected_lines(rows)
    assert line_index.drop_repeated_lines(no_documents).collect() == []


def test_index_is_minimal_and_perfect():
    draw = np.random.default_rng(3)
    high, low = draw.integers(0, 2**64, (2, 20_000), dtype=np.uint64)
    high[1000:2000] = high[:1000]  # half a hash may be shared
    index = line_index.LineIndex.build(high[:10_000], low[:10_000], np.arange(10_000), np.arange(10_000) * 7)
    index = line_index.LineIndex.load(index.dump())
    slot = index.find(high, low)
    assert sorted(slot[:10_000]) == list(range(10_000)) and (slot[10_000:] == -1).all()
    assert (index.last[slot[:10_000]] == np.arange(10_000) * 7).all()
    assert 64 * len(index.bits) < 5 * 10_000
    none = line_index.LineIndex.build(*(x[:0] for x in (high, low, np.arange(1), np.arange(1))))
    assert (none.find(high, low) == -1).all()


def cut_rows():
    draw = random.Random(11)
    texts = ["", None, "a", "word", "two words", "ünïcödé ☃ text 𝔘𝔫", "<P", "a<S>b", "<M>", "< P><S", "x<", "\n\n", "<P<S>"]
    texts += ["".join(draw.choices("abcXYZ <>PSM\né☃𝔘0", k=draw.randrange(60))) for _ in range(600)]
    texts += ["long wörds " * 200_000, "z" * 1_500_000, "☃" * 700_000]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, *rows[5:8], (3, "another text"), (None, "no id here"), (-5, "negative id")]


def expected_cut(i, text, seed=1):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (i, n, "plain", None, None, text, text)
    if h4 % 100 < 20:
        return (i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text)
    return (i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text)


def test_fill_in_middle_equals_brute_force(spark):
    rows = cut_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = fill_in_middle.restore(fill_in_middle.fill_in_middle(docs))
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    found = sorted((tuple(r) for r in made.select(names).collect()), key=repr)
    assert found == sorted((expected_cut(*r) for r in rows), key=repr)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


def test_cuts_of_odd_tables(spark, odd_documents, no_documents):
    clashing = odd_documents.withColumns({"N": F.lit(1), "made_of": F.lit(2), "restored": F.lit(3)})
    made = fill_in_middle.fill_in_middle(clashing)
    assert made.columns == [
        *odd_documents.columns, "made_of", "restored", "n", "form", "prefix_chars", "middle_chars", "output",
    ]
    again = fill_in_middle.restore(made)
    assert again.filter("restored <> coalesce(text, '') or made_of <> 2").count() == 0
    assert again.count() == odd_documents.count()
    assert fill_in_middle.restore(fill_in_middle.fill_in_middle(no_documents)).collect() == []


def test_restore_takes_nulls_and_refuses_broken_outputs(spark):
    rows = [(None, None), ("x", None), (None, "plain"), ("<S>c<P>a<M>b", "spm"), ("<P>a<S>c<M>b", "psm"), ("<P><S><M>", "psm")]
    made = fill_in_middle.restore(spark.createDataFrame(rows, "output string, form string"))
    assert [r["restored"] for r in made.collect()] == ["", "x", "", "abc", "abc", ""]
    for broken in ("<P>a<S>b", "<S>a<P>b<M>c", "<P>a<S>b<M>c<M>", ""):
        part = next(slices(pa.array([broken, "<P>a<S>b<M>c"])))
        with pytest.raises(ValueError):
            fill_in_middle.gather(part, np.zeros(2, bool), np.zeros(2, bool))


def expected_negatives(rows, positives=5, negatives=10):
    kept = {}
    for i, vector, label in rows:
        if None in (i, vector, label) or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = (label, [int(np.floor(256 * float(np.float32(x)))) for x in vector])
        kept[i] = min(kept.get(i, whole), whole)
    out = []
    for a, (label, q) in kept.items():
        if a % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(q, w)), i, own)
            for i, (own, w) in kept.items()
            if i != a and len(w) == len(q)
        ]
        best = sorted((s, i) for s, i, own in scored if own == label)[:positives]
        for minus, p in best:
            inside = sorted((s, i) for s, i, own in scored if own != label and -30 * minus <= -100 * s <= -90 * minus)
            out += [(a, p, k + 1, i, -minus, -s) for k, (s, i) in enumerate(inside[:negatives])]
    return sorted(out)


def vector_rows(size=24, n=700):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(6, size))
    rows = []
    for i in range(n):
        label = int(draw.integers(6))
        vector = centres[(label + int(draw.integers(2))) % 6] + draw.normal(size=size) * 0.7
        rows.append([i, (vector / np.linalg.norm(vector)).astype(np.float32).tolist(), label])
    for i in range(200, 420):
        rows[i][1] = rows[200][1]  # a third of the rows are one vector, under several labels
    rows[300][1], rows[100][2], rows[500][1] = [0.0] * size, None, None
    rows[7][1] = [None, *rows[7][1][1:]]
    rows[8][1] = [float("nan"), *rows[8][1][1:]]
    rows[9][1] = [float("inf"), *rows[9][1][1:]]
    rows += [[600, rows[3][1], 2], [600, rows[600][1], 5], rows[11], [None, rows[3][1], 1], [800, [], 1], [801, [], 1], [802, [], 2]]
    rows += [[900, [0.5, 1.0, -2.0], 1], [901, [0.5, 1.0, -1.5], 1], [902, [0.5, 0.25, -1.0], 2], [-100, rows[5][1], 0]]
    return [tuple(r) for r in rows]


def negatives_of(vectors):
    found = hard_negatives.hard_negatives(vectors, anchors=F.col("id") % 100 == 0)
    return sorted(tuple(r) for r in found.collect())


def test_hard_negatives_equal_brute_force(spark):
    rows = vector_rows()
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    found = negatives_of(vectors.withColumns({"id": F.lit("x"), "q": F.lit(1), "code": F.lit(2), "row": F.lit(3)}))
    assert found == expected_negatives(rows)
    assert len(found) > 100 and any(r[0] == 900 for r in found)
    assert negatives_of(vectors.limit(0)) == [] and negatives_of(vectors.filter("vec_id % 100 <> 0")) == []


def test_blocks_change_nothing(spark, monkeypatch):
    rows = vector_rows()
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for name, value in (("MIN_BLOCK_ROWS", 90), ("MAX_BLOCK_ROWS", 90), ("BLOCK_ANCHORS", 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert negatives_of(vectors) == expected_negatives(rows)


@pytest.mark.parametrize("size", [1, 24, 64, 100])
def test_intervals_hold_the_score(size):
    draw = np.random.default_rng(size)
    vectors = np.floor(256 * draw.normal(size=(300, size))).astype(np.int64)
    vectors[:5] = 0
    anchors = vectors[:40]
    low, high = hard_negatives.intervals(anchors, hard_negatives.encode(vectors))
    scores = anchors @ vectors.T
    assert (low <= scores).all() and (scores <= high).all()
    if size == 64:  # and they say something
        length = np.linalg.norm(vectors, axis=1)
        width = (high - low)[5:, 5:] / (length[5:40, None] * length[None, 5:])
        assert np.median(width) < 1.4


def test_large_scores_are_exact_or_refused():
    big = np.array([[1 << 40, 3], [1 << 40, -1]], np.int64)
    with pytest.raises(OverflowError):
        hard_negatives.Exact(big).of(np.arange(2), big[0])
    near = np.array([[1 << 31, 1], [1 << 31, 0]], np.int64)
    assert hard_negatives.Exact(near).of(np.arange(2), near[0]).tolist() == [(1 << 62) + 1, 1 << 62]
