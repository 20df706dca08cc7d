import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from stratum.llm import exact_dedup, near_dedup, queries
from stratum.llm.components import components


def normal(text):
    return re.sub(r"[ \t-\r]+", " ", text or "")


@pytest.mark.parametrize("fan", [2, 16])
def test_exact_duplicates_against_brute_force(spark, fan):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a b", "a  b", "a\nb", " a b", "c", "", None, "d" * 50])) for i in rng.sample(range(900), 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    groups = {}
    for i, t in rows:
        groups.setdefault(normal(t), []).append(i)
    for r in exact_dedup.exact_duplicates(docs, fan=fan).collect():
        text = normal(dict(rows)[r["doc_id"]])
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert (r["keep_id"], r["group_size"]) == (min(groups[text]), len(groups[text]))
        assert r["kept"] == (r["doc_id"] == r["keep_id"])


def test_exact_duplicates_of_odd_rows(odd_documents, no_documents):
    rows = exact_dedup.exact_duplicates(odd_documents).collect()
    assert len(rows) == 12
    same = [r for r in rows if r["group_size"] == 4]
    assert len(same) == 4 and sum(r["kept"] for r in same) == 1 and {r["keep_id"] for r in same} == {1}
    kept = exact_dedup.drop_exact_duplicates(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted((r["doc_id"], len(r["text"] or "")) for r in kept.collect()) == [
        (1, 32), (3, 0), (5, 32), (5, 150_003), (6, 1), (7, 5), (8, 100_000),
    ]
    assert exact_dedup.exact_duplicates(no_documents).count() == 0
    assert exact_dedup.drop_exact_duplicates(no_documents).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    links += [(None, 3), (159, 300), (300, 299)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {found[i] for i in range(31)} == {0}
    assert {found[i] for i in [*range(100, 160), 299, 300]} == {100}
    assert found[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    words = re.findall(rb"[^ \t-\r]+", (text or "").encode().lower())
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            a, b = sets[x], sets[y]
            if x < y and a and b and 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((find(x), find(y)))
                root[high] = low
    return {i: find(i) for i in ids}, sets


def near_rows():
    """A large group of near copies, chains, decoys below the threshold and a common passage."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0

    def add(words):
        nonlocal i
        rows.append((i, " ".join(words)))
        i += 1

    passage = rng.choices(vocabulary, k=30)
    base = rng.choices(vocabulary, k=120)
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = f"z{rng.randrange(10**6)}"
        add(copy)
    for _ in range(60):
        add(passage + rng.choices(vocabulary, k=rng.randint(20, 200)))
    chain = rng.choices(vocabulary, k=80)
    for step in range(12):
        add(chain[step * 2 : step * 2 + 60])
    for _ in range(40):
        other = rng.choices(vocabulary, k=60)
        add(other)
        for changed in (1, 2, 3, 6):
            copy = list(other)
            for k in range(changed):
                copy[10 + 8 * k] = "changed"
            add(copy)
    return rows


def test_near_duplicates_against_brute_force(spark):
    rows = near_rows()
    expected, sets = brute_components(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for r in near_dedup.near_duplicates(docs).collect():
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["component_id"] == expected[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def template_rows(n, shared, own, planted):
    """Texts of one template, linked to nothing but a planted twin each: (rows, similarities of twins)."""
    rng = random.Random(n)
    template = [f"t{i}" for i in range(shared)]
    rows = [(i, template + [f"w{rng.randrange(10**9)}" for _ in range(own)]) for i in range(n)]
    for i in range(planted):
        tail = round((shared + own - 4) * (0.105 + 0.0065 * (i % 8)))
        rows[n - 1 - i] = (n - 1 - i, rows[i][1][:-tail] + rows[n - 1 - i][1][-tail:])
    rows = [(i, " ".join(words)) for i, words in rows]
    sets = [shingles(t) for _, t in rows]
    twins = [len(sets[i] & sets[n - 1 - i]) / len(sets[i] | sets[n - 1 - i]) for i in range(planted)]
    return rows, twins


@pytest.mark.parametrize("shared, own, levels", [(104, 25, 8), (104, 25, 0), (34, 80, 8)])
def test_near_duplicates_among_large_groups_of_one_template(spark, shared, own, levels):
    rows, twins = template_rows(1200, shared, own, 60)
    assert 0.7 < min(twins) and max(twins) < 0.9
    expected, _ = brute_components(rows)
    assert len(set(expected.values())) == 1200 - sum(x >= 0.75 for x in twins)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    settings = near_dedup.Settings(max_levels=levels)  # 0: all pairs in blocks
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, settings=settings).collect()}
    assert found == expected


def test_near_duplicates_at_the_fringe_of_a_large_group(spark):
    """Texts whose only link is to one of many edits, which are all close to the first text."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(204)]
    rows = [(0, base)]
    for i in range(1, 700):  # about 0.9 like the first text
        at = rng.randrange(190)
        rows.append((i, base[:at] + [f"e{i}x{k}" for k in range(10)] + base[at + 10 :]))
    for i in range(700, 760):
        words = list(rows[i - 600][1])
        cut = 26  # new words at the end
        rows.append((i, words[:-cut] + [f"f{i}x{k}" for k in range(cut)]))
    rows = [(i, " ".join(words)) for i, words in rows]
    expected, sets = brute_components(rows)
    only = [
        i
        for i in range(700, 760)
        if [j for j in range(700) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])] == [i - 600]
    ]
    assert len(only) >= 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert found == expected


def test_near_duplicates_of_odd_rows(odd_documents, no_documents):
    rows = near_dedup.near_duplicates(odd_documents).collect()
    assert len(rows) == 12
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by_id[1] == [(4, 1, True)] * 2
    assert by_id[2] == [(4, 1, False)]
    assert by_id[3] == [(0, 3, True)] and by_id[7] == [(0, 7, True)] and by_id[4] == [(0, 4, True)]
    assert sorted(by_id[5]) == [(2, 5, True), (2, 5, True)]
    assert sorted(by_id[None]) == [(0, None, True), (4, None, True)]
    assert by_id[6] == [(1, 6, True)] and by_id[8] == [(1, 8, True)]
    kept = near_dedup.drop_near_duplicates(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() == 11
    assert near_dedup.near_duplicates(no_documents).count() == 0


def test_words_split_at_ascii_whitespace_only(spark):
    text = "A b c d e\x0bf g\x1ch É"
    docs = spark.createDataFrame([(1, text), (2, text.replace("A", "a"))], "doc_id long, text string")
    rows = near_dedup.near_duplicates(docs).collect()
    assert {(r["n_shingles"], r["component_id"]) for r in rows} == {(len(shingles(text)), 1)}


def test_near_dedup_query_reads_whole_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected, sets = brute_components(docs.select("doc_id", "text").collect())
    got = {r["doc_id"]: r["component_id"] for r in queries.op7_near_dedup(spark, sf_dir).collect()}
    assert got == expected
    assert docs.count() == len(got) and docs.filter(F.col("text").isNull()).count() == 0
