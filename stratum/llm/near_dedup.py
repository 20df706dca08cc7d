"""Near-duplicate documents by chosen-path set similarity join over word shingles.

A document's set holds its distinct shingles of five words. Documents with equal sets collapse
into a class first, so copies cost nothing below. Then, in several independent trees:

* A tree's root deals the classes to nodes by one selected minwise token (a minwise value of the
  set under one hash function). Two sets of similarity J share a node with probability J.
* In a small node all pairs are compared, by sketches of 64 minwise tokens of four bits.
* In a large node the members share something: the text they are edits of, a template, a passage.
  Its core, the shingles that more than half of some random members hold, is taken out, and each
  member goes on with its remainder, the symmetric difference D of its set and the core. As A and B
  differ where their remainders differ, they are linked exactly if
  (100 + p) |D(A) ^ D(B)| <= (100 - p) (|A| + |B|). So members near enough to the core are linked with
  the nearest of all for certain, by the sizes of their remainders alone, and all others must share
  some of their remainder with whatever they are linked to: they go on to children, by selected
  minwise tokens of the remainder, and meet the members near the core there as well. Texts that are
  alike by the core only have remainders with little in common, and their nodes fall apart.

Pairs whose sketches allow the wanted similarity, for the sizes of their remainders, are confirmed on
the full sets. Links of classes form components, and the smallest doc_id of each component stays.

A pair at the threshold shares a root with probability 0.75 per tree, so ten trees miss it with
probability 0.25^10 if it need not branch. In a large node two members far from the core share at
least a quarter to a third of their remainders, and one of four children keeps them together with
probability 0.7 to 0.8 a level: ten trees miss such a pair with 0.45^10 after one level and 0.6^10 after
two. A link between a member just beyond reach of the core and one very near to it can rest on a few
shingles of the remainder and is found less often.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import MAX_BROADCAST_IDS, by_ids, map_arrow, settle
from stratum.llm.components import components
from stratum.llm.textbytes import IS_SPACE, SLICE_BYTES, Hashes, mix, slices, words

COORDINATES = 64
_RANDOM = np.random.Generator(np.random.PCG64(75))
_MULTIPLY = _RANDOM.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RANDOM.integers(1, 2**63, COORDINATES, dtype=np.uint64)
_PLACE = _RANDOM.integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)
MAX_SHINGLE = len(_PLACE)


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 75  # linked if 100 * intersection >= percent * union
    trees: int = 10
    small: int = 64  # nodes up to this size are compared exhaustively
    deviations: float = 4.0  # by which the sketches of a linked pair may agree less than expected
    heads: int = 24  # members that make a core, on average
    children: int = 4  # of a member of a large node
    max_levels: int = 8  # beyond these all pairs are compared, in blocks


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per slice: first row, hashes of the distinct shingles by document, offsets per document.

    A text of fewer than k words has one shingle, the whole sequence; without words it has none.
    """
    if not 1 <= k <= MAX_SHINGLE:
        raise ValueError(f"shingles have 1 to {MAX_SHINGLE} words")
    for part in slices(column):
        runs = words(part, IS_SPACE == False)  # noqa: E712
        w = Hashes(part.data).of(runs.starts, runs.ends)
        n_words = np.diff(runs.per_doc)
        docs = len(n_words)
        n_windows = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
        at = np.concatenate([[0], np.cumsum(n_windows)])
        sums = np.zeros(len(w) + k, np.uint64)
        for i in range(min(k, len(w))):
            sums[: len(w) - i] += w[i:] * _PLACE[i]
        # Window starts of long documents; a short one takes its only window from its words.
        doc = np.repeat(np.arange(docs), n_windows)
        first = runs.per_doc[doc] + (np.arange(at[-1]) - at[doc])
        hashes = sums[first]
        for d in np.flatnonzero((n_words > 0) & (n_words < k)):
            own = w[runs.per_doc[d] : runs.per_doc[d + 1]]
            hashes[at[d]] = (own * _PLACE[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
        hashes = mix(hashes)
        for d in np.flatnonzero(n_windows > 1):
            hashes[at[d] : at[d + 1]].sort()
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        new[at[:-1][n_windows > 0]] = True
        counts = np.concatenate([[0], np.cumsum(new)])
        yield part.first, hashes[new], counts[at]


def _signatures(hashes: np.ndarray, at: np.ndarray, trees: int):
    """Set digests, root tokens (docs x trees) and four longs of sketch, for non-empty sets."""
    starts = at[:-1]
    xor = np.bitwise_xor.reduceat(hashes, starts)
    total = np.add.reduceat(hashes * np.uint64(0xD1B54A32D192ED03) + np.uint64(1), starts)
    tokens = np.empty((len(starts), COORDINATES), np.uint32)
    scratch = np.empty_like(hashes)
    for c in range(COORDINATES):
        np.multiply(hashes, _MULTIPLY[c], out=scratch)
        scratch += _ADD[c]
        scratch >>= np.uint64(32)
        tokens[:, c] = np.minimum.reduceat(scratch, starts)
    nibbles = mix(tokens.astype(np.uint64)) & np.uint64(15)
    shifts = np.uint64(4) * np.arange(16, dtype=np.uint64)
    sketch = (nibbles.reshape(-1, 4, 16) << shifts).sum(axis=2, dtype=np.uint64)
    return xor.view(np.int64), total.view(np.int64), tokens[:, :trees].view(np.int32), sketch.view(np.int64)


_SET_SCHEMA = (
    "doc_id long, n_shingles long, d0 long, d1 long, tokens array<int>, "
    "s0 long, s1 long, s2 long, s3 long"
)


def _describe(shingle: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, hashes, at in shingle_sets(batch.column(1), shingle):
                n = len(at) - 1
                sizes = np.diff(at)
                full = sizes > 0
                xor, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
                tokens, sketch = np.zeros((n, trees), np.int32), np.zeros((n, 4), np.int64)
                if full.any():
                    xor[full], total[full], tokens[full], sketch[full] = _signatures(
                        hashes, np.append(at[:-1][full], at[-1]), trees
                    )
                flat = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, n * trees + 1, trees, dtype=np.int32)),
                    pa.array(tokens.reshape(-1)),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, n).cast(pa.int64()),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(xor),
                        pa.array(total),
                        flat,
                        *[pa.array(sketch[:, i].copy()) for i in range(4)],
                    ],
                    names=["doc_id", "n_shingles", "d0", "d1", "tokens", "s0", "s1", "s2", "s3"],
                )

    return run


def set_signatures(docs: DataFrame, id_col: str, text_col: str, settings: Settings) -> DataFrame:
    """(doc_id, n_shingles, set digest, root tokens, sketch) of each row, one pass over the texts."""
    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    return map_arrow(texts, _describe(settings.shingle, settings.trees), _SET_SCHEMA)


SKETCH = ["s0", "s1", "s2", "s3"]


def _differing(left: list[Column], right: list[Column]) -> Column:
    """How many of the 64 four-bit tokens differ."""
    total = None
    for a, b in zip(left, right, strict=True):
        x = a.bitwiseXOR(b)
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(0x1111111111111111))
        total = F.bit_count(x) if total is None else total + F.bit_count(x)
    return total


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


ROW = ["id", "size", "rest", *SKETCH, "star"]


def _slack(percent: int, prefix: str = "") -> Column:
    """Not negative: the member is near enough to the core to be linked with all others that are."""
    return (100 - percent) * F.col(f"{prefix}size") - (100 + percent) * F.col(f"{prefix}rest")


def _may_link(settings: Settings) -> Column:
    """Whether the sketches of two remainders allow the link that the sizes ask for.

    ``rest`` is the size of the remainder; with no core taken out it is the whole set. Members with
    a star are linked through it already.
    """
    a, b = F.col("rest"), F.col("o_rest")
    need = -(_slack(settings.percent) + _slack(settings.percent, "o_")) / (2 * (100 + settings.percent))
    shared = F.greatest(need, F.lit(0.0))  # as much of the remainders must be common
    similar = shared / F.greatest(a + b - shared, F.lit(1.0))
    chance = similar + (1 - similar) / 16
    expected = COORDINATES * chance
    least = expected - settings.deviations * F.sqrt(COORDINATES * chance * (1 - chance))
    equal = COORDINATES - _differing([F.col(c) for c in SKETCH], [F.col(f"o_{c}") for c in SKETCH])
    unknown = F.col("star").isNull() | F.col("o_star").isNull()
    return unknown & ((need <= 0) | ((shared <= F.least(a, b)) & (equal >= least)))


def _other(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"o_{c}") for c in rows.columns])


def _with(rows: DataFrame, few: DataFrame, how: str = "inner") -> DataFrame:
    """Join by node to a stored table of nodes; broadcast if small, so that rows of a large node stay
    where they are."""
    few = few.select(F.col("node").alias("at"), *[c for c in few.columns if c != "node"])
    few = F.broadcast(few) if few.count() <= MAX_BROADCAST_IDS // 2 else few.hint("merge")
    joined = rows.join(few, F.col("node") == F.col("at"), how)
    return joined if how == "left_anti" else joined.drop("at")


def _small_pairs(rows: DataFrame, settings: Settings) -> DataFrame:
    """Candidates in nodes of few members: all pairs of a node."""
    n = F.count(F.lit(1)).over(Window.partitionBy("node"))
    rows = rows.withColumn("n", n).filter("n > 1").drop("n")
    met = rows.hint("merge").join(_other(rows), (F.col("node") == F.col("o_node")) & (F.col("id") < F.col("o_id")))
    return met.filter(_may_link(settings)).select(F.col("id").alias("a"), F.col("o_id").alias("b")).distinct()


BLOCK = 512


def _block_pairs(rows: DataFrame, settings: Settings) -> DataFrame:
    """Candidates among all pairs of the nodes that no level has parted; ``n`` is the node's size.

    The exact way for what is left. Members are dealt to blocks, and every two blocks meet under a key
    of their own, so no task holds a node.
    """
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("id", F.lit("block")), blocks)

    def meet(i: Column, j: Column, side: int) -> Column:
        return F.struct(F.xxhash64("node", i, j).alias("key"), F.lit(side).alias("side"), (i == j).alias("same"))

    keys = F.concat(
        F.transform(F.sequence(own, blocks - 1), lambda j: meet(own, j, 0)),
        F.transform(F.sequence(F.lit(0).cast("long"), own), lambda i: meet(i, own, 1)),
    )
    dealt = settle(rows.select(*ROW, F.inline(keys)), "blocks")
    left = dealt.filter("side = 0").drop("side")
    right = _other(dealt.filter("side = 1").drop("side", "same"))
    met = left.hint("merge").join(
        right, (F.col("key") == F.col("o_key")) & (F.col("id") != F.col("o_id")) & (~F.col("same") | (F.col("id") < F.col("o_id")))
    )
    return met.filter(_may_link(settings)).select(*_pair(F.col("id"), F.col("o_id"))).distinct()


_REMAINDER = "node long, id long, size long, rest long, s0 long, s1 long, s2 long, s3 long, branch array<int>, blob binary"


def _remainders(level: int, children: int):
    """Of rows sorted by key, heads first: the remainder of each member beside the core of the heads.

    In memory are the heads' sets of one key, one batch of members and the remainders of some.
    """

    def chosen(node: np.ndarray) -> np.ndarray:
        """Coordinates that select the children of each node, others in each tree."""
        drawn = mix(node.view(np.uint64) + np.uint64(level + 1))
        step = (drawn >> np.uint64(32)) | np.uint64(1)
        at = drawn[:, None] + step[:, None] * np.arange(children, dtype=np.uint64)
        return (at % np.uint64(COORDINATES)).astype(np.int64)

    def described(batch: pa.RecordBatch, kept: list[int], rests: list[np.ndarray]) -> pa.RecordBatch:
        rows = batch.take(pa.array(kept))
        size = np.array([len(r) for r in rests])
        sketch = np.zeros((len(kept), 4), np.int64)
        branch = np.zeros((len(kept), children), np.int32)
        full = np.flatnonzero(size)
        if len(full):
            at = np.concatenate([[0], np.cumsum(size[full])])
            _, _, tokens, found = _signatures(np.concatenate([rests[i] for i in full]), at, COORDINATES)
            at = chosen(rows.column("node").to_numpy()[full])
            sketch[full], branch[full] = found, np.take_along_axis(tokens, at, axis=1)
        ends = np.arange(0, children * len(kept) + 1, children, dtype=np.int32)
        return pa.RecordBatch.from_arrays(
            [
                rows.column("node"),
                rows.column("id"),
                rows.column("size"),
                pa.array(size.astype(np.int64)),
                *[pa.array(sketch[:, c].copy()) for c in range(4)],
                pa.ListArray.from_arrays(pa.array(ends), pa.array(branch.reshape(-1))),
                pa.array([r.tobytes() for r in rests], pa.binary()),
            ],
            names=["node", "id", "size", "rest", *SKETCH, "branch", "blob"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, heads, core = None, [], None
        for batch in batches:
            keys, is_head = batch.column("key").to_pylist(), batch.column("is_head").to_pylist()
            blobs = batch.column("blob")
            kept, rests, tokens = [], [], 0
            for i, k in enumerate(keys):
                held = np.frombuffer(blobs[i].as_buffer(), np.uint64)
                if k != key:
                    key, heads, core = k, [], None
                if is_head[i]:
                    heads.append(held.copy())
                    continue
                if core is None:
                    shingles, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *heads]), return_counts=True)
                    core = shingles[2 * n > len(heads)]
                kept.append(i)
                rests.append(np.setxor1d(held, core, assume_unique=True))
                tokens += len(rests[-1])
                if tokens > SLICE_BYTES:
                    yield described(batch, kept, rests)
                    kept, rests, tokens = [], [], 0
            if kept:
                yield described(batch, kept, rests)

    return run


def _take_out_cores(members: DataFrame, level: int, settings: Settings, per_key: int = 256) -> DataFrame:
    """(node, id, size, rest, sketch, branch, blob) of the members (node, id, n, size, blob) of large nodes,
    their remainders in place of their sets.

    A node's members are dealt to keys of about ``per_key``, and its heads, drawn by hash, go to each.
    """
    keys = F.ceil(F.col("n") / per_key)
    is_head = F.pmod(F.xxhash64("node", "id", F.lit("head")), F.col("n")) < settings.heads
    salt = F.pmod(F.xxhash64("id", F.lit("salt")), keys)
    rows = members.select("node", "id", "size", "blob", F.xxhash64("node", salt).alias("key"), F.lit(False).alias("is_head"))
    heads = members.filter(is_head).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), keys - 1)))
    heads = heads.select("node", "id", "size", "blob", F.xxhash64("node", "salt").alias("key"), F.lit(True).alias("is_head"))
    met = rows.unionByName(heads).repartition("key").sortWithinPartitions("key", F.desc("is_head"))
    return map_arrow(met, _remainders(level, settings.children), _REMAINDER)


def candidates(
    classes: DataFrame, settings: Settings, sets_of: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame | None]:
    """Distinct pairs (a, b), a < b, of classes whose sketches allow the wanted similarity, and the
    links of members near the core of a large node, which are certain.

    ``sets_of`` gives the sets (id, blob) for a stored table of ids.
    """
    size = F.col("n_shingles").alias("size")
    rows = classes.select(
        "id", size, F.col("n_shingles").alias("rest"), *SKETCH, F.lit(None).cast("long").alias("star"),
        F.posexplode("tokens").alias("tree", "token"),
    )
    rows = rows.select(F.xxhash64("tree", "token").alias("node"), *ROW)
    found, links, stored = [], None, None
    for level in range(settings.max_levels + 1):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("star").isNull()).alias("free"))
        # Nodes of members that are linked already have nothing to find.
        large = settle(sizes.filter((F.col("n") > settings.small) & (F.col("free") > 0)).select("node", "n"), "large")
        small = rows
        if level:
            done = settle(sizes.filter((F.col("n") > settings.small) & (F.col("free") == 0)).select("node"), "done")
            small = _with(small, done, "left_anti")
        found.append(settle(_small_pairs(_with(small, large, "left_anti").select("node", *ROW), settings), "pairs"))
        if large.isEmpty():
            break
        if level == settings.max_levels:
            found.append(settle(_block_pairs(_with(rows.select("node", *ROW), large), settings), "pairs"))
            break
        if stored is None:
            inside = settle(_with(rows.select("node", "id"), large), "inside")
            sets = sets_of(settle(inside.select("id").distinct(), "inside-ids"))
            members = inside.join(sets, "id").withColumn("size", (F.octet_length("blob") / 8).cast("long"))
        else:
            inside = _with(rows.select("node", "id", "size", "parent"), large)
            sets = stored.select(F.col("node").alias("parent"), "id", "size", "blob").hint("merge")
            members = inside.join(sets, ["parent", "id", "size"])
        members = settle(members.select("node", "id", "n", "size", "blob"), "members")
        stored = settle(_take_out_cores(members, level, settings), "remainders")

        slack = _slack(settings.percent)
        nearest = stored.groupBy("node").agg(F.max(F.struct(slack.alias("slack"), F.col("id").alias("id"))).alias("near"))
        nearest = settle(nearest.select("node", F.col("near.id").alias("near"), F.col("near.slack").alias("near_slack")), "nearest")
        starred = _with(stored.drop("blob"), nearest).withColumn(
            "star", F.when((F.col("id") == F.col("near")) | (slack + F.col("near_slack") >= 0), F.col("near"))
        )
        new = starred.filter("star <> id").select(*_pair(F.col("id"), F.col("star"))).distinct()
        new = settle(new, "star-links")
        links = new if links is None else links.unionByName(new)
        # What is equal to the core shares no remainder with anybody.
        children = starred.filter("rest > 0").select(
            F.col("node").alias("parent"), *ROW, F.posexplode("branch").alias("which", "token")
        )
        rows = settle(
            children.select(F.xxhash64("parent", "which", "token").alias("node"), "parent", *ROW), "children"
        )
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct(), links


def _confirm(percent: int):
    """Of rows sorted by key, head first: compare the members with the head of their key.

    In memory are the sets of one head (several only if rows of different texts repeat its id; a
    link of any of them counts) and one batch of members.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, heads, head_id, linked = None, [], None, None
        for batch in batches:
            left, right = [], []
            keys = batch.column(0).to_pylist()
            ids = batch.column(1).to_pylist()
            is_head = batch.column(2).to_pylist()
            blobs = batch.column(3)
            for i, k in enumerate(keys):
                if k == key and not is_head[i] and ids[i] == linked:
                    continue
                own = np.frombuffer(blobs[i].as_buffer(), np.uint64)
                if is_head[i]:
                    if k != key:
                        key, heads, head_id, linked = k, [], ids[i], None
                    if not any(np.array_equal(own, h) for h in heads):
                        heads.append(own.copy())
                    continue
                if k != key:
                    raise RuntimeError("a member came without its head")
                for head in heads:
                    shared = len(np.intersect1d(head, own, assume_unique=True))
                    if 100 * shared >= percent * (len(head) + len(own) - shared):
                        left.append(head_id)
                        right.append(ids[i])
                        linked = ids[i]
                        break
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"]
            )

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, at in shingle_sets(batch.column(1), shingle):
                n = len(at) - 1
                blobs = [hashes[at[i] : at[i + 1]].tobytes() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(blobs, pa.binary()), batch.column(2).slice(first, n)],
                    names=["id", "blob", "roles"],
                )

    return run


def _plain_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, at in shingle_sets(batch.column(1), shingle):
                n = len(at) - 1
                blobs = [hashes[at[i] : at[i + 1]].tobytes() for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(blobs, pa.binary())], names=["id", "blob"]
                )

    return run


def sets_by_id(docs: DataFrame, id_col: str, text_col: str, ids: DataFrame, settings: Settings) -> DataFrame:
    """(id, blob) of the documents whose id is in the stored table; the hashes ascend in each blob."""
    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    sets = map_arrow(by_ids(texts, ids, "id", "left_semi"), _plain_sets(settings.shingle), "id long, blob binary")
    return sets.filter(F.octet_length("blob") > 0)


#: Roles (16 bytes each) that may be sent to every executor.
MAX_BROADCAST_ROLES = 500_000


def confirmed(
    docs: DataFrame, id_col: str, text_col: str, pairs: DataFrame, settings: Settings, per_key: int = 256
) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. ``pairs`` is a stored table.

    Each pair names a head, its member with more pairs, so few sets travel more than once. A
    head's pairs are dealt to keys of about ``per_key`` members. A document goes to the keys it
    has a role in, so the sets travel once, and only those of candidates are made.
    """
    sides = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    degree = sides.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    degree = settle(degree, "degree")
    ra = degree.select(F.col("id").alias("a"), F.col("n").alias("na"))
    rb = degree.select(F.col("id").alias("b"), F.col("n").alias("nb"))
    head_a = F.col("na") >= F.col("nb")
    dealt = pairs.join(ra, "a").join(rb, "b").select(
        F.when(head_a, F.col("a")).otherwise(F.col("b")).alias("head"),
        F.when(head_a, F.col("b")).otherwise(F.col("a")).alias("member"),
        F.greatest("na", "nb").alias("n"),
    )
    salt = F.pmod(F.xxhash64("member"), F.ceil(F.col("n") / per_key))
    dealt = settle(dealt.select("head", "member", F.xxhash64("head", salt).alias("key")), "dealt")
    heads = dealt.select(F.col("head").alias("id"), "key", F.lit(True).alias("is_head")).distinct()
    members = dealt.select(F.col("member").alias("id"), "key", F.lit(False).alias("is_head"))
    roles = heads.unionByName(members).groupBy("id").agg(
        F.collect_list(F.struct("key", "is_head")).alias("roles")
    )
    roles = settle(roles, "roles")
    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    # A pair makes two roles at most.
    if 2 * dealt.count() <= MAX_BROADCAST_ROLES:
        chosen = texts.join(F.broadcast(roles), "id")
    else:
        chosen = texts.join(roles.hint("merge"), "id")
    sets = map_arrow(
        chosen.select("id", "text", "roles"),
        _sets(settings.shingle),
        "id long, blob binary, roles array<struct<key: long, is_head: boolean>>",
    )
    spread = sets.select("id", "blob", F.inline("roles"))
    met = spread.repartition("key").sortWithinPartitions("key", F.desc("is_head"), "id")
    return map_arrow(
        met.select("key", "id", "is_head", "blob"), _confirm(settings.percent), "a long, b long"
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept.

    A-Z count as a-z. Null and empty texts have no shingles and stay, linked with nothing. Rows
    without an id have no component and stay. Rows that repeat an id are one document: they are
    linked with each other through it. An empty table gives an empty one. Other columns of ``docs`` are
    not read.
    """
    rows = settle(set_signatures(docs, id_col, text_col, settings), "sets")
    identified = rows.filter("doc_id is not null")
    full = identified.filter("n_shingles > 0")
    digest = ["n_shingles", "d0", "d1"]
    classes = full.groupBy(*digest).agg(
        F.min(F.struct("doc_id", "tokens", *SKETCH)).alias("first"),
    )
    classes = settle(
        classes.select(*digest, F.col("first.doc_id").alias("id"), "first.tokens", *[f"first.{c}" for c in SKETCH]),
        "classes",
    )

    def confirm(pairs: DataFrame) -> DataFrame:
        return confirmed(docs, id_col, text_col, pairs, settings)

    pairs, stars = candidates(
        classes, settings, lambda ids: sets_by_id(docs, id_col, text_col, ids, settings)
    )
    links = settle(confirm(settle(pairs, "candidates")), "links")
    if stars is not None:
        links = links.unionByName(stars)
    # Rows that repeat an id tie the classes of their texts together.
    repeated = (
        full.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    )
    ties = (
        by_ids(full, settle(repeated, "repeated"), "doc_id", "left_semi")
        .join(classes.select(*digest, "id"), digest)
        .select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    )
    found = components(links.unionByName(ties))
    lowest = (
        classes.select(*digest, "id")
        .join(found.withColumnRenamed("id", "node"), F.col("id") == F.col("node"), "left")
        .select(*digest, F.coalesce("component", "id").alias("component"))
    )
    linked = full.join(lowest, digest).select("doc_id", "n_shingles", "component")
    alone = rows.filter("doc_id is null or n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component")
    )
    return linked.unionByName(alone).select(
        "doc_id",
        "n_shingles",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``near_duplicates``."""
    marked = near_duplicates(docs, id_col, text_col, settings)
    dropped = settle(marked.filter(~F.col("kept")).select("doc_id").distinct(), "dropped")
    return by_ids(docs, dropped, id_col, "left_anti")
