"""Hard negatives by rotated one-bit codes with deterministic intervals.

Vectors become whole numbers; scores are inner products of these, exact. A vector v is rotated by a
fixed random rotation and keeps one bit per component, the sign: the code. With it are stored the norm
of v and the alignment, the cosine between v and the vector x of its signs. An anchor q is rotated too
and its components are rounded to 8 bits, so that <q, x> comes from population counts of the code under
the 8 bit planes, with a known rounding error. The part of v off x is at right angles to x, so by
Cauchy-Schwarz it adds at most |q off x| * |v off x| to <q, v>, and both lengths follow from what is
stored. This gives an interval that holds the score for certain; only rows whose interval can still
reach a result are scored in whole numbers, so the results are exact.

All anchors meet all rows in cells of a block of rows and a block of anchors, each of bounded size, in
two rounds: the positives of each anchor, then for each anchor and positive the negatives in its band.
A cell sends the few best of its block; windows choose among these.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.llm.common import map_arrow, settle, ship_package

SEED = 20240229
PLANES = 8
SCALE = 256
MAX_BLOCK_ROWS, MIN_BLOCK_ROWS = 16_384, 4_096
BLOCK_ANCHORS = 1_024
STEP = 64  # anchors whose intervals are in memory at a time
MAX_COMPONENT = 1 << 62


@lru_cache(maxsize=8)
def rotation(size: int) -> np.ndarray:
    """The same random rotation in every task."""
    gauss = np.random.Generator(np.random.PCG64(SEED)).standard_normal((size, size))
    q, r = np.linalg.qr(gauss)
    return q * np.sign(np.diag(r))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1, bitorder="little")
    padded = np.zeros((len(packed), -(-packed.shape[1] // 8) * 8), np.uint8)
    padded[:, : packed.shape[1]] = packed
    return padded.view(np.uint64)


class Codes(NamedTuple):
    words: np.ndarray
    norm: np.ndarray
    alignment: np.ndarray


def encode(vectors: np.ndarray) -> Codes:
    rotated = vectors.astype(np.float64) @ rotation(vectors.shape[1])
    norm = np.sqrt((rotated * rotated).sum(axis=1))
    ends = np.abs(rotated).sum(axis=1) / np.sqrt(max(1, vectors.shape[1]))
    alignment = np.divide(ends, norm, out=np.ones(len(norm)), where=norm > 0)
    return Codes(_packed(rotated >= 0), norm, np.minimum(alignment, 1.0))


def intervals(anchors: np.ndarray, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest possible score, one row per anchor."""
    size = anchors.shape[1]
    rotated = anchors.astype(np.float64) @ rotation(size)
    norm = np.sqrt((rotated * rotated).sum(axis=1))[:, None]
    low = rotated.min(axis=1, initial=0.0)[:, None]
    step = (rotated.max(axis=1, initial=0.0)[:, None] - low) / (2**PLANES - 1)
    rounded = np.rint(np.divide(rotated - low, step, out=np.zeros_like(rotated), where=step > 0)).astype(np.int64)
    ones = np.bitwise_count(codes.words).sum(axis=1, dtype=np.int64)[None, :]
    counted = np.zeros((len(anchors), len(codes.norm)), np.int64)
    for plane in range(PLANES):
        bits = _packed((rounded >> plane) & 1 == 1)
        for w in range(codes.words.shape[1]):
            counted += np.bitwise_count(codes.words[None, :, w] & bits[:, w, None]).astype(np.int64) << plane
    root = np.sqrt(max(1, size))
    # Signs are 2 * bit - 1.
    along = (2 * (low * ones + step * counted) - rotated.sum(axis=1)[:, None]) / root
    off = step * ones / root
    alignment, length = codes.alignment[None, :], codes.norm[None, :]
    least = np.maximum(np.abs(along) - off, 0)
    width = alignment * off + np.sqrt(np.maximum(norm**2 - least**2, 0)) * np.sqrt(np.maximum(1 - alignment**2, 0))
    middle = length * alignment * along
    width = length * width + 1e-9 * (size + 1) * norm * length + 0.5  # and the error of the arithmetic
    return middle - width, middle + width


class Exact:
    """Inner products in whole numbers; as floats only where these are exact."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.largest = int(np.abs(vectors).max(initial=0))
        self.floats = vectors.astype(np.float64) if self.largest < 1 << 26 else None

    def of(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        most = int(np.abs(anchor).max(initial=0)) * self.largest * max(1, len(anchor))
        if self.floats is not None and most < 1 << 53:
            return (self.floats[rows] @ anchor.astype(np.float64)).astype(np.int64)
        if most < 1 << 63:
            return self.vectors[rows] @ anchor
        exact = self.vectors[rows].astype(object) @ anchor.astype(object)
        if any(abs(x) >= 1 << 63 for x in exact):
            raise OverflowError("an inner product does not fit 64 bits")
        return exact.astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` by falling score, then by id."""
    if len(scores) > 4 * k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= bar)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def best_rows(low, high, ids, exact: Callable, k: int, floor=-np.inf, ceiling=np.inf) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the first ``k`` with floor <= score <= ceiling.

    Rows are scored in the order of their highest possible score and the search ends when no row that
    is left can reach the k-th best found.
    """
    open_rows = np.flatnonzero((high >= floor) & (low <= ceiling))
    rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(open_rows) > k:
        certain = low[open_rows][(low[open_rows] >= floor) & (high[open_rows] <= ceiling)]
        if len(certain) >= k:  # so many scores are in the band and no lower than this
            open_rows = open_rows[high[open_rows] >= np.partition(certain, len(certain) - k)[len(certain) - k]]
    take = 8 * k
    while len(open_rows):
        if len(open_rows) > take:
            split = np.argpartition(-high[open_rows], take)
            now, open_rows = open_rows[split[:take]], open_rows[split[take:]]
        else:
            now, open_rows = open_rows, open_rows[:0]
        found = exact(now)
        inside = (found >= floor) & (found <= ceiling)
        rows, scores = np.concatenate([rows, now[inside]]), np.concatenate([scores, found[inside]])
        chosen = _best(scores, ids[rows], k)
        rows, scores = rows[chosen], scores[chosen]
        if len(rows) == k:
            open_rows = open_rows[high[open_rows] >= scores[-1]]
        take *= 4
    return rows, scores


def _matrices(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, rows, their vectors) for each size of vector."""
    column = table.column("q").combine_chunks()
    sizes = column.value_lengths().to_numpy()
    at = np.concatenate([[0], np.cumsum(sizes)])
    flat = column.flatten().to_numpy()
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield size, rows, flat[at[rows][:, None] + np.arange(size)].reshape(len(rows), size)


def _cells(rows: pa.Table, anchors: pa.Table):
    """Per anchor of a cell that meets rows of its size: its place, the rows, whether their label is its own,
    lowest and highest scores, and the exact score of chosen rows."""
    labels = pa.chunked_array([*rows.column("label").chunks, *anchors.column("label").chunks]).combine_chunks()
    labels = labels.dictionary_encode().indices.to_numpy()
    row_label, anchor_label = labels[: len(rows)], labels[len(rows) :]
    words = rows.column("code").combine_chunks()
    norm, alignment = rows.column("norm").to_numpy(), rows.column("alignment").to_numpy()
    of_size = {size: (at, vectors) for size, at, vectors in _matrices(rows)}
    for size, at, queries in _matrices(anchors):
        if size not in of_size:
            continue
        mine, vectors = of_size[size]
        exact = Exact(vectors)
        packed = np.frombuffer(b"".join(words.take(pa.array(mine)).to_pylist()), np.uint64)
        codes = Codes(packed.reshape(len(mine), -1), norm[mine], alignment[mine])
        for first in range(0, len(at), STEP):
            low, high = intervals(queries[first : first + STEP], codes)
            for i, place in enumerate(at[first : first + STEP]):
                query = queries[first + i]
                same = row_label[mine] == anchor_label[place]
                yield place, mine, same, low[i], high[i], lambda r, q=query, e=exact: e.of(r, q)


def _positives(k: int):
    def run(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        ids, names = rows.column("id").to_numpy(), anchors.column("id").to_numpy()
        found = [(np.zeros(0, np.int64),) * 3]
        for place, mine, same, low, high, exact in _cells(rows, anchors):
            own = mine[same & (ids[mine] != names[place])]
            where = np.searchsorted(mine, own)
            chosen, scores = best_rows(low[where], high[where], ids[own], lambda r, w=where, e=exact: e(w[r]), k)
            found.append((np.full(len(chosen), names[place]), ids[own[chosen]], scores))
        return pa.table([np.concatenate(c) for c in zip(*found)], names=["anchor_id", "positive_id", "positive_score"])

    return run


def _once(exact: Callable, n: int) -> Callable:
    """``exact`` with each of its ``n`` rows scored once, for searches that share an anchor."""
    scores, known = np.zeros(n, np.int64), np.zeros(n, bool)

    def of(rows: np.ndarray) -> np.ndarray:
        new = rows[~known[rows]]
        if len(new):
            scores[new], known[new] = exact(new), True
        return scores[rows]

    return of


def _negatives(k: int, low_percent: int, high_percent: int):
    def run(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        ids, names = rows.column("id").to_numpy(), anchors.column("id").to_numpy()
        positives = anchors.column("positives").to_pylist()
        found = [(np.zeros(0, np.int64),) * 5]
        for place, mine, same, low, high, exact in _cells(rows, anchors):
            other = np.flatnonzero(~same)
            bounds = (low[other], high[other], ids[mine[other]])
            scored = _once(lambda r, o=other, e=exact: e(o[r]), len(other))
            known = {}  # positives of equal score share their band
            for positive in positives[place]:
                score = positive["positive_score"]
                if score not in known:
                    floor, ceiling = -(-low_percent * score // 100), high_percent * score // 100
                    known[score] = (np.zeros(0, np.int64),) * 2
                    if floor <= ceiling:
                        known[score] = best_rows(*bounds, scored, k, floor, ceiling)
                chosen, scores = known[score]
                n = len(chosen)
                found.append((
                    np.full(n, names[place]), np.full(n, positive["positive_id"]), np.full(n, score),
                    ids[mine[other[chosen]]], scores,
                ))
        columns = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        return pa.table([np.concatenate(c) for c in zip(*found)], names=columns)

    return run


def quantised(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label and whole-number vector q of the rows that take part, one row per id."""
    x = F.col(f"`{vector_col}`")
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.filter(
        F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & x.isNotNull() & finite
    ).select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.struct(
            F.col(f"`{label_col}`").alias("label"),
            F.transform(x, lambda c: F.floor(c.cast("double") * SCALE)).alias("q"),
        ).alias("row"),
    )
    return rows.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.q")


def index(rows: DataFrame) -> DataFrame:
    """``rows`` with code, norm and alignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            code = np.empty(len(batch), object)
            norm, alignment = np.zeros(len(batch)), np.ones(len(batch))
            for _, at, vectors in _matrices(table):
                if np.abs(vectors).max(initial=0) >= MAX_COMPONENT:
                    raise OverflowError("a component does not fit 62 bits")
                codes = encode(vectors)
                code[at] = [w.tobytes() for w in codes.words]
                norm[at], alignment[at] = codes.norm, codes.alignment
            made = [pa.array(code.tolist(), pa.binary()), pa.array(norm), pa.array(alignment)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=names)

    made = StructType.fromDDL("code binary, norm double, alignment double")
    schema = StructType([*rows.schema.fields, *made.fields])
    names = schema.names
    return map_arrow(rows, run, schema)


def _meet(rows: DataFrame, anchors: DataFrame, blocks: int, anchor_blocks: int, function, schema: str) -> DataFrame:
    """Each block of rows with each block of anchors, in one task each."""

    def dealt(df, own, n, other, m):
        every = F.sequence(F.lit(0), F.lit(m - 1))
        return df.withColumns({own: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"), other: F.explode(every)})

    cell = ["row_block", "anchor_block"]
    left = dealt(rows, "row_block", blocks, "anchor_block", anchor_blocks)
    right = dealt(anchors, "anchor_block", anchor_blocks, "row_block", blocks)
    ship_package(rows.sparkSession)
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(function, schema)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``anchors`` says of the column ``id`` which rows are anchors. The positives of an anchor are its
    best ``positives`` other rows of its label, its negatives for each of them the best ``negatives``
    rows of other labels whose score lies between ``low_percent`` and ``high_percent`` of the positive's;
    higher scores first, ties by smaller id. Components are taken as floor(256 x).

    Rows with a null id, label, vector or component, or a component that is not finite, take no part. Of rows
    that share an id the smallest by label and vector counts. Vectors of different sizes never meet; empty
    ones score 0. An empty table or one without anchors gives an empty one. Other columns are not read.
    Scores beyond 64 bits stop the job.
    """
    rows = settle(index(quantised(vectors, id_col, vector_col, label_col)), "vector-codes")
    n, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if(anchors)).first()
    blocks = max(1, -(-n // min(MAX_BLOCK_ROWS, max(MIN_BLOCK_ROWS, n // 64))))
    anchor_blocks = max(1, -(-n_anchors // BLOCK_ANCHORS))
    asked = settle(rows.filter(anchors).select("id", "label", "q"), "anchors")

    schema = "anchor_id long, positive_id long, positive_score long"
    near = _meet(rows, asked, blocks, anchor_blocks, _positives(positives), schema)
    first = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    near = near.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives)
    near = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    near = settle(near, "positives")

    asked = asked.join(near, F.col("id") == F.col("anchor_id")).select("id", "label", "q", "positives")
    schema += ", negative_id long, negative_score long"
    far = _meet(rows, asked, blocks, anchor_blocks, _negatives(negatives, low_percent, high_percent), schema)
    first = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    far = far.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= negatives)
    return far.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
