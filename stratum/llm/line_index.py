"""Repeated lines removed by a sharded minimal perfect hash over line hashes.

A line is known by a 128-bit hash of its key: stripped at both ends, A-Z lower-cased. One grouping
gives each distinct hash its number of documents and its last holder. The hashes held by enough
documents are dealt to shards; each shard is a minimal perfect hash (levels of bits: a key whose place
is its own in a level is settled there, the others go on) that numbers its hashes without gaps, and
arrays at these numbers: a fingerprint (the other half of the hash), the count and the last holder.
A line that is in no shard meets a wrong fingerprint, so lines of few documents need no entry.

Documents are not joined to lines. Their line hashes travel to the shard that would know them, right
behind its arrays, and probe those as they stream by: no task holds more than one shard. The few
lines with a large share of all rows (at most ``HOT_LINES``, by their counts) make one more small index
that every task has, so their probes are decided where they arise and travel nowhere.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.llm.common import fresh, map_arrow, settle, ship_package, text_of
from stratum.llm.textbytes import IS_SPACE, LOWER, Slice, mix, slices, words

#: A line that makes up more than one part in so many of the repeated lines is hot: so there are fewer.
HOT_LINES = 5000
#: Hashes of a shard, 21 bytes each.
SHARD_ROWS = 50_000
#: Stands for a null id; smaller than any other.
NO_ID = -(1 << 63)


class Lines(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    per_doc: np.ndarray  # index of the first line of each document, documents + 1


def lines_of(part: Slice) -> Lines:
    """Lines between the \\n of each text; an empty text has one empty line."""
    breaks = np.flatnonzero(part.data == 10)
    starts = np.sort(np.concatenate([part.offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([breaks, part.offsets[1:]]), kind="stable")
    docs = np.arange(len(part.offsets))
    return Lines(starts, ends, np.searchsorted(breaks, part.offsets) + docs)


class Keys(NamedTuple):
    line: np.ndarray  # index among the lines of the slice
    high: np.ndarray
    low: np.ndarray


def keys_of(part: Slice, lines: Lines, min_chars: int) -> Keys:
    """Hashes of the keys of at least ``min_chars`` code points."""
    cut = words(part, ~IS_SPACE)
    first = np.searchsorted(cut.starts, lines.starts)
    last = np.searchsorted(cut.starts, lines.ends)
    line = np.flatnonzero(last > first)
    begin, end = cut.starts[first[line]], cut.ends[last[line] - 1]
    long_enough = end - begin >= min_chars
    line, begin, end = line[long_enough], begin[long_enough], end[long_enough]
    if len(line) and part.data.max() >= 128:
        points = np.zeros(len(part.data) + 1, np.int32)
        np.cumsum((part.data & 0xC0) != 0x80, out=points[1:], dtype=np.int32)
        long_enough = points[end] - points[begin] >= min_chars
        line, begin, end = line[long_enough], begin[long_enough], end[long_enough]
    raw = LOWER[part.data].tobytes()
    digest = xxhash.xxh3_128_digest
    found = b"".join([digest(raw[a:b]) for a, b in zip(begin.tolist(), end.tolist())])
    halves = np.frombuffer(found, ">u8").reshape(-1, 2).astype(np.uint64)
    return Keys(line, halves[:, 0], halves[:, 1])


def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    return (((mix(low ^ mix(high + seed)) >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)


class LineIndex:
    """Minimal perfect hash over distinct 128-bit hashes with the arrays it numbers."""

    def __init__(self, sizes, bits, ranks, prints, counts, last):
        self.sizes, self.bits, self.ranks = sizes, bits, ranks
        self.prints, self.counts, self.last = prints, counts, last

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray, counts: np.ndarray, last: np.ndarray) -> LineIndex:
        sizes, bits, slot = [], [], np.zeros(len(high), np.int64)
        left, settled = np.arange(len(high)), 0
        while len(left):
            size = 64 * (-(-2 * len(left) // 64))
            at = _place(high[left], low[left], len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            mine = alone[at]
            slot[left[mine]] = settled + np.cumsum(alone)[at[mine]] - 1
            settled += int(mine.sum())
            left = left[~mine]
            sizes.append(size)
            bits.append(np.packbits(alone, bitorder="little").view(np.uint64))
            if len(sizes) > 500:
                raise ValueError("the hashes of a shard are not distinct")
        words = np.concatenate([np.zeros(0, np.uint64), *bits])
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.uint32)]).astype(np.uint32)
        arrays = [np.empty(len(high), kind) for kind in (np.uint64, np.uint32, np.int64)]
        for array, values in zip(arrays, (low, np.minimum(counts, 2**32 - 1), last)):
            array[slot] = values
        return cls(np.array(sizes, np.int64), words, ranks, *arrays)

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for hashes that are not in the index."""
        slot = np.full(len(high), -1, np.int64)
        left, base = np.arange(len(high)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = _place(high[left], low[left], level, size)
            word, bit = base + (at >> 6), (at & 63).astype(np.uint64)
            row = self.bits[word]
            here = (row >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(row & ((np.uint64(1) << bit) - np.uint64(1)))
            slot[left[here]] = self.ranks[word[here]] + below[here]
            left = left[~here]
            base += size >> 6
        inside = np.flatnonzero(slot >= 0)
        slot[inside[self.prints[slot[inside]] != low[inside]]] = -1
        return slot

    def lost(self, high: np.ndarray, low: np.ndarray, holder: np.ndarray, min_docs: int) -> np.ndarray:
        """Whether each document (``holder``) loses this line: in the index, and held last elsewhere."""
        slot = self.find(high, low)
        out = np.zeros(len(high), bool)
        inside = np.flatnonzero(slot >= 0)
        slot = slot[inside]
        out[inside] = (self.counts[slot] >= min_docs) & (self.last[slot] != holder[inside])
        return out

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(
            out, sizes=self.sizes, bits=self.bits, ranks=self.ranks,
            prints=self.prints, counts=self.counts, last=self.last,
        )
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> LineIndex:
        with np.load(io.BytesIO(blob), allow_pickle=False) as held:
            return cls(*(held[n] for n in ("sizes", "bits", "ranks", "prints", "counts", "last")))


def _light(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Holder (the id), row (a hash of the text) and text; equal rows are one document."""
    text = text_of(text_col)
    return docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("holder"),
        F.xxhash64(text).alias("row"),
        text.alias("text"),
    )


def _distinct_lines(light: DataFrame, min_chars: int) -> DataFrame:
    """Each line hash of a text once, with its holder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            holder = batch.column(0).to_numpy()
            for part in slices(batch.column(1)):
                lines = lines_of(part)
                keys = keys_of(part, lines, min_chars)
                doc = np.searchsorted(lines.per_doc, keys.line, "right") - 1
                order = np.lexsort((keys.low, keys.high, doc))
                doc, high, low = doc[order], keys.high[order], keys.low[order]
                new = np.ones(len(doc), bool)
                new[1:] = (np.diff(doc) != 0) | (high[1:] != high[:-1]) | (low[1:] != low[:-1])
                columns = [high[new].view(np.int64), low[new].view(np.int64), holder[doc[new] + part.first]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["high", "low", "holder"])

    return map_arrow(light.select("holder", "text"), run, "high long, low long, holder long")


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20
) -> DataFrame:
    """high, low (halves of the hash), docs and last holder of the line keys held by ``min_docs`` ids."""
    light = _light(docs, id_col, text_col)
    lines = _distinct_lines(light, min_chars)
    ids = light.groupBy("holder").agg(F.count(F.lit(1)).alias("n"))
    if not ids.filter("n > 1").isEmpty():  # rows that share an id are one document
        lines = lines.distinct()
    held = lines.groupBy("high", "low").agg(F.count(F.lit(1)).alias("docs"), F.max("holder").alias("last"))
    return held.filter(F.col("docs") >= min_docs)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def build_shards(repeated: DataFrame, shards: int) -> DataFrame:
    """One row per shard with hashes: its number and its index."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        index = LineIndex.build(
            _column(table, "high").view(np.uint64),
            _column(table, "low").view(np.uint64),
            _column(table, "docs"),
            _column(table, "last"),
        )
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "arrays": pa.array([index.dump()], pa.binary())})

    ship_package(repeated.sparkSession)
    dealt = repeated.withColumn("shard", F.pmod("high", F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(run, "shard int, arrays binary")


_PROBE = "shard int, high long, low long, holder long, row long, line int, decided boolean"


def _probes(light: DataFrame, hot: bytes, shards: int, min_docs: int, min_chars: int) -> DataFrame:
    """A row per line of a text that must be looked up, or that the hot index has found to go."""
    names = StructType.fromDDL(_PROBE).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = LineIndex.load(hot)
        for batch in batches:
            holders, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for part in slices(batch.column(2)):
                lines = lines_of(part)
                line, high, low = keys_of(part, lines, min_chars)
                doc = np.searchsorted(lines.per_doc, line, "right") - 1
                number = (line - lines.per_doc[doc]).astype(np.int32)
                holder, row = holders[doc + part.first], rows[doc + part.first]
                is_hot = index.find(high, low) >= 0
                decided = index.lost(high, low, holder, min_docs)
                # Decided lines go anywhere; the row and the line spread them.
                spread = mix(row.view(np.uint64) + number.astype(np.uint64)).view(np.int64)
                shard = np.where(decided, spread, high.view(np.int64)) % shards
                sent = decided | ~is_hot
                columns = [shard.astype(np.int32), high.view(np.int64), low.view(np.int64), holder, row, number, decided]
                yield pa.RecordBatch.from_arrays([pa.array(c[sent]) for c in columns], names=names)

    return map_arrow(light, run, _PROBE)


def _found(shard_rows: DataFrame, min_docs: int) -> DataFrame:
    """The lines that go, from shards and their probes, each shard's arrays before its probes."""
    names = ["holder", "row", "line"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, of_shard = None, None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            arrays = batch.column("arrays")
            is_index = arrays.is_valid().to_numpy(zero_copy_only=False)
            decided = batch.column("decided").fill_null(False).to_numpy(zero_copy_only=False)
            high, low, holder = (batch.column(n).fill_null(0).to_numpy() for n in ("high", "low", "holder"))
            lost = np.array(decided)
            cuts = np.flatnonzero((np.diff(shard) != 0) | is_index[1:]) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(shard)]):
                if lo < hi and is_index[lo]:
                    index, of_shard = LineIndex.load(arrays[int(lo)].as_py()), shard[lo]
                if lo == hi or index is None or shard[lo] != of_shard:
                    continue
                seen = index.lost(high[lo:hi].view(np.uint64), low[lo:hi].view(np.uint64), holder[lo:hi], min_docs)
                lost[lo:hi] |= seen & ~is_index[lo:hi]
            kept = pa.array(lost)
            yield pa.RecordBatch.from_arrays([batch.column(n).filter(kept) for n in names], names=names)

    return map_arrow(shard_rows, run, "holder long, row long, line int")


def _rewritten(part: Slice, dropped: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lines, lines that go, bytes that stay, their offsets); ``dropped`` lists line numbers per text."""
    lines = lines_of(part)
    n = np.diff(lines.per_doc)
    lost = np.zeros(len(lines.starts), bool)
    gone = dropped.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    numbers = dropped.flatten().to_numpy()
    lost[np.repeat(lines.per_doc[:-1], gone) + numbers] = True
    size = lines.ends - lines.starts + 1  # with its \n
    size[lines.per_doc[1:] - 1] -= 1  # the last line of a text has none
    stays = np.repeat(~lost, size)
    # The \n of the last line that stays goes if lines after it go.
    kept = np.flatnonzero(~lost)
    last = np.searchsorted(kept, lines.per_doc[1:]) - 1
    has_any = last >= np.searchsorted(kept, lines.per_doc[:-1])
    last = kept[last[has_any]]
    last = last[last != lines.per_doc[1:][has_any] - 1]
    stays[lines.ends[last]] = False
    kept_bytes = np.zeros(len(part.offsets), np.int64)
    size[lost] = 0
    size[last] -= 1
    np.cumsum(np.add.reduceat(size, lines.per_doc[:-1]), out=kept_bytes[1:])
    return n, gone, part.data[stays], kept_bytes


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 3,
    min_chars: int = 20,
    hot_lines: int = HOT_LINES,
) -> DataFrame:
    """``docs`` without the lines that many documents hold, and with n_lines and n_dropped.

    A line whose key (stripped of ASCII white space, A-Z lower-cased) has at least ``min_chars`` code
    points and occurs under at least ``min_docs`` ids goes from all of them but the largest, which
    keeps all its copies. The lines that stay are joined by \\n; a null text is empty and an empty text
    has one empty line. Rows that share an id are one document; a null id is one more id, smaller than
    all others. Ids are integers. An empty table gives an empty one. Columns named n_lines and
    n_dropped (in any letter case) are replaced.
    """
    spark = docs.sparkSession
    repeated = settle(repeated_lines(docs, id_col, text_col, min_docs, min_chars), "repeated-lines")
    held, distinct = repeated.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.count(F.lit(1))).first()
    is_hot = F.col("docs") > held // hot_lines if hot_lines else F.lit(False)
    hot = repeated.filter(is_hot).toArrow()  # fewer than hot_lines rows
    hot = LineIndex.build(
        _column(hot, "high").view(np.uint64), _column(hot, "low").view(np.uint64), _column(hot, "docs"), _column(hot, "last")
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(8 * partitions, -(-distinct // SHARD_ROWS))
    light = _light(docs, id_col, text_col)
    probes = _probes(light, hot.dump(), shards, min_docs, min_chars)
    indexed = build_shards(repeated.filter(~is_hot), shards)
    met = indexed.unionByName(probes, allowMissingColumns=True).repartition(partitions, "shard")
    met = met.sortWithinPartitions("shard", F.col("arrays").isNull())
    lost = _found(met, min_docs).groupBy("holder", "row").agg(F.collect_set("line").alias("lost"))

    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    text_name = next(c for c in kept if c.lower() == text_col.lower())
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    holder, row, numbers = fresh(rows, "holder", "row", "lost")
    keyed = rows.withColumns({
        text_name: text_of(text_name),
        holder: F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)),
        row: F.xxhash64(text_of(text_name)),
    })
    lost = lost.select(F.col("holder").alias(holder), F.col("row").alias(row), F.col("lost").alias(numbers))
    joined = keyed.join(lost, [holder, row], "left").select(*[F.col(f"`{c}`") for c in kept], F.col(numbers))
    schema = StructType([*joined.schema.fields[:-1], *StructType.fromDDL("n_lines long, n_dropped long").fields])
    at = kept.index(text_name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(at)):
                own = batch.slice(part.first, len(part.offsets) - 1)
                n, gone, data, offsets = _rewritten(part, own.column(len(kept)))
                texts = pa.LargeStringArray.from_buffers(
                    len(n), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))
                ).cast(pa.string())
                columns = own.columns[:-1]
                columns[at] = texts
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n), pa.array(gone)], names=schema.names)

    return map_arrow(joined, run, schema)
