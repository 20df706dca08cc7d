"""SentencePiece encoding, decoding and sampling of distinct segmentations; see ``pieces``."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from stratum.llm import pieces
from stratum.llm.common import fresh, map_arrow
from stratum.llm.textbytes import Slice

FLATTEN = 1.0
DECODED_ROWS = 256  # lists of ids spelled at a time
KNOWN_IDS = 2_000_000  # ids of units kept from slice to slice


def default_model() -> str:
    """Path of the public 32,000 piece BPE model with byte fallback, on this machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _ship(spark: SparkSession, model_file: str) -> str:
    """Hand the model file to the executors, where its path need not exist; gives its name there."""
    spark.sparkContext.addFile(model_file)
    return os.path.basename(model_file)


def _located(name: str) -> str:
    """Path of a shipped file on this machine."""
    return SparkFiles.get(name)


def _append(docs: DataFrame, out: str, kind, batch_column) -> DataFrame:
    rest = [c for c in docs.columns if c.lower() != out.lower()]
    kept = docs.select(*[F.col(f"`{c}`") for c in rest])
    names = [*rest, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, batch_column(batch, rest)], names=names)

    return map_arrow(kept, run, StructType([*kept.schema.fields, StructField(out, kind)]))


def _lists(values: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(np.int32)))


def _encode(texts: list[str], model_file: str) -> tuple[np.ndarray, np.ndarray]:
    found = _processor(model_file).encode(texts, num_threads=1) if texts else []
    at = np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])
    return np.fromiter(chain.from_iterable(found), np.int64, int(at[-1])), at


def _encode_slice(part: Slice, cut: pieces.Units, model_file: str) -> tuple[np.ndarray, np.ndarray]:
    """The tokenizer's own ids of each text, from those of the distinct units.

    No piece spans two units, so merges in one don't touch another. Where that isn't sure the texts
    are encoded as a whole: a model that rewrites text, or a text that spells a space by the mark.
    """
    if not _by_unit(model_file) or pieces.SPACE_MARK.encode() in part.data.tobytes():
        raw, at = part.data.tobytes(), part.offsets.tolist()
        return _encode([raw[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])], model_file)
    ids, begin, size = _encode_units(cut, model_file)
    size = size[cut.kind]
    ends = np.concatenate([[0], np.cumsum(size)])
    from_ = np.repeat(begin[cut.kind] - ends[:-1], size) + np.arange(ends[-1])
    return ids[from_].astype(np.int64), ends[cut.per_doc]


@dataclass
class _Known:
    """Ids of the units of earlier slices, found by the sorted hashes of the units."""

    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    number: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    at: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))


_known: dict[str, _Known] = {}


def _encode_units(cut: pieces.Units, model_file: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids in which each distinct unit has a place, where it begins and how many it has.

    Units of earlier slices are not encoded again, until ``KNOWN_IDS`` are kept and a new store begins.
    """
    known = _known.get(model_file)
    if known is None or len(known.ids) > KNOWN_IDS:
        known = _known[model_file] = _Known()
    order = np.argsort(cut.hashes)
    hashes = cut.hashes[order]
    place = np.searchsorted(known.hashes, hashes)
    found = np.append(known.hashes, np.uint64(0))[place] == hashes
    found &= place < len(known.hashes)
    number = np.empty(len(hashes), np.int64)
    number[order[found]] = known.number[place[found]]
    if not found.all():
        missing = order[~found]
        raw = cut.data.tobytes()
        begin, end = cut.starts[cut.first[missing]], cut.ends[cut.first[missing]]
        # The processor puts the first space before a text, except before an empty one.
        names = [raw[a + 1 : b].decode("utf-8", "replace") for a, b in zip(begin.tolist(), end.tolist())]
        ids, at = _encode(["a" if x == "" else x for x in names], model_file)
        ids[at[:-1][end - begin == 1]] = _processor(model_file).piece_to_id(pieces.SPACE_MARK)
        number[missing] = len(known.at) - 1 + np.arange(len(missing))
        known.hashes = np.insert(known.hashes, place[~found], hashes[~found])
        known.number = np.insert(known.number, place[~found], number[missing])
        known.at = np.concatenate([known.at, known.at[-1] + at[1:]])
        known.ids = np.concatenate([known.ids, ids.astype(np.int32)])
    return known.ids, known.at[number], known.at[number + 1] - known.at[number]


@lru_cache(maxsize=4)
def _by_unit(model_file: str) -> bool:
    """Whether the model takes texts as they are and has no piece with a space after another byte."""
    model, mark = _processor(model_file), pieces.SPACE_MARK
    probe = " \u00a0\u3000a  \t\n\ufb01\u2460\u00e9e\u0301 \u200b\ufeff "
    return (
        model.normalize(probe) == mark + probe.replace(" ", mark)
        and model.id_to_piece(model.piece_to_id(mark)) == mark
        and len(model.encode("a")) == 1
        and not any(mark in model.id_to_piece(i).lstrip(mark) for i in range(model.get_piece_size()))
    )


_processors: dict = {}


def _processor(model_file: str):
    if model_file not in _processors:
        import sentencepiece

        _processors[model_file] = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return _processors[model_file]


def encode(docs: DataFrame, text_col: str = "text", out: str = "ids", model_file: str | None = None) -> DataFrame:
    """``docs`` with the tokenizer's own ids of each whole text, without special tokens.

    Null and empty texts have no ids. A column named ``out`` is replaced.
    """
    model_name = _ship(docs.sparkSession, model_file or default_model())

    def column(batch: pa.RecordBatch, names: list[str]) -> pa.Array:
        model_file = _located(model_name)
        found = [
            _lists(*_encode_slice(part, pieces.units_of(part), model_file))
            for part in pieces.text_slices(batch.column(names.index(text_col)))
        ]
        return pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.int32()))

    return _append(docs, out, ArrayType(IntegerType()), column)


def _spelled(ids: np.ndarray, at: np.ndarray, model_file: str, flatten: float):
    """Bytes that sequences of ids spell, and where the text of each begins and ends: the space that
    the tokenizer puts before a text is no part of it."""
    letters, ends = pieces.spell(ids, at, model_file, flatten)
    begin, end = ends[:-1], ends[1:]
    full = np.flatnonzero(end > begin)
    before = np.zeros(len(begin), np.int64)
    before[full] = letters[begin[full]] == 32
    return letters, begin + before, end


def decode(rows: DataFrame, ids_col: str = "ids", out: str = "text", model_file: str | None = None) -> DataFrame:
    """``rows`` with the text that the ids spell.

    Control ids and ids outside the model spell nothing; bytes that are no UTF-8 become the
    replacement character. Null ids give null, no ids the empty text. A column named ``out`` is
    replaced.
    """
    model_name = _ship(rows.sparkSession, model_file or default_model())

    def column(batch: pa.RecordBatch, names: list[str]) -> pa.Array:
        model_file = _located(model_name)
        lists = batch.column(names.index(ids_col))
        pieces_known = len(pieces.vocabulary(model_file, FLATTEN).spelled)
        texts = []
        for first in range(0, len(lists), DECODED_ROWS):
            part = lists.slice(first, DECODED_ROWS)
            ids = part.flatten().fill_null(-1).to_numpy()
            at = np.concatenate([[0], np.cumsum(part.value_lengths().fill_null(0).to_numpy(), dtype=np.int64)])
            known = (ids >= 0) & (ids < pieces_known)
            at = np.concatenate([[0], np.cumsum(known, dtype=np.int64)])[at]
            letters, begin, end = _spelled(ids[known].astype(np.int64), at, model_file, FLATTEN)
            raw = letters.tobytes()
            spelled = [raw[a:b].decode("utf-8", "replace") for a, b in zip(begin.tolist(), end.tolist())]
            texts.append(pa.array(spelled, pa.string(), mask=part.is_null().to_numpy(zero_copy_only=False)))
        return pa.concat_arrays(texts) if texts else pa.array([], pa.string())

    return _append(rows, out, StringType(), column)


def _digest(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit number for each sequence of ids."""
    place = np.arange(len(ids)) - np.repeat(at[:-1], np.diff(at))
    value = pieces.mix(ids.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(20)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value)])
    return (sums[at[1:]] - sums[at[:-1]]).view(np.int64)


_SAMPLES = (
    "sample int, n_ids long, log_prob double, perturbed double, inclusion double, "
    "round_trip boolean, digest long"
)


def sample_encodings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 2,
    with_ids: bool = True,
    model_file: str | None = None,
    flatten: float = FLATTEN,
    carry: Sequence[str] = (),
    slice_bytes: int = pieces.BATCH_BYTES,
) -> DataFrame:
    """Rows (id, sample, n_ids, log_prob, perturbed, inclusion, round_trip, digest[, ids], carried).

    Sample 0 is the tokenizer's own encoding. Samples 1 to ``k`` are distinct segmentations drawn
    without replacement in the order of their perturbed log-probabilities; a text with fewer
    segmentations has fewer rows. ``inclusion`` is the probability that a segmentation is among
    those drawn, given the threshold that the next one sets: weights of 1 / inclusion make sums
    over the samples unbiased. ``flatten`` below 1 makes unlikely pieces likelier.

    Draws depend on the id, the text and nothing else; equal ids share them. ``round_trip`` says
    that the ids spell the whole text. Null and empty texts have one segmentation, of no ids.
    Repeated rows give repeated rows, an empty table an empty one.
    Columns named in ``carry`` come last, others are left out. Texts are worked on in slices of about
    ``slice_bytes``: a quarter of them saves 100 MB a worker and takes an eighth more time.
    """
    if k < 1:
        raise ValueError("k is at least 1")
    model_name = _ship(docs.sparkSession, model_file or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_file = _located(model_name)
        vocab = pieces.vocabulary(model_file, flatten)
        for batch in batches:
            keys = pieces.mix(batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            texts = batch.column(2)
            for part in pieces.text_slices(texts, slice_bytes):
                n = len(part.offsets) - 1
                cut = pieces.units_of(part)
                ids, at = _encode_slice(part, cut, model_file)
                yield rows(batch, part, cut, 0, np.arange(n), ids, at, *[np.full(n, np.nan)] * 3)
                samples, threshold = pieces.sample(part, keys[part.first : part.first + n], k, vocab, cut)
                for r, s in enumerate(samples):
                    with np.errstate(over="ignore"):
                        inclusion = -np.expm1(-np.exp(s.log_prob - threshold[s.docs]))
                    yield rows(batch, part, cut, r + 1, s.docs, s.pieces, s.at, s.log_prob, s.perturbed, inclusion)

    def rows(batch, part, cut, number, docs, ids, at, log_prob, perturbed, inclusion) -> pa.RecordBatch:
        n = len(docs)

        def numbers(x: np.ndarray) -> pa.Array:
            return pa.array(x, pa.float64(), from_pandas=True)  # NaN: null

        columns = [
            batch.column(0).take(pa.array(docs + part.first)),
            pa.array(np.full(n, number, np.int32)),
            pa.array(np.diff(at).astype(np.int64)),
            numbers(log_prob),
            numbers(perturbed),
            numbers(inclusion),
            pa.array(_same_text(part, cut, docs, ids, at, _located(model_name), flatten)),
            pa.array(_digest(ids, at)),
        ]
        if with_ids:
            columns.append(_lists(ids, at))
        columns += [batch.column(3 + i).take(pa.array(docs + part.first)) for i in range(len(carry))]
        return pa.RecordBatch.from_arrays(columns, names=names)

    key = F.col(f"`{id_col}`")
    hashed, text = fresh(docs, "key", "text_read")
    light = docs.select(key.alias(id_col), F.xxhash64(key).alias(hashed), F.col(f"`{text_col}`").cast("string").alias(text), *[F.col(f"`{c}`") for c in carry])
    schema = StructType([light.schema[0], *StructType.fromDDL(_SAMPLES).fields])
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))
    schema = StructType([*schema.fields, *light.schema.fields[3:]])
    names = schema.names
    return map_arrow(light, run, schema)


def _same_text(part, cut, docs, ids, at, model_file, flatten) -> np.ndarray:
    """Whether the ids of each text decode to it."""
    letters, begin, end = _spelled(ids, at, model_file, flatten)
    if len(docs) == len(part.offsets) - 1 and np.array_equal(letters, cut.data):
        if np.array_equal(end, part.offsets[1:] + np.cumsum(np.diff(part.offsets) > 0)):
            return np.ones(len(docs), bool)
    first = part.offsets[docs]
    size = part.offsets[docs + 1] - first
    same = end - begin == size
    for j in np.flatnonzero(same & (size > 0)):
        same[j] = np.array_equal(letters[begin[j] : end[j]], part.data[first[j] : first[j] + size[j]])
    return same
