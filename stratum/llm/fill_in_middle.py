"""Fill-in-the-middle transformation of whole texts by displacement scatter.

A text is cut at two of its units (runs of ASCII letters, and every other code point) into prefix,
middle and suffix, which change places around three sentinels. Nothing is cut out per document: in a
slice of many texts each segment moves by a fixed number of bytes, the changes of that shift are put
into a difference array at the cuts, its cumulative sum is the shift of every byte, and one numpy
scatter writes all outputs. ``restore`` finds the sentinels and gathers with the inverse shifts.

Slices hold whole documents of about half a megabyte, and shifts exist for a window of a slice at a
time, so memory is a few times the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratum.llm.common import fresh, map_arrow, text_of
from stratum.llm.textbytes import Slice, slices

PLAIN, PSM, SPM = "plain", "psm", "spm"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = 3  # bytes of a sentinel
WINDOW = 1 << 20

_IS_ASCII_LETTER = np.zeros(256, bool)
_IS_ASCII_LETTER[65:91] = _IS_ASCII_LETTER[97:123] = True
_MADE = "n long, form string, prefix_chars long, middle_chars long, output string"


def _draws(id_col: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a document; a null id counts as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    digest = F.sha2(name, 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _windows(n: int) -> Iterator[tuple[int, int]]:
    return ((lo, min(n, lo + WINDOW)) for lo in range(0, n, WINDOW))


def _before(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flagged bytes stand before each of the ascending positions."""
    out = np.zeros(len(at), np.int64)
    base = 0
    for lo, hi in _windows(len(flags)):
        found = np.flatnonzero(flags[lo:hi]) + lo
        here = slice(*np.searchsorted(at, [lo, hi]))
        out[here] = base + np.searchsorted(found, at[here])
        base += len(found)
    out[np.searchsorted(at, len(flags)) :] = base
    return out


def _select(flags: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Position of the flagged byte of each of the ascending ranks; the end beyond the last."""
    out = np.full(len(ranks), len(flags), np.int64)
    base = 0
    for lo, hi in _windows(len(flags)):
        found = np.flatnonzero(flags[lo:hi]) + lo
        here = slice(*np.searchsorted(ranks, [base, base + len(found)]))
        out[here] = found[ranks[here] - base]
        base += len(found)
    return out


def _moves(n: int, at: np.ndarray, shifts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Windows of bytes with the place each byte moves to.

    From position ``at[i]`` (ascending) on, bytes move by ``shifts[i]``. Of several shifts that begin
    at one byte the last holds: the differences add up.
    """
    steps = np.diff(shifts, prepend=0)
    carry = 0
    for lo, hi in _windows(n):
        here = slice(*np.searchsorted(at, [lo, hi]))
        difference = np.zeros(hi - lo, np.int64)
        np.add.at(difference, at[here] - lo, steps[here])
        places = np.cumsum(difference, out=difference)
        places += carry
        carry = int(places[-1])
        places += np.arange(lo, hi)
        yield lo, hi, places


def units_of(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Per byte of a slice: whether a unit begins there, and whether a code point does."""
    points = (part.data & 0xC0) != 0x80
    letter = _IS_ASCII_LETTER[part.data]
    goes_on = np.zeros(len(letter), bool)
    goes_on[1:] = letter[1:] & letter[:-1]
    heads = part.offsets[:-1]
    goes_on[heads[heads < len(letter)]] = False
    return points & ~goes_on, points


def scatter(part: Slice, h1: np.ndarray, h2: np.ndarray, is_plain: np.ndarray, is_spm: np.ndarray):
    """(units, prefix code points, middle code points, output bytes, output offsets) of a slice."""
    start, stop = part.offsets[:-1], part.offsets[1:]
    heads, points = units_of(part)
    ranks = _before(heads, part.offsets)
    units = np.diff(ranks)
    first, second = h1 % (units + 1), h2 % (units + 1)
    cuts = np.empty(2 * len(units), np.int64)
    cuts[0::2] = ranks[:-1] + np.minimum(first, second)
    cuts[1::2] = ranks[:-1] + np.maximum(first, second)
    cuts = _select(heads, cuts)
    a, b = np.minimum(cuts[0::2], stop), np.minimum(cuts[1::2], stop)
    edges = np.empty(3 * len(units), np.int64)
    edges[0::3], edges[1::3], edges[2::3] = start, a, b
    counted = _before(points, edges)

    size = stop - start
    offsets = np.concatenate([[0], np.cumsum(size + np.where(is_plain, 0, 3 * MARK))])
    out0 = offsets[:-1]
    n_prefix, n_middle, n_suffix = a - start, b - a, stop - b
    # Where each segment begins in the output.
    prefix_at = np.where(is_spm, out0 + 2 * MARK + n_suffix, out0 + MARK)
    suffix_at = np.where(is_spm, out0 + MARK, out0 + 2 * MARK + n_prefix)
    middle_at = out0 + 3 * MARK + n_prefix + n_suffix
    shifts = np.empty(3 * len(units), np.int64)
    shifts[0::3] = np.where(is_plain, out0 - start, prefix_at - start)
    shifts[1::3] = np.where(is_plain, out0 - start, middle_at - a)
    shifts[2::3] = np.where(is_plain, out0 - start, suffix_at - b)
    out = np.empty(offsets[-1], np.uint8)
    for lo, hi, places in _moves(len(part.data), edges, shifts):
        out[places] = part.data[lo:hi]
    for text, begin in ((PREFIX, prefix_at), (SUFFIX, suffix_at), (MIDDLE, middle_at)):
        marks = begin[~is_plain] - MARK
        for i, byte in enumerate(text.encode()):
            out[marks + i] = byte
    return units, counted[1::3] - counted[0::3], counted[2::3] - counted[1::3], out, offsets


def gather(part: Slice, is_plain: np.ndarray, is_spm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts before the transformation, and their offsets; inverse of ``scatter``."""
    start, stop = part.offsets[:-1], part.offsets[1:]
    data = part.data
    opens = np.flatnonzero(data[:-2] == ord("<")) if len(data) > 2 else np.zeros(0, np.int64)
    opens = opens[data[opens + 2] == ord(">")]
    marks = opens[np.isin(data[opens + 1], np.frombuffer(b"PSM", np.uint8))]
    document = np.searchsorted(part.offsets, marks, "right") - 1
    marks = marks[~is_plain[document] & (marks + MARK <= stop[document])]
    moved = np.flatnonzero(~is_plain)
    document = np.searchsorted(part.offsets, marks, "right") - 1
    names = data[marks + 1].tobytes()
    if not np.array_equal(document, np.repeat(moved, 3)) or names != b"".join(
        b"SPM" if spm else b"PSM" for spm in is_spm[moved]
    ):
        raise ValueError("an output does not hold its three sentinels once and in order")
    one, two, three = (np.array(start), np.array(start), np.array(start))
    one[moved], two[moved], three[moved] = marks[0::3], marks[1::3], marks[2::3]

    size = stop - start - np.where(is_plain, 0, 3 * MARK)
    offsets = np.concatenate([[0], np.cumsum(size)])
    text0 = offsets[:-1]
    prefix_from = np.where(is_spm, two, one) + MARK
    suffix_from = np.where(is_spm, one, two) + MARK
    n_prefix = np.where(is_spm, three, two) - prefix_from
    n_middle = stop - three - MARK
    edges = np.empty(3 * len(size), np.int64)
    edges[0::3] = text0
    edges[1::3] = np.where(is_plain, text0, text0 + n_prefix)
    edges[2::3] = np.where(is_plain, text0, text0 + n_prefix + n_middle)
    shifts = np.empty(3 * len(size), np.int64)
    shifts[0::3] = np.where(is_plain, start - text0, prefix_from - edges[0::3])
    shifts[1::3] = np.where(is_plain, start - text0, three + MARK - edges[1::3])
    shifts[2::3] = np.where(is_plain, start - text0, suffix_from - edges[2::3])
    out = np.empty(offsets[-1], np.uint8)
    for lo, hi, places in _moves(len(out), edges, shifts):
        out[lo:hi] = data[places]
    return out, offsets


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    texts = pa.LargeStringArray.from_buffers(len(offsets) - 1, buffers[1], buffers[2])
    return texts.cast(pa.string())


def _without(docs: DataFrame, *names: str) -> list[str]:
    taken = {n.lower() for n in names}
    return [c for c in docs.columns if c.lower() not in taken]


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 1,
    plain_percent: int = 10,
    spm_percent: int = 20,
) -> DataFrame:
    """``docs`` with n (units of the text), form, prefix_chars, middle_chars and output.

    Form is plain (output is the text, prefix_chars and middle_chars null) if the text is empty, holds
    a sentinel or is drawn so; else spm (suffix first) or psm. All draws depend on the id and ``seed``
    alone, so repeated ids are cut at the same draws and equal rows give equal rows. A null text is
    empty; a null id is drawn for as an empty one. An empty table gives an empty one. Columns of
    ``docs`` with the names of the new ones (in any letter case) are replaced.
    """
    kind = StructType.fromDDL(_MADE)
    kept = _without(docs, *kind.names)
    h1, h2, h3, h4 = _draws(id_col, seed)
    text = text_of(text_col)
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(mark))
    plain = (text == "") | marked | (h3 % 100 >= 100 - plain_percent)
    form = F.when(plain, PLAIN).when(h4 % 100 < spm_percent, SPM).otherwise(PSM)
    light = docs.select(
        F.struct(h1.alias("h1"), h2.alias("h2"), form.alias("form"), text.alias("text")).alias(*fresh(docs, "made_of")),
        *[F.col(f"`{c}`") for c in kept],
    )
    schema = StructType([*light.schema.fields[1:], *kind.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2, form, text = batch.column(0).flatten()
            h1, h2 = h1.to_numpy(), h2.to_numpy()
            is_plain = np.asarray(form.to_pylist(), object) == PLAIN
            is_spm = np.asarray(form.to_pylist(), object) == SPM
            for part in slices(text):
                rows = slice(part.first, part.first + len(part.offsets) - 1)
                plain = is_plain[rows]
                n, prefix, middle, out, at = scatter(part, h1[rows], h2[rows], plain, is_spm[rows])
                own = batch.slice(part.first, len(plain))
                made = [
                    pa.array(n),
                    form.slice(part.first, len(plain)),
                    pa.array(prefix, mask=plain),
                    pa.array(middle, mask=plain),
                    _strings(out, at),
                ]
                yield pa.RecordBatch.from_arrays([*own.columns[1:], *made], names=schema.names)

    return map_arrow(light, run, schema)


def restore(
    docs: DataFrame, output_col: str = "output", form_col: str = "form", out: str = "restored"
) -> DataFrame:
    """``docs`` with the text that each output was made from, by its form alone.

    A null output is empty, a null form counts as plain. An output without its three sentinels in the
    order of its form stops the job. A column named ``out`` (in any letter case) is replaced.
    """
    kept = _without(docs, out)
    light = docs.select(
        F.struct(
            text_of(output_col).alias("output"), F.coalesce(F.col(f"`{form_col}`"), F.lit(PLAIN)).alias("form")
        ).alias(*fresh(docs, "made_of")),
        *[F.col(f"`{c}`") for c in kept],
    )
    schema = StructType([*light.schema.fields[1:], *StructType.fromDDL(f"`{out}` string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            output, form = batch.column(0).flatten()
            form = np.asarray(form.to_pylist(), object)
            for part in slices(output):
                rows = slice(part.first, part.first + len(part.offsets) - 1)
                texts = _strings(*gather(part, form[rows] == PLAIN, form[rows] == SPM))
                own = batch.slice(part.first, len(texts))
                yield pa.RecordBatch.from_arrays([*own.columns[1:], texts], names=schema.names)

    return map_arrow(light, run, schema)
