"""Distinct sampled segmentations of whole texts into pieces, for batches of texts at once.

A text is a space and its bytes, cut into units, each of which begins with its spaces; no piece
spans two units, so the lattice of a text is the chain of the lattices of its units. A unit's
lattice is built and summed (log-sum-exp from its end) once per distinct unit of a batch.

Gumbel top-k without replacement as a perturbed A* search: the whole space gets a Gumbel value and a
sample. Taking the sample out leaves one subspace for each of its pieces: same pieces before, another
piece there, anything after. Each subspace gets a Gumbel value of its own mass, cut off at its
parent's value. The subspace with the largest value comes next. Every draw is a hash of the row's
key and the place it is for, so a row has the same samples in any batch and partition.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from stratum.llm.textbytes import Hashes, Slice, mix, slices

SPACE_MARK = "▁"
BATCH_BYTES = 1 << 19


@dataclass(frozen=True)
class Vocabulary:
    children: np.ndarray  # (nodes, 256) int32, 0: none
    piece_at: np.ndarray  # id of the piece that ends at a node, -1: none
    byte_piece: np.ndarray  # id of the fallback piece of each byte
    log_prob: np.ndarray
    spelled: list[bytes]


class Units(NamedTuple):
    """A slice with a space before each text that isn't empty, cut into units."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    per_doc: np.ndarray  # index of the first unit of each document, documents + 1
    first: np.ndarray  # a unit of each distinct kind
    kind: np.ndarray  # per unit
    hashes: np.ndarray  # per distinct kind


def units_of(part: Slice) -> Units:
    size = np.diff(part.offsets)
    data = np.insert(part.data, part.offsets[:-1][size > 0], 32)
    offsets = part.offsets + np.concatenate([[0], np.cumsum(size > 0)])
    space = data == 32
    new = space.copy()
    new[1:] &= ~space[:-1]
    new[offsets[:-1][size > 0]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    coded = pa.array(CaseHashes(data).of(starts, ends)).dictionary_encode()  # in the order they appear
    kind = coded.indices.to_numpy().astype(np.int64)
    first = np.empty(len(coded.dictionary), np.int64)
    first[kind[::-1]] = np.arange(len(kind))[::-1]
    return Units(data, starts, ends, np.searchsorted(starts, offsets), first, kind, coded.dictionary.to_numpy())


@lru_cache(maxsize=4)
def vocabulary(model_file: str, flatten: float) -> Vocabulary:
    """The pieces of a SentencePiece model with log-probabilities for sampling.

    The model orders its pieces by merge and has no probabilities; they are taken as proportional to
    (rank + 100) ** -flatten, fallback bytes last. Pieces without text are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    spelled, rank = [b""] * size, np.zeros(size)
    byte_piece = np.full(256, -1, np.int64)
    children: list[dict[int, int]] = [{}]
    piece_at = [-1]
    for i in range(size):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            rank[i] = size
        elif model.is_byte(i):
            value = int(model.id_to_piece(i)[3:-1], 16)
            byte_piece[value], spelled[i], rank[i] = i, bytes([value]), size
        else:
            spelled[i] = model.id_to_piece(i).replace(SPACE_MARK, " ").encode()
            rank[i] = max(0.0, -model.get_score(i))
            rank[i] = min(rank[i], size)
            node = 0
            for b in spelled[i]:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = children[node][b] = len(children)
                    children.append({})
                    piece_at.append(-1)
                node = nxt
            if node and piece_at[node] < 0:
                piece_at[node] = i
    table = np.zeros((len(children), 256), np.int32)
    for node, own in enumerate(children):
        for b, child in own.items():
            table[node, b] = child
    weight = (rank + 100.0) ** -flatten
    return Vocabulary(table, np.array(piece_at), byte_piece, np.log(weight / weight.sum()), spelled)


@dataclass
class Lattice:
    """States are places in distinct units, by distance from the unit's end; edges are pieces."""

    first_state: np.ndarray  # per distinct unit
    edges_from: np.ndarray  # per state, states + 1
    target: np.ndarray  # per edge; -1: the end of the unit
    piece: np.ndarray
    prob: np.ndarray  # of the edge, given its state
    upto: np.ndarray  # cumulated over the edges of the state, longest piece first; ends with 1

    def choose(self, state: np.ndarray, u: np.ndarray) -> np.ndarray:
        edge = self.edges_from.take(state)
        beyond = np.flatnonzero(u > self.upto.take(edge))
        while len(beyond):
            following = edge.take(beyond) + 1
            edge[beyond] = following
            beyond = beyond[u.take(beyond) > self.upto.take(following)]
        return edge


def lattice(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocab: Vocabulary) -> Lattice:
    length = ends - starts
    n = int(length.sum())
    unit = np.repeat(np.arange(len(starts)), length)
    begin = np.concatenate([[0], np.cumsum(length)])
    text = data[np.arange(n) - np.repeat(begin[:-1], length) + np.repeat(starts, length)]
    rest = begin[unit + 1] - np.arange(n)  # distance from the end of the unit

    found_at, found_size, found_piece, found_nth = [], [], [], []
    edges_of = np.zeros(n, np.int64)

    def add(at: np.ndarray, size: int, piece: np.ndarray) -> None:
        found_at.append(at)
        found_size.append(np.full(len(at), size))
        found_piece.append(piece)
        nth = edges_of.take(at) + 1
        edges_of[at] = nth
        found_nth.append(nth)

    at, node = np.arange(n), np.zeros(n, np.int32)
    flat, child = text.astype(np.int32), vocab.children.reshape(-1)
    depth = 0
    lead = (text & 0xC0) != 0x80
    char_size = 1 + (text >= 0xC0) + (text >= 0xE0) + (text >= 0xF0)
    has_char = np.zeros(n, bool)
    while len(at):
        node = child.take(node * 256 + flat.take(at + depth))
        depth += 1
        live = np.flatnonzero(node)
        at, node = at.take(live), node.take(live)
        found = vocab.piece_at.take(node)
        hit = np.flatnonzero(found >= 0)
        ends_here = at.take(hit)
        add(ends_here, depth, found.take(hit))
        if depth <= 4:
            has_char[ends_here[char_size.take(ends_here) == depth]] = True
        more = np.flatnonzero(rest.take(at) > depth)
        at, node = at.take(more), node.take(more)
    # Characters without a piece are spelled in bytes. Nothing leads into the middle of the others,
    # but every state has an edge.
    bare = np.flatnonzero(~has_char | ~lead)
    add(bare, 1, vocab.byte_piece[text[bare]])

    short = rest.astype(np.uint16) if n and rest.max() < 65536 else rest  # sorted by radix
    order = np.argsort(short, kind="stable")  # states nearest the end first
    state_of = np.empty(n, np.int64)
    state_of[order] = np.arange(n)
    edges_from = np.concatenate([[0], np.cumsum(edges_of[order])])
    src, nth = np.concatenate(found_at), np.concatenate(found_nth)
    slot = edges_from[state_of[src] + 1] - nth  # long pieces were found last and come first
    size, piece = np.empty(len(src), np.int64), np.empty(len(src), np.int64)
    size[slot], piece[slot] = np.concatenate(found_size), np.concatenate(found_piece)
    state = np.repeat(np.arange(n), edges_of[order])
    place = np.repeat(order, edges_of[order])
    beyond = place + size
    target = np.append(state_of, -1).take(beyond)
    target[size == rest.take(place)] = -1

    log_prob = vocab.log_prob.take(piece)
    mass = np.zeros(n + 1)  # the last entry is the end, reached by target -1
    level = np.searchsorted(rest[order], np.arange(1, (int(rest.max()) if n else 0) + 2))
    weight = np.empty(len(src))
    for lo, hi in zip(level[:-1], level[1:], strict=True):
        if lo == hi:
            continue
        a, b = edges_from[lo], edges_from[hi]
        value = log_prob[a:b] + mass.take(target[a:b])
        cut = edges_from[lo:hi] - a
        top = np.maximum.reduceat(value, cut)
        counts = np.diff(edges_from[lo : hi + 1])
        scaled = np.exp(value - np.repeat(top, counts))
        total = np.add.reduceat(scaled, cut)
        mass[lo:hi] = top + np.log(total)
        weight[a:b] = scaled / np.repeat(total, counts)
    running = np.cumsum(weight)
    upto = running - np.concatenate([[0.0], running])[edges_from[:-1]][state]
    upto[edges_from[1:] - 1] = 1.0
    return Lattice(state_of[begin[:-1]] if n else np.zeros(0, np.int64), edges_from, target, piece, weight, upto)


_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _uniform(key: np.ndarray, *place: np.ndarray | int) -> np.ndarray:
    """A draw in (0, 1) for up to three numbers that name its place, under the row's mixed key."""
    return _drawn(_placed(key, *place))


def _placed(key: np.ndarray, *place: np.ndarray | int) -> np.ndarray:
    x = key.astype(np.uint64)
    with np.errstate(over="ignore"):
        for factor, p in zip(_PLACES, place, strict=False):
            x += np.asarray(p).astype(np.uint64) * factor
    return x


def _drawn(x: np.ndarray) -> np.ndarray:
    x = mix(x)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _walk(lat: Lattice, state: np.ndarray, key: np.ndarray, unit: np.ndarray, draw: int, step: np.ndarray):
    """Sample from each state to its unit's end: edges, and which walk each belongs to, in order."""
    walks, edges = [], []
    count = np.zeros(len(state), np.int64)
    who = np.flatnonzero(state >= 0)
    state = state[who]
    place = _placed(key, unit, step, draw)[who]
    while len(who):
        edge = lat.choose(state, _drawn(place))
        walks.append(who)
        edges.append(edge)
        count[who] = len(walks)
        state = lat.target.take(edge)
        on = np.flatnonzero(state >= 0)
        who, state, place = who.take(on), state.take(on), place.take(on) + _PLACES[1]  # the next step
    at = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(at[-1], np.int64)
    for i, (w, e) in enumerate(zip(walks, edges, strict=True)):
        out[at.take(w) + i] = e  # a walk is on until it ends, so this is its piece i
    return out, at


def _cut_gumbel(location: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values at the locations, given that they are at most the bounds."""
    with np.errstate(divide="ignore", over="ignore"):
        free = location - np.log(-np.log(u))
        return np.where(np.isneginf(location), -np.inf, -np.logaddexp(-bound, -free))


@dataclass
class Sample:
    """One sample of every text of a slice that has one; flat arrays with offsets per text."""

    docs: np.ndarray
    at: np.ndarray  # offsets into pieces, len(docs) + 1
    pieces: np.ndarray
    log_prob: np.ndarray
    perturbed: np.ndarray


def sample(part: Slice, keys: np.ndarray, k: int, vocab: Vocabulary, cut: Units | None = None) -> tuple[list[Sample], np.ndarray]:
    """Up to ``k`` distinct samples of each text, best perturbed value first, and the threshold.

    The threshold is the perturbed value of what would come next, -inf if nothing is left.
    """
    docs = len(part.offsets) - 1
    data, starts, ends, units_at, sample_of, kind, _ = cut or units_of(part)
    lat = lattice(data, starts[sample_of], ends[sample_of], vocab)
    first_state = lat.first_state[kind] if len(starts) else np.zeros(0, np.int64)
    doc_of_unit = np.repeat(np.arange(docs), np.diff(units_at))
    unit_no = np.arange(len(starts)) - units_at[doc_of_unit]
    log_of = np.log(np.maximum(lat.prob, 1e-300))
    edge_state = np.repeat(np.arange(len(lat.edges_from) - 1), np.diff(lat.edges_from))

    # The whole space of each text: a free sample and a Gumbel value.
    edges, at = _walk(lat, first_state, keys[doc_of_unit], unit_no, 0, np.zeros(len(starts), np.int64))
    path = [edges]
    path_at = [at[units_at]]
    path_unit = [np.repeat(np.arange(len(starts)), np.diff(at))]
    own = [np.arange(docs)]
    value = [-np.log(-np.log(_uniform(keys, 7, 0, 0)))]
    log_prob, frontier, frontier_doc_at = [], [], []
    excluded: list[dict[int, tuple[int, list[int]]]] = [{}]  # per sample: doc -> (place, edges)
    samples: list[Sample] = []
    for r in range(k + 1):
        if r:
            # The largest subspace value of each text over all samples so far.
            best = np.full(docs, -np.inf)
            best_in = np.full(docs, -1)
            for s in range(r):
                peak = np.full(len(own[s]), -np.inf)
                filled = np.diff(frontier_doc_at[s]) > 0
                if filled.any():
                    peak[filled] = np.maximum.reduceat(frontier[s], frontier_doc_at[s][:-1][filled])
                better = peak > best[own[s]]
                best[own[s][better]], best_in[own[s][better]] = peak[better], s
            if r == k:
                return samples, best
            chosen = np.flatnonzero(best_in >= 0)
            edges, doc_at, units, marks = _deviate(
                lat, chosen, best, best_in, own, path, path_at, path_unit, frontier, frontier_doc_at, excluded,
                units_at, first_state, unit_no, keys, doc_of_unit, r,
            )
            path.append(edges)
            path_at.append(doc_at)
            path_unit.append(units)
            own.append(chosen)
            value.append(best[chosen])
            excluded.append(marks)
        else:
            edges, doc_at = path[0], path_at[0]
        # Subspaces of the new sample: one per piece, from the place where it left its parent.
        d = np.repeat(np.arange(len(own[r])), np.diff(doc_at))
        logs = log_of[edges]
        running = np.concatenate([[0.0], np.cumsum(logs)])
        before = running[:-1] - running[doc_at[:-1]][d]
        left = 1.0 - lat.prob[edges]
        single = np.diff(lat.edges_from)[edge_state[edges]] == 1
        left[single] = 0.0
        for j, (place, gone) in excluded[r].items():
            i = doc_at[j] + place
            left[doc_at[j] : i] = 0.0
            left[i] = max(0.0, 1.0 - lat.prob[gone].sum()) if len(gone) < _fan(lat, edges[i], edge_state) else 0.0
        with np.errstate(divide="ignore"):
            location = before + np.log(left)
        place = np.arange(len(edges)) - doc_at[:-1][d]
        u = _uniform(keys[own[r]][d], place, r, 11)
        frontier.append(_cut_gumbel(location, value[r][d], u))
        frontier_doc_at.append(doc_at)
        log_prob.append(running[doc_at[1:]] - running[doc_at[:-1]])
        samples.append(Sample(own[r], doc_at, lat.piece[edges], log_prob[r], value[r]))
    return samples, np.full(docs, -np.inf)


def _fan(lat: Lattice, edge: int, edge_state: np.ndarray) -> int:
    s = edge_state[edge]
    return int(lat.edges_from[s + 1] - lat.edges_from[s])


class CaseHashes(Hashes):
    """Hashes that tell upper from lower case."""

    def __init__(self, data: np.ndarray):
        super().__init__(data, fold=False)


def _deviate(
    lat, chosen, best, best_in, own, path, path_at, path_unit, frontier, frontier_doc_at, excluded,
    units_at, first_state, unit_no, keys, doc_of_unit, r,
):
    """The samples of the chosen texts' best subspaces: parent's start, another piece, a free rest."""
    heads, places, marks = [], [], {}
    start_unit = np.empty(len(chosen), np.int64)
    start_state = np.empty(len(chosen), np.int64)
    for j, d in enumerate(chosen):
        s = best_in[d]
        i = int(np.searchsorted(own[s], d))
        lo, hi = frontier_doc_at[s][i], frontier_doc_at[s][i + 1]
        t = int(lo + frontier[s][lo:hi].argmax())
        frontier[s][t] = -np.inf
        old = path[s][t]
        place = t - lo
        gone = [int(old)]
        if i in excluded[s] and excluded[s][i][0] == place:
            gone = excluded[s][i][1]
        state = _state_below(lat, old)
        a, b = lat.edges_from[state], lat.edges_from[state + 1]
        prob = lat.prob[a:b].copy()
        prob[np.array(gone) - a] = 0.0
        u = _uniform(keys[d : d + 1], place, r, 13)[0]
        running = np.cumsum(prob)
        pick = int(np.searchsorted(running, u * running[-1], "right"))
        pick = min(pick, int(np.flatnonzero(prob > 0)[-1]))
        new = int(a + pick)
        marks[j] = (place, [*gone, new])
        heads.append(np.append(path[s][lo:t], new))
        places.append(path_unit[s][lo : t + 1])
        start_unit[j] = path_unit[s][t]
        start_state[j] = lat.target[new]
    # Walks: the rest of the unit that was left, then all units after it.
    last_unit = units_at[chosen + 1]
    n_walks = last_unit - start_unit
    walk_doc = np.repeat(np.arange(len(chosen)), n_walks)
    begin = np.concatenate([[0], np.cumsum(n_walks)])
    unit = np.arange(begin[-1]) - begin[walk_doc] + start_unit[walk_doc]
    state = first_state[unit].copy()
    step = np.zeros(len(unit), np.int64)
    state[begin[:-1]] = start_state
    step[begin[:-1]] = 1_000_000  # apart from the steps of a unit walked from its start
    edges, at = _walk(lat, state, keys[doc_of_unit[unit]], unit_no[unit], r, step)
    tails_at = at[begin]
    tail_unit = np.repeat(unit, np.diff(at))
    head_size = np.array([len(h) for h in heads], np.int64)
    size = head_size + np.diff(tails_at)
    doc_at = np.concatenate([[0], np.cumsum(size)])
    out, units = np.empty(doc_at[-1], np.int64), np.empty(doc_at[-1], np.int64)
    for j in range(len(chosen)):
        mid = doc_at[j] + head_size[j]
        out[doc_at[j] : mid], units[doc_at[j] : mid] = heads[j], places[j]
        out[mid : doc_at[j + 1]] = edges[tails_at[j] : tails_at[j + 1]]
        units[mid : doc_at[j + 1]] = tail_unit[tails_at[j] : tails_at[j + 1]]
    return out, doc_at, units, marks


def _state_below(lat: Lattice, edge: int) -> int:
    return int(np.searchsorted(lat.edges_from, edge, "right")) - 1


def text_slices(column: pa.Array, limit: int = BATCH_BYTES):
    return slices(column, limit)


@lru_cache(maxsize=4)
def _spelling(model_file: str, flatten: float) -> pa.Array:
    return pa.array(vocabulary(model_file, flatten).spelled, pa.large_binary())


def spell(ids: np.ndarray, at: np.ndarray, model_file: str, flatten: float) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of sequences of piece ids, with the space before each text, and their offsets."""
    spelled = _spelling(model_file, flatten).take(pa.array(ids))
    _, ends, letters = spelled.buffers()
    ends = np.frombuffer(ends, np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
    out = np.frombuffer(letters, np.uint8)[: ends[-1]] if ends[-1] else np.zeros(0, np.uint8)
    return out, ends[at]
