"""Weighted acyclic automata over words: counts of phrases, built from sorted phrases.

A path of arcs from the root spells a phrase, and the weight on its last arc is the phrase's
count, so a phrase and its beginnings share a path. States from which the same words lead on
with the same weights are one state. Phrases are handled as levels of a sorted tree: for each
length the last word of every phrase, its weight, and where its continuations begin.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from vigil.llm.bytetext import mix

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@dataclass
class Level:
    """Phrases of one length in order: their last words, weights and, one entry more than
    there are phrases, where their continuations begin in the next level."""

    label: np.ndarray
    weight: np.ndarray
    start: np.ndarray


def _gather(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places first, first + 1, ... of each entry side by side, and where each entry's begin."""
    start = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=start[1:])
    return np.repeat(first - start[:-1], count) + np.arange(start[-1]), start


class Transducer:
    """words (sorted), and for each state its arcs first[s] .. first[s + 1] as label, weight and
    target, in order of label. State 0 has no arcs; the last state is the root."""

    def __init__(self, words: pa.Array, first, label, weight, target):
        self.words, self.first, self.label, self.weight, self.target = words, first, label, weight, target

    def levels(self) -> list[Level]:
        out, state = [], np.array([len(self.first) - 2])
        while True:
            at, start = _gather(self.first[state], self.first[state + 1] - self.first[state])
            if out:
                out[-1].start = start
            if not len(at):
                return out
            out.append(Level(self.label[at], self.weight[at], np.empty(0, np.int64)))
            state = self.target[at]

    def compose(self, asked: Transducer) -> list[np.ndarray]:
        """For each level of the phrases in `asked`, their weights here; 0 for none.

        Both are walked together, so that a beginning that many phrases share is met once.
        """
        place = pc.index_in(asked.words, value_set=self.words)
        here = place.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        width = len(self.words) + 1
        arcs = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first)) * width + self.label
        state, out = np.array([len(self.first) - 2]), []
        for level, above in zip(levels := asked.levels(), [None, *levels]):
            if above is not None:
                state = np.repeat(state, np.diff(above.start))
            label = here[level.label]
            key = state * width + label
            at = np.minimum(np.searchsorted(arcs, key), max(0, len(arcs) - 1))
            hit = (label >= 0) & (state >= 0) & (arcs[at] == key) if len(arcs) else np.zeros(len(key), bool)
            out.append(np.where(hit, self.weight[at], 0) if len(arcs) else np.zeros(len(key), np.int64))
            state = np.where(hit, self.target[at], -1) if len(arcs) else np.full(len(key), -1)
        return out

    def pack(self) -> bytes:
        lengths = pc.binary_length(self.words).to_numpy(zero_copy_only=False)
        parts = [np.diff(self.first), self.label, self.weight, self.target, lengths]
        raw = [b"".join(self.words.to_pylist())]
        for x in parts:
            kind = np.min_scalar_type(int(x.max(initial=0)))
            raw.append(struct.pack("<cq", kind.char.encode(), len(x)) + x.astype(kind).tobytes())
        return zstandard.compress(struct.pack("<q", len(raw[0])) + b"".join(raw), 1)

    @staticmethod
    def unpack(data: bytes) -> Transducer:
        raw = zstandard.decompress(data)
        (n,) = struct.unpack_from("<q", raw)
        text, at, parts = raw[8 : 8 + n], 8 + n, []
        for _ in range(5):
            kind, size = struct.unpack_from("<cq", raw, at)
            x = np.frombuffer(raw, np.dtype(kind.decode()), size, at + 9)
            parts.append(x.astype(np.int64))
            at += 9 + x.nbytes
        count, label, weight, target, lengths = parts
        ends = np.r_[0, np.cumsum(lengths)].astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(text)])
        return Transducer(words, np.r_[0, np.cumsum(count)], label, weight, target)


class Builder:
    """Adds sorted phrases level by level from the ends, one block after another. Finished
    states are registered by their arcs, and a state whose arcs are registered is not added."""

    def __init__(self, seed: int = 0):
        self.seed = np.uint64(seed)
        self.counts, self.arcs = [np.zeros(1, np.int64)], []  # state 0 has no arcs
        self.n_states, self.n_arcs = 1, 0
        self.known, self.state = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.root: list[np.ndarray] = []

    def add(self, levels: list[Level]) -> None:
        """Phrases that come after all added before, and whose first words are new."""
        target = np.zeros(len(levels[-1].label), np.int64)
        for level, below in zip(levels[-2::-1], levels[:0:-1]):
            target = self._states(np.stack([below.label, below.weight, target]), level.start)
        self.root.append(np.stack([levels[0].label, levels[0].weight, target]))

    def _states(self, arcs: np.ndarray, start: np.ndarray) -> np.ndarray:
        out = np.zeros(len(start) - 1, np.int64)
        count = np.diff(start)
        inner = np.flatnonzero(count)
        if not len(inner):
            return out
        label, weight, target = np.ascontiguousarray(arcs).view(np.uint64)
        h = mix(mix(label * _ODD[0] + target * _ODD[1] + self.seed) + weight * _ODD[2])
        signature = np.add.reduceat(h, start[inner])
        kinds, one, kind = np.unique(signature, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, kinds)
        old = at < len(self.known)
        old[old] = self.known[at[old]] == kinds[old]
        state = np.empty(len(kinds), np.int64)
        state[old] = self.state[at[old]]
        fresh = one[~old]
        state[~old] = self.n_states + np.arange(len(fresh))
        places, _ = _gather(start[inner[fresh]], count[inner[fresh]])
        self.counts.append(count[inner[fresh]])
        self.arcs.append(arcs[:, places])
        self.n_states += len(fresh)
        order = np.argsort(np.concatenate([self.known, kinds[~old]]), kind="stable")
        self.known = np.concatenate([self.known, kinds[~old]])[order]
        self.state = np.concatenate([self.state, state[~old]])[order]
        out[inner] = state[kind]
        self._check(arcs, start[inner], count[inner], out[inner])
        return out

    def _check(self, arcs, start, count, state) -> None:
        """Equal signatures must mean equal arcs."""
        counts, every = self._joined()
        first = np.r_[0, np.cumsum(counts)]
        if not np.array_equal(counts[state], count):
            raise Collision
        places, _ = _gather(first[state], count)
        if not np.array_equal(every[:, places], arcs[:, _gather(start, count)[0]]):
            raise Collision

    def _joined(self) -> tuple[np.ndarray, np.ndarray]:
        self.counts = [np.concatenate(self.counts)]
        self.arcs = [np.concatenate(self.arcs, axis=1)] if self.arcs else []
        return self.counts[0], self.arcs[0] if self.arcs else np.empty((3, 0), np.int64)

    def finish(self, words: pa.Array) -> Transducer:
        """The automaton, with those of the words that it uses."""
        counts, arcs = self._joined()
        root = np.concatenate(self.root, axis=1)
        label, weight, target = np.concatenate([arcs, root], axis=1)
        used, label = np.unique(label, return_inverse=True)
        first = np.r_[0, np.cumsum(np.r_[counts, root.shape[1]])]
        return Transducer(words.take(pa.array(used)), first, label, weight, target)


class Collision(Exception):
    """Two different states have the same signature."""


def build(levels: list[Level], words: pa.Array) -> Transducer:
    for seed in range(100):
        builder = Builder(seed)
        low = [0] * len(levels)
        try:
            for i in range(len(levels[0].label)):
                high = [i + 1]
                for level in levels[:-1]:
                    high.append(int(level.start[high[-1]]))
                builder.add(part(levels, low, high))
                low = high
        except Collision:
            continue
        return builder.finish(words)
    raise RuntimeError("states could not be told apart")


def union(parts: list[Transducer]) -> tuple[list[Level], pa.Array]:
    """Levels of all phrases of the parts with their weights summed, and their words."""
    every = pa.concat_arrays([p.words for p in parts]).dictionary_encode()
    order = pc.array_sort_indices(every.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    number = rank[every.indices.to_numpy()]
    ends = np.cumsum([len(p.words) for p in parts])
    trees = [p.levels() for p in parts]
    numbers = np.split(number, ends[:-1])
    width = len(order) + 1
    out: list[Level] = []
    above = [np.zeros(1, np.int64) for _ in parts]  # of each part's phrases, their number in the union
    for depth in range(max(map(len, trees))):
        keys, weights, sizes = [], [], []
        for i, tree in enumerate(trees):
            if depth < len(tree):
                own = above[i] if not depth else np.repeat(above[i], np.diff(tree[depth - 1].start))
                keys.append(own * width + numbers[i][tree[depth].label])
                weights.append(tree[depth].weight)
            sizes.append(len(tree[depth].label) if depth < len(tree) else 0)
        key, weight, place = summed(np.concatenate(keys), np.concatenate(weights))
        if out:
            out[-1].start = np.searchsorted(key, np.arange(len(out[-1].label) + 1) * width)
        out.append(Level(key % width, weight, np.zeros(len(key) + 1, np.int64)))
        above = np.split(place, np.cumsum(sizes)[:-1])
    return out, every.dictionary.take(pa.array(order))


def summed(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their weights' sums, and the place of each entry's key."""
    order = np.argsort(key, kind="stable")  # runs that are sorted already are only merged
    ordered = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    place = np.empty(len(key), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[first], np.add.reduceat(weight[order], first), place


def pruned(levels: list[Level], least: int) -> list[Level]:
    """Without phrases of a weight under `least` that no longer one which stays goes through.
    The first level stays whole."""
    stays: list[np.ndarray] = []
    for depth, level in reversed(list(enumerate(levels))):
        keep = level.weight >= least if depth else np.ones(len(level.label), bool)
        if stays:
            total = np.r_[0, np.cumsum(stays[-1])]
            keep |= total[level.start[1:]] > total[level.start[:-1]]
        stays.append(keep)
    stays.reverse()
    out = []
    for depth, (level, keep) in enumerate(zip(levels, stays)):
        start = np.zeros(int(keep.sum()) + 1, np.int64)
        if depth + 1 < len(levels):
            total = np.r_[0, np.cumsum(stays[depth + 1])]
            start[1:] = total[level.start[1:]][keep]
        if len(start) > 1 or not depth:
            out.append(Level(level.label[keep], level.weight[keep], start))
    return out


class _Words:
    """Sorted words for a binary search that makes Python objects of a few only."""

    def __init__(self, words: pa.Array):
        self.words = words

    def __len__(self) -> int:
        return len(self.words)

    def __getitem__(self, i: int) -> bytes:
        return self.words[i].as_py()


def cut_places(levels: list[Level], words: pa.Array, key: tuple[bytes, ...]) -> list[int]:
    """For each level, how many phrases come before the key."""
    out, open_, lo, hi, known = [], True, 0, len(levels[0].label), _Words(words)
    for depth, level in enumerate(levels):
        if not open_:
            out.append(lo)
            lo = int(level.start[lo])
            continue
        rank = bisect_left(known, key[depth])
        at = lo + int(np.searchsorted(level.label[lo:hi], rank))
        # A phrase that the key goes on from comes before it, and so do some of its own.
        open_ = at < hi and level.label[at] == rank and known[rank] == key[depth] and depth + 1 < len(key)
        out.append(at + open_)
        lo, hi = int(level.start[at]), int(level.start[at + open_])
    return out


def part(levels: list[Level], low: list[int], high: list[int]) -> list[Level]:
    """Phrases from place low to place high of each level. Beginnings of the first ones that
    come before have weight 0. Empty if there are none."""
    first, above = [0] * len(levels), None
    for depth in range(len(levels) - 1, -1, -1):
        first[depth] = low[depth]
        if above is not None:
            first[depth] = min(low[depth], int(np.searchsorted(levels[depth].start, above, "right")) - 1)
        above = first[depth] if first[depth] < high[depth] else None
    out = []
    for depth, level in enumerate(levels):
        a, b = first[depth], high[depth]
        if a >= b:
            break
        weight = level.weight[a:b].copy()
        weight[: max(0, low[depth] - a)] = 0
        start = np.zeros(b - a + 1, np.int64)
        if depth + 1 < len(levels):
            start = np.clip(level.start[a : b + 1] - first[depth + 1], 0, max(0, high[depth + 1] - first[depth + 1]))
        out.append(Level(level.label[a:b], weight, start))
    return out
