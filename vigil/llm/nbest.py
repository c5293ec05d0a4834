"""N-best SentencePiece segmentation, encoding and decoding.

A text's segmentations are paths through a lattice of pieces, scored by the sum of the model's
piece scores. The model's pieces never go on from another character to a space mark, so the
lattice falls into parts (a word with the marks before it) that can be solved one by one.

Forward Viterbi gives the best score of every prefix of a part. Searching backward from the
end, that score is the exact rest of the way: A* over (suffix so far, place) takes the
segmentations of a part from the heap in the order of their scores, and no dead ends.
Entries of the heap link to the one they go on from, and a place is left at most N times.
Parts of more than LONG_PART characters are cut at every place that no piece crosses, which
changes nothing. What is still longer gets the N best of every prefix instead, which keeps
N numbers a character.
Forward Viterbi runs over many parts of about one length at once, place by place, and the same
pass backward tells how far the second best of each part lies behind. The pieces that begin at a
place are found in a trie, a character of all places at a time. Only the N-1 parts of a text whose
second best is closest can take part in its N best, so A* runs for those alone.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections import deque
from collections.abc import Collection, Iterator
from itertools import count, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigil.llm.bytetext import bounded_batches
from vigil.llm.resident import resident

N_BEST = 4
SPACE = "▁"
UNKNOWN_BELOW = 10.0  # a character without a piece scores this below the worst piece
CACHE_BYTES = 64 << 20  # of solved parts that a worker keeps
PART_BYTES = 300  # about what a part takes beside 8 bytes a character
SLAB_CHARS = 1 << 16  # of parts that are solved at once, each as long as the longest
CHUNK_CHARS = 1 << 20
LONG_PART = 1024
CODE_BITS = 21  # of a character

_PART = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normalised(text: str) -> str:
    """The text as the lattice sees it: spaces are marks, and one stands before the text."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Numbers(dict[str, int]):
    """Numbers of parts, from 0 on; a part without one gets the next and is noted as fresh."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        self.fresh.append(part)
        return number


class Parts(list[str]):
    """Parts of a text, and their numbers in the cache."""

    numbers: np.ndarray


class Model:
    """Pieces and scores of a SentencePiece model file, and one worker's solved parts."""

    def __init__(self, path: str):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(own.get_piece_size())
        self.text = {i: own.id_to_piece(i) for i in every}
        self.byte_ids = {int(self.text[i][3:5], 16): i for i in every if own.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        # Bytes of ASCII stand for themselves; others are parts of characters.
        self.high = {i for i, b in self.byte_of.items() if b >= 0x80}
        self.plain = self.text | {i: chr(b) for i, b in self.byte_of.items() if b < 0x80}
        plain = [i for i in every if not (own.is_byte(i) or own.is_control(i) or own.is_unknown(i) or own.is_unused(i))]
        self.score = {i: own.get_score(i) for i in plain}
        self.id_of = {self.text[i]: i for i in plain}
        self.longest = max(map(len, self.id_of))
        self.unknown = min(s for s in self.score.values() if s > -1e8) - UNKNOWN_BELOW
        self.chars = np.array([len(self.text[i]) for i in every])
        self._tables()
        self.forget()

    def _tables(self) -> None:
        """The pieces as a trie, whose steps lie in a hash table at the first free slot."""
        steps: dict[int, int] = {}
        ids, scores = [-1], [-np.inf]
        for piece, i in self.id_of.items():
            node = 0
            for code in map(ord, piece):
                key = node << CODE_BITS | code
                if key not in steps:
                    steps[key] = len(ids)
                    ids.append(-1)
                    scores.append(-np.inf)
                node = steps[key]
            ids[node], scores[node] = i, self.score[i]
        self.node_id, self.node_score = np.array(ids, np.int32), np.array(scores)
        self.slots_log = (4 * len(steps)).bit_length()
        self.key = np.full(1 << self.slots_log, -1)
        self.child = np.full(1 << self.slots_log, -1, np.int32)
        keys = np.fromiter(steps, np.int64, len(steps))
        for slot, key, child in zip(self._slots(keys).tolist(), keys.tolist(), steps.values()):
            while self.child[slot] >= 0:
                slot = (slot + 1) % len(self.key)
            self.key[slot], self.child[slot] = key, child

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _BASE) >> np.uint64(64 - self.slots_log)).view(np.int64)

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The node that each node goes on to with each character, or -1."""
        keys = nodes.astype(np.int64) << CODE_BITS | codes
        slots = self._slots(keys)
        out = self.child[slots]
        other = np.flatnonzero((out >= 0) & (self.key[slots] != keys))
        while len(other):
            slots[other] = (slots[other] + 1) % len(self.key)
            out[other] = self.child[slots[other]]
            other = other[(out[other] >= 0) & (self.key[slots[other]] != keys[other])]
        return out

    def found(self, codes: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, places, nodes) of the pieces of n characters that begin at places with as many left."""
        at, nodes = np.arange(len(left)), np.zeros(len(left), np.int32)
        for n in range(1, self.longest + 1):
            room = left[at] >= n
            at = at[room]
            nodes = self.step(nodes[room], codes[at + n - 1])
            on = nodes >= 0
            at, nodes = at[on], nodes[on]
            real = self.node_id[nodes] >= 0
            yield n, at[real], nodes[real]

    def forget(self) -> None:
        self.index = Numbers()
        self.best = np.empty(1024)
        self.behind = np.empty(1024)
        self.start = np.empty(1024, np.int64)
        self.n_ids = np.empty(1024, np.int64)
        self.whole = np.empty(1024, bool)
        self.ids = np.empty(4096, np.int32)
        self.n_held = 0  # of ids
        self.held = 0
        self.near: dict[int, list[tuple[float, tuple[int, ...]]]] = {}

    # --- one part ---

    def edges(self, part: str, j: int) -> list[tuple[int, float, tuple[int, ...]]]:
        """Pieces that end at place j: (where they begin, score, ids)."""
        out = []
        for i in range(max(0, j - self.longest), j):
            piece = self.id_of.get(part[i:j])
            if piece is not None:
                out.append((i, self.score[piece], (piece,)))
        if part[j - 1] not in self.id_of:
            raw = part[j - 1].encode("utf-8", "surrogatepass")
            out.append((j - 1, self.unknown, tuple(self.byte_ids[b] for b in raw)))
        return out

    def n_best(self, part: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations (score, ids), best first, ties by the order of discovery."""
        forward, into = [0.0], [[]]
        for j in range(1, len(part) + 1):
            into.append(self.edges(part, j))
            forward.append(max(forward[i] + s for i, s, _ in into[j]))
        order = count()
        # (-score of the whole path, number, place, score of the suffix, ids of its first piece, the rest)
        heap = [(-forward[-1], next(order), len(part), 0.0, (), None)]
        out, left = [], [0] * (len(part) + 1)
        while heap and len(out) < n:
            entry = heapq.heappop(heap)
            place, suffix = entry[2], entry[3]
            if not place:
                ids = []
                while entry is not None:
                    ids.extend(entry[4])
                    entry = entry[5]
                out.append((suffix, tuple(ids)))
                continue
            if left[place] == n:
                continue  # n suffixes from here are as good, and go on alike
            left[place] += 1
            for i, s, piece in into[place]:
                heapq.heappush(heap, (-(forward[i] + s + suffix), next(order), i, s + suffix, piece, entry))
        return out

    def n_best_long(self, part: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The same by the n best of every prefix; of these only the last piece is kept."""
        size, rank = array("i", bytes(4 * n * (len(part) + 1))), array("i", bytes(4 * n * (len(part) + 1)))
        recent = deque([[0.0]], self.longest)  # scores of the n best of the last prefixes
        for j in range(1, len(part) + 1):
            ways = [
                (score + s, j - i, r)
                for i, s, _ in self.edges(part, j) for r, score in enumerate(recent[i - j])
            ]
            ways = heapq.nlargest(n, ways) if len(ways) > n else sorted(ways, reverse=True)
            for k, (_, length, r) in enumerate(ways, n * j):
                size[k], rank[k] = length, r
            recent.append([way[0] for way in ways])
        out = []
        for r, score in enumerate(recent[-1]):
            ids, place = [], len(part)
            while place:
                k = n * place + r
                piece = part[place - size[k] : place]
                own = self.id_of.get(piece)
                ids.extend([own] if own is not None else [self.byte_ids[x] for x in reversed(piece.encode("utf-8", "surrogatepass"))])
                place, r = place - size[k], rank[k]
            out.append((score, tuple(reversed(ids))))
        return out

    def cut(self, part: str) -> list[str]:
        """A part in blocks between the places that no piece crosses."""
        codes = _codes(part)
        total = len(codes)
        crossed = np.zeros(total + 1, bool)
        # A slab at a time; pieces that begin in it may end beyond it.
        for low in range(0, total, CHUNK_CHARS):
            first = np.arange(low, min(low + CHUNK_CHARS, total))
            for n, i, _ in self.found(codes[low:], total - first):
                for k in range(1, n):
                    crossed[low + i + k] = True
        places = np.flatnonzero(~crossed).tolist()
        return [part[a:b] for a, b in zip(places, places[1:])]

    # --- many parts ---

    def solve(self, parts: list[str], numbers: np.ndarray) -> None:
        """Best segmentation of each part and how far its second best is behind, into the cache.
        Parts come in order of rising length."""
        parts, numbers = parts[::-1], numbers[::-1]
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        total, count, most = int(size.sum()), len(parts), int(size[0])
        longest = min(self.longest, most)
        owner = np.repeat(np.arange(count), size)
        place = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
        # Of the piece of n characters that ends at place j of part p.
        score = np.full((most + 1, longest + 1, count), -np.inf)
        piece = np.full(score.shape, -1, np.int32)
        row = (longest + 1) * count
        cell = place * row + owner
        score.ravel()[cell + row + count] = self.unknown
        for n, i, nodes in self.found(_codes("".join(parts)), size[owner] - place):
            if n <= longest:
                to = cell[i] + n * (row + count)
                score.ravel()[to], piece.ravel()[to] = self.node_score[nodes], self.node_id[nodes]

        forward = np.full((most + 1, count), -np.inf)
        forward[0] = 0.0
        taken = np.zeros((most + 1, count), np.int32)
        # Parts are in order of falling length: those of j characters or more come first.
        active = np.searchsorted(-size, -np.arange(most + 1), "right").tolist()
        for j in range(1, most + 1):
            m, n = active[j], min(j, longest)
            value = score[j, 1 : n + 1, :m] + forward[j - n : j, :m][::-1]
            value.max(axis=0, out=forward[j, :m])
            taken[j, :m] = value.argmax(axis=0) + 1
        backward = np.full((most + 1, count), -np.inf)
        backward[size, np.arange(count)] = 0.0
        for j in range(most - 1, -1, -1):
            m, lengths = active[j + 1], np.arange(1, min(most - j, longest) + 1)
            value = score[j + lengths, lengths, :m] + backward[j + lengths, :m]
            value.max(axis=0, out=backward[j, :m])

        # Walk the best paths back and take their pieces out.
        place, live = size.copy(), np.arange(count)
        walked = []
        while len(live):
            j = place[live]
            n = taken[j, live]
            edge = j * row + n * count + live
            walked.append((live, piece.ravel()[edge]))
            score.ravel()[edge] = -np.inf
            place[live] = j - n
            live = live[place[live] > 0]
        # The second best path has a piece that the best one has not.
        second = np.full(count, -np.inf)
        for n in range(1, longest + 1):
            value = forward[: most + 1 - n] + score[n:, n] + backward[n:]
            np.maximum(second, value.max(axis=0), out=second)
        owner, number = (np.concatenate(x) for x in zip(*walked[::-1]))
        ids = number[np.argsort(owner, kind="stable")]
        known = np.r_[0, np.cumsum(np.bincount(owner, minlength=count))]
        best = forward[size, np.arange(count)]
        self._remember(parts, numbers, best, best - second, ids, known)

    def _remember(self, parts, k, best, behind, ids, known) -> None:
        while len(self.best) <= k.max():
            self.best, self.behind, self.start, self.n_ids, self.whole = (
                np.resize(x, 2 * len(x)) for x in (self.best, self.behind, self.start, self.n_ids, self.whole)
            )
        self.best[k] = best
        self.behind[k] = behind
        self.start[k] = self._hold(ids) + known[:-1]
        self.n_ids[k] = np.diff(known)
        lacking = np.unique(np.searchsorted(known, np.flatnonzero(ids < 0), "right") - 1).tolist()
        # What ids spell is seen once, when parts are solved: that of all parts side by side,
        # and how much of it each part has; that of parts with bytes one by one.
        plain = np.ones(len(parts), bool)
        plain[lacking] = False
        own = ids[np.repeat(plain, np.diff(known))]
        same = "".join(map(self.text.__getitem__, own.tolist())) == "".join([p for p, x in zip(parts, plain.tolist()) if x])
        chars = np.r_[0, np.cumsum(self.chars[ids])]
        self.whole[k] = same & (np.diff(chars[known]) == np.fromiter(map(len, parts), np.int64, len(parts)))
        for p in lacking:
            own = self._with_bytes(parts[p], ids[known[p] : known[p + 1]])
            self.start[k[p]], self.n_ids[k[p]] = self._hold(np.array(own, np.int32)), len(own)
            self.whole[k[p]] = self._spelled(own) == parts[p]
        self.held += _bytes_of(parts)

    def _hold(self, ids: np.ndarray) -> int:
        """Where the ids are in the cache."""
        first, self.n_held = self.n_held, self.n_held + len(ids)
        while len(self.ids) < self.n_held:
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[first : self.n_held] = ids
        return first

    def _encoded(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of parts, one after another."""
        n = self.n_ids[numbers]
        ends = np.cumsum(n)
        return self.ids[np.repeat(self.start[numbers] - ends + n, n) + np.arange(int(n.sum()))]

    def _with_bytes(self, part: str, ids: np.ndarray) -> list[int]:
        out, at = [], 0
        for i in ids.tolist():
            if i < 0:
                out.extend(self.byte_ids[b] for b in part[at].encode("utf-8", "surrogatepass"))
                at += 1
            else:
                out.append(i)
                at += len(self.text[i])
        return out

    def close(self, k: int, part: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """How far the n best segmentations of a part are behind, with their ids; the first is
        the one already chosen."""
        if k not in self.near:
            chosen = tuple(self.ids[self.start[k] : self.start[k] + self.n_ids[k]].tolist())
            found = (self.n_best if len(part) <= LONG_PART else self.n_best_long)(part, n + 1)
            others = [(self.best[k] - s, ids) for s, ids in found if ids != chosen]
            self.near[k] = [(0.0, chosen), *others][:n]
        return self.near[k]

    # --- texts ---

    def prepare(self, texts: list[str]) -> list[Parts]:
        """Parts of each text, all solved."""
        split = []
        for text in texts:
            own = Parts(_PART.findall(normalised(text)))
            if len(text) >= LONG_PART and max(map(len, own)) > LONG_PART:
                own = Parts(b for p in own for b in (self.cut(p) if len(p) > LONG_PART else [p]))
            self._number(own)
            split.append(own)
        if self.held and self.held + _bytes_of(self.index.fresh) > CACHE_BYTES:
            self.forget()
            for own in split:
                self._number(own)
        new, self.index.fresh = self.index.fresh, []
        first = len(self.index) - len(new)
        size = np.fromiter(map(len, new), np.int64, len(new))
        order = np.argsort(size, kind="stable")
        slab: list[int] = []
        for k in order[: np.count_nonzero(size <= LONG_PART)].tolist():
            if slab and (len(slab) + 1) * len(new[k]) > SLAB_CHARS:
                self.solve([new[i] for i in slab], first + np.array(slab))
                slab = []
            slab.append(k)
        if slab:
            self.solve([new[i] for i in slab], first + np.array(slab))
        for k in order[np.count_nonzero(size <= LONG_PART) :].tolist():
            found = self.n_best_long(new[k], 2)
            behind = found[0][0] - found[1][0] if len(found) > 1 else np.inf
            ids = np.array(found[0][1], np.int32)
            self._remember([new[k]], np.array([first + k]), np.array([found[0][0]]), np.array([behind]), ids, np.array([0, len(ids)]))
        return split

    def _number(self, parts: Parts) -> None:
        parts.numbers = np.fromiter(map(self.index.__getitem__, parts), np.int32, len(parts))

    def encode(self, parts: Parts, n: int) -> tuple[bytes, list[float], list[dict[int, tuple[int, ...]]]]:
        """Ids of the best segmentation, scores of the n best, and what each of them changes."""
        if not parts:
            return b"", [0.0], [{}]
        k = parts.numbers
        total = float(self.best[k].sum())
        behind = self.behind[k]
        few = min(n - 1, len(parts))
        ways: list[tuple[float, dict]] = [(0.0, {})]
        # The closest, and of those as close the first.
        near = np.flatnonzero(behind <= np.partition(behind, few - 1)[few - 1]) if few else np.empty(0, np.int64)
        closest = np.sort(near[np.argsort(behind[near], kind="stable")[:few]])
        for p in closest.tolist():
            if behind[p] == np.inf:
                continue
            options = self.close(int(k[p]), parts[p], n)
            sums = sorted((loss + more, way, rank) for way, (loss, _) in enumerate(ways) for rank, (more, _) in enumerate(options))
            ways = [(loss, ways[way][1] | ({p: options[rank][1]} if rank else {})) for loss, way, rank in sums[:n]]
        return self._encoded(k).tobytes(), [float(total - loss) for loss, _ in ways], [c for _, c in ways]

    def patches(self, parts: Parts, changes: list[dict[int, tuple[int, ...]]]) -> list[tuple[int, int, int, tuple[int, ...]]]:
        """(rank, place, count, ids): at this place of the best ids, so many are replaced by others
        in the segmentation of this rank; the last place of a rank comes first."""
        out = []
        if any(changes):
            at = self.n_ids[parts.numbers]
            end = np.cumsum(at)
            for rank, change in enumerate(changes):
                out += [(rank, int(end[p] - at[p]), int(at[p]), change[p]) for p in sorted(change, reverse=True)]
        return out

    def segmentations(self, parts: Parts, changes: list[dict[int, tuple[int, ...]]], raw: bytes | None = None) -> list[bytes]:
        """Ids of each of the n best, from what `encode` says that each changes."""
        if raw is None:
            raw = self._encoded(parts.numbers).tobytes() if parts else b""
        out = [raw] * len(changes)
        for rank, place, count, ids in self.patches(parts, changes):
            own = out[rank]
            out[rank] = own[: 4 * place] + np.array(ids, np.int32).tobytes() + own[4 * (place + count) :]
        return out

    def round_trip(self, text: str, parts: Parts) -> bool:
        """Whether decoding the best ids gives the text back. Parts hold whole characters, so
        the text's ids spell what its parts' ids spell."""
        return SPACE not in text and bool(self.whole[parts.numbers].all())

    def _spelled(self, ids) -> str:
        """Pieces side by side. Bytes that are no valid UTF-8 become U+FFFD."""
        if self.high.isdisjoint(ids):
            return "".join(map(self.plain.__getitem__, ids))
        out = []
        for is_byte, run in groupby(ids, self.byte_of.__contains__):
            if is_byte:
                out.append(bytes(map(self.byte_of.__getitem__, run)).decode("utf-8", "replace"))
            else:
                out.extend(map(self.text.__getitem__, run))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text that ids stand for. Bytes that are no valid UTF-8 become U+FFFD."""
        return self._spelled(ids).replace(SPACE, " ").removeprefix(" ")


def _bytes_of(parts: Collection[str]) -> int:
    return PART_BYTES * len(parts) + 8 * sum(map(len, parts))


def model(path: str) -> Model:
    return resident("nbest", path, lambda: Model(path))


def encoder(spark: SparkSession, path: str, n: int = N_BEST, with_ids: bool = False):
    """Column of texts to struct(n_pieces, scores, ids_sha256, round_trip, ids, n_best_sha256, changes).

    `scores` are those of the up to n best segmentations, best first; `ids` are the first one's.
    The others are put out as `changes`, (rank, place, count, ids): at this place of `ids`,
    counted from 0, so many are replaced (see `n_best_ids`). `ids_sha256` is of the first ids as
    little-endian 32-bit numbers, `n_best_sha256` of all n, each after its number of ids. The
    ids and changes come with `with_ids`, else null. `round_trip` says whether decoding the ids
    gives the text back, which it does unless the text has a space mark (U+2581) itself. Null
    counts as empty, which has no piece.
    """
    bounded_batches(spark)
    names = ["n_pieces", "scores", "ids_sha256", "round_trip", "ids", "n_best_sha256", "changes"]

    def lists(sizes: list[int], values: pa.Array) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), values)

    def slab(own: Model, texts: list[str]) -> pa.StructArray:
        raws, scored, digests, whole, n_best, patched = [], [], [], [], [], []
        for text, parts in zip(texts, own.prepare(texts)):
            raw, scores, changes = own.encode(parts, n)
            every = hashlib.sha256()
            for way in own.segmentations(parts, changes, raw):
                every.update((len(way) // 4).to_bytes(4, "little") + way)
            raws.append(raw)
            scored.append(scores)
            digests.append(hashlib.sha256(raw).hexdigest())
            whole.append(own.round_trip(text, parts))
            n_best.append(every.hexdigest())
            patched.append(own.patches(parts, changes) if with_ids else [])
        sizes = [len(r) // 4 for r in raws]
        if with_ids:
            ids = lists(sizes, pa.array(np.frombuffer(b"".join(raws), np.int32)))
            flat = [x for own_ in patched for x in own_]
            new = lists([len(x[3]) for x in flat], pa.array([i for x in flat for i in x[3]], pa.int32()))
            fields = [pa.array([x[c] for x in flat], pa.int32()) for c in range(3)]
            changed = lists([len(x) for x in patched], pa.StructArray.from_arrays([*fields, new], ["rank", "place", "count", "ids"]))
        else:
            kind = pa.struct([("rank", pa.int32()), ("place", pa.int32()), ("count", pa.int32()), ("ids", pa.list_(pa.int32()))])
            ids, changed = pa.nulls(len(raws), pa.list_(pa.int32())), pa.nulls(len(raws), pa.list_(kind))
        scores = lists([len(x) for x in scored], pa.array([y for x in scored for y in x], pa.float64()))
        columns = [pa.array(sizes, pa.int64()), scores, pa.array(digests, pa.string()), pa.array(whole, pa.bool_()), ids, pa.array(n_best, pa.string()), changed]
        return pa.StructArray.from_arrays(columns, names)

    def run(column: pa.Array) -> pa.Array:
        own, texts = model(path), [t or "" for t in column.to_pylist()]
        out = []
        first = size = 0
        for i in range(len(texts) + 1):
            if i < len(texts) and (i == first or size + len(texts[i]) <= CHUNK_CHARS):
                size += len(texts[i])
                continue
            out.append(slab(own, texts[first:i]))
            first, size = i, len(texts[i]) if i < len(texts) else 0
        return pa.concat_arrays(out)

    return F.arrow_udf(
        run,
        """struct<n_pieces:bigint,scores:array<double>,ids_sha256:string,round_trip:boolean,ids:array<int>,
           n_best_sha256:string,changes:array<struct<rank:int,place:int,count:int,ids:array<int>>>>""",
    )


def n_best_ids(ids: Column, scores: Column, changes: Column) -> Column:
    """Ids of each of the n best segmentations, from what `encoder` puts out."""

    def changed(acc: Column, c: Column) -> Column:
        rest = F.slice(acc, c["place"] + c["count"] + 1, F.greatest(F.size(acc) - c["place"] - c["count"], F.lit(0)))
        return F.concat(F.slice(acc, F.lit(1), c["place"]), c["ids"], rest)

    ranks = F.sequence(F.lit(0), F.size(scores) - 1)
    return F.transform(ranks, lambda r: F.aggregate(F.filter(changes, lambda c: c["rank"] == r), ids, changed))


def decoder(spark: SparkSession, path: str):
    """Column of ids to the text that they stand for; null gives null."""
    bounded_batches(spark)

    def run(column: pa.Array) -> pa.Array:
        own = model(path)
        return pa.array([None if ids is None else own.decode(ids) for ids in column.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")


def decoding(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text for each row of ids; other columns are not read."""
    return encoded.select(F.col(id_col).alias("doc_id"), decoder(encoded.sparkSession, path)(F.col(ids_col)).alias("text"))


def n_best_encoding(
    docs: DataFrame, path: str, n: int = N_BEST, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and the fields of `encoder` for each row of docs; with ids also `n_best_ids`, those of
    each of the n best segmentations.

    Rows that repeat, or share an id, or have none, are encoded one by one; other columns are
    not read; an empty table gives an empty result.
    """
    encode = encoder(docs.sparkSession, path, n, with_ids)
    out = docs.select(F.col(id_col).alias("doc_id"), encode(F.col(text_col)).alias("r")).select("doc_id", "r.*")
    return out.withColumn("n_best_ids", n_best_ids(F.col("ids"), F.col("scores"), F.col("changes"))) if with_ids else out
