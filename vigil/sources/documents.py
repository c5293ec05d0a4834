"""JSON documents of any size, cut into their records by many tasks.

A document is one array, whose elements are its records, or one object. Spark reads it in
pieces that end where an object begins, and a large file in blocks by many tasks. Where a
block lies inside the document is not known when it is read, so each is scanned twice:

1. for both answers to "does it begin inside a string?", how much deeper it ends and how many
   commas it has at its lowest levels; a pass over these few numbers, one row a block, then
   gives the string state, depth and record number that each block begins with;
2. with that, cutting at the commas between records. A record that lies in one block is whole;
   only pieces of records that cross blocks are moved and put together.

So no task holds a document, only a record at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

OPENS = "{"  # pieces end before one; no valid document ends with one
_SUMMARY = (
    "file_path string, block_start bigint, guess int, ends_inside boolean, deeper int, lowest int, commas bigint, "
    "commas_above bigint, first_byte int"
)
_FRAGMENT = "file_path string, modified timestamp, block_start bigint, number bigint, whole boolean, value binary"
ARRAY, OBJECT = 0x5B, 0x7B  # first byte of a document
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0D]] = True
_STEP = np.zeros(256, np.int8)
_STEP[list(b"{[")], _STEP[list(b"}]")] = 1, -1


@dataclass(frozen=True)
class Start:
    """Where a block begins: inside a string or not, how deep, in which record; whether text came
    before it, the document's first byte, and whether the document has one comma at least."""

    inside: bool
    depth: int
    number: int
    begun: bool
    kind: int
    several: bool


Block = tuple[str, int]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, datetime, bytes]]:
    """Blocks with their text, some at a time and in order."""
    block = None
    for batch in batches:
        paths, starts = batch.column("file_path").to_pylist(), batch.column("block_start").to_pylist()
        values, times = batch.column("value").to_pylist(), batch.column("modified")
        first = 0
        for i in range(1, len(paths) + 1):
            if i < len(paths) and (paths[i], starts[i]) == (paths[first], starts[first]):
                continue
            here = paths[first], starts[first]
            # Every piece but the first of a file follows an opening brace.
            head = b"" if here != block and not here[1] else b"{"
            yield here, times[first].as_py(), head + b"{".join(values[first:i])
            block, first = here, i


def _unquoted(text: np.ndarray) -> np.ndarray:
    """1 where a string begins or ends: quotes after an even number of backslashes."""
    quotes = text == 0x22
    slash = text == 0x5C
    if slash.any():
        place = np.arange(len(text))
        other = np.maximum.accumulate(np.where(slash, -1, place))
        run = place - other  # backslashes up to each place
        quotes[1:] &= run[:-1] % 2 == 0
    return quotes


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, state = None, None
    for here, _, raw in _runs(batches):
        if here != block:
            if block is not None:
                yield _summary(block, state)
            block, state = here, {"inside": 0, "first": -1, 0: [0, 0, {}], 1: [0, 0, {}]}
        text = np.frombuffer(raw, np.uint8)
        parity = (np.cumsum(_unquoted(text)) + state["inside"]) & 1
        if state["first"] < 0 and not _BLANK[text].all():
            state["first"] = int(text[~_BLANK[text]][0])
        step, comma = _STEP[text], text == 0x2C
        for guess in (0, 1):
            outside = parity == guess
            depth, lowest, commas = state[guess]
            level = depth + np.cumsum(np.where(outside, step, 0), dtype=np.int64)
            if len(level):
                state[guess][0], lowest = int(level[-1]), min(lowest, int(level.min()))
            own = level[outside & comma]
            for at in (lowest, lowest + 1):
                commas[at] = commas.get(at, 0) + int((own == at).sum())
            state[guess][1:] = lowest, {at: n for at, n in commas.items() if at <= lowest + 1}
        state["inside"] = int(parity[-1]) if len(parity) else state["inside"]
    if block is not None:
        yield _summary(block, state)


def _summary(block: Block, state: dict) -> pa.RecordBatch:
    rows = [
        (*block, guess, bool(state["inside"] ^ guess), state[guess][0], state[guess][1],
         state[guess][2].get(state[guess][1], 0), state[guess][2].get(state[guess][1] + 1, 0), state["first"])
        for guess in (0, 1)
    ]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
    names = ["file_path", "block_start", "guess", "ends_inside", "deeper", "lowest", "commas", "commas_above", "first_byte"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def starts(rows: list) -> tuple[dict[Block, Start], list[str]]:
    """What each block begins with, and the files that are no one array or object."""
    files: dict[str, dict[int, dict[int, object]]] = {}
    for r in rows:
        files.setdefault(r.file_path, {}).setdefault(r.block_start, {})[r.guess] = r
    out, bad = {}, []
    for path, blocks in files.items():
        inside, depth, number, kind = False, 0, 0, -1
        own = {}
        for place in sorted(blocks):
            r = blocks[place][int(inside)]
            own[path, place] = inside, depth, number, kind >= 0
            kind = r.first_byte if kind < 0 else kind
            # Records stand at depth 1, the lowest level of a block or the one above it.
            if kind == ARRAY:
                number += {0: r.commas, 1: r.commas_above}.get(1 - depth - r.lowest, 0)
            if depth + r.lowest < 0:
                kind = 0
            inside, depth = r.ends_inside, depth + r.deeper
        if inside or depth or kind not in (ARRAY, OBJECT, -1):
            bad.append(path)
        elif kind >= 0:  # else there are blanks only
            out |= {block: Start(*state, kind, number > 0) for block, state in own.items()}
    return out, bad


class _Cutter:
    """Cuts the text of one block into records."""

    def __init__(self, start: Start):
        self.inside, self.depth, self.number = start.inside, start.depth, start.number
        self.begun, self.array, self.several = start.begun, start.kind == ARRAY, start.several
        self.held: list[bytes] = []
        self.from_edge = start.begun  # the record under way began in an earlier block

    def cut(self, raw: bytes) -> Iterator[tuple[int, bool, bytes]]:
        """(number, whole, text) of records that end here; number -1 for text outside the value."""
        text = np.frombuffer(raw, np.uint8)
        parity = (np.cumsum(_unquoted(text)) + self.inside) & 1
        outside = parity == 0
        step = np.where(outside, _STEP[text], 0)
        level = self.depth + np.cumsum(step, dtype=np.int64)
        # Outside the value only blanks may stand; one bracket begins it, and its like ends it.
        end = (step == -1) & (text == (ARRAY if self.array else OBJECT) + 2)
        around = np.flatnonzero((level == 0) & ~_BLANK[text] & ~end)
        begins = np.flatnonzero((level == 1) & (step == 1))
        if len(around) or len(begins) > (not self.begun):
            yield -1, True, b""
        cuts = np.empty(0, np.int64)
        if self.array:
            edge = ((level == 1) & ((text == 0x2C) & outside | (step == 1))) | ((level == 0) & (step == -1))
            cuts = np.flatnonzero(edge)
        at = 0
        for cut, is_open in zip(cuts.tolist(), (step[cuts] == 1).tolist()):
            if not is_open:
                self.held.append(raw[at:cut])
                yield from self._done()
            self.held, self.from_edge, at = [], False, cut + 1
        if not self.array or level[-1:].any() or (not len(level) and self.depth):
            self.held.append(raw[at:])
        self.begun |= bool(len(begins))
        if len(text):
            self.inside, self.depth = bool(parity[-1]), int(level[-1])

    def _done(self) -> Iterator[tuple[int, bool, bytes]]:
        value = b"".join(self.held)
        if self.several or self.from_edge or value.strip(b" \t\r\n"):
            yield self.number, not self.from_edge, value
        self.number += 1

    def rest(self) -> Iterator[tuple[int, bool, bytes]]:
        """The record that goes on in the next block."""
        value = b"".join(self.held)
        if value.strip(b" \t\r\n") or self.depth:
            yield self.number, False, value


def _fragments(places: dict[Block, Start]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, cutter = None, None

        def out(found, when) -> Iterator[pa.RecordBatch]:
            rows = list(found)
            if rows:
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block[0]] * n, pa.string()), pa.array([when] * n, pa.timestamp("us", "UTC")), pa.array([block[1]] * n, pa.int64()),
                        pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.binary()),
                    ],
                    ["file_path", "modified", "block_start", "number", "whole", "value"],
                )

        time = None
        for here, when, raw in _runs(batches):
            if here != block:
                if cutter:
                    yield from out(cutter.rest(), time)
                block, time = here, when
                cutter = _Cutter(places[here]) if here in places else None
            if cutter:
                yield from out(cutter.cut(raw), when)
        if cutter:
            yield from out(cutter.rest(), time)

    return run


def document_records(pieces: DataFrame) -> tuple[DataFrame, list[str]]:
    """Records of documents as text, with file_path, modified and their number in the document,
    and the files that are no one array or object. A record that is no valid JSON, and text
    around the value, come as records with number -1 or text that does not parse.

    `pieces` are the documents' text in columns value, file_path, modified and block_start, cut
    before each `{`, as Spark reads them: in order inside a block, each block in one task.
    """
    raw = pieces.withColumn("value", F.col("value").cast("binary"))
    # Two rows for each block come back, whatever is in it.
    places, bad = starts(raw.mapInArrow(_summaries, _SUMMARY).collect())
    cut = raw.mapInArrow(_fragments(places), _FRAGMENT)
    joined = (
        cut.filter("not whole").groupBy("file_path", "modified", "number")
        .agg(F.array_sort(F.collect_list(F.struct("block_start", "value"))).alias("parts"))
        .select("file_path", "modified", "number", F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["value"])).alias("value"))
    )
    every = cut.filter("whole").select("file_path", "modified", "number", "value").unionByName(joined)
    return every.withColumn("value", F.col("value").cast("string")), bad
