"""Benchmark decontamination on a distributed positional inverted index.

Training texts are indexed once, in segments of whole documents. A segment's row holds its
term dictionary and, term after term, the positions of the term, so it is searched without
any other segment and nothing is shuffled to build or to search the index. Terms are 64-bit
word hashes.

A search walks the index in blocks of test phrases of bounded size. In a segment, a phrase
whose terms are not all present costs one dictionary look-up. For the others the positions
of the rarest term, moved back by its offset in the phrase, are intersected with the moved
positions of the next rarest term, and so on; what is left are exact occurrences. Proximity
search asks for the phrase's words in order with a few other words between them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vigil.llm.bytetext import ALNUM, Words, bounded_batches, chunks, text_bytes
from vigil.llm.resident import serve
from vigil.llm.stores import Store

WINDOW = 10
SEGMENT_BYTES = 4 << 20  # of text in one segment; a longer document is a segment of its own
BLOCK_WORDS = 1 << 20  # words of test phrases that one pass over the index searches for

INDEX_SCHEMA = """segment bigint, n_docs int, doc_ids array<bigint>, doc_words array<bigint>,
                  terms binary, counts binary, positions binary"""


# --- index ------------------------------------------------------------------------------


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    serve("decontaminate")
    for batch in batches:
        texts = text_bytes(batch.column("text"))
        for a, b in chunks(texts, SEGMENT_BYTES):
            hashes, counts = [], []
            for i, j in chunks(texts[a:b]):
                words = Words([t.lower() for t in texts[a + i : a + j]], ALNUM)
                hashes.append(words.hashes)
                counts.append(words.counts)
            terms, counts = np.concatenate(hashes), np.concatenate(counts)
            # One unused position between documents keeps phrases inside them.
            place = np.arange(len(terms)) + np.repeat(np.arange(len(counts)), counts)
            order = np.argsort(terms, kind="stable")
            sorted_terms = terms[order]
            heads = np.flatnonzero(np.r_[True, sorted_terms[1:] != sorted_terms[:-1]][: len(terms)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([0], pa.int64()),
                    pa.array([b - a], pa.int32()),
                    pa.array([batch.column("doc_id").slice(a, b - a).to_pylist()], pa.list_(pa.int64())),
                    pa.array([counts], pa.list_(pa.int64())),
                    pa.array([sorted_terms[heads].tobytes()], pa.binary()),
                    pa.array([np.diff(np.r_[heads, len(terms)]).astype(np.uint32).tobytes()], pa.binary()),
                    pa.array([place[order].astype(np.uint32).tobytes()], pa.binary()),
                ],
                ["segment", "n_docs", "doc_ids", "doc_words", "terms", "counts", "positions"],
            )


def build_index(docs: DataFrame, store: Store, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored positional index of all words of all documents, one row per segment.

    Null texts have no words; a document keeps its entry all the same. Repeated rows and
    repeated or null ids are separate documents of their segment.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInArrow(_segment_rows, INDEX_SCHEMA)
    return store.keep(rows.withColumn("segment", F.monotonically_increasing_id()), "index")


class Segment:
    """One row of the index, ready to be searched."""

    def __init__(self, row: dict):
        self.words = np.asarray(row["doc_words"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.counts = np.frombuffer(row["counts"], np.uint32)
        self.places = np.frombuffer(row["positions"], np.uint32)
        self.starts = np.r_[0, np.cumsum(self.counts, dtype=np.int64)]
        self.doc_at = np.r_[0, np.cumsum(self.words + 1)]  # first position of each document

    def positions(self, k: int) -> np.ndarray:
        return self.places[self.starts[k] : self.starts[k + 1]].astype(np.int64)

    def look_up(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term in the dictionary, or -1."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        k = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[k] == terms, k, -1)

    def phrase(self, ks: np.ndarray) -> np.ndarray:
        """Positions at which the terms stand one after the other."""
        order = np.argsort(self.counts[ks], kind="stable")
        found = self.positions(ks[order[0]]) - order[0]
        for o in order[1:]:
            if not len(found):
                break
            other = self.positions(ks[o])
            at = np.minimum(np.searchsorted(other, found + o), len(other) - 1)
            found = found[other[at] == found + o]
        return found

    def near(self, ks: np.ndarray, slack: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends (exclusive) of the shortest in-order matches from each start of the
        first term, inside one document, with at most `slack` other words in between."""
        start = last = self.positions(ks[0])
        for k in ks[1:]:
            other = self.positions(k)
            at = np.searchsorted(other, last, "right")
            ok = at < len(other)
            start, last = start[ok], other[at[ok]]
        ok = (last - start + 1 <= len(ks) + slack) & (self.doc_of(start) == self.doc_of(last))
        return start[ok], last[ok] + 1

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_at, at, "right") - 1


# --- test phrases -----------------------------------------------------------------------


@dataclass
class Block:
    """Test phrases of one pass: terms[starts[i]:starts[i + 1]] belong to item[i]."""

    items: list[str]
    item: np.ndarray
    starts: np.ndarray
    terms: np.ndarray


def phrase_blocks(
    items: DataFrame, store: Store, id_col: str, text_col: str, window: int | None
) -> Iterator[Block]:
    """Blocks of whole items, each of about BLOCK_WORDS words; only one is in memory at a time.

    With a window, an item's phrases are its runs of that many words; an item of fewer words,
    or any item without a window, is one phrase. Items without words or without an id have none.
    """
    own = items.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")
    ).filter("id is not null and text is not null").distinct()
    sized = store.keep(own.withColumn("n", F.length("text").cast("bigint")), "items")
    total = sized.agg(F.sum("n")).first()[0] or 0
    # A word takes two characters at least; windows repeat it up to `window` times.
    blocks = int(total // 2 * (window or 1) // BLOCK_WORDS) + 1
    numbered = sized.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    for b in range(blocks):
        rows = numbered.filter(F.col("block") == b).select("id", "text").collect()
        names, item, lengths, terms = [], [], [0], []
        for row in rows:
            words = Words([row.text.encode().lower()], ALNUM).hashes
            if not len(words):
                continue
            size = min(window or len(words), len(words))
            runs = np.lib.stride_tricks.sliding_window_view(words, size)
            item.extend([len(names)] * len(runs))
            lengths.extend([size] * len(runs))
            terms.append(runs.ravel())
            names.append(row.id)
        if names:
            yield Block(names, np.array(item), np.cumsum(lengths), np.concatenate(terms))


# --- search -----------------------------------------------------------------------------


def occurrences(segment: Segment, block: Block, slack: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the phrase, start and end of every match in a segment."""
    distinct, which = np.unique(block.terms, return_inverse=True)
    known = segment.look_up(distinct)[which]
    here = np.minimum.reduceat(known, block.starts[:-1]) >= 0
    phrases, starts, ends = [], [], []
    for p in np.flatnonzero(here).tolist():
        ks = known[block.starts[p] : block.starts[p + 1]]
        if slack:
            s, e = segment.near(ks, slack)
        else:
            s = segment.phrase(ks)
            e = s + len(ks)
        if len(s):
            phrases.append(np.full(len(s), p))
            starts.append(s)
            ends.append(e)
    if not phrases:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(phrases), np.concatenate(starts), np.concatenate(ends)


def _search(block: Block | None, slack: int):
    """Per document: the words hit, as disjoint ascending spans, and the items found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serve("decontaminate")
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()  # one segment at a time is copied
                segment, n = Segment(row), row["n_docs"]
                spans: list[list] = [[] for _ in range(n)]
                items: list[list] = [[] for _ in range(n)]
                if block is not None:
                    phrase, start, end = occurrences(segment, block, slack)
                    doc = segment.doc_of(start)
                    for d, i in sorted(set(zip(doc.tolist(), block.item[phrase].tolist()))):
                        items[d].append(block.items[i])
                    hit = np.zeros(segment.doc_at[-1] + 1, np.int32)
                    np.add.at(hit, start, 1)
                    np.add.at(hit, end, -1)
                    inside = np.r_[False, np.cumsum(hit) > 0]
                    edges = np.flatnonzero(inside[1:] != inside[:-1])
                    of = segment.doc_of(edges[0::2])
                    base = segment.doc_at[of]
                    for d, s, e in zip(of.tolist(), (edges[0::2] - base).tolist(), (edges[1::2] - base).tolist()):
                        spans[d].append({"start": s, "end": e})
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["segment"]] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["doc_words"], pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    ["segment", "ordinal", "doc_id", "n_words", "spans", "items"],
                )

    return run


def search(
    index: DataFrame, items: DataFrame, store: Store,
    id_col: str = "item_id", text_col: str = "text", window: int | None = WINDOW, slack: int = 0,
) -> DataFrame:
    """One row per indexed document: doc_id, n_words, n_hit, items (distinct, sorted) and spans.

    `spans` are the hit words (start, end exclusive), as found in each block; n_hit counts a
    word once. With `slack`, phrases match in order with up to that many words in between.
    Without items, or with items that have no words, nothing is hit.
    """
    schema = """segment bigint, ordinal int, doc_id bigint, n_words bigint,
                spans array<struct<start:bigint,end:bigint>>, items array<string>"""
    found, blocks = None, 0
    for block in phrase_blocks(items, store, id_col, text_col, window):
        part = index.mapInArrow(_search(block, slack), schema)
        found = part if found is None else found.union(part)
        blocks += 1
    if found is None:
        found = index.mapInArrow(_search(None, 0), schema)
    if blocks > 1:
        found = found.groupBy("segment", "ordinal").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"),
        )
    # Spans of several blocks can overlap: walk them in order and count what each adds.
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("bigint"), s["end"] - F.greatest(s["start"], acc["end"]))).alias("n"),
            F.greatest(s["end"], acc["end"]).alias("end"),
        ),
    )["n"]
    return found.select(
        "doc_id", "n_words", covered.alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"), "spans",
    )


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """Every row of docs with n_words, n_hit, items, spans and contaminated (n_hit > 0)."""
    store = Store(docs.sparkSession, "decontaminate")
    index = build_index(docs, store, id_col, text_col)
    return search(index, items, store, window=window).withColumn("contaminated", F.col("n_hit") > 0)
