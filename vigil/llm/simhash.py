"""Near duplicates by SimHash fingerprints, compared in a self-join of binary tries.

Two nodes of a trie are traversed together: their children are paired, a pair whose last bits
differ spends one of the errors allowed, and a pair that has spent too many is left. Three
tries hold every fingerprint, rotated so that each third of its bits comes first once. Two
fingerprints that differ in two bits agree in one third, so in each trie the top third may
spend nothing: node pairs there are a node with itself, which Spark groups by its bits.

A node pair with few fingerprints below is traversed by one task, together with many others.
One with many is split, level by level, into pairs of deeper nodes by joins of node tables,
until each is small. No pair of fingerprints is spelled out before it is a link.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from vigil.llm.bytetext import bounded_batches, text_bytes
from vigil.llm.stores import Store, least_label

SHINGLE = 3
SEED = 42
ERRORS = 2  # bits that linked fingerprints may differ in
BLOCK_BYTES = 1 << 20  # a text is cut into words and hashed about so much at a time
BLOCK_HASHES = 1 << 14
TOPS = (21, 21, 22)  # bits of the thirds; trie t has third t on top
TURNS = (0, 21, 42)  # by which trie t turns its fingerprints to the left
UNIT = 20_000  # most fingerprints below a node pair that one task traverses
LEVELS = 4  # of the trie by which larger ones are split at a time
FRONTIER = 1 << 18  # node pairs that are advanced at once

_space = re.compile(rb"[ \t-\r]")


# --- fingerprints ---------------------------------------------------------------------


def _hashes(text: bytes) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text, in blocks; a text of fewer words is one shingle."""
    digest, before, some, at = xxhash.xxh64_intdigest, [], False, 0
    while at < len(text):
        cut = _space.search(text, at + BLOCK_BYTES)
        end = cut.start() if cut else len(text)
        words = before + text[at:end].lower().split()
        at = end
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1][: max(0, len(words) - SHINGLE + 1)]
        pairs = zip(starts.tolist(), ends[SHINGLE - 1 :].tolist())
        if len(starts):
            some = True
            yield np.fromiter((digest(joined[s:e], SEED) for s, e in pairs), np.uint64, len(starts))
        before = words[-(SHINGLE - 1) :]
    if before and not some:
        yield np.array([digest(b" ".join(before), SEED)], np.uint64)


def fingerprint(text: bytes) -> int:
    """64 bits, each 1 if it is set in over half the shingles' hashes; 0 for no words."""
    total, ones = 0, np.zeros(64, np.int64)
    for hashes in _hashes(text):
        total += len(hashes)
        for i in range(0, len(hashes), BLOCK_HASHES):
            block = np.ascontiguousarray(hashes[i : i + BLOCK_HASHES]).view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


@F.arrow_udf(T.LongType())
def _fingerprints(texts: pa.Array) -> pa.Array:
    prints = np.fromiter(map(fingerprint, text_bytes(texts)), np.uint64, len(texts))
    return pa.array(prints.view(np.int64))


# --- the tries' node pairs, in Spark --------------------------------------------------


def _turned(fp: Column, by: int) -> Column:
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by)) if by else fp


def _depth(round_: int, top: int) -> int:
    """Bits of a node; each round goes LEVELS deeper."""
    return min(64, top + LEVELS * round_)


def _node(round_: int) -> Column:
    """The node above a turned fingerprint v, as its bits."""
    out = F.lit(None).cast("bigint")
    for turn, top in enumerate(TOPS):
        out = F.when(F.col("turn") == turn, F.shiftrightunsigned("v", 64 - _depth(round_, top))).otherwise(out)
    return out


def links(prints: DataFrame, store: Store) -> DataFrame:
    """(a, b): all pairs of distinct fingerprints, in column fp, that differ in ERRORS bits or fewer."""
    turned = F.array(*[F.struct(F.lit(t).alias("turn"), _turned(F.col("fp"), by).alias("v")) for t, by in enumerate(TURNS)])
    members = prints.select(F.inline(turned))
    counts = members.groupBy("turn", _node(0).alias("a")).agg(F.count("*").alias("n")).filter("n > 1")
    units = store.keep(
        counts.select("turn", "a", F.col("a").alias("b"), F.lit(0).alias("spent"), F.col("n").alias("na"), F.col("n").alias("nb")),
        "units-0",
    )
    found, round_ = [], 0
    while True:
        size = F.col("na") + F.when(F.col("a") == F.col("b"), 0).otherwise(F.col("nb"))
        small, large = units.filter(size <= UNIT), units.filter(size > UNIT)
        placed = members.withColumn("node", _node(round_))
        depth = F.array(*[F.lit(_depth(round_, top)) for top in TOPS])[F.col("turn")].alias("depth")
        sides = [
            placed.join(u, ["turn", "node"]).select("turn", depth, "a", "b", "spent", F.lit(s).alias("side"), "v")
            for s, u in enumerate((
                small.select("turn", F.col("a").alias("node"), "a", "b", "spent"),
                small.filter("a <> b").select("turn", F.col("b").alias("node"), "a", "b", "spent"),
            ))
        ]
        work = sides[0] if round_ == 0 else sides[0].union(sides[1])
        found.append(f"links-{round_}")
        store.keep(
            work.repartition("turn", "a", "b").sortWithinPartitions("turn", "a", "b", "side")
            # Workers import this module anew, so what is set here goes with the function.
            .mapInArrow(partial(_traversed, unit=UNIT, frontier=FRONTIER), "a bigint, b bigint"),
            found[-1],
        )
        if large.isEmpty():
            return store.read(found)
        # The nodes of what is still large, with their children and how much is below each.
        nodes = large.select("turn", F.col("a").alias("node")).union(large.select("turn", F.col("b").alias("node"))).distinct()
        members = store.keep(placed.join(nodes, ["turn", "node"], "left_semi").select("turn", "v", F.col("node").alias("above")), f"members-{round_}")
        round_ += 1
        below = store.keep(
            members.groupBy("turn", "above", _node(round_).alias("node")).agg(F.count("*").alias("n")), f"nodes-{round_}"
        )
        members = members.drop("above")
        left = below.select("turn", F.col("above").alias("a"), F.col("node").alias("ca"), F.col("n").alias("ma"))
        right = below.select("turn", F.col("above").alias("b"), F.col("node").alias("cb"), F.col("n").alias("mb"))
        spent = F.bit_count(F.col("ca").bitwiseXOR(F.col("cb")))
        pairs = (
            large.select("turn", "a", "b").join(left, ["turn", "a"]).join(right, ["turn", "b"])
            .filter((spent <= ERRORS) & ((F.col("a") != F.col("b")) | (F.col("ca") <= F.col("cb"))))
            # A single fingerprint has no pair with itself.
            .filter((F.col("ca") != F.col("cb")) | (F.col("ma") > 1))
        )
        units = store.keep(
            pairs.select("turn", F.col("ca").alias("a"), F.col("cb").alias("b"), spent.alias("spent"), F.col("ma").alias("na"), F.col("mb").alias("nb")),
            f"units-{round_}",
        )


# --- traversal of small node pairs, in a task -----------------------------------------


def _traversed(batches: Iterator[pa.RecordBatch], unit: int, frontier: int) -> Iterator[pa.RecordBatch]:
    """Links below the node pairs of a partition, whose rows come sorted by node pair and side."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows > unit:
            table = pa.concat_tables(held).combine_chunks()
            first = _changes(table)
            cut = int(first[-1])  # the last node pair may go on in the next batch
            held, rows = [table.slice(cut)], table.num_rows - cut
            if cut:
                yield from _links(table.slice(0, cut), first[:-1], frontier)
    if rows:
        table = pa.concat_tables(held).combine_chunks()
        yield from _links(table, _changes(table), frontier)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _changes(table: pa.Table) -> np.ndarray:
    """Where each node pair's rows begin."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for name in ("turn", "a", "b"):
        x = _column(table, name)
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _links(table: pa.Table, first: np.ndarray, frontier: int) -> Iterator[pa.RecordBatch]:
    turn, side = _column(table, "turn"), _column(table, "side")
    unit = np.repeat(np.arange(len(first)), np.diff(np.r_[first, table.num_rows]))
    order = np.lexsort((_column(table, "v").view(np.uint64), side, unit))
    v = _column(table, "v").view(np.uint64)[order]
    size = np.bincount(unit, minlength=len(first))
    of_a = np.bincount(unit, side == 0, minlength=len(first)).astype(np.int64)
    alone = of_a == size  # a node with itself
    lo, mid, hi = first, first + of_a, first + size
    depth = _column(table, "depth")[first]
    for level in np.unique(depth).tolist():
        at = depth == level
        start = (lo[at], mid[at], np.where(alone, lo, mid)[at], hi[at], _column(table, "spent")[first][at].astype(np.int8))
        for a, b in traverse(v, level, start, frontier):
            t = turn[a]  # every row of a node pair has its trie
            yield _unturned(v[a], v[b], t)


def _unturned(a: np.ndarray, b: np.ndarray, turn: np.ndarray) -> pa.RecordBatch:
    """Pairs as fingerprints, without those that an earlier trie has found too."""
    by = np.array(TURNS, np.uint64)[turn]
    back = (np.uint64(64) - by) & np.uint64(63)
    a, b = ((x >> by) | np.where(by > 0, x << back, np.uint64(0)) for x in (a, b))
    odd, new = a ^ b, np.ones(len(a), bool)
    for t, (top, start) in enumerate(zip(TOPS, TURNS)):
        third = np.uint64(((1 << top) - 1) << (64 - start - top))
        new &= (turn <= t) | (odd & third != 0)
    low, high = np.minimum(a, b)[new], np.maximum(a, b)[new]
    return pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), pa.array(high.view(np.int64))], ["a", "b"])


def traverse(
    v: np.ndarray, depth: int, pairs: tuple[np.ndarray, ...], frontier: int = FRONTIER
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of v, sorted below each node, whose values differ in ERRORS bits or fewer.

    A node is the range of v below it; pairs are (from a, to a, from b, to b, errors spent) of
    nodes at one depth. A pair of a node with itself has equal ranges. Pairs are advanced in
    blocks, the deepest first, so that few are held at a time.
    """
    ones: dict[int, np.ndarray] = {}

    def split(lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
        """Where the children with bit 1 begin."""
        if level not in ones:
            bit = (v >> np.uint64(63 - level)) & np.uint64(1)
            ones[level] = np.concatenate([[0], np.cumsum(bit.astype(np.int32), dtype=np.int32)])
        return hi - (ones[level][hi] - ones[level][lo])

    stack = [(depth, pairs)]
    while stack:
        level, (la, ha, lb, hb, spent) = stack.pop()
        if len(la) > frontier:
            for i in range(0, len(la), frontier):
                stack.append((level, tuple(x[i : i + frontier] for x in (la, ha, lb, hb, spent))))
            continue
        itself = la == lb
        # Two single fingerprints are compared at once: below them the trie has no branch.
        single = (ha - la == 1) & (hb - lb == 1)
        leaf = single & ~itself
        if leaf.any():
            a, b = la[leaf], lb[leaf]
            near = np.bitwise_count(v[a] ^ v[b]) <= ERRORS
            if near.any():
                yield a[near], b[near]
        if single.all():
            continue
        la, ha, lb, hb, spent, itself = (x[~single] for x in (la, ha, lb, hb, spent, itself))
        ma, mb = split(la, ha, level), split(lb, hb, level)
        children = [
            (la, ma, lb, mb, spent, None), (ma, ha, mb, hb, spent, None),
            (la, ma, mb, hb, spent + 1, None), (ma, ha, lb, mb, spent + 1, ~itself),
        ]
        kept = []
        for a0, a1, b0, b1, cost, only in children:
            live = (a1 > a0) & (b1 > b0) & (cost <= ERRORS)
            if only is not None:
                live &= only
            kept.append([x[live] for x in (a0, a1, b0, b1, cost)])
        following = tuple(np.concatenate(x) for x in zip(*kept))
        if len(following[0]):
            stack.append((level + 1, following))


# --- the operator ---------------------------------------------------------------------


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (a number) and component_id, one row for each row of docs.

    Null texts and texts without words have the fingerprint 0, which is linked like any other.
    A component is named by its smallest id of any type that has an order. Rows without an id
    take part; their group's name is null only if no member has an id. Rows that share an id or
    repeat are judged each by its own text. Other columns are not read. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    store = Store(spark, "simhash")
    rows = store.keep(docs.select(F.col(id_col).alias("doc_id"), _fingerprints(F.col(text_col)).alias("fp")), "rows")
    prints = store.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    labels = least_label(links(prints.select("fp"), store), store, "parts")
    placed = store.keep(
        prints.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "least", F.coalesce("component", "fp").alias("part")),
        "placed",
    )
    names = placed.groupBy("part").agg(F.min("least").alias("component_id"))
    # A fingerprint that many rows share is a hot key of their side only, which Spark splits.
    named = store.keep(placed.join(names, "part").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")
