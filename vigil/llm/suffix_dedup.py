"""Removal of repeated passages by suffix arrays.

Every byte that a string of LENGTH bytes covers goes if the string also starts elsewhere.

1. Every such string is assigned to an anchor, the least hashed K-gram inside it. Equal
   strings have equal anchors, so an anchor that occurs once in the corpus settles all its
   strings: they are unique. Runs of neighbouring strings with one anchor are one piece of
   text; the pieces of anchors that occur again are the candidates, and equal pieces are one.
2. Anchors are dealt to shards of bounded size. A shard sorts the suffixes of its pieces by
   Larsson-Sadakane refinement (the order by h bytes becomes the order by 2h bytes by sorting
   unsettled groups by the rank h bytes on), and Kasai's walk in text order gives the common
   prefixes of neighbours. A string is repeated if its piece occurs again or the common prefix
   with a neighbour has LENGTH bytes. An anchor with one distinct piece needs no sort: the
   piece occurs again, so all its strings do.
3. An anchor whose pieces would overfill a shard is split over several. Their strings are
   merged across shards: each shard sends the sorted fingerprints of its strings by range, each
   once, and each shard's run is looked up in the union of the range by binary search. There
   are as many ranges as the bytes of the split anchors ask for.

Decisions depend on the text alone, so copies of a text are handled once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from vigil.llm.bytetext import ARROW_BATCH_BYTES, bounded_batches, chunks, mix, powers, text_bytes
from vigil.llm.stores import Store

LENGTH = 400
K = 64
SHARD_BYTES = 1 << 20
SLICE = 1 << 24  # starts of strings that are looked at together; longer texts take several
RANGE_STARTS = 1 << 18  # strings of split anchors in one range, at most on average
_PLACE_BITS = 26
_BASE = 0xD6E8FEB86659FD93
_GAP = 0xFF  # in no UTF-8 text

KEY = ["k1", "k2"]


# --- anchors ----------------------------------------------------------------------------


def rolling(text: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from each place on."""
    n = len(text)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=total[1:])
    count = n - k + 1
    return mix((total[k:] - total[:count]) * powers(pow(_BASE, -1, 1 << 64), count))


def anchored_runs(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts of LENGTH-byte strings with one anchor: its hash and place, the first and
    the last start."""
    out = []
    for low in range(0, len(text) - LENGTH + 1, SLICE):
        part = np.frombuffer(text, np.uint8)[low : low + SLICE + LENGTH - 1]
        h = rolling(part, K)
        width = LENGTH - K + 1
        places = np.arange(len(h), dtype=np.uint64)
        mask = np.uint64((1 << _PLACE_BITS) - 1)
        keys = np.full(-(-len(h) // width) * width, ~np.uint64(0))
        # The place in the low bits makes the leftmost of equal hashes the least.
        keys[: len(h)] = (h & ~mask) | places
        blocks = keys.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(h) - width + 1
        least = (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & mask).astype(np.int64)
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        at = least[first]
        out.append((h[at].view(np.int64), at + low, first + low, np.r_[first[1:], n] - 1 + low))
    if not out:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_bytes(batch.column("text"))
        k1, k2 = (batch.column(k).to_numpy() for k in KEY)
        for a, b in chunks(texts):
            found = [anchored_runs(t) for t in texts[a:b]]
            owner = np.repeat(np.arange(a, b), [len(f[0]) for f in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[owner]), pa.array(k2[owner])]
                + [pa.array(np.concatenate([f[c] for f in found])) for c in (0, 1)],
                ["k1", "k2", "anchor", "place"],
            )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each live run of a text; the piece's bytes come with the first of equal ones."""
    kinds = [pa.int64()] * 7 + [pa.binary()]
    names = ["anchor", "s1", "s2", "k1", "k2", "first", "copies", "body"]
    for batch in batches:
        texts = text_bytes(batch.column("text"))
        rest = batch.select([*KEY, "copies", "places"]).to_pylist()
        for a, b in chunks(texts):
            rows, sent = [], set()
            for text, row in zip(texts[a:b], rest[a:b]):
                anchor, place, first, last = anchored_runs(text)
                live = np.flatnonzero(np.isin(place, np.asarray(row["places"])))
                for h, low, high in zip(anchor[live].tolist(), first[live].tolist(), last[live].tolist()):
                    body = text[low : high + LENGTH]
                    digest = hashlib.blake2b(body, digest_size=16).digest()
                    s = int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)
                    rows.append((h, *s, row["k1"], row["k2"], low, row["copies"], None if (h, s) in sent else body))
                    sent.add((h, s))
            size = 0
            first_row = 0
            for i, r in enumerate(rows):
                size += len(r[-1] or b"") + 64
                if size > ARROW_BATCH_BYTES or i == len(rows) - 1:
                    part = rows[first_row : i + 1]
                    yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in part], k) for c, k in enumerate(kinds)], names)
                    first_row, size = i + 1, 0


# --- suffix arrays ----------------------------------------------------------------------


def suffix_order(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffixes in order, each taken up to the gap that ends its piece; `left` is how many bytes
    that is, gap included. Suffixes that are the same up to there go by place, as if the gaps
    were growing letters, so a suffix's order settles that of the one a byte further on.

    Larsson-Sadakane refinement: suffixes ordered by h bytes fall into groups, and a group is
    sorted by the ranks h bytes on. Groups of one, and of suffixes that end within h bytes,
    are settled and not touched again.
    """
    n = len(text)
    bits = n.bit_length()
    h = 5
    padded = np.zeros(n + h, np.uint64)
    padded[:n] = text
    key = np.zeros(n, np.uint64)
    for j in range(h):
        # Nothing follows a gap, so zero there is like nothing else.
        key = (key << np.uint64(8)) | np.where(j < left, padded[j : j + n], np.uint64(0))
    order, key = _sorted_by(key, np.arange(n), bits)
    heads = np.r_[True, key[1:] != key[:-1]][:n]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    most = int(left.max(initial=0))
    open_ = np.arange(n)
    while h < most:
        # Places in the order whose group has more than one member.
        follows = np.r_[~heads[1:], False]
        open_ = open_[(follows | ~heads)[open_]]
        open_ = open_[left[order[open_]] > h]
        if not len(open_):
            break
        place = order[open_]
        # Members of a group agree on h bytes, so either all of them go on or none does.
        key = (rank[place].astype(np.uint64) << np.uint64(bits)) | rank[place + h].astype(np.uint64)
        order[open_], key = _sorted_by(key, place, bits)
        new = np.r_[True, key[1:] != key[:-1]]
        heads[open_] = new
        # A group's rank is where it begins, which its first member says.
        rank[order[open_]] = np.maximum.accumulate(np.where(new, open_, 0))
        h *= 2
    return order


def _sorted_by(key: np.ndarray, place: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys by key, then place. Keys have 2 * bits bits or 40, places have bits."""
    if max(3 * bits, 40 + bits) > 64:
        by = np.lexsort((place, key))
        return place[by], key[by]
    # Both fit one number, which is sorted faster than an index.
    both = np.sort((key << np.uint64(bits)) | place.astype(np.uint64))
    return (both & np.uint64((1 << bits) - 1)).astype(np.int64), both >> np.uint64(bits)


def common_prefixes(
    text: np.ndarray, left: np.ndarray, order: np.ndarray, first: np.ndarray, size: np.ndarray, most: int
) -> np.ndarray:
    """Common prefix, up to `most`, of each suffix in the order with the one before it; gaps
    have nothing in common. Zero for suffixes of fewer than `most` bytes, which end the walk.

    Kasai: from one place to the next in the text, a common prefix shrinks by one at most. The
    walk goes through all pieces (first place, size) side by side, eight bytes at a time.
    """
    n = len(text)
    position = np.empty(n, np.int64)
    position[order] = np.arange(n)
    padded = np.zeros(n + most + 16, np.uint8)
    padded[:n] = text
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = np.zeros(n, np.int64)
    walk = np.maximum(size - most + 1, 0)
    by_walk = np.argsort(-walk, kind="stable")
    first, walk = first[by_walk], walk[by_walk]
    held = np.zeros(len(first), np.int64)
    active = np.searchsorted(-walk, -np.arange(1, int(walk[0]) + 1), "right") if len(walk) else []
    for t, m in enumerate(active):
        i = first[:m] + t
        h = np.maximum(held[:m] - 1, 0)
        at = position[i]
        before = order[np.maximum(at - 1, 0)]
        go = np.flatnonzero((at > 0) & (h < most))
        while len(go):
            x = _word(words, i[go] + h[go])
            y = _word(words, before[go] + h[go])
            differ = x ^ y
            # Little-endian: the lowest non-zero byte is the first that differs.
            equal = np.where(differ == 0, 8, _low_byte(differ))
            h[go] += equal
            go = go[(equal == 8) & (h[go] < most)]
        h = np.where(at > 0, np.minimum(h, np.minimum(left[i], left[before]) - 1), 0)
        held[:m] = h
        out[at] = np.minimum(h, most)
    return out


def _word(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(words[at]).view("<u8")[:, 0]


def _low_byte(x: np.ndarray) -> np.ndarray:
    """Index of the lowest non-zero byte."""
    low = x & (~x + np.uint64(1))
    return (np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)) // 8).astype(np.int64)


def repeated_starts(bodies: list[bytes]) -> np.ndarray:
    """For the bodies laid side by side with a gap byte after each: which places begin a
    LENGTH-byte string, inside one body, that also begins elsewhere in them."""
    if not bodies:
        return np.zeros(0, bool)
    text = np.frombuffer(b"".join(x + bytes([_GAP]) for x in bodies), np.uint8)
    size = np.fromiter(map(len, bodies), np.int64, len(bodies))
    first = np.r_[0, np.cumsum(size + 1)][:-1]
    left = np.repeat(first + size + 1, size + 1) - np.arange(len(text))
    order = suffix_order(text, left)
    common = common_prefixes(text, left, order, first, size, LENGTH)
    long = common >= LENGTH
    again = np.zeros(len(text), bool)
    again[order] = long | np.r_[long[1:], False]
    return again


def starts_column(piece: np.ndarray, first: np.ndarray, last: np.ndarray, n: int) -> pa.Array:
    """For each of n pieces its intervals of starts, as a list."""
    order = np.argsort(piece, kind="stable")
    ends = np.r_[0, np.cumsum(np.bincount(piece, minlength=n))]
    values = pa.StructArray.from_arrays([pa.array(x[order].astype(np.int64)) for x in (first, last)], ["first", "last"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


_STARTS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def range_cuts(ranges: int) -> np.ndarray:
    """The least fingerprint of each range."""
    return np.array([(r << 64) // ranges for r in range(ranges)], np.uint64)


def _shard(ranges: int):
    return lambda table: _shard_rows(table, ranges)


def _shard_rows(table: pa.Table, ranges: int) -> pa.Table:
    """Repeated starts of each piece, within the shard; of split anchors also the fingerprints
    of what they hold, sorted and cut to ranges."""
    anchor, s1, s2, copies, split = (
        table.column(c).to_numpy() for c in ("anchor", "s1", "s2", "copies", "split")
    )
    bodies = table.column("body").to_pylist()
    count = np.fromiter(map(len, bodies), np.int64, len(bodies)) - LENGTH + 1
    which, members = np.unique(anchor, return_inverse=True, return_counts=True)[1:]
    # The other places of an only piece's strings are its copies: no suffixes to compare.
    alone = (copies > 1) & (members[which] == 1) & ~split
    compared = np.flatnonzero(~alone)
    again = repeated_starts([bodies[i] for i in compared])
    at = np.r_[0, np.cumsum(count[compared] + LENGTH)]
    for i in np.flatnonzero(copies[compared] > 1).tolist():
        again[at[i] : at[i] + count[compared[i]]] = True
    # Intervals end in the piece they begin in, as its last LENGTH - 1 bytes begin no string.
    edges = np.flatnonzero(np.diff(np.r_[False, again, False].view(np.int8)))
    low, high = edges[0::2], edges[1::2] - 1
    owner = np.searchsorted(at, low, "right") - 1
    settled = np.flatnonzero(alone)
    starts = starts_column(
        np.r_[compared[owner], settled],
        np.r_[low - at[owner], np.zeros(len(settled), np.int64)],
        np.r_[high - at[owner], count[settled] - 1],
        len(bodies),
    )
    left = []
    for i in np.flatnonzero(split).tolist():
        prints = rolling(np.frombuffer(bodies[i], np.uint8), LENGTH)
        left.append((prints, np.full(count[i], s1[i]), np.full(count[i], s2[i]), np.arange(count[i])))
    sent: list[tuple] = []
    if left:
        prints, p1, p2, start = (np.concatenate(x) for x in zip(*left))
        order = np.argsort(prints, kind="stable")
        # What the shard has several times is settled here; once is enough for the others.
        order = order[np.r_[True, prints[order[1:]] != prints[order[:-1]]]]
        prints, p1, p2, start = prints[order], p1[order], p2[order], start[order]
        cut = np.searchsorted(prints, range_cuts(ranges))
        for r, (a, b) in enumerate(zip(cut, np.r_[cut[1:], len(prints)])):
            if b > a:
                sent.append((r, *(x[a:b].tobytes() for x in (prints, p1, p2, start))))
    found = pa.table({"s1": s1, "s2": s2, "starts": starts}).filter(pc.greater(pc.list_value_length(starts), 0))
    n, m = len(found), len(sent)
    after = lambda column, kind: pa.concat_arrays([*column.chunks, pa.nulls(m, kind)])
    return pa.table(
        {
            "s1": after(found["s1"], pa.int64()),
            "s2": after(found["s2"], pa.int64()),
            "starts": after(found["starts"], _STARTS),
            "range": pa.array([None] * n + [x[0] for x in sent], pa.int64()),
            **{
                name: pa.array([None] * n + [x[c] for x in sent], pa.binary())
                for c, name in enumerate(("prints", "p1", "p2", "at"), 1)
            },
        }
    )


_SHARD_SCHEMA = """s1 bigint, s2 bigint, starts array<struct<first:bigint,last:bigint>>,
                   `range` bigint, prints binary, p1 binary, p2 binary, at binary"""


def _merge(table: pa.Table) -> pa.Table:
    """Strings of one range that more than one shard sent: each shard's sorted run is looked up
    in the union of all by binary search, and no shard sends a string twice. A string that its
    own shard already found again changes nothing."""
    runs = [
        [np.frombuffer(x, kind) for x in table.column(c).to_pylist()]
        for c, kind in (("prints", np.uint64), ("p1", np.int64), ("p2", np.int64), ("at", np.int64))
    ]
    union = np.sort(np.concatenate(runs[0]))
    found = []
    for prints, s1, s2, start in zip(*runs):
        hit = np.searchsorted(union, prints, "right") - np.searchsorted(union, prints, "left") > 1
        found.append((s1[hit], s2[hit], start[hit]))
    s1, s2, start = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((start, s2, s1))
    s1, s2, start = s1[order], s2[order], start[order]
    new = np.r_[True, (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])][: len(s1)]
    # Neighbouring starts of one piece are one interval.
    head = np.flatnonzero(new | np.r_[True, start[1:] != start[:-1] + 1][: len(s1)])
    last = start[np.r_[head[1:], len(s1)] - 1] if len(head) else head
    pieces = np.flatnonzero(new)
    owner = np.searchsorted(pieces, head, "right") - 1
    return pa.table(
        {"s1": s1[pieces], "s2": s2[pieces], "starts": starts_column(owner, start[head], last, len(pieces))}
    )


# --- texts ------------------------------------------------------------------------------


def covered(text: bytes, starts: list[dict]) -> tuple[int, int, bytes]:
    """Bytes removed, number of maximal removed runs, and the rest of the text."""
    edge = np.zeros(len(text) + 1, np.int64)
    if starts:
        np.add.at(edge, [s["first"] for s in starts], 1)
        np.add.at(edge, [s["last"] + LENGTH for s in starts], -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(np.count_nonzero(np.diff(np.r_[False, gone].view(np.int8)) == 1))
    return int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [covered(t, s or []) for t, s in zip(text_bytes(batch.column("text")), batch.column("starts").to_pylist())]
            # A cut inside a character leaves bytes that are no text; those are shown as U+FFFD.
            kept = [f[2].decode("utf-8", "replace") if with_text else None for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k1"), batch.column("k2"),
                    pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                    pa.array([hashlib.sha256(f[2]).hexdigest() for f in found], pa.string()), pa.array(kept, pa.string()),
                ],
                ["k1", "k2", "n_removed", "n_spans", "kept_sha256", "kept_text"],
            )

    return run


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept_text for each row of docs.

    Null counts as empty; texts of fewer than LENGTH bytes lose nothing. Rows that repeat, or
    share an id, count as separate occurrences and each get a row; other columns are not read.
    kept_text is null unless asked for, and for texts that lose nothing.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    store = Store(spark, "suffix")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]
    own = docs.select(*keys, text.alias("text")).filter(F.octet_length("text") >= LENGTH)

    anchors = store.keep(own.mapInArrow(_anchors, "k1 bigint, k2 bigint, anchor bigint, place bigint"), "anchors")
    live = _live(store, anchors).groupBy(*KEY).agg(F.collect_set("place").alias("places"))
    texts = store.keep(
        own.groupBy(*KEY).agg(F.first("text").alias("text"), F.count("*").alias("copies")).join(live, KEY), "texts"
    )
    pieces = store.keep(
        texts.mapInArrow(
            _pieces,
            "anchor bigint, s1 bigint, s2 bigint, k1 bigint, k2 bigint, first bigint, copies bigint, body binary",
        ),
        "pieces",
    )
    distinct = store.keep(
        pieces.groupBy("anchor", "s1", "s2").agg(F.max("body").alias("body"), F.sum("copies").alias("copies")), "distinct"
    )
    starts = _repeated_pieces(store, distinct)
    spans = (
        pieces.select("s1", "s2", *KEY, F.col("first").alias("low")).join(starts, ["s1", "s2"])
        .groupBy(*KEY)
        .agg(
            F.flatten(
                F.collect_list(
                    F.transform(
                        "starts", lambda s: F.struct((s["first"] + F.col("low")).alias("first"), (s["last"] + F.col("low")).alias("last"))
                    )
                )
            ).alias("starts")
        )
    )
    cut = texts.select(*KEY, "text").join(spans, KEY).mapInArrow(
        _cut(with_text), "k1 bigint, k2 bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"
    )
    plain = docs.select(
        F.col(id_col).alias("doc_id"), F.octet_length(text).cast("bigint").alias("n_bytes"), *keys, F.sha2(text, 256).alias("_whole")
    )
    none = F.lit(0).cast("bigint")
    return plain.join(store.keep(cut, "cut"), KEY, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "_whole").alias("kept_sha256"), "kept_text",
    )


def _live(store: Store, anchors: DataFrame) -> DataFrame:
    """Rows of anchors that occur again. An anchor with more than a quarter of a shuffle
    partition's share of all rows is known by its count, so its rows are not shuffled; there
    are at most four of them for each shuffle partition."""
    spark = store.spark
    again = store.keep(anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1"), "again")
    total = again.agg(F.sum("n")).first()[0] or 0
    share = max(1, total // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    hot = F.broadcast(again.filter(F.col("n") > share).select("anchor"))
    rest = anchors.join(hot, "anchor", "left_anti").join(again.filter(F.col("n") <= share), "anchor", "left_semi")
    return anchors.join(hot, "anchor", "left_semi").unionByName(rest)


def _repeated_pieces(store: Store, distinct: DataFrame) -> DataFrame:
    """(s1, s2, starts): where repeated strings begin in each distinct piece that has some."""
    size = F.octet_length("body") + 1
    per_anchor = distinct.groupBy("anchor").agg(F.sum(size).alias("bytes"))
    total = per_anchor.agg(F.sum("bytes")).first()[0] or 0
    shards = int(total // SHARD_BYTES) + 1
    hot = per_anchor.filter(F.col("bytes") > SHARD_BYTES).select(
        "anchor", F.ceil(F.col("bytes") / (SHARD_BYTES // 2)).alias("salts")
    )
    dealt = distinct.join(hot, "anchor", "left").select(
        "anchor", "s1", "s2", "body", "copies", F.col("salts").isNotNull().alias("split"),
        # Split anchors have shards of their own, numbered below zero.
        F.when(F.col("salts").isNull(), F.pmod(F.xxhash64("anchor"), F.lit(shards)))
        .otherwise(-1 - F.pmod(F.xxhash64("anchor", F.pmod(F.col("s1"), F.col("salts"))), F.lit(1 << 40))).alias("shard"),
    )
    split_bytes = hot.join(per_anchor, "anchor").agg(F.sum("bytes")).first()[0] or 0
    shard = _shard(int(split_bytes // RANGE_STARTS) + 1)
    found = store.keep(dealt.groupBy("shard").applyInArrow(shard, _SHARD_SCHEMA), "shards")
    merged = (
        found.filter("`range` is not null").groupBy("range")
        .applyInArrow(_merge, "s1 bigint, s2 bigint, starts array<struct<first:bigint,last:bigint>>")
    )
    each = found.filter("s1 is not null").select("s1", "s2", "starts")
    return each.unionByName(merged)
