"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations make all coordinates of a signature: the first scatters shingles over a
universe of fixed size, the second, shifted circularly by k places, gives coordinate k. The
K values that one shingle contributes therefore lie side by side in the second permutation
and are read in one go.

Documents with equal shingle sets form one class, and only a representative of each goes
on. Candidates come from equal bands. Within a bucket no pairs are spelled out: all members
are verified against one leader, links merge them into components, and a bucket goes on
only while it still holds members of different components: those outside its largest
component lead next, some at a time. So a bucket ends with every pair either verified or
already in one component, without a cap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vigil.llm.bytetext import NOT_SPACE, Words, bounded_batches, chunks, ngram_hashes, text_bytes
from vigil.llm.resident import resident
from vigil.llm.stores import Store, least_label, quoted, spare

SHINGLE = 5
PERCENT = 75  # of the union that two sets must share
UNIVERSE = 1 << 20
BANDS, ROWS = 32, 4  # at the threshold a pair shares no band once in 200,000 times
BLOCK_SHINGLES = 100_000  # about how many shingles of members are verified against as many others at once


def permutations() -> list[np.ndarray]:
    """The first permutation, and windows of K places over the second one, seen as a circle."""

    def make() -> list[np.ndarray]:
        rng = np.random.Generator(np.random.PCG64(7))
        k = BANDS * ROWS
        second = rng.permutation(UNIVERSE).astype(np.uint32)
        circle = np.concatenate([second, second[: k - 1]])
        return [rng.permutation(UNIVERSE).astype(np.int64), np.lib.stride_tricks.sliding_window_view(circle, k)]

    return resident("minhash", "permutations", make)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; a text of fewer words has one, of them all."""
    words = Words([t.lower() for t in texts], NOT_SPACE)
    grams = ngram_hashes(words.hashes, SHINGLE)
    out = []
    for first, n in zip(words.first.tolist(), words.counts.tolist()):
        if n >= SHINGLE:
            out.append(np.unique(grams[first : first + n - SHINGLE + 1]))
        elif n:
            out.append(ngram_hashes(words.hashes[first : first + n], n))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """K minima over the shingles, coordinate k under the second permutation shifted by k."""
    first, windows = permutations()
    places = np.unique(first[(shingles & np.uint64(UNIVERSE - 1)).astype(np.int64)])
    low = np.full(windows.shape[1], UNIVERSE, np.uint32)
    for i in range(0, len(places), 4096):
        np.minimum(low, windows[places[i : i + 4096]].min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        h = ngram_hashes(np.stack([h, rows[:, r]], 1).ravel(), 2)[0::2]
    return h.view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_bytes(batch.column("text"))
        for a, b in chunks(texts):
            sizes, digests, bands = [], [], []
            for s in shingle_sets(texts[a:b]):
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(band_keys(signature(s)).tolist() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, b - a),
                    batch.column("text_key").slice(a, b - a),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "n_shingles", "digest", "bands"],
            )


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full shingle sets share enough of their union."""
    for batch in batches:
        a, b = text_bytes(batch.column("text_a")), text_bytes(batch.column("text_b"))
        for i, j in chunks([x + y for x, y in zip(a, b)]):
            # A leader's text comes again and again; its set is made once.
            distinct = list(dict.fromkeys(a[i:j]))
            sets = dict(zip(distinct, shingle_sets(distinct)))
            hit = []
            for x, y in zip(a[i:j], shingle_sets(b[i:j])):
                shared = len(np.intersect1d(sets[x], y, assume_unique=True))
                hit.append(100 * shared >= PERCENT * (len(sets[x]) + len(y) - shared))
            yield batch.slice(i, j - i).select(["a", "b"]).filter(pa.array(hit, pa.bool_()))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row for each row of docs.

    Null and empty texts and texts without words have no shingles and are linked with
    nothing. Rows without an id are linked with nothing either: their component is null and
    they are kept. Rows that share an id are judged each by its own text. Other columns are
    not read. Equal texts are one class; the smallest id stays, and of its texts one. Rows that
    repeat both id and text are all kept if one is; `without_copies` leaves one of them.
    """
    grouped = _grouped(docs, id_col, text_col, nameless=False)
    return grouped.select(
        "doc_id", "n_shingles", F.coalesce("lead.doc_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("row") == F.col("lead.row"), F.lit(True)).alias("kept"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with exactly one row of each group of near duplicates, that with the smallest id.

    Rows without an id are members too, and stay only if no other member has one. Rows are
    told apart by id and text; of rows that share both, any one stays. Rows whose texts have no
    words are in no group and all stay.
    """
    store = Store(docs.sparkSession, "copies")
    rows = store.keep(_grouped(docs, id_col, text_col, nameless=True).filter("lead is not null"), "rows")
    number = store.keep(
        rows.groupBy("row").agg(F.first(F.col("row") == F.col("lead.row")).alias("stays"), F.count("*").alias("n"))
        .filter("not stays or n > 1"),
        "marked",
    )
    key = spare(docs, "row")
    keyed = docs.withColumn(key, _row_key(F.col(id_col), F.xxhash64(text_col)))
    rest = keyed.join(number.select(F.col("row").alias(key)), key, "left_anti")
    once = keyed.join(number.filter("stays").select(F.col("row").alias(key)), key, "left_semi").dropDuplicates([key])
    return rest.unionByName(once).select(quoted(docs.columns))


def _row_key(doc_id: Column, text_key: Column) -> Column:
    doc_id = doc_id.cast("bigint")
    return F.xxhash64(doc_id, doc_id.isNull(), text_key)


def _grouped(docs: DataFrame, id_col: str, text_col: str, nameless: bool) -> DataFrame:
    """doc_id, row (a hash of id and text), n_shingles and lead, the (doc_id, row) that stands for the row's group;
    lead is null for rows in no group, as are those without an id unless `nameless`.

    Groups are found over classes of equal shingle sets, whose key is a hash of the set, so
    that ids may be shared or missing.
    """
    spark = docs.sparkSession
    store = Store(spark, "minhash")
    bounded_batches(spark)
    own = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("text_key"),
    )
    signed = store.keep(
        own.mapInArrow(
            _signatures,
            "doc_id bigint, text_key bigint, n_shingles bigint, digest binary, bands array<bigint>",
        ),
        "signatures",
    ).withColumn("row", _row_key(F.col("doc_id"), F.col("text_key")))
    if not nameless:
        signed = signed.withColumn("digest", F.when(F.col("doc_id").isNotNull(), F.col("digest")))
    # One representative for all documents with the same set; its bands stand for theirs.
    classes = store.keep(
        signed.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "row", "n_shingles", "bands")).alias("r"))
        .select("digest", F.xxhash64("digest").alias("id"), "r.*"),
        "classes",
    )
    member = classes.select(F.explode("bands").alias("band"), "id", F.col("n_shingles").alias("n"))
    crowded = member.groupBy("band").agg(F.count("*").alias("c")).filter("c > 1").select("band")
    buckets = store.keep(member.join(crowded, "band"), "buckets-0")
    wanted = classes.join(buckets.select("id").distinct(), "id", "left_semi").select("id", "row")
    texts = store.keep(
        own.withColumn("row", _row_key(F.col("doc_id"), F.col("text_key"))).join(wanted, "row")
        .groupBy("id").agg(F.first("text").alias("text")),
        "texts",
    )
    components = _components(store, buckets, texts)
    placed = store.keep(
        classes.join(components, F.col("id") == F.col("node"), "left").select(
            "digest", F.coalesce("component", "id").alias("part"), F.struct("none", "doc_id", "text_key", "row").alias("own")
        ),
        "placed",
    )
    leads = placed.groupBy("part").agg(F.min("own").alias("own")).select("part", F.struct("own.doc_id", "own.row").alias("lead"))
    return (
        signed.select("doc_id", "row", "n_shingles", "digest")
        .join(placed.select("digest", "part").join(leads, "part").select("digest", "lead"), "digest", "left")
        .select("doc_id", "row", "n_shingles", "lead")
    )


def _block_links(table: pa.Table) -> pa.Table:
    """Links of a block between its leaders and members of other parts."""
    sets = shingle_sets(text_bytes(table.column("text")))
    ids, parts = table.column("id").to_numpy(), table.column("part").to_numpy()
    lead = table.column("lead").to_numpy(zero_copy_only=False)
    others = np.flatnonzero(~lead)
    sizes = np.array([len(s) for s in sets])
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.r_[0, np.cumsum(sizes)]
    every = np.concatenate([number[starts[i] : starts[i + 1]] for i in others]) if len(others) else number[:0]
    first = np.r_[0, np.cumsum(sizes[others])][:-1]
    held = np.zeros(number.max(initial=-1) + 1, np.int64)
    # Links between members that earlier ones connect are left out, so there are fewer links than members.
    links, part = [], np.unique(parts, return_inverse=True)[1]
    for i in np.flatnonzero(lead).tolist():
        if not len(others):
            break
        mine = number[starts[i] : starts[i + 1]]
        held[mine] = 1
        shared = np.add.reduceat(held[every], first)
        held[mine] = 0
        union = sizes[i] + sizes[others] - shared
        hit = others[(100 * shared >= PERCENT * union) & (part[others] != part[i])]
        joined, one = np.unique(part[hit], return_index=True)
        links.extend((min(ids[i], ids[j]), max(ids[i], ids[j])) for j in hit[one])
        part[np.isin(part, joined)] = part[i]
    links = sorted(set(links))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _components(store: Store, buckets: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, component) of all representatives linked with another one."""
    lead = buckets.groupBy("band").agg(F.min(F.struct("id", "n")).alias("lead"))
    # Sets of too different sizes cannot share enough.
    pairs = store.keep(
        buckets.join(lead, "band").filter(F.col("id") != F.col("lead.id"))
        .filter(100 * F.least("n", "lead.n") >= PERCENT * F.greatest("n", "lead.n"))
        .select(F.col("lead.id").alias("a"), F.col("id").alias("b")).distinct(),
        "pairs",
    )
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    # The member's text first: a leader's text then meets its many members in a join whose hot
    # keys Spark splits, and is never shuffled once for each of them.
    store.keep(
        pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a bigint, b bigint"),
        "links-1",
    )
    turn = 1
    while True:
        links = store.read([f"links-{t}" for t in range(1, turn + 1)])
        components = least_label(links, store, f"parts-{turn}")
        turn += 1
        placed = store.keep(
            buckets.join(components, F.col("id") == F.col("node"), "left")
            .select("band", "id", "n", F.coalesce("component", "id").alias("part")),
            f"placed-{turn}",
        )
        # The largest part of a bucket needs no look inside it. Members of the other parts lead
        # in turn: about BLOCK_SHINGLES of them are held against all others, in blocks of that
        # size too. So no task holds more than two blocks, whatever the size of a bucket.
        size = placed.groupBy("band", "part").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
        main = size.groupBy("band").agg(
            F.max(F.struct("c", "part", "s")).alias("m"), F.sum("s").alias("all"), F.count("*").alias("parts")
        )
        groups = main.filter("parts > 1").select(
            "band", F.col("m.part").alias("main"),
            F.ceil(F.col("all") / BLOCK_SHINGLES).alias("blocks"), F.ceil((F.col("all") - F.col("m.s")) / BLOCK_SHINGLES).alias("turns"),
        )
        open_ = store.keep(placed.join(groups, "band"), f"open-{turn}")
        if open_.isEmpty():
            return components
        leads = (F.col("part") != F.col("main")) & (F.pmod(F.xxhash64("id", F.lit(turn)), F.col("turns")) == 0)
        rows = open_.select(
            "band", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "id", "part", F.lit(False).alias("lead")
        ).union(
            open_.filter(leads).select(
                "band", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), "id", "part", F.lit(True)
            )
        )
        store.keep(
            rows.join(texts, "id").groupBy("band", "block").applyInArrow(_block_links, "a bigint, b bigint"), f"links-{turn}"
        )
        # Leaders are settled in this bucket from now on.
        buckets = store.keep(open_.filter(~leads).select("band", "id", "n"), f"buckets-{turn}")
