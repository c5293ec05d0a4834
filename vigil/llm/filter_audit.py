"""How quality filters interact: what each removes at each step of every order of applying them.

Each document becomes a mask of the filters it fails, and documents are counted per part and
mask, so that all that follows works on at most 32 cells a part. A recursive query then
extends prefixes of filter orders by the letters not yet used, carries the bits already
applied, and says for each mask cell at each level whether the step removes it, keeps it or
finds it gone. The number of its rows is fixed by the number of filters, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vigil.llm.stores import Store

LETTERS = "ABCDE"  # of the filters; the bit of the k-th is 2**k
COPY = 1 << LETTERS.index("E")
LEAST_WORDS = 100
LEAST_DISTINCT = 80  # percent of the words
MOST_CAPITALS = 10  # percent of the code points
SYMBOLS = "[#$%&*|]"

_METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(text: Column) -> Column:
    """Bits of the filters that look at a text alone: too short (A), too few distinct words
    (B), too many capitals (C), symbols (D)."""
    words = F.array_remove(F.split(text, r"[ \t-\r]+"), "")

    def judged(w: Column) -> Column:
        fails = [
            F.size(w) < LEAST_WORDS,
            100 * F.size(F.array_distinct(w)).cast("bigint") < LEAST_DISTINCT * F.size(w).cast("bigint"),
            100 * F.regexp_count(text, F.lit("[A-Z]")).cast("bigint") > MOST_CAPITALS * F.length(text).cast("bigint"),
            text.rlike(SYMBOLS),
        ]
        return sum(f.cast("int") * (1 << k) for k, f in enumerate(fails))

    # The words are made once, as the element of a one-element array.
    return F.transform(F.array(words), judged)[0]


def mask_cells(docs: DataFrame, labels: DataFrame, store: Store) -> DataFrame:
    """part, mask, n, good, toxic: documents, and those labelled good and toxic, per lang and
    mask of failed filters.

    A null text is empty, a null lang the part ''. A document fails E if a row with a smaller
    id has the same text; rows without an id fail it never and make no other row fail it, and
    have no labels. Repeated label rows count once; any of them decides. Columns beside those
    named here are not read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = store.keep(
        docs.select(
            "doc_id", F.coalesce("lang", F.lit("")).alias("part"), text_mask(text).alias("mask"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        ),
        "masks",
    )
    flags = labels.groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    cell = ["part", "mask", "good", "toxic"]
    # Equal texts are counted per id, then per cell, before any one task sees a text's rows:
    # of a text that a third of all rows hold, one row per lang and label is left.
    each = (
        rows.filter("doc_id is not null").join(flags, "doc_id", "left")
        .fillna(False, ["good", "toxic"])
        .groupBy("doc_id", "digest", *cell).agg(F.count("*").alias("n"))
        .groupBy("digest", *cell).agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("low"))
        .withColumn("first", F.min("low.doc_id").over(Window.partitionBy("digest")))
    )
    passed = F.when(F.col("low.doc_id") == F.col("first"), F.col("low.n")).otherwise(0)
    split = F.array(
        F.struct(F.col("mask"), passed.alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(COPY)).alias("mask"), (F.col("n") - passed).alias("n")),
    )
    named = each.select("part", "good", "toxic", F.inline(split)).filter("n > 0")
    nameless = rows.filter("doc_id is null").groupBy("part", "mask").agg(F.count("*").alias("n")).select(
        "part", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "mask", "n"
    )
    return store.keep(
        named.union(nameless).groupBy("part", "mask").agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        ),
        "cells",
    )


# Each level of the recursion adds one unused letter to every prefix, for every mask cell.
_WALK = """
with recursive walk(prefix, step, bit, before, mask) as (
    select cast('' as string), 0, 0, 0, mask from {masks}
    union all
    select concat(prefix, letter), step + 1, next, before | bit, mask
    from walk lateral view inline(filter({letters}, f -> ((before | bit) & f.next) = 0)) as letter, next
)
select prefix, step, right(prefix, 1) as letter, mask,
       (mask & (before | bit)) = 0 as stays,
       (mask & bit) <> 0 and (mask & before) = 0 as goes,
       (mask & bit) <> 0 and (mask & before) <> 0 as gone,
       mask = bit as alone
from walk where step > 0
"""


def walk(spark: SparkSession, masks: DataFrame) -> DataFrame:
    """prefix, step, letter, mask and what the step does to documents of that mask, for every
    beginning of every order: 325 rows a mask, 32 masks at most."""
    letters = ", ".join(f"named_struct('letter', '{x}', 'next', {1 << k})" for k, x in enumerate(LETTERS))
    return spark.sql(_WALK.replace("{letters}", f"array({letters})"), masks=masks)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost
    and shapley, for every part, order and step, zeros included; no rows for no documents.

    What nulls and repeats give is said at `mask_cells`.
    """
    spark = docs.sparkSession
    store = Store(spark, "filters")
    cells = mask_cells(docs, labels, store)
    # At most 10,400 rows, whatever the tables hold.
    levels = store.keep(walk(spark, cells.select("mask").distinct()), "levels")
    count = {
        "kept": ("stays", "n"), "removed": ("goes", "n"), "redundant": ("gone", "n"), "unique_fails": ("alone", "n"),
        "good_lost": ("goes", "good"), "toxic_lost": ("goes", "toxic"),
    }
    sums = [F.sum(F.when(F.col(flag), F.col(n)).otherwise(0)).alias(name) for name, (flag, n) in count.items()]
    prefixes = cells.join(F.broadcast(levels), "mask").groupBy("part", "prefix", "step", "letter").agg(*sums)
    orders = (
        levels.filter(F.col("step") == len(LETTERS)).select(F.col("prefix").alias("filter_order")).distinct()
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
        .withColumn("prefix", F.expr("substring(filter_order, 1, step)")).drop("step")
    )
    share = Window.partitionBy("part", "letter")  # 120 rows: one for each order
    return prefixes.join(F.broadcast(orders), "prefix").select(
        "part", "filter_order", "step", *_METRICS, F.sum("removed").over(share).alias("shapley")
    )
