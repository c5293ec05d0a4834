"""A training corpus from raw documents, stage by stage.

Each stage takes what the one before kept, and its result is stored and read again, so a lost
executor costs part of one stage only.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm import decontaminate, minhash, nbest, pii, toxicity
from vigil.llm.stores import Store, quoted, spare
from vigil.session import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that a model of the labelled ones calls toxic (score 0.5 or more)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = toxicity.scorer(spark, toxicity.fit(docs, labels), located=False)
    return docs.filter(score("text")["score"] < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id.

    Rows are told apart by id and text, so null, shared and repeated ids do no harm.
    """
    return minhash.without_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a phrase of a benchmark item.

    Rows are told apart by a hash of id and text, so null and repeated ids do no harm.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    key = spare(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = decontaminate.contamination(keyed, items, id_col=key)
    # Stored, its size is known: a short list is broadcast, so that no text is shuffled or sorted for it.
    dirty = Store(spark, "contaminated").keep(found.filter("contaminated").select(F.col("doc_id").alias(key)), "keys")
    return keyed.join(dirty, key, "left_anti").select(quoted(docs.columns))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind and n_chars as it then is."""
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the scores of the n best segmentations, with the ids of the best
    and what each other one changes of them (`nbest.n_best_ids` makes those out of it)."""
    encode = nbest.encoder(spark, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)
    return docs.select("doc_id", "lang", "source", encode("text").alias("r")).select("doc_id", "lang", "source", "r.*")


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal data", mask_personal_data),
    ("sentencepiece", encode_pieces),
]

# SQL can express neither the fitted model nor the segmentation; tests hold the stages
# against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{root}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
