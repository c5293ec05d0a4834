"""Toxicity by multiple-instance learning: sentences are judged, documents are labelled.

A sentence's probability is logistic in the words and word beginnings it holds. A document is
toxic if any of its sentences is: the noisy-or 1 - prod(1 - p). Training maximises the
likelihood of the document labels under that noisy-or, so what it learns are sentence
scores, and the sentences that make a document toxic can be pointed out. In training, every
document has a leak besides its sentences: one chance, the same for all and not part of any
score, that the label is toxic for no reason that a sentence shows. Without it such labels
raise the bias of every sentence, and a clean text comes out toxic if it is long enough.

The features are chosen by Spark from the training documents; the weights are fitted from
what those features leave of a sample (at most MOST_PER_CLASS documents of each label, by the
hash of the id, whatever their length). Up to DRIVER_HITS the fit runs on the driver; beyond
that every step is a Spark job over the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vigil.llm.bytetext import ALNUM, Words, bounded_batches, chunks, text_bytes
from vigil.llm.stores import Store

MOST_PER_CLASS = 4000
DRIVER_HITS = 4_000_000  # features of sentences that the driver fits on by itself
BUCKETS = 1 << 20
BEGINNINGS = (4, 5)  # bytes of a word that are features beside the word itself
FEATURES = 1024
LEAST_DOCUMENTS = 3
STEPS, RATE, SHRINK = 400, 0.1, 0.1
# Clean sentences weigh more in the fit, and logits are steepened after it, which moves no
# sentence over 0.5: long clean texts have many sentences, each with a small chance.
CLEAN_WEIGHT, SLOPE = 10.0, 2.0
SENTENCE_END = np.isin(np.arange(256), np.frombuffer(b".!?\n", np.uint8))


class Sentences:
    """Feature buckets of the words of each sentence of some texts."""

    def __init__(self, texts: list[bytes]):
        words = self.words = Words([t.lower() for t in texts], ALNUM)
        ends = np.flatnonzero(SENTENCE_END[words.buffer.bytes])
        # A sentence lies between two ends; those without a word do not count.
        place = np.searchsorted(ends, words.starts)
        new = np.r_[True, place[1:] != place[:-1]][: len(place)]
        self.first_word = np.flatnonzero(new)
        self.of_word = np.cumsum(new) - 1
        self.n = len(self.first_word)
        self.text_of = words.text_of_word()[self.first_word]
        self.starts = ends[place[self.first_word] - 1] + 1
        self.ends = ends[place[self.first_word]]
        kinds = [words.hashes]
        for size in BEGINNINGS:
            part = words.buffer.span_hashes(words.starts, np.minimum(words.starts + size, words.ends))
            kinds.append(part + np.uint64(size))
        shift = np.uint64(64 - BUCKETS.bit_length() + 1)
        self.buckets = [(k * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64) for k in kinds]

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        """One for each sentence: every feature counts once for each word that has it."""
        if not self.n:
            return np.empty(0)
        each = sum(weights[b] for b in self.buckets)
        return np.add.reduceat(each, self.first_word) + bias


@dataclass
class Model:
    features: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(BUCKETS)
        out[self.features] = self.weights
        return out


# --- training ---------------------------------------------------------------------------


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, toxic): the sample that a model is fitted on. Texts of any length are in it."""
    own = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("toxic"))
    own = own.filter("id is not null and toxic in (0, 1)").distinct()
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("id"), "id"))
    chosen = own.withColumn("rank", rank).filter(F.col("rank") <= MOST_PER_CLASS).select("id", "toxic")
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    # At most 2 * MOST_PER_CLASS rows of two numbers: small enough for every task.
    return texts.join(F.broadcast(chosen), "id").select("text", "toxic")


def _tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold a bucket, summed over what the task reads."""
    seen = np.zeros((2, BUCKETS), np.int32)
    for batch in batches:
        texts, toxic = text_bytes(batch.column("text")), batch.column("toxic").to_pylist()
        for a, b in chunks(texts):
            s = Sentences(texts[a:b])
            owner = s.text_of[s.of_word] if s.n else np.empty(0, np.int64)
            held = np.unique(np.concatenate([owner * BUCKETS + k for k in s.buckets]))
            np.add.at(seen, (np.asarray(toxic[a:b])[held // BUCKETS], held % BUCKETS), 1)
    used = np.flatnonzero(seen.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used), pa.array(seen[0, used].astype(np.int64)), pa.array(seen[1, used].astype(np.int64))],
        ["bucket", "clean", "toxic"],
    )


def _bags(features: np.ndarray):
    """Per document: its label, its sentences, and of each chosen feature which sentence has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = np.full(BUCKETS, -1, np.int64)
        slot[features] = np.arange(len(features))
        for batch in batches:
            texts, toxic = text_bytes(batch.column("text")), batch.column("toxic")
            for a, b in chunks(texts):
                s = Sentences(texts[a:b])
                first = np.searchsorted(s.text_of, np.arange(b - a))
                found = [np.empty((3, 0), np.int64)]
                for k in s.buckets:
                    hit = np.flatnonzero(slot[k] >= 0)
                    sentence = s.of_word[hit]
                    doc = s.text_of[sentence] if s.n else sentence
                    found.append(np.stack([doc, sentence - first[doc], slot[k[hit]]]))
                doc, sentence, feature = np.concatenate(found, axis=1)
                order = np.argsort(doc, kind="stable")
                ends = pa.array(np.r_[0, np.cumsum(np.bincount(doc, minlength=b - a))], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        toxic.slice(a, b - a),
                        pa.array(np.bincount(s.text_of, minlength=b - a), pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(sentence[order])),
                        pa.ListArray.from_arrays(ends, pa.array(feature[order])),
                    ],
                    ["toxic", "n_sentences", "sentence", "feature"],
                )

    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from all documents that have a label. Without both labels, it calls nothing toxic."""
    spark = docs.sparkSession
    bounded_batches(spark)
    store = Store(spark, "toxicity")
    sample = store.keep(training_sample(docs, labels, id_col, text_col, label_col), "sample")
    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not (n.get(0) and n.get(1)):
        return Model(np.empty(0, np.int64), np.empty(0), -20.0)
    sums = sample.mapInArrow(_tallies, "bucket bigint, clean bigint, toxic bigint").groupBy("bucket").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    # How far a bucket's share among toxic documents is from that among clean ones, in
    # standard deviations.
    p, q = F.col("toxic") / n[1], F.col("clean") / n[0]
    both = (F.col("toxic") + F.col("clean")) / (n[0] + n[1])
    spread = F.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1]) + 1e-9)
    best = (
        sums.filter(F.col("toxic") + F.col("clean") >= LEAST_DOCUMENTS)
        .select("bucket", (F.abs(p - q) / spread).alias("z"))
        .orderBy(F.desc("z"), "bucket").limit(FEATURES)
    )
    features = np.sort(np.array([r.bucket for r in best.collect()], np.int64))
    bags = store.keep(
        sample.mapInArrow(
            _bags(features), "toxic int, n_sentences bigint, sentence array<bigint>, feature array<bigint>"
        ),
        "bags",
    )
    hits = bags.agg(F.sum(F.size("feature"))).first()[0] or 0
    gradient = Bags(bags.toArrow()).gradient if hits <= DRIVER_HITS else _spark_gradient(bags)
    weights, bias = noisy_or_fit(gradient, n[0] + n[1], len(features))
    return Model(features, weights, bias)


class Bags:
    """Documents as labels, sentences and the chosen features of these.

    Sentences without any chosen feature all have the bias for a logit and are counted, not
    listed.
    """

    def __init__(self, table: pa.Table | pa.RecordBatch):
        def flat(name: str) -> pa.Array:
            column = table.column(name)
            return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column

        self.toxic = flat("toxic").to_numpy(zero_copy_only=False).astype(bool)
        n_sentences = flat("n_sentences").to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(self.toxic)), flat("sentence").value_lengths().to_numpy(zero_copy_only=False))
        number = (np.cumsum(n_sentences) - n_sentences)[doc] + flat("sentence").flatten().to_numpy(zero_copy_only=False)
        used, first, self.sentence = np.unique(number, return_index=True, return_inverse=True)
        self.owner = doc[first]
        self.feature = flat("feature").flatten().to_numpy(zero_copy_only=False)
        self.plain = n_sentences - np.bincount(self.owner, minlength=len(self.toxic))

    def gradient(self, w: np.ndarray) -> np.ndarray:
        """Of -log likelihood, by the weights, the leak's logit and the bias.

        With z a sentence's logit and Q the chance that no sentence of the document is toxic,
        the gradient by z is p (times CLEAN_WEIGHT, but for the leak) for clean documents and
        -p Q / (1 - Q) for toxic ones.
        """
        grad = np.zeros_like(w)
        if not len(self.toxic):
            return grad
        z = np.bincount(self.sentence, w[self.feature], minlength=len(self.owner)) + w[-1]
        log_q = -np.bincount(self.owner, np.logaddexp(0, z), minlength=len(self.toxic)) - self.plain * np.logaddexp(0, w[-1])
        log_q -= np.logaddexp(0, w[-2])
        q = np.exp(np.minimum(log_q, -1e-9))
        pull = np.where(self.toxic, -q / (1 - q), CLEAN_WEIGHT)
        g = pull[self.owner] * np.exp(-np.logaddexp(0, -z))
        grad[:-2] = np.bincount(self.feature, g[self.sentence], minlength=len(w) - 2)
        grad[-2] = np.where(self.toxic, pull, 1.0).sum() / (1 + np.exp(-w[-2]))
        grad[-1] = g.sum() + (pull * self.plain).sum() / (1 + np.exp(-w[-1]))
        return grad


def _spark_gradient(bags: DataFrame):
    """Bags.gradient summed over the rows of a table, by one job."""

    def gradient(w: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = sum((Bags(batch).gradient(w) for batch in batches), np.zeros_like(w))
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["g"])

        return np.sum([r.g for r in bags.mapInArrow(run, "g array<double>").collect()], axis=0)

    return gradient


def noisy_or_fit(gradient: Callable[[np.ndarray], np.ndarray], n_docs: int, n_features: int) -> tuple[np.ndarray, float]:
    """Weights and bias that make the document labels likeliest under the noisy-or."""
    w, first, second = np.zeros((3, n_features + 2))
    w[-2:] = -4.0, -6.0
    for step in range(1, STEPS + 1):
        grad = gradient(w) / n_docs
        grad[:-2] += SHRINK / n_docs * w[:-2]
        first += 0.1 * (grad - first)
        second += 0.01 * (grad**2 - second)
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return SLOPE * w[:-2], SLOPE * float(w[-1])


# --- scoring ----------------------------------------------------------------------------


def scorer(spark: SparkSession, model: Model, located: bool = True):
    """Column of texts to struct(score, sentences): the noisy-or of the sentences' chances and,
    if `located`, those at 0.5 or more as struct(start, end, score), in code points, end exclusive.

    Null, empty and wordless texts have no sentence and a score of 0.
    """
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def score(column: pa.Array) -> pa.Array:
        dense, texts = sent.value.dense(), text_bytes(column)
        scores, found = [], []
        for a, b in chunks(texts):
            s = Sentences(texts[a:b])
            z = s.logits(dense, sent.value.bias)
            log_q = np.bincount(s.text_of, -np.logaddexp(0, z), minlength=b - a)
            scores.append(-np.expm1(log_q))
            rows: list[list] = [[] for _ in range(b - a)]
            if located:
                at = s.words.buffer.text_at
                for i in np.flatnonzero(z >= 0).tolist():
                    d = s.text_of[i]
                    text, low, high = texts[a + d], int(s.starts[i] - at[d]), int(s.ends[i] - at[d])
                    start = len(text[:low].decode())
                    rows[d].append(
                        {"start": start, "end": start + len(text[low:high].decode()), "score": float(np.exp(-np.logaddexp(0, -z[i])))}
                    )
            found.extend(rows)
        kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(scores) if scores else [], pa.float64()), pa.array(found, pa.list_(kind))],
            ["score", "sentences"],
        )

    return F.arrow_udf(
        score, "struct<score:double,sentences:array<struct<start:bigint,end:bigint,score:double>>>"
    )


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted (1 at 0.5 or more) and the offending sentences of each row."""
    score = scorer(docs.sparkSession, model)
    return (
        docs.select(F.col(id_col).alias("doc_id"), score(F.col(text_col)).alias("r"))
        .select("doc_id", "r.score", (F.col("r.score") >= 0.5).cast("int").alias("predicted"), "r.sentences")
    )


def fold(id_col: str = "doc_id", folds: int = 5):
    """Remainder of an id's crc32: rows of remainder 0 are held out from training."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))
