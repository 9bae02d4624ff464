"""Quality of texts by supervised subword embeddings.

Words, pairs of neighbouring words and character n-grams are hashed to ``buckets`` learned vectors;
a text is the mean of its vectors, and a softmax over two outputs gives the quality.  The vectors and
outputs are trained by stochastic gradient descent in numpy on a bounded sample of labelled rows.

Once trained, the mean of vectors followed by a linear output equals the mean of one number per
bucket, so scoring looks up one number per n-gram.

Defined cases: missing and empty texts have no vectors and get the output's bias alone; a missing
label is not learned from; repeated rows are scored alike; very long texts are read whole; without
labelled rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm import hashing
from hitloom.llm.workspace import ship_code

BUCKET_BITS = 18
SIZES = range(3, 6)
_SAME = np.uint64(0x5AEE5AEE5AEE5AEE)


@dataclass(frozen=True)
class TrainingSettings:
    rows_per_label: int = 1000
    dimensions: int = 8
    epochs: int = 5
    rate: float = 4.0
    seed: int = 17


def bucket_runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Parts of the features of a run of texts: the row and the bucket of each."""
    text, starts_of = hashing.separated(data, offsets, lower=False)
    shift = np.uint64(64 - BUCKET_BITS)
    starts, ends = hashing.word_spans(text)
    words = hashing.word_hashes(text, starts, ends)
    row = np.searchsorted(starts_of, starts, "right") - 1
    yield row, (words >> shift).astype(np.int64)
    beside = row[1:] == row[:-1]
    left, right = words[:-1][beside], words[1:][beside]
    # A word beside itself is one feature whatever the word is.
    pairs = np.where(left == right, _SAME, hashing.mix(left * np.uint64(3) + right))
    yield row[1:][beside], (pairs >> shift).astype(np.int64)
    for _, at, hashes in hashing.char_ngrams(text, SIZES):
        # The blank between two texts may open the second's n-grams or close the first's.
        own = np.searchsorted(starts_of, at + 1, "right") - 1
        yield np.minimum(own, len(offsets) - 2), (hashes >> shift).astype(np.int64)


def sparse_rows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text: its buckets, ascending, and the part of its features in each."""
    for first, end, data, offsets in hashing.slices(column, 2 << 20):
        keys = np.concatenate([row << BUCKET_BITS | bucket for row, bucket in bucket_runs(data, offsets)])
        keys, counts = np.unique(keys, return_counts=True)
        cuts = np.searchsorted(keys, np.arange(end - first + 1, dtype=np.int64) << BUCKET_BITS)
        for a, b in zip(cuts, cuts[1:]):
            yield (keys[a:b] & ((1 << BUCKET_BITS) - 1)).astype(np.int32), (counts[a:b] / max(1, counts[a:b].sum())).astype(np.float32)


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows_per_label: int) -> DataFrame:
    """Labelled documents, at most ``rows_per_label`` of each label, chosen by the hash of their id."""
    parts = [
        labels.where(F.col(label) == value)
        .select("doc_id", F.lit(value).alias("label"))
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows_per_label)
        for value in (0, 1)
    ]
    # Two bounded lists of ids.
    return docs.select("doc_id", "text").join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id")


def train(sample: DataFrame, settings: TrainingSettings) -> tuple[np.ndarray, float]:
    """One number per bucket and a bias: the log-odds of label 1 are the mean of a text's numbers plus the bias."""
    ship_code(sample.sparkSession)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(sparse_rows(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[1] for r in rows], pa.list_(pa.float32())),
                ],
                names=["doc_id", "label", "buckets", "parts"],
            )

    schema = "doc_id long, label int, buckets array<int>, parts array<float>"
    rows = sample.select("doc_id", "label", "text").mapInArrow(features, schema).toArrow().sort_by("doc_id")
    labels = rows.column("label").to_numpy()
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-0.5, 0.5, (1 << BUCKET_BITS, settings.dimensions)) / settings.dimensions
    outputs, bias = np.zeros((2, settings.dimensions)), np.zeros(2)
    texts = [
        (np.asarray(b.values), np.asarray(p.values).astype(np.float64))
        for b, p in zip(rows.column("buckets"), rows.column("parts"))
    ]
    steps, done = max(1, settings.epochs * len(texts)), 0
    for _ in range(settings.epochs):
        for i in random.permutation(len(texts)):
            rate = settings.rate * (1 - done / steps)
            done += 1
            buckets, parts = texts[i]
            mean = parts @ vectors[buckets] if len(buckets) else np.zeros(settings.dimensions)
            scores = outputs @ mean + bias
            error = np.exp(scores - scores.max())
            error /= error.sum()
            error[labels[i]] -= 1
            back = error @ outputs
            outputs -= rate * np.outer(error, mean)
            bias -= 0.02 * rate * error
            if len(buckets):
                vectors[buckets] -= rate * np.outer(parts, back)
    return (vectors @ (outputs[1] - outputs[0])).astype(np.float32), float(bias[1] - bias[0])


def score(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """doc_id and score of every row."""
    spark = docs.sparkSession
    ship_code(spark)
    model = spark.sparkContext.broadcast((weights, bias))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = model.value
        for batch in batches:
            total, count = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for first, end, data, offsets in hashing.slices(batch.column(1), 4 << 20):
                for row, bucket in bucket_runs(data, offsets):
                    total[first:end] += np.bincount(row, weights[bucket], end - first)
                    count[first:end] += np.bincount(row, minlength=end - first)
            odds = total / np.maximum(count, 1) + bias
            scores = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(apply, "doc_id long, score double")


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def quality_scores(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, settings: TrainingSettings = TrainingSettings()
) -> DataFrame:
    """Every document's score, learned from the rows that are not held out."""
    learn = labels.where(~held_out())
    weights, bias = train(training_sample(docs, learn, "quality", settings.rows_per_label), settings)
    return score(docs, weights, bias).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
