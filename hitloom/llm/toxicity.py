"""Toxicity by a classifier chain.

The categories are predicted one after the other by linear models over the presence of words and
character n-grams; each later model also reads the earlier categories' probabilities.  While a later
model is trained, those come from models that did not see the row (out-of-fold predictions).

The features are the n-grams that tell a category best on a bounded, stratified sample of labelled
rows.  Presence in the whole text counts, not frequency, so the length of a text does not matter.

Defined cases: missing and empty texts have no features and get the models' base rates; a missing label
is not learned from; repeated rows are scored alike; very long texts are read whole; without labelled
rows, or with one class only, a category's probability is its base rate or 0; extra columns are kept, but for those
named like a probability, which are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.llm import hashing
from hitloom.llm.workspace import Workspace, ship_code

SIZES = range(4, 7)
_FILTER_BITS = 20
#: Bytes of text whose n-grams are held at once; they take some sixty times as much memory.
_SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class Category:
    """A name and the condition on the label table that marks it."""

    name: str
    marked: Column


def default_chain() -> list[Category]:
    """The categories the label table knows, the broader one first."""
    return [Category("low_quality", F.col("quality") == 0), Category("toxic", F.col("toxic") == 1)]


@dataclass(frozen=True)
class ChainSettings:
    rows_per_stratum: int = 1500
    features_per_category: int = 512
    least_documents: int = 5
    folds: int = 5
    steps: int = 200
    penalty: float = 1e-4


@dataclass
class Chain:
    """The selected features' hashes, ascending, and per category weights over them, inputs and bias."""

    names: list[str]
    hashes: np.ndarray
    weights: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self):
        self.known = np.zeros(1 << _FILTER_BITS, bool)
        self.known[(self.hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def _maybe(self, values: np.ndarray) -> np.ndarray:
        return self.known[(values >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]

    def present(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Per run of texts: its first and end row, and the pairs of row and feature that occur."""
        for first, end, data, offsets in hashing.slices(column, _SLICE_BYTES):
            keys = [np.empty(0, np.int64)]
            for row, values in feature_runs(data, offsets, self._maybe):
                place = np.minimum(np.searchsorted(self.hashes, values), max(0, len(self.hashes) - 1))
                hit = self.hashes[place] == values if len(self.hashes) else np.zeros(len(values), bool)
                keys.append(row[hit] * len(self.hashes) + place[hit])
            found = np.unique(np.concatenate(keys))
            yield first, end, found // max(1, len(self.hashes)), found % max(1, len(self.hashes))

    def probabilities(self, column: pa.Array) -> np.ndarray:
        out = np.zeros((len(self.names), len(column)))
        n = len(self.hashes)
        for first, end, row, feature in self.present(column):
            for k, w in enumerate(self.weights):
                score = np.bincount(row, w[feature], end - first) + out[:k, first:end].T @ w[n : n + k] + w[-1]
                out[k, first:end] = sigmoid(score)
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def feature_runs(
    data: np.ndarray, offsets: np.ndarray, wanted: Callable[[np.ndarray], np.ndarray] | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and hashes of the words and character n-grams of lower-cased texts; only ``wanted`` hashes, if given."""
    text, starts_of = hashing.separated(data, offsets, lower=True)
    starts, ends = hashing.word_spans(text)
    hashes = hashing.word_hashes(text, starts, ends)
    if wanted is not None:
        kept = np.flatnonzero(wanted(hashes))
        starts, hashes = starts[kept], hashes[kept]
    yield np.searchsorted(starts_of, starts, "right") - 1, hashes
    for _, at, hashes in hashing.char_ngrams(text, SIZES):
        if wanted is not None:
            kept = np.flatnonzero(wanted(hashes))
            at, hashes = at[kept], hashes[kept]
        own = np.searchsorted(starts_of, at + 1, "right") - 1
        yield np.minimum(own, len(offsets) - 2), hashes


def fit_linear(x: np.ndarray, y: np.ndarray, settings: ChainSettings) -> np.ndarray:
    """Weights and a last bias of a logistic model, by gradient steps with adaptive rates."""
    w, first, second = np.zeros(x.shape[1] + 1), 0.0, 0.0
    share = y.mean() if len(y) else 0.0
    rate = np.log((share + 1e-3) / (1 - share + 1e-3))
    w[-1] = rate
    if not len(y) or y.min() == y.max():
        return w
    for step in range(1, settings.steps + 1):
        error = sigmoid(x @ w[:-1] + w[-1]) - y
        slope = np.append(x.T @ error / len(y) + settings.penalty * w[:-1], error.mean())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def fit_chain(x: np.ndarray, y: np.ndarray, settings: ChainSettings) -> list[np.ndarray]:
    """One model per column of ``y``; later ones read out-of-fold probabilities of the earlier."""
    fold = np.arange(len(x)) % settings.folds
    inputs, models = x, []
    for k in range(y.shape[1]):
        models.append(fit_linear(inputs, y[:, k], settings))
        if k + 1 < y.shape[1]:
            unseen = np.zeros(len(x))
            for f in range(settings.folds):
                w = fit_linear(inputs[fold != f], y[fold != f, k], settings)
                unseen[fold == f] = sigmoid(inputs[fold == f] @ w[:-1] + w[-1])
            inputs = np.column_stack([inputs, unseen])
    return models


def _sample(docs: DataFrame, labels: DataFrame, categories: Sequence[Category], rows: int) -> DataFrame:
    """At most ``rows`` documents per combination of categories, chosen by the hash of their id."""
    flags = labels.select("doc_id", *[c.marked.cast("int").alias(f"y{k}") for k, c in enumerate(categories)])
    names = [f"y{k}" for k in range(len(categories))]
    flags = flags.dropna().dropDuplicates(["doc_id"])
    parts = [
        flags.where(reduce(lambda a, b: a & b, [F.col(n) == (combination >> k & 1) for k, n in enumerate(names)]))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
        for combination in range(1 << len(names))
    ]
    # A bounded list of ids.
    chosen = reduce(DataFrame.unionByName, parts)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[Category] | None = None,
    settings: ChainSettings = ChainSettings(),
) -> Chain:
    categories = list(categories or default_chain())
    work = Workspace(docs.sparkSession, "toxicity")
    flags = [f"y{k}" for k in range(len(categories))]
    sample = work.keep(_sample(docs, labels, categories, settings.rows_per_stratum), "sample")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in hashing.slices(batch.column("text"), 1 << 20):
                runs = list(feature_runs(data, offsets))
                row, values = (np.concatenate(x) for x in zip(*runs))
                order = np.lexsort((values, row))
                row, values = row[order], values[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (values[1:] != values[:-1])
                row, values = row[new], values[new].view(np.int64)
                columns = [batch.column(flag).slice(first, end - first).take(pa.array(row)) for flag in flags]
                yield pa.RecordBatch.from_arrays([pa.array(values), *columns], names=["feature", *flags])

    schema = ", ".join(["feature long", *[f"{flag} int" for flag in flags]])
    counted = work.keep(
        sample.mapInArrow(features, schema)
        .groupBy("feature")
        .agg(F.count("*").alias("n"), *[F.sum(flag).alias(flag) for flag in flags])
        .where(F.col("n") >= settings.least_documents),
        "features",
    )
    totals = sample.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in flags]).first()
    best = []
    for flag in flags:
        inside, outside = totals[flag] or 1, (totals["n"] - totals[flag]) or 1
        difference = F.abs(F.col(flag) / inside - (F.col("n") - F.col(flag)) / outside)
        spread = F.sqrt(F.col("n") / totals["n"] * (1 - F.col("n") / (totals["n"] + 1)) * (1 / inside + 1 / outside))
        best.append(counted.orderBy((difference / spread).desc(), "feature").limit(settings.features_per_category))
    selected = reduce(DataFrame.unionByName, best).select("feature").distinct().toArrow() if totals["n"] else None
    hashes = np.sort(selected.column(0).to_numpy().view(np.uint64)) if selected is not None else np.empty(0, np.uint64)
    chain = Chain([c.name for c in categories], hashes)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: list[np.ndarray] = []
            for first, end, row, feature in chain.present(batch.column("text")):
                cuts = np.searchsorted(row, np.arange(1, end - first))
                lists += np.split(feature, cuts)
            kept = [batch.column(name) for name in ("doc_id", *flags)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", *flags, "present"])

    schema = ", ".join(["doc_id long", *[f"{flag} int" for flag in flags], "present array<long>"])
    # The sample is bounded, and so is what comes back of each row.
    rows = sample.select("doc_id", "text", *flags).mapInArrow(vectors, schema).toArrow().sort_by("doc_id")
    x = np.zeros((rows.num_rows, len(hashes)))
    for i, present in enumerate(rows.column("present")):
        x[i, np.asarray(present.values)] = 1
    # Rows come in the order of their ids; a shuffle makes the folds alike.
    order = np.random.default_rng(11).permutation(rows.num_rows)
    y = np.column_stack([rows.column(flag).to_numpy() for flag in flags]).astype(float)
    chain.weights = fit_chain(x[order], y[order], settings)
    return chain


def with_probabilities(docs: DataFrame, chain: Chain, text: str = "text", prefix: str = "p_") -> DataFrame:
    """All rows and columns, and a column ``<prefix><category>`` per category, which replaces one of that name."""
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(chain)
    added = [f"{prefix}{name}" for name in chain.names]
    docs = docs.drop(*[name for name in added if name != text])
    at = docs.columns.index(text)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = shared.value.probabilities(batch.column(at))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(row) for row in p]], names=[*batch.schema.names, *added]
            )

    schema = T.StructType([*docs.schema.fields, *[T.StructField(name, T.DoubleType()) for name in added]])
    return docs.mapInArrow(apply, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows that the last category of the default chain does not mark, with all their columns."""
    chain = train(docs.select("doc_id", "text"), labels)
    prefix = f"p_{uuid.uuid4().hex}_"
    scored = with_probabilities(docs, chain, prefix=prefix)
    return scored.where(F.col(f"{prefix}{chain.names[-1]}") < threshold).select(docs.columns)
