"""How far the sources of a language differ in their terms: chi-square divergence, in whole numbers.

A term that a source lacks has one share there, whatever the term; so the divergence of two sources over
all kept terms is that of two absent terms, times the number of terms, with corrections for terms that
one or both have.  Corrections for one come from each source's few distinct counts.  Corrections for both
come from a frequent-pattern tree: a term is the row of its nonzero counts, sources in a fixed order
(most terms first); equal rows are one with a multiplicity; rows that begin alike share nodes.  Each
node adds the corrections with all its ancestors once, weighted by the terms below it, not once per term.

Rows are sorted and dealt out by ranges of (language, row), so a task inserts its rows in order and needs
only the current path: a node that a row leaves is complete.  A path of many terms is one row, and a long
common beginning may be cut anywhere between tasks: the parts of a node add up.  Tasks add up their
corrections per pair of sources before the shuffle.

Defined cases: null text, lang and source are ''; repeated rows count each; texts of any length are
read whole; a table without rows gives none, a language without kept terms has pairs of divergence 0 and
no terms; ties have the smaller item first, by its UTF-8 bytes; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm.workspace import Workspace, ship_code

UNIT = 1_000_000_000
#: Distinct terms that a task counts before it hands them on.
TERMS_AT_ONCE = 400_000
#: Corrections that a task collects before it adds them up.
CORRECTIONS_AT_ONCE = 2_000_000

#: Bytes that belong to terms (ASCII letters, lower-cased, and all of other characters); others are blanks.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

COUNTED = "lang string, source string, term string, n long, docs long"


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences and documents of each term per task, language and source: to be added up."""
    ship_code(docs.sparkSession)

    def rows(found: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, documents) in found.items():
            terms = pa.array(list(n), pa.binary()).cast(pa.string())
            columns = [
                pa.array([lang] * len(n), pa.string()),
                pa.array([source] * len(n), pa.string()),
                terms,
                pa.array(list(n.values()), pa.int64()),
                pa.array([documents[term] for term in n], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            for lang, source, text in zip(*(column.to_pylist() for column in batch.columns)):
                terms = text.translate(_TERM_BYTES).split()
                n, documents = found.setdefault((lang, source), (Counter(), Counter()))
                n.update(terms)
                documents.update(set(terms))
            if sum(len(n) for n, _ in found.values()) > TERMS_AT_ONCE:
                yield from rows(found)
                found = {}
        yield from rows(found)

    return docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(count, COUNTED)


def share(n: Column, total: Column) -> Column:
    """A term's smoothed share, from 1; in decimals, as counts times the unit may exceed a long."""
    scaled = (n + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.when(total > 0, 1 + F.call_function("div", scaled, total.cast("decimal(20,0)")))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class _PairSums:
    """Corrections per ordered pair of sources of one language, added up when there are many."""

    def __init__(self):
        self._keys: list[np.ndarray] = []
        self._values: list[np.ndarray] = []
        self._size = 0

    def add(self, first: np.ndarray, second: np.ndarray, values: np.ndarray) -> None:
        self._keys.append(first << 32 | second)
        self._values.append(values)
        self._size += len(values)
        if self._size > CORRECTIONS_AT_ONCE:
            self._combine()

    def _combine(self) -> None:
        keys = np.concatenate(self._keys)
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], np.concatenate(self._values)[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        self._keys, self._values = [keys[starts]], [np.add.reduceat(values, starts)]
        self._size = len(starts)

    def full(self) -> bool:
        return 2 * self._size > CORRECTIONS_AT_ONCE

    def rows(self, lang: str) -> Iterator[pa.RecordBatch]:
        if not self._keys:
            return
        self._combine()
        keys, values = self._keys[0], self._values[0]
        columns = [pa.array([lang] * len(keys), pa.string()), keys >> 32, keys & 0xFFFFFFFF, values]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lang", "first", "second", "value"])
        self.__init__()


class _Path:
    """The path of a frequent-pattern tree that the last row went, with the terms at or below each node.

    Row entries are a source's place, its share of the term, and its share of an absent term.
    """

    def __init__(self, sums: _PairSums):
        self._sums = sums
        self._nodes = np.empty((0, 3), np.int64)
        self._terms = np.empty(0, np.int64)

    def insert(self, nodes: np.ndarray, terms: int) -> None:
        shorter = min(len(nodes), len(self._nodes))
        differ = np.flatnonzero((nodes[:shorter] != self._nodes[:shorter]).any(axis=1))
        self.leave(int(differ[0]) if len(differ) else shorter)
        self._nodes = nodes
        self._terms = np.r_[self._terms, np.zeros(len(nodes) - len(self._terms), np.int64)]
        self._terms[-1] += terms

    def leave(self, depth: int) -> None:
        """Complete all nodes from ``depth`` on: correct them with their ancestors, and tell their parents."""
        nodes, terms = self._nodes, self._terms
        if depth == len(nodes):
            return
        below = np.cumsum(terms[depth:][::-1])[::-1]
        if depth:
            terms[depth - 1] += below[0]
        lower = np.arange(depth, len(nodes))
        node, ancestor = np.nonzero(np.arange(len(nodes)) < lower[:, None])
        weight, node = below[node], lower[node]
        (a, p, p0), (b, q, q0) = nodes[ancestor].T, nodes[node].T
        for one, x, x0, other, y, y0 in ((a, p, p0, b, q, q0), (b, q, q0, a, p, p0)):
            both = _divergence(x, y) - _divergence(x, y0) - _divergence(x0, y) + _divergence(x0, y0)
            self._sums.add(one, other, weight * both)
        self._nodes, self._terms = nodes[:depth], terms[:depth]


def pair_corrections(rows: DataFrame) -> DataFrame:
    """Per ordered pair of sources, the corrections of the terms that both have: lang, first, second, value.

    Rows have ``lang``, ``row`` (an array of structs place, p, p0 in order of place) and ``terms``.
    """
    ship_code(rows.sparkSession)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, sums = None, _PairSums()
        path = _Path(sums)
        for batch in batches:
            lists = batch.column(1)
            ends = lists.offsets.to_numpy()
            entries = lists.values
            entries = np.stack([entries.field(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            each = zip(batch.column(0).to_pylist(), ends, ends[1:], batch.column(2).to_pylist())
            for own, start, end, terms in each:
                if own != lang or sums.full():
                    path.leave(0)
                    yield from sums.rows(lang)
                    lang = own
                path.insert(entries[start:end].astype(np.int64), terms)
        path.leave(0)
        yield from sums.rows(lang)

    ordered = rows.select("lang", "row", "terms").repartitionByRange("lang", "row").sortWithinPartitions("lang", "row")
    found = ordered.mapInArrow(grow, "lang string, first long, second long, value long")
    return found.groupBy("lang", "first", "second").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """Per language and source: the other sources by divergence from them, and the terms that stand out.

    Columns read: ``lang``, ``source``, ``text``.  Terms in fewer than ``least_docs`` documents of a
    language are left out; a source lists its ``top`` terms.
    """
    work = Workspace(docs.sparkSession, "source-divergence")
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = term_counts(plain).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("row")
    )
    terms = work.keep(terms.where(F.col("docs") >= least_docs).drop("docs"), "terms")
    entries = terms.select("lang", "term", "lang_n", F.inline("row"))

    # One row per language and source: sources with many terms come first in the rows of the tree.
    own = entries.groupBy("lang", "source").agg(F.sum("n").alias("source_n"), F.count("*").alias("held"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("all_n"))
    sources = plain.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    sources = sources.fillna(0, ["source_n", "held", "v", "all_n"])
    total = F.col("source_n") + F.col("v")
    by_terms = Window.partitionBy("lang").orderBy(F.desc("held"), "source")
    sources = sources.select(
        "*",
        total.alias("total"),
        share(F.lit(0), total).alias("p0"),
        F.row_number().over(by_terms).cast("long").alias("place"),
    )
    sources = work.keep(sources, "sources")

    known = sources.select("lang", "source", "total", "p0", "place", (F.col("all_n") + F.col("v")).alias("lang_total"))
    shares = entries.join(known, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        "place",
        "p0",
        share(F.col("n"), F.col("total")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total")).alias("q"),
    )
    shares = work.keep(shares, "shares")

    rows = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("place", "p", "p0"))).alias("row"))
    rows = rows.where(F.size("row") > 1).groupBy("lang", "row").agg(F.count("*").alias("terms"))
    both = work.keep(pair_corrections(work.keep(rows, "rows")), "corrections")

    pairs = _pairs(sources, shares, both)
    standing = shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value")
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(best).cast("int").alias("rank")
    return pairs.select("*", ranked).unionByName(standing.select("*", ranked).where(F.col("rank") <= top))


def _pairs(sources: DataFrame, shares: DataFrame, both: DataFrame) -> DataFrame:
    """The divergence of each source from each other one of its language; as many rows as the result has."""
    repeated = shares.groupBy("lang", "place", "p").agg(F.count("*").alias("m"))
    repeated = repeated.groupBy("lang", "place").agg(F.collect_list(F.struct("p", "m")).alias("shares"))
    sides = sources.join(repeated, ["lang", "place"], "left").select("lang", "source", "place", "p0", "v", "shares")
    first = sides.select("lang", "source", F.col("place").alias("first"), "p0", "v", "shares")
    second = sides.select(
        "lang",
        F.col("source").alias("item"),
        F.col("place").alias("second"),
        F.col("p0").alias("q0"),
        F.col("shares").alias("other_shares"),
    )
    pairs = first.join(second, "lang").where("first != second").join(both, ["lang", "first", "second"], "left")
    p0, q0 = F.col("p0"), F.col("q0")
    absent = divergence(p0, q0)

    def corrected(shares: str, with_share) -> Column:
        none = F.array().cast("array<struct<p:bigint,m:bigint>>")
        return F.aggregate(
            F.coalesce(shares, none),
            F.lit(0).cast("long"),
            lambda total, x: total + x["m"] * (with_share(x["p"]) - absent),
        )

    value = (
        F.col("v") * absent
        + corrected("shares", lambda p: divergence(p, q0))
        + corrected("other_shares", lambda q: divergence(p0, q))
        + F.coalesce("value", F.lit(0).cast("long"))
    )
    return pairs.select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.when(F.col("v") > 0, value).otherwise(0).cast("long").alias("value")
    )
