"""One day of a mart, from the export table to the warehouse table and its quality summary."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.plans import hits, products, quality, sessions, shared_day, visits
from hitloom.session import shared_folder
from hitloom.sources import exports, marts


@dataclass(frozen=True)
class Mart:
    """How a mart is scanned, built and identified; ``folder`` is its place below the target."""

    folder: str
    scan: Callable[[SparkSession, str, date | None], DataFrame]
    build: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]


MARTS = {
    "ga4_hits": Mart(
        "hits_ga4",
        exports.ga4_events,
        lambda events: hits.target_layout(hits.hits(events)),
        ("visitId", "hitNumber"),
    ),
    "ga4_visits": Mart("visits_ga4", exports.ga4_events, visits.visits_attributed, ("visitId", "engagement_time")),
    "ga4_products": Mart("products_ga4", exports.ga4_events, products.products, ("visitId", "hitNumber")),
    "ga4_promos": Mart("promos_ga4", exports.ga4_events, products.promotions, ("visitId", "hitNumber")),
    "ua_hits": Mart("hits", exports.ua_sessions, sessions.hits, ("visitId", "fullVisitorId", "hitNumber")),
    "ua_visits": Mart("visits", exports.ua_sessions, sessions.visits, ("visitId", "fullVisitorId")),
    "ua_promotions": Mart("promotions", exports.ua_sessions, sessions.promotions, ("visitId", "fullVisitorId")),
}


def build_day(spark: SparkSession, name: str, source: str, day: date | None = None) -> DataFrame:
    """The named mart over one day of the export at ``source``; yesterday unless told otherwise."""
    mart = MARTS[name]
    return mart.build(mart.scan(spark, source, day or exports.yesterday()))


def _replace(spark: SparkSession, name: str, rows: DataFrame, target: str, day: date) -> DataFrame:
    path = f"{target}/{MARTS[name].folder}"
    marts.write_mart(rows, path, day)
    written = marts.read_mart(spark, path, rows.schema).where(F.col(marts.LOAD_DAY) == F.lit(day))
    return quality.summary(written, MARTS[name].keys)


def load_day(spark: SparkSession, name: str, source: str, target: str, day: date | None = None) -> DataFrame:
    """Build one day, replace it in the Parquet mart below ``target`` and summarise what was written."""
    day = day or exports.yesterday()
    return _replace(spark, name, build_day(spark, name, source, day), target, day)


def backfill(
    spark: SparkSession, name: str, source: str, target: str, days: Sequence[date], at_once: int = 16
) -> DataFrame:
    """Build several days and replace them in the Parquet mart below ``target``; their rows by day.

    Each day is built by itself, as a single run does, so visits do not run on over midnight.  Up to
    ``at_once`` days are written by one job, which keeps the cluster busy where days are small.
    """
    mart = MARTS[name]
    path, days = f"{target}/{mart.folder}", sorted(set(days))
    for at in range(0, len(days), at_once):
        some = days[at : at + at_once]
        parts = [build_day(spark, name, source, day).withColumn(marts.LOAD_DAY, F.lit(day)) for day in some]
        marts.write_days(reduce(DataFrame.unionByName, parts), path, some)
    schema = build_day(spark, name, source, days[0]).schema if days else T.StructType()
    written = marts.read_mart(spark, path, schema).where(F.col(marts.LOAD_DAY).isin(*days))
    return written.groupBy(marts.LOAD_DAY).agg(F.count("*").alias("row_count"))


def build_ga4_day(spark: SparkSession, source: str, day: date | None = None) -> dict[str, DataFrame]:
    """All event-based marts of one day: hits, products and promotions share one table of numbered hits.

    That table is written to the session's shared folder when this is called, so that the marts read
    files that every executor sees instead of numbering the hits again.
    """
    events = exports.ga4_events(spark, source, day or exports.yesterday())
    path = f"{shared_folder(spark)}/numbered-hits-{uuid.uuid4().hex}"
    numbered = shared_day.numbered_hits(events)
    numbered.write.parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)
    return {
        "ga4_hits": hits.target_layout(shared_day.hits(numbered)),
        "ga4_visits": MARTS["ga4_visits"].build(events),
        "ga4_products": shared_day.products(numbered),
        "ga4_promos": shared_day.promotions(numbered),
    }


def load_ga4_day(spark: SparkSession, source: str, target: str, day: date | None = None) -> dict[str, DataFrame]:
    """Build all event-based marts of one day together and replace it in each; returns their summaries."""
    day = day or exports.yesterday()
    return {name: _replace(spark, name, mart, target, day) for name, mart in build_ga4_day(spark, source, day).items()}


def export_day(
    spark: SparkSession,
    name: str,
    source: str,
    target: str,
    day: date | None = None,
    rows_per_file: int = 0,
    bytes_per_file: int = 0,
) -> str:
    """Build one day and write it as gzip CSV to the mart's own folder; returns that folder."""
    path = f"{target}/{MARTS[name].folder}"
    marts.export_csv(build_day(spark, name, source, day), path, rows_per_file, bytes_per_file)
    return path


def load_exported_day(
    spark: SparkSession, name: str, files: str, schema: T.StructType, target: str, quarantine: str, day: date
) -> DataFrame:
    """Load a day's exported CSV files into the mart below ``target``, going on past bad rows.

    Rows that do not fit ``schema`` go, as text with their file, record and reason, to the mart's folder
    below ``quarantine``; both replace what the day had before.  Returns the summary of what was written.
    """
    good, rejected = marts.load_csv(spark, files, schema)
    rejected.write.mode("overwrite").parquet(f"{quarantine}/{MARTS[name].folder}/{marts.LOAD_DAY}={day}")
    return _replace(spark, name, good, target, day)
