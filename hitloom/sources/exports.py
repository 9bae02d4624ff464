"""Scans of the nested exports: Parquet tables partitioned by day."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.schemas import GA4_EVENTS, UA_SESSIONS


def yesterday() -> date:
    return date.today() - timedelta(days=1)


def _scan(spark: SparkSession, path: str, schema: T.StructType, column: str, day: date | None) -> DataFrame:
    table = spark.read.schema(schema).parquet(path)
    return table if day is None else table.where(F.col(column) == day.strftime("%Y%m%d"))


def ga4_events(spark: SparkSession, path: str, day: date | None = None) -> DataFrame:
    """Events of one day (a single partition), or of all days."""
    return _scan(spark, path, GA4_EVENTS, "event_date", day)


def ua_sessions(spark: SparkSession, path: str, day: date | None = None) -> DataFrame:
    """Sessions of one day (a single partition), or of all days."""
    return _scan(spark, path, UA_SESSIONS, "date", day)
