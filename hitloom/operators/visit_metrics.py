"""Counts, flags and durations per visit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.functions import flags
from hitloom.functions.lookups import user_text
from hitloom.operators.hit_numbers import is_complete


def visit_metrics(events: DataFrame, logged_in: tuple[str, ...] = flags.LOGGED_IN) -> DataFrame:
    """One row per visit: duration, distinct hits, page and screen views, and flags as 0/1.

    The events are first reduced to distinct (visit, time, name), which turns every distinct count
    into a plain one: both steps combine before they shuffle, and no row is multiplied as it would
    be by several distinct counts in one aggregation.
    """
    name = F.col("event_name")
    login = flags.as_bit(flags.is_logged_in(user_text("login_status"), logged_in))
    distinct = events.groupBy("visitId", "event_timestamp", "event_name").agg(F.max(login).alias("logged_in"))

    def views(wanted: str):
        return F.count(F.when(is_complete() & (name == wanted), 1))

    return distinct.groupBy("visitId").agg(
        flags.seconds(F.max("event_timestamp") - F.min("event_timestamp")).alias("duration"),
        F.count(F.when(is_complete(), 1)).alias("hits"),
        F.max(flags.as_bit(flags.is_first_event(name))).alias("new_visit"),
        views("page_view").alias("pageviews"),
        views("screen_view").alias("screenviews"),
        F.max("logged_in").alias("logged_in"),
        F.max(flags.as_bit(flags.is_interaction(name))).alias("active"),
    )
