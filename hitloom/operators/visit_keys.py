"""Visitor, visit and event keys, and the events that have them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.functions.lookups import event_long

HIT_KEY = "hit_key"


def visit_id(session_id: Column | None = None) -> Column:
    """Visitor and session number in one text; NULL if either is missing."""
    return F.concat(F.col("user_pseudo_id"), event_long("ga_session_id") if session_id is None else session_id)


def event_id(session_id: Column | None = None) -> Column:
    """Identity of a distinct event: visit, name and time; NULL if any is missing."""
    return F.concat(visit_id(session_id), F.col("event_name"), F.col("event_timestamp"))


def with_visits(events: DataFrame) -> DataFrame:
    """Add ``fullVisitorId`` and ``visitId`` and keep the events that have both.

    The visitor test comes first and on the bare column, so it reaches the Parquet scan.
    """
    return (
        events.where(F.col("user_pseudo_id").isNotNull())
        .withColumns({"fullVisitorId": F.col("user_pseudo_id"), "visitId": visit_id()})
        .where(F.col("visitId").isNotNull())
    )


def hit_key(complete_only: bool = False) -> Column:
    """Time and name of the event: what tells the hits of one visit apart.

    A struct compares NULL fields as equal, so events without a name still find their visit.
    With ``complete_only`` such events get a NULL key instead, which matches nothing.
    """
    key = F.struct("event_timestamp", "event_name")
    if complete_only:
        return F.when(F.col("event_timestamp").isNotNull() & F.col("event_name").isNotNull(), key)
    return key
