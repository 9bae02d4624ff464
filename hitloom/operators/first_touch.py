"""Attributes a visit takes over from one of its events.

Each choice is the minimum of a struct that starts with the ordering columns and ends with the
values wanted.  A minimum combines on the map side, so even a visit that holds a large share of all
events arrives at its reducer as one row per map task; a window would send and sort all of them.

Texts in an aggregate make Spark sort the events before it combines them.  The structs are therefore made
in a step before the aggregation, so that they are all it sorts, not the bags they were looked up in.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = ("event_timestamp", "event_name")


def _candidate(order: Sequence[Column], values: Mapping[str, Column]) -> Column:
    ranks = [column.alias(f"order_{i}") for i, column in enumerate(order)]
    return F.struct(*ranks, *[value.alias(name) for name, value in values.items()])


def first_row(events: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Values of the visit's earliest event; ties go by event name, then by the values in order."""
    candidates = events.select("visitId", _candidate([F.col(c) for c in ORDER], values).alias("candidate"))
    picked = candidates.groupBy("visitId").agg(F.min("candidate").alias("first"))
    return picked.select("visitId", *[F.col("first")[name].alias(name) for name in values])


class TouchGroup:
    """Attributes taken together from the earliest event on which all ``required`` ones and the time are known.

    Visits without any such event take the earliest event, with whatever it knows.
    """

    def __init__(self, required: Sequence[Column], values: Mapping[str, Column]):
        self.required = list(required)
        self.values = dict(values)

    def candidate(self) -> Column:
        """What the event offers; the lowest of a visit is taken."""
        unknown = F.col(ORDER[0]).isNull()
        for column in self.required:
            unknown = unknown | column.isNull()
        return _candidate([unknown, *[F.col(c) for c in ORDER]], self.values)


def first_touch(events: DataFrame, groups: Mapping[str, TouchGroup], *extra: Column) -> DataFrame:
    """One row per visit with the values of all groups and the ``extra`` aggregates."""
    candidates = events.withColumns({f"touch_{name}": group.candidate() for name, group in groups.items()})
    picked = candidates.groupBy("visitId").agg(
        *[F.min(f"touch_{name}").alias(f"touch_{name}") for name in groups], *extra
    )
    values = [
        F.col(f"touch_{name}")[value].alias(value) for name, group in groups.items() for value in group.values
    ]
    kept = [c for c in picked.columns if c != "visitId" and not c.startswith("touch_")]
    return picked.select("visitId", *values, *kept)
