"""Hit numbers: the rank of each distinct event within its visit by time, then name.

A window over the visit would put the whole visit into one task, and a single automated visitor can
hold a large share of all traffic, even within minutes.  Visits are therefore cut into time slices of
two levels: events are ranked within their second, the seconds' counts are summed up within five
minutes, those within the visit, and the three are added.  No task sees more than one second of a
visit, or one row per slice of the level below.  Repeated deliveries of an event are collapsed before
the first shuffle.  Only the narrow event key travels through all of this; wide rows are shuffled
once, when they look up their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.operators.visit_keys import HIT_KEY, hit_key

SECOND_MICROS = 1_000_000
SLICE_MICROS = 300_000_000
BEFORE_ALL_SLICES = -(2**63)


def distinct_events(events: DataFrame, **lowest: Column) -> DataFrame:
    """One row per distinct (visit, time, name), with the lowest value of each extra expression."""
    return events.groupBy("visitId", "event_timestamp", "event_name").agg(
        F.count(F.lit(1)).alias("copies"), *[F.min(value).alias(name) for name, value in lowest.items()]
    )


def is_complete() -> Column:
    """Whether the event has everything its identity consists of."""
    return F.col("event_timestamp").isNotNull() & F.col("event_name").isNotNull()


def hit_table(
    events: DataFrame, slice_micros: int = SLICE_MICROS, second_micros: int = SECOND_MICROS, **visit_lowest: Column
) -> DataFrame:
    """Number the distinct events of every visit.

    Columns: ``visitId``, ``event_timestamp``, ``event_name``, ``hitNumber`` (NULL for events whose
    identity is incomplete; they still use up a number), ``is_exit`` (carries the visit's highest
    number), ``first_timestamp`` of the visit, and per ``visit_lowest`` entry the visit's minimum of
    that expression.  The lower slices have ``second_micros``, which must divide ``slice_micros``.
    """
    second_micros = min(second_micros, slice_micros)
    if slice_micros % second_micros:
        raise ValueError(f"{second_micros} does not divide {slice_micros}")

    def cut(micros: int) -> Column:
        return F.coalesce(F.expr(f"event_timestamp div {micros}"), F.lit(BEFORE_ALL_SLICES))

    distinct = distinct_events(events, **visit_lowest).drop("copies")
    distinct = distinct.withColumn("second", cut(second_micros)).withColumn("slice", cut(slice_micros))
    # Ranking and summing up both work on this partitioning and share its shuffle.
    placed = distinct.repartition("visitId", "second")

    in_second = Window.partitionBy("visitId", "second")
    ranked = placed.select(
        "visitId",
        "second",
        "event_timestamp",
        "event_name",
        F.row_number().over(in_second.orderBy("event_timestamp", "event_name")).alias("rank_in_second"),
        *[F.col(name).alias(f"own_{name}") for name in visit_lowest],
    ).withColumn("last_complete", F.max(F.when(is_complete(), F.col("rank_in_second"))).over(in_second))

    in_slice = Window.partitionBy("visitId", "slice")
    seconds = (
        placed.groupBy("visitId", "second", "slice")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.min("event_timestamp").alias("first_timestamp"),
            F.max(F.when(is_complete(), F.col("second"))).alias("last_second"),
            *[F.min(name).alias(name) for name in visit_lowest],
        )
        .withColumn("before_in_slice", F.sum("events").over(in_slice.orderBy("second")) - F.col("events"))
    )
    visit = Window.partitionBy("visitId")
    slices = (
        seconds.groupBy("visitId", "slice")
        .agg(
            F.sum("events").alias("events"),
            F.min("first_timestamp").alias("first_timestamp"),
            F.max("last_second").alias("last_second"),
            *[F.min(name).alias(name) for name in visit_lowest],
        )
        .select(
            "visitId",
            "slice",
            (F.sum("events").over(visit.orderBy("slice")) - F.col("events")).alias("events_before"),
            F.max("last_second").over(visit).alias("last_second"),
            *[F.min(name).over(visit).alias(name) for name in ("first_timestamp", *visit_lowest)],
        )
    )
    of_second = [F.col(name).alias(f"second_{name}") for name in visit_lowest]
    placed_seconds = seconds.select("visitId", "second", "slice", "before_in_slice", *of_second)
    before = placed_seconds.join(slices, ["visitId", "slice"]).drop("slice")

    number = F.col("events_before") + F.col("before_in_slice") + F.col("rank_in_second")
    closes_visit = (F.col("second") == F.col("last_second")) & (F.col("rank_in_second") == F.col("last_complete"))
    return ranked.join(before, ["visitId", "second"]).select(
        "visitId",
        "event_timestamp",
        "event_name",
        F.when(is_complete(), number).alias("hitNumber"),
        F.when(is_complete(), closes_visit).alias("is_exit"),
        "first_timestamp",
        # Always the visit's value.  Naming those of the event and its second keeps them in all branches,
        # so that these read one and the same shuffle of the distinct events instead of scanning again.
        *[F.coalesce(name, f"second_{name}", f"own_{name}").alias(name) for name in visit_lowest],
    )


def keyed(hits: DataFrame) -> DataFrame:
    """Replace time and name by the key that rows are joined on."""
    return hits.withColumn(HIT_KEY, hit_key()).drop("event_timestamp", "event_name")


def with_hits(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Look up the hit of every row by ``visitId`` and ``hit_key``.

    The key is almost unique, so this shuffle balances by itself; should one event be repeated
    without end, AQE splits its partition.  A later ``distinct`` that keeps both key columns runs on
    this partitioning without another shuffle.
    """
    return rows.join(keyed(hits), ["visitId", HIT_KEY], "left")
