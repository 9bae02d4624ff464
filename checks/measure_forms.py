"""

    python -m checks.measure_forms [sf folder]
"""

from __future__ import annotations

import statistics
import sys
import tempfile
import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from checks import exports
from hitloom.functions import flags
from hitloom.functions.lookups import event_text, user_text
from hitloom.operators.first_touch import first_touch
from hitloom.operators.hit_numbers import hit_table
from hitloom.operators.visit_keys import event_id, with_visits
from hitloom.operators.visit_metrics import visit_metrics
from hitloom.plans import hits, visits
from hitloom.session import local_session

RUNS = 5


def in_visit():
    return Window.partitionBy("visitId").orderBy("event_timestamp", "event_name")


def numbers_by_join(events: DataFrame) -> DataFrame:
    rows = events.withColumn("identity", event_id()) if "user_pseudo_id" in events.columns else events
    distinct = rows.select("visitId", "event_timestamp", "event_name", "identity").distinct()
    numbered = distinct.select("identity", F.row_number().over(in_visit()).alias("hitNumber"))
    return rows.select("visitId", "identity").join(numbered, "identity", "left")


def numbers_by_window(events: DataFrame) -> DataFrame:
    return events.select("visitId", "event_timestamp", "event_name", F.dense_rank().over(in_visit()).alias("hitNumber"))


def texts_by_filter(events: DataFrame) -> DataFrame:
    def found(key: str) -> Column:
        return F.get(F.filter("event_params", lambda e: e["key"] == key), 0)["value"]["string_value"]

    return events.select(*[found(key).alias(name) for name, key in hits.EVENT_TEXTS.items()])


def texts_by_position(events: DataFrame) -> DataFrame:
    return events.select(*[event_text(key).alias(name) for name, key in hits.EVENT_TEXTS.items()])


def touch_by_windows(events: DataFrame) -> DataFrame:
    chosen = []
    for group in visits.touch_groups().values():
        unknown = F.lit(False)
        for column in group.required:
            unknown = unknown | column.isNull()
        order = Window.partitionBy("visitId").orderBy(unknown, "event_timestamp", "event_name", *group.values.values())
        chosen += [F.first(value).over(order).alias(name) for name, value in group.values.items()]
    return events.select("visitId", *chosen).distinct()


def touch_by_minimum(events: DataFrame) -> DataFrame:
    return first_touch(events, visits.touch_groups())


def counts_distinct(events: DataFrame) -> DataFrame:
    rows = events.withColumn("identity", event_id())
    name, login = F.col("event_name"), flags.as_bit(flags.is_logged_in(user_text("login_status")))
    return rows.groupBy("visitId").agg(
        flags.seconds(F.max("event_timestamp") - F.min("event_timestamp")).alias("duration"),
        F.count_distinct("identity").alias("hits"),
        F.max(flags.as_bit(flags.is_first_event(name))).alias("new_visit"),
        F.count_distinct(F.when(name == "page_view", F.col("identity"))).alias("pageviews"),
        F.count_distinct(F.when(name == "screen_view", F.col("identity"))).alias("screenviews"),
        F.max(login).alias("logged_in"),
        F.max(flags.as_bit(flags.is_interaction(name))).alias("active"),
    )


def dominated(spark, rows: int) -> DataFrame:
    """Event keys of which one visit holds a third."""
    return spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, "bot").otherwise(F.concat(F.lit("v"), F.col("id") % (rows // 10))).alias("visitId"),
        (F.col("id") * 86_400_000_000 / rows).cast("long").alias("event_timestamp"),
        F.concat(F.lit("event_"), F.col("id") % 5).alias("event_name"),
        F.col("id").cast("string").alias("identity"),
    )


def median_seconds(frame: DataFrame, runs: int = RUNS) -> float:
    times = []
    for _ in range(runs + 1):
        started = time.perf_counter()
        frame.write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - started)
    return statistics.median(times[1:])


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(tempfile.mkdtemp(prefix="checks-"), "8")
    spark.sparkContext.setLogLevel("ERROR")
    events = exports.ga4(spark, sf_dir)
    visited = with_visits(events)
    cases = {
        "numbers: row_number and join": numbers_by_join(visited),
        "numbers: dense_rank over the visit": numbers_by_window(visited),
        "numbers: time slices": hit_table(visited),
        "20 texts: a filter each": texts_by_filter(events),
        "20 texts: position": texts_by_position(events),
        "first touch: windows": touch_by_windows(visited),
        "first touch: minimum of a struct": touch_by_minimum(visited),
        "visit metrics: count distinct": counts_distinct(visited),
        "visit metrics: two steps": visit_metrics(visited),
    }
    for name, frame in cases.items():
        print(f"{median_seconds(frame):8.2f}s  {name}", flush=True)
    keys = dominated(spark, 12_000_000)
    for name, make in [
        ("row_number and join", numbers_by_join),
        ("dense_rank over the visit", numbers_by_window),
        ("time slices", hit_table),
    ]:
        print(f"{median_seconds(make(keys), 1):8.2f}s  12M keys, a third in one visit: {name}", flush=True)


if __name__ == "__main__":
    main()
