"""The test exports are made of narrow rows until they are written."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import exports
from checks.queries import all_queries
from hitloom.sources import marts

WIDE = {"ga4": ("event_params", "user_properties"), "ua": ("customDimensions", "hits")}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    times = [datetime(2024, 1, 1 + i % 2, i) for i in range(14)]
    events = [(i, time, i % 3, ("view", "click")[i % 2], float(i)) for i, time in enumerate(times)]
    types = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    spark.createDataFrame(events, types).write.parquet(f"{folder}/events.parquet")
    lines = [(i // 2, i % 5, i % 3, i % 2 + 1, float(i), "R" if i % 4 == 0 else "N", "F") for i in range(20)]
    types = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, "
        "l_returnflag string, l_linestatus string"
    )
    spark.createDataFrame(lines, types).write.parquet(f"{folder}/lineitem.parquet")
    parts = [(i, f"part {i}", f"brand {i}", f"type {i}", i + 1) for i in range(5)]
    types = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"
    spark.createDataFrame(parts, types).write.parquet(f"{folder}/part.parquet")
    return folder


@pytest.mark.parametrize("kind, derive", [("ga4", exports.derive_ga4_events), ("ua", exports.derive_ua_sessions)])
def test_wide_rows_are_neither_shuffled_nor_sorted(spark, tables, kind, derive):
    rows = derive(spark, tables)
    text = rows._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "REBALANCE_PARTITIONS_BY_COL" in text
    inputs = re.findall(r"\(\d+\) (?:Exchange|Sort)\s*\nInput \[\d+\]: \[(.*)\]", text)
    assert inputs
    for name in WIDE[kind]:
        assert not any(f"{name}#" in columns for columns in inputs)


def test_derived_rows(spark, tables):
    events = exports.derive_ga4_events(spark, tables)
    assert events.count() == 14 + 2  # events 0 and 7 are delivered twice
    first = events.where("collected_traffic_source.gclid = 'g0'").first()
    assert [(i.item_name, i.item_list_name, i.item_category, i.promotion_id, i.promotion_name) for i in first["items"]] == [
        ("part 0", "list0", "type 0", "(not set)", "brand 0"),
        ("part 1", "list1", "type 1", "P1", None),
    ]
    hits = exports.derive_ua_sessions(spark, tables).select(F.explode("hits").alias("hit")).select("hit.*")
    assert hits.count() == 14
    assert hits.where("size(promotion) = size(product)").count() == hits.where("promotion is not null").count()
    assert {row["hitNumber"] for row in hits.collect()} == {1, 2, 3, 4, 5}


@pytest.mark.parametrize("query, rows", [("mart_day_overwrite", 2), ("mart_day_emptied", 1)])
def test_promotion_days_are_written_from_one_built_mart(spark, tables, monkeypatch, query, rows):
    plans, write = [], marts.write_mart

    def recorded(mart, *place):
        plans.append(mart._jdf.queryExecution().executedPlan().toString())
        return write(mart, *place)

    monkeypatch.setattr(marts, "write_mart", recorded)
    written = all_queries()[query](spark, tables)
    assert len(plans) == 3 and not any("Exchange" in plan or "Generate" in plan for plan in plans)
    assert {n for (n,) in written.groupBy(*written.columns[:-1]).count().where("promoName is null or promoName != 'before'").select("count").collect()} == {rows}
