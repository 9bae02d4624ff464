"""Plan shapes that matter at scale, read from the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from hitloom.operators import hit_numbers
from hitloom.operators.visit_keys import with_visits
from hitloom.plans import hits, products, sessions, visits
from hitloom.session import RUNTIME_SETTINGS
from hitloom.sources import exports
from tests.builders import event, events_frame, item, session, hit, sessions_frame

MARTS = {
    "hits": hits.hits,
    "hits_basic": lambda events: hits.hits(events, full=False),
    "products": products.products,
    "promotions": products.promotions,
    "promotions_basic": lambda events: products.promotions(events, with_date=False),
    "visits_basic": visits.visits_basic,
    "visits_attributed": visits.visits_attributed,
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("exports")
    rows = [event(i, "view_promotion", items=[item("a", promo_id="P", promo_name="N")]) for i in range(5)]
    events_frame(spark, *rows).write.partitionBy("event_date").parquet(str(folder / "events"))
    sessions_frame(spark, session(hits=[hit(1)])).write.partitionBy("date").parquet(str(folder / "sessions"))
    return exports.ga4_events(spark, str(folder / "events")), exports.ua_sessions(spark, str(folder / "sessions"))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange (\w+)", text)


@pytest.mark.parametrize("name", MARTS)
def test_no_python_no_cross_join_no_forced_broadcast(tables, no_broadcast, name):
    text = plan(MARTS[name](tables[0]))
    for banned in ("Python", "Pandas", "CartesianProduct", "NestedLoop", "Broadcast", "collect_list", "collect_set"):
        assert banned not in text
    assert "Exchange SinglePartition" not in text


@pytest.mark.parametrize("name", MARTS)
def test_visitor_filter_reaches_the_scan(tables, name):
    text = plan(MARTS[name](tables[0]))
    assert text.count("PushedFilters: [IsNotNull(user_pseudo_id)") == text.count("FileScan")


# Per mart, what the whole of its scans must not read.
UNREAD = {
    "hits": ("float_value", "double_value", "set_timestamp_micros", "language:", "geo"),
    "hits_basic": ("float_value", "double_value", "set_timestamp_micros", "language:", "geo"),
    "products": ("float_value", "string_value", "device", "user_properties", "promotion_id"),
    "promotions": ("float_value", "string_value", "device", "user_properties", "item_name", "item_category"),
    "promotions_basic": ("float_value", "string_value", "device", "user_properties", "item_name", "item_category"),
    "visits_attributed": ("float_value", "double_value", "items", "set_timestamp_micros"),
    "visits_basic": ("float_value", "double_value", "items", "set_timestamp_micros"),
}


def scanned(text):
    found = re.findall(r"ReadSchema: (.*)", text)
    assert found and not any(schema.endswith("...") for schema in found)
    return " ".join(found)


@pytest.mark.parametrize("name", MARTS)
def test_scans_read_only_what_a_mart_needs(spark, tables, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        read = scanned(plan(MARTS[name](tables[0])))
        assert [field for field in UNREAD[name] if field in read] == []
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_session_promotions_read_three_fields_of_a_hit(spark, tables):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        read = scanned(plan(sessions.promotions(tables[1])))
        assert "promotion" in read and not any(x in read for x in ("product", "customDimensions", "page", "eventInfo"))
        assert scanned(plan(sessions.visits(tables[1]))).count("hits:array") == 0
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_duplicates_are_removed_without_another_shuffle(tables, no_broadcast):
    """Rows are shuffled once, to their hit; the two deduplicating aggregates sit right on the join."""
    lines = plan(hits.hits(tables[0])).splitlines()
    joins = [n for n, line in enumerate(lines) if "SortMergeJoin" in line and "LeftOuter" in line]
    assert len(joins) == 1
    above = "\n".join(lines[: joins[0]])
    assert above.count("HashAggregate") == 2 and "Exchange" not in above


@pytest.mark.parametrize("name", ["hits", "products", "promotions"])
def test_no_window_sorts_the_events_of_a_whole_visit(tables, no_broadcast, name):
    """Windows over a visit see one row per time slice; windows over events are cut by slice."""
    for window in re.findall(r"Window \[(.*)", plan(MARTS[name](tables[0]))):
        if "row_number" in window or "rank_in_second" in window:
            assert "second" in window


@pytest.mark.parametrize("name", ["visits_basic", "visits_attributed"])
def test_visits_need_no_window(tables, name):
    assert "Window" not in plan(MARTS[name](tables[0]))


def test_all_branches_of_the_numbering_share_one_shuffle(spark, tables, no_broadcast):
    frame = products.promotions(tables[0])
    frame.collect()
    final = plan(frame).split("Initial Plan")[0]
    assert final.count("FileScan") == 2 and final.count("ReusedExchange") == 2


def test_session_marts_shuffle_at_most_once(tables):
    assert exchanges(plan(sessions.visits(tables[1]))) == []
    assert len(exchanges(plan(sessions.hits(tables[1])))) == 1
    assert len(exchanges(plan(sessions.promotions(tables[1])))) == 1


@pytest.mark.parametrize("micros", [50_000, 1_000])
def test_a_dominating_visit_is_spread_over_tasks(spark, micros):
    """One visit holds nearly all events, even within 200 seconds; no task ranks more than its share."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(200_000).select(
            F.when(F.col("id") % 20 == 0, F.concat(F.lit("v"), F.col("id"))).otherwise("bot").alias("visitId"),
            (F.col("id") * micros).alias("event_timestamp"),
            F.lit("n").alias("event_name"),
        )
        table = hit_numbers.hit_table(rows).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in table.where("visitId = 'bot'").groupBy("task").count().collect()]
        assert sum(sizes) == 190_000 and max(sizes) < 0.4 * 190_000
        assert table.where("visitId = 'bot'").agg(F.max("hitNumber")).first()[0] == 190_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_skewed_rows_are_split_by_aqe(spark):
    """Copies of one event fill a partition; AQE splits it and the result stays right."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        base = events_frame(spark, event(1, "n", params=[("page_path", "p")]))
        copies = base.crossJoin(spark.range(0, 30_000, 1, 8)).drop("id")
        others = base.crossJoin(spark.range(0, 6_000, 1, 8)).withColumn("event_timestamp", F.col("id") + 2).drop("id")
        frame = hits.hits(copies.unionByName(others))
        rows = frame.collect()
        assert len(rows) == 6_001 and {r["hitNumber"] for r in rows} == set(range(1, 6_002))
        assert "SortMergeJoin(skew=true)" in plan(frame)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_keys_filter_first(spark):
    frame = events_frame(spark, event(1, "a", visitor=None), event(1, "a"))
    assert with_visits(frame).count() == 1


@pytest.mark.parametrize("name", ["visits_basic", "visits_attributed"])
def test_bags_are_not_sorted(spark, tables, name):
    """Spark sorts the input of an aggregate that holds texts: it must be the values wanted, not whole bags."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = MARTS[name](tables[0])._jdf.queryExecution().explainString(mode)
    sorted_columns = re.findall(r"\(\d+\) Sort\s*\nInput \[\d+\]: \[(.*)\]", text)
    assert sorted_columns
    assert not any("event_params#" in columns for columns in sorted_columns)


def test_tasks_take_bounded_bytes(spark):
    """Packed exports and shuffles grow many times in memory; Spark's 128 MB and 64 MB are too much of them."""
    megabytes = {
        name: int(RUNTIME_SETTINGS[name].removesuffix("m"))
        for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    }
    assert max(megabytes.values()) <= 32
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == RUNTIME_SETTINGS["spark.sql.files.maxPartitionBytes"]
