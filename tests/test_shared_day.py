"""The marts from the shared table against those built one by one."""

from datetime import date

import pytest

from hitloom.plans import daily, hits, products, shared_day
from hitloom.sources import marts
from tests.builders import as_bag, event, events_frame, item

A, B = item("a", "l", "c", "P1", "N1"), item("b", None, "(not set)", "P2", "N2")


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        event(1, "view_promotion", items=[A, B]),
        event(1, "view_promotion", items=[B, A]),  # the same hit, its items in another order
        event(1, "view_promotion", items=[A, B]),
        event(1, "select_promotion", items=[A]),
        event(2, "page_view", params=[("page_path", "/x")], items=[]),
        event(2, "page_view", params=[("page_path", "/y")]),
        event(3, None, items=[A]),
        event(4, None, items=[A]),
        event(None, "view_promotion", items=[A]),
        event(None, "view_promotion", items=[B]),
        event(5, "view_promotion", visitor="v", items=[item(promo_id="P", promo_name="(not set)")], date="20240102"),
        event(6, "purchase", visitor="v", items=[item("only name")], date="20240103"),
        event(7, "scroll", visitor=None),
        event(8, "scroll", session=None),
    ]
    return events_frame(spark, *rows)


@pytest.fixture(scope="module")
def numbered(spark, events, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("day") / "numbered")
    shared_day.numbered_hits(events).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    "shared, alone",
    [
        (shared_day.hits, hits.hits),
        (shared_day.products, products.products),
        (shared_day.promotions, products.promotions),
    ],
)
def test_marts_are_equal(events, numbered, shared, alone):
    assert shared(numbered).dtypes == alone(events).dtypes
    assert as_bag(shared(numbered)) == as_bag(alone(events))


def test_the_export_is_scanned_twice_and_rows_are_shuffled_once(spark, events, tmp_path):
    events.write.parquet(str(tmp_path / "events"))
    frame = shared_day.numbered_hits(spark.read.schema(events.schema).parquet(str(tmp_path / "events")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame.collect()
        text = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("FileScan") == 2
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning(" in line and "page_name_17" in line]
    assert not wide  # grouped by all columns on the partitioning of the join


def test_texts_made_of_items_are_not_shuffled(spark, events):
    """They are computed above the join; its shuffle carries the items alone."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        tree = shared_day.numbered_hits(events)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    above, _, below = tree.partition("Join LeftOuter")
    assert "AS page_name_17#" in below
    assert all(f"AS {name}#" in above and f"AS {name}#" not in below for name in hits.ITEM_TEXTS)


def test_an_empty_day(events):
    none = shared_day.numbered_hits(events.limit(0))
    assert [mart(none).count() for mart in (shared_day.hits, shared_day.products, shared_day.promotions)] == [0, 0, 0]


def test_a_day_is_loaded_together(spark, events, tmp_path):
    events.write.partitionBy("event_date").parquet(str(tmp_path / "events"))
    day = date(2024, 1, 1)
    for _ in range(2):
        summaries = daily.load_ga4_day(spark, str(tmp_path / "events"), str(tmp_path / "marts"), day)
    for name, summary in summaries.items():
        alone = marts.normalise_for_load(daily.build_day(spark, name, str(tmp_path / "events"), day))
        loaded = spark.read.parquet(str(tmp_path / "marts" / daily.MARTS[name].folder)).drop(marts.LOAD_DAY)
        assert as_bag(loaded) == as_bag(alone) and summary.first()["row_count"] == alone.count()
