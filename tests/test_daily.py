"""A day of a mart from export table to warehouse table."""

import datetime

import pytest

from hitloom.plans import daily
from hitloom.sources import exports, marts
from tests.builders import as_bag, event, events_frame, hit, item, session, sessions_frame

DAY = datetime.date(2024, 1, 1)
PROMO = [item("a", promo_id="P", promo_name="N")]


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("exports")
    rows = [event(i, "view_promotion", items=PROMO) for i in range(5)]
    rows += [event(i, "view_promotion", items=PROMO, date="20240102") for i in range(7)]
    events_frame(spark, *rows).write.partitionBy("event_date").parquet(str(folder / "events"))
    one = [hit(1, promotion=[("P", "N")])]
    sessions_frame(spark, session(hits=one), session("w", hits=one)).write.partitionBy("date").parquet(
        str(folder / "sessions")
    )
    return {"ga4": str(folder / "events"), "ua": str(folder / "sessions")}


@pytest.mark.parametrize("name", daily.MARTS)
def test_day_is_loaded_once_however_often_it_runs(spark, sources, tmp_path, name):
    source = sources[name.split("_")[0]]
    expected = {"ga4_hits": 5, "ga4_visits": 1, "ga4_products": 5, "ga4_promos": 5}.get(name, 2)
    for _ in range(2):
        summary = daily.load_day(spark, name, source, str(tmp_path), DAY).first()
        assert summary["row_count"] == expected
    assert (tmp_path / daily.MARTS[name].folder / f"{marts.LOAD_DAY}=2024-01-01").is_dir()


def test_other_days_stay(spark, sources, tmp_path):
    daily.load_day(spark, "ga4_promos", sources["ga4"], str(tmp_path), DAY)
    daily.load_day(spark, "ga4_promos", sources["ga4"], str(tmp_path), DAY + datetime.timedelta(days=1))
    assert spark.read.parquet(str(tmp_path / "promos_ga4")).count() == 12


def test_csv_and_parquet_hold_the_same(spark, sources, tmp_path):
    path = daily.export_day(spark, "ga4_hits", sources["ga4"], str(tmp_path), DAY)
    mart = daily.build_day(spark, "ga4_hits", sources["ga4"], DAY)
    loaded, rejected = marts.load_csv(spark, path, mart.schema)
    assert as_bag(loaded) == as_bag(marts.normalise_for_load(mart)) and rejected.count() == 0


def test_default_day_is_yesterday(spark, sources):
    assert daily.build_day(spark, "ua_visits", sources["ua"]).count() == 0
    assert exports.yesterday() == datetime.date.today() - datetime.timedelta(days=1)


@pytest.mark.parametrize("name", ["ga4_promos", "ua_visits"])
def test_backfill_equals_single_runs(spark, sources, tmp_path, name):
    source, folder = sources[name.split("_")[0]], daily.MARTS[name].folder
    days = [DAY + datetime.timedelta(days=i) for i in range(3)]
    for target in ("one", "many"):
        daily.load_day(spark, name, source, str(tmp_path / target), DAY)
    for day in days:
        daily.load_day(spark, name, source, str(tmp_path / "one"), day)
    counts = daily.backfill(spark, name, source, str(tmp_path / "many"), days, at_once=2)
    one, many = (spark.read.parquet(str(tmp_path / target / folder)) for target in ("one", "many"))
    assert as_bag(one) == as_bag(many)
    assert as_bag(counts) == as_bag(one.groupBy("load_day").count())
