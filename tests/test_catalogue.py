"""The SQL functions against the Column forms."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from checks import queries
from hitloom.functions import catalogue, traffic
from hitloom.functions.lookups import bag_value
from hitloom.functions.texts import clean_text
from tests.builders import bag, event, events_frame

MEDIUMS = [None, "", "(none)", "cpc", "cpm", "ppc", "organic", "email", "e mail", "sms", "audio", "affiliate", "web push",
           "mobile", "social", "my video", "referral", "paid\nx", "banner"]
NAMES = [None, "cross-network", "shop", "eshop", "big shopping day", "a\nshop", "x"]
SOURCES = [None, "(direct)", "google", "google shopping", "fb", "netflix", "firebase", "sms", "e-mail", "amazon", "z"]


def test_channels_equal_the_column_form(spark):
    catalogue.register(spark)
    rows = spark.createDataFrame(list(product(MEDIUMS, NAMES, SOURCES)), "medium string, name string, source string")
    column = traffic.channel(F.col("medium"), F.col("name"), F.col("source"))
    found = rows.select(
        "*",
        F.expr("create_channel(medium, name, source)").alias("sql"),
        column.alias("column"),
        F.expr("channel_grouping(create_channel(medium, name, source))").alias("sql_group"),
        traffic.channel_group(column).alias("column_group"),
        F.expr("data_cleaning(source)").alias("sql_clean"),
        clean_text(F.col("source")).alias("column_clean"),
    )
    pairs = [("sql", "column"), ("sql_group", "column_group"), ("sql_clean", "column_clean")]
    for one, other in pairs:
        assert found.where(~F.col(one).eqNullSafe(F.col(other))).count() == 0
    assert found.select("sql").distinct().count() == 19


def test_lookups_equal_the_column_form(spark):
    catalogue.register(spark)
    frame = events_frame(
        spark,
        event(1, "a", params=[("k", "text"), ("n", 5), ("k", "second")], user=[("login_status", "true")]),
        event(2, "b"),
        event(3, "c", params=[("n", "as text")]),
    )
    for key in ("k", "n", "none", "ga_session_id"):
        found = frame.select(
            F.expr(f"get_event('{key}', event_params)").alias("sql"), bag_value(F.col("event_params"), key).alias("column")
        )
        assert all(row["sql"] == row["column"] for row in found.collect())
    found = frame.select(F.expr("get_user('login_status', user_properties).string_value").alias("status"))
    assert [row["status"] for row in found.collect()] == ["true", None, None]


def test_strict_and_other_cleaning(spark):
    frame = events_frame(spark, event(1, "a", params=[("k", "x"), ("k", "y")]))
    catalogue.register(spark, strict=True, clean="upper(value)")
    assert frame.selectExpr("get_event('ga_session_id', event_params).int_value AS n").first()["n"] == 1
    assert frame.selectExpr("data_cleaning(event_name) AS n").first()["n"] == "A"
    with pytest.raises(Exception, match="occurs more than once"):
        frame.selectExpr("get_event('k', event_params)").collect()
    catalogue.register(spark)
    assert frame.selectExpr("get_event('k', event_params).string_value AS v").first()["v"] == "x"


def test_a_mart_from_text_runs_without_python(spark):
    mart = queries.sql_functions(events_frame(spark, event(1, "a", params=bag() or [])))
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and mart.count() == 1
