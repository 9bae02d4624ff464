import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.functions import flags, traffic
from hitloom.functions.lookups import (
    bag_field,
    bag_value,
    dimension,
    event_long,
    event_text,
    explode_repeats,
    strict_lookups,
)
from hitloom.functions.texts import clean_text, joined
from hitloom.schemas import DIMENSIONS, EVENT_PARAMS, ITEMS
from tests.builders import bag, item


def one(spark, column, value, schema):
    return spark.createDataFrame([(value,)], f"x {schema}").select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "params, expected",
    [
        (None, (None, None)),
        ([], (None, None)),
        (bag(("other", "x")), (None, None)),
        (bag(("k", "text")), ("text", None)),
        (bag(("k", 7)), (None, 7)),
        (bag(("a", "x"), ("k", "first"), ("k", "second")), ("first", None)),
    ],
)
def test_lookup(spark, params, expected):
    frame = spark.createDataFrame([(params,)], f"event_params {EVENT_PARAMS.simpleString()}")
    assert tuple(frame.select(event_text("k"), event_long("k")).first()) == expected


def test_lookup_of_whole_value(spark):
    frame = spark.createDataFrame([(bag(("k", 7)),)], f"p {EVENT_PARAMS.simpleString()}")
    assert frame.select(bag_value(F.col("p"), "k").alias("v")).first()["v"]["int_value"] == 7


def test_strict_lookup_refuses_repeated_keys(spark):
    frame = spark.createDataFrame([(bag(("k", "a"), ("k", "b")),)], f"p {EVENT_PARAMS.simpleString()}")
    with pytest.raises(Exception, match="more than once"):
        frame.select(bag_field(F.col("p"), "k", "string_value", strict=True)).collect()
    other = spark.createDataFrame([(bag(("k", "a"), ("j", "b"), ("j", "c")),)], frame.schema)
    assert other.select(bag_field(F.col("p"), "k", "string_value", strict=True)).first()[0] == "a"


ITEM_ROWS = [
    item("b", "l2"),
    item(None, "l1"),
    item("(not set)", "l0"),
    item("b", "(not set)"),
    item("b", "a"),
    item("a", None),
]


@pytest.mark.parametrize(
    "items, field, by, expected",
    [
        (None, "item_name", None, ""),
        ([], "item_name", None, ""),
        ([item("(not set)"), item(None)], "item_name", None, ""),
        (ITEM_ROWS, "item_name", None, "a,b,b,b"),
        # NULL key first, then the placeholder (sorted as it is), then a, b; ties by value.
        (ITEM_ROWS, "item_list_name", "item_name", "l1,l0,a,l2"),
    ],
)
def test_joined_items(spark, items, field, by, expected):
    assert one(spark, joined(F.col("x"), field, by), items, ITEMS.simpleString()) == expected


def test_joined_can_keep_placeholders(spark):
    column = joined(F.col("x"), "item_name", drop_not_set=False)
    assert one(spark, column, [item("b"), item("(not set)")], ITEMS.simpleString()) == "(not set),b"


@pytest.mark.parametrize("value, expected", [("x", "x"), ("", None), ("(not set)", None), (None, None), (" ", " ")])
def test_clean_text(spark, value, expected):
    assert one(spark, clean_text(F.col("x")), value, "string") == expected


@pytest.mark.parametrize(
    "value, expected",
    [("Web", "Website"), ("IOS", "App"), ("android", "App"), ("tv", None), (None, None)],
)
def test_site_or_app(spark, value, expected):
    assert one(spark, flags.site_or_app(F.col("x")), value, "string") == expected


@pytest.mark.parametrize(
    "status, plain, with_one",
    [("LOGGED IN", True, True), ("true", True, True), ("1", False, True), ("no", False, False), (None, False, False)],
)
def test_login(spark, status, plain, with_one):
    assert one(spark, flags.is_logged_in(F.col("x")), status, "string") is plain
    assert one(spark, flags.is_logged_in(F.col("x"), flags.LOGGED_IN_OR_ONE), status, "string") is with_one


@pytest.mark.parametrize(
    "name, interaction, kind",
    [
        ("page_view", False, "PAGE"),
        ("screen_view", False, "APPVIEW"),
        ("scroll", False, "EVENT"),
        ("click", True, "EVENT"),
        (None, False, "EVENT"),
    ],
)
def test_event_kind(spark, name, interaction, kind):
    assert one(spark, flags.is_interaction(F.col("x")), name, "string") is interaction
    assert one(spark, flags.hit_type(F.col("x")), name, "string") == kind


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
@pytest.mark.parametrize(
    "micros, day",
    [
        (0, datetime.date(1970, 1, 1)),
        (86_399_999_999, datetime.date(1970, 1, 1)),
        (86_400_000_000, datetime.date(1970, 1, 2)),
        (-1, datetime.date(1969, 12, 31)),
        (1_704_067_199_999_999, datetime.date(2023, 12, 31)),
        (1_704_067_200_000_000, datetime.date(2024, 1, 1)),
    ],
)
def test_utc_date_ignores_the_session_zone(spark, zone, micros, day):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, flags.utc_date(F.col("x")), micros, "long") == day
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_malformed_event_date_raises(spark):
    with pytest.raises(Exception, match="(?i)parse|date"):
        one(spark, flags.event_date(F.col("x")), "2024-99-99", "string")


CHANNELS = [
    ("(none)", None, "(direct)", "Direct"),
    ("(not set)", None, "(direct)", "Direct"),
    ("cpc", "a cross-network b", "google", "Cross-network"),
    ("cpc", None, "amazon", "Paid Shopping"),
    ("paid", "my shop", "acme", "Paid Shopping"),
    ("ppc", None, "bing", "Paid Search"),
    ("cpm", None, "google", "Paid Search"),  # before Display
    ("retargeting", None, "facebook", "Paid Social"),
    ("paid-video", None, "vimeo", "Paid Video"),
    ("banner", None, "acme", "Display"),
    ("cpm", None, "acme", "Display"),  # before Paid Other
    ("cpc", None, "acme", "Paid Other"),
    ("referral", None, "etsy", "Organic Shopping"),
    ("x", "shopping days", "acme", "Organic Shopping"),
    ("x", "workshop", "acme", "Unassigned"),
    ("x", "eshop", "acme", "Organic Shopping"),  # "e" is the one letter allowed before "shop"
    ("sm", None, "acme", "Organic Social"),
    ("referral", None, "twitter", "Organic Social"),
    ("some video ad", None, "acme", "Organic Video"),
    ("x", None, "twitch", "Organic Video"),
    ("organic", None, "acme", "Organic Search"),
    ("x", None, "yandex", "Organic Search"),
    ("link", None, "acme", "Referral"),
    ("e-mail", None, "acme", "Email"),
    ("x", None, "e mail", "Email"),
    ("affiliate", None, "acme", "Affiliates"),
    ("audio", None, "acme", "Audio"),
    ("sms", None, "acme", "SMS"),
    ("x", None, "sms", "SMS"),
    ("web push", None, "acme", "Mobile Push Notifications"),
    ("mobile app", None, "acme", "Mobile Push Notifications"),
    ("x", None, "firebase", "Mobile Push Notifications"),
    ("x", None, "acme", "Unassigned"),
    (None, None, None, "Unassigned"),
    ("cpc", None, "Google", "Paid Other"),  # sources are matched as they are
    ("cpc\n", None, "acme", "Unassigned"),  # the pattern ends at the end of the text
]


def test_channels(spark):
    rows = spark.createDataFrame(CHANNELS, "medium string, campaign string, source string, expected string")
    found = rows.withColumn("found", traffic.channel(F.col("medium"), F.col("campaign"), F.col("source")))
    assert [r for r in found.collect() if r["found"] != r["expected"]] == []
    assert found.select("found").distinct().count() == 19


def test_channel_groups(spark):
    names = ["Direct", "organic search", "Paid Social", "Organic Social", "social", "Unassigned", None]
    rows = spark.createDataFrame([(n,) for n in names], "x string")
    groups = [r[0] for r in rows.select(traffic.channel_group(F.col("x"))).collect()]
    assert groups == ["Direct", "organic search", "(Other)", "(Other)", "social", "(Other)", "(Other)"]


def test_channel_group_of_unknown_traffic(spark):
    rows = spark.createDataFrame([(None, None, None), ("x", None, None)], "m string, c string, s string")
    groups = rows.select(traffic.channel_group_or_null(F.col("m"), F.col("c"), F.col("s"))).collect()
    assert [r[0] for r in groups] == [None, "(Other)"]


@pytest.mark.parametrize(
    "source, medium, gclid, expected",
    [
        ("Google", "Organic", "g1", "cpc"),
        ("google", "organic", None, "organic"),
        ("bing", "Organic", "g1", "organic"),
        ("google", "CPC", None, "cpc"),
        (None, "Email", "g1", "email"),
        (None, None, None, None),
    ],
)
def test_effective_medium(spark, source, medium, gclid, expected):
    value = (source, medium, gclid)
    schema = "struct<manual_source:string,manual_medium:string,gclid:string>"
    assert one(spark, traffic.effective_medium(F.col("x")), value, schema) == expected


@pytest.mark.parametrize(
    "entries, expected",
    [
        (None, [(None, None)]),
        ([], [(None, None)]),
        ([(1, "a"), (2, "b")], [("a", "b")]),
        ([(1, "a"), (None, "n"), (None, "m"), (1, "c")], [("a", None), ("c", None)]),
        ([(9, "x"), (9, "y"), (1, "a")], [("a", None)]),
        ([(1, "a"), (2, "b"), (1, "c"), (2, "d")], [("a", "b"), ("c", "b"), ("a", "d"), ("c", "d")]),
        ([(1, None), (1, "a")], [(None, None), ("a", None)]),
        ([(9, "x"), (9, "y")], [(None, None)]),
    ],
)
def test_repeated_dimensions_give_a_row_per_combination(spark, entries, expected):
    frame = spark.createDataFrame([(entries,)], T.StructType([T.StructField("x", DIMENSIONS)]))
    rows = explode_repeats(frame, F.col("x"), [1, 2])
    found = rows.select(*[dimension(F.col("chosen"), i) for i in (1, 2)]).collect()
    assert rows.columns == ["x", "chosen"] and sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_repeated_dimensions_plan_grows_with_each_dimension_alike(spark):
    frame = spark.createDataFrame([], T.StructType([T.StructField("x", DIMENSIONS)]))

    def size(n: int) -> int:
        rows = explode_repeats(frame, F.col("x"), range(n))
        rows = rows.select(*[dimension(F.col("chosen"), i) for i in range(n)])
        return len(rows._jdf.queryExecution().optimizedPlan().toString())

    assert size(41) - size(21) < 1.2 * (size(21) - size(1))


def test_strict_lookups_reach_every_lookup_built_inside(spark):
    with strict_lookups():
        wanted = event_text("k")
    params = [("k", ("a", None, None, None)), ("k", ("b", None, None, None))]
    schema = "event_params array<struct<key:string,value:struct<string_value:string,int_value:long,float_value:double,double_value:double>>>"
    frame = spark.createDataFrame([(params,)], schema)
    assert frame.select(event_text("k")).first()[0] == "a"
    with pytest.raises(Exception, match="occurs more than once"):
        frame.select(wanted).collect()

