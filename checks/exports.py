"""Derive the two nested exports from ``events``, ``lineitem`` and ``part`` and write them once.

The queries then read them the way a user would: as Parquet tables partitioned by day, with column
and partition pruning.  They are written to the session's shared checkpoint folder, once per Spark
application and scale folder.

An exported row is many times as large as what it is made of, so all shuffles and sorts come first, on
the narrow rows, and the wide ones are made on their way into the files.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import rules
from hitloom.functions import flags
from hitloom.schemas import GA4_EVENTS, UA_SESSIONS
from hitloom.session import shared_folder
from hitloom.sources import exports, marts

#: Shuffled bytes of the narrow rows that one task writes.
BYTES_PER_FILE = 16 << 20

_written: dict[tuple[str, str, str], str] = {}


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number)


def _choice(number: Column, *choices) -> Column:
    return F.get(F.array(*[F.lit(c) for c in choices]), number.cast("int"))


def _epoch_micros(ts: Column) -> Column:
    """Micros since the epoch of a zone-less timestamp, whatever the session zone is."""
    day = F.unix_date(ts.cast("date")).cast("long") * flags.MICROS_PER_DAY
    minutes = (F.hour(ts) * 60 + F.minute(ts)).cast("long") * 60_000_000
    micros = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return day + minutes + micros


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of each order, as the array the export carries in one event row."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type", "p_size"
    )

    def unset_if(condition: Column, value: Column) -> Column:
        return F.when(condition, "(not set)").otherwise(value)

    placed = (
        lines.join(parts, "l_partkey")
        .select(
            F.col("l_orderkey").alias("event_id"),
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            "l_extendedprice",
            (F.col("l_returnflag") == "R").alias("returned"),
            unset_if(F.col("l_linenumber") % 4 == 0, F.col("p_name")).alias("item_name"),
            unset_if(F.col("p_size") % 5 == 0, F.col("p_type")).alias("item_category"),
            F.when(~((F.col("l_linestatus") == "F") & (F.col("l_linenumber") % 2 == 0)), F.col("p_brand")).alias(
                "promotion_name"
            ),
        )
        .repartition("event_id")
    )
    item = F.struct(
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        F.struct(
            F.col("item_name"),
            F.when(F.col("l_linenumber") % 3 != 0, _text("list", F.col("l_suppkey") % 5)).alias("item_list_name"),
            F.col("item_category"),
            unset_if(F.col("returned"), _text("P", F.col("l_suppkey") % 10)).alias("promotion_id"),
            F.col("promotion_name"),
        ).alias("item"),
    )
    return placed.groupBy("event_id").agg(F.sort_array(F.collect_list(item))["item"].alias("items"))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, with its items, new name, raw time and three-day bucket."""
    event = F.col("event_id")
    kind = F.col("event_type")
    name = (
        F.when(event % 89 == 0, None)
        .when(kind == "signup", "first_visit")
        .when(kind == "error", "scroll")
        .when(kind == "click", "select_promotion")
        .when(kind == "view", _choice(event % 3, "page_view", "screen_view", "view_promotion"))
        .otherwise(_choice(event % 2, "video_start", "view_item"))
    )
    no_items = F.when(event % 2 == 1, F.array().cast(GA4_EVENTS["items"].dataType))
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .join(_items(spark, sf_dir), "event_id", "left")
        .withColumns(
            {
                "us": _epoch_micros(F.col("ts")),
                "event_date": F.replace(F.col("ts").cast("date").cast("string"), F.lit("-"), F.lit("")),
                "event_name": name,
                "items": F.coalesce("items", no_items),
            }
        )
        .withColumn("bucket", F.expr(f"us div {rules.BUCKET_MICROS}"))
    )


def _traffic(number: Column) -> Column:
    rows = [
        F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(("source", "medium", "campaign"), row)])
        for row in rules.TRAFFIC
    ]
    return F.get(F.array(*rows), number.cast("int"))


def _entry(key: str, value: Column, slot: str, user: bool = False) -> Column:
    slots = {"string_value": "string", "int_value": "long", "float_value": "double", "double_value": "double"}
    if user:
        slots["set_timestamp_micros"] = "long"
    fields = [(value if n == slot else F.lit(None)).cast(t).alias(n) for n, t in slots.items()]
    return F.struct(F.lit(key).alias("key"), F.struct(*fields).alias("value"))


def _event_params() -> Column:
    event, user = F.col("event_id"), F.col("user_id")

    def text(key: str, value: Column) -> Column:
        return _entry(key, value, "string_value")

    def number(key: str, value: Column) -> Column:
        return _entry(key, value, "int_value")

    section = F.when(event % 3 == 0, "").otherwise(_text("sec", event % 4))
    entries = [
        F.when(event % 50 != 0, number("ga_session_id", F.col("bucket") * rules.BUCKET_SECONDS)),
        F.when(event % 4 != 0, number("engagement_time_msec", F.expr("cast(floor(value) as bigint) div 100"))),
        number("video_duration", event % 600),
        F.when(event % 3 == 0, text("player_id", _text("p", event % 9))).when(
            event % 3 == 1, number("player_id", event)
        ),
        text("page_language", _choice(event % 2, "en", "de")),
        F.when(event % 8 != 0, text("country", _text("X", user % 25))),
        text("content_section_1", section),
        text("content_section_2", section),
        *[
            F.when((event + position) % 5 != 0, text(key, _text(f"{key}_", event % 12)))
            for position, key in enumerate(rules.TEXT_PARAMS, 1)
        ],
    ]
    return F.when(event % 101 != 0, F.array_compact(F.array(*entries)))


def _user_properties() -> Column:
    event, user = F.col("event_id"), F.col("user_id")

    def text(key: str, value: Column) -> Column:
        return _entry(key, value, "string_value", user=True)

    entries = [
        F.when(event % 5 != 4, text("login_status", _choice(event % 5, "Logged In", "true", "1", "no"))),
        F.when(user % 2 == 0, text("newsletter_subscriber", F.lit("y"))),
        text("user_team", _text("t", user % 20)),
    ]
    return F.array_compact(F.array(*entries))


def derive_ga4_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, user, us = F.col("event_id"), F.col("user_id"), F.col("us")
    traffic = _traffic(event % 23)
    columns = {
        "event_timestamp": F.when(event % 3 == 0, us - us % rules.ROUNDING_MICROS).otherwise(us),
        "event_name": F.col("event_name"),
        "user_pseudo_id": F.when(event % 97 != 0, _text("u", user)),
        "stream_id": _text("s", user % 3),
        "platform": F.when(event % 11 != 0, _choice(user % 4, "WEB", "Android", "iOS", "SMART_TV")),
        "device": F.struct(
            F.when(event % 13 == 0, "(not set)")
            .when(user % 5 == 0, "smart tv")
            .otherwise("mobile")
            .alias("category"),
            F.when(event % 17 != 0, _text("os", user % 6)).alias("operating_system"),
            F.when(event % 19 == 0, "").otherwise(_choice(user % 2, "en", "fr")).alias("language"),
        ),
        "geo": F.struct(
            F.when(event % 5 == 0, "(not set)").otherwise(_text("N", user % 25)).alias("country"),
            F.when(event % 6 != 0, _text("C", user % 40)).alias("city"),
        ),
        "collected_traffic_source": F.struct(
            _text("id", event % 23).alias("manual_campaign_id"),
            traffic["campaign"].alias("manual_campaign_name"),
            traffic["source"].alias("manual_source"),
            traffic["medium"].alias("manual_medium"),
            F.when(event % 2 == 0, _text("g", event)).alias("gclid"),
        ),
        "event_params": _event_params(),
        "user_properties": _user_properties(),
        "items": F.col("items"),
        "event_date": F.col("event_date"),
    }
    narrow = _base(spark, sf_dir).select(
        "event_id", "user_id", "us", "event_date", "event_name", "bucket", "value", "items"
    )
    # Every seventh event is delivered twice.
    deliveries = F.explode(F.when(event % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    rows = narrow.hint("rebalance", "event_date").select("*", deliveries.alias("delivery"))
    return rows.sortWithinPartitions("event_date").select(*[column.alias(name) for name, column in columns.items()])


def _session_dimensions(user: Column) -> Column:
    def entry(index: int, value) -> Column:
        return F.struct(F.lit(index).cast("long").alias("index"), value.alias("value"))

    return F.array_compact(
        F.array(
            entry(2, _text("X", user % 25)),
            F.when(user % 10 == 0, entry(2, F.lit("DUP"))),
            entry(23, _choice(user % 2, "Website", "App")),
            F.when(user % 5 != 0, entry(24, flags.flag_text(user % 3 == 0))),
        )
    )


def _narrow_hit() -> Column:
    """What the hit of one base row is made of, in the order that hits of a session are sorted by."""
    name = F.col("event_name")
    return F.struct(
        "us",
        "event_id",
        flags.hit_type(name).alias("type"),
        F.when(flags.is_interaction(name), True).alias("isInteraction"),
        flags.is_promotion_view(name).alias("promoIsView"),
        flags.is_promotion_click(name).alias("promoIsClick"),
        "items",
    )


def _hit(narrow: Column) -> dict[str, Column]:
    """The fields of a hit that do not depend on its session."""
    event, items = narrow["event_id"], narrow["items"]

    def numbered(field: str) -> Column:
        return _text(f"{field}_", event % 6).alias(field)

    dimensions = F.array_compact(
        F.array(
            *[
                F.when(
                    (event + index) % 4 != 0,
                    F.struct(F.lit(index).cast("long").alias("index"), _text(f"d{index}_", event % 12).alias("value")),
                )
                for index in rules.HIT_DIMENSIONS
            ],
            *[
                F.when(
                    event % 50 == 7,
                    F.struct(F.lit(index).cast("long").alias("index"), _text("r", event % 3).alias("value")),
                )
                for index in rules.REPEATED_DIMENSIONS
            ],
        )
    )
    promotion = F.transform(
        items, lambda i: F.struct(i["promotion_id"].alias("promoId"), i["promotion_name"].alias("promoName"))
    )
    product = F.transform(
        items,
        lambda i: F.struct(
            i["item_name"].alias("v2ProductName"),
            i["item_list_name"].alias("productListName"),
            i["item_category"].alias("v2ProductCategory"),
        ),
    )
    return {
        "type": narrow["type"],
        "isInteraction": narrow["isInteraction"],
        "page": F.struct(numbered("hostname"), numbered("pageTitle")),
        "appInfo": F.struct(numbered("screenName")),
        "sourcePropertyInfo": F.struct(numbered("sourcePropertyTrackingId"), numbered("sourcePropertyDisplayName")),
        "eventInfo": F.struct(numbered("eventCategory"), numbered("eventAction"), numbered("eventLabel")),
        "promotionActionInfo": F.struct(
            narrow["promoIsView"].alias("promoIsView"), narrow["promoIsClick"].alias("promoIsClick")
        ),
        "promotion": promotion,
        "product": product,
        "customDimensions": dimensions,
    }


def derive_ua_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    def views(name: str) -> Column:
        return F.nullif(F.count(F.when(F.col("event_name") == name, 1)), F.lit(0).cast("long"))

    groups = (
        _base(spark, sf_dir)
        .groupBy("user_id", "bucket")
        .agg(
            F.sort_array(F.collect_list(_narrow_hit())).alias("sorted"),
            F.min("event_date").alias("date"),
            F.min("us").alias("start"),
            F.expr("(max(us) - min(us)) div 1000000").alias("spent"),
            F.count(F.lit(1)).alias("hit_count"),
            views("page_view").alias("pageviews"),
            views("screen_view").alias("screenviews"),
            F.max(F.when(F.col("event_type") == "signup", F.lit(1).cast("long"))).alias("newVisits"),
        )
        .hint("rebalance", "date")
        .sortWithinPartitions("date")
    )
    user, bucket = F.col("user_id"), F.col("bucket")
    traffic = _traffic((user + bucket) % 23)
    # `order` is the zero-based position of the hit.
    hits = F.transform(
        "sorted",
        lambda hit, order: F.struct(
            (order + 1).cast("long").alias("hitNumber"),
            F.floor((hit["us"] - F.col("start")) / 1000).cast("long").alias("time"),
            (order + 1 == F.col("hit_count")).alias("isExit"),
            *[column.alias(name) for name, column in _hit(hit).items()],
        ),
    )
    columns = {
        "fullVisitorId": _text("u", user),
        "visitId": bucket * rules.BUCKET_SECONDS,
        "channelGrouping": _text("ch", (user + bucket) % 7),
        "trafficSource": F.struct(
            _text("id", (user + bucket) % 23).alias("campaignCode"),
            traffic["medium"].alias("medium"),
            traffic["campaign"].alias("campaign"),
            traffic["source"].alias("source"),
        ),
        "device": F.struct(F.when(user % 5 == 0, "smart tv").otherwise("mobile").alias("deviceCategory")),
        "geoNetwork": F.struct(
            _text("N", user % 25).alias("country"),
            _text("ci", user % 40).alias("cityId"),
            _text("C", user % 40).alias("city"),
        ),
        "totals": F.struct(
            F.col("pageviews"),
            F.col("screenviews"),
            F.lit(1).cast("long").alias("visits"),
            F.when(user % 2 == 0, F.col("spent")).alias("timeOnSite"),
            F.col("hit_count").alias("hits"),
            F.col("newVisits"),
            F.when(user % 2 == 1, F.col("spent")).alias("timeOnScreen"),
        ),
        "customDimensions": _session_dimensions(user),
        "hits": hits,
        "date": F.col("date"),
    }
    return groups.select(*[column.alias(name) for name, column in columns.items()]).select(
        *[_as_declared(field) for field in UA_SESSIONS]
    )


def _as_declared(field) -> Column:
    """Cast to the declared type, which also fixes the order of nested fields."""
    if field.name != "hits":
        return F.col(field.name).cast(field.dataType).alias(field.name)
    order = [inner.name for inner in field.dataType.elementType]
    ordered = F.transform(field.name, lambda hit: F.struct(*[hit[name].alias(name) for name in order]))
    return ordered.cast(field.dataType).alias(field.name)


def write_once(spark: SparkSession, sf_dir: str, table: str, write) -> str:
    """Path of a derived table in the shared folder; ``write(path)`` makes it on first use."""
    application = spark.sparkContext.applicationId
    key = (application, sf_dir, table)
    if key not in _written:
        folder = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
        path = f"{shared_folder(spark)}/{application}/{folder}/{table}"
        write(path)
        _written[key] = path
    return _written[key]


def _write_by_day(rows: DataFrame, day_column: str, path: str) -> None:
    """Write rows that are dealt out and sorted by day already."""
    with marts.partitions_of(rows.sparkSession, BYTES_PER_FILE):
        rows.write.mode("overwrite").partitionBy(day_column).parquet(path)


def ga4_path(spark: SparkSession, sf_dir: str) -> str:
    return write_once(
        spark, sf_dir, "ga4_events", lambda path: _write_by_day(derive_ga4_events(spark, sf_dir), "event_date", path)
    )


def ua_path(spark: SparkSession, sf_dir: str) -> str:
    return write_once(
        spark, sf_dir, "ga_sessions", lambda path: _write_by_day(derive_ua_sessions(spark, sf_dir), "date", path)
    )


def ga4(spark: SparkSession, sf_dir: str, day=None) -> DataFrame:
    return exports.ga4_events(spark, ga4_path(spark, sf_dir), day)


def ua(spark: SparkSession, sf_dir: str, day=None) -> DataFrame:
    return exports.ua_sessions(spark, ua_path(spark, sf_dir), day)
