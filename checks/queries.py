"""The registered queries: every mart, and every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import exports
from hitloom.functions import catalogue, flags, traffic
from hitloom.functions.lookups import bag_value, event_long, event_text, user_text
from hitloom.functions.texts import clean_text, joined, null_if, without_not_set
from hitloom.operators import hit_numbers, items, visit_metrics
from hitloom.operators.first_touch import first_row, first_touch
from hitloom.operators.visit_keys import HIT_KEY, event_id, hit_key, visit_id, with_visits
from hitloom.plans import daily, hits, products, quality, sessions, shared_day, visits
from hitloom.session import apply_settings
from hitloom.sources import marts

Query = Callable[[SparkSession, str], DataFrame]

DAY = date(2024, 1, 15)
NEXT_DAY = date(2024, 1, 16)
EVENT = ("event_timestamp", "event_name")
VISIT_EVENT = ("visitId", *EVENT)

_on_events: dict[str, Callable[[DataFrame], DataFrame]] = {}
_on_sessions: dict[str, Callable[[DataFrame], DataFrame]] = {}
_on_files: dict[str, Query] = {}


def on_events(make):
    _on_events[make.__name__] = make
    return make


def on_sessions(make):
    _on_sessions[make.__name__] = make
    return make


def on_files(make):
    _on_files[make.__name__] = make
    return make


# --- marts ------------------------------------------------------------------------------------------


_on_events["ga4_hits"] = hits.hits
_on_events["ga4_hits_basic"] = lambda events: hits.hits(events, full=False)
_on_events["ga4_visits_attributed"] = visits.visits_attributed
_on_events["ga4_visits_per_visit"] = lambda events: visits.visits_attributed(events, grain="visit")
_on_events["ga4_visits_basic"] = visits.visits_basic
_on_events["ga4_products"] = products.products
_on_events["ga4_promos"] = products.promotions
_on_events["ga4_promos_basic"] = lambda events: products.promotions(events, with_date=False)
_on_sessions["ua_hits"] = sessions.hits
_on_sessions["ua_visits"] = sessions.visits
_on_sessions["ua_promotions"] = sessions.promotions


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = shared_day.numbered_hits(exports.ga4(spark, sf_dir))
    path = exports.write_once(spark, sf_dir, "numbered_hits", lambda path: numbered.write.mode("overwrite").parquet(path))
    return spark.read.schema(numbered.schema).parquet(path)


@on_files
def shared_day_hits(spark, sf_dir):
    return shared_day.hits(_numbered(spark, sf_dir))


@on_files
def shared_day_products(spark, sf_dir):
    return shared_day.products(_numbered(spark, sf_dir))


@on_files
def shared_day_promos(spark, sf_dir):
    return shared_day.promotions(_numbered(spark, sf_dir))


# --- sources and sinks ------------------------------------------------------------------------------


@on_files
def scan_ga4_day(spark, sf_dir):
    return exports.ga4(spark, sf_dir, DAY).select(*EVENT, "user_pseudo_id", "platform")


@on_files
def scan_ua_day(spark, sf_dir):
    return exports.ua(spark, sf_dir, DAY).select("fullVisitorId", "visitId", "channelGrouping", "date")


@on_files
def csv_roundtrip(spark, sf_dir):
    def write(path):
        marts.export_csv(products.products(exports.ga4(spark, sf_dir)), path)

    path = exports.write_once(spark, sf_dir, "products_csv", write)
    schema = products.products(exports.ga4(spark, sf_dir)).schema
    return marts.load_csv(spark, path, schema)[0]


@on_files
def csv_shards_by_size(spark, sf_dir):
    """The same by shards of 256 KB at most."""

    def write(path):
        marts.export_csv(products.products(exports.ga4(spark, sf_dir)), path, bytes_per_file=256 << 10)

    path = exports.write_once(spark, sf_dir, "products_csv_shards", write)
    schema = products.products(exports.ga4(spark, sf_dir)).schema
    return marts.load_csv(spark, path, schema)[0]


RAW_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
    ]
)


def _untidy_csv(spark: SparkSession, sf_dir: str) -> str:
    """One line per event, in eight kinds of tidiness."""
    lines = [
        "%1$s,%2$s,%3$s,%4$s",
        '%1$s,"%2$s ""q"", x",%3$s,%4$s',
        "%1$s,  %2$s  ,%3$s,%4$s",
        "%1$s,%2$s",
        "%1$s,%2$s,%3$s,%4$s,more,fields",
        "%1$s,%2$s,abc,%4$s",
        '%1$s,"",%3$s,',
        "%1$s,a\\nb,%3$s,%4$s",
    ]

    def write(path):
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
        values = [F.col(c).cast("string") for c in ("event_id", "event_type", "user_id", "value")]
        written = F.lit(None).cast("string")
        for kind, line in enumerate(lines):
            written = F.when(F.col("event_id") % len(lines) == kind, F.format_string(line, *values)).otherwise(written)
        events.select(written.alias("line")).write.mode("overwrite").option("compression", "gzip").text(path)

    return exports.write_once(spark, sf_dir, "untidy_csv", write)


@on_files
def csv_load(spark, sf_dir):
    return marts.load_csv(spark, _untidy_csv(spark, sf_dir), RAW_SCHEMA)[0]


@on_files
def csv_load_rejected(spark, sf_dir):
    return marts.load_csv(spark, _untidy_csv(spark, sf_dir), RAW_SCHEMA)[1].select(*RAW_SCHEMA.names)


@on_files
def csv_rejected_origin(spark, sf_dir):
    """Rejected rows, short ones too, with their reason, and whether file and record are known."""
    rejected = marts.load_csv(spark, _untidy_csv(spark, sf_dir), RAW_SCHEMA, reject_short=True)[1]
    known = F.col("file").endswith(".gz") & (F.col("record") >= 1)
    return rejected.select("event_id", "user_id", "reason", known.alias("origin_known"))


@on_files
def mart_backfill(spark, sf_dir):
    """Three days loaded by one write over an older state; the last has no rows any more."""
    days = [DAY, NEXT_DAY, date(2030, 1, 1)]

    def write(path):
        daily.load_day(spark, "ua_promotions", exports.ua_path(spark, sf_dir), path, DAY)
        old = marts.read_mart(spark, f"{path}/promotions", sessions.promotions(exports.ua(spark, sf_dir)).schema)
        marts.write_mart(old.drop(marts.LOAD_DAY), f"{path}/promotions", days[2])
        daily.backfill(spark, "ua_promotions", exports.ua_path(spark, sf_dir), path, days)

    path = exports.write_once(spark, sf_dir, "promotions_backfill", write)
    return marts.read_mart(spark, f"{path}/promotions", sessions.promotions(exports.ua(spark, sf_dir)).schema)


@on_files
def mart_day_overwrite(spark, sf_dir):
    """Two days; the first is written with other values, then as it is."""
    return _promotion_days(spark, sf_dir, "promotions_mart", lambda mart: mart)


@on_files
def mart_day_emptied(spark, sf_dir):
    """Two days; the first is written with other values, then with no rows."""
    return _promotion_days(spark, sf_dir, "promotions_emptied", lambda mart: mart.where(F.lit(False)))


def _promotion_days(spark, sf_dir, table, rebuilt):
    """The mart is built once, into a table from which all days are written."""
    built = sessions.promotions(exports.ua(spark, sf_dir))
    made = exports.write_once(spark, sf_dir, "promotions_built", lambda path: built.write.mode("overwrite").parquet(path))
    mart = spark.read.schema(built.schema).parquet(made)

    def write(path):
        marts.write_mart(mart.withColumn("promoName", F.lit("before")), path, DAY)
        marts.write_mart(mart, path, NEXT_DAY)
        marts.write_mart(rebuilt(mart), path, DAY)

    return marts.read_mart(spark, exports.write_once(spark, sf_dir, table, write), mart.schema)


@on_files
def csv_day_load(spark, sf_dir):
    """Exported CSV files of products, loaded into their mart in one call."""
    mart = products.products(exports.ga4(spark, sf_dir))

    def write(path):
        marts.export_csv(mart, f"{path}/csv", rows_per_file=5000)
        daily.load_exported_day(
            spark, "ga4_products", f"{path}/csv", mart.schema, f"{path}/marts", f"{path}/quarantine", DAY
        )

    path = exports.write_once(spark, sf_dir, "products_day", write)
    return marts.read_mart(spark, f"{path}/marts/{daily.MARTS['ga4_products'].folder}", mart.schema)


@on_events
def hits_target_projection(events):
    return hits.target_layout(hits.hits(events))


@on_events
def normalised_hits(events):
    return marts.normalise_for_load(hits.hits(events))


# --- projections and filters ------------------------------------------------------------------------


@on_events
def struct_projection(events):
    return events.select(*EVENT, "device.category", "geo.country", "collected_traffic_source.manual_source")


@on_events
def select_except(events):
    return events.drop("device", "geo", "collected_traffic_source", "event_params", "user_properties", "items")


@on_events
def clean_events(events):
    return with_visits(events).select("fullVisitorId", *VISIT_EVENT)


@on_events
def interaction_flag(events):
    return events.select(*EVENT, flags.is_interaction(F.col("event_name")).alias("interaction"))


@on_events
def platform_case(events):
    return events.select(*EVENT, "platform", visits.platform().alias("kind"))


@on_events
def login_flag(events):
    status = user_text("login_status")
    return events.select(
        *EVENT,
        flags.is_logged_in(status).alias("logged_in"),
        flags.is_logged_in(status, flags.LOGGED_IN_OR_ONE).alias("logged_in_or_one"),
    )


@on_events
def explode_items(events):
    rows = with_visits(events).select("visitId", event_id().alias("event_id"), "items")
    return items.explode_items(rows, items.PRODUCT_FIELDS | items.PROMOTION_FIELDS, "visitId", "event_id")


@on_events
def clean_items_any(events):
    return items.with_any(
        items.clean_items(items.explode_items(with_visits(events), items.PRODUCT_FIELDS, "visitId"), items.PRODUCT_FIELDS),
        items.PRODUCT_FIELDS,
    )


@on_events
def clean_promos_all(events):
    fields = items.PROMOTION_FIELDS
    rows = items.explode_items(with_visits(events), fields, "visitId", "event_name")
    return items.with_all(items.clean_items(rows, fields), fields)


@on_events
def promo_event_filter(events):
    """The numbers of promotion events; all events were numbered."""
    numbered = hit_numbers.hit_table(with_visits(events))
    return numbered.where(F.col("event_name").isin(*flags.PROMOTION_EVENTS)).select(*VISIT_EVENT, "hitNumber")


# --- keys and lookups -------------------------------------------------------------------------------


_on_events["visit_id"] = lambda events: events.select(*EVENT, "user_pseudo_id", visit_id().alias("visit"))
_on_events["event_id"] = lambda events: events.select(*EVENT, "user_pseudo_id", event_id().alias("identity"))


@on_events
def get_event_param(events):
    params = F.col("event_params")
    return events.select(
        *EVENT,
        bag_value(params, "page_path")["string_value"].alias("page_path"),
        event_long("video_duration").alias("video_duration"),
        event_text("video_duration").alias("video_duration_text"),
        event_text("no_such_key").alias("missing"),
    )


@on_events
def get_user_property(events):
    return events.select(
        *EVENT,
        user_text("login_status").alias("login_status"),
        user_text("newsletter_subscriber").alias("newsletter"),
        user_text("user_team").alias("team"),
    )


# --- scalar functions -------------------------------------------------------------------------------


def _scalar(name: str, make) -> None:
    _on_events[name] = lambda events: events.select(*EVENT, make().alias("result"))


_scalar("page_language_upper", lambda: F.upper(event_text("page_language")))
_scalar("tv_platform", lambda: flags.tv_platform(F.col("device")))
_scalar("video_length", hits.video_length)
_scalar("hit_type", lambda: flags.hit_type(F.col("event_name")))
_scalar("player_id", hits.player_id)
_scalar("content_section", lambda: null_if(event_text("content_section_1"), ""))
_scalar("not_set_to_null", lambda: without_not_set(F.col("geo.country")))
_scalar("data_cleaning", lambda: clean_text(F.col("device.language")))
_scalar("parse_event_date", lambda: flags.event_date(F.col("event_date")))
_scalar("items_to_string_promo_id", lambda: joined(F.col("items"), "promotion_id"))
_scalar("items_to_string_promo_name", lambda: joined(F.col("items"), "promotion_name"))
_scalar("items_to_string_product_name", lambda: joined(F.col("items"), "item_name"))
_scalar("items_to_string_list_name", lambda: joined(F.col("items"), "item_list_name", "item_name"))
_scalar("items_to_string_category", lambda: joined(F.col("items"), "item_category", "item_name"))
_scalar("effective_medium", lambda: traffic.effective_medium(F.col("collected_traffic_source")))


@on_events
def promo_flags(events):
    name = F.col("event_name")
    return events.select(
        *EVENT, flags.is_promotion_view(name).alias("viewed"), flags.is_promotion_click(name).alias("clicked")
    )


def _traffic_parts():
    source = F.col("collected_traffic_source")
    return traffic.effective_medium(source), source["manual_campaign_name"], source["manual_source"]


@on_events
def create_channel(events):
    medium, campaign, source = _traffic_parts()
    return events.select(
        *EVENT,
        traffic.channel(medium, campaign, source).alias("channel"),
        traffic.channel(medium, F.lower(campaign), F.lower(source)).alias("lower_channel"),
    )


@on_events
def channel_grouping(events):
    return events.select(*EVENT, traffic.channel_group(traffic.channel(*_traffic_parts())).alias("channel_group"))


@on_events
def channel_null_guard(events):
    return events.select(*EVENT, traffic.channel_group_or_null(*_traffic_parts()).alias("channel_group"))


def _quoted(texts) -> str:
    return ", ".join(f"'{text}'" for text in texts)


#: The basic visits mart as a user writes it in SQL, calling the functions by name.
VISITS_SQL = f"""
WITH named AS (
    SELECT *, concat(user_pseudo_id, get_event('ga_session_id', event_params).int_value) AS visitId,
        lower(collected_traffic_source.manual_medium) AS medium
    FROM {{events}} WHERE user_pseudo_id IS NOT NULL
),
visited AS (SELECT * FROM named WHERE visitId IS NOT NULL),
first_events AS (
    SELECT visitId, min(struct(
        event_timestamp, event_name, user_pseudo_id AS fullVisitorId, to_date(event_date, 'yyyyMMdd') AS date_5,
        CASE WHEN lower(platform) = 'web' THEN 'Website' WHEN lower(platform) IN ('android', 'ios') THEN 'App' END
            AS platform_id_10,
        collected_traffic_source.manual_campaign_id AS acq_channel_id_12, device.category AS device_category_24,
        geo.country AS country_name_30, get_event('country', event_params).string_value AS country_code_uefa_30,
        CASE WHEN lower(collected_traffic_source.manual_source) = 'google' AND medium = 'organic'
            AND collected_traffic_source.gclid IS NOT NULL THEN 'cpc' ELSE medium END AS Custom_Acq_Channel_Name,
        collected_traffic_source.manual_campaign_name AS Campaign_56,
        collected_traffic_source.manual_source AS Traffic_Source_62, geo.city AS City_Name_65
    )) AS first
    FROM visited GROUP BY visitId
),
events AS (
    SELECT visitId, event_timestamp, event_name, event_timestamp IS NOT NULL AND event_name IS NOT NULL AS complete,
        max(coalesce(lower(get_user('login_status', user_properties).string_value) IN ({_quoted(flags.LOGGED_IN)}),
            FALSE)) AS logged_in
    FROM visited GROUP BY visitId, event_timestamp, event_name
),
metrics AS (
    SELECT visitId, (max(event_timestamp) - min(event_timestamp)) / 1000000 AS duration, count_if(complete) AS hits,
        max(coalesce(event_name IN ({_quoted(flags.FIRST_EVENTS)}), FALSE)) AS newVisits,
        count_if(complete AND event_name = 'page_view') AS pageviews_44,
        count_if(complete AND event_name = 'screen_view') AS screenviews_44, max(logged_in) AS nbr_loggedin_user_46,
        CAST(max(coalesce(event_name NOT IN ({_quoted(flags.PASSIVE_EVENTS)}), FALSE)) AS BIGINT) AS total_visit_51
    FROM events GROUP BY visitId
)
SELECT first.fullVisitorId, visitId, first.date_5, first.platform_id_10, first.acq_channel_id_12,
    channel_grouping(create_channel(
        first.Custom_Acq_Channel_Name, lower(first.Campaign_56), lower(first.Traffic_Source_62))) AS channel_name_13,
    first.device_category_24, first.country_name_30, first.country_code_uefa_30, first.Custom_Acq_Channel_Name,
    first.Campaign_56, first.Traffic_Source_62, first.City_Name_65, CAST(NULL AS STRING) AS City_ID_64, hits, newVisits,
    pageviews_44, screenviews_44, nbr_loggedin_user_46, total_visit_51,
    CASE WHEN first.platform_id_10 = 'Website' THEN duration END AS timeonesite,
    CASE WHEN first.platform_id_10 = 'App' THEN duration END AS timeOnScreen
FROM first_events JOIN metrics USING (visitId)
"""


@on_events
def sql_functions(events):
    """A whole mart from SQL text that calls the registered functions."""
    spark = events.sparkSession
    catalogue.register(spark)
    return spark.sql(VISITS_SQL, events=events)


# --- hit numbers ------------------------------------------------------------------------------------


def _hit_table(events: DataFrame) -> DataFrame:
    return hit_numbers.hit_table(with_visits(events))


@on_events
def distinct_rows(events):
    return events.select(*EVENT, "user_pseudo_id", "platform").distinct()


@on_events
def event_dedup(events):
    return hit_numbers.distinct_events(with_visits(events)).drop("copies")


@on_events
def hit_number(events):
    return _hit_table(events).select(*VISIT_EVENT, "hitNumber")


@on_events
def hit_number_join(events):
    visited = with_visits(events)
    rows = visited.select("visitId", hit_key(complete_only=True).alias(HIT_KEY), event_id().alias("identity"))
    return hit_numbers.with_hits(rows, hit_numbers.hit_table(visited)).select("visitId", "identity", "hitNumber")


@on_events
def session_first_ts(events):
    return _hit_table(events).select(*VISIT_EVENT, "first_timestamp")


@on_events
def hit_is_exit(events):
    return _hit_table(events).select(*VISIT_EVENT, "is_exit")


@on_events
def hit_time(events):
    elapsed = flags.seconds(F.col("event_timestamp") - F.col("first_timestamp"))
    return _hit_table(events).select(*VISIT_EVENT, elapsed.alias("hit_seconds"))


@on_events
def session_utc_date(events):
    return _hit_table(events).select(*VISIT_EVENT, flags.utc_date(F.col("first_timestamp")).alias("first_day"))


@on_events
def promo_min_date(events):
    first_days = hit_numbers.hit_table(with_visits(events), date_5=products.item_date())
    return first_days.select("visitId", "date_5").where(F.col("date_5").isNotNull()).distinct()


# --- visits -----------------------------------------------------------------------------------------


def _metrics(events: DataFrame, *columns) -> DataFrame:
    return visit_metrics.visit_metrics(with_visits(events)).select("visitId", *columns)


@on_events
def session_metrics(events):
    return _metrics(events, "duration", "hits", "new_visit", "pageviews", "screenviews", "logged_in", "active")


_on_events["session_duration"] = lambda events: _metrics(events, "duration")
_on_events["session_hits"] = lambda events: _metrics(events, "hits")
_on_events["conditional_count_distinct"] = lambda events: _metrics(events, "pageviews", "screenviews")
_on_events["total_visit"] = lambda events: _metrics(events, "active")


@on_events
def any_flag(events):
    return _metrics(events, F.col("new_visit").cast("boolean"), F.col("logged_in").cast("boolean"))


def _metrics_by_time(events: DataFrame) -> DataFrame:
    return visit_metrics.visit_metrics(with_visits(events), flags.LOGGED_IN_OR_ONE)


@on_events
def windowed_count_distinct(events):
    return _metrics_by_time(events).select("visitId", "pageviews", "screenviews", "hits")


@on_events
def windowed_flags(events):
    return _metrics_by_time(events).select(
        "visitId", "new_visit", "active", F.col("logged_in").cast("boolean").alias("logged_in")
    )


@on_events
def login_text(events):
    return _metrics_by_time(events).select("visitId", flags.flag_text(F.col("logged_in") == 1).alias("logged_in"))


@on_events
def time_on_site_screen(events):
    return visits.visits_basic(events).select("visitId", "platform_id_10", "timeonesite", "timeOnScreen")


@on_events
def array_agg_first_row(events):
    values = {"platform": F.col("platform"), "country": F.col("geo.country"), "city": F.col("geo.city")}
    return first_row(with_visits(events), values)


@on_events
def session_metrics_join(events):
    visited = with_visits(events)
    first = first_row(visited, {"platform": F.col("platform")})
    return first.join(visit_metrics.visit_metrics(visited), "visitId", "left").select(
        "visitId", "platform", "duration", "hits"
    )


@on_events
def session_min_date(events):
    first_day = F.min(flags.event_date(F.col("event_date"))).alias("date_5")
    return with_visits(events).groupBy("visitId").agg(first_day)


_on_events["first_touch_platform"] = lambda events: first_touch(with_visits(events), {"t": visits.platform_touch()})
_on_events["first_touch_traffic"] = lambda events: first_touch(with_visits(events), {"t": visits.traffic_touch()})
_on_events["first_touch_geo"] = lambda events: first_touch(with_visits(events), {"t": visits.geo_touch()})
_on_events["first_touch_device"] = lambda events: first_touch(with_visits(events), {"t": visits.device_touch()})


@on_events
def mart_dq_summary(events):
    return quality.summary(hits.hits(events), ["visitId", "hitNumber"])


@on_events
def largest_visits_dq(events):
    return quality.summary(events.select("user_pseudo_id", visit_id().alias("visitId")), ["visitId"])


# --- session-based export ---------------------------------------------------------------------------


@on_sessions
def ua_explode_hits(rows):
    hit = F.col("hit")
    return sessions.explode_hits(rows, "hitNumber", "type").select(
        "visitId", "fullVisitorId", hit["hitNumber"].alias("hitNumber"), hit["type"].alias("type")
    )


@on_sessions
def ua_custom_dims_hits(rows):
    return sessions.hits(rows).select("visitId", "fullVisitorId", "hitNumber", *sessions.HIT_DIMENSIONS).distinct()


@on_sessions
def ua_custom_dims_session(rows):
    return sessions.visits(rows).select("visitId", "fullVisitorId", *sessions.SESSION_DIMENSIONS)


@on_sessions
def ua_items_to_string(rows):
    hit = F.col("hit")
    return sessions.explode_hits(rows).select(
        "visitId",
        "fullVisitorId",
        hit["hitNumber"].alias("hitNumber"),
        *[
            joined(hit[array], field, by, drop_not_set=False).alias(name)
            for name, (array, field, by) in sessions.HIT_LISTS.items()
        ],
    )


# --- registry ---------------------------------------------------------------------------------------


def _event_query(make) -> Query:
    return lambda spark, sf_dir: make(exports.ga4(apply_settings(spark), sf_dir))


def _session_query(make) -> Query:
    return lambda spark, sf_dir: make(exports.ua(apply_settings(spark), sf_dir))


def _file_query(make) -> Query:
    return lambda spark, sf_dir: make(apply_settings(spark), sf_dir)


def all_queries() -> dict[str, Query]:
    return {
        **{name: _event_query(make) for name, make in _on_events.items()},
        **{name: _session_query(make) for name, make in _on_sessions.items()},
        **{name: _file_query(make) for name, make in _on_files.items()},
    }
