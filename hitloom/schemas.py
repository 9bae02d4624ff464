"""Schemas of the two nested export tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.LongType()) for name in names]


def _rows_of(*fields: T.StructField) -> T.ArrayType:
    return T.ArrayType(T.StructType(list(fields)))


def _bag(*extra: T.StructField) -> T.ArrayType:
    """Key/value entries whose value holds one of several typed slots."""
    value = T.StructType(
        [
            T.StructField("string_value", T.StringType()),
            T.StructField("int_value", T.LongType()),
            T.StructField("float_value", T.DoubleType()),
            T.StructField("double_value", T.DoubleType()),
            *extra,
        ]
    )
    return _rows_of(T.StructField("key", T.StringType()), T.StructField("value", value))


EVENT_PARAMS = _bag()
USER_PROPERTIES = _bag(T.StructField("set_timestamp_micros", T.LongType()))
ITEMS = _rows_of(*_strings("item_name", "item_list_name", "item_category", "promotion_id", "promotion_name"))
DIMENSIONS = _rows_of(T.StructField("index", T.LongType()), T.StructField("value", T.StringType()))

# One row per event.  ``event_timestamp`` is micros since the epoch, UTC, and always present.
GA4_EVENTS = T.StructType(
    [
        T.StructField("event_timestamp", T.LongType()),
        *_strings("event_name", "user_pseudo_id", "stream_id", "platform"),
        T.StructField("device", T.StructType(_strings("category", "operating_system", "language"))),
        T.StructField("geo", T.StructType(_strings("country", "city"))),
        T.StructField(
            "collected_traffic_source",
            T.StructType(
                _strings("manual_campaign_id", "manual_campaign_name", "manual_source", "manual_medium", "gclid")
            ),
        ),
        T.StructField("event_params", EVENT_PARAMS),
        T.StructField("user_properties", USER_PROPERTIES),
        T.StructField("items", ITEMS),
        T.StructField("event_date", T.StringType()),
    ]
)

UA_HIT = T.StructType(
    [
        *_longs("hitNumber", "time"),
        *_strings("type"),
        T.StructField("isExit", T.BooleanType()),
        T.StructField("isInteraction", T.BooleanType()),
        T.StructField("page", T.StructType(_strings("hostname", "pageTitle"))),
        T.StructField("appInfo", T.StructType(_strings("screenName"))),
        T.StructField(
            "sourcePropertyInfo", T.StructType(_strings("sourcePropertyTrackingId", "sourcePropertyDisplayName"))
        ),
        T.StructField("eventInfo", T.StructType(_strings("eventCategory", "eventAction", "eventLabel"))),
        T.StructField(
            "promotionActionInfo",
            T.StructType(
                [T.StructField("promoIsView", T.BooleanType()), T.StructField("promoIsClick", T.BooleanType())]
            ),
        ),
        T.StructField("promotion", _rows_of(*_strings("promoId", "promoName"))),
        T.StructField("product", _rows_of(*_strings("v2ProductName", "productListName", "v2ProductCategory"))),
        T.StructField("customDimensions", DIMENSIONS),
    ]
)

# One row per session, with its hits nested.
UA_SESSIONS = T.StructType(
    [
        *_strings("fullVisitorId"),
        *_longs("visitId"),
        *_strings("channelGrouping"),
        T.StructField("trafficSource", T.StructType(_strings("campaignCode", "medium", "campaign", "source"))),
        T.StructField("device", T.StructType(_strings("deviceCategory"))),
        T.StructField("geoNetwork", T.StructType(_strings("country", "cityId", "city"))),
        T.StructField(
            "totals",
            T.StructType(
                _longs("pageviews", "screenviews", "visits", "timeOnSite", "hits", "newVisits", "timeOnScreen")
            ),
        ),
        T.StructField("customDimensions", DIMENSIONS),
        T.StructField("hits", T.ArrayType(UA_HIT)),
        T.StructField("date", T.StringType()),
    ]
)
