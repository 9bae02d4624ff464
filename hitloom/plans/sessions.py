"""Hits, visits and promotions of the session-based (UA) export, whose rows nest their hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.functions.lookups import dimension, dimension_values, explode_repeats
from hitloom.functions.texts import joined

# Output column -> custom dimension of the hit.
HIT_DIMENSIONS = {
    "language_26": 1,
    "page_type_28": 4,
    "competition_16": 10,
    "page_name_17": 14,
    "user_news_letter_71": 25,
    "user_team_72": 30,
    "video_name_70": 35,
    "video_id_68": 36,
    "video_length_73": 37,
    "article_master_id_27": 39,
    "article_master_name_69": 40,
    "article_child_id_27": 41,
    "articleChildName_69": 42,
    "Match_ID": 43,
    "Match_Name": 44,
    "player_id_74": 51,
    "Team_ID_63": 53,
    "exclusive_promo_id_75": 56,
    "videoType_58": 105,
    "TV_Platforms_55": 106,
}
# Output column -> custom dimension of the session.
SESSION_DIMENSIONS = {"country_code_uefa_30": 2, "platform_id_10": 23, "nbr_loggedin_user_46": 24}
# Output column -> field of the hit.
HIT_FIELDS = {
    "hitNumber": "hitNumber",
    "product_id_14": "sourcePropertyInfo.sourcePropertyTrackingId",
    "product_name_displayname_15": "sourcePropertyInfo.sourcePropertyDisplayName",
    "product_name_hostname_15": "page.hostname",
    "page_name_18": "page.pageTitle",
    "screen_name_19": "appInfo.screenName",
    "event_category": "eventInfo.eventCategory",
    "event_action": "eventInfo.eventAction",
    "event_label_57": "eventInfo.eventLabel",
    "hit_type_59": "type",
    "hit_time_60": "time",
    "hit_isExit_61": "isExit",
    "hit_isInteraction_62": "isInteraction",
    "promoIsView": "promotionActionInfo.promoIsView",
    "promoIsClick": "promotionActionInfo.promoIsClick",
}
# Output column -> other output column it repeats.
REPEATED_FIELDS = {
    "Source_Property_Tracking_ID_20": "product_id_14",
    "hostname_21": "product_name_hostname_15",
    "Source_Property_Display_Name_22": "product_name_displayname_15",
}
# Output column -> (nested array, field, field it is ordered by).
HIT_LISTS = {
    "promoId": ("promotion", "promoId", "promoId"),
    "promoName": ("promotion", "promoName", "promoId"),
    "products_name_75": ("product", "v2ProductName", "v2ProductName"),
    "products_list_name_76": ("product", "productListName", "v2ProductName"),
    "products_category_77": ("product", "v2ProductCategory", "v2ProductName"),
}
# Output column -> field of the session.
SESSION_FIELDS = {
    "fullVisitorId": "fullVisitorId",
    "visitId": "visitId",
    "date_5": "date",
    "acq_channel_id_12": "trafficSource.campaignCode",
    "channel_name_13": "channelGrouping",
    "device_category_24": "device.deviceCategory",
    "country_name_30": "geoNetwork.country",
    "pageviews_44": "totals.pageviews",
    "screenviews_44": "totals.screenviews",
    "total_visit_51": "totals.visits",
    "timeonesite": "totals.timeOnSite",
    "hits": "totals.hits",
    "newVisits": "totals.newVisits",
    "timeOnScreen": "totals.timeOnScreen",
    "Custom_Acq_Channel_Name": "trafficSource.medium",
    "Campaign_56": "trafficSource.campaign",
    "Traffic_Source_62": "trafficSource.source",
    "City_ID_64": "geoNetwork.cityId",
    "City_Name_65": "geoNetwork.city",
}
# Column order of the marts.
HIT_LAYOUT = (
    "visitId",
    "fullVisitorId",
    "hitNumber",
    "product_id_14",
    "product_name_displayname_15",
    "product_name_hostname_15",
    "competition_16",
    "page_name_17",
    "page_name_18",
    "screen_name_19",
    "Source_Property_Tracking_ID_20",
    "hostname_21",
    "Source_Property_Display_Name_22",
    "language_26",
    "article_master_id_27",
    "article_child_id_27",
    "page_type_28",
    "event_category",
    "event_action",
    "TV_Platforms_55",
    "Match_ID",
    "Match_Name",
    "event_label_57",
    "videoType_58",
    "hit_type_59",
    "hit_time_60",
    "hit_isExit_61",
    "hit_isInteraction_62",
    "Team_ID_63",
    "video_id_68",
    "article_master_name_69",
    "articleChildName_69",
    "video_name_70",
    "user_news_letter_71",
    "user_team_72",
    "video_length_73",
    "player_id_74",
    "exclusive_promo_id_75",
    "promoId",
    "promoName",
    "promoIsView",
    "promoIsClick",
    "products_name_75",
    "products_list_name_76",
    "products_category_77",
)
VISIT_LAYOUT = (
    "fullVisitorId",
    "visitId",
    "date_5",
    "platform_id_10",
    "acq_channel_id_12",
    "channel_name_13",
    "device_category_24",
    "country_name_30",
    "country_code_uefa_30",
    "pageviews_44",
    "screenviews_44",
    "nbr_loggedin_user_46",
    "total_visit_51",
    "timeonesite",
    "hits",
    "newVisits",
    "timeOnScreen",
    "Custom_Acq_Channel_Name",
    "Campaign_56",
    "Traffic_Source_62",
    "City_ID_64",
    "City_Name_65",
)
PROMOTION_LAYOUT = ("visitId", "fullVisitorId", "hitNumber", "promoId", "promoName", "promoIsView", "promoIsClick")


def explode_hits(sessions: DataFrame, *fields: str) -> DataFrame:
    """One row per hit, with the keys of its session; sessions without hits give no row.

    With ``fields``, only those of the hit are kept, and read.
    """
    hits = F.col("hits")
    wanted = F.arrays_zip(*[hits[field].alias(field) for field in fields]) if fields else hits
    return sessions.select("visitId", "fullVisitorId", F.explode(wanted).alias("hit"))


def explode_dimension(rows: DataFrame, entries: Column, name: str, index: int) -> DataFrame:
    """Add the dimension's value as ``name``: one row per entry with that index, or one with NULL."""
    return rows.select("*", F.explode_outer(dimension_values(entries, index)).alias(name))


def _field(parent: Column | None, path: str) -> Column:
    if parent is None:
        return F.col(path)
    for part in path.split("."):
        parent = parent[part]
    return parent


def hits(sessions: DataFrame) -> DataFrame:
    """The hits mart, without duplicate rows.

    A custom dimension given more than once in a hit gives a row per value.
    """
    hit = F.col("hit")
    fields = {
        **{name: _field(hit, path) for name, path in HIT_FIELDS.items()},
        **{
            name: joined(hit[array], field, by, drop_not_set=False)
            for name, (array, field, by) in HIT_LISTS.items()
        },
    }
    rows = explode_hits(sessions).select(
        "visitId",
        "fullVisitorId",
        *[column.alias(name) for name, column in fields.items()],
        hit["customDimensions"].alias("dimensions"),
    )
    chosen = explode_repeats(rows, F.col("dimensions"), list(HIT_DIMENSIONS.values()))
    dimensions = [dimension(F.col("chosen"), index).alias(name) for name, index in HIT_DIMENSIONS.items()]
    distinct = chosen.select("visitId", "fullVisitorId", *fields, *dimensions).distinct()
    return distinct.select(*[F.col(REPEATED_FIELDS.get(name, name)).alias(name) for name in HIT_LAYOUT])


def visits(sessions: DataFrame) -> DataFrame:
    """The visits mart: a bag with one row per session and combination of repeated dimensions."""
    columns = [_field(None, path).alias(name) for name, path in SESSION_FIELDS.items()]
    rows = sessions.select(*columns, F.col("customDimensions").alias("dimensions"))
    for name, index in SESSION_DIMENSIONS.items():
        rows = explode_dimension(rows, F.col("dimensions"), name, index)
    return rows.select(*VISIT_LAYOUT)


def promotions(sessions: DataFrame) -> DataFrame:
    """The promotions mart: distinct promotions of every hit that has any."""
    hit, shown = F.col("hit"), F.col("shown")
    rows = explode_hits(sessions, "hitNumber", "promotionActionInfo", "promotion").select(
        "visitId",
        "fullVisitorId",
        hit["hitNumber"].alias("hitNumber"),
        hit["promotionActionInfo"].alias("action"),
        F.explode(hit["promotion"]).alias("shown"),
    )
    return rows.select(
        "visitId",
        "fullVisitorId",
        "hitNumber",
        shown["promoId"].alias("promoId"),
        shown["promoName"].alias("promoName"),
        F.col("action.promoIsView").alias("promoIsView"),
        F.col("action.promoIsClick").alias("promoIsClick"),
    ).distinct()
