"""GA4 visits, attributed per attribute group or from the visit's first event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.functions import flags, traffic
from hitloom.functions.lookups import event_long, event_text
from hitloom.functions.texts import clean_text, no_text
from hitloom.operators.first_touch import TouchGroup, first_row, first_touch
from hitloom.operators.visit_keys import with_visits
from hitloom.operators.visit_metrics import visit_metrics

# Column order of the two marts.
ATTRIBUTED_LAYOUT = (
    "fullVisitorId",
    "visitId",
    "City_ID_64",
    "Gigya_Id_88",
    "engagement_time",
    "date_5",
    "platform_id_10",
    "acq_channel_id_12",
    "Campaign_56",
    "Traffic_Source_62",
    "Custom_Acq_Channel_Name",
    "country_name_30",
    "country_code_uefa_30",
    "City_Name_65",
    "device_category_24",
    "Device_Language_87",
    "operatingSystemVersion",
    "newVisits",
    "pageviews_44",
    "screenviews_44",
    "total_visit_51",
    "is_login",
    "hits",
    "nbr_loggedin_user_46",
    "timeonesite",
    "timeOnScreen",
    "channel_name_13",
)
BASIC_LAYOUT = (
    "fullVisitorId",
    "visitId",
    "date_5",
    "platform_id_10",
    "acq_channel_id_12",
    "channel_name_13",
    "device_category_24",
    "country_name_30",
    "country_code_uefa_30",
    "Custom_Acq_Channel_Name",
    "Campaign_56",
    "Traffic_Source_62",
    "City_Name_65",
    "City_ID_64",
    "hits",
    "newVisits",
    "pageviews_44",
    "screenviews_44",
    "nbr_loggedin_user_46",
    "total_visit_51",
    "timeonesite",
    "timeOnScreen",
)


def platform() -> Column:
    return flags.site_or_app(F.col("platform"))


def platform_touch() -> TouchGroup:
    return TouchGroup([platform()], {"platform_id_10": platform()})


def traffic_touch() -> TouchGroup:
    """Campaign id and name come along but need not be known."""
    source = F.col("collected_traffic_source")
    medium = traffic.effective_medium(source)
    return TouchGroup(
        [source["manual_source"], medium],
        {
            "acq_channel_id_12": source["manual_campaign_id"],
            "Campaign_56": source["manual_campaign_name"],
            "Traffic_Source_62": source["manual_source"],
            "Custom_Acq_Channel_Name": medium,
        },
    )


def _all_required(values: dict[str, Column]) -> TouchGroup:
    return TouchGroup(list(values.values()), values)


def geo_touch(clean=clean_text) -> TouchGroup:
    return _all_required(
        {
            "country_name_30": clean(F.col("geo.country")),
            "country_code_uefa_30": clean(event_text("country")),
            "City_Name_65": clean(F.col("geo.city")),
        }
    )


def device_touch(clean=clean_text) -> TouchGroup:
    return _all_required(
        {
            "device_category_24": clean(F.col("device.category")),
            "Device_Language_87": clean(F.col("device.language")),
            "operatingSystemVersion": clean(F.col("device.operating_system")),
        }
    )


def touch_groups(clean=clean_text) -> dict[str, TouchGroup]:
    return {
        "platform": platform_touch(),
        "traffic": traffic_touch(),
        "geo": geo_touch(clean),
        "device": device_touch(clean),
    }


def _with_durations(visits: DataFrame) -> DataFrame:
    """The duration counts as time on site for websites and as time on screen for apps."""
    kind, duration = F.col("platform_id_10"), F.col("duration")
    return visits.withColumns(
        {
            "timeonesite": flags.only_on(kind, "Website", duration),
            "timeOnScreen": flags.only_on(kind, "App", duration),
        }
    )


def visits_attributed(events: DataFrame, grain: str = "engagement", clean=clean_text) -> DataFrame:
    """Visits with first-touch attribution.

    With the default grain a visit has one row per distinct engagement time; ``grain='visit'`` gives
    one row per visitor and visit and leaves that column out.  ``clean`` is applied to the geo and
    device texts before they are tested for completeness.
    """
    if grain not in ("engagement", "visit"):
        raise ValueError(f"unknown grain: {grain}")
    visited = with_visits(events)
    first_day = F.min(flags.event_date(F.col("event_date"))).alias("date_5")
    attributes = first_touch(visited, touch_groups(clean), first_day)
    metrics = visit_metrics(visited, flags.LOGGED_IN_OR_ONE)
    medium, campaign, source = "Custom_Acq_Channel_Name", "Campaign_56", "Traffic_Source_62"
    visits = _with_durations(attributes.join(metrics, "visitId")).select(
        "*",
        no_text().alias("City_ID_64"),
        no_text().alias("Gigya_Id_88"),
        F.col("new_visit").alias("newVisits"),
        F.col("pageviews").alias("pageviews_44"),
        F.col("screenviews").alias("screenviews_44"),
        F.col("active").alias("total_visit_51"),
        F.col("logged_in").cast("boolean").alias("is_login"),
        flags.flag_text(F.col("logged_in") == 1).alias("nbr_loggedin_user_46"),
        traffic.channel_group_or_null(F.col(medium), F.col(campaign), F.col(source)).alias("channel_name_13"),
    )
    keys = {"fullVisitorId": F.col("fullVisitorId"), "visitId": F.col("visitId")}
    if grain == "engagement":
        keys["engagement_time"] = event_long("engagement_time_msec")
    grains = visited.select(*[column.alias(key) for key, column in keys.items()]).distinct()
    layout = [c for c in ATTRIBUTED_LAYOUT if c in keys or c != "engagement_time"]
    return grains.join(visits, "visitId").select(*layout)


def visits_basic(events: DataFrame) -> DataFrame:
    """One row per visit, with the attributes of the visit's first event as they are."""
    visited = with_visits(events)
    source = F.col("collected_traffic_source")
    attributes = first_row(
        visited,
        {
            "fullVisitorId": F.col("fullVisitorId"),
            "date_5": flags.event_date(F.col("event_date")),
            "platform_id_10": platform(),
            "acq_channel_id_12": source["manual_campaign_id"],
            "device_category_24": F.col("device.category"),
            "country_name_30": F.col("geo.country"),
            "country_code_uefa_30": event_text("country"),
            "Custom_Acq_Channel_Name": traffic.effective_medium(source),
            "Campaign_56": source["manual_campaign_name"],
            "Traffic_Source_62": source["manual_source"],
            "City_Name_65": F.col("geo.city"),
        },
    )
    # The channel depends on the chosen event alone, so it is found once per visit.
    name = traffic.channel_group(
        traffic.channel(
            F.col("Custom_Acq_Channel_Name"), F.lower("Campaign_56"), F.lower("Traffic_Source_62")
        )
    )
    visits = attributes.join(visit_metrics(visited), "visitId", "left")
    return _with_durations(visits).select(
        "*",
        name.alias("channel_name_13"),
        no_text().alias("City_ID_64"),
        F.col("new_visit").cast("boolean").alias("newVisits"),
        F.col("pageviews").alias("pageviews_44"),
        F.col("screenviews").alias("screenviews_44"),
        F.col("logged_in").cast("boolean").alias("nbr_loggedin_user_46"),
        F.col("active").alias("total_visit_51"),
    ).select(*BASIC_LAYOUT)
