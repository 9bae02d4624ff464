"""GA4 hits: one row per distinct event, in the column layout of the session-based export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.functions import flags
from hitloom.functions.lookups import event_long, event_text, user_text
from hitloom.functions.texts import joined, no_text, null_if
from hitloom.operators.hit_numbers import hit_table, with_hits
from hitloom.operators.visit_keys import HIT_KEY, hit_key, with_visits

# Output column -> event parameter holding its text.
EVENT_TEXTS = {
    "product_name_hostname_15": "link_domain",
    "competition_16": "competition",
    "page_name_17": "page_path",
    "page_name_18": "page_title",
    "screen_name_19": "screen_name",
    "article_master_id_27": "article_master_id",
    "article_child_id_27": "article_child_id",
    "page_type_28": "page_type",
    "event_category": "event_category",
    "event_action": "event_action",
    "Match_ID": "match_id",
    "Match_Name": "match_name",
    "event_label_57": "event_label",
    "videoType_58": "video_type",
    "Team_ID_63": "team_id",
    "video_id_68": "video_id",
    "article_master_name_69": "article_master_title",
    "articleChildName_69": "article_child_title",
    "video_name_70": "video_title",
    "exclusive_promo_id_75": "partners",
}
# Output column -> event parameter holding its text, empty text being NULL.
SECTION_TEXTS = {"content_section_1_85": "content_section_1", "content_section_2_86": "content_section_2"}
# Output column -> user property holding its text.
USER_TEXTS = {"user_news_letter_71": "newsletter_subscriber", "user_team_72": "user_team"}
# Output column -> (item field, item field it is ordered by).
ITEM_TEXTS = {
    "promoId": ("promotion_id", "promotion_id"),
    "promoName": ("promotion_name", "promotion_name"),
    "products_name_75": ("item_name", "item_name"),
    "products_list_name_76": ("item_list_name", "item_name"),
    "products_category_77": ("item_category", "item_name"),
}
# Columns the session-based export has and the event-based one lacks.
ABSENT = (
    "product_name_displayname_15",
    "Source_Property_Tracking_ID_20",
    "hostname_21",
    "Source_Property_Display_Name_22",
)
# Column order of the mart.
LAYOUT = (
    "fullVisitorId",
    "visitId",
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
    "products_name_75",
    "products_list_name_76",
    "products_category_77",
    "content_section_1_85",
    "content_section_2_86",
    "hitNumber",
    "promoIsView",
    "promoIsClick",
    "hit_isInteraction_62",
    "hit_time_60",
    "hit_isExit_61",
    "datedate",
)
ONLY_IN_FULL = ("content_section_1_85", "content_section_2_86", "datedate")
# Column order of the warehouse table, which is the session-based layout plus a date.
TARGET_LAYOUT = (
    "visitId",
    "fullVisitorId",
    "datedate",
    "hitNumber",
    *LAYOUT[2:24],
    "hit_time_60",
    "hit_isExit_61",
    "hit_isInteraction_62",
    *LAYOUT[24:36],
    "promoIsView",
    "promoIsClick",
    *LAYOUT[36:41],
)


def player_id() -> Column:
    return F.coalesce(event_text("player_id"), event_long("player_id").cast("string"))


def video_length() -> Column:
    return F.when(F.col("event_name") == "video_start", event_long("video_duration"))


def event_columns() -> dict[str, Column]:
    """Mart columns read from the event's parameters, properties, items and device."""
    return {
        "product_id_14": F.col("stream_id"),
        **{column: event_text(key) for column, key in EVENT_TEXTS.items()},
        **{column: null_if(event_text(key), "") for column, key in SECTION_TEXTS.items()},
        **{column: user_text(key) for column, key in USER_TEXTS.items()},
        **{column: joined(F.col("items"), field, by) for column, (field, by) in ITEM_TEXTS.items()},
        "language_26": F.upper(event_text("page_language")),
        "TV_Platforms_55": flags.tv_platform(F.col("device")),
        "video_length_73": video_length(),
        "player_id_74": player_id(),
    }


def hit_columns() -> dict[str, Column]:
    """Mart columns that follow from the hit's time, name and place in its visit."""
    name, time = F.col(HIT_KEY)["event_name"], F.col(HIT_KEY)["event_timestamp"]
    return {
        **{column: no_text() for column in ABSENT},
        "hit_type_59": flags.hit_type(name),
        "promoIsView": flags.is_promotion_view(name),
        "promoIsClick": flags.is_promotion_click(name),
        "hit_isInteraction_62": flags.is_interaction(name),
        "hit_time_60": flags.seconds(time - F.col("first_timestamp")),
        "hit_isExit_61": F.col("is_exit"),
        "datedate": flags.utc_date(F.col("first_timestamp")),
    }


def hits(events: DataFrame, full: bool = True) -> DataFrame:
    """The hits mart; ``full=False`` leaves out the content sections and the date.

    Duplicates are removed by ``hit_key`` and the event's columns: hit number, time and all that
    follows from the name are fixed by that key, and removing on the columns of the join needs no
    further shuffle.
    """
    layout = [c for c in LAYOUT if full or c not in ONLY_IN_FULL]
    visited = with_visits(events)
    columns = {name: column for name, column in event_columns().items() if name in layout}
    rows = visited.select(
        "visitId",
        hit_key().alias(HIT_KEY),
        "fullVisitorId",
        *[column.alias(name) for name, column in columns.items()],
    )
    distinct = with_hits(rows, hit_table(visited)).distinct()
    derived = hit_columns()
    return distinct.select(*[derived[name].alias(name) if name in derived else F.col(name) for name in layout])


def target_layout(mart: DataFrame) -> DataFrame:
    """Reorder the full mart, by name, into the column order of the warehouse table."""
    return mart.select(*TARGET_LAYOUT)
