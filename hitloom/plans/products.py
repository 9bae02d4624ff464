"""GA4 products and promotions: one row per distinct item of a numbered hit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.functions import flags
from hitloom.operators.hit_numbers import hit_table, with_hits
from hitloom.operators.items import (
    PRODUCT_FIELDS,
    PROMOTION_FIELDS,
    clean_items,
    explode_items,
    with_all,
    with_any,
)
from hitloom.operators.visit_keys import HIT_KEY, hit_key, with_visits

PRODUCT_LAYOUT = ("visitId", "fullVisitorId", *PRODUCT_FIELDS, "hitNumber")
PROMOTION_LAYOUT = ("visitId", "fullVisitorId", "date_5", "promoIsView", "promoIsClick", *PROMOTION_FIELDS, "hitNumber")


def products(events: DataFrame) -> DataFrame:
    """Items with a name, list or category.  Hits are numbered over all events, items or not."""
    visited = with_visits(events)
    keyed = visited.select("visitId", "fullVisitorId", hit_key(complete_only=True).alias(HIT_KEY), "items")
    items = explode_items(keyed, PRODUCT_FIELDS, "visitId", "fullVisitorId", HIT_KEY)
    rows = with_any(clean_items(items, PRODUCT_FIELDS), PRODUCT_FIELDS)
    numbered = with_hits(rows, hit_table(visited).select("visitId", "event_timestamp", "event_name", "hitNumber"))
    return numbered.select(HIT_KEY, *PRODUCT_LAYOUT).distinct().select(*PRODUCT_LAYOUT)


def item_date():
    """Date of an event that has items, else NULL."""
    return F.when(F.size(F.col("items")["promotion_id"]) > 0, flags.event_date(F.col("event_date")))


def promotions(events: DataFrame, with_date: bool = True) -> DataFrame:
    """Promotions seen or clicked, with id and name.

    ``date_5`` is the first day on which the visit had any items.  The restriction to promotion
    events applies only to the rows: numbers and dates come from all events of the visit.
    """
    layout = [c for c in PROMOTION_LAYOUT if with_date or c != "date_5"]
    visited = with_visits(events)
    name = F.col("event_name")
    keyed = visited.where(name.isin(*flags.PROMOTION_EVENTS)).select(
        "visitId",
        "fullVisitorId",
        hit_key().alias(HIT_KEY),
        flags.is_promotion_view(name).alias("promoIsView"),
        flags.is_promotion_click(name).alias("promoIsClick"),
        "items",
    )
    kept = ("visitId", "fullVisitorId", HIT_KEY, "promoIsView", "promoIsClick")
    rows = with_all(clean_items(explode_items(keyed, PROMOTION_FIELDS, *kept), PROMOTION_FIELDS), PROMOTION_FIELDS)
    visit_values = {"date_5": item_date()} if with_date else {}
    numbers = hit_table(visited, **visit_values).drop("is_exit", "first_timestamp")
    return with_hits(rows, numbers).select(HIT_KEY, *layout).distinct().select(*layout)
