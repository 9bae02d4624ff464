"""The event-based marts of one day from one table of numbered hits.

Built one by one, each mart scans the events twice and numbers the hits again.  Here the numbers are
found once, and one join gives a table with a row per distinct hit: all columns of the hits mart, and
the item arrays of the events that became this row.  Its rows are grouped on the partitioning of the
join, so grouping needs no further shuffle, and the hits mart is then a plain selection.  Products and
promotions explode the arrays they need; they read neither the wide columns nor the export again.
"""

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
from hitloom.plans import hits as hit_plan
from hitloom.plans import products as item_plan

VISIT_VALUES = ("hitNumber", "is_exit", "first_timestamp", "date_5")
ITEM_ARRAYS = "item_arrays"


def numbered_hits(events: DataFrame) -> DataFrame:
    """One row per row of the hits mart, with its key, number, visit values and distinct item arrays.

    Events that differ in their items only by order are one hit; ``item_arrays`` holds each variant.
    The first day with items is that of the visit.  The export is scanned twice: once for the narrow
    keys, once for the rows.  Texts made of the items follow the join, so that items are shuffled once.
    """
    visited = with_visits(events)
    columns = hit_plan.event_columns()
    own = [column.alias(name) for name, column in columns.items() if name not in hit_plan.ITEM_TEXTS]
    rows = visited.select("visitId", hit_key().alias(HIT_KEY), "fullVisitorId", *own, "items")
    joined = with_hits(rows, hit_table(visited, date_5=item_plan.item_date()))
    joined = joined.withColumns({name: columns[name] for name in hit_plan.ITEM_TEXTS})
    keys = ["visitId", HIT_KEY, "fullVisitorId", *columns, *VISIT_VALUES]
    return joined.groupBy(*keys).agg(F.collect_set("items").alias(ITEM_ARRAYS))


def hits(numbered: DataFrame) -> DataFrame:
    """The hits mart."""
    derived = hit_plan.hit_columns()
    return numbered.select(*[derived[n].alias(n) if n in derived else F.col(n) for n in hit_plan.LAYOUT])


def _items(numbered: DataFrame, fields: dict[str, str], *kept) -> DataFrame:
    rows = numbered.select(*kept, F.explode(ITEM_ARRAYS).alias("items"))
    names = [column if isinstance(column, str) else rows.columns[i] for i, column in enumerate(kept)]
    return clean_items(explode_items(rows, fields, *names), fields)


def products(numbered: DataFrame) -> DataFrame:
    """The products mart."""
    rows = _items(numbered, PRODUCT_FIELDS, "visitId", "fullVisitorId", "hitNumber")
    return with_any(rows, PRODUCT_FIELDS).select(*item_plan.PRODUCT_LAYOUT).distinct()


def promotions(numbered: DataFrame) -> DataFrame:
    """The promotions mart."""
    name = F.col(HIT_KEY)["event_name"]
    shown = numbered.where(name.isin(*flags.PROMOTION_EVENTS))
    kept = (
        "visitId",
        "fullVisitorId",
        "date_5",
        flags.is_promotion_view(name).alias("promoIsView"),
        flags.is_promotion_click(name).alias("promoIsClick"),
        "hitNumber",
    )
    rows = _items(shown, PROMOTION_FIELDS, *kept)
    return with_all(rows, PROMOTION_FIELDS).select(*item_plan.PROMOTION_LAYOUT).distinct()
