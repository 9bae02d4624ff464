"""Exploding item arrays and keeping the items worth reporting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.functions.texts import without_not_set

# Output name -> item field.
PRODUCT_FIELDS = {
    "products_name": "item_name",
    "products_list_name": "item_list_name",
    "products_category": "item_category",
}
PROMOTION_FIELDS = {"promoId": "promotion_id", "promoName": "promotion_name"}


def explode_items(events: DataFrame, fields: dict[str, str], *kept: str) -> DataFrame:
    """One row per item with the named fields; events without items give no row."""
    # Zipping the fields, instead of exploding whole items, lets the scan read nothing else.
    wanted = F.arrays_zip(*[F.col("items")[field].alias(field) for field in fields.values()])
    rows = events.select(*kept, F.explode(wanted).alias("item"))
    return rows.select(*kept, *[F.col("item")[field].alias(name) for name, field in fields.items()])


def clean_items(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Placeholders become NULL."""
    return rows.withColumns({name: without_not_set(F.col(name)) for name in fields})


def with_any(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Rows on which at least one field is known."""
    return rows.where(F.coalesce(*[F.col(name) for name in fields]).isNotNull())


def with_all(rows: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Rows on which every field is known."""
    return rows.dropna(subset=list(fields))
