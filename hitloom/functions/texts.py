"""Cleaning of text values and flattening of item arrays to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_SET = "(not set)"


def no_text() -> Column:
    """A text column without a value."""
    return F.lit(None).cast("string")


def null_if(value: Column, text: str) -> Column:
    """NULL instead of ``text``.

    A plain condition: ``nullif`` is planned as a shared sub-expression with a projection of its own,
    which keeps a scan from being pruned to the fields a lookup reads.
    """
    return F.when(value != text, value)


def without_not_set(value: Column) -> Column:
    return null_if(value, NOT_SET)


def clean_text(value: Column) -> Column:
    """Placeholder and empty text become NULL, so that completeness tests need only look for NULL."""
    return F.when((value != NOT_SET) & (value != ""), value)


def joined(items: Column, field: str, order_by: str | None = None, drop_not_set: bool = True) -> Column:
    """Comma-joined ``field`` of an array of structs, ordered by ``order_by`` (default: the field).

    NULL values are skipped; a NULL or empty array gives ''.  NULL order keys come first and ties
    are ordered by the value, which makes the text deterministic.
    """
    if order_by in (None, field):
        values = F.sort_array(items[field])
    else:
        values = F.sort_array(F.arrays_zip(items[order_by], items[field]))[field]
    if drop_not_set:
        values = F.array_remove(values, NOT_SET)
    return F.coalesce(F.array_join(values, ","), F.lit(""))
