"""Lookups in key/value arrays.

``array_position`` on the key array plus ``get`` on the value array stays inside generated code,
and a row with many lookups extracts the key array once.  A lambda filter per key would run
interpreted and walk the structs again for every key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_strict: ContextVar[bool] = ContextVar("strict", default=False)


@contextmanager
def strict_lookups() -> Iterator[None]:
    """Within this block, lookups are built to raise when a key is repeated: a mart built here is strict."""
    token = _strict.set(True)
    try:
        yield
    finally:
        _strict.reset(token)


def _slot(keys: Column, key) -> Column:
    """Zero-based position of ``key``; -1 when missing, for which ``get`` gives NULL."""
    return (F.array_position(keys, key) - 1).cast("int")


def _only_once(keys: Column, key, found: Column) -> Column:
    occurrences = F.size(keys) - F.size(F.array_remove(keys, key))
    return F.when(occurrences > 1, F.raise_error(F.lit(f"key {key!r} occurs more than once"))).otherwise(found)


def bag_value(entries: Column, key: str, strict: bool | None = None) -> Column:
    """The whole typed value struct stored under ``key``; NULL if absent.

    The first entry wins when a key is repeated; ``strict``, also as ``strict_lookups``, raises instead.
    """
    found = F.get(entries["value"], _slot(entries["key"], key))
    return _only_once(entries["key"], key, found) if (_strict.get() if strict is None else strict) else found


def bag_field(entries: Column, key: str, field: str, strict: bool | None = None) -> Column:
    """One typed slot (``string_value``, ``int_value``, ...) of the value under ``key``.

    Reads only that slot's array, so a Parquet scan skips the slots nobody asks for.
    """
    found = F.get(entries["value"][field], _slot(entries["key"], key))
    return _only_once(entries["key"], key, found) if (_strict.get() if strict is None else strict) else found


def event_text(key: str) -> Column:
    return bag_field(F.col("event_params"), key, "string_value")


def event_long(key: str) -> Column:
    return bag_field(F.col("event_params"), key, "int_value")


def user_text(key: str) -> Column:
    return bag_field(F.col("user_properties"), key, "string_value")


def dimension(entries: Column, index: int) -> Column:
    """The value of the custom dimension ``index``; NULL if absent, the first if repeated."""
    wanted = F.lit(index).cast("long")
    return F.get(entries["value"], _slot(entries["index"], wanted))


def dimension_values(entries: Column, index: int) -> Column:
    """All values of the custom dimension ``index``, for callers that keep repeats."""
    return F.transform(F.filter(entries, lambda entry: entry["index"] == index), lambda entry: entry["value"])


def dimension_groups(entries: Column, indexes: Sequence[int]) -> Column:
    """The wanted dimensions that are given, each once with all its values."""
    wanted = F.array(*[F.lit(index).cast("long") for index in indexes])
    return F.transform(
        F.array_intersect(entries["index"], wanted),
        lambda index: F.struct(
            index.alias("index"),
            F.transform(F.filter(entries, lambda e: e["index"] == index), lambda e: e["value"]).alias("values"),
        ),
    )


def _pick(groups: Column, choice: Column) -> Column:
    """One value of each group; the choice is read like a clock that has a digit per group."""
    nothing = F.struct(
        F.lit(1).cast("long").alias("turns"),
        F.array().cast("array<struct<index:bigint,value:string>>").alias("picked"),
    )

    def turn(clock: Column, group: Column) -> Column:
        values = group["values"]
        at = F.call_function("div", choice, clock["turns"]) % F.size(values)
        entry = F.struct(group["index"].alias("index"), F.get(values, at.cast("int")).alias("value"))
        return F.struct(
            (clock["turns"] * F.size(values)).alias("turns"),
            F.concat(clock["picked"], F.array(entry)).alias("picked"),
        )

    return F.aggregate(groups, nothing, turn, lambda clock: clock["picked"])


def explode_repeats(rows: DataFrame, entries: Column, indexes: Sequence[int]) -> DataFrame:
    """Add ``chosen``: the dimensions with one value each, in one row per combination of repeated ones.

    Almost always there is exactly one row, and ``chosen`` is the array itself.  Otherwise the values are
    grouped by dimension once per row.  Only the combinations' numbers are made at once, and each row
    picks its own values by number, so the expression does not grow with the number of dimensions.
    """
    repeated = F.size(F.array_distinct(entries["index"])) < F.size(entries)
    grouped = rows.select("*", F.when(repeated, dimension_groups(entries, indexes)).alias("groups"))
    groups, first = F.col("groups"), F.array(F.lit(0).cast("long"))
    rows_needed = F.aggregate(groups, F.lit(1).cast("long"), lambda n, group: n * F.size(group["values"]))
    numbers = F.when(groups.isNotNull(), F.sequence(F.lit(0).cast("long"), rows_needed - 1)).otherwise(first)
    numbered = grouped.select("*", F.explode(numbers).alias("choice"))
    chosen = F.when(groups.isNotNull(), _pick(groups, F.col("choice"))).otherwise(entries)
    return numbered.select(*rows.columns, chosen.alias("chosen"))
