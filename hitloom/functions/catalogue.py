"""The lookups and traffic rules as SQL functions, for queries written as text.

``register`` creates temporary functions with SQL bodies: Spark puts the body in place of the call, so
a query that uses them is planned like one built from the Column forms, and no Python runs.  The
patterns and lists are those of the Column forms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from hitloom.functions import traffic
from hitloom.functions.texts import NOT_SET
from hitloom.schemas import EVENT_PARAMS, USER_PROPERTIES


def _text(value: str) -> str:
    """A raw text literal; none of the fixed values holds a quote."""
    return f"r'{value}'"


def _among(value: str, texts: Sequence[str]) -> str:
    return f"{value} IN ({', '.join(map(_text, texts))})"


def _matches(value: str, pattern: str) -> str:
    return f"{value} RLIKE {_text(traffic.exact_pattern(pattern))}"


def _lookup(entries: T.ArrayType, strict: bool) -> tuple[str, str, str]:
    """Parameters, result and body of a lookup of a key's whole value."""
    found = "get(entries.value, CAST(array_position(entries.key, wanted) - 1 AS INT))"
    if strict:
        twice = "size(entries.key) - size(array_remove(entries.key, wanted)) > 1"
        found = f"CASE WHEN {twice} THEN raise_error('key ' || wanted || ' occurs more than once') ELSE {found} END"
    value = entries.elementType["value"].dataType
    return f"wanted STRING, entries {entries.simpleString()}", value.simpleString(), found


def channel_rules() -> list[tuple[str, str]]:
    """Channel and condition, in order, over ``medium``, ``name`` (of the campaign) and ``source``."""
    paid = _matches("medium", traffic.PAID_MEDIUM)
    kinds = {
        "Shopping": f"({_matches('source', traffic.SHOPPING_SOURCE)} OR {_matches('name', traffic.SHOPPING_CAMPAIGN)})",
        "Search": _matches("source", traffic.SEARCH_SOURCE),
        "Social": _matches("source", traffic.SOCIAL_SOURCE),
        "Video": _matches("source", traffic.VIDEO_SOURCE),
    }
    organic = {
        "Shopping": "FALSE",
        "Social": _among("medium", traffic.SOCIAL_MEDIUM),
        "Video": _matches("medium", traffic.VIDEO_MEDIUM),
        "Search": "medium = 'organic'",
    }
    return [
        ("Direct", f"source = '(direct)' AND {_among('medium', traffic.NO_MEDIUM)}"),
        ("Cross-network", _matches("name", traffic.CROSS_NETWORK)),
        *[(f"Paid {kind}", f"{found} AND {paid}") for kind, found in kinds.items()],
        ("Display", _among("medium", traffic.DISPLAY_MEDIUM)),
        ("Paid Other", paid),
        *[(f"Organic {kind}", f"{kinds[kind]} OR {by_medium}") for kind, by_medium in organic.items()],
        ("Referral", _among("medium", traffic.REFERRAL_MEDIUM)),
        ("Email", f"{_matches('source', traffic.MAIL)} OR {_matches('medium', traffic.MAIL)}"),
        ("Affiliates", "medium = 'affiliate'"),
        ("Audio", "medium = 'audio'"),
        ("SMS", "medium = 'sms' OR source = 'sms'"),
        (
            "Mobile Push Notifications",
            f"medium LIKE '%push' OR {_matches('medium', traffic.PUSH_MEDIUM)} OR source = 'firebase'",
        ),
    ]


def _channel() -> str:
    cases = " ".join(f"WHEN {condition} THEN '{name}'" for name, condition in channel_rules())
    return f"CASE {cases} ELSE 'Unassigned' END"


def register(spark: SparkSession, strict: bool = False, clean: str | None = None) -> None:
    """Create the functions in the session: ``get_event``, ``get_user``, ``create_channel``, ``channel_grouping``,
    ``data_cleaning``.

    A key that occurs twice counts with its first value; with ``strict`` it raises.  ``clean`` is another
    SQL body for ``data_cleaning``, over ``value``.  Creating them again replaces them.
    """
    if clean is None:
        clean = f"CASE WHEN value <> '{NOT_SET}' AND value <> '' THEN value END"
    grouped = f"CASE WHEN {_among('lower(channel)', traffic.KEPT_GROUPS)} THEN channel ELSE '(Other)' END"
    functions = {
        "get_event": _lookup(EVENT_PARAMS, strict),
        "get_user": _lookup(USER_PROPERTIES, strict),
        "create_channel": ("medium STRING, name STRING, source STRING", "STRING", _channel()),
        "channel_grouping": ("channel STRING", "STRING", grouped),
        "data_cleaning": ("value STRING", "STRING", clean),
    }
    for name, (parameters, result, body) in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
