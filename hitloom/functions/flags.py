"""Event and visit attributes derived from names, platforms and status texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
PASSIVE_EVENTS = (
    "view_item",
    "screenview",
    "screen_view",
    "onboarding_pick_teams_screen_view",
    "gdpr_screen_view",
    "page_view",
    "view_item_list",
    "view_promotion",
    "scroll",
)
FIRST_EVENTS = ("first_visit", "first_open")
PROMOTION_EVENTS = ("view_promotion", "select_promotion")
LOGGED_IN = ("logged in", "true")
LOGGED_IN_OR_ONE = ("logged in", "true", "1")
MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400_000_000


def holds(condition: Column) -> Column:
    """TRUE where the condition holds, FALSE where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False))


def as_bit(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("long")


def is_interaction(name: Column) -> Column:
    return holds(~name.isin(*PASSIVE_EVENTS))


def is_promotion_view(name: Column) -> Column:
    return holds(name == PROMOTION_EVENTS[0])


def is_promotion_click(name: Column) -> Column:
    return holds(name == PROMOTION_EVENTS[1])


def is_first_event(name: Column) -> Column:
    return holds(name.isin(*FIRST_EVENTS))


def is_logged_in(status: Column, accepted: tuple[str, ...] = LOGGED_IN) -> Column:
    return holds(F.lower(status).isin(*accepted))


def flag_text(flag: Column) -> Column:
    return F.when(flag, "true").otherwise("false")


def hit_type(name: Column) -> Column:
    return F.when(name == "page_view", "PAGE").when(name == "screen_view", "APPVIEW").otherwise("EVENT")


def site_or_app(platform: Column) -> Column:
    kind = F.lower(platform)
    return F.when(kind == "web", "Website").when(kind.isin("android", "ios"), "App")


def only_on(platform: Column, wanted: str, value: Column) -> Column:
    """``value`` for visits on the wanted platform, NULL for all others."""
    return F.when(platform == wanted, value)


def tv_platform(device: Column) -> Column:
    return F.when(device["category"] == "smart tv", device["operating_system"])


def event_date(text: Column) -> Column:
    """Parse ``yyyyMMdd``; malformed text raises under ANSI mode."""
    return F.to_date(text, "yyyyMMdd")


def utc_date(micros: Column) -> Column:
    """UTC calendar day of an epoch-micros value, whatever the session time zone is."""
    day_start = micros - F.pmod(micros, F.lit(MICROS_PER_DAY))
    return F.date_from_unix_date((day_start / MICROS_PER_DAY).cast("int"))


def seconds(micros: Column) -> Column:
    return micros / MICROS_PER_SECOND
