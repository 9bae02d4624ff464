"""Marketing medium, channel and channel group of a traffic source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source, medium and campaign patterns (partial match, lower case).
PAID_MEDIUM = r"^(.*cp.*|ppc|retargeting|paid.*)$"
SHOPPING_SOURCE = r"alibaba|amazon|google shopping|shopify|etsy|ebay|stripe|walmart"
SHOPPING_CAMPAIGN = r"^(.*(([^a-df-z]|^)shop|shopping).*)$"
SEARCH_SOURCE = r"baidu|bing|duckduckgo|ecosia|google|yahoo|yandex"
SOCIAL_SOURCE = r"badoo|facebook|fb|instagram|linkedin|pinterest|tiktok|twitter|whatsapp"
VIDEO_SOURCE = r"dailymotion|disneyplus|netflix|youtube|vimeo|twitch"
VIDEO_MEDIUM = r"^(.*video.*)$"
MAIL = r"email|e-mail|e_mail|e mail"
PUSH_MEDIUM = r"mobile|notification"
CROSS_NETWORK = r"cross-network"
NO_MEDIUM = ("(not set)", "(none)")
DISPLAY_MEDIUM = ("display", "banner", "expandable", "interstitial", "cpm")
SOCIAL_MEDIUM = ("social", "social-network", "social-media", "sm", "social network", "social media")
REFERRAL_MEDIUM = ("referral", "app", "link")
KEPT_GROUPS = ("direct", "organic search", "referral", "social", "paid search", "email", "display")


def exact_pattern(pattern: str) -> str:
    """UNIX_LINES and \\z: "." stops at a line feed only and "$" means the very end of the text."""
    return "(?d)" + pattern.replace("$", r"\z")


def _matches(text: Column, pattern: str) -> Column:
    return text.rlike(exact_pattern(pattern))


def channel(medium: Column, campaign: Column, source: Column) -> Column:
    """Marketing channel of one traffic source: the first rule that holds names it."""
    paid = _matches(medium, PAID_MEDIUM)
    kinds = {
        "Shopping": _matches(source, SHOPPING_SOURCE) | _matches(campaign, SHOPPING_CAMPAIGN),
        "Search": _matches(source, SEARCH_SOURCE),
        "Social": _matches(source, SOCIAL_SOURCE),
        "Video": _matches(source, VIDEO_SOURCE),
    }
    organic_by_medium = {
        "Shopping": F.lit(False),
        "Social": medium.isin(*SOCIAL_MEDIUM),
        "Video": _matches(medium, VIDEO_MEDIUM),
        "Search": medium == "organic",
    }
    rules = [
        ("Direct", (source == "(direct)") & medium.isin(*NO_MEDIUM)),
        ("Cross-network", _matches(campaign, CROSS_NETWORK)),
        *[(f"Paid {kind}", found & paid) for kind, found in kinds.items()],
        ("Display", medium.isin(*DISPLAY_MEDIUM)),
        ("Paid Other", paid),
        *[(f"Organic {kind}", kinds[kind] | by_medium) for kind, by_medium in organic_by_medium.items()],
        ("Referral", medium.isin(*REFERRAL_MEDIUM)),
        ("Email", _matches(source, MAIL) | _matches(medium, MAIL)),
        ("Affiliates", medium == "affiliate"),
        ("Audio", medium == "audio"),
        ("SMS", (medium == "sms") | (source == "sms")),
        (
            "Mobile Push Notifications",
            medium.like("%push") | _matches(medium, PUSH_MEDIUM) | (source == "firebase"),
        ),
    ]
    (first_name, first_rule), *others = rules
    chain = F.when(first_rule, first_name)
    for name, rule in others:
        chain = chain.when(rule, name)
    return chain.otherwise("Unassigned")


def channel_group(name: Column) -> Column:
    """The channel itself if it is one of the reported groups, else ``(Other)``."""
    return F.when(F.lower(name).isin(*KEPT_GROUPS), name).otherwise("(Other)")


def effective_medium(traffic: Column) -> Column:
    """Lower-cased medium; organic search traffic that carries a click id counts as paid."""
    medium = F.lower(traffic["manual_medium"])
    is_ad_click = (
        (F.lower(traffic["manual_source"]) == "google") & (medium == "organic") & traffic["gclid"].isNotNull()
    )
    return F.when(is_ad_click, "cpc").otherwise(medium)


def channel_group_or_null(medium: Column, campaign: Column, source: Column) -> Column:
    """Channel group, but NULL when nothing at all is known about the traffic source."""
    known = medium.isNotNull() | campaign.isNotNull() | source.isNotNull()
    return F.when(known, channel_group(channel(medium, campaign, source)))
