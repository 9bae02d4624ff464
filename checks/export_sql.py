"""The same two derivations as ``exports``, as SQL for the oracles."""

from __future__ import annotations

from checks import rules

VALUE = "STRUCT(string_value VARCHAR, int_value BIGINT, float_value DOUBLE, double_value DOUBLE)"
USER_VALUE = VALUE[:-1] + ", set_timestamp_micros BIGINT)"
ENTRY = f"STRUCT(key VARCHAR, value {VALUE})"
USER_ENTRY = f"STRUCT(key VARCHAR, value {USER_VALUE})"
DIMENSION = "STRUCT(index BIGINT, value VARCHAR)"


def _quoted(text: str | None) -> str:
    return "NULL" if text is None else f"'{text}'"


def _traffic_rows() -> str:
    rows = [
        f"({number}, {', '.join(f'CAST({_quoted(v)} AS VARCHAR)' for v in row)})"
        for number, row in enumerate(rules.TRAFFIC)
    ]
    return ", ".join(rows)


def _entry(condition: str | None, key: str, value: str, slot: str, kind: str = ENTRY) -> str:
    slots = ["string_value", "int_value", "float_value", "double_value"]
    if kind == USER_ENTRY:
        slots.append("set_timestamp_micros")
    fields = ", ".join(f"'{s}': {value if s == slot else 'NULL'}" for s in slots)
    entry = f"CAST({{'key': '{key}', 'value': {{{fields}}}}} AS {kind})"
    return entry if condition is None else f"CASE WHEN {condition} THEN {entry} END"


def _compact(entries: list[str]) -> str:
    return f"list_filter([{', '.join(entries)}], lambda e: e IS NOT NULL)"


def _event_params() -> str:
    section = "CASE WHEN event_id % 3 = 0 THEN '' ELSE 'sec' || (event_id % 4) END"
    text, number = "string_value", "int_value"
    entries = [
        _entry("event_id % 50 <> 0", "ga_session_id", f"bucket * {rules.BUCKET_SECONDS}", number),
        _entry("event_id % 4 <> 0", "engagement_time_msec", "CAST(floor(value) AS BIGINT) // 100", number),
        _entry(None, "video_duration", "event_id % 600", number),
        _entry("event_id % 3 = 0", "player_id", "'p' || (event_id % 9)", text),
        _entry("event_id % 3 = 1", "player_id", "event_id", number),
        _entry(None, "page_language", "CASE WHEN event_id % 2 = 0 THEN 'en' ELSE 'de' END", text),
        _entry("event_id % 8 <> 0", "country", "'X' || (user_id % 25)", text),
        _entry(None, "content_section_1", section, text),
        _entry(None, "content_section_2", section, text),
    ]
    for position, key in enumerate(rules.TEXT_PARAMS, 1):
        entries.append(_entry(f"(event_id + {position}) % 5 <> 0", key, f"'{key}_' || (event_id % 12)", text))
    return f"CASE WHEN event_id % 101 <> 0 THEN {_compact(entries)} END"


def _user_properties() -> str:
    status = "CASE event_id % 5 WHEN 0 THEN 'Logged In' WHEN 1 THEN 'true' WHEN 2 THEN '1' ELSE 'no' END"
    return _compact(
        [
            _entry("event_id % 5 <> 4", "login_status", status, "string_value", USER_ENTRY),
            _entry("user_id % 2 = 0", "newsletter_subscriber", "'y'", "string_value", USER_ENTRY),
            _entry(None, "user_team", "'t' || (user_id % 20)", "string_value", USER_ENTRY),
        ]
    )


BASE = f"""
traffic_rows(traffic_row, source, medium, campaign) AS (VALUES {_traffic_rows()}),
order_items AS (
    SELECT l_orderkey, list({{
            'item_name': CASE WHEN l_linenumber % 4 = 0 THEN '(not set)' ELSE p_name END,
            'item_list_name': CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 'list' || (l_suppkey % 5) END,
            'item_category': CASE WHEN p_size % 5 = 0 THEN '(not set)' ELSE p_type END,
            'promotion_id': CASE WHEN l_returnflag = 'R' THEN '(not set)' ELSE 'P' || (l_suppkey % 10) END,
            'promotion_name': CASE WHEN l_linestatus = 'F' AND l_linenumber % 2 = 0 THEN NULL ELSE p_brand END
        }} ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS line_items
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY l_orderkey
),
base AS (
    SELECT e.*, us // {rules.BUCKET_MICROS} AS bucket, strftime(ts, '%Y%m%d') AS event_date,
        CASE WHEN line_items IS NOT NULL THEN line_items WHEN event_id % 2 = 0 THEN NULL ELSE [] END AS items,
        CASE WHEN event_id % 89 = 0 THEN NULL
            WHEN event_type = 'signup' THEN 'first_visit'
            WHEN event_type = 'error' THEN 'scroll'
            WHEN event_type = 'click' THEN 'select_promotion'
            WHEN event_type = 'view' THEN CASE event_id % 3
                WHEN 0 THEN 'page_view' WHEN 1 THEN 'screen_view' ELSE 'view_promotion' END
            WHEN event_id % 2 = 0 THEN 'video_start' ELSE 'view_item' END AS event_name
    FROM (SELECT *, epoch_us(ts) AS us FROM events) e
    LEFT JOIN order_items ON l_orderkey = event_id
)"""

GA4 = f"""{BASE},
once AS (
    SELECT event_id, event_name, event_date, items,
        CASE WHEN event_id % 3 = 0 THEN us - us % {rules.ROUNDING_MICROS} ELSE us END AS event_timestamp,
        CASE WHEN event_id % 97 <> 0 THEN 'u' || user_id END AS user_pseudo_id,
        's' || (user_id % 3) AS stream_id,
        CASE WHEN event_id % 11 <> 0 THEN
            CASE user_id % 4 WHEN 0 THEN 'WEB' WHEN 1 THEN 'Android' WHEN 2 THEN 'iOS' ELSE 'SMART_TV' END
        END AS platform,
        {{'category': CASE WHEN event_id % 13 = 0 THEN '(not set)' WHEN user_id % 5 = 0 THEN 'smart tv' ELSE 'mobile' END,
          'operating_system': CASE WHEN event_id % 17 <> 0 THEN 'os' || (user_id % 6) END,
          'language': CASE WHEN event_id % 19 = 0 THEN '' WHEN user_id % 2 = 0 THEN 'en' ELSE 'fr' END}} AS device,
        {{'country': CASE WHEN event_id % 5 = 0 THEN '(not set)' ELSE 'N' || (user_id % 25) END,
          'city': CASE WHEN event_id % 6 <> 0 THEN 'C' || (user_id % 40) END}} AS geo,
        {{'manual_campaign_id': 'id' || (event_id % 23), 'manual_campaign_name': campaign, 'manual_source': source,
          'manual_medium': medium,
          'gclid': CASE WHEN event_id % 2 = 0 THEN 'g' || event_id END}} AS collected_traffic_source,
        {_event_params()} AS event_params,
        {_user_properties()} AS user_properties
    FROM base JOIN traffic_rows ON traffic_row = event_id % 23
),
ga4_events AS (
    SELECT * EXCLUDE (event_id) FROM once
    UNION ALL
    SELECT * EXCLUDE (event_id) FROM once WHERE event_id % 7 = 0
)"""


def _hit_dimensions() -> str:
    return _compact(
        [
            f"CASE WHEN (event_id + {k}) % 4 <> 0 THEN "
            f"CAST({{'index': {k}, 'value': 'd{k}_' || (event_id % 12)}} AS {DIMENSION}) END"
            for k in rules.HIT_DIMENSIONS
        ]
        + [
            f"CASE WHEN event_id % 50 = 7 THEN CAST({{'index': {k}, 'value': 'r' || (event_id % 3)}} AS {DIMENSION}) END"
            for k in rules.REPEATED_DIMENSIONS
        ]
    )


def _session_dimensions() -> str:
    def entry(condition: str, index: int, value: str) -> str:
        return f"CASE WHEN {condition} THEN CAST({{'index': {index}, 'value': {value}}} AS {DIMENSION}) END"

    return _compact(
        [
            entry("true", 2, "'X' || (user_id % 25)"),
            entry("user_id % 10 = 0", 2, "'DUP'"),
            entry("true", 23, "CASE WHEN user_id % 2 = 0 THEN 'Website' ELSE 'App' END"),
            entry("user_id % 5 <> 0", 24, "CASE WHEN user_id % 3 = 0 THEN 'true' ELSE 'false' END"),
        ]
    )


def _numbered(*fields: str) -> str:
    return "{" + ", ".join(f"'{f}': '{f}_' || (event_id % 6)" for f in fields) + "}"


# Events that are no interaction.
PASSIVE = (
    "('view_item', 'screenview', 'screen_view', 'onboarding_pick_teams_screen_view', 'gdpr_screen_view', "
    "'page_view', 'view_item_list', 'view_promotion', 'scroll')"
)

UA = f"""{BASE},
hit_rows AS (
    SELECT *,
        row_number() OVER (PARTITION BY user_id, bucket ORDER BY us, event_id) AS n,
        count(*) OVER (PARTITION BY user_id, bucket) AS hit_count,
        min(us) OVER (PARTITION BY user_id, bucket) AS start_us
    FROM base
),
ga_sessions AS (
    SELECT 'u' || user_id AS fullVisitorId, bucket * {rules.BUCKET_SECONDS} AS visitId, min(event_date) AS date,
        'ch' || ((user_id + bucket) % 7) AS channelGrouping,
        {{'campaignCode': 'id' || ((user_id + bucket) % 23), 'medium': any_value(medium),
          'campaign': any_value(campaign), 'source': any_value(source)}} AS trafficSource,
        {{'deviceCategory': CASE WHEN user_id % 5 = 0 THEN 'smart tv' ELSE 'mobile' END}} AS device,
        {{'country': 'N' || (user_id % 25), 'cityId': 'ci' || (user_id % 40), 'city': 'C' || (user_id % 40)}} AS geoNetwork,
        {{'pageviews': nullif(count(*) FILTER (WHERE event_name = 'page_view'), 0),
          'screenviews': nullif(count(*) FILTER (WHERE event_name = 'screen_view'), 0),
          'visits': CAST(1 AS BIGINT),
          'timeOnSite': CASE WHEN user_id % 2 = 0 THEN (max(us) - min(us)) // 1000000 END,
          'hits': count(*),
          'newVisits': CASE WHEN count(*) FILTER (WHERE event_type = 'signup') > 0 THEN CAST(1 AS BIGINT) END,
          'timeOnScreen': CASE WHEN user_id % 2 = 1 THEN (max(us) - min(us)) // 1000000 END}} AS totals,
        {_session_dimensions()} AS customDimensions,
        list({{'hitNumber': n, 'time': (us - start_us) // 1000,
            'type': CASE WHEN event_name = 'page_view' THEN 'PAGE'
                WHEN event_name = 'screen_view' THEN 'APPVIEW' ELSE 'EVENT' END,
            'isExit': n = hit_count,
            'isInteraction': CASE WHEN event_name NOT IN {PASSIVE} THEN true END,
            'page': {_numbered("hostname", "pageTitle")},
            'appInfo': {_numbered("screenName")},
            'sourcePropertyInfo': {_numbered("sourcePropertyTrackingId", "sourcePropertyDisplayName")},
            'eventInfo': {_numbered("eventCategory", "eventAction", "eventLabel")},
            'promotionActionInfo': {{'promoIsView': coalesce(event_name = 'view_promotion', false),
                'promoIsClick': coalesce(event_name = 'select_promotion', false)}},
            'promotion': list_transform(items, lambda i: {{'promoId': i.promotion_id, 'promoName': i.promotion_name}}),
            'product': list_transform(items, lambda i: {{'v2ProductName': i.item_name,
                'productListName': i.item_list_name, 'v2ProductCategory': i.item_category}}),
            'customDimensions': {_hit_dimensions()}}} ORDER BY n) AS hits
    FROM hit_rows LEFT JOIN traffic_rows ON traffic_row = (user_id + bucket) % 23
    GROUP BY user_id, bucket
)"""
