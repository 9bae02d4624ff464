"""DuckDB SQL for the registered queries.

Where Spark uses a rewritten form (time slices, minimum of a struct, two-step counts) the SQL here
stays with the plain one: windows over whole visits, ``first_value``, ``count(DISTINCT ...)``.
"""

from __future__ import annotations

from checks import oracle_layouts as fixed
from checks.export_sql import GA4, PASSIVE, UA


def _param(key: str, slot: str = "string_value", bag: str = "event_params") -> str:
    return f"list_filter({bag}, lambda e: e.key = '{key}')[1].value.{slot}"


def _user(key: str) -> str:
    return _param(key, bag="user_properties")


def _joined(array: str, value: str, by: str, clean: bool = True) -> str:
    shown = f"nullif(i.{value}, '(not set)')" if clean else f"i.{value}"
    return (
        f"coalesce((SELECT string_agg({shown}, ',' ORDER BY i.{by} NULLS FIRST, i.{value} NULLS FIRST) "
        f"FROM (SELECT unnest({array}) AS i)), '')"
    )


SOURCE = "collected_traffic_source"
MEDIUM = (
    f"CASE WHEN lower({SOURCE}.manual_source) = 'google' AND lower({SOURCE}.manual_medium) = 'organic' "
    f"AND {SOURCE}.gclid IS NOT NULL THEN 'cpc' ELSE lower({SOURCE}.manual_medium) END"
)
KIND = "CASE WHEN lower(platform) = 'web' THEN 'Website' WHEN lower(platform) IN ('android', 'ios') THEN 'App' END"
DAY = "CAST(strptime(event_date, '%Y%m%d') AS DATE)"
HIT_TYPE = "CASE WHEN event_name = 'page_view' THEN 'PAGE' WHEN event_name = 'screen_view' THEN 'APPVIEW' ELSE 'EVENT' END"
INTERACTION = f"coalesce(event_name NOT IN {PASSIVE}, false)"
VIEWED = "coalesce(event_name = 'view_promotion', false)"
CLICKED = "coalesce(event_name = 'select_promotion', false)"
LOGIN = f"coalesce(lower({_user('login_status')}) IN ('logged in', 'true'), false)"
LOGIN_ONE = f"coalesce(lower({_user('login_status')}) IN ('logged in', 'true', '1'), false)"
TV = "CASE WHEN device.category = 'smart tv' THEN device.operating_system END"
VIDEO_LENGTH = f"CASE WHEN event_name = 'video_start' THEN {_param('video_duration', 'int_value')} END"
PLAYER = f"coalesce({_param('player_id')}, CAST({_param('player_id', 'int_value')} AS VARCHAR))"
SESSION = _param("ga_session_id", "int_value")


def _clean(value: str) -> str:
    return f"nullif(nullif({value}, '(not set)'), '')"


def _channel(medium: str, campaign: str, source: str) -> str:
    """The published rule table, in its order."""
    paid = f"regexp_matches({medium}, '^(.*cp.*|ppc|retargeting|paid.*)$')"
    shop = (
        f"(regexp_matches({source}, 'alibaba|amazon|google shopping|shopify|etsy|ebay|stripe|walmart') "
        f"OR regexp_matches({campaign}, '^(.*(([^a-df-z]|^)shop|shopping).*)$'))"
    )
    search = f"regexp_matches({source}, 'baidu|bing|duckduckgo|ecosia|google|yahoo|yandex')"
    social = f"regexp_matches({source}, 'badoo|facebook|fb|instagram|linkedin|pinterest|tiktok|twitter|whatsapp')"
    video = f"regexp_matches({source}, 'dailymotion|disneyplus|netflix|youtube|vimeo|twitch')"
    mail = "email|e-mail|e_mail|e mail"
    rules = [
        (f"{source} = '(direct)' AND {medium} IN ('(not set)', '(none)')", "Direct"),
        (f"regexp_matches({campaign}, 'cross-network')", "Cross-network"),
        (f"{shop} AND {paid}", "Paid Shopping"),
        (f"{search} AND {paid}", "Paid Search"),
        (f"{social} AND {paid}", "Paid Social"),
        (f"{video} AND {paid}", "Paid Video"),
        (f"{medium} IN ('display', 'banner', 'expandable', 'interstitial', 'cpm')", "Display"),
        (paid, "Paid Other"),
        (shop, "Organic Shopping"),
        (
            f"{social} OR {medium} IN "
            "('social', 'social-network', 'social-media', 'sm', 'social network', 'social media')",
            "Organic Social",
        ),
        (f"{video} OR regexp_matches({medium}, '^(.*video.*)$')", "Organic Video"),
        (f"{search} OR {medium} = 'organic'", "Organic Search"),
        (f"{medium} IN ('referral', 'app', 'link')", "Referral"),
        (f"regexp_matches({source}, '{mail}') OR regexp_matches({medium}, '{mail}')", "Email"),
        (f"{medium} = 'affiliate'", "Affiliates"),
        (f"{medium} = 'audio'", "Audio"),
        (f"{medium} = 'sms' OR {source} = 'sms'", "SMS"),
        (
            f"{medium} LIKE '%push' OR regexp_matches({medium}, 'mobile|notification') OR {source} = 'firebase'",
            "Mobile Push Notifications",
        ),
    ]
    return "CASE " + " ".join(f"WHEN {rule} THEN '{name}'" for rule, name in rules) + " ELSE 'Unassigned' END"


def _group(channel: str) -> str:
    kept = "('direct', 'organic search', 'referral', 'social', 'paid search', 'email', 'display')"
    return f"CASE WHEN lower({channel}) IN {kept} THEN {channel} ELSE '(Other)' END"


def _guarded(medium: str, campaign: str, source: str) -> str:
    unknown = f"{medium} IS NULL AND {campaign} IS NULL AND {source} IS NULL"
    return f"CASE WHEN {unknown} THEN NULL ELSE {_group(_channel(medium, campaign, source))} END"


# Visits, distinct events and their numbers, in the plain form.
VISITED = f"""{GA4},
visited AS (
    SELECT *, user_pseudo_id AS fullVisitorId, user_pseudo_id || session_no AS visitId,
        user_pseudo_id || session_no || event_name || event_timestamp AS identity
    FROM (SELECT *, {SESSION} AS session_no FROM ga4_events)
    WHERE user_pseudo_id IS NOT NULL AND session_no IS NOT NULL
)"""
NUMBERED = f"""{VISITED},
numbered AS (
    SELECT *, row_number() OVER (
        PARTITION BY visitId ORDER BY event_timestamp NULLS FIRST, event_name NULLS FIRST) AS rank
    FROM (SELECT DISTINCT visitId, event_timestamp, event_name, identity FROM visited)
),
events_numbered AS (
    SELECT v.*, n.rank AS hitNumber FROM visited v LEFT JOIN numbered n USING (identity)
),
events_measured AS (
    SELECT *, min(event_timestamp) OVER (PARTITION BY visitId) AS first_timestamp,
        hitNumber = max(hitNumber) OVER (PARTITION BY visitId) AS is_exit
    FROM events_numbered
)"""


def _ga4(body: str) -> str:
    return f"WITH {GA4} {body}"


def _visited(body: str) -> str:
    return f"WITH {VISITED} {body}"


def _numbered(body: str) -> str:
    return f"WITH {NUMBERED} {body}"


def _ua(body: str) -> str:
    return f"WITH {UA} {body}"


def _per_event(**columns: str) -> str:
    shown = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return _ga4(f"SELECT event_timestamp, event_name, {shown} FROM ga4_events")


# --- hits -------------------------------------------------------------------------------------------


def _hit_columns() -> dict[str, str]:
    return {
        "fullVisitorId": "fullVisitorId",
        "visitId": "visitId",
        "product_id_14": "stream_id",
        **{name: "CAST(NULL AS VARCHAR)" for name in fixed.ABSENT},
        **{name: _param(key) for name, key in fixed.EVENT_TEXTS.items()},
        **{name: f"nullif({_param(key)}, '')" for name, key in fixed.SECTION_TEXTS.items()},
        **{name: _user(key) for name, key in fixed.USER_TEXTS.items()},
        **{name: _joined("items", field, by) for name, (field, by) in fixed.ITEM_TEXTS.items()},
        "language_26": f"upper({_param('page_language')})",
        "TV_Platforms_55": TV,
        "hit_type_59": HIT_TYPE,
        "video_length_73": VIDEO_LENGTH,
        "player_id_74": PLAYER,
        "hitNumber": "hitNumber",
        "promoIsView": VIEWED,
        "promoIsClick": CLICKED,
        "hit_isInteraction_62": INTERACTION,
        "hit_time_60": "(event_timestamp - first_timestamp) / 1000000",
        "hit_isExit_61": "is_exit",
        "datedate": "CAST(make_timestamp(first_timestamp) AS DATE)",
    }


def _hits(layout) -> str:
    columns = _hit_columns()
    return _numbered(
        "SELECT DISTINCT " + ", ".join(f"{columns[name]} AS {name}" for name in layout) + " FROM events_measured"
    )


def _normalised_hits() -> str:
    columns = _hit_columns()
    typed = {"video_length_73", "hitNumber", "promoIsView", "promoIsClick", "hit_isInteraction_62"}
    typed |= {"hit_time_60", "hit_isExit_61", "datedate"}
    shown = ", ".join(
        f"{name}" if name in typed else f"nullif(trim({name}), '') AS {name}" for name in fixed.HITS_LAYOUT
    )
    inner = "SELECT DISTINCT " + ", ".join(f"{columns[n]} AS {n}" for n in fixed.HITS_LAYOUT) + " FROM events_measured"
    return _numbered(f"SELECT {shown} FROM ({inner})")


# --- products and promotions ------------------------------------------------------------------------

PRODUCTS = """SELECT DISTINCT visitId, fullVisitorId, products_name, products_list_name, products_category, hitNumber
FROM (
    SELECT visitId, fullVisitorId, identity, nullif(i.item_name, '(not set)') AS products_name,
        nullif(i.item_list_name, '(not set)') AS products_list_name,
        nullif(i.item_category, '(not set)') AS products_category
    FROM (SELECT *, unnest(items) AS i FROM visited)
)
LEFT JOIN (SELECT identity, rank AS hitNumber FROM numbered) USING (identity)
WHERE products_name IS NOT NULL OR products_list_name IS NOT NULL OR products_category IS NOT NULL"""


def _promotions(layout) -> str:
    return _numbered(
        f"""SELECT DISTINCT {', '.join(layout)}
FROM (
    SELECT visitId, fullVisitorId, identity, event_name, min({DAY}) OVER (PARTITION BY visitId) AS date_5,
        {VIEWED} AS promoIsView, {CLICKED} AS promoIsClick,
        nullif(i.promotion_id, '(not set)') AS promoId, nullif(i.promotion_name, '(not set)') AS promoName
    FROM (SELECT *, unnest(items) AS i FROM visited)
)
LEFT JOIN (SELECT identity, rank AS hitNumber FROM numbered) USING (identity)
WHERE promoId IS NOT NULL AND promoName IS NOT NULL AND event_name IN ('view_promotion', 'select_promotion')"""
    )


# --- visits -----------------------------------------------------------------------------------------

METRICS = f"""(
    SELECT visitId, (max(event_timestamp) - min(event_timestamp)) / 1000000 AS duration,
        count(DISTINCT identity) AS hits,
        max(CASE WHEN event_name IN ('first_visit', 'first_open') THEN 1 ELSE 0 END) AS new_visit,
        count(DISTINCT CASE WHEN event_name = 'page_view' THEN identity END) AS pageviews,
        count(DISTINCT CASE WHEN event_name = 'screen_view' THEN identity END) AS screenviews,
        max(CASE WHEN {LOGIN} THEN 1 ELSE 0 END) AS logged_in,
        max(CASE WHEN event_name NOT IN {PASSIVE} THEN 1 ELSE 0 END) AS active
    FROM visited GROUP BY visitId
)"""
METRIC_COLUMNS = {
    "duration": "duration",
    "hits": "hits",
    "new_visit": "CAST(new_visit AS BIGINT)",
    "pageviews": "pageviews",
    "screenviews": "screenviews",
    "logged_in": "CAST(logged_in AS BIGINT)",
    "active": "CAST(active AS BIGINT)",
}


def _metrics(*names: str) -> str:
    shown = ", ".join(f"{METRIC_COLUMNS[name]} AS {name}" for name in names)
    return _visited(f"SELECT visitId, {shown} FROM {METRICS}")


# Columns the attributed visits choose from, cleaned, with the visit's time bounds.
ATTRIBUTES = f"""attributes AS (
    SELECT fullVisitorId, visitId, identity, event_timestamp, event_name, {DAY} AS day,
        {_param('engagement_time_msec', 'int_value')} AS engagement_time,
        {KIND} AS kind,
        {SOURCE}.manual_campaign_id AS channel_id, {SOURCE}.manual_campaign_name AS campaign,
        {SOURCE}.manual_source AS source, {MEDIUM} AS medium,
        {_clean('geo.country')} AS country, {_clean(_param('country'))} AS country_code, {_clean('geo.city')} AS city,
        {_clean('device.category')} AS category, {_clean('device.language')} AS language,
        {_clean('device.operating_system')} AS os,
        {LOGIN_ONE} AS logged_in,
        max(event_timestamp) OVER (PARTITION BY visitId) AS last_ts,
        min(event_timestamp) OVER (PARTITION BY visitId) AS first_ts
    FROM visited
)"""
# Per group: columns that must be known, then mart column -> column taken.
TOUCH = {
    "platform": (["kind"], {"platform_id_10": "kind"}),
    "traffic": (
        ["source", "medium"],
        {
            "acq_channel_id_12": "channel_id",
            "Campaign_56": "campaign",
            "Traffic_Source_62": "source",
            "Custom_Acq_Channel_Name": "medium",
        },
    ),
    "geo": (
        ["country", "country_code", "city"],
        {"country_name_30": "country", "country_code_uefa_30": "country_code", "City_Name_65": "city"},
    ),
    "device": (
        ["category", "language", "os"],
        {"device_category_24": "category", "Device_Language_87": "language", "operatingSystemVersion": "os"},
    ),
}


def _touch(group: str) -> list[str]:
    required, values = TOUCH[group]
    known = " || ".join([*required, "event_timestamp"])
    order = [f"CASE WHEN ({known}) IS NULL THEN last_ts + 1 ELSE event_timestamp END", "event_timestamp", "event_name"]
    order = ", ".join(f"{c} NULLS FIRST" for c in [*order, *values.values()])
    return [
        f"first_value({column}) OVER (PARTITION BY visitId ORDER BY {order}) AS {name}"
        for name, column in values.items()
    ]


def _first_touch(group: str) -> str:
    return f"WITH {VISITED}, {ATTRIBUTES} SELECT DISTINCT visitId, {', '.join(_touch(group))} FROM attributes"


def _visits_attributed(layout) -> str:
    touches = ", ".join(column for group in TOUCH for column in _touch(group))
    timed = "count(DISTINCT CASE WHEN event_name = '{}' THEN event_timestamp END) OVER v"
    channel = _guarded("Custom_Acq_Channel_Name", "Campaign_56", "Traffic_Source_62")
    return f"""WITH {VISITED}, {ATTRIBUTES},
per_event AS (
    SELECT fullVisitorId, visitId, engagement_time, {touches},
        min(day) OVER v AS date_5,
        (last_ts - first_ts) / 1000000 AS duration,
        CAST(max(CASE WHEN event_name IN ('first_visit', 'first_open') THEN 1 ELSE 0 END) OVER v AS BIGINT) AS newVisits,
        {timed.format('page_view')} AS pageviews_44,
        {timed.format('screen_view')} AS screenviews_44,
        CAST(max(CASE WHEN event_name NOT IN {PASSIVE} THEN 1 ELSE 0 END) OVER v AS BIGINT) AS total_visit_51,
        CAST(max(CASE WHEN logged_in THEN 1 ELSE 0 END) OVER v AS BOOLEAN) AS is_login,
        count(DISTINCT identity) OVER v AS hits
    FROM attributes
    WINDOW v AS (PARTITION BY visitId)
),
completed AS (
    SELECT *, CAST(NULL AS VARCHAR) AS City_ID_64, CAST(NULL AS VARCHAR) AS Gigya_Id_88,
        CASE WHEN is_login THEN 'true' ELSE 'false' END AS nbr_loggedin_user_46,
        CASE WHEN platform_id_10 = 'Website' THEN duration END AS timeonesite,
        CASE WHEN platform_id_10 = 'App' THEN duration END AS timeOnScreen,
        {channel} AS channel_name_13
    FROM per_event
)
SELECT DISTINCT {', '.join(layout)} FROM completed"""


def _first_rows(columns: dict[str, str], names: list[str]) -> str:
    """Rows of ``visited`` that come first in their visit, by time, name and the named columns."""
    shown = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    order = ", ".join(f"{name} NULLS FIRST" for name in ["event_timestamp", "event_name", *names])
    return f"""(
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY visitId ORDER BY {order}) AS place
        FROM (SELECT visitId, event_timestamp, event_name, {shown} FROM visited)
    ) WHERE place = 1
)"""


BASIC_FIRST = {
    "fullVisitorId": "fullVisitorId",
    "date_5": DAY,
    "platform_id_10": KIND,
    "acq_channel_id_12": f"{SOURCE}.manual_campaign_id",
    "device_category_24": "device.category",
    "country_name_30": "geo.country",
    "country_code_uefa_30": _param("country"),
    "Custom_Acq_Channel_Name": MEDIUM,
    "Campaign_56": f"{SOURCE}.manual_campaign_name",
    "Traffic_Source_62": f"{SOURCE}.manual_source",
    "City_Name_65": "geo.city",
    "channel_name_13": _group(
        _channel(MEDIUM, f"lower({SOURCE}.manual_campaign_name)", f"lower({SOURCE}.manual_source)")
    ),
}


def _visits_basic(layout) -> str:
    order = [name for name in BASIC_FIRST if name != "channel_name_13"]
    return _visited(
        f"""SELECT DISTINCT {', '.join(layout)} FROM (
    SELECT f.*, hits, CAST(new_visit AS BOOLEAN) AS newVisits, pageviews AS pageviews_44,
        screenviews AS screenviews_44, CAST(logged_in AS BOOLEAN) AS nbr_loggedin_user_46,
        CAST(active AS BIGINT) AS total_visit_51, CAST(NULL AS VARCHAR) AS City_ID_64,
        CASE WHEN platform_id_10 = 'Website' THEN duration END AS timeonesite,
        CASE WHEN platform_id_10 = 'App' THEN duration END AS timeOnScreen
    FROM {_first_rows(BASIC_FIRST, order)} f LEFT JOIN {METRICS} m USING (visitId)
)"""
    )


# --- session-based export ---------------------------------------------------------------------------

UA_HITS = "(SELECT visitId, fullVisitorId, unnest(hits) AS hit FROM ga_sessions)"


def _dimension_join(array: str, name: str, index: int) -> str:
    return (
        f"LEFT JOIN LATERAL (SELECT d.value AS {name} FROM (SELECT unnest({array}) AS d) "
        f"WHERE d.index = {index}) ON true"
    )


def _ua_hit_columns() -> dict[str, str]:
    return {
        "visitId": "visitId",
        "fullVisitorId": "fullVisitorId",
        **{name: f"hit.{path}" for name, path in fixed.UA_HIT_FIELDS.items()},
        **{name: f"hit.{fixed.UA_HIT_FIELDS[same]}" for name, same in fixed.UA_REPEATED_FIELDS.items()},
        **{name: name for name in fixed.UA_HIT_DIMENSIONS},
        **{
            name: _joined(f"hit.{array}", field, by, clean=False)
            for name, (array, field, by) in fixed.UA_HIT_LISTS.items()
        },
    }


def _ua_hits(*names: str) -> str:
    columns = _ua_hit_columns()
    joins = " ".join(
        _dimension_join("hit.customDimensions", name, index)
        for name, index in fixed.UA_HIT_DIMENSIONS.items()
        if name in names
    )
    return _ua("SELECT DISTINCT " + ", ".join(f"{columns[n]} AS {n}" for n in names) + f" FROM {UA_HITS} {joins}")


def _ua_visits(*names: str) -> str:
    columns = {name: path for name, path in fixed.UA_SESSION_FIELDS.items()}
    columns |= {name: name for name in fixed.UA_SESSION_DIMENSIONS}
    joins = " ".join(
        _dimension_join("customDimensions", name, index) for name, index in fixed.UA_SESSION_DIMENSIONS.items()
    )
    return _ua("SELECT " + ", ".join(f"{columns[n]} AS {n}" for n in names) + f" FROM ga_sessions {joins}")


LOADED_PROMOTIONS = (
    "SELECT * REPLACE (nullif(trim(promoId), '') AS promoId, nullif(trim(promoName), '') AS promoName)"
)
UA_PROMOTIONS = """SELECT DISTINCT visitId, fullVisitorId, hit.hitNumber AS hitNumber, shown.promoId AS promoId,
    shown.promoName AS promoName, hit.promotionActionInfo.promoIsView AS promoIsView,
    hit.promotionActionInfo.promoIsClick AS promoIsClick
FROM (SELECT visitId, fullVisitorId, hit, unnest(hit.promotion) AS shown
      FROM (SELECT visitId, fullVisitorId, unnest(hits) AS hit FROM ga_sessions))"""


def _summary(rows: str, keys: list[str]) -> str:
    missing = " OR ".join(f"{key} IS NULL" for key in keys)
    return f"""SELECT CAST(coalesce(sum(copies), 0) AS BIGINT) AS row_count,
    CAST(coalesce(sum(CASE WHEN {missing} THEN copies END), 0) AS BIGINT) AS null_key_rows,
    count(*) AS distinct_keys, count(CASE WHEN copies > 1 THEN 1 END) AS repeated_keys,
    coalesce(max(copies), 0) AS largest_key_rows
FROM (SELECT {', '.join(keys)}, count(*) AS copies FROM ({rows}) GROUP BY ALL)"""


UNTIDY = """SELECT event_id,
    CASE event_id % 8 WHEN 1 THEN event_type || ' "q", x' WHEN 6 THEN NULL WHEN 7 THEN 'a\\nb' ELSE event_type END
        AS label,
    CASE WHEN event_id % 8 = 3 THEN NULL ELSE user_id END AS user_id,
    CASE WHEN event_id % 8 IN (3, 6) THEN NULL ELSE value END AS amount
FROM events WHERE event_id % 8 <> 5"""
REJECTED = """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS label, 'abc' AS user_id,
    CAST(value AS VARCHAR) AS amount
FROM events WHERE event_id % 8 = 5"""


REJECTED_ORIGIN = """SELECT CAST(event_id AS VARCHAR) AS event_id,
    CASE event_id % 8 WHEN 5 THEN 'abc' END AS user_id,
    CASE event_id % 8 WHEN 5 THEN 'user_id is no bigint' ELSE 'short row' END AS reason, TRUE AS origin_known
FROM events WHERE event_id % 8 IN (3, 5)"""


def all_oracles() -> dict[str, str]:
    visit_event = "visitId, event_timestamp, event_name"
    per_hit = f"SELECT DISTINCT {visit_event}"
    item = "SELECT visitId, identity AS event_id, i.item_name AS products_name, i.item_list_name AS products_list_name"
    by_time = f"""(SELECT visitId, {LOGIN_ONE} AS login,
        count(DISTINCT CASE WHEN event_name = 'page_view' THEN event_timestamp END) OVER v AS pageviews,
        count(DISTINCT CASE WHEN event_name = 'screen_view' THEN event_timestamp END) OVER v AS screenviews,
        count(DISTINCT identity) OVER v AS hits,
        max(CASE WHEN event_name IN ('first_visit', 'first_open') THEN 1 ELSE 0 END) OVER v AS new_visit,
        max(CASE WHEN event_name NOT IN {PASSIVE} THEN 1 ELSE 0 END) OVER v AS active,
        max(CASE WHEN {LOGIN_ONE} THEN 1 ELSE 0 END) OVER v AS logged_in
        FROM visited WINDOW v AS (PARTITION BY visitId))"""
    raw_channel = (MEDIUM, f"{SOURCE}.manual_campaign_name", f"{SOURCE}.manual_source")
    lower_channel = (MEDIUM, f"lower({raw_channel[1]})", f"lower({raw_channel[2]})")
    first_values = {"platform": "platform", "country": "geo.country", "city": "geo.city"}
    return {
        "ga4_hits": _hits(fixed.HITS_LAYOUT),
        "ga4_hits_basic": _hits([c for c in fixed.HITS_LAYOUT if c not in fixed.ONLY_IN_FULL]),
        "ga4_visits_attributed": _visits_attributed(fixed.ATTRIBUTED_LAYOUT),
        "ga4_visits_per_visit": _visits_attributed([c for c in fixed.ATTRIBUTED_LAYOUT if c != "engagement_time"]),
        "ga4_visits_basic": _visits_basic(fixed.BASIC_LAYOUT),
        "ga4_products": _numbered(PRODUCTS),
        "ga4_promos": _promotions(fixed.PROMOTION_LAYOUT),
        "ga4_promos_basic": _promotions([c for c in fixed.PROMOTION_LAYOUT if c != "date_5"]),
        "shared_day_hits": _hits(fixed.HITS_LAYOUT),
        "shared_day_products": _numbered(PRODUCTS),
        "shared_day_promos": _promotions(fixed.PROMOTION_LAYOUT),
        "ua_hits": _ua_hits(*fixed.UA_HIT_LAYOUT),
        "ua_visits": _ua_visits(*fixed.UA_VISIT_LAYOUT),
        "ua_promotions": _ua(UA_PROMOTIONS),
        "scan_ga4_day": _ga4(
            "SELECT event_timestamp, event_name, user_pseudo_id, platform FROM ga4_events WHERE event_date = '20240115'"
        ),
        "scan_ua_day": _ua("SELECT fullVisitorId, visitId, channelGrouping, date FROM ga_sessions WHERE date = '20240115'"),
        "csv_roundtrip": _numbered(PRODUCTS),
        "csv_shards_by_size": _numbered(PRODUCTS),
        "csv_load": UNTIDY,
        "csv_load_rejected": REJECTED,
        "csv_rejected_origin": REJECTED_ORIGIN,
        "mart_backfill": _ua(
            " UNION ALL ".join(
                f"{LOADED_PROMOTIONS}, DATE '{day}' AS load_day FROM ({UA_PROMOTIONS.replace('FROM ga_sessions', of_day)})"
                for day, of_day in (
                    ("2024-01-15", "FROM ga_sessions WHERE date = '20240115'"),
                    ("2024-01-16", "FROM ga_sessions WHERE date = '20240116'"),
                )
            )
        ),
        "mart_day_overwrite": _ua(
            f"{LOADED_PROMOTIONS}, DATE '2024-01-15' AS load_day FROM ({UA_PROMOTIONS}) UNION ALL "
            f"{LOADED_PROMOTIONS}, DATE '2024-01-16' AS load_day FROM ({UA_PROMOTIONS})"
        ),
        "mart_day_emptied": _ua(
            f"{LOADED_PROMOTIONS}, DATE '2024-01-16' AS load_day FROM ({UA_PROMOTIONS})"
        ),
        "csv_day_load": _numbered(f"SELECT *, DATE '2024-01-15' AS load_day FROM ({PRODUCTS})"),
        "hits_target_projection": _hits(fixed.TARGET_LAYOUT),
        "normalised_hits": _normalised_hits(),
        "struct_projection": _per_event(
            category="device.category", country="geo.country", manual_source=f"{SOURCE}.manual_source"
        ),
        "select_except": _ga4(
            "SELECT * EXCLUDE (device, geo, collected_traffic_source, event_params, user_properties, items) FROM ga4_events"
        ),
        "clean_events": _visited(f"SELECT fullVisitorId, {visit_event} FROM visited"),
        "interaction_flag": _per_event(interaction=INTERACTION),
        "platform_case": _per_event(platform="platform", kind=KIND),
        "login_flag": _per_event(logged_in=LOGIN, logged_in_or_one=LOGIN_ONE),
        "explode_items": _visited(
            f"{item}, i.item_category AS products_category, i.promotion_id AS promoId, i.promotion_name AS promoName "
            "FROM (SELECT *, unnest(items) AS i FROM visited)"
        ),
        "clean_items_any": _visited(
            "SELECT * FROM (SELECT visitId, nullif(i.item_name, '(not set)') AS products_name, "
            "nullif(i.item_list_name, '(not set)') AS products_list_name, "
            "nullif(i.item_category, '(not set)') AS products_category FROM (SELECT *, unnest(items) AS i FROM visited)) "
            "WHERE products_name IS NOT NULL OR products_list_name IS NOT NULL OR products_category IS NOT NULL"
        ),
        "clean_promos_all": _visited(
            "SELECT * FROM (SELECT visitId, event_name, nullif(i.promotion_id, '(not set)') AS promoId, "
            "nullif(i.promotion_name, '(not set)') AS promoName FROM (SELECT *, unnest(items) AS i FROM visited)) "
            "WHERE promoId IS NOT NULL AND promoName IS NOT NULL"
        ),
        "promo_event_filter": _numbered(
            f"{per_hit}, hitNumber FROM events_numbered WHERE event_name IN ('view_promotion', 'select_promotion')"
        ),
        "visit_id": _per_event(user_pseudo_id="user_pseudo_id", visit=f"user_pseudo_id || {SESSION}"),
        "event_id": _per_event(
            user_pseudo_id="user_pseudo_id",
            identity=f"user_pseudo_id || {SESSION} || event_name || event_timestamp",
        ),
        "get_event_param": _per_event(
            page_path=_param("page_path"),
            video_duration=_param("video_duration", "int_value"),
            video_duration_text=_param("video_duration"),
            missing=_param("no_such_key"),
        ),
        "get_user_property": _per_event(
            login_status=_user("login_status"), newsletter=_user("newsletter_subscriber"), team=_user("user_team")
        ),
        "page_language_upper": _per_event(result=f"upper({_param('page_language')})"),
        "tv_platform": _per_event(result=TV),
        "video_length": _per_event(result=VIDEO_LENGTH),
        "hit_type": _per_event(result=HIT_TYPE),
        "player_id": _per_event(result=PLAYER),
        "content_section": _per_event(result=f"nullif({_param('content_section_1')}, '')"),
        "not_set_to_null": _per_event(result="nullif(geo.country, '(not set)')"),
        "data_cleaning": _per_event(result=_clean("device.language")),
        "parse_event_date": _per_event(result=DAY),
        "items_to_string_promo_id": _per_event(result=_joined("items", "promotion_id", "promotion_id")),
        "items_to_string_promo_name": _per_event(result=_joined("items", "promotion_name", "promotion_name")),
        "items_to_string_product_name": _per_event(result=_joined("items", "item_name", "item_name")),
        "items_to_string_list_name": _per_event(result=_joined("items", "item_list_name", "item_name")),
        "items_to_string_category": _per_event(result=_joined("items", "item_category", "item_name")),
        "effective_medium": _per_event(result=MEDIUM),
        "promo_flags": _per_event(viewed=VIEWED, clicked=CLICKED),
        "create_channel": _per_event(channel=_channel(*raw_channel), lower_channel=_channel(*lower_channel)),
        "channel_grouping": _per_event(channel_group=_group(_channel(*raw_channel))),
        "channel_null_guard": _per_event(channel_group=_guarded(*raw_channel)),
        "sql_functions": _visits_basic(fixed.BASIC_LAYOUT),
        "distinct_rows": _ga4("SELECT DISTINCT event_timestamp, event_name, user_pseudo_id, platform FROM ga4_events"),
        "event_dedup": _visited(f"{per_hit} FROM visited"),
        "hit_number": _numbered(f"{per_hit}, hitNumber FROM events_numbered"),
        "hit_number_join": _numbered("SELECT visitId, identity, hitNumber FROM events_numbered"),
        "session_first_ts": _numbered(f"{per_hit}, first_timestamp FROM events_measured"),
        "hit_is_exit": _numbered(f"{per_hit}, is_exit FROM events_measured"),
        "hit_time": _numbered(
            f"{per_hit}, (event_timestamp - first_timestamp) / 1000000 AS hit_seconds FROM events_measured"
        ),
        "session_utc_date": _numbered(
            f"{per_hit}, CAST(make_timestamp(first_timestamp) AS DATE) AS first_day FROM events_measured"
        ),
        "promo_min_date": _visited(
            f"SELECT DISTINCT visitId, min({DAY}) OVER (PARTITION BY visitId) AS date_5 "
            "FROM (SELECT *, unnest(items) AS i FROM visited)"
        ),
        "session_metrics": _metrics(*METRIC_COLUMNS),
        "session_duration": _metrics("duration"),
        "session_hits": _metrics("hits"),
        "conditional_count_distinct": _metrics("pageviews", "screenviews"),
        "total_visit": _metrics("active"),
        "any_flag": _visited(
            f"SELECT visitId, CAST(new_visit AS BOOLEAN) AS new_visit, CAST(logged_in AS BOOLEAN) AS logged_in FROM {METRICS}"
        ),
        "windowed_count_distinct": _visited(f"SELECT DISTINCT visitId, pageviews, screenviews, hits FROM {by_time}"),
        "windowed_flags": _visited(
            "SELECT DISTINCT visitId, CAST(new_visit AS BIGINT) AS new_visit, CAST(active AS BIGINT) AS active, "
            f"CAST(logged_in AS BOOLEAN) AS logged_in FROM {by_time}"
        ),
        "login_text": _visited(
            f"SELECT DISTINCT visitId, CASE WHEN logged_in = 1 THEN 'true' ELSE 'false' END AS logged_in FROM {by_time}"
        ),
        "time_on_site_screen": _visits_basic(["visitId", "platform_id_10", "timeonesite", "timeOnScreen"]),
        "array_agg_first_row": _visited(
            f"SELECT visitId, platform, country, city FROM {_first_rows(first_values, list(first_values))}"
        ),
        "session_metrics_join": _visited(
            f"SELECT visitId, platform, duration, hits FROM {_first_rows({'platform': 'platform'}, ['platform'])} "
            f"LEFT JOIN {METRICS} USING (visitId)"
        ),
        "session_min_date": _visited(
            f"SELECT DISTINCT visitId, min({DAY}) OVER (PARTITION BY visitId) AS date_5 FROM visited"
        ),
        **{f"first_touch_{group}": _first_touch(group) for group in TOUCH},
        "mart_dq_summary": _numbered(
            _summary(_hits(fixed.HITS_LAYOUT).removeprefix(f"WITH {NUMBERED} "), ["visitId", "hitNumber"])
        ),
        "largest_visits_dq": _ga4(_summary(f"SELECT user_pseudo_id || {SESSION} AS visitId FROM ga4_events", ["visitId"])),
        "ua_explode_hits": _ua(
            f"SELECT visitId, fullVisitorId, hit.hitNumber AS hitNumber, hit.type AS type FROM {UA_HITS}"
        ),
        "ua_custom_dims_hits": _ua_hits("visitId", "fullVisitorId", "hitNumber", *fixed.UA_HIT_DIMENSIONS),
        "ua_custom_dims_session": _ua_visits("visitId", "fullVisitorId", *fixed.UA_SESSION_DIMENSIONS),
        "ua_items_to_string": _ua_hits("visitId", "fullVisitorId", "hitNumber", *fixed.UA_HIT_LISTS),
    }
