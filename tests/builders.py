"""Small hand-made export rows."""

from hitloom.schemas import GA4_EVENTS, UA_SESSIONS


def bag(*entries, user=False):
    """Entries from (key, value) pairs: text goes to the text slot, a number to the integer slot."""
    extra = (None,) if user else ()
    return [
        (key, (value, None, None, None, *extra) if isinstance(value, str) else (None, value, None, None, *extra))
        for key, value in entries
    ]


def item(name=None, list_name=None, category=None, promo_id=None, promo_name=None):
    return (name, list_name, category, promo_id, promo_name)


def event(
    timestamp,
    name,
    visitor="u",
    session=1,
    params=(),
    user=(),
    items=None,
    date="20240101",
    platform=None,
    device=(None, None, None),
    geo=(None, None),
    traffic=(None, None, None, None, None),
    stream=None,
):
    keyed = list(params) if session is None else [("ga_session_id", session), *params]
    return (
        timestamp,
        name,
        visitor,
        stream,
        platform,
        device,
        geo,
        traffic,
        bag(*keyed),
        bag(*user, user=True),
        items,
        date,
    )


def events_frame(spark, *rows):
    return spark.createDataFrame(list(rows), GA4_EVENTS)


def hit(number, dimensions=None, promotion=None, product=None, kind="PAGE"):
    return (
        number,
        number * 10,
        kind,
        False,
        None,
        ("host", "title"),
        ("screen",),
        ("tracking", "display"),
        ("category", "action", "label"),
        (True, False),
        promotion,
        product,
        dimensions,
    )


def session(visitor="u", visit=1, dimensions=None, hits=None):
    return (
        visitor,
        visit,
        "ch",
        ("code", "medium", "campaign", "source"),
        ("mobile",),
        ("N1", "ci1", "C1"),
        (1, None, 1, 10, 2, None, None),
        dimensions,
        hits,
        "20240101",
    )


def sessions_frame(spark, *rows):
    return spark.createDataFrame(list(rows), UA_SESSIONS)


def as_bag(frame, *columns):
    """Rows as sortable tuples, in a fixed order."""
    rows = frame.select(*columns).collect() if columns else frame.collect()
    return sorted((tuple(row) for row in rows), key=repr)
