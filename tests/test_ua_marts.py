"""Session-based marts on hand-made rows."""

import itertools

from hitloom.plans import sessions
from tests.builders import as_bag, hit, session, sessions_frame


def test_visits_keep_repeated_dimensions_as_a_bag(spark):
    frame = sessions_frame(
        spark,
        session(dimensions=[(2, "X"), (2, "Y"), (2, "Y"), (23, "App"), (99, "z")]),
        session("w", dimensions=None),
    )
    found = as_bag(sessions.visits(frame), "fullVisitorId", *sessions.SESSION_DIMENSIONS)
    expected = [("u", v, "App", None) for v in ("X", "Y", "Y")] + [("w", None, None, None)]
    assert found == sorted(expected, key=repr)
    assert sessions.visits(frame).columns == list(sessions.VISIT_LAYOUT)


def test_hits(spark):
    promotion = [("P2", "a"), ("P1", "b"), (None, "c"), ("P1", "(not set)")]
    product = [("n2", "l2", None), ("n1", "l1", "c1")]
    frame = sessions_frame(
        spark,
        session(hits=[hit(1, [(1, "en"), (106, "tv")], promotion, product), hit(1, [(1, "en"), (106, "tv")], promotion, product), hit(2)]),
        session("w", hits=[]),
        session("x", hits=None),
    )
    mart = sessions.hits(frame)
    assert mart.columns == list(sessions.HIT_LAYOUT) and len(mart.columns) == 45
    rows = {r["hitNumber"]: r for r in mart.collect()}
    assert set(rows) == {1, 2}
    assert (rows[1]["language_26"], rows[1]["TV_Platforms_55"], rows[1]["Match_ID"]) == ("en", "tv", None)
    assert rows[1]["promoId"] == "P1,P1,P2" and rows[1]["promoName"] == "c,(not set),b,a"
    assert rows[1]["products_name_75"] == "n1,n2" and rows[1]["products_category_77"] == "c1"
    assert rows[2]["promoId"] == "" and rows[2]["language_26"] is None
    assert rows[1]["hostname_21"] == rows[1]["product_name_hostname_15"] == "host"
    assert rows[1]["Source_Property_Tracking_ID_20"] == rows[1]["product_id_14"] == "tracking"


def test_hits_multiply_by_repeated_dimensions(spark):
    dimensions = [(1, "en"), (1, "fr"), (10, "a"), (10, "b"), (10, "a"), (31, "club"), (31, "club2"), (4, "t")]
    frame = sessions_frame(spark, session(hits=[hit(1, dimensions)]))
    found = as_bag(sessions.hits(frame), "language_26", "competition_16", "page_type_28")
    assert found == sorted((x, y, "t") for x, y in itertools.product(("en", "fr"), ("a", "b")))


def test_hits_agree_with_one_explode_per_dimension(spark):
    pool = [(1, "a"), (1, "b"), (4, "c"), (9, "d"), (9, "e"), (4, None), (None, "f")]
    rows = [
        session(f"u{n}", hits=[hit(1, list(chosen))])
        for n, chosen in enumerate(itertools.combinations(pool, 4))
    ]
    frame = sessions_frame(spark, *rows)
    exploded = sessions.explode_hits(frame)
    for name in ("language_26", "page_type_28"):
        exploded = sessions.explode_dimension(
            exploded, exploded["hit"]["customDimensions"], name, sessions.HIT_DIMENSIONS[name]
        )
    columns = ("fullVisitorId", "language_26", "page_type_28")
    assert as_bag(sessions.hits(frame), *columns) == as_bag(exploded.select(*columns).distinct())


def test_promotions(spark):
    frame = sessions_frame(
        spark, session(hits=[hit(1, promotion=[("P1", "a"), ("P1", "a"), (None, "b")]), hit(2, promotion=[]), hit(3)])
    )
    assert as_bag(sessions.promotions(frame)) == sorted(
        [(1, "u", 1, "P1", "a", True, False), (1, "u", 1, None, "b", True, False)], key=repr
    )
    assert sessions.promotions(frame).columns == list(sessions.PROMOTION_LAYOUT)
