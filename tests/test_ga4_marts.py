"""GA4 marts on hand-made rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from hitloom.operators.visit_keys import event_id, visit_id, with_visits
from hitloom.plans import hits, products, visits
from tests.builders import as_bag, event, events_frame, item

D1 = datetime.date(2024, 1, 1)
D2 = datetime.date(2024, 1, 2)


def test_keys(spark):
    frame = events_frame(
        spark, event(5, "n"), event(5, None), event(5, "n", visitor=None), event(5, "n", session=None)
    )
    keys = [tuple(r) for r in frame.select(visit_id(), event_id()).collect()]
    assert keys == [("u1", "u1n5"), ("u1", None), (None, None), (None, None)]
    assert as_bag(with_visits(frame), "visitId", "event_name") == [("u1", "n"), ("u1", None)]


def test_hits_layouts(spark):
    frame = events_frame(spark, event(5, "n"))
    full = hits.hits(frame)
    assert full.columns == list(hits.LAYOUT) and len(full.columns) == 48
    assert len(hits.hits(frame, full=False).columns) == 45
    target = hits.target_layout(full).columns
    assert sorted(target) == sorted(full.columns)
    assert target[:5] == ["visitId", "fullVisitorId", "datedate", "hitNumber", "product_id_14"]
    assert target[25:29] == ["hit_type_59", "hit_time_60", "hit_isExit_61", "hit_isInteraction_62"]
    assert "void" not in dict(full.dtypes).values()


def test_hits_values(spark):
    frame = events_frame(
        spark,
        event(1_000_000, "page_view", params=[("page_language", "en"), ("content_section_1", "")]),
        event(1_000_000, "page_view", params=[("page_language", "en"), ("content_section_1", "")]),
        event(3_500_000, "video_start", params=[("video_duration", 30), ("player_id", 7)]),
        event(
            3_500_000,
            "view_promotion",
            params=[("video_duration", 30), ("player_id", "p")],
            items=[item("b", "l", "(not set)", "P2", "N1"), item("a", None, "c", "P1", "N2")],
            device=("smart tv", "tvOS", None),
        ),
        event(2_000_000, None),
    )
    rows = {r["hitNumber"]: r.asDict() for r in hits.hits(frame).collect()}
    assert set(rows) == {1, None, 3, 4}
    first, nameless, video, promotion = rows[1], rows[None], rows[3], rows[4]
    assert (first["language_26"], first["content_section_1_85"], first["hit_type_59"]) == ("EN", None, "PAGE")
    assert (first["hit_time_60"], first["hit_isExit_61"], first["datedate"]) == (0.0, False, D1.replace(1970))
    assert (nameless["hit_time_60"], nameless["hit_isExit_61"], nameless["hit_isInteraction_62"]) == (1.0, None, False)
    assert (video["video_length_73"], video["player_id_74"], video["hit_isInteraction_62"]) == (30, "7", True)
    assert (promotion["video_length_73"], promotion["player_id_74"]) == (None, "p")
    assert (promotion["promoIsView"], promotion["promoIsClick"], promotion["hit_isExit_61"]) == (True, False, True)
    assert promotion["TV_Platforms_55"] == "tvOS"
    assert promotion["promoId"] == "P1,P2" and promotion["promoName"] == "N1,N2"
    assert promotion["products_name_75"] == "a,b" and promotion["products_list_name_76"] == "l"
    assert promotion["products_category_77"] == "c" and first["products_name_75"] == ""


def test_events_that_differ_only_in_a_parameter_stay_apart(spark):
    frame = events_frame(
        spark, event(1, "n", params=[("page_path", "a")]), event(1, "n", params=[("page_path", "b")])
    )
    assert as_bag(hits.hits(frame), "hitNumber", "page_name_17") == [(1, "a"), (1, "b")]


def test_products(spark):
    frame = events_frame(
        spark,
        event(1, "page_view"),
        event(2, "view_item", items=[item("a"), item("a"), item("(not set)", None, "(not set)"), item(None, "l")]),
        event(2, "view_item", items=[item("a")]),
        event(3, "view_item", items=[]),
        event(4, None, items=[item("a")]),
        event(5, None, items=[item("a")]),
    )
    assert as_bag(products.products(frame)) == sorted(
        [("u1", "u", "a", None, None, 2), ("u1", "u", None, "l", None, 2), ("u1", "u", "a", None, None, None)],
        key=repr,
    )


def test_adding_copies_changes_no_mart(spark):
    promo = [item("a", promo_id="P1", promo_name="N")]
    rows = [event(1, "view_promotion", items=promo), event(2, "view_item", items=promo), event(3, "n")]
    once, twice = events_frame(spark, *rows), events_frame(spark, *rows, *rows)
    for mart in (hits.hits, products.products, products.promotions, visits.visits_basic, visits.visits_attributed):
        assert as_bag(mart(once)) == as_bag(mart(twice))


def test_promotions(spark):
    promo = item(promo_id="P1", promo_name="N")
    frame = events_frame(
        spark,
        event(1, "view_item", date="20240103"),
        event(2, "scroll", items=[item("x")], date="20240102"),
        event(3, "view_promotion", items=[promo, item(promo_id="P2"), item(promo_id="(not set)", promo_name="N")], date="20240103"),
        event(4, "select_promotion", items=[promo], date="20240103"),
        event(0, "page_view", date="20240101", items=[]),
        event(1, "view_promotion", visitor="w", items=[promo], date="20240105"),
    )
    expected = [
        ("u1", "u", D2, True, False, "P1", "N", 4),
        ("u1", "u", D2, False, True, "P1", "N", 5),
        ("w1", "w", datetime.date(2024, 1, 5), True, False, "P1", "N", 1),
    ]
    assert as_bag(products.promotions(frame)) == sorted(expected, key=repr)
    assert products.promotions(frame, with_date=False).columns == [
        c for c in products.PROMOTION_LAYOUT if c != "date_5"
    ]


TRAFFIC = ("id1", "camp", "Google", "cpc", None)
UNKNOWN = ("id2", "late", None, "email", None)


def test_first_touch_takes_the_first_complete_event(spark):
    frame = events_frame(
        spark,
        event(1, "a", platform=None, geo=("N", None), traffic=UNKNOWN),
        event(2, "b", platform="Web", geo=("N", "C"), traffic=TRAFFIC, params=[("country", "X")]),
        event(3, "c", platform="ios", geo=("M", "D"), traffic=TRAFFIC, params=[("country", "Y")]),
    )
    row = visits.visits_attributed(frame, grain="visit").first()
    assert (row["platform_id_10"], row["country_name_30"], row["country_code_uefa_30"]) == ("Website", "N", "X")
    assert (row["City_Name_65"], row["Traffic_Source_62"], row["acq_channel_id_12"]) == ("C", "Google", "id1")
    assert row["channel_name_13"] == "(Other)"
    assert (row["timeonesite"], row["timeOnScreen"], row["device_category_24"]) == (2 / 1_000_000, None, None)


def test_first_touch_without_complete_event_takes_the_earliest(spark):
    frame = events_frame(
        spark,
        event(2, "b", traffic=("id", "camp", "s", None, None), geo=("M", "D")),
        event(1, "z", traffic=UNKNOWN, geo=(None, "C")),
    )
    row = visits.visits_attributed(frame, grain="visit").first()
    assert (row["acq_channel_id_12"], row["Campaign_56"], row["Traffic_Source_62"]) == ("id2", "late", None)
    assert (row["Custom_Acq_Channel_Name"], row["country_name_30"], row["City_Name_65"]) == ("email", None, "C")


def test_placeholder_texts_count_as_unknown_unless_told_otherwise(spark):
    frame = events_frame(
        spark,
        event(1, "a", device=("(not set)", "", "en")),
        event(2, "b", device=("mobile", "os", "en")),
    )
    assert visits.visits_attributed(frame).first()["device_category_24"] == "mobile"
    assert visits.visits_attributed(frame, clean=lambda text: text).first()["device_category_24"] == "(not set)"


def test_attributed_grain(spark):
    frame = events_frame(
        spark,
        event(1, "a", params=[("engagement_time_msec", 5)]),
        event(2, "b", params=[("engagement_time_msec", 5)]),
        event(3, "c", params=[("engagement_time_msec", 6)]),
        event(4, "d"),
    )
    assert as_bag(visits.visits_attributed(frame), "engagement_time", "hits") == [(5, 4), (6, 4), (None, 4)]
    assert visits.visits_attributed(frame, grain="visit").count() == 1
    assert visits.visits_attributed(frame).columns == list(visits.ATTRIBUTED_LAYOUT)
    with pytest.raises(ValueError):
        visits.visits_attributed(frame, grain="day")


def test_visit_counts(spark):
    frame = events_frame(
        spark,
        event(1, "page_view", user=[("login_status", "1")]),
        event(1, "page_view"),
        event(2, "page_view"),
        event(2, "screen_view"),
        event(3, None),
        event(9, "first_open", date="20231231"),
        event(1, "scroll", visitor="w"),
    )
    attributed = {r["visitId"]: r for r in visits.visits_attributed(frame, grain="visit").collect()}
    basic = {r["visitId"]: r for r in visits.visits_basic(frame).collect()}
    for mart in (attributed, basic):
        row = mart["u1"]
        assert (row["hits"], row["pageviews_44"], row["screenviews_44"], row["newVisits"]) == (4, 2, 1, 1)
        assert (row["total_visit_51"], mart["w1"]["total_visit_51"], mart["w1"]["hits"]) == (1, 0, 1)
    assert (attributed["u1"]["is_login"], attributed["u1"]["nbr_loggedin_user_46"]) == (True, "true")
    assert basic["u1"]["nbr_loggedin_user_46"] is False
    assert attributed["u1"]["date_5"] == datetime.date(2023, 12, 31) and basic["u1"]["date_5"] == D1
    assert attributed["u1"]["channel_name_13"] is None and basic["u1"]["channel_name_13"] == "(Other)"


def test_results_do_not_depend_on_row_order(spark):
    rows = [
        event(i % 4, "abc"[i % 3], session=i % 5, platform=("Web", "ios")[i % 2], items=[item(f"i{i % 6}", promo_id="P", promo_name="N")])
        for i in range(60)
    ]
    plain, shuffled = events_frame(spark, *rows), events_frame(spark, *reversed(rows)).repartition(7, F.rand(1))
    for mart in (hits.hits, products.products, products.promotions, visits.visits_basic, visits.visits_attributed):
        assert as_bag(mart(plain)) == as_bag(mart(shuffled))
