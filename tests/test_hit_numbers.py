"""Hit numbers against a plain in-memory ranking."""

import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hitloom.operators.hit_numbers import distinct_events, hit_table
from tests.builders import as_bag

SCHEMA = "visitId string, event_timestamp long, event_name string, extra long"


def _lowest_first(key):
    return tuple((value is not None, value) for value in key)


def brute_force(rows):
    visits = defaultdict(set)
    extras = defaultdict(list)
    for visit, timestamp, name, extra in rows:
        visits[visit].add((timestamp, name))
        if extra is not None:
            extras[visit].append(extra)
    expected = []
    for visit, keys in visits.items():
        ordered = sorted(keys, key=_lowest_first)
        times = [t for t, _ in ordered if t is not None]
        complete = [None not in key for key in ordered]
        last = max((n for n, ok in enumerate(complete, 1) if ok), default=None)
        for number, ((timestamp, name), ok) in enumerate(zip(ordered, complete), 1):
            expected.append(
                (
                    visit,
                    timestamp,
                    name,
                    number if ok else None,
                    number == last if ok else None,
                    min(times, default=None),
                    min(extras[visit], default=None),
                )
            )
    return sorted(expected, key=repr)


def numbered(spark, rows, slice_micros):
    frame = spark.createDataFrame(rows, SCHEMA)
    second_micros = 1_000_000 if slice_micros > 1_000_000 else 1
    table = hit_table(frame, slice_micros, second_micros, lowest=F.col("extra"))
    return as_bag(
        table, "visitId", "event_timestamp", "event_name", "hitNumber", "is_exit", "first_timestamp", "lowest"
    )


@pytest.mark.parametrize("slice_micros", [1, 7, 60_000_000])
def test_random_events(spark, slice_micros):
    pick = random.Random(slice_micros)
    rows = [
        (
            pick.choice(["a", "b", "c"]),
            pick.choice([None, *range(-5, 60)]),
            pick.choice([None, "x", "y", ""]),
            pick.choice([None, 1, 2, 3]),
        )
        for _ in range(600)
    ]
    assert numbered(spark, rows, slice_micros) == brute_force(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b"]),
            st.one_of(st.none(), st.integers(-20, 20)),
            st.one_of(st.none(), st.sampled_from(["x", "y"])),
            st.one_of(st.none(), st.integers(0, 3)),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_any_events(spark, rows):
    assert numbered(spark, rows, 5) == brute_force(rows)


def test_two_events_on_the_last_timestamp(spark):
    rows = [("a", 1, "z", None), ("a", 9, "b", None), ("a", 9, "c", None)]
    exits = {(t, n): e for _, t, n, _, e, _, _ in numbered(spark, rows, 60)}
    assert exits == {(1, "z"): False, (9, "b"): False, (9, "c"): True}


def test_nameless_event_uses_up_a_number(spark):
    rows = [("a", 1, None, None), ("a", 1, "b", None), ("a", 2, None, None)]
    assert [(n, number, e) for _, _, n, number, e, _, _ in numbered(spark, rows, 60)] == [
        ("b", 2, True),
        (None, None, None),
        (None, None, None),
    ]


def test_copies_do_not_change_numbers(spark):
    rows = [("a", t, "x", None) for t in range(5)]
    assert numbered(spark, rows * 3, 2) == numbered(spark, rows, 2)
    copies = distinct_events(spark.createDataFrame(rows * 3, SCHEMA)).select("copies").distinct().collect()
    assert [r[0] for r in copies] == [3]


def test_row_order_and_partitioning_do_not_matter(spark):
    frame = spark.range(2000).select(
        F.concat(F.lit("v"), F.col("id") % 7).alias("visitId"),
        (F.col("id") * 37 % 501).alias("event_timestamp"),
        F.concat(F.lit("n"), F.col("id") % 3).alias("event_name"),
    )
    plain = as_bag(hit_table(frame, 10))
    assert as_bag(hit_table(frame.repartition(13).orderBy(F.rand(3)), 10)) == plain


def test_numbers_have_no_gaps(spark):
    frame = spark.range(3000).select(
        F.concat(F.lit("v"), F.col("id") % 11).alias("visitId"),
        (F.col("id") * 7919 % 1009).alias("event_timestamp"),
        F.lit("n").alias("event_name"),
    )
    gaps = (
        hit_table(frame, 50)
        .groupBy("visitId")
        .agg(
            F.max("hitNumber").alias("high"),
            F.count_distinct("hitNumber").alias("many"),
            F.count("*").alias("all"),
            F.count(F.when(F.col("is_exit"), 1)).alias("exits"),
        )
        .where("high <> many or many <> all or exits <> 1")
    )
    assert gaps.count() == 0
