"""Scans, CSV export and load, and mart writes."""

import datetime
import gzip
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitloom.plans import quality
from hitloom.session import shared_folder
from hitloom.sources import exports, marts
from tests.builders import as_bag, event, events_frame, session, sessions_frame

SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("day", T.DateType()),
        T.StructField("flag", T.BooleanType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)
DAY = datetime.date(2024, 1, 2)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_day_scan_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "events")
    events_frame(spark, event(1, "a", date="20240101"), event(2, "b", date="20240102")).write.partitionBy(
        "event_date"
    ).parquet(path)
    day = exports.ga4_events(spark, path, DAY)
    assert as_bag(day, "event_name", "event_date") == [("b", "20240102")]
    assert "PartitionFilters: [isnotnull(event_date" in plan_of(day)
    assert exports.ga4_events(spark, path).count() == 2


def test_day_scan_of_sessions(spark, tmp_path):
    path = str(tmp_path / "sessions")
    sessions_frame(spark, session("a"), session("b")).write.partitionBy("date").parquet(path)
    assert exports.ua_sessions(spark, path, datetime.date(2024, 1, 1)).count() == 2
    assert exports.ua_sessions(spark, path, DAY).count() == 0
    assert exports.yesterday() < datetime.date.today()


def test_csv_round_trip(spark, tmp_path):
    rows = [
        ('a"b,c', 1, DAY, True, 0.1),
        (" t ", -5, None, False, 1e-7),
        ("line\\n", None, DAY, None, 3.0),
        ("two\nlines", 2, DAY, True, None),
        ("", 3, DAY, True, 2.5),
        (None, 4, None, None, None),
        ('"', 6, DAY, True, 1.0),
        ("\\", 7, DAY, True, 1.0),
    ]
    path = str(tmp_path / "csv")
    mart = spark.createDataFrame(rows, SCHEMA)
    marts.export_csv(mart, path)
    marts.export_csv(mart, path)
    good, bad = marts.load_csv(spark, path, SCHEMA)
    assert good.schema.simpleString() == SCHEMA.simpleString()
    assert as_bag(good) == as_bag(marts.normalise_for_load(mart))
    assert ("t", -5, None, False, 1e-7) in as_bag(good)
    assert bad.count() == 0
    assert all(f.name.endswith(".csv.gz") for f in (tmp_path / "csv").glob("part-*"))


def test_csv_shards(spark, tmp_path):
    marts.export_csv(spark.range(25).coalesce(1), str(tmp_path / "csv"), rows_per_file=10)
    assert len(list((tmp_path / "csv").glob("part-*"))) == 3


@pytest.mark.parametrize("partitions", [1, 40])
def test_csv_shards_by_size(spark, tmp_path, partitions):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    mart = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(partitions)
    marts.export_csv(mart, str(tmp_path / "csv"), bytes_per_file=128 << 10)
    sizes = [f.stat().st_size for f in (tmp_path / "csv").glob("part-*")]
    assert max(sizes) <= 128 << 10 and sum(sizes) / len(sizes) > 32 << 10
    loaded = marts.load_csv(spark, str(tmp_path / "csv"), mart.schema)[0]
    assert loaded.exceptAll(mart).count() == 0 and loaded.count() == 20_000
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before


def test_untidy_csv(spark, tmp_path):
    lines = [
        '"a""b,c",1,2024-01-02,true,0.5',
        "  t  , 2 ,2024-01-02,true,0.5",
        "short,3",
        "long,4,2024-01-02,true,0.5,more,still more",
        "bad,abc,2024-01-02,true,0.5",
        '"",5,,,',
        "raw\\n,6,2024-01-02,false,0.5",
        "bad day,7,2024-13-02,true,0.5",
    ]
    with gzip.open(tmp_path / "part.csv.gz", "wt") as file:
        file.write("\n".join(lines) + "\n")
    good, bad = marts.load_csv(spark, str(tmp_path), SCHEMA)
    assert as_bag(good, "text", "number", "day") == sorted(
        [
            ('a"b,c', 1, DAY),
            ("t", 2, DAY),
            ("short", 3, None),
            ("long", 4, DAY),
            (None, 5, None),
            ("raw\\n", 6, DAY),
        ],
        key=repr,
    )
    assert as_bag(bad, "text", "number") == sorted([("bad day", "7"), ("bad", "abc")], key=repr)


def test_writing_a_day_again_replaces_only_that_day(spark, tmp_path):
    path = str(tmp_path / "mart")
    first = spark.createDataFrame([("a",), (" ",)], "text string")
    marts.write_mart(first, path, datetime.date(2024, 1, 1))
    marts.write_mart(first, path, DAY)
    marts.write_mart(spark.createDataFrame([(" b ",)], "text string"), path, DAY)
    found = as_bag(spark.read.parquet(path), "text", "load_day")
    assert found == sorted([("a", datetime.date(2024, 1, 1)), (None, datetime.date(2024, 1, 1)), ("b", DAY)], key=repr)


def test_quality_summary(spark):
    mart = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", 1), ("b", None), (None, 2)], "k string, n int")
    assert tuple(quality.summary(mart, ["k", "n"]).first()) == (6, 2, 4, 1, 3)
    assert tuple(quality.summary(mart.where(F.lit(False)), ["k", "n"]).first()) == (0, 0, 0, 0, 0)


def _session(folder, of_context=None):
    conf = SimpleNamespace(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getCheckpointDir=lambda: of_context))


def test_shared_folder():
    assert shared_folder(_session("/shared/tables/", "/other")) == "/shared/tables"
    assert shared_folder(_session(None, "/other")) == "/other"
    with pytest.raises(ValueError):
        shared_folder(_session(None))


def test_a_day_without_rows_is_emptied_and_others_stay(spark, tmp_path):
    path, other = str(tmp_path / "mart"), datetime.date(2024, 1, 1)
    full = spark.createDataFrame([("a",)], "text string")
    empty = full.where(F.lit(False))
    marts.write_mart(empty, path, DAY)
    assert marts.read_mart(spark, path, full.schema).count() == 0
    marts.write_mart(full, path, other)
    marts.write_mart(full, path, DAY)
    marts.write_mart(empty, path, DAY)
    assert as_bag(marts.read_mart(spark, path, full.schema), "text", "load_day") == [("a", other)]


def test_csv_and_parquet_trim_alike(spark, tmp_path):
    mart = spark.createDataFrame([("\tx\x01 ",), ("\n",), ("a b",)], "text string")
    marts.export_csv(mart, str(tmp_path / "csv"))
    loaded = marts.load_csv(spark, str(tmp_path / "csv"), mart.schema)[0]
    assert as_bag(loaded) == as_bag(marts.normalise_for_load(mart)) == sorted([("x",), (None,), ("a b",)], key=repr)


def test_rejected_rows_have_their_origin(spark, tmp_path):
    files = {
        "a.csv": ["x,1,,,", "y,z,,,", "w,2", "v,3,2024-13-02,maybe,"],
        "b.csv": ["p,4,,,", "q,5,,,", '"open,6', "swallowed,7,,,"],
    }
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    good, bad = marts.load_csv(spark, str(tmp_path), SCHEMA)
    assert [r[0] for r in as_bag(good, "number")] == [1, 2, 4, 5]
    found = [(r["file"].rsplit("/", 1)[1], r["record"], r["reason"]) for r in bad.collect()]
    assert sorted(found) == [
        ("a.csv", 2, "number is no bigint"),
        ("a.csv", 4, "day is no date; flag is no boolean"),
        ("b.csv", 3, "unbalanced quotes"),
    ]
    short = marts.load_csv(spark, str(tmp_path), SCHEMA, reject_short=True)[1].where("reason = 'short row'")
    assert [(r["text"], r["number"], r["record"]) for r in short.collect()] == [("w", "2", 3)]


def test_several_days_in_one_write(spark, tmp_path):
    path, days = str(tmp_path / "mart"), [datetime.date(2024, 1, d) for d in (1, 2, 3, 4)]
    rows = spark.createDataFrame([(" a ", days[0]), ("b", days[1]), ("c", days[3])], "text string, load_day date")
    for day in days:
        marts.write_mart(spark.createDataFrame([("old",)], "text string"), path, day)
    marts.write_days(rows, path, days[:3])
    found = as_bag(marts.read_mart(spark, path, T.StructType([SCHEMA[0]])), "text", "load_day")
    assert found == sorted([("a", days[0]), ("b", days[1]), ("old", days[3])], key=repr)
