"""Writing marts: gzip CSV, a tolerant CSV load, and day-partitioned Parquet."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_DAY = "load_day"
#: What the CSV reader trims: all characters up to the blank.
TRIMMED = "".join(map(chr, range(33)))


_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: AQE joins a rest of up to this share of a partition to its neighbour.
_REST = 0.2


@contextmanager
def partitions_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Let AQE aim at partitions of ``size`` bytes, for the queries started inside."""
    before = spark.conf.get(_ADVISORY, None)
    spark.conf.set(_ADVISORY, f"{size}b")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_ADVISORY)
        else:
            spark.conf.set(_ADVISORY, before)


def export_csv(mart: DataFrame, path: str, rows_per_file: int = 0, bytes_per_file: int = 0) -> None:
    """Write sharded gzip CSV without header, replacing what is there.

    Quotes are doubled and blanks kept.  Gzip files cannot be split when they are read back, so their
    size bounds the tasks of the load: ``rows_per_file`` bounds a shard's rows.  ``bytes_per_file`` spreads
    the rows anew so that no shard's rows take more than that, as Spark shuffles them; gzip makes the files
    smaller still.  Few large partitions are divided by it and many small ones merged.
    """
    if bytes_per_file:
        with partitions_of(mart.sparkSession, max(1, int(bytes_per_file / (1 + _REST)))):
            return export_csv(mart.hint("rebalance"), path, rows_per_file)
    (
        mart.write.mode("overwrite")
        .option("compression", "gzip")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


#: Columns that rejected rows have besides their fields.
ORIGIN = ("file", "record", "reason")
_RAW = "_raw_record"


def _read_texts(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All fields as trimmed text: short rows are padded, surplus fields dropped, '' is NULL.

    The raw text of rows with another number of fields is kept, and each row's file.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*columns, _RAW)])
    texts = (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _RAW)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    return normalise_for_load(texts).withColumn("file", F.col("_metadata.file_path"))


def _reason(schema: T.StructType, short_rows: bool) -> Column:
    """Why a row cannot be loaded; '' if it can."""
    unquoted = F.regexp_replace(_RAW, '"[^"]*"', "")
    faults = {"unbalanced quotes": unquoted.contains('"')}
    if short_rows:
        faults["short row"] = ~unquoted.contains('"') & (F.size(F.split(unquoted, ",")) < len(schema))
    for field in schema:
        cast = F.col(field.name).try_cast(field.dataType)
        faults[f"{field.name} is no {field.dataType.simpleString()}"] = F.col(field.name).isNotNull() & cast.isNull()
    return F.concat_ws("; ", *[F.when(fault, text) for text, fault in faults.items()])


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType, reject_short: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Read exported CSV and go on past bad rows.

    Returns the typed rows, and as text the rows that do not fit: those with a field that does not fit its
    type or with quotes that do not close, and with ``reject_short`` those that lack fields, which are
    padded otherwise.  Rejected rows have their ``file``, the number of their ``record`` in it, from 1, and
    the ``reason``.  Records are counted only when rejected rows are read, by reading the files once more.
    """
    texts = _read_texts(spark, path, schema.names)
    bad = _reason(schema, reject_short) != ""
    good = texts.where(~bad).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])
    # A file is read by one task from its beginning, so its records have running numbers.
    placed = texts.withColumn("at", F.monotonically_increasing_id())
    first = placed.groupBy("file").agg(F.min("at").alias("first"))
    reason = _reason(schema, reject_short).alias("reason")
    rejected = placed.where(bad).select(*schema.names, "file", "at", reason).join(first, "file")
    return good, rejected.select(*schema.names, "file", (F.col("at") - F.col("first") + 1).alias("record"), "reason")


def normalise_for_load(mart: DataFrame) -> DataFrame:
    """What a warehouse holds after the CSV hop: texts without blanks and control characters around, empty ones NULL."""
    trimmed = {f.name: F.btrim(f"`{f.name}`", F.lit(TRIMMED)) for f in mart.schema if f.dataType == T.StringType()}
    texts = {name: F.when(text != "", text) for name, text in trimmed.items()}
    return mart.withColumns(texts) if texts else mart


def write_mart(mart: DataFrame, path: str, day: date, rows_per_file: int = 0) -> None:
    """Replace one day of a Parquet mart, also by nothing; running it again changes nothing.

    The day is a folder of its own, which is overwritten as a whole: a day without rows is empty
    afterwards.  ``rows_per_file`` bounds a file; small ones are merged by AQE where a mart ends in a
    shuffle.
    """
    rows = normalise_for_load(mart)
    rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/{LOAD_DAY}={day}")


def write_days(mart: DataFrame, path: str, days: Sequence[date]) -> None:
    """Replace several days of a Parquet mart by one write; ``load_day`` tells the rows' days.

    Only the given days are touched: those with rows are overwritten as partitions, and those without,
    which the write counts on its way, are emptied.
    """
    seen = Observation()
    counts = [F.count_if(F.col(LOAD_DAY) == F.lit(day)).alias(str(day)) for day in days]
    rows = normalise_for_load(mart).where(F.col(LOAD_DAY).isin(*days)).observe(seen, *counts)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD_DAY).parquet(path)
    nothing = mart.drop(LOAD_DAY).limit(0)
    for day in days:
        if not seen.get[str(day)]:
            write_mart(nothing, path, day)


def read_mart(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet mart with its days, also when all of them are empty."""
    days = T.StructType([*schema.fields, T.StructField(LOAD_DAY, T.DateType())])
    return spark.read.schema(days).parquet(path)
