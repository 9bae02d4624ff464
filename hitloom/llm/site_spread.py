"""Cross-site boilerplate lines by the spread of each line over distinct sites.

Per line a HyperLogLog sketch of its sites is built, merged by aggregation.  Lines whose estimate lies
near the threshold get an exact distinct count.  A line on at least ``min_sites`` sites is widespread.

A copied document makes its own lines widespread too, and they must not be cut out of its copies.  So
copies don't vote: a text of whose characters more than ``max_shared`` stand in widespread lines is taken
for a copy, and the sites of the widespread lines are counted again over all other texts.  Lines that
reach ``min_sites`` there are boilerplate, alone or in blocks of several lines, and leave every text, those
that did not vote included.

Defined cases: a missing text has no lines and stays missing; an empty text is one empty line, and lines
of blanks alone are never boilerplate; a missing site counts as none; repeated rows and equal texts are
judged alike; lines that occur twice in a text count once, and both go; a line of any length is one line;
an empty table stays empty; extra columns are kept as they are, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.workspace import Workspace

#: Registers of a sketch as a power of two, and the part of the threshold that counts as near.
SKETCH_BITS = 10
NEAR = 0.2


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_occurrences(docs: DataFrame, text: str = "text", site: str = "source") -> DataFrame:
    """One row per row and different line: hashes of text and line, the site, and the characters of line and text."""
    lines = F.array_distinct(F.filter(_lines(F.col(text)), lambda x: F.trim(x) != ""))
    split = docs.select(F.col(site).alias("site"), F.xxhash64(F.col(text)).alias("text_hash"), lines.alias("lines"))
    total = F.aggregate("lines", F.lit(0).cast("long"), lambda n, x: n + F.length(x))
    hashed = F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("line"), F.length(x).alias("length")))
    # The outer form spares a second split of the text, which a test for empty arrays would need.
    rows = split.select("site", "text_hash", total.alias("total"), F.explode_outer(hashed).alias("at"))
    return rows.select("site", "text_hash", "total", "at.line", "at.length").where(F.col("line").isNotNull())


def widespread_lines(occurrences: DataFrame, min_sites: int) -> DataFrame:
    """The hashes of lines on at least so many sites, one row each."""
    sketched = occurrences.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sites"))
    spread = sketched.select("line", F.hll_sketch_estimate("sites").alias("estimate")).where(F.col("estimate") >= min_sites * (1 - NEAR))
    near = spread.where(F.col("estimate") <= min_sites * (1 + NEAR)).select("line")
    exact = (
        occurrences.select("line", "site")
        .distinct()
        .join(near, "line", "left_semi")
        .groupBy("line")
        .agg(F.count("site").alias("n_sites"))
        .where(F.col("n_sites") >= min_sites)
        .select("line")
    )
    return spread.where(F.col("estimate") > min_sites * (1 + NEAR)).select("line").unionByName(exact)


def copied_texts(shared: DataFrame, max_shared: float) -> DataFrame:
    """The hashes of texts that consist of widespread lines, given the occurrences of those."""
    once = shared.select("text_hash", "total", "line", "length").distinct()
    part = once.groupBy("text_hash", "total").agg(F.sum("length").alias("shared"))
    return part.where(F.col("shared") > max_shared * F.col("total")).select("text_hash")


def remove_boilerplate(
    docs: DataFrame, min_sites: int = 8, max_shared: float = 0.5, text: str = "text", site: str = "source"
) -> DataFrame:
    """The same rows and columns, with boilerplate lines taken out of the text, and two counts.

    Columns that are named like the counts, ``n_lines`` and ``n_removed_lines``, are replaced by them.
    """
    work = Workspace(docs.sparkSession, "spread")
    occurrences = work.keep(line_occurrences(docs, text, site), "occurrences")
    widespread = work.keep(widespread_lines(occurrences, min_sites), "widespread")
    shared = work.keep(occurrences.join(widespread, "line", "left_semi"), "shared")
    voters = shared.join(copied_texts(shared, max_shared), "text_hash", "left_anti")
    found = work.keep(widespread_lines(voters, min_sites), "boilerplate")
    # Equal texts have equal lines, so a text's hash is key enough and repeated rows need no number.
    own = shared.select("text_hash", "line").distinct().join(found, "line", "left_semi")
    # Helper columns that no column of the documents can be named like.
    mark = uuid.uuid4().hex
    text_hash, lines = f"text_{mark}", f"lines_{mark}"
    bad = own.groupBy(F.col("text_hash").alias(text_hash)).agg(F.collect_set("line").alias(lines))
    # They grow with the documents, so they are not broadcast, however few they are today.
    bad = bad.hint("merge")
    kept = F.filter(_lines(F.col(text)), lambda x: ~F.array_contains(F.col(lines), F.xxhash64(x)))
    cleaned = F.when(F.col(lines).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(_lines(F.col(text))))
    removed = F.when(F.col(lines).isNull(), 0).otherwise(F.size(_lines(F.col(text))) - F.size(kept))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed_lines")]
    return (
        docs.withColumn(text_hash, F.xxhash64(F.col(text)))
        .join(bad, text_hash, "left")
        .select(
            *[cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in columns],
            n_lines.cast("long").alias("n_lines"),
            removed.cast("long").alias("n_removed_lines"),
        )
    )
