"""Exact removal of repeated byte strings, by suffixes sorted one bucket at a time.

All strings of ``length`` bytes are judged: of equal ones, only the one that starts first stays.

* Each string is assigned to the smallest hash among the short grams in it, its anchor.  Neighbouring
  strings mostly share one, so a document is a chain of spans, one per anchor.  Equal strings have equal
  anchors: the anchors are the suffix buckets.
* Spans travel as hashes.  Within a bucket, spans that are equal as a whole are settled at once: all but
  the first go.  Only where different spans share an anchor are the strings themselves compared.
* For these, the suffixes of a bucket are sorted.  A sort by the first ``PERIOD`` bytes leaves long
  ties; they are resolved by the ranks of a difference-cover sample: positions whose distance from the
  anchor, modulo the period, is in a difference cover are ranked beforehand, and every suffix has one
  within reach.  Ranks are held for the sample only, and for one group of buckets at a time.
* A bucket of more than ``SPANS_PER_SORT`` different spans, such as of a short line in many surroundings,
  is not sorted as one: its strings are dealt out by their own hashes, and the first of equal ones stays.

Hashes of spans are 64 bits wide, those of a large bucket's strings 128; suffixes are compared by their
bytes.

Defined cases: missing and empty texts have nothing to remove, nor have texts shorter than ``length``;
a missing doc_id counts as the smallest; rows of one doc_id with different texts are ordered by the
texts' hashes; of fully equal rows the first is judged and the others are repeats of it; extra columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm import hashing
from hitloom.llm.workspace import Workspace, ship_code, shuffle_width

GRAM = 24
PERIOD = 32
#: Bytes of text whose spans are held at once, spans that one bucket should have, and spans that are
#: sorted at once; an anchor of more different spans is not sorted.
RUN_BYTES = 3 << 20
SPANS_PER_BUCKET = 200_000
SPANS_PER_SORT = 4_000
NO_ID = np.iinfo(np.int64).min

SPAN = np.dtype(
    [("anchor", "<u8"), ("span", "<u8"), ("doc", "<i8"), ("tie", "<u4"), ("start", "<i4"), ("lead", "u1"), ("size", "<u2")]
)
DEALT = "bucket int, spans binary, doc array<long>, tie array<long>, start array<long>, size array<long>"
SETTLED = "doc long, tie long, start long, size long, anchor long, lead int"


def difference_cover(period: int) -> np.ndarray:
    """Residues such that every distance modulo the period is a difference of two of them."""
    step = int(np.ceil(np.sqrt(period)))
    return np.unique(np.concatenate([np.arange(step), np.arange(step, period + step, step)]) % period)


def to_cover(period: int) -> np.ndarray:
    """Per residue, the distance to the next covered residue."""
    cover = difference_cover(period)
    return np.array([min((c - r) % period for c in cover) for r in range(period)])


def spans_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of a run of texts: the row, the fields of SPAN (start within the text), the span's place in the run."""
    n, wide = len(data), length - GRAM + 1
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(len(lengths)), np.maximum(lengths - length + 1, 0))
    if not len(rows):
        return rows, np.empty(0, SPAN), rows
    counts = np.maximum(lengths - length + 1, 0)
    first_of = np.cumsum(counts) - counts
    at = np.arange(len(rows)) - first_of[rows] + offsets[rows]
    sums, inverse = hashing.prefix_sums(data)
    grams = hashing.ranges_hash(sums, inverse, np.arange(n - GRAM + 1), GRAM)
    # The high bits order the grams, the low ones are the place: the leftmost of equal grams wins.
    least = (grams & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while reach * 2 <= wide:
        least = np.minimum(least[: len(least) - reach], least[reach:])
        reach *= 2
    if wide > reach:
        least = np.minimum(least[: len(least) - (wide - reach)], least[wide - reach :])
    anchor_at = (least[at] & np.uint64(0xFFFFFF)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = anchor_at[1:] != anchor_at[:-1]
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(at)) - 1
    start, size = at[begin], at[last] - at[begin] + length
    out = np.empty(len(begin), SPAN)
    out["anchor"] = grams[anchor_at[begin]]
    out["lead"] = anchor_at[begin] - start
    out["size"] = size
    out["span"] = hashing.mix(hashing.ranges_hash(sums, inverse, start, size) + out["lead"].astype(np.uint64))
    out["start"] = start - offsets[rows[begin]]
    return rows[begin], out, start


def settle(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans sorted and without repeated rows; which equal an earlier span; which share only the anchor."""
    spans = spans[np.lexsort((spans["start"], spans["tie"], spans["doc"], spans["span"], spans["anchor"]))]
    same = np.zeros(len(spans), bool)
    same[1:] = (spans["anchor"][1:] == spans["anchor"][:-1]) & (spans["span"][1:] == spans["span"][:-1])
    again = same.copy()
    for name in ("doc", "tie", "start"):
        again[1:] &= spans[name][1:] == spans[name][:-1]
    spans, same = spans[~again], same[~again]
    firsts = np.flatnonzero(~same)
    anchors = spans["anchor"][firsts]
    shared = np.zeros(len(firsts), bool)
    shared[1:] = anchors[1:] == anchors[:-1]
    shared[:-1] |= shared[1:]
    mixed = np.zeros(len(spans), bool)
    mixed[firsts[shared]] = True
    return spans, same, mixed


def union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by intervals; touching ones become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > reach[:-1]
    begin = np.flatnonzero(new)
    return starts[begin], reach[np.append(begin[1:], len(starts)) - 1]


def merged(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Removed spans as few intervals: doc, tie, start, size."""
    spans = spans[np.lexsort((spans["start"], spans["tie"], spans["doc"]))]
    if not len(spans):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    document = np.zeros(len(spans), np.int64)
    document[1:] = np.cumsum((spans["doc"][1:] != spans["doc"][:-1]) | (spans["tie"][1:] != spans["tie"][:-1]))
    starts, ends = union(document << 32 | spans["start"], (document << 32 | spans["start"]) + spans["size"])
    first = np.searchsorted(document, starts >> 32)
    return spans["doc"][first], spans["tie"][first].astype(np.int64), starts & 0xFFFFFFFF, ends - starts


def sort_bucket(texts: list[bytes], anchors: np.ndarray, leads: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Sort the suffixes of spans that share anchors, and find those with equal strings.

    Returns the span, the offset there, and the group of each string; equal strings have one group.
    """
    sizes = np.array([len(t) for t in texts])
    pad = 4 * PERIOD + length
    width = sizes + pad
    base = np.cumsum(width) - width
    data = np.frombuffer(b"".join(t + bytes(pad) for t in texts), np.uint8)
    # The bytes from each place as one big-endian number.
    word = np.zeros(len(data), np.uint64)
    for k in range(8):
        word[: len(data) - k] |= data[k:].astype(np.uint64) << np.uint64(56 - 8 * k)

    def dense(keys: list[np.ndarray]) -> np.ndarray:
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), np.int64)
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(new)
        return out

    counts = sizes - length + 1
    span = np.repeat(np.arange(len(texts)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    place = base[span] + offset
    aligned = offset - leads[span]
    prefix = dense([anchors[span], aligned, *[word[place + 8 * k] for k in range(PERIOD // 8)]])
    tied = np.bincount(prefix)[prefix] > 1
    span, offset, place, aligned, prefix = (x[tied] for x in (span, offset, place, aligned, prefix))
    # Ranks of the sample: places whose distance from their span's anchor is in the cover.
    needed = place + to_cover(PERIOD)[aligned % PERIOD]
    sample = np.unique(np.concatenate([needed + k * PERIOD for k in range(4)])) if len(needed) else needed
    rank = np.full(len(data) + 1, -1, np.int64)
    last = len(data) - 8
    rank[sample] = dense([word[np.minimum(sample + 8 * k, last)] for k in range(PERIOD // 8)])
    for depth in (PERIOD, 2 * PERIOD):  # ranks by twice, then four times the period
        rank[sample] = dense([rank[sample], rank[np.minimum(sample + depth, len(data))]])
    order = np.lexsort((rank[needed], prefix))
    span, offset, place, prefix = (x[order] for x in (span, offset, place, prefix))
    # Neighbours in the order of their suffixes: equal strings stand together.
    equal = prefix[1:] == prefix[:-1]
    for k in range(PERIOD // 8, length // 8):
        equal &= word[place[1:] + 8 * k] == word[place[:-1] + 8 * k]
    if length % 8:
        equal &= word[place[1:] + length - 8] == word[place[:-1] + length - 8]
    group = np.zeros(len(span), np.int64)
    group[1:] = np.cumsum(~equal)
    return span, offset, group


def removed_intervals(docs: DataFrame, length: int, work: Workspace) -> DataFrame:
    """What repeats earlier bytes: doc, tie, start, size in bytes; intervals may overlap."""
    spark = docs.sparkSession
    ship_code(spark)
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("doc"),
        F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)).alias("tie"),
        "text",
    )
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    spans_expected = 2 * n_bytes // (length - GRAM + 2)
    buckets = max(shuffle_width(spark), int(spans_expected // SPANS_PER_BUCKET) + 1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def flush() -> pa.RecordBatch:
            spans, same, _ = settle(np.concatenate(held))
            again = merged(spans[same])
            spans = spans[~same]
            bucket = (spans["anchor"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            sent = [spans[order[a:b]].tobytes() for a, b in zip(cuts, cuts[1:])]
            used = [k for k, one in enumerate(sent) if one]
            # What is settled here travels along, dealt evenly over the buckets.
            share = [[column[i :: len(used)] for i in range(len(used))] for column in again]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(used, pa.int32()),
                    pa.array([sent[k] for k in used], pa.binary()),
                    *[pa.array(column, pa.list_(pa.int64())) for column in share],
                ],
                names=["bucket", "spans", "doc", "tie", "start", "size"],
            )

        for batch in batches:
            ids = batch.column(0).to_numpy()
            ties = batch.column(1).to_numpy()
            for row, base, data, offsets in text_runs(batch.column(2), length):
                of, spans, _ = spans_of(data, offsets, length)
                spans["doc"], spans["tie"] = ids[row[of]], ties[row[of]]
                spans["start"] += base[of].astype(np.int32)
                if len(spans):
                    held.append(spans)
                    n_held += len(spans)
            if n_held > 1_000_000:
                yield flush()
                held, n_held = [], 0
        if n_held:
            yield flush()

    def settle_bucket(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(one, SPAN) for one in table.column("spans").to_pylist()]
        spans, same, mixed = settle(np.concatenate(parts))
        gone = merged(spans[same])
        columns = []
        for k, name in enumerate(("doc", "tie", "start", "size")):
            earlier = table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
            columns.append(np.concatenate([earlier, gone[k], spans[mixed][name].astype(np.int64)]))
        n_gone = len(columns[0]) - np.count_nonzero(mixed)
        anchor = np.concatenate([np.zeros(n_gone, np.int64), spans[mixed]["anchor"].view(np.int64)])
        lead = np.concatenate([np.full(n_gone, -1), spans[mixed]["lead"]])
        return pa.table([*columns, anchor, pa.array(lead, pa.int32())], names=["doc", "tie", "start", "size", "anchor", "lead"])

    settled = work.keep(keyed.mapInArrow(deal, DEALT).groupBy("bucket").applyInArrow(settle_bucket, SETTLED), "settled")
    mixed = settled.where(F.col("lead") >= 0)
    large = mixed.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > SPANS_PER_SORT).select("anchor")
    large = work.keep(large, "large")
    sorted_spans = mixed.join(large, "anchor", "left_anti")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                whole = batch.column("text")[i].as_py().encode()
                spans = batch.column("spans")[i].values
                start, size, anchor, lead = (spans.field(n) for n in ("start", "size", "anchor", "lead"))
                n = len(start)
                parts = [whole[a : a + b] for a, b in zip(start.to_pylist(), size.to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, batch.column("doc")[i].as_py())),
                        pa.array(np.full(n, batch.column("tie")[i].as_py())),
                        start,
                        anchor,
                        lead,
                        pa.array(parts, pa.binary()),
                    ],
                    names=["doc", "tie", "start", "anchor", "lead", "span"],
                )

    def with_bytes(some: DataFrame) -> DataFrame:
        # As many as the document has spans.
        asked = some.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "size", "anchor", "lead")).alias("spans"))
        schema = "doc long, tie long, start long, anchor long, lead int, span binary"
        return keyed.join(asked, ["doc", "tie"]).mapInArrow(cut, schema)

    sort_buckets = max(shuffle_width(spark), mixed.count() // (4 * SPANS_PER_SORT) + 1)

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("anchor", "ascending"), ("doc", "ascending"), ("tie", "ascending"), ("start", "ascending")])
        anchors = table.column("anchor").to_numpy()
        out = []
        a = 0
        while a < len(anchors):  # one group of whole suffix buckets after the other
            b = min(a + SPANS_PER_SORT, len(anchors)) - 1
            b = int(np.searchsorted(anchors, anchors[b], "right"))
            part = table.slice(a, b - a)
            doc, tie, start = (part.column(n).to_numpy() for n in ("doc", "tie", "start"))
            span, offset, group = sort_bucket(
                part.column("span").to_pylist(), anchors[a:b], part.column("lead").to_numpy().astype(np.int64), length
            )
            # Spans are in order of doc and start within an anchor; equal strings have one anchor.
            order = np.lexsort((offset, span, group))
            again = np.zeros(len(order), bool)
            again[1:] = group[order][1:] == group[order][:-1]
            again = order[again]
            gone = np.zeros(len(again), SPAN)
            gone["doc"], gone["tie"] = doc[span[again]], tie[span[again]]
            gone["start"], gone["size"] = start[span[again]] + offset[again], length
            out.append(merged(gone))
            a = b
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.table(columns, names=["doc", "tie", "start", "size"])

    bucket = F.pmod(F.xxhash64("anchor"), F.lit(sort_buckets))
    compared = (
        with_bytes(sorted_spans).groupBy(bucket.alias("bucket")).applyInArrow(compare, "doc long, tie long, start long, size long")
    )
    gone = settled.where(F.col("lead") < 0).select("doc", "tie", "start", "size").unionByName(work.keep(compared, "compared"))
    if large.isEmpty():
        return gone
    strings = work.keep(strings_of(with_bytes(mixed.join(large, "anchor", "left_semi")), length), "strings")
    return gone.unionByName(work.keep(repeated_strings(strings, length), "repeated"))


def strings_of(spans: DataFrame, length: int) -> DataFrame:
    """Every string of the spans, by two hashes of 64 bits: doc, tie, start, h0, h1."""
    offsets = F.sequence(F.lit(0), F.octet_length("span") - length)
    string = F.substr("span", F.col("offset") + 1, F.lit(length))
    return spans.select("doc", "tie", "start", "span", F.explode(offsets).alias("offset")).select(
        "doc",
        "tie",
        (F.col("start") + F.col("offset")).alias("start"),
        F.xxhash64(F.lit(0), string).alias("h0"),
        F.xxhash64(F.lit(1), string).alias("h1"),
    )


def repeated_strings(strings: DataFrame, length: int) -> DataFrame:
    """All but the first of equal strings: doc, tie, start, size."""
    place = F.struct("doc", "tie", "start")
    first = strings.groupBy("h0", "h1").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = strings.join(first, ["h0", "h1"]).where(place > F.col("first"))
    return again.select("doc", "tie", "start", F.lit(length).cast("long").alias("size"))


def text_runs(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of text with the row and byte offset of each part; only very long texts have several parts.

    Parts of one text overlap by ``length - 1`` bytes, so that each string is whole in exactly one.
    """
    for first, end, data, offsets in hashing.slices(column, RUN_BYTES):
        if len(data) <= 2 * RUN_BYTES:
            yield np.arange(first, end), np.zeros(end - first, np.int64), data, offsets
            continue
        for at in range(0, max(1, len(data) - length + 1), RUN_BYTES):
            part = data[at : at + RUN_BYTES + length - 1]
            yield np.array([first]), np.array([at]), part, np.array([0, len(part)])


def deduplicate(docs: DataFrame, length: int = 100) -> DataFrame:
    """Per row: sizes, and the hash of the bytes that remain after removing all repeats."""
    work = Workspace(docs.sparkSession, "cover")
    gone = (
        removed_intervals(docs, length, work)
        .groupBy("doc", "tie")
        .agg(F.collect_list(F.struct("start", "size")).alias("gone"))
    )
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("doc"),
        F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)).alias("tie"),
        "text",
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, gone in zip(batch.column(1), batch.column(2)):
                whole = (text.as_py() or "").encode()
                starts = ends = np.empty(0, np.int64)
                if gone.is_valid:
                    starts = gone.values.field("start").to_numpy()
                    starts, ends = union(starts, starts + gone.values.field("size").to_numpy())
                kept, at = hashlib.sha256(), 0
                for a, b in zip(starts.tolist(), ends.tolist()):
                    kept.update(whole[at:a])
                    at = b
                kept.update(whole[at:])
                rows.append((len(whole), int((ends - starts).sum()), len(starts), kept.hexdigest()))
            columns = list(zip(*rows)) if rows else [[]] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), batch.column(4), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["doc_id", "doc", "tie", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    schema = "doc_id long, doc long, tie long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    found = keyed.join(gone, ["doc", "tie"], "left").select("doc_id", "text", "gone", "doc", "tie").mapInArrow(remove, schema)
    # Of fully equal rows, all but the first repeat it.
    copy = F.row_number().over(Window.partitionBy("doc", "tie").orderBy("kept_sha256")) > 1
    repeat = F.col("copy") & (F.col("n_bytes") >= length)
    nothing = hashlib.sha256().hexdigest()
    return found.withColumn("copy", copy).select(
        "doc_id",
        "n_bytes",
        F.when(repeat, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(repeat, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(repeat, F.lit(nothing)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
