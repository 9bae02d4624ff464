"""Similarity join of shingle sets in the metric space of the Jaccard distance, exact.

Equal sets are one point of the space.  Points that are linked share a shingle of their prefixes (the
first shingles in one order of all, common ones last), so points that meet at a shingle form a first
region; unrelated texts lie at distance 1 from each other and no pivot could separate them otherwise.

A contraction of the metric narrows the regions: the counts of a set's shingles in ``BINS`` parts of the
shingle universe.  The distance of two counts is at most the symmetric difference of the sets, so points
whose counts are too far apart can't be linked.  The components left are the regions of the exact join:

* A region that fits a task is joined there.  Pivots are spread over it, each point goes to the Voronoi
  region of its nearest pivot, and to every other region whose pivot is not farther by more than twice
  the radius (triangle inequality); the regions are joined recursively, small ones pair by pair.
* Long texts can stay together though nothing links them, as the counts of large sets are alike.  The
  points of a region too large for a task are therefore counted again in ``FINE_BINS`` parts, and meet
  again at their shared shingles.
* A region that is still larger, such as a group of near copies that holds a third of all rows, is dealt
  out in blocks.  All points are compared with a few pivots; those linked to the main pivot's component need
  no further comparison with each other.  Only the rest is compared with all blocks.

Links are reported as a spanning forest: all that components need.

Defined cases: missing and empty texts, and texts of white space, have no shingles and no links; a text
of fewer words than a shingle is one shingle; rows with equal sets are linked with each other; repeated
rows likewise; a missing doc_id counts as the largest; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm import hashing
from hitloom.llm.components import connected_components
from hitloom.llm.workspace import Workspace, ship_code, shuffle_width

BINS = 64
#: Points and bytes of text that one task joins at once, points of a block of a larger region; shingles
#: listed as common.
REGION_POINTS = 3000
REGION_BYTES = 32 << 20
BLOCK_POINTS = 2000
#: Parts of the shingle universe that the points of larger regions are counted in.
FINE_BINS = 1024
COMMON_LISTED = 20_000
TOKENS_PER_BUCKET = 400_000
_TOKEN = np.dtype([("token", "<u8"), ("point", "<i8")])
NO_ID = (1 << 63) - 1
_SEED = np.uint64(0xA24BAED4963EE407)


@dataclass(frozen=True)
class Similarity:
    """Words per shingle, and the least similarity in hundredths."""

    words: int
    percent: int

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1

    @property
    def radius(self) -> float:
        return 1 - self.percent / 100

    def linked(self, both: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 100 * both >= self.percent * (n + m - both)

    def possible(self, apart: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Whether sets of these sizes, with at least ``apart`` elements in one only, can be linked."""
        return (100 + self.percent) * apart <= (100 - self.percent) * (n + m)


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Per text: the hashes of its distinct shingles, ascending."""
    for first, end, data, offsets in hashing.slices(column, 4 << 20):
        text, starts_of = hashing.separated(data, offsets, lower=True)
        starts, ends = hashing.word_spans(text)
        coded = hashing.word_hashes(text, starts, ends)
        cuts = np.searchsorted(starts, starts_of)
        together = np.zeros(max(0, len(coded) - words + 1), np.uint64)
        for k in range(words):
            together = hashing.mix(together * np.uint64(31) + coded[k : len(coded) - words + 1 + k] + np.uint64(k))
        for a, b in zip(cuts, cuts[1:]):
            if b - a >= words:
                yield np.unique(together[a : b - words + 1])
            elif b > a:
                short = np.array([_SEED])
                for k in range(a, b):
                    short = hashing.mix(short * np.uint64(31) + coded[k : k + 1])
                yield short
            else:
                yield np.empty(0, np.uint64)


def point_of(shingles: np.ndarray) -> int:
    """The identity of a set."""
    if not len(shingles):
        return 0
    spread = hashing.mix(shingles ^ _SEED)
    size = np.array([len(shingles)], np.uint64)
    return int(hashing.mix(spread.sum(keepdims=True) + np.bitwise_xor.reduce(spread) * size).view(np.int64)[0])


POINTS = "doc_id long, text_hash long, point long, n long, bins binary, common array<long>, common_n array<int>"


def _row_key() -> list:
    """A row's id, the largest if it is missing, and its text's hash."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("text_hash")]


def packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs: they travel once for every region of their point."""
    most = counts.max()
    return counts.astype("u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<i4").tobytes()


def unpacked(column: pa.ChunkedArray, parts: int) -> np.ndarray:
    """The counts that ``packed`` packed, in ``parts`` parts, a row each."""
    rows = column.to_pylist()
    sizes = np.array([len(row) for row in rows], np.int64)
    counts = np.empty((len(rows), parts), np.int32)
    for kind in ("u1", "<u2", "<i4"):
        those = np.flatnonzero(sizes == parts * np.dtype(kind).itemsize)
        counts[those] = np.frombuffer(b"".join([rows[i] for i in those]), kind).reshape(-1, parts)
    return counts


def points(docs: DataFrame, like: Similarity) -> DataFrame:
    """Per row its set's identity, size and counts; now and then, shingles that were common of late."""
    ship_code(docs.sparkSession)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, seen = [], []
            for shingles in shingle_sets(batch.column(2), like.words):
                bins = np.bincount((shingles >> np.uint64(58)).astype(np.int64), minlength=BINS)
                out.append((point_of(shingles), len(shingles), packed(bins), None, None))
                seen.append(shingles)
            if out:
                values, counts = np.unique(np.concatenate(seen), return_counts=True)
                often = counts >= max(5, len(seen) // 200)
                out[0] = (*out[0][:3], values[often].view(np.int64), counts[often])
            columns = list(zip(*out)) if out else [[]] * 5
            types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(columns, types)]],
                names=["doc_id", "text_hash", "point", "n", "bins", "common", "common_n"],
            )

    return docs.select(*_row_key(), "text").mapInArrow(describe, POINTS)


def common_shingles(found: DataFrame) -> np.ndarray:
    """Shingles of many texts, most common last; they only set the order of prefixes."""
    listed = found.where(F.col("common").isNotNull()).select(F.explode(F.arrays_zip("common", "common_n")).alias("c"))
    top = listed.groupBy("c.common").agg(F.sum("c.common_n").alias("n")).orderBy(F.desc("n"), "common").limit(COMMON_LISTED)
    return np.array([row["common"] for row in top.collect()][::-1], np.int64).view(np.uint64)


def meeting_tokens(docs: DataFrame, like: Similarity, common: np.ndarray, n_tokens: int) -> DataFrame:
    """Prefix shingles that several points share: token, point."""
    spark = docs.sparkSession
    buckets = max(shuffle_width(spark), n_tokens // TOKENS_PER_BUCKET + 1)
    order = np.argsort(common)
    listed = spark.sparkContext.broadcast((common[order], order))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place = listed.value
        held: list[np.ndarray] = []
        points: set[int] = set()

        def flush() -> pa.RecordBatch:
            rows = np.concatenate(held)
            bucket = (rows["token"] % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
            sent = [(k, rows[by[a:b]].tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in sent], pa.int32()), pa.array([x for _, x in sent], pa.binary())], names=["bucket", "tokens"]
            )

        for batch in batches:
            for shingles in shingle_sets(batch.column(0), like.words):
                point = point_of(shingles)
                if not len(shingles) or point in points:
                    continue
                points.add(point)
                if len(known):
                    at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
                    rank = np.where(known[at] == shingles, place[at] + 1, 0)
                    shingles = shingles[np.argsort(rank, kind="stable")]
                tokens = np.empty(like.prefix(len(shingles)), _TOKEN)
                tokens["token"], tokens["point"] = shingles[: len(tokens)], point
                held.append(tokens)
            if sum(map(len, held)) > 2_000_000:
                yield flush()
                held, points = [], set()
        if held:
            yield flush()

    def meet(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(one, _TOKEN) for one in table.column("tokens").to_pylist()])
        rows = rows[np.lexsort((rows["point"], rows["token"]))]
        new = np.ones(len(rows), bool)
        new[1:] = rows[1:] != rows[:-1]
        rows = rows[new]
        group = np.append(0, np.cumsum(rows["token"][1:] != rows["token"][:-1])) if len(rows) else np.empty(0, np.int64)
        size = np.bincount(group) if len(rows) else group
        keep = size[group] > 1
        rows, group = rows[keep], group[keep]
        # Of tokens with the same points here, one is enough.
        if len(rows):
            starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            spread = hashing.mix(rows["point"].view(np.uint64))
            sums = np.add.reduceat(spread, starts), np.bitwise_xor.reduceat(hashing.mix(spread), starts)
            first = np.zeros(len(starts), bool)
            first[np.unique(np.column_stack(sums), axis=0, return_index=True)[1]] = True
            rows = rows[first[np.cumsum(np.append(False, group[1:] != group[:-1]))]]
        return pa.table([rows["token"].view(np.int64), rows["point"]], names=["token", "point"])

    dealt = docs.select("text").mapInArrow(deal, "bucket int, tokens binary")
    return dealt.groupBy("bucket").applyInArrow(meet, "token long, point long")


class Forest:
    """Union-find over 0..n-1 that remembers the links that joined two trees."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = int(self.parent[i])
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((i, j))


class Space:
    """The points of a region, with a distance from one to many."""

    def __init__(self, sets: list[np.ndarray], like: Similarity):
        self.like = like
        self.n = np.array([len(s) for s in sets])
        self.starts = np.cumsum(self.n) - self.n
        values, self.ids = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(values), bool)

    def common(self, i: int, others: np.ndarray) -> np.ndarray:
        own = self.ids[self.starts[i] : self.starts[i] + self.n[i]]
        self.mark[own] = True
        lengths = self.n[others]
        at = np.repeat(self.starts[others] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        sums = np.append(0, np.cumsum(self.mark[self.ids[at]]))
        self.mark[own] = False
        ends = np.cumsum(lengths)
        return sums[ends] - sums[ends - lengths]

    def join(self) -> list[tuple[int, int]]:
        forest = Forest(len(self.n))
        self._join(np.arange(len(self.n)), forest)
        return forest.links

    def _pairs(self, members: np.ndarray, forest: Forest) -> None:
        members = members[np.argsort(self.n[members], kind="stable")]
        for k, i in enumerate(members[:-1]):
            reach = np.searchsorted(self.n[members], self.n[i] * 100 / self.like.percent, "right")
            others = members[k + 1 : max(reach, k + 1)]
            if len(others):
                both = self.common(i, others)
                for j in others[self.like.linked(both, self.n[i], self.n[others])]:
                    forest.join(int(i), int(j))

    def _join(self, members: np.ndarray, forest: Forest) -> None:
        if len(members) <= 24:
            self._pairs(members, forest)
            return
        pivots: list[int] = [int(members[np.argmax(self.n[members])])]
        far = np.full(len(members), np.inf)
        distances = []
        for _ in range(8):
            i = pivots[-1]
            both = self.common(i, members)
            for j in members[self.like.linked(both, self.n[i], self.n[members])]:
                forest.join(i, int(j))
            distances.append(1 - both / (self.n[i] + self.n[members] - both))
            far = np.minimum(far, distances[-1])
            pivots.append(int(members[np.argmax(far)]))
            if far.max() == 0:
                break
        distance = np.array(distances)
        nearest = distance.argmin(axis=0)
        within = distance <= distance[nearest, np.arange(len(members))] + 2 * self.like.radius + 1e-9
        for k in range(len(distance)):
            if not (nearest == k).any():
                continue
            region = members[within[k]]
            if len({forest.root(int(i)) for i in region}) == 1:
                continue  # all linked already
            if len(region) < 0.7 * len(members):
                self._join(region, forest)
            else:
                self._pairs(region, forest)


def _payload_sets(table: pa.Table, like: Similarity) -> list[np.ndarray]:
    return list(shingle_sets(table.column("text").combine_chunks(), like.words))


def _by_region(join_region: Callable[[pa.Table], list[tuple[int, int]]]) -> Callable[[pa.Table], pa.Table]:
    """Join the regions of a bucket one after the other; returns their links as pairs of points."""

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by([("region", "ascending"), ("point", "ascending")])
        region, point = table.column("region").to_numpy(), table.column("point").to_numpy()
        cuts = np.append(np.flatnonzero(np.append(True, region[1:] != region[:-1])), len(region))
        a, b = [], []
        for start, end in zip(cuts, cuts[1:]):
            for i, j in join_region(table.slice(start, end - start)):
                a.append(point[start + i])
                b.append(point[start + j])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return join


def _join_regions(
    members: DataFrame,
    payload: list[str],
    large: DataFrame,
    join_region: Callable[[pa.Table], list[tuple[int, int]]],
    join_blocks: Callable[[pa.Table, pa.Table], list[tuple[int, int]]],
    work: Workspace,
    name: str,
) -> DataFrame:
    """Links of all regions.  ``large`` has the regions to be dealt out; ``join_blocks`` compares two blocks of one."""
    spark = members.sparkSession
    columns = ["region", "point", *payload]
    small = members.join(large, "region", "left_anti").select(*columns)
    bucket = F.pmod(F.xxhash64("region"), F.lit(8 * shuffle_width(spark))).alias("bucket")
    links = work.keep(small.groupBy(bucket).applyInArrow(_by_region(join_region), "a long, b long"), f"{name}-small")
    if large.isEmpty():
        return links
    dealt = work.keep(members.join(large, "region").select(*columns), f"{name}-large")

    def blocks(frame: DataFrame, size: int, number: str) -> DataFrame:
        return frame.groupBy("region").agg(F.ceil(F.count("*") / size).cast("long").alias(number))

    def cross(asked: DataFrame, step: str) -> DataFrame:
        """Links between the points asked for and all points of their regions, a block with a block."""
        many = blocks(dealt, BLOCK_POINTS, "blocks").join(blocks(asked, BLOCK_POINTS // 4, "chunks"), "region")
        many = F.broadcast(work.keep(many, f"{name}-{step}-blocks"))
        place = lambda n: F.pmod(F.xxhash64("point"), n)
        each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        ours = dealt.join(many, "region").select(*columns, place(F.col("blocks")).alias("block"), each("chunks").alias("chunk"))
        theirs = asked.join(many, "region").select(*columns, each("blocks").alias("block"), place(F.col("chunks")).alias("chunk"))
        keys = ("region", "block", "chunk")

        def compare(left: pa.Table, right: pa.Table) -> pa.Table:
            found = join_blocks(left, right) if left.num_rows and right.num_rows else []
            a, b = left.column("point").to_pylist(), right.column("point").to_pylist()
            return pa.table([pa.array([a[i] for i, _ in found], pa.int64()), pa.array([b[j] for _, j in found], pa.int64())], names=["a", "b"])

        return work.keep(ours.groupBy(*keys).cogroup(theirs.groupBy(*keys)).applyInArrow(compare, "a long, b long"), f"{name}-{step}")

    found = None
    for step in range(2):
        # Of the points not linked yet, one becomes the pivot of its region.
        free = dealt if found is None else dealt.join(found.select(F.col("a").alias("point")), "point", "left_anti")
        first = free.groupBy("region").agg(F.min("point").alias("point"))
        linked = cross(work.keep(dealt.join(first, ["region", "point"]).select(*columns), f"{name}-pivot{step}"), f"star{step}")
        found = linked if found is None else found.unionByName(linked)
    parts = connected_components(found, work, f"{name}-parts")
    placed = dealt.select("region", "point").join(parts.withColumnRenamed("node", "point"), "point", "left")
    placed = placed.select("region", "point", F.coalesce("component", "point").alias("component"))
    sizes = placed.groupBy("region", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("region").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    rest = placed.join(main, "region").where("component != main").select("region", "point")
    more = cross(work.keep(dealt.join(rest, ["region", "point"], "left_semi"), f"{name}-asked"), "rest")
    return links.unionByName(found).unionByName(more)


def _near(like: Similarity, parts: int) -> tuple[Callable, Callable]:
    """Joins of a region, and of two blocks of one, by the contraction: columns ``n`` and ``bins`` of ``parts`` counts."""

    def read(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        bins = unpacked(table.column("bins"), parts)
        # Finer counts are 255 at most, all of a block are held at once.
        return table.column("n").to_numpy(), bins.astype(np.int16) if parts > BINS else bins

    def near(table: pa.Table) -> list[tuple[int, int]]:
        n, bins = read(table)
        order = np.argsort(n, kind="stable")
        n, bins, forest = n[order], bins[order], Forest(len(n))
        for i in range(len(n) - 1):
            reach = np.searchsorted(n, n[i] * 100 / like.percent, "right")
            apart = np.abs(bins[i + 1 : reach] - bins[i]).sum(axis=1)
            for j in np.flatnonzero(like.possible(apart, n[i], n[i + 1 : reach])):
                forest.join(i, i + 1 + int(j))
        return [(int(order[i]), int(order[j])) for i, j in forest.links]

    def near_blocks(ours: pa.Table, theirs: pa.Table) -> list[tuple[int, int]]:
        (n, left), (m, right) = read(ours), read(theirs)
        forest = Forest(len(n) + len(m))
        for j in range(len(m)):
            apart = np.abs(left - right[j]).sum(axis=1)
            for i in np.flatnonzero(like.possible(apart, n, m[j])):
                forest.join(int(i), len(n) + j)
        return [(i, j - len(n)) for i, j in forest.links]

    return near, near_blocks


def _large_regions(members: DataFrame) -> DataFrame:
    """The regions that one task should not join: region."""
    sizes = members.groupBy("region").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    return sizes.where((F.col("n") > REGION_POINTS) | (F.col("bytes") > REGION_BYTES)).select("region")


def _divided(members: DataFrame, large: DataFrame, meetings: DataFrame, like: Similarity, work: Workspace) -> DataFrame:
    """The members with large regions divided: region, point, text; points near to no other are left out.

    Points that are linked share a first region, so it is there that their finer counts are compared.
    Counts above 255 are cut, which brings sets nearer to each other, never farther apart.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(64 - (FINE_BINS.bit_length() - 1))
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), like.words))
            bins = [np.bincount((own >> shift).astype(np.int64), minlength=FINE_BINS) for own in sets]
            counts = pa.array([np.minimum(own, 255).astype(np.uint8).tobytes() for own in bins], pa.binary())
            sizes = pa.array([len(own) for own in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, counts], names=["point", "n", "bins"])

    crowded = members.join(large, "region").select("point", "text")
    fine = work.keep(crowded.mapInArrow(count, "point long, n long, bins binary"), "fine")
    again = work.keep(meetings.join(fine, "point"), "fine-members")
    sizes = again.groupBy("region").agg(F.count("*").alias("n"))
    many = work.keep(sizes.where(F.col("n") > REGION_POINTS).select("region"), "fine-many")
    close = _join_regions(again, ["n", "bins"], many, *_near(like, FINE_BINS), work, "fine")
    parts = connected_components(close, work, "fine-regions")
    parts = parts.select(F.col("node").alias("point"), F.col("component").alias("region"))
    others = members.join(large, "region", "left_anti")
    return work.keep(others.unionByName(crowded.join(parts, "point").select("region", "point", "text")), "divided")


def one_of_each(docs: DataFrame, like: Similarity) -> DataFrame:
    """The rows that stay when each component keeps its first."""
    key = [F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.col("text_hash").alias("__text")]
    stay = components(docs, like).where("stays").select(*key).distinct()
    keyed = docs.withColumns({"__id": _row_key()[0], "__text": _row_key()[1]})
    return keyed.join(stay, ["__id", "__text"], "left_semi").dropDuplicates(["__id", "__text"]).select(docs.columns)


def components(docs: DataFrame, like: Similarity) -> DataFrame:
    """Per row: doc_id, the size of its set and the smallest doc_id it is linked with, directly or not.

    ``stays`` marks the first row of a component, by doc_id and then by the text's hash; fully equal rows
    are marked alike.  Rows without shingles are components of their own.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "metric")
    described = work.keep(points(docs, like), "points")
    distinct = described.where("n > 0").groupBy("point").agg(F.first("n").alias("n"), F.first("bins").alias("bins"))
    total = described.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    common = common_shingles(described)
    tokens = work.keep(meeting_tokens(docs, like, common, int(total * like.radius)), "tokens")

    # Tokens that bring together the same points are one first region.
    same = tokens.groupBy("token").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("point").cast("decimal(20,0)")).alias("s"), F.bit_xor(F.xxhash64("point", F.lit(1))).alias("x")
    )
    kept = same.groupBy("n", "s", "x").agg(F.min("token").alias("region")).select("region", F.col("n").alias("size"))
    kept = work.keep(kept, "first")
    members = tokens.withColumnRenamed("token", "region").join(kept.select("region"), "region").join(distinct, "point")
    members = work.keep(members, "members")

    large = kept.where(F.col("size") > 2 * REGION_POINTS).select("region")
    close = _join_regions(members, ["n", "bins"], large, *_near(like, BINS), work, "near")
    regions = work.keep(
        connected_components(close, work, "regions").select(F.col("node").alias("point"), F.col("component").alias("region")), "regions"
    )

    # Each point once, with its text: the first of its rows stands for it.
    row = F.min(F.struct("doc_id", "text_hash")).alias("row")
    chosen = described.where("n > 0").join(regions, "point").groupBy("point", "region").agg(row).select("point", "region", "row.*")
    texts = docs.select(*_row_key(), "text").join(chosen, ["doc_id", "text_hash"])
    meetings = members.select("region", "point")
    # Only equal rows repeat here, and these meet by the join: no second shuffle of the texts.
    members = texts.dropDuplicates(["doc_id", "text_hash", "region", "point"]).select("region", "point", "text")
    members = work.keep(members, "texts")
    large = work.keep(_large_regions(members), "large")
    if not large.isEmpty():
        members = _divided(members, large, meetings, like, work)
        large = work.keep(_large_regions(members), "still-large")

    def exact(table: pa.Table) -> list[tuple[int, int]]:
        return Space(_payload_sets(table, like), like).join()

    def exact_blocks(ours: pa.Table, theirs: pa.Table) -> list[tuple[int, int]]:
        left, right = _payload_sets(ours, like), _payload_sets(theirs, like)
        space, forest, all_left = Space(left + right, like), Forest(len(left) + len(right)), np.arange(len(left))
        for j in range(len(left), len(left) + len(right)):
            # Sets of too different sizes can't be linked.
            n, m = space.n[all_left], space.n[j]
            alike = all_left[(100 * n >= like.percent * m) & (100 * m >= like.percent * n)]
            both = space.common(j, alike)
            for i in alike[like.linked(both, space.n[alike], m)]:
                forest.join(int(i), j)
        return [(i, j - len(left)) for i, j in forest.links]

    links = _join_regions(members, ["text"], large, exact, exact_blocks, work, "exact")
    linked = connected_components(links, work, "links").select(F.col("node").alias("point"), "component")
    placed = described.select("doc_id", "text_hash", "n", "point").join(linked, "point", "left")
    placed = work.keep(placed.withColumn("component", F.coalesce("component", "point")), "placed")
    first = F.min(F.struct("doc_id", "text_hash"))
    least = placed.where("n > 0").groupBy("component").agg(first.alias("first"))
    own = lambda c: F.when(c != NO_ID, c)
    return placed.join(least, "component", "left").select(
        own(F.col("doc_id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        own(F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id"))).alias("component_id"),
        "text_hash",
        ((F.col("n") == 0) | (F.struct("doc_id", "text_hash") == F.col("first"))).alias("stays"),
    )
