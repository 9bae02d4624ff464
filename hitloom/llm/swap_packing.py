"""Best-fit packing of token pieces into sequences, improved by swaps.

Pieces are dealt to groups of bounded size by hash.  A group is packed by best fit decreasing; then a
local search moves a piece, exchanges one for one, or two for one, from the emptiest bins to fuller
ones.  Each step increases the sum of squared fills; bins that lose their last piece are gone.  Bins
still poorly filled are opened again and packed together with those of other groups, level by level.

Defined cases: a missing or empty text is a piece of the end id alone; repeated rows are packed each
for itself; an empty table gives no pieces; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.encoding import encoder
from hitloom.llm.workspace import Workspace, ship_code

PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", bin_group long, bin long, offset long, fill long"
#: Bins filled to a smaller part than this are opened again with those of other groups.
WEAK_FILL = 0.97


def token_pieces(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int) -> DataFrame:
    """The pieces of every document: whole, or cut so that all but the first are full."""
    ship_code(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_file)
        end = np.array([end_id], "<u4")
        for batch in batches:
            out: list[tuple] = []
            coded = encode.encode_many(batch.column(2).to_pylist())
            for doc_id, row, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), coded):
                ids = np.concatenate([ids.astype("<u4"), end])
                first = len(ids) - (len(ids) - 1) // capacity * capacity
                starts = [0, *range(first, len(ids), capacity)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    out.append((doc_id, row, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = list(zip(*out)) if out else [[]] * 6
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "row", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=names)

    numbered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text"
    )
    return numbered.mapInArrow(cut, PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin numbers by best fit decreasing; equal sizes keep their order."""
    bins = np.empty(len(sizes), np.int64)
    room: list[int] = []  # distinct free spaces, ascending
    at: dict[int, list[int]] = {}
    made = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        k = bisect_left(room, size)
        if k < len(room):
            free = room[k]
            chosen = at[free].pop()
            if not at[free]:
                del at[free], room[k]
        else:
            free, chosen = capacity, made
            made += 1
        bins[item] = chosen
        if free := free - size:
            if free not in at:
                at[free] = []
                insort(room, free)
            at[free].append(chosen)
    return bins


class LocalSearch:
    """Moves and swaps towards larger squared fills, over the underfull bins of one group."""

    def __init__(self, sizes: np.ndarray, bins: np.ndarray, capacity: int, steps: int):
        self.sizes, self.bins, self.capacity, self.steps = sizes, bins, capacity, steps
        self.fill = np.bincount(bins, weights=sizes).astype(np.int64)

    def _shift(self, giver: int, taker: int, out: list[int], back: list[int]) -> None:
        moved = int(self.sizes[out].sum() - self.sizes[back].sum())
        self.bins[out], self.bins[back] = taker, giver
        self.fill[giver] -= moved
        self.fill[taker] += moved
        self.steps -= 1

    def _improve(self, giver: int) -> bool:
        """One step that empties ``giver`` further into a bin at least as full."""
        own = np.flatnonzero(self.bins == giver)
        own = own[np.argsort(-self.sizes[own], kind="stable")]
        others = np.flatnonzero((self.fill >= self.fill[giver]) & (self.fill < self.capacity))
        others = others[others != giver]
        if not len(own) or not len(others):
            return False
        room = self.capacity - self.fill
        for item in own:  # a move, to the tightest place
            fits = others[room[others] >= self.sizes[item]]
            if len(fits):
                self._shift(giver, int(fits[np.argmin(room[fits])]), [item], [])
                return True
        theirs = np.flatnonzero(np.isin(self.bins, others))
        best, gain = None, 0
        singles = [([item], int(self.sizes[item])) for item in own]
        pairs = [
            ([own[i], own[j]], int(self.sizes[own[i]] + self.sizes[own[j]]))
            for i in range(min(len(own), 8))
            for j in range(i + 1, min(len(own), 8))
        ]
        for out, weight in singles + pairs:  # one for one, then two for one
            delta = weight - self.sizes[theirs]
            delta = np.where((delta > 0) & (delta <= room[self.bins[theirs]]), delta, 0)
            k = int(np.argmax(delta)) if len(delta) else 0
            if len(delta) and delta[k] > gain:
                best, gain = (out, int(theirs[k])), int(delta[k])
        if best is None:
            return False
        out, item = best
        self._shift(giver, int(self.bins[item]), out, [item])
        return True

    def run(self) -> np.ndarray:
        least = -(-int(self.sizes.sum()) // self.capacity)
        stuck: set[int] = set()
        while self.steps > 0 and np.count_nonzero(self.fill) > least:
            open_bins = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
            open_bins = [b for b in open_bins[np.argsort(self.fill[open_bins], kind="stable")] if b not in stuck]
            if not open_bins:
                break
            if self._improve(int(open_bins[0])):
                stuck.clear()
            else:
                stuck.add(int(open_bins[0]))
                if len(stuck) > 16:
                    break
        return self.bins


def pack_sizes(sizes: np.ndarray, capacity: int, steps: int = 4000) -> np.ndarray:
    """Bin numbers from 0 for the given sizes."""
    sizes = np.asarray(sizes, np.int64)
    if not len(sizes):
        return np.empty(0, np.int64)
    found = LocalSearch(sizes, best_fit(sizes, capacity), capacity, steps).run()
    return np.unique(found, return_inverse=True)[1].astype(np.int64)


def pack(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int = 2048, group_size: int = 16_000) -> DataFrame:
    """Every piece with its sequence and the place there.

    ``group_size`` is what one task packs, on average.  Full pieces are sequences of their own.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "packing")
    pieces = work.keep(token_pieces(docs, tokenizer_file, end_id, capacity), "pieces")

    def pack_group(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "row", "piece"], ignore_index=True)
        frame["bin"] = pack_sizes(frame["length"].to_numpy(), capacity)
        by_bin = frame.groupby("bin")["length"]
        frame["offset"] = by_bin.cumsum() - frame["length"]
        frame["fill"] = by_bin.transform("sum")
        return frame

    waiting = pieces.where(F.col("length") < capacity)
    done = pieces.where(F.col("length") >= capacity).select(
        "*",
        F.lit(-1).cast("long").alias("bin_group"),
        F.monotonically_increasing_id().alias("bin"),
        F.lit(0).cast("long").alias("offset"),
    )
    level, base = 0, 0
    while True:
        groups = max(1, -(-waiting.count() // group_size))
        key = F.pmod(F.xxhash64("row", "piece", F.lit(level)), F.lit(groups)) + base
        packed = work.keep(
            waiting.withColumn("bin_group", key).groupBy("bin_group").applyInPandas(pack_group, PACKED), f"level{level}"
        )
        weak = F.col("fill") < WEAK_FILL * capacity if groups > 1 else F.lit(False)
        done = done.unionByName(packed.where(~weak).drop("fill"))
        if groups == 1:
            break
        fewer = packed.where(weak).select(*pieces.columns)
        base, level, waiting = base + groups, level + 1, fewer
        if level > 1 and -(-fewer.count() // group_size) >= groups:  # no group can be filled better
            done = done.unionByName(packed.where(weak).drop("fill"))
            break
    # Groups differ in size, so each has its own 32 bits of numbers; full pieces count downwards from -1.
    number = F.when(F.col("bin_group") < 0, -1 - F.col("bin")).otherwise(F.shiftleft("bin_group", 32) + F.col("bin"))
    return done.withColumn("sequence_id", number).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "row"
    )
