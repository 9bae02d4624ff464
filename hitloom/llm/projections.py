"""Approximate nearest neighbours by largest inner product, over stable projections in a kd-tree.

Vectors get one more coordinate so that the largest inner product is the smallest distance.  A few
Gaussian (2-stable) projections make points of low dimension: the squared projected distance, divided by
the squared distance, has a chi-square distribution.  The projected points lie in the cells of a kd-tree.
A query takes its projected neighbours in order of their distance, cell by cell, leaf by leaf and, by
some more projections, point by point, and verifies them with the whole vectors; it stops when the
chi-square test says that a better neighbour would have been met by now with probability ``certainty``.

The tree's upper part is fitted on a bounded sample and cuts the vectors into cells; large cells are dealt
out in blocks and their queries in chunks, so neither equal vectors nor all queries meet in one task.  A
query visits its own cell, then the nearest few, then all others, each time only cells that the test,
with the neighbours known by then, can't rule out.

Defined cases: missing vectors, and vectors with missing or non-finite components or of zero length, take
no part; vectors of different dimensions have no inner product, so each dimension is searched by itself;
equal scores go to the smaller vec_id; repeated vec_ids are candidates each for itself, but a query's own
id is never one, and the query is the smallest of its vectors; fewer candidates than asked for are all
returned; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, exp, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm.workspace import Workspace

FOUND = "query_id long, vec_id long, score double"
_CLOSE = 1e-9
#: Pairs of a query and a point that are in memory at once.
_AT_ONCE = 1 << 19


@dataclass(frozen=True)
class SearchSettings:
    """``sample`` bounds the vectors that the cells of a dimension are fitted on.

    The tree has ``projections`` dimensions, the test of a point uses ``tests`` (both even).  A task holds
    ``block`` vectors and ``chunk`` queries; ``rounds`` are the cells visited at once after the own.
    """

    neighbours: int = 20
    projections: int = 8
    tests: int = 32
    certainty: float = 0.95
    sample: int = 20_000
    block: int = 8_000
    chunk: int = 2_000
    rounds: tuple[int, ...] = (4,)
    leaf: int = 128
    seed: int = 29


def chi_square_bound(degrees: int, certainty: float) -> float:
    """Where the distribution function of a chi-square variable with an even number of degrees reaches ``certainty``."""

    def below(x: float) -> float:
        term = total = 1.0
        for j in range(1, degrees // 2):
            term *= x / 2 / j
            total += term
        return 1 - exp(-x / 2) * total

    low, high = 0.0, 20.0 * degrees
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < certainty else (low, middle)
    return high


def split_cells(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """A kd-tree of ``2**depth`` cells as a heap: node k splits by a dimension and a value."""
    nodes: list[tuple[int, float]] = [(0, 0.0)] * (2**depth - 1)
    members = {0: points}
    for k in range(2**depth - 1):
        own = members.pop(k)
        if len(own):
            dimension = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            nodes[k] = dimension, float(np.median(own[:, dimension]))
        left = own[:, nodes[k][0]] < nodes[k][1]
        members[2 * k + 1], members[2 * k + 2] = own[left], own[~left]
    return nodes


def cell_of(points: np.ndarray, nodes: list[tuple[int, float]], depth: int) -> np.ndarray:
    at = np.zeros(len(points), np.int64)
    dimensions = np.array([d for d, _ in nodes] or [0])
    values = np.array([v for _, v in nodes] or [0.0])
    for _ in range(depth):
        right = points[np.arange(len(points)), dimensions[at]] >= values[at]
        at = 2 * at + 1 + right
    return at - (2**depth - 1)


def cell_boxes(nodes: list[tuple[int, float]], depth: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    low, high = np.full((2 ** (depth + 1) - 1, dimensions), -np.inf), np.full((2 ** (depth + 1) - 1, dimensions), np.inf)
    for k, (dimension, value) in enumerate(nodes):
        for child in (2 * k + 1, 2 * k + 2):
            low[child], high[child] = low[k], high[k]
        high[2 * k + 1, dimension] = value
        low[2 * k + 2, dimension] = value
    return low[2**depth - 1 :], high[2**depth - 1 :]


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d : d + 1]
        out += np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0) ** 2
    return out


class Space:
    """The projections of one dimension, its cells, and the distance that belongs to an inner product."""

    def __init__(self, dimension: int, longest: float, settings: SearchSettings):
        random = np.random.default_rng(settings.seed)
        self.matrix = random.standard_normal((dimension + 1, max(settings.projections, settings.tests)))
        self.longest, self.settings = longest, settings
        self.tree_bound = chi_square_bound(settings.projections, settings.certainty)
        self.point_bound = chi_square_bound(settings.tests, settings.certainty)

    def fit(self, sample: np.ndarray, n: int, first_cell: int) -> None:
        """Place the cells, numbered from ``first_cell``, for ``n`` vectors of which ``sample`` are given."""
        self.first_cell = first_cell
        self.depth = max(0, ceil(log2(n / self.settings.block)))
        self.nodes = split_cells(self.tree(self.candidates(sample)), self.depth)
        self.low, self.high = cell_boxes(self.nodes, self.depth, self.settings.projections)

    def candidates(self, x: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.longest - (x**2).sum(axis=1), 0))
        return np.column_stack([x, extra]) @ self.matrix

    def queries(self, q: np.ndarray) -> np.ndarray:
        return q @ self.matrix[:-1]

    def tree(self, points: np.ndarray) -> np.ndarray:
        return points[:, : self.settings.projections]

    def cell(self, points: np.ndarray) -> np.ndarray:
        return self.first_cell + cell_of(self.tree(points), self.nodes, self.depth)

    def distance(self, q_norm: np.ndarray, worst: np.ndarray) -> np.ndarray:
        """The squared distance of the worst neighbour still kept; the test stops at a bound times this."""
        return np.maximum(q_norm + self.longest - 2 * worst, 0)


def search_block(space: Space, ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, worst: np.ndarray):
    """The best candidates of a block per query, as arrays of query, candidate and score, and the number verified.

    At each step every query visits its next leaf; the queries of all leaves go through numpy together.
    """
    settings = space.settings
    points, asked = space.candidates(x)[:, : settings.tests], space.queries(q)[:, : settings.tests]
    tree_points = space.tree(space.candidates(x))
    depth = max(0, ceil(log2(max(1, len(x)) / settings.leaf)))
    leaf = cell_of(tree_points, split_cells(tree_points, depth), depth)
    order = np.argsort(leaf, kind="stable")
    cuts = np.searchsorted(leaf[order], np.arange(2**depth + 1))
    members = [order[a:b] for a, b in zip(cuts, cuts[1:]) if b > a]
    low = np.array([tree_points[m].min(axis=0) for m in members])
    high = np.array([tree_points[m].max(axis=0) for m in members])
    distance = box_distances(space.tree(space.queries(q)), low, high)
    nearest = np.argsort(distance, axis=1, kind="stable")
    q_norm, worst = (q**2).sum(axis=1), worst.copy()
    point_norm = (points**2).sum(axis=1)
    k = settings.neighbours
    # Per query its best so far, by falling score and rising id.
    held_ids = np.zeros((len(q_ids), k), np.int64)
    held_scores = np.zeros((len(q_ids), k))
    taken = np.zeros((len(q_ids), k), bool)
    # How much the products of a whole leaf may differ from those summed one by one.
    slack = _CLOSE * np.sqrt(q_norm * (x**2).sum(axis=1).max())
    longest = max(map(len, members))
    listed = np.array([np.pad(own, (0, longest - len(own))) for own in members])
    at_once = max(1, _AT_ONCE // longest)
    verified = 0

    def visit(rows: np.ndarray, leaves: np.ndarray) -> int:
        """Each row's query meets the points of its leaf; rows are sorted by leaf."""
        met_points = 0
        apart, rough = np.full((len(rows), longest), np.inf), np.zeros((len(rows), longest))
        different = np.flatnonzero(np.append(True, leaves[1:] != leaves[:-1]))
        for a, b in zip(different, [*different[1:], len(rows)]):
            own, mine = members[leaves[a]], rows[a:b]
            far = point_norm[own] - 2 * (asked[mine] @ points[own].T) + (asked[mine] ** 2).sum(axis=1)[:, None]
            apart[a:b, : len(own)], rough[a:b, : len(own)] = far, q[mine] @ x[own].T
        order = np.argsort(apart, axis=1, kind="stable")
        apart, rough = np.take_along_axis(apart, order, axis=1), np.take_along_axis(rough, order, axis=1)
        # In parts of ascending projected distance, so that the neighbours met stop the test earlier.
        at, width = 0, k
        while at < longest and len(rows):
            reach = space.point_bound * space.distance(q_norm[rows], worst[rows]) + _CLOSE
            reach = np.minimum(reach, np.finfo(float).max)
            part = slice(at, at + width)
            met = apart[:, part] <= reach[:, None]
            met_points += int(met.sum())
            row, column = np.nonzero(met & (rough[:, part] >= (worst[rows] - slack[rows])[:, None]))
            near, asking = listed[leaves[row], order[row, at + column]], rows[row]
            # Summed in one order for all, so that equal vectors have equal scores.
            exact = (x[near] * q[asking]).sum(axis=1)
            good = (exact >= worst[asking]) & (ids[near] != q_ids[asking])
            _keep_best(held_ids, held_scores, taken, asking[good], ids[near[good]], exact[good])
            full = rows[taken[rows, -1]]
            worst[full] = np.maximum(worst[full], held_scores[full, -1])
            at, width = at + width, 2 * width
            if at < longest:  # the next part is farther than all of this one
                on = apart[:, at - 1] <= reach
                rows, leaves, order, apart, rough = rows[on], leaves[on], order[on], apart[on], rough[on]
        return met_points

    active = np.arange(len(q_ids))
    for step in range(len(members)):
        now = nearest[active, step]
        open_still = distance[active, now] <= space.tree_bound * space.distance(q_norm[active], worst[active])
        active, now = active[open_still], now[open_still]
        if not len(active):
            break
        by_leaf = np.argsort(now, kind="stable")
        active, now = active[by_leaf], now[by_leaf]
        for at in range(0, len(active), at_once):
            verified += visit(active[at : at + at_once], now[at : at + at_once])
    return np.repeat(q_ids, taken.sum(axis=1)), held_ids[taken], held_scores[taken], verified


def _keep_best(ids: np.ndarray, scores: np.ndarray, taken: np.ndarray, rows: np.ndarray, new_ids: np.ndarray, new_scores: np.ndarray):
    """Merge new candidates of some rows into the best of each row, in place."""
    k = ids.shape[1]
    own = np.unique(rows)
    old = np.nonzero(taken[own])
    at = np.concatenate([own[old[0]], rows])
    all_ids = np.concatenate([ids[own][old], new_ids])
    all_scores = np.concatenate([scores[own][old], new_scores])
    order = np.lexsort((all_ids, -all_scores, at))
    at, all_ids, all_scores = at[order], all_ids[order], all_scores[order]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    kept = place < k
    at, place = at[kept], place[kept]
    ids[at, place], scores[at, place], taken[at, place] = all_ids[kept], all_scores[kept], True


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64) if len(column) else np.empty((0, 1))


def _by_dimension(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each dimension of a column of vectors, the rows that have it, and their matrix."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield int(d), rows, _matrix(column.take(pa.array(rows)))


def _fit_spaces(usable: DataFrame, settings: SearchSettings) -> dict[int, Space]:
    """A space per dimension; its cells are placed by a bounded sample, chosen by hash."""
    spaces: dict[int, Space] = {}
    cells = 0
    facts = usable.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"), F.max("norm").alias("longest"))
    for d, n, longest in sorted(tuple(row) for row in facts.collect()):
        sample = usable.where(F.size("x") == d).orderBy(F.xxhash64("vec_id"), "vec_id", "x").limit(settings.sample)
        spaces[d] = Space(d, longest * (1 + 1e-12), settings)
        spaces[d].fit(_matrix(sample.select("x").toArrow().column("x").combine_chunks()), n, cells)
        cells += 2 ** spaces[d].depth
    return spaces


def nearest(
    vectors: DataFrame, asked: Column, settings: SearchSettings = SearchSettings(), vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Per row that fulfils ``asked``: its neighbours among all rows, with rank and score."""
    spark = vectors.sparkSession
    work = Workspace(spark, "projections")
    usable = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("x"),
        F.coalesce(asked, F.lit(False)).alias("asked"),
    )
    usable = usable.where(_usable(F.col("x")) & F.col("vec_id").isNotNull())
    usable = usable.withColumn("norm", F.aggregate("x", F.lit(0.0), lambda a, b: a + b * b))
    spaces = _fit_spaces(usable, settings)
    if not spaces:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.empty(batch.num_rows, np.int64)
            for d, rows, x in _by_dimension(batch.column("x")):
                cell[rows] = spaces[d].cell(spaces[d].candidates(x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    placed_schema = "vec_id long, x array<double>, asked boolean, cell long"
    placed = work.keep(usable.select("vec_id", "x", "asked").mapInArrow(place, placed_schema), "placed")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / settings.block).cast("long").alias("blocks"))
    sizes = work.keep(sizes, "sizes")
    blocks = placed.join(sizes, "cell").select("vec_id", "x", "cell", F.pmod(F.xxhash64("vec_id", "x"), "blocks").alias("block"))
    queries = placed.where("asked").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("x").alias("q"))

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found = ([], [], [])
        if candidates.num_rows and queries.num_rows:
            candidates = candidates.sort_by("vec_id")
            x = _matrix(candidates.column("x").combine_chunks())
            found = search_block(
                spaces[x.shape[1]],
                candidates.column("vec_id").to_numpy(),
                x,
                queries.column("query_id").to_numpy(),
                _matrix(queries.column("q").combine_chunks()),
                queries.column("worst").to_numpy(),
            )
        arrays = [pa.array(a, t) for a, t in zip(found, (pa.int64(), pa.int64(), pa.float64()))]
        return pa.table(arrays, names=["query_id", "vec_id", "score"])

    def visit(visits: DataFrame, name: str) -> DataFrame:
        """Search the cells of ``visits``: every block of a cell with every chunk of its queries."""
        visits = work.keep(visits, f"{name}-visits")
        chunks = visits.groupBy("cell").agg(F.ceil(F.count("*") / settings.chunk).cast("long").alias("chunks"))
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        asked = visits.join(sizes, "cell").join(chunks, "cell").withColumn("chunk", F.pmod(F.xxhash64("query_id"), "chunks"))
        asked = asked.withColumn("block", every("blocks")).select("query_id", "q", "worst", "cell", "block", "chunk")
        held = blocks.join(chunks, "cell").withColumn("chunk", every("chunks")).drop("chunks")
        key = ["cell", "block", "chunk"]
        return work.keep(held.groupBy(key).cogroup(asked.groupBy(key)).applyInArrow(search, FOUND), name)

    def cells_of(first: int, last: int | None):
        """Visits of each query to the cells from number ``first`` to ``last``, by distance, that the test leaves."""

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for d, rows, q in _by_dimension(batch.column("q")):
                    space = spaces[d]
                    projected = space.tree(space.queries(q))
                    worst = batch.column("worst").to_numpy(zero_copy_only=False)[rows]
                    distance = box_distances(projected, space.low, space.high)
                    open_still = distance <= space.tree_bound * space.distance((q**2).sum(axis=1), worst)[:, None]
                    # The own cell is at distance 0; a query on a border may have others there.
                    distance[np.arange(len(q)), space.cell(projected) - space.first_cell] = -1
                    place = np.argsort(np.argsort(distance, axis=1, kind="stable"), axis=1)
                    row, cell = np.nonzero(open_still & (place >= first) & (place < (last or place.shape[1])))
                    taken = [batch.column(c).take(pa.array(rows[row])) for c in range(3)]
                    yield pa.RecordBatch.from_arrays(
                        [*taken, pa.array(cell + space.first_cell)], names=["query_id", "q", "worst", "cell"]
                    )

        return choose

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def top(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= settings.neighbours)

    found, first = None, 0
    most = max(2**space.depth for space in spaces.values())
    for width in (1, *settings.rounds, None):
        if first >= most:
            break
        known = queries.withColumn("worst", F.lit(float("-inf")))
        if found is not None:
            last_kept = found.where(F.col("rank") == settings.neighbours).select("query_id", F.col("score").alias("worst"))
            known = queries.join(last_kept, "query_id", "left").withColumn("worst", F.coalesce("worst", F.lit(float("-inf"))))
        last = None if width is None else first + width
        visits = known.mapInArrow(cells_of(first, last), "query_id long, q array<double>, worst double, cell long")
        new = visit(visits, f"found-{first}")
        found = top(new if found is None else found.drop("rank").unionByName(new))
        found, first = work.keep(found, f"top-{first}"), last or most
    return found.select("query_id", "rank", "vec_id", "score")
