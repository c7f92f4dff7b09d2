"""Exact top-k search by inner product: dual-tree search over shards of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .cover_tree import LEAF, NOTHING, CoverTree, build, no_floor, outer_bounds, search

SHARD_ROWS = 1 << 14
QUERY_ROWS = 1 << 11
QUERY_LEAF = 64
SCALE = 1024.0
# Cells that rows are dealt to before shards are cut, shards that each group of a block
# of queries searches first, groups of trees that are compared with others at once.
MOST_CELLS = 1 << 10
NEAREST = 2
ROOTS = 1 << 10
_DRAWN = 8
_CIRCLE = 1 << 30
_FLOOR = "array<struct<place: int, score: bigint, vec_id: bigint>>"
_GROUPS = pa.list_(
    pa.struct(
        [("points", pa.int32()), ("centre", pa.list_(pa.float64())), ("radius", pa.float64())]
    )
)


def whole_vectors(rows: DataFrame) -> DataFrame:
    """vec_id and v, the embedding times 1024 rounded down; rows whose id or
    embedding is NULL or whose embedding holds a component that is NULL or not
    finite are left out. Equal rows become one."""
    double = F.transform("embedding", lambda x: x.cast("double"))
    infinite = F.lit(float("inf"))
    sound = F.forall(
        double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)
    )
    return (
        rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .filter(F.coalesce(sound, F.lit(False)))
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.transform(double, lambda x: F.floor(x * SCALE)).alias("v"),
        )
        .distinct()
    )


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """One row per list; components that a list lacks are zero, those beyond the
    width are left out."""
    sizes = np.diff(np.asarray(lists.offsets))
    points = np.zeros((len(lists), width))
    row = np.repeat(np.arange(len(lists)), sizes)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = inside < width
    points[row[kept], inside[kept]] = np.asarray(lists.flatten())[kept]
    return points


def _cells(rows: int, size: int) -> int:
    return min(MOST_CELLS, max(1, -(-rows // size)))


def _pivots(vectors: DataFrame, rows: int, n: int) -> np.ndarray:
    """At most ``n`` different vectors, the first by hash of a few times as many."""
    hashed = vectors.withColumn("place", F.pmod(F.xxhash64("vec_id", "v"), F.lit(_CIRCLE)))
    share = 2 * _DRAWN * n / max(rows, 1)
    if share < 1:
        hashed = hashed.filter(F.col("place") <= int(_CIRCLE * share))
    drawn = hashed.orderBy("place", "vec_id").limit(_DRAWN * n).select("v").toArrow()
    different = list(dict.fromkeys(map(tuple, drawn.column(0).to_pylist())))[:n]
    pivots = np.zeros((max(len(different), 1), max([1, *map(len, different)])))
    for i, v in enumerate(different):
        pivots[i, : len(v)] = v
    return pivots


def _in_cells(vectors: DataFrame, pivots: np.ndarray, shards: int, blocks: int) -> DataFrame:
    """vec_id, v, the nearest of the first ``shards`` pivots as ``cell`` and of the
    first ``blocks`` as ``query_cell``. Cells decide where a row is searched, not
    what is found."""
    half = (pivots**2).sum(axis=1) / 2

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _matrix(batch.column(1), pivots.shape[1]) @ pivots.T - half
            cells = [
                pa.array(near[:, :n].argmax(axis=1).astype(np.int32)) for n in (shards, blocks)
            ]
            yield pa.record_batch(
                [*batch.columns, *cells], names=["vec_id", "v", "cell", "query_cell"]
            )

    return vectors.select("vec_id", "v").mapInArrow(
        place, "vec_id long, v array<long>, cell int, query_cell int"
    )


def _groups(tree: CoverTree) -> np.ndarray:
    """The nodes below the root, or the root if there are none."""
    return np.arange(tree.child[0], tree.child[0] + tree.children[0]) if tree.children[0] else np.array([0])


def _trees(rows: DataFrame, cell: str, size: int, leaf: int, name: str) -> DataFrame:
    """One row per shard of at most about ``size`` rows of a cell: its number, its
    tree, and the groups of points below the tree's root, in tree order."""
    counts = rows.groupBy(cell).agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") / size)
    part = F.pmod(F.xxhash64("vec_id", "v"), parts)
    # At most MOST_CELLS counts.
    groups = (
        rows.join(F.broadcast(counts), cell)
        .select((F.col(cell) * F.lit(1 << 40) + part).alias("number"), "vec_id", "v")
        .groupBy("number")
        .agg(
            F.collect_list("vec_id").alias("ids"),
            F.max(F.size("v")).alias("width"),
            F.collect_list("v").alias("vs"),
        )
    )

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.asarray(batch.column(1)[i].values)
                points = _matrix(batch.column(3)[i].values, batch.column(2)[i].as_py())
                tree = build(points, ids, leaf)
                found = [
                    {
                        "points": int(tree.end[g] - tree.begin[g]),
                        "centre": tree.points[tree.centre[g]].tolist(),
                        "radius": float(tree.radius[g]),
                    }
                    for g in _groups(tree)
                ]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(i, 1),
                        pa.array([found], _GROUPS),
                        pa.array([tree.to_bytes()], pa.binary()),
                    ],
                    names=["number", "groups", "tree"],
                )

    grown = groups.select("number", "ids", "width", "vs").mapInArrow(
        grow,
        "number long, groups array<struct<points: int, centre: array<double>, radius: double>>, "
        "tree binary",
    )
    return stored(grown, name)


def _roots(trees: DataFrame) -> DataFrame:
    """number, group, points, centre, radius, and a worst score that all reach."""
    return (
        trees.select("number", F.posexplode("groups").alias("group", "root"))
        .select("number", "group", "root.*")
        .withColumn("worst", F.lit(NOTHING))
    )


def _pages(roots: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Groups of trees by pages of about ``ROOTS``, those of a tree in one page."""
    n = max(1, -(-roots.count() // ROOTS))
    page = F.pmod(F.xxhash64("number"), F.lit(n)).cast("int").alias("page")
    root = F.struct("number", "group", "centre", "radius", "worst")
    return roots.groupBy(page).agg(F.collect_list(root).alias(name)), n


class _Page:
    """Groups of a page sorted by tree; ``starts`` and ``numbers`` of the trees."""

    def __init__(self, roots: pa.StructArray):
        number, group, self.centre, radius, worst = roots.flatten()
        number = np.asarray(number)
        self.order = np.argsort(number, kind="stable")
        self.number, self.group = number[self.order], np.asarray(group)[self.order]
        self.numbers, self.starts = np.unique(self.number, return_index=True)
        self.radius = np.asarray(radius)[self.order]
        self.worst = np.asarray(worst)[self.order]
        self.width = int(np.diff(np.asarray(self.centre.offsets)).max())

    def ball(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        return _matrix(self.centre, width)[self.order], self.radius


def _pairs(blocks: DataFrame, shards: DataFrame, nearest: int | None) -> DataFrame:
    """block, shard: the ``nearest`` shards of each group of a block, by the inner
    products of centres; or all shards with a group whose bound with a group of the
    block reaches the ``worst`` score of the latter.

    Pages of groups meet, not trees; of a pair of pages only what is asked for goes on.
    """
    left, _ = _pages(blocks, "blocks")
    right, n = _pages(shards, "shards")
    met = left.select(
        "blocks", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("page")
    ).join(right, "page")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b, s = (_Page(batch.column(c)[i].values) for c in (0, 1))
                width = max(b.width, s.width)
                balls = b.ball(width), s.ball(width)
                if nearest is None:
                    bounds = np.maximum.reduceat(outer_bounds(*balls), s.starts, axis=1)
                    reached = np.floor(bounds) >= b.worst[:, None]
                    row, column = np.nonzero(np.logical_or.reduceat(reached, b.starts, axis=0))
                    block, group, score = b.numbers[row], np.zeros(len(row), np.int32), None
                else:
                    middle = np.maximum.reduceat(balls[0][0] @ balls[1][0].T, s.starts, axis=1)
                    column = np.argsort(-middle, axis=1, kind="stable")[:, :nearest]
                    row = np.repeat(np.arange(len(middle)), column.shape[1])
                    column = column.ravel()
                    block, group, score = b.number[row], b.group[row], middle[row, column]
                yield pa.record_batch(
                    [
                        pa.array(block),
                        pa.array(group),
                        pa.array(s.numbers[column]),
                        pa.nulls(len(row), pa.float64()) if score is None else pa.array(score),
                    ],
                    names=["block", "group", "shard", "score"],
                )

    found = met.select("blocks", "shards").mapInArrow(
        compare, "block long, group int, shard long, score double"
    )
    if nearest is not None:
        order = Window.partitionBy("block", "group").orderBy(F.desc("score"), "shard")
        found = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= nearest)
        return found.select("block", "shard").distinct()
    return found.select("block", "shard")


def _searched(pairs: DataFrame, blocks: DataFrame, shards: DataFrame, k: int) -> DataFrame:
    """block, group and place (of the query in its block's tree), query_id, vec_id,
    score: the best of each pair of a block and a shard, less what ``floor`` of the
    block, place and score and id of queries' kth candidates, makes useless."""
    trees = pairs.select("block", "shard").join(
        blocks.select(F.col("number").alias("block"), F.col("tree").alias("queries"), "floor"),
        "block",
    )
    trees = trees.join(shards.select(F.col("number").alias("shard"), "tree"), "shard")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                queries, data = (
                    CoverTree.from_bytes(batch.column(c)[i].as_buffer().to_pybytes())
                    for c in (1, 2)
                )
                queries, data = _same_width(queries, data)
                scores, ids = no_floor(len(queries.ids))
                if batch.column(3)[i].is_valid:
                    at, floor_scores, floor_ids = (
                        np.asarray(c) for c in batch.column(3)[i].values.flatten()
                    )
                    scores[at], ids[at] = floor_scores, floor_ids
                best = search(queries, data, k, (scores, ids))
                row, place = np.nonzero(best.scores > NOTHING)
                group = np.searchsorted(queries.begin[_groups(queries)], row, "right") - 1
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(row), batch.column(0)[i].as_py(), np.int64)),
                        pa.array(group.astype(np.int32)),
                        pa.array(row.astype(np.int32)),
                        pa.array(queries.ids[row]),
                        pa.array(best.ids[row, place]),
                        pa.array(best.scores[row, place]),
                    ],
                    names=["block", "group", "place", "query_id", "vec_id", "score"],
                )

    return trees.select("block", "queries", "tree", "floor").mapInArrow(
        find, "block long, group int, place int, query_id long, vec_id long, score long"
    )


def _kth(found: DataFrame, k: int) -> DataFrame:
    """The kth candidate of each query that has so many: block, group, place, score,
    vec_id."""
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k)


def _with_worst(roots: DataFrame, kth: DataFrame) -> DataFrame:
    """Groups of blocks with the least kth score of their queries. A query with fewer
    than k candidates still needs every shard."""
    least = kth.groupBy(F.col("block").alias("number"), "group").agg(
        F.count(F.lit(1)).alias("known"), F.min("score").alias("least")
    )
    worst = F.when(F.col("known") == F.col("points"), F.col("least")).otherwise(F.lit(NOTHING))
    joined = roots.join(least, ["number", "group"], "left")
    return joined.withColumn("worst", worst).drop("known", "least")


def search_rounds(
    rows: DataFrame, is_query: Column, k: int
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What both rounds of a search find (see ``top_k``), and the pairs of a block
    and a shard that each of them searches."""
    vectors = stored(whole_vectors(rows), "topk-vectors")
    n, asked = vectors.count(), vectors.filter(is_query).count()
    cells, query_cells = _cells(n, SHARD_ROWS), _cells(asked, QUERY_ROWS)
    pivots = _pivots(vectors, n, max(cells, query_cells))
    placed = stored(_in_cells(vectors, pivots, cells, query_cells), "topk-cells")
    shards = _trees(placed, "cell", SHARD_ROWS, LEAF, "topk-shards")
    blocks = _trees(
        placed.filter(is_query), "query_cell", QUERY_ROWS, QUERY_LEAF, "topk-queries"
    )
    block_roots, shard_roots = _roots(blocks), _roots(shards)
    fresh = blocks.withColumn("floor", F.lit(None).cast(_FLOOR))
    near = stored(_pairs(block_roots, shard_roots, NEAREST), "topk-near")
    first = stored(_searched(near, fresh, shards, k), "topk-found")
    kth = stored(_kth(first, k), "topk-kth")
    floors = kth.groupBy(F.col("block").alias("number")).agg(
        F.collect_list(F.struct("place", "score", "vec_id")).alias("floor")
    )
    left = _pairs(_with_worst(block_roots, kth), shard_roots, None)
    left = stored(left.join(near, ["block", "shard"], "left_anti"), "topk-left")
    known = blocks.join(floors, "number", "left")
    return first, _searched(left, known, shards, k), near, left


def top_k(rows: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """The ``k`` rows with the highest inner product for each query row, without
    those of the query's own id: query_id, rank, vec_id, score.

    ``rows``: vec_id, embedding; other columns are not read. ``is_query`` picks the
    queries by vec_id. Ties go to the smaller id. Fewer candidates than ``k`` are
    all returned; a query without any gives no row. A shorter vector counts as
    filled up with zeros. Vectors that hold a NULL or a component that is not
    finite take no part, equal rows count once; two queries of one id with other
    vectors share the ranks of that id. Scores must fit into 64 bits.

    Rows go to the cell of their nearest pivot, of which there are at most
    ``MOST_CELLS``, and cells are cut into shards, each with a cover tree; queries in
    the same way into blocks, each with a tree of its own. A block first searches the
    ``NEAREST`` shards of each group below its root. What it finds there decides which
    other shards it meets: those with a bound that reaches the worst kth score so far
    of one of its groups. The best of all pairs are ranked again.
    """
    first, second, _, _ = search_rounds(rows, is_query, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        first.unionByName(second)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _same_width(a: CoverTree, b: CoverTree) -> tuple[CoverTree, CoverTree]:
    width = max(a.points.shape[1], b.points.shape[1])

    def widened(tree: CoverTree) -> CoverTree:
        more = np.zeros((len(tree.points), width - tree.points.shape[1]))
        return CoverTree(**{**tree.__dict__, "points": np.hstack([tree.points, more])})

    return widened(a), widened(b)
