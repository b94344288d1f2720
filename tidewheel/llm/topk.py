"""Exact top-k inner-product search with cover trees of queries and data.

The top level is one cover for all data: centres picked farthest-first from a bounded sample of the vectors. Each vector
belongs to the cell of its nearest centre, and each cell has its covering radius and its longest vector. A query starts
with the k-th best score that it has in the sample, and goes only to the cells whose bound reaches it. A cell of many
rows is dealt to several tasks; each builds a cover tree of its data and of its queries and walks both together. A pair
of nodes is dropped if no pair of points below them can reach the worst k-th score that the queries below the query node
hold. Pairs of leaves are scored exactly. The best k of each query from all cells meet in one window.

Two bounds hold for points within radii r, s of centres p, q at distance d, with norms of at most a, b; the smaller one
counts: p.q + |p| s + |q| r + r s, and (a^2 + b^2 - max(0, d - r - s)^2) / 2.

A node's children are centres picked farthest-first until they cover its points within a share of its radius, so
centres are as far apart as they cover, and each node keeps its true covering radius. Points that are equal form a node
of radius 0, which is a leaf; they tie, so the k + 1 smallest ids of such a leaf are all that can be found in it.

The sample (SAMPLE rows of the smallest hashes of vec_id) only chooses the cells and first bounds: results are exact
whatever it holds. Vectors without structure prune little, and then every query meets every cell.

Nulls: vectors that are null or hold a null or non-finite component, and rows with a null id, take no part. Rows that
repeat an id count once (the greatest vector). A shorter vector counts as filled up with zeros. Ties go to the smaller
id. A query gets all other rows if there are fewer than k. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import sent_with_tasks, written

SAMPLE, CENTRES, CELL = 4_096, 256, 2_048
# Components of a task's data and queries, so that memory does not depend on the dimension; rows of the smallest block.
DATA_BLOCK, QUERY_BLOCK, LEAST_BLOCK, SPREAD = 1 << 22, 1 << 20, 1_024, 64
LEAF, FANOUT, SHRINK = 128, 32, 1.3


@dataclass
class Node:
    low: int
    high: int
    centre: np.ndarray
    norm: float
    radius: float
    longest: float
    children: list[Node] = field(default_factory=list)


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, Node | None]:
    """The order of the points in which each node is one stretch, and the root."""
    order = np.arange(len(points))
    if not len(points):
        return order, None
    norms = np.sqrt((points**2).sum(1))

    def build(low: int, high: int) -> Node:
        at = order[low:high]
        own = points[at]
        centre = own[0]
        far = np.sqrt(((own - centre) ** 2).sum(1))
        node = Node(low, high, centre, float(norms[at[0]]), float(far.max()), float(norms[at].max()))
        if high - low <= LEAF or node.radius == 0:
            return node
        owner, near = np.zeros(len(own), np.int64), far.copy()
        for k in range(1, FANOUT):
            pick = int(near.argmax())
            if near[pick] <= node.radius / SHRINK and k > 1 or near[pick] == 0:
                break
            d = np.sqrt(((own - own[pick]) ** 2).sum(1))
            closer = d < near
            owner[closer], near[closer] = k, d[closer]
        sort = np.lexsort((near, owner))
        order[low:high] = at[sort]  # each child begins with its centre
        starts = np.flatnonzero(np.diff(owner[sort], prepend=-1))
        for a, b in zip(starts, [*starts[1:], high - low], strict=True):
            node.children.append(build(low + int(a), low + int(b)))
        return node

    return order, build(0, len(points))


def bound(dot: np.ndarray, p: np.ndarray, q: np.ndarray, radius: np.ndarray, other: np.ndarray, longest: np.ndarray, longest_other: np.ndarray) -> np.ndarray:
    """The most that an inner product can be below two centres of norms p and q and inner product dot."""
    reach = dot + p * other + q * radius + radius * other
    apart = np.maximum(0, np.sqrt(np.maximum(0, p * p + q * q - 2 * dot)) * (1 - 1e-9) - radius - other)
    norms = longest * longest + longest_other * longest_other
    return np.minimum(reach + 1e-6 * np.abs(reach), (norms - apart * apart) / 2 + 1e-6 * norms) + 1e-6


def is_exact(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether inner products of the rows are whole numbers that a double holds."""
    return float(np.abs(x).max(initial=1)) * float(np.abs(y).max(initial=1)) * max(1, x.shape[1]) < 2.0**52


def dual_search(data: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each query (rows) its best k scores and their ids (-1 where there are fewer), ties to the smaller id.

    data comes in the order of ids. floor: a score known to be reached by k rows, for each query; lower ones may be missed.
    """
    none = np.iinfo(np.int64).min
    x, q = (data.astype(np.float64), queries.astype(np.float64)) if is_exact(data, queries) else (data, queries)
    x_order, x_root = cover_tree(data.astype(np.float64))
    q_order, q_root = cover_tree(queries.astype(np.float64))
    x, ids, q, query_ids = x[x_order], ids[x_order], q[q_order], query_ids[q_order]
    least = np.full(len(q), none, np.int64) if floor is None else floor[q_order]
    score = np.full((len(q), k), none, np.int64)
    found = np.full((len(q), k), -1, np.int64)

    def most(a: Node, b: Node) -> float:
        return float(bound(float(a.centre @ b.centre), a.norm, b.norm, a.radius, b.radius, a.longest, b.longest))

    def base(a: Node, b: Node) -> None:
        high = min(b.high, b.low + k + 1) if b.radius == 0 else b.high  # equal points lie in the order of ids
        s = (q[a.low : a.high] @ x[b.low : high].T).astype(np.int64)
        s[query_ids[a.low : a.high, None] == ids[None, b.low : high]] = none
        # Only queries with something at or above their k-th score so far.
        for r in np.flatnonzero(s.max(1) >= least[a.low : a.high]):
            at = np.flatnonzero(s[r] >= least[a.low + r])
            new_s, new_i = np.append(score[a.low + r], s[r, at]), np.append(found[a.low + r], ids[b.low : high][at])
            best = np.lexsort((new_i, ~new_s))[:k]
            score[a.low + r], found[a.low + r] = new_s[best], new_i[best]
            least[a.low + r] = max(least[a.low + r], new_s[best[-1]])

    def walk(a: Node, b: Node) -> None:
        if most(a, b) < least[a.low : a.high].min():
            return
        if not a.children and not b.children:
            return base(a, b)
        if a.children and (not b.children or a.high - a.low > b.high - b.low):
            for child in a.children:
                walk(child, b)
        else:
            for child in sorted(b.children, key=lambda c: -most(a, c)):
                walk(a, child)

    if x_root and q_root:
        walk(q_root, x_root)
    found[score == none] = -1
    back = np.argsort(q_order)
    return score[back], found[back]


def as_integers(vectors: DataFrame) -> DataFrame:
    """vec_id and v, floor(256 * component) as long, of the vectors that take part."""
    fine = vectors.filter("vec_id is not null and embedding is not null").filter(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    ints = fine.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("v"))
    return ints.groupBy("vec_id").agg(F.max("v").alias("v"))


def matrix(rows: pa.Table | pa.RecordBatch, dim: int) -> np.ndarray:
    lists = rows.column("v")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lens = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lens), dim), np.int64)
    out[np.arange(dim)[None, :] < lens[:, None]] = lists.flatten().to_numpy()
    return out


def centres_of(sample: np.ndarray, most: int) -> np.ndarray:
    """Positions of at most ``most`` different vectors, each the farthest from those before."""
    chosen = [0]
    near = ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < most and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return np.array(chosen)


def dealt(ints: DataFrame, is_query: str, k: int, sample: np.ndarray, sample_ids: np.ndarray, centres: np.ndarray) -> DataFrame:
    """vec_id, v, query, cell, far (distance to the cell's centre), norm; floor: a query's k-th score in the sample, if it has k."""
    dim = sample.shape[1]
    shared = ints.sparkSession.sparkContext.broadcast((sample, sample_ids, sample[centres].astype(np.float64)))  # SAMPLE rows

    def floors(q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        rows, row_ids, _ = shared.value
        s = (q.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64) if is_exact(q, rows) else q @ rows.T
        own = ids[:, None] == row_ids[None, :]
        s[own] = np.iinfo(np.int64).min
        enough = (~own).sum(1) >= k
        return np.where(enough, np.partition(s, -k, 1)[:, -k], np.iinfo(np.int64).min) if s.shape[1] >= k else np.full(len(q), np.iinfo(np.int64).min)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cover = shared.value[2]
        for batch in batches:
            for low in range(0, batch.num_rows, 1_024):
                part = batch.slice(low, 1_024)
                v, ids = matrix(part, dim), part.column("vec_id").to_numpy()
                x = v.astype(np.float64)
                square = (x**2).sum(1)
                cell = (square[:, None] - 2 * x @ cover.T + (cover**2).sum(1)[None, :]).argmin(1)
                asks = part.column("query").to_numpy(zero_copy_only=False).astype(bool)
                floor = np.full(len(v), np.iinfo(np.int64).min)
                if asks.any():
                    floor[asks] = floors(v[asks], ids[asks])
                more = [pa.array(cell, pa.int32()), pa.array(np.sqrt(((x - cover[cell]) ** 2).sum(1))), pa.array(np.sqrt(square)), pa.array(floor)]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, "cell", "far", "norm", "floor"])

    return ints.withColumn("query", F.coalesce(F.expr(is_query), F.lit(False))).mapInArrow(run, "vec_id long, v array<long>, query boolean, cell int, far double, norm double, floor long")


def asked_cells(queries: DataFrame, cover: np.ndarray, cells: list) -> DataFrame:
    """vec_id, v, floor and each cell that may hold a score of at least the floor. cells: cell, radius, longest."""
    at = np.array([c.cell for c in cells])
    radius, longest = np.array([c.radius for c in cells]), np.array([c.longest for c in cells])
    centre = cover[at].astype(np.float64)
    norms, dim = np.sqrt((centre**2).sum(1)), cover.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, dim).astype(np.float64)
            own = np.sqrt((x**2).sum(1))[:, None]
            reached = bound(x @ centre.T, own, norms[None, :], 0.0, radius[None, :], own, longest[None, :]) >= batch.column("floor").to_numpy()[:, None]
            lists = pa.array([at[r].tolist() for r in reached], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "cells"])

    listed = queries.mapInArrow(run, "vec_id long, v array<long>, floor long, cells array<int>")
    return listed.select("vec_id", "v", "floor", F.explode("cells").alias("cell"))


def top_k(vectors: DataFrame, is_query: str, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of every query.

    is_query: SQL condition on vec_id.
    """
    spark = vectors.sparkSession
    ints = as_integers(vectors)
    n, dim = ints.agg(F.count("*"), F.max(F.size("v"))).first()
    dim = max(dim or 0, 1)
    drawn = ints.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(k + 1, min(SAMPLE, DATA_BLOCK // dim))).toArrow()
    if not drawn.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample, sample_ids = matrix(drawn, dim), drawn.column("vec_id").to_numpy()
    centres = centres_of(sample.astype(np.float64), max(1, min(CENTRES, n // CELL)))
    rows = written(dealt(ints, is_query, k, sample, sample_ids, centres), "topk-cells")

    # A row for each cell, CENTRES at most, comes to the driver and goes back with the joins.
    cells = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius"), F.max("norm").alias("longest")).collect()
    asked = asked_cells(rows.filter("query").select("vec_id", "v", "floor"), sample[centres], cells)
    asks = {r.cell: r["count"] for r in asked.groupBy("cell").count().collect()}
    block, query_block = max(LEAST_BLOCK, min(DATA_BLOCK // dim, n // SPREAD)), max(1, QUERY_BLOCK // dim)
    plan = [(c.cell, -(-c.n // block), -(-asks[c.cell] // query_block)) for c in cells if c.cell in asks]
    deal = F.broadcast(spark.createDataFrame(plan, "cell int, subs int, parts int"))

    slot = lambda salt, m: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
    data = rows.join(deal, "cell").select(F.lit(False).alias("query"), "vec_id", "v", F.lit(0).cast("long").alias("floor"), "cell", slot(1, "subs").alias("sub"), every("parts").alias("part"))
    asking = asked.join(deal, "cell").select(F.lit(True).alias("query"), "vec_id", "v", "floor", "cell", every("subs").alias("sub"), slot(2, "parts").alias("part"))

    def search(table: pa.Table) -> pa.Table:
        asks = table.column("query").to_numpy(zero_copy_only=False)
        rows, q = table.filter(pa.array(~asks)).sort_by("vec_id"), table.filter(pa.array(asks)).sort_by("vec_id")
        ids, query_ids, floor = rows.column("vec_id").to_numpy(), q.column("vec_id").to_numpy(), q.column("floor").to_numpy()
        score, found = dual_search(matrix(rows, dim), ids, matrix(q, dim), query_ids, k, floor)
        real = (score > np.iinfo(np.int64).min) & (score >= floor[:, None])
        return pa.table([np.repeat(query_ids, k)[real.ravel()], found[real], score[real]], ["query_id", "vec_id", "score"])

    met = data.unionByName(asking).groupBy("cell", "sub", "part").applyInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


sent_with_tasks(__name__)
