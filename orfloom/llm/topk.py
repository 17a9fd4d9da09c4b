"""Exact top-k by inner product: dual-tree search over cover trees.

The rows are dealt into blocks, and each block gets a cover tree in its task.
The queries have one cover tree too, which is built once and broadcast.  Both
trees are walked together from their roots: a query node and a data node are
compared by the largest inner product that their points can reach,
``cq.cd + rq*|cd| + rd*|cq| + rq*rd`` with centres ``c`` and covering radii
``r``; the pair, with all that is below it, is dropped when that is under the
worst k-th score of the node's queries so far.  Else the node of the larger
radius is divided; two leaves are multiplied.  Blocks of a task are searched one
after another with the same k-th scores, so later blocks are pruned harder.  A
window keeps the best k of what the tasks found.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orfloom.llm.storage import stored

#: Rows of one tree, and of one task at most: a task returns k rows for each query.
BLOCK_ROWS, TASK_ROWS = 4096, 131072
#: Rows under which a node is not divided.
LEAF_ROWS = 128
#: Queries that are broadcast at once; more go in further passes.
QUERY_BYTES = 64 << 20
#: The scale of the components: floor(SCALE * x).
SCALE = 1024
_EXACT = float(1 << 53)
_MOST = int(np.iinfo(np.int64).max) - 1
_LEAST = -_MOST - 1


@dataclass
class Node:
    """Points ``rows`` of a matrix within ``radius`` of row ``center``; the children partition them."""

    center: int
    radius: float
    rows: np.ndarray
    children: list[Node] = field(default_factory=list)


def _distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    apart = points - center
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def cover_tree(points: np.ndarray, rows: np.ndarray, center: int | None = None) -> Node:
    """Children have centres more than half the radius apart and cover within half of it; radii are then tightened."""
    center = int(rows[0]) if center is None else center
    far = _distances(points[rows], points[center])
    node = Node(center, float(far.max(initial=0.0)), rows)
    if len(rows) <= LEAF_ROWS or node.radius == 0 or not np.isfinite(node.radius):
        return node
    half, left = node.radius / 2, rows
    singles = []
    next_center = center
    while len(left):
        near = _distances(points[left], points[next_center]) <= half
        mine, left = left[near], left[~near]
        if len(mine) == 1:
            singles.append(int(mine[0]))
        else:
            node.children.append(cover_tree(points, mine, next_center))
        if len(singles) > max(LEAF_ROWS, 8 * len(node.children)):  # points far from one another: more centres would cover nothing
            singles.extend(left.tolist())
            break
        if len(left):
            next_center = int(left[0])
    for i in range(0, len(singles), LEAF_ROWS):  # points that cover nothing else share leaves under this node
        part = np.array(singles[i : i + LEAF_ROWS])
        radius = np.sqrt(((points[part] - points[part[0]]) ** 2).sum(axis=1)).max()
        node.children.append(Node(int(part[0]), float(radius), part))
    return node


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: by float64 where no sum can pass 2^53, else by Python integers, cut to 64 bits."""
    top = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if top < _EXACT:
        return (a @ b.T).astype(np.int64)
    exact = [[int(x) for x in row] for row in b]
    found = [[max(-_MOST, min(_MOST, sum(int(x) * y for x, y in zip(row, other, strict=True)))) for other in exact] for row in a]
    return np.array(found, dtype=np.int64).reshape(len(a), len(b))


class Best:
    """The best k (score, smaller id first) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), _LEAST, dtype=np.int64)
        self.id = np.full((n, k), np.iinfo(np.int64).max, dtype=np.int64)

    def worst(self, rows: np.ndarray) -> int:
        return int(self.score[rows, -1].min())

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores``: a row for each of ``rows``, a column for each id; the least value stands for none."""
        some = np.flatnonzero((scores >= self.score[rows, -1:]).any(axis=1))
        if len(some):
            rows, both = rows[some], np.concatenate([self.score[rows[some]], scores[some]], axis=1)
            names = np.concatenate([self.id[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
            order = np.lexsort((names, -both), axis=-1)[:, : self.k]
            self.score[rows], self.id[rows] = np.take_along_axis(both, order, 1), np.take_along_axis(names, order, 1)


def _reach(q_at: np.ndarray, q_radius: np.ndarray, p_at: np.ndarray, p_radius: np.ndarray) -> np.ndarray:
    """Largest inner product of points around centres, rounded up; one side may be a single centre."""
    q_size, p_size = np.linalg.norm(q_at, axis=1), np.linalg.norm(p_at, axis=1)
    bound = (q_at * p_at).sum(axis=1) + q_radius * p_size + p_radius * q_size + q_radius * p_radius
    return bound + (q_size + q_radius) * (p_size + p_radius) * 1e-12 + 1


def search_block(queries: np.ndarray, query_ids: np.ndarray, query_tree: Node, points: np.ndarray, ids: np.ndarray, best: Best) -> int:
    """Walks the queries' tree and the block's together; returns how many scores were computed."""
    done = 0
    stack = [(np.inf, query_tree, cover_tree(points, np.arange(len(points))))]
    while stack:
        bound, q, d = stack.pop()
        if bound < best.worst(q.rows):
            continue
        if not q.children and not d.children:
            scores = dot(queries[q.rows], points[d.rows])
            done += scores.size
            scores[query_ids[q.rows][:, None] == ids[d.rows][None, :]] = _LEAST
            best.add(q.rows, scores, ids[d.rows])
            continue
        split_query = bool(q.children) and (not d.children or q.radius > d.radius)
        pairs = [(c, d) for c in q.children] if split_query else [(q, c) for c in d.children]
        with np.errstate(over="ignore", invalid="ignore"):
            bounds = _reach(
                queries[[x.center for x, _ in pairs]], np.array([x.radius for x, _ in pairs]), points[[y.center for _, y in pairs]], np.array([y.radius for _, y in pairs])
            )
        bounds[np.isnan(bounds)] = np.inf  # beyond float64: nothing is pruned
        stack.extend((float(bounds[i]), *pairs[i]) for i in np.argsort(bounds))  # the best is taken from the end
    return done


def _vectors(batch_ids: pa.Array, column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: ids and floored rows; rows that are null or hold null or non-finite components are left out."""
    lists = column.cast(pa.large_list(pa.float64()))
    with np.errstate(over="ignore"):
        values = np.floor(lists.values.to_numpy(zero_copy_only=False) * SCALE)
    where = lists.offsets.to_numpy()
    ids = batch_ids.to_numpy(zero_copy_only=False)
    valid = np.asarray(lists.is_valid()) & np.asarray(batch_ids.is_valid())
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    valid &= bad[where[1:]] == bad[where[:-1]]
    out = {}
    length = np.diff(where)
    for d in np.unique(length[valid]):
        rows = np.flatnonzero(valid & (length == d))
        take = where[rows][:, None] + np.arange(d)[None, :]
        out[int(d)] = ids[rows].astype(np.int64), values[take]
    return out


def top_k(df: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest integer inner product for each row with ``is_query``.

    Components are floored after scaling and scores are exact; past 64 bits they
    are cut to the largest or least value.  Ties go to the smaller id and a query
    is no candidate of its own.  Rows with a null id, a null vector, or
    components that are null or not finite (also after scaling) take no part,
    and only vectors of one dimension are compared; long ones are handled whole.  Fewer
    candidates give fewer rows.  A repeated row is a candidate once for each
    time, but one query; rows with a query's own id are never its candidates.
    Other columns play no part.  Queries are broadcast in passes of bounded
    size; tables of any size are dealt into tasks of ``TASK_ROWS`` rows.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"), is_query.alias("q"))
    rows = rows.where("id is not null and v is not null")
    total = rows.count()
    tasks = max(1, -(-total // TASK_ROWS), min(spark.sparkContext.defaultParallelism, -(-total // BLOCK_ROWS)))
    rows = stored(rows.repartition(tasks, "id"), "vectors") if tasks > 1 else rows
    ask = rows.where("q").select("id", "v")
    size = ask.agg(F.sum(8 * F.size("v") + 16)).first()[0] or 0
    passes = max(1, -(-int(size) // QUERY_BYTES))
    found = []
    for p in range(passes):
        part = ask.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == p) if passes > 1 else ask
        queries = _vectors_of(part)
        trees = {d: (q_ids, q, cover_tree(q, np.arange(len(q)))) for d, (q_ids, q) in queries.items()}
        shipped = spark.sparkContext.broadcast(trees)

        def run(batches, shipped=shipped):
            state = {d: (q_ids, q, tree, Best(len(q), k)) for d, (q_ids, q, tree) in shipped.value.items()}
            waiting: dict[int, list] = {}

            def flush(d):
                parts = waiting.pop(d, [])
                if parts and d in state:
                    ids, points = np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts])
                    q_ids, q, tree, best = state[d]
                    search_block(q, q_ids, tree, points, ids, best)

            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    piece = batch.slice(at, BLOCK_ROWS)
                    for d, got in _vectors(piece.column(0), piece.column(1)).items():
                        waiting.setdefault(d, []).append(got)
                        if sum(len(a) for a, _ in waiting[d]) >= BLOCK_ROWS:
                            flush(d)
            for d in list(waiting):
                flush(d)
            for q_ids, _, _, best in state.values():
                row, col = np.nonzero(best.score > _LEAST)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[row]), pa.array(best.id[row, col]), pa.array(best.score[row, col])], names=["query_id", "vec_id", "score"])

        near = rows.select("id", "v").mapInArrow(run, "query_id long, vec_id long, score long")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
        near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        found.append(near if passes == 1 else stored(near, "top-k"))
        if passes > 1:
            shipped.destroy()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _vectors_of(part: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The distinct queries of one pass, on the driver: at most about ``QUERY_BYTES``."""
    got = part.dropDuplicates(["id"]).toPandas()
    if not len(got):
        return {}
    return _vectors(pa.array(got["id"].to_numpy(np.int64)), pa.array(got["v"].tolist(), pa.list_(pa.float64())))
