"""Exact top-k by inner product: ball trees per shard, searched by branch and bound.

Every vector goes to the nearest of a few pivots (means of a sample of at most SAMPLE rows); the cell of a pivot is a ball
around it, and a cell of over GROUP rows is dealt out to shards of about that many. A shard's rows come to one task, which
builds its ball trees (of TREE rows each) once; the queries that need the shard stream through behind them. A query goes down
a tree, nodes with the higher upper bound (q.center + |q| * radius) first, and leaves a node as soon as the bound is below
its current k-th score. A first search, in one shard of the cell that promises most, gives each query a k-th score that all
its other searches start from, and it is sent only to cells whose own bound reaches that score. The k best of each
shard are merged per query.

Defined results: rows with a null id, a null vector, or null or non-finite components take no part; an empty vector has
length 0 and scores 0 with its like; vectors are compared with vectors of their own length; a query is never its own
answer (rows that repeat its id included); other repeated rows each take a rank; every row of a repeated query id is
searched, and the ranks go over the answers of all of them, as in the SQL (equal rows give equal answers, each ranked); ties go to the smaller id; with fewer
than k candidates all are returned; an empty table gives an empty result. Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

GROUP, TREE, LEAF = 32_768, 4_096, 128
#: Rows of the sample that pivots are fitted on, and pivots at most: both are held by the driver and every task.
SAMPLE, PIVOTS = 4_096, 256
LOW = -(1 << 62)


def integer_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, v (array of double holding whole numbers), dim, of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    whole = F.col("vec_id").isNotNull() & x.isNotNull() & ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return embeddings.where(whole).select("vec_id", F.transform(x, lambda e: F.floor(e * scale).cast("double")).alias("v"), F.size(x).alias("dim"))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dim)


class BallTree:
    """Nodes as (rows, center, radius, children); splits along the line between two far points."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.root = self._node(np.arange(len(x)))

    def _node(self, rows: np.ndarray) -> tuple:
        x = self.x[rows]
        center = x.mean(0)
        far = np.sqrt(((x - center) ** 2).sum(1))
        if len(rows) <= LEAF or not far.max():
            return rows, center, far.max(), ()
        a = x[far.argmax()]
        b = x[((x - a) ** 2).sum(1).argmax()]
        order = (x @ (b - a)).argsort(kind="stable")
        half = len(rows) // 2
        return rows, center, far.max(), (self._node(rows[order[:half]]), self._node(rows[order[half:]]))


def _dot(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products as int64: floats are exact below 2 ** 53."""
    if q.size and x.size and np.abs(q).max() * np.abs(x).max() * x.shape[1] >= 2.0**53:
        return q.astype(np.int64) @ x.astype(np.int64).T
    return (q @ x.T).astype(np.int64)


def search(trees: list[tuple[np.ndarray, BallTree]], qids: np.ndarray, q: np.ndarray, kth: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best k (ids, scores) of each query among the trees (with their ids); kth: scores known to be reached by k candidates of each query."""
    best_s, best_i = np.full((len(q), k), LOW, np.int64), np.full((len(q), k), np.iinfo(np.int64).max)
    floor, norms = kth.copy(), np.sqrt((q**2).sum(1))

    def visit(tree: BallTree, own: np.ndarray, node: tuple, live: np.ndarray, bound: np.ndarray) -> None:
        live = live[bound >= floor[live]]
        if not len(live):
            return
        rows, _, _, children = node
        if children:
            bounds = [upper_bound(q[live] @ c[1], norms[live], c[2]) for c in children]
            for c in sorted((0, 1), key=lambda c: -bounds[c].sum()):
                visit(tree, own, children[c], live, bounds[c])
            return
        scores = _dot(q[live], tree.x[rows])
        found = np.broadcast_to(own[rows], scores.shape)
        scores = np.where(found == qids[live][:, None], LOW, scores)
        all_s, all_i = np.concatenate([best_s[live], scores], 1), np.concatenate([best_i[live], found], 1)
        all_i = np.where(all_s == LOW, np.iinfo(np.int64).max, all_i)
        top = np.lexsort((all_i, -all_s), axis=1)[:, :k]
        best_s[live], best_i[live] = np.take_along_axis(all_s, top, 1), np.take_along_axis(all_i, top, 1)
        floor[live] = np.maximum(floor[live], best_s[live, k - 1])

    for own, tree in trees:
        visit(tree, own, tree.root, np.arange(len(q)), np.full(len(q), np.inf))
    return best_i, best_s


def upper_bound(dots: np.ndarray, norms: np.ndarray, radius: float) -> np.ndarray:
    """No inner product with a point of the ball is above it, rounding included."""
    return (dots + norms * radius) * (1 + 1e-9) + 1e-3 + 1e-9 * np.abs(dots)


def _pivots(vectors: DataFrame, wanted: int) -> dict[int, np.ndarray]:
    """Up to wanted pivots for each length of vectors in a sample: means of a few rounds, from rows far apart."""
    rows = vectors.select("dim", "v", F.xxhash64("vec_id", "v").alias("h")).orderBy("h").limit(SAMPLE).collect() if wanted > 1 else []
    out = {}
    for dim in {r["dim"] for r in rows} - {0}:
        x = np.unique(np.array([r["v"] for r in rows if r["dim"] == dim]).reshape(-1, dim), axis=0)
        centers, far = [x.mean(0)], np.full(len(x), np.inf)
        while len(centers) < min(wanted, len(x)):
            far = np.minimum(far, ((x - centers[-1]) ** 2).sum(1))
            centers.append(x[far.argmax()])
        c = np.array(centers)
        for _ in range(5):
            near = _nearest(x, c)
            c = np.array([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
        out[dim] = c
    return out


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c**2).sum(1) - 2 * x @ c.T).argmin(1)


def _celled(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """vectors with g, the number of the nearest pivot, far, the distance to it, and row, a number of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, v = b.column(2).to_numpy(), b.column(1)
            g, far = np.zeros(len(dims), np.int32), np.zeros(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = _matrix(pa.chunked_array([v.take(pa.array(at))]), int(dim))
                c = pivots.get(int(dim), np.zeros((1, dim)))
                g[at] = _nearest(x, c)
                far[at] = np.sqrt(((x - c[g[at]]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(g), pa.array(far)], names=[*b.schema.names, "g", "far"])

    rows = vectors.select("vec_id", "v", "dim", F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(run, rows.select("*", F.lit(0).alias("g"), F.lit(0.0).alias("far")).schema)


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("copies", pa.int64())])


def _searched(shards: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """What queries find in the shards they are sent to. Both have dim, g, s; a shard's rows come first, then its queries as a stream."""
    key = ["dim", "g", "s"]
    left = shards.select(*key, F.lit(0).alias("kind"), F.col("vec_id").cast("long").alias("id"), "v", F.lit(0).cast("long").alias("kth"), F.lit(0).cast("long").alias("copies"))
    right = asked.select(*key, F.lit(1).alias("kind"), F.col("query_id").cast("long").alias("id"), "v", "kth", "copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, trees = None, [], None
        for b in batches:
            marks = np.stack([b.column(i).to_numpy() for i in range(4)], 1)
            edges = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1).tolist(), len(marks)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if hi == lo:
                    continue
                if (place := tuple(marks[lo, :3])) != at:
                    at, parts, trees = place, [], None
                piece, dim = b.slice(lo, hi - lo), int(marks[lo, 0])
                ids, x = piece.column(4).to_numpy(), _matrix(pa.chunked_array([piece.column(5)]), dim)
                if marks[lo, 3] == 0:
                    parts.append((ids, x))
                    continue
                if not parts:
                    continue
                if trees is None:
                    all_ids, all_x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                    trees = [(all_ids[i : i + TREE], BallTree(all_x[i : i + TREE])) for i in range(0, len(all_ids), TREE)]
                kth, copies = piece.column(6).to_numpy(), piece.column(7).to_numpy()
                for i in range(0, len(ids), 1024):
                    own = slice(i, i + 1024)
                    found, scores = search(trees, ids[own], x[own], kth[own], k)
                    keep = (scores > LOW) & (scores >= kth[own, None])
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[own], k)[keep.ravel()]), pa.array(found[keep]), pa.array(scores[keep]), pa.array(np.repeat(copies[own], k)[keep.ravel()])], schema=FOUND)

    both = left.unionByName(right).repartition(*key).sortWithinPartitions(*key, "kind")
    return both.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint, copies bigint")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score. vectors and queries: vec_id, v, dim (see integer_vectors)."""
    spark = vectors.sparkSession
    pivots = _pivots(vectors, min(PIVOTS, -(-4 * vectors.count() // GROUP)))
    celled = materialize(_celled(vectors, pivots), "celled")
    cells = celled.groupBy("dim", "g").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius")).collect()  # a row for each pivot
    balls = {(c["dim"], c["g"]): (-(-c["n"] // GROUP), c["radius"]) for c in cells}
    parts = spark.createDataFrame([(d, g, n) for (d, g), (n, _) in balls.items()], "dim int, g int, parts int")
    shards = celled.join(F.broadcast(parts), ["dim", "g"]).withColumn("s", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    once = queries.groupBy("vec_id", "v", "dim").agg(F.count(F.lit(1)).alias("copies"))
    asked = once.select(F.col("vec_id").cast("long").alias("query_id"), "v", "dim", "copies")

    def sent(first: bool):  # noqa: ANN202
        """Queries (with kth) by the shards they are sent to: the first of the most promising cell, or all others whose bound reaches kth."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                dims = b.column(2).to_numpy()
                for dim in np.unique(dims).tolist():
                    own = b.filter(pa.array(dims == dim))
                    names = sorted(g for d, g in balls if d == dim)
                    if not names:
                        continue
                    q = _matrix(pa.chunked_array([own.column(1)]), dim)
                    dots, norms = q @ pivots.get(dim, np.zeros((1, dim)))[names].T, np.sqrt((q**2).sum(1))
                    bounds = np.stack([upper_bound(dots[:, i], norms, balls[dim, g][1]) for i, g in enumerate(names)], 1)
                    best = bounds.argmax(1)
                    for i, g in enumerate(names):
                        for s in range(1 if first else balls[dim, g][0]):
                            wanted = best == i if first else (bounds[:, i] >= own.column(4).to_numpy()) & ((best != i) if s == 0 else True)
                            out = own.filter(pa.array(wanted))
                            if out.num_rows:
                                number = lambda x, out=out: pa.array([x] * out.num_rows, pa.int32())
                                yield pa.RecordBatch.from_arrays([*out.columns, number(g), number(s)], names=[*out.schema.names, "g", "s"])

        return run

    def dealt(df: DataFrame, first: bool) -> DataFrame:
        rows = df.select("query_id", "v", "dim", "copies", "kth")
        return rows.mapInArrow(sent(first), rows.select("*", F.lit(0).alias("g"), F.lit(0).alias("s")).schema)

    begun = materialize(_searched(shards, dealt(asked.withColumn("kth", F.lit(LOW)), True), k), "begun")
    if max((n for n, _ in balls.values()), default=0) * len({g for g in balls}) > 1:
        nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
        known = begun.withColumn("n", nth).where(F.col("n") == k).select("query_id", F.col("score").alias("low"))
        rest = asked.join(known, "query_id", "left").withColumn("kth", F.coalesce("low", F.lit(LOW))).drop("low")
        begun = begun.unionByName(_searched(shards, dealt(rest, False), k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = begun.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long")))))
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
