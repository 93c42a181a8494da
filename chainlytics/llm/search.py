"""Exact top-k inner products with one KD-tree a shard.

Vectors are dealt to shards by a hash of their row. A shard's tree splits at the median of the widest dimension down to
leaves of ``LEAF`` vectors; every node keeps the tight box of its vectors. The best product a box can give is an upper
bound: the sum over dimensions of max(q*low, q*high). A query visits nodes best bound first and stops when no bound
reaches its kth score.

A query first searches its own shard. With the kth score found there it is held against the root boxes of the other shards, which
are kept in blocks, and goes on only to those whose bound reaches that score; there the score cuts branches from the start. A
shard's tree is sent once, ahead of the blocks of queries that ask it, and these pass through the task one after another.
Products are whole numbers and every cut keeps bounds equal to the kth score, so ties fall to the smaller id exactly."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainlytics.llm.tables import kept, table

#: Vectors a shard and a leaf hold.
SHARD, LEAF = 16_384, 256

SCALE = 64

#: Root boxes a block holds, and queries that travel together.
BOXES, TOGETHER = 512, 512

TREE = "shard int, ids binary, rows binary, points binary, lows binary, highs binary, nodes binary, asked binary, queries binary, kth binary, found binary"
ASKS = "shard int, asked binary, queries binary, kth binary"
HITS = "query_row bigint, query_id bigint, vec_id bigint, score bigint"


def whole_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, embedding) to (vec_id, vector of floor(64 * x)); rows without an id or a finite vector are left out."""
    for batch in batches:
        ids, found = [], []
        for key, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
            values = vector.values
            if key is None or values is None or values.null_count:
                continue
            x = np.floor(np.asarray(values.to_numpy(zero_copy_only=False), dtype=np.float64) * SCALE)
            if np.isfinite(x).all():
                ids.append(key)
                found.append(x.astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["vec_id", "vector"])


def products(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers; through floating point where every partial sum is exact in it."""
    if points.size and queries.size and float(np.abs(points).max()) * float(np.abs(queries).max()) * points.shape[1] < 2**53:
        return (queries.astype(np.float64) @ points.T.astype(np.float64)).astype(np.int64)
    return queries @ points.T


def grow(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order of the points, low corners, high corners, nodes as (first, last, left child, right child); -1: leaf)."""
    order = np.arange(len(points))
    lows, highs, nodes = [], [], []

    def add(first: int, last: int) -> int:
        own = points[order[first:last]]
        lows.append(own.min(axis=0))
        highs.append(own.max(axis=0))
        nodes.append([first, last, -1, -1])
        return len(nodes) - 1

    open_nodes = [add(0, len(points))] if len(points) else []
    while open_nodes:
        at = open_nodes.pop()
        first, last = nodes[at][:2]
        width = highs[at] - lows[at]
        if last - first <= LEAF or not width.any():
            continue
        middle = (last - first) // 2
        own = order[first:last]
        order[first:last] = own[np.argpartition(points[own, int(width.argmax())], middle)]
        nodes[at][2], nodes[at][3] = add(first, first + middle), add(first + middle, last)
        open_nodes += nodes[at][2:]
    return order, np.array(lows), np.array(highs), np.array(nodes, dtype=np.int64).reshape(-1, 4)


def traverse(bounds: np.ndarray, nodes: np.ndarray, scores, ids: np.ndarray, rows: np.ndarray, own: int, kth: int | None, k: int) -> tuple[list, int | None]:
    """One query: its hits [(score, -id)] of at least ``kth`` in a tree, but for its own row, and the kth score then known."""
    best: list[tuple[int, int]] = []
    waiting = [(-int(bounds[0]), 0)] if len(nodes) else []
    while waiting:
        bound, at = heapq.heappop(waiting)
        if kth is not None and -bound < kth:
            break
        first, last, left, right = nodes[at]
        if left >= 0:
            heapq.heappush(waiting, (-int(bounds[left]), int(left)))
            heapq.heappush(waiting, (-int(bounds[right]), int(right)))
            continue
        s, i = scores(first, last), ids[first:last]
        good = rows[first:last] != own if kth is None else (rows[first:last] != own) & (s >= kth)
        best += zip(s[good].tolist(), (-i[good]).tolist())
        if len(best) > k:
            best = heapq.nlargest(k, best)
        if len(best) == k:
            low = min(best)[0]
            kth = low if kth is None else max(kth, low)
    return best, kth


def reach(queries: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """The best product each query can have with a vector in each box."""
    return products(np.maximum(queries, 0), highs) + products(np.minimum(queries, 0), lows)


def search(ids, rows, points, lows, highs, nodes, asked, queries, kth, k) -> tuple[np.ndarray, list]:
    """A block of queries, ``asked`` being their (row, id), against one tree: hits (query row, query id, id, score) and the
    new kth scores."""
    hits, new = [], []
    if len(nodes):
        bounds = reach(queries, lows, highs)
        for n, (own, query_id) in enumerate(asked.tolist()):
            q = queries[n : n + 1]
            best, low = traverse(bounds[n], nodes, lambda a, b: products(q, points[a:b])[0], ids, rows, own, kth[n], k)
            hits += [(own, query_id, -i, s) for s, i in best]
            new.append(low)
    else:
        new = list(kth)
    return np.array(hits, dtype=np.int64).reshape(-1, 4), new


def _build(frame: pd.DataFrame, k: int, every: int, dims: int) -> pd.DataFrame:
    ids, rows = frame["vec_id"].to_numpy(np.int64), frame["row"].to_numpy(np.int64)
    points = np.zeros((len(ids), dims), dtype=np.int64)
    for n, vector in enumerate(frame["vector"]):
        points[n, : len(vector)] = vector
    by_id = np.lexsort((rows, ids))
    ids, rows, points = ids[by_id], rows[by_id], points[by_id]
    of_query = ids % every == 0
    asked, queries = np.stack([rows[of_query], ids[of_query]], axis=1), points[of_query]
    # Of equal vectors only the k + 1 rows with the smallest ids can ever be among a query's k best.
    if dims and len(points):
        _, group = np.unique(points, axis=0, return_inverse=True)
        group = group.ravel()
        sorted_at = np.argsort(group, kind="stable")
        first = np.r_[True, np.diff(group[sorted_at]) != 0]
        rank = np.arange(len(ids)) - np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))
        keep = np.sort(sorted_at[rank <= k])
        ids, rows, points = ids[keep], rows[keep], points[keep]
    order, lows, highs, nodes = grow(points)
    ids, rows, points = ids[order], rows[order], points[order]
    hits, kth = search(ids, rows, points, lows, highs, nodes, asked, queries, [None] * len(asked), k)
    raw = [x.astype(np.int64).tobytes() for x in (ids, rows, points, lows, highs, nodes, asked, queries, _known(kth), hits)]
    return pd.DataFrame([[int(frame["shard"].iloc[0]), *raw]], columns=_names(TREE))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _known(kth: list) -> np.ndarray:
    return np.array([[low is not None, low or 0] for low in kth], dtype=np.int64).reshape(-1, 2)


def _kth(known: np.ndarray) -> list:
    return [int(low) if has else None for has, low in known.tolist()]


def _array(raw, *shape) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.int64).reshape(*shape)


def _hits(hits: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(hits[:, c])) for c in range(4)], names=_names(HITS))


def _own_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for raw in batch.column("found"):
            yield _hits(_array(raw.as_py(), -1, 4))


def _send(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """A shard's queries and a block of root boxes to the queries that go on, for each shard whose box they reach."""
    for batch in batches:
        for row in batch.to_pylist():
            asked, known = _array(row["asked"], -1, 2), _array(row["kth"], -1, 2)
            queries = _array(row["queries"], len(asked), dims)
            corners = [(s, np.frombuffer(b["low"], dtype=np.int64), np.frombuffer(b["high"], dtype=np.int64)) for b in row["boxes"] for s in [b["shard"]] if s != row["home"]]
            if not corners or not len(asked):
                continue
            bounds = reach(queries, np.stack([c[1] for c in corners]), np.stack([c[2] for c in corners]))
            goes = (known[:, :1] == 0) | (bounds >= known[:, 1:])
            for n, (shard, _, _) in enumerate(corners):
                at = np.flatnonzero(goes[:, n])
                for first in range(0, len(at), TOGETHER):
                    own = at[first : first + TOGETHER]
                    raw = [np.ascontiguousarray(x[own]).tobytes() for x in (asked, queries, known)]
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), *[pa.array([r], pa.binary()) for r in raw]], names=_names(ASKS))


def _other_hits(batches: Iterator[pa.RecordBatch], k: int, dims: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, the tree before the queries that ask it."""
    tree = None
    for batch in batches:
        for number in range(batch.num_rows):
            row = {name: batch.column(name)[number].as_py() for name in batch.schema.names}
            if row["kind"] == 0:
                nodes = _array(row["nodes"], -1, 4)
                boxes = [_array(row[c], len(nodes), dims) for c in ("lows", "highs")]
                ids = _array(row["ids"], -1)
                tree = (ids, _array(row["rows"], -1), _array(row["points"], len(ids), dims), *boxes, nodes)
                continue
            asked = _array(row["asked"], -1, 2)
            hits, _ = search(*tree, asked, _array(row["queries"], len(asked), dims), _kth(_array(row["kth"], -1, 2)), k)
            yield _hits(hits)


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, shard_rows: int = SHARD) -> DataFrame:
    """The k highest products of each query, ties to the smaller id: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and embedding (array of numbers); queries are the rows whose vec_id is divisible by ``every``,
    candidates all rows but the query's own. Rows that share a vec_id are queries and candidates of their own each, so a
    query_id may have several lists, and one may hold its own id. Rows without a vec_id, without a vector or with a null,
    infinite or NaN component take no part. Shorter vectors count as filled up with zeros, so an empty vector has product 0 with all.
    A lone row has no result; an empty table gives an empty result. Products must fit 64 bits. Other columns are not read.
    """
    spark = vectors.sparkSession
    whole = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").mapInArrow(whole_vectors, "vec_id bigint, vector array<bigint>")
    single = kept(whole.withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = single.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dims")).first()
    if not size["n"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dims, shards = size["dims"], -(-size["n"] // shard_rows)
    dealt = single.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    trees = kept(dealt.groupBy("shard").applyInPandas(lambda frame: _build(frame, k, every, dims), TREE), "trees")
    hits = trees.select("found").mapInArrow(_own_hits, HITS)
    if shards > 1:
        corner = F.struct("shard", F.expr(f"substring(lows, 1, {8 * dims})").alias("low"), F.expr(f"substring(highs, 1, {8 * dims})").alias("high"))
        boxes = trees.select(F.floor(F.col("shard") / BOXES).cast("int").alias("block"), corner.alias("box"))
        boxes = boxes.groupBy("block").agg(F.collect_list("box").alias("boxes"))  # BOXES of them at most
        blocks = F.explode(F.sequence(F.lit(0), F.lit((shards - 1) // BOXES))).alias("block")
        asking = trees.select(F.col("shard").alias("home"), "asked", "queries", "kth", blocks).join(boxes, "block")
        asks = asking.mapInArrow(lambda it: _send(it, dims), ASKS).withColumn("kind", F.lit(1))
        sent = trees.select("shard", "ids", "rows", "points", "lows", "highs", "nodes", F.lit(0).alias("kind"))
        met = sent.unionByName(asks, allowMissingColumns=True).repartitionById(shards, "shard").sortWithinPartitions("shard", "kind")
        hits = hits.unionByName(met.mapInArrow(lambda it: _other_hits(it, k, dims), HITS))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best of every 20th vector against all others."""
    return nearest(table(spark, folder, "embeddings"))


ORACLE = """
    WITH whole AS (SELECT row_number() OVER () AS row, vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
               FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND c.row <> q.row),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""
