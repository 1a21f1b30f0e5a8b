"""Approximate nearest neighbours by multiprobe p-stable hashing (operator 10).

Vectors are scaled by the largest norm and given one more component that makes them unit
vectors, so the largest inner product is the nearest point. Each of ``TABLES`` tables hashes a
point by ``m`` Gaussian projections, cut at multiples of ``WIDTH`` into four levels each. A
query visits the buckets of all tables in the order of their estimated success: the
probability that a near point's projections, which lie around the query's own, fall into the
bucket's levels. It stops at a total probability that was fitted, on ``FIT_ON`` queries compared with
every row, so that their true neighbours are found at a rate of ``RECALL``. Candidates are
ranked by exact inner products. Buckets of any size are worked on in blocks of bounded size,
so no bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import discard, stage
from tradewind.llm.vectors import matrix, sound

TABLES, WIDTH, LEVELS = 2, 1.0, 4
FIT_ON, RECALL = 64, 0.97
# Rows and queries of a bucket that one task compares at a time.
BLOCK = 4096


def _projections(n_rows: int, size: int) -> np.ndarray:
    """Tables x m x size; m grows with the logarithm of the table."""
    m = 3
    while n_rows > 2_000_000 and m < 8:
        n_rows //= LEVELS
        m += 1
    return np.random.default_rng(20).standard_normal((TABLES, m, size))


def _lifted(x: np.ndarray, top: float) -> np.ndarray:
    x = x / top
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))
    return np.hstack([x, rest[:, None]])


def _cells(points: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Bucket of each point in each table (points x tables)."""
    levels = np.clip(np.floor(np.einsum("tmd,nd->ntm", a, points) / WIDTH) + LEVELS // 2, 0, LEVELS - 1)
    return (levels @ (LEVELS ** np.arange(a.shape[1]))).astype(np.int64)


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    """Logistic form of the normal distribution function, good to 0.0002."""
    return 1.0 / (1.0 + np.exp(-np.clip(1.5976 * x + 0.07056 * x**3, -50, 50)))


def _success(queries: np.ndarray, a: np.ndarray, near: float) -> np.ndarray:
    """Queries x tables x buckets: the chance that a point at cosine ``near`` lies in the bucket."""
    mean = near * np.einsum("tmd,nd->ntm", a, queries)
    edges = WIDTH * (np.arange(1, LEVELS) - LEVELS // 2)
    below = _normal_cdf((edges - mean[..., None]) / np.sqrt(max(1e-6, 1 - near * near)))
    ends = np.zeros((*below.shape[:-1], 1))
    level = np.diff(np.concatenate([ends, below, ends + 1], axis=-1), axis=-1)
    out = np.ones((*level.shape[:2], 1))
    for k in range(level.shape[2]):
        # The first projection varies fastest in the bucket number.
        out = (level[:, :, k, :, None] * out[:, :, None, :]).reshape(*out.shape[:2], -1)
    return out


def _visits(success: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all tables in the order of success, and the chance to have found a near point
    before each is visited."""
    n, tables, cells = success.shape
    flat = success.reshape(n, -1)
    order = np.argsort(-flat, axis=1, kind="stable")
    sorted_ = np.take_along_axis(flat, order, axis=1)
    missed = np.ones((n, flat.shape[1]))
    for t in range(tables):
        own = np.where(order // cells == t, sorted_, 0.0)
        missed *= np.clip(1.0 - (np.cumsum(own, axis=1) - own), 0.0, 1.0)
    return order, 1.0 - missed


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (x * q).sum(axis=1)


def _nearest(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int):
    """(query_id, vec_id, score) of the k rows nearest each query, ties to the smaller id."""
    if not len(ids) or not len(query_ids):
        return
    rough = q @ x.T
    for row, query in enumerate(query_ids.tolist()):
        some = np.arange(len(ids))
        if len(ids) > k + 1:
            cut = np.partition(rough[row], len(ids) - k - 1)[len(ids) - k - 1]
            some = np.flatnonzero(rough[row] >= cut - 1e-9 * (1 + abs(cut)))
        some = some[ids[some] != query]
        score = _exact(x[some], q[row])
        best = np.lexsort((ids[some], -score))[:k]
        yield np.full(len(best), query), ids[some][best], score[best]


_HIT = "query_id long, vec_id long, score double"


def _hits(found: list) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
    return pa.table({"query_id": columns[0], "vec_id": columns[1], "score": columns[2]})


def _fit(rows: DataFrame, queries: DataFrame, top: float, k: int) -> tuple[np.ndarray, float, float]:
    """Projections, the cosine of near points, and the chance to stop at."""
    sample = queries.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(FIT_ON).select("vec_id", "x").toArrow()
    query_ids, q = sample.column("vec_id").to_numpy(), matrix(sample.column("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, BLOCK):
                part = batch.slice(s, BLOCK)
                ids, x = part.column("vec_id").to_numpy(), matrix(part.column("x"))
                found = list(_nearest(ids, x, query_ids, q, k))
                yield from _hits(found).to_batches()

    true = _top(rows.select("vec_id", "x").mapInArrow(run, _HIT), k).join(
        rows.select("vec_id", "x"), "vec_id"
    ).select("query_id", "x").toArrow()
    a = _projections(rows.count(), q.shape[1] + 1)
    unit = np.hstack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros((len(q), 1))])
    if not true.num_rows:
        return a, 0.5, 1.0
    points = _lifted(matrix(true.column("x")), top)
    owner = np.searchsorted(np.sort(query_ids), true.column("query_id").to_numpy())
    owner = np.argsort(query_ids)[owner]
    near = float(np.clip((points * unit[owner]).sum(axis=1).mean(), 0.05, 0.95))
    order, before = _visits(_success(unit, a, near))
    cells = _cells(points, a)
    size = order.shape[1] // TABLES
    rank = np.argsort(order, axis=1)
    needed = np.min([before[owner, rank[owner, t * size + cells[:, t]]] for t in range(TABLES)], axis=0)
    return a, near, float(np.quantile(needed, RECALL, method="higher"))


def _top(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` rows of largest inner product found for each
    row whose vec_id is divisible by ``every``, itself left out, ties to the smaller id.

    Rows that ``vectors.sound`` rejects take no part, nor do vectors shorter than the longest.
    Rows that repeat an id and vector count once. An empty table gives an empty result.
    """
    whole = sound(embeddings).withColumn("size", F.size("x")).drop("norm").distinct()
    staged = stage(whole)
    longest = staged.agg(F.max("size")).first()[0]
    rows = staged.where(F.col("size") == (longest or 0))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
    top = rows.agg(F.max(norm)).first()[0]
    if top is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = rows.where(F.col("vec_id") % every == 0)
    a, near, stop = _fit(rows, queries, top, k)
    cells = LEVELS ** a.shape[1]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, BLOCK):
                part = batch.slice(s, BLOCK)
                bucket = _cells(_lifted(matrix(part.column("x")), top), a) + np.arange(TABLES) * cells
                for t in range(TABLES):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket[:, t], pa.int32()), part.column("vec_id"), part.column("x")],
                        ["bucket", "vec_id", "x"],
                    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                q = matrix(part.column("x"))
                unit = np.hstack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros((len(q), 1))])
                order, before = _visits(_success(unit, a, near))
                row, turn = np.nonzero(before <= stop)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(order[row, turn], pa.int32()), part.column("vec_id").take(pa.array(row)),
                     part.column("x").take(pa.array(row))],
                    ["bucket", "vec_id", "x"],
                )

    kind = "bucket int, vec_id long, x array<double>"
    points = rows.select("vec_id", "x").mapInArrow(index, kind)
    probes = queries.select("vec_id", "x").mapInArrow(probe, kind)
    # Blocks of each bucket: one row per bucket, at most TABLES * LEVELS ** m of them.
    sizes = points.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("rows")).join(
        probes.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("queries")), "bucket"
    )
    sizes = F.broadcast(stage(sizes))

    def dealt(frame: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one block of its side, with every block of the other side."""
        mine = F.pmod(F.xxhash64("vec_id", F.lit(own)), F.col(own)).cast("int")
        return frame.join(sizes, "bucket").select(
            "bucket", mine.alias(f"{own}_block"),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"{other}_block"), "vec_id", "x",
        )

    keys = ["bucket", "rows_block", "queries_block"]

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        return _hits(list(_nearest(
            left.column("vec_id").to_numpy(), matrix(left.column("x")),
            right.column("vec_id").to_numpy(), matrix(right.column("x")), k,
        )))

    hits = dealt(points, "rows", "queries").groupBy(*keys).cogroup(
        dealt(probes, "queries", "rows").groupBy(*keys)
    ).applyInArrow(rank, _HIT)
    out = stage(_top(hits, k).select("query_id", "rank", "vec_id", "score"))
    discard(staged)
    return out
