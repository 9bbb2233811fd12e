"""Nearest neighbours by shifted space-filling curves.

Vectors are projected several times at random, shifted, and ordered along a
Hilbert curve by a range partitioning of Spark's. Rows that stand near a query on
one of the curves are merged and reranked, which gives every query a score its
k-th neighbour must reach. The first curve's order is then walked in tiles: a tile
whose centre and radius rule such a score out is left, the others are searched, in
blocks of queries. So the windows widen until nothing better can be left, and the
result is exact; how much is walked depends on how clustered the vectors are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetflow.session import scratch_path, write_out

CURVES = 3
DIMENSIONS = 8
BITS = 7
WINDOW = 128
TILE = 1024
#: Queries that are broadcast at a time.
BLOCK = 8192
_PAIRS = 1 << 19
_SLACK = 1e-9


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``x`` (integers of ``bits`` bits)."""
    x = x.astype(np.int64).copy()
    d = x.shape[1]
    for b in range(bits - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i in range(d):
            high = (x[:, i] & q) != 0
            x[:, 0] ^= np.where(high, p, 0)
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= swap
            x[:, i] ^= swap
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        t ^= np.where(x[:, d - 1] & (1 << b), (1 << b) - 1, 0)
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[:, i] >> b & 1)
    return key


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _keyed(rows: DataFrame, size: int, seed: int) -> DataFrame:
    """Each row once per curve, with its place on it."""
    random = np.random.default_rng(seed)
    axes = random.standard_normal((CURVES, size, DIMENSIONS))
    shifts = random.uniform(0, 1, (CURVES, DIMENSIONS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _vectors(batch.column(1))
            unit = v / np.abs(v).max(axis=1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            for curve in range(CURVES):
                # A direction's projections lie within 3 with few exceptions; those go to the edge.
                place = (unit @ axes[curve] / 6 + 0.5) * (1 << (BITS - 1)) + shifts[curve] * (1 << (BITS - 1))
                key = hilbert(np.clip(place, 0, (1 << BITS) - 1).astype(np.int64), BITS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(v), curve, np.int32)), pa.array(key), *batch.columns], names=["curve", "key", "id", "v", "query"]
                )

    return rows.mapInArrow(run, f"curve int, key long, id {dict(rows.dtypes)['id']}, v array<double>, query boolean")


def _inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up component by component."""
    return np.add.reduce(np.ascontiguousarray((a * b).T), axis=0)


def _best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of each query's ``k`` best pairs, ties to the smaller id."""
    order = np.lexsort((ids, -score, q))
    first = np.searchsorted(q[order], q[order], "left")
    return order[np.arange(len(order)) - first < k]


def _windows(k: int):
    """Pairs of each query with the best of the rows around it in the order given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = v = asks = None
        done = 0  # rows at the front that have been asked

        def answers(until: int):
            at = done + np.flatnonzero(asks[done:until])
            for part in np.array_split(at, -(-len(at) // 256)) if len(at) else []:
                near = part[:, None] + np.arange(-WINDOW, WINDOW + 1)[None, :]
                real = (near >= 0) & (near < len(ids))
                i, j = np.nonzero(real)
                a, b = part[i], near[real]
                other = ids[a] != ids[b]
                a, b = a[other], b[other]
                score = _inner(v[a], v[b])
                best = _best(a, ids[b], score, k)
                yield pa.RecordBatch.from_arrays([pa.array(ids[a[best]]), pa.array(ids[b[best]]), pa.array(score[best])], names=["q", "id", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = batch.column(0).to_numpy(zero_copy_only=False), _vectors(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False)
            ids, v, asks = new if ids is None else (np.concatenate([x, y]) for x, y in zip((ids, v, asks), new))
            until = max(done, len(ids) - WINDOW)
            yield from answers(until)
            cut = max(0, until - WINDOW)
            ids, v, asks, done = ids[cut:], v[cut:], asks[cut:], until - cut
        if ids is not None:
            yield from answers(len(ids))

    return run


def _walk(sent, k: int):
    """Pairs of the broadcast queries with their best rows among this task's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        q_ids, q_v, least = np.array([r[0] for r in block]), np.array([r[1] for r in block]), np.array([r[2] for r in block])
        q_norm = np.linalg.norm(q_v, axis=1)
        held: list[tuple] = []
        pending = 0

        def reduce():
            nonlocal held, pending
            q, ids, score = (np.concatenate(x) for x in zip(*held))
            best = _best(q, ids, score, k)
            q, ids, score = q[best], ids[best], score[best]
            count = np.bincount(q, minlength=len(q_ids))
            last = np.cumsum(count) - 1
            full = count == k
            least[full] = np.maximum(least[full], score[last[full]])
            held, pending = [(q, ids, score)], 0

        for batch in batches:
            if not batch.num_rows:
                continue
            all_ids, all_v = batch.column(0).to_numpy(zero_copy_only=False), _vectors(batch.column(1))
            for at in range(0, len(all_ids), TILE):
                ids, v = all_ids[at : at + TILE], all_v[at : at + TILE]
                centre = v.mean(axis=0)
                radius = np.linalg.norm(v - centre, axis=1).max()
                slack = _SLACK * (1 + q_norm * np.linalg.norm(v, axis=1).max())
                asked = np.flatnonzero(q_v @ centre + q_norm * radius >= least - slack)
                for part in np.array_split(asked, -(-len(asked) // 1024)) if len(asked) else []:
                    i, j = np.nonzero(q_v[part] @ v.T >= (least[part] - slack[part])[:, None])
                    q = part[i]
                    other = q_ids[q] != ids[j]
                    q, j = q[other], j[other]
                    held.append((q, ids[j], _inner(q_v[q], v[j])))
                    pending += len(q)
                    if pending > _PAIRS:
                        reduce()
        if held:
            reduce()
            q, ids, score = held[0]
            for at in range(0, len(q), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[at : at + 50_000]) for x in (q_ids[q], ids, score)], names=["q", "id", "score"]
                )

    return run


def _top(pairs: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def usable(rows: DataFrame, id_col: str, vector_col: str, query: Column) -> tuple[DataFrame, int]:
    """``id, v, query`` of the vectors that take part, and their length."""
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), query.alias("query"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("id is not null and v is not null").where(~bad & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = sizes["size"] if sizes else 0
    one = rows.where(F.size("v") == size).groupBy("id").agg(F.min("v").alias("v"), F.max("query").alias("query"))
    return one.select("id", "v", F.coalesce("query", F.lit(False)).alias("query")), size


def search(
    rows: DataFrame, query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 11
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query row's ``k`` rows of largest inner product.

    ``query`` marks the query rows; every other row is a candidate. Ranks count
    from 1, ties go to the smaller id. Vectors that are null or zero, hold a null
    or a value that isn't finite, or have another length than most, take no part;
    nor do rows without an id. Rows that share an id are one, with the smallest of
    their vectors, and a query if one of them is. Fewer candidates than ``k``
    are all returned; empty input gives no rows; other columns are not read.
    """
    spark = rows.sparkSession
    points, size = usable(rows, id_col, vector_col, query)
    if not size:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ordered = _keyed(points, size, seed).repartitionByRange("curve", "key", "id").sortWithinPartitions("curve", "key", "id")
    curves = write_out(ordered, "curves")
    pairs = curves.select("id", "v", "query").mapInArrow(_windows(k), "q long, id long, score double")
    near = write_out(_top(pairs.distinct(), k).select("q", "id", "score"), "windows")

    first = curves.where("curve = 0")
    reached = near.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("score"))
    asked = first.where("query").join(reached, F.col("id") == F.col("q"), "left")
    asked = asked.select("id", "v", F.when(F.col("n") >= k, F.col("score")).otherwise(float("-inf")).alias("least"))
    path, blocks = scratch_path(spark, "neighbours"), -(-first.where("query").count() // BLOCK)
    for b in range(blocks):
        block = [tuple(r) for r in asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()]
        sent = spark.sparkContext.broadcast(block)
        if block:
            first.select("id", "v").mapInArrow(_walk(sent, k), "q long, id long, score double").write.mode("append").parquet(path)
        sent.unpersist()
    walked = spark.read.schema("q long, id long, score double").parquet(path) if blocks else near
    out = _top(near.union(walked).distinct(), k)
    return out.select(F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
