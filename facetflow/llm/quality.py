"""Quality classifier: random Fourier features, ridge, isotonic calibration.

Statistics of a text are standardised and mapped to random cosines, whose inner
products approximate a Gaussian kernel. Each partition sums its share of the
normal equations; the sums give the ridge weights. Scores are then calibrated by
isotonic regression over a histogram of bounded resolution.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetflow.session import write_out

FEATURES = 192
WIDTH = 3.0
RIDGE = 1e-3
#: Steps of a raw score in the calibration histogram.
STEPS = 2000
#: Rows whose statistics are held at once.
_SLICE = 1024
_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
_SIGNS = [ord(c) for c in ".,!?|#$%&*:;-'\"/\\<>()[]{}=+~^`_@"]


def statistics(text: str | None) -> list[float]:
    """What the classifier sees of a text; all zero for an empty one."""
    raw = (text or "").encode()
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n, nw, nl = max(len(raw), 1), max(len(words), 1), max(len(lines), 1)
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    letters = max(count[_UPPER].sum() + count[_LOWER].sum(), 1)
    repeated = 1 - len(set(words)) / nw if words else 0.0
    signs = count[_SIGNS] / nw
    return [
        np.log1p(len(words)),
        np.log1p(len(lines)),
        lengths.mean(),
        lengths.std(),
        repeated,
        1 - len(set(lines)) / nl if lines else 0.0,
        len(words) / nl / 50,
        count[_UPPER].sum() / letters,
        count[_DIGIT].sum() / n,
        count[128:].sum() / n,
        (count[9] + count[32]) / n,
        *np.log1p(signs[:5]).tolist(),
        np.log1p(signs[5:10].sum()),
        np.log1p(signs[10:].sum()),
        (lengths <= 2).mean() if words else 0.0,
        (lengths >= 12).mean() if words else 0.0,
    ]


SIZE = len(statistics("one"))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # raw scores, increasing
    levels: np.ndarray  # their calibrated scores, never decreasing

    def cosines(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.directions + self.phases
        return np.concatenate([np.cos(z) * np.sqrt(2 / len(self.phases)), np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.cosines(x) @ self.weights, -1, 2)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.steps, self.levels)


def with_statistics(docs: DataFrame, keep: Column, text_col: str) -> DataFrame:
    """``kept`` (any column) and ``x`` (the statistics) of every row."""
    rows = docs.select(keep.alias("kept"), F.col(text_col).cast("string").alias("body"))
    schema = T.StructType([rows.schema["kept"], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["kept", "x"])

    return rows.mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE)


def _equations(model: Model):
    """Cells (i, j, value) of a partition's share of the normal equations; the last column is the label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            z = model.cosines(_matrix(batch.column(0)))
            z = np.concatenate([z, batch.column(1).to_numpy(zero_copy_only=False)[:, None]], axis=1)
            total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    return run


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest never decreasing sequence: neighbours in the wrong order are pooled."""
    pools: list[list[float]] = []
    for v, w in zip(values, weights):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            (a, m, k), (b, n, l) = pools[-2:]
            pools[-2:] = [[(a * m + b * n) / (m + n), m + n, k + l]]
    return np.concatenate([np.full(int(k), v) for v, _, k in pools])


def fit(rows: DataFrame, features: int = FEATURES, width: float = WIDTH, ridge: float = RIDGE, seed: int = 7) -> Model | None:
    """A model from rows with ``x`` and ``y`` (0 or 1, null rows are left out); None without any."""
    rows = rows.select("x", F.col("y").cast("double").alias("y")).where("y in (0, 1)")
    sums = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("i").collect()
    if not sums:
        return None
    random = np.random.default_rng(seed)
    scale = np.array([r.s if r.s and r.s > 1e-9 else 1.0 for r in sums])
    directions = random.standard_normal((SIZE, features)) / width
    none = np.zeros(0)
    model = Model(np.array([r.m for r in sums]), scale, directions, random.uniform(0, 2 * np.pi, features), none, none, none)
    cells = rows.mapInArrow(_equations(model), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    normal = np.zeros((features + 2, features + 2))
    for c in cells:
        normal[c.i, c.j] = normal[c.j, c.i] = c.v
    n = normal[features, features]
    left = normal[:-1, :-1] + ridge * n * np.diag([*np.ones(features), 0.0])
    weights = np.linalg.solve(left, normal[:-1, -1])
    model = Model(model.mean, scale, directions, model.phases, weights, none, none)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = np.round(model.raw(_matrix(batch.column(0))) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column(1)], names=["step", "y"])

    counted = rows.mapInArrow(steps, "step long, y double").groupBy("step").agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("step").collect()
    levels = isotonic(np.array([r.y for r in counted]), np.array([float(r.n) for r in counted]))
    raw = np.array([r.step / STEPS for r in counted])
    # A small share of the raw score keeps the order inside a pool.
    return Model(model.mean, scale, directions, model.phases, weights, raw, 0.998 * levels + 0.001 * np.clip(raw, 0, 1) + 0.0005)


def scored(rows: DataFrame, model: Model | None) -> DataFrame:
    """``kept`` and ``score`` of rows with ``kept`` and ``x``; 0.5 without a model."""
    schema = T.StructType([rows.schema["kept"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column(1))) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["kept", "score"])

    return rows.select("kept", "x").mapInArrow(run, schema)


def held_out(key: Column) -> Column:
    """A third of the ids, by their checksum; a null id is never held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[Model | None, DataFrame]:
    """The model, and ``kept`` (the id) with ``x`` of every row, written once.

    Only labelled rows that aren't held out are learnt from. A row counts as
    often as it is labelled; labels other than 0 and 1 are passed over.
    """
    rows = write_out(with_statistics(docs, F.col(id_col), text_col), "statistics")
    known = labels.select(F.col(id_col).alias("kept"), F.col(label_col).alias("y")).where(~held_out(F.col(id_col)))
    return fit(rows.join(known, "kept")), rows


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """One row per row of ``docs``: the id, ``held_out``, ``score`` and ``predicted``.

    The score depends on the text alone and lies between 0 and 1, higher where
    label 1 is likelier; null and empty texts are scored like any other (all
    statistics zero). Without any label every score is 0.5. Null ids stay null
    and are not held out; other columns are not read.
    """
    model, rows = train(docs, labels, id_col, text_col, label_col)
    out = scored(rows, model).withColumnRenamed("kept", id_col)
    return out.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns.

    Each row goes to Python and back once; a task holds a batch of rows and the
    statistics of ``_SLICE`` of them.
    """
    model, _ = train(docs, labels, id_col, text_col, label_col)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                rows = batch.slice(start, _SLICE)
                x = np.array([statistics(t.as_py()) for t in rows.column(at).cast(pa.string())])
                good = model.score(x) >= 0.5 if model else np.ones(len(x), dtype=bool)
                yield rows.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
