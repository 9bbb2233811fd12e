"""A price model that never falls as weight rises.

Ridge least squares on log price. The weight enters through ramps between fixed
edges and its logarithm, all with coefficients that may not be negative; the
grades enter as indicators, the other measures as values with an indicator for
gaps. Everything needed to fit any training split is a sum over rows, so one
pass that adds up cross products per fold and period serves every fold, the time
holdout and the final fit: a training split is the total minus its test part.

The sums are kept as the cells that are not zero. Spark adds them up from the
terms a row has, numbers and one level of every grade, so neither a row nor a
sum is ever as wide as the levels.
"""

from __future__ import annotations

import itertools
import json
import zlib
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetflow.functions.features import CATEGORICAL, NUMERIC, or_missing

# Edges of the weight ramps; beyond the last one the logarithm
# alone carries on.
RAMP_EDGES = [0.0, 0.25, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 5.0, 8.0, 12.0, 20.0, 30.0]
RIDGE = 1e-4
MEASURES = [c for c in NUMERIC if c != "carat"]


def _looked_up(values: list[str], start: int, key: Column) -> Column:
    """``start`` plus the place of ``key`` in ``values``, by a small table per checksum."""
    slots = max(1, len(values) // 4)
    names: list[list[str]] = [[] for _ in range(slots)]
    places: list[list[int]] = [[] for _ in range(slots)]
    for k, value in enumerate(values):
        slot = zlib.crc32(value.encode()) % slots
        names[slot].append(value)
        places[slot].append(start + k)
    own = (F.crc32(key.cast("binary")) % slots).cast("int")
    found = F.array_position(F.get(F.from_json(F.lit(json.dumps(names)), "array<array<string>>"), own), key)
    return F.get(F.get(F.from_json(F.lit(json.dumps(places)), "array<array<int>>"), own), found.cast("int") - 1)


@dataclass(frozen=True)
class Design:
    """The versioned feature contract: levels of every grade and column order."""

    levels: dict[str, list[str]]
    edges: list[float] = field(default_factory=lambda: list(RAMP_EDGES))

    @cached_property
    def columns(self) -> list[str]:
        names = ["intercept"]
        for grade in CATEGORICAL:
            names += [f"{grade}={level}" for level in self.levels[grade]]
        for measure in MEASURES:
            names += [measure, f"{measure}_missing"]
        names += [f"carat_ramp_{a}_{b}" for a, b in self.ramps] + ["carat_ln"]
        return names

    @property
    def ramps(self) -> list[tuple[float, float]]:
        return list(zip(self.edges[:-1], self.edges[1:]))

    @cached_property
    def monotone(self) -> list[bool]:
        """Which coefficients may not be negative: the weight terms."""
        return [name.startswith("carat_") for name in self.columns]

    def offset(self, grade: str) -> int:
        before = CATEGORICAL[: CATEGORICAL.index(grade)]
        return 1 + sum(len(self.levels[g]) for g in before)

    @cached_property
    def widest(self) -> tuple[int, int]:
        """Where the columns of the grade with the most levels start and end."""
        grade = max(CATEGORICAL, key=lambda g: len(self.levels[g]))
        return self.offset(grade), self.offset(grade) + len(self.levels[grade])

    def codes(self) -> list[Column]:
        """Position of every grade in its levels, 0 for an unknown grade."""
        return [F.coalesce(_looked_up(self.levels[g], 1, or_missing(F.col(g))), F.lit(0)).alias(g) for g in CATEGORICAL]

    def numbers(self) -> list[tuple[str, Column]]:
        """Name and expression of every column after the indicators."""
        carat = F.col("carat")
        out = []
        for measure in MEASURES:
            out.append((measure, F.coalesce(F.col(measure), F.lit(0.0))))
            out.append((f"{measure}_missing", F.col(measure).isNull().cast("double")))
        for a, b in self.ramps:
            rise = (carat - a) / (b - a)
            out.append((f"carat_ramp_{a}_{b}", F.least(F.greatest(rise, F.lit(0.0)), F.lit(1.0))))
        out.append(("carat_ln", F.ln(carat)))
        return out

    def segment(self) -> Column:
        """How many ramps the weight has passed."""
        passed = F.lit(0)
        for edge in self.edges[1:]:
            passed = passed + F.coalesce((F.col("carat") >= edge).cast("int"), F.lit(0))
        return passed

    def rise(self) -> Column:
        """The value of the ramp the weight stands on; zero beyond the last."""
        lefts, widths = [a for a, _ in self.ramps], [b - a for a, b in self.ramps]
        rise = (F.col("carat") - F.get(F.lit(lefts), F.col("_segment"))) / F.get(F.lit(widths), F.col("_segment"))
        on = F.least(F.greatest(rise, F.lit(0.0)), F.lit(1.0))
        return F.when(F.col("_segment") < len(self.ramps), on).otherwise(0.0)

    @cached_property
    def at(self) -> dict[str, int]:
        """Position of every column; ``log_price`` comes after the last."""
        return {name: i for i, name in enumerate([*self.columns, "log_price"])}

    def encode(self, rows: DataFrame) -> DataFrame:
        """Add ``_at_<grade>``, the column of the row's level; null for a level unknown to the design."""
        out = {}
        for grade in CATEGORICAL:
            start = self.offset(grade)
            out[f"_at_{grade}"] = _looked_up(self.levels[grade], start, or_missing(F.col(grade)))
        return rows.withColumns(out)

    def number_terms(self, target: str | None = "log_price") -> list[tuple[int, Column]]:
        """Position and value of the intercept, every number and the target."""
        terms = [(0, F.lit(1.0)), *((self.at[name], value) for name, value in self.numbers())]
        return terms + ([(self.at["log_price"], F.col(target))] if target else [])

    def terms(self, target: str | None = "log_price") -> Column:
        """The terms of an encoded row, as rows ``i, x``."""
        pairs = [x for i, value in self.number_terms(target) for x in (F.lit(i), value.cast("double"))]
        pairs += [x for grade in CATEGORICAL for x in (F.col(f"_at_{grade}"), F.lit(1.0))]
        return F.stack(F.lit(len(pairs) // 2), *pairs).alias("i", "x")


def category_levels(df: DataFrame) -> DataFrame:
    """``feature, level``: every value of every grade, gaps as a value of their own."""
    pairs = F.explode(
        F.array(
            *[F.struct(F.lit(g).alias("feature"), or_missing(F.col(g)).alias("level")) for g in CATEGORICAL]
        )
    )
    return df.select(pairs.alias("_pair")).select("_pair.*").distinct()


def fit_design(rows: DataFrame) -> Design:
    """Freeze the levels of the whole data, so that all splits share one design."""
    levels = category_levels(rows).collect()
    return Design({g: sorted(r["level"] for r in levels if r["feature"] == g) for g in CATEGORICAL})


def cross_products(rows: DataFrame, design: Design, by: list[str]) -> DataFrame:
    """``by, i, j, value``: the cells i <= j of the cross products of all columns and log price that are not zero.

    Every term of a row meets the row's plain numbers, and every pair of its
    levels is counted. Both are plain aggregates: a task passes on one partial
    sum per group and term it has seen. Of the ramps a row has one rise only:
    between two edges the ramps before are one and those behind are zero, so
    sums per segment of the weight hold the sums of all ramps.
    """
    numbers = design.number_terms()
    ramps = [design.at[f"carat_ramp_{a}_{b}"] for a, b in design.ramps]
    rise = -1  # stands for the ramp of the row's segment
    plain = [(i, x) for i, x in numbers if i not in ramps] + [(rise, design.rise())]
    named = {i: f"_x{k}" for k, (i, _) in enumerate(plain)}
    slim = design.encode(rows).withColumn("_segment", design.segment()).withColumns({named[i]: x.cast("double") for i, x in plain})
    pairs = [x for i, _ in plain for x in (F.lit(i), F.col(named[i]))] + [x for g in CATEGORICAL for x in (F.col(f"_at_{g}"), F.lit(1.0))]
    terms = F.stack(F.lit(len(pairs) // 2), *pairs).alias("i", "x")
    each = slim.select(*by, "_segment", *named.values(), terms).where("i is not null and x <> 0")
    sums = each.groupBy(*by, "_segment", "i").agg(*[F.sum(F.col("x") * F.col(n)).alias(n) for n in named.values()])

    segment, one = F.col("_segment"), F.col(named[0])
    sides = {j: F.col(named[j]) for j in named if j != rise}
    for k, j in enumerate(ramps):
        # Times zero, not zero: what is not finite stays so.
        sides[j] = F.when(segment > k, one).when(segment == k, F.col(named[rise])).otherwise(one * 0.0)
    places = F.lit(ramps)
    filled = F.when(F.col("i") == 0, F.concat(F.array(F.lit(0)), F.slice(places, F.lit(1), segment)))
    own = filled.when(F.col("i") == rise, F.array(F.get(places, segment))).otherwise(F.array("i"))
    whole = sums.select(*by, F.explode(own).alias("i"), *[x.alias(f"_s{j}") for j, x in sides.items()])
    whole = whole.groupBy(*by, "i").agg(*[F.sum(f"_s{j}").alias(f"_s{j}") for j in sides])

    first_grade, first_number = 1, numbers[1][0]
    graded = F.col("i").between(first_grade, first_number - 1)
    cells = [x for j in sides for x in (F.lit(j), F.col(f"_s{j}"))]
    # Two levels of one grade never meet: a level meets itself as often as the intercept.
    cells += [F.when(graded, F.col("i")), F.col("_s0")]
    beside = whole.select(*by, "i", F.stack(F.lit(len(cells) // 2), *cells).alias("j", "value"))
    beside = beside.where((F.col("value") != 0) & (graded | (F.col("i") <= F.col("j"))) & F.col("j").isNotNull())
    beside = beside.select(*by, F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "value")
    met = list(itertools.combinations(CATEGORICAL, 2))
    pairs = F.stack(F.lit(len(met)), *[F.col(f"_at_{g}") for pair in met for g in pair]).alias("i", "j")
    met = design.encode(rows).select(*by, pairs).dropna(subset=["i", "j"])
    counted = met.groupBy(*by, "i", "j").agg(F.count("*").cast("double").alias("value"))
    return beside.unionByName(counted)


@dataclass(frozen=True)
class Cells:
    """Symmetric sums as their upper cells that are not zero, in order."""

    width: int
    place: np.ndarray  # i * width + j
    value: np.ndarray

    @staticmethod
    def of_dense(matrix: np.ndarray) -> Cells:
        i, j = np.nonzero(np.triu(matrix))
        return Cells(len(matrix), i * len(matrix) + j, matrix[i, j])

    @staticmethod
    def of(rows, width: int) -> Cells:
        """From ``(i, j, value)``; equal places are added."""
        table = np.array([tuple(r) for r in rows], dtype=float).reshape(-1, 3)
        place, where = np.unique((table[:, 0] * width + table[:, 1]).astype(np.int64), return_inverse=True)
        return Cells(width, place, np.bincount(where, table[:, 2], minlength=len(place)))

    def plus(self, other: Cells, sign: float = 1.0) -> Cells:
        place, where = np.unique(np.concatenate([self.place, other.place]), return_inverse=True)
        return Cells(self.width, place, np.bincount(where, np.concatenate([self.value, sign * other.value]), minlength=len(place)))

    def minus(self, other: Cells) -> Cells:
        return self.plus(other, -1.0)

    def at(self, i: int, j: int) -> float:
        k = np.searchsorted(self.place, i * self.width + j)
        return float(self.value[k]) if k < len(self.place) and self.place[k] == i * self.width + j else 0.0

    @property
    def rows(self) -> float:
        return self.at(0, 0)

    @property
    def both(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column and value of the cells on both sides of the diagonal."""
        i, j = np.divmod(self.place, self.width)
        off = i != j
        return np.concatenate([i, j[off]]), np.concatenate([j, i[off]]), np.concatenate([self.value, self.value[off]])

    def diagonal(self) -> np.ndarray:
        i, j = np.divmod(self.place, self.width)
        out = np.zeros(self.width)
        out[i[i == j]] = self.value[i == j]
        return out

    def row(self, k: int) -> np.ndarray:
        i, j, value = self.both
        out = np.zeros(self.width)
        out[j[i == k]] = value[i == k]
        return out

    def dense(self) -> np.ndarray:
        out = np.zeros((self.width, self.width))
        i, j, value = self.both
        out[i, j] = value
        return out


def collect_cells(table: DataFrame, design: Design) -> Cells:
    """A table without groups on the driver: the cells of one matrix that are not zero."""
    return Cells.of(table.select("i", "j", "value").collect(), len(design.columns) + 1)


def solve(sums: Cells, monotone: list[bool], ridge: float = RIDGE, block: tuple[int, int] = (0, 0), start: np.ndarray | None = None) -> np.ndarray:
    """Ridge coefficients with the marked ones not negative.

    The columns from ``block[0]`` to before ``block[1]`` never meet each other,
    as the levels of one grade; they are solved for by division, so the system
    that is left has all other columns only. ``start`` are coefficients to begin
    from. Columns without any variation in scale get coefficient 0.
    """
    p = len(monotone)
    n = max(sums.rows, 1.0)
    scale = np.sqrt(np.maximum(sums.diagonal()[:p] / n, 0.0))
    live = scale > 1e-12
    safe = np.where(live, scale, 1.0)
    target = sums.row(p)[:p] / n / safe
    inner = np.zeros(p, dtype=bool)
    inner[block[0] : block[1]] = True
    outer = np.flatnonzero(~inner)
    new = np.full(p, -1)
    new[outer] = np.arange(len(outer))
    i, j, value = sums.both
    kept = (i < p) & (j < p)
    i, j, value = i[kept], j[kept], value[kept] / n / (safe[i[kept]] * safe[j[kept]])

    a = np.zeros((len(outer), len(outer)))
    both = ~inner[i] & ~inner[j]
    a[new[i[both]], new[j[both]]] = value[both]
    penalty = np.where(outer == 0, 0.0, ridge)
    a[np.arange(len(outer)), np.arange(len(outer))] += penalty
    b = target[outer]
    across = np.zeros((len(outer), block[1] - block[0]))
    mixed = ~inner[i] & inner[j]
    across[new[i[mixed]], j[mixed] - block[0]] = value[mixed]
    weight = np.where(live[inner], 1.0 / (1.0 + ridge), 0.0)
    a = a - (across * weight) @ across.T
    b = b - across @ (weight * target[inner])

    bound = np.array(monotone, dtype=bool)[outer]
    first = None if start is None else (start * safe)[outer]
    beta = np.zeros(p)
    beta[outer] = _active_set(a, b, bound, live[outer], first)
    beta[inner] = weight * (target[inner] - beta[outer] @ across)
    return np.where(live, beta / safe, 0.0)


def _active_set(a: np.ndarray, b: np.ndarray, bound: np.ndarray, live: np.ndarray, start: np.ndarray | None) -> np.ndarray:
    """Marked columns start at zero (or as in ``start``), enter while the error still falls, and leave when they would turn negative."""
    p = len(b)
    beta = np.zeros(p)
    passive = live & ~bound
    if start is not None:
        passive = live & (~bound | (start > 0))
        beta = np.where(passive & bound, start, 0.0)
    tolerance = 1e-10 * max(1.0, float(np.abs(b).max(initial=0.0)))
    for _ in range(10 * p):
        while True:
            index = np.flatnonzero(passive)
            trial = np.zeros(p)
            trial[index] = np.linalg.solve(a[np.ix_(index, index)], b[index])
            negative = passive & bound & (trial <= 0.0)
            if not negative.any():
                beta = trial
                break
            gap = beta[negative] - trial[negative]
            ratio = np.where(gap > 0, beta[negative] / np.where(gap > 0, gap, 1.0), 0.0)
            step = float(ratio.min())
            beta = beta + step * (trial - beta)
            leaving = negative & (beta <= 1e-14)
            if not leaving.any():
                leaving = negative
            beta[leaving] = 0.0
            passive &= ~leaving
        gain = b - a @ beta
        candidates = live & bound & ~passive & (gain > tolerance)
        if not candidates.any():
            break
        passive[int(np.argmax(np.where(candidates, gain, -np.inf)))] = True
    return beta


def scoring_vector(design: Design, coefficients) -> list[float]:
    """The coefficients laid out for ``linear_prediction``.

    Every grade gets a leading zero for unknown levels, and the ramps become one
    line per segment: its height at the left edge and its slope.
    """
    at = {name: float(c) for name, c in zip(design.columns, coefficients)}
    vector = [at["intercept"]]
    for grade in CATEGORICAL:
        vector += [0.0, *(at[f"{grade}={level}"] for level in design.levels[grade])]
    for measure in MEASURES:
        vector += [at[measure], at[f"{measure}_missing"]]
    vector.append(at["carat_ln"])
    rises = [at[f"carat_ramp_{a}_{b}"] for a, b in design.ramps]
    heights = [0.0, *np.cumsum(rises)]
    slopes = [rise / (b - a) for rise, (a, b) in zip(rises, design.ramps)] + [0.0]
    return vector + [float(h) for h in heights] + slopes


def linear_prediction(design: Design, scoring: Column) -> Column:
    """The model as a built-in expression over an array made by ``scoring_vector``."""

    def at(position):
        return F.get(scoring, position if isinstance(position, Column) else F.lit(position))

    total, next_at = at(0), 1
    for code, grade in zip(design.codes(), CATEGORICAL):
        total = total + at(code + next_at)
        next_at += len(design.levels[grade]) + 1
    for measure in MEASURES:
        value = F.col(measure)
        total = total + F.coalesce(value * at(next_at), at(next_at + 1))
        next_at += 2
    carat = F.col("carat")
    total = total + at(next_at) * F.ln(carat)
    segment = F.lit(0)
    for edge in design.edges[1:]:
        segment = segment + (carat >= edge).cast("int")
    left = F.get(F.lit(design.edges), segment)
    heights, slopes = next_at + 1, next_at + 1 + len(design.edges)
    return total + at(segment + heights) + at(segment + slopes) * (carat - left)


@dataclass(frozen=True)
class Model:
    design: Design
    coefficients: list[float]
    means: list[float]
    rows: int

    def predict(self) -> Column:
        return linear_prediction(self.design, F.lit(scoring_vector(self.design, self.coefficients)))


def fit(sums: Cells, design: Design, ridge: float = RIDGE, start: Model | None = None) -> Model:
    p = len(design.columns)
    begin = None if start is None else np.array(start.coefficients)
    return Model(
        design,
        [float(c) for c in solve(sums, design.monotone, ridge, design.widest, begin)],
        [float(m) for m in sums.row(0)[:p] / max(sums.rows, 1.0)],
        int(round(sums.rows)),
    )


def column_means(rows: DataFrame, design: Design) -> tuple[list[float], int]:
    """The mean of every column over ``rows``, and their number."""
    each = design.encode(rows).select(design.terms(None)).where("i is not null")
    sums = {r["i"]: r["x"] for r in each.groupBy("i").agg(F.sum("x").alias("x")).collect()}
    n = sums.get(0, 0.0)
    return [sums.get(i, 0.0) / max(n, 1.0) for i in range(len(design.columns))], int(n)


def optimality(rows: DataFrame, model: Model, ridge: float = RIDGE, tolerance: float = 1e-7) -> DataFrame:
    """``feature, monotone, not_negative, stationary, complementary`` per column.

    The conditions of the constrained fit, from the rows themselves: the error
    must not fall along any column that is free to move (``stationary``: the
    slope is zero, for a bound column not above zero), and a bound column has no
    slope or no weight (``complementary``).
    """
    design = model.design
    # The error is a column before the terms are made, else it is worked out for every term.
    wide = design.encode(rows).withColumn("_error", F.col("log_price") - model.predict())
    each = wide.select("_error", design.terms(None)).where("i is not null and x <> 0")
    sums = each.groupBy("i").agg(F.sum(F.col("x") * F.col("_error")).alias("slope"), F.sum(F.col("x") * F.col("x")).alias("square"))
    known = [(i, name, bound, c, 0.0 if i == 0 else ridge) for i, (name, bound, c) in enumerate(zip(design.columns, design.monotone, model.coefficients))]
    columns = rows.sparkSession.createDataFrame(known, "i int, feature string, monotone boolean, coefficient double, ridge double")
    n = max(model.rows, 1)
    square = F.coalesce("square", F.lit(0.0)) / n
    slope = F.coalesce("slope", F.lit(0.0)) / n - F.col("ridge") * square * F.col("coefficient")
    judged = columns.join(sums, "i", "left").withColumn("slope", F.coalesce(slope / F.nullif(F.sqrt(square), F.lit(0.0)), F.lit(0.0)))
    still = F.abs("slope") <= tolerance
    bound, weight = F.col("monotone"), F.col("coefficient")
    return judged.select(
        "feature",
        "monotone",
        (~bound | (weight >= 0)).alias("not_negative"),
        F.when(bound & (weight == 0), F.col("slope") <= tolerance).otherwise(still).alias("stationary"),
        (~bound | (weight == 0) | still).alias("complementary"),
    )


def attribution(rows: DataFrame, model: Model) -> DataFrame:
    """``feature, mean_abs_contribution``: how far each column moves predictions.

    For an additive model the contribution of a column to one prediction is its
    coefficient times its distance from the mean. The mean distance of an
    indicator follows from its mean; the others are one aggregate over the rows.
    """
    at = {name: i for i, name in enumerate(model.design.columns)}
    distances = rows.agg(
        *[
            F.avg(F.abs(value - model.means[at[name]])).alias(name.replace(".", "_"))
            for name, value in model.design.numbers()
        ]
    ).first()
    table = []
    numbers = {name for name, _ in model.design.numbers()}
    for name, i in at.items():
        if name == "intercept":
            continue
        if name in numbers:
            spread = distances[name.replace(".", "_")] or 0.0
        else:
            spread = 2 * model.means[i] * (1 - model.means[i])
        table.append((name, float(abs(model.coefficients[i]) * spread)))
    return rows.sparkSession.createDataFrame(table, "feature string, mean_abs_contribution double")


MODEL_SCHEMA = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("feature", T.StringType()),
        T.StructField("coefficient", T.DoubleType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("monotone", T.BooleanType()),
        T.StructField("contract", T.StringType()),
    ]
)


def model_table(spark: SparkSession, model: Model) -> DataFrame:
    """Model and feature contract as one small table, written and read back whole."""
    contract = json.dumps(
        {"version": 1, "levels": model.design.levels, "edges": model.design.edges, "rows": model.rows}
    )
    rows = [
        (i, name, model.coefficients[i], model.means[i], model.design.monotone[i], contract)
        for i, name in enumerate(model.design.columns)
    ]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def load_model(table: DataFrame) -> Model:
    rows = table.orderBy("position").collect()
    contract = json.loads(rows[0]["contract"])
    design = Design(contract["levels"], contract["edges"])
    if [r["feature"] for r in rows] != design.columns:
        raise ValueError("model table does not fit its feature contract")
    return Model(
        design, [r["coefficient"] for r in rows], [r["mean"] for r in rows], contract["rows"]
    )
