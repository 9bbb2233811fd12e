import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetflow.llm import neighbours


def brute(rows, k, step=20):
    good = {}
    for i, v in rows:
        if i is None or v is None or len(v) != 8 or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = min(good[i], v) if i in good else v
    out = set()
    for q in good:
        if q % step == 0:
            scores = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


def search(spark, rows, k=20):
    table = spark.createDataFrame([(i, v, 0.5, "x") for i, v in rows], "vec_id long, embedding array<double>, score double, key string").repartition(4)
    return {tuple(r) for r in neighbours.search(table, F.col("vec_id") % 20 == 0, k).collect()}


def same(a, b):
    key = lambda s: {x[:3]: x[3] for x in s}
    return key(a).keys() == key(b).keys() and all(abs(key(a)[k] - key(b)[k]) < 1e-12 for k in key(a))


@pytest.mark.parametrize("seed,spread", [(1, 0.05), (2, 10.0)])
def test_equals_brute_force(spark, monkeypatch, seed, spread):
    monkeypatch.setattr(neighbours, "WINDOW", 8)
    r = np.random.default_rng(seed)
    centres = r.standard_normal((6, 8))
    rows = [(i, (centres[i % 6] + spread * r.standard_normal(8)).tolist()) for i in range(400)]
    assert same(search(spark, rows), brute(rows, 20))


def test_nulls_zeros_ties_and_repeats(spark):
    one = [1.0] + [0.0] * 7
    rows = [(i, one) for i in range(60)]  # all tie
    rows += [(100, None), (120, [0.0] * 8), (101, [None, *one[1:]]), (102, [float("inf"), *one[1:]]), (103, [float("nan"), *one[1:]])]
    rows += [(104, [1.0]), (None, one), (40, one), (41, [0.5, *one[1:]]), (140, []), (61, [-x for x in one])]
    assert same(search(spark, rows), brute(rows, 20))


def test_fewer_candidates_and_empty_table(spark):
    v = [0.0, 1.0] + [0.0] * 6
    assert same(search(spark, [(20, v), (21, v)]), {(20, 1, 21, 1.0)})
    assert search(spark, [(20, v)]) == set()
    empty = neighbours.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0)
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.count() == 0


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (2, 4)])
def test_the_curve_visits_every_cell_by_unit_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    key = neighbours.hilbert(cells, bits)
    assert sorted(key.tolist()) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1)
    assert (steps == 1).all()
