import zlib

import numpy as np

from facetflow.llm import quality

from .cases import NAMES, documents, empty, prose, texts

LABELS = "doc_id long, quality int, x string"


def corpus(n=240):
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        text = prose(i, 30 + i % 50).capitalize() + "." if good else " | ".join(prose(i, 40).upper().split()) + "!!"
        rows.append((i, text))
        labels.append((i, int(good), "x"))
    return rows, labels


def test_held_out_accuracy_and_split(spark):
    rows, labels = corpus()
    out = quality.classify(documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    truth = dict((i, y) for i, y, _ in labels)
    assert len(out) == len(rows)
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.5)
    held = [r for r in out if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.97


def test_held_out_labels_are_not_learnt_from(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y, x) for i, y, x in labels]
    a = {r.doc_id: r.score for r in quality.classify(docs, spark.createDataFrame(labels, LABELS)).collect()}
    b = {r.doc_id: r.score for r in quality.classify(docs, spark.createDataFrame(flipped, LABELS)).collect()}
    assert all(abs(a[i] - b[i]) < 1e-9 for i in a)


def test_awkward_rows_and_kept_columns(spark):
    rows, labels = corpus(120)
    docs = documents(spark, [(i + 1000, t) for i, t in rows] + texts())
    known = spark.createDataFrame([(i + 1000, y, x) for i, y, x in labels] + [(1000, None, "x"), (None, 1, "x"), (1001, 7, "x")], LABELS)
    out = quality.classify(docs, known).collect()
    assert len(out) == 120 + len(texts()) and all(0 <= r.score <= 1 for r in out)
    assert all(r.held_out is False for r in out if r.doc_id is None)
    kept = quality.keep_good(docs, known)
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if r in set(kept.collect()))


def test_without_labels_and_empty(spark):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality.classify(documents(spark), none).collect()} == {0.5}
    assert quality.classify(empty(spark), none).count() == 0
    one = spark.createDataFrame([(1, 1, "x")], LABELS)
    assert all(0 <= r.score <= 1 for r in quality.classify(documents(spark), one).collect())
    assert NAMES.startswith("doc_id")


def test_isotonic():
    w = np.ones(5)
    assert quality.isotonic(np.array([1.0, 3, 2, 2, 5]), w).tolist() == [1, 7 / 3, 7 / 3, 7 / 3, 5]
    assert quality.isotonic(np.array([3.0, 2, 1]), np.array([1.0, 1, 2])).tolist() == [1.75] * 3


def test_cosines_approximate_a_gaussian_kernel():
    r = np.random.default_rng(0)
    x = r.standard_normal((20, quality.SIZE))
    m = quality.Model(np.zeros(quality.SIZE), np.ones(quality.SIZE), r.standard_normal((quality.SIZE, 20_000)) / 3, r.uniform(0, 2 * np.pi, 20_000), *[np.zeros(0)] * 3)
    z = m.cosines(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / 18)
    assert np.abs(z @ z.T - kernel).max() < 0.05
