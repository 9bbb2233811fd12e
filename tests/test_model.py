import datetime
import heapq
import itertools
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from facetflow import catalog
from facetflow.functions import features
from facetflow.operators import baseline, model, policy, quantiles, residual_trees, splits, validation
from facetflow.plans import train


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return catalog.training_rows(spark, sf_dir)


@pytest.fixture(scope="module")
def checked(rows):
    return train.validate(rows)


def values(spark):
    rng = np.random.default_rng(5)
    data = [
        (["a", "a", "b", None][i % 4], "uvw"[i % 3], float(np.round(v, 2)))
        for i, v in enumerate(rng.lognormal(3, 2, 900))
    ] + [("a", "u", 7.0)] * 300
    return data, spark.createDataFrame(data, "k string, f string, x double").repartition(5)


@pytest.mark.parametrize("slices", [1, 4096])
def test_quantiles_are_exact_at_any_size(spark, monkeypatch, slices):
    monkeypatch.setattr(quantiles, "SLICES", slices)
    data, df = values(spark)
    got = quantiles.exact_quantiles(df, ["k"], "x", [0.5, 0.9], ["m", "p"], "f")
    got = {(r["k"], r["f"]): (r["m"], r["p"]) for r in got.collect()}
    assert len(got) == 9
    for (k, f), (m, p) in got.items():
        rest = [x for kk, ff, x in data if kk == k and ff != f]
        assert m == pytest.approx(np.percentile(rest, 50)) and p == pytest.approx(np.percentile(rest, 90))
    whole = quantiles.exact_quantiles(df, [], "x", [0.75], ["q"]).first()["q"]
    assert whole == pytest.approx(np.percentile([x for _, _, x in data], 75))
    grouped = quantiles.group_quantiles(df, ["k"], "x", 0.5).collect()
    assert {r["k"]: r["quantile"] for r in grouped} == pytest.approx(
        {k: statistics.median([x for kk, _, x in data if kk == k]) for k in ("a", "b", None)}
    )


def test_quantiles_of_nothing_and_of_one_value(spark):
    df = spark.createDataFrame([("a", 1.0)] * 40, "k string, x double")
    assert quantiles.exact_quantiles(df.where("false"), ["k"], "x", [0.5], ["m"]).count() == 0
    assert quantiles.exact_quantiles(df, ["k"], "x", [0.5], ["m"]).first()["m"] == 1.0
    alone = df.withColumn("f", F.lit("u"))
    assert quantiles.exact_quantiles(alone, ["k"], "x", [0.5], ["m"], "f").count() == 0


def test_quantiles_of_infinite_and_signed_values(spark):
    data = [-math.inf, -3.5, -0.0, 0.0, 5e-324, 1.0, 1.7e308, math.inf, math.inf, math.inf]
    df = spark.createDataFrame([(x,) for x in [*data, None, math.nan]], "x double").repartition(3)
    for k in range(len(data)):
        assert quantiles.global_quantiles(df, "x", [k / (len(data) - 1)], ["q"]).first()["q"] == data[k]


def test_feature_expressions(spark):
    df = spark.createDataFrame(
        [(1.25, 100.0, None, False), (0.875, 0.0, "Oval", None), (4.0, 10.0, "Oval", True), (2.0, 5.0, "Oval", None)],
        "carat double, price_usd double, shape string, is_lab_grown boolean",
    )
    kept = features.model_rows(df)
    assert sorted(r["carat"] for r in kept.collect()) == [1.25, 2.0]
    row = features.with_hinges(kept).where("carat = 2").first()
    assert (row["carat_sq"], row["carat_over_1_5"], row["carat_over_5_0"]) == (4.0, 0.5, 0.0)
    buckets = spark.createDataFrame([(0.125,), (0.375,), (0.4,)], "c double").select(features.carat_bucket(F.col("c")))
    assert [r[0] for r in buckets.collect()] == [0.0, 0.5, 0.5]


def test_folds_keep_vendors_whole(spark):
    sizes = {"a": 50, "b": 30, "c": 20, "d": 20, "e": 5, "f": 4, None: 1}
    df = spark.createDataFrame([(v,) for v, n in sizes.items() for _ in range(n)], "vendor string")
    got = {r["vendor"]: r["fold"] for r in splits.vendor_folds(df).collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4, "f": 4, "Unknown": 4}
    assert splits.group_count(df).first()[0] == 7


DATED = "date_seen date, source_url string, vendor string"


def test_time_split_is_exact_inside_a_date(spark):
    data = [("2026-01-01", f"u{i}", "v") for i in range(100)] + [("2026-01-02", f"w{i}", "v") for i in range(200)] + [(None, "n", "v")]
    df = spark.createDataFrame(data, "date_seen string, source_url string, vendor string")
    df = df.withColumn("date_seen", F.col("date_seen").cast("date"))
    at = splits.time_cut(df, ["source_url"])
    split = splits.with_time_split(df, at, ["source_url"])
    assert {r["is_late"]: r["count"] for r in split.groupBy("is_late").count().collect()} == {False: 240, True: 60, None: 1}
    again = splits.with_time_split(df.repartition(7), splits.time_cut(df.repartition(3), ["source_url"]), ["source_url"])
    assert sorted(map(str, split.collect())) == sorted(map(str, again.collect()))
    assert splits.time_cut(df.limit(50), ["source_url"]) is None


def test_time_split_deals_out_identical_rows(spark):
    df = spark.createDataFrame([("same", "v")] * 150 + [("other", "v")] * 3, "source_url string, vendor string")
    df = df.withColumn("date_seen", F.lit("2026-01-01").cast("date"))
    at = splits.time_cut(df, ["source_url"])
    assert at.early_copies > 0
    split = splits.with_time_split(df, at, ["source_url"])
    assert {r["is_late"]: r["count"] for r in split.groupBy("is_late").count().collect()} == {False: 122, True: 31}
    assert split.where("source_url = 'same'").count() == 150


def test_baseline_falls_back_to_the_overall_median(spark):
    train_rows = [("Fancy", 1.0, float(i), "a") for i in range(5)] + [(None, 1.0, 100.0, "a"), ("Deep", 2.0, 50.0, "b")]
    df = spark.createDataFrame(train_rows, "intensity string, carat double, log_price double, vendor string")
    fitted = baseline.fit_baseline(df.where("vendor = 'a'"))
    got = baseline.predict_baseline(df, fitted).select("intensity", "baseline_log_price").distinct().collect()
    assert {r[0]: r[1] for r in got} == {"Fancy": 2.0, None: 100.0, "Deep": 2.5}


def test_solver_meets_its_conditions():
    rng = np.random.default_rng(2)
    x = np.column_stack([np.ones(400), rng.normal(size=(400, 3)), rng.random((400, 4)), np.zeros(400)])
    x = np.column_stack([x, x[:, 1]])
    y = x[:, 1] - 2 * x[:, 4] + 3 * x[:, 5] + 0.1 * rng.normal(size=400)
    z = np.column_stack([x, y])
    bound = [False] * 4 + [True] * 4 + [True, False]
    beta = model.solve(model.Cells.of_dense(z.T @ z), bound)
    assert (beta[4:9] >= 0).all() and beta[4] == 0 and beta[8] == 0
    scale = np.sqrt((x**2).mean(axis=0))
    penalty = np.where(np.arange(10) == 0, 0, model.RIDGE) * scale**2
    gradient = x.T @ (y - x @ beta) / 400 - penalty * beta
    for j in range(10):
        if bound[j] and beta[j] == 0:
            assert gradient[j] <= 1e-8
        else:
            assert abs(gradient[j]) < 1e-8


def dense(design, pdf):
    """The rows of the design, written out."""
    x = np.zeros((len(pdf), len(design.columns)))
    for r, row in enumerate(pdf.to_dict("records")):
        at = dict.fromkeys(design.columns, 0.0) | {"intercept": 1.0}
        for g in model.CATEGORICAL:
            level = row[g] if isinstance(row[g], str) else features.MISSING
            if f"{g}={level}" in at:
                at[f"{g}={level}"] = 1.0
        for m in model.MEASURES:
            gap = row[m] is None or math.isnan(row[m])
            at[m], at[f"{m}_missing"] = (0.0, 1.0) if gap else (row[m], 0.0)
        for low, high in design.ramps:
            at[f"carat_ramp_{low}_{high}"] = min(max((row["carat"] - low) / (high - low), 0.0), 1.0)
        at["carat_ln"] = math.log(row["carat"])
        x[r] = [at[c] for c in design.columns]
    return x


def test_cross_products_and_prediction_agree_with_numpy(rows):
    design = model.fit_design(rows)
    pdf = rows.select(*model.CATEGORICAL, *model.MEASURES, "carat", "log_price").toPandas()
    z = np.column_stack([dense(design, pdf), pdf["log_price"]])
    cells = model.collect_cells(model.cross_products(rows, design, []), design)
    assert np.allclose(cells.dense(), z.T @ z) and (cells.value != 0).all()
    fitted = model.fit(cells, design)
    spark_mean = rows.agg(F.avg(fitted.predict()), F.stddev_pop(fitted.predict())).first()
    expected = z[:, :-1] @ np.array(fitted.coefficients)
    assert tuple(spark_mean) == pytest.approx((expected.mean(), expected.std()))
    means, n = model.column_means(rows, design)
    assert n == len(z) and np.allclose(means, z[:, :-1].mean(axis=0)) and np.allclose(means, fitted.means)


def test_sums_of_all_ramps_follow_from_those_of_a_segment(spark):
    edges = model.RAMP_EDGES[1:]
    weights = [0.001, *edges, *(e - 1e-9 for e in edges), *(e * (1 + 2e-16) for e in edges), 0.7, 11.0, 31.0, 1e6]
    data = [(f"v{k % 2}", "ab"[k % 2] if k % 3 else None, w, None if k % 4 else float(k), k / 8) for k, w in enumerate(weights * 2)]
    schema = "vendor string, shape string, carat double, length_mm double, log_price double"
    others = [c for c in [*model.CATEGORICAL, *model.MEASURES] if c not in schema]
    kind = {c: "string" if c in model.CATEGORICAL else "double" for c in others}
    df = spark.createDataFrame(data, schema).select("*", *[F.lit(None).cast(kind[c]).alias(c) for c in others])
    design = model.fit_design(df)
    pdf = df.toPandas()
    cells = model.cross_products(df, design, ["vendor"]).collect()
    assert len({(r["vendor"], r["i"], r["j"]) for r in cells}) == len(cells)
    for vendor in ("v0", "v1"):
        own = pdf[pdf["vendor"] == vendor].reset_index(drop=True)
        z = np.column_stack([dense(design, own), own["log_price"]])
        got = model.Cells.of([(r["i"], r["j"], r["value"]) for r in cells if r["vendor"] == vendor], len(z.T))
        assert np.allclose(got.dense(), z.T @ z, rtol=1e-12) and ((got.dense() != 0) == (z.T @ z != 0)).all()


def test_a_number_that_is_not_finite_spoils_its_cells(spark, rows):
    df = rows.limit(3).withColumn("carat", F.lit(0.3)).withColumn("length_mm", F.lit(float("inf")))
    design = model.fit_design(df)
    value = {(r["i"], r["j"]): r["value"] for r in model.cross_products(df, design, []).collect()}
    last = [design.at[f"carat_ramp_{a}_{b}"] for a, b in design.ramps][-1]
    assert math.isnan(value[design.at["length_mm"], last]) and value[0, design.at["length_mm"]] == math.inf


def test_gram_matrix_writes_only_what_it_sums(spark, sf_dir, monkeypatch):
    written, write_out = [], catalog.write_out
    monkeypatch.setattr(catalog, "write_out", lambda df, name: written.append(df.columns) or write_out(df, name))
    assert catalog.gram_matrix(spark, sf_dir).count() > 0
    assert [sorted(c) for c in written] == [sorted(["vendor", *features.CATEGORICAL, *features.NUMERIC, "log_price"])]


def test_dividing_out_a_grade_and_starting_elsewhere_change_nothing(rows):
    design = model.fit_design(rows)
    cells = model.collect_cells(model.cross_products(rows, design, []), design)
    plain = model.solve(cells, design.monotone)
    assert np.allclose(plain, model.solve(cells, design.monotone, block=design.widest), atol=1e-8)
    start = np.abs(np.random.default_rng(1).normal(size=len(plain)))
    assert np.allclose(plain, model.solve(cells, design.monotone, block=design.widest, start=start), atol=1e-8)


def test_ten_thousand_levels(spark, rows):
    n = F.pmod(F.xxhash64("source_url"), F.lit(10_000))
    many = rows.withColumn("shape", F.concat(F.lit("Shape "), n.cast("string")))
    more = spark.range(10_000).select(F.concat(F.lit("Shape "), F.col("id").cast("string")).alias("shape"), F.lit(1.0).alias("carat"), F.lit(7.0).alias("log_price"))
    many = many.unionByName(more, allowMissingColumns=True)
    design = model.fit_design(many)
    assert len(design.levels["shape"]) == 10_000 and design.widest == (design.offset("shape"), design.offset("shape") + 10_000)
    fitted = model.fit(model.collect_cells(model.cross_products(many, design, []), design), design)
    judged = model.optimality(many, fitted).where("not (not_negative and stationary and complementary)")
    assert judged.count() == 0
    wrong = model.Model(design, [c + 0.01 for c in fitted.coefficients], fitted.means, fitted.rows)
    assert model.optimality(many, wrong).where("not stationary").count() > 0


def greedy(sizes, folds):
    lightest, out = [(0, f) for f in range(folds)], []
    for size in sizes:
        load, fold = heapq.heappop(lightest)
        out.append(fold)
        heapq.heappush(lightest, (load + size, fold))
    return out


def test_dealing_by_size_is_greedy():
    r = random.Random(4)
    for _ in range(300):
        folds = r.randint(1, 6)
        sizes = sorted((r.choice([1, 1, 2, 3, 7, 50, 1000]) for _ in range(r.randint(0, 60))), reverse=True)
        loads, got = [0] * folds, []
        for size, group in itertools.groupby(sizes):
            items = len(list(group))
            stages = splits.dealing_order(loads, size)
            for k in range(items):
                first, order = [s for s in stages if s[0] <= k][-1]
                got.append(order[(k - first) % len(order)])
            loads = splits._after(loads, size, items)
        assert got == greedy(sizes, folds)


def test_folds_of_many_equal_vendors(spark):
    df = spark.range(200_000).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("vendor"))
    df = df.unionByName(spark.range(90_000).select(F.lit("big").alias("vendor")))
    got = {r["vendor"]: r["fold"] for r in splits.vendor_folds(df).collect()}
    names = ["big", *sorted(v for v in got if v != "big")]
    assert [got[v] for v in names] == greedy([90_000] + [1] * 200_000, 5)


def test_prediction_never_falls_with_weight(spark, rows, checked):
    fitted = checked.sums.whole
    some = rows.limit(20).drop("carat").crossJoin(spark.range(1, 4000).select((F.col("id") / 100).alias("carat")))
    step = some.select("source_url", "carat", fitted.predict().alias("p"))
    before = F.lag("p").over(Window.partitionBy("source_url").orderBy("carat"))
    assert step.withColumn("d", F.col("p") - before).agg(F.min("d")).first()[0] >= -1e-9


def test_validation_beats_the_baseline(checked):
    cv = checked.cv.first()
    assert cv["status"] == "ok" and cv["cv_mae_improvement_vs_baseline"] > 0
    assert checked.per_fold.count() == 5 and cv["cv_r2_mean"] > 0.9
    held = {r["vendor"]: r for r in checked.vendor_holdout.collect()}
    assert len(held) == 5 and all(r["model_mae_log"] < r["baseline_mae_log"] for r in held.values())
    late = checked.time_holdout.first()
    assert late["model_mae_log"] < late["baseline_mae_log"]


def test_leave_one_out_sums_equal_a_refit(rows, checked):
    folds = {r["vendor"]: r["fold"] for r in checked.folds.collect()}
    scoring = {r["fold"]: r["scoring"] for r in validation.fold_coefficients(rows.sparkSession, checked.sums).collect()}
    vendor, fold = next(iter(folds.items()))
    rest = rows.where(F.col("vendor") != vendor)
    sums = model.collect_cells(model.cross_products(rest, checked.design, []), checked.design)
    refit = model.scoring_vector(checked.design, model.solve(sums, checked.design.monotone))
    assert np.allclose(scoring[fold], refit, atol=1e-6)
    held = checked.sums.vendor_models(checked.rows, validation.eligible_vendors(checked.rows)).collect()
    assert len(held) == 5
    assert np.allclose(next(r["scoring"] for r in held if r["vendor"] == vendor), refit, atol=1e-6)


def test_vendors_without_enough_rows_are_not_held_out(spark):
    sizes = {"a": 49, "b": 10, "c": 9, "Unknown": 40}
    df = spark.createDataFrame([(v,) for v, n in sizes.items() for _ in range(n)], "vendor string")
    assert sorted(r[0] for r in validation.eligible_vendors(df).collect()) == ["a", "b"]
    assert validation.eligible_vendors(df.where("vendor = 'a'")).count() == 0


def test_stored_models_are_validated_without_training(spark, rows):
    checked = train.validate(rows, stored=catalog.stored_models)
    assert isinstance(checked.sums, validation.Stored) and checked.per_fold.count() == 5
    assert [k for k, _ in checked.sums.fold_models()] == [0, 1, 2, 3, 4]
    held = [r["vendor"] for r in checked.vendor_holdout.collect()]
    assert held == sorted(held) and len(held) == 5
    record = train.metrics_record(checked, checked.cv, checked.sums.whole).first()
    assert record["n_samples"] == rows.count() and record["time_holdout"]["model_mae_log"] > 0
    broken = validation.Stored(checked.design, checked.sums.table.where("feature <> 'carat_ln'"), checked.sums.means, 1)
    with pytest.raises(ValueError):
        broken.whole


def test_rows_reach_the_same_node_alone_and_among_others():
    rng = np.random.default_rng(3)
    tree, bins = residual_trees.Tree(31), rng.integers(0, 6, (500, 13)).astype(np.int32)
    tree.feature[:11], tree.cut[:11] = rng.integers(0, 13, 11), rng.integers(0, 5, 11)
    some = np.flatnonzero(rng.random(500) < 0.6)
    for depth in range(5):
        assert (tree.node_of(bins, depth, some) == tree.node_of(bins, depth)[some]).all()
    assert len(set(tree.node_of(bins, 4, some))) > 5 and len(tree.node_of(bins, 4, some[:0])) == 0


def test_the_validation_queries_train_the_model_of_every_split(spark, monkeypatch):
    r = random.Random(8)
    schema = "vendor string, source_url string, sku_or_stock string, date_seen date, log_price double, "
    schema += ", ".join([*(f"{g} string" for g in features.CATEGORICAL), *(f"{m} double" for m in features.NUMERIC)])
    data = []
    for k in range(270):
        grades = [r.choice(["a", "b", "c", None]) for _ in features.CATEGORICAL]
        weight, sizes = r.choice([0.3, 0.7, 1.2, 1.8, 4.5, 40.0]), [r.choice([None, 1.0, 2.5, 4.0]) for _ in model.MEASURES]
        log_price = 6 + 1.5 * math.log(weight) + 0.2 * (grades[0] == "a") + 0.1 * r.random()
        data.append((f"v{k % 9 % 4}", f"u{k}", None, datetime.date(2026, 1, 1 + k % 20), log_price, *grades, weight, *sizes))
    df = spark.createDataFrame(data * 2, schema)  # every row comes twice
    monkeypatch.setattr(catalog, "training_rows", lambda *_: df)
    per_fold = {row["fold"]: row for row in catalog.cv_metrics(spark, "").collect()}
    held = {row["vendor"]: row for row in catalog.vendor_holdout(spark, "").collect()}
    design = model.fit_design(df)
    pdf = df.toPandas()
    x, y = dense(design, pdf), pdf["log_price"].to_numpy()
    folds = {row["vendor"]: row["fold"] for row in splits.vendor_folds(df).collect()}
    assert len(per_fold) == len(held) == 4 and sum(f["rows"] for f in per_fold.values()) == 540
    for vendor, fold in folds.items():
        own = (pdf["vendor"] == vendor).to_numpy()
        z = np.column_stack([x[~own], y[~own]])
        left = y[own] - x[own] @ model.solve(model.Cells.of_dense(z.T @ z), design.monotone)
        error, explained = np.abs(left).mean(), 1 - (left**2).mean() / y[own].var()
        assert held[vendor]["model_mae_log"] == pytest.approx(error, abs=2e-6)
        assert (per_fold[fold]["mae_log"], per_fold[fold]["r2"]) == pytest.approx((error, explained), abs=2e-6)


def test_one_vendor_skips_cross_validation(rows):
    vendor = rows.first()["vendor"]
    cv = train.validate(rows.where(F.col("vendor") == vendor)).cv.first()
    assert cv["status"] == "skipped_single_vendor" and cv["cv_mae_log_mean"] is None


def test_policy_and_scoring(spark, rows, checked):
    rules, report = policy.uncertainty_policy(rows, checked.residuals)
    errors = [r[0] for r in checked.residuals.select("abs_error").collect()]
    assert rules.high_error == pytest.approx(np.percentile(errors, 90))
    assert rules.medium_error == pytest.approx(np.percentile(errors, 75))
    assert report.first()["reject_if_missing_feature_count_ge"] == 4
    sparse = rows.limit(3).withColumns({c: F.lit(None).cast("double") for c in ("table_pct", "depth_pct", "length_mm", "width_mm")})
    fitted = checked.sums.whole
    rejected = policy.score(sparse, fitted, rules).collect()
    assert all(r["reject"] and r["predicted_price"] is None for r in rejected)
    kept = policy.score(rows, fitted, rules).where("not reject").first()
    assert kept["price_low"] < kept["predicted_price"] < kept["price_high"]


def test_bands_of_scored_prices_are_out_of_fold(checked):
    errors = [r[0] for r in checked.errors(checked.sums.whole).select("abs_error").collect()]
    bands = policy.error_bands(checked.errors(checked.sums.whole)).first()
    out = policy.score(checked.rows, checked.sums.whole, policy.Policy(bands["p75"], bands["p90"])).where("not reject").first()
    assert math.log(out["price_high"] / out["predicted_price"]) == pytest.approx(np.percentile(errors, 90))


def tree_by_hand(bins, residual, depth, kinds, penalty):
    """Corrections of one tree, grown node by node over lists of rows."""
    out = np.zeros(len(bins))

    def grow(rows, level):
        total, n = residual[rows].sum(), len(rows)
        out[rows] = total / (n + penalty)
        best = (1e-12, None)
        for f in range(bins.shape[1]) if level < depth else ():
            for cut in range(bins[:, f].max() + 1):
                left = bins[rows, f] == cut if kinds[f] else bins[rows, f] <= cut
                a, b = rows[left], rows[~left]
                if len(a) and len(b):
                    gain = residual[a].sum() ** 2 / (len(a) + penalty) + residual[b].sum() ** 2 / (len(b) + penalty) - total**2 / (n + penalty)
                    if gain > best[0] + 1e-12:
                        best = (gain, (a, b))
        if best[1]:
            grow(best[1][0], level + 1)
            grow(best[1][1], level + 1)

    grow(np.arange(len(bins)), 0)
    return out


def boosted_by_hand(bins, residual, folds, fold, trees, depth, rate, together, kinds):
    left, used = residual.copy(), np.flatnonzero(folds != fold)
    for _ in range(0, trees, together):
        fitted = tree_by_hand(bins[used], left[used], depth, kinds, 1.0)
        # All trees of a round are the same without sampling; rows outside learn from their bins.
        lookup = {tuple(b): v for b, v in zip(bins[used].tolist(), fitted)}
        left = left - rate * together * np.array([lookup.get(tuple(b), np.nan) for b in bins.tolist()])
    return left


@pytest.mark.parametrize(("depth", "together"), [(1, 1), (3, 2)])
def test_boosted_residuals_like_a_tree_grown_by_hand(spark, rows, depth, together):
    small = rows.where("table_pct < 54").select("vendor", "log_price", "carat", *model.CATEGORICAL, *model.MEASURES).limit(400)
    small = small.withColumns({c: F.lit(None).cast("double") for c in ("length_mm", "width_mm", "depth_mm", "l_w_ratio")})
    small = small.withColumns({c: F.lit("x") for c in ("shape", "clarity", "intensity")})
    small = small.withColumn("fold", F.pmod(F.xxhash64("log_price"), F.lit(2)).cast("int"))
    design = model.fit_design(small)
    fitted = model.Model(design, [0.1] * len(design.columns), [0.0] * len(design.columns), 400)
    trees = 4
    done = residual_trees.boost(small, [(0, fitted), (1, fitted)], trees, depth, 0.2, 1.0, 1.0, together)
    state = done.state.select("fold", "_bins", "_left", "linear_log_price", "log_price").toPandas()
    bins = np.array(state["_bins"].tolist())
    residual = (state["log_price"] - state["linear_log_price"]).to_numpy()
    kinds = [True] * len(model.CATEGORICAL) + [False] * len(model.MEASURES)
    for k in (0, 1):
        want = boosted_by_hand(bins, residual, state["fold"].to_numpy(), k, trees, depth, 0.2, together, kinds)
        known = ~np.isnan(want)
        assert known.sum() > 300
        assert np.allclose(np.array(state["_left"].tolist())[known, k], want[known], atol=1e-9)
    errors = done.out_of_fold().collect()
    assert len(errors) == len(state) and all(r["abs_error"] >= 0 for r in errors)


def test_trees_lower_the_out_of_fold_error_and_stay_monotone(spark, rows, checked):
    second = checked.boosted(10, depth=3, rate=0.1)
    both = second.out_of_fold().agg(F.avg("abs_error"), F.avg(F.abs(F.col("log_price") - F.col("linear_log_price")))).first()
    assert both[0] < both[1] == pytest.approx(checked.residuals.agg(F.avg("abs_error")).first()[0])
    some = rows.limit(5).drop("carat").crossJoin(spark.range(1, 300).select((F.col("id") / 10).alias("carat")))
    scored = residual_trees.predict_in_two_stages(some, checked.sums.whole, second.trees)
    before = F.lag("predicted_log_price").over(Window.partitionBy("source_url").orderBy("carat"))
    assert scored.select((F.col("predicted_log_price") - before).alias("d")).agg(F.min("d")).first()[0] >= -1e-9
    assert scored.where("predicted_log_price <> linear_log_price").count() > 0
    table = residual_trees.tree_table(spark, second.trees)
    assert {r[0] for r in table.select("model").distinct().collect()} == {-1, 0, 1, 2, 3, 4}
    shares = [r["importance"] for r in residual_trees.tree_importance(table).collect()]
    assert shares and sum(shares) == pytest.approx(1.0)


def test_edges_and_rare_levels(spark, rows):
    edges = residual_trees.measure_edges(rows, 8)
    seen = sorted({r[0] for r in rows.select("table_pct").collect()})
    assert edges["table_pct"] == seen[: len(edges["table_pct"])] and edges["l_w_ratio"] == []
    design = model.fit_design(rows)
    few = residual_trees.fit_inputs(rows, design, grade_bins=4)
    assert max(few.bins["shape"]) == 3 and sorted(few.bins["shape"]).count(1) == 1
    most = rows.groupBy("shape").count().orderBy(F.desc("count"), "shape").first()["shape"]
    assert few.bins["shape"][design.levels["shape"].index(most)] == 1


def test_model_table_round_trip(spark, rows, checked, tmp_path):
    fitted = checked.sums.whole
    path = str(tmp_path / "model")
    model.model_table(spark, fitted).write.parquet(path)
    assert model.load_model(spark.read.parquet(path)) == fitted
    ranked = model.attribution(rows, fitted).orderBy(F.col("mean_abs_contribution").desc()).first()
    assert ranked["feature"].startswith("carat") or ranked["feature"].startswith("length")


def test_the_error_of_a_row_is_worked_out_once(rows, checked):
    """The prediction stands below the step that makes a row's terms, not above it."""
    plan = model.optimality(rows, checked.sums.whole)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("Generate stack") < plan.index("AS _error")


def test_rows_are_not_sent_by_fold_or_vendor_to_meet_medians(checked):
    """Few medians come to the rows, whatever a plan knows of them."""
    fitted = baseline.fit_baseline(checked.rows, "vendor")
    for met in (baseline.predict_baseline(checked.rows, fitted), validation.out_of_fold(checked.rows, checked.sums)):
        plan = met._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
