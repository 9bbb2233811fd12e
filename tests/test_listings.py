import random

import pytest
from pyspark.sql import functions as F

from facetflow.operators import anomaly, dedupe, gates, normalize, quality, runs
from facetflow.sources import readers, registry, writers

LISTING = "vendor string, source_url string, date_seen string, carat double, intensity string, cert_lab string, cert_number string, price_usd double, length_mm double, width_mm double, depth_mm double"


def listings(spark, rows):
    return normalize.normalize(spark.createDataFrame(rows, LISTING))


ROWS = [
    ("a", "u1", "2026-01-01", 1.0, "Fancy", "GIA", "1234567", 10.0, 1.0, 1.0, 1.0),
    ("b", "u2", "2026-01-03", 1.2, "Fancy", "gia", "No 1234567", 11.0, 2.0, 1.0, 1.0),
    ("b", "u3", None, 1.2, "Fancy", "IGI", "1234567", 12.0, 2.0, 1.0, 1.0),
    ("a", "u4", "2026-01-01", 1.004, "Fancy", None, None, 10.0, 5.0, 4.0, 3.0),
    ("b", "u5", "2026-01-02", 0.996, "Fancy", None, "12", 10.0, 5.005, 4.0, 3.0),
    ("b", "u6", "2026-01-02", 0.996, None, None, None, 10.0, 5.0, 4.0, 3.0),
    ("a", "u7", "2026-01-02", None, None, None, None, None, None, None, None),
    ("b", "u8", "2026-01-02", None, None, None, None, None, None, None, None),
]


def urls(df):
    return sorted(r["source_url"] for r in df.select("source_url").collect())


def test_dedupe_by_certificate_then_geometry(spark):
    df = listings(spark, ROWS)
    assert urls(dedupe.dedupe(df)) == ["u2", "u3", "u5", "u6", "u7"]
    assert urls(dedupe.dedupe(df, "keep")) == ["u2", "u3", "u5", "u6", "u7", "u8"]
    with pytest.raises(ValueError):
        dedupe.dedupe(df, "drop")


def test_dedupe_is_idempotent_and_ignores_input_order(spark):
    rows = [
        (random.Random(i).choice("ab"), f"u{i % 40}", f"2026-01-{1 + i % 5:02d}", (i % 7) / 3, "Fancy", "GIA", str(1000000 + i % 50) if i % 3 else None, float(i % 4), 1.0, 2.0, 3.0)
        for i in range(400)
    ]
    df = listings(spark, rows)
    once = dedupe.dedupe(df).cache()
    assert once.count() < 400
    assert sorted(map(str, dedupe.dedupe(once).collect())) == sorted(map(str, once.collect()))
    shuffled = df.repartition(7, F.rand(3))
    assert sorted(map(str, dedupe.dedupe(shuffled).collect())) == sorted(map(str, once.collect()))


def test_dedupe_drops_copies_before_the_shuffle(spark):
    plan = dedupe.dedupe(listings(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange")
    assert "Partial" in plan


def test_batch_summary_rates(spark):
    df = spark.createDataFrame([(1000.0, 1.0, "1234567"), (None, 1.2, "")], "price_usd double, carat double, cert_number string")
    row = quality.summarize_batch(df).first()
    assert (row["rows"], row["price_present_rate"], row["carat_present_rate"]) == (2, 0.5, 1.0)
    assert (row["mean_parse_rate"], row["cert_present_rate"]) == (0.75, 0.5)
    empty = quality.summarize_batch(df.where("false").drop("carat")).first()
    assert tuple(empty) == (0, 0.0, 0.0, 0.0, 0.0)


def test_feeds_without_rows_are_reported(spark):
    df = spark.createDataFrame([("x", 1.0, 1.0, "1")], "feed string, price_usd double, carat double, cert_number string")
    wanted = spark.createDataFrame([("x",), ("import:y",)], "feed string")
    got = {r["feed"]: tuple(r)[1:] for r in quality.summarize_feeds(df, wanted).collect()}
    assert got == {"x": (1, 1.0, 1.0, 1.0, 1.0), "import:y": (0, 0.0, 0.0, 0.0, 0.0)}
    row = quality.weighted_quality(quality.summarize_feeds(df, wanted)).first()
    assert tuple(row) == (1, 1.0, 1.0)


def test_quality_report(spark):
    row = quality.quality_report(listings(spark, ROWS + [(None, None, None, 1.0, None, None, None, None, None, None, None)])).first()
    assert row["row_count"] == 9
    assert row["vendor_counts"] == {"a": 3, "b": 5, "Unknown": 1}
    assert row["joint_parse_rate"] == pytest.approx(6 / 9)
    assert (row["missing_price_rows"], row["missing_carat_rows"]) == (3, 2)
    assert row["required_completeness"]["intensity"] == pytest.approx(5 / 9)


def test_vendor_counts_ignore_blank(spark):
    df = spark.createDataFrame([("A",), ("B",), ("B",), ("",), (None,)], "vendor string")
    assert quality.active_vendors(df).first()[0] == 2
    assert tuple(quality.dominant_vendor(df).first()) == ("B", 2 / 3)
    assert tuple(quality.dominant_vendor(df.where("false")).first()) == (None, 0.0)
    tie = spark.createDataFrame([("B",), ("A",)], "vendor string")
    assert tuple(quality.dominant_vendor(tie).first()) == ("A", 0.5)


RUN1, RUN2 = "20260101T000000Z", "20260102T000000Z"


def run_history(spark, n1=2, n2=6):
    rows = [(RUN1, k, str(i + 1)) for i, k in enumerate("ABCDEF"[:n1])]
    rows += [(RUN2, k, str(i + 1)) for i, k in enumerate("ABCDEF"[:n2])]
    return spark.createDataFrame(rows, "run_id string, listing_key string, cert_number string")


def test_expansion_and_growth(spark):
    history = run_history(spark)
    row = runs.expansion_of(history, RUN2).first()
    assert (row["baseline_run_id"], row["current_unique_listings"], row["baseline_unique_listings"]) == (RUN1, 6, 2)
    assert (row["listing_coverage_multiple"], row["cert_coverage_multiple"]) == (3.0, 3.0)
    assert runs.run_expansion(history).where(F.col("run_id") == RUN2).first()["cert_coverage_multiple"] == 3.0
    grown = runs.growth_of(history, RUN2).first()
    assert (grown["previous_run_id"], grown["previous_rows"], grown["current_rows"], grown["delta_rows"], grown["delta_pct"]) == (RUN1, 2, 6, 4, 2.0)
    first = runs.growth_of(history, RUN1).first()
    assert (first["previous_run_id"], first["delta_rows"], first["delta_pct"]) == (None, 2, 1.0)
    empty = runs.growth_of(history.where("false"), RUN1).first()
    assert (empty["current_rows"], empty["delta_rows"], empty["delta_pct"]) == (0, 0, 0.0)
    assert runs.expansion_of(history.where("false"), RUN1).first()["listing_coverage_multiple"] == 0.0


def metrics_row(spark, **changes):
    values = dict(
        active_vendor_count=3, listing_coverage_multiple=3.2, cert_coverage_multiple=3.0, dominant_vendor="A",
        dominant_vendor_share=0.4, weighted_cert_present_rate=0.82, weighted_parse_success_rate=0.87, delta_rows=30,
    )
    values.update(changes)
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'bigint'}" for k, v in values.items()))


def test_phases_are_independent(spark):
    df = metrics_row(spark, cert_coverage_multiple=2.1)
    row = df.select(gates.phase_progress(gates.Thresholds()).alias("p")).first()["p"]
    assert row["phase_1_acquisition_hardening"]["ready"] is True
    assert row["phase_2_dataset_defensibility"]["ready"] is False
    assert row["phase_2_dataset_defensibility"]["checks"]["meets_listing_coverage"] is True


def test_exit_gate(spark):
    def judge(df):
        return df.select(gates.exit_evaluation(gates.Thresholds()).alias("e")).first()["e"]

    assert judge(metrics_row(spark))["ready"] is True
    dominated = judge(metrics_row(spark, dominant_vendor_share=0.9))
    assert dominated["ready"] is False
    assert dominated["checks"]["max_dominant_vendor_share"] is False


def test_gate_precedence(spark):
    everything = gates.Required(True, True, True, True)

    def status(required, **changes):
        return metrics_row(spark, **changes).select(gates.status(gates.Thresholds(), required)).first()[0]

    bad = dict(delta_rows=1, active_vendor_count=1, cert_coverage_multiple=1.0)
    assert status(gates.Required(), **bad) == "ok"
    assert status(everything, **bad) == gates.FAILED_GROWTH
    assert status(everything, **{**bad, "delta_rows": 25}) == gates.FAILED_SOURCES
    assert status(everything, cert_coverage_multiple=1.0) == gates.FAILED_COVERAGE
    assert status(everything, dominant_vendor_share=0.7) == gates.FAILED_EXIT
    assert status(everything) == "ok"
    failed = metrics_row(spark).withColumn("status", F.lit(gates.FAILED_EXIT))
    with pytest.raises(gates.GateFailed):
        gates.enforce(failed)


def test_training_gates(spark):
    with pytest.raises(gates.GateFailed):
        gates.enforce_training_quality(None)
    report = spark.createDataFrame([(0.89,)], "joint_parse_rate double")
    with pytest.raises(gates.GateFailed):
        gates.enforce_training_quality(report)
    gates.enforce_training_quality(report.select((F.col("joint_parse_rate") + 0.01).alias("joint_parse_rate")))
    cv = spark.createDataFrame([(0.1, 0.1)], "cv_mae_log_mean double, baseline_cv_mae_log_mean double")
    gates.enforce_gate(gates.improvement(cv))
    with pytest.raises(gates.GateFailed):
        gates.enforce_gate(gates.improvement(cv, 0.01))
    with pytest.raises(gates.GateFailed):
        gates.enforce_gate(gates.improvement(cv.where("false")))


def test_source_policy(spark):
    sources = registry.registry(spark)
    assert registry.active_sources(sources).count() == 2
    with pytest.raises(gates.GateFailed):
        registry.enforce_source_policy(sources)
    registry.enforce_source_policy(sources, 2)


PRICES = "listing_key string, price_usd string, scraped_at string, vendor string, source_url string"


def price_rows(key, prices):
    return [(key, None if p is None else str(p), f"2026-01-{i + 1:02d}T00:00:00Z", "V", "u") for i, p in enumerate(prices)]


def test_large_drop_is_flagged(spark):
    rows = price_rows("drop", [10010 + 10 * i for i in range(7)] + [6500]) + price_rows("short", [1, 2, 3])
    rows += price_rows("flat", [5] * 6) + price_rows("bad", [1, 2, 3, 4, "x", None])
    got = {r["listing_key"]: r for r in anomaly.detect_mispriced(spark.createDataFrame(rows, PRICES), z_threshold=2.0).collect()}
    assert set(got) == {"drop", "flat"}
    assert got["drop"]["is_mispriced"] and got["drop"]["is_potentially_undervalued"]
    assert got["drop"]["price_usd"] == 6500 and got["drop"]["count"] == 8
    assert got["flat"]["z_score"] is None and got["flat"]["is_mispriced"] is False


def test_mispriced_runs_nothing_before_an_action(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    anomaly.detect_mispriced(spark.createDataFrame(price_rows("a", range(1, 8)), PRICES))
    assert not tracker.getJobIdsForGroup("planning")


def test_hot_listings_give_the_same_result(spark):
    rows = [r for k, n in (("hot", 300), ("cool", 20), ("few", 6)) for r in price_rows(k, [((i * 37) % 101) / 7 for i in range(n)])]
    rows = [(k, p, f"2026-01-01T00:{i // 60:02d}:{i % 60:02d}Z", v, u) for i, (k, p, _, v, u) in enumerate(rows)]
    df = spark.createDataFrame(rows, PRICES)
    exact = ["listing_key", "price_usd", "count", "median", "drop_pct_vs_median"]  # deviations add up in any order
    plain = sorted(map(str, anomaly.detect_mispriced(df).select(exact).collect()))
    hot = sorted(map(str, anomaly.detect_mispriced(df.repartition(7)).select(exact).collect()))
    assert plain == hot


def test_written_listings_give_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(anomaly, "LISTED", 50)
    prices = {"hot": [((i * 37) % 101) / 7 for i in range(300)], "cool": [9, 1, 4.5, 3, 8, 2.25], "few": [1, 2, 3], "far": [1, "1e999", 3, "1e999", 5, "x"]}
    rows = [r for k, values in prices.items() for r in price_rows(k, values)] + price_rows(None, range(9))
    rows = [(k, p, f"2026-01-01T00:{i // 60:02d}:{i % 60:02d}Z", v, u) for i, (k, p, _, v, u) in enumerate(rows)]
    df = spark.createDataFrame(rows, PRICES)
    exact = ["listing_key", "price_usd", "count", "median", "drop_pct_vs_median"]
    plain = sorted(map(str, anomaly.detect_mispriced(df).select(exact).collect()))
    written = sorted(map(str, anomaly.detect_mispriced(df, written=True).select(exact).collect()))
    assert len(plain) == 3 and plain == written


def test_readers(spark, tmp_path):
    (tmp_path / "partner.csv").write_text("source_url,price_usd,carat,vendor\nu1,1000,1.0,\n\"u,2\",1200,None, v \n")
    (tmp_path / "empty.csv").write_text("source_url,price_usd\n")
    (tmp_path / "b.csv").write_text("carat,source_url\n2.5,u3\n")
    (tmp_path / "c.json").write_text('{"source_url": "u4", "cert_number": "00123456", "price_usd": 5}\n')
    feed = readers.read_import(spark, "partner", str(tmp_path))
    assert [(r["source_url"], r["vendor"], r["carat"]) for r in feed.collect()] == [("u1", "partner", "1.0"), ("u,2", "v", "None")]
    with pytest.raises(readers.SourceEmpty):
        readers.read_import(spark, "empty", str(tmp_path))
    with pytest.raises(readers.SourceMissing):
        readers.read_import(spark, "absent", str(tmp_path))
    paths = [str(tmp_path / n) for n in ("partner.csv", "absent.csv", "b.csv", "c.json")]
    both = {r["source_url"]: r for r in readers.read_present(spark, paths).collect()}
    assert both["u3"]["carat"] == 2.5 and both["u4"]["cert_number"] == "00123456" and both["u4"]["price_usd"] == 5.0
    with pytest.raises(readers.SourceMissing):
        readers.read_present(spark, [str(tmp_path / "absent.csv")])
    with pytest.raises(ValueError):
        readers.read_table(spark, "x.xml")
    found, skipped = readers.read_run(spark, {"b": paths[2], "e": str(tmp_path / "empty.csv"), "n": paths[1]})
    assert [r["feed"] for r in found.collect()] == ["b"]
    assert [s.feed for s in skipped] == ["e", "n"]


def test_feed_tokens():
    assert readers.feed_tokens(" A, ,import:B ,") == ["a", "import:b"]
    assert readers.import_alias("import: x ") == "x" and readers.import_alias("x") is None
    assert readers.feed_folder("import:x") == "import_x"
    with pytest.raises(ValueError):
        readers.import_alias("import: ")


def test_history_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "history")
    batch = listings(spark, ROWS)
    assert readers.read_history(spark, path).count() == 0
    for _ in range(2):
        writers.append_history(writers.stamp(batch, RUN1, "2026-01-01 00:00:00"), path)
    writers.append_history(writers.stamp(batch, RUN2, "2026-01-02 00:00:00"), path)
    history = readers.read_history(spark, path)
    assert history.groupBy("run_id").count().orderBy("run_id").collect() == [(RUN1, 8), (RUN2, 8)]
    assert history.where("listing_key = 'URL:a:u7'").count() == 2


def test_header_only_feed_flows_through(spark):
    empty = readers.header_only(spark)
    assert dedupe.dedupe(empty).count() == 0
    assert quality.summarize_batch(empty).first()["rows"] == 0
    assert quality.quality_report(empty).first()["row_count"] == 0


def test_an_emptied_run_and_other_writers_of_a_history(spark, tmp_path):
    path = str(tmp_path / "history")
    batch = listings(spark, ROWS)
    for run in (RUN1, RUN2):
        writers.append_history(writers.stamp(batch, run, "2026-01-01 00:00:00"), path, run)
    writers.append_history(writers.stamp(batch.where("false"), RUN1, "2026-01-01 00:00:00"), path, RUN1)
    assert readers.read_history(spark, path).groupBy("run_id").count().collect() == [(RUN2, 8)]


def test_only_faults_of_a_feed_are_passed_over(spark, tmp_path, monkeypatch):
    (tmp_path / "q.csv").write_text('source_url,price_usd,carat\nu1,1,"a\nb"\nu2,2,1.0\n')
    assert readers.read_import(spark, "q", str(tmp_path), multiline=True).count() == 2

    def lost(*_):
        raise OSError("store not reached")

    monkeypatch.setattr(readers, "read_table", lost)
    with pytest.raises(OSError):
        readers.read_run(spark, {"a": "a.csv"})
