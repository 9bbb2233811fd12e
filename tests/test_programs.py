import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from facetflow import sampledata
from facetflow.operators import gates, normalize
from facetflow.plans import harvest, merge, run_cycle, train
from facetflow.sources import readers, registry, writers


def test_entry_and_catalogue(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_run_cycle(spark, sf_dir, tmp_path):
    raw, imports = str(tmp_path / "raw"), tmp_path / "imports"
    imports.mkdir()
    (imports / "partner.csv").write_text("source_url,price_usd,carat\nu1,1000,1.0\nu2,1200,1.1\n")
    listings = normalize.normalize(sampledata.listings(spark, sf_dir))
    writers.write_batch(listings, raw, "africa")
    tokens = readers.feed_tokens("africa,import:partner,absent")
    batch, skipped = run_cycle.collect_feeds(spark, tokens, raw, str(imports))
    assert [s.feed for s in skipped] == ["absent"]
    history, out = str(tmp_path / "history"), str(tmp_path / "run1")
    summary = run_cycle.run(spark, batch, "20260101T000000Z", "2026-01-01 00:00:00", history, out, tokens, skipped).first()
    assert summary["status"] == "ok" and summary["batch_rows"] == 6002
    assert summary["feed_quality"]["absent"]["rows"] == 0 and summary["feed_quality"]["import:partner"]["rows"] == 2
    assert summary["phase12_exit"]["metrics"]["vendor_distribution"]["partner"] == 2
    assert summary["skipped_feeds"][0]["feed"] == "absent"
    outcomes = {r["feed"]: (r["status"], r["rows"]) for r in summary["feed_outcomes"]}
    assert outcomes == {"africa": ("read", 6000), "import:partner": ("read", 2), "absent": ("absent", 0)}
    written = json.loads(next(Path(out, "run_summary").glob("*.json")).read_text())
    assert written["growth_metrics"]["delta_rows"] == 6002
    strict = gates.Required(growth=True)
    with pytest.raises(gates.GateFailed):
        run_cycle.run(spark, batch, "20260102T000000Z", "2026-01-02 00:00:00", history, str(tmp_path / "run2"), required=strict)
    assert Path(tmp_path, "run2", "run_summary").exists()


def test_a_run_carries_no_more_columns_than_its_report_shows(spark, tmp_path, monkeypatch):
    seen, detect = [], run_cycle.anomaly.detect_mispriced
    monkeypatch.setattr(run_cycle.anomaly, "detect_mispriced", lambda history, **more: seen.extend(history.columns) or detect(history, **more))
    rows = [("a", "u", "2026-01-01", "s", 10.0)]
    batch = normalize.normalize(spark.createDataFrame(rows, "vendor string, source_url string, date_seen string, sku_or_stock string, price_usd double"))
    run_cycle.run(spark, batch, "20260101T000000Z", "2026-01-01 00:00:00", str(tmp_path / "history"), str(tmp_path / "run"))
    assert set(seen) == {"listing_key", "vendor", "source_url", "price_usd", "scraped_at", "run_id"}


def test_merging_reads_small_pieces_and_leaves_the_session_as_it_was(spark, tmp_path, monkeypatch):
    name, seen, write = "spark.sql.files.maxPartitionBytes", [], merge.write_clean
    usual = spark.conf.get(name)
    monkeypatch.setattr(merge, "write_clean", lambda *given: seen.append(spark.conf.get(name)) or write(*given))
    spark.createDataFrame([("a", "u", 1.0), ("a", "u", 1.0)], "vendor string, source_url string, carat double").write.parquet(str(tmp_path / "in.parquet"))
    report = merge.merge_and_clean(spark, [str(tmp_path / "in.parquet")], str(tmp_path / "clean")).first()
    assert (report["rows_read"], report["rows_kept"]) == (2, 1)
    assert seen == [str(8 << 20)] and spark.conf.get(name) == usual


def test_run_with_an_empty_batch(spark, tmp_path):
    batch = readers.header_only(spark).withColumn("feed", F.lit(""))
    summary = run_cycle.run(spark, batch, "20260101T000000Z", "2026-01-01 00:00:00", str(tmp_path / "h"), str(tmp_path / "o"), ["a"]).first()
    assert summary["batch_rows"] == 0 and summary["active_vendor_count"] == 0
    assert summary["phase12_exit"]["checks"]["max_dominant_vendor_share"] is True
    assert summary["phase12_exit"]["ready"] is False


def test_merge_then_train(spark, sf_dir, tmp_path):
    feed, clean = str(tmp_path / "feed.parquet"), str(tmp_path / "clean")
    sampledata.priced_listings(spark, sf_dir).drop("feed").write.parquet(feed)
    with pytest.raises(gates.GateFailed):
        merge.merge_and_clean(spark, [feed], clean, sources=registry.registry(spark))
    report = merge.merge_and_clean(spark, [feed, str(tmp_path / "none.csv")], clean, str(tmp_path / "q"), str(tmp_path / "csv"))
    row = report.first()
    assert row["rows_read"] == 6000 and row["rows_kept"] == row["row_count"] < 6000
    listings = spark.read.parquet(clean)
    trained = train.train(listings, report)
    metrics = trained.metrics.first()
    assert metrics["n_groups"] == 5 and len(metrics["vendor_holdout"]) == 5
    assert metrics["time_holdout"]["model_mae_log"] < metrics["time_holdout"]["baseline_mae_log"]
    train.publish(spark, trained, str(tmp_path / "out"))
    assert {p.name for p in Path(tmp_path, "out").iterdir()} == {"metrics", "uncertainty_policy", "attribution", "model"}
    deep = train.train(listings, report, trees=4)
    errors = deep.metrics.first()
    assert errors["two_stage_cv_mae_log_mean"] < errors["cv_mae_log_mean"]
    assert deep.policy.high_error < trained.policy.high_error
    train.publish(spark, deep, str(tmp_path / "deep"))
    assert spark.read.parquet(str(tmp_path / "deep" / "trees")).where("model = -1").select("tree").distinct().count() == 4
    with pytest.raises(gates.GateFailed):
        train.train(listings, None)
    with pytest.raises(gates.GateFailed):
        train.train(listings, report, min_improvement=10.0)


def test_feeds_with_line_breaks_and_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('source_url,girdle,carat\nu1,"thin\nto ""thick""",1.5\nu2,plain,2\n')
    (tmp_path / "b.csv").write_text("source_url,girdle,carat\nu3,plain,1\n")
    (tmp_path / "c.csv").write_text("source_url,carat\n")
    assert readers.has_broken_lines(spark, str(tmp_path / "a.csv")) and not readers.has_broken_lines(spark, str(tmp_path / "b.csv"))
    rows = readers.read_present(spark, [str(tmp_path / f"{n}.csv") for n in "ab"]).collect()
    assert sorted((r["source_url"], r["girdle"], r["carat"]) for r in rows) == [("u1", 'thin\nto "thick"', 1.5), ("u2", "plain", 2.0), ("u3", "plain", 1.0)]
    feeds = {n: str(tmp_path / f"{n}.csv") for n in "abcd"} | {"e": str(tmp_path / "e.xml"), "import:b": str(tmp_path), "import:z": str(tmp_path)}
    found, skipped = readers.read_run(spark, feeds)
    got = {r["feed"]: (r["status"], r["rows"]) for r in readers.feed_outcomes(spark, found, skipped).collect()}
    assert got == {
        "a": ("read", 2), "b": ("read", 1), "import:b": ("read", 1), "c": ("empty", 0), "d": ("absent", 0), "e": ("unsupported", 0), "import:z": ("absent", 0),
    }
    assert found.where("feed = 'import:b'").first()["vendor"] == "b"
    nothing, skipped = readers.read_run(spark, {"d": feeds["d"]})
    assert nothing is None and readers.feed_outcomes(spark, nothing, skipped).count() == 1


def test_harvest_writes_batch_and_log(spark, sf_dir, tmp_path):
    lists, details = sampledata.label_pages(spark, sf_dir)
    lists.write.parquet(str(tmp_path / "lists"))
    details.write.parquet(str(tmp_path / "details"))
    done = harvest.harvest(spark, str(tmp_path / "lists"), str(tmp_path / "details"), "label", "2026-01-01", str(tmp_path / "raw"), "leaf:1")
    batch, log = spark.read.parquet(done.batch_path), spark.read.json(done.log_path)
    assert batch.count() == log.count() == done.listings > 0
    assert done.parsed == batch.where("price_usd <> 0 and carat <> 0").count()
    found, skipped = run_cycle.collect_feeds(spark, ["leaf:1"], str(tmp_path / "raw"), str(tmp_path))
    assert found.count() == done.listings and not skipped


def test_text_feeds_of_whole_tables_are_written_packed(spark, sf_dir):
    from facetflow import catalog

    for query in (catalog.json_scan, catalog.merged_inputs, catalog.run_feeds):
        files = query(spark, sf_dir).inputFiles()
        assert any(f.endswith((".csv.gz", ".json.gz")) for f in files) and not any(f.endswith((".csv", ".json")) for f in files), query
