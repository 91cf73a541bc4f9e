from dataclasses import replace
"""File sources and sinks, the batch reports over CSV tables, and the streaming detector."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ladle.config import Config
from ladle.operators import items
from ladle.plans import batch
from ladle.plans.mart import FileMart
from ladle.schemas import SCHEMAS
from ladle.sources import readers, sinks
from ladle.streaming.bursts import streaming_bursts


@pytest.fixture(scope="module")
def raw_folder(mart, tmp_path_factory):
    """The star tables written out as the eleven source tables in CSV."""
    folder = str(tmp_path_factory.mktemp("raw"))
    promo = mart.shipped_lines.groupBy("order_id").agg(F.max("promotion_id").alias("promotion_id"))
    tables = {
        "menu_categories": mart.categories,
        "menu_items": mart.menu_items.drop("item_no"),
        "locations": mart.locations,
        "customers": mart.star.customers(),
        "promotions": mart.promotions.withColumns(
            {"start_date": F.lit(None).cast("date"), "end_date": F.lit(None).cast("date")}),
        "pricing_history": mart.pricing_history.select("item_id", "price", "effective_date"),
        "orders": mart.raw_orders.join(promo, "order_id", "left"),
        "order_items": mart.raw_lines.withColumn("order_item_id", F.monotonically_increasing_id()),
        "ratings": mart.raw_ratings,
        "inventory": mart.inventory,
        "wastage": mart.raw_wastage.withColumns({"wastage_id": F.lit("w"), "reason": F.lit("returned")}),
    }
    for name, df in tables.items():
        columns = [c.split()[0] for c in SCHEMAS[name].split(", ")]
        df.select(*columns).write.option("header", True).option("escape", '"').csv(f"{folder}/{name}.csv")
    return folder


@pytest.fixture(scope="module")
def files(spark, raw_folder):
    return FileMart(spark, raw_folder, Config())


def test_csv_scan_with_and_without_schema(spark, raw_folder):
    typed = readers.read_csv(spark, raw_folder, "orders", columns=["order_id", "total_amount"])
    inferred = readers.read_csv(spark, raw_folder, "orders", infer=True)
    assert dict(typed.dtypes) == {"order_id": "string", "total_amount": "double"}
    assert typed.count() == inferred.count()
    assert "ReadSchema: struct<total_amount:double>" in typed.select(
        "total_amount")._jdf.queryExecution().executedPlan().toString()


def test_csv_mart_gives_the_same_fact(mart, files):
    total = lambda m: m.fact.agg(
        F.count("*").alias("n"), F.sum("quantity").alias("q"), F.sum("revenue").alias("r"), F.sum("cost").alias("c")).first()
    assert total(files) == total(mart)


def test_csv_mart_classifies_the_same(mart, files):
    pick = lambda m: {(r.item_id, r.menu_class) for r in m.menu.select("item_id", "menu_class").collect()}
    # promotion and rating keys come from text here, the class inputs are the same
    assert pick(files) == pick(mart)


REPORTS_WITHOUT_MODELS = [
    "profitability", "market_basket_rules", "demand_forecast", "forecast_by_location", "price_sensitivity",
    "promotion_effectiveness", "wastage_by_item", "location_performance", "anomalies", "data_quality_report", "cleaning_log"]


def test_batch_reports_over_csv(files, monkeypatch):
    monkeypatch.setattr(batch.ml, "first_family", lambda cfg: {"Decision Tree": batch.ml.DecisionTreeClassifier(maxDepth=4)})
    whole = batch.ml.train_second_family
    monkeypatch.setattr(batch.ml, "train_second_family", lambda samples, store, cfg: whole(samples, store, replace(cfg, boosting_rounds=3), trees=5))
    frames = batch.report_frames(files)
    assert set(frames) == set(sinks.REPORTS)
    for name in REPORTS_WITHOUT_MODELS:
        assert frames[name].limit(1).count() == 1, name
    assert frames["model_comparison"].count() == files.cells.count()
    assert frames["customer_segments"].filter("rfm_score between 1 and 5").count() == files.customers.count()


def test_report_round_trip_keeps_quotes(spark, tmp_path):
    df = spark.createDataFrame([('Restructure "Tier 5%" promotion, now', 1)], "action string, n int")
    sinks.write_report(df, str(tmp_path), "recommendations", "csv")
    assert sinks.read_report(spark, str(tmp_path), "recommendations", "csv").first().action == df.first().action
    found = {r.report: r.available for r in sinks.catalogue(spark, str(tmp_path)).collect()}
    assert found["recommendations"] and not found["anomalies"] and len(found) == 20


def test_report_view_is_capped(spark):
    rows = sinks.report_view(spark.range(30), ["id"], cap=10).collect()
    assert len(rows) == 10 and rows[0].total == 30 and rows[0].truncated
    assert not sinks.report_view(spark.range(3), ["id"], cap=10).first().truncated


def test_payload_is_one_nested_row(mart, spark, tmp_path):
    doc = sinks.payload(spark, {"classes": items.class_counts(mart.menu)})
    sinks.write_payload(doc, str(tmp_path / "p"))
    row = spark.read.json(str(tmp_path / "p")).collect()
    assert len(row) == 1 and sum(x["items"] for x in row[0].classes) == mart.menu.count()


def test_splits_are_written(mart, spark, tmp_path):
    batch.write_splits(mart, str(tmp_path), "parquet")
    parts = [sinks.read_report(spark, str(tmp_path), n) for n in ("train", "val", "test")]
    assert sum(p.count() for p in parts) == mart.cells.count()
    keys = ["item_id", "location_id"]
    assert parts[0].join(parts[1].unionByName(parts[2]), keys, "left_semi").count() == 0


def test_stream_finds_the_burst_once(spark, tmp_path):
    at = datetime(2026, 9, 17, 20, 15)
    schema = "item_id string, rating_ts timestamp, stars int"
    spark.createDataFrame([("M063", at, 5)] * 41 + [("M001", at, 4)] * 3, schema).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame([("M002", at + timedelta(hours=6), 3)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (streaming_bursts(stream).writeStream.outputMode("append").format("memory").queryName("bursts")
             .option("checkpointLocation", str(tmp_path / "cp")).start())
    query.processAllAvailable()
    query.stop()
    rows = spark.table("bursts").collect()
    assert [(r.item_id, r.stars, r.n) for r in rows] == [("M063", 5, 41)]
