"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from ladle.operators import cleaning, ml
from ladle.plans.mart import StarMart
from ladle.plans.registry import load_all

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# queries timed after the stored tables exist, in report order
HEADLINE = [
    "data_quality_report", "cleaning_log", "kpi_row", "kpi_deltas", "location_performance", "category_revenue",
    "channel_mix", "item_economics", "item_repeat", "item_trend", "menu_classification", "profitability",
    "local_classification", "customer_features", "rfm_scores", "rule_segments", "segment_profile",
    "new_vs_returning", "market_basket_rules", "basket_brand_pairs", "asof_price_in_effect", "daily_series",
    "peak_monthly", "outlet_peaks", "orders_heatmap", "demand_forecast", "holdout_metrics", "forecast_by_location",
    "forecast_by_category", "price_sensitivity", "promotion_effectiveness", "wastage_by_item", "waste_risk",
    "what_if", "anomaly_report", "recommendations", "slice_dates_kpis", "slice_place_kpis", "slice_dates_locations",
]


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("ladle-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    """Execute the whole plan without bringing rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    begin = time.time()
    spark = session()
    times: dict[str, float] = {"start_session": round(time.time() - begin, 2)}

    def timed(name, action):
        start = time.time()
        out = action()
        times[name] = round(time.time() - start, 2)
        return out

    mart = StarMart(spark, SF_DIR)
    queries = load_all()
    # the stages of the batch job: ingest, clean, join and write, features, models
    timed("stage_ingest_and_counts", lambda: queries["ingest_audit"].run(mart).collect())
    timed("stage_source_tables", lambda: (mart.menu_items, mart.shipped_lines, mart.raw_orders))
    timed("stage_clean_audit", lambda: cleaning.row_audit(mart.dirty_lines, mart.menu_items).collect())
    timed("stage_fact_write", lambda: mart.fact)
    timed("stage_order_tables", lambda: (mart.orders, mart.order_items))
    timed("stage_stock", lambda: mart.stock)
    timed("stage_item_features", lambda: mart.menu)
    cells = timed("stage_cell_features", lambda: mart.cells)
    keys = ["item_id", "location_id"]
    timed("stage_split", lambda: ml.stratified_split(
        cells.select(*keys, "local_class"), "local_class", keys, {"train": 70, "test": 30}, mart.cfg.seed
    ).groupBy("split").count().collect())
    for name, estimator in ml.first_family(mart.cfg).items():
        timed("stage_fit_" + name.lower().replace(" ", "_"), lambda e=estimator, n=name: ml.train_family(
            cells, {n: e}, ml.FIRST_FEATURES, mart.cfg))
    chosen = ml.train_family(cells, {"Decision Tree": ml.first_family(mart.cfg)["Decision Tree"]},
                             ml.FIRST_FEATURES, mart.cfg)
    timed("stage_predict", lambda: run(ml.score_cells(cells, chosen.model, ml.FIRST_FEATURES)))
    timed("stage_save_model", lambda: ml.save_model(chosen.model, f"{mart.root}/bench_model"))
    timed("stage_customers", lambda: mart.segments)
    timed("stage_pairs", lambda: mart.pair_metrics)
    timed("stage_series", lambda: (mart.daily, mart.outlet_days))
    timed("second_family", lambda: mart.second_family)
    for name in HEADLINE:
        timed(name, lambda n=name: run(queries[n].run(mart)))
    total = round(time.time() - begin, 2)
    # the batch job: session start, ingest, clean, join, write, features, models
    job = round(times["start_session"] + sum(v for k, v in times.items() if k.startswith("stage_")), 2)
    print(json.dumps({"metric": "batch_job_total", "value": job, "unit": "sec", "queries": times,
                      "with_headline_queries": total, "sf": SF_DIR.rsplit("sf", 1)[-1], "cpus": int(CPUS)}))
    spark.stop()


if __name__ == "__main__":
    main()
