"""The whole batch run: every report, the payload, both model families, splits and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.operators import (
    anomalies, basket, cleaning, commerce, customers, items, kpis, ml, quality, recommend, series)
from ladle.plans.mart import Mart
from ladle.sources import sinks

SPLIT = {"train": 70, "val": 15, "test": 15}


def report_frames(m: Mart) -> dict[str, DataFrame]:
    """All named reports as lazy frames over the mart."""
    prices = commerce.elasticity(m.fact, m.menu_items, m.cfg)
    effect = commerce.promotion_effectiveness(m.fact, m.promotions, m.orders, m.cfg)
    waste = commerce.waste_by_item(m.wastage, m.inventory, m.menu_items)
    names = m.menu_items.select(F.col("item_id").alias("item"), "name")
    found = anomalies.detect(m.orders, m.daily, m.outlet_days, m.ratings, m.locations, m.cfg)
    comparison = ml.compare_predictions(m.first_predictions, m.second_predictions)
    recs = recommend.recommendations(m.menu, effect, waste, m.segment_report, prices)
    return {
        "menu_performance": m.menu,
        "profitability": items.profitability(m.menu, m.categories),
        "customer_segments": customers.rfm_scores(m.cluster_segments),
        "churn_risk": m.churn_report(),
        "market_basket_rules": basket.rules(m.pair_metrics, names, m.cfg),
        "demand_forecast": series.forecast_report(m.daily, m.cfg),
        "forecast_by_location": series.group_forecasts(m.outlet_days, "location_id", m.cfg),
        "forecast_by_category": series.group_forecasts(
            series.daily_by_category(m.order_items), "category_id", m.cfg),
        "price_sensitivity": prices,
        "promotion_effectiveness": effect,
        "wastage_by_item": waste,
        "peak_monthly": series.monthly(m.orders),
        "location_performance": kpis.location_table(
            m.fact, m.orders, m.wastage, m.ratings, m.locations, m.menu_items),
        "anomalies": anomalies.anomaly_report(found, m.cfg),
        "recommendations": recommend.flattened(recs),
        "model_comparison": comparison,
        "spark_predictions": m.first_predictions,
        "python_predictions": m.second_predictions,
        "data_quality_report": quality.assess(
            m.raw_lines, m.raw_orders, m.raw_ratings, m.raw_wastage, m.menu_items, m.locations),
        "cleaning_log": cleaning.cleaning_log(
            m.raw_lines, m.raw_orders, m.raw_ratings, m.raw_wastage, m.menu_items),
    }


def payload_sections(m: Mart, root: str, fmt: str) -> dict[str, DataFrame]:
    """Sections of the dashboard document, taken from the written reports where one exists."""
    def report(name: str) -> DataFrame:
        return sinks.read_report(m.spark, root, name, fmt)

    top = commerce.price_demand_curve(m.fact, commerce.most_priced_item(m.fact))
    return {
        "kpis": kpis.kpi_row(m.orders, m.wastage, series.forecast_total(m.daily, m.cfg)),
        "deltas": kpis.kpi_deltas(m.daily, series.waste_by_date(m.wastage)),
        "daily": m.daily.select("date", "revenue", "orders"),
        "menu": report("menu_performance"),
        "menu_class_counts": items.class_counts(m.menu),
        "category_revenue": kpis.category_revenue(m.fact, m.categories),
        "heatmap": series.heatmap(m.orders, "order_ts"),
        "forecast": report("demand_forecast").filter("type = 'forecast'"),
        "forecast_quality": series.holdout_metrics(m.daily, m.cfg),
        "segments": m.segment_report,
        "rfm_buckets": customers.score_distribution(report("customer_segments")),
        "new_vs_returning": customers.new_vs_returning(m.orders),
        "basket": report("market_basket_rules"),
        "bundles": basket.bundles(report("market_basket_rules")),
        "locations_table": report("location_performance"),
        "channel_mix": kpis.channel_mix(m.orders, m.channels),
        "pricing": report("price_sensitivity"),
        "price_curve": top,
        "promotions": report("promotion_effectiveness"),
        "wastage_top": report("wastage_by_item").orderBy(F.desc("wastage_pct"), "item_id").limit(6),
        "wastage_risk": commerce.waste_risk(m.inventory, m.daily_inventory, m.menu_items, m.locations),
        "wastage_daily": series.waste_by_date(m.wastage),
        "anomalies": report("anomalies"),
        "data_quality": report("data_quality_report"),
        "clean_log": report("cleaning_log"),
        "recommendations": report("recommendations"),
        "model_agreement": ml.agreement(report("model_comparison")),
        "weekday_weekend": series.weekday_weekend(m.orders),
        "busiest_day": series.busiest_day(m.orders),
        "outlet_peaks": series.outlet_peaks(m.orders, "order_ts"),
        "churn": ml.churn_metrics(m.churn_scores, m.churn_model),
        "forecast_by_location": report("forecast_by_location"),
        "forecast_by_category": report("forecast_by_category"),
        "spark_models": m.first_family.leaderboard(m.cells),
        "python_models": m.second_family.leaderboard(m.cells),
    }


def run(m: Mart, out: str, fmt: str = "csv") -> None:
    """Write everything under ``out``: reports, payload, metrics, splits, model."""
    reports = f"{out}/reports"
    sinks.write_reports(report_frames(m), reports, fmt)
    sinks.write_sections(payload_sections(m, reports, fmt), f"{out}/payload")
    for name, engine, trained in (
            ("spark_metrics", "first family", m.first_family), ("python_metrics", "second family", m.second_family)):
        ml.metrics_document(trained, m.cells, engine, trained.seconds).write.mode("overwrite").json(f"{out}/{name}")
    ml.churn_metrics(m.churn_scores, m.churn_model).write.mode("overwrite").json(f"{out}/churn_metrics")
    write_splits(m, f"{out}/splits", fmt)
    ml.save_model(m.first_family.model, f"{out}/model")


def write_splits(m: Mart, out: str, fmt: str = "csv") -> None:
    """Train, validation and test files, stratified by the local class."""
    columns = ["item_id", "location_id", "name", *items.MODEL_FEATURES, "local_class"]
    split = ml.stratified_split(
        m.cells.select(*columns), "local_class", ["item_id", "location_id"], SPLIT, m.cfg.seed)
    for name in SPLIT:
        sinks.write_report(split.filter(F.col("split") == name).drop("split"), out, name, fmt)
