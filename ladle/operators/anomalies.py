"""Anomaly detectors; each returns ``(type, location, date, severity, detail)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.config import Config
from ladle.functions import scalars as S
from ladle.functions.ranking import exact_quantile

# Severities in report order.
SEVERITIES = ("critical", "high", "medium", "low")


def _row(kind: Column, location: Column, date: Column, severity: Column, detail: Column) -> list[Column]:
    return [kind.alias("type"), location.alias("location"), date.cast("string").alias("date"),
            severity.alias("severity"), detail.alias("detail")]


def revenue_zscores(daily: DataFrame) -> DataFrame:
    """Daily revenue in sample standard deviations from the overall mean."""
    rev = F.col("revenue").cast("double")
    stats = daily.agg(F.avg(rev).alias("__mean"), F.stddev_samp(rev).alias("__sd"))
    return S.as_columns(daily, stats).withColumn("z", S.ratio(rev - F.col("__mean"), F.col("__sd"))).drop(
        "__mean", "__sd")


def revenue_spikes(daily: DataFrame, cfg: Config = Config()) -> DataFrame:
    odd = revenue_zscores(daily).filter(F.abs("z") > cfg.z_cut)
    up = F.col("z") > 0
    detail = F.concat(
        F.lit("Daily revenue was "), S.signed(F.col("z"), 1), F.lit(" std from the norm ("),
        F.when(up, "well above").otherwise("well below"), F.lit(" expected). Flagged for review."))
    return odd.select(*_row(
        F.when(up, "Sales spike").otherwise("Sales drop"), F.lit("All locations"), F.col("date"),
        F.when(F.abs("z") > cfg.z_high, "high").otherwise("medium"), detail))


def margin_collapses(outlet_days: DataFrame, locations: DataFrame, cfg: Config = Config(), rows: int = 2) -> DataFrame:
    """The worst-margin outlet-days among those with above-median revenue."""
    days = outlet_days.select("location_id", "date", F.col("revenue").cast("double").alias("rev"),
                              F.col("profit").cast("double").alias("prof"))
    base = outlet_days.agg(S.ratio(F.sum("profit"), F.sum("revenue")).alias("base_margin"))
    df = S.as_columns(days, exact_quantile(days, "rev", 0.5, "median_rev")).filter("rev > median_rev")
    worst = df.withColumn("margin", S.ratio(F.col("prof"), F.col("rev"))).orderBy(
        "margin", "location_id", "date").limit(rows)
    worst = S.as_columns(worst, base).filter(F.col("margin") < F.col("base_margin") * cfg.margin_collapse)
    named = worst.join(locations.select("location_id", "name"), "location_id", "left")
    detail = F.concat(
        F.lit("Revenue was healthy ("), S.thousands(F.col("rev")), F.lit(") but contribution margin fell to "),
        S.fixed(F.col("margin") * 100, 0), F.lit("% (norm ~"), S.fixed(F.col("base_margin") * 100, 0),
        F.lit("%). Likely a promo discounting profitable mains."))
    return named.select(*_row(
        F.lit("Margin collapse"), F.col("name"), F.col("date"), F.lit("critical"), detail))


def order_outlier_count(orders: DataFrame, cfg: Config = Config()) -> DataFrame:
    """How many orders exceed mean + k standard deviations, and that threshold."""
    rev = F.col("revenue").cast("double")
    cut = orders.agg((F.avg(rev) + cfg.outlier_sigmas * F.stddev_samp(rev)).alias("threshold"))
    return S.as_columns(orders.select("revenue"), cut).agg(
        F.count_if(rev > F.col("threshold")).alias("outliers"), F.max("threshold").alias("threshold"))


def order_outliers(orders: DataFrame, cfg: Config = Config()) -> DataFrame:
    found = order_outlier_count(orders, cfg).filter("outliers > 0")
    detail = F.concat(
        F.col("outliers").cast("string"), F.lit(" orders exceeded "), S.thousands(F.col("threshold")),
        F.lit(" (4+ std above the mean order). Likely large group bookings - kept, but flagged for review."))
    return found.select(*_row(
        F.lit("Order-value outliers"), F.lit("Multiple"), F.lit("last 14 days"), F.lit("low"), detail))


def rating_burst_groups(ratings: DataFrame, size: int, unit: str = "hour", by: str = "item_id") -> DataFrame:
    """Groups of at least ``size`` equal ratings on one item within one clock unit."""
    timed = ratings.filter(F.col("rating_ts").isNotNull())
    return timed.groupBy(by, F.date_trunc(unit, "rating_ts").alias("bin"), "stars").agg(
        F.count("*").alias("n")).filter(F.col("n") >= size)


def rating_bursts(ratings: DataFrame, cfg: Config = Config(), unit: str = "hour", by: str = "item_id") -> DataFrame:
    found = rating_burst_groups(ratings, cfg.burst_size, unit, by)
    detail = F.concat(
        F.col("n").cast("string"), F.lit(" identical "), F.col("stars").cast("string"), F.lit("-star ratings on item "),
        F.col(by), F.lit(f" within one {unit} - possible non-organic ratings."))
    return found.select(*_row(
        F.lit("Rating cluster"), F.lit("Multiple"), F.to_date("bin"), F.lit("medium"), detail))


def detect(orders: DataFrame, daily: DataFrame, outlet_days: DataFrame, ratings: DataFrame, locations: DataFrame,
           cfg: Config = Config(), unit: str = "hour", by: str = "item_id") -> DataFrame:
    """All detectors together, unlimited."""
    return (revenue_spikes(daily, cfg)
            .unionByName(margin_collapses(outlet_days, locations, cfg))
            .unionByName(order_outliers(orders, cfg))
            .unionByName(rating_bursts(ratings, cfg, unit, by)))


def anomaly_report(found: DataFrame, cfg: Config = Config()) -> DataFrame:
    """The most severe first, then by date; a fixed-length report."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity"))
    return found.orderBy(rank, "date", "type", "location", "detail").limit(cfg.anomaly_rows)


def severity_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("severity").agg(F.count("*").alias("anomalies"))
