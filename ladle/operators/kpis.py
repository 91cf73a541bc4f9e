"""Headline figures, category and channel mix, outlet comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.functions import scalars as S
from ladle.functions.ranking import first_per_group
from ladle.operators import customers, series


def totals(orders: DataFrame) -> DataFrame:
    """Revenue, profit, orders and average order value (0 on an empty slice)."""
    zero = F.lit(0)
    return orders.agg(
        F.coalesce(F.sum("revenue"), zero).cast(S.MONEY).alias("revenue"),
        F.coalesce(F.sum("profit"), zero).cast(S.MONEY).alias("profit"),
        F.count("*").alias("orders"),
        F.coalesce(F.round(S.ratio(F.sum("revenue"), F.count("*")), 4), F.lit(0.0)).alias("aov"))


def kpi_row(orders: DataFrame, wastage: DataFrame, forecast_total: DataFrame | None = None) -> DataFrame:
    """One row with every headline figure."""
    row = S.as_columns(totals(orders), customers.activity(orders))
    waste = wastage.agg(F.coalesce(F.sum("cost"), F.lit(0)).cast(S.MONEY).alias("wastage_cost"))
    row = S.as_columns(row, waste)
    rate = S.half_even(S.ratio(F.col("wastage_cost"), F.col("revenue")) * 100, 1)
    row = row.withColumn("wastage_rate", F.coalesce(rate, F.lit(0.0)))
    return row if forecast_total is None else S.as_columns(row, forecast_total)


def kpi_deltas(daily: DataFrame, waste_series: DataFrame | None = None) -> DataFrame:
    """Second half against first half of the period for revenue, orders, profit and waste."""
    row = series.half_deltas(daily, ["revenue", "orders", "profit"])
    if waste_series is None:
        return row
    return S.as_columns(row, series.half_deltas(waste_series, ["waste"]))


def category_revenue(fact: DataFrame, categories: DataFrame) -> DataFrame:
    sums = fact.groupBy("category_id").agg(F.sum("revenue").cast(S.MONEY).alias("revenue"))
    return sums.join(categories, "category_id", "left").select(
        F.coalesce("category_name", "category_id").alias("category"), "revenue").orderBy(F.desc("revenue"), "category")


def channel_mix(orders: DataFrame, channels: DataFrame) -> DataFrame:
    """Orders per channel; channels without orders show zero."""
    counts = orders.groupBy("channel").agg(F.count("*").alias("n"))
    return channels.join(counts, "channel", "left").select("channel", F.coalesce("n", F.lit(0)).alias("orders"))


def overall_margin(orders: DataFrame) -> DataFrame:
    return orders.agg(S.half_even(S.ratio(F.sum("profit"), F.sum("revenue")) * 100, 1).alias("margin_pct"))


def leaders(menu: DataFrame, outlets: DataFrame, segments: DataFrame) -> DataFrame:
    """Best and worst item, best outlet by revenue, weakest by margin, biggest segment."""
    def end(value: str, key: str, low: bool = False) -> Column:
        v = F.col(value).cast("double")
        return F.min_by(key, F.struct((v if low else -v).alias("v"), F.col(key).alias("k")))

    row = menu.agg(end("revenue", "name").alias("best_item"), end("revenue", "name", True).alias("worst_item"))
    row = S.as_columns(row, outlets.agg(
        end("revenue", "name").alias("best_location"), end("profit_pct", "name", True).alias("weakest_location")))
    sizes = segments.groupBy("segment").agg(F.count("*").alias("n"))
    return S.as_columns(row, sizes.agg(end("n", "segment").alias("biggest_segment")))


# -- outlets ----------------------------------------------------------------
def outlet_economics(orders: DataFrame) -> DataFrame:
    return orders.groupBy("location_id").agg(
        F.sum("revenue").cast(S.MONEY).alias("revenue"),
        S.half_even(S.ratio(F.sum("profit"), F.sum("revenue")) * 100, 1).alias("profit_pct"),
        S.half_even(S.ratio(F.sum("revenue"), F.count("*")), 2).alias("aov"))


def outlet_customers(orders: DataFrame) -> DataFrame:
    per = orders.filter(~F.col("is_guest")).groupBy("location_id", "customer_id").agg(F.count("*").alias("n"))
    return per.groupBy("location_id").agg(
        F.count("*").alias("customers"),
        S.half_even(F.avg((F.col("n") > 1).cast("int")) * 100, 0).alias("repeat_pct"))


def star_and_drag(fact: DataFrame, menu_items: DataFrame) -> DataFrame:
    """Items with the largest and smallest profit per outlet."""
    sums = fact.groupBy("location_id", "item_id").agg(F.sum("profit").alias("p"))
    named = sums.join(menu_items.select("item_id", "name"), "item_id", "left")
    name = F.coalesce("name", "item_id")
    best = F.min_by(name, F.struct((-F.col("p")).alias("p"), F.col("item_id").alias("i")))
    worst = F.min_by(name, F.struct(F.col("p").alias("p"), F.col("item_id").alias("i")))
    return named.groupBy("location_id").agg(best.alias("star"), worst.alias("drag"))


def outlet_channel(orders: DataFrame) -> DataFrame:
    """Top channel per outlet and its share of the outlet's orders."""
    counts = orders.groupBy("location_id", "channel").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("location_id"))
    shared = counts.withColumn("channel_share", S.half_even(S.ratio(F.col("n"), total) * 100, 0))
    return first_per_group(shared, ["location_id"], [F.desc("n"), F.asc("channel")]).select(
        "location_id", "channel", "channel_share")


def outlet_waste_rating(orders: DataFrame, wastage: DataFrame, ratings: DataFrame) -> DataFrame:
    cost = wastage.groupBy("location_id").agg(F.sum("cost").alias("cost"))
    stars = ratings.groupBy("location_id").agg(F.avg("stars").alias("stars"))
    rev = orders.groupBy("location_id").agg(F.sum("revenue").alias("rev"))
    waste = S.half_even(S.ratio(F.coalesce(F.col("cost"), F.lit(0)), F.col("rev")) * 100, 1)
    return rev.join(cost, "location_id", "left").join(stars, "location_id", "left").select(
        "location_id", F.coalesce(waste, F.lit(0.0)).alias("waste_pct"),
        F.coalesce(S.half_even(F.col("stars"), 1), F.lit(0.0)).alias("rating"))


def location_table(fact: DataFrame, orders: DataFrame, wastage: DataFrame, ratings: DataFrame,
                   locations: DataFrame, menu_items: DataFrame) -> DataFrame:
    """One row per outlet, best revenue first; every part is one aggregate over all outlets."""
    return (
        outlet_economics(orders)
        .join(outlet_customers(orders), "location_id", "left")
        .join(star_and_drag(fact, menu_items), "location_id", "left")
        .join(outlet_channel(orders), "location_id", "left")
        .join(outlet_waste_rating(orders, wastage, ratings), "location_id", "left")
        .join(locations.select("location_id", "name"), "location_id", "left")
        .select("location_id", F.coalesce("name", F.col("location_id").cast("string")).alias("name"), "revenue",
                "profit_pct", "aov", F.coalesce("customers", F.lit(0)).alias("customers"),
                F.coalesce("repeat_pct", F.lit(0.0)).alias("repeat_pct"), "waste_pct", "rating", "star", "drag",
                "channel", "channel_share")
        .orderBy(F.desc("revenue"), "location_id")
    )
