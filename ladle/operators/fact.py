"""Order-line fact table, order-grain facts, totals and generic lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions import scalars as S


def build_fact(lines: DataFrame, orders: DataFrame, menu_items: DataFrame) -> DataFrame:
    """Clean lines x clean orders (inner), item cost and category attached, line economics.

    A promotion may be recorded on the line or on the order; the line wins.
    """
    header = ["order_id", "customer_id", "is_guest", "location_id", "channel", "order_ts"]
    line_cols = ["order_id", "item_id", "quantity", "unit_price", "discount_pct", "line_total"]
    if "promotion_id" in lines.columns:
        line_cols.append("promotion_id")
    else:
        header.append("promotion_id")
    dim = menu_items.select("item_id", "category_id", F.col("food_cost").cast("decimal(12,2)").alias("food_cost"))
    joined = (
        lines.select(*line_cols)
        .join(orders.select(*header), "order_id")
        .join(dim, "item_id", "left")
    )
    revenue = F.col("line_total").cast(S.MONEY)
    cost = F.round(F.col("quantity").cast("decimal(10,0)") * F.col("food_cost"), 2).cast(S.MONEY)
    return joined.select(
        "order_id", "item_id", "category_id", "location_id", "customer_id", "is_guest", "channel",
        "order_ts", F.to_date("order_ts").alias("order_date"), "promotion_id",
        S.present(F.col("promotion_id")).alias("has_promo"),
        F.col("quantity").cast("int").alias("quantity"), "unit_price", "discount_pct",
        revenue.alias("revenue"), cost.alias("cost"), (revenue - cost).cast(S.MONEY).alias("profit"),
    )


def widen(fact: DataFrame, menu_items: DataFrame, categories: DataFrame, locations: DataFrame) -> DataFrame:
    """Attach names of item, category and outlet (left joins, unmatched keys keep their row)."""
    return (
        fact.join(menu_items.select("item_id", F.col("name").alias("item_name"), "base_price", "food_cost"),
                  "item_id", "left")
        .join(categories.select("category_id", "category_name"), "category_id", "left")
        .join(locations.select("location_id", F.col("name").alias("location_name")), "location_id", "left")
    )


def order_facts(fact: DataFrame) -> DataFrame:
    """One row per order. Order-level counts become plain counts on this table."""
    header = ["order_id", "location_id", "customer_id", "is_guest", "channel", "order_ts", "order_date"]
    return fact.groupBy(*header).agg(
        F.sum("revenue").cast(S.MONEY).alias("revenue"),
        F.sum("profit").cast(S.MONEY).alias("profit"),
        F.sum("quantity").alias("quantity"),
        F.count("*").alias("lines"),
        F.count_if("has_promo").alias("promo_lines"),
    )


def order_item_facts(fact: DataFrame) -> DataFrame:
    """One row per order and item. Counting orders per item, buyers per item and baskets
    needs no distinct on this table."""
    keys = ["order_id", "item_id", "category_id", "location_id", "customer_id", "is_guest", "order_date"]
    return fact.groupBy(*keys).agg(
        F.sum("quantity").alias("quantity"),
        F.sum("revenue").cast(S.MONEY).alias("revenue"),
        F.sum("cost").cast(S.MONEY).alias("cost"),
        F.sum("profit").cast(S.MONEY).alias("profit"),
        F.count("*").alias("lines"),
        F.count_if("has_promo").alias("promo_lines"),
    )


def sql_fact(spark: SparkSession, lines: DataFrame, orders: DataFrame, menu_items: DataFrame) -> DataFrame:
    """The same three-table join written in Spark SQL, at item x outlet detail."""
    return spark.sql(
        """
        SELECT l.item_id, o.location_id, l.quantity,
               l.line_total AS revenue,
               CAST(l.line_total - l.quantity * i.food_cost AS DECIMAL(18,2)) AS profit,
               CASE WHEN l.promotion_id IS NOT NULL AND l.promotion_id <> '' THEN 1 ELSE 0 END AS has_promo
        FROM {lines} l
        JOIN {orders} o ON l.order_id = o.order_id
        JOIN {items} i ON l.item_id = i.item_id
        WHERE o.location_id IS NOT NULL
        """,
        lines=lines, orders=orders, items=menu_items)


def lookup(df: DataFrame, dim: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Key -> name lookup that falls back to the key itself."""
    names = dim.select(key, F.col(value).alias("__name"))
    return df.join(names, key, "left").withColumn(
        out, F.coalesce("__name", F.col(key).cast("string"))).drop("__name")


def header_reconciliation(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Order totals from lines against the amount on the order header."""
    totals = lines.groupBy("order_id").agg(F.sum("line_total").cast(S.MONEY).alias("lines_total"))
    return orders.select("order_id", "total_amount").join(totals, "order_id").withColumn(
        "difference", (F.col("total_amount") - F.col("lines_total")).cast(S.MONEY))
