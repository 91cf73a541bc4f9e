"""Data-quality assessment: counts issues, changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.functions import scalars as S
from ladle.operators.cleaning import counted_lines, valid_stars

# Issue names and the action each one leads to.
ISSUES = {
    "missing_customer": ("Missing customer IDs", "flag & keep (guest orders)"),
    "duplicate_lines": ("Duplicate order-lines", "quarantine"),
    "bad_price": ("Invalid / non-positive prices", "recover from pricing history"),
    "bad_quantity": ("Negative quantities", "remove"),
    "bad_rating": ("Invalid ratings (outside 1-5)", "clamp / drop"),
    "negative_waste": ("Impossible wastage (<0)", "remove"),
    "unknown_item": ("Unknown menu item refs", "quarantine"),
    "bad_location": ("Invalid location refs", "quarantine"),
    "not_completed": ("Cancelled / non-completed orders", "exclude from revenue"),
}


def line_issues(lines: DataFrame, menu_items: DataFrame) -> DataFrame:
    """Issue counters of the order lines: one scan, one shuffle (needed for duplicates)."""
    copies = counted_lines(lines).withColumnRenamed("copies", "__copies")
    known = menu_items.select("item_id", F.lit(True).alias("__known"))
    n = F.col("__copies")

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    return copies.join(known, "item_id", "left").agg(
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("duplicate_lines"),
        total(F.col("unit_price") <= 0).alias("bad_price"),
        total(F.col("quantity") <= 0).alias("bad_quantity"),
        total(F.col("__known").isNull()).alias("unknown_item"),
    )


def order_issues(orders: DataFrame, locations: DataFrame) -> DataFrame:
    known = locations.select("location_id", F.lit(True).alias("__known"))
    return orders.join(known, "location_id", "left").agg(
        F.count_if(~S.present(F.col("customer_id"))).alias("missing_customer"),
        F.count_if(F.col("__known").isNull()).alias("bad_location"),
        F.count_if(F.coalesce(F.col("status") != "completed", F.lit(True))).alias("not_completed"),
    )


def rating_issues(ratings: DataFrame) -> DataFrame:
    return ratings.agg(F.count_if(~valid_stars()).alias("bad_rating"))


def waste_issues(wastage: DataFrame) -> DataFrame:
    return wastage.agg(F.count_if(F.col("wasted_qty") < 0).alias("negative_waste"))


def issue_counts(one_row: DataFrame) -> DataFrame:
    """Counter columns -> ``(issue, records, action)`` rows."""
    rows = F.array(*[
        F.struct(F.lit(ISSUES[c][0]).alias("issue"), F.col(c).cast("long").alias("records"),
                 F.lit(ISSUES[c][1]).alias("action"))
        for c in one_row.columns])
    return one_row.select(F.explode(rows).alias("r")).select("r.*")


def assess(lines: DataFrame, orders: DataFrame, ratings: DataFrame, wastage: DataFrame,
           menu_items: DataFrame, locations: DataFrame) -> DataFrame:
    parts = [line_issues(lines, menu_items), order_issues(orders, locations),
             rating_issues(ratings), waste_issues(wastage)]
    report = issue_counts(parts[0])
    for part in parts[1:]:
        report = report.unionByName(issue_counts(part))
    return report


def foreign_key_violations(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Key values of ``child`` that ``parent`` does not have, with their row counts."""
    return child.join(parent.select(key), key, "left_anti").groupBy(key).agg(F.count("*").alias("records"))


def totals(report: DataFrame, log: DataFrame) -> DataFrame:
    """Issues caught and records cleaned, over the two reports."""
    a = report.select(F.lit("issues_caught").alias("metric"), "records")
    b = log.select(F.lit("records_cleaned").alias("metric"), "records")
    return a.unionByName(b).groupBy("metric").agg(F.sum("records").alias("records"))
