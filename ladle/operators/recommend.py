"""Ranked, evidence-backed recommendations from the finished report tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle import config as C
from ladle.functions import scalars as S


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _rec(df: DataFrame, position: int, priority: str, action: Column, why: list[Column], do: str,
         impact: str) -> DataFrame:
    return df.select(
        F.lit(position).alias("position"), F.lit(priority).alias("priority"), action.alias("action"),
        F.array(*why).alias("why"), F.lit(do).alias("do"), F.lit(impact).alias("impact"))


# The sentences below are report text and part of the result.
def promote_hidden(menu: DataFrame) -> DataFrame:
    best = menu.filter(F.col("menu_class") == C.HIDDEN_OPPORTUNITY).orderBy(F.desc("margin"), "item_id").limit(1)
    return _rec(
        best, 1, "Critical", _text("Promote ", F.col("name")),
        [_text(S.fixed(F.col("margin") * 100, 0), "% contribution margin - among the highest on the menu"),
         _text(S.fixed(F.col("rating"), 1), "★ average rating"),
         _text("Only ", S.fixed(F.col("wastage_pct"), 1), "% wastage"),
         F.lit("Low current order frequency (Hidden Opportunity)"),
         _text(S.fixed(F.col("repeat_pct"), 0), "% repeat purchase among people who try it")],
        "Feature on the homepage and suggest at checkout", "+ est. profit uplift")


def restructure_trap(effect: DataFrame) -> DataFrame:
    trap = effect.filter("verdict = 'TRAP'").orderBy("promotion_id").limit(1)
    return _rec(
        trap, 2, "Critical", _text('Restructure "', F.col("promotion"), '" promotion'),
        [_text("Sales lift ", S.signed(F.col("order_share_pct"), 0), "% but margin ",
               S.signed(F.col("margin_gap"), 1), " pts vs baseline"),
         F.col("note"), F.lit("Classic promotion-trap pattern")],
        "Cap the discount or switch to a fixed-price bundle", "Recovers lost margin")


def cut_preparation(waste_items: DataFrame) -> DataFrame:
    worst = waste_items.orderBy(F.desc("wastage_pct"), "item_id").limit(1)
    return _rec(
        worst, 3, "High", _text("Reduce prep for ", F.col("name")),
        [_text(S.fixed(F.col("wastage_pct"), 1), "% wastage - well above the 3% target"),
         F.lit("Demand is stable and predictable"), F.lit("Forecast supports a prep reduction")],
        "Cut daily prep quantity ~20% and re-check weekly", "Direct wastage cost saving")


def win_back(segments: DataFrame) -> DataFrame:
    risk = segments.filter("segment = 'At-Risk'")
    return _rec(
        risk, 4, "High", F.lit("Re-engage At-Risk customers"),
        [_text(S.thousands(F.col("customers")), " customers with ", F.col("churn_pct").cast("string"),
               "% churn probability"),
         F.lit("Recency climbing, frequency falling"), F.lit("Historically responsive to favourite-item offers")],
        "Targeted win-back on their top category", "Protects customer lifetime value")


def _collected(df: DataFrame, sort: str, rows: int) -> DataFrame:
    """Names of at most ``rows`` rows in sort order, as one array."""
    few = df.orderBy(sort, "item_id").limit(rows)
    entries = F.array_sort(F.collect_list(F.struct(F.col(sort).alias("k"), F.col("item_id").alias("i"), "name")))
    return few.agg(F.transform(entries, lambda e: e["name"]).alias("names")).filter("size(names) > 0")


def price_rise(prices: DataFrame) -> DataFrame:
    low = _collected(prices.filter(F.col("sensitivity") == C.LOW_SENSITIVITY), "elasticity", 3)
    return _rec(
        low, 5, "Medium", _text("Test a price increase on ", F.size("names").cast("string"), " low-sensitivity items"),
        [F.lit("Elasticity near zero - demand barely moves with price"),
         _text("Items: ", F.concat_ws(", ", "names")), F.lit("Margins have room to grow")],
        "Test a 4-6% increase and monitor two weeks", "+ est. margin uplift")


def redesign_low(menu: DataFrame) -> DataFrame:
    low = _collected(menu.filter(F.col("menu_class") == C.LOW_PERFORMER), "profit_score", 3)
    return _rec(
        low, 6, "Medium", _text("Redesign or retire ", F.size("names").cast("string"), " Low Performers"),
        [F.lit("Weak demand + weak margin + poor trend"),
         _text("High wastage on ", F.concat_ws(", ", F.slice("names", 1, 2))),
         F.lit("No location where they clearly perform")],
        "Replace with a seasonal special", "Frees prep capacity")


def recommendations(menu: DataFrame, effect: DataFrame, waste_items: DataFrame, segments: DataFrame,
                    prices: DataFrame) -> DataFrame:
    """All recommendations in order; a rule without a match adds no row."""
    parts = [promote_hidden(menu), restructure_trap(effect), cut_preparation(waste_items), win_back(segments),
             price_rise(prices), redesign_low(menu)]
    return reduce(DataFrame.unionByName, parts)


def flattened(recs: DataFrame) -> DataFrame:
    """The report form: evidence joined into one cell."""
    return recs.select("position", "priority", "action", "do", "impact", F.concat_ws(" | ", "why").alias("evidence"))


def priority_counts(recs: DataFrame) -> DataFrame:
    return recs.groupBy("priority").agg(F.count("*").alias("recommendations"))
