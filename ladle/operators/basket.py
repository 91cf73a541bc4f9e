"""Market-basket rules over item pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.config import Config
from ladle.functions import scalars as S

BLOCK = 64  # items per side of one join block of a large basket


def baskets(lines: DataFrame, item: str = "item_id", distinct: bool = False) -> DataFrame:
    """Distinct items per order. Rows that are already one per order and item
    (``distinct=True``) need no shuffle for it."""
    picked = lines.select("order_id", F.col(item).alias("item"))
    return picked if distinct else picked.distinct()


def item_support(basket: DataFrame) -> DataFrame:
    return basket.groupBy("item").agg(F.count("*").alias("item_orders"))


def basket_count(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count("*").alias("baskets"))


def support_floors(cfg: Config) -> list[float]:
    """The support floors tried in turn: halved until the stop value is reached."""
    floors = [cfg.min_support]
    while floors[-1] > cfg.support_stop:
        floors.append(floors[-1] / 2)
    return floors


def frequent_baskets(basket: DataFrame, support: DataFrame, total: DataFrame, floor: float) -> DataFrame:
    """Keep items that reach the lowest floor. Loses no rule: a pair is never more
    frequent than its rarer item."""
    frequent = S.as_columns(support, total).filter(F.col("item_orders") / F.col("baskets") >= floor)
    return basket.join(frequent.select("item"), "item", "left_semi")


def pair_counts(basket: DataFrame) -> DataFrame:
    """Orders per item pair (a < b).

    The self-join runs on order and block: a basket of up to 64 items is one block, a
    larger one is cut into blocks by item hash and its block pairs are joined apart, so
    one huge order is shared by many tasks. Counts are combined before the last shuffle.
    """
    # after the distinct a window group holds at most one row per frequent item
    size = F.count("*").over(Window.partitionBy("order_id"))
    sized = basket.withColumn("__blocks", F.ceil(size / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("item"), F.col("__blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    left = sized.select("order_id", F.col("item").alias("a"), own.alias("bl"), others.alias("br"))
    right = sized.select("order_id", F.col("item").alias("b"), own.alias("br"), others.alias("bl"))
    return (
        left.join(right, ["order_id", "bl", "br"]).filter("a < b")
        .groupBy("a", "b").agg(F.count("*").alias("pair_orders"))
    )


def pair_metrics(pairs: DataFrame, support: DataFrame, total: DataFrame) -> DataFrame:
    """Support, confidence P(b|a) and lift, unrounded."""
    left = support.select(F.col("item").alias("a"), F.col("item_orders").alias("__na"))
    right = support.select(F.col("item").alias("b"), F.col("item_orders").alias("__nb"))
    joined = S.as_columns(pairs.join(left, "a").join(right, "b"), total)
    return joined.withColumns({
        "support": F.col("pair_orders") / F.col("baskets"),
        "confidence": F.col("pair_orders") / F.col("__na"),
    }).withColumn("lift", F.col("confidence") / (F.col("__nb") / F.col("baskets"))).select(
        "a", "b", "pair_orders", "support", "confidence", "lift")


def chosen_floor(metrics: DataFrame, cfg: Config) -> DataFrame:
    """First floor that yields enough rules, else the last; every floor is counted in one pass."""
    floors = support_floors(cfg)
    counts = metrics.agg(*[F.count_if(F.col("support") >= f).alias(f"n{i}") for i, f in enumerate(floors)])
    pick = F.lit(floors[-1])
    for i in range(len(floors) - 2, -1, -1):
        pick = F.when(F.col(f"n{i}") >= cfg.top_rules, F.lit(floors[i])).otherwise(pick)
    return counts.select(pick.alias("support_floor"))


def all_metrics(basket: DataFrame, orders: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Metrics of every pair that can reach the lowest support floor."""
    support = item_support(basket)
    total = basket_count(orders)
    kept = frequent_baskets(basket, support, total, support_floors(cfg)[-1])
    return pair_metrics(pair_counts(kept), support, total)


def rules(metrics: DataFrame, names: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Top rules by lift above the adaptive support floor. ``names`` has ``item, name``.

    ``metrics`` is read twice (floor, then rules), so pass a stored table for big data.
    """
    kept = S.as_columns(metrics, chosen_floor(metrics, cfg)).filter("support >= support_floor")
    left = names.select(F.col("item").alias("a_id"), F.col("name").alias("__a"))
    right = names.select(F.col("item").alias("b_id"), F.col("name").alias("__b"))
    top = (
        kept.select(
            F.col("a").alias("a_id"), F.col("b").alias("b_id"),
            S.half_even(F.col("support"), 4).alias("support"),
            S.half_even(F.col("confidence"), 3).alias("confidence"),
            S.half_even(F.col("lift"), 2).alias("lift"))
        .orderBy(F.desc("lift"), "a_id", "b_id").limit(cfg.top_rules)
    )
    return (
        top.join(left, "a_id", "left").join(right, "b_id", "left")
        .select("a_id", "b_id", F.coalesce("__a", "a_id").alias("a"), F.coalesce("__b", "b_id").alias("b"),
                "support", "confidence", "lift")
        .orderBy(F.desc("lift"), "a_id", "b_id")
    )


def bundles(rule_table: DataFrame, rows: int = 3) -> DataFrame:
    """Combo suggestions from the strongest rules, with their evidence as text."""
    best = rule_table.orderBy(F.desc("lift"), "a_id", "b_id").limit(rows)
    return best.select(
        F.concat(F.element_at(F.split("a", " "), 1), F.lit(" Combo")).alias("title"),
        F.concat_ws(" + ", "a", "b").alias("pair"),
        F.concat(S.fixed(F.col("confidence") * 100, 0), F.lit("% of "), F.col("a"), F.lit(" buyers add "),
                 F.col("b"), F.lit(" · lift "), S.fixed(F.col("lift"), 2), F.lit("×")).alias("evidence"),
        F.lit("+ AOV uplift").alias("impact"),
    )


def rule_headline(rule_table: DataFrame) -> DataFrame:
    return rule_table.agg(F.count("*").alias("rules_found"), F.max("lift").alias("strongest_lift"))
