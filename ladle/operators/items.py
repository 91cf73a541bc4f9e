"""Item economics, four-quadrant classification menu-wide and per outlet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle import config as C
from ladle.config import Config
from ladle.functions import scalars as S
from ladle.functions.dealing import dealt


def economics(order_items: DataFrame) -> DataFrame:
    """Volume and money per item, with margin and promotion dependency.

    ``order_items`` has one row per order and item (``fact.order_item_facts``).
    """
    return order_items.groupBy("item_id").agg(
        F.sum("quantity").alias("qty"),
        F.sum("revenue").cast(S.MONEY).alias("revenue"),
        F.sum("cost").cast(S.MONEY).alias("cost"),
        F.sum("profit").cast(S.MONEY).alias("profit"),
        F.count("*").alias("orders"),
        F.sum("promo_lines").alias("promo_lines"),
        F.sum("lines").alias("lines"),
    ).withColumns({
        "margin": S.ratio(F.col("revenue") - F.col("cost"), F.col("revenue")),
        "promo_dependency": S.half_even(S.ratio(F.col("promo_lines"), F.col("lines")) * 100, 1),
    })


def rating_summary(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item_id").agg(
        S.half_even(F.avg("stars"), 2).alias("rating"), F.count("stars").alias("rating_count"))


def waste_summary(inventory: DataFrame, wastage: DataFrame, keys: list[str]) -> DataFrame:
    """Prepared, consumed and wasted quantity; each side is aggregated before the join."""
    stock = inventory.groupBy(*keys).agg(
        F.sum("prepared_qty").alias("prepared"), F.sum("consumed_qty").alias("consumed"))
    waste = wastage.groupBy(*keys).agg(F.sum("wasted_qty").alias("wasted"))
    return stock.join(waste, keys, "left")


def item_waste(inventory: DataFrame, wastage: DataFrame) -> DataFrame:
    return waste_summary(inventory, wastage, ["item_id"]).withColumn(
        "wastage_pct", S.half_even(S.ratio(F.col("wasted"), F.col("prepared")) * 100, 1))


def repeat_share(order_items: DataFrame) -> DataFrame:
    """Share of an item's buyers with more than one order of it; all guests are one buyer."""
    sold = dealt(order_items.select("item_id", "customer_id"), "item_id", "customer_id")
    buyers = sold.groupBy("item_id", "customer_id").agg(F.count("*").alias("n"))
    return buyers.groupBy("item_id").agg(
        S.half_even(F.avg((F.col("n") > 1).cast("int")) * 100, 0).alias("repeat_pct"))


def trend(order_items: DataFrame) -> DataFrame:
    """Change of quantity from the first to the last third of the date window, in percent."""
    daily = order_items.groupBy("item_id", "order_date").agg(F.sum("quantity").alias("q"))
    span = order_items.agg(F.min("order_date").alias("d0"), F.max("order_date").alias("d1"))
    dated = S.as_columns(daily, span)
    days = F.date_diff("d1", "d0")
    early = F.date_diff("order_date", "d0") * 3 <= days
    late = F.date_diff("d1", "order_date") * 3 < days
    sums = dated.groupBy("item_id").agg(
        F.sum(F.when(early, F.col("q"))).alias("early"), F.sum(F.when(late, F.col("q"))).alias("late"))
    return sums.withColumn(
        "trend", S.half_even(S.ratio(F.col("late") - F.col("early"), F.col("early")) * 100, 0))


def item_features(order_items: DataFrame, ratings: DataFrame, wastage: DataFrame, inventory: DataFrame,
                  menu_items: DataFrame, cfg: Config = Config()) -> DataFrame:
    """All item-level features, one row per sold item."""
    parts = [
        rating_summary(ratings),
        item_waste(inventory, wastage),
        repeat_share(order_items),
        trend(order_items).select("item_id", "trend"),
        menu_items.select("item_id", "name", "category_id", "base_price", "food_cost"),
    ]
    joined = reduce(lambda a, b: a.join(b, "item_id", "left"), parts, economics(order_items))
    return joined.fillna({
        "rating": cfg.default_rating, "rating_count": 0, "wastage_pct": 0.0,
        "repeat_pct": 0.0, "trend": 0.0, "promo_dependency": 0.0})


def profit_penalty(waste_pct: Column, rating: Column, cfg: Config) -> tuple[Column, Column]:
    weak = F.when(rating < cfg.rating_floor, cfg.rating_penalty).otherwise(0.0)
    return (waste_pct / 100) * cfg.waste_weight, weak


def quadrant(demand: Column, profit: Column, cfg: Config) -> Column:
    high_demand = demand >= cfg.demand_cut
    high_profit = profit >= cfg.profit_cut
    return (
        F.when(high_demand & high_profit, C.PROFIT_DRIVER)
        .when(high_demand, C.VOLUME_DRIVER)
        .when(high_profit, C.HIDDEN_OPPORTUNITY)
        .otherwise(C.LOW_PERFORMER)
    )


def classify(features: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Demand and profit scores relative to the whole menu, class and slow-mover flag."""
    bounds = features.agg(F.min("qty").alias("q0"), F.max("qty").alias("q1"),
                          F.min("margin").alias("m0"), F.max("margin").alias("m1"))
    scored = S.as_columns(features, bounds)
    demand = S.minmax(F.col("qty"), F.col("q0"), F.col("q1"))
    waste, weak = profit_penalty(F.col("wastage_pct"), F.col("rating"), cfg)
    profit = S.minmax(F.col("margin"), F.col("m0"), F.col("m1")) - waste - weak
    slow = (F.col("demand_score") < cfg.slow_demand) & (
        (F.col("wastage_pct") > cfg.slow_waste_pct) | (F.col("trend") < 0))
    return (
        scored.withColumns({"demand_score": demand, "profit_score": profit})
        .withColumn("menu_class", quadrant(F.col("demand_score"), F.col("profit_score"), cfg))
        .withColumn("slow_mover", slow)
        .drop("q0", "q1", "m0", "m1")
    )


def class_counts(classified: DataFrame, column: str = "menu_class") -> DataFrame:
    """Items per class; all four classes are present."""
    counted = classified.agg(*[F.count_if(F.col(column) == k).alias(k) for k in C.CLASSES])
    rows = F.array(*[F.struct(F.lit(k).alias("menu_class"), F.col(f"`{k}`").alias("items")) for k in C.CLASSES])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def profitability(classified: DataFrame, categories: DataFrame) -> DataFrame:
    names = categories.select("category_id", F.col("category_name").alias("category"))
    return (
        classified.join(names, "category_id", "left")
        .select("item_id", "name", "category", "qty", "revenue", "cost", "profit", "wastage_pct", "menu_class",
                S.half_even(F.col("margin") * 100, 1).alias("margin_pct"))
        .orderBy(F.desc("profit"), "item_id")
    )


# -- item x outlet cells ----------------------------------------------------
def cell_economics(order_items: DataFrame) -> DataFrame:
    return order_items.groupBy("item_id", "location_id").agg(
        F.sum("quantity").alias("qty"),
        F.sum("revenue").cast(S.MONEY).alias("revenue"),
        F.sum("profit").cast(S.MONEY).alias("profit"),
        F.sum("lines").alias("lines"),
        F.sum("promo_lines").alias("promo_lines"),
    ).withColumns({
        "margin": S.ratio(F.col("profit"), F.col("revenue")),
        "promo_dep": S.ratio(F.col("promo_lines"), F.col("lines")) * 100,
    })


def cell_waste(inventory: DataFrame, wastage: DataFrame) -> DataFrame:
    summed = waste_summary(inventory, wastage, ["item_id", "location_id"])
    share = S.ratio(F.coalesce(F.col("wasted"), F.lit(0)), F.col("prepared")) * 100
    return summed.withColumn("wastage", F.coalesce(share, F.lit(0.0))).select(
        "item_id", "location_id", "prepared", "wasted", "wastage")


def local_classes(cells: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Scores and class within each outlet.

    Window groups hold the aggregated cells of one outlet, so their size is bounded by
    the number of menu items, not by the number of transactions.
    """
    here = Window.partitionBy("location_id")
    demand = S.minmax(F.col("qty"), F.min("qty").over(here), F.max("qty").over(here))
    base = S.minmax(F.col("margin"), F.min("margin").over(here), F.max("margin").over(here))
    waste, weak = profit_penalty(F.col("wastage"), F.col("rating"), cfg)
    return (
        cells.withColumns({"local_demand": demand, "__base": base})
        .withColumn("local_profit", F.col("__base") - waste - weak)
        .withColumn("local_class", quadrant(F.col("local_demand"), F.col("local_profit"), cfg))
        .drop("__base")
    )


MODEL_FEATURES = ["qty", "revenue", "margin", "rating", "repeat", "wastage", "promo_dep", "trend"]


def model_samples(order_items: DataFrame, menu: DataFrame, inventory: DataFrame, wastage: DataFrame,
                  cfg: Config = Config()) -> DataFrame:
    """One row per item and outlet with the model features and the local class."""
    item_level = menu.select("item_id", "name", "rating", F.col("repeat_pct").alias("repeat"), "trend")
    cells = (
        cell_economics(order_items)
        .join(cell_waste(inventory, wastage), ["item_id", "location_id"], "left")
        .fillna({"wastage": 0.0})
        .join(item_level, "item_id", "left")
    )
    return local_classes(cells, cfg).dropna(subset=MODEL_FEATURES + ["local_class"])


# -- selections over the classified menu -----------------------------------
def tricky_cases(menu: DataFrame, rating_floor: float = 4.4) -> DataFrame:
    """Five items worth a second look, found in one pass over the menu."""
    def top(case: str, sort: Column, where: Column | None = None) -> Column:
        # among equal sort values the smallest item_id wins: min_by on (-sort, id)
        key = F.struct((-sort.cast("double")).alias("v"), F.col("item_id").alias("i"))
        if where is not None:
            key = F.when(where, key)
        best = F.min_by(F.struct("item_id", "name", sort.cast("double").alias("value")), key)
        return best.alias(case)

    is_class = lambda k: F.col("menu_class") == k
    picked = menu.agg(
        top("top_volume_driver", F.col("qty"), is_class(C.VOLUME_DRIVER)),
        top("top_volume_any", F.col("qty")),
        top("best_hidden", F.col("margin"), is_class(C.HIDDEN_OPPORTUNITY)),
        top("most_wasted", F.col("wastage_pct")),
        top("most_promoted", F.col("promo_dependency")),
        top("rated_but_thin", -F.col("margin"), F.col("rating") >= rating_floor),
    )
    cases = {
        "high volume, thin margin": F.coalesce("top_volume_driver", "top_volume_any"),
        "great margin, low visibility": F.col("best_hidden"),
        "excessive wastage": F.col("most_wasted"),
        "leans on promotions": F.col("most_promoted"),
        "highly rated, weak profit": F.col("rated_but_thin"),
    }
    rows = F.array(*[
        F.struct(F.lit(n).alias("case_no"), F.lit(name).alias("case_name"), pick.alias("pick"))
        for n, (name, pick) in enumerate(cases.items(), 1)])
    return picked.select(F.explode(rows).alias("r")).filter("r.pick is not null").select(
        "r.case_no", "r.case_name", "r.pick.item_id", "r.pick.name")


def redesign_candidates(menu: DataFrame, rows: int = 4) -> DataFrame:
    """Slow movers and low performers, best sellers among them first."""
    weak = F.col("slow_mover") | (F.col("menu_class") == C.LOW_PERFORMER)
    return menu.filter(weak).orderBy(F.desc("revenue"), "item_id").limit(rows).select(
        "item_id", "name", "menu_class", "slow_mover", "revenue")


def top_items(menu: DataFrame, rows: int, menu_class: str | None = None) -> DataFrame:
    chosen = menu if menu_class is None else menu.filter(F.col("menu_class") == menu_class)
    return chosen.orderBy(F.desc("revenue"), "item_id").limit(rows).select(
        "item_id", "name", "menu_class", "revenue")


def extremes(menu: DataFrame) -> DataFrame:
    """Lowest and highest item per measure (sales, profit, margin, rating)."""
    def pick(measure: str, side: str) -> Column:
        sort = F.col(measure).cast("double")
        key = F.struct((-sort if side == "highest" else sort).alias("v"), F.col("item_id").alias("i"))
        return F.struct(F.lit(measure).alias("measure"), F.lit(side).alias("side"),
                        F.min_by("item_id", key).alias("item_id"))

    picks = [pick(m, s) for m in ("qty", "profit", "margin", "rating") for s in ("lowest", "highest")]
    return menu.agg(F.array(*picks).alias("a")).select(F.explode("a").alias("r")).select("r.*")
