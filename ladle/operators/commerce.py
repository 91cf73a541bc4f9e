"""Price sensitivity, promotion effectiveness, wastage and what-if scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle import config as C
from ladle.config import Config
from ladle.functions import scalars as S
from ladle.functions.dealing import dealt
from ladle.functions.ranking import first_per_group


# -- pricing ----------------------------------------------------------------
def weekly_demand(fact: DataFrame, by_iso_year: bool = False) -> DataFrame:
    """Quantity and mean price per item and ISO week.

    By default equal week numbers of different years fall together; ``by_iso_year``
    keeps them apart.
    """
    keys = [F.weekofyear("order_date").alias("week")]
    if by_iso_year:
        keys.insert(0, F.date_part(F.lit("YEAROFWEEK"), F.col("order_date")).cast("int").alias("iso_year"))
    return fact.groupBy("item_id", *keys).agg(
        F.sum("quantity").alias("qty"),
        S.ratio(F.sum("unit_price"), F.count("unit_price")).alias("price"))


def elasticity(fact: DataFrame, menu_items: DataFrame, cfg: Config = Config(), by_iso_year: bool = False) -> DataFrame:
    """Slope of log demand on log price per item, with a prior for few price points."""
    points = weekly_demand(fact, by_iso_year).filter("qty > 0 and price > 0")
    fitted = points.groupBy("item_id").agg(
        F.regr_slope(F.log("qty"), F.log("price")).alias("slope"), F.countDistinct("price").alias("prices"))
    observed = (F.col("prices") >= 3) & F.col("slope").isNotNull()
    value = F.when(observed, S.clip(F.col("slope"), cfg.elasticity_lo, cfg.elasticity_hi)).otherwise(
        cfg.elasticity_prior)
    return (
        fitted.withColumns({"raw": value, "basis": F.when(observed, "observed").otherwise("prior (few price points)")})
        .withColumn("sensitivity", sensitivity(F.col("raw"), cfg))
        .join(menu_items.select("item_id", "name", "category_id"), "item_id", "left")
        .select("item_id", "name", "category_id", F.round("raw", 2).alias("elasticity"), "sensitivity", "basis")
        .orderBy("elasticity", "item_id")
    )


def sensitivity(value: Column, cfg: Config = Config()) -> Column:
    return (
        F.when(value < cfg.high_sensitivity_cut, C.HIGH_SENSITIVITY)
        .when(value < cfg.moderate_sensitivity_cut, C.MODERATE_SENSITIVITY)
        .otherwise(C.LOW_SENSITIVITY)
    )


def sensitivity_counts(prices: DataFrame) -> DataFrame:
    return prices.groupBy("sensitivity").agg(F.count("*").alias("items"))


def most_priced_item(fact: DataFrame) -> DataFrame:
    counts = fact.groupBy("item_id").agg(F.countDistinct("unit_price").alias("prices"))
    return counts.orderBy(F.desc("prices"), "item_id").limit(1)


def price_demand_curve(fact: DataFrame, chosen: DataFrame) -> DataFrame:
    """Week points (price, demand) of the chosen items, cheapest first."""
    return (
        weekly_demand(fact.join(chosen.select("item_id"), "item_id", "left_semi"))
        .select("item_id", "week", S.half_even(F.col("price"), 2).alias("price"), "qty")
        .orderBy("item_id", "price", "week")
    )


# -- promotions -------------------------------------------------------------
# The note that goes with each verdict.
NOTE_COLLAPSE = "Margin collapses - discount is eating profitable items"
NOTE_BREAK_EVEN = "Promoted orders barely break even"
NOTE_GOOD = "Healthy margin held while driving volume"
NOTE_OK = "Works, but margin is on the thin side"


def verdict(gap: Column, margin: Column, share: Column, cfg: Config = Config()) -> tuple[Column, Column]:
    collapse, thin = gap <= cfg.trap_gap, margin < cfg.trap_margin
    good = (margin >= cfg.good_margin) & (share >= cfg.good_share)
    label = F.when(collapse | thin, "TRAP").when(good, "GOOD").otherwise("OK")
    note = F.when(collapse, NOTE_COLLAPSE).when(thin, NOTE_BREAK_EVEN).when(good, NOTE_GOOD).otherwise(NOTE_OK)
    return label, note


def promotion_effectiveness(fact: DataFrame, promotions: DataFrame, orders: DataFrame,
                            cfg: Config = Config()) -> DataFrame:
    """Order share, margin gap to the overall margin and order value of each used promotion."""
    lines = dealt(fact.filter("has_promo").select("promotion_id", "order_id", "revenue", "profit"), "order_id")
    used = lines.groupBy("promotion_id", "order_id").agg(
        F.sum("revenue").alias("rev"), F.sum("profit").alias("prof")).groupBy("promotion_id").agg(
        F.sum("rev").alias("rev"), F.sum("prof").alias("prof"), F.count("order_id").alias("n"))
    overall = orders.agg(F.count("*").alias("all_orders"), F.sum("revenue").alias("all_rev"),
                         F.sum("profit").alias("all_prof"))
    df = S.as_columns(used.join(promotions, "promotion_id"), overall)
    margin = S.ratio(F.col("prof"), F.col("rev"))
    df = df.withColumns({
        "margin": margin,
        "order_share_pct": S.half_even(S.ratio(F.col("n"), F.col("all_orders")) * 100, 1),
        "margin_gap": S.half_even((margin - S.ratio(F.col("all_prof"), F.col("all_rev"))) * 100, 1),
        "aov": S.half_even(S.ratio(F.col("rev"), F.col("n")), 2),
    })
    label, note = verdict(F.col("margin_gap"), F.col("margin"), F.col("order_share_pct"), cfg)
    return df.select(
        "promotion_id", F.col("name").alias("promotion"), "type", F.col("discount_pct").alias("discount"),
        "order_share_pct", "margin_gap", "aov", label.alias("verdict"), note.alias("note"))


def traps(effect: DataFrame) -> DataFrame:
    """Number of trap promotions and the first of them."""
    bad = F.col("verdict") == "TRAP"
    return effect.agg(
        F.count_if(bad).alias("traps"),
        F.min_by("promotion", F.when(bad, F.col("promotion_id"))).alias("first_trap"))


def promotion_repeat_and_waste(fact: DataFrame, menu: DataFrame) -> DataFrame:
    """Repeat rate of each promotion's buyers and waste of the items it sells.

    Repeat: share of buyers who used the promotion in more than one order. Waste: mean
    item waste percentage weighted by the promotion's quantity.
    """
    lines = fact.filter("has_promo")
    buyers = lines.filter(~F.col("is_guest")).groupBy("promotion_id", "customer_id").agg(
        F.countDistinct("order_id").alias("n"))
    repeat = buyers.groupBy("promotion_id").agg(
        F.round(F.avg((F.col("n") > 1).cast("int")) * 100, 4).alias("repeat_pct"))
    sold = lines.groupBy("promotion_id", "item_id").agg(F.sum("quantity").alias("qty"))
    waste = sold.join(menu.select("item_id", "wastage_pct"), "item_id").groupBy("promotion_id").agg(
        F.round(S.ratio(F.sum(F.col("qty") * F.col("wastage_pct")), F.sum("qty")), 4).alias("waste_pct"))
    return repeat.join(waste, "promotion_id")


# -- wastage ----------------------------------------------------------------
def waste_by_item(wastage: DataFrame, inventory: DataFrame, menu_items: DataFrame) -> DataFrame:
    wasted = wastage.groupBy("item_id").agg(
        F.sum("wasted_qty").alias("wasted"), F.sum("cost").cast(S.MONEY).alias("cost"))
    prepared = inventory.groupBy("item_id").agg(F.sum("prepared_qty").alias("prepared"))
    return (
        wasted.join(prepared, "item_id", "left")
        .join(menu_items.select("item_id", "name"), "item_id", "left")
        .withColumn("wastage_pct", S.half_even(S.ratio(F.col("wasted"), F.col("prepared")) * 100, 1))
        .select("item_id", "name", "wasted", "cost", "prepared", "wastage_pct")
        .orderBy(F.desc("wastage_pct"), "item_id")
    )


def over_preparation(inventory: DataFrame) -> DataFrame:
    """Mean over-preparation, mean preparation and spread of consumption per item and outlet."""
    g = inventory.groupBy("item_id", "location_id").agg(
        F.avg(F.col("prepared_qty") - F.col("consumed_qty")).alias("over"),
        F.avg("prepared_qty").alias("prepared"),
        F.stddev_samp("consumed_qty").alias("volatility"))
    return g.withColumn("over_ratio", S.ratio(F.col("over"), F.col("prepared"))).dropna()


def risk_level(over_ratio: Column) -> Column:
    return F.when(over_ratio > 0.3, "high").otherwise("med")


def risk_weekday(daily_inventory: DataFrame) -> DataFrame:
    """Weekday with the highest mean over-preparation per item and outlet; null where the stock is
    counted on one weekday only, as weekly counts say nothing about weekdays."""
    by_day = daily_inventory.groupBy("item_id", "location_id", S.dow(F.col("date")).alias("dow")).agg(
        F.avg(F.col("prepared_qty") - F.col("consumed_qty")).alias("over"))
    worst = F.max_by("dow", F.struct(F.col("over").alias("o"), (-F.col("dow")).alias("d")))
    days = by_day.agg(F.count_distinct("dow")).scalar()
    return by_day.groupBy("item_id", "location_id").agg(worst.alias("dow")).select(
        "item_id", "location_id", F.when(days > 1, S.label_of(F.col("dow"), C.WEEKDAYS)).alias("day"))


def waste_risk(inventory: DataFrame, daily_inventory: DataFrame, menu_items: DataFrame, locations: DataFrame,
               rows: int = 5) -> DataFrame:
    """The item-outlet pairs most likely to over-prepare next week."""
    top = over_preparation(inventory).orderBy(F.desc("over_ratio"), "item_id", "location_id").limit(rows)
    return (
        top.join(risk_weekday(daily_inventory), ["item_id", "location_id"], "left")
        .join(menu_items.select("item_id", F.col("name").alias("item")), "item_id", "left")
        .join(locations.select("location_id", F.col("name").alias("location")), "location_id", "left")
        .select("item_id", "location_id", "item", "location", "day", risk_level(F.col("over_ratio")).alias("risk"),
                F.round("over_ratio", 4).alias("over_ratio"))
    )


def waste_cost_rate(wastage: DataFrame, orders: DataFrame) -> DataFrame:
    """Total waste cost and its share of revenue."""
    cost = wastage.agg(F.coalesce(F.sum("cost"), F.lit(0)).cast(S.MONEY).alias("wastage_cost"))
    both = S.as_columns(cost, orders.agg(F.sum("revenue").alias("rev")))
    rate = S.half_even(S.ratio(F.col("wastage_cost"), F.col("rev")) * 100, 1)
    return both.select("wastage_cost", F.coalesce(rate, F.lit(0.0)).alias("wastage_rate"))


def waste_breakdown(wastage: DataFrame, menu_items: DataFrame) -> DataFrame:
    """Waste by category, by outlet and by weekday, in one table."""
    base = wastage.join(menu_items.select("item_id", "category_id"), "item_id", "left")

    def part(name: str, key: Column) -> DataFrame:
        return base.groupBy(key.cast("string").alias("key")).agg(
            F.sum("wasted_qty").alias("wasted"), F.sum("cost").cast(S.MONEY).alias("cost")
        ).select(F.lit(name).alias("breakdown"), "key", "wasted", "cost")

    day = S.label_of(S.dow(F.col("date")), C.WEEKDAYS)
    return (part("category", F.col("category_id"))
            .unionByName(part("location", F.col("location_id")))
            .unionByName(part("weekday", day)))


# -- what-if ----------------------------------------------------------------
def what_if(menu: DataFrame, scenarios: list[tuple[float, float, float, float]], weeks: Column) -> DataFrame:
    """Every item under every scenario ``(price %, discount %, prep %, promo %)``.

    Results are weekly. Demand falls 1.1 % per point of net price and gains 0.45 % per
    point of promotion push, never below a tenth of the base.
    """
    rows = F.array(*[
        F.struct(F.lit(n).alias("scenario"), F.lit(float(p)).alias("d_price"), F.lit(float(d)).alias("discount"),
                 F.lit(float(k)).alias("d_prep"), F.lit(float(m)).alias("promo"))
        for n, (p, d, k, m) in enumerate(scenarios, 1)])
    df = menu.select("item_id", "qty", F.col("base_price").cast("double").alias("p0"),
                     F.col("food_cost").cast("double").alias("c0"), "wastage_pct",
                     F.explode(rows).alias("s")).select("*", "s.*").drop("s")
    share = F.col("wastage_pct") / 100
    df = df.withColumn("q0", F.col("qty") / weeks)
    df = df.withColumns({
        "r0": F.col("q0") * F.col("p0"),
        "f0": F.col("q0") * (F.col("p0") - F.col("c0")),
        "w0": F.col("q0") * share * F.col("c0"),
        "price": F.col("p0") * (1 + F.col("d_price") / 100) * (1 - F.col("discount") / 100),
        "units": F.col("q0") * F.greatest(
            F.lit(0.1), 1 - 1.1 * (F.col("d_price") - F.col("discount")) / 100 + 0.45 * F.col("promo") / 100),
    })
    spare = F.greatest(F.lit(0.0), F.col("q0") * (1 + F.col("d_prep") / 100) - F.col("units"))
    df = df.withColumns({
        "revenue": F.col("units") * F.col("price"),
        "profit": F.col("units") * (F.col("price") - F.col("c0")),
        "waste": (spare + F.col("units") * share * 0.4) * F.col("c0"),
    })

    def change(new: str, old: str) -> Column:
        return F.coalesce(F.round(S.ratio(F.col(new) - F.col(old), F.col(old)) * 100, 4), F.lit(0.0))

    return df.select(
        "item_id", "scenario",
        F.round("units", 4).alias("units"), F.round("revenue", 4).alias("revenue"),
        F.round("profit", 4).alias("profit"), F.round("waste", 4).alias("waste"), F.round("price", 4).alias("price"),
        F.round(S.ratio(F.col("price") - F.col("c0"), F.col("price")) * 100, 4).alias("margin_pct"),
        change("revenue", "r0").alias("revenue_change"), change("profit", "f0").alias("profit_change"),
        change("units", "q0").alias("units_change"), change("waste", "w0").alias("waste_change"))


def first_trap(effect: DataFrame) -> DataFrame:
    return first_per_group(effect.filter("verdict = 'TRAP'"), ["verdict"], [F.asc("promotion_id")])
