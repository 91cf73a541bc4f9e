"""RFM inputs and scores, rule segments, cohorts and churn labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle import config as C
from ladle.config import Config
from ladle.functions import scalars as S
from ladle.functions.dealing import dealt
from ladle.functions.ranking import first_per_group
from ladle.functions.selection import keys_at_ranks, step_of


def customer_features(fact: DataFrame, orders: DataFrame, analysis_end: Column) -> DataFrame:
    """Recency, frequency, spend, categories, promotion share and order value per customer.

    Recency counts whole days back from midnight of the end date, so a later order on
    that day gives -1.
    """
    known = orders.filter(~F.col("is_guest"))
    base = known.groupBy("customer_id").agg(
        F.max("order_ts").alias("last_ts"),
        F.count("*").alias("frequency"),
        F.sum("revenue").cast(S.MONEY).alias("monetary"),
        F.sum("promo_lines").alias("__promo"),
        F.sum("lines").alias("__lines"),
    )
    bought = dealt(fact.filter(~F.col("is_guest")).select("customer_id", "category_id"), "customer_id")
    tastes = bought.groupBy("customer_id").agg(F.countDistinct("category_id").alias("categories"))
    seconds = F.unix_timestamp(analysis_end.cast("timestamp")) - F.unix_timestamp("last_ts")
    return base.join(tastes, "customer_id").select(
        "customer_id",
        F.floor(seconds / 86400).cast("int").alias("recency"),
        "frequency",
        "monetary",
        "categories",
        S.half_even(S.ratio(F.col("__promo"), F.col("__lines")) * 100, 0).alias("promo_share"),
        S.half_even(S.ratio(F.col("monetary"), F.col("frequency")), 2).alias("avg_order_value"),
    )


def rfm_scores(customers: DataFrame) -> DataFrame:
    """Scores 1..5 for recency (reversed), frequency and spend: quintiles of the rank by (measure, id).

    Only the four edges of each measure are searched for; rows then compare themselves with them, so no row is ranked
    and nothing is shuffled for the scores.
    """
    rows = customers.count()
    ranks = [j * (rows - 1) // 5 + 1 for j in range(1, 5)]

    def quintile_of(measure: str) -> Column:
        key = F.struct(F.col(measure).alias("value"), F.col("customer_id").alias("id"))
        edges = keys_at_ranks(customers, key, ranks) if rows else []
        return step_of(key, edges, customers.select(key.alias("k")).schema["k"].dataType) + 1

    scored = customers.withColumns({"R": F.lit(6) - quintile_of("recency"), "F": quintile_of("frequency"), "M": quintile_of("monetary")})
    mean = (F.col("R") + F.col("F") + F.col("M")) / 3
    return scored.withColumn("rfm_score", F.round(mean).cast("int")).select(
        *customers.columns, "R", "F", "M", "rfm_score")


def score_distribution(scored: DataFrame) -> DataFrame:
    """Customers per combined score; scores 1..5 are all present."""
    counts = scored.agg(*[F.count_if(F.col("rfm_score") == s).alias(f"s{s}") for s in range(1, 6)])
    rows = F.array(*[F.struct(F.lit(s).alias("score"), F.col(f"s{s}").alias("customers")) for s in range(1, 6)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def segment_rule(recency, frequency, monetary, promo, means: dict[str, Column], rich: Column) -> Column:
    """Name of one profile (a customer or a cluster) relative to the mean profile."""
    return (
        F.when((recency > means["recency"] * 1.5) & (frequency < means["frequency"]), "At-Risk")
        .when(rich, "High-Value Loyal")
        .when(promo > means["promo"] * 1.25, "Promotion-Driven")
        .when(frequency > means["frequency"], "Frequent")
        .when(recency < means["recency"] * 0.6, "New")
        .otherwise("Occasional")
    )


def rule_segments(customers: DataFrame, rich_factor: float = 1.5) -> DataFrame:
    """Segment by rules alone: the cluster-naming thresholds applied to each customer."""
    means = customers.agg(
        F.avg("recency").alias("__r"), F.avg("frequency").alias("__f"),
        F.avg(F.col("monetary").cast("double")).alias("__m"), F.avg("promo_share").alias("__p"))
    df = S.as_columns(customers, means)
    name = segment_rule(
        F.col("recency"), F.col("frequency"), F.col("monetary"), F.col("promo_share"),
        {"recency": F.col("__r"), "frequency": F.col("__f"), "promo": F.col("__p")},
        F.col("monetary").cast("double") > F.col("__m") * rich_factor)
    return df.withColumn("segment", name).select(*customers.columns, "segment")


def top_channel(segments: DataFrame, orders: DataFrame) -> DataFrame:
    """Most used ordering channel per segment."""
    used = (
        orders.filter(~F.col("is_guest")).select("customer_id", "channel")
        .join(segments.select("customer_id", "segment"), "customer_id")
        .groupBy("segment", "channel").agg(F.count("*").alias("orders"))
    )
    return first_per_group(used, ["segment"], [F.desc("orders"), F.asc("channel")])


def segment_profile(segments: DataFrame, orders: DataFrame, churn: DataFrame | None = None) -> DataFrame:
    """One row per segment in a fixed order, with its channel and a suggested play.

    Without churn scores the churn figure is the segment's mean recency relative to the
    longest recency, in percent, kept between 3 and 88.
    """
    df = segments
    if churn is not None:
        df = df.join(churn.select("customer_id", "churn_prob"), "customer_id", "left")
        churn_pct = F.bround(F.avg("churn_prob") * 100, 0).cast("int")
    else:
        df = S.as_columns(df, segments.agg(F.greatest(F.lit(1), F.max("recency")).alias("__longest")))
        churn_pct = S.clip(F.avg("recency") / F.max("__longest") * 100, 3.0, 88.0).cast("int")
    profile = df.groupBy("segment").agg(
        F.count("*").alias("customers"),
        F.avg("recency").cast("int").alias("recency"),
        S.half_even(F.avg("frequency"), 1).alias("frequency"),
        F.floor(F.avg(F.col("monetary").cast("double"))).alias("monetary"),
        S.half_even(F.avg("avg_order_value"), 2).alias("aov"),
        S.half_even(F.avg("categories"), 1).alias("categories"),
        F.bround(F.avg("promo_share"), 0).cast("int").alias("promo_share"),
        churn_pct.alias("churn_pct"),
    )
    names = F.array(*[F.lit(s) for s in C.SEGMENTS])
    plays = F.create_map(*[F.lit(x) for pair in C.SEGMENT_PLAYS.items() for x in pair])
    return (
        profile.join(top_channel(segments, orders).select("segment", "channel"), "segment", "left")
        .withColumns({"position": F.array_position(names, F.col("segment")).cast("int"),
                      "play": F.coalesce(plays[F.col("segment")], F.lit("Engage"))})
        .orderBy("position")
    )


def activity(orders: DataFrame) -> DataFrame:
    """Active customers and the share of them with more than one order."""
    per = orders.filter(~F.col("is_guest")).groupBy("customer_id").agg(F.count("*").alias("n"))
    return per.agg(
        F.count("*").alias("active_customers"),
        S.half_even(F.coalesce(F.avg((F.col("n") > 1).cast("int")) * 100, F.lit(0.0)), 1).alias("repeat_rate"))


def new_vs_returning(orders: DataFrame, weeks: int | None = 12) -> DataFrame:
    """Customers per week, split by whether their first order falls in that week; all weeks for ``None``.

    After the distinct a customer has one row per active week, which bounds the window.
    """
    seen = orders.filter(~F.col("is_guest")).select(
        "customer_id", S.week_start(F.col("order_date")).alias("week")).distinct()
    first = F.min("week").over(Window.partitionBy("customer_id"))
    per_week = seen.withColumn("is_new", F.col("week") == first).groupBy("week").agg(
        F.count_if("is_new").alias("new"), F.count_if(~F.col("is_new")).alias("returning"))
    label = F.concat_ws("/", F.col("week").cast("string"), F.date_add("week", 6).cast("string"))
    last = per_week if weeks is None else per_week.orderBy(F.desc("week")).limit(weeks)
    return last.withColumn("label", label).orderBy("week")


def churn_labels(customers: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Churned = recency beyond the configured quantile (linear interpolation).

    The exact percentile counts distinct day values, so its state is bounded by the
    calendar and not by the number of customers.
    """
    cut = customers.agg(F.percentile("recency", F.lit(cfg.churn_quantile)).alias("recency_cut"))
    return S.as_columns(customers, cut).withColumn("churned", (F.col("recency") > F.col("recency_cut")).cast("int"))


def risk_bands(scored: DataFrame, cfg: Config = Config()) -> DataFrame:
    return scored.withColumn(
        "risk_band", S.band(F.col("churn_prob"), [cfg.low_risk, cfg.medium_risk], ["Low", "Medium", "High"]))


def churn_report(scored: DataFrame, cfg: Config = Config()) -> DataFrame:
    """The customers most at risk (a fixed-length report)."""
    return scored.orderBy(F.desc("churn_prob"), "customer_id").limit(cfg.churn_report_rows).select(
        "customer_id", "recency", "frequency", "monetary", S.half_even(F.col("churn_prob"), 3).alias("churn_prob"),
        "risk_band")
