"""Daily series, peaks and the trend-plus-weekday forecast.

A series holds one row per calendar day and group, so window groups here are bounded
by the length of the calendar, however many transactions stand behind a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle import config as C
from ladle.config import Config
from ladle.functions import scalars as S
from ladle.functions.ranking import first_per_group

ALL = "series"  # constant group key of an ungrouped series


def daily(orders: DataFrame) -> DataFrame:
    """Revenue, profit and orders per day."""
    return orders.groupBy(F.col("order_date").alias("date")).agg(
        F.sum("revenue").cast(S.MONEY).alias("revenue"),
        F.sum("profit").cast(S.MONEY).alias("profit"),
        F.count("*").alias("orders"))


def waste_by_date(wastage: DataFrame) -> DataFrame:
    return wastage.groupBy("date").agg(F.sum("cost").cast(S.MONEY).alias("waste")).orderBy("date")


def _grouped(series: DataFrame, group: str | None) -> tuple[DataFrame, str]:
    if group is None:
        return series.withColumn(ALL, F.lit("all")), ALL
    return series, group


def half_deltas(series: DataFrame, values: list[str]) -> DataFrame:
    """Percent change of the second half of a series over the first, per value column."""
    df, g = _grouped(series, None)
    w = Window.partitionBy(g)
    placed = df.withColumns({"__rn": F.row_number().over(w.orderBy("date")), "__n": F.count("*").over(w)})
    first = F.col("__rn") <= F.floor(F.col("__n") / 2)
    sums = placed.agg(*[F.sum(F.when(first, F.col(v))).alias(f"{v}_prev") for v in values],
                      *[F.sum(F.when(~first, F.col(v))).alias(f"{v}_cur") for v in values])

    def delta(v: str):
        change = S.ratio(F.col(f"{v}_cur") - F.col(f"{v}_prev"), F.col(f"{v}_prev")) * 100
        return F.coalesce(F.bround(change, 0), F.lit(0.0)).cast("long").alias(f"{v}_delta")

    return sums.select(*[delta(v) for v in values])


def moving_average(series: DataFrame, value: str, days: int = 7) -> DataFrame:
    df, g = _grouped(series, None)
    frame = Window.partitionBy(g).orderBy("date").rowsBetween(1 - days, 0)
    return df.select("date", value, F.round(F.avg(F.col(value).cast("double")).over(frame), 4).alias("moving_avg"))


# -- peaks ------------------------------------------------------------------
def monthly(orders: DataFrame) -> DataFrame:
    return orders.groupBy(S.month_label(F.col("order_date")).alias("month")).agg(
        F.count("*").alias("orders")).orderBy("month")


def weekday_weekend(orders: DataFrame) -> DataFrame:
    weekend = S.is_sat_sun(F.col("order_date"))
    return orders.agg(F.count_if(~weekend).alias("weekday"), F.count_if(weekend).alias("weekend"))


def fri_sun_share(series: DataFrame) -> DataFrame:
    late = F.sum(F.when(S.is_fri_sun(F.col("date")), F.col("revenue")))
    share = F.coalesce(S.ratio(late, F.sum("revenue")) * 100, F.lit(0.0))
    return series.agg(F.bround(share, 0).cast("long").alias("fri_sun_share_pct"))


def busiest_day(orders: DataFrame, date: str = "order_date") -> DataFrame:
    counts = orders.groupBy(S.dow(F.col(date)).alias("dow")).agg(F.count("*").alias("orders"))
    return counts.orderBy(F.desc("orders"), "dow").limit(1).select(
        S.label_of(F.col("dow"), C.WEEKDAYS).alias("busiest_dow"), "orders")


def busiest_hour(orders: DataFrame, ts: str) -> DataFrame:
    counts = orders.groupBy(F.hour(ts).alias("busiest_hour")).agg(F.count("*").alias("orders"))
    return counts.orderBy(F.desc("orders"), "busiest_hour").limit(1)


def outlet_peaks(orders: DataFrame, ts: str) -> DataFrame:
    """Peak day, peak hour and order count per outlet, from one pass over the orders.

    Orders shrink to outlet x weekday x hour counts first (at most 168 rows an outlet).
    """
    cube = orders.groupBy("location_id", S.dow(F.col(ts)).alias("dow"), F.hour(ts).alias("hour")).agg(
        F.count("*").alias("n"))
    days = first_per_group(cube.groupBy("location_id", "dow").agg(F.sum("n").alias("n")),
                           ["location_id"], [F.desc("n"), F.asc("dow")])
    hours = first_per_group(cube.groupBy("location_id", "hour").agg(F.sum("n").alias("n")),
                            ["location_id"], [F.desc("n"), F.asc("hour")])
    totals = cube.groupBy("location_id").agg(F.sum("n").alias("orders"))
    return (
        totals.join(days.select("location_id", S.label_of(F.col("dow"), C.WEEKDAYS).alias("peak_day")), "location_id")
        .join(hours.select("location_id", F.col("hour").alias("peak_hour")), "location_id")
        .orderBy(F.desc("orders"), "location_id")
    )


def heatmap(orders: DataFrame, ts: str) -> DataFrame:
    """Orders per weekday and hour mark; all 7 x 8 cells are present."""
    counts = orders.groupBy(
        S.dow(F.col(ts)).alias("dow"), S.hour_bucket(F.hour(ts)).alias("bucket")).agg(F.count("*").alias("n"))
    seed = orders.sparkSession.range(7).select(F.col("id").cast("int").alias("dow"))
    grid = S.with_domain(seed, "bucket", range(len(C.HOUR_BUCKETS)), "int")
    return grid.join(counts, ["dow", "bucket"], "left").select(
        "dow", "bucket",
        S.label_of(F.col("dow"), C.WEEKDAYS).alias("day"),
        S.label_of(F.col("bucket"), C.HOUR_BUCKETS).alias("hour_mark"),
        F.coalesce("n", F.lit(0)).alias("orders"))


# -- forecast ---------------------------------------------------------------
def numbered(series: DataFrame, group: str) -> DataFrame:
    """Position ``t`` (0-based, by date; gaps in the calendar are ignored) and length ``n``."""
    w = Window.partitionBy(group)
    return series.withColumns({
        "t": (F.row_number().over(w.orderBy("date")) - 1).cast("int"),
        "n": F.count("*").over(w).cast("int")})


def fit(train: DataFrame, group: str, value: str = "orders") -> DataFrame:
    """Linear trend over ``t`` plus the mean residual per weekday, one row per group."""
    w = Window.partitionBy(group)
    y = F.col(value).cast("double")
    t = F.col("t").cast("double")
    lined = train.withColumns({"slope": F.regr_slope(y, t).over(w), "intercept": F.regr_intercept(y, t).over(w)})
    residual = F.col(value) - (F.col("intercept") + F.col("slope") * F.col("t"))
    by_day = lined.groupBy(group, S.dow(F.col("date")).alias("dow")).agg(
        F.avg(residual).alias("season"), F.first("slope").alias("slope"), F.first("intercept").alias("intercept"),
        F.count("*").alias("days"), F.max("date").alias("last_date"))
    # at most seven entries per group
    season = F.map_from_entries(F.collect_list(F.struct("dow", "season")))
    return by_day.groupBy(group).agg(
        F.first("slope").alias("slope"), F.first("intercept").alias("intercept"), season.alias("season"),
        F.sum("days").cast("int").alias("train_n"), F.max("last_date").alias("last_date"))


def predicted(t, date):
    """Model value at position ``t`` on ``date``, never below zero."""
    shift = F.coalesce(F.try_element_at("season", S.dow(date)), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.col("intercept") + F.col("slope") * t + shift)


def project(model: DataFrame, horizon: int) -> DataFrame:
    """Future dates after the last observed one with their predicted value."""
    steps = model.select("*", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))).alias("step"))
    dated = steps.withColumn("date", F.date_add("last_date", F.col("step") + 1))
    return dated.withColumn("predicted", predicted(F.col("train_n") + F.col("step"), F.col("date")))


def holdout_predictions(series: DataFrame, cfg: Config = Config()) -> DataFrame:
    """The last days of the series, predicted by a model that has not seen them."""
    df, g = _grouped(series.select("date", "orders"), None)
    placed = numbered(df, g)
    tail = F.col("t") >= F.col("n") - cfg.holdout
    train = placed.filter(~tail)
    model = fit(train, g).select("slope", "intercept", "season")
    test = S.as_columns(placed.filter(tail), model)
    test = S.as_columns(test, train.agg(F.avg("orders").alias("flat_mean")))
    return test.select("date", "t", "n", F.col("orders").alias("actual"),
                       predicted(F.col("t"), F.col("date")).alias("predicted"), "flat_mean")


def holdout_table(series: DataFrame, cfg: Config = Config(), flag_share: float = 0.12) -> DataFrame:
    """Actual against predicted per held-out day, whole orders, large errors flagged."""
    p = holdout_predictions(series, cfg).withColumn("predicted", F.bround("predicted", 0).cast("long"))
    error = F.col("actual") - F.col("predicted")
    return p.select(
        "date", F.concat(F.lit("D-"), (F.col("n") - F.col("t")).cast("string")).alias("day"), "actual", "predicted",
        error.alias("error"), (F.abs(error) > F.col("actual") * flag_share).alias("flagged"))


def holdout_metrics(series: DataFrame, cfg: Config = Config()) -> DataFrame:
    """MAE, RMSE, MAPE and R2 of the held-out days, and the flat-mean baseline."""
    p = holdout_predictions(series, cfg)
    err = F.col("actual") - F.col("predicted")
    raw = p.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.avg(S.ratio(F.abs(err), F.col("actual"))) * 100).alias("mape"),
        F.sum(err * err).alias("res"),
        (F.var_pop("actual") * F.count("*")).alias("tot"),
        (F.avg(S.ratio(F.abs(F.col("actual") - F.col("flat_mean")), F.col("actual"))) * 100).alias("flat"))
    return raw.select(
        S.half_even(F.col("mae"), 1).alias("mae"), S.half_even(F.col("rmse"), 1).alias("rmse"),
        S.half_even(F.col("mape"), 1).alias("mape"),
        S.half_even(F.when(F.col("tot") > 0, 1 - S.ratio(F.col("res"), F.col("tot"))).otherwise(0.0), 3).alias("r2"),
        S.half_even(F.col("flat"), 1).alias("baseline_mape"),
        S.half_even(S.ratio(F.col("flat") - F.col("mape"), F.col("flat")) * 100, 1).alias("improvement"))


def forecast(series: DataFrame, cfg: Config = Config()) -> DataFrame:
    """The next days with a band that widens with the step; all whole orders."""
    p = holdout_predictions(series, cfg)
    err = F.col("actual") - F.col("predicted")
    rmse = p.agg(F.sqrt(F.avg(err * err)).alias("rmse"))
    df, g = _grouped(series.select("date", "orders"), None)
    future = S.as_columns(project(fit(numbered(df, g), g), cfg.horizon).select("date", "step", "predicted"), rmse)
    half = F.col("rmse") * (1 + F.col("step") * cfg.band_growth) * cfg.band_sigmas
    return future.select(
        "date", F.bround("predicted", 0).cast("long").alias("orders"),
        F.greatest(F.lit(0), F.bround(F.col("predicted") - half, 0).cast("long")).alias("lo"),
        F.bround(F.col("predicted") + half, 0).cast("long").alias("hi"))


def forecast_report(series: DataFrame, cfg: Config = Config()) -> DataFrame:
    """History and forecast in one table."""
    history = series.select("date", F.lit("actual").alias("type"), "orders")
    ahead = forecast(series, cfg).withColumn("type", F.lit("forecast"))
    return history.unionByName(ahead, allowMissingColumns=True).select("date", "type", "orders", "lo", "hi")


def forecast_total(series: DataFrame, cfg: Config = Config()) -> DataFrame:
    return forecast(series, cfg).agg(F.sum("orders").alias("forecast_orders"))


def widest_bands(series: DataFrame, rows: int = 3, cfg: Config = Config()) -> DataFrame:
    return forecast(series, cfg).orderBy(F.desc(F.col("hi") - F.col("lo")), "date").limit(rows)


def group_forecasts(series: DataFrame, group: str, cfg: Config = Config()) -> DataFrame:
    """Next window against the last one for every group, all groups in one job.

    Groups with no more than ``horizon + 5`` days are left out.
    """
    placed = numbered(series, group).filter(F.col("n") > cfg.horizon + 5)
    ahead = project(fit(placed, group), cfg.horizon).groupBy(group).agg(F.sum("predicted").alias("ahead"))
    recent = placed.groupBy(group).agg(
        F.sum(F.when(F.col("t") >= F.col("n") - cfg.horizon, F.col("orders"))).alias("last"))
    change = F.coalesce(S.ratio(F.col("ahead") - F.col("last"), F.col("last")) * 100, F.lit(0.0))
    return ahead.join(recent, group).select(
        group, F.bround("ahead", 0).cast("long").alias("next"), F.col("last"),
        S.half_even(change, 1).alias("change_pct")).orderBy(F.desc("next"), group)


def daily_by_outlet(orders: DataFrame) -> DataFrame:
    """Revenue, profit and orders per outlet and day."""
    return orders.groupBy("location_id", F.col("order_date").alias("date")).agg(
        F.sum("revenue").cast(S.MONEY).alias("revenue"),
        F.sum("profit").cast(S.MONEY).alias("profit"),
        F.count("*").alias("orders"))


def daily_by_category(fact: DataFrame) -> DataFrame:
    return fact.groupBy("category_id", F.col("order_date").alias("date")).agg(
        F.countDistinct("order_id").alias("orders"))
