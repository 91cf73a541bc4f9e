"""Backward as-of join: the latest history value at or before each probe time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(probes: DataFrame, history: DataFrame, by: str, probe_time: str, history_time: str,
               value: str, out: str) -> DataFrame:
    """Left as-of join of ``probes`` to ``history`` on ``by`` and time."""
    resolved = resolve(probes, history, by, probe_time, history_time, value, out)
    return probes.join(resolved, [by, probe_time], "left")


def resolve(probes: DataFrame, history: DataFrame, by: str, probe_time: str, history_time: str,
            value: str, out: str) -> DataFrame:
    """The value in effect for every distinct ``(by, time)`` the probes ask for.

    1. Probes shrink to their distinct ``(by, time)`` pairs, so a hot key costs its
       distinct times, not its rows.
    2. Pairs and history are laid on one time line, cut into calendar months. Each
       month is its own window group; the value carried in from earlier months comes
       from a summary of one row per key and month. No group spans a key's whole life.

    Of several values of one key and time the greatest counts.

    The result joins back to the probes with an equi-join. It has at most one row per
    key and time, so stored as a table it is often small enough to be broadcast.
    """
    asked = probes.select(by, F.col(probe_time).alias("__t")).distinct()
    asked = asked.select(by, "__t", F.lit(1).alias("__side"), F.lit(None).cast(dict(history.dtypes)[value]).alias("__v"))
    known = history.select(by, F.col(history_time).alias("__t"), F.lit(0).alias("__side"), F.col(value).alias("__v"))
    line = known.unionByName(asked).withColumn("__month", F.date_trunc("month", "__t").cast("date"))

    summary = line.groupBy(by, "__month").agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.struct("__t", "__v"))).alias("__last"))
    before = Window.partitionBy(by).orderBy("__month").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(by, "__month", F.last("__last", ignorenulls=True).over(before).alias("__carry"))

    inside = Window.partitionBy(by, "__month").orderBy("__t", "__side", "__v").rowsBetween(Window.unboundedPreceding, 0)
    return (
        line.withColumn("__here", F.last("__v", ignorenulls=True).over(inside))
        .filter("__side = 1")
        .join(carried, [by, "__month"])
        .select(by, F.col("__t").alias(probe_time), F.coalesce("__here", "__carry").alias(out))
    )


def resolved_prices(lines: DataFrame, history: DataFrame) -> DataFrame:
    return resolve(lines, history, "item_id", "ship_date", "effective_date", "price", "history_price")


def price_in_effect(lines: DataFrame, resolved: DataFrame, menu_items: DataFrame) -> DataFrame:
    """Price valid on each line's date; items without earlier history use the base price."""
    matched = lines.join(resolved, ["item_id", "ship_date"], "left")
    base = menu_items.select("item_id", "base_price")
    return matched.join(base, "item_id", "left").withColumn(
        "price_in_effect", F.coalesce(F.col("history_price"), F.col("base_price")))
