"""Cleaning rules over the source tables, with a log and a quarantine.

All rules are row-local except the duplicate rule. Dimension lookups are plain left
joins: the planner broadcasts a dimension only when its known size is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle import config as C
from ladle.functions import scalars as S

LINE_NUMBER = "order_item_id"


def line_identity(lines: DataFrame) -> list[str]:
    """The columns that make two lines the same: all but the running line number."""
    return [c for c in lines.columns if c != LINE_NUMBER]


def counted_lines(lines: DataFrame, key: list[str] | None = None) -> DataFrame:
    """One row per distinct line with its ``copies``; a ``key`` compares only the columns named."""
    key = key or line_identity(lines)
    needed = [c for c in ("item_id", "quantity", "unit_price") if c not in key]
    return lines.groupBy(*key).agg(F.count("*").alias("copies"), *[F.first(c).alias(c) for c in needed])


def drop_duplicate_lines(lines: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Distinct lines. The running line number is not part of a line's identity, so by
    default it is left out; a ``key`` keeps all columns and compares only those named.
    """
    return lines.dropDuplicates(key) if key else lines.drop(LINE_NUMBER).distinct()


def distinct_by_order(lines: DataFrame) -> DataFrame:
    """The same rows as ``drop_duplicate_lines`` without a key, dealt and sorted by order.

    Hardly any lines are equal, so they are not combined in memory before the shuffle; the one shuffle and sort by order
    also serve the join with the orders that follows.
    """
    same = line_identity(lines)
    alike = Window.partitionBy("order_id", *[c for c in same if c != "order_id"]).orderBy("order_id")
    return lines.select(*same).repartition("order_id").withColumn("__copy", F.row_number().over(alike)).filter(
        "__copy = 1").drop("__copy")


def known_items(lines: DataFrame, menu_items: DataFrame) -> DataFrame:
    """Attach ``known`` and the item's base price."""
    dim = menu_items.select("item_id", F.col("base_price").alias("__base"), F.lit(True).alias("known"))
    return lines.join(dim, "item_id", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def clean_order_items(lines: DataFrame, menu_items: DataFrame, price_policy: str = "recover",
                      dedup_key: list[str] | None = None) -> DataFrame:
    """De-duplicate, drop bad quantities, repair prices, drop unknown items, re-price."""
    if price_policy not in ("recover", "drop"):
        raise ValueError(f"price_policy must be 'recover' or 'drop', not {price_policy!r}")
    one_each = drop_duplicate_lines(lines, dedup_key) if dedup_key else distinct_by_order(lines)
    good = one_each.filter("quantity > 0")
    if price_policy == "drop":
        good = good.filter("unit_price > 0")
    checked = known_items(good, menu_items).filter("known")
    price = F.when(F.col("unit_price") <= 0, F.col("__base")).otherwise(F.col("unit_price"))
    kind = dict(lines.dtypes)["unit_price"]
    return (
        checked.withColumn("unit_price", price.cast(kind))
        .withColumn("line_total", S.line_amount(F.col("quantity"), F.col("unit_price"), F.col("discount_pct")))
        .select(*good.columns)
    )


def quarantined_items(lines: DataFrame, menu_items: DataFrame, dedup_key: list[str] | None = None) -> DataFrame:
    """Lines set aside because they name an item that does not exist."""
    good = drop_duplicate_lines(lines, dedup_key).filter("quantity > 0")
    return good.join(menu_items.select("item_id"), "item_id", "left_anti").select(*good.columns)


def valid_stars() -> Column:
    return F.coalesce(F.col("stars").between(1, 5), F.lit(False))


def clean_ratings(ratings: DataFrame) -> DataFrame:
    return ratings.filter(valid_stars())


def clean_wastage(wastage: DataFrame) -> DataFrame:
    return wastage.filter("wasted_qty >= 0")


def flag_guests(orders: DataFrame) -> DataFrame:
    """Mark orders without a customer; a text key also gets the guest label."""
    guest = ~S.present(F.col("customer_id"))
    out = orders.withColumn("is_guest", guest)
    if dict(orders.dtypes)["customer_id"] == "string":
        out = out.withColumn("customer_id", F.when(guest, C.GUEST).otherwise(F.col("customer_id")))
    return out


def completed(orders: DataFrame) -> DataFrame:
    return orders.filter("status = 'completed'")


def clean_orders(orders: DataFrame) -> DataFrame:
    return completed(flag_guests(orders))


def cleaning_log(lines: DataFrame, orders: DataFrame, ratings: DataFrame, wastage: DataFrame,
                 menu_items: DataFrame, dedup_key: list[str] | None = None) -> DataFrame:
    """Rows touched per step, in step order. Each table is read once."""
    copies = counted_lines(lines, dedup_key)
    checked = known_items(copies, menu_items)
    sold = F.col("quantity") > 0
    line_counts = checked.agg(
        F.sum(F.col("copies") - 1).alias("a"),
        F.count_if(~sold).alias("b"),
        F.count_if(sold & (F.col("unit_price") <= 0)).alias("c"),
        F.count_if(sold & ~F.col("known")).alias("d"),
    )
    steps = [
        _stack(line_counts, {
            1: ("Removed duplicate order-lines", "a"),
            2: ("Removed non-positive quantities", "b"),
            3: ("Recovered invalid prices from history", "c"),
            4: ("Quarantined unknown item references", "d")}),
        _stack(ratings.agg(F.count_if(~valid_stars()).alias("a")), {5: ("Dropped out-of-range ratings", "a")}),
        _stack(wastage.agg(F.count_if(F.col("wasted_qty") < 0).alias("a")),
               {6: ("Removed impossible wastage rows", "a")}),
        _stack(orders.agg(F.count_if(~S.present(F.col("customer_id"))).alias("a")),
               {7: ("Flagged guest orders", "a")}),
    ]
    log = steps[0]
    for part in steps[1:]:
        log = log.unionByName(part)
    return log


def _stack(one_row: DataFrame, steps: dict[int, tuple[str, str]]) -> DataFrame:
    """One row of counters -> one row per step."""
    packed = F.array(*[
        F.struct(F.lit(n).alias("step_no"), F.lit(text).alias("step"),
                 F.coalesce(F.col(c), F.lit(0)).cast("long").alias("records"))
        for n, (text, c) in steps.items()])
    return one_row.select(F.explode(packed).alias("s")).select("s.*")


def row_audit(lines: DataFrame, menu_items: DataFrame, price_policy: str = "drop") -> DataFrame:
    """Rows before and after cleaning from one pass over the lines."""
    copies = counted_lines(lines)
    keep = F.col("quantity") > 0
    if price_policy == "drop":
        keep = keep & (F.col("unit_price") > 0)
    else:
        copies = known_items(copies, menu_items)
        keep = keep & F.col("known")
    counts = copies.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
                        F.count_if(keep).alias("rows_after"))
    return counts.withColumn("dropped", F.col("rows_before") - F.col("rows_after"))
