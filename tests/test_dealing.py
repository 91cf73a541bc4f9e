from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from ladle.functions.dealing import dealt, dealt_alike
from ladle.operators import cleaning, commerce, customers, fact, items
from ladle.sources.star import StarTables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """(columns, origin) of every shuffle by key, from the top."""
    return [(line.split("hashpartitioning(")[1].split(")")[0], line.split("), ")[-1]) for line in plan(df).splitlines() if "Exchange hashpartitioning" in line]


def lines_of(spark, rows):
    return spark.createDataFrame(rows, "order_id long, item_id string, quantity int, unit_price decimal(14,4), discount_pct int, line_total decimal(18,2), promotion_id string")


ROWS = [(1, "a", 2, D("3.0000"), 0, D("6.00"), None), (1, "a", 2, D("3.0000"), 0, D("6.00"), None), (1, "a", 2, D("3.0000"), 0, D("6.01"), None),
        (1, "b", 1, None, None, None, "P05"), (1, "b", 1, None, None, None, "P05"), (None, "a", 2, D("3.0000"), 0, D("6.00"), None),
        (None, "a", 2, D("3.0000"), 0, D("6.00"), None), (2, "a", 2, D("3.0000"), 0, D("6.00"), None)]


def test_distinct_by_order_keeps_the_same_rows(spark):
    lines = lines_of(spark, ROWS)
    want, got = cleaning.drop_duplicate_lines(lines).collect(), cleaning.distinct_by_order(lines).collect()
    assert len(got) == 5 and sorted(map(str, got)) == sorted(map(str, want))
    numbered = lines.withColumn("order_item_id", F.monotonically_increasing_id())
    assert sorted(map(str, cleaning.distinct_by_order(numbered).collect())) == sorted(map(str, want))


def test_fact_shuffles_its_lines_once(spark):
    """One shuffle serves duplicates and the join with orders, and nothing is combined in memory before it."""
    menu = spark.createDataFrame([("a", "c", D("6.00"), D("2.00")), ("b", "c", D("6.00"), D("2.00"))], "item_id string, category_id string, base_price decimal(12,2), food_cost decimal(12,2)")
    orders = spark.createDataFrame([(1, "x", 3, "web", datetime(2026, 1, 1), "completed")], "order_id long, customer_id string, location_id int, channel string, order_ts timestamp, status string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        clean = cleaning.clean_order_items(lines_of(spark, ROWS).filter("unit_price > 0"), F.broadcast(menu))
        df = fact.build_fact(clean, cleaning.clean_orders(orders), F.broadcast(menu))
        found = exchanges(df)
        assert len(found) == 2 and all("order_id" in columns and "," in columns and "item_id" not in columns for columns, _ in found), found
        assert "HashAggregate" not in plan(df)
        assert sorted(r["item_id"] for r in df.collect()) == ["a", "a"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dealt_bounds_the_rows_of_a_task(spark):
    df = spark.range(1000).select((F.col("id") % 400).alias("k"))
    got = dealt(df, "k", rows_per_task=100)
    sizes = got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count_distinct("k").alias("k")).collect()
    assert got.rdd.getNumPartitions() == 10 and sum(r["n"] for r in sizes) == 1000 and sum(r["k"] for r in sizes) == 400
    assert dealt(df.limit(0), "k").count() == 0


def facts_of(spark):
    at = datetime(2026, 1, 1)
    rows = [(1, "a", "c", 3, "x", False, "P05", True, D("6.00"), D("2.00")), (1, "b", "d", 3, "x", False, "P05", True, D("4.00"), D("1.00")),
            (2, "a", "c", 3, "y", False, "P05", True, D("6.00"), D("2.00")), (3, "a", "c", 3, "x", False, "P10", True, D("6.00"), D("2.00")),
            (4, "a", "c", 3, None, True, None, False, D("6.00"), D("2.00"))]
    return spark.createDataFrame([(*r, at, at.date()) for r in rows], "order_id long, item_id string, category_id string, location_id int, customer_id string, "
                                 "is_guest boolean, promotion_id string, has_promo boolean, revenue decimal(18,2), profit decimal(18,2), order_ts timestamp, order_date date")


def first_is_dealt(df):
    """The lowest shuffle is one of rows as they are."""
    found = exchanges(df) or [("", plan(df))]
    return "REPARTITION_BY_NUM" in plan(df) and "ENSURE_REQUIREMENTS" not in found[-1][1]


def test_groups_of_few_rows_are_not_combined_before_their_shuffle(spark):
    df = facts_of(spark)
    promotions = spark.createDataFrame([("P05", "Five", "light", 5), ("P10", "Ten", "light", 10)], "promotion_id string, name string, type string, discount_pct int")
    effect = commerce.promotion_effectiveness(df, promotions, df)
    assert "REPARTITION_BY_NUM" in plan(effect)
    assert {r["promotion_id"]: (r["order_share_pct"], r["aov"]) for r in effect.collect()} == {"P05": (40.0, 8.0), "P10": (20.0, 6.0)}
    repeat = items.repeat_share(df)
    assert first_is_dealt(repeat)
    assert {r["item_id"]: r["repeat_pct"] for r in repeat.collect()} == {"a": 33.0, "b": 0.0}
    orders = df.withColumns({"promo_lines": F.col("has_promo").cast("int"), "lines": F.lit(1)})
    features = customers.customer_features(df, orders, F.lit("2026-01-02"))
    assert "REPARTITION_BY_NUM" in plan(features)
    assert {r["customer_id"]: r["categories"] for r in features.collect()} == {"x": 2, "y": 1}


def test_order_items_of_the_mart_are_dealt(mart):
    want = sorted(map(str, fact.order_item_facts(mart.fact).collect()))
    assert sorted(map(str, mart.order_items.collect())) == want
    assert "REPARTITION_BY_NUM" in plan(fact.order_item_facts(dealt(mart.fact, "order_id")))


def test_stock_deals_lines_and_orders_alike(spark):
    """Their join adds no shuffle by order to those two; rows of one day are summed over tasks."""
    day = date(2026, 1, 5)
    lines = spark.createDataFrame([(i, "a", 2, day, "R" if i % 2 else "N") for i in range(8)] + [(None, "a", 9, day, "N"), (99, "a", 9, day, "N")],
                                  "order_id long, item_id string, quantity int, ship_date date, return_flag string")
    orders = spark.createDataFrame([(i, 3) for i in range(8)] + [(7, 4), (None, 3)], "order_id long, location_id int")
    menu = spark.createDataFrame([("a", D("2.00"))], "item_id string, food_cost decimal(12,2)")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        a, b = dealt_alike(lines, orders, "order_id", rows_per_task=3)
        joined = a.join(b, "order_id")
        assert [origin.split(",")[0] for _, origin in exchanges(joined)] == ["REPARTITION_BY_NUM"] * 2 and joined.count() == 9
        stock = StarTables(spark, "").stock_daily(lines, orders, F.broadcast(menu))
        assert plan(stock).count("REPARTITION_BY_NUM") == 2
        got = {r["location_id"]: (r["prepared_qty"], r["wasted_qty"], r["cost"]) for r in stock.collect()}
        assert got == {3: (16, 8, D("16.00")), 4: (2, 2, D("4.00"))}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
