"""The eleven source tables, expressed over a TPC-H-like star schema.

``part`` supplies items (one per brand and type), ``nation`` outlets, ``orders`` and
``lineitem`` the transactions, ``events`` the ratings. Every definition is a lazy
DataFrame over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladle.functions import scalars as S
from ladle.functions.dealing import dealt_alike


class StarTables:
    """Lazy source tables over a directory of Parquet files."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    # -- dimensions ---------------------------------------------------------
    @staticmethod
    def _item_id() -> Column:
        return F.concat_ws("/", "p_brand", "p_type")

    def menu_items(self) -> DataFrame:
        cheapest = F.min(F.col("p_retailprice").cast("decimal(12,2)"))
        items = self.raw("part").groupBy("p_brand", "p_type").agg(cheapest.alias("food_cost"))
        # The window sees one row per (brand, type): the item dimension, never `part` itself.
        numbered = F.row_number().over(Window.orderBy("item_id")) - 1
        return items.select(
            self._item_id().alias("item_id"),
            F.concat_ws(" ", "p_brand", "p_type").alias("name"),
            F.col("p_type").alias("category_id"),
            (F.col("food_cost") * 2).cast("decimal(12,2)").alias("base_price"),
            "food_cost",
        ).withColumn("item_no", numbered.cast("int"))

    def menu_categories(self) -> DataFrame:
        kinds = self.raw("part").select("p_type").distinct()
        return kinds.select(F.col("p_type").alias("category_id"), F.initcap("p_type").alias("category_name"))

    def locations(self) -> DataFrame:
        region = self.raw("region")
        nation = self.raw("nation")
        return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
            F.col("n_nationkey").alias("location_id"),
            F.col("n_name").alias("name"),
            F.col("r_name").alias("city"),
        )

    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.lit(None).cast("date").alias("signup_date"),
            F.col("c_mktsegment").alias("ctype"),
        )

    def promotions(self) -> DataFrame:
        tiers = (
            self.raw("lineitem")
            .select(F.round(F.col("l_discount") * 100).cast("int").alias("discount_pct"))
            .filter("discount_pct > 0")
            .distinct()
        )
        return tiers.select(
            self._promotion_id("discount_pct").alias("promotion_id"),
            F.concat(F.lit("Tier "), F.col("discount_pct").cast("string"), F.lit("%")).alias("name"),
            F.when(F.col("discount_pct") <= 5, "light").otherwise("deep").alias("type"),
            "discount_pct",
        )

    @staticmethod
    def _promotion_id(pct: str) -> Column:
        text = F.concat(F.lit("P"), F.lpad(F.col(pct).cast("string"), 2, "0"))
        return F.when(F.col(pct) > 0, text)

    # -- transactions -------------------------------------------------------
    def orders(self) -> DataFrame:
        homes = self.raw("customer").select("c_custkey", "c_nationkey")
        o = self.raw("orders")
        return o.join(homes, o.o_custkey == homes.c_custkey, "left").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("c_nationkey").alias("location_id"),
            F.col("o_orderpriority").alias("channel"),
            F.col("o_orderdate").alias("order_ts"),
            S.money(F.col("o_totalprice")).alias("total_amount"),
            F.when(F.col("o_orderstatus") == "P", "cancelled").otherwise("completed").alias("status"),
        )

    def order_items(self) -> DataFrame:
        """Order lines plus the shipping columns the stock tables are derived from."""
        parts = self.raw("part").select("p_partkey", self._item_id().alias("item_id"))
        li = self.raw("lineitem")
        amount, discount = F.col("l_extendedprice"), F.col("l_discount")
        qty = F.col("l_quantity").cast("int")
        # whole cents and percents are computed as such; other doubles go through decimals, which takes longer
        whole = S.whole_hundredths(amount, -1e13, 1e13)
        percents = S.whole_hundredths(discount, -0.01, 1.01)
        cents = F.when(whole, S.hundredths(amount)).otherwise((amount.cast(S.MONEY) * 100).cast("bigint")).alias("__cents")
        # price per unit to four decimals, rounded half up in whole numbers
        ten_thousandths = F.expr("(__cents * 200 + quantity) div nullif(quantity * 2, 0)")
        price = (ten_thousandths.cast("decimal(18,0)") * F.lit("0.0001").cast("decimal(4,4)"))
        net = amount.cast(S.MONEY) * (F.lit(1).cast("decimal(3,0)") - discount.cast("decimal(4,2)"))
        whole_net = F.expr("bigint(sign(__cents)) * ((abs(__cents * (100 - __percents)) + 50) div 100)")
        return (
            li.join(parts, li.l_partkey == parts.p_partkey, "left")
            .select("*", qty.alias("quantity"), cents, F.when(percents, S.hundredths(discount)).alias("__percents"), whole.alias("__whole"))
            .select(
                F.col("l_orderkey").alias("order_id"),
                F.col("l_linenumber").alias("line_no"),
                "item_id",
                "quantity",
                price.cast("decimal(14,4)").alias("unit_price"),
                F.coalesce(F.col("__percents"), F.round(discount * 100)).cast("int").alias("discount_pct"),
                F.when(F.col("__whole") & F.col("__percents").isNotNull(), S.from_hundredths(whole_net)).otherwise(
                    F.round(net, 2).cast(S.MONEY)).alias("line_total"),
                F.col("l_shipdate").cast("date").alias("ship_date"),
                F.col("l_returnflag").alias("return_flag"),
                F.col("l_linestatus").alias("line_status"),
            )
            .withColumn("promotion_id", self._promotion_id("discount_pct"))
        )

    # -- feedback and stock -------------------------------------------------
    def ratings(self, menu_items: DataFrame) -> DataFrame:
        homes = self.raw("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("location_id"))
        votes = self.raw("events").select(
            F.col("event_id").alias("rating_id"),
            F.get_json_object("props", "$.k").cast("int").alias("item_no"),
            "user_id",
            (F.floor("value").cast("int") % 7).alias("stars"),
            F.col("ts").alias("rating_ts"),
            F.col("event_type").alias("kind"),
        )
        return (
            votes.join(menu_items.select("item_no", "item_id"), "item_no", "left")
            .join(homes, "user_id", "left")
            .select("rating_id", "item_id", F.col("user_id").alias("customer_id"),
                    "location_id", "stars", "rating_ts", "kind")
        )

    def stock_daily(self, order_items: DataFrame, orders: DataFrame, menu_items: DataFrame) -> DataFrame:
        """Prepared and returned quantity per item, outlet and ship day."""
        lines, home = dealt_alike(order_items.select("order_id", "item_id", "quantity", "ship_date", "return_flag"),
                                  orders.select("order_id", "location_id"), "order_id")
        waste = F.when(F.col("return_flag") == "R", F.col("quantity")).otherwise(0)
        return (
            lines.join(home, "order_id")
            .groupBy("item_id", "location_id", F.col("ship_date").alias("date"))
            .agg(F.sum("quantity").alias("prepared_qty"), F.sum(waste).alias("wasted_qty"))
            .join(menu_items.select("item_id", "food_cost"), "item_id")
            .select("item_id", "location_id", "date", "prepared_qty", "wasted_qty",
                    (F.col("prepared_qty") - F.col("wasted_qty")).alias("consumed_qty"),
                    (F.col("wasted_qty").cast("decimal(10,0)") * F.col("food_cost")).cast(S.MONEY).alias("cost"))
        )

    @staticmethod
    def stock_weekly(daily: DataFrame) -> DataFrame:
        return daily.groupBy("item_id", "location_id", S.week_start(F.col("date")).alias("date")).agg(
            F.sum("prepared_qty").alias("prepared_qty"),
            F.sum("consumed_qty").alias("consumed_qty"),
            F.sum("wasted_qty").alias("wasted_qty"),
            F.sum("cost").cast(S.MONEY).alias("cost"),
        )

    @staticmethod
    def pricing_history(order_items: DataFrame) -> DataFrame:
        return (
            order_items.filter("line_status = 'F'")
            .groupBy("item_id", F.col("ship_date").alias("effective_date"))
            .agg(F.max("unit_price").alias("price"))
        )

    # -- the same tables with planted defects ------------------------------
    @staticmethod
    def dirty_order_items(order_items: DataFrame) -> DataFrame:
        """All lines, some of them spoiled; every 501st order has its lines twice."""
        key = F.col("order_id")
        copies = F.when(key % 501 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return order_items.select(
            "order_id",
            F.when((key * 7 + F.col("line_no")) % 1009 == 0, "UNKNOWN").otherwise(F.col("item_id")).alias("item_id"),
            F.when(key % 997 == 0, -1).otherwise(F.col("quantity")).alias("quantity"),
            F.when(key % 311 == 0, F.lit(0).cast("decimal(14,4)")).otherwise(F.col("unit_price")).alias("unit_price"),
            "discount_pct",
            "line_total",
            "promotion_id",
            F.explode(copies).alias("copy"),
        ).drop("copy")

    @staticmethod
    def dirty_orders(orders: DataFrame) -> DataFrame:
        key = F.col("order_id")
        return orders.withColumns({
            "customer_id": F.when(key % 125 != 0, F.col("customer_id").cast("string")),
            "location_id": F.when(key % 1013 == 0, -1).otherwise(F.col("location_id")),
        })

    @staticmethod
    def dirty_wastage(wastage: DataFrame) -> DataFrame:
        spoiled = (F.month("date") == 1) & (F.col("location_id") == 3)
        return wastage.withColumn(
            "wasted_qty", F.when(spoiled, -F.col("wasted_qty")).otherwise(F.col("wasted_qty")))
