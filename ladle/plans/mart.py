"""Source, clean and stored intermediate tables of one data directory.

``clean -> join`` is the expensive part of every report, so its result is written once
as Parquet and read back with column pruning and partition pruning. The tables live in
the folder the cluster names in ``spark.checkpoint.dir``, which all executors share, so
losing an executor loses nothing; and because the planner then knows the real size of
every stored table, it broadcasts small ones by itself and shuffles large ones.
"""

from __future__ import annotations

import tempfile
import time
import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.config import Config
from ladle.functions.dealing import dealt
from ladle.operators import asof, basket, cleaning, customers, fact, items, kpis, ml, series
from ladle.sources.readers import read_raw
from ladle.sources.star import StarTables


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. A local session without one gets a temporary one; a cluster has to name its own,
    as executors can't see a folder of the driver."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ladle-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def store(df: DataFrame, path: str, partition_by: str | None = None, sort_by: str | None = None) -> DataFrame:
    """Write once, read back with the known schema.

    An unpartitioned table is written straight from its last stage, whose partitions
    adaptive execution has sized already. A partitioned one is first gathered by its
    partition value with the rebalance hint, which splits a hot value over several tasks
    and files; rows are then sorted inside each file, so that range filters on ``sort_by``
    skip row groups.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        order = [partition_by] if sort_by is None else [partition_by, sort_by]
        gathered = df.hint("rebalance", partition_by).sortWithinPartitions(*order)
        gathered.write.mode("overwrite").partitionBy(partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Mart:
    """Clean, joined and aggregated tables over any provider of the source tables.

    A subclass supplies ``menu_items``, ``categories``, ``locations``, ``promotions``,
    ``raw_orders``, ``raw_lines``, ``raw_ratings``, ``inventory``, ``raw_wastage``,
    ``daily_inventory`` and ``pricing_history``.
    """

    def __init__(self, spark: SparkSession, cfg: Config | None = None):
        self.spark = spark
        self.cfg = cfg or Config()
        self._objects: dict[str, object] = {}
        self.root = f"{shared_folder(spark)}/ladle-{uuid.uuid4().hex[:12]}"

    def keep(self, name: str, df: DataFrame, partition_by: str | None = None,
             sort_by: str | None = None) -> DataFrame:
        return store(df, f"{self.root}/{name}", partition_by, sort_by)

    def keep_part(self, name: str, df: DataFrame) -> DataFrame:
        """A table of one fit; every call has a folder of its own."""
        return self.keep(f"parts/{name}-{uuid.uuid4().hex[:8]}", df)

    def close(self) -> None:
        """Remove the stored tables of this mart."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def remember(self, name: str, make):
        """An object built once per mart."""
        if name not in self._objects:
            self._objects[name] = make()
        return self._objects[name]

    # -- clean tables -------------------------------------------------------
    @property
    def clean_lines(self) -> DataFrame:
        return cleaning.clean_order_items(self.raw_lines, self.menu_items)

    @property
    def clean_orders(self) -> DataFrame:
        return cleaning.clean_orders(self.raw_orders)

    @property
    def ratings(self) -> DataFrame:
        return cleaning.clean_ratings(self.raw_ratings)

    @property
    def wastage(self) -> DataFrame:
        return cleaning.clean_wastage(self.raw_wastage)

    @property
    def channels(self) -> DataFrame:
        return self.raw_orders.select("channel").distinct()

    # -- stored facts -------------------------------------------------------
    def lazy_fact(self) -> DataFrame:
        return fact.build_fact(self.clean_lines, self.clean_orders, self.menu_items)

    @cached_property
    def fact(self) -> DataFrame:
        return self.keep("fact_order_lines", self.lazy_fact(), partition_by="location_id", sort_by="order_date")

    @cached_property
    def orders(self) -> DataFrame:
        return self.keep("fact_orders", fact.order_facts(self.fact))

    @cached_property
    def order_items(self) -> DataFrame:
        return self.keep("fact_order_items", fact.order_item_facts(dealt(self.fact, "order_id")))

    @cached_property
    def daily(self) -> DataFrame:
        """One row per calendar day."""
        return self.keep("daily_series", series.daily(self.orders))

    @cached_property
    def outlet_days(self) -> DataFrame:
        """One row per outlet and calendar day."""
        return self.keep("outlet_days", series.daily_by_outlet(self.orders))

    # -- stored reports that other reports read -----------------------------
    @cached_property
    def pair_metrics(self) -> DataFrame:
        return self.keep("pair_metrics", basket.all_metrics(
            basket.baskets(self.order_items, distinct=True), self.orders, self.cfg))

    @cached_property
    def features(self) -> DataFrame:
        return self.keep("item_features", items.item_features(
            self.order_items, self.ratings, self.wastage, self.inventory, self.menu_items, self.cfg))

    @cached_property
    def menu(self) -> DataFrame:
        return self.keep("menu_performance", items.classify(self.features, self.cfg))

    @cached_property
    def cells(self) -> DataFrame:
        return self.keep("item_outlet_cells", items.model_samples(
            self.order_items, self.menu, self.inventory, self.wastage, self.cfg))

    @property
    def analysis_end(self) -> Column:
        if self.cfg.analysis_end is not None:
            return F.lit(self.cfg.analysis_end)
        return self.orders.agg(F.max("order_date")).scalar()

    @cached_property
    def customers(self) -> DataFrame:
        return self.keep("customer_features", customers.customer_features(
            self.order_items, self.orders, self.analysis_end))

    @cached_property
    def rfm(self) -> DataFrame:
        return self.keep("rfm_scores", customers.rfm_scores(self.customers))

    @cached_property
    def segments(self) -> DataFrame:
        """Customer features with the rule-based segment."""
        return self.keep("rule_segments", customers.rule_segments(self.customers))

    @cached_property
    def outlet_figures(self) -> DataFrame:
        """Waste share and mean rating of every outlet, over the whole table."""
        return self.keep("outlet_figures", kpis.outlet_waste_rating(self.orders, self.wastage, self.ratings))

    @cached_property
    def rule_profile(self) -> DataFrame:
        """Profile of the rule-based segments, over all customers."""
        return self.keep("rule_profile", customers.segment_profile(self.segments, self.orders))

    # -- models -------------------------------------------------------------
    @cached_property
    def first_family(self) -> ml.Trained:
        started = time.time()
        trained = ml.train_family(self.cells, ml.first_family(self.cfg), ml.FIRST_FEATURES, self.cfg)
        trained.seconds = round(time.time() - started, 1)
        return trained

    @cached_property
    def second_family(self) -> ml.Trained:
        started = time.time()
        trained = ml.train_second_family(self.cells, self.keep_part, self.cfg)
        trained.seconds = round(time.time() - started, 1)
        return trained

    @cached_property
    def first_predictions(self) -> DataFrame:
        return self.keep("spark_predictions", ml.score_cells(
            self.cells, self.first_family.model, ml.FIRST_FEATURES))

    @cached_property
    def second_predictions(self) -> DataFrame:
        cells = self.cells.select("item_id", "location_id", "name", "local_class")
        return self.keep("python_predictions", cells.join(self.second_family.predictions, ["item_id", "location_id"]))

    @cached_property
    def cluster_segments(self) -> DataFrame:
        return self.keep("cluster_segments", ml.segment_customers(self.customers, seed=self.cfg.seed))

    @cached_property
    def churn_model(self) -> ml.ChurnModel:
        return ml.train_churn(self.customers, self.cfg)

    @cached_property
    def churn_scores(self) -> DataFrame:
        return self.keep("churn_scores", ml.score_churn(self.customers, self.churn_model, self.cfg))

    def churn_report(self) -> DataFrame:
        return customers.churn_report(self.churn_scores, self.cfg)

    @property
    def segment_report(self) -> DataFrame:
        return customers.segment_profile(self.cluster_segments, self.orders, self.churn_scores)


class StarMart(Mart):
    """Mart over the star-schema Parquet tables, with spoiled copies for the cleaning rules."""

    def __init__(self, spark: SparkSession, directory: str, cfg: Config | None = None):
        super().__init__(spark, cfg)
        self.star = StarTables(spark, directory)

    @cached_property
    def menu_items(self) -> DataFrame:
        return self.keep("menu_items", self.star.menu_items())

    @cached_property
    def categories(self) -> DataFrame:
        return self.menu_items.select("category_id", F.initcap("category_id").alias("category_name")).distinct()

    @cached_property
    def locations(self) -> DataFrame:
        return self.star.locations()

    @cached_property
    def promotions(self) -> DataFrame:
        return self.keep("promotions", self.star.promotions())

    @cached_property
    def raw_orders(self) -> DataFrame:
        return self.keep("source_orders", self.star.orders())

    @cached_property
    def shipped_lines(self) -> DataFrame:
        """Order lines with their item and shipping columns: read by fact, stock and prices."""
        return self.keep("source_lines", self.star.order_items())

    @property
    def raw_lines(self) -> DataFrame:
        return self.shipped_lines.drop("line_no", "ship_date", "return_flag", "line_status")

    @cached_property
    def raw_ratings(self) -> DataFrame:
        return self.keep("source_ratings", self.star.ratings(self.menu_items))

    @cached_property
    def daily_inventory(self) -> DataFrame:
        return self.keep("stock_daily", self.star.stock_daily(self.shipped_lines, self.raw_orders, self.menu_items))

    @cached_property
    def stock(self) -> DataFrame:
        """Weekly inventory and wastage, the detail the reports work on."""
        return self.keep("stock_weekly", self.star.stock_weekly(self.daily_inventory))

    @property
    def inventory(self) -> DataFrame:
        return self.stock.select("item_id", "location_id", "date", "prepared_qty", "consumed_qty")

    @property
    def raw_wastage(self) -> DataFrame:
        return self.stock.select("item_id", "location_id", "date", "wasted_qty", "cost")

    @cached_property
    def pricing_history(self) -> DataFrame:
        return self.keep("pricing_history", self.star.pricing_history(self.shipped_lines))

    @property
    def price_probes(self) -> DataFrame:
        return self.shipped_lines.filter("line_status = 'O'").select("order_id", "line_no", "item_id", "ship_date")

    @cached_property
    def resolved_prices(self) -> DataFrame:
        return self.keep("resolved_prices", asof.resolved_prices(self.price_probes, self.pricing_history))

    def priced_lines(self) -> DataFrame:
        return asof.price_in_effect(self.price_probes, self.resolved_prices, self.menu_items)

    @cached_property
    def brand_pair_metrics(self) -> DataFrame:
        """Pairs with the brand as the item: few items, dense pairs."""
        brand = F.element_at(F.split("item_id", "/"), 1)
        lines = self.order_items.select("order_id", brand.alias("brand"))
        return self.keep("brand_pair_metrics", basket.all_metrics(
            basket.baskets(lines, "brand"), self.orders, self.cfg))

    # -- spoiled copies -----------------------------------------------------
    @property
    def dirty_lines(self) -> DataFrame:
        return self.star.dirty_order_items(self.shipped_lines)

    @property
    def dirty_orders(self) -> DataFrame:
        return self.star.dirty_orders(self.raw_orders)

    @property
    def dirty_wastage(self) -> DataFrame:
        return self.star.dirty_wastage(self.stock)


class FileMart(Mart):
    """Mart over the eleven source tables kept as CSV or Parquet files in one folder."""

    def __init__(self, spark: SparkSession, folder: str, cfg: Config | None = None, fmt: str = "csv"):
        super().__init__(spark, cfg)
        self.tables = read_raw(spark, folder, fmt=fmt)

    menu_items = property(lambda self: self.tables["menu_items"])
    categories = property(lambda self: self.tables["menu_categories"])
    locations = property(lambda self: self.tables["locations"])
    promotions = property(lambda self: self.tables["promotions"])
    raw_orders = property(lambda self: self.tables["orders"])
    raw_lines = property(lambda self: self.tables["order_items"])
    raw_ratings = property(lambda self: self.tables["ratings"])
    inventory = property(lambda self: self.tables["inventory"])
    daily_inventory = property(lambda self: self.tables["inventory"])
    raw_wastage = property(lambda self: self.tables["wastage"])
    pricing_history = property(lambda self: self.tables["pricing_history"])


_MARTS: dict[tuple[str, str], StarMart] = {}


def mart_for(spark: SparkSession, directory: str) -> StarMart:
    """The mart of this session and directory; stored tables are built on first use."""
    key = (spark.sparkContext.applicationId, directory)
    if key not in _MARTS:
        _MARTS[key] = StarMart(spark, directory)
    return _MARTS[key]
