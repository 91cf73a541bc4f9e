"""Slice-and-recompute: a set of filters, and every report over the filtered facts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle import config as C
from ladle.functions import scalars as S
from ladle.operators import fact as facts
from ladle.operators import items, kpis, series

_NUMBERS = ("rating_min", "price_min", "price_max", "waste_min", "waste_max")
_DATES = ("date_from", "date_to")
_ITEM_FIELDS = ("item", "category", "klass") + _NUMBERS


@dataclass(frozen=True)
class Filters:
    """Fourteen optional filters. ``None`` means "all"."""

    date_from: date | None = None
    date_to: date | None = None
    location: str | None = None
    channel: str | None = None
    promotion: str | None = None
    segment: str | None = None
    item: str | None = None
    category: str | None = None
    klass: str | None = None
    rating_min: float | None = None
    price_min: float | None = None
    price_max: float | None = None
    waste_min: float | None = None
    waste_max: float | None = None

    @classmethod
    def from_dict(cls, given: dict) -> "Filters":
        """Read request parameters; "all", empty and unreadable numbers are ignored."""
        out = {}
        for f in fields(cls):
            value = given.get(f.name)
            if value in (None, "", "all"):
                continue
            if f.name in _NUMBERS:
                try:
                    value = float(value)
                except (TypeError, ValueError):
                    continue
            elif f.name in _DATES and not isinstance(value, date):
                value = date.fromisoformat(str(value))
            out[f.name] = value
        return cls(**out)

    @property
    def active(self) -> int:
        return sum(getattr(self, f.name) is not None for f in fields(self))

    @property
    def has_item_filter(self) -> bool:
        return any(getattr(self, n) is not None for n in _ITEM_FIELDS)

    def item_predicate(self) -> Column:
        """Condition on the classified menu."""
        pairs = [
            (self.item, lambda v: F.col("item_id") == v),
            (self.category, lambda v: F.col("category_id") == v),
            (self.klass, lambda v: F.col("menu_class") == v),
            (self.rating_min, lambda v: F.col("rating") >= v),
            (self.price_min, lambda v: F.col("base_price") >= v),
            (self.price_max, lambda v: F.col("base_price") <= v),
            (self.waste_min, lambda v: F.col("wastage_pct") >= v),
            (self.waste_max, lambda v: F.col("wastage_pct") <= v),
        ]
        return _all(pairs)

    def date_predicate(self, column: str) -> Column:
        return _all([(self.date_from, lambda v: F.col(column) >= F.lit(v)),
                     (self.date_to, lambda v: F.col(column) <= F.lit(v))])


def _all(pairs) -> Column:
    parts = [make(value) for value, make in pairs if value is not None]
    return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def _named_keys(dim: DataFrame, key: str, name: str) -> DataFrame:
    return dim.filter(F.col("name") == name).select(key)


class Slice:
    """Reports over the facts that pass the filters.

    ``store(name, frame)`` may write the filtered facts once; otherwise use the slice as a
    context manager to keep them persisted while several reports are taken. Dates, outlet and channel are plain predicates that reach the scan (the outlet also
    prunes partition folders); the other filters are semi-joins against small tables.
    """

    def __init__(self, filters: Filters, fact: DataFrame, menu: DataFrame, locations: DataFrame,
                 promotions: DataFrame, segments: DataFrame, wastage: DataFrame, categories: DataFrame,
                 channels: DataFrame, store: Callable[[str, DataFrame], DataFrame] | None = None,
                 outlets: DataFrame | None = None, profile: DataFrame | None = None):
        """outlets: waste_pct and rating per location_id; profile: one row per segment. Both are figures of the whole
        table that reports of a slice carry along; without them those columns are left out."""
        self._outlets, self._profile = outlets, profile
        self._store = store or (lambda name, df: df)
        self.filters = filters
        self.menu = menu
        self.locations = locations
        self.segments = segments
        self.categories = categories
        self.channels = channels
        self._source = fact
        self._promotions = promotions
        self._wastage = wastage

    @cached_property
    def fact(self) -> DataFrame:
        p = self.filters
        df = self._source.filter(p.date_predicate("order_date"))
        if p.channel is not None:
            df = df.filter(F.col("channel") == p.channel)
        if p.location is not None:
            df = df.join(_named_keys(self.locations, "location_id", p.location), "location_id", "left_semi")
        if p.promotion is not None:
            df = df.join(_named_keys(self._promotions, "promotion_id", p.promotion), "promotion_id", "left_semi")
        if p.has_item_filter:
            df = df.join(self._items, "item_id", "left_semi")
        if p.segment is not None:
            chosen = self.segments.filter(F.col("segment") == p.segment).select("customer_id")
            df = df.join(chosen, "customer_id", "left_semi")
        return self._store("fact", df)

    @property
    def _items(self) -> DataFrame:
        return self.menu.filter(self.filters.item_predicate()).select("item_id")

    @cached_property
    def orders(self) -> DataFrame:
        return self._store("orders", facts.order_facts(self.fact))

    @cached_property
    def wastage(self) -> DataFrame:
        """Waste under the item, outlet and date filters (the others do not apply to it)."""
        p = self.filters
        df = self._wastage.filter(p.date_predicate("date"))
        if p.location is not None:
            df = df.join(_named_keys(self.locations, "location_id", p.location), "location_id", "left_semi")
        if p.has_item_filter:
            df = df.join(self._items, "item_id", "left_semi")
        return df

    def __enter__(self) -> "Slice":
        """Keep the filtered facts while several reports are taken from them."""
        self.fact.persist()
        self.orders.persist()
        return self

    def __exit__(self, *_) -> None:
        self.orders.unpersist()
        self.fact.unpersist()

    def meta(self) -> DataFrame:
        """Orders, lines, customers and items in the slice, and whether it is empty."""
        head = self.orders.agg(
            F.count("*").alias("orders"), F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
            F.countDistinct(F.when(~F.col("is_guest"), F.col("customer_id"))).alias("customers"))
        kinds = self.fact.agg(F.countDistinct("item_id").alias("items"))
        return S.as_columns(head, kinds).withColumn("empty", F.col("lines") == 0)

    def kpis(self) -> DataFrame:
        return kpis.kpi_row(self.orders, self.wastage)

    def deltas(self) -> DataFrame:
        return kpis.kpi_deltas(series.daily(self.orders))

    def daily(self) -> DataFrame:
        return series.daily(self.orders).orderBy("date")

    def category_revenue(self) -> DataFrame:
        return kpis.category_revenue(self.fact, self.categories)

    def items(self) -> DataFrame:
        """Item economics on the slice with the item's menu-wide attributes (0, false or the id where the menu has none)."""
        here = self.fact.groupBy("item_id").agg(
            F.sum("quantity").alias("qty"), F.sum("revenue").cast(S.MONEY).alias("revenue"),
            F.sum("profit").cast(S.MONEY).alias("profit"), F.count_distinct("order_id").alias("orders"))
        numbers = ["base_price", "food_cost", "rating", "repeat_pct", "wastage_pct", "promo_dependency", "trend",
                   "demand_score", "profit_score"]
        names = self.categories.select("category_id", F.col("category_name").alias("category"))
        fixed = self.menu.select("item_id", "name", "category_id", "menu_class", "slow_mover", *numbers).join(names, "category_id", "left")
        margin = F.coalesce(S.ratio(F.col("profit"), F.col("revenue")), F.lit(0.0))
        return here.join(fixed, "item_id", "left").select(
            "item_id", F.coalesce("name", "item_id").alias("name"), F.coalesce("category", F.lit("")).alias("category"),
            "qty", "orders", "revenue", S.half_even(margin, 3).alias("margin"), "profit",
            F.coalesce("menu_class", F.lit(C.LOW_PERFORMER)).alias("menu_class"),
            F.coalesce("slow_mover", F.lit(False)).alias("slow_mover"),
            *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in numbers],
        ).orderBy(F.desc("revenue"), "item_id")

    def class_counts(self) -> DataFrame:
        return items.class_counts(self.items())

    def most_wasted(self, rows: int = 6) -> DataFrame:
        return self.items().orderBy(F.desc("wastage_pct"), F.desc("revenue"), "item_id").limit(rows).select(
            "item_id", "name", "wastage_pct")

    def location_table(self) -> DataFrame:
        names = self.locations.select("location_id", "name")
        carried = []
        if self._outlets is not None:
            names = names.join(self._outlets.select("location_id", "waste_pct", "rating"), "location_id", "left")
            carried = [F.coalesce(c, F.lit(0.0)).alias(c) for c in ("waste_pct", "rating")]
        return (
            kpis.outlet_economics(self.orders).filter("revenue <> 0")
            .join(kpis.outlet_customers(self.orders), "location_id", "left")
            .join(kpis.star_and_drag(self.fact, self.menu), "location_id", "left")
            .join(kpis.outlet_channel(self.orders), "location_id", "left")
            .join(names, "location_id", "left")
            .select("location_id", "name", "revenue", "profit_pct", "aov",
                    F.coalesce("customers", F.lit(0)).alias("customers"),
                    F.coalesce("repeat_pct", F.lit(0.0)).alias("repeat_pct"), *carried, "star", "drag", "channel",
                    "channel_share")
            .orderBy(F.desc("revenue"), "location_id"))

    def channel_mix(self) -> DataFrame:
        return kpis.channel_mix(self.orders, self.channels)

    def segment_mix(self) -> DataFrame:
        """Customers of the slice per segment, fixed order, zero filled, beside the whole segment's profile."""
        buyers = self.orders.filter(~F.col("is_guest")).select("customer_id").distinct()
        counts = buyers.join(self.segments.select("customer_id", "segment"), "customer_id").agg(
            *[F.count_if(F.col("segment") == s).alias(s) for s in C.SEGMENTS])
        rows = F.array(*[F.struct(F.lit(n).alias("position"), F.lit(s).alias("segment"),
                                  F.col(f"`{s}`").alias("customers")) for n, s in enumerate(C.SEGMENTS, 1)])
        mix = counts.select(F.explode(rows).alias("r")).select("r.*")
        if self._profile is None:
            return mix
        return mix.join(self._profile.drop("position", "customers"), "segment", "left").orderBy("position")


def filter_options(menu: DataFrame, locations: DataFrame, categories: DataFrame, promotions: DataFrame,
                   channels: DataFrame) -> DataFrame:
    """Every value a filter can take, as ``(filter, value)`` rows."""
    def part(name: str, df: DataFrame, column: str) -> DataFrame:
        return df.select(F.lit(name).alias("filter"), F.col(column).cast("string").alias("value")).distinct()

    fixed = locations.sparkSession.range(1).select(F.explode(F.array(
        *[F.struct(F.lit("classes").alias("filter"), F.lit(k).alias("value")) for k in C.CLASSES],
        *[F.struct(F.lit("segments").alias("filter"), F.lit(s).alias("value")) for s in C.SEGMENTS])).alias("r"))
    parts = [part("locations", locations, "name"), part("categories", categories, "category_name"),
             part("promotions", promotions, "name"), part("channels", channels, "channel"),
             part("items", menu, "name"), fixed.select("r.*")]
    return reduce(DataFrame.unionByName, parts).orderBy("filter", "value")
