"""Exact ranks and quantiles of unbounded tables without a one-task window.

A global ``row_number`` sorts the whole table in one task. Here rows are first put
into ordered cells of bounded size, cells are counted, and the rank is the number of
rows in earlier cells plus the row number inside the cell. Cut points only steer how
evenly rows spread; the ranks are exact whatever the cut points are.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_CELL = 1_000_000
MIN_CELLS, MAX_CELLS = 16, 4096


def cells_for(rows: int) -> int:
    """Number of cells so that one cell holds about a million rows."""
    return max(MIN_CELLS, min(MAX_CELLS, rows // ROWS_PER_CELL))


@dataclass(frozen=True)
class Cuts:
    """Distinct ordered cut points and how many quantiles fell on each.

    A weight above one marks a value that many rows share.
    """

    points: list[float]
    weights: list[int]

    @classmethod
    def of(cls, quantiles: list[float]) -> "Cuts":
        runs = [(point, len(list(same))) for point, same in groupby(sorted(quantiles))]
        return cls([p for p, _ in runs], [w for _, w in runs])

    def position(self, value: Column) -> Column:
        """Ordered cell number: odd on a cut point, even in the gaps between them.

        Two short array scans (block, then point in block) instead of one long one.
        """
        if not self.points:
            return F.lit(0)
        v = value.cast("double")
        step = max(1, int(len(self.points) ** 0.5))
        blocks = [self.points[i:i + step] for i in range(0, len(self.points), step)]
        lasts = F.array(*[F.lit(float(b[-1])) for b in blocks])
        nested = F.array(*[F.array(*[F.lit(float(p)) for p in b]) for b in blocks])
        block = F.size(F.filter(lasts, lambda p: p < v))
        inside = F.try_element_at(nested, block + 1)
        below = F.coalesce(F.size(F.filter(inside, lambda p: p < v)), F.lit(0))
        # beyond the last block every point is below
        below = F.when(block < len(blocks), below).otherwise(F.lit(len(self.points) - (len(blocks) * step)))
        on_cut = F.coalesce(F.array_contains(inside, v), F.lit(False)).cast("int")
        return ((block * step + below) * 2 + on_cut).cast("int")

    def weight(self, position: Column) -> Column:
        """Weight of the cut point a row sits on; 1 in a gap."""
        if max(self.weights, default=1) == 1:
            return F.lit(1)
        heavy = {2 * i + 1: w for i, w in enumerate(self.weights) if w > 1}
        table = F.create_map(*[F.lit(x) for pair in heavy.items() for x in pair])
        return F.coalesce(F.try_element_at(table, position), F.lit(1))


def value_cuts(df: DataFrame, columns: list[str], cells: int) -> dict[str, Cuts]:
    """Approximate quantile cut points per column, all columns in one pass.

    At most ``cells`` numbers per column reach the driver.
    """
    probabilities = [i / cells for i in range(1, cells)]
    found = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).approxQuantile(
        columns, probabilities, 1.0 / (2 * cells))
    return {c: Cuts.of(points) for c, points in zip(columns, found)}


def exact_rank(df: DataFrame, value: str, tie: str, out: str, cuts: dict[str, Cuts],
               source: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the 1-based rank by ``(value, tie)``; ``tie`` is a unique number.

    A value shared by very many rows is a cell of its own and is split further by the
    tie key, into as many parts as its share of the rows asks for. ``source`` may give
    the same rows in a form that is cheaper to count (when several ranks are chained).
    """
    cell = cuts[value].position(F.col(value))
    parts = cuts[value].weight(F.col("__cell"))
    slots = 2 * len(cuts[tie].points) + 1
    split = F.when(parts > 1, F.floor(cuts[tie].position(F.col(tie)) * parts / slots)).otherwise(0).cast("int")

    def place(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__cell", cell).withColumn("__split", split)

    placed = place(df)
    sizes = place((df if source is None else source).select(value, tie)).groupBy("__cell", "__split").agg(F.count("*").alias("__n"))
    # one row per cell and part: a few thousand rows at most
    earlier = Window.orderBy("__cell", "__split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "__cell", "__split", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__cell", "__split").orderBy(value, tie)
    return (
        placed.withColumn("__rn", F.row_number().over(within))
        .join(offsets, ["__cell", "__split"])
        .withColumn(out, (F.col("__before") + F.col("__rn")).cast("long"))
        .select(*df.columns, out)
    )


def quintile(rank: Column, rows: Column, bins: int = 5) -> Column:
    """Equal-width bin (1..bins) of a rank by interpolated edges, as a quantile cut gives."""
    edge = F.ceil(((rank - 1) * bins) / F.greatest(rows - 1, F.lit(1)))
    return F.greatest(F.lit(1), edge).cast("int")


def hashed_rank_in_class(df: DataFrame, label: str, keys: list[str], seed: int,
                         rank: str, size: str, slices: int = 1024) -> DataFrame:
    """Add a seeded pseudo-random rank inside each class and the class size.

    The hash is cut into equal slices, so even a class with most of the rows is
    ranked by many tasks. The result does not depend on how the table is partitioned.
    """
    h = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    placed = df.withColumn("__h", h).withColumn("__slice", F.pmod(F.shiftright("__h", 32), F.lit(slices)))
    sizes = placed.groupBy(label, "__slice").agg(F.count("*").alias("__n"))
    by_class = Window.partitionBy(label)
    earlier = by_class.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        label, "__slice",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__n").over(by_class).alias(size))
    within = Window.partitionBy(label, "__slice").orderBy("__h", *keys)
    return (
        placed.withColumn("__rn", F.row_number().over(within))
        .join(offsets, [label, "__slice"])
        .withColumn(rank, (F.col("__before") + F.col("__rn")).cast("long"))
        .select(*df.columns, rank, size)
    )


def first_per_group(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """First row of each group. Meant for aggregated frames, where groups are small."""
    rn = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("__rn", rn).filter("__rn = 1").drop("__rn")


def exact_quantile(df: DataFrame, value: str, q: float, out: str) -> DataFrame:
    """One-row frame with the linearly interpolated quantile of an unbounded column.

    Equal values collapse to one counted row first, then each cell of distinct values
    keeps its own running count; no task sees the whole column.
    """
    v = F.col(value).cast("double")
    counted = df.select(v.alias("__v")).filter("__v is not null").groupBy("__v").agg(F.count("*").alias("__n"))
    cuts = value_cuts(counted, ["__v"], cells_for(counted.count()))["__v"]
    placed = counted.withColumn("__cell", cuts.position(F.col("__v")))
    sizes = placed.groupBy("__cell").agg(F.sum("__n").alias("__size"))
    ordered = Window.orderBy("__cell")  # one row per cell
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select(
        "__cell",
        F.coalesce(F.sum("__size").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.sum("__size").over(everything).alias("__total"))
    running = F.sum("__n").over(Window.partitionBy("__cell").orderBy("__v"))
    ranged = placed.withColumn("__run", running).join(offsets, "__cell")
    last = F.col("__before") + F.col("__run") - 1
    first = last - F.col("__n") + 1
    position = F.lit(q) * (F.col("__total") - 1)

    def value_at(k: Column) -> Column:
        return F.max(F.when((first <= k) & (k <= last), F.col("__v")))

    low, high = value_at(F.floor(position)), value_at(F.ceil(position))
    weight = F.max(position - F.floor(position))
    return ranged.agg((low + (high - low) * weight).alias(out))
