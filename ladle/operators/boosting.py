"""Multinomial gradient boosting from histogram aggregates.

Features are binned once. A round grows one tree per class on the deviance's gradients: each of its levels is one
aggregate of gradients, Hessians and rows per (class, node, feature, bin) over all rows, and what reaches the driver are
those cells: classes x nodes x features x bins numbers, whatever the number of rows. Leaves take Newton steps. Scores
are an array column. Gradients are summed as integers of 2^-32, so a model doesn't depend on partitions. A table of at
most LOCAL_ROWS rows is fitted inside one task, whose histograms are NumPy's: the same rounds without a job per level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

UNIT = float(1 << 32)
#: Rounds after which rows with their scores are stored: bounds the lineage of a fit.
STORED_ROUNDS = 10

#: Binned rows that one task may hold to fit a model; histograms of larger tables are Spark aggregates.
LOCAL_ROWS = 50_000

Store = Callable[[str, DataFrame], DataFrame]


@dataclass(frozen=True)
class Tree:
    """A complete tree in heap order from 0: split features and the last bin that goes left; leaf values."""

    feature: list[int]
    bin: list[int]
    value: list[float]


@dataclass(frozen=True)
class Boosted:
    """Prior scores, cut points per feature (value <= cut: that bin or below), and per round one tree per class."""

    prior: list[float]
    cuts: list[list[float]]
    rounds: list[list[Tree]]
    depth: int


def cut_points(rows: DataFrame, features: int, bins: int, sample: int = 10_000) -> list[list[float]]:
    """At most bins - 1 ascending cut points per feature: quantiles of the `sample` rows of least hash (nulls and NaN apart).

    Cut points only steer how finely a feature is cut; the hash makes them the same for any partitions.
    """
    least = rows.select("features").orderBy(F.xxhash64("features"), "features").limit(sample).toArrow().column("features").to_pylist()
    out = []
    for f in range(features):
        values = np.array([r[f] for r in least if r[f] is not None and r[f] == r[f]], dtype=np.float64)
        out.append(sorted({float(q) for q in np.quantile(values, np.arange(1, bins) / bins, method="lower")}) if len(values) else [])
    return out


def binned(cuts: list[list[float]]) -> Column:
    """The features as bin numbers: how many cut points lie below the value; a null or NaN goes to bin 0."""
    def place(f: int) -> Column:
        value = F.col("features")[f]
        below = F.expr(f"size(filter({_array(cuts[f])}, cut -> cut < features[{f}]))")
        return F.when(value.isNull() | F.isnan(value), 0).otherwise(below).cast("int")

    return F.array(*[place(f) for f in range(len(cuts))])


def _array(values: list) -> str:
    """A SQL array of numbers. Spark folds it into one constant, so that plans of different rounds compile to the same code."""
    return "array(" + ", ".join(f"double('{v!r}')" if isinstance(v, float) else str(v) for v in values) + ")"


def _node(tree: Tree, levels: int) -> str:
    """Heap number of the node that a row of `bins` reaches after so many levels, as SQL."""
    at, features, cuts = "0", _array(tree.feature), _array(tree.bin)
    for _ in range(levels):
        at = f"(2 * {at} + 1 + int(get(bins, get({features}, {at})) > get({cuts}, {at})))"
    return at


def _added(trees: list[Tree], depth: int) -> str:
    """`scores` after one more round, as SQL."""
    return "array(" + ", ".join(
        f"scores[{k}] + get({_array(t.value)}, {_node(t, depth)} - {2 ** depth - 1})" for k, t in enumerate(trees)) + ")"


def _best_splits(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature and last left bin of the best split per node, and both sides' (gradient, Hessian).

    cells: nodes x features x bins x (gradient, Hessian, rows). A node that no split improves keeps all rows on the
    left. Ties go to the lower feature, then the lower bin.
    """
    nodes, features, bins, _ = cells.shape
    left = np.cumsum(cells, axis=2)
    total = left[:, :1, -1:, :]
    right = total - left
    usable = (left[..., 2] > 0) & (right[..., 2] > 0) & (left[..., 1] > 0) & (right[..., 1] > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[..., 0] ** 2 / left[..., 1] + right[..., 0] ** 2 / right[..., 1] - total[..., 0] ** 2 / total[..., 1]
    gain = np.where(usable, gain, 0.0).reshape(nodes, -1)
    best = gain.argmax(axis=1)
    none = gain[np.arange(nodes), best] <= 1e-12
    feature, last = np.where(none, 0, best // bins), np.where(none, bins, best % bins)
    rows = np.arange(nodes)
    sides = np.stack([left[rows, feature, np.minimum(last, bins - 1)], right[rows, feature, np.minimum(last, bins - 1)]], axis=1)
    return feature, last, sides[..., :2]


def _round(classes: int, features: int, width: int, depth: int, rate: float, histogram: Callable[[list[Tree], int], np.ndarray]) -> list[Tree]:
    """One tree per class. histogram(trees so far, level): (gradient, Hessian, rows) per class, node, feature and bin."""
    grown = [Tree([0] * (2 ** depth - 1), [width] * (2 ** depth - 1), [0.0] * 2 ** depth) for _ in range(classes)]
    for level in range(depth):
        nodes, first = 2 ** level, 2 ** level - 1
        feature, last, sides = _best_splits(histogram(grown, level).reshape(classes * nodes, features, width, 3))
        for k in range(classes):
            for i in range(nodes):
                grown[k].feature[first + i], grown[k].bin[first + i] = int(feature[k * nodes + i]), int(last[k * nodes + i])
        if level == depth - 1:
            # Newton step of the multinomial deviance
            step = (classes - 1) / classes * sides[..., 0] / np.maximum(sides[..., 1], 1e-12)
            value = np.where(sides[..., 1] > 1e-12, step, 0.0).reshape(classes, -1)
            for k in range(classes):
                grown[k].value[:] = [float(rate * v) for v in value[k]]
    return grown


_TREES = pa.schema([("number", pa.int32()), ("class", pa.int32()), ("feature", pa.list_(pa.int32())), ("bin", pa.list_(pa.int32())),
                    ("value", pa.list_(pa.float64()))])
_TREES_DDL = "number int, class int, feature array<int>, bin array<int>, value array<double>"


def _heap(tree: Tree, levels: int, bins: np.ndarray) -> np.ndarray:
    at, rows = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
    feature, cut = np.array(tree.feature), np.array(tree.bin)
    for _ in range(levels):
        at = 2 * at + 1 + (bins[rows, feature[at]] > cut[at])
    return at


def fit_rounds(bins: np.ndarray, label: np.ndarray, prior: list[float], width: int, rounds: int, rate: float, depth: int) -> list[list[Tree]]:
    """The rounds of a table that fits into one task: bins (rows x features) and labels."""
    classes, (rows, features) = len(prior), bins.shape
    scores, truth = np.tile(np.array(prior), (rows, 1)), label[:, None] == np.arange(classes)
    columns, done = np.arange(features), []
    for _ in range(rounds):
        powers = np.exp(scores - scores.max(axis=1, keepdims=True))
        p = powers / powers.sum(axis=1, keepdims=True)
        slope, curve = np.rint((truth - p) * UNIT), np.rint(p * (1 - p) * UNIT)

        def histogram(grown: list[Tree], level: int, slope=slope, curve=curve) -> np.ndarray:
            nodes, out = 2 ** level, []
            for k in range(classes):
                cell = (((_heap(grown[k], level, bins) - nodes + 1)[:, None] * features + columns) * width + bins).ravel()
                sums = [np.bincount(cell, w, nodes * features * width) for w in (np.repeat(slope[:, k], features), np.repeat(curve[:, k], features), None)]
                out.append(np.stack([sums[0] / UNIT, sums[1] / UNIT, sums[2]], axis=1))
            return np.concatenate(out)

        grown = _round(classes, features, width, depth, rate, histogram)
        for k, tree in enumerate(grown):
            scores[:, k] += np.array(tree.value)[_heap(tree, depth, bins) - 2 ** depth + 1]
        done.append(grown)
    return done


def _fit_in_task(binned_rows: DataFrame, prior: list[float], width: int, rounds: int, rate: float, depth: int) -> list[list[Tree]]:
    def task(batches):
        full = [b for b in batches if b.num_rows]
        if full:
            table = pa.Table.from_batches(full)
            bins = np.array(table.column("bins").to_pylist(), dtype=np.int64)
            for number, trees in enumerate(fit_rounds(bins, np.asarray(table.column("label")), prior, width, rounds, rate, depth)):
                yield pa.RecordBatch.from_pylist([{"number": number, "class": k, "feature": t.feature, "bin": t.bin, "value": t.value}
                                                  for k, t in enumerate(trees)], schema=_TREES)

    found = binned_rows.select("bins", "label").repartition(1).mapInArrow(task, _TREES_DDL).collect()  # rounds x classes rows
    trees = {(r["number"], r["class"]): Tree(r["feature"], r["bin"], r["value"]) for r in found}
    return [[trees[n, k] for k in range(len(prior))] for n in range(rounds)]


def fit(rows: DataFrame, features: int, classes: int, store: Store, rounds: int = 100, rate: float = 0.15, depth: int = 3,
        bins: int = 32, local_rows: int = LOCAL_ROWS) -> Boosted:
    """A model of rows (features array<double>, label int from 0). Rows without features or label are left out.

    Beyond local_rows, one aggregate per level: 3 x rounds passes over the binned rows. An empty table gives equal priors
    and no rounds.
    """
    usable = rows.select("features", "label").filter("features is not null and label is not null")
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    size = sum(counts.values())
    prior = [float(np.log(max(counts.get(k, 0), 1e-9) / size)) if size else 0.0 for k in range(classes)]
    if not size:
        return Boosted(prior, [[] for _ in range(features)], [], depth)
    cuts = cut_points(usable, features, bins)
    start = usable.select(binned(cuts).alias("bins"), F.col("label").cast("int").alias("label"), F.array(*[F.lit(p) for p in prior]).alias("scores"))
    width = max(len(c) for c in cuts) + 1
    if size <= local_rows:
        return Boosted(prior, cuts, _fit_in_task(start, prior, width, rounds, rate, depth), depth)
    scored, held, done = store("binned", start), [], []
    slopes = [f"bigint(round((double(label = {k}) - p[{k}]) * {UNIT})) AS g{k}" for k in range(classes)]
    curves = [f"bigint(round(p[{k}] * (1 - p[{k}]) * {UNIT})) AS h{k}" for k in range(classes)]
    for number in range(rounds):
        # gradients and Hessians of the deviance as integers, once per round
        sloped = (scored.selectExpr("bins", "label", "scores", "transform(scores, s -> exp(s - array_max(scores))) AS e")
                  .selectExpr("bins", "label", "scores", "transform(e, x -> x / aggregate(e, 0D, (a, y) -> a + y)) AS p")
                  .selectExpr("bins", "label", "scores", *slopes, *curves).persist())
        held.append(sloped)

        def histogram(grown: list[Tree], level: int, sloped=sloped) -> np.ndarray:
            nodes = 2 ** level
            parts = [f"transform(bins, (b, f) -> struct((({k * nodes - nodes + 1} + {_node(grown[k], level)}) * {features} + f) * {width} + b AS cell, "
                     f"g{k} AS g, h{k} AS h))" for k in range(classes)]
            found = (sloped.selectExpr(f"inline(flatten(array({', '.join(parts)})))").groupBy("cell")
                     .agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n")).toArrow())
            cells = np.zeros((classes * nodes * features * width, 3))
            for i, (name, unit) in enumerate((("g", UNIT), ("h", UNIT), ("n", 1))):
                cells[np.asarray(found.column("cell")), i] = np.asarray(found.column(name)) / unit
            return cells

        grown = _round(classes, features, width, depth, rate, histogram)
        done.append(grown)
        scored = sloped.selectExpr("bins", "label", f"{_added(grown, depth)} AS scores")
        if (number + 1) % STORED_ROUNDS == 0 and number + 1 < rounds:
            scored = store(f"round_{number + 1}", scored)
            while held:
                held.pop().unpersist()
        elif len(held) > 2:  # a round's rows are made from those of the round before
            held.pop(0).unpersist()
    while held:
        held.pop().unpersist()
    return Boosted(prior, cuts, done, depth)


def predict(model: Boosted, rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, scores array<double>, prediction int): the class of the highest score, the lower one on a tie.

    A null or NaN feature counts as the lowest bin. The trees travel with the tasks: rounds x classes x 2^depth numbers.
    """
    schema = StructType([*rows.select(*keys).schema.fields, StructField("scores", ArrayType(DoubleType())), StructField("prediction", IntegerType())])
    arrow = to_arrow_schema(schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = np.asarray(batch.column("bins").flatten(), dtype=np.int64).reshape(batch.num_rows, -1)
            scores = np.tile(np.array(model.prior), (len(bins), 1))
            for trees in model.rounds:
                for k, tree in enumerate(trees):
                    scores[:, k] += np.array(tree.value)[_heap(tree, model.depth, bins) - 2 ** model.depth + 1]
            ends = pa.array(np.arange(len(bins) + 1) * scores.shape[1], pa.int32())
            columns = [*[batch.column(k) for k in keys], pa.ListArray.from_arrays(ends, scores.ravel()), pa.array(scores.argmax(axis=1), pa.int32())]
            yield pa.Table.from_arrays(columns, names=arrow.names).cast(arrow).combine_chunks().to_batches()[0]

    return rows.select(*keys, binned(model.cuts).alias("bins")).mapInArrow(task, schema)
