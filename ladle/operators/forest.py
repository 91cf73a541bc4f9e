"""Extremely randomised trees grown level by level over DataFrames.

Every tree sees all rows. A node draws a few features that vary in it and one threshold for each, uniformly between the
feature's least and greatest value there; the draw hashes (seed, tree, node, feature). A level takes two aggregates over
the pairs of a row and a tree in which the row isn't settled yet: class counts of both sides of every candidate, and,
where a child is still mixed, the bounds of its features. Nodes of at most LOCAL_ROWS rows leave the levels: each is
finished with all that is below it by one task. Counts, bounds and draws are the same on both ways, so a forest depends
neither on partitions nor on where a node was split.

Levels are stored tables. Spark broadcasts a level's splits while they are small and shuffles them with the rows beyond.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

#: Rows of a node (in one tree) that one task holds to finish it.
LOCAL_ROWS = 50_000
#: Levels after which pairs of row and tree are stored: bounds the plan of one job.
STORED_LEVELS = 3
#: Leaf shares are summed as integers of this unit, so that no sum depends on its order.
SHARE_UNIT = 1_000_000_000

Store = Callable[[str, DataFrame], DataFrame]


@dataclass
class Forest:
    """Trees as tables: the roots; per level the split nodes (tree, node, feature, threshold, left, right counts); and
    below, the nodes that tasks finished (tree, sub, node, feature, threshold, counts), where sub is the node begun with.

    A node's children are 2 * node and 2 * node + 1, the root is 1; values up to the threshold go left.
    """

    trees: int
    features: int
    classes: int
    roots: DataFrame
    below: DataFrame
    levels: list[DataFrame] = field(default_factory=list)

    def nodes(self) -> DataFrame:
        """(tree, node, feature, threshold, counts) of all nodes; feature and threshold are null in leaves."""
        told = self.roots.select("tree", "node", "counts")
        splits = self.below.filter("feature is not null").select("tree", "node", "feature", "threshold")
        for level in self.levels:
            told = told.unionByName(level.select("tree", F.explode(F.array(
                F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("counts")),
                F.struct((F.col("node") * 2 + 1).alias("node"), F.col("right").alias("counts")))).alias("child")).select("tree", "child.*"))
            splits = splits.unionByName(level.select("tree", "node", "feature", "threshold"))
        told = told.unionByName(self.below.filter("node <> sub").select("tree", "node", "counts"))
        return told.join(splits, ["tree", "node"], "left")


# -- draws: the same in Spark and in NumPy ------------------------------------
_P = [np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]
_TURN, _AT = 1, 2


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _hash_long(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """xxHash64 of one 8-byte number, as the SQL function takes it."""
    h = seed + _P[4] + np.uint64(8)
    h = _turned(h ^ (_turned(value.astype(np.int64).view(np.uint64) * _P[1], 31) * _P[0]), 27) * _P[0] + _P[3]
    h = (h ^ (h >> np.uint64(33))) * _P[1]
    h = (h ^ (h >> np.uint64(29))) * _P[2]
    return h ^ (h >> np.uint64(32))


def _hashes(seed: int, tree: int, node: np.ndarray, feature: int, what: int) -> np.ndarray:
    h = np.full(len(node), 42, dtype=np.uint64)
    for part in (seed, tree, node, feature, what):
        h = _hash_long(np.broadcast_to(np.asarray(part, dtype=np.int64), len(node)).copy(), h)
    return h


def _hash_column(seed: int, feature: int, what: int) -> Column:
    return F.xxhash64(*[c.cast("long") for c in (F.lit(seed), F.col("tree"), F.col("node"), F.lit(feature), F.lit(what))])


def _columns(features: int) -> list[str]:
    return [f"x{f}" for f in range(features)]


def _value(feature: Column, features: int) -> Column:
    """The row's value of a feature named by number."""
    out = F.col(f"x{features - 1}")
    for f in range(features - 1):
        out = F.when(feature == f, F.col(f"x{f}")).otherwise(out)
    return out


class _Candidates:
    """From bounds, (tree, node, f0, t0, f1, t1, ...) of the nodes in which a feature varies; null beyond what varies."""

    def __init__(self, features: int, tried: int, seed: int):
        def option(f: int) -> Column:
            low, high = F.col(f"a{f}"), F.col(f"z{f}")
            drawn = F.shiftrightunsigned(_hash_column(seed, f, _AT), 11) / F.lit(float(1 << 53))
            at = low + drawn * (high - low)
            return F.when(low < high, F.struct(_hash_column(seed, f, _TURN).alias("turn"), F.lit(f).alias("f"),
                                               F.when(at < high, at).otherwise(low).alias("t")))

        self.options = F.array_sort(F.filter(F.array(*[option(f) for f in range(features)]), lambda o: o.isNotNull())).alias("o")
        self.columns = [c for i in range(tried) for c in (F.get("o", F.lit(i))["f"].alias(f"f{i}"), F.get("o", F.lit(i))["t"].alias(f"t{i}"))]

    def of(self, bounds: DataFrame) -> DataFrame:
        return bounds.select("tree", "node", self.options).filter("size(o) > 0").select("tree", "node", *self.columns)


def _bounds(features: int) -> list[Column]:
    return [c for f in range(features) for c in (F.min(f"x{f}").alias(f"a{f}"), F.max(f"x{f}").alias(f"z{f}"))]


def _purity(counts: list[Column]) -> Column:
    """Sum of squared class counts over their total: what a split wants to be large on both sides."""
    total, squares = counts[0], counts[0] * counts[0]
    for c in counts[1:]:
        total, squares = total + c, squares + c * c
    return squares.cast("double") / total


class _Best:
    """A level's splits: of each node's candidates the one with the purest sides, the first drawn on a tie."""

    def __init__(self, features: int, classes: int, tried: int):
        ks = range(classes)
        goes_left = [_value(F.col(f"f{i}"), features) <= F.col(f"t{i}") for i in range(tried)]
        self.sums = [*[F.count_if(F.col("label") == k).alias(f"n{k}") for k in ks],
                     *[F.count_if(goes_left[i] & (F.col("label") == k)).alias(f"l{i}_{k}") for i in range(tried) for k in ks],
                     *[F.max(c).alias(c) for i in range(tried) for c in (f"f{i}", f"t{i}")]]
        chosen = None
        for i in reversed(range(tried)):
            left = [F.col(f"l{i}_{k}") for k in ks]
            right = [F.col(f"n{k}") - F.col(f"l{i}_{k}") for k in ks]
            this = F.struct((_purity(left) + _purity(right)).alias("score"), F.col(f"f{i}").alias("feature"), F.col(f"t{i}").alias("threshold"),
                            F.array(*left).alias("left"), F.array(*right).alias("right"))
            if chosen is not None:
                this = F.when(chosen["feature"].isNull() | (this["score"] >= chosen["score"]), this).otherwise(chosen)
            chosen = this
        self.chosen = chosen.alias("b")

    def of(self, pairs: DataFrame) -> DataFrame:
        return (pairs.groupBy("tree", "node").agg(*self.sums).select("tree", "node", self.chosen)
                .select("tree", "node", "b.feature", "b.threshold", "b.left", "b.right"))


def _mixed(counts: Column) -> Column:
    return F.size(F.filter(counts, lambda c: c > 0)) > 1


class _Moves:
    """Pairs at a level's split nodes, at the child on their side, where that child is mixed; n is the child's rows."""

    def __init__(self, features: int):
        total = "aggregate({0}, 0L, (a, c) -> a + c) AS n{0}"
        self.split = ["tree", "node", "feature", "threshold", _mixed(F.col("left")).alias("l"), _mixed(F.col("right")).alias("r"),
                      *[F.expr(total.format(side)) for side in ("left", "right")]]
        self.side = (_value(F.col("feature"), features) > F.col("threshold")).alias("side")
        self.row = [*_columns(features), "label", "tree"]

    def of(self, pairs: DataFrame, level: DataFrame) -> DataFrame:
        return (pairs.select(*self.row, "node").join(level.select(*self.split), ["tree", "node"])
                .select(*self.row, "node", "l", "r", "nleft", "nright", self.side).filter("if(side, r, l)")
                .selectExpr(*self.row, "node * 2 + bigint(side) AS node", "if(side, nright, nleft) AS n"))


# -- nodes of bounded size, finished by one task ------------------------------
_BELOW_DDL = "tree int, sub long, node long, feature int, threshold double, counts array<long>"
_BELOW = pa.schema([("tree", pa.int32()), ("sub", pa.int64()), ("node", pa.int64()), ("feature", pa.int32()), ("threshold", pa.float64()),
                    ("counts", pa.list_(pa.int64()))])


def grow_below(x: np.ndarray, y: np.ndarray, tree: int, sub: int, classes: int, tried: int, max_depth: int, seed: int) -> pa.Table:
    """All nodes from node `sub` on for rows x (rows x features) of labels y: the levels' rules on arrays."""
    features = x.shape[1]
    at, out = np.full(len(y), sub, dtype=np.int64), []
    for depth in range(int(sub).bit_length() - 1, max_depth + 1):
        order = np.argsort(at, kind="stable")
        at, x, y = at[order], x[order], y[order]
        begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        node, length = at[begin], np.diff(np.append(begin, len(at)))
        ones = (y[:, None] == np.arange(classes)).astype(np.int64)
        counts = np.add.reduceat(ones, begin)
        low, high = np.minimum.reduceat(x, begin), np.maximum.reduceat(x, begin)
        varies = low < high
        splits = ((counts > 0).sum(axis=1) > 1) & varies.any(axis=1) & (depth < max_depth)
        turn = np.stack([_hashes(seed, tree, node, f, _TURN).view(np.int64) for f in range(features)], axis=1)
        drawn = np.stack([(_hashes(seed, tree, node, f, _AT) >> np.uint64(11)).astype(np.float64) for f in range(features)], axis=1) / float(1 << 53)
        cut = low + drawn * (high - low)
        cut = np.where(cut < high, cut, low)
        ranked = np.lexsort((turn, ~varies), axis=1)
        best, score = np.full(len(node), -1), np.full(len(node), -np.inf)
        segments = np.arange(len(node))
        for i in range(min(tried, features)):
            f = ranked[:, i]
            left = np.add.reduceat(ones * (x[np.arange(len(x)), np.repeat(f, length)] <= np.repeat(cut[segments, f], length))[:, None], begin)
            right = counts - left
            with np.errstate(divide="ignore", invalid="ignore"):
                pure = (left * left).sum(axis=1).astype(np.float64) / left.sum(axis=1) + (right * right).sum(axis=1).astype(np.float64) / right.sum(axis=1)
            better = varies[segments, f] & (pure > score)
            best, score = np.where(better, f, best), np.where(better, pure, score)
        feature = np.where(splits, best, 0)
        threshold = cut[segments, feature]
        out.append(pa.table({
            "tree": pa.array(np.full(len(node), tree), pa.int32()), "sub": pa.array(np.full(len(node), sub), pa.int64()), "node": node,
            "feature": pa.array(feature.astype(np.int32), mask=~splits), "threshold": pa.array(threshold, mask=~splits),
            "counts": pa.ListArray.from_arrays(np.arange(len(node) + 1, dtype=np.int32) * classes, counts.ravel())}).cast(_BELOW))
        go = np.repeat(splits, length)
        if not go.any():
            break
        right = x[np.arange(len(x)), np.repeat(feature, length)] > np.repeat(threshold, length)
        at, x, y = (at * 2 + right)[go], x[go], y[go]
    return pa.concat_tables(out)


def _below(pairs: DataFrame, features: int, classes: int, tried: int, max_depth: int, seed: int) -> DataFrame:
    """Nodes below for pairs (x..., label, tree, node), one task per (tree, node)."""
    def finish(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x = np.stack([np.asarray(table.column(f"x{f}"), dtype=np.float64) for f in range(features)], axis=1)
        return grow_below(x, np.asarray(table.column("label")), key[0].as_py(), key[1].as_py(), classes, tried, max_depth, seed)

    return pairs.groupBy("tree", "node").applyInArrow(finish, _BELOW_DDL)


def _usable() -> Column:
    return F.col("features").isNotNull() & ~F.exists("features", lambda x: x.isNull() | F.isnan(x))


def _wide(features: int) -> list[Column]:
    return [F.col("features")[f].alias(f"x{f}") for f in range(features)]


def grow(rows: DataFrame, features: int, classes: int, store: Store, trees: int = 350, tried: int | None = None,
         max_depth: int = 30, seed: int = 0, local_rows: int = LOCAL_ROWS) -> Forest:
    """A forest on rows (features array<double>, label int from 0): all rows, `tried` random features and thresholds a node.

    tried is the rounded-down square root of the number of features unless given. Nodes are split until pure, constant
    or max_depth (at most 60) deep; of equally good candidates the first drawn wins. Rows with a null or NaN feature or a
    null label are left out. An empty table gives a forest without roots.
    """
    tried = tried or max(1, int(features ** 0.5))
    usable = rows.filter(F.col("label").isNotNull() & _usable()).select(*_wide(features), "label")
    number = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    counts = F.array(*[F.count_if(F.col("label") == k) for k in range(classes)])
    bounds = _bounds(features)
    whole = store("root", usable.agg(counts.alias("counts"), *bounds, F.count("*").alias("n")).filter("n > 0"))
    size = sum(r["n"] for r in whole.select("n").collect())  # one row
    roots = whole.withColumn("tree", number).withColumn("node", F.lit(1).cast("long")).select("tree", "node", "counts")
    numbered = usable.withColumn("tree", number).withColumn("node", F.lit(1).cast("long"))
    below = lambda pairs: _below(pairs, features, classes, tried, max_depth, seed)
    forest = Forest(trees, features, classes, roots, store("below_0", below(numbered if size <= local_rows else numbered.limit(0))))
    if size <= local_rows:
        return forest
    candidates, best, moves = _Candidates(features, tried, seed), _Best(features, classes, tried), _Moves(features)
    first = whole.withColumn("tree", number).withColumn("node", F.lit(1).cast("long"))
    open_ = store("open_0", candidates.of(first.filter(_mixed(F.col("counts")))))
    pairs = numbered.join(open_, ["tree", "node"])
    for depth in range(1, max_depth + 1):
        level = store(f"level_{depth}", best.of(pairs))
        if level.isEmpty():
            break
        forest.levels.append(level)
        if depth == max_depth:
            break
        moved = store(f"pairs_{depth}", moves.of(pairs, level))
        small = store(f"below_{depth}", below(moved.filter(F.col("n") <= local_rows).drop("n")))
        forest.below = forest.below.unionByName(small)
        large = moved.filter(F.col("n") > local_rows).drop("n")
        open_ = store(f"open_{depth}", candidates.of(large.groupBy("tree", "node").agg(*bounds)))
        pairs = large.join(open_, ["tree", "node"])
    return forest


# -- prediction ---------------------------------------------------------------
def _reached(features: int, keys: list[str], out: pa.Schema):
    """For rows that come to one subtree: the counts of the leaf each reaches."""
    def walk(rows: pa.Table, nodes: pa.Table) -> pa.Table:
        if not rows.num_rows or not nodes.num_rows:
            return out.empty_table()
        nodes = nodes.sort_by("node")
        number = np.asarray(nodes.column("node"))
        feature = np.asarray(nodes.column("feature").fill_null(-1))
        threshold = np.asarray(nodes.column("threshold").fill_null(0.0))
        x = np.stack([np.asarray(rows.column(f"x{f}"), dtype=np.float64) for f in range(features)], axis=1)
        at = np.zeros(len(x), dtype=np.int64)  # sub is the least number of its nodes
        going = np.flatnonzero(feature[at] >= 0)
        while len(going):
            here = at[going]
            right = x[going, feature[here]] > threshold[here]
            at[going] = np.searchsorted(number, number[here] * 2 + right)
            going = going[feature[at[going]] >= 0]
        return rows.select([*keys, "tree"]).append_column("counts", nodes.column("counts").take(pa.array(at)).cast(pa.list_(pa.int64()))).cast(out)

    return walk


def leaves_of(forest: Forest, rows: DataFrame, keys: list[str], store: Store, block: int = 200_000) -> DataFrame:
    """(keys, tree, counts): the leaf that each row reaches in each tree. Rows with a null or NaN feature have none.

    Rows come to a subtree in blocks of about `block`, so that no task holds all rows of a large table.
    """
    x = _columns(forest.features)
    usable = rows.filter(_usable())
    blocks = max(1, -(-usable.count() // block))
    at = (usable.select(*keys, *_wide(forest.features), F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int").alias("block"),
                        F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))).alias("tree")).join(forest.roots, "tree"))
    for depth, level in enumerate(forest.levels, 1):
        here = F.col("feature").isNotNull()
        side = _value(F.col("feature"), forest.features) > F.col("threshold")
        at = at.join(level, ["tree", "node"], "left").withColumn("side", side).select(
            *keys, *x, "block", "tree", F.when(here, F.col("node") * 2 + F.col("side").cast("long")).otherwise(F.col("node")).alias("node"),
            F.when(here & F.col("side"), F.col("right")).when(here, F.col("left")).otherwise(F.col("counts")).alias("counts"))
        if depth % STORED_LEVELS == 0:
            at = store(f"routed_{depth}", at)
    subs = forest.below.filter("node = sub").select("tree", F.col("sub").alias("node")).withColumn("goes_on", F.lit(True))
    if forest.levels:
        at = store("routed", at)
    routed = at.join(subs, ["tree", "node"], "left")
    every = forest.below.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    schema = StructType([*rows.select(*keys).schema.fields, StructField("tree", IntegerType()), StructField("counts", ArrayType(LongType()))])
    walked = (routed.filter("goes_on").select(*keys, *x, "tree", "block", F.col("node").alias("sub")).groupBy("tree", "sub", "block")
              .cogroup(every.groupBy("tree", "sub", "block")).applyInArrow(_reached(forest.features, keys, to_arrow_schema(schema)), schema))
    return routed.filter("goes_on is null").select(*keys, "tree", "counts").unionByName(walked)


def predict(forest: Forest, rows: DataFrame, keys: list[str], store: Store) -> DataFrame:
    """(keys, shares array<long>, prediction int): leaf shares of the classes summed over trees, and the largest's class.

    Ties go to the lower class. A row without usable features has no result.
    """
    share = [F.expr(f"(counts[{i}] * {SHARE_UNIT}L) div aggregate(counts, 0L, (a, c) -> a + c)") for i in range(forest.classes)]
    shares = leaves_of(forest, rows, keys, store).groupBy(*keys).agg(F.array(*[F.sum(s) for s in share]).alias("shares"))
    return shares.withColumn("prediction", (F.array_position("shares", F.array_max("shares")) - 1).cast("int"))
