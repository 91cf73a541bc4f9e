"""Extra-trees and multinomial boosting against plain versions."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from ladle.operators import boosting, forest


@pytest.fixture(scope="module")
def cells(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(500, 4)), 2)
    x[:40, 1] = 0.5
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(int) + 2 * (x[:, 3] > 0.3)
    y[rng.random(500) < 0.1] = 0
    rows = [(i, [float(v) for v in r], int(k)) for i, (r, k) in enumerate(zip(x, y))]
    return rows, spark.createDataFrame(rows, "id long, features array<double>, label int")


@pytest.fixture
def store(tmp_path):
    number = itertools.count()

    def keep(name, df):
        path = str(tmp_path / f"{next(number)}_{name}")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return keep


def plain_tree(x, y, tree, classes, tried, max_depth, seed):
    """Recursive growth with draws taken from Spark's own hash."""
    out, wanted = {}, []

    def draws(node):
        return wanted.append(node)

    def grow(node, rows, drawn):
        counts = [int((y[rows] == k).sum()) for k in range(classes)]
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        varying = [f for f in range(x.shape[1]) if low[f] < high[f]]
        out[node] = (None, None, counts)
        if sum(c > 0 for c in counts) < 2 or not varying or node.bit_length() - 1 >= max_depth:
            return []
        if node not in drawn:
            draws(node)
            return [node]
        best = None
        for f in sorted(varying, key=lambda f: drawn[node][f][0])[:tried]:
            u = ((drawn[node][f][1] & (1 << 64) - 1) >> 11) / float(1 << 53)
            t = low[f] + u * (high[f] - low[f])
            t = t if t < high[f] else low[f]
            left = rows[x[rows, f] <= t]
            right = rows[x[rows, f] > t]
            score = sum(sum(int((y[s] == k).sum()) ** 2 for k in range(classes)) / len(s) for s in (left, right))
            if best is None or score > best[0]:
                best = (score, f, t, left, right)
        out[node] = (best[1], best[2], counts)
        return grow(2 * node, best[3], drawn) + grow(2 * node + 1, best[4], drawn)

    return out, grow, wanted


def test_forest_equals_brute_force(spark, cells, store):
    rows, df = cells
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    grown = forest.grow(df, 4, 4, store, trees=3, tried=2, max_depth=12, seed=5)
    got = {(r.tree, r.node): (r.feature, r.threshold, r.counts) for r in grown.nodes().collect()}
    for tree in range(3):
        drawn = {}
        while True:
            out, grow, _ = plain_tree(x, y, tree, 4, 2, 12, 5)
            missing = grow(1, np.arange(len(y)), drawn)
            if not missing:
                break
            ask = spark.createDataFrame([(n,) for n in missing], "node long").withColumn("tree", F.lit(tree))
            hashes = [forest._hash_column(5, f, w).alias(f"h{f}_{w}") for f in range(4) for w in (forest._TURN, forest._AT)]
            for r in ask.select("node", *hashes).collect():
                drawn[r.node] = [(r[f"h{f}_{forest._TURN}"], r[f"h{f}_{forest._AT}"]) for f in range(4)]
        assert {n: v for (t, n), v in got.items() if t == tree} == out


def test_forest_is_the_same_by_levels_in_tasks_and_for_any_partitions(cells, store):
    _, df = cells
    found = []
    for frame, local in ((df, 10**6), (df.repartition(5), 0), (df.coalesce(1), 60)):
        grown = forest.grow(frame, 4, 4, store, trees=5, max_depth=9, seed=1, local_rows=local)
        nodes = sorted((r.tree, r.node, r.feature, r.threshold, r.counts) for r in grown.nodes().na.fill({"feature": -1, "threshold": 0.0}).collect())
        found.append((nodes, sorted((r.id, r.shares, r.prediction) for r in forest.predict(grown, df, ["id"], store).collect())))
        blocks = forest.leaves_of(grown, df, ["id"], store, block=100)
        assert blocks.count() == 5 * df.count()
    assert found[0] == found[1] == found[2]
    assert max(n for _, n, *_ in found[0][0]).bit_length() - 1 <= 9


def test_forest_learns_and_meets_odd_rows(cells, store, spark):
    rows, df = cells
    grown = forest.grow(df.filter("id % 4 > 0"), 4, 4, store, trees=60, seed=2)
    joined = forest.predict(grown, df, ["id"], store).join(df, "id")
    held = joined.filter("id % 4 = 0").agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert held > 0.7 and joined.count() == len(rows)
    odd = spark.createDataFrame([(1, None, 0), (2, [1.0, None, 0.0, 0.0], 1), (3, [float("nan")] * 4, 2), (4, [0.0] * 4, None)],
                                "id long, features array<double>, label int")
    assert forest.predict(grown, odd, ["id"], store).count() == 1
    same = forest.grow(df.unionByName(odd).filter("id % 4 > 0 or id < 5 and label is null"), 4, 4, store, trees=60, seed=2)
    assert same.nodes().exceptAll(grown.nodes()).count() == 0
    nothing = forest.grow(df.limit(0), 4, 4, store, trees=3)
    assert nothing.nodes().count() == 0 and forest.predict(nothing, df, ["id"], store).count() == 0


def plain_boosting(bins, y, classes, width, rounds, rate, depth):
    """Exact greedy trees on bins by loops."""
    n, scores = len(y), np.log(np.array([max((y == k).sum(), 1e-9) / len(y) for k in range(classes)]))[None].repeat(len(y), 0)
    for _ in range(rounds):
        p = np.exp(scores - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        step = np.zeros((n, classes))
        for k in range(classes):
            g, h = (y == k) - p[:, k], p[:, k] * (1 - p[:, k])

            def grow(rows, level, g=g, h=h, k=k):
                if level == depth:
                    step[rows, k] = rate * (classes - 1) / classes * g[rows].sum() / max(h[rows].sum(), 1e-12) if len(rows) else 0
                    return
                best = (1e-9, None, None)
                for f, b in itertools.product(range(bins.shape[1]), range(width)):
                    left, right = rows[bins[rows, f] <= b], rows[bins[rows, f] > b]
                    if len(left) and len(right):
                        gain = g[left].sum() ** 2 / h[left].sum() + g[right].sum() ** 2 / h[right].sum() - g[rows].sum() ** 2 / h[rows].sum()
                        if gain > best[0] + 1e-9:
                            best = (gain, f, b)
                if best[1] is None:
                    grow(rows, level + 1)
                else:
                    grow(rows[bins[rows, best[1]] <= best[2]], level + 1)
                    grow(rows[bins[rows, best[1]] > best[2]], level + 1)

            grow(np.arange(n), 0)
        scores = scores + step
    return scores


def test_boosting_equals_brute_force_in_a_task_and_by_aggregates(cells, store):
    rows, df = cells
    models = [boosting.fit(df, 4, 4, store, rounds=3, bins=8), boosting.fit(df.repartition(3), 4, 4, store, rounds=3, bins=8, local_rows=0)]
    binned = {r.id: r.b for r in df.select("id", boosting.binned(models[0].cuts).alias("b")).collect()}
    y = np.array([r[2] for r in rows])
    want = plain_boosting(np.array([binned[i] for i in range(len(rows))]), y, 4, 8, 3, 0.15, 3)
    for model in models:
        got = {r.id: r for r in boosting.predict(model, df, ["id"]).collect()}
        assert np.allclose(np.array([got[i].scores for i in range(len(rows))]), want, atol=1e-6)
        assert all(got[i].prediction == int(np.argmax(got[i].scores)) for i in got)
    assert [[t.feature for t in r] for r in models[0].rounds] == [[t.feature for t in r] for r in models[1].rounds]


def test_boosting_learns_and_meets_odd_rows(cells, store, spark):
    rows, df = cells
    model = boosting.fit(df.filter("id % 4 > 0"), 4, 4, store, rounds=40)
    assert len(model.rounds) == 40
    held = boosting.predict(model, df, ["id"]).join(df, "id").filter("id % 4 = 0")
    assert held.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0] > 0.75
    odd = spark.createDataFrame([(2, [1.0, None, 0.0, 0.0], 1), (3, [float("nan")] * 4, 2)], "id long, features array<double>, label int")
    assert boosting.predict(model, odd, ["id"]).count() == 2
    assert boosting.fit(df.limit(0), 4, 4, store).rounds == []
