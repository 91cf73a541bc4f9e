import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ladle.functions import ranking as R


def brute(rows):
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    return {r[0]: i for i, r in enumerate(order, 1)}


@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
def test_exact_rank_with_hot_value(spark, hot):
    rng = np.random.default_rng(3)
    rows = [(int(i), 7.0 if rng.random() < hot else float(rng.integers(0, 500))) for i in rng.permutation(3000)]
    df = spark.createDataFrame(rows, "id long, v double")
    cuts = R.value_cuts(df, ["v", "id"], 40)
    out = R.exact_rank(df, "v", "id", "rank", cuts)
    assert {r["id"]: r["rank"] for r in out.collect()} == brute(rows)


def test_hot_value_is_split_by_the_tie_key(spark):
    df = spark.range(4000).select("id", F.lit(1.0).alias("v"))
    cuts = R.value_cuts(df, ["v", "id"], 32)
    parts = df.select(cuts["v"].weight(cuts["v"].position(F.col("v"))).alias("w")).first().w
    assert parts > 20


def test_position_orders_values(spark):
    cuts = R.Cuts.of([1.0, 2.0, 2.0, 5.0, 9.0, 11.0, 30.0])
    values = [0.5, 1.0, 1.5, 2.0, 3.0, 5.0, 7.0, 9.0, 10.0, 11.0, 12.0, 30.0, 99.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(cuts.position(F.col("v"))).collect()]
    assert got == list(range(13))


@pytest.mark.parametrize("n", [5, 7, 52, 100, 143])
def test_quintiles_equal_rank_first_qcut(spark, n):
    df = spark.range(1, n + 1).select(F.col("id").alias("rank"))
    got = [r.b for r in df.select("rank", R.quintile(F.col("rank"), F.lit(n)).alias("b")).orderBy("rank").collect()]
    want = pd.qcut(pd.Series(range(1, n + 1)).rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    assert got == want


@pytest.mark.parametrize("q", [0.0, 0.5, 0.7, 1.0])
def test_exact_quantile(spark, q):
    values = [float(v) for v in np.random.default_rng(1).integers(0, 60, 501)] + [3.5] * 400
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    assert R.exact_quantile(df, "v", q, "x").first().x == pytest.approx(np.quantile(values, q))


def test_hashed_rank_is_independent_of_partitioning(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("c"))
    a = R.hashed_rank_in_class(df, "c", ["id"], 5, "r", "n")
    b = R.hashed_rank_in_class(df.repartition(7), "c", ["id"], 5, "r", "n")
    rows = {x["id"]: (x["r"], x["n"]) for x in a.collect()}
    assert rows == {x["id"]: (x["r"], x["n"]) for x in b.collect()}
    per_class = [sorted(r for i, (r, _) in rows.items() if i % 3 == c) for c in range(3)]
    assert all(p == list(range(1, len(p) + 1)) for p in per_class)
