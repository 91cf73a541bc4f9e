import random

import pytest
from pyspark.sql import functions as F

from ladle.functions.selection import keys_at_ranks, step_of
from ladle.operators import customers


@pytest.mark.parametrize("small", [150, 5000])
def test_keys_at_ranks_equal_sorting(spark, small):
    rng = random.Random(small)
    values = [rng.choice([0.5, 0.5, 0.5, rng.random()]) for _ in range(3000)] + [None] * 40
    rows = [(v, f"c{rng.randint(0, 10**6)}") for v in values]
    df = spark.createDataFrame(rows, "v double, id string").repartition(5)
    ranks = [1, 2, 40, 41, 600, 601, 1500, 2999, 3040, 3041, 0]
    plain = sorted(values, key=lambda v: (v is not None, v or 0))
    assert keys_at_ranks(df, F.col("v"), ranks, small)[:2] == [None, None]
    assert keys_at_ranks(df.filter("v is not null"), F.col("v"), [1, 700, 1500, 3000], small) == [sorted(v for v in values if v is not None)[r - 1] for r in (1, 700, 1500, 3000)]
    pairs = sorted((r for r in rows if r[0] is not None))
    key = F.struct(F.col("v").alias("value"), "id")
    got = keys_at_ranks(df.filter("v is not null"), key, ranks, small)
    assert [None if g is None else tuple(g) for g in got] == [pairs[r - 1] if 1 <= r <= 3000 else None for r in ranks]
    assert plain[40] is not None and keys_at_ranks(df.limit(0), F.col("v"), [1]) == [None]


def test_one_key_that_most_rows_share_ends_the_search(spark):
    df = spark.range(50_000).select((F.col("id") / 49_000).cast("int").alias("k"))
    assert keys_at_ranks(df, F.col("k"), [1, 25_000, 49_000, 49_001, 50_000], small=100) == [0, 0, 0, 1, 1]


def test_steps(spark):
    df = spark.range(10)
    steps = df.select(step_of(F.col("id"), [2, 5], df.schema["id"].dataType).alias("s")).collect()
    assert [r.s for r in steps] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 2]


def test_rfm_on_text_ids_ranks_ties_by_id(spark):
    rng = random.Random(9)
    ids = [f"C{rng.randint(0, 10**9)}" for _ in range(503)]
    rows = [(i, rng.randint(0, 4), rng.randint(1, 3), float(rng.randint(0, 9))) for i in ids]
    df = spark.createDataFrame(rows, "customer_id string, recency int, frequency int, monetary double")
    got = {r.customer_id: (r.R, r.F, r.M) for r in customers.rfm_scores(df).collect()}
    plan = customers.rfm_scores(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan

    def bins(column):
        order = sorted(rows, key=lambda r: (r[column], r[0]))
        return {r[0]: max(1, -(-(k * 5) // (len(rows) - 1))) for k, r in enumerate(order)}

    r, f, m = bins(1), bins(2), bins(3)
    assert got == {i: (6 - r[i], f[i], m[i]) for i in ids}
    assert customers.rfm_scores(df.limit(0)).count() == 0
