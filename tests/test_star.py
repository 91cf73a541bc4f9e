from __future__ import annotations

import random
from datetime import datetime

from pyspark.sql import functions as F

from ladle.functions import scalars as S
from ladle.sources.star import StarTables

AT = datetime(2026, 1, 1)
# halves that a product of doubles misses, more than two places, signs, nulls and values beyond whole-number arithmetic
AMOUNTS = [0.0, -0.0, 0.01, 0.005, 1.005, 2.675, -2.675, 1.15, 84197.04, -7.25, 1e12, 9999999999999.99, 1e13, 123456789012345.67, 0.1 + 0.2, 1e-7, None]
DISCOUNTS = [0.0, 0.05, 0.07, 0.1, 1.0, -0.02, 0.055, 0.005, 1.01, 2.5, None]


def test_whole_cents_give_what_decimals_give(spark, tmp_path):
    """Lines and orders as the decimal formulas have them, for whole cents and for doubles that are none."""
    draw = random.Random(5)
    pairs = [(a, d) for a in AMOUNTS if not a or a < 1e9 for d in DISCOUNTS] + [(round(draw.uniform(0, 1e5), 2), round(draw.uniform(0, 0.1), 2)) for _ in range(500)]
    lines = [(i, 1, i % 3, float(draw.choice([0, 1, 7, 50])) if i % 40 else None, a, d, "N", "O", AT) for i, (a, d) in enumerate(pairs)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                          "l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "B", "T", 1.0)], "p_partkey long, p_brand string, p_type string, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    star = StarTables(spark, str(tmp_path))
    got = star.order_items()
    raw = spark.read.parquet(f"{tmp_path}/lineitem.parquet")
    want = raw.selectExpr(
        "l_orderkey AS order_id", "round(l_discount * 100) AS pct",
        "cast(round(cast(l_extendedprice AS decimal(18,2)) * (1 - cast(l_discount AS decimal(4,2))), 2) AS decimal(18,2)) AS net")
    both = got.join(want, "order_id")
    assert both.count() == len(lines)
    assert both.filter("not (discount_pct <=> int(pct)) or not (line_total <=> net)").count() == 0
    assert dict(got.dtypes)["line_total"] == "decimal(18,2)" and dict(got.dtypes)["unit_price"] == "decimal(14,4)"
    # the price per unit as the decimal formula has it, to the last place
    text = raw.selectExpr("l_orderkey AS order_id", "cast(((cast(cast(l_extendedprice AS decimal(18,2)) * 100 AS bigint) * 200 + cast(l_quantity AS int)) "
                          "div nullif(cast(l_quantity AS int) * 2, 0)) AS decimal(18,0)) * 0.0001BD AS exact")
    assert got.join(text, "order_id").filter("not (unit_price <=> exact)").count() == 0
    sums = spark.createDataFrame([(a,) for a in AMOUNTS], "v double").select(S.money(F.col("v")).alias("m"), F.col("v").cast(S.MONEY).alias("w"))
    assert sums.filter("not (m <=> w)").count() == 0 and sums.schema["m"].dataType == sums.schema["w"].dataType


def test_whole_cents_need_no_decimal_of_the_double(spark):
    """The text form of a double is made only where it is not whole cents."""
    of = lambda v: spark.createDataFrame([(v,)], "v double").select(S.whole_hundredths(F.col("v"), -1e13, 1e13)).first()[0]
    assert [of(v) for v in (84197.04, -7.25, 0.0, 1.005, 1e13, float("nan"), float("inf"), None)] == [True, True, True, False, False, False, False, None]
