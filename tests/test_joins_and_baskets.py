from collections import Counter
from datetime import date, timedelta
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from ladle.config import Config
from ladle.operators import asof, basket


def test_asof_equals_merge_asof(spark):
    rng = np.random.default_rng(7)
    start = date(2020, 1, 1)
    hist = {(f"i{rng.integers(0, 5)}", start + timedelta(days=int(rng.integers(60, 700)))): float(k) for k in range(80)}
    probes = [(k, f"i{rng.integers(0, 6)}", start + timedelta(days=int(rng.integers(0, 760)))) for k in range(400)]
    h = spark.createDataFrame([(i, d, v) for (i, d), v in hist.items()], "item string, d date, v double")
    p = spark.createDataFrame(probes, "k int, item string, t date")
    got = {r.k: r.out for r in asof.as_of_join(p, h, "item", "t", "d", "v", "out").collect()}
    pp = pd.DataFrame(probes, columns=["k", "item", "t"])
    pp["t"] = pd.to_datetime(pp.t)
    hh = pd.DataFrame([(i, d, v) for (i, d), v in hist.items()], columns=["item", "d", "v"])
    hh["d"] = pd.to_datetime(hh.d)
    want = pd.merge_asof(pp.sort_values("t"), hh.sort_values("d"), left_on="t", right_on="d", by="item")
    assert got == {int(k): (None if pd.isna(v) else v) for k, v in zip(want.k, want.v)}


@pytest.mark.parametrize("size", [3, 200])
def test_pair_counts_equal_brute_force(spark, size):
    """Also for an order larger than several join blocks."""
    rng = np.random.default_rng(2)
    orders = {o: {f"x{v:03d}" for v in rng.integers(0, 40, 4)} for o in range(60)}
    orders[999] = {f"x{v:03d}" for v in range(size)}
    want = Counter(pair for items in orders.values() for pair in combinations(sorted(items), 2))
    lines = [(o, i) for o, items in orders.items() for i in items]
    df = spark.createDataFrame(lines + lines[:10], "order_id long, item_id string")
    got = {(r.a, r.b): r.pair_orders for r in basket.pair_counts(basket.baskets(df)).collect()}
    assert got == dict(want)


def test_support_floor_is_halved_until_enough_rules(spark):
    assert basket.support_floors(Config()) == [0.004, 0.002, 0.001, 0.0005, 0.00025]
    metrics = spark.createDataFrame([(0.003,)] * 10 + [(0.0012,)] * 15, "support double")
    assert basket.chosen_floor(metrics, Config()).first().support_floor == 0.001
    few = spark.createDataFrame([(0.003,)], "support double")
    assert basket.chosen_floor(few, Config()).first().support_floor == 0.00025


def test_dropping_rare_items_loses_no_rule(spark):
    rows = [(o, i) for o in range(2000) for i in (["a", "b"] if o % 2 else ["a"])] + [(1, "rare")]
    lines = spark.createDataFrame(rows, "order_id long, item_id string")
    orders = lines.select("order_id").distinct()
    cfg = Config(min_support=0.01, support_stop=0.001)
    pairs = basket.all_metrics(basket.baskets(lines), orders, cfg).collect()
    assert [(r.a, r.b, r.pair_orders) for r in pairs] == [("a", "b", 1000)]
    assert pairs[0].support == 0.5 and pairs[0].confidence == 0.5 and pairs[0].lift == pytest.approx(1.0)
