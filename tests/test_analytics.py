from datetime import date, datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from ladle.config import Config
from ladle.functions import scalars as S
from ladle.operators import anomalies, commerce, customers, items, recommend, series

# A few published rows: item, qty, margin, wastage %, rating, trend -> demand, profit, class, slow mover.
FEATURES = "item_id string, qty long, margin double, wastage_pct double, rating double, trend double"


def daily_frame(spark, values, start=date(2025, 1, 6)):
    rows = [(start + timedelta(days=i), int(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date date, orders long")


def test_classification_by_hand(spark):
    df = spark.createDataFrame([
        ("top", 100, 0.8, 10.0, 4.0, 5.0), ("busy", 90, 0.4, 10.0, 4.0, 0.0),
        ("gem", 20, 0.7, 5.0, 4.0, 0.0), ("weak", 0, 0.2, 20.0, 3.0, -1.0)], FEATURES)
    got = {r.item_id: r for r in items.classify(df).collect()}
    assert {k: v.menu_class for k, v in got.items()} == {
        "top": "Profit Driver", "busy": "Volume Driver", "gem": "Hidden Opportunity", "weak": "Low Performer"}
    assert got["weak"].profit_score == pytest.approx(0 - 0.2 * 0.9 - 0.12)
    assert got["weak"].slow_mover and not got["top"].slow_mover
    assert got["gem"].demand_score == pytest.approx(0.2)


def test_constant_column_scores_one_half(spark):
    df = spark.createDataFrame([("a", 5, 0.5, 0.0, 4.0, 0.0), ("b", 5, 0.5, 0.0, 4.0, 0.0)], FEATURES)
    assert {r.demand_score for r in items.classify(df).collect()} == {0.5}


def test_class_counts_show_empty_classes(spark):
    df = spark.createDataFrame([("Profit Driver",)], "menu_class string")
    assert [r["items"] for r in items.class_counts(df).collect()] == [1, 0, 0, 0]


def test_forecast_equals_least_squares(spark):
    rng = np.random.default_rng(0)
    y = 100 + 0.3 * np.arange(80) + np.tile([0, 1, 2, 3, 20, 30, 10], 12)[:80] + rng.integers(0, 9, 80)
    y = y.astype(int)
    got = series.project(series.fit(series.numbered(
        daily_frame(spark, y).withColumn("g", F.lit("all")), "g"), "g"), 14).orderBy("step").collect()
    t = np.arange(80)
    slope, intercept = np.polyfit(t, y, 1)
    resid = y - (intercept + slope * t)
    season = {d: resid[t % 7 == d].mean() for d in range(7)}  # the series starts on a Monday
    want = [max(0, intercept + slope * (80 + i) + season[(80 + i) % 7]) for i in range(14)]
    assert [r.predicted for r in got] == pytest.approx(want)


def test_holdout_beats_flat_mean_on_a_seasonal_series(spark):
    y = [50 + 10 * (i % 7) for i in range(70)]
    m = series.holdout_metrics(daily_frame(spark, y)).first()
    assert m.mape < m.baseline_mape and 0 <= m.r2 <= 1


def test_short_groups_are_left_out(spark):
    long = [("a", date(2025, 1, 1) + timedelta(days=i), 5) for i in range(30)]
    short = [("b", date(2025, 1, 1) + timedelta(days=i), 5) for i in range(19)]
    df = spark.createDataFrame(long + short, "g string, date date, orders long")
    rows = series.group_forecasts(df, "g").collect()
    assert [(r.g, r.next, r["last"], r.change_pct) for r in rows] == [("a", 70, 70, 0.0)]


def test_half_deltas(spark):
    df = daily_frame(spark, [10, 10, 15, 15, 10])
    assert series.half_deltas(df, ["orders"]).first().orders_delta == 100
    assert series.half_deltas(daily_frame(spark, [10]), ["orders"]).first().orders_delta == 0
    assert series.half_deltas(daily_frame(spark, [0, 9]), ["orders"]).first().orders_delta == 0


@pytest.mark.parametrize("hour,bucket", [(0, 0), (10, 0), (11, 1), (12, 1), (13, 2), (22, 6), (23, 7)])
def test_hour_buckets(spark, hour, bucket):
    assert spark.range(1).select(S.hour_bucket(F.lit(hour))).first()[0] == bucket


def test_heatmap_has_every_cell(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 6, 9),), (datetime(2025, 1, 6, 10),)], "ts timestamp")
    rows = series.heatmap(df, "ts").collect()
    assert len(rows) == 56 and sum(r.orders for r in rows) == 2


def test_text_functions(spark):
    one = spark.range(1)
    texts = [one.select(S.money_short(F.lit(v))).first()[0] for v in (1234567.0, 3400.0, 12.4)]
    assert texts == ["$1.23M", "$3.4k", "$12"]
    halves = [one.select(S.fixed(F.lit(v), 0)).first()[0] for v in (16.5, 17.5, -0.4)]
    assert halves == [f"{v:.0f}".replace("-0", "0") for v in (16.5, 17.5, -0.4)]
    assert one.select(S.half_even(F.lit(2.5), 0)).first()[0] == 2.0
    assert one.select(S.ratio(F.lit(1), F.lit(0))).first()[0] is None
    assert one.select(S.line_amount(F.lit(3), F.lit(Decimal("1.115")), F.lit(10))).first()[0] == Decimal("3.01")


def test_recency_floor_and_guests(spark):
    orders = spark.createDataFrame([
        (1, "c", False, datetime(2026, 9, 25, 18), Decimal("10.00"), 1, 2), (2, "c", False, datetime(2026, 9, 1), Decimal("5.50"), 0, 1),
        (3, "GUEST", True, datetime(2026, 9, 2), Decimal("9.00"), 0, 1)],
        "order_id long, customer_id string, is_guest boolean, order_ts timestamp, revenue decimal(18,2), promo_lines long, lines long")
    lines = spark.createDataFrame([("c", False, "x"), ("c", False, "y"), ("c", False, "x")],
                                  "customer_id string, is_guest boolean, category_id string")
    row = customers.customer_features(lines, orders, F.lit(date(2026, 9, 25))).collect()
    assert len(row) == 1 and row[0].recency == -1 and row[0].frequency == 2 and row[0].categories == 2
    assert row[0].promo_share == 33.0 and row[0].avg_order_value == 7.75


def test_segment_rules_cover_all_names(spark):
    df = spark.createDataFrame(
        [(1, 100, 1, Decimal("1.00"), 0.0), (2, 10, 2, Decimal("900.00"), 0.0), (3, 10, 3, Decimal("1.00"), 90.0),
         (4, 10, 9, Decimal("1.00"), 0.0), (5, 1, 1, Decimal("1.00"), 0.0), (6, 25, 1, Decimal("1.00"), 0.0)],
        "customer_id long, recency int, frequency long, monetary decimal(18,2), promo_share double")
    names = {r.customer_id: r.segment for r in customers.rule_segments(df).collect()}
    assert names == {1: "At-Risk", 2: "High-Value Loyal", 3: "Promotion-Driven", 4: "Frequent", 5: "New", 6: "Occasional"}


def test_rfm_with_text_ids(spark):
    df = spark.createDataFrame([(f"c{i}", i, 50 - i, Decimal(i)) for i in range(50)],
                               "customer_id string, recency int, frequency int, monetary decimal(18,2)")
    rows = {r.customer_id: (r.R, r.F, r.M) for r in customers.rfm_scores(df).collect()}
    assert rows["c0"] == (5, 5, 1) and rows["c49"] == (1, 1, 5)


@pytest.mark.parametrize("gap,margin,share,label", [
    (-9.0, 0.6, 9.0, "TRAP"), (-1.0, 0.49, 9.0, "TRAP"), (0.0, 0.58, 6.0, "GOOD"), (0.0, 0.58, 5.9, "OK"), (-8.9, 0.5, 9.0, "OK")])
def test_verdicts(spark, gap, margin, share, label):
    verdict, note = commerce.verdict(F.lit(gap), F.lit(margin), F.lit(share))
    row = spark.range(1).select(verdict.alias("v"), note.alias("n")).first()
    assert row.v == label and row.n


def test_elasticity_bands_and_prior(spark):
    rows, start = [], date(2025, 1, 6)
    for item, power in (("steep", -2.0), ("middle", -1.0), ("flat", 0.0)):
        for week in range(6):
            price = 10.0 + week
            rows.append((item, start + timedelta(weeks=week), int(round(1e6 * price ** power)), Decimal(str(price))))
    rows += [("few", start + timedelta(weeks=w), 10, Decimal("5.0")) for w in range(6)]
    fact = spark.createDataFrame(rows, "item_id string, order_date date, quantity int, unit_price decimal(14,4)")
    dim = spark.createDataFrame([(i, i, "c") for i in ("steep", "middle", "flat", "few")],
                                "item_id string, name string, category_id string")
    got = {r.item_id: r for r in commerce.elasticity(fact, dim).collect()}
    assert got["steep"].sensitivity == "Highly Price Sensitive" and got["steep"].elasticity == pytest.approx(-2.0)
    assert got["middle"].sensitivity == "Moderately Price Sensitive" and got["flat"].sensitivity == "Low Price Sensitivity"
    assert got["few"].elasticity == -0.9 and got["few"].basis.startswith("prior")


def test_what_if_base_scenario_changes_nothing_but_waste(spark):
    menu = spark.createDataFrame([("a", 520, 10.0, 4.0, 5.0)],
                                 "item_id string, qty long, base_price double, food_cost double, wastage_pct double")
    row = commerce.what_if(menu, [(0, 0, 0, 0)], F.lit(52.0)).first()
    assert (row.units, row.revenue, row.profit, row.price) == (10.0, 100.0, 60.0, 10.0)
    assert row.revenue_change == 0.0 and row.waste == pytest.approx(10 * 0.05 * 0.4 * 4)
    floor = commerce.what_if(menu, [(500, 0, 0, 0)], F.lit(52.0)).first()
    assert floor.units == pytest.approx(1.0)


def test_rating_burst_is_found(spark):
    at = datetime(2026, 9, 17, 20, 15)
    rows = [("M063", at, 5)] * 41 + [("M001", at + timedelta(hours=i), 5) for i in range(20)] + [("M002", None, 5)] * 30
    df = spark.createDataFrame(rows, "item_id string, rating_ts timestamp, stars int")
    found = anomalies.rating_bursts(df).collect()
    assert [(r.date, r.severity) for r in found] == [("2026-09-17", "medium")]
    assert found[0].detail == ("41 identical 5-star ratings on item M063 within one hour - possible non-organic ratings.")


def test_anomaly_report_order(spark):
    df = spark.createDataFrame(
        [("t", "l", "2020-01-02", "low", "d"), ("t", "l", "2020-01-03", "critical", "d"), ("t", "l", "2020-01-01", "high", "d")],
        "type string, location string, date string, severity string, detail string")
    assert [r.severity for r in anomalies.anomaly_report(df).collect()] == ["critical", "high", "low"]
    assert anomalies.anomaly_report(df, Config(anomaly_rows=1)).count() == 1


def test_recommendations_skip_empty_selections(spark):
    menu = spark.createDataFrame([("a", "Alpha", "Low Performer", 0.4, 3.9, 2.0, 10.0, 0.1)],
                                 "item_id string, name string, menu_class string, margin double, rating double, "
                                 "wastage_pct double, repeat_pct double, profit_score double")
    effect = spark.createDataFrame([], "promotion_id string, promotion string, order_share_pct double, margin_gap double, "
                                       "verdict string, note string")
    waste = spark.createDataFrame([("a", "Alpha", 34.1)], "item_id string, name string, wastage_pct double")
    segs = spark.createDataFrame([("At-Risk", 6427, 35)], "segment string, customers long, churn_pct int")
    prices = spark.createDataFrame([], "item_id string, name string, elasticity double, sensitivity string")
    recs = recommend.flattened(recommend.recommendations(menu, effect, waste, segs, prices)).collect()
    assert [r.position for r in recs] == [3, 4, 6]
    assert recs[1].evidence.startswith("6,427 customers with 35% churn probability | ")


def test_tricky_case_without_a_match_gives_no_row(spark):
    menu = spark.createDataFrame([("a", "A", "Low Performer", 5, 0.4, 1.0, 2.0, 4.0)],
                                 "item_id string, name string, menu_class string, qty long, margin double, "
                                 "wastage_pct double, promo_dependency double, rating double")
    assert [r.case_no for r in items.tricky_cases(menu).orderBy("case_no").collect()] == [1, 3, 4]
