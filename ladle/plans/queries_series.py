"""Daily series, peaks and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.operators import series
from ladle.plans.registry import query, rounded

_DAYS = "['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun']"
_MARKS = "['9a', '11a', '1p', '3p', '5p', '7p', '9p', '11p']"


def _daily(m):
    return m.daily


def _votes(m):
    """The hour-bearing table: orders carry a day only, ratings a time of day. Ratings without an outlet are outlet -1."""
    return m.ratings.fillna(-1, ["location_id"])


query("daily_series", "T1", lambda m: series.daily(m.orders), "SELECT * FROM daily")
query("waste_by_date", "T2", lambda m: series.waste_by_date(m.wastage),
      "SELECT date, CAST(sum(cost) AS DECIMAL(18,2)) AS waste FROM stock GROUP BY date")
query("moving_average", "D1", lambda m: series.moving_average(_daily(m), "revenue"),
      """SELECT date, revenue, round(avg(CAST(revenue AS DOUBLE)) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING
                AND CURRENT ROW), 4) AS moving_avg FROM daily""")
query("peak_monthly", "T4", lambda m: series.monthly(m.orders),
      "SELECT strftime(order_date, '%Y-%m') AS month, count(*) AS orders FROM order_facts GROUP BY 1")
query("weekday_weekend", "T5", lambda m: series.weekday_weekend(m.orders),
      """SELECT count_if(isodow(order_date) < 6) AS weekday, count_if(isodow(order_date) >= 6) AS weekend
         FROM order_facts""")
query("busiest_day", "T6", lambda m: series.busiest_day(m.orders),
      f"""SELECT {_DAYS}[dow] AS busiest_dow, orders FROM (SELECT isodow(order_date) AS dow, count(*) AS orders
          FROM order_facts GROUP BY 1 ORDER BY orders DESC, dow LIMIT 1)""")
query("busiest_hour", "T6", lambda m: series.busiest_hour(m.ratings, "rating_ts"),
      """SELECT CAST(hour(rating_ts) AS INTEGER) AS busiest_hour, count(*) AS orders FROM ratings
         GROUP BY 1 ORDER BY orders DESC, busiest_hour LIMIT 1""")
query("outlet_peaks", "T7", lambda m: series.outlet_peaks(_votes(m), "rating_ts"),
      f"""SELECT t.location_id, t.orders, {_DAYS}[d.dow] AS peak_day, CAST(h.hour AS INTEGER) AS peak_hour
          FROM (SELECT location_id, count(*) AS orders FROM votes GROUP BY location_id) t
          JOIN (SELECT location_id, dow FROM (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY n DESC, dow) AS rn
                FROM (SELECT location_id, isodow(rating_ts) AS dow, count(*) AS n FROM votes GROUP BY 1, 2)) WHERE rn = 1) d
            USING (location_id)
          JOIN (SELECT location_id, hour FROM (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY n DESC, hour) AS rn
                FROM (SELECT location_id, hour(rating_ts) AS hour, count(*) AS n FROM votes GROUP BY 1, 2)) WHERE rn = 1) h
            USING (location_id)""",
      "votes AS (SELECT * REPLACE (coalesce(location_id, -1) AS location_id) FROM ratings)")
query("orders_heatmap", "T8 J11 S11", lambda m: series.heatmap(m.ratings, "rating_ts"),
      f"""SELECT CAST(d AS INTEGER) AS dow, CAST(b AS INTEGER) AS bucket, {_DAYS}[d + 1] AS day,
                 {_MARKS}[b + 1] AS hour_mark, count(rating_id) AS orders
          FROM (SELECT unnest(generate_series(0, 6)) AS d) CROSS JOIN (SELECT unnest(generate_series(0, 7)) AS b)
          LEFT JOIN ratings ON isodow(rating_ts) - 1 = d
               AND CAST(greatest(0, ceil((hour(rating_ts) - 10) / 2.0)) AS INTEGER) = b
          GROUP BY d, b""")
query("fri_sun_share", "T9 S2", lambda m: series.fri_sun_share(_daily(m)),
      """SELECT CAST(round_even(CAST(sum(revenue) FILTER (isodow(date) >= 5) AS DOUBLE)
                     / CAST(sum(revenue) AS DOUBLE) * 100, 0) AS BIGINT) AS fri_sun_share_pct FROM daily""")


# -- forecast ---------------------------------------------------------------
def _model_views(prefix, source, group="'all'"):
    """Trend and weekday season of one series per group, as SQL."""
    return (
        f"""{prefix}_pos AS (SELECT {group} AS g, date, orders,
              row_number() OVER (PARTITION BY {group} ORDER BY date) - 1 AS t,
              count(*) OVER (PARTITION BY {group}) AS n FROM {source})""",
        f"""{prefix}_line AS (SELECT g, regr_slope(orders, t) AS slope, regr_intercept(orders, t) AS intercept,
              count(*) AS n, max(date) AS last_date FROM {prefix}_pos GROUP BY g)""",
        f"""{prefix}_season AS (SELECT p.g, isodow(date) AS dow, avg(orders - (intercept + slope * t)) AS season
              FROM {prefix}_pos p JOIN {prefix}_line USING (g) GROUP BY p.g, isodow(date))""",
        f"""{prefix}_ahead AS (
              SELECT f.g, f.step, f.date, greatest(0, intercept + slope * (n + step) + coalesce(season, 0)) AS predicted
              FROM (SELECT *, last_date + CAST(step + 1 AS INTEGER) AS date
                    FROM {prefix}_line, (SELECT unnest(generate_series(0, 13)) AS step)) f
              LEFT JOIN {prefix}_season s ON f.g = s.g AND isodow(f.date) = s.dow)""")


_TRAIN = _model_views("train", "(SELECT * FROM daily ORDER BY date LIMIT (SELECT count(*) - 14 FROM daily))")
_ALL = _model_views("full_series", "daily")
_HOLD = (*_TRAIN, """hold AS (
    SELECT p.date, p.actual, p.rn, greatest(0, intercept + slope * (p.t) + coalesce(season, 0)) AS predicted,
           (SELECT avg(orders) FROM train_pos) AS flat_mean
    FROM (SELECT date, orders AS actual, row_number() OVER (ORDER BY date) - 1 AS t,
                 row_number() OVER (ORDER BY date DESC) AS rn FROM daily) p
    CROSS JOIN train_line LEFT JOIN train_season s ON isodow(p.date) = s.dow WHERE rn <= 14)""")
_NEXT = (*_HOLD, *_ALL, """ahead AS (
    SELECT date, CAST(round_even(predicted, 0) AS BIGINT) AS orders,
           greatest(0, CAST(round_even(predicted - half, 0) AS BIGINT)) AS lo,
           CAST(round_even(predicted + half, 0) AS BIGINT) AS hi
    FROM (SELECT *, (SELECT sqrt(avg((actual - predicted) * (actual - predicted))) FROM hold)
                    * (1 + step * CAST(0.03 AS DOUBLE)) * 1.5 AS half FROM full_series_ahead))""")

query("trend_and_season", "T10",
      lambda m: rounded(series.fit(series.numbered(_daily(m).withColumn("g", F.lit("all")), "g"), "g").select(
          "slope", "intercept", F.explode("season").alias("dow", "season"))),
      """SELECT round(slope, 6) AS slope, round(intercept, 6) AS intercept, CAST(dow - 1 AS INTEGER) AS dow,
                round(season, 6) AS season FROM full_series_line JOIN full_series_season USING (g)""", *_ALL)
query("forward_projection", "T11 S23",
      lambda m: rounded(series.project(series.fit(series.numbered(
          _daily(m).withColumn("g", F.lit("all")), "g"), "g"), 14).select("date", "step", "predicted"), 4),
      "SELECT date, CAST(step AS INTEGER) AS step, round(predicted, 4) AS predicted FROM full_series_ahead", *_ALL)
query("holdout_metrics", "T12 T13", lambda m: series.holdout_metrics(_daily(m), m.cfg),
      """SELECT round_even(mae, 1) AS mae, round_even(rmse, 1) AS rmse, round_even(mape, 1) AS mape,
                round_even(1 - res / tot, 3) + 0 AS r2, round_even(flat, 1) AS baseline_mape,
                round_even((flat - mape) / flat * 100, 1) + 0 AS improvement
         FROM (SELECT avg(abs(actual - predicted)) AS mae, sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
                      avg(abs(actual - predicted) / actual) * 100 AS mape,
                      sum((actual - predicted) * (actual - predicted)) AS res, var_pop(actual) * count(*) AS tot,
                      avg(abs(actual - flat_mean) / actual) * 100 AS flat FROM hold)""", *_HOLD)
query("holdout_table", "T20", lambda m: series.holdout_table(_daily(m), m.cfg),
      """SELECT date, 'D-' || CAST(rn AS VARCHAR) AS day, actual, CAST(round_even(predicted, 0) AS BIGINT) AS predicted,
                CAST(actual - round_even(predicted, 0) AS BIGINT) AS error,
                abs(actual - round_even(predicted, 0)) > actual * CAST(0.12 AS DOUBLE) AS flagged FROM hold""", *_HOLD)
query("demand_forecast", "T14", lambda m: series.forecast(_daily(m), m.cfg), "SELECT * FROM ahead", *_NEXT)
query("demand_forecast_report", "T17", lambda m: series.forecast_report(_daily(m), m.cfg),
      """SELECT date, 'actual' AS type, orders, CAST(NULL AS BIGINT) AS lo, CAST(NULL AS BIGINT) AS hi FROM daily
         UNION ALL SELECT date, 'forecast', orders, lo, hi FROM ahead""", *_NEXT)
query("forecast_total", "T18", lambda m: series.forecast_total(_daily(m), m.cfg),
      "SELECT CAST(sum(orders) AS BIGINT) AS forecast_orders FROM ahead", *_NEXT)
query("widest_bands", "T19", lambda m: series.widest_bands(_daily(m), cfg=m.cfg),
      "SELECT * FROM ahead ORDER BY hi - lo DESC, date LIMIT 3", *_NEXT)


def _group_sql(key):
    return f"""SELECT g AS {key}, CAST(round_even(ahead, 0) AS BIGINT) AS "next", CAST(last AS BIGINT) AS "last",
                      coalesce(round_even((ahead - last) / nullif(last, 0) * 100, 1) + 0, 0) AS change_pct
               FROM (SELECT g, sum(predicted) AS ahead FROM grp_ahead GROUP BY g)
               JOIN (SELECT g, sum(orders) FILTER (t >= n - 14) AS last, max(n) AS n FROM grp_pos GROUP BY g) USING (g)
               WHERE n > 19"""


query("forecast_by_location", "T15",
      lambda m: series.group_forecasts(m.outlet_days, "location_id", m.cfg),
      _group_sql("location_id"),
      "by_outlet AS (SELECT location_id, order_date AS date, count(*) AS orders FROM order_facts GROUP BY 1, 2)",
      *_model_views("grp", "by_outlet", "location_id"))
query("forecast_by_category", "T16",
      lambda m: series.group_forecasts(series.daily_by_category(m.order_items), "category_id", m.cfg),
      _group_sql("category_id"),
      """by_category AS (SELECT category_id, order_date AS date, count(DISTINCT order_id) AS orders
                         FROM fact GROUP BY 1, 2)""",
      *_model_views("grp", "by_category", "category_id"))
