"""KPI, outlet, pricing, promotion, wastage, anomaly, recommendation and slice queries."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.functions import scalars as S
from ladle.operators import anomalies, commerce, customers, kpis, recommend, series, slicing
from ladle.plans.queries_customers import PROFILE_CHANNEL, PROFILE_SQL
from ladle.plans.registry import query, rounded

# -- KPIs -------------------------------------------------------------------
_ACTIVITY = """activity AS (
  SELECT count(*) AS active_customers,
         round_even(coalesce(avg(CASE WHEN n > 1 THEN 1 ELSE 0 END) * 100, 0), 1) AS repeat_rate
  FROM (SELECT customer_id, count(*) AS n FROM order_facts WHERE NOT is_guest GROUP BY customer_id))"""


query(
    "kpi_row", "K1 W4 C11", lambda m: kpis.kpi_row(m.orders, m.wastage),
    """SELECT t.*, a.*, w.wastage_cost,
              coalesce(round_even(CAST(wastage_cost AS DOUBLE) / nullif(CAST(revenue AS DOUBLE), 0) * 100, 1), 0)
                AS wastage_rate
       FROM (SELECT CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue, CAST(sum(profit) AS DECIMAL(18,2)) AS profit,
                    count(*) AS orders, round(CAST(sum(revenue) AS DOUBLE) / count(*), 4) AS aov FROM order_facts) t,
            activity a, (SELECT CAST(sum(cost) AS DECIMAL(18,2)) AS wastage_cost FROM stock) w""", _ACTIVITY)
query("customer_activity", "C11", lambda m: customers.activity(m.orders), "SELECT * FROM activity", _ACTIVITY)

_HALVES = """halves AS (
  SELECT *, row_number() OVER (ORDER BY date) <= count(*) OVER () // 2 AS first_half FROM daily)"""


def _delta_sql(v, view="halves"):
    return f"""CAST(round_even(CAST(sum({v}) FILTER (NOT first_half) - sum({v}) FILTER (first_half) AS DOUBLE)
               / nullif(CAST(sum({v}) FILTER (first_half) AS DOUBLE), 0) * 100, 0) AS BIGINT) AS {v}_delta"""


query(
    "kpi_deltas", "K2 T3 T2", lambda m: kpis.kpi_deltas(m.daily, series.waste_by_date(m.wastage)),
    f"""SELECT d.*, w.* FROM (SELECT {_delta_sql('revenue')}, {_delta_sql('orders')}, {_delta_sql('profit')} FROM halves) d,
        (SELECT {_delta_sql('waste')} FROM waste_halves) w""", _HALVES,
    """waste_halves AS (SELECT *, row_number() OVER (ORDER BY date) <= count(*) OVER () // 2 AS first_half
       FROM (SELECT date, sum(cost) AS waste FROM stock GROUP BY date))""")
query(
    "category_revenue", "K3", lambda m: kpis.category_revenue(m.fact, m.categories),
    """SELECT category_name AS category, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue
       FROM fact JOIN categories USING (category_id) GROUP BY category_name""")
query(
    "channel_mix", "K4 J11", lambda m: kpis.channel_mix(m.orders, m.channels),
    """SELECT c.channel, count(o.order_id) AS orders FROM (SELECT DISTINCT channel FROM raw_orders) c
       LEFT JOIN order_facts o ON c.channel = o.channel GROUP BY c.channel""")
query(
    "overall_margin", "K5 J12", lambda m: kpis.overall_margin(m.orders),
    """SELECT round_even(CAST(sum(profit) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) * 100, 1) AS margin_pct
       FROM order_facts""")

_OUTLETS = """outlets AS (
  SELECT e.location_id, n.name, e.revenue, e.profit_pct, e.aov, coalesce(c.customers, 0) AS customers,
         coalesce(c.repeat_pct, 0) AS repeat_pct,
         coalesce(round_even(CAST(coalesce(w.cost, 0) AS DOUBLE) / CAST(e.revenue AS DOUBLE) * 100, 1), 0) AS waste_pct,
         coalesce(round_even(r.stars, 1), 0) AS rating, s.star, s.drag, h.channel, h.channel_share
  FROM (SELECT location_id, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue,
               round_even(CAST(sum(profit) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) * 100, 1) AS profit_pct,
               round_even(CAST(sum(revenue) AS DOUBLE) / count(*), 2) AS aov FROM order_facts GROUP BY location_id) e
  LEFT JOIN (SELECT location_id, count(*) AS customers,
                    round_even(avg(CASE WHEN n > 1 THEN 1 ELSE 0 END) * 100, 0) AS repeat_pct
             FROM (SELECT location_id, customer_id, count(*) AS n FROM order_facts WHERE NOT is_guest
                   GROUP BY location_id, customer_id) GROUP BY location_id) c USING (location_id)
  LEFT JOIN (SELECT location_id, max(CASE WHEN best = 1 THEN name END) AS star,
                    max(CASE WHEN worst = 1 THEN name END) AS drag
             FROM (SELECT location_id, name,
                          row_number() OVER (PARTITION BY location_id ORDER BY p DESC, item_id) AS best,
                          row_number() OVER (PARTITION BY location_id ORDER BY p, item_id) AS worst
                   FROM (SELECT location_id, item_id, sum(profit) AS p FROM fact GROUP BY location_id, item_id)
                   JOIN menu_items USING (item_id)) GROUP BY location_id) s USING (location_id)
  LEFT JOIN (SELECT location_id, channel, round_even(CAST(n AS DOUBLE) / CAST(total AS DOUBLE) * 100, 0) AS channel_share
             FROM (SELECT *, sum(n) OVER (PARTITION BY location_id) AS total,
                          row_number() OVER (PARTITION BY location_id ORDER BY n DESC, channel) AS rn
                   FROM (SELECT location_id, channel, count(*) AS n FROM order_facts GROUP BY location_id, channel))
             WHERE rn = 1) h USING (location_id)
  LEFT JOIN (SELECT location_id, sum(cost) AS cost FROM stock GROUP BY location_id) w USING (location_id)
  LEFT JOIN (SELECT location_id, avg(stars) AS stars FROM ratings GROUP BY location_id) r USING (location_id)
  LEFT JOIN locations n USING (location_id))"""


def _outlets(m):
    return kpis.location_table(m.fact, m.orders, m.wastage, m.ratings, m.locations, m.menu_items)


query("location_performance", "L1 L2 L3 L4 L5", _outlets, "SELECT * FROM outlets", _OUTLETS)
query(
    "leaders", "K6", lambda m: kpis.leaders(m.menu, _outlets(m), m.segments),
    """SELECT (SELECT name FROM menu ORDER BY revenue DESC, name LIMIT 1) AS best_item,
              (SELECT name FROM menu ORDER BY revenue, name LIMIT 1) AS worst_item,
              (SELECT name FROM outlets ORDER BY revenue DESC, name LIMIT 1) AS best_location,
              (SELECT name FROM outlets ORDER BY profit_pct, name LIMIT 1) AS weakest_location,
              (SELECT segment FROM segments GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)
                AS biggest_segment""", _OUTLETS)

# -- pricing ----------------------------------------------------------------
_WEEKLY = """weekly AS (
  SELECT item_id, CAST(week(order_date) AS INTEGER) AS week, CAST(sum(quantity) AS BIGINT) AS qty,
         CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS price FROM fact GROUP BY item_id, week(order_date))"""
_WEEKLY_YEAR = """weekly AS (
  SELECT item_id, CAST(isoyear(order_date) AS INTEGER) AS iso_year, CAST(week(order_date) AS INTEGER) AS week,
         CAST(sum(quantity) AS BIGINT) AS qty,
         CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS price
  FROM fact GROUP BY item_id, isoyear(order_date), week(order_date))"""
_ELASTIC = """prices AS (
  SELECT item_id, name, category_id, round(raw, 2) + 0 AS elasticity,
         CASE WHEN raw < -1.4 THEN 'Highly Price Sensitive' WHEN raw < -0.8 THEN 'Moderately Price Sensitive'
              ELSE 'Low Price Sensitivity' END AS sensitivity, basis
  FROM (SELECT item_id, CASE WHEN n >= 3 AND slope IS NOT NULL THEN greatest(-4, least(1, slope)) ELSE -0.9 END AS raw,
               CASE WHEN n >= 3 AND slope IS NOT NULL THEN 'observed' ELSE 'prior (few price points)' END AS basis
        FROM (SELECT item_id, regr_slope(ln(qty), ln(price)) AS slope, count(DISTINCT price) AS n
              FROM weekly WHERE qty > 0 AND price > 0 GROUP BY item_id))
  LEFT JOIN menu_items USING (item_id))"""


def _prices(m):
    return commerce.elasticity(m.fact, m.menu_items, m.cfg)


query("weekly_demand", "P1", lambda m: rounded(commerce.weekly_demand(m.fact)),
      "SELECT item_id, week, qty, round(price, 6) AS price FROM weekly", _WEEKLY)
query("weekly_demand_by_year", "P1", lambda m: rounded(commerce.weekly_demand(m.fact, by_iso_year=True)),
      "SELECT item_id, iso_year, week, qty, round(price, 6) AS price FROM weekly", _WEEKLY_YEAR)
query("price_sensitivity", "P2 P3", _prices, "SELECT * FROM prices", _WEEKLY, _ELASTIC)
query("price_sensitivity_by_year", "P2 P3", lambda m: commerce.elasticity(m.fact, m.menu_items, m.cfg, by_iso_year=True),
      "SELECT * FROM prices", _WEEKLY_YEAR, _ELASTIC)
query("sensitivity_counts", "P4", lambda m: commerce.sensitivity_counts(_prices(m)),
      "SELECT sensitivity, count(*) AS items FROM prices GROUP BY sensitivity", _WEEKLY, _ELASTIC)
_MOST = """most AS (SELECT item_id, count(DISTINCT unit_price) AS prices FROM fact GROUP BY item_id
             ORDER BY prices DESC, item_id LIMIT 1)"""
query("most_priced_item", "P5", lambda m: commerce.most_priced_item(m.fact), "SELECT * FROM most", _MOST)
query("price_demand_curve", "P6", lambda m: commerce.price_demand_curve(m.fact, commerce.most_priced_item(m.fact)),
      """SELECT item_id, week, round_even(price, 2) AS price, qty FROM weekly
         WHERE item_id IN (SELECT item_id FROM most)""", _WEEKLY, _MOST)

# -- promotions -------------------------------------------------------------
_EFFECT = """effect AS (
  SELECT promotion_id, promotion, type, discount, order_share_pct, margin_gap, aov,
         CASE WHEN margin_gap <= -9 OR margin < 0.50 THEN 'TRAP'
              WHEN margin >= 0.58 AND order_share_pct >= 6 THEN 'GOOD' ELSE 'OK' END AS verdict,
         CASE WHEN margin_gap <= -9 THEN 'Margin collapses - discount is eating profitable items'
              WHEN margin < 0.50 THEN 'Promoted orders barely break even'
              WHEN margin >= 0.58 AND order_share_pct >= 6 THEN 'Healthy margin held while driving volume'
              ELSE 'Works, but margin is on the thin side' END AS note
  FROM (SELECT promotion_id, p.name AS promotion, p.type, p.discount_pct AS discount, rev, n,
               CAST(prof AS DOUBLE) / CAST(rev AS DOUBLE) AS margin,
               round_even(CAST(n AS DOUBLE) / CAST(all_orders AS DOUBLE) * 100, 1) AS order_share_pct,
               round_even((CAST(prof AS DOUBLE) / CAST(rev AS DOUBLE)
                           - CAST(all_prof AS DOUBLE) / CAST(all_rev AS DOUBLE)) * 100, 1) + 0 AS margin_gap,
               round_even(CAST(rev AS DOUBLE) / n, 2) AS aov
        FROM (SELECT promotion_id, sum(revenue) AS rev, sum(profit) AS prof, count(DISTINCT order_id) AS n
              FROM fact WHERE has_promo GROUP BY promotion_id) u JOIN promotions p USING (promotion_id),
             (SELECT count(*) AS all_orders, sum(revenue) AS all_rev, sum(profit) AS all_prof FROM order_facts)))"""


def _effect(m):
    return commerce.promotion_effectiveness(m.fact, m.promotions, m.orders, m.cfg)


query("promotion_effectiveness", "R1 R2", _effect, "SELECT * FROM effect", _EFFECT)
query("promotion_traps", "R3", lambda m: commerce.traps(_effect(m)),
      """SELECT count_if(verdict = 'TRAP') AS traps,
                min_by(promotion, promotion_id) FILTER (verdict = 'TRAP') AS first_trap FROM effect""", _EFFECT)
query("promotion_repeat_and_waste", "D3", lambda m: commerce.promotion_repeat_and_waste(m.fact, m.menu),
      """SELECT r.promotion_id, r.repeat_pct, w.waste_pct
         FROM (SELECT promotion_id, round(avg(CASE WHEN n > 1 THEN 1 ELSE 0 END) * 100, 4) AS repeat_pct
               FROM (SELECT promotion_id, customer_id, count(DISTINCT order_id) AS n FROM fact
                     WHERE has_promo AND NOT is_guest GROUP BY promotion_id, customer_id) GROUP BY promotion_id) r
         JOIN (SELECT promotion_id, round(sum(sold * wastage_pct) / sum(sold), 4) AS waste_pct
               FROM (SELECT promotion_id, item_id, sum(quantity) AS sold FROM fact WHERE has_promo
                     GROUP BY promotion_id, item_id) JOIN menu USING (item_id) GROUP BY promotion_id) w
         USING (promotion_id)""")

# -- wastage ----------------------------------------------------------------
_WASTE = """waste_items AS (
  SELECT item_id, name, CAST(sum(wasted_qty) AS BIGINT) AS wasted, CAST(sum(cost) AS DECIMAL(18,2)) AS cost,
         CAST(sum(prepared_qty) AS BIGINT) AS prepared,
         round_even(CAST(sum(wasted_qty) AS DOUBLE) / CAST(sum(prepared_qty) AS DOUBLE) * 100, 1) AS wastage_pct
  FROM stock LEFT JOIN menu_items USING (item_id) GROUP BY item_id, name)"""
_OVER = """over_prep AS (
  SELECT * FROM (
    SELECT item_id, location_id, avg(prepared_qty - consumed_qty) AS over, avg(prepared_qty) AS prepared,
           stddev_samp(consumed_qty) AS volatility,
           avg(prepared_qty - consumed_qty) / nullif(avg(prepared_qty), 0) AS over_ratio
    FROM stock GROUP BY item_id, location_id)
  WHERE over IS NOT NULL AND prepared IS NOT NULL AND volatility IS NOT NULL AND over_ratio IS NOT NULL)"""
_RISK_DAY = """risk_days AS (
  SELECT item_id, location_id, ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][dow + 1] AS day
  FROM (SELECT *, row_number() OVER (PARTITION BY item_id, location_id ORDER BY over DESC, dow) AS rn
        FROM (SELECT item_id, location_id, CAST(isodow(date) - 1 AS INTEGER) AS dow,
                     avg(prepared_qty - consumed_qty) AS over
              FROM stock_daily GROUP BY item_id, location_id, isodow(date))) WHERE rn = 1)"""


def _waste_items(m):
    return commerce.waste_by_item(m.wastage, m.inventory, m.menu_items)


query("wastage_by_item", "W1", _waste_items, "SELECT * FROM waste_items", _WASTE)
query("top_wasted_items", "W5", lambda m: _waste_items(m).limit(6),
      "SELECT * FROM waste_items ORDER BY wastage_pct DESC, item_id LIMIT 6", _WASTE)
query("over_preparation", "W2", lambda m: rounded(commerce.over_preparation(m.inventory).withColumn(
          "risk", commerce.risk_level(F.col("over_ratio")))),
      """SELECT item_id, location_id, round(over, 6) AS over, round(prepared, 6) AS prepared,
                round(volatility, 6) AS volatility, round(over_ratio, 6) AS over_ratio,
                CASE WHEN over_ratio > 0.3 THEN 'high' ELSE 'med' END AS risk FROM over_prep""", _OVER)
query("risk_weekday", "W3", lambda m: commerce.risk_weekday(m.daily_inventory), "SELECT * FROM risk_days", _RISK_DAY)
query("waste_risk", "W2 W3 J5", lambda m: commerce.waste_risk(m.inventory, m.daily_inventory, m.menu_items, m.locations),
      """SELECT item_id, location_id, i.name AS item, l.name AS location, day,
                CASE WHEN over_ratio > 0.3 THEN 'high' ELSE 'med' END AS risk, round(over_ratio, 4) AS over_ratio
         FROM (SELECT * FROM over_prep ORDER BY over_ratio DESC, item_id, location_id LIMIT 5)
         LEFT JOIN risk_days USING (item_id, location_id) LEFT JOIN menu_items i USING (item_id)
         LEFT JOIN locations l USING (location_id)""", _OVER, _RISK_DAY)
query("weekly_stock", "W6", lambda m: m.stock, "SELECT * FROM stock")
query("waste_cost_rate", "W4", lambda m: commerce.waste_cost_rate(m.wastage, m.orders),
      """SELECT wastage_cost, round_even(CAST(wastage_cost AS DOUBLE) / CAST(rev AS DOUBLE) * 100, 1) AS wastage_rate
         FROM (SELECT CAST(sum(cost) AS DECIMAL(18,2)) AS wastage_cost FROM stock),
              (SELECT sum(revenue) AS rev FROM order_facts)""")
query("waste_breakdown", "D2",
      lambda m: commerce.waste_breakdown(m.daily_inventory.select("item_id", "location_id", "date", "wasted_qty", "cost"),
                                         m.menu_items),
      """SELECT 'category' AS breakdown, category_id AS key, CAST(sum(wasted_qty) AS BIGINT) AS wasted,
                CAST(sum(cost) AS DECIMAL(18,2)) AS cost FROM stock_daily JOIN menu_items USING (item_id) GROUP BY category_id
         UNION ALL SELECT 'location', CAST(location_id AS VARCHAR), CAST(sum(wasted_qty) AS BIGINT),
                CAST(sum(cost) AS DECIMAL(18,2)) FROM stock_daily GROUP BY location_id
         UNION ALL SELECT 'weekday', ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][isodow(date)],
                CAST(sum(wasted_qty) AS BIGINT), CAST(sum(cost) AS DECIMAL(18,2)) FROM stock_daily GROUP BY isodow(date)""")

# -- what-if ----------------------------------------------------------------
SCENARIOS = [(5.0, 0.0, 0.0, 0.0), (-10.0, 0.0, 5.0, 0.0), (0.0, 15.0, 10.0, 40.0), (8.0, 0.0, -20.0, 10.0)]
_WEEKS = "(SELECT CAST(date_diff('day', min(order_date), max(order_date)) + 1 AS DOUBLE) / 7 FROM order_facts)"


def _what_if(m):
    span = m.orders.agg(((F.date_diff(F.max("order_date"), F.min("order_date")) + 1).cast("double") / 7).alias("w"))
    return commerce.what_if(m.menu, SCENARIOS, span.scalar())


def _change(new, old):
    return f"coalesce(round(({new} - {old}) / nullif({old}, 0) * 100, 4) + 0, 0) AS "


query(
    "what_if", "F1", _what_if,
    f"""SELECT item_id, scenario, round(units, 4) AS units, round(revenue, 4) AS revenue, round(profit, 4) AS profit,
               round(waste, 4) AS waste, round(price, 4) AS price, round((price - c0) / price * 100, 4) AS margin_pct,
               {_change('revenue', 'r0')}revenue_change, {_change('profit', 'f0')}profit_change,
               {_change('units', 'q0')}units_change, {_change('waste', 'w0')}waste_change
        FROM (SELECT *, units * price AS revenue, units * (price - c0) AS profit,
                     (greatest(0, q0 * (1 + d_prep / 100) - units) + units * share * 0.4::DOUBLE) * c0 AS waste,
                     q0 * p0 AS r0, q0 * (p0 - c0) AS f0, q0 * share * c0 AS w0
              FROM (SELECT *, p0 * (1 + d_price / 100) * (1 - discount / 100) AS price,
                           q0 * greatest(0.1::DOUBLE, 1 - 1.1::DOUBLE * (d_price - discount) / 100
                                         + 0.45::DOUBLE * promo / 100) AS units
                    FROM (SELECT item_id, qty / {_WEEKS} AS q0, CAST(base_price AS DOUBLE) AS p0,
                                 CAST(food_cost AS DOUBLE) AS c0, wastage_pct / 100 AS share FROM menu),
                         (VALUES {', '.join(f'({n}, {p}::DOUBLE, {d}::DOUBLE, {k}::DOUBLE, {s}::DOUBLE)'
                                            for n, (p, d, k, s) in enumerate(SCENARIOS, 1))})
                           AS s(scenario, d_price, discount, d_prep, promo)))""")

# -- anomalies --------------------------------------------------------------
_Z = """zscores AS (
  SELECT d.*, (CAST(revenue AS DOUBLE) - mean) / sd AS z
  FROM daily d, (SELECT avg(CAST(revenue AS DOUBLE)) AS mean, stddev_samp(CAST(revenue AS DOUBLE)) AS sd FROM daily))"""
_SPIKES = """spikes AS (
  SELECT CASE WHEN z > 0 THEN 'Sales spike' ELSE 'Sales drop' END AS type, 'All locations' AS location,
         CAST(date AS VARCHAR) AS date, CASE WHEN abs(z) > 2.8 THEN 'high' ELSE 'medium' END AS severity,
         'Daily revenue was ' || printf('%+.1f', z) || ' std from the norm ('
         || CASE WHEN z > 0 THEN 'well above' ELSE 'well below' END || ' expected). Flagged for review.' AS detail
  FROM zscores WHERE abs(z) > 2.1)"""
_COLLAPSE = """collapses AS (
  SELECT 'Margin collapse' AS type, l.name AS location, CAST(date AS VARCHAR) AS date, 'critical' AS severity,
         'Revenue was healthy (' || format('{:,}', CAST(round_even(rev, 0) AS BIGINT))
         || ') but contribution margin fell to ' || printf('%.0f', margin * 100) || '% (norm ~'
         || printf('%.0f', base * 100) || '%). Likely a promo discounting profitable mains.' AS detail
  FROM (SELECT *, prof / rev AS margin FROM days
        WHERE rev > (SELECT quantile_cont(rev, 0.5) FROM days) ORDER BY margin, location_id, date LIMIT 2)
  JOIN locations l USING (location_id),
  (SELECT CAST(sum(profit) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) AS base FROM order_facts)
  WHERE margin < base * 0.75)"""
_DAYS = """days AS (
  SELECT location_id, order_date AS date, CAST(sum(revenue) AS DOUBLE) AS rev, CAST(sum(profit) AS DOUBLE) AS prof
  FROM order_facts GROUP BY location_id, order_date)"""
_OUTLIERS = """outliers AS (
  SELECT 'Order-value outliers' AS type, 'Multiple' AS location, 'last 14 days' AS date, 'low' AS severity,
         CAST(n AS VARCHAR) || ' orders exceeded ' || format('{:,}', CAST(round_even(cut, 0) AS BIGINT))
         || ' (4+ std above the mean order). Likely large group bookings - kept, but flagged for review.' AS detail
  FROM (SELECT count_if(CAST(revenue AS DOUBLE) > cut) AS n, max(cut) AS cut FROM order_facts,
          (SELECT avg(CAST(revenue AS DOUBLE)) + 4 * stddev_samp(CAST(revenue AS DOUBLE)) AS cut FROM order_facts))
  WHERE n > 0)"""


def _bursts_sql(unit, by, rows):
    return f"""bursts AS (
      SELECT 'Rating cluster' AS type, 'Multiple' AS location, CAST(CAST(bin AS DATE) AS VARCHAR) AS date,
             'medium' AS severity, CAST(n AS VARCHAR) || ' identical ' || CAST(stars AS VARCHAR)
             || '-star ratings on item ' || {by} || ' within one {unit} - possible non-organic ratings.' AS detail
      FROM (SELECT {by}, date_trunc('{unit}', rating_ts) AS bin, stars, count(*) AS n FROM {rows}
            GROUP BY {by}, date_trunc('{unit}', rating_ts), stars) WHERE n >= 15)"""


def _found(m, unit="day", by="kind"):
    """Bursts by rating kind and day: no item reaches the burst size within an hour here."""
    return anomalies.detect(m.orders, m.daily, m.outlet_days, m.ratings, m.locations, m.cfg, unit, by)


_FOUND = (_Z, _SPIKES, _DAYS, _COLLAPSE, _OUTLIERS, _bursts_sql("day", "kind", "ratings"),
          """found AS (SELECT * FROM spikes UNION ALL SELECT * FROM collapses UNION ALL SELECT * FROM outliers
                       UNION ALL SELECT * FROM bursts)""",
          """report AS (SELECT * FROM found
                        ORDER BY list_position(['critical', 'high', 'medium', 'low'], severity), date, type, location, detail
                        LIMIT 8)""")

query("revenue_zscores", "A1", lambda m: rounded(anomalies.revenue_zscores(m.daily)),
      "SELECT date, revenue, profit, orders, round(z, 6) AS z FROM zscores", _Z)
query("revenue_spikes", "A1", lambda m: anomalies.revenue_spikes(m.daily, m.cfg),
      "SELECT * FROM spikes", _Z, _SPIKES)
query("margin_collapses", "A2", lambda m: anomalies.margin_collapses(m.outlet_days, m.locations, m.cfg),
      "SELECT * FROM collapses", _DAYS, _COLLAPSE)
query("order_outliers", "A3", lambda m: anomalies.order_outliers(m.orders, m.cfg), "SELECT * FROM outliers", _OUTLIERS)
query("rating_groups_per_hour", "A4",
      lambda m: anomalies.rating_burst_groups(m.ratings.fillna("unknown", ["item_id"]), 1, "hour"),
      """SELECT coalesce(item_id, 'unknown') AS item_id, date_trunc('hour', rating_ts) AS bin, stars, count(*) AS n FROM ratings
         GROUP BY item_id, date_trunc('hour', rating_ts), stars""")
query("rating_bursts", "A4", lambda m: anomalies.rating_bursts(m.ratings, m.cfg, "day", "kind"),
      "SELECT * FROM bursts", _bursts_sql("day", "kind", "ratings"))
query("anomaly_report", "A5", lambda m: anomalies.anomaly_report(_found(m), m.cfg), "SELECT * FROM report", *_FOUND)
query("anomaly_counts", "A6", lambda m: anomalies.severity_counts(_found(m)),
      "SELECT severity, count(*) AS anomalies FROM found GROUP BY severity", *_FOUND)

# -- recommendations --------------------------------------------------------
_PROFILE_SIZE = """at_risk AS (
  SELECT count(*) AS customers,
         CAST(floor(greatest(3, least(88, avg(recency) / (SELECT greatest(1, max(recency)) FROM segments) * 100)))
              AS INTEGER) AS churn
  FROM segments WHERE segment = 'At-Risk')"""
_REC_SQL = """
SELECT 1 AS position, 'Critical' AS priority, 'Promote ' || name AS action,
       'Feature on the homepage and suggest at checkout' AS "do", '+ est. profit uplift' AS impact,
       printf('%.0f', margin * 100) || '% contribution margin - among the highest on the menu | '
       || printf('%.1f', rating) || '★ average rating | Only ' || printf('%.1f', wastage_pct)
       || '% wastage | Low current order frequency (Hidden Opportunity) | ' || printf('%.0f', repeat_pct)
       || '% repeat purchase among people who try it' AS evidence
FROM (SELECT * FROM menu WHERE menu_class = 'Hidden Opportunity' ORDER BY margin DESC, item_id LIMIT 1)
UNION ALL
SELECT 2, 'Critical', 'Restructure "' || promotion || '" promotion', 'Cap the discount or switch to a fixed-price bundle',
       'Recovers lost margin', 'Sales lift ' || printf('%+.0f', order_share_pct) || '% but margin '
       || printf('%+.1f', margin_gap) || ' pts vs baseline | ' || note || ' | Classic promotion-trap pattern'
FROM (SELECT * FROM effect WHERE verdict = 'TRAP' ORDER BY promotion_id LIMIT 1)
UNION ALL
SELECT 3, 'High', 'Reduce prep for ' || name, 'Cut daily prep quantity ~20% and re-check weekly',
       'Direct wastage cost saving', printf('%.1f', wastage_pct) || '% wastage - well above the 3% target'
       || ' | Demand is stable and predictable | Forecast supports a prep reduction'
FROM (SELECT * FROM waste_items ORDER BY wastage_pct DESC, item_id LIMIT 1)
UNION ALL
SELECT 4, 'High', 'Re-engage At-Risk customers', 'Targeted win-back on their top category',
       'Protects customer lifetime value', format('{:,}', customers) || ' customers with '
       || CAST(churn AS VARCHAR) || '% churn probability'
       || ' | Recency climbing, frequency falling | Historically responsive to favourite-item offers'
FROM at_risk WHERE customers > 0
UNION ALL
SELECT 5, 'Medium', 'Test a price increase on ' || CAST(len(names) AS VARCHAR) || ' low-sensitivity items',
       'Test a 4-6% increase and monitor two weeks', '+ est. margin uplift',
       'Elasticity near zero - demand barely moves with price | Items: ' || array_to_string(names, ', ')
       || ' | Margins have room to grow'
FROM (SELECT list(name ORDER BY elasticity, item_id) AS names
      FROM (SELECT * FROM prices WHERE sensitivity = 'Low Price Sensitivity' ORDER BY elasticity, item_id LIMIT 3))
WHERE len(names) > 0
UNION ALL
SELECT 6, 'Medium', 'Redesign or retire ' || CAST(len(names) AS VARCHAR) || ' Low Performers',
       'Replace with a seasonal special', 'Frees prep capacity',
       'Weak demand + weak margin + poor trend | High wastage on ' || array_to_string(names[1:2], ', ')
       || ' | No location where they clearly perform'
FROM (SELECT list(name ORDER BY profit_score, item_id) AS names
      FROM (SELECT * FROM menu WHERE menu_class = 'Low Performer' ORDER BY profit_score, item_id LIMIT 3))
WHERE len(names) > 0"""


def _recs(m):
    profile = customers.segment_profile(m.segments, m.orders)
    return recommend.recommendations(m.menu, _effect(m), _waste_items(m), profile, _prices(m))


_REC_VIEWS = (_EFFECT, _WASTE, _WEEKLY, _ELASTIC, _PROFILE_SIZE)
query("recommendations", "X1 X2 X3 X4 X5 X6 X7 X9", lambda m: recommend.flattened(_recs(m)), _REC_SQL, *_REC_VIEWS)
query("recommendation_counts", "X8", lambda m: recommend.priority_counts(_recs(m)),
      f"SELECT priority, count(*) AS recommendations FROM ({_REC_SQL}) GROUP BY priority", *_REC_VIEWS)

# -- slices -----------------------------------------------------------------
DATES = slicing.Filters(date_from=date(1996, 1, 1), date_to=date(1999, 12, 31), channel="1-URGENT", rating_min=3.0)
PLACE = slicing.Filters.from_dict({
    "location": "NATION_7", "segment": "Frequent", "waste_max": 60, "price_min": "cheap", "category": "all"})
TIER = slicing.Filters(promotion="Tier 5%", category="ECONOMY", klass="Low Performer", price_max=2000.0)
_CHOSEN = {
    "dates": (DATES, "order_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND channel = '1-URGENT' "
              "AND item_id IN (SELECT item_id FROM menu WHERE rating >= 3.0)"),
    "place": (PLACE, "location_id IN (SELECT location_id FROM locations WHERE name = 'NATION_7') "
              "AND customer_id IN (SELECT customer_id FROM segments WHERE segment = 'Frequent') "
              "AND item_id IN (SELECT item_id FROM menu WHERE wastage_pct <= 60)"),
    "tier": (TIER, "promotion_id IN (SELECT promotion_id FROM promotions WHERE name = 'Tier 5%') "
             "AND item_id IN (SELECT item_id FROM menu WHERE category_id = 'ECONOMY' "
             "AND menu_class = 'Low Performer' AND base_price <= 2000)"),
}
_WASTE_SLICE = {
    "dates": "date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' "
             "AND item_id IN (SELECT item_id FROM menu WHERE rating >= 3.0)",
    "place": "location_id IN (SELECT location_id FROM locations WHERE name = 'NATION_7') "
             "AND item_id IN (SELECT item_id FROM menu WHERE wastage_pct <= 60)",
    "tier": "item_id IN (SELECT item_id FROM menu WHERE category_id = 'ECONOMY' "
            "AND menu_class = 'Low Performer' AND base_price <= 2000)",
}


def _slice(m, which):
    """The slice with its filtered facts stored once for all of its reports."""
    return m.remember(f"slice_{which}", lambda: slicing.Slice(
        _CHOSEN[which][0], m.fact, m.menu, m.locations, m.promotions, m.segments, m.wastage, m.categories,
        m.channels, store=lambda name, df: m.keep(f"slice_{which}_{name}", df), outlets=m.outlet_figures, profile=m.rule_profile))


def _slice_views(which):
    return (
        f"part_fact AS (SELECT * FROM fact WHERE {_CHOSEN[which][1]})",
        """part_orders AS (
          SELECT order_id, location_id, customer_id, is_guest, channel, order_date,
                 CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue, CAST(sum(profit) AS DECIMAL(18,2)) AS profit,
                 count(*) AS lines
          FROM part_fact GROUP BY order_id, location_id, customer_id, is_guest, channel, order_date)""",
        f"part_waste AS (SELECT * FROM stock WHERE {_WASTE_SLICE[which]})",
        """part_items AS (
          SELECT item_id, m.name, c.category_name AS category, p.qty, p.orders, p.revenue,
                 round_even(coalesce(CAST(p.profit AS DOUBLE) / nullif(CAST(p.revenue AS DOUBLE), 0), 0), 3) + 0 AS margin,
                 p.profit, m.menu_class, m.slow_mover, CAST(m.base_price AS DOUBLE) AS base_price, CAST(m.food_cost AS DOUBLE) AS food_cost,
                 m.rating, m.repeat_pct, m.wastage_pct, m.promo_dependency, m.trend, m.demand_score, m.profit_score
          FROM (SELECT item_id, CAST(sum(quantity) AS BIGINT) AS qty, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue,
                       CAST(sum(profit) AS DECIMAL(18,2)) AS profit, count(DISTINCT order_id) AS orders FROM part_fact GROUP BY item_id) p
          LEFT JOIN menu m USING (item_id) LEFT JOIN categories c USING (category_id))""")


query("filter_options", "Q1",
      lambda m: slicing.filter_options(m.menu, m.locations, m.categories, m.promotions, m.channels),
      """SELECT 'locations' AS filter, name AS value FROM locations
         UNION ALL SELECT 'categories', category_name FROM categories
         UNION ALL SELECT 'promotions', name FROM promotions
         UNION ALL SELECT DISTINCT 'channels', channel FROM raw_orders
         UNION ALL SELECT 'items', name FROM menu
         UNION ALL SELECT 'classes', unnest(['Profit Driver', 'Volume Driver', 'Hidden Opportunity', 'Low Performer'])
         UNION ALL SELECT 'segments', unnest(['High-Value Loyal', 'Frequent', 'Promotion-Driven', 'Occasional',
                                              'New', 'At-Risk'])""")
for _w, _ids in (("dates", "Q2 Q3"), ("place", "Q4 Q9"), ("tier", "Q2 Q3")):
    query(f"slice_{_w}_kpis", f"{_ids} Q5 Q6", lambda m, w=_w: _slice(m, w).kpis(),
          """SELECT coalesce(CAST(sum(revenue) AS DECIMAL(18,2)), 0) AS revenue,
                    coalesce(CAST(sum(profit) AS DECIMAL(18,2)), 0) AS profit, count(*) AS orders,
                    coalesce(round(CAST(sum(revenue) AS DOUBLE) / nullif(count(*), 0), 4), 0) AS aov,
                    (SELECT count(DISTINCT customer_id) FROM part_orders WHERE NOT is_guest) AS active_customers,
                    (SELECT round_even(coalesce(avg(CASE WHEN n > 1 THEN 1 ELSE 0 END) * 100, 0), 1)
                     FROM (SELECT customer_id, count(*) AS n FROM part_orders WHERE NOT is_guest GROUP BY customer_id))
                      AS repeat_rate,
                    (SELECT coalesce(CAST(sum(cost) AS DECIMAL(18,2)), 0) FROM part_waste) AS wastage_cost,
                    coalesce(round_even(CAST((SELECT coalesce(sum(cost), 0) FROM part_waste) AS DOUBLE)
                                        / nullif(CAST(sum(revenue) AS DOUBLE), 0) * 100, 1), 0) AS wastage_rate
             FROM part_orders""", *_slice_views(_w))
    query(f"slice_{_w}_meta", f"{_ids} Q5", lambda m, w=_w: _slice(m, w).meta(),
          """SELECT count(*) AS orders, coalesce(CAST(sum(lines) AS BIGINT), 0) AS lines,
                    count(DISTINCT customer_id) FILTER (NOT is_guest) AS customers,
                    (SELECT count(DISTINCT item_id) FROM part_fact) AS items, count(*) = 0 AS empty
             FROM part_orders""", *_slice_views(_w))
query("slice_dates_deltas", "Q5 T3", lambda m: _slice(m, "dates").deltas(),
      f"SELECT {_delta_sql('revenue')}, {_delta_sql('orders')}, {_delta_sql('profit')} FROM part_halves",
      *_slice_views("dates"),
      """part_halves AS (SELECT *, row_number() OVER (ORDER BY date) <= count(*) OVER () // 2 AS first_half
         FROM (SELECT order_date AS date, sum(revenue) AS revenue, sum(profit) AS profit, count(*) AS orders
               FROM part_orders GROUP BY order_date))""")
query("slice_dates_daily", "Q7 T1", lambda m: _slice(m, "dates").daily(),
      """SELECT order_date AS date, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue,
                CAST(sum(profit) AS DECIMAL(18,2)) AS profit, count(*) AS orders FROM part_orders GROUP BY order_date""",
      *_slice_views("dates"))
query("slice_place_category_revenue", "Q7 K3", lambda m: _slice(m, "place").category_revenue(),
      """SELECT category_name AS category, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue FROM part_fact
         JOIN categories USING (category_id) GROUP BY category_name""", *_slice_views("place"))
query("slice_dates_items", "Q7 M1", lambda m: rounded(_slice(m, "dates").items()),
      "SELECT * REPLACE (round(demand_score, 6) AS demand_score, round(profit_score, 6) AS profit_score) FROM part_items",
      *_slice_views("dates"))
query("slice_place_class_counts", "Q7 M11", lambda m: _slice(m, "place").class_counts(),
      """SELECT k AS menu_class, count(menu_class) AS items
         FROM (SELECT unnest(['Profit Driver', 'Volume Driver', 'Hidden Opportunity', 'Low Performer']) AS k)
         LEFT JOIN part_items ON menu_class = k GROUP BY k""", *_slice_views("place"))
query("slice_dates_locations", "Q7 L1 L2 L3", lambda m: _slice(m, "dates").location_table(),
      """SELECT p.location_id, p.name, p.revenue, p.profit_pct, p.aov, p.customers, p.repeat_pct, o.waste_pct, o.rating,
                p.star, p.drag, p.channel, p.channel_share
         FROM part_outlets p LEFT JOIN outlets o USING (location_id)""", *_slice_views("dates"), _OUTLETS,
      _OUTLETS.replace("outlets AS", "part_outlets AS", 1).replace("order_facts", "part_orders").replace("FROM fact ", "FROM part_fact "))
query("slice_place_channels", "Q7 K4", lambda m: _slice(m, "place").channel_mix(),
      """SELECT c.channel, count(o.order_id) AS orders FROM (SELECT DISTINCT channel FROM raw_orders) c
         LEFT JOIN part_orders o ON c.channel = o.channel GROUP BY c.channel""", *_slice_views("place"))
query("slice_tier_most_wasted", "Q7 W5", lambda m: _slice(m, "tier").most_wasted(),
      "SELECT item_id, name, wastage_pct FROM part_items ORDER BY wastage_pct DESC, revenue DESC, item_id LIMIT 6",
      *_slice_views("tier"))
query("slice_dates_segments", "Q8 J11", lambda m: _slice(m, "dates").segment_mix().drop("play"),
      f"""SELECT CAST(n.position AS INTEGER) AS position, n.k AS segment, n.customers, p.* EXCLUDE (segment, customers, position)
         FROM (SELECT position, k, count(s.customer_id) AS customers
               FROM (SELECT unnest(['High-Value Loyal', 'Frequent', 'Promotion-Driven', 'Occasional', 'New', 'At-Risk']) AS k,
                            unnest([1, 2, 3, 4, 5, 6]) AS position)
               LEFT JOIN (SELECT DISTINCT customer_id FROM part_orders WHERE NOT is_guest) b ON true
               LEFT JOIN segments s ON s.customer_id = b.customer_id AND s.segment = k
               GROUP BY position, k) n LEFT JOIN ({PROFILE_SQL}) p ON p.segment = n.k""", *_slice_views("dates"), PROFILE_CHANNEL)
query("active_filters", "Q10",
      lambda m: reduce(DataFrame.unionByName, [
          _slice(m, w).meta().select(F.lit(w).alias("slice"), F.lit(f.active).alias("active"), "lines")
          for w, (f, _) in _CHOSEN.items()]),
      " UNION ALL ".join(
          f"SELECT '{w}' AS slice, {n} AS active, count(*) AS lines FROM fact WHERE {_CHOSEN[w][1]}"
          for w, n in (("dates", 4), ("place", 3), ("tier", 4))))
