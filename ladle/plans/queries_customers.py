"""Customer and market-basket queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.functions.ranking import exact_quantile
from ladle.operators import basket, customers
from ladle.plans.registry import query, rounded

# -- RFM --------------------------------------------------------------------
_RFM = """rfm AS (
  SELECT *, CAST(round((r + f + m) / 3.0) AS INTEGER) AS rfm_score FROM (
    SELECT c.*, 6 - CAST(greatest(1, ceil((row_number() OVER (ORDER BY recency, customer_id) - 1) * 5.0
                    / (count(*) OVER () - 1))) AS INTEGER) AS r,
           CAST(greatest(1, ceil((row_number() OVER (ORDER BY frequency, customer_id) - 1) * 5.0
                    / (count(*) OVER () - 1))) AS INTEGER) AS f,
           CAST(greatest(1, ceil((row_number() OVER (ORDER BY monetary, customer_id) - 1) * 5.0
                    / (count(*) OVER () - 1))) AS INTEGER) AS m
    FROM customers c))"""
query("customer_features", "C1", lambda m: m.customers, "SELECT * FROM customers")
query("rfm_scores", "C2 C3",
      lambda m: m.rfm.select("customer_id", "R", "F", "M", "rfm_score"),
      'SELECT customer_id, r AS "R", f AS "F", m AS "M", rfm_score FROM rfm', _RFM)
query("rfm_distribution", "C4 J11", lambda m: customers.score_distribution(m.rfm),
      """SELECT CAST(s AS INTEGER) AS score, count(rfm_score) AS customers
         FROM (SELECT unnest([1, 2, 3, 4, 5]) AS s) LEFT JOIN rfm ON rfm_score = s GROUP BY s""", _RFM)
query("rule_segments", "C8", lambda m: m.segments.select("customer_id", "segment"),
      "SELECT customer_id, segment FROM segments")
_CHANNEL = """channels AS (
  SELECT segment, channel, orders FROM (
    SELECT *, row_number() OVER (PARTITION BY segment ORDER BY orders DESC, channel) AS rn
    FROM (SELECT segment, channel, count(*) AS orders FROM order_facts JOIN segments USING (customer_id)
          GROUP BY segment, channel)) WHERE rn = 1)"""
query("segment_top_channel", "C10 J10", lambda m: customers.top_channel(m.segments, m.orders),
      "SELECT * FROM channels", _CHANNEL)
PROFILE_SQL = """SELECT segment, customers, CAST(trunc(p.recency) AS INTEGER) AS recency, round_even(p.frequency, 1) AS frequency,
                CAST(floor(p.monetary) AS BIGINT) AS monetary, round_even(p.aov, 2) AS aov,
                round_even(p.categories, 1) AS categories, CAST(round_even(p.promo_share, 0) AS INTEGER) AS promo_share,
                CAST(floor(greatest(3, least(88, p.recency / longest * 100))) AS INTEGER) AS churn_pct, channel,
                CAST(list_position(['High-Value Loyal', 'Frequent', 'Promotion-Driven', 'Occasional', 'New', 'At-Risk'],
                                   segment) AS INTEGER) AS position
         FROM (SELECT segment, count(*) AS customers, avg(recency) AS recency, avg(frequency) AS frequency,
                      avg(CAST(monetary AS DOUBLE)) AS monetary, avg(avg_order_value) AS aov,
                      avg(categories) AS categories, avg(promo_share) AS promo_share FROM segments GROUP BY segment) p
         LEFT JOIN channels USING (segment), (SELECT greatest(1, max(recency)) AS longest FROM segments)"""
PROFILE_CHANNEL = _CHANNEL
query("segment_profile", "C9 C17", lambda m: customers.segment_profile(m.segments, m.orders).drop("play"), PROFILE_SQL, _CHANNEL)


def _cohorts(weeks):
    return f"""SELECT week, CAST(week AS VARCHAR) || '/' || CAST(week + 6 AS VARCHAR) AS label,
                      count_if(week = first_week) AS "new", count_if(week <> first_week) AS "returning"
               FROM (SELECT *, min(week) OVER (PARTITION BY customer_id) AS first_week FROM
                       (SELECT DISTINCT customer_id, CAST(date_trunc('week', order_date) AS DATE) AS week
                        FROM order_facts WHERE NOT is_guest))
               GROUP BY week ORDER BY week DESC{f" LIMIT {weeks}" if weeks else ""}"""


query("new_vs_returning", "C12", lambda m: customers.new_vs_returning(m.orders), _cohorts(12))
query("new_vs_returning_long", "C12", lambda m: customers.new_vs_returning(m.orders, weeks=None), _cohorts(None))
query("churn_labels", "C13",
      lambda m: rounded(customers.churn_labels(m.customers).select("customer_id", "recency_cut", "churned")),
      """SELECT customer_id, round(cut, 6) AS recency_cut, CAST(recency > cut AS INTEGER) AS churned
         FROM customers, (SELECT quantile_cont(recency, 0.7) AS cut FROM customers)""")
query("order_value_quantiles", "A2 C13",
      lambda m: rounded(exact_quantile(m.orders, "revenue", 0.5, "median_revenue"), 4),
      "SELECT round(quantile_cont(CAST(revenue AS DOUBLE), 0.5), 4) AS median_revenue FROM order_facts")

# -- market basket ----------------------------------------------------------


def _brands(m):
    return m.menu_items.select(F.element_at(F.split("item_id", "/"), 1).alias("item")).distinct().withColumn(
        "name", F.col("item"))


def _items(m):
    return m.menu_items.select(F.col("item_id").alias("item"), "name")


def _views(item, names):
    return (
        f"baskets AS (SELECT DISTINCT order_id, {item} AS item FROM fact)",
        "support AS (SELECT item, count(*) AS item_orders FROM baskets GROUP BY item)",
        f"names AS ({names})",
        """pairs AS (SELECT l.item AS a, r.item AS b, count(*) AS pair_orders FROM baskets l
                     JOIN baskets r ON l.order_id = r.order_id AND l.item < r.item GROUP BY l.item, r.item)""",
        """metrics AS (
             SELECT a, b, pair_orders, CAST(pair_orders AS DOUBLE) / n AS support,
                    CAST(pair_orders AS DOUBLE) / x.item_orders AS confidence,
                    (CAST(pair_orders AS DOUBLE) / x.item_orders) / (CAST(y.item_orders AS DOUBLE) / n) AS lift
             FROM pairs JOIN support x ON a = x.item JOIN support y ON b = y.item,
                  (SELECT count(*) AS n FROM order_facts))""",
        """floor_choice AS (
             SELECT CASE WHEN n0 >= 20 THEN 0.004 WHEN n1 >= 20 THEN 0.002 WHEN n2 >= 20 THEN 0.001
                         WHEN n3 >= 20 THEN 0.0005 ELSE 0.00025 END AS support_floor
             FROM (SELECT count_if(support >= 0.004) AS n0, count_if(support >= 0.002) AS n1,
                          count_if(support >= 0.001) AS n2, count_if(support >= 0.0005) AS n3 FROM metrics))""",
        """rules AS (
             SELECT a AS a_id, b AS b_id, l.name AS a, r.name AS b, round_even(support, 4) AS support,
                    round_even(confidence, 3) AS confidence, round_even(lift, 2) AS lift
             FROM metrics JOIN names l ON metrics.a = l.item JOIN names r ON metrics.b = r.item, floor_choice
             WHERE support >= support_floor ORDER BY lift DESC, a_id, b_id LIMIT 20)""")


_BRAND = _views("split_part(item_id, '/', 1)", "SELECT DISTINCT split_part(item_id, '/', 1) AS item, item AS name FROM menu_items")
_ITEM = _views("item_id", "SELECT item_id AS item, name FROM menu_items")


def _brand_rules(m):
    return basket.rules(m.brand_pair_metrics, _brands(m), m.cfg)


query("basket_item_support", "B1 B2", lambda m: basket.item_support(basket.baskets(m.order_items, distinct=True)),
      "SELECT * FROM support", *_ITEM)
query("basket_count", "B1", lambda m: basket.basket_count(m.orders), "SELECT count(*) AS baskets FROM order_facts")
query("basket_pair_counts", "B3 J9", lambda m: basket.pair_counts(basket.baskets(m.order_items, distinct=True)), "SELECT * FROM pairs", *_ITEM)
query("basket_brand_pairs", "B3 B4",
      lambda m: rounded(m.brand_pair_metrics),
      """SELECT a, b, pair_orders, round(support, 6) AS support, round(confidence, 6) AS confidence,
                round(lift, 6) AS lift FROM metrics""", *_BRAND)
query("basket_support_floor", "B5",
      lambda m: basket.chosen_floor(m.pair_metrics, m.cfg),
      "SELECT CAST(support_floor AS DOUBLE) AS support_floor FROM floor_choice", *_ITEM)
query("market_basket_rules", "B4 B5 B6", lambda m: basket.rules(m.pair_metrics, _items(m), m.cfg),
      "SELECT * FROM rules", *_ITEM)
query("brand_basket_rules", "B4 B5 B6", _brand_rules, "SELECT * FROM rules", *_BRAND)
query("bundles", "B7", lambda m: basket.bundles(_brand_rules(m)),
      """SELECT split_part(a, ' ', 1) || ' Combo' AS title, a || ' + ' || b AS pair,
                printf('%.0f', confidence * 100) || '% of ' || a || ' buyers add ' || b || ' · lift '
                || printf('%.2f', lift) || '×' AS evidence, '+ AOV uplift' AS impact
         FROM (SELECT * FROM rules ORDER BY lift DESC, a_id, b_id LIMIT 3)""", *_BRAND)
query("basket_headline", "B8", lambda m: basket.rule_headline(_brand_rules(m)),
      "SELECT count(*) AS rules_found, max(lift) AS strongest_lift FROM rules", *_BRAND)
