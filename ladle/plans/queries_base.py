"""Sources, quality, cleaning, joins, scalar functions and item queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.functions import scalars as S
from ladle.operators import asof, cleaning, fact, items, quality
from ladle.plans.registry import query, rounded
from ladle.sources.readers import row_counts

# -- audit and quality ------------------------------------------------------
query(
    "ingest_audit", "IO4",
    lambda m: row_counts({t: m.star.raw(t) for t in (
        "customer", "events", "lineitem", "nation", "orders", "part", "region")}),
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS records FROM {t}"
        for t in ("customer", "events", "lineitem", "nation", "orders", "part", "region")))

_QUALITY_SQL = """
SELECT 'Missing customer IDs' AS issue, count_if(coalesce(customer_id, '') = '') AS records,
       'flag & keep (guest orders)' AS action FROM dirty_orders
UNION ALL SELECT 'Duplicate order-lines', count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty_lines)),
       'quarantine' FROM dirty_lines
UNION ALL SELECT 'Invalid / non-positive prices', count_if(unit_price <= 0), 'recover from pricing history' FROM dirty_lines
UNION ALL SELECT 'Negative quantities', count_if(quantity <= 0), 'remove' FROM dirty_lines
UNION ALL SELECT 'Invalid ratings (outside 1-5)', count_if(NOT coalesce(stars BETWEEN 1 AND 5, false)), 'clamp / drop'
       FROM raw_ratings
UNION ALL SELECT 'Impossible wastage (<0)', count_if(wasted_qty < 0), 'remove' FROM dirty_wastage
UNION ALL SELECT 'Unknown menu item refs', count_if(item_id NOT IN (SELECT item_id FROM menu_items)), 'quarantine'
       FROM dirty_lines
UNION ALL SELECT 'Invalid location refs', count_if(location_id NOT IN (SELECT location_id FROM locations)), 'quarantine'
       FROM dirty_orders
UNION ALL SELECT 'Cancelled / non-completed orders', count_if(status <> 'completed'), 'exclude from revenue'
       FROM dirty_orders"""

_LOG_SQL = """
SELECT 1 AS step_no, 'Removed duplicate order-lines' AS step, CAST(sum(copies - 1) AS BIGINT) AS records FROM line_copies
UNION ALL SELECT 2, 'Removed non-positive quantities', count_if(quantity <= 0) FROM line_copies
UNION ALL SELECT 3, 'Recovered invalid prices from history', count_if(quantity > 0 AND unit_price <= 0) FROM line_copies
UNION ALL SELECT 4, 'Quarantined unknown item references',
       count_if(quantity > 0 AND item_id NOT IN (SELECT item_id FROM menu_items)) FROM line_copies
UNION ALL SELECT 5, 'Dropped out-of-range ratings', count_if(NOT coalesce(stars BETWEEN 1 AND 5, false)) FROM raw_ratings
UNION ALL SELECT 6, 'Removed impossible wastage rows', count_if(wasted_qty < 0) FROM dirty_wastage
UNION ALL SELECT 7, 'Flagged guest orders', count_if(coalesce(customer_id, '') = '') FROM dirty_orders"""


def _quality(m):
    return quality.assess(m.dirty_lines, m.dirty_orders, m.raw_ratings, m.dirty_wastage, m.menu_items, m.locations)


def _log(m):
    return cleaning.cleaning_log(m.dirty_lines, m.dirty_orders, m.raw_ratings, m.dirty_wastage, m.menu_items)


query("data_quality_report", "DQ1 DQ2 DQ3 DQ4 DQ5 DQ6 DQ7 DQ8 DQ9 DQ10", _quality, _QUALITY_SQL)
query(
    "foreign_key_check", "DQ11 J7",
    lambda m: quality.foreign_key_violations(m.dirty_lines, m.menu_items, "item_id"),
    """SELECT item_id, count(*) AS records FROM dirty_lines
       WHERE item_id NOT IN (SELECT item_id FROM menu_items) GROUP BY item_id""")
query(
    "quality_totals", "DQ12", lambda m: quality.totals(_quality(m), _log(m)),
    """SELECT 'issues_caught' AS metric, CAST(sum(records) AS BIGINT) AS records FROM report
       UNION ALL SELECT 'records_cleaned', CAST(sum(records) AS BIGINT) FROM log""",
    f"report AS ({_QUALITY_SQL})", f"log AS ({_LOG_SQL})")

# -- cleaning ---------------------------------------------------------------
query("cleaning_log", "CL11", _log, _LOG_SQL)
query(
    "clean_order_lines", "CL1 CL2 CL3 CL4 CL6",
    lambda m: cleaning.clean_order_items(m.dirty_lines, m.menu_items).drop("promotion_id"),
    """SELECT *, CAST(round(quantity * unit_price * (100 - discount_pct) * CAST('0.01' AS DECIMAL(3,2)), 2)
                      AS DECIMAL(18,2)) AS line_total FROM clean_dirty""")
query(
    "clean_order_lines_drop_prices", "CL5",
    lambda m: cleaning.clean_order_items(m.dirty_lines, m.menu_items, "drop").drop("promotion_id"),
    """SELECT order_id, item_id, quantity, unit_price, discount_pct,
              CAST(round(quantity * unit_price * (100 - discount_pct) * CAST('0.01' AS DECIMAL(3,2)), 2)
                   AS DECIMAL(18,2)) AS line_total
       FROM line_copies JOIN menu_items USING (item_id) WHERE quantity > 0 AND unit_price > 0""")
query(
    "quarantined_lines", "CL6 J7",
    lambda m: cleaning.quarantined_items(m.dirty_lines, m.menu_items).drop("promotion_id"),
    """SELECT order_id, item_id, quantity, unit_price, discount_pct, line_total FROM line_copies
       WHERE quantity > 0 AND item_id NOT IN (SELECT item_id FROM menu_items)""")
query(
    "clean_ratings", "CL7", lambda m: m.ratings.groupBy("stars").agg(F.count("*").alias("ratings")),
    "SELECT stars, count(*) AS ratings FROM ratings GROUP BY stars")
query(
    "clean_wastage", "CL8",
    lambda m: cleaning.clean_wastage(m.dirty_wastage).select("item_id", "location_id", "date", "wasted_qty"),
    "SELECT item_id, location_id, date, wasted_qty FROM dirty_wastage WHERE wasted_qty >= 0")
query(
    "clean_orders", "CL9 CL10",
    lambda m: cleaning.clean_orders(m.dirty_orders).select(
        "order_id", "customer_id", "is_guest", "location_id", "channel"),
    """SELECT order_id, coalesce(customer_id, 'GUEST') AS customer_id, customer_id IS NULL AS is_guest,
              location_id, channel FROM dirty_orders WHERE status = 'completed'""")
query(
    "clean_row_audit", "CL12", lambda m: cleaning.row_audit(m.dirty_lines, m.menu_items),
    """SELECT CAST(sum(copies) AS BIGINT) AS rows_before, count_if(quantity > 0 AND unit_price > 0) AS rows_after,
              CAST(sum(copies) - count_if(quantity > 0 AND unit_price > 0) AS BIGINT) AS dropped FROM line_copies""")

# -- joins ------------------------------------------------------------------
query(
    "fact_order_lines", "J1 S1 S4 S5",
    lambda m: m.lazy_fact(),
    """SELECT order_id, item_id, category_id, location_id, customer_id, is_guest, channel, order_ts, order_date,
              promotion_id, has_promo, quantity, unit_price, discount_pct, revenue, cost, profit FROM fact""")
query(
    "fact_with_names", "J2 J5 IO3",
    lambda m: fact.widen(m.fact, m.menu_items, m.categories, m.locations).select(
        "order_id", "item_id", "item_name", "category_name", "location_name", "base_price", "food_cost", "revenue"),
    """SELECT f.order_id, f.item_id, i.name AS item_name, c.category_name, l.name AS location_name,
              i.base_price, i.food_cost, f.revenue
       FROM fact f LEFT JOIN menu_items i USING (item_id)
       LEFT JOIN categories c ON f.category_id = c.category_id LEFT JOIN locations l ON f.location_id = l.location_id""")
query(
    "fact_by_sql", "J3",
    lambda m: fact.sql_fact(m.spark, m.clean_lines, m.raw_orders, m.menu_items).groupBy(
        "item_id", "location_id").agg(
            F.sum("quantity").alias("qty"), F.sum("revenue").cast(S.MONEY).alias("revenue"),
            F.sum("profit").cast(S.MONEY).alias("profit"), F.sum("has_promo").alias("promo_lines")),
    """SELECT l.item_id, o.location_id, CAST(sum(l.quantity) AS BIGINT) AS qty,
              CAST(sum(l.line_total) AS DECIMAL(18,2)) AS revenue,
              CAST(sum(l.line_total - l.quantity * i.food_cost) AS DECIMAL(18,2)) AS profit,
              CAST(sum(CASE WHEN l.promotion_id IS NOT NULL AND l.promotion_id <> '' THEN 1 ELSE 0 END) AS BIGINT)
                AS promo_lines
       FROM clean_lines l JOIN raw_orders o ON l.order_id = o.order_id JOIN menu_items i ON l.item_id = i.item_id
       WHERE o.location_id IS NOT NULL GROUP BY l.item_id, o.location_id""")
query(
    "lines_of_completed_orders", "J6",
    lambda m: m.shipped_lines.join(cleaning.completed(m.raw_orders).select("order_id"), "order_id", "left_semi")
    .groupBy("line_status").agg(F.count("*").alias("order_lines")),
    """SELECT line_status, count(*) AS order_lines FROM raw_lines
       WHERE order_id IN (SELECT order_id FROM raw_orders WHERE status = 'completed') GROUP BY line_status""")
query(
    "asof_price_in_effect", "J8 P7",
    lambda m: m.priced_lines().select("order_id", "line_no", "item_id", "ship_date", "history_price", "price_in_effect"),
    """SELECT p.order_id, p.line_no, p.item_id, p.ship_date, h.price AS history_price,
              coalesce(h.price, CAST(i.base_price AS DECIMAL(14,4))) AS price_in_effect
       FROM (SELECT * FROM raw_lines WHERE line_status = 'O') p
       ASOF LEFT JOIN pricing_history h ON p.item_id = h.item_id AND p.ship_date >= h.effective_date
       LEFT JOIN menu_items i ON p.item_id = i.item_id""")
query(
    "header_reconciliation", "J14", lambda m: fact.header_reconciliation(m.raw_lines, m.raw_orders),
    """SELECT o.order_id, o.total_amount, t.lines_total, CAST(o.total_amount - t.lines_total AS DECIMAL(18,2)) AS difference
       FROM raw_orders o JOIN (SELECT order_id, CAST(sum(line_total) AS DECIMAL(18,2)) AS lines_total
                               FROM raw_lines GROUP BY order_id) t ON o.order_id = t.order_id""")

# -- scalar functions -------------------------------------------------------
query(
    "calendar_columns", "S1 S2 S3 S6 S7 S8",
    lambda m: m.raw_orders.select(
        "order_id", F.to_date("order_ts").alias("order_date"), F.hour("order_ts").alias("hour"), S.dow(F.col("order_ts")).alias("dow"),
        S.is_fri_sun(F.col("order_ts")).alias("is_fri_sun"), S.is_sat_sun(F.col("order_ts")).alias("is_sat_sun"), S.month_label("order_ts").alias("month"),
        F.weekofyear("order_ts").alias("iso_week"), S.week_start(F.col("order_ts")).alias("week_start"), S.week_end(F.col("order_ts")).alias("week_end")),
    """SELECT order_id, CAST(order_ts AS DATE) AS order_date, CAST(hour(order_ts) AS INTEGER) AS hour,
              CAST(isodow(order_ts) - 1 AS INTEGER) AS dow, isodow(order_ts) - 1 >= 4 AS is_fri_sun,
              isodow(order_ts) - 1 >= 5 AS is_sat_sun, strftime(order_ts, '%Y-%m') AS month,
              CAST(week(order_ts) AS INTEGER) AS iso_week, CAST(date_trunc('week', order_ts) AS DATE) AS week_start,
              CAST(date_trunc('week', order_ts) AS DATE) + 6 AS week_end FROM raw_orders""")
query(
    "clock_columns", "S9 S10 S11 S12 S13 S19",
    lambda m: m.star.raw("events").select(
        "event_id", S.hour_floor(F.col("ts")).alias("hour_floor"), S.hour_bucket(F.hour("ts")).alias("bucket"),
        S.band(F.col("value"), [5.0, 20.0], ["small", "middle", "large"]).alias("value_band"),
        F.round(S.clip(F.col("value"), 1.0, 50.0), 4).alias("clipped"),
        F.round(F.log(F.abs("value") + 1), 6).alias("log_value"), F.round(F.sqrt(F.abs("value")), 6).alias("root"),
        S.lenient_timestamp(F.concat(F.substring("props", 1, 1), F.col("event_type"))).isNotNull().alias("parsed"),
        S.lenient_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("parsed_ts")),
    """SELECT event_id, date_trunc('hour', ts) AS hour_floor,
              CAST(greatest(0, ceil((hour(ts) - 10) / 2.0)) AS INTEGER) AS bucket,
              CASE WHEN value <= 5 THEN 'small' WHEN value <= 20 THEN 'middle' ELSE 'large' END AS value_band,
              round(greatest(1.0::DOUBLE, least(50.0::DOUBLE, value)), 4) AS clipped,
              round(ln(abs(value) + 1), 6) AS log_value, round(sqrt(abs(value)), 6) AS root,
              try_cast(substr(props, 1, 1) || event_type AS TIMESTAMP) IS NOT NULL AS parsed,
              try_strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed_ts FROM events""")
query(
    "line_arithmetic", "S4 S14 S15 S16 S18",
    lambda m: m.shipped_lines.select(
        "order_id", "line_no", F.when(F.col("discount_pct") > 5, "deep").otherwise("light").alias("tier"),
        F.coalesce("promotion_id", F.lit("none")).alias("promotion"),
        F.round(S.ratio(F.col("line_total"), F.col("discount_pct")), 4).alias("per_point"),
        F.bround(F.col("line_total"), 1).cast("decimal(18,1)").alias("even_rounded")),
    """SELECT order_id, line_no, CASE WHEN discount_pct > 5 THEN 'deep' ELSE 'light' END AS tier,
              coalesce(promotion_id, 'none') AS promotion,
              round(CAST(line_total AS DOUBLE) / nullif(CAST(discount_pct AS DOUBLE), 0), 4) AS per_point,
              CAST(round_even(line_total, 1) AS DECIMAL(18,1)) AS even_rounded FROM raw_lines""")
query(
    "formatted_texts", "S20 S21",
    lambda m: m.features.select(
        "item_id", F.element_at(F.split("name", " "), 1).alias("first_word"),
        S.money_short(F.col("revenue")).alias("money"), S.thousands(F.col("qty")).alias("qty_text"),
        F.concat_ws(" | ", "item_id", S.fixed(F.col("promo_dependency"), 1)).alias("joined")),
    """SELECT item_id, split_part(name, ' ', 1) AS first_word,
              CASE WHEN revenue >= 1000000 THEN printf('$%.2fM', CAST(revenue AS DOUBLE) / 1e6)
                   WHEN revenue >= 1000 THEN printf('$%.1fk', CAST(revenue AS DOUBLE) / 1e3)
                   ELSE '$' || CAST(CAST(round_even(revenue, 0) AS BIGINT) AS VARCHAR) END AS money,
              format('{:,}', qty) AS qty_text,
              item_id || ' | ' || printf('%.1f', promo_dependency) AS joined FROM features""")
query(
    "next_days", "S23",
    lambda m: m.orders.agg(F.max("order_date").alias("last")).select(
        F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", 14))).alias("date")),
    """SELECT CAST(unnest(generate_series((SELECT max(order_date) FROM order_facts) + INTERVAL 1 DAY,
              (SELECT max(order_date) FROM order_facts) + INTERVAL 14 DAY, INTERVAL 1 DAY)) AS DATE) AS date""")
query(
    "range_filter", "S24",
    lambda m: m.fact.filter("order_date between '1997-01-01' and '1998-12-31' and location_id = 7").agg(
        F.count("*").alias("order_lines"), F.sum("revenue").cast(S.MONEY).alias("revenue")),
    """SELECT count(*) AS order_lines, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue FROM fact
       WHERE order_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' AND location_id = 7""")

# -- items ------------------------------------------------------------------
query(
    "item_economics", "M1 M2", lambda m: rounded(items.economics(m.order_items)),
    "SELECT item_id, qty, revenue, cost, profit, orders, promo_lines, lines, round(margin, 6) AS margin, "
    "promo_dependency FROM economics")
query("item_ratings", "M3", lambda m: items.rating_summary(m.ratings.fillna("unknown", ["item_id"])),
      "SELECT * REPLACE (coalesce(item_id, 'unknown') AS item_id) FROM rating_summary")
query("item_waste", "M4", lambda m: items.item_waste(m.inventory, m.wastage), "SELECT * FROM item_waste")
query("item_repeat", "M5", lambda m: items.repeat_share(m.order_items), "SELECT * FROM repeat_share")
query("item_trend", "M6", lambda m: items.trend(m.order_items), "SELECT * FROM item_trend")
query(
    "item_features", "M7 J13", lambda m: rounded(m.features),
    "SELECT * REPLACE (round(margin, 6) AS margin) FROM features")
query(
    "menu_classification", "M8 M9 M10 S17",
    lambda m: rounded(m.menu.select("item_id", "demand_score", "profit_score", "menu_class", "slow_mover")),
    """SELECT item_id, round(demand_score, 6) AS demand_score, round(profit_score, 6) AS profit_score,
              menu_class, slow_mover FROM menu""")
query(
    "menu_class_counts", "M11 J11", lambda m: items.class_counts(m.menu),
    """SELECT k AS menu_class, count(menu_class) AS items
       FROM (SELECT unnest(['Profit Driver', 'Volume Driver', 'Hidden Opportunity', 'Low Performer']) AS k)
       LEFT JOIN menu ON menu_class = k GROUP BY k""")
query(
    "profitability", "M12", lambda m: items.profitability(m.menu, m.categories),
    """SELECT item_id, name, category_name AS category, qty, revenue, cost, profit, wastage_pct, menu_class,
              round_even(margin * 100, 1) AS margin_pct FROM menu LEFT JOIN categories USING (category_id)""")
query(
    "cell_economics", "M13", lambda m: rounded(items.cell_economics(m.order_items)),
    "SELECT * REPLACE (round(margin, 6) AS margin, round(promo_dep, 6) AS promo_dep) FROM cell_economics")
query(
    "cell_waste", "M14 J4", lambda m: rounded(items.cell_waste(m.inventory, m.wastage)),
    "SELECT * REPLACE (round(wastage, 6) AS wastage) FROM cell_waste")
_CELLS_SQL = """
SELECT item_id, location_id, qty, revenue, profit, lines, promo_lines, round(margin, 6) AS margin,
       round(promo_dep, 6) AS promo_dep, prepared, wasted, round(wastage, 6) AS wastage, name, rating, repeat, trend,
       round(local_demand, 6) AS local_demand, round(local_profit, 6) AS local_profit, local_class FROM samples"""
query("local_classification", "M15 M16 M17 M18", lambda m: rounded(m.cells), _CELLS_SQL)
query(
    "tricky_cases", "M19", lambda m: items.tricky_cases(m.menu),
    """SELECT 1 AS case_no, 'high volume, thin margin' AS case_name, item_id, name FROM
         (SELECT * FROM menu ORDER BY menu_class <> 'Volume Driver', qty DESC, item_id LIMIT 1)
       UNION ALL SELECT 2, 'great margin, low visibility', item_id, name FROM
         (SELECT * FROM menu WHERE menu_class = 'Hidden Opportunity' ORDER BY margin DESC, item_id LIMIT 1)
       UNION ALL SELECT 3, 'excessive wastage', item_id, name FROM
         (SELECT * FROM menu ORDER BY wastage_pct DESC, item_id LIMIT 1)
       UNION ALL SELECT 4, 'leans on promotions', item_id, name FROM
         (SELECT * FROM menu ORDER BY promo_dependency DESC, item_id LIMIT 1)
       UNION ALL SELECT 5, 'highly rated, weak profit', item_id, name FROM
         (SELECT * FROM menu WHERE rating >= 4.4 ORDER BY margin, item_id LIMIT 1)""")
query(
    "redesign_candidates", "M20", lambda m: items.redesign_candidates(m.menu),
    """SELECT item_id, name, menu_class, slow_mover, revenue FROM menu
       WHERE slow_mover OR menu_class = 'Low Performer' ORDER BY revenue DESC, item_id LIMIT 4""")
query(
    "top_items", "M21", lambda m: items.top_items(m.menu, 7),
    "SELECT item_id, name, menu_class, revenue FROM menu ORDER BY revenue DESC, item_id LIMIT 7")
query(
    "items_of_class", "M21", lambda m: items.top_items(m.menu, 6, "Volume Driver"),
    """SELECT item_id, name, menu_class, revenue FROM menu WHERE menu_class = 'Volume Driver'
       ORDER BY revenue DESC, item_id LIMIT 6""")
query(
    "item_extremes", "D4", lambda m: items.extremes(m.menu),
    " UNION ALL ".join(
        f"(SELECT '{c}' AS measure, '{s}' AS side, item_id FROM menu ORDER BY {c} {d}, item_id LIMIT 1)"
        for c in ("qty", "profit", "margin", "rating") for s, d in (("lowest", "ASC"), ("highest", "DESC"))))
