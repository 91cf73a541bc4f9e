"""The canonical tables in ANSI SQL, shared by all check queries as one WITH prefix."""

VIEWS = """
menu_items AS (
  SELECT p_brand || '/' || p_type AS item_id, p_brand || ' ' || p_type AS name, p_type AS category_id,
         CAST(2 * min(CAST(p_retailprice AS DECIMAL(12,2))) AS DECIMAL(12,2)) AS base_price,
         min(CAST(p_retailprice AS DECIMAL(12,2))) AS food_cost,
         CAST(row_number() OVER (ORDER BY p_brand || '/' || p_type) - 1 AS INTEGER) AS item_no
  FROM part GROUP BY p_brand, p_type),
categories AS (
  SELECT DISTINCT category_id, upper(substr(category_id, 1, 1)) || lower(substr(category_id, 2)) AS category_name
  FROM menu_items),
locations AS (
  SELECT n_nationkey AS location_id, n_name AS name, r_name AS city
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
promotions AS (
  SELECT 'P' || lpad(CAST(discount_pct AS VARCHAR), 2, '0') AS promotion_id,
         'Tier ' || CAST(discount_pct AS VARCHAR) || '%' AS name,
         CASE WHEN discount_pct <= 5 THEN 'light' ELSE 'deep' END AS type, discount_pct
  FROM (SELECT DISTINCT CAST(round(l_discount * 100) AS INTEGER) AS discount_pct FROM lineitem)
  WHERE discount_pct > 0),
raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, c_nationkey AS location_id, o_orderpriority AS channel,
         o_orderdate AS order_ts, CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount,
         CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'completed' END AS status
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
raw_lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, p_brand || '/' || p_type AS item_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(((CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) * 200 + CAST(l_quantity AS INTEGER))
               // (CAST(l_quantity AS INTEGER) * 2)) * CAST('0.0001' AS DECIMAL(5,4)) AS DECIMAL(14,4)) AS unit_price,
         CAST(round(l_discount * 100) AS INTEGER) AS discount_pct,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
              AS DECIMAL(18,2)) AS line_total,
         CAST(l_shipdate AS DATE) AS ship_date, l_returnflag AS return_flag, l_linestatus AS line_status,
         CASE WHEN round(l_discount * 100) > 0
              THEN 'P' || lpad(CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR), 2, '0') END AS promotion_id
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
raw_ratings AS (
  SELECT event_id AS rating_id, item_id, user_id AS customer_id, c_nationkey AS location_id,
         CAST(floor(value) AS INTEGER) % 7 AS stars, ts AS rating_ts, event_type AS kind
  FROM events
  LEFT JOIN menu_items ON item_no = CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER)
  LEFT JOIN customer ON user_id = c_custkey),
ratings AS (SELECT * FROM raw_ratings WHERE coalesce(stars BETWEEN 1 AND 5, false)),
stock_daily AS (
  SELECT l.item_id, o.location_id, l.ship_date AS date, CAST(sum(l.quantity) AS BIGINT) AS prepared_qty,
         CAST(sum(CASE WHEN l.return_flag = 'R' THEN l.quantity ELSE 0 END) AS BIGINT) AS wasted_qty,
         CAST(sum(CASE WHEN l.return_flag = 'R' THEN 0 ELSE l.quantity END) AS BIGINT) AS consumed_qty,
         CAST(sum(CASE WHEN l.return_flag = 'R' THEN l.quantity ELSE 0 END) * min(i.food_cost) AS DECIMAL(18,2)) AS cost
  FROM raw_lines l JOIN raw_orders o ON l.order_id = o.order_id JOIN menu_items i ON l.item_id = i.item_id
  GROUP BY l.item_id, o.location_id, l.ship_date),
stock AS (
  SELECT item_id, location_id, CAST(date_trunc('week', date) AS DATE) AS date,
         CAST(sum(prepared_qty) AS BIGINT) AS prepared_qty, CAST(sum(consumed_qty) AS BIGINT) AS consumed_qty,
         CAST(sum(wasted_qty) AS BIGINT) AS wasted_qty, CAST(sum(cost) AS DECIMAL(18,2)) AS cost
  FROM stock_daily GROUP BY item_id, location_id, date_trunc('week', date)),
pricing_history AS (
  SELECT item_id, ship_date AS effective_date, max(unit_price) AS price
  FROM raw_lines WHERE line_status = 'F' GROUP BY item_id, ship_date),
dirty_lines AS (
  SELECT order_id,
         CASE WHEN (order_id * 7 + line_no) % 1009 = 0 THEN 'UNKNOWN' ELSE item_id END AS item_id,
         CASE WHEN order_id % 997 = 0 THEN -1 ELSE quantity END AS quantity,
         CASE WHEN order_id % 311 = 0 THEN CAST(0 AS DECIMAL(14,4)) ELSE unit_price END AS unit_price,
         discount_pct, line_total, promotion_id
  FROM raw_lines, unnest(CASE WHEN order_id % 501 = 0 THEN [1, 2] ELSE [1] END) AS c(copy)),
dirty_orders AS (
  SELECT order_id, CASE WHEN order_id % 125 <> 0 THEN CAST(customer_id AS VARCHAR) END AS customer_id,
         CASE WHEN order_id % 1013 = 0 THEN -1 ELSE location_id END AS location_id,
         channel, order_ts, total_amount, status
  FROM raw_orders),
dirty_wastage AS (
  SELECT item_id, location_id, date, prepared_qty, consumed_qty, cost,
         CASE WHEN month(date) = 1 AND location_id = 3 THEN -wasted_qty ELSE wasted_qty END AS wasted_qty
  FROM stock),
line_copies AS (
  SELECT order_id, item_id, quantity, unit_price, discount_pct, line_total, count(*) AS copies
  FROM dirty_lines GROUP BY ALL),
clean_dirty AS (
  SELECT c.order_id, c.item_id, c.quantity,
         CASE WHEN unit_price <= 0 THEN CAST(i.base_price AS DECIMAL(14,4)) ELSE unit_price END AS unit_price,
         c.discount_pct
  FROM line_copies c JOIN menu_items i ON c.item_id = i.item_id WHERE quantity > 0),
clean_lines AS (
  SELECT order_id, item_id, quantity, unit_price, discount_pct, promotion_id,
         CAST(round(quantity * unit_price * (100 - discount_pct) * CAST('0.01' AS DECIMAL(3,2)), 2)
              AS DECIMAL(18,2)) AS line_total
  FROM (SELECT DISTINCT order_id, item_id, quantity, unit_price, discount_pct, line_total, promotion_id
        FROM raw_lines WHERE quantity > 0)),
fact AS (
  SELECT l.order_id, l.item_id, i.category_id, o.location_id, o.customer_id, o.customer_id IS NULL AS is_guest,
         o.channel, o.order_ts, CAST(o.order_ts AS DATE) AS order_date, l.promotion_id,
         coalesce(l.promotion_id, '') <> '' AS has_promo, l.quantity, l.unit_price, l.discount_pct,
         l.line_total AS revenue, CAST(round(l.quantity * i.food_cost, 2) AS DECIMAL(18,2)) AS cost,
         CAST(l.line_total - round(l.quantity * i.food_cost, 2) AS DECIMAL(18,2)) AS profit
  FROM clean_lines l JOIN raw_orders o ON l.order_id = o.order_id JOIN menu_items i ON l.item_id = i.item_id
  WHERE o.status = 'completed'),
order_facts AS (
  SELECT order_id, location_id, customer_id, is_guest, channel, order_ts, order_date,
         CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue, CAST(sum(profit) AS DECIMAL(18,2)) AS profit,
         CAST(sum(quantity) AS BIGINT) AS quantity, count(*) AS lines, count_if(has_promo) AS promo_lines
  FROM fact GROUP BY order_id, location_id, customer_id, is_guest, channel, order_ts, order_date),
economics AS (
  SELECT item_id, CAST(sum(quantity) AS BIGINT) AS qty, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue,
         CAST(sum(cost) AS DECIMAL(18,2)) AS cost, CAST(sum(profit) AS DECIMAL(18,2)) AS profit,
         count(DISTINCT order_id) AS orders, count_if(has_promo) AS promo_lines, count(*) AS lines,
         CAST(sum(revenue) - sum(cost) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) AS margin,
         round_even(CAST(count_if(has_promo) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100, 1) AS promo_dependency
  FROM fact GROUP BY item_id),
rating_summary AS (
  SELECT item_id, round_even(avg(stars), 2) AS rating, count(stars) AS rating_count FROM ratings GROUP BY item_id),
item_waste AS (
  SELECT item_id, CAST(sum(prepared_qty) AS BIGINT) AS prepared, CAST(sum(consumed_qty) AS BIGINT) AS consumed,
         CAST(sum(wasted_qty) AS BIGINT) AS wasted,
         round_even(CAST(sum(wasted_qty) AS DOUBLE) / CAST(sum(prepared_qty) AS DOUBLE) * 100, 1) AS wastage_pct
  FROM stock GROUP BY item_id),
repeat_share AS (
  SELECT item_id, round_even(avg(CASE WHEN n > 1 THEN 1 ELSE 0 END) * 100, 0) AS repeat_pct
  FROM (SELECT item_id, customer_id, count(DISTINCT order_id) AS n FROM fact GROUP BY item_id, customer_id)
  GROUP BY item_id),
span AS (SELECT min(order_date) AS d0, max(order_date) AS d1 FROM fact),
item_trend AS (
  SELECT item_id, CAST(early AS BIGINT) AS early, CAST(late AS BIGINT) AS late,
         round_even(CAST(late - early AS DOUBLE) / nullif(CAST(early AS DOUBLE), 0) * 100, 0) + 0 AS trend
  FROM (SELECT item_id,
               sum(quantity) FILTER (date_diff('day', d0, order_date) * 3 <= date_diff('day', d0, d1)) AS early,
               sum(quantity) FILTER (date_diff('day', order_date, d1) * 3 < date_diff('day', d0, d1)) AS late
        FROM fact, span GROUP BY item_id)),
features AS (
  SELECT e.*, coalesce(r.rating, 3.8) AS rating, coalesce(r.rating_count, 0) AS rating_count,
         w.prepared, w.consumed, w.wasted, coalesce(w.wastage_pct, 0) AS wastage_pct,
         coalesce(p.repeat_pct, 0) AS repeat_pct, coalesce(t.trend, 0) AS trend,
         i.name, i.category_id, i.base_price, i.food_cost
  FROM economics e LEFT JOIN rating_summary r USING (item_id) LEFT JOIN item_waste w USING (item_id)
  LEFT JOIN repeat_share p USING (item_id) LEFT JOIN item_trend t USING (item_id)
  LEFT JOIN menu_items i USING (item_id)),
scored AS (
  SELECT f.*,
         CASE WHEN q1 > q0 THEN CAST(qty - q0 AS DOUBLE) / CAST(q1 - q0 AS DOUBLE) ELSE 0.5 END AS demand_score,
         CASE WHEN m1 > m0 THEN (margin - m0) / (m1 - m0) ELSE CAST(0.5 AS DOUBLE) END
           - (wastage_pct / 100) * CAST(0.9 AS DOUBLE)
           - CASE WHEN rating < 3.6 THEN CAST(0.12 AS DOUBLE) ELSE 0 END AS profit_score
  FROM features f, (SELECT min(qty) AS q0, max(qty) AS q1, min(margin) AS m0, max(margin) AS m1 FROM features)),
menu AS (
  SELECT *, CASE WHEN demand_score >= 0.55 AND profit_score >= 0.45 THEN 'Profit Driver'
                 WHEN demand_score >= 0.55 THEN 'Volume Driver'
                 WHEN profit_score >= 0.45 THEN 'Hidden Opportunity' ELSE 'Low Performer' END AS menu_class,
         demand_score < 0.35 AND (wastage_pct > 8 OR trend < 0) AS slow_mover
  FROM scored),
cell_economics AS (
  SELECT item_id, location_id, CAST(sum(quantity) AS BIGINT) AS qty, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue,
         CAST(sum(profit) AS DECIMAL(18,2)) AS profit, count(*) AS lines, count_if(has_promo) AS promo_lines,
         CAST(sum(profit) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) AS margin,
         CAST(count_if(has_promo) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS promo_dep
  FROM fact GROUP BY item_id, location_id),
cell_waste AS (
  SELECT item_id, location_id, CAST(sum(prepared_qty) AS BIGINT) AS prepared, CAST(sum(wasted_qty) AS BIGINT) AS wasted,
         CAST(sum(wasted_qty) AS DOUBLE) / CAST(sum(prepared_qty) AS DOUBLE) * 100 AS wastage
  FROM stock GROUP BY item_id, location_id),
cells AS (
  SELECT c.*, w.prepared, w.wasted, coalesce(w.wastage, 0) AS wastage, m.name, m.rating,
         m.repeat_pct AS repeat, m.trend
  FROM cell_economics c LEFT JOIN cell_waste w USING (item_id, location_id) LEFT JOIN menu m USING (item_id)),
local_scored AS (
  SELECT *,
    CASE WHEN max(qty) OVER h > min(qty) OVER h
         THEN CAST(qty - min(qty) OVER h AS DOUBLE) / CAST(max(qty) OVER h - min(qty) OVER h AS DOUBLE)
         ELSE 0.5 END AS local_demand,
    CASE WHEN max(margin) OVER h > min(margin) OVER h
         THEN (margin - min(margin) OVER h) / (max(margin) OVER h - min(margin) OVER h)
         ELSE CAST(0.5 AS DOUBLE) END - (wastage / 100) * CAST(0.9 AS DOUBLE)
      - CASE WHEN rating < 3.6 THEN CAST(0.12 AS DOUBLE) ELSE 0 END AS local_profit
  FROM cells WINDOW h AS (PARTITION BY location_id)),
samples AS (
  SELECT *, CASE WHEN local_demand >= 0.55 AND local_profit >= 0.45 THEN 'Profit Driver'
                 WHEN local_demand >= 0.55 THEN 'Volume Driver'
                 WHEN local_profit >= 0.45 THEN 'Hidden Opportunity' ELSE 'Low Performer' END AS local_class
  FROM local_scored),
customers AS (
  SELECT b.customer_id,
         CAST(floor((epoch((SELECT CAST(max(order_date) AS TIMESTAMP) FROM order_facts)) - epoch(last_ts)) / 86400)
              AS INTEGER) AS recency,
         frequency, monetary, categories,
         round_even(CAST(promo AS DOUBLE) / CAST(lines AS DOUBLE) * 100, 0) AS promo_share,
         round_even(CAST(monetary AS DOUBLE) / CAST(frequency AS DOUBLE), 2) AS avg_order_value
  FROM (SELECT customer_id, max(order_ts) AS last_ts, count(*) AS frequency,
               CAST(sum(revenue) AS DECIMAL(18,2)) AS monetary, sum(promo_lines) AS promo, sum(lines) AS lines
        FROM order_facts WHERE NOT is_guest GROUP BY customer_id) b
  JOIN (SELECT customer_id, count(DISTINCT category_id) AS categories FROM fact WHERE NOT is_guest
        GROUP BY customer_id) t ON b.customer_id = t.customer_id),
segments AS (
  SELECT c.*, CASE WHEN recency > r * 1.5 AND frequency < f THEN 'At-Risk'
                   WHEN CAST(monetary AS DOUBLE) > m * 1.5 THEN 'High-Value Loyal'
                   WHEN promo_share > p * 1.25 THEN 'Promotion-Driven'
                   WHEN frequency > f THEN 'Frequent'
                   WHEN recency < r * 0.6 THEN 'New' ELSE 'Occasional' END AS segment
  FROM customers c, (SELECT avg(recency) AS r, avg(frequency) AS f, avg(CAST(monetary AS DOUBLE)) AS m,
                            avg(promo_share) AS p FROM customers)),
daily AS (
  SELECT order_date AS date, CAST(sum(revenue) AS DECIMAL(18,2)) AS revenue,
         CAST(sum(profit) AS DECIMAL(18,2)) AS profit, count(*) AS orders
  FROM order_facts GROUP BY order_date)
"""


def check(body: str, *more: str) -> str:
    """A complete statement: the shared views, extra views in order, and the final select."""
    extra = "".join(",\n" + view for view in more)
    return f"WITH {VIEWS.strip()}{extra}\n{body.strip()}"
