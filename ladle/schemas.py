"""Explicit schemas of the eleven source tables (no inference pass needed)."""

from __future__ import annotations

SCHEMAS: dict[str, str] = {
    "menu_categories": "category_id string, category_name string",
    "menu_items": "item_id string, name string, category_id string, base_price double, food_cost double",
    "locations": "location_id string, name string, city string",
    "customers": "customer_id string, name string, signup_date date, ctype string",
    "promotions": "promotion_id string, name string, type string, discount_pct int, "
                  "start_date date, end_date date",
    "pricing_history": "item_id string, price double, effective_date date",
    "orders": "order_id string, customer_id string, location_id string, channel string, "
              "order_ts timestamp, promotion_id string, total_amount double, status string",
    "order_items": "order_item_id string, order_id string, item_id string, quantity int, "
                   "unit_price double, discount_pct int, line_total double",
    "ratings": "rating_id string, item_id string, customer_id string, location_id string, "
               "stars int, rating_ts timestamp",
    "inventory": "item_id string, location_id string, date date, prepared_qty int, consumed_qty int",
    "wastage": "wastage_id string, item_id string, location_id string, date date, wasted_qty int, "
               "reason string, cost double",
}
TABLES = tuple(SCHEMAS)
