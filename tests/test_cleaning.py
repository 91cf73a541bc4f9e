from decimal import Decimal

from pyspark.sql import functions as F

from ladle.operators import cleaning, fact, quality


def test_log_counts_each_rule_once(defective):
    d = defective
    log = cleaning.cleaning_log(d["order_items"], d["orders"], d["ratings"], d["wastage"], d["menu_items"])
    assert [r.records for r in log.orderBy("step_no").collect()] == [1, 2, 0, 1, 1, 1, 1]


def test_clean_lines_keep_two(defective):
    d = defective
    kept = cleaning.clean_order_items(d["order_items"], d["menu_items"])
    assert sorted(r.order_id for r in kept.collect()) == ["O1", "O5"]
    assert "order_item_id" not in kept.columns
    bad = cleaning.quarantined_items(d["order_items"], d["menu_items"]).collect()
    assert [r.item_id for r in bad] == ["ZZZ"]


def test_line_number_in_the_key_keeps_repeated_lines(defective):
    d = defective
    kept = cleaning.clean_order_items(d["order_items"], d["menu_items"], dedup_key=["order_item_id"])
    assert kept.count() == 3


def test_price_policies(spark, defective):
    lines = spark.createDataFrame(
        [("O1", "M001", 2, 0.0, 10, 0.0), ("O2", "M002", 3, 2.0, None, 6.0)],
        "order_id string, item_id string, quantity int, unit_price double, discount_pct int, line_total double")
    fixed = {r.order_id: r for r in cleaning.clean_order_items(lines, defective["menu_items"]).collect()}
    assert fixed["O1"].unit_price == 9.5 and fixed["O1"].line_total == Decimal("17.10")
    assert fixed["O2"].line_total == Decimal("6.00")
    dropped = cleaning.clean_order_items(lines, defective["menu_items"], price_policy="drop").collect()
    assert [r.order_id for r in dropped] == ["O2"]


def test_guests_and_status(spark, defective):
    orders = defective["orders"].withColumn(
        "status", F.when(F.col("order_id") == "O5", "cancelled").otherwise(F.col("status")))
    clean = {r.order_id: r for r in cleaning.clean_orders(orders).collect()}
    assert set(clean) == {"O1", "O2", "O3", "O4"}
    assert clean["O3"].is_guest and clean["O3"].customer_id == "GUEST" and not clean["O1"].is_guest


def test_null_rating_is_bad(spark):
    ratings = spark.createDataFrame([(None,), (3,), (6,)], "stars int")
    assert cleaning.clean_ratings(ratings).count() == 1
    assert quality.rating_issues(ratings).first().bad_rating == 2


def test_assess_reports_every_issue(spark, defective):
    d = defective
    orders = d["orders"].withColumn("location_id", F.when(F.col("order_id") == "O1", "L99").otherwise("L01"))
    report = quality.assess(d["order_items"].drop("order_item_id"), orders, d["ratings"], d["wastage"],
                            d["menu_items"], d["locations"])
    found = {r.issue: r.records for r in report.collect()}
    assert len(found) == 9
    assert found["Duplicate order-lines"] == 1 and found["Negative quantities"] == 2
    assert found["Invalid / non-positive prices"] == 1 and found["Unknown menu item refs"] == 1
    assert found["Invalid location refs"] == 1 and found["Missing customer IDs"] == 1
    assert found["Cancelled / non-completed orders"] == 0


def test_empty_tables_give_zero_counts(defective):
    d = {k: v.limit(0) for k, v in defective.items()}
    log = cleaning.cleaning_log(d["order_items"], d["orders"], d["ratings"], d["wastage"], d["menu_items"])
    assert {r.records for r in log.collect()} == {0}
    assert cleaning.row_audit(d["order_items"], d["menu_items"]).first().dropped == 0


def test_fact_takes_promotion_from_the_order(defective):
    d = defective
    orders = cleaning.clean_orders(d["orders"].withColumn("promotion_id", F.when(F.col("order_id") == "O1", "P1").otherwise("")))
    rows = fact.build_fact(cleaning.clean_order_items(d["order_items"], d["menu_items"]), orders, d["menu_items"]).collect()
    by_order = {r.order_id: r for r in rows}
    assert by_order["O1"].has_promo and not by_order["O5"].has_promo
    assert by_order["O1"].cost == Decimal("6.00") and by_order["O1"].profit == Decimal("13.00")
    assert all(r.profit <= r.revenue for r in rows)


def test_reconciliation_difference(defective):
    d = defective
    rows = fact.header_reconciliation(d["order_items"].filter("order_item_id <> 'A1b'"), d["orders"]).collect()
    off = {r.order_id: r.difference for r in rows if r.difference}
    assert off == {"O2": Decimal("10.00")}  # header 5, but its only line is -5


def test_all_reports_share_one_identity_of_a_line(spark, defective):
    """The running number is no part of a line; assessment, log, audit and removal agree, also on further columns."""
    d = defective
    report = quality.assess(d["order_items"], d["orders"], d["ratings"], d["wastage"], d["menu_items"], d["locations"])
    assert {r.issue: r.records for r in report.collect()}["Duplicate order-lines"] == 1
    promoted = d["order_items"].withColumn("line_promo", F.col("order_item_id"))
    for lines, repeats in ((d["order_items"], 1), (promoted, 0)):
        assert quality.line_issues(lines, d["menu_items"]).first().duplicate_lines == repeats
        log = cleaning.cleaning_log(lines, d["orders"], d["ratings"], d["wastage"], d["menu_items"])
        assert log.orderBy("step_no").first().records == repeats
        assert lines.count() - cleaning.drop_duplicate_lines(lines).count() == repeats
        audit = cleaning.row_audit(lines, d["menu_items"]).first()
        assert audit.rows_before == lines.count()


def test_log_takes_any_key(defective):
    d = defective
    log = cleaning.cleaning_log(d["order_items"], d["orders"], d["ratings"], d["wastage"], d["menu_items"], dedup_key=["order_item_id"])
    assert [r.records for r in log.orderBy("step_no").collect()] == [0, 2, 0, 1, 1, 1, 1]


def test_weekly_stock_names_no_weekday(spark):
    from ladle.operators import commerce

    weekly = [("M1", "L1", f"2026-01-{d:02d}", 10, 4) for d in (5, 12, 19)]
    schema = "item_id string, location_id string, date string, prepared_qty int, consumed_qty int"
    days = lambda rows: [r.day for r in commerce.risk_weekday(spark.createDataFrame(rows, schema).withColumn("date", F.to_date("date"))).collect()]
    assert days(weekly) == [None]
    assert days([*weekly, ("M1", "L1", "2026-01-06", 90, 4)]) == ["Tue"]
