from __future__ import annotations

import os
import sys
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]").appName("ladle-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test tables are not on this machine")
    return SF_DIR


@pytest.fixture(scope="session")
def mart(spark, sf_dir):
    from ladle.plans.mart import mart_for
    return mart_for(spark, sf_dir)


@pytest.fixture(scope="session")
def defective(spark):
    """Six small tables with one of each defect."""
    at = datetime(2026, 1, 1, 12)
    lines = [
        ("A1", "O1", "M001", 2, 9.5, 0, 19.0), ("A1b", "O1", "M001", 2, 9.5, 0, 19.0),
        ("A2", "O2", "M002", -1, 5.0, 0, -5.0), ("A3", "O3", "M003", 0, -4.0, 0, 0.0),
        ("A4", "O4", "ZZZ", 3, 7.0, 0, 21.0), ("A5", "O5", "M002", 1, 6.0, 0, 6.0)]
    orders = [(f"O{i}", c, "L01", "Dine-in", at, None, t, "completed") for i, (c, t) in enumerate(
        [("C1", 19.0), ("C2", 5.0), (None, 0.0), ("C4", 21.0), ("C5", 6.0)], 1)]
    return {
        "order_items": spark.createDataFrame(
            lines, "order_item_id string, order_id string, item_id string, quantity int, unit_price double, "
                   "discount_pct int, line_total double"),
        "orders": spark.createDataFrame(
            orders, "order_id string, customer_id string, location_id string, channel string, order_ts timestamp, "
                    "promotion_id string, total_amount double, status string"),
        "menu_items": spark.createDataFrame(
            [("M001", "A", "C01", 9.5, 3.0), ("M002", "B", "C01", 6.0, 2.0), ("M003", "C", "C02", 8.0, 3.0)],
            "item_id string, name string, category_id string, base_price double, food_cost double"),
        "ratings": spark.createDataFrame(
            [("R1", "M001", "C1", "L01", 5, datetime(2026, 1, 1, 13)), ("R2", "M002", "C2", "L01", 9, datetime(2026, 1, 1, 13))],
            "rating_id string, item_id string, customer_id string, location_id string, stars int, rating_ts timestamp"),
        "wastage": spark.createDataFrame(
            [("W1", "M001", "L01", date(2026, 1, 1), 2, 4.0), ("W2", "M002", "L01", date(2026, 1, 1), -3, 6.0)],
            "wastage_id string, item_id string, location_id string, date date, wasted_qty int, cost double"),
        "locations": spark.createDataFrame([("L01", "Main", "X")], "location_id string, name string, city string"),
    }


@pytest.fixture
def money():
    return lambda text: Decimal(text)
