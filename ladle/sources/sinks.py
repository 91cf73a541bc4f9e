"""Report, payload, metric and catalogue outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Report keys and their titles.
REPORTS = {
    "menu_performance": "Menu performance",
    "profitability": "Profitability",
    "customer_segments": "Customer segmentation",
    "churn_risk": "Churn risk",
    "market_basket_rules": "Market-basket analysis",
    "demand_forecast": "Demand forecast",
    "forecast_by_location": "Forecast by location",
    "forecast_by_category": "Forecast by category",
    "price_sensitivity": "Pricing",
    "promotion_effectiveness": "Promotions",
    "wastage_by_item": "Wastage",
    "peak_monthly": "Monthly orders",
    "location_performance": "Location performance",
    "anomalies": "Anomalies",
    "recommendations": "Recommendations",
    "model_comparison": "Model comparison",
    "spark_predictions": "Predictions, first family",
    "python_predictions": "Predictions, second family",
    "data_quality_report": "Data-quality report",
    "cleaning_log": "Cleaning log",
}


def write_report(df: DataFrame, root: str, name: str, fmt: str = "parquet") -> None:
    """Executors write the report; nothing passes through the driver."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.format(fmt).save(f"{root}/{name}")


def write_reports(reports: dict[str, DataFrame], root: str, fmt: str = "parquet") -> None:
    for name, df in reports.items():
        write_report(df, root, name, fmt)


def read_report(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", True).option("escape", '"')
    return reader.format(fmt).load(f"{root}/{name}")


def catalogue(spark: SparkSession, root: str, reports: dict[str, str] = REPORTS) -> DataFrame:
    """Report keys, titles and whether the report exists under ``root``.

    Looks only for the folders, through the Hadoop file system of the path.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(conf)
    rows = [(k, t, bool(fs.exists(jvm.org.apache.hadoop.fs.Path(base, f"{k}/_SUCCESS")))) for k, t in reports.items()]
    return spark.createDataFrame(rows, "report string, title string, available boolean")


def report_view(df: DataFrame, order: list, cap: int = 2000) -> DataFrame:
    """The first ``cap`` rows of a report plus its full length and a truncation flag."""
    total = df.agg(F.count("*")).scalar()
    head = df.orderBy(*order).limit(cap)
    return head.withColumn("total", total).withColumn("truncated", F.col("total") > cap)


def payload(spark: SparkSession, sections: dict[str, DataFrame]) -> DataFrame:
    """One row, one array of structs per section, for a few sections of fixed length (a KPI row, classes,
    months). Reports that grow with items or outlets go out with ``write_sections``."""
    row = spark.range(1).select(F.lit(1).alias("version"))
    columns = {}
    for name, df in sections.items():
        packed = df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias("rows"))
        columns[name] = packed.scalar()
    return row.withColumns(columns)


def write_sections(sections: dict[str, DataFrame], path: str) -> None:
    """One JSON folder per section, written by the executors: no section passes through one task or the driver."""
    for name, df in sections.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def write_payload(doc: DataFrame, path: str) -> None:
    doc.write.mode("overwrite").json(path)
