"""Scans of the raw CSV and Parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ladle.schemas import SCHEMAS, TABLES


def read_csv(spark: SparkSession, folder: str, name: str, infer: bool = False,
             columns: list[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """One raw table. With a known schema (its own, unless one is given) there is no inference pass; ``columns``
    are pruned in the scan."""
    reader = spark.read.option("header", True).option("escape", '"')
    reader = reader.option("inferSchema", True) if infer else reader.schema(schema or SCHEMAS[name])
    df = reader.csv(f"{folder.rstrip('/')}/{name}.csv")
    return df if columns is None else df.select(*columns)


def read_parquet(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return df if columns is None else df.select(*columns)


def read_raw(spark: SparkSession, folder: str, names=TABLES, fmt: str = "csv") -> dict[str, DataFrame]:
    """All source tables, lazily."""
    read = {"csv": read_csv, "parquet": read_parquet}[fmt]
    return {name: read(spark, folder, name) for name in names}


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, all tables counted by one job."""
    counts = [df.agg(F.count("*").alias("records")).select(F.lit(name).alias("table_name"), "records")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
