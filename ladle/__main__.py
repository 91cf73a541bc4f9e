"""Batch run: ``python -m ladle --raw FOLDER --out FOLDER`` (or ``--star FOLDER``)."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from ladle.config import Config
from ladle.plans import batch
from ladle.plans.mart import FileMart, StarMart


def main() -> None:
    parser = argparse.ArgumentParser(prog="ladle")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--raw", help="folder with the eleven source tables")
    source.add_argument("--star", help="folder with star-schema Parquet tables")
    parser.add_argument("--raw-format", default="csv", choices=("csv", "parquet"))
    parser.add_argument("--out", required=True)
    parser.add_argument("--format", default="parquet", choices=("csv", "parquet"))
    parser.add_argument("--analysis-end", type=date.fromisoformat)
    args = parser.parse_args()
    # master and sizing come from spark-submit or the cluster's defaults
    spark = SparkSession.builder.appName("ladle").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    cfg = Config(analysis_end=args.analysis_end)
    mart = FileMart(spark, args.raw, cfg, args.raw_format) if args.raw else StarMart(spark, args.star, cfg)
    try:
        batch.run(mart, args.out, args.format)
    finally:
        mart.close()


if __name__ == "__main__":
    main()
