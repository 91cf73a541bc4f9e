"""The rating-burst detector on a stream of ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.config import Config


def streaming_bursts(ratings: DataFrame, cfg: Config = Config(), window: str = "1 hour",
                     watermark: str = "1 hour", by: str = "item_id") -> DataFrame:
    """Equal ratings per item and clock hour, emitted once the watermark closes the hour.

    State holds one counter per open (item, hour, stars) group; closed hours are dropped.
    """
    return (
        ratings.filter(F.col("rating_ts").isNotNull())
        .withWatermark("rating_ts", watermark)
        .groupBy(F.window("rating_ts", window).alias("w"), by, "stars")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= cfg.burst_size)
        .select(by, F.col("w.start").alias("bin"), "stars", "n")
    )
