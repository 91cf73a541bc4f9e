"""Rows dealt by key into partitions of bounded size, for groups of few rows each.

An aggregate first combines the rows of each input task in a hash map. Where hardly two rows of a task share a key this
combines nothing: the map holds nearly every row, grows with the input split and spills. Dealt rows cross the shuffle as
they are, and one task holds the groups of about ROWS_PER_TASK rows, however large the table is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS_PER_TASK = 250_000


def parts_of(df: DataFrame, rows_per_task: int) -> int:
    """Counts the rows: meant for stored tables, where that reads file footers."""
    return max(1, -(-df.count() // rows_per_task))


def dealt(df: DataFrame, *keys: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows, equal keys in one partition."""
    return df.repartition(parts_of(df, rows_per_task), *keys)


def dealt_alike(df: DataFrame, other: DataFrame, *keys: str, rows_per_task: int = 2 * ROWS_PER_TASK) -> tuple[DataFrame, DataFrame]:
    """Both tables dealt as the rows of the first ask for, so that a join by the keys shuffles neither again."""
    parts = parts_of(df, rows_per_task)
    return df.repartition(parts, *keys), other.repartition(parts, *keys)
