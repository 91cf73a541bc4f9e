"""Exact selection of a few ranks from an unbounded table, without a rank per row.

Each wanted rank lies in a range of keys that is narrowed by pivots: a hash sample of the range's own rows. One aggregate
counts the rows at and between pivots for all ranges at once; once a range holds few rows it is read. Keys may be any orderable
column, also structs such as (value, id), so that a value which most rows share is split by its tie key. What reaches the
driver is bounded: pivots, counts, and at most SMALL keys per range.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

#: Rows of a range that are read to end the search.
SMALL = 4096
PIVOTS = 16


@dataclass
class _Range:
    """Keys between low and high, without them (no bound if unset): how many rows come before it and lie in it."""

    before: int
    rows: int
    low: Any = None
    high: Any = None
    has_low: bool = False
    has_high: bool = False


def literal(value: Any, kind: DataType) -> Column:
    """A collected key as a column again."""
    if hasattr(value, "asDict"):
        return F.struct(*[literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields, strict=True)])
    return F.lit(value).cast(kind)


def _inside(key: Column, r: _Range, kind: DataType) -> Column:
    test = F.lit(True)
    if r.has_low:
        test = test & (key > literal(r.low, kind))
    if r.has_high:
        test = test & (key < literal(r.high, kind))
    return test


def keys_at_ranks(df: DataFrame, key: Column, ranks: list[int], small: int = SMALL, pivots: int = PIVOTS) -> list[Any]:
    """The keys at 1-based ranks of the ascending order (nulls first), in the order of `ranks`.

    Equal keys may meet a rank: any of them is the key. A rank outside 1 to the number of rows gives None.
    """
    rows = df.select(F.struct(key.alias("key")).alias("k"))  # structs compare nulls, too
    kind = rows.schema["k"].dataType
    total = rows.count()
    wanted = {r for r in ranks if 1 <= r <= total}
    found: dict[int, Any] = {}
    ranges = {r: _Range(0, total) for r in wanted}
    salt = 0
    while ranges:
        salt += 1
        spans = {(x.before, x.rows): x for x in ranges.values()}
        number = {s: i for i, s in enumerate(spans)}
        place = F.lit(None).cast("int")
        for s, i in number.items():
            place = F.when(_inside(F.col("k"), spans[s], kind), i).otherwise(place)
        placed = rows.withColumn("range", place).filter("range is not null")
        # small ranges whole, of large ones a sample of about 4 * pivots keys
        step = F.lit(1).cast("long")
        for s, i in number.items():
            if s[1] > small:
                step = F.when(F.col("range") == i, max(1, s[1] // (4 * pivots))).otherwise(step)
        read = placed.filter(F.pmod(F.xxhash64(F.lit(salt), F.col("k")), step) == 0).orderBy("range", "k").collect()
        keys: dict[int, list] = {i: [] for i in number.values()}
        for r in read:
            keys[r["range"]].append(r["k"])
        cuts = {}
        for s, i in number.items():
            if s[1] <= small:
                for rank in [w for w, x in ranges.items() if (x.before, x.rows) == s]:
                    found[rank] = keys[i][rank - s[0] - 1]
                    del ranges[rank]
            else:
                distinct = list(dict.fromkeys(keys[i]))
                every = max(1, len(distinct) // pivots)
                cuts[s] = distinct[every // 2::every] if distinct else []
        if not any(cuts.values()):
            continue  # another salt draws another sample
        slot = F.lit(0)
        for s, points in cuts.items():
            at = F.lit(0)
            for p in points:  # 2 per pivot below the key, 1 for the pivot that it equals
                at = at + F.when(F.col("k") > literal(p, kind), 2).when(F.col("k") == literal(p, kind), 1).otherwise(0)
            slot = F.when(F.col("range") == number[s], at).otherwise(slot)
        counted = {(r["range"], r["slot"]): r["n"] for r in placed.groupBy("range", slot.alias("slot")).agg(F.count("*").alias("n")).collect()}
        for s, points in cuts.items():
            before, old = s[0], spans[s]
            mine = [w for w, x in ranges.items() if (x.before, x.rows) == s]
            for j in range(2 * len(points) + 1):
                n = counted.get((number[s], j), 0)
                left, right = j // 2 - 1, j // 2
                for rank in [w for w in mine if before < w <= before + n]:
                    if j % 2:
                        found[rank] = points[right]
                        del ranges[rank]
                    else:
                        ranges[rank] = _Range(before, n, points[left] if left >= 0 else old.low, points[right] if right < len(points) else old.high,
                                              left >= 0 or old.has_low, right < len(points) or old.has_high)
                before += n
    return [found[r]["key"] if r in found else None for r in ranks]


def step_of(key: Column, edges: list[Any], kind: DataType) -> Column:
    """How many edges lie below the key: 0 up to the first edge."""
    return sum([(key > literal(e, kind)).cast("int") for e in edges], F.lit(0))
