"""Column functions shared by the operators (all JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that yields null for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def half_even(value: Column, digits: int) -> Column:
    return F.bround(value.cast("double"), digits)


def line_amount(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """``round(quantity * price * (1 - discount/100), 2)`` in exact decimals."""
    keep = (F.lit(100) - F.coalesce(discount_pct, F.lit(0)).cast("int")).cast("decimal(5,0)")
    hundredth = F.lit("0.01").cast("decimal(2,2)")
    gross = quantity.cast("decimal(10,0)") * unit_price.cast("decimal(14,4)")
    return F.round(gross * keep * hundredth, 2).cast(MONEY)


def whole_hundredths(value: Column, least: float, most: float) -> Column:
    """True where a double is a whole number of hundredths in the open range (of 1e13 either way at most).

    ``hundredths`` is that number there: what a cast to a decimal of two places gives by way of the double's text.
    """
    return (value > least) & (value < most) & (F.rint(value * 100) / 100 == value)


def hundredths(value: Column) -> Column:
    return F.rint(value * 100).cast("bigint")


def from_hundredths(whole: Column) -> Column:
    """MONEY of a number of hundredths of at most 15 digits."""
    return (whole.cast("decimal(15,0)") * F.lit("0.01").cast("decimal(2,2)")).cast(MONEY)


def money(value: Column) -> Column:
    """The cast of a double to MONEY, several times as fast for whole cents."""
    return F.when(whole_hundredths(value, -1e13, 1e13), from_hundredths(hundredths(value))).otherwise(value.cast(MONEY))


def present(value: Column) -> Column:
    """True where a text key is neither null nor empty."""
    return F.coalesce(value.cast("string"), F.lit("")) != ""


def dow(value: Column) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(value)


def is_fri_sun(value: Column) -> Column:
    return dow(value) >= 4


def is_sat_sun(value: Column) -> Column:
    return dow(value) >= 5


def month_label(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM")


def week_start(value: Column) -> Column:
    return F.date_trunc("week", value).cast("date")


def week_end(value: Column) -> Column:
    return F.date_add(week_start(value), 6)


def hour_floor(value: Column) -> Column:
    return F.date_trunc("hour", value)


def lenient_timestamp(value: Column) -> Column:
    return F.try_to_timestamp(value)


def hour_bucket(hour: Column) -> Column:
    """Index of the nearest two-hour mark 9, 11, ... 23; ties go to the lower mark."""
    return F.greatest(F.lit(0), F.ceil((hour - 10) / F.lit(2.0))).cast("int")


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def band(value: Column, cuts: list[float], labels: list[str]) -> Column:
    """Right-closed interval banding: the first label whose cut is >= value."""
    out = F.when(value <= cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:]):
        out = out.when(value <= cut, label)
    return out.otherwise(labels[-1])


def minmax(value: Column, low: Column, high: Column) -> Column:
    """Scale to 0..1; a constant range gives 0.5."""
    return F.when(high > low, (value - low) / (high - low)).otherwise(F.lit(0.5))


def money_short(value: Column) -> Column:
    value = value.cast("double")
    return (
        F.when(value >= 1e6, F.format_string("$%.2fM", value / 1e6))
        .when(value >= 1e3, F.format_string("$%.1fk", value / 1e3))
        .otherwise(F.format_string("$%d", F.bround(value, 0).cast("long")))
    )


def signed(value: Column, digits: int) -> Column:
    """Fixed-point text with a sign; halves go to the even digit, unlike ``format_string``."""
    return F.format_string(f"%+.{digits}f", half_even(value, digits))


def fixed(value: Column, digits: int) -> Column:
    """Fixed-point text; halves go to the even digit, unlike ``format_string`` alone."""
    return F.format_string(f"%.{digits}f", half_even(value, digits))


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def label_of(index: Column, labels) -> Column:
    """Position -> label lookup."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), index.cast("int") + 1)


def as_columns(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row of ``df``.

    The aggregate becomes one scalar subquery returning a struct, so no join node
    is planned and nothing but that single row moves.
    """
    names = one_row.columns
    packed = one_row.select(F.struct(*names).alias("s")).scalar()
    wide = df.withColumn("__scalars", packed)
    return wide.select(*df.columns, *[F.col("__scalars")[n].alias(n) for n in names])


def with_domain(df: DataFrame, name: str, values, kind: str = "string") -> DataFrame:
    """Repeat each row once per value of a small fixed domain (dense grids)."""
    domain = F.array(*[F.lit(v).cast(kind) for v in values])
    return df.select("*", F.explode(domain).alias(name))
