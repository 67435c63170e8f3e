"""Small expression helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def col_of(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def true_only(condition: Column) -> Column:
    """A flag: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def finite(value: Column | str) -> Column:
    """NaN and both infinities become NULL, so that later comparisons see one "missing"."""
    value = col_of(value)
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def clean_numeric(df: DataFrame) -> DataFrame:
    """Apply :func:`finite` to every floating-point column."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    known = "CASE WHEN NOT isnan(`{0}`) AND abs(`{0}`) <> double('Infinity') THEN `{0}` END"
    return df.withColumns({name: F.expr(known.format(name)) for name in floating}) if floating else df


def number(text: Column | str) -> Column:
    """Text to double; anything unparsable is NULL."""
    return finite(col_of(text).try_cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division where a zero denominator gives NULL instead of an ANSI error."""
    return numerator / F.nullif(denominator, F.lit(0.0))
