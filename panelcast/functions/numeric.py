"""Numeric and null-handling helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.DoubleType, T.FloatType, T.DecimalType, T.IntegerType, T.LongType,
                 T.ShortType, T.ByteType)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c) -> Column:
    """half-even rounding of the scaled double, as numpy does.

    ``rint(x*100)/100`` (0.575 -> 0.57) rather than ``round``/``bround``,
    which round the decimal value (0.575 -> 0.58).
    """
    return F.rint(_col(c).cast("double") * 100) / 100


def pct_error(pred, actual) -> Column:
    """signed whole-percent error ``rint(((p - a) / a) * 100)``.

    A zero actual gives NULL instead of +-inf (ANSI division would raise).
    A result of zero is always +0.0: ``rint`` of a small negative ratio gives
    -0.0, which grouping and distinct would fold into +0.0 anyway.
    """
    e = F.rint(F.try_divide(_col(pred) - _col(actual), _col(actual)) * 100)
    return F.when(e == 0, F.lit(0.0)).otherwise(e)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in skip]


def round_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """F5 on every numeric column (pandas ``DataFrame.round(2)``)."""
    cols = numeric_columns(df, exclude)
    return df.withColumns({c: round2(c) for c in cols}) if cols else df


def fill_zero(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """NULL -> 0 on numeric columns (or the given subset)."""
    cols = list(subset) if subset is not None else numeric_columns(df)
    return df.fillna(0, subset=cols) if cols else df


def zero_to_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Undo a zero fill, ``nullif(x, 0)``."""
    return df.withColumns({c: F.when(F.col(c) != 0, F.col(c)) for c in cols})


def complete_cases(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Drop a row if any (listed) column is NULL."""
    return df.dropna(how="any", subset=list(subset) if subset is not None else None)


def to_double(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Cast decimal / float measures to DOUBLE at the edge of a query."""
    skip = set(exclude)
    casts = {f.name: F.col(f.name).cast("double") for f in df.schema.fields
             if isinstance(f.dataType, (T.DecimalType, T.FloatType)) and f.name not in skip}
    return df.withColumns(casts) if casts else df
