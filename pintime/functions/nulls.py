"""Null handling with pandas semantics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_in_keep_nulls(c: Column | str, values: Sequence) -> Column:
    """``~s.isin(values)``: unlike SQL ``NOT IN`` a null value is kept."""
    col = F.col(c) if isinstance(c, str) else c
    return ~F.coalesce(col.isin(list(values)), F.lit(False))


def fill_zero_all(df: DataFrame) -> DataFrame:
    """``fillna(0)`` on every column: numbers get 0, text gets ``'0'``.

    ``na.fill(0)`` alone only reaches numeric columns.
    """
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = df.na.fill(0)
    if strings:
        out = out.na.fill("0", subset=strings)
    return out


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``dropna()``: drops rows holding a null (or a NaN) in any column."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def as_nullable_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``astype('Int64', errors='ignore')`` per column: a column whose non-null
    values are all whole numbers becomes ``bigint`` (nulls stay null); a column
    holding any fractional value is left as it is (a plain cast would truncate
    1.7 to 1). The check is one global aggregate returning one row."""
    cols = list(cols)
    if not cols:
        return df
    checks = df.agg(*[F.coalesce(F.bool_and(F.col(c) == F.floor(F.col(c))), F.lit(True))
                      .alias(c) for c in cols]).first()
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in cols and checks[c] else F.col(c)
                       for c in df.columns])
