"""Temporal train/test split (ML-1)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def temporal_split(df: DataFrame, test_span: timedelta, timestamp_col: str,
                   drop: Sequence[str] = ("state",)) -> tuple[DataFrame, DataFrame]:
    """The rows of the last ``test_span`` are test, all before them training.

    A row exactly ``test_span`` before the newest one trains. The timestamp and key
    columns are dropped (the key name is a parameter, Q9). The newest time is a
    scalar subquery (JN-4): one aggregate, compared with every row."""
    if test_span <= timedelta(0):
        raise ValueError(f"test_span must be positive, not {test_span}")
    newest = df.agg(F.max(timestamp_col)).scalar()
    is_train = F.col(timestamp_col) <= newest - F.lit(test_span)
    return tuple(df.where(side).drop(timestamp_col, *drop) for side in (is_train, ~is_train))
