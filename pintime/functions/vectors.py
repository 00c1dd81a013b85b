"""Feature vectors for interchange (FN-9) and for MLlib."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def feature_array(cols: Sequence[str], dtype: str = "float") -> Column:
    """Columns in contract order as one ``array<float>`` (FP32 tensor)."""
    return F.array(*[F.col(c).cast(dtype) for c in cols])
