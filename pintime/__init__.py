"""pintime: a PySpark engine for time-aware feature data.

Weekly features per key are built from raw tables, declared as typed feature
views grouped into services, joined point-in-time correct into training sets,
published newest-value-per-key to a snapshot table, scored with MLlib, and
checked for drift between time windows. Everything is DataFrame / Spark SQL.
"""

from pintime.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
