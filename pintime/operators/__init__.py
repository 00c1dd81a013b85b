"""Operators the reference needs beyond single built-in calls."""

from pintime.operators.asof import AsofSide, asof_join

__all__ = ["AsofSide", "asof_join"]
