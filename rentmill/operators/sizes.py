"""What the planner knows about sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate, read from the plan without running anything."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_bytes(df: DataFrame) -> int:
    """The size up to which the planner broadcasts a side of a join; negative when it never does."""
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
