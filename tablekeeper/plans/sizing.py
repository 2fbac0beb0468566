"""Checked broadcasting: a side is shipped whole only after its rows and bytes were bounded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows and bytes a broadcast side may hold, and rows every target row may be compared with.
BROADCAST_ROWS = 10_000
BROADCAST_BYTES = 32 << 20
COMPARE_ROWS = 1_000


def small_enough(frame: DataFrame, rows: int, size: int = BROADCAST_BYTES) -> bool:
    """True if the frame holds at most `rows` rows and, as text, `size` bytes. The check stops after `rows + 1` rows."""
    width = F.octet_length(F.struct("*").cast("string")) if frame.columns else F.lit(0)
    found = frame.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return found[0] <= rows and found[1] <= size


def broadcast_if_small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast behind a size check; a larger frame is left to the optimizer."""
    return F.broadcast(frame) if small_enough(frame, rows) else frame


def plan_text(frame: DataFrame) -> str:
    """The physical plan as Spark would print it."""
    return frame._jdf.queryExecution().executedPlan().toString()


def compares_all_pairs(frame: DataFrame) -> bool:
    plan = plan_text(frame)
    return "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan


def broadcasts(joined: DataFrame) -> bool:
    """Does the optimizer broadcast a side of this join, so that the other one is not shuffled?"""
    return "BroadcastHashJoin" in plan_text(joined)


def prefilter(frame: DataFrame, keys: DataFrame, match: Column) -> DataFrame:
    """Drop rows whose key is not asked for, if that needs no shuffle of the frame.

    Used ahead of a grouping: where the optimizer would broadcast `keys`, most rows go
    before they move. Otherwise the frame is returned whole and the grouping, which is
    combined map-side, comes first, so that a hot key shrinks before it is joined.
    """
    narrowed = frame.join(keys, match, "left_semi")
    return narrowed if broadcasts(narrowed) else frame
