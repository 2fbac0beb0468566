"""Keyed maintenance of tables on Spark: find, preview, delete, clean, merge and version rows."""

from tablekeeper.operators.delete import DeletePlan
from tablekeeper.operators.merge import Merge, upsert
from tablekeeper.session import build_session, sized_settings
from tablekeeper.sources.snapshots import SnapshotTable

__all__ = ["DeletePlan", "Merge", "SnapshotTable", "build_session", "sized_settings", "upsert"]
