"""Path, size and time formatting columns used by the file catalogue operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def base_name(path: Column) -> Column:
    """Last segment of a `/` or `\\` path; null gives the empty string."""
    forward = F.regexp_replace(path, r"\\", "/")
    return F.coalesce(F.substring_index(forward, "/", -1), F.lit(""))


def url_path(url: Column) -> Column:
    """A URL without its query string and fragment."""
    return F.substring_index(F.substring_index(url, "?", 1), "#", 1)


def split_container(path: Column, prefix: Column | None = None) -> tuple[Column, Column]:
    """`container/prefix` split at the first slash, unless a prefix is given separately."""
    if prefix is not None:
        return path, prefix
    parts = F.split(path, "/", 2)
    return parts.getItem(0), F.when(F.size(parts) > 1, F.get(parts, F.lit(1))).otherwise(F.lit(""))


def to_mb(size: Column) -> Column:
    return F.round(F.coalesce(size, F.lit(0)) / F.lit(1024 * 1024), 2)


def to_gb(size: Column) -> Column:
    return F.round(F.coalesce(size, F.lit(0)) / F.lit(1024 * 1024 * 1024), 2)


def time_text(time: Column, pattern: str = TIME_FORMAT, missing: str = "unknown") -> Column:
    return F.coalesce(F.date_format(time, pattern), F.lit(missing))


def days_before(time: Column, days: Column) -> Column:
    """`time` minus a number of days; the timestamp kind is kept."""
    return time - F.make_dt_interval(days)
