"""Row predicates with the null rules of table maintenance.

*Delete where P* keeps a row whose P is unknown; *keep where Q* drops it. Both
directions go through :func:`is_true`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_hash(frame: DataFrame) -> Column:
    """Hash over all columns that can be hashed (maps cannot)."""
    return F.xxhash64(*[col(name) for name, kind in frame.dtypes if not kind.startswith(("map", "variant"))])


def is_true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    result = None
    for condition in conditions:
        result = condition if result is None else result & condition
    return F.lit(True) if result is None else result


def any_of(conditions: Iterable[Column]) -> Column:
    result = None
    for condition in conditions:
        result = condition if result is None else result | condition
    return F.lit(False) if result is None else result


def text_match(column: str, term: str, *, regex: bool = False, ignore_case: bool = True) -> Column:
    """Substring test by default; a regular expression on request. Null text is no match."""
    text = col(column)
    if regex:
        return is_true(text.rlike(("(?i)" if ignore_case else "") + term))
    if ignore_case:
        return is_true(F.contains(F.lower(text), F.lower(F.lit(term))))
    return is_true(F.contains(text, F.lit(term)))


def strip_space(text: Column) -> Column:
    """Strip every kind of white space from both ends (`trim` strips spaces only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def metadata_flag(metadata: Column, key: str = "delete", value: str = "1") -> Column:
    """Does a string map hold `key` (any case) with `value` (white space ignored)?"""
    return is_true(
        F.exists(
            F.map_entries(metadata),
            lambda e: (F.lower(e["key"]) == key.lower()) & (strip_space(e["value"]) == value),
        )
    )


QUALITY_RULES = {
    "is_null": lambda c: c.isNull(),
    "negative": lambda c: c < 0,
    "unknown": lambda c: c == "unknown",
}


def quality_rule(column: str, rule: str, sentinel: str | None = None) -> Column:
    """One named data-quality test. A rule that is not known is an error."""
    if rule not in QUALITY_RULES:
        raise ValueError(f"unknown quality rule {rule!r}; known: {sorted(QUALITY_RULES)}")
    if rule == "unknown" and sentinel is not None:
        return is_true(col(column) == sentinel)
    return is_true(QUALITY_RULES[rule](col(column)))


def violations(constraints: Mapping[str, str]) -> Column:
    """Array with the names of the SQL row constraints a row breaks (unknown passes, as in CHECK)."""
    failed = [
        F.when(~F.coalesce(F.expr(rule), F.lit(True)), F.lit(name)) for name, rule in constraints.items()
    ]
    return F.array_compact(F.array(*failed))
