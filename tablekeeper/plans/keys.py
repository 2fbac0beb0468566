"""Key mappings between a target and a criteria table.

A mapping always runs target column -> criteria column. Criteria keys are renamed to
private names before a join, so equal names and shared lineage never clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from tablekeeper.functions.predicates import all_of, col

Keys = str | Sequence[str] | Mapping[str, str]
KEY = "__key"


def _family(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "number"
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "time"
    return kind.typeName()


def key_pairs(on: Keys, target: DataFrame, criteria: DataFrame) -> list[tuple[str, str]]:
    """Check a mapping against both schemas and return it as (target, criteria) pairs."""
    if isinstance(on, str):
        pairs = [(on, on)]
    elif isinstance(on, Mapping):
        pairs = list(on.items())
    else:
        pairs = [(name, name) for name in on]
    if not pairs:
        raise ValueError("at least one key column is required")
    for left, right in pairs:
        for name, frame, side in ((left, target, "target"), (right, criteria, "criteria")):
            if name not in frame.columns:
                raise ValueError(f"{side} has no column {name!r}; it has {frame.columns}")
        kinds = target.schema[left].dataType, criteria.schema[right].dataType
        if not isinstance(kinds[1], T.NullType) and _family(kinds[0]) != _family(kinds[1]):
            raise TypeError(
                f"key types differ: target {left} is {kinds[0].simpleString()}, "
                f"criteria {right} is {kinds[1].simpleString()}"
            )
    return pairs


def rename_keys(pairs: list[tuple[str, str]], criteria: DataFrame) -> list[Column]:
    return [col(name).alias(f"{KEY}{i}") for i, (_, name) in enumerate(pairs)]


def distinct_keys(criteria: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Criteria keys once each, nulls dropped (a null key never matches).

    The distinct is combined map-side, so a key that fills a third of the criteria
    travels once per task, and its exchange is the one the join needs anyway.
    """
    return criteria.select(*rename_keys(pairs, criteria)).dropna().distinct()


def keys_match(pairs: list[tuple[str, str]]) -> Column:
    return all_of(col(name) == col(f"{KEY}{i}") for i, (name, _) in enumerate(pairs))


def without_clash(target: DataFrame, names: Iterable[str]) -> None:
    clash = sorted(set(target.columns) & set(names))
    if clash:
        raise ValueError(f"result would hold two columns named {clash}; rename one side first")
