"""Parquet, CSV, JSON and catalog-table sources and sinks, and temporary views."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablekeeper.functions.predicates import col


def read_parquet(spark: SparkSession, paths: str | Sequence[str], view: str | None = None, **options) -> DataFrame:
    """Read one or many paths or globs, with reader options such as `mergeSchema`; name the result if asked."""
    frame = spark.read.options(**options).parquet(*([paths] if isinstance(paths, str) else paths))
    if view:
        frame.createOrReplaceTempView(view)
    return frame


def query_view(spark: SparkSession, view: str, query: str | None = None) -> DataFrame:
    """The view itself, or a query in which it is used by name."""
    return spark.sql(query) if query else spark.table(view)


def list_views(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if t.isTemporary)


def drop_view(spark: SparkSession, view: str) -> bool:
    """True if there was such a view."""
    return spark.catalog.dropTempView(view)


def view_schema(spark: SparkSession, view: str) -> T.StructType:
    return spark.table(view).schema


def file_facts(spark: SparkSession, path: str) -> dict:
    """Schema, row count and number of files; the rows are counted from footers."""
    frame = spark.read.parquet(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet"
    ).load(path)
    return {"schema": frame.schema, "rows": frame.count(), "files": files.select("path").count()}


def distinct_sorted(frame: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column in order, nulls dropped."""
    return frame.select(col(column)).dropna().distinct().orderBy(col(column))


def write_parquet(frame: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write parquet. Rows are brought together per partition value, split where one value is large."""
    if partition_by:
        frame = frame.hint("rebalance", *partition_by)
    frame.write.mode(mode).partitionBy(*partition_by).parquet(path)


def save_table(frame: DataFrame, name: str, mode: str = "overwrite") -> None:
    frame.write.mode(mode).saveAsTable(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True, **options) -> DataFrame:
    """CSV with a stated schema: no inference pass; partitions take the place of chunks."""
    return spark.read.schema(schema).options(header=header, **options).csv(path)


def parse_json(text: Column, schema: T.StructType | str) -> Column:
    return F.from_json(text, schema)


def flatten(frame: DataFrame, separator: str = "_") -> DataFrame:
    """Nested structs as flat columns named by their path; arrays and maps are kept as they are."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        result = []
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                result += leaves(field.dataType, here)
            else:
                name = re.sub(r"\.", separator, separator.join(here))
                result.append(F.col(".".join(f"`{p}`" for p in here)).alias(name))
        return result

    return frame.select(*leaves(frame.schema, ()))


def union_all_by_name(frames: Sequence[DataFrame], constants: Sequence[Mapping[str, object]] | None = None) -> DataFrame:
    """Union by name with missing columns null; each frame may get constant columns first.

    The same column must have one type throughout: silently widening ids is how rows break later.
    """
    if not frames:
        raise ValueError("nothing to union")
    tagged = [
        frame.withColumns({k: F.lit(v) for k, v in values.items()}) if values else frame
        for frame, values in zip(frames, constants or [{}] * len(frames))
    ]
    kinds: dict[str, T.DataType] = {}
    for frame in tagged:
        for field in frame.schema.fields:
            known = kinds.setdefault(field.name, field.dataType)
            if known != field.dataType:
                raise TypeError(
                    f"column {field.name} is {known.simpleString()} and {field.dataType.simpleString()}"
                )
    result = tagged[0]
    for frame in tagged[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def literal_rows(spark: SparkSession, schema: str, rows: Sequence[Sequence]) -> DataFrame:
    """A small table from literal rows. Spark knows its exact size, so joins can broadcast it unasked."""
    fields = T.StructType.fromDDL(schema)
    kinds = to_arrow_schema(fields)
    columns = [pa.array([row[i] for row in rows], kind.type) for i, kind in enumerate(kinds)]
    return spark.createDataFrame(pa.table(columns, schema=kinds), schema=fields)


def id_range(spark: SparkSession, start: int, stop: int, name: str = "id") -> DataFrame:
    return spark.range(start, stop).select(F.col("id").alias(name))
