"""Deletes in a partitioned parquet folder that rewrite only the partitions they touch.

The victims are found once, from the whole table, and written down as (file, row). The touched partitions are then staged
without them, counted, and put back with dynamic partition overwrite. Nothing changes before the count is right, and a plan that
looks at the whole table, such as a percentile, is never asked about a part of it. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeeper.functions.predicates import all_of, col
from tablekeeper.operators.delete import DeletePlan
from tablekeeper.session import drop_path, scratch_path

FILE, ROW = "__file", "__row"


def delete_in_place(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    describe: Callable[[DataFrame], DeletePlan],
    dry_run: bool = True,
) -> dict:
    """Run the delete that `describe(table)` returns; the default only reports what it would touch.

    Returns the rows deleted, the partitions touched, and those that end up empty and go.
    """
    schema = spark.read.parquet(path).schema
    table = spark.read.schema(schema).parquet(path)
    placed = table.withColumns({FILE: F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index")})
    groups = [col(c) for c in partition_by]
    noted = scratch_path(spark, "victims")
    describe(placed).preview().select(*groups, FILE, ROW).distinct().write.parquet(noted)
    victims = spark.read.parquet(noted)
    touched = victims.groupBy(*[col(c).alias(f"__p{i}") for i, c in enumerate(partition_by)]).agg(F.count("*").alias("__n"))
    deleted, count = touched.agg(F.coalesce(F.sum("__n"), F.lit(0)), F.count("*")).first()
    report = {"rows_deleted": deleted, "partitions": count, "emptied": 0}
    if dry_run or not count:
        drop_path(spark, noted)
        return report
    same = all_of(col(c).eqNullSafe(F.col(f"__p{i}")) for i, c in enumerate(partition_by))
    part = placed.join(touched.drop("__n"), same, "left_semi")
    before = part.count()
    staged = scratch_path(spark, "rewrite")
    left = part.join(victims.select(FILE, ROW), [FILE, ROW], "left_anti").select(*[col(c) for c in schema.names])
    left.hint("rebalance", *groups).write.partitionBy(*partition_by).parquet(staged)
    kept = spark.read.schema(schema).parquet(staged)
    after = kept.count()
    if after != before - deleted:
        raise ValueError(f"{after} rows were staged in {staged} where {before - deleted} were expected; {path} was not changed")
    folder = F.regexp_replace(FILE, "/[^/]*$", "").alias("folder")
    held = kept.select(*[col(c).alias(f"__p{i}") for i, c in enumerate(partition_by)]).distinct()
    still = all_of(col(c).eqNullSafe(F.col(f"__p{i}")) for i, c in enumerate(partition_by))
    emptied = 0
    # Folder names of partitions that are left empty, one after another.
    for row in victims.join(held, still, "left_anti").select(folder).distinct().toLocalIterator():
        drop_path(spark, spark._jvm.java.net.URI.create(row.folder))
        emptied += 1
    if after:
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    drop_path(spark, staged)
    drop_path(spark, noted)
    return {**report, "emptied": emptied}
