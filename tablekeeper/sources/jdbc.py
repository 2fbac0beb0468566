"""Database tables: partitioned reads, and deletes driven by a key DataFrame.

Deletes run where the keys are. Each task binds its keys as parameters in chunks and
commits per chunk; a delete by key may be repeated, so a retried task does no harm.
The number of rows is taken from a preview, not from tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeeper.functions.predicates import col

# Keys per statement, for one and for several key columns.
CHUNK_ONE_COLUMN = 1_000
CHUNK_COLUMNS = 500


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    partitions: int = 16,
    **options: str,
) -> DataFrame:
    """Read a table; with a partition column the reads are split evenly between its minimum and maximum."""
    reader = spark.read.format("jdbc").options(url=url, **options)
    if partition_column is None:
        return reader.option("dbtable", table).load()
    bounds = reader.option(
        "query", f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}"
    ).load().select(F.col("lo").cast("string"), F.col("hi").cast("string")).first()
    whole = spark.read.format("jdbc").options(url=url, **options).option("dbtable", table)
    if bounds[0] is None:
        return whole.load()
    return whole.options(
        partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
    ).load()


def statement(table: str, columns: Sequence[str], rows: int, mark: str = "?", scope: str | None = None) -> str:
    """DELETE text with parameter marks for `rows` keys; values are always bound, never pasted."""
    if len(columns) == 1:
        where = f"{columns[0]} IN ({', '.join([mark] * rows)})"
    else:
        one = "(" + " AND ".join(f"{c} = {mark}" for c in columns) + ")"
        where = " OR ".join([one] * rows)
    return f"DELETE FROM {table} WHERE {where}" if scope is None else f"DELETE FROM {table} WHERE ({where}) AND ({scope})"


def delete_keys(
    keys: DataFrame,
    connect: Callable[[], object],
    table: str,
    columns: Sequence[str],
    *,
    connections: int = 8,
    chunk: int | None = None,
    mark: str = "?",
    scope: str | None = None,
) -> None:
    """Delete the rows whose key columns are in `keys`, over at most `connections` connections at a time.

    `connect` opens a DB-API connection inside the task. `scope` is a fixed extra SQL condition.
    """
    size = chunk or (CHUNK_ONE_COLUMN if len(columns) == 1 else CHUNK_COLUMNS)
    chosen = keys.select(*[col(c) for c in columns]).dropna().distinct().repartition(connections)

    def run(rows: Iterator) -> None:
        connection = None
        try:
            batch: list[tuple] = []
            for row in rows:
                batch.append(tuple(row))
                if len(batch) == size:
                    connection = connection or connect()
                    _delete(connection, batch)
                    batch = []
            if batch:
                connection = connection or connect()
                _delete(connection, batch)
        finally:
            if connection is not None:
                connection.close()

    def _delete(connection, batch: list[tuple]) -> None:
        cursor = connection.cursor()
        try:
            cursor.execute(
                statement(table, columns, len(batch), mark, scope), [value for key in batch for value in key]
            )
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            cursor.close()

    chosen.foreachPartition(run)


def stage_keys(keys: DataFrame, url: str, staging: str, columns: Sequence[str], **options: str) -> None:
    """Write the distinct keys to a staging table, for one set-based DELETE in the database."""
    chosen = keys.select(*[col(c) for c in columns]).dropna().distinct()
    chosen.write.format("jdbc").options(url=url, dbtable=staging, **options).mode("overwrite").save()


def staged_delete_statement(table: str, staging: str, columns: Sequence[str]) -> str:
    """The DELETE to run after :func:`stage_keys`."""
    same = " AND ".join(f"{staging}.{c} = {table}.{c}" for c in columns)
    return f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} WHERE {same})"
