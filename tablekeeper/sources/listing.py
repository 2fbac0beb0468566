"""File listings as tables, made by listing folders in parallel; no file is opened."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeeper.functions.paths import ISO_FORMAT, base_name, split_container, time_text, to_gb, to_mb
from tablekeeper.functions.predicates import col, metadata_flag
from tablekeeper.session import checkpoint_dir
from tablekeeper.sources.files import literal_rows

# The columns of a listing export.
EXPORT_COLUMNS = (
    "container",
    "name",
    "size",
    "size_mb",
    "last_modified",
    "content_type",
    "blob_type",
    "creation_time",
    "etag",
)


FOUND = "path string, folder boolean, size bigint, modified timestamp"


def list_files(
    spark: SparkSession,
    root: str,
    prefix: str = "",
    glob: str | None = None,
    connect: Callable[[], fs.FileSystem] | None = None,
) -> DataFrame:
    """Files below `root`: container (first folder), name below it, size, size_mb, last_modified.

    Folders are listed level by level, in parallel tasks, and each level is kept in the
    checkpoint folder; empty files are included, which Spark's own file readers pass over.
    `connect` opens the file system inside a task when the URI alone does not say enough.
    A prefix narrows names within the containers, a glob (`*` and `?`) the base names. Attributes
    only an object store knows (content type, tags, metadata) are null columns, to be joined in
    where available.
    """
    if connect is None:
        base = fs.FileSystem.from_uri(root)[1]
        connect = partial(_file_system, root)
    else:
        base = root
    base = base.rstrip("/")
    checkpoint_dir(spark)
    # A stated number of parts is kept as it is; paths alone are small enough to be merged into one task.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level, files = literal_rows(spark, "path string", [(base,)]), None
    while level is not None:
        found = level.repartition(parts, "path").mapInArrow(partial(_list_folders, connect), FOUND).checkpoint()
        here = found.filter("NOT folder")
        files = here if files is None else files.unionAll(here)
        level = found.filter("folder").select("path")
        if level.isEmpty():
            level = None
    container, name = split_container(F.substring(F.col("path"), len(base) + 2, 1 << 30))
    listed = files.select(
        container.alias("container"),
        name.alias("name"),
        F.col("size"),
        to_mb(F.col("size")).alias("size_mb"),
        F.col("modified").alias("last_modified"),
        F.lit(None).cast("string").alias("content_type"),
        F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("string").alias("blob_type"),
        F.lit(None).cast("timestamp").alias("creation_time"),
        F.lit(None).cast("map<string,string>").alias("metadata"),
    )
    if glob:
        pattern = re.escape(glob).replace(r"\*", ".*").replace(r"\?", ".")
        listed = listed.filter(base_name(F.col("name")).rlike(f"^{pattern}$"))
    return with_prefix(listed, prefix)


def _file_system(root: str) -> fs.FileSystem:
    return fs.FileSystem.from_uri(root)[0]


def _list_folders(connect: Callable[[], fs.FileSystem], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries directly inside each folder path."""
    system = None
    for batch in batches:
        for path in batch.column("path").to_pylist():
            system = system or connect()
            entries = system.get_file_info(fs.FileSelector(path))
            for start in range(0, len(entries), 10_000):
                part = entries[start : start + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([e.path for e in part], pa.string()),
                        pa.array([e.type == fs.FileType.Directory for e in part], pa.bool_()),
                        pa.array([e.size for e in part], pa.int64()),
                        pa.array([e.mtime for e in part], pa.timestamp("us", "UTC")),
                    ],
                    names=["path", "folder", "size", "modified"],
                )


def with_prefix(listing: DataFrame, prefix: str) -> DataFrame:
    return listing.filter(F.col("name").startswith(prefix)) if prefix else listing


def containers(listing: DataFrame) -> DataFrame:
    return listing.select("container").distinct()


def allow_containers(listing: DataFrame, allowed: DataFrame, column: str = "container") -> tuple[DataFrame, DataFrame]:
    """(files of allowed containers, allowed containers that do not exist)."""
    wanted = allowed.select(col(column).alias("container")).dropna().distinct()
    return listing.join(wanted, "container", "left_semi"), missing_names(wanted, containers(listing), "container")


def missing_names(wanted: DataFrame, present: DataFrame, column: str) -> DataFrame:
    """Set difference: names asked for that are not present."""
    names = wanted.select(col(column)).distinct()
    return names.join(present.select(col(column)).distinct(), column, "left_anti")


def inventory_summary(listing: DataFrame) -> DataFrame:
    """Files and size per container. Bytes are summed first; the per-file rounding is reported beside it."""
    counts = listing.groupBy("container").agg(
        F.count("*").alias("files"), F.sum("size").alias("bytes"), F.sum(to_mb(F.col("size"))).alias("rounded_mb")
    )
    return counts.withColumns({"mb": to_mb(F.col("bytes")), "gb": to_gb(F.col("bytes"))})


def export_csv(listing: DataFrame, path: str) -> None:
    """Write the nine export columns with ISO times; missing values are empty text."""
    kinds = dict(listing.dtypes)
    columns = []
    for name in EXPORT_COLUMNS:
        value = col(name)
        if kinds[name].startswith("timestamp"):
            value = time_text(value, ISO_FORMAT, "")
        columns.append(value.alias(name))
    listing.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def flagged_for_deletion(listing: DataFrame, metadata: str = "metadata") -> DataFrame:
    return listing.filter(metadata_flag(col(metadata)))


def write_matches(listing: DataFrame, path: str) -> None:
    """One `container/name<TAB>time` line per file."""
    line = F.concat_ws(
        "\t", F.concat_ws("/", "container", "name"), time_text(F.col("last_modified"))
    )
    listing.select(line.alias("value")).write.mode("overwrite").text(path)


def read_matches(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Read `container/path` lines, with or without a tab and time, into container and name."""
    lines = spark.read.text(path).select(F.substring_index("value", "\t", 1).alias("line")).filter("line <> ''")
    container, name = split_container(F.col("line"))
    return lines.select(container.alias("container"), name.alias("name"))


def name_search_counts(frame: DataFrame, column: str, condition) -> DataFrame:
    """Entries per name among the rows that satisfy a text condition."""
    return frame.filter(condition).groupBy(col(column)).agg(F.count("*").alias("entries"))
