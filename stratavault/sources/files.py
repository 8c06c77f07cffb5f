"""File lifecycle: listing, change classification, missing files, old versions, status log, run summary."""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavault.functions.parsing import file_name_parts, is_workbook_name, table_name
from stratavault.operators.relational import nth_per_key

# Status codes of the file log, and the change classes with their codes.
FILE_LOADED, READING, STAGED, SANDBOXED, DONE, FAILED, MERGED_CELLS, MANY_SHEETS = STATUS_CODES = (
    "file_load_to_store", "reading_file", "stage_db_load_completed", "sandbox_db_load", "processing_completed",
    "processing_failed", "merged_cells_detected", "more_than_one_list_detected")
CHANGE_CLASSES = {1: "new", 2: "changed", 3: "error", 4: "no_changed"}
LISTING_COLUMNS = ["key", "file_name", "user_name", "guid", "bucket", "table_name", "last_modified", "size"]


def describe(objects: DataFrame) -> DataFrame:
    """The listing columns for objects given as ``bucket, key, last_modified, size``."""
    parts = file_name_parts("key")
    named = objects.select("*", *[c.alias(n) for n, c in parts.items()])
    return named.withColumn("table_name", table_name("file_name")).select(*LISTING_COLUMNS)


def list_objects(spark: SparkSession, root: str, buckets: Sequence[str], pattern: str = "*") -> DataFrame:
    """Listing of the files in the bucket folders below ``root``, with all folders below a bucket in the key; file contents
    are not read."""
    paths = [f"{root.rstrip('/')}/{b}" for b in buckets]
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
             .load(paths).select("path", "modificationTime", "length"))
    bucket, key = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in buckets:
        folder = re.sub(r"^[a-zA-Z0-9+.-]+:/*", "/", f"{root.rstrip('/')}/{name}/")
        at = F.locate(folder, F.col("path"))
        bucket = F.when(at > 0, name).otherwise(bucket)
        key = F.when(at > 0, F.substr("path", at + len(folder))).otherwise(key)
    return describe(found.select(bucket.alias("bucket"), key.alias("key"),
                                 F.col("modificationTime").cast("timestamp_ntz").alias("last_modified"),
                                 F.col("length").alias("size")))


def read_object(spark: SparkSession, path: str) -> DataFrame:
    """One object with its bytes; a missing object is an error."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "content")


FILE_KEY = ["bucket", "file_name"]


def current_metadata(metadata: DataFrame) -> DataFrame:
    """The newest stored version of every file."""
    return nth_per_key(metadata, FILE_KEY, [F.desc("last_modified"), F.desc("key")])


def classify_changes(listing: DataFrame, metadata: DataFrame) -> DataFrame:
    """The listing with ``change_code`` 1 to 4 and its name: new, changed, error (no workbook), no_changed."""
    stored = current_metadata(metadata).select(
        *FILE_KEY, *[F.col(c).alias(f"_{c}") for c in ("last_modified", "size", "guid")], F.lit(True).alias("_known"))
    joined = listing.join(stored, FILE_KEY, "left")
    same = reduce_and([F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("last_modified", "size", "guid")])
    code = (F.when(~is_workbook_name("file_name"), 3).when(F.col("_known").isNull(), 1).when(~same, 2).otherwise(4))
    status = F.element_at(F.create_map(*[F.lit(x) for pair in CHANGE_CLASSES.items() for x in pair]), F.col("change_code"))
    return joined.select(*LISTING_COLUMNS, code.alias("change_code")).withColumn("status", status)


def reduce_and(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for c in conditions[1:]:
        result = result & c
    return result


def missing_files(listing: DataFrame, metadata: DataFrame) -> DataFrame:
    """Stored files that are no longer listed, newest version each."""
    return current_metadata(metadata).join(listing.select(*FILE_KEY).distinct(), FILE_KEY, "left_anti")


def nth_latest(metadata: DataFrame, n: int = 2) -> DataFrame:
    """The n-th newest stored version of every file that has so many."""
    return nth_per_key(metadata, FILE_KEY, [F.desc("last_modified"), F.desc("key")], n)


def without_keys(metadata: DataFrame, removed: DataFrame) -> DataFrame:
    """The metadata after deleting the given object keys."""
    return metadata.join(removed.select("bucket", "key").distinct(), ["bucket", "key"], "left_anti")


def without_keys_and_times(metadata: DataFrame, removed: DataFrame) -> DataFrame:
    """The metadata after deleting the given versions; a key may be rewritten in place, so its time tells versions apart."""
    version = ["bucket", "key", "last_modified"]
    return metadata.join(removed.select(*version).distinct(), version, "left_anti")


def latest_status(log: DataFrame) -> DataFrame:
    """Current status of every file; ``log`` has ``bucket, file_name, status, logged_at, entry``."""
    return nth_per_key(log, FILE_KEY, [F.desc("logged_at"), F.desc("entry")])


def status_entries(files: DataFrame, status: str, logged_at: Column | None = None) -> DataFrame:
    """Log rows to append for the given files."""
    if status not in STATUS_CODES:
        raise ValueError(f"unknown status {status!r}")
    moment = F.localtimestamp() if logged_at is None else logged_at
    return files.select(*FILE_KEY, F.lit(status).alias("status"), moment.alias("logged_at"))


def run_summary(results: DataFrame) -> DataFrame:
    """Totals of a load run from per-file results (status, file_status, rows_loaded,
    processing_time_seconds, file_size_bytes), in one pass."""
    ok = F.col("status") == "success"

    def total(value: str, condition: Column | None = None) -> Column:
        c = F.col(value) if condition is None else F.when(condition, F.col(value))
        return F.coalesce(F.sum(c), F.lit(0))

    return results.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("successful"),
        F.count_if(F.col("status") == "error").alias("failed"), F.count_if(F.col("status") == "deleted").alias("deleted"),
        F.count_if(ok & (F.col("file_status") == "new")).alias("new_files"),
        F.count_if(ok & (F.col("file_status") == "changed")).alias("changed_files"),
        F.count_if(F.col("file_status") == "missing").alias("missing_files"),
        total("rows_loaded", ok).cast("bigint").alias("total_rows_loaded"),
        F.round(total("processing_time_seconds"), 2).cast("double").alias("total_processing_time_seconds"),
        total("file_size_bytes").cast("bigint").alias("total_size_bytes"))
