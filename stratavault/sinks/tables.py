"""Table sinks and lifecycle: rebuild, append, upsert, history append, views, layer names."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratavault.operators.vault import upsert_by_key
from stratavault.session import materialise

# Schema of each model folder.
LAYER_SCHEMAS = {"rdv": "main_rdv", "bdv": "main_bdv", "mart": "main_mart", "report": "main_report"}
PREFIXED_VIEWS = ("mart/dims", "report", "bdv/satellites")


def layer_table(layer: str, name: str, kind: str = "table", part: str = "", default_schema: str = "stage") -> str:
    """Full name of a model: the schema follows the layer; views of some layers get the prefix ``v_``."""
    place = f"{layer}/{part}" if part else layer
    prefixed = kind == "view" and any(place == p or place.startswith(p + "/") for p in PREFIXED_VIEWS)
    return f"{LAYER_SCHEMAS.get(layer, default_schema)}.{'v_' if prefixed else ''}{name}"


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_view(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {name}")


def truncate(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def create_landing(spark: SparkSession, name: str, columns: Sequence[str]) -> None:
    """An all-text table with these columns, unless it exists; headerless spreadsheet columns are left out."""
    kept = [c for c in columns if not c.startswith("Unnamed:")]
    listed = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in kept)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({listed}) USING parquet")


def _writer(df: DataFrame, mode: str, max_records_per_file: int | None = None, partition_by: Sequence[str] = ()):
    writer = df.write.mode(mode).format("parquet")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    return writer.partitionBy(*partition_by) if partition_by else writer


def rebuild(df: DataFrame, name: str, max_records_per_file: int | None = None) -> None:
    """Replace the table. The new content is complete before the old table goes, so it may read from it. A partitioned
    table keeps its partitioning, and its name throughout; its columns must stay the same."""
    spark = df.sparkSession
    if not exists(spark, name):
        _writer(df, "errorifexists", max_records_per_file).saveAsTable(name)
        return
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        ready = materialise(df, name.replace(".", "_"))
        ready.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
        return
    fresh = f"{name}__next"
    drop_table(spark, fresh)
    _writer(df, "errorifexists", max_records_per_file).saveAsTable(fresh)
    drop_table(spark, name)
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def append(df: DataFrame, name: str, max_records_per_file: int | None = None) -> int:
    """Add rows by column name; returns how many were written, counted during the write."""
    spark = df.sparkSession
    ordered = df.select(*[F.col(f"`{c}`") for c in spark.table(name).columns]) if exists(spark, name) else df
    counter = Observation("written")
    observed = ordered.observe(counter, F.count(F.lit(1)).alias("rows"))
    _writer(observed, "append", max_records_per_file).saveAsTable(name)
    return counter.get["rows"]


def upsert(df: DataFrame, name: str, keys: Sequence[str], order_by: Sequence[Column]) -> None:
    """Load into a keyed table: one row per key stays, the first in the given order."""
    spark = df.sparkSession
    current = spark.table(name) if exists(spark, name) else df.limit(0)
    rebuild(upsert_by_key(current, df, keys, order_by), name)


_writers = {"lock": Lock(), "count": 0, "before": None}


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """The session overwrites single partitions while any writer, of whatever thread, is in here."""
    mode = "spark.sql.sources.partitionOverwriteMode"
    with _writers["lock"]:
        if not _writers["count"]:
            _writers["before"] = spark.conf.get(mode)
            spark.conf.set(mode, "dynamic")
        _writers["count"] += 1
    try:
        yield
    finally:
        with _writers["lock"]:
            _writers["count"] -= 1
            if not _writers["count"]:
                spark.conf.set(mode, _writers["before"])


def replace_partitions(df: DataFrame, name: str) -> None:
    """Write ``df`` over the partitions of the table that it has rows for; the others stay."""
    spark = df.sparkSession
    with _dynamic_overwrite(spark):
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)


def append_history(df: DataFrame, name: str, full_refresh: bool = False, load_ts: str | None = None) -> None:
    """Add one load to a satellite, stored by load date, or start it anew. A load that comes again replaces its own rows; with
    ``load_ts`` also if it comes without any.

    A refresh computes the new content before it drops the old (partitioned tables are not renamed).
    """
    spark = df.sparkSession
    if not exists(spark, name):
        _writer(df, "errorifexists", partition_by=["load_date"]).saveAsTable(name)
    elif full_refresh:
        ready = materialise(df, name.replace(".", "_"))
        drop_table(spark, name)
        _writer(ready, "errorifexists", partition_by=["load_date"]).saveAsTable(name)
    else:
        replace_partitions(df, name)
        if load_ts and spark.table(name).where(F.col("load_date") == F.lit(load_ts).cast("timestamp_ntz")).limit(1).count() and df.isEmpty():
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (load_date = TIMESTAMP_NTZ'{load_ts}')")


def companion_view(spark: SparkSession, name: str) -> str:
    """View ``v_<table>`` over a typed table; returns its name."""
    schema, _, table = name.rpartition(".")
    view = f"{schema}.v_{table}" if schema else f"v_{table}"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {name}")
    return view
