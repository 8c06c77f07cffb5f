"""Bulk load of delimited files into a table: all rows that can be read, or none if too many cannot."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratavault.session import scratch_path
from stratavault.sinks import tables as sinks

LABEL = "load_label"
_LINE, _BAD = "_line", "_bad"


@dataclass(frozen=True)
class BulkLoad:
    """Outcome of a load."""

    label: str
    total: int
    loaded: int
    filtered: int

    @property
    def ratio(self) -> float:
        return self.filtered / self.total if self.total else 0.0


class LoadRefused(ValueError):
    """Too many lines could not be read; nothing was loaded."""

    def __init__(self, load: BulkLoad, allowed: float):
        super().__init__(f"{load.filtered} of {load.total} lines filtered, a share of {load.ratio:.4f}; allowed are {allowed}")
        self.load = load


def scan(spark: SparkSession, path: str, schema: str, separator: str = "|", required: tuple[str, ...] = (), **options: str) -> DataFrame:
    """Delimited lines by the declared schema, with the raw line of those that do not fit it (``_line``, otherwise null).

    A line fits if it has as many fields as columns, if every field can be read as the type of its column, and if none of
    ``required`` is empty. Fields are not quoted unless an option says so.
    """
    settings = {"sep": separator, "quote": "", "lineSep": "\n", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE, **options}
    rows = spark.read.options(**settings).schema(f"{schema}, {_LINE} string").csv(path)
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(f"`{c}`").isNull()
    fields = [F.col(f"`{c}`") for c in rows.columns if c != _LINE]
    return rows.withColumn(_LINE, F.when(F.col(_LINE).isNotNull(), F.col(_LINE)).when(missing, F.concat_ws(separator, *[f.cast("string") for f in fields])))


def bulk_load(spark: SparkSession, path: str, name: str, schema: str, label: str, separator: str = "|", max_filter_ratio: float = 0.0,
              required: tuple[str, ...] = (), **options: str) -> BulkLoad:
    """Load delimited files under a label. Lines that do not fit are filtered; if their share is above ``max_filter_ratio``, the
    load is refused and no row reaches the table.

    The files are read once: rows go to a scratch table, good and bad apart, and are counted on the way; only then the good
    ones are written to the table's partition of the label. A label that is loaded again replaces its own rows. Bad lines are
    kept in ``<name>__filtered`` under the same label.
    """
    staged, counter = scratch_path(spark, "bulk"), Observation()
    rows = scan(spark, path, schema, separator, required, **options).withColumn(_BAD, F.col(_LINE).isNotNull())
    observed = rows.observe(counter, F.count(F.lit(1)).alias("total"), F.count_if(_BAD).alias("filtered"))
    observed.write.partitionBy(_BAD).parquet(staged)
    found = counter.get
    load = BulkLoad(label, found["total"], found["total"] - found["filtered"], found["filtered"])
    if load.ratio > max_filter_ratio:
        raise LoadRefused(load, max_filter_ratio)
    read = spark.read.schema(rows.schema).parquet(staged)
    _put(read.where(~F.col(_BAD)).drop(_BAD, _LINE), name, label)
    _put(read.where(_BAD).select(F.col(_LINE).alias("line")), f"{name}__filtered", label)
    return load


def _put(df: DataFrame, name: str, label: str) -> None:
    """Rows of one label, in place of those that the table has under it."""
    spark, rows = df.sparkSession, df.withColumn(LABEL, F.lit(label))
    if not sinks.exists(spark, name):
        rows.write.mode("errorifexists").format("parquet").partitionBy(LABEL).saveAsTable(name)
    elif rows.isEmpty():
        quoted = label.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({LABEL} = '{quoted}')")
    else:
        sinks.replace_partitions(rows, name)
