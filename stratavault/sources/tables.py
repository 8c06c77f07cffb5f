"""Table sources: parquet and CSV scans, JDBC extracts, and the session catalogue."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header row and a declared schema; a byte-order mark is accepted."""
    return spark.read.csv(path, schema=schema, header=True, encoding="UTF-8", enforceSchema=True)


def read_jdbc(spark: SparkSession, url: str, name: str, partition_column: str | None = None,
              bounds: tuple[int, int] | None = None, partitions: int = 16, **options: str) -> DataFrame:
    """Full extract of a database table, in parallel ranges of a numeric column when one is named."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options)
    if partition_column and bounds:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", bounds[0])
                  .option("upperBound", bounds[1]).option("numPartitions", partitions))
    return reader.load()


def table_kind(raw: Column | str) -> Column:
    """Catalogue spelling of a table type to the library's: table, external, view, materializedview, ..."""
    text = F.upper(raw if not isinstance(raw, str) else F.col(raw))
    return (F.when(text.isin("BASE TABLE", "MANAGED"), "table").when(text.isin("EXTERNAL", "EXTERNAL TABLE"), "external")
            .when(text == "MATERIALIZED VIEW", "materializedview").when(text == "TEMPORARY", "view").otherwise(F.lower(text)))


def catalogue(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views the session knows: schema, name, kind."""
    listed = spark.catalog.listTables(database)
    columns = {"schema": [t.namespace[-1] if t.namespace else "" for t in listed],
               "name": [t.name for t in listed], "kind": [t.tableType for t in listed]}
    text = pa.schema([(c, pa.string()) for c in columns])
    return spark.createDataFrame(pa.table(columns, schema=text)).withColumn("kind", table_kind("kind"))


def relations_by_pattern(spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "",
                         database: str | None = None) -> list[str]:
    """Names of the relations whose schema and name match the LIKE patterns in any case."""
    rows = catalogue(spark, database).where(F.col("schema").ilike(schema_pattern) & F.col("name").ilike(table_pattern))
    rows = rows.where(~F.col("name").ilike(exclude)) if exclude else rows
    return sorted({f"{r['schema']}.{r['name']}" if r["schema"] else r["name"] for r in rows.collect()})


def relations_by_prefix(spark: SparkSession, prefix: str, schema_pattern: str = "%", exclude: str = "",
                        database: str | None = None) -> list[str]:
    """Names of the relations that start with ``prefix``."""
    escaped = prefix.replace("\\", "\\\\").replace("_", "\\_").replace("%", "\\%")
    return relations_by_pattern(spark, schema_pattern, escaped + "%", exclude, database)


def column_list(df: DataFrame) -> list[str]:
    """Ordered column names; a relation without columns is an error."""
    if not df.columns:
        raise ValueError("relation has no columns")
    return list(df.columns)


def safe_columns(names: Iterable[str]) -> list[str]:
    """Names without a back-tick or backslash; the others are left out of generated projections."""
    return [n for n in names if "`" not in n and "\\" not in n]
