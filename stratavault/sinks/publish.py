"""Publishing layers to a serving store: type names, catalogue difference, table copies with counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratavault.operators.relational import _quoted, difference
from stratavault.session import delete_path, list_folder

# Serving-store type for each Spark type; other types become the fallback.
SERVING_TYPES = {
    "boolean": "BOOLEAN", "tinyint": "SMALLINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT",
    "float": "REAL", "double": "DOUBLE PRECISION", "decimal": "NUMERIC", "date": "DATE",
    "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP", "string": "TEXT", "char": "CHAR",
    "varchar": "VARCHAR", "binary": "BYTEA", "variant": "JSONB",
}
FALLBACK_TYPE = "VARCHAR(255)"
SYNC_BATCH = 50_000


def map_type(source: Column | str) -> Column:
    """Serving type of a source type name; a size in brackets is kept, except on the fallback."""
    text = F.lower(F.col(source) if isinstance(source, str) else source)
    base = F.trim(F.substring_index(text, "(", 1))
    size = F.regexp_extract(text, r"(\([^)]*\))", 1)
    names = F.create_map(*[F.lit(x) for pair in SERVING_TYPES.items() for x in pair])
    found = F.try_element_at(names, base)
    return F.when(found.isNull(), FALLBACK_TYPE).otherwise(F.concat(found, size))


def columns_of(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns of the tables with their types and the number of filled cells, one scan per table."""
    def one(name: str, df: DataFrame) -> DataFrame:
        filled = df.agg(F.array(*[
            F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"), F.count(_quoted(f.name)).alias("filled"))
            for i, f in enumerate(df.schema.fields)]).alias("c"))
        return filled.select(F.lit(name).alias("table_name"), F.inline("c"))
    return reduce(DataFrame.unionAll, [one(n, df) for n, df in tables.items()])


def structure(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Table structures for the serving store."""
    return columns_of(tables).withColumn("target_type", map_type("data_type"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()])


def stale_tables(source: DataFrame, target: DataFrame) -> DataFrame:
    """Names that the target has and the source has not."""
    return difference(target, source).orderBy(*target.columns)


def copy_jdbc(df: DataFrame, url: str, name: str, batch: int = SYNC_BATCH, partitions: int | None = None, **options: str) -> None:
    """Full copy into a database table, written in parallel by partition and in batches of rows."""
    rows = df.coalesce(partitions) if partitions else df
    (rows.write.format("jdbc").option("url", url).option("dbtable", name).option("batchsize", batch)
     .option("truncate", "true").options(**options).mode("overwrite").save())


def copy_files(df: DataFrame, folder: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables that a folder holds in full; what a failed copy has left is none."""
    root = folder.rstrip("/")
    return {n: spark.read.parquet(f"{root}/{n}") for n in list_folder(spark, root) if "_SUCCESS" in list_folder(spark, f"{root}/{n}")}


#: Tables that are copied at a time.
AT_ONCE = 4
MANIFEST = "_manifest"


def _all_at_once(spark: SparkSession, work: Callable[[str, DataFrame], dict[str, object]], tables: Mapping[str, DataFrame]) -> list[dict[str, object]]:
    """One entry per table, some tables at a time; an error is the entry of its table and does not stop the others."""
    def one(item: tuple[str, DataFrame]) -> dict[str, object]:
        try:
            return work(*item)
        except Exception as problem:  # noqa: BLE001 - reported per table
            return {"table_name": item[0], "status": f"error: {problem}", "source_rows": None, "target_rows": None}
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(inheritable_thread_target(spark)(one), tables.items()))


def _drop_stale(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> list[dict[str, object]]:
    dropped = [n for n in list_folder(spark, folder) if n not in tables and not n.startswith(("_", "."))]
    for name in dropped:
        delete_path(spark, f"{folder.rstrip('/')}/{name}")
    return [{"table_name": name, "status": "dropped", "source_rows": None, "target_rows": None} for name in dropped]


def publish_files(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, drop_stale: bool = True) -> list[dict[str, object]]:
    """Copy every table into a folder, count the rows that were sent and those that can be read back, and drop what the
    source no longer has. One entry per table: name, status, source_rows, target_rows; errors do not stop the others."""
    def copy(name: str, df: DataFrame) -> dict[str, object]:
        counter = Observation()
        copy_files(df.observe(counter, F.count(F.lit(1)).alias("rows")), folder, name)
        sent, there = counter.get["rows"], spark.read.schema(df.schema).parquet(f"{folder.rstrip('/')}/{name}").count()
        return {"table_name": name, "status": "success" if sent == there else "error: the copy has another number of rows",
                "source_rows": sent, "target_rows": there}
    return _all_at_once(spark, copy, tables) + (_drop_stale(spark, tables, folder) if drop_stale else [])


def _row_hashes(df: DataFrame) -> list[Column]:
    """Two hashes of a row, in which nulls count by their column."""
    cells = []
    for f in df.schema.fields:
        plain = isinstance(f.dataType, (T.AtomicType, T.NullType)) and not isinstance(f.dataType, T.VariantType)
        cells.append(F.xxhash64(_quoted(f.name) if plain else F.to_json(F.struct(_quoted(f.name))), _quoted(f.name).isNull()))
    return [F.xxhash64(F.lit(seed), *cells) for seed in (17, 23)]


def _exact_sum(hashed: Column) -> Column:
    """Sum of 64-bit numbers as a decimal, from the sums of three parts that are added as longs."""
    low = F.sum(hashed.bitwiseAND(F.lit((1 << 21) - 1)))
    middle = F.sum(F.shiftrightunsigned(hashed, 21).bitwiseAND(F.lit((1 << 21) - 1)))
    high = F.sum(F.shiftright(hashed, 42))
    low, middle, high = (part.cast("decimal(20,0)") for part in (low, middle, high))
    return high * F.lit(1 << 42).cast("decimal(13,0)") + middle * F.lit(1 << 21).cast("decimal(7,0)") + low


def fingerprint(df: DataFrame) -> list[Column]:
    """Aggregates that identify the rows of a table as a multiset, in any order and any partitions: their number and the sums of
    two 64-bit row hashes, exact for up to 4 * 10**12 rows."""
    first, second = _row_hashes(df)
    return [F.count(F.lit(1)).alias("n"), _exact_sum(first).alias("h1"), _exact_sum(second).alias("h2")]


def _plain(row) -> tuple[int, int, int]:
    return int(row["n"]), int(row["h1"] or 0), int(row["h2"] or 0)


def fingerprint_of(df: DataFrame) -> tuple[int, int, int]:
    """Rows and hash sums of a table, in one pass."""
    return _plain(df.agg(*fingerprint(df)).first())


def _manifest(spark: SparkSession, folder: str) -> dict[str, tuple[int, int, int]]:
    """Fingerprints of the copies that were proven; one small file per table."""
    place = f"{folder.rstrip('/')}/{MANIFEST}"
    found = {}
    for name in list_folder(spark, place):
        if "_SUCCESS" in list_folder(spark, f"{place}/{name}"):
            row = spark.read.json(f"{place}/{name}", schema="n string, h1 string, h2 string").first()
            found[name] = (int(row["n"]), int(row["h1"]), int(row["h2"]))
    return found


def publish_verified(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, drop_stale: bool = True) -> list[dict[str, object]]:
    """Copy every table into a folder and prove each copy by its content: the fingerprint is taken of the rows as they are
    sent, and again of what can be read back.

    A proven copy is noted in a manifest. A sync that was cut off goes on where it stopped: tables whose fingerprint is in the
    manifest, and whose copy still has it, are left alone (status ``kept``). One entry per table: name, status, source_rows,
    target_rows; errors do not stop the others. Tables that the source no longer has are dropped.
    """
    root = folder.rstrip("/")
    known = _manifest(spark, folder)

    def copy(name: str, df: DataFrame) -> dict[str, object]:
        target, note = f"{root}/{name}", f"{root}/{MANIFEST}/{name}"
        if name in known and "_SUCCESS" in list_folder(spark, target) and known[name] == fingerprint_of(df) == fingerprint_of(spark.read.schema(df.schema).parquet(target)):
            return {"table_name": name, "status": "kept", "source_rows": known[name][0], "target_rows": known[name][0]}
        delete_path(spark, note)
        seen = Observation()
        copy_files(df.observe(seen, *fingerprint(df)), folder, name)
        sent, there = _plain(seen.get), fingerprint_of(spark.read.schema(df.schema).parquet(target))
        if sent == there:
            spark.createDataFrame([tuple(map(str, sent))], "n string, h1 string, h2 string").coalesce(1).write.mode("overwrite").json(note)
        return {"table_name": name, "status": "success" if sent == there else "error: the copy has other rows", "source_rows": sent[0], "target_rows": there[0]}

    report = _all_at_once(spark, copy, tables)
    stale = _drop_stale(spark, tables, folder) if drop_stale else []
    for entry in stale:
        delete_path(spark, f"{root}/{MANIFEST}/{entry['table_name']}")
    return report + stale


def differing(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Names of the tables whose copy has not the same rows, or is not there."""
    copies = published(spark, folder)

    def compare(name: str, df: DataFrame) -> dict[str, object]:
        same = name in copies and fingerprint_of(df) == fingerprint_of(spark.read.schema(df.schema).parquet(f"{folder.rstrip('/')}/{name}"))
        return {"table_name": name, "status": "same" if same else "different"}
    return sorted(e["table_name"] for e in _all_at_once(spark, compare, tables) if e["status"] != "same")


def sync(tables: Mapping[str, DataFrame], write) -> dict[str, str]:
    """Copy every table with ``write(df, name)``; the outcome per table, errors do not stop the others."""
    outcome = {}
    for name, df in tables.items():
        try:
            write(df, name)
            outcome[name] = "success"
        except Exception as problem:  # noqa: BLE001 - reported per table
            outcome[name] = f"error: {problem}"
    return outcome


def layer_tables(spark: SparkSession, schema: str, include_views: bool = True) -> dict[str, DataFrame]:
    """All tables of a schema, and its views as their results."""
    listed = spark.catalog.listTables(schema)
    return {t.name: spark.table(f"{schema}.{t.name}") for t in listed
            if not t.isTemporary and (include_views or t.tableType != "VIEW")}
