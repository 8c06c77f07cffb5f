"""Catalogue and publishing queries over all test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratavault.catalog.base import Query, own_database, table
from stratavault.session import materialise, scratch_path
from stratavault.sinks import publish as pb
from stratavault.sinks.bulk import LoadRefused, bulk_load
from stratavault.sources.tables import column_list, relations_by_pattern

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "pages",
          "benchmark", "conversations", "embeddings"]


def tables(spark, d, names=TABLES):
    return {n: table(spark, d, n) for n in names}


def catalog_columns(spark, d):
    found = tables(spark, d)
    for df in found.values():
        column_list(df)
    return pb.columns_of(found).drop("data_type")


def type_mapping(spark, d):
    return pb.structure(tables(spark, d)).select("table_name", "column_name", "target_type", "filled")


def pattern_counts(spark, d):
    """Views found by a name pattern, with their rows."""
    for name, df in tables(spark, d).items():
        df.createOrReplaceTempView(f"stratavault_all_{name}")
    found = relations_by_pattern(spark, "%", "STRATAVAULT\\_ALL\\_%s", exclude="%labels")
    views = {n.removeprefix("stratavault_all_"): spark.table(n) for n in found}
    for name in tables(spark, d):  # so that no other query finds them in the session
        spark.catalog.dropTempView(f"stratavault_all_{name}")
    return pb.row_counts(views)


def publish_counts(spark, d):
    """Rows of the published copies, and of what was sent."""
    folder = scratch_path(spark, "published")
    sent = pb.publish_files(spark, tables(spark, d), folder)
    counted = pb.row_counts(pb.published(spark, folder))
    reported = spark.createDataFrame([(r["table_name"], r["status"], r["source_rows"]) for r in sent], "table_name string, status string, source_rows bigint")
    return counted.join(reported, "table_name")


def catalog_diff(spark, d):
    """A folder that holds all tables, published again from a source that has only the names in ``s``: the tables that go,
    and the rows of those that stay."""
    folder, every = scratch_path(spark, "published"), tables(spark, d)
    pb.publish_files(spark, every, folder)
    report = pb.publish_files(spark, {n: df for n, df in every.items() if n.endswith("s")}, folder)
    names = spark.createDataFrame([(r["table_name"], r["status"]) for r in report], "table_name string, status string")
    return names.join(pb.row_counts(pb.published(spark, folder)), "table_name", "left")


def publish_verified(spark, d):
    """Copies proven by content. One cell of a copy is changed afterwards: the check finds it, and the next sync copies that
    table alone."""
    folder, every = scratch_path(spark, "published"), tables(spark, d)
    first = {e["table_name"]: e for e in pb.publish_verified(spark, every, folder)}
    changed = materialise(every["nation"].withColumn("n_name", F.when(F.col("n_nationkey") == 3, "x").otherwise(F.col("n_name"))), "changed")
    pb.copy_files(changed, folder, "nation")
    found = pb.differing(spark, every, folder)
    second = {e["table_name"]: e["status"] for e in pb.publish_verified(spark, every, folder)}
    left = pb.differing(spark, every, folder)
    rows = [(n, e["status"], e["target_rows"], n in found, second[n], n not in left) for n, e in first.items()]
    return spark.createDataFrame(rows, "table_name string, status string, row_count bigint, damaged boolean, again string, same boolean")


def bulk_load_filtered(spark, d):
    """Documents as delimited lines, three tenths of them broken: the rows that were loaded, and the counts of that load and of
    one that was refused."""
    path = scratch_path(spark, "delimited")
    n, key = F.col("doc_id"), F.col("doc_id").cast("string")
    text = F.translate(F.coalesce("text", F.lit("")), "\n\r|\\\"", "     ")
    fields = [F.coalesce(c, F.lit("")) for c in ("lang", "source")]
    size = F.coalesce(F.col("n_chars").cast("string"), F.lit(""))
    line = (F.when(n % 10 == 0, F.concat_ws("|", key, *fields)).when(n % 10 == 1, F.concat_ws("|", key, *fields, size, text, F.lit("more")))
            .when(n % 10 == 2, F.concat_ws("|", key, *fields, F.lit("many"), text)).otherwise(F.concat_ws("|", key, *fields, size, text)))
    table(spark, d, "documents").select(line.alias("value")).write.text(path)
    schema = "doc_id bigint, lang string, source string, n_chars bigint, text string"
    with own_database(spark) as database:
        done = bulk_load(spark, path, f"{database}.docs", schema, "one", max_filter_ratio=0.5)
        try:
            bulk_load(spark, path, f"{database}.strict", schema, "one", max_filter_ratio=0.1)
            refused = None
        except LoadRefused as refusal:
            refused = refusal.load
        kept = spark.table(f"{database}.docs__filtered").count()
        there = spark.catalog.tableExists(f"{database}.strict")
        rows = materialise(spark.table(f"{database}.docs").drop("load_label"), "bulk")
    counts = [(done.loaded, "loaded", str(done.filtered), done.total, str(kept)), (refused.loaded, "refused", str(refused.filtered), refused.total, str(there))]
    return rows.unionByName(spark.createDataFrame(counts, schema))


BULK_SQL = """
WITH lines AS (SELECT doc_id, nullif(lang, '') AS lang, nullif(source, '') AS source, n_chars, nullif(translate(coalesce(text, ''), chr(10) || chr(13) || '|' || chr(92) || '"', '     '), '') AS text,
  doc_id % 10 > 2 AS fits FROM documents)
SELECT doc_id, lang, source, n_chars, text FROM lines WHERE fits
UNION ALL SELECT count(*) FILTER (fits), 'loaded', CAST(count(*) FILTER (NOT fits) AS VARCHAR), count(*), CAST(count(*) FILTER (NOT fits) AS VARCHAR) FROM lines
UNION ALL SELECT count(*) FILTER (fits), 'refused', CAST(count(*) FILTER (NOT fits) AS VARCHAR), count(*), 'False' FROM lines
"""


# Expected serving types by column kind.
KINDS = {"list": "VARCHAR(255)", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE PRECISION", "text": "TEXT", "time": "TIMESTAMP"}
COLUMNS = {
    "region": "r_regionkey int, r_name text",
    "nation": "n_nationkey int, n_name text, n_regionkey int",
    "customer": "c_custkey bigint, c_name text, c_nationkey int, c_acctbal double, c_mktsegment text",
    "supplier": "s_suppkey bigint, s_name text, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name text, p_brand text, p_type text, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus text, o_totalprice double, o_orderdate time, o_orderpriority text",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag text, l_linestatus text, l_shipdate time",
    "events": "event_id bigint, ts time, user_id bigint, event_type text, value double, props text",
    "documents": "doc_id bigint, text text, lang text, source text, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url text, html text",
    "benchmark": "item_id bigint, text text",
    "conversations": "conv_id bigint, turn bigint, role text, text text",
    "embeddings": "vec_id bigint, embedding list, label int",
}


def _per_column(make) -> str:
    rows = []
    for name, columns in COLUMNS.items():
        for position, column in enumerate(columns.split(", "), 1):
            rows.append(make(name, position, *column.split(" ")))
    return " UNION ALL ".join(rows)


QUERIES = {
    "publish_verified": Query(publish_verified, " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'success' AS status, count(*) AS row_count, {str(t == 'nation').lower()} AS damaged, "
        f"'{'success' if t == 'nation' else 'kept'}' AS again, true AS same FROM {t}" for t in TABLES)),
    "bulk_load_filtered": Query(bulk_load_filtered, BULK_SQL),
    "catalog_columns": Query(catalog_columns, _per_column(
        lambda t, i, c, k: f"SELECT '{t}' AS table_name, {i} AS position, '{c}' AS column_name, count({c}) AS filled FROM {t}")),
    "type_mapping": Query(type_mapping, _per_column(
        lambda t, i, c, k: f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{KINDS[k]}' AS target_type, count({c}) AS filled FROM {t}")),
    "publish_counts": Query(publish_counts, " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, 'success' AS status, count(*) AS source_rows FROM {t}" for t in TABLES)),
    "relations_by_pattern": Query(pattern_counts, " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES if t.endswith("s") and t != "labels")),
    "catalog_diff": Query(catalog_diff, " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'success' AS status, count(*) AS row_count FROM {t}" if t.endswith("s")
        else f"SELECT '{t}', 'dropped', NULL" for t in sorted(TABLES, key=lambda t: not t.endswith("s")))),
}
