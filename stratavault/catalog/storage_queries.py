"""Stored tables from landing to removal, seeds, and checks of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavault.catalog.base import Query, own_database, table
from stratavault.operators import quality as q
from stratavault.operators.typing import inferred_types, typed_projection
from stratavault.plans.ingest import clean_missing
from stratavault.session import materialise, scratch_path
from stratavault.sinks import publish as pb
from stratavault.sinks import tables as sinks
from stratavault.sources.tables import catalogue, read_seed, safe_columns

SCHEMA = "step string, name string, value bigint, kind string"


def table_cycle(spark, d) -> DataFrame:
    """Customers landed as text in bounded files, typed, replaced, shown by a view, published with their view, and removed:
    what each step leaves."""
    source = table(spark, d, "customer")
    names = safe_columns([*source.columns, "odd`name"])
    rows = []
    with own_database(spark) as db:
        landing, typed = f"{db}.customer__landing", f"{db}.customer"
        sinks.create_landing(spark, landing, [*names, "Unnamed: 7"])
        texts = source.select(*[F.col(c).cast("string").alias(c) for c in names])
        for part in (0, 1):
            rows.append((f"append {part}", landing.split(".")[1], sinks.append(texts.where(F.col("c_custkey").cast("bigint") % 2 == part), landing, 200), "landing"))
        landed = spark.table(landing)
        sinks.rebuild(typed_projection(landed, inferred_types(landed)), typed)
        sinks.rebuild(spark.table(typed).where("c_custkey % 5 <> 0"), typed)  # replaced from itself
        view = sinks.companion_view(spark, typed)
        rows.append(("view", view.split(".")[1], spark.table(view).count(), "rows"))
        rows += [("catalogue", r["name"], None, r["kind"]) for r in catalogue(spark, db).collect()]
        folder = scratch_path(spark, "published")
        report = pb.publish_files(spark, pb.layer_tables(spark, db), folder)
        rows += [("published", e["table_name"], e["target_rows"], e["status"]) for e in report]
        rows.append(("balance", "customer", pb.published(spark, folder)["v_customer"].agg(F.sum(F.round(F.col("c_acctbal") * 100)).cast("bigint")).first()[0], "cents"))
        sinks.truncate(spark, landing)
        rows.append(("truncated", "customer__landing", spark.table(landing).count(), "rows"))
        sinks.drop_table(spark, landing)
        gone = clean_missing(spark, spark.createDataFrame([("customer.xlsx", "customer")], "file_name string, table_name string"), db)
        rows += [("cleaned", r.table_name, int(sinks.exists(spark, typed) or sinks.exists(spark, landing)), r.status) for r in gone]
    rows.append(("named", sinks.layer_table("mart", "customer", "view", "dims"), None, sinks.layer_table("rdv", "hub_customer")))
    return spark.createDataFrame(rows, SCHEMA)


CYCLE_SQL = """
SELECT 'append 0' AS step, 'customer__landing' AS name, count(*) AS value, 'landing' AS kind FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT 'append 1', 'customer__landing', count(*), 'landing' FROM customer WHERE c_custkey % 2 = 1
UNION ALL SELECT 'view', 'v_customer', count(*), 'rows' FROM customer WHERE c_custkey % 5 <> 0
UNION ALL SELECT 'catalogue', name, NULL, kind FROM (VALUES ('customer', 'table'), ('customer__landing', 'table'), ('v_customer', 'view')) AS t(name, kind)
UNION ALL SELECT 'published', 'customer__landing', count(*), 'success' FROM customer
UNION ALL SELECT 'published', name, count(*), 'success' FROM customer CROSS JOIN (VALUES ('customer'), ('v_customer')) AS t(name) WHERE c_custkey % 5 <> 0 GROUP BY name
UNION ALL SELECT 'balance', 'customer', CAST(sum(round(c_acctbal * 100)) AS BIGINT), 'cents' FROM customer WHERE c_custkey % 5 <> 0
UNION ALL SELECT 'truncated', 'customer__landing', 0, 'rows' UNION ALL SELECT 'cleaned', 'customer', 0, 'deleted'
UNION ALL SELECT 'named', 'main_mart.v_customer', NULL, 'main_rdv.hub_customer'
"""


def seed(spark, d) -> DataFrame:
    """Suppliers written as delimited text with a header and read again with a declared schema."""
    path = scratch_path(spark, "seed")
    rows = table(spark, d, "supplier").select("s_suppkey", F.concat("s_name", F.lit(', "'), "s_nationkey", F.lit('"')).alias("s_name"), "s_acctbal")
    rows.write.option("header", True).csv(path)
    return read_seed(spark, path, "s_suppkey bigint, s_name string, s_acctbal double")


def columns_match(spark, d) -> DataFrame:
    """Columns of lineitem against those of orders and two of its own, with the number of rows behind each."""
    lines = table(spark, d, "lineitem")
    expected = [*table(spark, d, "orders").columns, "L_ORDERKEY", "l_tax"]
    found = q.columns_match_set(lines, expected)
    return materialise(found, "columns").withColumn("n_rows", lines.agg(F.count(F.lit(1))).scalar())


QUERIES = {
    "stored_table_cycle": Query(table_cycle, CYCLE_SQL),
    "seed_read": Query(seed, """SELECT s_suppkey, s_name || ', "' || s_nationkey || '"' AS s_name, s_acctbal FROM supplier"""),
    "dq_column_set": Query(columns_match, """SELECT column_name, problem, (SELECT count(*) FROM lineitem) AS n_rows FROM (
SELECT column_name, 'unexpected' AS problem FROM (DESCRIBE lineitem) WHERE column_name NOT IN ('l_orderkey', 'l_tax')
UNION ALL SELECT column_name, 'missing' FROM (DESCRIBE orders))"""),
    "dq_columns_equal": Query(lambda s, d: q.columns_equal(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") % 2).alias("a"), (F.col("l_linenumber") % 2).alias("b")), "a", "b"),
                              "SELECT l_orderkey, l_linenumber, l_quantity % 2 AS a, l_linenumber % 2 AS b FROM lineitem WHERE l_quantity % 2 <> l_linenumber % 2"),
}
