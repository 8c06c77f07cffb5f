"""Generic relational and scalar operators over the test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavault.catalog.base import Query, portable, table
from stratavault.functions import keys, scalars
from stratavault.operators import relational as rel
from stratavault.sources.tables import relations_by_prefix

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def star_except(spark, d):
    orders = table(spark, d, "orders")
    return orders.select(*rel.star(orders, exclude=["O_TOTALPRICE", "o_orderstatus"]))


def star_affix(spark, d):
    orders = table(spark, d, "orders").alias("o")
    return orders.select(*rel.star(orders, exclude=["o_totalprice"], prefix="pre_", suffix="_post", relation_alias="o"))


def star_aggregate(spark, d):
    """Grouped use of the column list: every column but the measure is a grouping key."""
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    groups = rel.star(rows, exclude=["l_quantity"])
    return rows.groupBy(*groups).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


def group_by_n(spark, d):
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return rel.group_by_n(rows, 2).agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("max_quantity"))


def nullcheck_table(spark, d):
    """Document text after dropping everything but digits; texts without digits become empty, then null."""
    docs = table(spark, d, "documents").select("doc_id", F.regexp_replace("text", "[^0-9]", "").alias("digits"), "lang")
    return rel.nullcheck_table(docs)


def _parties(spark, d) -> dict[str, DataFrame]:
    customer = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("string").alias("code"))
    supplier = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("code"))
    return {"customer": customer, "supplier": supplier}


def union_by_prefix(spark, d):
    """Tables found in the catalogue by name prefix, then unioned."""
    orders = table(spark, d, "orders")
    for status in ("F", "O", "P"):
        orders.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_orderstatus").createOrReplaceTempView(
            f"stratavault_orders_{status.lower()}")
    found = relations_by_prefix(spark, "stratavault_orders_")
    return rel.union_relations({name: spark.table(name) for name in found})


def pivot_count(spark, d):
    events = table(spark, d, "events")
    return events.groupBy("user_id").agg(*rel.pivot("event_type", EVENT_TYPES, prefix="n_"))


def pivot_sum(spark, d):
    rows = table(spark, d, "lineitem").withColumn("qty", F.col("l_quantity").cast("bigint"))
    flags = rel.pivot("l_returnflag", ["A", "N", "R"], then_value="qty", suffix=" qty", quoted=False)
    big = rel.pivot("l_quantity", [10, 25], cmp=">=", agg="count", then_value="l_orderkey", else_value=None,
                    prefix="orders_", distinct=True)
    return rows.groupBy("l_linestatus").agg(*flags, *big)


def unpivot(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return rel.unpivot(part, exclude=["p_partkey"], remove=["P_NAME"], field_name="prop", value_name="val")


def unpivot_bool(spark, d):
    part = table(spark, d, "part").select(
        "p_partkey", "p_brand", F.when(F.col("p_size") > 5, F.col("p_size") > 25).alias("is_large"))
    return rel.unpivot(part, exclude=["p_partkey"], field_name="prop", value_name="val")


def deduplicate(spark, d):
    events = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    return rel.deduplicate(events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


def column_values_topk(spark, d):
    return rel.column_values(table(spark, d, "lineitem"), "l_suppkey", max_records=20, where="l_quantity > 10")


def single_value(spark, d):
    """Smallest supplier balance, and the default for an empty result."""
    supplier = table(spark, d, "supplier")
    found = rel.single_value(supplier.agg(F.min("s_acctbal")), 0.0).withColumnRenamed("value", "lowest")
    missing = rel.single_value(supplier.where("s_suppkey < 0").select("s_acctbal"), -1.0)
    return found.withColumn("missing", missing.scalar())


def results_as_columns(spark, d):
    counts = table(spark, d, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return rel.results_as_columns(counts)


def generate_series(spark, d):
    """A row for every order number up to the largest one, with the lines it has."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    upper = table(spark, d, "orders").agg(F.max("o_orderkey")).first()[0]
    numbers = rel.generate_series(spark, upper)
    return (numbers.join(lines, F.col("generated_number") == F.col("l_orderkey"), "left")
            .select("generated_number", F.coalesce("lines", F.lit(0).cast("bigint")).alias("lines")))


def date_spine(spark, d):
    """Every day of the order calendar, with the orders of that day."""
    orders = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    first, last = orders.agg(F.min("day"), F.max("day")).first()
    daily = orders.groupBy("day").agg(F.count(F.lit(1)).alias("orders"))
    days = rel.date_spine(spark, "day", first, last)
    return days.join(daily, F.col("date_day") == F.col("day"), "left").select(
        "date_day", F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders"))


def date_spine_month(spark, d):
    orders = table(spark, d, "orders").select(F.trunc("o_orderdate", "month").alias("month"), "o_orderkey")
    first, last = orders.agg(F.min("month"), F.max("month")).first()
    monthly = orders.groupBy("month").agg(F.count(F.lit(1)).alias("orders"))
    months = rel.date_spine(spark, "month", date(first.year - 1, 1, 1), last)
    return months.join(monthly, F.col("date_month") == F.col("month"), "left").select(
        "date_month", F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders"))


def surrogate_key(spark, d):
    rows = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")).alias("name"), "c_nationkey")
    return rows.select("c_custkey", keys.surrogate_key(["name", "c_nationkey"]).alias("sk"),
                       keys.surrogate_key(["name", "c_nationkey"], nulls_as_empty=True).alias("sk_legacy"))


def safe_arith(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("a"),
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey").cast("int")).alias("b"),
        (F.col("l_partkey") % 4).cast("int").alias("c"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", scalars.safe_add("a", "b", "c").alias("added"),
                       scalars.safe_subtract("a", "b", "c").alias("subtracted"),
                       scalars.safe_divide(F.col("a").cast("double"), F.col("c").cast("double")).alias("divided"))


def width_bucket(spark, d):
    part = table(spark, d, "part")
    return part.select("p_partkey", scalars.width_bucket("p_retailprice", 950.0, 1050.0, 4).alias("bucket"))


def haversine(spark, d):
    c = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 90).alias("lat"),
                                           (F.col("c_custkey") % 180).alias("lon"), F.col("c_nationkey").alias("n"))
    arguments = ("lat", "lon", F.col("lat") - F.col("n"), F.col("lon") + F.col("n"))
    return c.select("c_custkey", F.round(scalars.haversine_distance(*arguments, unit="km"), 6).alias("km"),
                    F.round(scalars.haversine_distance(*arguments), 6).alias("mi"))


def slugify(spark, d):
    part = table(spark, d, "part")
    text = F.concat_ws(" - ", F.col("p_size").cast("string"), F.col("p_brand"), F.col("p_name"))
    return part.select("p_partkey", scalars.slugify(text).alias("slug"), scalars.slugify("p_brand").alias("brand_slug"))


def urls(make):
    return lambda spark, d: table(spark, d, "pages").select("page_id", *make(F.col("url")))


STRIPPED = "replace(replace(url, 'http://', ''), 'https://', '')"
PARTIES_SQL = """customer_part AS (SELECT 'customer' AS source_relation, c_custkey AS id, c_name AS name, c_mktsegment AS segment,
  CAST(c_nationkey AS VARCHAR) AS code FROM customer),
supplier_part AS (SELECT 'supplier', s_suppkey, s_name, NULL, CAST(s_nationkey AS VARCHAR) FROM supplier)"""
DISTANCE = """2 * 3961 * asin(sqrt(power(sin(radians((lat2 - lat) / 2)), 2)
  + cos(radians(lat)) * cos(radians(lat2)) * power(sin(radians((lon2 - lon) / 2)), 2)))"""


def _slug_sql(text: str) -> str:
    return (f"regexp_replace(regexp_replace(regexp_replace(lower({text}), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'), "
            "'^([0-9])', '_\\1')")


QUERIES = {
    "star_except": Query(star_except, "SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM orders"),
    "star_affix": Query(star_affix, """SELECT o_orderkey AS pre_o_orderkey_post, o_custkey AS pre_o_custkey_post,
o_orderstatus AS pre_o_orderstatus_post, o_orderdate AS pre_o_orderdate_post, o_orderpriority AS pre_o_orderpriority_post FROM orders"""),
    "star_aggregate": Query(star_aggregate, """SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem GROUP BY ALL"""),
    "group_by_n": Query(group_by_n, "SELECT l_returnflag, l_linestatus, count(*) AS n, max(l_quantity) AS max_quantity FROM lineitem GROUP BY 1, 2"),
    "nullcheck_table": Query(nullcheck_table, "SELECT doc_id, nullif(regexp_replace(text, '[^0-9]', '', 'g'), '') AS digits, lang FROM documents"),
    "union_relations": Query(lambda s, d: rel.union_relations(_parties(s, d)),
                             f"WITH {PARTIES_SQL} SELECT * FROM customer_part UNION ALL SELECT * FROM supplier_part"),
    "union_exclude": Query(lambda s, d: rel.union_relations(_parties(s, d), exclude=["NAME"], column_override={"id": "string"}),
                           f"""WITH {PARTIES_SQL} SELECT source_relation, CAST(id AS VARCHAR) AS id, segment, code
FROM (SELECT * FROM customer_part UNION ALL SELECT * FROM supplier_part)"""),
    "union_where": Query(lambda s, d: rel.union_relations(_parties(s, d), include=["id", "code"], source_column=None, where="id % 7 = 1"),
                         f"""WITH {PARTIES_SQL} SELECT id, code FROM (SELECT * FROM customer_part UNION ALL SELECT * FROM supplier_part)
WHERE id % 7 = 1"""),
    "union_by_prefix": Query(union_by_prefix, """SELECT 'stratavault_orders_' || lower(o_orderstatus) AS source_relation, o_orderkey, o_orderstatus
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')"""),
    "pivot_count": Query(pivot_count, "SELECT user_id, " + ", ".join(
        f"CAST(sum(CASE WHEN event_type = '{e}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{e}" for e in EVENT_TYPES) + " FROM events GROUP BY user_id"),
    "pivot_sum": Query(pivot_sum, "SELECT l_linestatus, " + ", ".join(
        f"CAST(sum(CASE WHEN l_returnflag = '{f}' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS {f.lower()}_qty" for f in "ANR") + """,
count(DISTINCT CASE WHEN l_quantity >= 10 THEN l_orderkey END) AS orders_10,
count(DISTINCT CASE WHEN l_quantity >= 25 THEN l_orderkey END) AS orders_25 FROM lineitem GROUP BY l_linestatus"""),
    "unpivot": Query(unpivot, """SELECT p_partkey, 'p_brand' AS prop, p_brand AS val FROM part UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part"""),
    "unpivot_bool": Query(unpivot_bool, """SELECT p_partkey, 'p_brand' AS prop, p_brand AS val FROM part UNION ALL
SELECT p_partkey, 'is_large', CASE WHEN p_size > 5 THEN CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END END FROM part"""),
    "deduplicate": Query(deduplicate, """SELECT user_id, event_type, event_id, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""),
    "column_values_topk": Query(column_values_topk, """SELECT l_suppkey AS value, count(*) AS row_count FROM lineitem WHERE l_quantity > 10
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""),
    "single_value": Query(single_value, "SELECT min(s_acctbal) AS lowest, CAST(-1.0 AS DOUBLE) AS missing FROM supplier"),
    "results_as_columns": Query(results_as_columns, """WITH c AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (ORDER BY o_orderpriority NULLS FIRST, o_orderstatus NULLS FIRST, n) AS position FROM c)
SELECT position, unnest(['o_orderpriority', 'o_orderstatus', 'n']) AS column_name,
unnest([o_orderpriority, o_orderstatus, CAST(n AS VARCHAR)]) AS value FROM r"""),
    "generate_series": Query(generate_series, """SELECT g AS generated_number, coalesce(lines, 0) AS lines
FROM range(1, (SELECT max(o_orderkey) FROM orders) + 1) t(g)
LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1) ON g = l_orderkey"""),
    "date_spine": Query(date_spine, """SELECT CAST(g AS DATE) AS date_day, coalesce(n, 0) AS orders
FROM (SELECT unnest(range((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS g)
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1) ON CAST(g AS DATE) = day"""),
    "date_spine_month": Query(date_spine_month, """SELECT CAST(g AS DATE) AS date_month, coalesce(n, 0) AS orders
FROM (SELECT unnest(range((SELECT date_trunc('year', min(o_orderdate)) - INTERVAL 1 YEAR FROM orders)::TIMESTAMP,
      (SELECT date_trunc('month', max(o_orderdate)) FROM orders)::TIMESTAMP, INTERVAL 1 MONTH)) AS g)
LEFT JOIN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1) ON CAST(g AS DATE) = month"""),
    "surrogate_key": Query(surrogate_key, f"""WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS name, c_nationkey FROM customer)
SELECT c_custkey, md5(coalesce(name, '{keys.SURROGATE_NULL_TEXT}') || '-' || CAST(c_nationkey AS VARCHAR)) AS sk,
md5(coalesce(name, '') || '-' || CAST(c_nationkey AS VARCHAR)) AS sk_legacy FROM r"""),
    "safe_arith": Query(safe_arith, """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS INTEGER) AS a,
CASE WHEN l_suppkey % 5 <> 0 THEN CAST(l_suppkey AS INTEGER) END AS b, CAST(l_partkey % 4 AS INTEGER) AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) AS added,
coalesce(a, 0) - coalesce(b, 0) - coalesce(c, 0) AS subtracted, CAST(a AS DOUBLE) / nullif(CAST(c AS DOUBLE), 0) AS divided FROM r"""),
    "width_bucket": Query(width_bucket, """SELECT p_partkey, CAST(CASE WHEN p_retailprice < 950 THEN 0 WHEN p_retailprice >= 1050 THEN 5
ELSE floor((p_retailprice - 950) / 25) + 1 END AS BIGINT) AS bucket FROM part"""),
    "haversine": Query(haversine, f"""WITH c AS (SELECT c_custkey, CAST(c_custkey % 90 AS DOUBLE) AS lat, CAST(c_custkey % 180 AS DOUBLE) AS lon,
CAST(c_custkey % 90 - c_nationkey AS DOUBLE) AS lat2, CAST(c_custkey % 180 + c_nationkey AS DOUBLE) AS lon2 FROM customer)
SELECT c_custkey, round({DISTANCE} * 1.60934::DOUBLE, 6) AS km, round({DISTANCE}, 6) AS mi FROM c"""),
    "slugify": Query(slugify, f"""SELECT p_partkey, {_slug_sql("concat_ws(' - ', CAST(p_size AS VARCHAR), p_brand, p_name)")} AS slug,
{_slug_sql('p_brand')} AS brand_slug FROM part"""),
    "url_host": Query(urls(lambda u: [scalars.url_host(u).alias("host")]),
                      f"SELECT page_id, split_part(split_part(replace({STRIPPED}, 'android-app://', ''), '/', 1), '?', 1) AS host FROM pages"),
    "url_path": Query(urls(lambda u: [scalars.url_path(u).alias("path")]),
                      "SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?]*/([^?]*)', 1) AS path FROM pages"),
    "url_parameter": Query(urls(lambda u: [scalars.url_parameter(u, p).alias(p) for p in ("page", "ref", "utm_source")]),
                           "SELECT page_id, " + ", ".join(f"nullif(regexp_extract(url, '[?&]{p}=([^&]*)', 1), '') AS {p}"
                                                          for p in ("page", "ref", "utm_source")) + " FROM pages"),
}
