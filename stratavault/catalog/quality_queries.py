"""Data-quality checks, with arguments under which most of them find violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavault.catalog.base import Query, table
from stratavault.operators import quality as q

AS_OF = "2024-01-31 00:00:00"


def on(name, check):
    return lambda spark, d: check(table(spark, d, name))


def documents_with_labels(spark, d) -> DataFrame:
    """Documents with a quality label where there is one."""
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return table(spark, d, "documents").select("doc_id", "lang").join(labels, "doc_id", "left")


def orders_of(spark, d, *statuses: str) -> DataFrame:
    return table(spark, d, "orders").where(F.col("o_orderstatus").isin(list(statuses)))


def event_ranges(df: DataFrame) -> DataFrame:
    """Every event as a range of ``value`` seconds, a tenth of them without an end."""
    end = F.timestamp_add("SECOND", F.floor("value").cast("int"), F.col("ts"))
    return df.select("user_id", F.col("ts").alias("starts"), F.when(F.col("event_id") % 10 != 0, end).alias("ends"))


def whole_minutes(df: DataFrame) -> DataFrame:
    return df.select("event_type", F.date_trunc("MINUTE", "ts").cast("timestamp_ntz").alias("minute"))


def equality(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice")
    moved = part.where("p_partkey % 50 <> 7").withColumn(
        "p_retailprice", F.col("p_retailprice") + F.when(F.col("p_partkey") % 40 == 3, 0.5).otherwise(0.00001))
    return q.equality(part, moved, precision=2).withColumn("p_retailprice", F.col("p_retailprice").cast("double")).withColumn(
        "p_partkey", F.col("p_partkey").cast("bigint"))


def summary(spark, d):
    orders, customer = table(spark, d, "orders"), table(spark, d, "customer")
    lineitem, events = table(spark, d, "lineitem"), table(spark, d, "events")
    return q.summary([
        q.Check("orders_key_unique", q.unique(orders, "o_orderkey"), "error"),
        q.Check("orders_customer_known", q.relationships(orders, "o_custkey", customer.where("c_custkey % 2 = 0"), "c_custkey"), "error"),
        q.Check("line_combination_unique", q.unique_combination_of_columns(lineitem, ["l_orderkey", "l_linenumber"])),
        q.RowCheck("quantity_in_range", lineitem, q.outside("l_quantity", 1, 50)),
        q.RowCheck("few_large_quantities", lineitem, q.outside("l_quantity", max_value=49), "error", "> 0", "> 1000000000"),
        q.Check("same_orders", q.equal_rowcount(orders_of(spark, d, "F", "O"), orders_of(spark, d, "F"), ["o_orderpriority"]),
                "error", failures=q.FAIL_CALCULATIONS["equal_rowcount"]),
        q.Check("events_recent", q.recency(events, "ts", "day", 1, as_of=AS_OF), "error"),
    ])


CHANGED = """part_a AS (SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_brand, round(p_retailprice, 2) AS p_retailprice FROM part),
part_b AS (SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_brand,
  round(p_retailprice + CASE WHEN p_partkey % 40 = 3 THEN 0.5 ELSE 0.00001 END, 2) AS p_retailprice FROM part WHERE p_partkey % 50 <> 7)"""
RANGES = """r AS (SELECT user_id AS partition_by_col, ts AS lower_bound,
  CASE WHEN event_id % 10 <> 0 THEN ts + to_seconds(CAST(floor(value) AS INTEGER)) END AS upper_bound FROM events),
w AS (SELECT *, lead(lower_bound) OVER (PARTITION BY partition_by_col ORDER BY lower_bound NULLS FIRST, upper_bound NULLS FIRST) AS next_lower_bound,
  row_number() OVER (PARTITION BY partition_by_col ORDER BY lower_bound DESC NULLS LAST, upper_bound DESC NULLS LAST) = 1 AS is_last_record FROM r)"""
COUNTS = """a AS (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '5-LOW' GROUP BY 1),
b AS (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT' GROUP BY 1)"""


def count_pair(spark, d):
    return (orders_of(spark, d, "F", "O").where("o_orderpriority <> '5-LOW'"),
            orders_of(spark, d, "P").where("o_orderpriority <> '1-URGENT'"))


QUERIES = {
    "dq_not_null": Query(lambda s, d: q.not_null(documents_with_labels(s, d), "quality"),
                         "SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL"),
    "dq_unique": Query(on("lineitem", lambda t: q.unique(t, "l_orderkey")),
                       "SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    "dq_relationships": Query(lambda s, d: q.relationships(table(s, d, "documents"), "doc_id", table(s, d, "labels"), "doc_id"),
                              "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"),
    "dq_relationships_where": Query(
        lambda s, d: q.relationships_where(table(s, d, "lineitem"), "l_orderkey", table(s, d, "orders"), "o_orderkey",
                                           "l_returnflag = 'R'", "o_orderstatus <> 'P'"),
        """SELECT l_orderkey AS id FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IS NOT NULL
AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey IS NOT NULL)"""),
    "dq_unique_combination": Query(on("lineitem", lambda t: q.unique_combination_of_columns(t, ["l_orderkey", "l_linenumber"])),
                                   "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"),
    "dq_accepted_range": Query(on("lineitem", lambda t: q.accepted_range(t, "l_quantity", 2, 50, inclusive=False).select("l_orderkey", "l_linenumber", "l_quantity")),
                               "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT l_quantity > 2 OR NOT l_quantity < 50"),
    "dq_not_accepted_values": Query(on("orders", lambda t: q.not_accepted_values(t, "o_orderpriority", ["1-URGENT", "5-LOW", "9-NONE"])),
                                    "SELECT DISTINCT o_orderpriority AS value_field FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW', '9-NONE')"),
    "dq_not_constant": Query(on("lineitem", lambda t: q.not_constant(t, "l_suppkey", ["l_orderkey"])),
                             "SELECT l_orderkey, count(DISTINCT l_suppkey) AS filler_column FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 1"),
    "dq_not_empty_string": Query(lambda s, d: q.not_empty_string(table(s, d, "documents").select(
        F.regexp_replace("text", "[^0-9]", " ").alias("digits")), "digits"),
        "SELECT '' AS digits FROM documents WHERE trim(regexp_replace(text, '[^0-9]', ' ', 'g'), ' ') = ''"),
    "dq_not_null_proportion": Query(lambda s, d: q.not_null_proportion(documents_with_labels(s, d), "quality", 0.40, 0.41, ["lang"]),
        """SELECT lang, CAST(count(quality) AS DOUBLE) / count(*) AS not_null_proportion FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang
HAVING CAST(count(quality) AS DOUBLE) / count(*) < 0.40 OR CAST(count(quality) AS DOUBLE) / count(*) > 0.41"""),
    "dq_at_least_one": Query(lambda s, d: q.at_least_one(documents_with_labels(s, d).withColumn("block", F.floor(F.col("doc_id") / 5)), "quality", ["block"]),
        "SELECT doc_id // 5 AS block, count(quality) AS filler_column FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1 HAVING count(quality) = 0"),
    "dq_expression_is_true": Query(on("lineitem", lambda t: q.expression_is_true(t, "+ l_tax <= 0.15", "l_discount").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")),
        "SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE NOT (l_discount + l_tax <= 0.15)"),
    "dq_cardinality_equality": Query(
        lambda s, d: q.cardinality_equality(table(s, d, "customer").where("c_acctbal > 0"), "c_nationkey", table(s, d, "customer"), "c_nationkey"),
        """WITH a AS (SELECT c_nationkey AS value, count(*) AS num_rows FROM customer WHERE c_acctbal > 0 GROUP BY 1),
b AS (SELECT c_nationkey AS value, count(*) AS num_rows FROM customer GROUP BY 1)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)"""),
    "dq_equal_rowcount": Query(lambda s, d: q.equal_rowcount(*count_pair(s, d), ["o_orderpriority"]), f"""WITH {COUNTS}
SELECT a.o_orderpriority AS o_orderpriority_a, b.o_orderpriority AS o_orderpriority_b, a.n AS count_a, b.n AS count_b, abs(a.n - b.n) AS diff_count
FROM a FULL JOIN b ON a.o_orderpriority = b.o_orderpriority"""),
    "dq_fewer_rows_than": Query(lambda s, d: q.fewer_rows_than(*count_pair(s, d), ["o_orderpriority"]), f"""WITH {COUNTS}
SELECT a.o_orderpriority AS o_orderpriority_a, b.o_orderpriority AS o_orderpriority_b, a.n AS count_our_model, b.n AS count_comparison_model,
CAST(CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS BIGINT) AS row_count_delta
FROM a FULL JOIN b ON a.o_orderpriority = b.o_orderpriority"""),
    "dq_equality": Query(equality, f"""WITH {CHANGED}
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM part_a EXCEPT SELECT * FROM part_b)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM part_b EXCEPT SELECT * FROM part_a)"""),
    "dq_mutually_exclusive_ranges": Query(
        lambda s, d: q.mutually_exclusive_ranges(event_ranges(table(s, d, "events")), "starts", "ends", "user_id"), f"""WITH {RANGES},
c AS (SELECT *, coalesce(lower_bound < upper_bound, false) AS lower_bound_less_than_upper_bound,
  coalesce(upper_bound <= next_lower_bound, is_last_record, false) AS upper_bound_less_than_or_equal_to_next_lower_bound FROM w)
SELECT * FROM c WHERE NOT (lower_bound_less_than_upper_bound AND upper_bound_less_than_or_equal_to_next_lower_bound)"""),
    "dq_ranges_no_gaps": Query(
        lambda s, d: q.mutually_exclusive_ranges(table(s, d, "lineitem").select("l_quantity", (F.col("l_quantity") + F.col("l_linenumber") % 2).alias("up")),
                                                 "l_quantity", "up", gaps="not_allowed", zero_length_range_allowed=True),
        """WITH w AS (SELECT l_quantity AS lower_bound, l_quantity + l_linenumber % 2 AS upper_bound,
  lead(l_quantity) OVER (ORDER BY l_quantity, l_linenumber % 2) AS next_lower_bound,
  lead(l_quantity) OVER (ORDER BY l_quantity, l_linenumber % 2) IS NULL AS is_last_record FROM lineitem)
SELECT *, true AS lower_bound_less_than_or_equal_to_upper_bound, upper_bound = next_lower_bound AS upper_bound_equal_to_next_lower_bound
FROM w WHERE upper_bound <> next_lower_bound"""),
    "dq_sequential_values": Query(on("orders", lambda t: q.sequential_values(t.where("o_orderstatus <> 'P'"), "o_orderkey", 1)),
        """SELECT o_orderkey, previous_o_orderkey FROM (SELECT o_orderkey, lag(o_orderkey) OVER (ORDER BY o_orderkey) AS previous_o_orderkey
FROM orders WHERE o_orderstatus <> 'P') WHERE o_orderkey <> previous_o_orderkey + 1"""),
    "dq_sequential_timestamps": Query(on("events", lambda t: q.sequential_values(whole_minutes(t), "minute", 20, "minute", ["event_type"])),
        """SELECT event_type, minute, previous_minute FROM (SELECT event_type, minute, lag(minute) OVER (PARTITION BY event_type ORDER BY minute) AS previous_minute
FROM (SELECT event_type, date_trunc('minute', ts) AS minute FROM events)) WHERE minute <> previous_minute + INTERVAL 20 MINUTE"""),
    "dq_recency": Query(on("events", lambda t: q.recency(t, "ts", "hour", 36, group_by=["user_id"], as_of=AS_OF)),
        f"""SELECT user_id, max(ts) AS most_recent, TIMESTAMP '{AS_OF}' - INTERVAL 36 HOUR AS threshold FROM events GROUP BY 1
HAVING max(ts) < TIMESTAMP '{AS_OF}' - INTERVAL 36 HOUR"""),
    "dq_summary": Query(summary, f"""WITH f AS (
SELECT 'orders_key_unique' AS test, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS failures, 'error' AS severity, 0 AS lim
UNION ALL SELECT 'orders_customer_known', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)), 'error', 0
UNION ALL SELECT 'line_combination_unique', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)), 'warn', 0
UNION ALL SELECT 'quantity_in_range', (SELECT count(*) FROM lineitem WHERE l_quantity NOT BETWEEN 1 AND 50), 'warn', 0
UNION ALL SELECT 'few_large_quantities', (SELECT count(*) FROM lineitem WHERE l_quantity > 49), 'error', 1000000000
UNION ALL SELECT 'same_orders', (SELECT CAST(sum(abs(x.n - y.n)) AS BIGINT) FROM (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1) x
  JOIN (SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) y USING (o_orderpriority)), 'error', 0
UNION ALL SELECT 'events_recent', (SELECT CAST(max(ts) < TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY AS BIGINT) FROM events), 'error', 0)
SELECT test, failures, severity, CASE WHEN severity = 'error' AND failures > lim THEN 'error' WHEN failures > 0 THEN 'warn' ELSE 'pass' END AS status FROM f"""),
}
