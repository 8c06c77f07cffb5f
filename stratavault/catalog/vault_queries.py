"""Raw vault, business vault, mart and report queries.

Stand-ins: center = nation, road = region, channel = order priority, sector = customer segment (BUILDING
plays the paid-services sector), amounts = order totals as text.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavault.catalog.base import LOAD_1, LOAD_2, LOAD_3, Query, own_database, portable, table
from stratavault.functions.keys import hash_key
from stratavault.operators import vault as v
from stratavault.plans import revenue as r
from stratavault.session import materialise
from stratavault.sinks.keyed import keyed_rows

SRC = r.REVENUE_SOURCE


def revenue_stage(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus")
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    amount = F.col("o_totalprice").cast("decimal(15,2)")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_name").alias(r.CENTER),
                    F.year("o_orderdate").cast("string").alias(r.YEAR),
                    F.month("o_orderdate").cast("string").alias(r.MONTH),
                    F.col("o_orderpriority").alias(r.CHANNEL),
                    F.when(F.col("c_mktsegment") == "BUILDING", r.SECTOR_PAID).otherwise(F.col("c_mktsegment")).alias(r.SECTOR),
                    F.col("r_name").alias(r.ROAD),
                    F.when(F.col("o_orderstatus") != "P", amount.cast("string")).alias(r.PLAN),
                    F.when(F.col("o_orderstatus") == "F", amount.cast("string")).alias(r.APPROVED),
                    amount.cast("string").alias(r.FACT)))


# directory members; a second load drops some of them in the tests
MEMBERS = {
    "unit": [r.UNIT_ROUBLE, r.UNIT_THOUSAND],
    "metric": [r.METRIC_FACT, "План"],
    "data_type": [r.DATA_PRIMARY, r.DATA_DERIVED],
    "discreteness": [r.STEP_MONTH, r.STEP_YEAR],
    "value_type": [r.VALUE_DAILY, r.VALUE_RUNNING, r.VALUE_TOTAL],
}


def directory(spark: SparkSession, members: list[str]) -> DataFrame:
    rows = ", ".join(f"('{m}')" for m in members)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(fullname)")


def full_stage(spark: SparkSession, d: str) -> r.Stage:
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    return r.Stage(
        revenue=revenue_stage(spark, d),
        roads=region.select(F.col("r_name").alias("fullname"), F.col("r_regionkey").cast("string").alias("id")),
        centers=nation.select(F.col("n_name").alias("fullname"), F.col("n_nationkey").cast("string").alias("id")),
        channels=table(spark, d, "orders").select(
            F.col("o_orderpriority").alias("shortname"), F.substring("o_orderpriority", 1, 1).alias("id"),
            F.col("o_orderpriority").alias("fullname")).distinct(),
        directories={name: directory(spark, members) for name, members in MEMBERS.items()})


def layers(spark: SparkSession, d: str) -> dict[str, dict[str, DataFrame]]:
    return r.build(full_stage(spark, d), LOAD_1)


def supplier_history(spark: SparkSession, d: str) -> DataFrame:
    """Two loads of the supplier directory: all rows, then two thirds of them with new balances."""
    supplier = table(spark, d, "supplier")
    attributes = {"name": F.col("s_name"), "nation": F.col("s_nationkey"), "balance": F.col("balance")}
    first = supplier.withColumn("balance", F.col("s_acctbal").cast("decimal(15,2)"))
    second = supplier.where("s_suppkey % 3 <> 0").withColumn("balance", (F.col("s_acctbal") + 1).cast("decimal(15,2)"))
    return v.satellite(first, "supplier_hk", ["s_name"], attributes, LOAD_1, "directory").unionByName(
        v.satellite(second, "supplier_hk", ["s_name"], attributes, LOAD_2, "directory"))


def hub_distinct(spark, d):
    return v.hub(table(spark, d, "nation"), "center_hk", ["n_name"], {"center": "n_name"}, LOAD_1, "directory")


def hub_grouped(spark, d):
    return v.hub(table(spark, d, "customer"), "sector_hk", ["c_mktsegment"], {"shortname": "c_mktsegment"}, LOAD_1, SRC)


def hub_composite(spark, d):
    return r.hub_revenue(revenue_stage(spark, d), LOAD_1)


def upsert_by_key(spark, d):
    """Orders loaded in two batches into a table keyed by customer and priority: the newest order stays."""
    rows = table(spark, d, "orders").select(
        hash_key("o_custkey", "o_orderpriority").alias("bucket_hk"), "o_custkey", "o_orderpriority", "o_orderkey",
        "o_orderdate", F.col("o_totalprice").alias("total"))
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return v.upsert_by_key(rows.where(early), rows.where(~early), ["bucket_hk"],
                           [F.desc("o_orderdate"), F.desc("o_orderkey")])


def sat_measures(spark, d):
    return portable(r.sat_revenue(revenue_stage(spark, d), LOAD_1))


def rank_id(spark, d):
    return r.sat_sales_sector(revenue_stage(spark, d), LOAD_1)


def raw_table(name):
    return lambda spark, d: r.raw_vault(full_stage(spark, d), LOAD_1)[name]


def link_constant_dim_left(spark, d):
    stage = revenue_stage(spark, d)
    hub = r.hub_revenue(stage, LOAD_1)
    units = v.hub(directory(spark, [r.UNIT_THOUSAND]), "unit_hk", ["fullname"], {"fullname": "fullname"}, LOAD_1, "directory")
    return v.link_to_constant(stage, units, "unit_hk", "fullname", r.UNIT_ROUBLE, hub, "revenue_hk",
                              "link_unit_revenue_hk", LOAD_1, SRC, keep_missing=True)


def bdv_two_grain(spark, d):
    return portable(r.business_revenue(r.raw_vault(full_stage(spark, d), LOAD_1)))


def bdv_revenue(spark, d):
    return portable(layers(spark, d)["bdv"]["sat_revenue"])


def bdv_hub(spark, d):
    return layers(spark, d)["bdv"]["hub_revenue"]


def bdv_link(spark, d):
    return layers(spark, d)["bdv"]["link_road"]


def bdv_link_rekey(spark, d):
    return layers(spark, d)["bdv"]["link_sales_channel"]


def mart_fact(spark, d):
    return portable(layers(spark, d)["mart"]["pmu_revenue"])


def report_core(spark, d):
    return portable(layers(spark, d)["report"]["pmu_revenue"])


def mart_dims(spark, d):
    mart = layers(spark, d)["mart"]
    return mart["medical_center"].withColumnRenamed("medical_center_hk", "hk").withColumn("dim", F.lit("medical_center")).unionByName(
        mart["road"].withColumnRenamed("road_hk", "hk").withColumn("dim", F.lit("road")))


def report_dim(spark, d):
    return layers(spark, d)["report"]["medical_center"]


def duplicate_stage(spark, d) -> r.Stage:
    """Directories that list every name twice, with other attributes."""
    full = full_stage(spark, d)

    def twice(df: DataFrame) -> DataFrame:
        return df.withColumn("note", F.explode(F.array(F.lit("a"), F.lit("b"), F.lit(None).cast("string"))))
    return r.Stage(full.revenue, twice(full.roads), twice(full.centers), twice(full.channels), {n: twice(df) for n, df in full.directories.items()})


def bdv_duplicate_directory(spark, d):
    return portable(r.business_revenue(r.raw_vault(duplicate_stage(spark, d), LOAD_1)))


LOADED = ("hub_revenue", "sat_revenue", "hub_road", "sat_road", "link_road")


def loaded(spark, d, reload: bool) -> DataFrame:
    """Two deliveries into stored tables: orders before 1998 with all roads, then those since 1997 with all roads but one.
    ``reload`` loads the second one again, and starts the road satellite anew from it. Rows by table and load."""
    full = full_stage(spark, d)
    first = replace(full, revenue=full.revenue.where(f"`{r.YEAR}` < '1998'"))
    second = replace(full, revenue=full.revenue.where(f"`{r.YEAR}` >= '1997'"), roads=full.roads.where("id <> '0'"))
    with own_database(spark) as database:
        r.load(first, LOAD_1, database, LOADED)
        r.load(second, LOAD_2, database, LOADED)
        if reload:
            r.load(second, LOAD_2, database, LOADED)
            r.load(second, LOAD_2, database, ["sat_road"], full_refresh=True)
        parts = [spark.table(f"{database}.{n}").groupBy("load_date").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(spark.table(f"{database}.{n}").columns[0]).alias("n_keys"))
                 .withColumn("table_name", F.lit(n)) for n in LOADED]
        return materialise(reduce(DataFrame.unionByName, parts), "loaded")


def two_deliveries(spark, d) -> tuple[r.Stage, r.Stage]:
    """Years before 1998, then the even months since 1997 with one rouble more in every order: of 1997 only these come again."""
    full = full_stage(spark, d)
    again = full.revenue.where(f"`{r.YEAR}` >= '1997' AND CAST(`{r.MONTH}` AS INT) % 2 = 0")
    again = again.withColumn(r.FACT, (F.col(f"`{r.FACT}`").cast("decimal(15,2)") + 1).cast("string"))
    return replace(full, revenue=full.revenue.where(f"`{r.YEAR}` < '1998'")), replace(full, revenue=again)


def report_two_loads(spark, d):
    """Report over the stored warehouse after two deliveries, the second one loaded twice under two load times."""
    first, second = two_deliveries(spark, d)
    with own_database(spark) as database:
        for stage, load_ts in ((first, LOAD_1), (second, LOAD_2), (second, LOAD_3)):
            r.load(stage, load_ts, database)
        return materialise(portable(r.stored_layers(spark, database, LOAD_3)["report"]["pmu_revenue"]), "report")


def bdv_incremental(spark, d):
    """The stored business aggregate, brought up to date after each of two deliveries; sums that stay keep their load date."""
    first, second = two_deliveries(spark, d)
    with own_database(spark) as database:
        for stage, load_ts in ((first, LOAD_1), (second, LOAD_2)):
            r.load(stage, load_ts, database)
            r.load_business(spark, database, load_ts)
        return materialise(portable(keyed_rows(spark, f"{database}.{r.BUSINESS_TABLE}").drop("source_system")), "business")


def rank_id_two_loads(spark, d):
    """Numbers of customer names after two deliveries of orders: those of customers that were seen first stay."""
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    first = materialise(v.lasting_ids(orders.where("o_orderdate < '1993-01-01'"), None, "c_name"), "ids")
    return v.lasting_ids(orders, first, "c_name")


# ---------------------------------------------------------------- expected rows

STG = f"""
stg AS (
  SELECT n_name AS center, CAST(year(o_orderdate) AS VARCHAR) AS y, CAST(month(o_orderdate) AS VARCHAR) AS m,
         CAST(year(o_orderdate) || '-' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '-01' AS DATE) AS period,
         o_orderpriority AS channel, r_name AS road,
         CASE WHEN c_mktsegment = 'BUILDING' THEN '{r.SECTOR_PAID}' ELSE c_mktsegment END AS sector,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(15,2)) ELSE 0 END AS plan_amount,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(15,2)) ELSE 0 END AS approved_amount,
         CAST(o_totalprice AS DECIMAL(15,2)) AS fact_amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
stk AS (SELECT *, md5(concat_ws('|', center, CAST(period AS VARCHAR), channel)) AS revenue_hk FROM stg)"""

AUDIT = f"TIMESTAMP '{LOAD_1}' AS load_date, '{SRC}' AS source_system"


def _pair(entity: str, column: str) -> str:
    return f"""SELECT DISTINCT md5({column}) AS {entity}_hk, revenue_hk FROM stk"""


def _link(entity: str, column: str) -> str:
    return f"""WITH {STG}, p AS ({_pair(entity, column)})
SELECT md5(concat_ws('|', {entity}_hk, revenue_hk)) AS link_{entity}_revenue_hk, {entity}_hk, revenue_hk, {AUDIT} FROM p"""


def _constant_link(entity: str, member: str) -> str:
    return f"""WITH {STG}
SELECT md5(concat_ws('|', md5('{member}'), revenue_hk)) AS link_{entity}_revenue_hk, md5('{member}') AS {entity}_hk,
       revenue_hk, {AUDIT} FROM (SELECT DISTINCT revenue_hk FROM stk)"""


BUSINESS = f"""{STG},
hub AS (SELECT DISTINCT revenue_hk, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month FROM stk),
sat AS (SELECT revenue_hk, fact_amount FROM stk),
l_road AS ({_pair('road', 'road')}),
l_center AS ({_pair('medical_center', 'center')}),
l_sector AS (SELECT DISTINCT sector, revenue_hk FROM stk),
joined AS (
  SELECT hub.year, hub.month, fact_amount, road_hk, medical_center_hk
  FROM hub JOIN sat USING (revenue_hk) JOIN l_road USING (revenue_hk) JOIN l_center USING (revenue_hk)
  JOIN l_sector USING (revenue_hk) WHERE l_sector.sector = '{r.SECTOR_PAID}'),
grains AS (
  SELECT year, month, road_hk, medical_center_hk, md5('{r.VALUE_RUNNING}') AS value_type_hk, md5('{r.UNIT_ROUBLE}') AS unit_hk,
         md5('{r.STEP_MONTH}') AS discreteness_hk, md5('{r.METRIC_FACT}') AS metric_hk, md5('{r.DATA_DERIVED}') AS data_type_hk,
         sum(fact_amount) AS value
  FROM joined GROUP BY year, month, road_hk, medical_center_hk
  UNION ALL
  SELECT year, NULL, road_hk, medical_center_hk, md5('{r.VALUE_TOTAL}'), md5('{r.UNIT_ROUBLE}'),
         md5('{r.STEP_YEAR}'), md5('{r.METRIC_FACT}'), md5('{r.DATA_DERIVED}'), sum(fact_amount)
  FROM joined GROUP BY year, road_hk, medical_center_hk),
bdv AS (
  SELECT md5(concat_ws('|', CAST(year AS VARCHAR), CAST(month AS VARCHAR), road_hk, medical_center_hk, value_type_hk, unit_hk,
                       discreteness_hk, metric_hk, data_type_hk)) AS revenue_hk, * FROM grains)"""

MART = f"""
mart AS (
  SELECT make_date(CAST(year AS INTEGER), CAST(coalesce(month, 1) AS INTEGER), 1) AS date, road_hk, medical_center_hk, value_type_hk, discreteness_hk,
         md5('{r.UNIT_THOUSAND}') AS unit_hk, metric_hk, data_type_hk, CAST(CAST(value AS DECIMAL(18,2)) * 0.001 AS DOUBLE) AS value
  FROM bdv)"""

HISTORY = f"""
hist AS (
  SELECT md5(s_name) AS supplier_hk, TIMESTAMP '{LOAD_1}' AS load_date, s_name AS name, s_nationkey AS nation,
         CAST(CAST(s_acctbal AS DECIMAL(15,2)) AS DOUBLE) AS balance, 'directory' AS source_system FROM supplier
  UNION ALL
  SELECT md5(s_name), TIMESTAMP '{LOAD_2}', s_name, s_nationkey, CAST(CAST(s_acctbal + 1 AS DECIMAL(15,2)) AS DOUBLE), 'directory'
  FROM supplier WHERE s_suppkey % 3 <> 0)"""

LOADS = f"""{STG},
one AS (SELECT * FROM stk WHERE y < '1998'), two AS (SELECT * FROM stk WHERE y >= '1997'),
roads AS (SELECT r_name, r_regionkey <> 0 AS again FROM region),
hub_revenue AS (SELECT revenue_hk AS k, CASE WHEN revenue_hk IN (SELECT revenue_hk FROM two) THEN TIMESTAMP '{LOAD_2}' ELSE TIMESTAMP '{LOAD_1}' END AS load_date
  FROM (SELECT DISTINCT revenue_hk FROM stk)),
sat_revenue AS (SELECT revenue_hk AS k, TIMESTAMP '{LOAD_1}' AS load_date FROM one UNION ALL SELECT revenue_hk, TIMESTAMP '{LOAD_2}' FROM two),
hub_road AS (SELECT r_name AS k, CASE WHEN again THEN TIMESTAMP '{LOAD_2}' ELSE TIMESTAMP '{LOAD_1}' END AS load_date FROM roads),
sat_road AS (SELECT r_name AS k, TIMESTAMP '{LOAD_1}' AS load_date FROM roads UNION ALL SELECT r_name, TIMESTAMP '{LOAD_2}' FROM roads WHERE again),
pairs AS (SELECT DISTINCT road || revenue_hk AS k, TIMESTAMP '{LOAD_1}' AS load_date FROM one
  UNION ALL SELECT DISTINCT road || revenue_hk, TIMESTAMP '{LOAD_2}' FROM two WHERE road IN (SELECT r_name FROM roads WHERE again)),
link_road AS (SELECT k, max(load_date) AS load_date FROM pairs GROUP BY k)"""


def _loaded_sql(refreshed: bool) -> str:
    kept = f" WHERE load_date = TIMESTAMP '{LOAD_2}'" if refreshed else ""
    return f"WITH {LOADS} " + " UNION ALL ".join(
        f"SELECT load_date, count(*) AS n_rows, count(DISTINCT k) AS n_keys, '{n}' AS table_name FROM {n}{kept if n == 'sat_road' else ''} GROUP BY load_date"
        for n in LOADED)


def _business_of(rows: str) -> str:
    """The business aggregate over ``rows``, a select from stk."""
    return f"{STG}, one AS (SELECT * FROM stk WHERE y < '1998'),\n" \
        "two AS (SELECT * REPLACE (fact_amount + 1 AS fact_amount) FROM stk WHERE y >= '1997' AND CAST(m AS INTEGER) % 2 = 0),\n" \
        f"counted AS ({rows})" + BUSINESS[len(STG):].replace("FROM stk", "FROM counted")


NEWEST = _business_of("SELECT * FROM two UNION ALL SELECT * FROM one WHERE revenue_hk NOT IN (SELECT revenue_hk FROM two)")

QUERIES = {
    "report_two_loads": Query(report_two_loads, f"WITH {NEWEST}, {MART} SELECT * RENAME (medical_center_hk AS med_center_hk) FROM mart"),
    "bdv_incremental": Query(bdv_incremental, f"""SELECT n.* REPLACE (CAST(n.value AS DOUBLE) AS value),
CASE WHEN n.value = o.value THEN TIMESTAMP '{LOAD_1}' ELSE TIMESTAMP '{LOAD_2}' END AS load_date
FROM (WITH {NEWEST} SELECT * FROM bdv) n LEFT JOIN (WITH {_business_of("SELECT * FROM one")} SELECT revenue_hk, value FROM bdv) o USING (revenue_hk)"""),
    "rank_id_two_loads": Query(rank_id_two_loads, """WITH seen AS (SELECT c_name, min(o_orderdate) < TIMESTAMP '1993-01-01' AS early
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name)
SELECT c_name, row_number() OVER (ORDER BY NOT early, encode(c_name)) AS id FROM seen"""),
    "bdv_duplicate_directory": Query(bdv_duplicate_directory, f"WITH {BUSINESS} SELECT * REPLACE (CAST(value AS DOUBLE) AS value) FROM bdv"),
    "vault_two_loads": Query(lambda s, d: loaded(s, d, reload=False), _loaded_sql(refreshed=False)),
    "vault_reload": Query(lambda s, d: loaded(s, d, reload=True), _loaded_sql(refreshed=True)),
    "hub_distinct": Query(hub_distinct, f"""SELECT DISTINCT md5(n_name) AS center_hk, n_name AS center,
TIMESTAMP '{LOAD_1}' AS load_date, 'directory' AS source_system FROM nation"""),
    "hub_grouped": Query(hub_grouped, f"SELECT md5(c_mktsegment) AS sector_hk, c_mktsegment AS shortname, {AUDIT} FROM customer GROUP BY c_mktsegment"),
    "hub_composite": Query(hub_composite, f"""WITH {STG} SELECT DISTINCT revenue_hk, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month,
channel AS sales_channel, center AS medical_center, period, {AUDIT} FROM stk"""),
    "upsert_by_key": Query(upsert_by_key, """
SELECT md5(concat_ws('|', CAST(o_custkey AS VARCHAR), o_orderpriority)) AS bucket_hk, o_custkey, o_orderpriority, o_orderkey,
       o_orderdate, o_totalprice AS total
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""),
    "sat_append": Query(lambda s, d: portable(supplier_history(s, d)), f"WITH {HISTORY} SELECT * FROM hist"),
    "sat_measures": Query(sat_measures, f"""WITH {STG} SELECT revenue_hk, TIMESTAMP '{LOAD_1}' AS load_date,
CAST(plan_amount AS DOUBLE) AS plan_kdro__rub, CAST(approved_amount AS DOUBLE) AS plan_approved__rub,
CAST(fact_amount AS DOUBLE) AS fact__rub, '{SRC}' AS source_system FROM stk"""),
    "rank_id": Query(rank_id, f"""WITH {STG} SELECT md5(sector) AS sales_sector_hk, TIMESTAMP '{LOAD_1}' AS load_date, sector AS shortname,
row_number() OVER (ORDER BY encode(sector)) AS id, sector AS fullname, '{SRC}' AS source_system FROM (SELECT DISTINCT sector FROM stk)"""),
    "link_equi": Query(raw_table("link_road"), _link("road", "road")),
    "link_hash": Query(raw_table("link_sales_sector"), _link("sales_sector", "sector")),
    "link_medical_center": Query(raw_table("link_medical_center"), _link("medical_center", "center")),
    "link_sales_channel": Query(raw_table("link_sales_channel"), _link("sales_channel", "channel")),
    "link_constant_dim": Query(raw_table("link_discreteness"), _constant_link("discreteness", r.STEP_MONTH)),
    "link_constant_dim_hash": Query(raw_table("link_value_type"), _constant_link("value_type", r.VALUE_DAILY)),
    "link_constant_dim_left": Query(link_constant_dim_left, f"""WITH {STG} SELECT CAST(NULL AS VARCHAR) AS link_unit_revenue_hk,
CAST(NULL AS VARCHAR) AS unit_hk, revenue_hk, {AUDIT} FROM (SELECT DISTINCT revenue_hk FROM stk)"""),
    "bdv_two_grain": Query(bdv_two_grain, f"WITH {BUSINESS} SELECT * REPLACE (CAST(value AS DOUBLE) AS value) FROM bdv"),
    "bdv_revenue": Query(bdv_revenue, f"""WITH {BUSINESS} SELECT revenue_hk, TIMESTAMP '{LOAD_1}' AS load_date, CAST(value AS DOUBLE) AS value,
'{SRC}' AS source_system FROM bdv"""),
    "bdv_hub": Query(bdv_hub, f"WITH {BUSINESS} SELECT * EXCLUDE (value), {AUDIT} FROM bdv"),
    "bdv_link": Query(bdv_link, f"""WITH {BUSINESS} SELECT DISTINCT md5(concat_ws('|', road_hk, revenue_hk)) AS link_road_revenue_hk, road_hk,
revenue_hk, {AUDIT} FROM bdv"""),
    "bdv_link_rekey": Query(bdv_link_rekey, _link("sales_channel", "channel")),
    "sat_latest_per_key": Query(lambda s, d: portable(v.latest_per_key(supplier_history(s, d), "supplier_hk")),
                                f"WITH {HISTORY} SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY supplier_hk ORDER BY load_date DESC) = 1"),
    "sat_latest_batch": Query(lambda s, d: portable(v.latest_batch(supplier_history(s, d))),
                              f"WITH {HISTORY} SELECT * FROM hist WHERE load_date = (SELECT max(load_date) FROM hist)"),
    "mart_fact": Query(mart_fact, f"WITH {BUSINESS}, {MART} SELECT * FROM mart"),
    "report_core": Query(report_core, f"WITH {BUSINESS}, {MART} SELECT * RENAME (medical_center_hk AS med_center_hk) FROM mart"),
    "mart_dims": Query(mart_dims, """SELECT md5(n_name) AS hk, n_name AS fullname, CAST(n_nationkey AS VARCHAR) AS id, 'medical_center' AS dim FROM nation
UNION ALL SELECT md5(r_name), r_name, CAST(r_regionkey AS VARCHAR), 'road' FROM region"""),
    "report_dim": Query(report_dim, "SELECT md5(n_name) AS med_center_hk, n_name AS full_name, CAST(n_nationkey AS VARCHAR) AS id FROM nation"),
}
