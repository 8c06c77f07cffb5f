"""Profiling, type inference, typed projection and landing clean-up over stringified tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavault.catalog.base import Query, dealt, portable, table
from stratavault.functions.parsing import NBSP, NULL_TEXTS
from stratavault.operators import typing as ty


def text_lines(spark, d) -> DataFrame:
    """Line items as a landed file would show them: grouped digits, blanks, several date forms."""
    li = dealt(table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate", "l_linenumber", "l_quantity", "l_returnflag"), "l_orderkey")
    price = F.col("l_extendedprice").cast("decimal(15,2)").cast("string")
    day = F.col("l_shipdate").cast("date")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order no"),
        F.concat(F.substring(F.col("l_partkey").cast("string"), 1, 1), F.lit(NBSP),
                 F.substring(F.col("l_partkey").cast("string"), 2, 20)).alias("part"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit(" "), price)).otherwise(price).alias("price, rub."),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity").cast("decimal(15,1)").cast("string")).otherwise(" ").alias("quantity"),
        F.date_format(day, "yyyy-MM-dd").alias("iso"),
        F.date_format(day, "dd.MM.yyyy").alias("dotted"),
        F.date_format(day, "dd/MM/yyyy").alias("slashed"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 10:20:30")).alias("moment"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:20:30")).alias("moment_t"),
        F.when(F.col("l_linenumber") == 1, F.lit("итого")).otherwise(F.col("l_returnflag")).alias("mixed"),
        F.concat(F.repeat(F.lit("ю"), 30), F.col("l_returnflag")).alias("long"),
        F.lit(None).cast("string").alias("nothing"),
        (F.col("l_orderkey") + 3_000_000_000).cast("string").alias("big"),
        F.concat(F.lit("9000000000000"), F.lpad(F.col("l_orderkey").cast("string"), 7, "0")).alias("account"),
        F.lpad(F.col("l_partkey").cast("string"), 12, "0").alias("code"),
        F.concat(F.lit("1."), F.lpad(F.col("l_partkey").cast("string"), 12, "7")).alias("fine"))


def typed_cast(spark, d):
    return portable(ty.typed_projection(text_lines(spark, d)))


def landing_clean(spark, d):
    """Documents as a file would land them, with null spellings, separators and a headerless column."""
    docs = table(spark, d, "documents").select(
        "doc_id", F.col("text"), F.when(F.col("lang") == "fr", "N/A").when(F.col("lang") == "de", None)
        .otherwise(F.concat_ws("|", "lang", "source")).alias("tag"), F.lit("x").alias("Unnamed: 3"))
    return ty.landing_clean(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))


LINES_SQL = """lines AS (SELECT CAST(l_orderkey AS VARCHAR) AS "order no",
  substr(CAST(l_partkey AS VARCHAR), 1, 1) || chr(160) || substr(CAST(l_partkey AS VARCHAR), 2) AS part,
  CASE WHEN l_linenumber % 2 = 0 THEN ' ' ELSE '' END || CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS "price, rub.",
  CASE WHEN l_linenumber <> 3 THEN CAST(CAST(l_quantity AS DECIMAL(15,1)) AS VARCHAR) ELSE ' ' END AS quantity,
  strftime(l_shipdate, '%Y-%m-%d') AS iso, strftime(l_shipdate, '%d.%m.%Y') AS dotted, strftime(l_shipdate, '%d/%m/%Y') AS slashed,
  strftime(l_shipdate, '%Y-%m-%d') || ' 10:20:30' AS moment, strftime(l_shipdate, '%Y-%m-%d') || 'T10:20:30' AS moment_t,
  CASE WHEN l_linenumber = 1 THEN 'итого' ELSE l_returnflag END AS mixed, repeat('ю', 30) || l_returnflag AS long,
  CAST(NULL AS VARCHAR) AS nothing, CAST(l_orderkey + 3000000000 AS VARCHAR) AS big, '9000000000000' || lpad(CAST(l_orderkey AS VARCHAR), 7, '0') AS account,
  lpad(CAST(l_partkey AS VARCHAR), 12, '0') AS code, '1.' || lpad(CAST(l_partkey AS VARCHAR), 12, '7') AS fine FROM lineitem),
cells AS (SELECT unnest([{names}]) AS field_nm, unnest([{values}]) AS v FROM lines),
clean AS (SELECT field_nm, v, replace(replace(v, ' ', ''), chr(160), '') AS n FROM cells),
profile AS (SELECT field_nm, count(v) AS not_null_count, count(*) FILTER (trim(v, ' ') <> '') AS truly_non_empty_count, count(*) AS total_rows,
  count(*) FILTER (regexp_full_match(n, '-?[0-9]+')) AS integer_count,
  count(*) FILTER (regexp_full_match(n, '-?[0-9]+([.][0-9]+)?')) AS decimal_count,
  count(*) FILTER (regexp_full_match(n, '-?[0-9]+[.][0-9]+') AND TRY_CAST(n AS DECIMAL(38,10)) <> floor(TRY_CAST(n AS DECIMAL(38,10)))) AS fractional_values_count,
  count(*) FILTER (regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}') OR v LIKE '%-%-%T%:%:%' OR v LIKE '%-%- %:%:%') AS datetime_count,
  count(*) FILTER (regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') OR regexp_full_match(v, '[0-9]{{2}}[.][0-9]{{2}}[.][0-9]{{4}}')
                   OR regexp_full_match(v, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}')) AS date_count,
  CAST(max(strlen(v)) AS INTEGER) AS max_length,
  coalesce(CAST(max(length(split_part(ltrim(n, '-'), '.', 1))) FILTER (regexp_full_match(n, '-?[0-9]+([.][0-9]+)?')) AS INTEGER), 0) AS max_digits,
  coalesce(CAST(max(length(split_part(n, '.', 2))) FILTER (regexp_full_match(n, '-?[0-9]+[.][0-9]+')) AS INTEGER), 0) AS max_fraction,
  count(*) FILTER (regexp_full_match(n, '-?0[0-9]+([.][0-9]+)?')) AS coded_count
  FROM clean GROUP BY field_nm)"""
NAMES = ["order no", "part", "price, rub.", "quantity", "iso", "dotted", "slashed", "moment", "moment_t", "mixed", "long", "nothing", "big", "account", "code", "fine"]
LINES = LINES_SQL.format(names=", ".join(f"'{n}'" for n in NAMES), values=", ".join(f'"{n}"' for n in NAMES))


def _percent(counter: str) -> str:
    return f"round(100.0::DOUBLE * {counter} / greatest(truly_non_empty_count, 1), 1)"


NULL_LIST = ", ".join(f"'{t}'" for t in NULL_TEXTS)


def _landing_sql(text: str) -> str:
    blanked = f"regexp_replace(coalesce({text}, ''), '[\\r\\n\\t|]', ' ', 'g')"
    return f"CASE WHEN {text} IN ({NULL_LIST}) THEN '' ELSE regexp_replace({blanked}, '[\\x00-\\x1f\\x7f-\\x{{9f}}]', '', 'g') END"


QUERIES = {
    "profile_columns": Query(lambda s, d: ty.profile_columns(text_lines(s, d)), f"WITH {LINES} SELECT * FROM profile"),
    "infer_types": Query(lambda s, d: ty.infer_types(ty.profile_columns(text_lines(s, d))), f"""WITH {LINES}
SELECT field_nm, CASE WHEN truly_non_empty_count = 0 THEN 'DECIMAL(38,10)' WHEN datetime_count = truly_non_empty_count THEN 'DATETIME'
  WHEN date_count = truly_non_empty_count THEN 'DATE'
  WHEN decimal_count = truly_non_empty_count AND coded_count = 0 AND fractional_values_count > 0 AND max_digits <= 28 AND max_fraction <= 10 THEN 'DECIMAL(38,10)'
  WHEN decimal_count = truly_non_empty_count AND coded_count = 0 AND fractional_values_count = 0 AND max_digits <= 38
    THEN CASE WHEN max_digits <= 9 THEN 'INTEGER' WHEN max_digits <= 18 THEN 'BIGINT' ELSE 'DECIMAL(38,0)' END
  WHEN max_length <= 50 THEN 'VARCHAR(50)' WHEN max_length <= 65535 THEN 'VARCHAR(' || max_length || ')' ELSE 'VARCHAR(65533)' END AS field_type_nm,
not_null_count, truly_non_empty_count, integer_count, decimal_count, fractional_values_count, date_count, datetime_count, max_length, max_digits, max_fraction, coded_count,
{_percent('integer_count')} AS integer_match_pct, {_percent('decimal_count')} AS decimal_match_pct,
{_percent('fractional_values_count')} AS fractional_match_pct, {_percent('datetime_count')} AS datetime_match_pct FROM profile"""),
    "typed_cast": Query(typed_cast, f"""WITH {LINES} SELECT CAST(l."order no" AS INTEGER) AS "order no", CAST(replace(part, chr(160), '') AS INTEGER) AS part,
CAST(trim("price, rub.") AS DOUBLE) AS "price, rub.", CAST(TRY_CAST(quantity AS DOUBLE) AS INTEGER) AS quantity,
CAST(iso AS DATE) AS iso, CAST(iso AS DATE) AS dotted, CAST(iso AS DATE) AS slashed, CAST(moment AS TIMESTAMP) AS moment,
CAST(moment AS TIMESTAMP) AS moment_t, mixed, long, CAST(NULL AS DOUBLE) AS nothing,
CAST(big AS BIGINT) AS big, CAST(account AS DOUBLE) AS account, code, fine FROM lines l"""),
    "landing_clean": Query(landing_clean, f"""SELECT doc_id, {_landing_sql('text')} AS text,
CASE WHEN lang IN ('fr', 'de') THEN '' ELSE lang || ' ' || source END AS tag FROM documents"""),
}
