"""Type inference for text tables: profile every column, decide its type, cast with that type.

All columns are profiled in one aggregate pass over the melted cells; only one row per column reaches the
driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratavault.functions.parsing import any_date, clean_number, landing_text
from stratavault.operators.relational import _quoted
from stratavault.sources.tables import safe_columns

# Text forms and type names of the inference rules.
DECIMAL_FORM = r"^-?[0-9]+(\.[0-9]+)?$"
DATETIME_FORM = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}"
DATETIME_LIKE = ["%-%-%T%:%:%", "%-%- %:%:%"]
DATE_FORM = r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})$"
DECIMAL_TYPE, INTEGER_TYPE, DATE_TYPE, DATETIME_TYPE = "DECIMAL(38,10)", "INTEGER", "DATE", "DATETIME"
LONG_TYPE, WIDE_TYPE = "BIGINT", "DECIMAL(38,0)"
LONGEST_TEXT, OVERLONG_TEXT = 65535, 65533

COUNTERS = ["not_null_count", "truly_non_empty_count", "total_rows", "integer_count", "decimal_count",
            "fractional_values_count", "datetime_count", "date_count", "max_length", "max_digits", "max_fraction", "coded_count"]


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row of counters per column. Names with a back-tick or backslash are skipped.

    Cells are melted into (column, text) rows and counted per column: one scan, one small set of aggregates
    whatever the width, and per task only one partial row per column leaves for the shuffle.
    """
    names = safe_columns(columns or df.columns)
    if not names:
        raise ValueError("no columns to profile")
    texts = df.select(*[_quoted(n).cast("string").alias(n) for n in names])
    cells = texts.unpivot([], [_quoted(n) for n in names], "field_nm", "_text").withColumn("_rows", F.lit(1))
    # one weightless cell per column, so that an empty table has its columns too
    listed = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("field_nm"))
    listed = listed.select("field_nm", F.lit(None).cast("string").alias("_text"), F.lit(0).alias("_rows"))

    text, number, is_decimal = F.col("_text"), F.col("_number"), F.col("_is_decimal")
    read = (cells.unionAll(listed).withColumn("_number", clean_number(text))
            .withColumn("_is_decimal", number.rlike(DECIMAL_FORM)))
    has_point = F.contains(number, F.lit("."))
    digits = F.ltrim(F.substring_index(number, ".", 1), F.lit("-"))
    # only numbers with a point are read: the cast is made for every cell, and a failed one is the dearest
    exact = F.when(is_decimal & has_point, number).try_cast("decimal(38,10)")
    like = reduce(lambda a, b: a | b, [text.like(p) for p in DATETIME_LIKE])
    counted = read.groupBy("field_nm").agg(
        F.count(text).alias("not_null_count"),
        F.count_if(F.trim(text) != "").alias("truly_non_empty_count"),
        F.sum("_rows").alias("total_rows"),
        F.count_if(is_decimal & ~has_point).alias("integer_count"),
        F.count_if(is_decimal).alias("decimal_count"),
        F.count_if(is_decimal & has_point & (exact != F.floor(exact))).alias("fractional_values_count"),
        # every moment has a colon and every date ten bytes: cheap tests before the patterns
        F.count_if(F.contains(text, F.lit(":")) & (text.rlike(DATETIME_FORM) | like)).alias("datetime_count"),
        F.count_if((F.octet_length(text) == 10) & text.rlike(DATE_FORM)).alias("date_count"),
        F.max(F.octet_length(text)).alias("max_length"),
        F.coalesce(F.max(F.when(is_decimal, F.length(digits))), F.lit(0)).alias("max_digits"),
        F.coalesce(F.max(F.when(is_decimal & has_point, F.length(F.substring_index(number, ".", -1)))), F.lit(0)).alias("max_fraction"),
        F.count_if(is_decimal & F.startswith(digits, F.lit("0")) & (F.length(digits) > 1)).alias("coded_count"))
    return counted.select("field_nm", *COUNTERS)


def infer_types(profile: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Type per profiled column, with the match percentages.

    A form is accepted when at least ``threshold`` of the non-empty values have it (default: all of them). A number
    type is chosen wide enough for the longest digit run; numbers with leading zeros are codes and, like those too
    long for any number type, stay text.
    """
    filled = F.col("truly_non_empty_count")

    def matches(counter: str) -> Column:
        return (F.col(counter) > 0) & (F.col(counter) >= filled * F.lit(threshold))

    def percent(counter: str) -> Column:
        return F.round(F.lit(100.0) * F.col(counter) / F.greatest(filled, F.lit(1)), 1)

    length = F.col("max_length")
    sized = F.concat(F.lit("VARCHAR("), F.greatest(length, F.lit(50)).cast("string"), F.lit(")"))
    digits = F.col("max_digits")
    whole = F.when(digits <= 9, INTEGER_TYPE).when(digits <= 18, LONG_TYPE).when(digits <= 38, WIDE_TYPE)
    split = F.when((digits <= 28) & (F.col("max_fraction") <= 10), DECIMAL_TYPE)
    number = F.when(matches("decimal_count") & (F.col("coded_count") == 0), F.when(F.col("fractional_values_count") > 0, split).otherwise(whole))
    decided = (F.when(filled == 0, DECIMAL_TYPE)
               .when(matches("datetime_count"), DATETIME_TYPE)
               .when(matches("date_count"), DATE_TYPE)
               .when(number.isNotNull(), number)
               .when(length <= LONGEST_TEXT, sized).otherwise(f"VARCHAR({OVERLONG_TEXT})"))
    return profile.select(
        "field_nm", decided.alias("field_type_nm"), *[c for c in COUNTERS if c != "total_rows"],
        percent("integer_count").alias("integer_match_pct"), percent("decimal_count").alias("decimal_match_pct"),
        percent("fractional_values_count").alias("fractional_match_pct"),
        percent("datetime_count").alias("datetime_match_pct")).orderBy("field_nm")


def inferred_types(df: DataFrame, threshold: float = 1.0) -> dict[str, str]:
    """Column to type name; the only thing brought to the driver, one row per column."""
    rows = infer_types(profile_columns(df), threshold).select("field_nm", "field_type_nm").collect()
    return {r["field_nm"]: r["field_type_nm"] for r in rows}


def _whole_number(number: Column, kind: str, digits: int) -> Column:
    """The whole part of a number text. Texts of so many digits, and ten behind a point at most, always fit and are read as they are;
    any others, with an exponent, say, as decimals, which takes several times as long."""
    plain = number.rlike(rf"\A-?[0-9]{{1,{digits}}}(\.[0-9]{{0,10}})?\z")
    return F.when(plain, F.substring_index(number, ".", 1).try_cast(kind)).otherwise(number.try_cast("decimal(38,10)").try_cast(kind))


def typed(name: str, type_name: str) -> Column:
    """One text column cast to its inferred type; unreadable text becomes null."""
    kind, c = type_name.upper(), _quoted(name).cast("string")
    if kind in (INTEGER_TYPE, LONG_TYPE):
        value = _whole_number(clean_number(c), *(("int", 9) if kind == INTEGER_TYPE else ("bigint", 18)))
    elif kind.startswith("DECIMAL"):
        value = clean_number(c).try_cast(kind.lower())
    elif kind == DATE_TYPE:
        value = any_date(c)
    elif kind == DATETIME_TYPE:
        value = c.try_cast("timestamp_ntz")
    else:
        value = c
    return value.alias(name)


def typed_projection(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """The table with inferred types; unchanged when nothing could be inferred."""
    types = inferred_types(df) if types is None else types
    return df.select(*[typed(n, types[n]) for n in df.columns if n in types]) if types else df


def landing_clean(df: DataFrame, separator: str = "|", legacy: bool = False) -> DataFrame:
    """All columns as cleaned text; spreadsheet columns without a header (``Unnamed: n``) are left out."""
    named = [c for c in df.columns if not c.startswith("Unnamed:")]
    return df.select(*[landing_text(_quoted(c), separator, legacy).alias(c) for c in named])
