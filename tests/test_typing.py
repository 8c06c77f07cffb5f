import re

from datetime import date, datetime
from decimal import Decimal

from conftest import rows

from pyspark.sql import functions as F

from stratavault.operators import typing as ty

NB = " "


def sample(spark):
    data = [("1", "1 000", "1.50", "2024-01-02", "02.01.2024", "02/01/2024", "2024-01-02 10:11:12", "2024-01-02T10:11:12", "a", "", None),
            ("2", f"2{NB}000", "2", "2024-02-03", "03.02.2024", "03/02/2024", "2024-02-03 10:11", "2024-02-03T10:11:12", "1", " ", None),
            ("-3", None, "3.0", "", None, "04/02/2024", "2024-02-03 10:11:12.5", "2024-02-03T10:11:13", "я" * 30, None, None)]
    names = ["whole", "spaced", "money", "iso", "dotted", "slashed", "moment", "pandas", "text", "blank", "null"]
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))


def test_types(spark):
    types = ty.inferred_types(sample(spark))
    assert types == {"whole": "INTEGER", "spaced": "INTEGER", "money": "DECIMAL(38,10)", "iso": "DATE", "dotted": "DATE", "slashed": "DATE",
                     "moment": "DATETIME", "pandas": "DATETIME", "text": "VARCHAR(60)", "blank": "DECIMAL(38,10)", "null": "DECIMAL(38,10)"}


def test_counters(spark):
    got = {r["field_nm"]: r for r in ty.profile_columns(sample(spark)).collect()}
    assert (got["iso"]["not_null_count"], got["iso"]["truly_non_empty_count"], got["iso"]["date_count"]) == (3, 2, 2)
    assert (got["money"]["integer_count"], got["money"]["decimal_count"], got["money"]["fractional_values_count"]) == (1, 3, 1)
    assert got["text"]["max_length"] == 60 and got["null"]["max_length"] is None
    shares = {r["field_nm"]: r for r in ty.infer_types(ty.profile_columns(sample(spark))).collect()}
    assert shares["money"]["integer_match_pct"] == 33.3 and shares["text"]["decimal_match_pct"] == 33.3


def test_projection(spark):
    got = ty.typed_projection(sample(spark))
    assert dict(got.dtypes)["money"] == "decimal(38,10)" and dict(got.dtypes)["moment"] == "timestamp_ntz"
    first = next(r for r in got.collect() if r["whole"] == 1)
    assert (first["spaced"], first["money"], first["dotted"], first["slashed"]) == (1000, Decimal("1.5"), date(2024, 1, 2), date(2024, 1, 2))
    assert first["pandas"] == datetime(2024, 1, 2, 10, 11, 12) and first["text"] == "a" and first["blank"] is None


def test_threshold_and_bad_values(spark):
    df = spark.createDataFrame([(str(i),) for i in range(95)] + [("x",)] * 5, "n string")
    assert ty.inferred_types(df) == {"n": "VARCHAR(50)"}
    assert ty.inferred_types(df, threshold=0.9) == {"n": "INTEGER"}
    assert ty.typed_projection(df, {"n": "INTEGER"}).where("n is null").count() == 5


def test_wide_table_and_odd_names(spark):
    names = [f"c {i}, руб." for i in range(120)]
    df = spark.range(3).selectExpr(*[f"cast(id + {i} as string) AS `{n}`" for i, n in enumerate(names)])
    assert set(ty.inferred_types(df).values()) == {"INTEGER"} and len(ty.inferred_types(df)) == 120
    odd = spark.range(2).selectExpr("cast(id as string) AS good", "cast(id as string) AS `back``tick`", "cast(id as string) AS `back\\slash`")
    assert list(ty.inferred_types(odd)) == ["good"]
    assert ty.typed_projection(odd).columns == ["good"]
    assert ty.typed_projection(odd, {}).columns == odd.columns


def test_landing(spark):
    df = spark.createDataFrame([("a|b", 1, None), ("null", None, "x")], "`Имя, руб.` string, n int, `Unnamed: 2` string")
    got = ty.landing_clean(df)
    assert got.columns == ["Имя, руб.", "n"] and rows(got) == [("", ""), ("a b", "1")]


def test_only_numbers_with_a_point_are_read_as_decimals(spark, frame):
    """Other cells are not given to the cast, and the counts are those of the numbers alone."""
    df = frame("('abc'), ('12'), ('1.50'), ('2.0'), ('1.00000000001'), ('-0.9'), ('1.5.2'), ('x.5'), (null)", "a")
    row = ty.profile_columns(df).collect()[0]
    assert (row["fractional_values_count"], row["integer_count"], row["decimal_count"]) == (2, 1, 5)
    plan = ty.profile_columns(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "try_cast" in plan and all("Contains(" in before[-60:] and before.endswith("THEN ") for before in re.split(r"(?:cast\(|FLOOR\()*try_cast\(", plan)[:-1])


def test_whole_numbers_are_read_as_before(spark, frame):
    texts = ["12", "-7", " 1 2", "12.0", "12.9", "-0.9", "5.", ".5", "1e3", "999999999", "2147483648", "-2147483648", "1234567890123456789",
             "12345678901234567890", "1.99999999999", "x", "", "-", "--1", "+4", "1\n", "12\t", "١"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "a string")
    for kind, into in ((ty.INTEGER_TYPE, "int"), (ty.LONG_TYPE, "bigint")):
        old = ty.clean_number(F.col("a")).try_cast("decimal(38,10)").try_cast(into)
        assert df.where(~ty.typed("a", kind).eqNullSafe(old)).count() == 0
    plan = df.select(ty.typed("a", ty.INTEGER_TYPE))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan.upper()
