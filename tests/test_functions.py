import pytest
from conftest import rows, values
from pyspark.sql import functions as F

from stratavault.functions import keys, parsing, scalars


def test_surrogate_key_known_hashes(frame):
    df = frame("('a','b','c'), ('a',null,'c'), (null,null,'c'), (null,null,null)", "x", "y", "z")
    assert set(values(df.select(keys.surrogate_key(["x"])))) == {
        "0cc175b9c0f1b6a831c399e269772661", "f14cc5cdce0420f4a5a6b6d9d7b85f39"}
    assert set(values(df.select(keys.surrogate_key(["x", "y", "z"])))) == {
        "7b193b3d33184464106f41ddf733783b", "4f32a73dc87b7bbb7a654d8898d58c7e",
        "d9c538b129f1a3ad6ecfe55345c32a05", "2fa5491950d66d153d23cfbcfea4e164"}


def test_hash_key_separates_parts(frame):
    df = frame("('ab','c'), ('a','bc')", "x", "y")
    assert len(set(values(df.select(keys.hash_key("x", "y"))))) == 2
    assert values(frame("(cast(null as string))", "x").select(keys.hash_key("x"))) == [None]


def test_first_of_month(frame):
    df = frame("('2024','3'), ('2024','12'), ('2024','13'), ('x','1')", "y", "m")
    assert sorted(str(v) for v in values(df.select(keys.first_of_month("y", "m")))) == ["2024-03-01", "2024-12-01", "None", "None"]


def test_safe_arithmetic(frame):
    df = frame("(1,2,3), (1,null,3), (null,null,2), (null,null,null)", "a", "b", "c")
    assert values(df.select(scalars.safe_add("a", "b", "c"))) == [0, 2, 4, 6]
    df = frame("(3,2,1), (4,null,3), (null,2,-2), (null,null,null)", "a", "b", "c")
    assert sorted(values(df.select(scalars.safe_subtract("a", "b", "c")))) == [0, 0, 0, 1]
    df = frame("(6,0), (10,5), (null,null), (17,null), (null,9), (0,5)", "n", "d")
    assert [r[0] for r in df.select(scalars.safe_divide("n", "d")).collect()] == [None, 2.0, None, None, None, 0.0]
    assert [r[0] for r in df.select(scalars.safe_divide(F.col("n") - 6, F.col("d") * 2)).collect()][:2] == [None, 0.4]


def test_width_bucket(frame):
    df = frame("(11D), (24D), (31D), (39.99D), (40D), (47D), (55D), (61D)", "v")
    assert [r[0] for r in df.select(scalars.width_bucket("v", 20.0, 60.0, 4)).collect()] == [0, 1, 2, 2, 3, 3, 4, 5]


def test_haversine(frame):
    df = frame("(0D, 0D, 0D, 90D)", "a", "b", "c", "d")
    assert round(df.select(scalars.haversine_distance("a", "b", "c", "d", "km")).first()[0]) == 10013
    assert round(df.select(scalars.haversine_distance("a", "b", "c", "d")).first()[0]) == 6222
    with pytest.raises(ValueError):
        scalars.haversine_distance("a", "b", "c", "d", "furlong")


@pytest.mark.parametrize("url,host,path", [
    ("shop.invalid?from=mail&kind=b", "shop.invalid", ""),
    ("http://one.invalid/a/07/page-two/", "one.invalid", "a/07/page-two/"),
    ("https://two.invalid/b/c/d?y=2", "two.invalid", "b/c/d"),
    ("android-app://three.invalid/", "three.invalid", None),
    ("four.invalid/e/file.css?from=x", "four.invalid", "e/file.css"),
])
def test_url_parts(spark, url, host, path):
    df = spark.range(1).select(F.lit(url).alias("u"))
    assert df.select(scalars.url_host("u")).first()[0] == host
    if path is not None:
        assert df.select(scalars.url_path("u")).first()[0] == path


def test_url_parameter(frame):
    df = frame("('http://q.invalid/p?kind=tree'), ('http://q.invalid/p?kind=tree&shade=green')", "u")
    got = rows(df.select(scalars.url_parameter("u", "kind"), scalars.url_parameter("u", "shade")))
    assert got == [("tree", "green"), ("tree", None)]


def test_slugify(frame):
    df = frame("(''), (null), ('?Two w0rds-more'), ('2Two w0rds-more')", "s")
    assert [r[0] for r in df.select(scalars.slugify("s")).collect()] == ["", "", "two_w0rds_more", "_2two_w0rds_more"]
    assert [scalars.slug(s) for s in ("", None, "?Two w0rds-more", "2Two w0rds-more")] == ["", "", "two_w0rds_more", "_2two_w0rds_more"]


def parsed(spark, parser, *texts):
    data = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "i int, t string").select("i", parser("t").alias("v"))
    return [None if r["v"] is None else str(r["v"]) for r in sorted(df.collect())]


def test_amounts(spark):
    texts = ("61\u00a0500", "73,19", "8 642,5", "30.5", "", "n/a", None)
    assert parsed(spark, parsing.amount, *texts) == ["61500.0", "73.19", "8642.5", "30.5", None, None, None]
    assert parsed(spark, lambda c: parsing.amount(c, legacy=True), "73,19", "1 0,5") == ["7319.0", "105.0"]


def test_moments(spark):
    assert parsed(spark, parsing.local_timestamp, "07.08.2033 21:34:55", "07.08.2033 1:34:55", "2033-08-07 21:34:55", "32.08.2033 21:34:55", "") == [
        "2033-08-07 21:34:55", None, None, None, None]
    assert parsed(spark, parsing.loose_timestamp, "09.04.2032 5:07:08", "20.05.2031 13:14:15", "01.10.2035 0:00:00", "x\n09.04.2032 5:07:08") == [
        "2032-04-09 05:07:08", "2031-05-20 13:14:15", "2035-10-01 00:00:00", None]
    assert parsed(spark, parsing.iso_timestamp, "2031-02-03T04:05:06", "0001-01-01T00:00:00", "2031-02-03", "2031-02-03T04:05:06Z") == [
        "2031-02-03 04:05:06", None, None, None]
    assert parsed(spark, parsing.any_date, "2034-06-17", "17.06.2034", "17/06/2034", "7.6.2034", "x") == ["2034-06-17"] * 3 + [None, None]


def test_flags_and_integers(spark):
    assert parsed(spark, parsing.boolean, "true", "False", "1", "yes", None) == ["True", "False", None, None, None]
    assert parsed(spark, parsing.integer, " 12 ", "-3", "1.5", "99999999999", "") == ["12", "-3", None, None, None]


def test_landing_text(spark):
    texts = ("a\r\nb\tc|d", "NaN", "#N/A", None, "x\x00\x07\x85y", "nano")
    assert parsed(spark, parsing.landing_text, *texts) == ["a  b c d", "", "", "", "xy", "nano"]
    assert parsed(spark, lambda c: parsing.landing_text(c, legacy=True), "a\r\nb") == ["ab"]
    assert parsed(spark, lambda c: parsing.landing_text(c, separator=";"), "a;b|c") == ["a b|c"]


def test_file_names(spark):
    guid = "12345678-1234-1234-1234-123456789abc"
    keys_ = [f"Отчёт 1.v2_--_ivan.p_--_{guid}.xlsx", f"a_--_b_--_c_--_{guid}.xlsx", "plain.xlsx", f"a_--_b_--_{guid[:-1]}.xlsx"]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys_)], "i int, k string")
    parts = parsing.file_name_parts("k")
    got = [tuple(r)[1:] for r in sorted(df.select("i", *[parts[p].alias(p) for p in ("file_name", "user_name", "guid")]).collect())]
    assert got[0] == ("Отчёт 1.v2.xlsx", "ivan.p", guid)
    assert got[1:] == [(k, "unknown", "unknown") for k in keys_[1:]]
