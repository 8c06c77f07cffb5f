from datetime import date, datetime

import pytest
from conftest import rows, values
from pyspark.sql import functions as F

from stratavault.operators import relational as rel


@pytest.fixture
def colours(frame):
    return frame("('S','red'), ('S','blue'), ('S','blue''s'), ('M','red')", "size", "color")


def test_pivot(colours):
    got = colours.groupBy("size").agg(*rel.pivot("color", ["red", "blue", "blue's"], quoted=False))
    assert got.columns == ["size", "red", "blue", "blues"]
    assert rows(got) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    like = colours.groupBy("size").agg(*rel.pivot("color", ["BLUE%"], cmp="ilike", prefix="n "))
    assert rows(like) == [("M", 0), ("S", 2)] and like.columns == ["size", "n BLUE%"]


def test_unpivot(frame):
    df = frame("(123, date'2017-01-01', 'active', 'tier 1', 'name 1', true), (567, date'2017-03-01', 'churned', 'tier 2', 'name 2', null)",
               "Customer_Id", "created_at", "sTaTuS", "segment", "name", "is_updated")
    got = rel.unpivot(df, exclude=["customer_id", "created_at"], remove=["NAME"], field_name="prop", value_name="val")
    assert got.columns == ["Customer_Id", "created_at", "prop", "val"]
    first, second = date(2017, 1, 1), date(2017, 3, 1)
    assert rows(got) == sorted([
        (123, first, "sTaTuS", "active"), (123, first, "segment", "tier 1"), (123, first, "is_updated", "true"),
        (567, second, "sTaTuS", "churned"), (567, second, "segment", "tier 2"), (567, second, "is_updated", None)], key=repr)


def test_union(frame):
    one = frame("(1,'drew','pi'), (2,'bob','e'), (3,'alice','4')", "id", "name", "favorite_number")
    two = frame("(1,'green',7), (2,'pink',13)", "id", "favorite_color", "favorite_number")
    both = {"one": one, "two": two}
    full = rel.union_relations(both, source_column=None)
    assert full.columns == ["id", "name", "favorite_number", "favorite_color"]
    assert rows(full.select("id", "name", "favorite_color", "favorite_number")) == sorted([
        (1, "drew", None, "pi"), (2, "bob", None, "e"), (3, "alice", None, "4"), (1, None, "green", "7"), (2, None, "pink", "13")], key=repr)
    for name in ("name", "NAME"):
        assert rel.union_relations(both, exclude=[name]).columns == ["source_relation", "id", "favorite_number", "favorite_color"]
    assert rows(rel.union_relations(both, include=["ID", "favorite_number"], where="id = 1", source_column="s")) == [("one", 1, "pi"), ("two", 1, "7")]
    with pytest.raises(ValueError):
        rel.union_relations(both, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        rel.union_relations(both, include=["nothing"])


def test_star(frame):
    df = frame("(1,2,3)", "field_1", "field_2", "field_3")
    assert df.select(*rel.star(df, exclude=["FIELD_3"])).columns == ["field_1", "field_2"]
    assert df.select(*rel.star(df, prefix="prefix_", suffix="_suffix")).columns[0] == "prefix_field_1_suffix"
    assert rel.filtered_columns(df, ["field_1"]) == ["field_2", "field_3"]


def test_deduplicate(frame):
    df = frame("(1,'play',1), (1,'play',2), (2,'pause',1), (3,null,5)", "user_id", "event", "version")
    assert rows(rel.deduplicate(df, ["user_id"], [F.desc("version")])) == [(1, "play", 2), (2, "pause", 1), (3, None, 5)]
    plan = rel.deduplicate(df, ["user_id"], [F.desc("version")])._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_nullcheck(frame):
    df = frame("('a','',1), ('','b',2), ('','',3)", "field_1", "field_2", "field_3")
    assert rows(rel.nullcheck_table(df)) == sorted([("a", None, 1), (None, "b", 2), (None, None, 3)], key=repr)


def test_values_and_cells(frame):
    df = frame("('a'), ('b'), ('b'), ('c'), ('c'), (null)", "field")
    assert rel.column_value_list(df, "field", 2) == ["b", "c"]
    assert rel.column_value_list(df, "field", 5, where="field = 'zz'", default=["d"]) == ["d"]
    assert rel.column_value_list(None, "field", 5, default=["d"]) == ["d"]
    with pytest.raises(ValueError):
        rel.column_value_list(None, "field", 5)
    assert values(rel.single_value(df.orderBy("field").where("field is not null"))) == ["a"]
    assert values(rel.single_value(df.where("field = 'zz'"), "none")) == ["none"]
    assert values(rel.single_value(df.where("field is null"), "none")) == [None]
    assert set(rel.column_value_list(df.where("field is not null"), "field")) == {"a", "b", "c"}
    cells = rows(rel.results_as_columns(df.where("field <> 'a'")).select("position", "column_name", "value"))
    assert cells == [(1, "field", "b"), (2, "field", "b"), (3, "field", "c"), (4, "field", "c")]


def test_results_of_any_length(spark):
    many = spark.range(12_345).selectExpr("id % 7 AS a", "IF(id % 5 = 0, null, cast(id as string)) AS b")
    cells = rel.results_as_columns(many)
    assert cells.count() == 24_690 and values(cells.where("column_name = 'a'").select("position"))[-1] == 9999
    assert cells.where("column_name = 'a' AND position = 1").first()["value"] == "0"


def test_series_and_spine(spark):
    assert values(rel.generate_series(spark, 10)) == sorted(range(1, 11), key=repr)
    with pytest.raises(ValueError):
        rel.generate_series(spark, 0)
    days = rel.date_spine(spark, "day", date(2018, 1, 1), date(2018, 1, 10))
    assert [r[0] for r in days.orderBy("date_day").collect()] == [date(2018, 1, d) for d in range(1, 10)]
    months = rel.date_spine(spark, "month", date(2023, 11, 15), date(2024, 2, 1))
    assert [r[0] for r in months.orderBy(months.columns[0]).collect()] == [date(2023, 11, 15), date(2023, 12, 15), date(2024, 1, 15)]
    hours = rel.date_spine(spark, "hour", datetime(2024, 1, 1, 22), datetime(2024, 1, 2, 1))
    assert hours.count() == 3
    assert rel.intervals_between(date(2024, 1, 31), date(2024, 2, 1), "month") == 1
    assert rel.intervals_between(date(2024, 1, 7), date(2024, 1, 8), "week") == 1


def test_group_by_n(frame):
    df = frame("(1,'a',5), (1,'a',6), (2,'b',7)", "x", "y", "z")
    assert rows(rel.group_by_n(df, 2).agg(F.sum("z"))) == [(1, "a", 11), (2, "b", 7)]


def test_difference(frame):
    a, b = frame("(1,null), (1,null), (2,'x')", "k", "v"), frame("(1,null), (3,'y')", "k", "v")
    assert rows(rel.tagged_difference(a, b)) == [("a_minus_b", 2, "x"), ("b_minus_a", 3, "y")]
    assert rows(rel.difference(a, b)) == [(2, "x")]
