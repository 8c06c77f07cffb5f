"""Each check with data that passes and data that fails."""

import pytest
from conftest import rows, values

from stratavault.operators import quality as q


def test_keys(frame):
    df = frame("(1), (2), (2), (null), (null)", "id")
    assert q.not_null(df, "id").count() == 2
    assert rows(q.unique(df, "id")) == [(2, 2)]
    other = frame("(1), (3), (null)", "k")
    assert values(q.relationships(df, "id", other, "k")) == [2, 2]
    assert q.relationships(other.where("k = 1"), "k", df, "id").count() == 0


def test_relationships_where(frame):
    one, two = frame("(1), (2), (3)", "id"), frame("(1), (2), (4)", "id")
    assert q.relationships_where(two, "id", one, "id", from_condition="id <> 4").count() == 0
    assert values(q.relationships_where(two, "id", one, "id")) == [4]
    assert values(q.relationships_where(two, "id", one, "id", "id <> 4", "id <> 1")) == [1]


def test_accepted_range(frame):
    df = frame("(-1), (11), (null)", "id")
    assert q.accepted_range(df, "id", -1, 11).count() == 0
    assert q.accepted_range(df, "id", -2, 11.1, inclusive=False).count() == 0
    assert q.accepted_range(df.where("id <> -1"), "id", 0).count() == 0
    assert values(q.accepted_range(df, "id", -1, 11, inclusive=False)) == [-1, 11]
    assert q.accepted_range(df, "id").count() == 0


def test_at_least_one(frame):
    df = frame("('a', 1), ('b', null)", "field", "value")
    assert q.at_least_one(df, "field").count() == 0
    assert q.at_least_one(df, "value").count() == 0
    assert rows(q.at_least_one(df, "value", ["field"])) == [("b", 0)]
    assert rows(q.at_least_one(df.where("value is null"), "value")) == [(0,)]


def test_cardinality(frame):
    a = frame("(1), (2), (3)", "same_name")
    b = frame("(1,2), (2,3), (3,1)", "same_name", "different_name")
    assert q.cardinality_equality(a, "same_name", b, "same_name").count() == 0
    assert q.cardinality_equality(a, "same_name", b, "different_name").count() == 0
    assert rows(q.cardinality_equality(a, "same_name", a.unionAll(a.where("same_name = 1")), "same_name")) == [
        ("a_minus_b", 1, 1), ("b_minus_a", 1, 2)]


def test_equality(frame):
    a = frame("(1,1,3), (1,2,1), (2,3,3)", "col_a", "col_b", "col_c")
    b = frame("(1,1,2), (1,2,2), (2,3,2)", "col_a", "col_b", "col_c")
    assert q.equality(a, a).count() == 0
    assert q.equality(a, b).count() == 6
    assert q.equality(a, b, compare_columns=["col_a", "col_b"]).count() == 0
    assert q.equality(a, b, exclude_columns=["COL_C"]).count() == 0
    with pytest.raises(ValueError):
        q.equality(a, b, ["col_a"], ["col_b"])
    with pytest.raises(ValueError):
        q.equality(a, b.drop("col_c"))


def test_equality_precision(frame):
    a = frame("('x', 62.3888186D, 'a'), ('y', 81.2511656D, 'a')", "id", "n", "ignored")
    b = frame("('x', 62.3888187D, 'b'), ('y', 81.2511657D, 'b')", "id", "n", "ignored")
    assert q.equality(a, b, exclude_columns=["ignored"], precision=4).count() == 0
    assert q.equality(a, b, compare_columns=["id", "n"], precision=4).count() == 0
    assert q.equality(a, b, exclude_columns=["ignored"], precision=8).count() == 4
    assert q.equality(a, b, precision=4).count() == 4


def test_row_counts(frame):
    small, large = frame("(1,1), (1,2), (1,3)", "col_a", "field"), frame("(1,1), (1,2), (1,3), (1,4)", "col_a", "field")
    assert rows(q.equal_rowcount(small, small)) == [(3, 3, 0)]
    assert rows(q.equal_rowcount(small, large, ["col_a"])) == [(1, 3, 1, 4, 1)] or rows(
        q.equal_rowcount(small, large, ["col_a"]).select("count_a", "count_b", "diff_count")) == [(3, 4, 1)]
    assert rows(q.fewer_rows_than(small, large).select("row_count_delta")) == [(0,)]
    assert rows(q.fewer_rows_than(small, small, ["col_a"]).select("row_count_delta")) == [(1,)]
    assert rows(q.fewer_rows_than(large, small).select("row_count_delta")) == [(1,)]
    extra = large.unionAll(frame("(9, 9)", "col_a", "field"))
    lone = q.equal_rowcount(extra, large, ["col_a"]).where("col_a_a = 9")
    assert values(lone.select("diff_count")) == [None]
    assert values(q.equal_rowcount(extra, large, ["col_a"], strict=True).where("col_a_a = 9").select("diff_count")) == [1]


def test_expressions(frame):
    df = frame("(0D,1D), (1D,0D), (0.5D,0.5D), (null,1D)", "col_a", "col_b")
    assert q.expression_is_true(df, "col_a + col_b = 1").count() == 0
    assert q.expression_is_true(df.where("col_b = 0.5"), "col_a = 0.5").count() == 0
    assert q.expression_is_true(df, "+ col_b = 1", "col_a").count() == 0
    assert q.expression_is_true(df, "= 0.5", "col_a").count() == 2


def test_values(frame):
    df = frame("(1,'Barcelona'), (2,'London'), (3,'London'), (4,'  ')", "id", "city")
    assert q.not_accepted_values(df, "city", ["Madrid", "Berlin"]).count() == 0
    assert values(q.not_accepted_values(df, "city", ["London"])) == ["London"]
    assert q.not_empty_string(df, "city").count() == 1
    assert q.not_empty_string(df, "city", trim_whitespace=False).count() == 0


def test_not_constant(frame):
    df = frame("(1,1), (1,1), (1,2), (2,null)", "col_a", "field")
    assert q.not_constant(df, "field").count() == 0
    assert rows(q.not_constant(df.where("field = 1"), "field", ["col_a"])) == [(1, 1)]


def test_not_null_proportion(frame):
    df = frame("(1,1), (null,2), (null,3), (4,4), (5,5), (6,6), (null,7), (null,8), (null,null), (10,10)", "point_5", "point_9")
    assert q.not_null_proportion(df, "point_5", 0.5, 0.5).count() == 0
    assert q.not_null_proportion(df, "point_9", 0.9).count() == 0
    assert q.not_null_proportion(df, "point_5", 0, group_by=["point_9"]).count() == 0
    assert rows(q.not_null_proportion(df, "point_5", 0.6)) == [(0.5,)]


def test_ranges(frame):
    df = frame("(0,1), (1,2), (2,4)", "lower_bound", "upper_bound")
    assert q.mutually_exclusive_ranges(df, "lower_bound", "upper_bound", gaps="not_allowed").count() == 0
    assert q.mutually_exclusive_ranges(df, "lower_bound", "upper_bound", gaps="required").count() == 2
    with pytest.raises(ValueError):
        q.mutually_exclusive_ranges(df, "lower_bound", "upper_bound", gaps="maybe")


def test_ranges_by_group(frame, spark):
    from pyspark.sql import functions as F
    df = frame("(1, date'2019-01-01', date'2019-02-01'), (1, date'2019-03-03', date'2019-04-01'), "
               "(2, date'2019-05-06', date'2019-07-02'), (2, date'2019-07-03', null)", "subscription_id", "valid_from", "valid_to")
    open_end = F.coalesce("valid_to", F.lit("2099-01-01").cast("date"))
    for gaps in ("allowed", "required"):
        assert q.mutually_exclusive_ranges(df, "valid_from", open_end, "subscription_id", gaps).count() == 0
    assert q.mutually_exclusive_ranges(df, "valid_from", open_end, "subscription_id", "not_allowed").count() == 2
    assert q.mutually_exclusive_ranges(df, "valid_from", "valid_to", "subscription_id").count() == 1


def test_zero_length_ranges(frame):
    df = frame("(3, date'2020-05-06', date'2020-05-07'), (3, date'2020-05-08', date'2020-05-10'), (3, date'2020-05-08', date'2020-05-08'), "
               "(3, date'2020-05-12', date'2020-05-15'), (4, date'2020-06-06', date'2020-06-07'), (4, date'2020-06-08', date'2020-06-08'), "
               "(4, date'2020-06-09', date'2020-06-10')", "id", "f", "t")
    assert q.mutually_exclusive_ranges(df, "f", "t", "id", zero_length_range_allowed=True).count() == 0
    assert q.mutually_exclusive_ranges(df, "f", "t", "id").count() == 2


def test_equal_ranges_overlap(frame):
    df = frame("(1, 2), (1, 2), (1, 2), (2, 3)", "f", "t")
    bad = q.mutually_exclusive_ranges(df, "f", "t")
    assert bad.count() == 2 and values(bad.select("next_lower_bound")) == [1, 1]


def test_sequences(frame):
    df = frame("(1,2), (1,4), (1,6), (2,8), (2,10)", "col_a", "my_even_sequence")
    assert q.sequential_values(df, "my_even_sequence", 2).count() == 0
    assert q.sequential_values(df, "my_even_sequence", 2, group_by=["col_a"]).count() == 0
    assert q.sequential_values(df, "my_even_sequence", 1).count() == 4
    assert rows(q.sequential_values(df.unionAll(df.where("my_even_sequence = 4")), "my_even_sequence", 2)) == [(4, 4)]
    hours = frame("(timestamp_ntz'2021-01-01 00:00'), (timestamp_ntz'2021-01-01 01:00'), (timestamp_ntz'2021-01-01 02:00')", "my_timestamp")
    assert q.sequential_values(hours, "my_timestamp", 1, "hour").count() == 0
    assert q.sequential_values(hours, "my_timestamp", 1, "day").count() == 2


def test_recency(frame):
    df = frame("('a', timestamp_ntz'2024-01-30 12:00'), ('b', timestamp_ntz'2024-01-01 12:00')", "g", "at")
    assert q.recency(df, "at", "day", 1, as_of="2024-01-31 10:00:00").count() == 0
    assert q.recency(df, "at", "hour", 1, as_of="2024-01-31 10:00:00").count() == 1
    assert values(q.recency(df, "at", "day", 1, group_by=["g"], as_of="2024-01-31 10:00:00").select("g")) == ["b"]
    assert q.recency(df, "at", "day", 1, ignore_time_component=True, as_of="2024-01-31 23:00:00").count() == 0
    assert q.recency(df, "at", "day", 1, as_of="2024-01-31 23:00:00").count() == 1
    assert q.recency(df, "at", "day", 1).count() == 1


def test_schema_and_columns(frame):
    df = frame("(1,1,'x'), (1,2,null), (null,2,'y')", "a", "b", "c")
    assert q.columns_match_set(df, ["A", "b", "c"]).count() == 0
    assert rows(q.columns_match_set(df, ["a", "b", "d"])) == [("c", "unexpected"), ("d", "missing")]
    assert q.columns_match_set(df, ["A", "b", "c"], ignore_case=False).count() == 2
    assert q.columns_equal(df, "a", "b").count() == 1


def test_summary_status(frame):
    df = frame("(1), (null)", "id")
    bad = q.not_null(df, "id")
    got = rows(q.summary([q.Check("soft", bad), q.Check("hard", bad, "error"), q.Check("none", bad.limit(0), "error"),
                          q.Check("negative", bad, "error", "< 0", "< 1"), q.Check("tolerant", bad, "error", "> 0", "> 10")]))
    assert got == [("hard", 1, "error", "error"), ("negative", 1, "error", "pass"), ("none", 0, "error", "pass"),
                   ("soft", 1, "warn", "warn"), ("tolerant", 1, "error", "warn")]
    pair = q.equality(df, df.where("id = 1"))
    assert q.summary([q.Check("eq", pair, failures=q.FAIL_CALCULATIONS["equality"])]).first()["failures"] == 2
