"""Data-quality checks. Each returns the violating rows (or groups), so an empty result means the check holds.

Checks that compare counts, keys or neighbours fold equal rows before anything is shuffled; ordered checks
work in value slices (see ``ordering``), so one dominant key or group never lands in a single task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratavault.functions.keys import ColumnLike, _column
from stratavault.functions.scalars import slug
from stratavault.operators.ordering import distinct_with_counts, expand_copies, with_neighbour
from stratavault.operators.relational import _quoted, tagged_difference


def _condition(c: str | Column) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(_quoted(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls do not count."""
    counted = df.where(_quoted(column).isNotNull()).groupBy(_quoted(column).alias("unique_field"))
    return counted.agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def unique_combination_of_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return distinct_with_counts(df, columns).where("_copies > 1").drop("_copies")


def relationships_where(df: DataFrame, column: str, to: DataFrame, field: str, from_condition: str | None = None,
                        to_condition: str | None = None) -> DataFrame:
    """One row ``id`` per row whose non-null key has no partner. Keys are folded before the join."""
    rows = df.where(from_condition) if from_condition else df
    partners = to.where(to_condition) if to_condition else to
    keys = distinct_with_counts(rows.select(_quoted(column).alias("id")).where("id IS NOT NULL"), ["id"])
    known = partners.select(_quoted(field).alias("id")).where("id IS NOT NULL").distinct()
    return expand_copies(keys.join(known, "id", "left_anti"))


def relationships(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    return relationships_where(df, column, to, field)


def accepted_range(df: DataFrame, column: ColumnLike, min_value: object = None, max_value: object = None,
                   inclusive: bool = True) -> DataFrame:
    """Rows outside the range; nulls pass."""
    return df.where(outside(column, min_value, max_value, inclusive))


def not_accepted_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """The forbidden values that occur, each once."""
    return df.where(_quoted(column).isin(list(values))).select(_quoted(column).alias("value_field")).distinct()


def _grouped(df: DataFrame, group_by: Sequence[str]):
    return df.groupBy(*[_quoted(c) for c in group_by])


def not_constant(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups in which the column has exactly one non-null value."""
    counted = _grouped(df, group_by).agg(F.count_distinct(_quoted(column)).alias("filler_column"))
    return counted.where("filler_column = 1")


def at_least_one(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Groups without any non-null value. Without groups the scan stops at the first value found."""
    rows = df.select(_quoted(column)) if not group_by else df
    rows = rows if group_by else rows.where(_quoted(column).isNotNull()).limit(1)
    return _grouped(rows, group_by).agg(F.count(_quoted(column)).alias("filler_column")).where("filler_column = 0")


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    text = F.trim(_quoted(column)) if trim_whitespace else _quoted(column)
    return df.where(text == "").select(text.alias(column))


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0,
                        group_by: Sequence[str] = ()) -> DataFrame:
    """Groups whose share of non-null values is outside the limits."""
    share = F.count(_quoted(column)) / F.count(F.lit(1))
    found = _grouped(df, group_by).agg(share.alias("not_null_proportion"))
    return found.where((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    """Rows for which the expression (or ``column expression``) is false; unknown passes."""
    return df.where(~F.expr(f"`{column}` {expression}" if column else expression))


def _value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(_quoted(column).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """(value, count) pairs that one side has and the other has not."""
    return tagged_difference(_value_counts(df, column), _value_counts(to, field))


def _counts_side_by_side(df: DataFrame, other: DataFrame, names: tuple[str, str], group_by: Sequence[str]) -> DataFrame:
    """Row counts of both sides per group; a group that only one side has leaves the other side null.

    Group columns appear as ``<name>_a`` and ``<name>_b``. Both sides are aggregated on the join key, so the
    join needs no further shuffle. A null group never has a partner.
    """
    a = _grouped(df, group_by).agg(F.count(F.lit(1)).alias(names[0]))
    b = _grouped(other, group_by).agg(F.count(F.lit(1)).alias(names[1]))
    if not group_by:
        return a.withColumn(names[1], b.scalar())
    a = a.withColumnsRenamed({c: f"{c}_a" for c in group_by})
    b = b.withColumnsRenamed({c: f"{c}_b" for c in group_by})
    return a.join(b, [F.col(f"{c}_a") == F.col(f"{c}_b") for c in group_by], "full")


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Counts of both sides with ``diff_count``; the check fails when the sum of ``diff_count`` is not 0.

    A group missing on one side gives null, which counts as 0 unless ``strict``.
    """
    both = _counts_side_by_side(df, compare, ("count_a", "count_b"), group_by)
    a, b = F.col("count_a"), F.col("count_b")
    if strict:
        a, b = F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))
    return both.withColumn("diff_count", F.abs(a - b))


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Counts of both sides with ``row_count_delta``: 0 when there are fewer rows, 1 when equal, else the excess."""
    both = _counts_side_by_side(df, compare, ("count_our_model", "count_comparison_model"), group_by)
    ours, theirs = F.col("count_our_model"), F.col("count_comparison_model")
    return both.withColumn("row_count_delta", F.when(ours > theirs, ours - theirs).when(ours == theirs, F.lit(1).cast("bigint"))
                           .otherwise(F.lit(0).cast("bigint")))


def equality(df: DataFrame, compare: DataFrame, compare_columns: Sequence[str] = (), exclude_columns: Sequence[str] = (),
             precision: int | None = None) -> DataFrame:
    """Distinct rows that only one side has, tagged ``a_minus_b`` or ``b_minus_a``; numbers rounded on request."""
    if compare_columns and exclude_columns:
        raise ValueError("give either compare_columns or exclude_columns, not both")
    if compare_columns:
        names = list(compare_columns)
    else:
        dropped = {c.lower() for c in exclude_columns}
        names = [c for c in df.columns if c.lower() not in dropped]
        theirs = {c.lower() for c in compare.columns} - dropped
        if {c.lower() for c in names} != theirs:
            raise ValueError(f"columns differ: {sorted({c.lower() for c in names} ^ theirs)}")

    def column(side: DataFrame, name: str) -> Column:
        kind = side.select(_quoted(name)).schema.fields[0].dataType
        if precision is None or not isinstance(kind, (T.FractionalType, T.IntegralType)):
            return _quoted(name).alias(name)
        return F.round(_quoted(name).cast(f"decimal(38,{max(precision, 10)})"), precision).alias(name)

    return tagged_difference(df.select(*[column(df, n) for n in names]), compare.select(*[column(compare, n) for n in names]))


RANGE_RULES = {"not_allowed": ("=", "equal_to"), "allowed": ("<=", "less_than_or_equal_to"), "required": ("<", "less_than")}


def mutually_exclusive_ranges(df: DataFrame, lower: ColumnLike, upper: ColumnLike, partition_by: str | None = None,
                              gaps: str = "allowed", zero_length_range_allowed: bool = False,
                              slices: int | None = None) -> DataFrame:
    """Ranges that are empty or reversed, or that do not end before the next one of their partition starts."""
    if gaps not in RANGE_RULES:
        raise ValueError(f"gaps must be one of {sorted(RANGE_RULES)}, got {gaps!r}")
    group = [partition_by] if partition_by else []
    bounds = ["lower_bound", "upper_bound"]
    ranges = df.select(*[_quoted(g) for g in group], _column(lower).alias("lower_bound"), _column(upper).alias("upper_bound"))
    folded = distinct_with_counts(ranges, [*group, *bounds])
    chained = with_neighbour(folded, group, bounds, "_next", ahead=True, slices=slices)
    # equal ranges are followed by themselves, except for the last copy
    one = F.lit(1).cast("bigint")
    copies = F.array(
        F.struct(one.alias("n"), F.col("_next.lower_bound").alias("next"), F.col("_next").isNull().alias("last")),
        F.struct((F.col("_copies") - 1).alias("n"), F.col("lower_bound").alias("next"), F.lit(False).alias("last")))
    rows = chained.withColumn("c", F.explode(copies)).where("c.n > 0").select(
        *[_quoted(g).alias("partition_by_col") for g in group], *bounds, F.col("c.next").alias("next_lower_bound"),
        F.col("c.last").alias("is_last_record"), F.col("c.n").alias("_copies"))
    gap_sign, gap_words = RANGE_RULES[gaps]
    length_sign, length_words = ("<=", "less_than_or_equal_to") if zero_length_range_allowed else ("<", "less_than")
    filled, ordered = f"lower_bound_{length_words}_upper_bound", f"upper_bound_{gap_words}_next_lower_bound"
    judged = (rows.withColumn(filled, F.expr(f"coalesce(lower_bound {length_sign} upper_bound, false)"))
              .withColumn(ordered, F.expr(f"coalesce(upper_bound {gap_sign} next_lower_bound, is_last_record, false)")))
    return expand_copies(judged.where(~(F.col(filled) & F.col(ordered))))


def sequential_values(df: DataFrame, column: str, interval: int = 1, datepart: str | None = None,
                      group_by: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """Values that are not exactly ``interval`` after the previous value of their group."""
    previous = f"previous_{slug(column)}"
    rows = df.select(*[_quoted(g) for g in group_by], _quoted(column))
    folded = distinct_with_counts(rows, [*group_by, column])
    chained = with_neighbour(folded, group_by, [column], "_before", ahead=False, slices=slices)
    one = F.lit(1).cast("bigint")
    copies = F.array(F.struct(one.alias("n"), F.col(f"_before.`{column}`").alias("p")),
                     F.struct((F.col("_copies") - 1).alias("n"), _quoted(column).alias("p")))
    spread = chained.withColumn("c", F.explode(copies)).where("c.n > 0").select(
        *[_quoted(g) for g in group_by], _quoted(column), F.col("c.p").alias(previous), F.col("c.n").alias("_copies"))
    if datepart:
        expected = F.timestamp_add(datepart.upper(), F.lit(interval), F.col(previous).cast("timestamp_ntz"))
        holds = _quoted(column).cast("timestamp_ntz") == expected
    else:
        holds = _quoted(column) == F.col(previous) + F.lit(interval)
    return expand_copies(spread.where(~holds))


def recency(df: DataFrame, field: str, datepart: str, interval: int, ignore_time_component: bool = False,
            group_by: Sequence[str] = (), as_of: str | None = None) -> DataFrame:
    """Groups whose newest moment is older than ``interval`` dateparts before ``as_of`` (default: now)."""
    kind = "date" if ignore_time_component else "timestamp_ntz"
    now = F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    limit = F.timestamp_add(datepart.upper(), F.lit(-interval), now).cast(kind)
    newest = _grouped(df, group_by).agg(F.max(_quoted(field)).cast(kind).alias("most_recent"))
    return newest.select(*[_quoted(g) for g in group_by], "most_recent", limit.alias("threshold")).where("most_recent < threshold")


def columns_match_set(df: DataFrame, expected: Sequence[str], ignore_case: bool = True) -> DataFrame:
    """Column names that are missing from the table or not expected, with the side that has them."""
    def fold(names: Sequence[str]) -> set[str]:
        return {n.lower() if ignore_case else n for n in names}
    found, wanted = fold(df.columns), fold(expected)
    rows = [(n, "unexpected") for n in sorted(found - wanted)] + [(n, "missing") for n in sorted(wanted - found)]
    return df.sparkSession.createDataFrame(rows, "column_name string, problem string")


def columns_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows in which two columns differ; unknown passes."""
    return df.where(_quoted(actual) != _quoted(expected))


@dataclass(frozen=True)
class Check:
    """A named check result with its thresholds, written as conditions on the failure count."""

    name: str
    violations: DataFrame
    severity: str = "warn"
    warn_if: str = "!= 0"
    error_if: str = "!= 0"
    failures: str = "count(1)"  # aggregate over the violations


@dataclass(frozen=True)
class RowCheck:
    """A check of single rows: ``violated`` is true for those that fail. Checks of one ``table`` share a scan."""

    name: str
    table: DataFrame
    violated: Column
    severity: str = "warn"
    warn_if: str = "!= 0"
    error_if: str = "!= 0"


def outside(column: ColumnLike, min_value: object = None, max_value: object = None, inclusive: bool = True) -> Column:
    """Condition of a value outside the range; unknown for null."""
    c = _column(column)
    broken = []
    if min_value is not None:
        broken.append(c < F.lit(min_value) if inclusive else c <= F.lit(min_value))
    if max_value is not None:
        broken.append(c > F.lit(max_value) if inclusive else c >= F.lit(max_value))
    return reduce(lambda a, b: a | b, broken) if broken else F.lit(False)


FAIL_CALCULATIONS: Mapping[str, str] = {
    "equal_rowcount": "sum(coalesce(diff_count, 0))",
    "fewer_rows_than": "sum(coalesce(row_count_delta, 0))",
    "equality": "count(1) + coalesce(abs(count_if(which_diff = 'a_minus_b') - count_if(which_diff = 'b_minus_a')), 0)",
}


def _status(c: Check | RowCheck) -> Column:
    status = F.when(F.expr(f"failures {c.warn_if}"), "warn").otherwise("pass")
    return F.when(F.expr(f"failures {c.error_if}"), "error").otherwise(status) if c.severity == "error" else status


def summary(checks: Sequence[Check | RowCheck]) -> DataFrame:
    """One row per check: failures, severity and status (``pass``, ``warn`` or ``error``). All row checks of one table are
    counted in one pass over it."""
    def line(c: Check) -> DataFrame:
        counted = c.violations.agg(F.expr(f"cast(coalesce({c.failures}, 0) as bigint)").alias("failures"))
        return counted.select(F.lit(c.name).alias("test"), "failures", F.lit(c.severity).alias("severity"), _status(c).alias("status"))

    def lines(own: Sequence[RowCheck]) -> DataFrame:
        counts = own[0].table.agg(*[F.count_if(c.violated).alias(f"n{i}") for i, c in enumerate(own)])
        entries = [F.struct(F.lit(c.name).alias("test"), F.col(f"n{i}").alias("failures"), F.lit(c.severity).alias("severity"), F.lit(i).alias("place"))
                   for i, c in enumerate(own)]
        status = reduce(lambda rest, i: F.when(F.col("place") == i, _status(own[i])).otherwise(rest), range(len(own)), F.lit(None).cast("string"))
        return counts.select(F.inline(F.array(*entries))).select("test", "failures", "severity", status.alias("status"))

    by_table: dict[int, list[RowCheck]] = {}
    for c in checks:
        if isinstance(c, RowCheck):
            by_table.setdefault(id(c.table), []).append(c)
    return reduce(DataFrame.unionAll, [line(c) for c in checks if isinstance(c, Check)] + [lines(own) for own in by_table.values()])
