"""Generic relational operators: column selection, union, pivot, melt, dedupe, series, value lists."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratavault.functions.keys import ColumnLike, _column
from stratavault.functions.scalars import slug
from stratavault.operators.ordering import distinct_with_counts, expand_copies, numbered


def _quoted(name: str, alias: str | None = None) -> Column:
    escaped = "`" + name.replace("`", "``") + "`"
    return F.col(f"{alias}.{escaped}" if alias else escaped)


def _lower(names: Iterable[str] | None) -> set[str]:
    return {n.lower() for n in names or ()}


def filtered_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Column names of ``df`` without ``exclude`` (any case)."""
    dropped = _lower(exclude)
    return [c for c in df.columns if c.lower() not in dropped]


def star(df: DataFrame, exclude: Iterable[str] = (), prefix: str = "", suffix: str = "",
         relation_alias: str | None = None) -> list[Column]:
    """All columns of ``df`` but ``exclude``, renamed with ``prefix`` and ``suffix`` when given."""
    return [_quoted(c, relation_alias).alias(f"{prefix}{c}{suffix}") for c in filtered_columns(df, exclude)]


def group_by_n(df: DataFrame, n: int) -> GroupedData:
    """Group by the first ``n`` columns."""
    return df.groupBy(*[_quoted(c) for c in df.columns[:n]])


def nullcheck(df: DataFrame) -> list[Column]:
    """Every column of ``df``; empty strings become null."""
    return [F.nullif(_quoted(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType)
            else _quoted(f.name) for f in df.schema.fields]


def nullcheck_table(df: DataFrame) -> DataFrame:
    return df.select(*nullcheck(df))


def union_relations(relations: Mapping[str, DataFrame], column_override: Mapping[str, str] | None = None,
                    include: Sequence[str] = (), exclude: Sequence[str] = (),
                    source_column: str | None = "source_relation", where: str | None = None) -> DataFrame:
    """Union of unlike tables over the superset of their columns.

    A column has the type it has in the first table that carries it, unless overridden; tables without it
    give null. ``where`` filters every input, so it reaches each scan.
    """
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    wanted, unwanted = _lower(include), _lower(exclude)

    def keeps(name: str) -> bool:
        return name.lower() in wanted if wanted else name.lower() not in unwanted

    override = dict(column_override or {})
    types: dict[str, T.DataType | str] = {}
    for df in relations.values():
        for field in df.schema.fields:
            if keeps(field.name):
                types.setdefault(field.name, override.get(field.name, field.dataType))
    if not types:
        raise ValueError(f"no columns to union for {', '.join(relations)}")

    def aligned(name: str, df: DataFrame) -> DataFrame:
        rows = df.where(where) if where else df
        own = set(df.columns)
        tag = [F.lit(name).alias(source_column)] if source_column else []
        return rows.select(*tag, *[(_quoted(c) if c in own else F.lit(None)).cast(t).alias(c) for c, t in types.items()])

    parts = [aligned(n, df) for n, df in relations.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


def pivot(column: ColumnLike, values: Sequence[object], agg: str = "sum", cmp: str = "=", prefix: str = "",
          suffix: str = "", then_value: object = 1, else_value: object = 0, quoted: bool = True,
          distinct: bool = False) -> list[Column]:
    """One conditional aggregate per value, for use inside ``groupBy(...).agg(*pivot(...))``."""
    comparisons = {"=": operator.eq, "!=": operator.ne, "<>": operator.ne, "<": operator.lt, "<=": operator.le,
                   ">": operator.gt, ">=": operator.ge, "like": Column.like, "ilike": Column.ilike}
    aggregate = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "avg": F.avg}[agg.lower()]
    if distinct:
        aggregate = {"sum": F.sum_distinct, "count": F.count_distinct}.get(agg.lower(), aggregate)
    key = _column(column)

    def branch(v: object) -> Column:
        return F.expr(v) if isinstance(v, str) else F.lit(v)

    def compared(value: object) -> Column:
        return comparisons[cmp.lower()](key, value)

    def label(value: object) -> str:
        text = f"{prefix}{value}{suffix}"
        return text if quoted else slug(text)

    return [aggregate(F.when(compared(v), branch(then_value)).otherwise(branch(else_value))).alias(label(v))
            for v in values]


def unpivot(df: DataFrame, cast_to: str = "string", exclude: Sequence[str] = (), remove: Sequence[str] = (),
            field_name: str = "field_name", value_name: str = "value") -> DataFrame:
    """Columns to rows. ``exclude`` columns stay as they are, ``remove`` columns go; nulls are kept."""
    skipped = _lower(exclude) | _lower(remove)
    molten = [c for c in df.columns if c.lower() not in skipped]
    kept = [c for c in df.columns if c.lower() in _lower(exclude)]
    values = [_quoted(c).cast("string").cast(cast_to).alias(c) if df.schema[c].dataType == T.BooleanType()
              else _quoted(c).cast(cast_to).alias(c) for c in molten]
    ready = df.select(*[_quoted(c) for c in kept], *values)
    return ready.unpivot([_quoted(c) for c in kept], [_quoted(c) for c in molten], field_name, value_name)


def nth_per_key(df: DataFrame, keys: Sequence[ColumnLike], order_by: Sequence[Column], n: int = 1) -> DataFrame:
    """The n-th row of each key. The rank filter is applied before the shuffle too, so that at most ``n``
    rows per key leave each task, however many rows the key has."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == n).drop("_rn")


def deduplicate(df: DataFrame, partition_by: Sequence[ColumnLike], order_by: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order; rows with null columns are kept."""
    return nth_per_key(df, partition_by, order_by, 1)


def column_values(df: DataFrame, column: str, order_by: Sequence[Column] | None = None,
                  max_records: int | None = None, where: str | None = None) -> DataFrame:
    """Distinct values with their ``row_count``, most frequent first; ties by value."""
    rows = df.where(where) if where else df
    counted = rows.groupBy(_quoted(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))
    ordered = counted.orderBy(*(order_by or [F.desc("row_count"), F.asc("value")]))
    return ordered.limit(max_records) if max_records is not None else ordered


def column_value_list(df: DataFrame | None, column: str, max_records: int | None = None, default: Sequence[object] | None = None,
                      where: str | None = None) -> list[object]:
    """The values as a Python list for building plans such as pivots: all of them, or the ``max_records`` most frequent
    ones where a limit is asked for. The list is one column of a plan to be built, so it has to fit the driver."""
    if df is None:
        if default is None:
            raise ValueError("relation does not exist and no default was given")
        return list(default)
    found = [r["value"] for r in column_values(df, column, max_records=max_records, where=where).collect()]
    return found or list(default or [])


def single_value(df: DataFrame, default: object = None) -> DataFrame:
    """One row, one column ``value``: the first cell of ``df``, or the default when ``df`` has no rows."""
    cell = df.limit(1).agg(F.count(F.lit(1)).alias("n"), F.first(_quoted(df.columns[0])).alias("v"))
    return cell.select(F.when(F.col("n") > 0, F.col("v")).otherwise(F.lit(default)).alias("value"))


def results_as_columns(df: DataFrame) -> DataFrame:
    """A result column by column: one row (column_name, position, value) per cell, values as text, positions from 1 in
    the order of all columns (nulls first). Any number of rows; numbered slice by slice, never in one task."""
    folded = distinct_with_counts(df, df.columns)
    copies = expand_copies(folded, number="_copy")
    ordered = numbered(copies.withColumn("_row", F.struct(*[_quoted(c) for c in df.columns], "_copy")), "_row", "position")
    texts = ordered.select("position", *[_quoted(c).cast("string").alias(c) for c in df.columns])
    return texts.unpivot(["position"], [_quoted(c) for c in df.columns], "column_name", "value")


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """``generated_number`` from 1 to ``upper_bound``, produced in parallel."""
    if upper_bound <= 0:
        raise ValueError("upper_bound must be positive")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


_MONTHS = {"month": 1, "quarter": 3, "year": 12}
_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def intervals_between(start: datetime | date, end: datetime | date, datepart: str) -> int:
    """Number of ``datepart`` boundaries between two moments."""
    if datepart in _MONTHS:
        size = _MONTHS[datepart]
        return (end.year * 12 + end.month - 1) // size - (start.year * 12 + start.month - 1) // size
    origin = datetime(1970, 1, 5 if datepart == "week" else 1)

    def ticks(moment: datetime | date) -> int:
        full = moment if isinstance(moment, datetime) else datetime(moment.year, moment.month, moment.day)
        gap = full - origin
        return (gap.days * 86400 + gap.seconds) // _SECONDS[datepart]
    return ticks(end) - ticks(start)


def date_spine(spark: SparkSession, datepart: str, start: datetime | date, end: datetime | date) -> DataFrame:
    """One row per period from ``start``, end exclusive, in column ``date_<datepart>``."""
    if datepart not in _MONTHS and datepart not in _SECONDS:
        raise ValueError(f"unknown datepart {datepart!r}")
    periods = max(intervals_between(start, end, datepart), 0)
    as_date = not isinstance(start, datetime) and datepart not in ("second", "minute", "hour")
    first = F.lit(start.isoformat()).cast("timestamp_ntz")
    moment = F.timestamp_add(datepart.upper(), F.col("id").cast("int"), first)
    return (spark.range(periods)
            .select((moment.cast("date") if as_date else moment).alias(f"date_{datepart}"))
            .where(F.col(f"date_{datepart}") <= F.lit(end.isoformat()).cast("timestamp_ntz")))


def tagged_difference(a: DataFrame, b: DataFrame, tag: str = "which_diff") -> DataFrame:
    """Distinct rows of ``a`` not in ``b`` and of ``b`` not in ``a``, tagged by side.

    One shuffle with map-side folding serves both directions; many equal rows on one side stay cheap.
    """
    names = a.columns
    both = a.withColumn("_side", F.lit(1)).unionAll(b.toDF(*names).withColumn("_side", F.lit(2)))
    sides = (both.groupBy(*[_quoted(c) for c in names])
             .agg(F.min("_side").alias("_lo"), F.max("_side").alias("_hi")).where("_lo = _hi"))
    return sides.select(F.when(F.col("_lo") == 1, "a_minus_b").otherwise("b_minus_a").alias(tag),
                        *[_quoted(c) for c in names])


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``."""
    return tagged_difference(a, b, "_which").where("_which = 'a_minus_b'").drop("_which")
