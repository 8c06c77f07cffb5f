"""Hash keys of the vault and generic surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Key separator, and the text that stands for a null field inside a surrogate key.
KEY_SEPARATOR = "|"
SURROGATE_NULL_TEXT = "_dbt_utils_surrogate_key_null_"


def _column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_key(*parts: ColumnLike, sep: str = KEY_SEPARATOR) -> Column:
    """32-character md5 key. One part: null stays null; several parts: nulls are skipped."""
    columns = [_column(p).cast("string") for p in parts]
    return F.md5(columns[0]) if len(columns) == 1 else F.md5(F.concat_ws(sep, *columns))


def surrogate_key(fields: Sequence[ColumnLike], nulls_as_empty: bool = False) -> Column:
    """md5 of all fields joined by ``-``; a null field keeps its place through a placeholder text."""
    stand_in = F.lit("" if nulls_as_empty else SURROGATE_NULL_TEXT)
    return F.md5(F.concat_ws("-", *[F.coalesce(_column(f).cast("string"), stand_in) for f in fields]))


def first_of_month(year: ColumnLike, month: ColumnLike) -> Column:
    """First day of a month given as text or numbers; unusable input gives null."""
    y, m = (_column(c).cast("string") for c in (year, month))
    return F.concat(y, F.lit("-"), F.lpad(m, 2, "0"), F.lit("-01")).try_cast("date")
