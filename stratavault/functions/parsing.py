"""Tolerant text parsers: bad text becomes null and never fails a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratavault.functions.keys import ColumnLike, _column

NBSP = "\u00a0"

# Texts that stand for "no value" in landed files, the empty timestamp of master data,
# and the accepted file name form.
NULL_TEXTS = ["nan", "NaN", "None", "NULL", "null", "<NA>", "nat", "NaT", "NONE", "Null", "NAN", "N/A", "n/a", "#N/A", "NA"]
EMPTY_TIMESTAMP = "0001-01-01T00:00:00"
FILE_NAME_FORM = r"^[a-zA-Zа-яА-ЯёЁ0-9\._ -]+_--_[a-zA-Z0-9\._-]+_--_[a-zA-Z0-9-]{36}\.[a-z]+$"

CONTROL_CHARACTERS = "".join(chr(c) for c in [*range(0x00, 0x20), *range(0x7F, 0xA0)])
LINE_CHARACTERS = "\r\n\t"


def clean_number(c: ColumnLike) -> Column:
    """Number text without blanks and no-break spaces."""
    return F.replace(F.replace(_column(c).cast("string"), F.lit(" "), F.lit("")), F.lit(NBSP), F.lit(""))


def landing_text(c: ColumnLike, separator: str = "|", legacy: bool = False) -> Column:
    """Cell text as landed: null spellings to empty, control characters out, separator to blank.

    Line breaks and tabs become blanks; ``legacy`` deletes them with the other control characters.
    """
    text = F.coalesce(_column(c).cast("string"), F.lit(""))
    text = F.when(text.isin(NULL_TEXTS), F.lit("")).otherwise(text)
    to_blank = ("" if legacy else LINE_CHARACTERS) + (separator if separator in "-,;|" else "")
    dropped = "".join(ch for ch in CONTROL_CHARACTERS if ch not in to_blank)
    return F.translate(text, to_blank + dropped, " " * len(to_blank))


def amount(c: ColumnLike, legacy: bool = False) -> Column:
    """Money text to double. A comma is the decimal mark; ``legacy`` deletes commas instead."""
    text = _column(c).cast("string")
    if legacy:
        return F.regexp_replace(text, r"[\s,]", "").try_cast("double")
    return F.replace(F.regexp_replace(text, r"[\s\u00a0]", ""), F.lit(","), F.lit(".")).try_cast("double")


def integer(c: ColumnLike) -> Column:
    """Whole-number text to int; blanks around it are allowed, fractions are not."""
    return _column(c).cast("string").try_cast("int")


def boolean(c: ColumnLike) -> Column:
    """The JSON booleans or their text; anything else is null."""
    text = F.lower(_column(c).cast("string"))
    return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))


def _reshaped(text: Column, form: str, into: str) -> Column:
    """Text of exactly this form rewritten with its groups; any other text becomes unreadable on purpose,
    so that one replace decides and one cast reads."""
    return F.regexp_replace(text, f"(?s)^(?:{form}|.*)$", into)


def iso_timestamp(c: ColumnLike) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` to a zone-free timestamp; the empty timestamp is null."""
    day, clock = r"(\d{4}-\d{2}-\d{2})", r"(\d{2}:\d{2}:\d{2})"
    filled = F.nullif(_column(c), F.lit(EMPTY_TIMESTAMP))
    return _reshaped(filled, f"{day}T{clock}", "$1T$2").try_cast("timestamp_ntz")


def _dotted(text: Column, clock: str) -> Column:
    return _reshaped(text, rf"(\d{{2}})\.(\d{{2}})\.(\d{{4}}) ({clock})", "$3-$2-$1T$4").try_cast("timestamp_ntz")


def local_timestamp(c: ColumnLike) -> Column:
    """``dd.MM.yyyy HH:mm:ss``."""
    return _dotted(_column(c), r"\d{2}:\d{2}:\d{2}")


def loose_timestamp(c: ColumnLike) -> Column:
    """``dd.MM.yyyy H:mm:ss``: the hour may have one digit."""
    return _dotted(_column(c), r"\d{1,2}:\d{2}:\d{2}")


def dotted_date(c: ColumnLike, mark: str = ".") -> Column:
    """``dd.MM.yyyy`` (or another mark) to date."""
    return _reshaped(_column(c), rf"(\d{{2}})[{mark}](\d{{2}})[{mark}](\d{{4}})", "$3-$2-$1").try_cast("date")


def any_date(c: ColumnLike) -> Column:
    """A date in ISO, dotted or slashed form."""
    text = _column(c).cast("string")
    return F.coalesce(text.try_cast("date"), dotted_date(text, "."), dotted_date(text, "/"))


def is_workbook_name(name: ColumnLike) -> Column:
    return F.lower(_column(name)).rlike(r"\.xlsx?$")


def file_name_parts(key: ColumnLike) -> dict[str, Column]:
    """``file_name``, ``user_name`` and ``guid`` of an object key; odd keys keep their name, the rest unknown."""
    k = _column(key)
    parts = F.split(k, "_--_")
    good = (F.size(parts) == 3) & k.rlike(FILE_NAME_FORM)
    tail = F.element_at(parts, -1)
    unknown = F.lit("unknown")
    return {
        "file_name": F.when(good, F.concat(parts[0], F.lit("."), F.substring_index(tail, ".", -1))).otherwise(k),
        "user_name": F.when(good, parts[1]).otherwise(unknown),
        "guid": F.when(good, F.substring_index(tail, ".", 1)).otherwise(unknown),
    }


def table_name(file_name: ColumnLike) -> Column:
    return F.translate(_column(file_name), " .", "__")
