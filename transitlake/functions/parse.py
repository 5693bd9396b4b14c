"""Safe parsing Column functions.

Text from feeds is never cast with a plain CAST (ANSI mode would fail the job);
every conversion is a `try_cast` behind a shape check where the source program's
rules are stricter than Spark's (e.g. `int('12.0')` fails, `int(' 12 ')` works).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# an integer as the source programs accept it: optional sign, digits, optional
# single underscores between digit groups, surrounding whitespace
INT_TEXT = r"^\s*[+-]?\d+(?:_\d+)*\s*$"


# ASCII whitespace, the same set as the regex class \s
WHITESPACE = " \t\n\r\x0b\x0c"


def strip(c: Column) -> Column:
    """Remove surrounding whitespace (spaces, tabs, CR/LF, VT, FF); no regex."""
    return F.trim(c, F.lit(WHITESPACE))


def int_or_null(c: Column, dtype: str = "bigint") -> Column:
    """Text -> integer, NULL when the text is not an integer literal.

    `try_cast` of the stripped text already accepts exactly sign + digits (a decimal
    point or exponent gives NULL); only texts with '_' digit separators, which the
    source programs accept, go through the regex path."""
    t = strip(c)
    return (F.when(t.contains("_"),
                   F.when(t.rlike(INT_TEXT), F.regexp_replace(t, "_", "").try_cast(dtype)))
             .otherwise(t.try_cast(dtype)))


def is_int_text(c: Column) -> Column:
    return int_or_null(c).isNotNull()


def double_or_null(c: Column) -> Column:
    return strip(c).try_cast("double")


def none_literal_to_null(c: Column) -> Column:
    """Archived text uses Python's `None` for missing values (trap D9)."""
    return F.when(strip(c) != "None", c)


def repair_double_utf8(c: Column) -> Column:
    """undo UTF-8 text that was decoded as Latin-1 (e.g. 'MustamÃ¤e' -> 'Mustamäe').

    Only strings made entirely of Latin-1 code points are candidates; the re-decoded
    bytes must be valid UTF-8, otherwise the input is returned unchanged."""
    redecoded = F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string"))
    return F.when(c.rlike(r"^[\x{00}-\x{FF}]*$"), F.coalesce(redecoded, c)).otherwise(c)


def timestamp_or_null(c: Column, fmt: str = "yyyy-M-d H:m:s") -> Column:
    """`%Y-%m-%d %H:%M:%S`-style text -> TIMESTAMP_NTZ, NULL when unparsable."""
    return F.try_to_timestamp(strip(c), F.lit(fmt)).cast("timestamp_ntz")


def gtfs_seconds(c: Column) -> Column:
    """GTFS `H:MM:SS` time of day (may exceed 24:00:00) -> seconds since midnight."""
    parts = F.split(strip(c), ":")
    h, m, sec = (F.get(parts, i).try_cast("int") for i in range(3))
    return F.when(F.size(parts) == 3, h * 3600 + m * 60 + sec)
