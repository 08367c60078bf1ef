"""Text functions: tokens, CSV fields, printable windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word separator and the timestamp pattern of printed windows.
WORD_SEPARATOR = r"\W+"
STAMP_PATTERN = "yyyy-MM-dd HH:mm:ss.SSS"


def words(line: Column | str) -> Column:
    """Lower-cased words of a line as an array; ``\\W`` is ASCII-only.

    The first or last word may be empty. Drop empty words after exploding: a
    filter on rows is compiled, one inside the array is not.
    """
    return F.split(F.lower(line), WORD_SEPARATOR)


def stamp(ts: Column | str) -> Column:
    """A timestamp printed with milliseconds."""
    return F.date_format(ts, STAMP_PATTERN)


def window_text(key: Column | str, start: Column | str, end: Column | str, n: Column | str) -> Column:
    """One printable line for a window result."""
    key, n = (F.col(c) if isinstance(c, str) else c for c in (key, n))
    return F.concat(
        F.lit("key="), key.cast("string"),
        F.lit(" window=["), stamp(start), F.lit(","), stamp(end),
        F.lit(") n="), n.cast("string"),
    )
