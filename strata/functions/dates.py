"""Date and timestamp parsing and date parts.

Spark 4 runs with ANSI mode on, where a failed parse or cast raises. The
layer jobs treat bad text as missing, so every parse here is a ``try_*``
function: null in, or unparsable text in, gives null out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layouts of the source feeds.
REGISTERED_DATE_PATTERN = "MMM d, yyyy"  # e.g. "Aug 13, 2006", "Feb 4, 2005"
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def _as_col(c: str | Column) -> Column:
    return c if isinstance(c, Column) else F.col("`" + c + "`")


def parse_date(c: str | Column, pattern: str = REGISTERED_DATE_PATTERN) -> Column:
    """Month-name date text to DATE.

    With the feed's layout the text is read by its parts between spaces: a
    month name exactly as in ``MONTHS``, a day of which commas are dropped
    and the last two characters count, a year; further parts are ignored. So
    ``Aug 4 2006`` and ``Aug 4, 2006 x`` are dates, while ``AUG 13, 2006``,
    ``Sept 4, 2005`` and ``Feb 30, 2006`` give null. Any other ``pattern`` is
    a date pattern."""
    if pattern != REGISTERED_DATE_PATTERN:
        return F.try_to_date(_as_col(c), pattern)
    parts = F.split(_as_col(c), " ")
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.get(parts, F.lit(0)))
    day = F.right(F.concat(F.lit("0"), F.replace(F.get(parts, F.lit(1)), F.lit(","), F.lit(""))), F.lit(2))
    return F.try_to_date(F.concat_ws("-", F.get(parts, F.lit(2)), F.lpad(month.cast("string"), 2, "0"), day), "yyyy-MM-dd")


def parse_timestamp(c: str | Column, pattern: str | None = None) -> Column:
    """Timestamp text to TIMESTAMP (X5). Without a pattern, ISO-8601 text
    (with or without a zone such as ``Z``) is accepted; the session time
    zone applies to text without a zone."""
    if pattern is None:
        return F.try_to_timestamp(_as_col(c))
    return F.try_to_timestamp(_as_col(c), F.lit(pattern))


def year_of(c: str | Column) -> Column:
    """Year of a date or timestamp as INT (X6); null gives null."""
    return F.year(_as_col(c))


def month_of(c: str | Column) -> Column:
    """Month of a date or timestamp as INT (X6); null gives null."""
    return F.month(_as_col(c))


def day_of(c: str | Column) -> Column:
    """Day of month as INT (X7); null date gives null."""
    return F.dayofmonth(_as_col(c))


def to_int(c: str | Column) -> Column:
    """Text holding an integer (``4`` and ``04`` alike) to INT; bad text
    gives null instead of failing the job (X9)."""
    return _as_col(c).try_cast("int")
