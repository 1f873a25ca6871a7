"""Date parts and seasons (``datetime.strptime(s, "%Y-%m-%d")`` semantics)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# strptime's fields -- %Y exactly four digits (year 0000 is not a
# Python date), %m 1-12 with an optional leading zero, %d 1-31 with an optional
# leading zero or space -- and nothing else on the line.
DATE_PATTERN = r"^(?!0000)[0-9]{4}-(?:1[0-2]|0[1-9]|[1-9])-(?:3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])\z"

# Meteorological seasons; December stays in its own calendar year.
SEASONS = (("Winter", (12, 1, 2)), ("Spring", (3, 4, 5)), ("Summer", (6, 7, 8)), ("Autumn", (9, 10, 11)))


def parse_date(value: Column) -> Column:
    """DATE of a ``YYYY-MM-DD`` string; NULL where strptime would raise."""
    # A non-matching string extracts as '' (NULL date); Spark's cast reads the
    # one- or two-digit month/day forms and rejects impossible days (02-30).
    matched = F.regexp_extract(value, DATE_PATTERN, 0)
    return F.replace(matched, F.lit(" "), F.lit("")).try_cast("date")


def season(month: Column) -> Column:
    """Season name of a month number; NULL month gives NULL."""
    expr = None
    for name, months in SEASONS[:-1]:
        cond = month.isin(*months)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return F.when(month.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(SEASONS[-1][0])))
