"""Numeric parsing and validity rules (Python ``float()`` semantics)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip

# What Python's float() accepts -- optional sign, digits with single
# underscores between them, optional fraction, optional exponent, or the words
# inf / infinity / nan in any case.  Spark's own cast also takes "1.0d" / "1.0f",
# which Python rejects, hence the guard.
_DIGITS = r"[0-9](?:_?[0-9])*"
NUMBER_PATTERN = (
    r"^([+-]?(?:(?:" + _DIGITS + r"(?:\.(?:" + _DIGITS + r")?)?|\." + _DIGITS + r")"
    r"(?:[eE][+-]?" + _DIGITS + r")?|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?|[nN][aA][nN]))\z"
)

# Fixed value: readings at or above this magnitude are missing-value markers
# (999.9, 9999.9, ...).
MISSING_THRESHOLD = 999.0

# Sums run on exact decimals so results do not depend on partitioning or on the
# order rows reach an aggregate.  A reading that this type does not hold exactly (more
# decimals, a very large magnitude) goes into a DOUBLE sum beside it.
SUM_TYPE = "decimal(18,6)"


# A string whose first character is one of FIRST_CHARS, whose
# last is one of LAST_CHARS and that holds no 'x' or '_' is read alike by Java's
# Double.parseDouble and Python's float(): that rules out Java's f/d suffixes,
# hex forms and the control characters Java trims; both then share one decimal
# grammar, so a plain cast is exact.  Specials are spelled the same way by both.
FIRST_CHARS = "0123456789.+-"
LAST_CHARS = "0123456789."
SPECIAL_WORDS = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan", "+nan", "-nan")


def is_plain_number(s: Column) -> Column:
    """True for the common spellings that a cast reads as Python does."""
    return (F.lit(FIRST_CHARS).contains(F.left(s, F.lit(1))) & F.lit(LAST_CHARS).contains(F.right(s, F.lit(1)))
            & (F.octet_length(s) > 0) & ~s.contains("x") & ~s.contains("X") & ~s.contains("_"))


def parse_float(value: Column, stripped: bool = False) -> Column:
    """DOUBLE of ``float(value.strip())``, NULL where Python would raise.

    Pass ``value`` as a plain column: it is read several times.  The common case
    is two edge-character checks plus a cast; the full pattern runs only for
    other strings (underscores, junk such as Spark-only ``1.0d`` or hex forms).
    """
    s = value if stripped else py_strip(value)
    plain = is_plain_number(s)
    special = F.lower(s).isin(*SPECIAL_WORDS)
    return (F.when(plain | special, s.try_cast("double"))
            .otherwise(F.replace(F.regexp_extract(s, NUMBER_PATTERN, 1), F.lit("_"), F.lit("")).try_cast("double")))


def below_missing(x: Column, absolute: bool) -> Column:
    """``abs(x) < 999`` or ``x < 999``; NULL (unparseable) counts as invalid."""
    v = F.abs(x) if absolute else x
    return F.coalesce(v < F.lit(MISSING_THRESHOLD), F.lit(False))


def scaled(x: Column, places: int, digits: int) -> tuple[Column, Column]:
    """Whether a DOUBLE is below ``10^digits`` and the nearest to a decimal of ``places`` places; this decimal.

    Such a DOUBLE (15 digits at most) has that decimal as its text, so this is what a cast gives,
    without the text: the decimal is made of a whole number.
    """
    whole = F.rint(x * F.lit(float(10**places)))
    near = (F.abs(x) < F.lit(float(10**digits))) & (whole / F.lit(float(10**places)) == x)
    return near, whole.cast("bigint").cast(f"decimal({digits + places},0)") * F.lit(Decimal(1).scaleb(-places))


def _summand(x: Column) -> Column:
    """The reading as SUM_TYPE, or nearly."""
    near, value = scaled(x, 6, 5)
    return F.when(near, value).otherwise(x.try_cast(SUM_TYPE))


def _held(x: Column) -> Column:
    """True where SUM_TYPE holds the reading exactly."""
    return F.coalesce(scaled(x, 6, 5)[0] | (x.try_cast(SUM_TYPE).cast("double") == x), F.lit(False))


def exact_part(x: Column) -> Column:
    """Sum of the readings that SUM_TYPE holds, as a decimal."""
    return F.sum(F.when(_held(x), _summand(x)))


def other_part(x: Column) -> Column:
    """DOUBLE sum of all other readings.

    A valid reading can be ``-inf`` (the rule for PRCP, WDSP and GUST has no ``abs``);
    as with Python floats the sum then is ``-inf``.
    """
    return F.sum(F.when(~_held(x), x))


def joined_parts(exact: Column, other: Column) -> Column:
    """The DOUBLE sum of both parts; NULL without any reading."""
    return F.when(other.isNull(), exact.cast("double")).otherwise(
        F.coalesce(exact.cast("double"), F.lit(0.0)) + other)


def exact_sum(x: Column) -> Column:
    """Sum of a DOUBLE reading that keeps every reading, returned as DOUBLE.

    It does not depend on partitioning as long as SUM_TYPE holds all readings.
    """
    return joined_parts(exact_part(x), other_part(x))
