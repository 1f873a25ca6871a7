"""Text of DOUBLE values in results, in built-in expressions.

``str(float)`` and Spark's cast agree on the digits (the shortest text that reads
back alike); they differ in when and how an exponent is written, which ``py_str``
mends.  ``py_fixed`` rounds the shortest text half up where Python rounds the exact
binary value, so a last digit can differ on a tie such as 0.125.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python writes an exponent below and from these magnitudes on.
EXPONENT_BELOW, EXPONENT_FROM = 1e-4, 1e16


def py_fixed(x: Column, decimals: int) -> Column:
    """``f"{x:.Nf}"`` of a DOUBLE column (NULL stays NULL)."""
    v = x.cast("double")
    special = F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return F.when(v.isNull(), F.lit(None)).when(special, py_str(v)).otherwise(F.format_string(f"%.{decimals}f", v))


def py_str(x: Column) -> Column:
    """``str(float)`` of a DOUBLE column (NULL stays NULL)."""
    v = x.cast("double")
    size, text = F.abs(v), v.cast("string")
    # Without an exponent: Java's text from 1e-3 to 1e7, else the digits of an exact decimal.
    digits = F.rtrim(v.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    digits = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0\z", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    exponent = F.concat(F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")), F.lpad(F.abs(power).cast("string"), 2, "0"))
    return (F.when(F.isnan(v), F.lit("nan"))
            .when(size == F.lit(float("inf")), F.when(v > 0, F.lit("inf")).otherwise(F.lit("-inf")))
            .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), text)
            .when((size >= EXPONENT_BELOW) & (size < EXPONENT_FROM), digits)
            .otherwise(F.concat(mantissa, exponent)))
