"""Summary text (K4) and the job report (K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.format import py_fixed


def summary_lines(summary: DataFrame) -> DataFrame:
    """K4 text: the reference's three sentences, one row each (column ``line``).

    Missing facts print as ``None`` with ``0.00``, as in the reference.
    """
    def key(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit("None"))

    s = summary.select(
        F.concat(F.lit("Hottest year: "), key("hottest_year"), F.lit(" with avg temp "),
                 py_fixed(F.col("hottest_year_temp"), 2)).alias("l1"),
        F.concat(F.lit("Wettest station: "), key("wettest_station"), F.lit(" with total prcp "),
                 py_fixed(F.col("wettest_station_prcp"), 2)).alias("l2"),
        F.concat(F.lit("Highest gust: "), key("gust_station"), F.lit(" with "),
                 py_fixed(F.col("highest_gust"), 2)).alias("l3"))
    return s.select(F.explode(F.array("l1", "l2", "l3")).alias("line"))
