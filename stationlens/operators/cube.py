"""The station-month cube: one scan, one shuffle, then cheap roll-ups.

Every climate result is a roll-up of ``(station, year, month)`` -- year and
season are functions of that key -- so the job aggregates the observations once
into this cube (at most stations x months rows, tiny next to the raw lines) and
derives A1-A10 and T1-T4 from it.  Sums stay DECIMAL in the cube (readings that
the decimal type does not hold are summed beside them as DOUBLE), so a roll-up of
decimal sums is exact and equals the direct aggregation bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.events import EVENT_NAMES, event_flag
from ..functions.values import exact_part, joined_parts, other_part
from .climate import _event_counts_from, top_k, year_mean_of_stations
from .parse import KEPT, REJECTED, UNDATED, lines_with_outcome

KEY = ("station", "year", "month", "season")


def station_month_cube(obs: DataFrame) -> DataFrame:
    """Aggregate observations to one row per (station, year, month).

    Columns: ``station, year, month, season, n_obs, n_prcp, sum_temp, sum_prcp
    (DECIMAL), other_temp, other_prcp (DOUBLE), max_max_temp, max_gust, fog ..
    tornado`` (event counts).
    """
    return obs.groupBy(*KEY).agg(*_measures())


def line_cube(lines: DataFrame) -> DataFrame:
    """The cube of raw lines with an ``outcome`` beside its key: of kept lines the station-month
    cube, of all others one row for each outcome.

    The counts of lines therefore stand in the same table as the results; they are exact
    however often a task was run.
    """
    return lines_with_outcome(lines).groupBy("outcome", *KEY).agg(*_measures())


def of_kept(line_cube: DataFrame) -> DataFrame:
    """The station-month cube in a :func:`line_cube`."""
    return line_cube.where(F.col("outcome") == KEPT).drop("outcome")


def job_counts(line_cube: DataFrame) -> DataFrame:
    """K5: ``lines, valid_rows, kept_rows, stations`` of a :func:`line_cube` (one row)."""
    def total(*outcomes: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("outcome").isin(*outcomes), F.col("n_obs"))), F.lit(0))

    return line_cube.agg(
        total(KEPT, UNDATED, REJECTED).alias("lines"), total(KEPT, UNDATED).alias("valid_rows"),
        total(KEPT).alias("kept_rows"), F.count_distinct("station").alias("stations"))


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_obs"),
        F.count("prcp").alias("n_prcp"),
        *[part(F.col(x)).alias(f"{name}_{x}") for name, part in (("sum", exact_part), ("other", other_part))
          for x in ("temp", "prcp")],
        F.max("max_temp").alias("max_max_temp"),
        F.max("gust").alias("max_gust"),
        *[F.count_if(F.coalesce(event_flag(F.col("frshtt"), i), F.lit(False))).alias(n.lower())
          for i, n in enumerate(EVENT_NAMES)]]


def _total(reading: str) -> Column:
    return joined_parts(F.sum(f"sum_{reading}"), F.sum(f"other_{reading}"))


def _mean(reading: str, count: str = "n_obs") -> Column:
    return _total(reading) / F.sum(count)


def monthly_avg_temp(cube: DataFrame) -> DataFrame:
    """A1 from the cube (already at the month grain: no further shuffle)."""
    return cube.groupBy("station", "year", "month").agg(_mean("temp").alias("avg_temp"))


def yearly_avg_temp(cube: DataFrame) -> DataFrame:
    """A2 from the cube."""
    return cube.groupBy("station", "year").agg(_mean("temp").alias("avg_temp"))


def seasonal_avg_prcp(cube: DataFrame) -> DataFrame:
    """A3 from the cube."""
    return cube.groupBy("station", "year", "season").agg(_mean("prcp", "n_prcp").alias("avg_prcp"))


def station_max_temp(cube: DataFrame) -> DataFrame:
    """A4 from the cube."""
    return cube.groupBy("station").agg(F.max("max_max_temp").alias("max_temp"))


def extreme_events(cube: DataFrame) -> DataFrame:
    """A5 from the cube."""
    return _event_counts_from(cube, ["station"], [F.sum(n.lower()) for n in EVENT_NAMES])


def event_totals(cube: DataFrame) -> DataFrame:
    """A6 from the cube (over observations with a valid date)."""
    return _event_counts_from(cube, [], [F.sum(n.lower()) for n in EVENT_NAMES])


def station_total_prcp(cube: DataFrame) -> DataFrame:
    """A8 from the cube."""
    return cube.groupBy("station").agg(_total("prcp").alias("total_prcp"))


def station_max_gust(cube: DataFrame) -> DataFrame:
    """A9 from the cube."""
    return cube.groupBy("station").agg(F.max("max_gust").alias("max_gust"))


def station_total_temp(cube: DataFrame) -> DataFrame:
    """A10 from the cube."""
    return cube.groupBy("station").agg(_total("temp").alias("total_temp"))


def highest_max_temp(cube: DataFrame, k: int = 10) -> DataFrame:
    """T1 from the cube."""
    return top_k(station_max_temp(cube), "max_temp", k)


def hottest_year(cube: DataFrame) -> DataFrame:
    """T2 from the cube."""
    return top_k(year_mean_of_stations(yearly_avg_temp(cube)), "avg_temp", 1, key="year")


def wettest_station(cube: DataFrame) -> DataFrame:
    """T3 from the cube."""
    return top_k(station_total_prcp(cube), "total_prcp", 1)


def highest_gust(cube: DataFrame) -> DataFrame:
    """T4 from the cube."""
    return top_k(station_max_gust(cube), "max_gust", 1)
