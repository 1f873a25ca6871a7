"""Climate aggregations and rankings over observations.

Every operator is one ``groupBy().agg()`` (partial aggregation map-side, one
shuffle of partial buffers keyed by a small key) or a top-k
(``TakeOrderedAndProject``: per-partition top-k, then a single merge of k rows
per partition).  Means are ``sum / count`` with exact decimal sums, so results do
not depend on partitioning.  Ties in rankings break on the key, ascending.

Hot keys: a station holding a third of all rows is combined map-side before the
shuffle, so each map task sends one partial row per key, not its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.events import EVENT_NAMES, event_flag
from ..functions.values import exact_part, exact_sum, joined_parts, other_part


def mean(x: Column) -> Column:
    """Mean of a reading as DOUBLE: exact sum divided by the number of readings."""
    return exact_sum(x) / F.count(x)


def monthly_avg_temp(obs: DataFrame) -> DataFrame:
    """A1: mean TEMP per (station, year, month)."""
    return obs.groupBy("station", "year", "month").agg(mean(F.col("temp")).alias("avg_temp"))


def yearly_avg_temp(obs: DataFrame) -> DataFrame:
    """A2: mean TEMP per (station, year), over rows (not over monthly means)."""
    return obs.groupBy("station", "year").agg(mean(F.col("temp")).alias("avg_temp"))


def seasonal_avg_prcp(obs: DataFrame) -> DataFrame:
    """A3: mean PRCP per (station, year, season); December counts in its own year."""
    return obs.groupBy("station", "year", "season").agg(mean(F.col("prcp")).alias("avg_prcp"))


def station_max_temp(obs: DataFrame) -> DataFrame:
    """A4: highest MAX per station."""
    return obs.groupBy("station").agg(F.max("max_temp").alias("max_temp"))


def _event_counts(obs: DataFrame, keys: list[str]) -> DataFrame:
    """Count rows per key and event; only events that occurred give rows."""
    return _event_counts_from(obs, keys, [
        F.count_if(F.coalesce(event_flag(F.col("frshtt"), i), F.lit(False)))
        for i in range(len(EVENT_NAMES))])


def _event_counts_from(df: DataFrame, keys: list[str], counters: list[Column]) -> DataFrame:
    """Aggregate six event counters per key, then unpivot the non-zero ones."""
    counts = df.groupBy(*keys).agg(*[c.alias(f"_{i}") for i, c in enumerate(counters)])
    stack = "stack({}, {}) as (event_type, event_count)".format(
        len(EVENT_NAMES), ", ".join(f"'{n}', _{i}" for i, n in enumerate(EVENT_NAMES)))
    return counts.selectExpr(*keys, stack).filter(F.col("event_count") > 0)


def extreme_events(obs: DataFrame) -> DataFrame:
    """A5: occurrences per (station, event type); zero counts are not listed.

    Flags are counted with ``count_if`` inside one aggregation (six counters per
    station, combined map-side) and unpivoted afterwards, instead of exploding
    every row into up to six event rows before the shuffle.
    """
    return _event_counts(obs, ["station"])


def event_totals(records: DataFrame) -> DataFrame:
    """Occurrences per event type over all stations."""
    return _event_counts(records, [])


def year_mean_of_stations(yearly: DataFrame) -> DataFrame:
    """Per year, the unweighted mean of the stations' yearly means."""
    return yearly.groupBy("year").agg(F.avg("avg_temp").alias("avg_temp"))


def station_total_prcp(obs: DataFrame) -> DataFrame:
    """Total PRCP per station."""
    return obs.groupBy("station").agg(exact_sum(F.col("prcp")).alias("total_prcp"))


def station_max_gust(obs: DataFrame) -> DataFrame:
    """Highest GUST per station."""
    return obs.groupBy("station").agg(F.max("gust").alias("max_gust"))


def station_total_temp(records: DataFrame) -> DataFrame:
    """A10: total TEMP per station."""
    return records.groupBy("station").agg(exact_sum(F.col("temp")).alias("total_temp"))


def distinct_stations(obs: DataFrame) -> DataFrame:
    """Exact number of distinct stations (one row)."""
    return obs.agg(F.count_distinct("station").alias("stations"))


def top_k(df: DataFrame, value: str, k: int, key: str = "station") -> DataFrame:
    """Top ``k`` rows by ``value`` descending, ties by ``key`` ascending."""
    return df.orderBy(F.col(value).desc(), F.col(key).asc()).limit(k)


def highest_max_temp(obs: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` stations with the highest MAX."""
    return top_k(station_max_temp(obs), "max_temp", k)


def hottest_year(obs: DataFrame) -> DataFrame:
    """The year with the highest mean of station-year means (lowest year on a tie)."""
    return top_k(year_mean_of_stations(yearly_avg_temp(obs)), "avg_temp", 1, key="year")


def wettest_station(obs: DataFrame) -> DataFrame:
    """The station with the highest total PRCP."""
    return top_k(station_total_prcp(obs), "total_prcp", 1)


def highest_gust(obs: DataFrame) -> DataFrame:
    """T4: the station with the highest GUST."""
    return top_k(station_max_gust(obs), "max_gust", 1)


def max_gust_record(records: DataFrame) -> DataFrame:
    """T5: the (station, gust) record with the highest gust over all rows.

    A global top-1 over rows: each partition keeps its best row, one task merges
    them; no shuffle of the rows themselves.
    """
    return top_k(records.select("station", "gust"), "gust", 1)


def climate_summary(obs: DataFrame) -> DataFrame:
    """K4 (typed) from observations, in one linear plan (one scan of the lines).

    Station-year aggregates, then one ``GROUPING SETS ((year), (station))``
    aggregation gives both the per-year means of station means and the
    per-station totals, then one global aggregation picks the three facts.
    Three separate roll-ups would each prune the shared aggregation differently,
    so Spark could not reuse it and would scan the lines three times.
    """
    sy = obs.groupBy("station", "year").agg(
        F.count(F.lit(1)).alias("n_obs"),
        *[part(F.col(x)).alias(f"{name}_{x}") for x in ("temp", "prcp")
          for name, part in (("sum", exact_part), ("other", other_part))],
        F.max("gust").alias("max_gust"))
    return summary_from_station_years(sy)


def climate_summary_from_cube(c: DataFrame) -> DataFrame:
    """K4 (typed) from the station-month cube."""
    sy = c.groupBy("station", "year").agg(
        F.sum("n_obs").alias("n_obs"),
        *[F.sum(f"{part}_{x}").alias(f"{part}_{x}") for x in ("temp", "prcp") for part in ("sum", "other")],
        F.max("max_gust").alias("max_gust"))
    return summary_from_station_years(sy)


def summary_from_station_years(sy: DataFrame) -> DataFrame:
    """The three facts from station-year aggregates; NULL / 0.0 when empty.

    Each fact is ``min(struct(-value, key))`` (highest value, lowest key) over
    its grouping set, in a global aggregation that always yields one row.
    """
    year_mean = joined_parts(F.col("sum_temp"), F.col("other_temp")) / F.col("n_obs")
    g = sy.withColumn("year_mean", year_mean).groupingSets(
        [["year"], ["station"]], "year", "station").agg(
        F.grouping_id().alias("gid"),
        F.avg("year_mean").alias("avg_temp"),
        joined_parts(F.sum("sum_prcp"), F.sum("other_prcp")).alias("total_prcp"),
        F.max("max_gust").alias("max_gust"))
    # grouping_id: bit set for each grouping column left out (year, station order).
    by_year, by_station = F.col("gid") == 1, F.col("gid") == 2

    def best(cond, value: str, key: str):
        return F.min(F.when(cond, F.struct((-F.col(value)).alias("neg"), F.col(key).alias("key"))))

    r = g.agg(best(by_year, "avg_temp", "year").alias("y"), best(by_station, "total_prcp", "station").alias("p"),
              best(by_station, "max_gust", "station").alias("g"))
    zero = F.lit(0.0)
    return r.select(
        F.col("y.key").alias("hottest_year"), F.coalesce(-F.col("y.neg"), zero).alias("hottest_year_temp"),
        F.col("p.key").alias("wettest_station"), F.coalesce(-F.col("p.neg"), zero).alias("wettest_station_prcp"),
        F.col("g.key").alias("gust_station"), F.coalesce(-F.col("g.neg"), zero).alias("highest_gust"))
