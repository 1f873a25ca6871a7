"""Metamorphic checks: the cube path equals the direct path; partitioning is irrelevant."""

from __future__ import annotations

import pytest

from stationlens.operators import climate, cube, parse
from stationlens.sources.tables import gsod_lines

SF = "/root/testdata/sf0.001"


def rows(df):
    """Sorted rows; a mean of DOUBLE means hangs on the order of its sum in the last digits."""
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def obs(spark):
    return parse.observations(gsod_lines(spark, SF)).cache()


@pytest.mark.parametrize("name", ["monthly_avg_temp", "yearly_avg_temp", "seasonal_avg_prcp", "station_max_temp",
                                  "extreme_events", "station_total_prcp", "station_max_gust",
                                  "station_total_temp", "highest_max_temp", "hottest_year",
                                  "wettest_station", "highest_gust"])
def test_cube_equals_direct(obs, name):
    c = cube.station_month_cube(obs)
    assert rows(getattr(cube, name)(c)) == rows(getattr(climate, name)(obs))


def test_event_totals_cube_equals_direct(obs):
    assert rows(cube.event_totals(cube.station_month_cube(obs))) == rows(climate.event_totals(obs))


@pytest.mark.parametrize("name", ["monthly_avg_temp", "seasonal_avg_prcp", "extreme_events", "hottest_year"])
def test_partitioning_is_irrelevant(obs, name):
    fn = getattr(climate, name)
    assert rows(fn(obs.repartition(1))) == rows(fn(obs.repartition(16)))


def test_summary_empty_input(spark, obs):
    r = climate.climate_summary(obs.limit(0)).first()
    assert (r.hottest_year, r.hottest_year_temp, r.wettest_station, r.highest_gust) == (None, 0.0, None, 0.0)
