"""Print the physical plans of the key queries (the adaptive plan as planned;
AQE may still coalesce partitions or demote joins at run time).
Usage: python scripts/show_plans.py [sf_dir] > docs/plans.txt"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from stationlens.operators import climate, cube, parse, stations  # noqa: E402
from stationlens.session import local_session  # noqa: E402
from stationlens.sources.tables import gsod_lines  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session()
    lines = gsod_lines(spark, sf_dir)
    obs = parse.observations(lines)
    shown = {
        "station_month_cube (one scan, partial aggregate, one exchange)": cube.station_month_cube(obs),
        "climate_summary (station-year aggregate, grouping sets, global pick)": climate.climate_summary(obs),
        "station_dimension (window with group limit, min_by)": stations.station_dimension(lines),
        "highest_max_temp (TakeOrderedAndProject)": climate.highest_max_temp(obs),
    }
    for title, df in shown.items():
        print("=" * 100)
        print(title)
        print("=" * 100)
        print(df._jdf.queryExecution().executedPlan().toString())


if __name__ == "__main__":
    main()
