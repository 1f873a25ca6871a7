"""Writers for small GSOD-style CSV inputs used by the tests."""

from __future__ import annotations

import os

from stationlens.sources.tables import GSOD_COLUMNS

HEADER_PADDED = ", ".join(f'"{c}"' for c in GSOD_COLUMNS)
HEADER_COMPACT = ",".join(f'"{c}"' for c in GSOD_COLUMNS)


def gsod_line(station, date, temp, max_t, min_t, prcp, wdsp, gust, frshtt, *, name="TEST STATION, NO",
              lat="70.9333333", lon="-8.6666667", elev="9.0", padded=True):
    vals = {"STATION": station, "DATE": date, "LATITUDE": lat, "LONGITUDE": lon, "ELEVATION": elev,
            "NAME": name, "TEMP": temp, "MAX": max_t, "MIN": min_t, "PRCP": prcp, "WDSP": wdsp,
            "GUST": gust, "FRSHTT": frshtt}
    fields = []
    for c in GSOD_COLUMNS:
        v = vals.get(c, " 8" if c.endswith("_ATTRIBUTES") else "999.9")
        if padded and c in ("TEMP", "MAX", "MIN", "PRCP", "WDSP", "GUST"):
            v = f"{v:>6}"
        fields.append(f'"{v}"')
    return (", " if padded else ",").join(fields)


def write_files(directory: str, files: dict[str, list[str]]) -> str:
    os.makedirs(directory, exist_ok=True)
    for name, lines in files.items():
        with open(os.path.join(directory, name), "w") as f:
            f.write("".join(line + "\n" for line in lines))
    return directory
