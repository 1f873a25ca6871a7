"""FRSHTT weather-event flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six FRSHTT positions, in order.
EVENT_NAMES = ("Fog", "Rain", "Snow", "Hail", "Thunder", "Tornado")


def event_flag(frshtt: Column, position: int) -> Column:
    """BOOLEAN flag of one position (0-based); NULL when the code is not 6 long."""
    return F.when(F.length(frshtt) == 6, F.substring(frshtt, position + 1, 1) == F.lit("1"))


def decode_events(frshtt: Column) -> Column:
    """``MAP<STRING,BOOLEAN>`` of the six flags; an empty map unless 6 characters."""
    names = F.array(*[F.lit(n) for n in EVENT_NAMES])
    flags = F.array(*[F.substring(frshtt, i + 1, 1) == F.lit("1") for i in range(len(EVENT_NAMES))])
    empty = F.create_map().cast("map<string,boolean>")
    return F.when(F.length(frshtt) == 6, F.map_from_arrays(names, flags)).otherwise(empty)
