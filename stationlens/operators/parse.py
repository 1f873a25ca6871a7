"""From raw lines to typed observations (P1-P7), column expressions only.

``parsed_lines`` -> ``valid_records`` -> ``observations``.  Every step is a
narrow projection/filter that Catalyst fuses into the scan's stage; nothing
here shuffles.

Expensive per-line expressions (the tokeniser, the parsed record, the date)
are evaluated behind ``explode(array(x))``: a predicate on a generator's output
cannot be pushed below the generator, so Catalyst cannot copy the tokeniser into
every pushed-down filter term.  Without this barrier the validity filter
inlines ``tokenize`` dozens of times and the generated code overflows 64 KB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date, season
from ..functions.events import EVENT_NAMES, decode_events, event_flag
from ..functions.text import ALL_RAW, VALUES, between_quotes, csv_value, py_strip, split_fields, strip_quotes
from ..functions.values import below_missing, parse_float

# Position of each used field in the 28-field layout.  In the
# 29-field layout (a station name split at its comma) every index from TEMP on
# is one higher.
FIELD_INDEX = {"STATION": 0, "DATE": 1, "TEMP": 6, "WDSP": 16, "GUST": 19,
               "MAX": 20, "MIN": 22, "PRCP": 24, "FRSHTT": 27}
LAYOUT_SIZES = (28, 29)

# (output column, source field, validity uses abs())
MEASURES = (("temp", "TEMP", True), ("max_temp", "MAX", True), ("min_temp", "MIN", True),
            ("prcp", "PRCP", False), ("wdsp", "WDSP", False), ("gust", "GUST", False))
MEASURE_COLUMNS = tuple(m[0] for m in MEASURES)

# Fixed value: stands before each used field of a plain line, which has no control character there.
MARK = "\u0001"


def once(expr: Column) -> Column:
    """Evaluate ``expr`` once per row, as a generator output (see module doc)."""
    return F.explode(F.array(expr))


def _tokens_all(lines: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """``_t`` (the line's fields) and ``_k`` (which of them are still raw tokens)."""
    quoted = lines.select(*keep, "value", between_quotes(F.col("value")).alias("_q"))
    f = quoted.select(*keep, once(split_fields(F.col("value"), F.col("_q"))).alias("_f"))
    return f.select(*keep, F.col("_f.kind").alias("_k"), F.col("_f.v").alias("_t"))


def _raw_token(name: str, t: Column) -> Column:
    """Field of one used column, taken by position (P2); NULL where the line has none."""
    idx = FIELD_INDEX[name]
    return F.get(t, F.lit(idx) if idx < 2 else F.size(t) - F.lit(28 - idx))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _any_record(line: Column) -> Column:
    """The record of any line, by the exact expressions."""
    names = ("STATION", "DATE", *[source for _, source, _ in MEASURES], "FRSHTT")

    def tokens(f: Column) -> Column:
        return F.struct(F.size(f["v"]).alias("n"), f["kind"].alias("k"), *[_raw_token(x, f["v"]).alias(x) for x in names])

    def texts(t: Column) -> Column:
        def value(name: str) -> Column:
            raw = (t["k"] != VALUES) if FIELD_INDEX[name] == 0 else (t["k"] == ALL_RAW)
            return strip_quotes(py_strip(F.when(raw, csv_value(t[name])).otherwise(t[name])))
        return F.struct(t["n"].alias("n"), *[value(x).alias(x) for x in names])

    def numbers(v: Column) -> Column:
        return F.struct(v.alias("v"), *[py_strip(v[source]).alias(source) for _, source, _ in MEASURES])

    def record(x: Column) -> Column:
        v = x["v"]
        return F.struct(
            v["n"].isin(*LAYOUT_SIZES).alias("layout_ok"), v["STATION"].alias("station"), v["DATE"].alias("date"),
            *[parse_float(x[source], stripped=True).alias(name) for name, source, _ in MEASURES], v["FRSHTT"].alias("frshtt"))

    return _let(split_fields(line), lambda f: _let(tokens(f), lambda t: _let(texts(t), lambda v: _let(numbers(v), record))))


def plain_line() -> tuple[str, str]:
    """Pattern of a plain line, and its replacement: :data:`MARK` before each used field, in file order.

    A line is plain in one of two shapes (see :func:`split_fields`), whose fields can be told without
    the reader's state machine: each quoted and no quote between, or no quote after a comma and the first
    field quoted whole or not at all.  The used fields have no whitespace but spaces around them, and
    readings are of digits with a sign or a point at most, or of letters and slashes alone ("n/a", "inf"):
    a cast reads both as Python does.  A text between spaces and quotes is not plain in the second shape,
    as there its spaces stay.

    Runs that end before a character which is none of theirs are greedy: Java reads these in a loop of
    their own, possessive ones step by step.  Where spaces could be shared out they stay possessive.
    """
    word, number = r"[!#-+\--~]*", r"[+-]?+[0-9]+(?:\.[0-9]*)?+|[A-Za-z/]+"
    readings = {source for _, source, _ in MEASURES}
    indexes = {i: number if n in readings else word for n, i in FIELD_INDEX.items()}

    # The layouts differ in the fields between DATE and TEMP: ``likely`` is "?" to try the shorter one first.
    def line(first: str, comma: str, text: str, reading: str, other: str, likely: str) -> str:
        out, skipped = first, 0
        for i in range(1, LAYOUT_SIZES[0]):
            if i not in indexes:
                skipped += 1
                continue
            n = f"{{{skipped}}}" if i != FIELD_INDEX["TEMP"] else f"{{{skipped},{skipped + LAYOUT_SIZES[1] - LAYOUT_SIZES[0]}}}{likely}"
            out += (f"(?:{comma}{other}){n}" if skipped else "") + comma + (reading if indexes[i] == number else text) % f"({indexes[i]})"
            skipped = 0
        return out

    quoted = '" *+%s *+"'
    first = quoted % f"({word})"
    compact = line(first, ",", quoted, quoted, '"[^"]*"', "?")
    padded = line(f"(?:{first}| *+({word}) *+)", ',(?!")', ' *+"?+%s"?+ *+', ' *+"?+ *+%s *+"?+ *+', "[^,]*", "")
    n = len(FIELD_INDEX)
    # The second shape's first field has two groups; a group that took no part is empty.
    groups = [f"$1${n + 1}${n + 2}", *[f"${i}${i + n + 1}" for i in range(2, n + 1)]]
    return rf"^(?:{compact}|{padded})\z", "".join(MARK + g for g in groups)


def parsed_lines(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every line with ``layout_ok``, the used fields and the six readings as DOUBLE.

    Nothing is filtered here; :func:`valid_records` and :func:`ingest_profile`
    decide.  Almost all lines are plain (:func:`plain_line`): one pattern takes their used fields, and a cast
    reads the numbers.  For the others the exact expressions stand in ``transform`` over
    one-element arrays, which Spark evaluates outside the generated loops; these so stay
    short enough for the JIT compiler (8,000 bytes).  The record is computed behind a
    generator barrier, so the validity filter that follows cannot be pushed into (and
    duplicate) it.
    """
    f = lines.select(*keep, "value", F.regexp_replace("value", *plain_line()).alias("_r"))
    columns = {"STATION": "station", "DATE": "date", "FRSHTT": "frshtt", **{s: d for d, s, _ in MEASURES}}
    # A plain line has no mark of its own.  A missing line is none of them and has no text to go by.
    plain = F.coalesce(F.col("_r").startswith(MARK) & ~F.col("value").startswith(MARK), F.lit(False))
    f = f.select(*keep, plain.alias("_plain"), "value", once(F.split("_r", MARK, -1)).alias("_t"))
    f = f.select(*keep, "_plain", *[F.get("_t", F.lit(i + 1)).alias(columns[s]) for i, s in enumerate(FIELD_INDEX)],
                 F.when(~F.col("_plain"), _any_record(F.col("value"))).alias("_odd"))
    record = F.struct(F.lit(True).alias("layout_ok"), F.col("station"), F.col("date"),
                      *[F.col(d).try_cast("double").alias(d) for d in MEASURE_COLUMNS], F.col("frshtt"))
    p = f.select(*keep, once(F.when(F.col("_plain"), record).otherwise(F.col("_odd"))).alias("_p"))
    return p.select(*keep, "_p.*")


def validity(measures: tuple[str, ...] = MEASURE_COLUMNS) -> Column:
    """TEMP, MAX, MIN need ``abs(x) < 999``; PRCP, WDSP, GUST only ``x < 999``.

    NULL (unparseable) is invalid; NaN fails both tests, as in Python.
    """
    ok = None
    for dst, _, absolute in MEASURES:
        if dst in measures:
            c = below_missing(F.col(dst), absolute)
            ok = c if ok is None else ok & c
    return ok


def valid_records(lines: DataFrame, keep: tuple[str, ...] = (), prcp_missing: float | None = None) -> DataFrame:
    """Records whose six readings all parse and are not missing markers.

    Schema: ``station, date, temp, max_temp, min_temp, prcp, wdsp, gust DOUBLE,
    frshtt``.  PRCP 99.99 (GSOD's own missing code) is kept as a reading, as in the
    reference, unless ``prcp_missing`` names it: then PRCP of such a record is NULL and
    counts in no sum or mean, and the record stays.
    """
    records = (parsed_lines(lines, keep).filter(F.col("layout_ok") & validity())
               .select(*keep, "station", "date", *MEASURE_COLUMNS, "frshtt"))
    if prcp_missing is None:
        return records
    return records.withColumn("prcp", F.when(F.col("prcp") != F.lit(prcp_missing), F.col("prcp")))


def with_date_parts(records: DataFrame) -> DataFrame:
    """Add ``obs_date, year, month, season`` (P4, P5); NULL where the date is invalid."""
    d = records.select("*", once(parse_date(F.col("date"))).alias("obs_date"))
    return (d.withColumn("year", F.year("obs_date"))
            .withColumn("month", F.month("obs_date"))
            .withColumn("season", season(F.col("month"))))


def observations(lines: DataFrame, keep: tuple[str, ...] = (), prcp_missing: float | None = None) -> DataFrame:
    """Typed observations (P7): valid records with a valid date, plus event map.

    Schema: ``station, date, obs_date, year, month, season, temp, max_temp,
    min_temp, prcp, wdsp, gust (DOUBLE), frshtt, events MAP<STRING,BOOLEAN>``.
    """
    return observations_from_records(valid_records(lines, keep, prcp_missing), keep)


def observations_from_records(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """P4-P7 on valid records: add date parts, drop invalid dates, decode events."""
    obs = with_date_parts(records).filter(F.col("obs_date").isNotNull())
    return obs.select(*keep, "station", "date", "obs_date", "year", "month", "season",
                      *MEASURE_COLUMNS, "frshtt", decode_events(F.col("frshtt")).alias("events"))


# What becomes of a line.
KEPT, UNDATED, REJECTED = "kept", "undated", "rejected"


def lines_with_outcome(lines: DataFrame) -> DataFrame:
    """Every line with its ``outcome``; kept ones also with their observation.

    ``rejected`` lines (headers among them) are no valid record (P2, P3), ``undated`` ones are, but
    have no valid date (P4).  Station and date parts are NULL in both.
    """
    p = parsed_lines(lines)
    ok = F.coalesce(F.col("layout_ok") & validity(), F.lit(False))
    d = p.select("*", once(F.struct(ok.alias("ok"), F.when(ok, parse_date(F.col("date"))).alias("day"))).alias("_d"))
    day = F.col("_d.day")
    outcome = F.when(day.isNotNull(), F.lit(KEPT)).when(F.col("_d.ok"), F.lit(UNDATED)).otherwise(F.lit(REJECTED))
    return d.select(
        outcome.alias("outcome"), F.when(day.isNotNull(), F.col("station")).alias("station"), F.year(day).alias("year"),
        F.month(day).alias("month"), season(F.month(day)).alias("season"), *MEASURE_COLUMNS, "frshtt")


def event_columns(obs: DataFrame) -> DataFrame:
    """Observation rows with the six flags as BOOLEAN columns (NULL: no 6-char code)."""
    return obs.select("*", *[event_flag(F.col("frshtt"), i).alias(n.lower()) for i, n in enumerate(EVENT_NAMES)])


def ingest_profile(lines: DataFrame) -> DataFrame:
    """S4 + S6 + A11 in one pass: ``lines, headers, valid_rows, kept_rows, stations``.

    ``valid_rows`` counts records passing P2/P3, ``kept_rows`` those that also
    have a valid date (P4).  A header line (first field ``STATION``) never
    passes P3, so dropping it (S6) changes no other count.
    """
    p = parsed_lines(lines)
    valid = F.col("layout_ok") & validity()
    kept = valid & parse_date(F.col("date")).isNotNull()
    return p.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.coalesce(F.col("station") == F.lit("STATION"), F.lit(False))).alias("headers"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(kept).alias("kept_rows"),
        F.count_distinct(F.when(kept, F.col("station"))).alias("stations"))
