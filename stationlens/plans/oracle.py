"""DuckDB oracle SQL for every registered query.

The oracle reads the typed columns of ``lineitem`` / ``supplier`` / ``nation``
directly (no raw text), applies the reference's validity, date, season and event
rules in plain SQL, and aggregates.  The Spark side goes through the raw text, so
a parser error cannot cancel out.
"""

from __future__ import annotations

# Fixed values shared with stationlens.sources.tables (the adapter).
_SRC = """
src AS (
  SELECT lpad(CAST(l_suppkey AS VARCHAR), 11, '0') AS station,
         l_suppkey AS suppkey, l_orderkey * 8 + l_linenumber AS line_pos,
         CASE WHEN l_orderkey % 61 = 0 AND l_linenumber = 1 THEN 27
              WHEN l_orderkey % 67 = 0 AND l_linenumber = 2 THEN 30
              WHEN l_suppkey % 2 = 1 THEN 29 ELSE 28 END AS n_fields,
         CASE WHEN l_orderkey % 53 = 0 THEN '1995-13-41' ELSE substr(CAST(l_shipdate AS VARCHAR), 1, 10) END AS date,
         CAST(CASE WHEN l_orderkey % 97 = 0 THEN 9999.9 WHEN l_orderkey % 7 = 0 THEN l_quantity + 0.125
                   ELSE l_quantity + 0.1 * l_linenumber END AS DECIMAL(18,3)) AS temp,
         CAST(CASE WHEN l_partkey % 89 = 0 THEN 9999.9 ELSE l_quantity + 20 END AS DECIMAL(18,2)) AS max_temp,
         CAST(l_quantity - 20 AS DECIMAL(18,2)) AS min_temp,
         CAST(CASE WHEN l_orderkey % 11 = 0 THEN 99.99 ELSE l_discount END AS DECIMAL(18,2)) AS prcp,
         CAST(l_tax * 100 AS DECIMAL(18,2)) AS wdsp,
         CAST(CASE WHEN l_partkey % 71 = 0 THEN NULL WHEN l_partkey % 13 = 0 THEN 999.9 ELSE l_quantity END AS DECIMAL(18,2)) AS gust,
         CASE WHEN l_linenumber = 7 THEN '123' ELSE concat(
           CAST(l_orderkey % 2 AS VARCHAR), CAST(l_partkey % 2 AS VARCHAR), CAST(l_suppkey % 2 AS VARCHAR),
           CASE WHEN l_orderkey % 50 = 0 THEN '1' ELSE '0' END,
           CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END, '0') END AS frshtt
  FROM lineitem),
valid AS (
  SELECT * FROM src
  WHERE n_fields IN (28, 29) AND abs(temp) < 999 AND abs(max_temp) < 999 AND abs(min_temp) < 999
    AND prcp < 999 AND wdsp < 999 AND gust < 999),
obs AS (
  SELECT *, CAST(year(CAST(date AS DATE)) AS INTEGER) AS year,
         CAST(month(CAST(date AS DATE)) AS INTEGER) AS month,
         CASE WHEN month(CAST(date AS DATE)) IN (12, 1, 2) THEN 'Winter'
              WHEN month(CAST(date AS DATE)) IN (3, 4, 5) THEN 'Spring'
              WHEN month(CAST(date AS DATE)) IN (6, 7, 8) THEN 'Summer'
              ELSE 'Autumn' END AS season
  FROM (SELECT * FROM valid WHERE TRY_CAST(date AS DATE) IS NOT NULL)),
flags AS (
  SELECT *,
    CASE WHEN length(frshtt) = 6 THEN substr(frshtt, 1, 1) = '1' END AS fog,
    CASE WHEN length(frshtt) = 6 THEN substr(frshtt, 2, 1) = '1' END AS rain,
    CASE WHEN length(frshtt) = 6 THEN substr(frshtt, 3, 1) = '1' END AS snow,
    CASE WHEN length(frshtt) = 6 THEN substr(frshtt, 4, 1) = '1' END AS hail,
    CASE WHEN length(frshtt) = 6 THEN substr(frshtt, 5, 1) = '1' END AS thunder,
    CASE WHEN length(frshtt) = 6 THEN substr(frshtt, 6, 1) = '1' END AS tornado
  FROM obs),
vflags AS (
  SELECT *,
    length(frshtt) = 6 AND substr(frshtt, 1, 1) = '1' AS fog,
    length(frshtt) = 6 AND substr(frshtt, 2, 1) = '1' AS rain,
    length(frshtt) = 6 AND substr(frshtt, 3, 1) = '1' AS snow,
    length(frshtt) = 6 AND substr(frshtt, 4, 1) = '1' AS hail,
    length(frshtt) = 6 AND substr(frshtt, 5, 1) = '1' AS thunder,
    length(frshtt) = 6 AND substr(frshtt, 6, 1) = '1' AS tornado
  FROM valid),
yearly AS (
  SELECT station, year, CAST(sum(temp) AS DOUBLE) / count(*) AS avg_temp FROM obs GROUP BY station, year),
year_means AS (
  SELECT year, avg(avg_temp) AS avg_temp FROM yearly GROUP BY year),
first_rows AS (
  SELECT suppkey, arg_min(n_fields, line_pos) AS n_fields FROM src GROUP BY suppkey),
dim AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR), 11, '0') AS station,
         concat(s_name, ', ', coalesce(n_name, '')) AS name,
         CAST((s_suppkey * 7) % 180 - 90 AS DOUBLE) AS latitude,
         CAST((s_suppkey * 13 + s_nationkey) % 360 - 180 AS DOUBLE) AS longitude,
         s_acctbal AS elevation
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
  WHERE s_suppkey % 17 <> 0 AND s_suppkey IN (SELECT suppkey FROM first_rows WHERE n_fields IN (28, 29)))
"""


def _q(body: str) -> str:
    return "WITH " + _SRC.strip() + "\n" + body.strip()


def _events(keys: str, source: str) -> str:
    sel = (keys + ", ") if keys else ""
    grp = f"GROUP BY {keys}" if keys else ""
    parts = [f"SELECT {sel}'{e}' AS event_type, count(*) FILTER (WHERE {e.lower()}) AS event_count FROM {source} {grp}"
             for e in ("Fog", "Rain", "Snow", "Hail", "Thunder", "Tornado")]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE event_count > 0"


_MONTHLY = "SELECT station, year, month, CAST(sum(temp) AS DOUBLE) / count(*) AS avg_temp FROM obs GROUP BY station, year, month"
_YEARLY = "SELECT station, year, avg_temp FROM yearly"
_SEASONAL = "SELECT station, year, season, CAST(sum(prcp) AS DOUBLE) / count(*) AS avg_prcp FROM obs GROUP BY station, year, season"
_HIGHEST_MAX = ("SELECT station, CAST(max(max_temp) AS DOUBLE) AS max_temp FROM obs GROUP BY station "
                "ORDER BY max_temp DESC, station LIMIT 10")
_HOTTEST = "SELECT year, avg_temp FROM year_means ORDER BY avg_temp DESC, year LIMIT 1"
_HOTTEST_SHOWN = "SELECT year, round(avg_temp, 6) AS avg_temp FROM (" + _HOTTEST + ")"
_WETTEST = ("SELECT station, CAST(sum(prcp) AS DOUBLE) AS total_prcp FROM obs GROUP BY station "
            "ORDER BY total_prcp DESC, station LIMIT 1")
_GUSTIEST = ("SELECT station, CAST(max(gust) AS DOUBLE) AS max_gust FROM obs GROUP BY station "
             "ORDER BY max_gust DESC, station LIMIT 1")
_SUMMARY = """
SELECT h.year AS hottest_year, coalesce(h.avg_temp, 0.0) AS hottest_year_temp,
       w.station AS wettest_station, coalesce(w.total_prcp, 0.0) AS wettest_station_prcp,
       g.station AS gust_station, coalesce(g.max_gust, 0.0) AS highest_gust
FROM (SELECT 1 AS k) one
LEFT JOIN (""" + _HOTTEST + """) h ON true
LEFT JOIN (""" + _WETTEST + """) w ON true
LEFT JOIN (""" + _GUSTIEST + """) g ON true
"""

ORACLE_SQL: dict[str, str] = {
    "observations_from_raw": _q(
        "SELECT station, date, year, month, season, CAST(temp AS DOUBLE) AS temp, CAST(max_temp AS DOUBLE) AS max_temp,"
        " CAST(min_temp AS DOUBLE) AS min_temp, CAST(prcp AS DOUBLE) AS prcp, CAST(wdsp AS DOUBLE) AS wdsp,"
        " CAST(gust AS DOUBLE) AS gust, frshtt, fog, rain, snow, hail, thunder, tornado FROM flags"),
    "field_layouts": _q("""
        SELECT n_fields, sum(n) AS lines FROM (
          SELECT n_fields, count(*) AS n FROM src GROUP BY 1
          UNION ALL SELECT 28 AS n_fields, count(*) AS n FROM supplier
          UNION ALL SELECT 28 AS n_fields, count(*) AS n FROM nation) GROUP BY n_fields"""),
    "ingest_profile": _q("""
        SELECT (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation) AS lines,
               (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation) AS headers,
               (SELECT count(*) FROM valid) AS valid_rows,
               (SELECT count(*) FROM obs) AS kept_rows,
               (SELECT count(DISTINCT station) FROM obs) AS stations"""),
    "monthly_avg_temp": _q(_MONTHLY),
    "yearly_avg_temp": _q(_YEARLY),
    "seasonal_avg_prcp": _q(_SEASONAL),
    "station_max_temp": _q("SELECT station, CAST(max(max_temp) AS DOUBLE) AS max_temp FROM obs GROUP BY station"),
    "extreme_events": _q(_events("station", "flags")),
    "event_totals": _q(_events("", "vflags")),
    "year_mean_of_stations": _q("SELECT year, round(avg_temp, 6) AS avg_temp FROM year_means"),
    "station_total_prcp": _q("SELECT station, CAST(sum(prcp) AS DOUBLE) AS total_prcp FROM obs GROUP BY station"),
    "station_max_gust": _q("SELECT station, CAST(max(gust) AS DOUBLE) AS max_gust FROM obs GROUP BY station"),
    "station_total_temp": _q("SELECT station, CAST(sum(temp) AS DOUBLE) AS total_temp FROM valid GROUP BY station"),
    "distinct_stations": _q("SELECT count(DISTINCT station) AS stations FROM obs"),
    "highest_max_temp": _q(_HIGHEST_MAX),
    "hottest_year": _q(_HOTTEST_SHOWN),
    "wettest_station": _q(_WETTEST),
    "highest_gust": _q(_GUSTIEST),
    "max_gust_record": _q("SELECT station, CAST(gust AS DOUBLE) AS gust FROM valid ORDER BY gust DESC, station LIMIT 1"),
    "climate_summary": _q("SELECT * REPLACE (round(hottest_year_temp, 6) AS hottest_year_temp) FROM (" + _SUMMARY + ")"),
    "summary_lines": _q("""
        SELECT 'Hottest year: ' || coalesce(CAST(hottest_year AS VARCHAR), 'None') || ' with avg temp ' || printf('%.2f', hottest_year_temp) AS line FROM (""" + _SUMMARY + """)
        UNION ALL SELECT 'Wettest station: ' || coalesce(wettest_station, 'None') || ' with total prcp ' || printf('%.2f', wettest_station_prcp) FROM (""" + _SUMMARY + """)
        UNION ALL SELECT 'Highest gust: ' || coalesce(gust_station, 'None') || ' with ' || printf('%.2f', highest_gust) FROM (""" + _SUMMARY + ")"),
    "station_month_cube": _q("""
        SELECT station, year, month, season, count(*) AS n_obs,
               CAST(sum(temp) AS DOUBLE) AS sum_temp, CAST(sum(prcp) AS DOUBLE) AS sum_prcp,
               count(prcp) AS n_prcp,
               CAST(max(max_temp) AS DOUBLE) AS max_max_temp, CAST(max(gust) AS DOUBLE) AS max_gust,
               count(*) FILTER (WHERE fog) AS fog, count(*) FILTER (WHERE rain) AS rain,
               count(*) FILTER (WHERE snow) AS snow, count(*) FILTER (WHERE hail) AS hail,
               count(*) FILTER (WHERE thunder) AS thunder, count(*) FILTER (WHERE tornado) AS tornado
        FROM flags GROUP BY station, year, month, season"""),
    "monthly_avg_temp_from_cube": _q(_MONTHLY),
    "yearly_avg_temp_from_cube": _q(_YEARLY),
    "seasonal_avg_prcp_from_cube": _q(_SEASONAL),
    "extreme_events_from_cube": _q(_events("station", "flags")),
    "highest_max_temp_from_cube": _q(_HIGHEST_MAX),
    "hottest_year_from_cube": _q(_HOTTEST_SHOWN),
    "wettest_station_from_cube": _q(_WETTEST),
    "highest_gust_from_cube": _q(_GUSTIEST),
    "station_dimension": _q("SELECT station, name, latitude, longitude, elevation FROM dim"),
    "station_centre": _q("""
        SELECT CAST(sum(CAST(latitude AS DECIMAL(30,10))) AS DOUBLE) / count(*) AS centre_latitude,
               CAST(sum(CAST(longitude AS DECIMAL(30,10))) AS DOUBLE) / count(*) AS centre_longitude FROM dim"""),
    "station_markers": _q("""
        SELECT station, latitude, longitude, name || ' (' || station || ')' AS tooltip,
               printf('%.4f', latitude) || '°' AS latitude_text, printf('%.4f', longitude) || '°' AS longitude_text,
               CAST(round(CAST(elevation AS DECIMAL(18,2)), 1) AS VARCHAR) || ' m' AS elevation_text FROM dim"""),
    "extraction_report": _q("""
        SELECT (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation) AS files,
               (SELECT count(*) FROM dim) AS stations,
               (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation) - (SELECT count(*) FROM dim) AS failed_files"""),
    "seasonal_avg_prcp_strict": _q(
        "SELECT station, year, season, CAST(sum(prcp) AS DOUBLE) / nullif(count(prcp), 0) AS avg_prcp FROM ("
        "SELECT station, year, season, nullif(prcp, 99.99) AS prcp FROM obs) GROUP BY station, year, season"),
    "wettest_station_strict": _q(
        "SELECT station, CAST(sum(nullif(prcp, 99.99)) AS DOUBLE) AS total_prcp FROM obs GROUP BY station "
        "ORDER BY total_prcp DESC NULLS LAST, station LIMIT 1"),
    # jobs on files that Spark renders from the tables
    "lines_of_files": _q("""
        SELECT n AS lines, count(*) AS files FROM (
          SELECT suppkey, count(*) + 1 AS n FROM src GROUP BY suppkey
          UNION ALL SELECT s_suppkey, 1 FROM supplier WHERE s_suppkey NOT IN (SELECT suppkey FROM src)
          UNION ALL SELECT -1 - n_nationkey, 1 FROM nation) GROUP BY n"""),
    "first_row_per_file": _q("""
        SELECT lpad(CAST(suppkey AS VARCHAR), 11, '0') AS station, arg_min(n_fields, line_pos) AS n_fields,
               arg_min(date, line_pos) AS date FROM src GROUP BY suppkey"""),
    "climate_job_monthly": _q(_MONTHLY),
    "climate_job_events": _q(_events("station", "flags")),
    "climate_job_report": _q("""
        SELECT (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation) AS lines,
               (SELECT count(*) FROM valid) AS valid_rows, (SELECT count(*) FROM obs) AS kept_rows,
               (SELECT count(DISTINCT station) FROM obs) AS stations"""),
    "climate_job_files": _q("""
        SELECT result, CASE WHEN result IN ('highest_max_temp', 'summary') OR (SELECT count(*) FROM obs) < 100000
                            THEN 1 ELSE 4 END AS files
        FROM (VALUES ('monthly_avg_temp'), ('yearly_avg_temp'), ('seasonal_prcp'), ('highest_max_temp'),
                     ('extreme_events'), ('summary')) t(result)"""),
    "preview_lines": "SELECT substr(text, 1, 200) AS line FROM documents ORDER BY doc_id LIMIT 3",
    "station_job_markers": _q("""
        SELECT station, latitude, longitude, name || ' (' || station || ')' AS tooltip,
               printf('%.4f', latitude) || '°' AS latitude_text, printf('%.4f', longitude) || '°' AS longitude_text,
               CAST(round(CAST(elevation AS DECIMAL(18,2)), 1) AS VARCHAR) || ' m' AS elevation_text FROM dim"""),
    # A station is one file here: none of the tables has one of a million lines.
    "jobs_without_input": """
        WITH n AS (SELECT (SELECT count(*) FROM nation) AS empty, (SELECT count(*) FROM supplier) AS stations,
                          (SELECT count(*) FROM lineitem) AS readings)
        SELECT t.input, t.job, true AS error, false AS written,
               CASE WHEN t.input = 'missing' THEN NULL
                    WHEN t.input = 'header only' THEN empty
                    WHEN t.job = 'climate' THEN empty + stations + readings
                    ELSE empty + stations END AS seen
        FROM n, (VALUES ('header only', 'climate'), ('header only', 'stations'), ('missing', 'climate'),
                        ('missing', 'stations'), ('none valid', 'climate'), ('none valid', 'stations')) t(input, job)""",
    "tokenise_odd_lines": """
        SELECT CAST(c_custkey AS BIGINT) AS id, 3 AS n_fields, c_name AS first,
               CASE c_custkey % 4 WHEN 0 THEN CAST(c_nationkey AS VARCHAR) || '"' || c_mktsegment WHEN 1 THEN CAST(c_nationkey AS VARCHAR) || ',' || c_mktsegment
                 WHEN 2 THEN CAST(c_nationkey AS VARCHAR) || c_mktsegment || '"' ELSE ' "' || CAST(c_nationkey AS VARCHAR) || '"' END AS second,
               CASE c_custkey % 4 WHEN 2 THEN ',' ELSE c_mktsegment END AS third
        FROM customer""",
}
