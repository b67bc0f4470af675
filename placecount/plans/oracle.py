"""The same queries as SQL over the given tables."""

from __future__ import annotations

from placecount.plans.catalog import FROM, HALF, HOURS, MORNING, NIGHT, OTHER_PLACE, PLACE, TO, TODAY
from placecount.roles import OBS_COLUMNS

_EVENTS = """
obs AS (
  SELECT CAST(ts AS DATE) AS obs_date,
         CAST(user_id AS VARCHAR) AS place,
         lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':00' AS slot,
         CAST(hour(ts) AS INTEGER) AS hour,
         CAST(floor(value) AS INTEGER) AS v,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS incidents,
         event_type AS condition,
         event_type AS weather,
         CAST(isodow(ts) AS INTEGER) AS dow,
         CAST(hour(ts) * 3600 AS INTEGER) AS slot_no,
         event_id AS seq
  FROM events)"""

# Events after the roughening of the raw files; missing counts still null.
_RAW = (
    _EVENTS.replace("obs AS", "whole AS")
    + """,
obs AS (
  SELECT obs_date,
         CASE WHEN condition = 'click' AND place = '7' THEN NULL ELSE place END AS place,
         slot, hour,
         CASE WHEN condition IN ('purchase', 'signup') THEN NULL ELSE v END AS v,
         incidents, condition, weather, dow, seq
  FROM whole)"""
)

_LINEITEM = """
obs AS (
  SELECT CAST(l_shipdate AS DATE) AS obs_date,
         CAST(l_suppkey AS VARCHAR) AS place,
         lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') AS slot,
         CAST(floor(l_quantity) AS INTEGER) AS v,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS incidents,
         l_returnflag AS condition, l_linestatus AS weather,
         l_orderkey, l_linenumber, l_partkey
  FROM lineitem)"""

_ORDERS = """
obs AS (
  SELECT CAST(o_orderdate AS DATE) AS obs_date,
         CAST(o_custkey AS VARCHAR) AS place,
         lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS slot,
         CAST(floor(o_totalprice) AS INTEGER) AS v,
         o_orderkey AS seq
  FROM orders)"""

_EVENT_ORDER = "obs_date DESC, slot DESC, seq DESC"
_LINEITEM_ORDER = "obs_date DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, v DESC"


def _latest(order: str, keys: str = "place") -> str:
    return f"""
latest AS (
  SELECT {keys}, v FROM (
    SELECT {keys}, v, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS r
    FROM obs WHERE place IS NOT NULL AND v IS NOT NULL) ranked
  WHERE r = 1)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_L1 = _with(_EVENTS, _latest(_EVENT_ORDER))
_L1_RAW = _with(_RAW, _latest(_EVENT_ORDER))
_L1_LINEITEM = _with(_LINEITEM, _latest(_LINEITEM_ORDER))
_L1_ORDERS = _with(_ORDERS, _latest("obs_date DESC, seq DESC"))
_L2_ORDER = "obs_date DESC, seq DESC"
_L2 = _with(_EVENTS, _latest(_L2_ORDER, "place, slot"))
_L2_RAW = _with(_RAW, _latest(_L2_ORDER, "place, slot"))

_BAND = """CASE WHEN hour >= 6 AND hour < 12 THEN 'Morning (6:00-12:00)'
            WHEN hour >= 12 AND hour < 16 THEN 'Afternoon (12:00-16:00)'
            WHEN hour >= 16 AND hour < 20 THEN 'Evening (16:00-20:00)'
            WHEN hour >= 20 OR hour < 6 THEN 'Night (20:00-6:00)' END"""
_PERIOD = f"obs_date BETWEEN DATE '{FROM}' AND DATE '{TO}'"


def _selected(band: str, place: str | None = None) -> str:
    one = f" AND place = '{place}'" if place else ""
    return f"{_PERIOD} AND {_BAND} = '{band}'{one}"


_FIGURES = """CAST(count(v) AS BIGINT) AS n, CAST(sum(v) AS BIGINT) AS total_v,
       avg(v) AS avg_v, max(v) AS max_v, min(v) AS min_v,
       CAST(sum(incidents) AS BIGINT) AS total_incidents"""
_TOTAL = "CAST(sum(v) AS BIGINT) AS total_v"
_N = "CAST(count(*) AS BIGINT) AS n"
_DAILY = f"SELECT place, obs_date, {_TOTAL} FROM obs"
_DAILY_N = f"""SELECT place, obs_date, {_TOTAL}, CAST(count(v) AS BIGINT) AS n
FROM obs GROUP BY place, obs_date"""
_DATA = "obs_date, place, slot, hour, v, incidents, condition, weather, dow"


def _rounded(x: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal form, as text."""
    return (
        f"CAST(CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(30, 12)), {digits})"
        f" AS DECIMAL(30, {digits})) AS VARCHAR)"
    )


_PEAKS = f"""
peaks AS (
  SELECT place, obs_date AS peak_date, slot AS peak_slot, v AS peak_v FROM (
    SELECT *, row_number() OVER (
      PARTITION BY place ORDER BY v DESC, obs_date, slot, seq) AS r FROM obs) ranked
  WHERE r = 1),
figures AS (SELECT place, {_FIGURES} FROM obs GROUP BY place)"""

_HISTOGRAM = """,
width AS (SELECT max(v) // 5 AS w FROM latest),
bins AS (SELECT * FROM (VALUES (0), (1), (2), (3), (4)) b(bin)),
placed AS (
  SELECT CASE WHEN v <= w THEN 0 WHEN v <= 2 * w THEN 1 WHEN v <= 3 * w THEN 2
              WHEN v <= 4 * w THEN 3 ELSE 4 END AS bin
  FROM latest, width)
SELECT bins.bin,
       CAST(CASE WHEN bins.bin = 0 THEN 0 ELSE w * bins.bin + 1 END AS VARCHAR)
         || CASE WHEN bins.bin = 4 THEN '+' ELSE '-' || CAST(w * (bins.bin + 1) AS VARCHAR) END
         AS label,
       CAST(count(placed.bin) AS BIGINT) AS n
FROM bins CROSS JOIN width LEFT JOIN placed ON placed.bin = bins.bin
GROUP BY bins.bin, w"""

_QUARTILES = """,
ranked AS (
  SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n FROM latest),
cuts AS (
  SELECT max(CASE WHEN i = n // 4 THEN v END) AS q1,
         max(CASE WHEN i = n // 2 THEN v END) AS q2,
         max(CASE WHEN i = 3 * n // 4 THEN v END) AS q3
  FROM ranked)"""

_SHARES = """,
classed AS (
  SELECT CASE WHEN v <= q1 THEN 0 WHEN v <= q2 THEN 1 WHEN v <= q3 THEN 2 ELSE 3 END AS class
  FROM latest, cuts),
classes AS (
  SELECT 0 AS class, 'Low Traffic (0-' || q1 || ')' AS label FROM cuts
  UNION ALL SELECT 1, 'Medium-Low (' || (q1 + 1) || '-' || q2 || ')' FROM cuts
  UNION ALL SELECT 2, 'Medium-High (' || (q2 + 1) || '-' || q3 || ')' FROM cuts
  UNION ALL SELECT 3, 'High Traffic (>' || q3 || ')' FROM cuts)
SELECT classes.class, label, CAST(count(classed.class) AS BIGINT) AS n,
       CAST(count(classed.class) AS DOUBLE) / (SELECT count(*) FROM latest) * 100 AS pct
FROM classes LEFT JOIN classed ON classed.class = classes.class
GROUP BY classes.class, label"""

_POINTS = " SELECT row_number() OVER (ORDER BY place) - 1 AS idx, place, v FROM latest"

_TREND = """,
ends AS (SELECT min(slot) AS first_slot, max(slot) AS last_slot FROM obs),
pairs AS (
  SELECT place, max(CASE WHEN slot = first_slot THEN v END) AS first_v,
         max(CASE WHEN slot = last_slot THEN v END) AS last_v
  FROM latest, ends WHERE first_slot <> last_slot GROUP BY place)
SELECT place, first_v, last_v, (last_v - first_v) / CAST(first_v AS DOUBLE) * 100 AS pct_change
FROM pairs WHERE first_v > 0 AND last_v IS NOT NULL"""


def _compare(a: str, b: str) -> str:
    return f"""{_L2}
SELECT slot, max(CASE WHEN place = '{a}' THEN v END) AS v_a,
       max(CASE WHEN place = '{b}' THEN v END) AS v_b
FROM latest WHERE place IN ('{a}', '{b}') GROUP BY slot"""


def _load_counts() -> str:
    rows = [
        f"SELECT {i} AS position, '{c}' AS name, '{t}' AS dtype, "
        f"CAST(count({c}) AS BIGINT) AS non_null, CAST(count(*) AS BIGINT) AS n_rows FROM obs"
        for i, (c, t) in enumerate(OBS_COLUMNS.items())
    ]
    return f"{_with(_EVENTS)} " + " UNION ALL ".join(rows)


_REPORT_TEXT = f"""
SELECT figures.place,
       'TRAFFIC CONGESTION REPORT' || chr(10) || '==========================' || chr(10)
       || 'Junction: ' || figures.place || chr(10)
       || 'Period: {FROM} to {TO}' || chr(10)
       || 'Time Range: {NIGHT}' || chr(10) || chr(10)
       || 'Total Records: ' || n || chr(10)
       || 'Total Vehicles: ' || total_v || chr(10)
       || 'Average Vehicles: ' || {_rounded("avg_v", 2)} || chr(10)
       || 'Maximum Vehicles: ' || max_v || chr(10)
       || 'Minimum Vehicles: ' || min_v || chr(10)
       || 'Total Accidents: ' || total_incidents || chr(10) AS report,
       'Peak Congestion: ' || peak_date || ' at ' || peak_slot || ' with ' || peak_v
       || ' vehicles' AS peak
FROM figures JOIN peaks ON figures.place = peaks.place"""

# Ridge regression of the count in closed form. The places' dummies are solved for first:
# each is a shrunk mean of what hour and weekday leave of its place. That leaves three
# unknowns, the intercept and two slopes, here by Cramer's rule. The penalty of 0.1 is in
# units of the deviations of count and input.
_COUNT_MODEL = """,
whole AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, stddev_pop(v) AS sd, avg(v) AS my,
         var_pop(hour) AS vh, var_pop(dow) AS vd FROM obs),
by_place AS (
  SELECT place, CAST(count(*) AS DOUBLE) AS np, avg(v) AS y, avg(CAST(hour AS DOUBLE)) AS h,
         avg(CAST(dow AS DOUBLE)) AS d FROM obs GROUP BY place),
shrunk AS (
  SELECT by_place.*, 1 / (1 + 0.1 / sd * (1 - np / n)) AS s FROM by_place, whole),
raw AS (
  SELECT sum(CAST(hour AS DOUBLE)) AS h, sum(CAST(dow AS DOUBLE)) AS d, sum(CAST(v AS DOUBLE)) AS y,
         sum(CAST(hour * hour AS DOUBLE)) AS hh, sum(CAST(hour * dow AS DOUBLE)) AS hd,
         sum(CAST(dow * dow AS DOUBLE)) AS dd, sum(CAST(hour AS DOUBLE) * v) AS hy,
         sum(CAST(dow AS DOUBLE) * v) AS dy FROM obs),
m AS (
  SELECT max(n) - sum(s * np) AS a11, max(raw.h) - sum(s * np * shrunk.h) AS a12,
         max(raw.d) - sum(s * np * shrunk.d) AS a13,
         max(hh) - sum(s * np * shrunk.h * shrunk.h) + max(n * 0.1 / sd * vh) AS a22,
         max(hd) - sum(s * np * shrunk.h * shrunk.d) AS a23,
         max(dd) - sum(s * np * shrunk.d * shrunk.d) + max(n * 0.1 / sd * vd) AS a33,
         max(raw.y) - sum(s * np * shrunk.y) AS b1, max(hy) - sum(s * np * shrunk.h * shrunk.y) AS b2,
         max(dy) - sum(s * np * shrunk.d * shrunk.y) AS b3
  FROM shrunk, raw, whole),
det AS (
  SELECT *, a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13)
            + a13 * (a12 * a23 - a22 * a13) AS det FROM m),
w AS (
  SELECT (b1 * (a22 * a33 - a23 * a23) - a12 * (b2 * a33 - a23 * b3) + a13 * (b2 * a23 - a22 * b3)) / det AS w0,
         (a11 * (b2 * a33 - a23 * b3) - b1 * (a12 * a33 - a23 * a13) + a13 * (a12 * b3 - b2 * a13)) / det AS wh,
         (a11 * (a22 * b3 - b2 * a23) - a12 * (a12 * b3 - b2 * a13) + b1 * (a12 * a23 - a22 * a13)) / det AS wd
  FROM det),
asked AS (SELECT DISTINCT place, obs_date + 7 AS obs_date, hour, dow FROM obs),
arriving AS (SELECT place, obs_date, hour, dow FROM obs)"""


def _predicted(requests: str) -> str:
    return f"""
SELECT asked.place, CAST(asked.obs_date AS DATE) AS obs_date, asked.hour, asked.dow,
       CAST(floor(w0 + wh * asked.hour + wd * asked.dow + s * (y - w0 - wh * h - wd * d) + 0.5) AS BIGINT)
         AS predicted_v
FROM {requests} asked JOIN shrunk ON asked.place = shrunk.place, w"""


_NULL = "CAST(NULL AS DOUBLE)"
_SUMMARY = f"""{_with(_EVENTS)}
SELECT 'by_place' AS summary, place AS label, {_N}, {_NULL} AS avg_v, {_NULL} AS avg_incidents
FROM obs GROUP BY place
UNION ALL
SELECT 'by_weather', weather, {_N}, {_NULL}, {_NULL} FROM obs GROUP BY weather
UNION ALL
SELECT 'by_condition', condition, CAST(NULL AS BIGINT), avg(v), avg(incidents)
FROM obs GROUP BY condition"""


_BROKEN = "(hour = 3 OR hour = 4 AND condition = 'error' OR hour = 5 AND condition = 'purchase')"


def oracle_sql() -> dict[str, str]:
    ev, raw, li = _with(_EVENTS), _with(_RAW), _with(_LINEITEM)
    counts = f"{ev}{_COUNT_MODEL} {_predicted('asked')}"
    hot = f"{_with(_EVENTS.replace('obs AS', 'every AS'))}"
    night = f"{hot}, obs AS (SELECT * FROM every WHERE {_selected(NIGHT)})"
    return {
        "observations": f"{ev} SELECT {_DATA} FROM obs",
        "raw_files_normalised": f"""{raw}
SELECT obs_date, place, slot, hour,
       CASE WHEN condition = 'purchase' THEN 0 ELSE v END AS v,
       incidents, condition, weather, dow, seq FROM obs""",
        "raw_files_quarantine": f"""{raw}
SELECT seq, place, v,
       CASE WHEN place IS NULL THEN 'no place' ELSE 'no whole-number count' END AS reason
FROM obs WHERE place IS NULL OR v IS NULL""",
        "raw_files_decimals": f"""{ev}
SELECT place, CAST(count(v) AS BIGINT) AS n, {_TOTAL}, avg(v) AS avg_v, max(v) AS max_v, min(v) AS min_v,
       CAST(sum(CASE WHEN place <> '12' THEN incidents END) AS BIGINT) AS total_incidents
FROM obs GROUP BY place""",
        "raw_files_decimals_quarantine": f"""{ev}
SELECT seq, place, v, CASE WHEN place <> '12' THEN incidents END AS incidents,
       CASE WHEN condition = 'signup' THEN 'no date' ELSE 'unreadable incidents' END AS reason
FROM obs WHERE condition = 'signup' OR place = '12'""",
        "raw_files_defaults": f"""{ev}
SELECT obs_date, place, CAST(NULL AS VARCHAR) AS slot, 12 AS hour, v, 0 AS incidents,
       'Normal' AS condition, dow, seq FROM obs WHERE hour <> 3""",
        "raw_files_fixed_schema": f"{ev} SELECT {_DATA} FROM obs",
        "raw_files_latest": f"{_L1_RAW} SELECT place, v FROM latest",
        "raw_files_histogram": f"{_L1_RAW}{_HISTOGRAM}",
        "raw_files_trend": f"{_L2_RAW}{_TREND}",
        "mixed_files": f"""{ev}
SELECT CASE WHEN hour = 12 THEN DATE '{TODAY}' ELSE obs_date END AS obs_date,
       CASE WHEN hour = 12 THEN 'Default Junction' ELSE place END AS place, slot, hour, v,
       CASE WHEN hour < 6 THEN incidents ELSE 0 END AS incidents,
       CASE WHEN hour = 12 THEN 'Normal' ELSE condition END AS condition,
       CASE WHEN hour < 6 THEN weather END AS weather,
       CASE WHEN hour = 12 THEN 0 ELSE dow END AS dow, seq
FROM obs WHERE NOT {_BROKEN}""",
        "mixed_files_quarantine": f"""{ev}
SELECT obs_date || ',' || slot || ',"' || place || '",' || v || ',' || incidents || ',' || weather
       || CASE hour WHEN 3 THEN '' WHEN 4 THEN ',' || condition || ',' || seq || ',x,y'
          ELSE ',"' || condition || ',' || seq END AS line,
       CASE hour WHEN 3 THEN 'too few fields' WHEN 4 THEN 'too many fields' ELSE 'unclosed quote' END AS reason
FROM obs WHERE {_BROKEN}""",
        "landed_daily": f"{ev} {_DAILY} WHERE {_PERIOD} GROUP BY place, obs_date",
        "exported_daily": f"{ev} {_DAILY} GROUP BY place, obs_date",
        "load_counts": _load_counts(),
        "places": f"{ev} SELECT DISTINCT place FROM obs WHERE trim(place) <> ''",
        "conditions": f"{ev} SELECT DISTINCT condition FROM obs",
        "slots": f"{ev} SELECT DISTINCT slot FROM obs",
        "dates": f"{ev} SELECT DISTINCT obs_date FROM obs",
        "detail": f"{ev} SELECT place, obs_date, slot, v, weather, condition FROM obs",
        "detail_of_place": f"""{ev}
SELECT obs_date, slot, v, weather, condition FROM obs WHERE {_selected(NIGHT, PLACE)}""",
        "peak": f"""{ev}
SELECT place, obs_date, slot, v FROM obs ORDER BY v DESC, obs_date, slot, place, seq LIMIT 1""",
        "peak_of_place": f"""{ev}
SELECT place, obs_date, slot, v FROM obs WHERE {_selected(MORNING, PLACE)}
ORDER BY v DESC, obs_date, slot, seq LIMIT 1""",
        "summary": _SUMMARY,
        "count_by_place": f"{ev} SELECT place, {_N} FROM obs GROUP BY place",
        "count_by_weather": f"{ev} SELECT weather, {_N} FROM obs GROUP BY weather",
        "avg_by_condition": f"""{ev}
SELECT condition, avg(v) AS avg_v, avg(incidents) AS avg_incidents FROM obs GROUP BY condition""",
        "count_by_weather_lineitem": f"""{li}
SELECT weather, {_N} FROM obs GROUP BY weather""",
        "avg_by_condition_lineitem": f"""{li}
SELECT condition, avg(v) AS avg_v, avg(incidents) AS avg_incidents FROM obs GROUP BY condition""",
        "bands": f"""{ev}
SELECT place, {_BAND} AS band, {_N}, {_TOTAL} FROM obs GROUP BY place, {_BAND}""",
        "daily": f"{ev} {_DAILY} GROUP BY place, obs_date",
        "daily_of_place": f"""{ev}
SELECT obs_date, {_TOTAL} FROM obs WHERE {_selected(NIGHT, PLACE)} GROUP BY obs_date""",
        "daily_labels": f"""{ev}
SELECT place, obs_date, {_TOTAL}, strftime(obs_date, '%b %d') AS label
FROM obs GROUP BY place, obs_date""",
        "daily_lineitem": f"{li} {_DAILY} GROUP BY place, obs_date",
        "last_30_days": f"""{ev} {_DAILY}
WHERE obs_date BETWEEN DATE '{TODAY}' - 30 AND DATE '{TODAY}' GROUP BY place, obs_date""",
        "report": f"{ev} SELECT place, {_FIGURES} FROM obs GROUP BY place",
        "report_lineitem": f"{li} SELECT place, {_FIGURES} FROM obs GROUP BY place",
        "report_of_place": f"""{ev}
SELECT place, {_FIGURES} FROM obs WHERE {_selected(MORNING, PLACE)} GROUP BY place""",
        "report_overall": f"{ev} SELECT {_FIGURES} FROM obs",
        "report_with_peak": f"""{_with(_EVENTS, _PEAKS)}
SELECT figures.*, peak_date, peak_slot, peak_v
FROM figures JOIN peaks ON figures.place = peaks.place""",
        "report_text": f"{night},{_PEAKS}{_REPORT_TEXT}",
        "latest": f"{_L1} SELECT place, v FROM latest",
        "latest_in_source_order": f"""{_with(_EVENTS, _latest("seq DESC"))}
SELECT place, v FROM latest""",
        "latest_lineitem": f"{_L1_LINEITEM} SELECT place, v FROM latest",
        "latest_orders": f"{_L1_ORDERS} SELECT place, v FROM latest",
        "latest_by_slot": f"{_L2} SELECT place, slot, v FROM latest",
        "latest_by_slot_lineitem": f"""{_with(_LINEITEM, _latest(_LINEITEM_ORDER, "place, slot"))}
SELECT place, slot, v FROM latest""",
        "kpis": f"""{_L1}
SELECT CAST(count(*) AS BIGINT) AS n_places, {_TOTAL}, avg(v) AS avg_v,
       (SELECT place FROM latest ORDER BY v DESC, place LIMIT 1) AS top_place FROM latest""",
        "kpi_labels": f"""{_L1_ORDERS},
k AS (SELECT CAST(count(*) AS BIGINT) AS n_places, {_TOTAL}, avg(v) AS avg_v,
       (SELECT place FROM latest ORDER BY v DESC, place LIMIT 1) AS top_place FROM latest)
SELECT *, format('{{:,}}', total_v) AS total_label, {_rounded("avg_v", 1)} AS avg_label,
       top_place AS top_label FROM k""",
        "top_places": f"{_L1} SELECT place, v FROM latest ORDER BY v DESC, place LIMIT 8",
        "histogram": f"{_L1}{_HISTOGRAM}",
        "histogram_lineitem": f"{_L1_LINEITEM}{_HISTOGRAM}",
        "quartiles": f"{_L1}{_QUARTILES} SELECT * FROM cuts",
        "quartiles_orders": f"{_L1_ORDERS}{_QUARTILES} SELECT * FROM cuts",
        "quartile_shares": f"{_L1}{_QUARTILES}{_SHARES}",
        "points": f"{_L1}{_POINTS}",
        "points_orders": f"{_L1_ORDERS}{_POINTS}",
        "slot_profile": f"{_L2} SELECT slot, avg(v) AS avg_v FROM latest GROUP BY slot",
        "slot_load": f"""{_L2}, p AS (SELECT slot, avg(v) AS avg_v FROM latest GROUP BY slot)
SELECT slot, avg_v, avg_v / (SELECT max(avg_v) FROM p) AS load FROM p""",
        "series": f"{_L2} SELECT slot, v FROM latest WHERE place = '{PLACE}'",
        "compare": _compare(PLACE, OTHER_PLACE),
        "compare_with_itself": _compare(PLACE, PLACE),
        "trend": f"{_L2}{_TREND}",
        "rollup_week": f"""{ev}
SELECT place, CAST(date_trunc('week', obs_date) AS DATE) AS period,
       CAST(count(v) AS BIGINT) AS n, {_TOTAL}, avg(v) AS avg_v FROM obs GROUP BY 1, 2""",
        "rollup_month": f"""{li}
SELECT place, CAST(date_trunc('month', obs_date) AS DATE) AS period,
       CAST(count(v) AS BIGINT) AS n, {_TOTAL}, avg(v) AS avg_v FROM obs GROUP BY 1, 2""",
        "condition_trend": f"""{ev}
SELECT obs_date, condition, {_N} FROM obs GROUP BY obs_date, condition""",
        "heatmap": f"{_L2} SELECT place, "
        + ", ".join(f"max(CASE WHEN slot = '{h}' THEN v END) AS \"{h}\"" for h in HOURS)
        + " FROM latest GROUP BY place",
        "place_index": f"""{ev}
SELECT place, CAST(row_number() OVER (ORDER BY count(*) DESC, place) - 1 AS DOUBLE) AS place_index
FROM obs GROUP BY place""",
        "stream_daily": f"{ev} {_DAILY_N}",
        "raw_stream_daily": f"{raw} {_DAILY_N}",
        "raw_stream_latest": f"{_L1_RAW} SELECT place, v FROM latest",
        "predicted_counts": counts,
        "condition_totals": f"{ev} SELECT condition, {_N} FROM obs GROUP BY condition",
        "condition_totals_with_holes": f"""{ev} SELECT condition, {_N} FROM obs
WHERE hour <> 3 AND NOT (condition = 'click' AND dow = 2) AND place <> '7' GROUP BY condition""",
        "predictions_count": counts,
        "reloaded_predictions_count": counts,
        "stream_scores_count": f"{ev}{_COUNT_MODEL} {_predicted('arriving')}",
        "prediction_text_count": f"""{ev}{_COUNT_MODEL}, scored AS ({_predicted('asked')})
SELECT place, obs_date, hour,
       'Prediction Results:' || chr(10) || chr(10) || 'Junction: ' || place || chr(10)
       || 'Date: ' || obs_date || chr(10) || 'Hour: ' || hour || ':00' || chr(10) || chr(10)
       || 'Predicted Vehicle Count: ' || predicted_v || chr(10) AS text FROM scored""",
        "stream_late_rows": f"""{ev}
SELECT place, obs_date, slot, v, seq, 'too late' AS reason FROM obs
WHERE obs_date < DATE '{HALF}' AND obs_date + 1 <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
        "stream_latest": f"{_L1} SELECT place, v FROM latest",
    }
