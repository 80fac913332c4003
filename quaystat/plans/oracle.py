"""Independent DuckDB SQL for every registered query.

Written from the semantics, not from the Spark code: the mapping from
``events`` is restated in SQL, the star schema is replaced by its
definition (surrogate key = rank of the natural key in a first load), and
rounding is done on exact integer ratios half away from zero, as SQL NUMERIC
rounding does. Tables are the pre-registered views of the shared parquet.
"""

from __future__ import annotations

# Mapped observations (see quaystat.sources.testdata for the rules).
_OBS = """
ev AS (
  SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 3 AS bkt
  FROM events
),
obs0 AS (
  SELECT
    event_id,
    ts AS collected_at_utc,
    concat('S', user_id % 5) AS stop_place_id,
    concat('Stop ', user_id % 5) AS stop_name,
    CASE WHEN k % 10 = 0 THEN NULL ELSE concat('S', user_id % 5, ':Q', k % 4) END AS quay_id,
    CASE WHEN k % 10 = 0 THEN NULL ELSE concat('Quay ', k % 4) END AS quay_name,
    {journey} AS service_journey_id,
    concat('L', user_id) AS line_id,
    CASE WHEN user_id % 25 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS line_public_code,
    CASE WHEN user_id % 25 = 0 THEN NULL ELSE concat('Line ', user_id) END AS line_name,
    (['bus', 'tram', 'metro', 'rail', 'coach'])[CAST((user_id // 5) % 5 AS INTEGER) + 1] AS transport_mode,
    concat('Dest ', user_id % 7) AS destination,
    k % 2 = 1 AS realtime,
    TIMESTAMP '2024-01-01' + to_days(CAST(3 * bkt AS INTEGER))
      + to_hours(CAST((user_id * 7 + length(event_type) * 5) % 72 AS INTEGER)) AS aimed_departure_utc,
    CAST(floor(value * 6) AS BIGINT) - 60 AS delay_seconds
  FROM ev
),
obs1 AS (
  SELECT *, aimed_departure_utc + to_seconds(delay_seconds) AS expected_departure_utc,
         CAST(NULL AS TIMESTAMP) AS actual_departure_utc
  FROM obs0
),
obs AS (
  SELECT *,
    CAST(loc AS DATE) AS service_date,
    CAST(hour(loc) AS INTEGER) AS departure_hour,
    CAST(dayofweek(loc) + 1 AS INTEGER) AS weekday_number,
    dayofweek(loc) IN (0, 6) AS is_weekend,
    loc AS expected_departure_local
  FROM (SELECT *, (expected_departure_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Oslo' AS loc FROM obs1)
)"""

_JOURNEY = "concat('J', user_id, ':', event_type)"
_JOURNEY_DIRTY = f"CASE WHEN k % 50 = 7 THEN NULL ELSE {_JOURNEY} END"

# Star schema by definition, latest estimate by ROW_NUMBER, dashboard set.
_GOLD = """,
stops AS (SELECT stop_place_id, stop_name, DENSE_RANK() OVER (ORDER BY stop_place_id) AS stop_key
          FROM (SELECT DISTINCT stop_place_id, stop_name FROM obs)),
lines AS (SELECT line_id, line_public_code, line_name, transport_mode,
                 DENSE_RANK() OVER (ORDER BY line_id) AS line_key
          FROM (SELECT DISTINCT line_id, line_public_code, line_name, transport_mode FROM obs)),
quays AS (SELECT quay_id, DENSE_RANK() OVER (ORDER BY quay_id) AS quay_key
          FROM (SELECT DISTINCT quay_id FROM obs WHERE quay_id IS NOT NULL)),
fact AS (
  SELECT o.collected_at_utc,
         CAST(strftime(o.service_date, '%Y%m%d') AS INTEGER) AS date_key,
         s.stop_key, q.quay_key, l.line_key, o.service_journey_id, o.destination, o.realtime,
         o.aimed_departure_utc, o.expected_departure_utc, o.actual_departure_utc,
         CAST(o.delay_seconds AS INTEGER) AS delay_seconds,
         CAST(o.departure_hour AS SMALLINT) AS departure_hour,
         o.service_date, o.event_id
  FROM obs o JOIN stops s USING (stop_place_id) JOIN lines l USING (line_id)
  LEFT JOIN quays q USING (quay_id)
),
latest AS (
  SELECT * FROM fact
  QUALIFY ROW_NUMBER() OVER (PARTITION BY stop_key, service_journey_id, aimed_departure_utc
                             ORDER BY collected_at_utc DESC) = 1
),
dep AS (
  SELECT x.service_date, x.stop_key, s.stop_name, x.line_key, l.line_public_code, l.line_name,
         l.transport_mode, x.departure_hour, x.delay_seconds, x.realtime, x.collected_at_utc,
         x.aimed_departure_utc, x.expected_departure_utc
  FROM latest x JOIN stops s USING (stop_key) JOIN lines l USING (line_key)
)"""


def with_obs(body: str, dirty: bool = False) -> str:
    return "WITH " + _OBS.format(journey=_JOURNEY_DIRTY if dirty else _JOURNEY) + "\n" + body


def with_gold(body: str) -> str:
    return "WITH " + _OBS.format(journey=_JOURNEY) + _GOLD + "\n" + body


def rround(num: str, den: str, digits: int = 1) -> str:
    """num/den rounded half away from zero, from integers, as DOUBLE."""
    scale = 10**digits
    return (
        f"(CASE WHEN ({den}) > 0 THEN sign({num}) * ((abs({num}) * {2 * scale} + ({den})) // (2 * ({den})))"
        f" / CAST({scale} AS DOUBLE) END)"
    )


def ratio(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END)"


# The fact after the second batch of the two-batch variant (rules in sources.testdata).
_SECOND = """, fact2 AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 7 = 0 THEN expected_departure_utc + INTERVAL 90000 SECOND ELSE expected_departure_utc END AS expected_departure_utc,
    CASE WHEN event_id % 7 = 0 THEN delay_seconds + 90000 ELSE delay_seconds END AS delay_seconds)
  FROM fact
  UNION ALL SELECT * REPLACE (service_journey_id || 'N' AS service_journey_id) FROM fact WHERE event_id % 7 = 1
  UNION ALL SELECT * REPLACE (service_journey_id || 'F' AS service_journey_id, collected_at_utc + INTERVAL 400 DAY AS collected_at_utc)
    FROM fact WHERE event_id % 7 = 2
)
"""

# Board variant: collection instants floored to 6 hours.
_BOARD = """, board AS (SELECT * REPLACE (time_bucket(INTERVAL '6 hours', collected_at_utc) AS collected_at_utc) FROM obs)
"""
# Calls that the landed boards hold: some boards are empty, some have no payload.
_LANDED = (
    _BOARD
    + """, landed AS (SELECT * FROM board
  WHERE NOT (stop_place_id = 'S3' AND hour(collected_at_utc) = 6) AND NOT (stop_place_id = 'S4' AND hour(collected_at_utc) = 12))
"""
)

OVER3 = "count(*) FILTER (WHERE delay_seconds > 180)"
OVER5 = "count(*) FILTER (WHERE delay_seconds > 300)"


def _stats(median: bool = True, p90: bool = False, long_rate: bool = False) -> str:
    cols = [
        "count(*) AS departures",
        f"{rround('sum(delay_seconds)', 'count(delay_seconds)')} AS average_delay_seconds",
    ]
    if median:
        cols.append("round(quantile_cont(delay_seconds, 0.5), 1) AS median_delay_seconds")
    if p90:
        cols.append("round(quantile_cont(delay_seconds, 0.9), 1) AS p90_delay_seconds")
    cols.append(f"{rround(f'100 * {OVER3}', 'count(*)')} AS percent_over_3_minutes")
    if long_rate:
        cols.append(f"{rround(f'100 * {OVER5}', 'count(*)')} AS percent_over_5_minutes")
    return ",\n  ".join(cols)


def _summary(group: str) -> str:
    return f"""SELECT {group}, count(*) AS departures,
  {ratio('sum(delay_seconds)', 'count(delay_seconds)')} AS average_delay_seconds,
  quantile_cont(delay_seconds, 0.5) AS median_delay_seconds,
  {ratio(f'100 * {OVER3}', 'count(*)')} AS percent_over_threshold,
  {ratio('sum(delay_seconds)', 'count(delay_seconds)')} / 60.0 AS average_delay_minutes
FROM dep GROUP BY {group}"""


ORACLE: dict[str, str] = {
    "latest_estimate": with_gold(
        """SELECT collected_at_utc, date_key, stop_key, quay_key, line_key, service_journey_id,
  destination, realtime, aimed_departure_utc, expected_departure_utc, actual_departure_utc,
  delay_seconds, departure_hour FROM latest"""
    ),
    "coverage": with_gold(
        """SELECT min(service_date) AS first_service_date, max(service_date) AS last_service_date,
  count(*) AS unique_departures, count(DISTINCT stop_key) AS monitored_stops,
  count(DISTINCT line_key) AS distinct_lines FROM latest"""
    ),
    "delay_by_mode": with_gold(
        f"""SELECT l.transport_mode, {_stats(p90=True, long_rate=True)}
FROM latest x JOIN lines l USING (line_key) GROUP BY l.transport_mode"""
    ),
    "delay_by_stop": with_gold(
        f"""SELECT s.stop_name, {_stats()}
FROM latest x JOIN stops s USING (stop_key) GROUP BY s.stop_name"""
    ),
    "delay_by_hour": with_gold(f"SELECT departure_hour, {_stats()} FROM latest GROUP BY departure_hour"),
    "worst_lines": with_gold(
        f"""SELECT transport_mode, line_public_code, line_name, departures, average_delay_seconds,
  percent_over_3_minutes FROM (
  SELECT l.line_id, l.transport_mode, l.line_public_code, l.line_name, {_stats(median=False)}
  FROM latest x JOIN lines l USING (line_key)
  GROUP BY l.line_id, l.transport_mode, l.line_public_code, l.line_name
  HAVING count(*) >= 30
  ORDER BY percent_over_3_minutes DESC, departures DESC, line_id
  LIMIT 15)"""
    ),
}


def _label(code: str, name: str, mode: str) -> str:
    """Line label; the mode is title-cased per word (one-word modes here)."""
    c, n = f"nullif({code}, '')", f"nullif({name}, '')"
    return (
        f"(CASE WHEN {c} IS NOT NULL AND {n} IS NOT NULL AND {n} <> {c} THEN concat({c}, ' — ', {n})"
        f" ELSE coalesce({c}, {n}, 'Unnamed line') END"
        f" || ' (' || upper(left({mode}, 1)) || lower(substr({mode}, 2)) || ')')"
    )


def _overview(where: str = "") -> str:
    return f"""SELECT count(*) AS departures, count(DISTINCT stop_key) AS stops,
  count(DISTINCT line_key) AS lines,
  coalesce({ratio('sum(delay_seconds)', 'count(delay_seconds)')}, 0.0) AS average_delay_seconds,
  coalesce({ratio(f'100 * {OVER3}', 'count(*)')}, 0.0) AS percent_over_threshold,
  count(*) < 30 AS is_small_sample
FROM dep {where}"""


def _quality(src: str) -> str:
    return f"""SELECT count(*) AS total_observations,
  count(DISTINCT stop_place_id) AS distinct_stops,
  count(DISTINCT line_id) AS distinct_lines,
  CAST(sum(CAST(realtime AS INTEGER)) AS BIGINT) AS realtime_observations,
  CAST(count(*) FILTER (WHERE service_journey_id IS NULL) AS BIGINT) AS missing_service_journey_id,
  CAST(count(*) FILTER (WHERE aimed_departure_utc IS NULL) AS BIGINT) AS missing_aimed_departure,
  CAST(count(*) FILTER (WHERE expected_departure_utc IS NULL) AS BIGINT) AS missing_expected_departure,
  CAST(count(*) FILTER (WHERE delay_seconds < 0) AS BIGINT) AS negative_delay_observations,
  CAST(count(*) FILTER (WHERE abs(delay_seconds) > 7200) AS BIGINT) AS delay_over_two_hours,
  {rround('sum(delay_seconds)', 'count(delay_seconds)', 2)} AS average_delay_seconds,
  quantile_disc(delay_seconds, 0.5) AS median_delay_seconds,
  max(delay_seconds) AS maximum_delay_seconds
FROM {src}"""


_OBS_COLS = (
    "collected_at_utc, stop_place_id, stop_name, quay_id, quay_name, service_journey_id, line_id, "
    "line_public_code, line_name, transport_mode, destination, realtime, aimed_departure_utc, "
    "expected_departure_utc, actual_departure_utc, delay_seconds, expected_departure_local, "
    "service_date, departure_hour, weekday_number, is_weekend"
)
_DEDUP_REST = [
    c.strip() for c in _OBS_COLS.split(",")
    if c.strip() not in ("collected_at_utc", "stop_place_id", "service_journey_id", "quay_id", "aimed_departure_utc")
]

ORACLE.update(
    {
        "filtered_departures": with_gold(
            """SELECT * FROM dep WHERE service_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND stop_key IN (1, 2, 4) AND transport_mode IN ('bus', 'tram', 'rail')"""
        ),
        "overview": with_gold(_overview()),
        "overview_empty": with_gold(_overview("WHERE service_date BETWEEN DATE '2030-01-01' AND DATE '2030-01-02'")),
        "summary_by_mode": with_gold(_summary("transport_mode")),
        "summary_by_stop": with_gold(_summary("stop_name")),
        "summary_by_hour": with_gold(_summary("departure_hour")),
        "sample_partition": with_gold(
            f"""SELECT line_key, count(*) AS departures,
  {ratio('sum(delay_seconds)', 'count(delay_seconds)')} AS average_delay_seconds,
  quantile_cont(delay_seconds, 0.5) AS median_delay_seconds,
  {ratio(f'100 * {OVER3}', 'count(*)')} AS percent_over_threshold,
  count(*) >= 35 AS is_sufficient
FROM dep GROUP BY line_key"""
        ),
        "elevated_lines": with_gold(
            f"""SELECT *, {_label('line_public_code', 'line_name', 'transport_mode')} AS line_label FROM (
  SELECT line_key, line_public_code, line_name, transport_mode, count(*) AS departures,
    {ratio('sum(delay_seconds)', 'count(delay_seconds)')} AS average_delay_seconds,
    quantile_cont(delay_seconds, 0.5) AS median_delay_seconds,
    {ratio(f'100 * {OVER3}', 'count(*)')} AS percent_over_threshold
  FROM dep GROUP BY line_key, line_public_code, line_name, transport_mode
  HAVING count(*) >= 30
  ORDER BY percent_over_threshold DESC, departures DESC, line_key
  LIMIT 15)"""
        ),
        "options_stops": with_gold("SELECT DISTINCT stop_key, stop_name FROM dep"),
        "options_modes": with_gold("SELECT DISTINCT transport_mode FROM dep"),
        "options_lines": with_gold(
            f"""SELECT DISTINCT line_key, line_public_code, line_name, transport_mode,
  {_label('line_public_code', 'line_name', 'transport_mode')} AS line_label FROM dep"""
        ),
        "date_bounds": with_gold(
            "SELECT min(service_date) AS minimum_date, max(service_date) AS maximum_date FROM dep"
        ),
        "quality_summary": with_obs(_quality("obs")),
        "quality_summary_prefilter": with_obs(_quality("obs"), dirty=True),
        "quality_by_mode": with_obs(
            f"""SELECT transport_mode, count(*) AS observations,
  {rround('sum(delay_seconds)', 'count(delay_seconds)', 2)} AS average_delay_seconds,
  quantile_disc(delay_seconds, 0.5) AS median_delay_seconds
FROM obs GROUP BY transport_mode"""
        ),
        "flatten_snapshots": with_obs(f"SELECT {_OBS_COLS} FROM obs"),
        "dedup_observations": with_obs(
            f"""SELECT {_OBS_COLS} FROM (
  SELECT * REPLACE (time_bucket(INTERVAL '6 hours', collected_at_utc) AS collected_at_utc) FROM obs)
QUALIFY ROW_NUMBER() OVER (
  PARTITION BY collected_at_utc, stop_place_id, service_journey_id, quay_id, aimed_departure_utc
  ORDER BY expected_departure_utc DESC NULLS LAST, {', '.join(c + ' ASC NULLS LAST' for c in _DEDUP_REST)}) = 1"""
        ),
        "reject_summary": with_obs(
            """SELECT 'missing_required_field' AS reject_reason, count(*) AS rejected_rows
FROM obs WHERE service_journey_id IS NULL""",
            dirty=True,
        ),
        "dim_date": with_obs(
            """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
  CAST(week(d) AS INTEGER) AS week_of_year, CAST(isodow(d) AS INTEGER) AS day_of_week,
  dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT DISTINCT service_date AS d FROM obs)"""
        ),
        "dim_stop": with_gold("SELECT stop_key, stop_place_id, stop_name FROM stops"),
        "dim_line": with_gold(
            "SELECT line_key, line_id, line_public_code, line_name, transport_mode FROM lines"
        ),
        "dim_quay": with_gold(
            """SELECT q.quay_key, q.quay_id, o.quay_name, s.stop_key
FROM quays q JOIN (SELECT DISTINCT quay_id, quay_name, stop_place_id FROM obs) o USING (quay_id)
JOIN stops s USING (stop_place_id)"""
        ),
        "fact_upsert": with_gold(
            _SECOND
            + """SELECT collected_at_utc, date_key, stop_key, quay_key, line_key, service_journey_id,
  destination, realtime, aimed_departure_utc, expected_departure_utc, actual_departure_utc,
  delay_seconds, departure_hour, CAST(collected_at_utc AS DATE) AS collected_date
FROM fact2"""
        ),
        "fact_row_count": with_gold(_SECOND + "SELECT count(*) AS fact_rows FROM fact2"),
        "dim_line_second_load": with_gold(
            """, renamed AS (SELECT DISTINCT line_id FROM obs WHERE event_id % 7 = 2)
SELECT line_key, line_id, line_public_code,
  CASE WHEN line_id NOT IN (SELECT line_id FROM renamed) THEN line_name
       WHEN CAST(substr(line_id, 2) AS BIGINT) % 2 = 1 THEN line_name || ' II' END AS line_name,
  transport_mode
FROM lines"""
        ),
        "fk_violations": with_gold(
            """SELECT 'fact.line_key' AS relation, CAST(line_key AS VARCHAR) AS key_value, count(*) AS rows
FROM fact f WHERE line_key NOT IN (SELECT line_key FROM lines) GROUP BY line_key
UNION ALL
SELECT 'fact.stop_key', CAST(stop_key AS VARCHAR), count(*) FROM fact
WHERE stop_key NOT IN (SELECT stop_key FROM stops) GROUP BY stop_key
UNION ALL
SELECT 'fact.quay_key', CAST(quay_key AS VARCHAR), count(*) FROM fact
WHERE quay_key IS NOT NULL AND quay_key NOT IN (SELECT quay_key FROM quays) GROUP BY quay_key"""
        ),
        "key_duplicates": with_gold(
            """SELECT 'fact.natural' AS table_name,
  concat_ws('|', collected_at_utc, stop_key, service_journey_id, aimed_departure_utc) AS key_text,
  count(*) AS occurrences
FROM fact GROUP BY collected_at_utc, stop_key, service_journey_id, aimed_departure_utc HAVING count(*) > 1
UNION ALL
SELECT 'dim_line.line_id', line_id, count(*) FROM lines GROUP BY line_id HAVING count(*) > 1
UNION ALL
SELECT 'dim_stop.stop_place_id', stop_place_id, count(*) FROM stops GROUP BY stop_place_id HAVING count(*) > 1"""
        ),
        "line_labels": with_gold(
            f"SELECT line_key, {_label('line_public_code', 'line_name', 'transport_mode')} AS line_label FROM lines"
        ),
    }
)

ORACLE["stream_latest"] = with_obs(
    f"""SELECT {_OBS_COLS} FROM obs
QUALIFY ROW_NUMBER() OVER (PARTITION BY stop_place_id, service_journey_id, aimed_departure_utc
                           ORDER BY collected_at_utc DESC) = 1"""
)

ORACLE["latest_incremental"] = with_gold(
    _SECOND
    + """SELECT collected_at_utc, date_key, stop_key, quay_key, line_key, service_journey_id,
  destination, realtime, aimed_departure_utc, expected_departure_utc, actual_departure_utc,
  delay_seconds, departure_hour
FROM fact2 QUALIFY ROW_NUMBER() OVER (PARTITION BY stop_key, service_journey_id, aimed_departure_utc
                                      ORDER BY collected_at_utc DESC) = 1"""
)

# Latest estimates and lines after the second batch, for the reports from maintained counts.
_AFTER = (
    _SECOND
    + """, latest2 AS (SELECT * REPLACE (CAST(delay_seconds AS INTEGER) AS delay_seconds) FROM fact2
  QUALIFY ROW_NUMBER() OVER (PARTITION BY stop_key, service_journey_id, aimed_departure_utc ORDER BY collected_at_utc DESC) = 1)
"""
)
ORACLE["counts_coverage"] = with_gold(
    _AFTER
    + """SELECT strptime(CAST(min(date_key) AS VARCHAR), '%Y%m%d')::DATE AS first_service_date, strptime(CAST(max(date_key) AS VARCHAR), '%Y%m%d')::DATE AS last_service_date,
  count(*) AS unique_departures, count(DISTINCT stop_key) AS monitored_stops, count(DISTINCT line_key) AS distinct_lines FROM latest2"""
)
ORACLE["counts_delay_by_mode"] = with_gold(_AFTER + f"SELECT l.transport_mode, {_stats(p90=True, long_rate=True)} FROM latest2 JOIN lines l USING (line_key) GROUP BY l.transport_mode")
ORACLE["counts_delay_by_stop"] = with_gold(_AFTER + f"SELECT s.stop_name, {_stats()} FROM latest2 JOIN stops s USING (stop_key) GROUP BY s.stop_name")
ORACLE["counts_delay_by_hour"] = with_gold(_AFTER + f"SELECT departure_hour, {_stats()} FROM latest2 GROUP BY departure_hour")
ORACLE["counts_worst_lines"] = with_gold(
    _AFTER
    + f"""SELECT transport_mode, line_public_code, departures, average_delay_seconds, percent_over_3_minutes FROM (
  SELECT l.line_id, l.transport_mode, l.line_public_code, {_stats(median=False)}
  FROM latest2 JOIN lines l USING (line_key) GROUP BY l.line_id, l.transport_mode, l.line_public_code
  HAVING count(*) >= 30 ORDER BY percent_over_3_minutes DESC, departures DESC, line_id LIMIT 15)"""
)

_PICKED = """, picked AS (SELECT * FROM dep WHERE service_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND stop_key IN (1, 2, 4) AND transport_mode IN ('bus', 'tram', 'rail'))
"""
_VIEW_COLUMNS = ["transport_mode", "stop_name", "stop_key", "departure_hour", "line_key", "line_public_code", "line_name"]
_VIEWS = {
    "overview": [], "mode": ["transport_mode"], "stop": ["stop_name"], "stop_key": ["stop_key"], "hour": ["departure_hour"],
    "line_key": ["line_key"], "line": ["line_key", "line_public_code", "line_name", "transport_mode"],
}


def _view(name: str, columns: list[str]) -> str:
    """One view as a query of its own."""
    out = ", ".join(c if c in columns else f"NULL AS {c}" for c in _VIEW_COLUMNS)
    group = f"GROUP BY {', '.join(columns)}" if columns else ""
    return f"""SELECT '{name}' AS view, {out}, count(*) AS departures, {ratio('sum(delay_seconds)', 'count(delay_seconds)')} AS average_delay_seconds,
  quantile_cont(delay_seconds, 0.5) AS median_delay_seconds, {ratio(f'100 * {OVER3}', 'count(*)')} AS percent_over_threshold FROM picked {group}"""


ORACLE["dashboard_views"] = with_gold(_PICKED + " UNION ALL ".join(_view(n, c) for n, c in _VIEWS.items()))
ORACLE["dashboard_dataset"] = with_gold(
    _PICKED
    + f"""SELECT 'overview' AS part, 'all' AS name, count(*) AS departures FROM picked
UNION ALL SELECT CASE WHEN count(*) >= 30 THEN 'by_mode' ELSE 'omitted_modes' END, transport_mode, count(*) FROM picked GROUP BY transport_mode
UNION ALL SELECT 'by_stop', stop_name, count(*) FROM picked GROUP BY stop_name
UNION ALL SELECT 'by_hour', CAST(departure_hour AS VARCHAR), count(*) FROM picked GROUP BY departure_hour
UNION ALL SELECT 'elevated_lines', label, n FROM (
  SELECT {_label('line_public_code', 'line_name', 'transport_mode')} AS label, count(*) AS n, {ratio(f'100 * {OVER3}', 'count(*)')} AS late, line_key FROM picked
  GROUP BY line_key, line_public_code, line_name, transport_mode HAVING count(*) >= 30 ORDER BY late DESC, n DESC, line_key LIMIT 15)"""
)
ORACLE["export_order"] = with_gold(
    _PICKED
    + """SELECT CAST(row_number() OVER (ORDER BY aimed_departure_utc, stop_key, line_key, collected_at_utc) AS INTEGER) AS position, stop_key, line_key, aimed_departure_utc, collected_at_utc FROM picked"""
)
ORACLE["report_order"] = with_gold(
    f""", m AS (SELECT transport_mode, {_stats()} FROM dep GROUP BY 1), s AS (SELECT stop_name, {_stats()} FROM dep GROUP BY 1)
SELECT 'mode' AS kind, CAST(row_number() OVER (ORDER BY average_delay_seconds DESC, transport_mode) AS INTEGER) AS position, transport_mode AS value FROM m
UNION ALL SELECT 'stop', CAST(row_number() OVER (ORDER BY average_delay_seconds DESC, stop_name) AS INTEGER), stop_name FROM s
UNION ALL SELECT 'hour', CAST(row_number() OVER (ORDER BY departure_hour) AS INTEGER), CAST(departure_hour AS VARCHAR) FROM (SELECT DISTINCT departure_hour FROM dep)
UNION ALL SELECT 'quality', CAST(row_number() OVER (ORDER BY n DESC, transport_mode) AS INTEGER), transport_mode FROM (SELECT transport_mode, count(*) AS n FROM obs GROUP BY 1)"""
)
ORACLE["overlapping_loads"] = with_gold(
    """SELECT collected_at_utc, stop_place_id, line_id, service_journey_id, aimed_departure_utc, delay_seconds, date_key
FROM fact JOIN stops USING (stop_key) JOIN lines USING (line_key)"""
)
ORACLE["refused_rows"] = with_obs(
    """SELECT 'not_null.service_journey_id' AS rule, stop_place_id, count(*) AS rows FROM obs WHERE service_journey_id IS NULL GROUP BY 2
UNION ALL SELECT 'hour outside 0..23', stop_place_id, count(*) FROM obs WHERE NOT realtime AND departure_hour + 12 > 23 GROUP BY 2""",
    dirty=True,
)
ORACLE["dim_stop_second_load"] = with_gold(
    "SELECT stop_key, stop_place_id, stop_name || CASE WHEN CAST(substr(stop_place_id, 2) AS INTEGER) % 2 = 0 THEN ' South' ELSE '' END AS stop_name FROM stops"
)
ORACLE["dim_quay_second_load"] = with_gold(
    """SELECT quay_key, quay_id, CASE WHEN q <> 'Q2' THEN quay_name END AS quay_name,
  CASE WHEN q = 'Q1' THEN concat('S', (n + 1) % 5) ELSE concat('S', n) END AS stop_place_id
FROM (SELECT DISTINCT quay_key, quay_id, quay_name, split_part(quay_id, ':', 2) AS q, CAST(substr(split_part(quay_id, ':', 1), 2) AS INTEGER) AS n FROM quays JOIN obs USING (quay_id))"""
)
ORACLE["raw_json_roundtrip"] = with_obs(f"SELECT {_OBS_COLS} FROM obs")
ORACLE["stream_dedup"] = ORACLE["dedup_observations"]
ORACLE["flatten_boards"] = with_obs(_LANDED + f"SELECT {_OBS_COLS} FROM landed")
ORACLE["etl_silver"] = with_obs(
    _LANDED
    + f"""SELECT {_OBS_COLS} FROM landed
QUALIFY ROW_NUMBER() OVER (
  PARTITION BY collected_at_utc, stop_place_id, service_journey_id, quay_id, aimed_departure_utc
  ORDER BY expected_departure_utc DESC NULLS LAST, {', '.join(c + ' ASC NULLS LAST' for c in _DEDUP_REST)}) = 1"""
)
ORACLE["stream_ingest"] = ORACLE["etl_silver"]
ORACLE["etl_counts"] = with_obs(
    _LANDED
    + """, docs AS (SELECT DISTINCT collected_at_utc AS seen, stop_place_id AS stop FROM board)
SELECT (SELECT count(*) FROM docs) AS raw_count,
  (SELECT count(*) FROM (SELECT DISTINCT collected_at_utc, stop_place_id, service_journey_id, quay_id, aimed_departure_utc FROM landed)) AS processed_count,
  CAST(0 AS BIGINT) AS rejected_count,
  (SELECT count(*) FROM docs WHERE stop = 'S3' AND hour(seen) = 6) AS empty_boards,
  (SELECT count(*) FROM docs WHERE stop = 'S4' AND hour(seen) = 12) AS null_boards,
  CAST(0 AS BIGINT) AS corrupt_files"""
)
ORACLE["parse_instants"] = "SELECT event_id, CASE WHEN event_id % 6 < 3 THEN CAST(ts AS TIMESTAMP) END AS instant FROM events"
ORACLE["stream_upsert"] = with_obs(
    """SELECT collected_at_utc, stop_place_id, line_id, service_journey_id, aimed_departure_utc,
  CAST(delay_seconds AS INTEGER) AS delay_seconds FROM obs
QUALIFY ROW_NUMBER() OVER (PARTITION BY stop_place_id, service_journey_id, aimed_departure_utc
                           ORDER BY collected_at_utc DESC) = 1"""
)


def _twice(name: str, table: str, value: str, even: str) -> str:
    """Keys of rows that stand twice because their ``even`` key is even."""
    return f"SELECT '{name}' AS table_name, CAST({value} AS VARCHAR) AS key_text, count(*) AS occurrences FROM (SELECT * FROM {table} UNION ALL SELECT * FROM {table} WHERE {even} % 2 = 0) GROUP BY 2 HAVING count(*) > 1"


_DATES = "(SELECT DISTINCT CAST(strftime(service_date, '%Y%m%d') AS INTEGER) AS date_key, service_date FROM obs)"
ORACLE["key_duplicates_found"] = with_gold(
    _BOARD
    + """, bfact AS (SELECT b.collected_at_utc, s.stop_key, b.service_journey_id, b.aimed_departure_utc FROM board b JOIN stops s USING (stop_place_id))
SELECT 'fact.natural' AS table_name,
  concat_ws('|', strftime(collected_at_utc, '%Y-%m-%d %H:%M:%S'), stop_key, service_journey_id, strftime(aimed_departure_utc, '%Y-%m-%d %H:%M:%S')) AS key_text,
  count(*) AS occurrences
FROM bfact GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'fact', CAST(CAST(epoch(collected_at_utc) AS BIGINT) AS VARCHAR), count(*) FROM bfact GROUP BY 2 HAVING count(*) > 1
UNION ALL """
    + " UNION ALL ".join(
        [
            _twice("dim_date", _DATES, "date_key", "date_key"),
            _twice("dim_date.full_date", _DATES, "service_date", "date_key"),
            _twice("dim_stop", "stops", "stop_key", "stop_key"),
            _twice("dim_stop.stop_place_id", "stops", "stop_place_id", "stop_key"),
            _twice("dim_quay", "quays", "quay_key", "quay_key"),
            _twice("dim_quay.quay_id", "quays", "quay_id", "quay_key"),
            _twice("dim_line", "lines", "line_key", "line_key"),
            _twice("dim_line.line_id", "lines", "line_id", "line_key"),
        ]
    )
)
ORACLE["fk_violations_found"] = with_gold(
    " UNION ALL ".join(
        f"SELECT 'fact.{c}' AS relation, CAST({c} AS VARCHAR) AS key_value, count(*) AS rows FROM fact WHERE {c} % 3 = 0 GROUP BY 2"
        for c in ("date_key", "stop_key", "quay_key", "line_key")
    )
    + """ UNION ALL SELECT 'dim_quay.stop_key', CAST(s.stop_key AS VARCHAR), count(*)
FROM quays q JOIN (SELECT DISTINCT quay_id, stop_place_id FROM obs) o USING (quay_id) JOIN stops s USING (stop_place_id)
WHERE s.stop_key % 3 = 0 GROUP BY 2"""
)
ORACLE["hour_violations"] = with_gold(
    """SELECT departure_hour + line_key % 3 AS departure_hour, count(*) AS rows FROM fact
WHERE departure_hour + line_key % 3 > 23 GROUP BY 1"""
)
ORACLE["line_filter"] = with_gold(_overview("WHERE service_date BETWEEN DATE '2024-01-01' AND DATE '2024-12-31' AND line_key IN (1, 2, 3, 10)"))
ORACLE["option_order"] = with_gold(
    """SELECT 'stop' AS kind, CAST(row_number() OVER (ORDER BY stop_name, stop_key) AS INTEGER) AS position, CAST(stop_key AS VARCHAR) AS value
FROM (SELECT DISTINCT stop_key, stop_name FROM dep)
UNION ALL SELECT 'mode', CAST(row_number() OVER (ORDER BY transport_mode) AS INTEGER), transport_mode FROM (SELECT DISTINCT transport_mode FROM dep)
UNION ALL SELECT 'line', CAST(row_number() OVER (ORDER BY transport_mode, line_public_code NULLS LAST, line_name NULLS LAST, line_key) AS INTEGER), CAST(line_key AS VARCHAR)
FROM (SELECT DISTINCT line_key, line_public_code, line_name, transport_mode FROM dep)"""
)
ORACLE["worst_line_order"] = with_gold(
    f"""SELECT 'elevated' AS kind, CAST(row_number() OVER (ORDER BY late DESC, n DESC, line_key) AS INTEGER) AS position, CAST(line_key AS VARCHAR) AS value
FROM (SELECT line_key, count(*) AS n, {ratio(f'100 * {OVER3}', 'count(*)')} AS late FROM dep GROUP BY line_key HAVING count(*) >= 30)
QUALIFY position <= 15"""
)
ORACLE["view_sql"] = with_gold(
    "SELECT transport_mode, count(*) AS departures, count(*) FILTER (WHERE delay_seconds > 180) AS late FROM dep GROUP BY transport_mode"
)
ORACLE["scale_delay_by_mode"] = f"""WITH j AS (
  SELECT l_suppkey, l_orderkey, o_orderdate, l_linenumber, l_partkey,
    date_diff('second', CAST(o_orderdate AS TIMESTAMP), CAST(l_shipdate AS TIMESTAMP)) AS delay_seconds
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  QUALIFY ROW_NUMBER() OVER (PARTITION BY l_suppkey, l_orderkey, o_orderdate ORDER BY l_linenumber DESC) = 1)
SELECT (['bus', 'tram', 'metro', 'rail', 'coach'])[CAST(l_partkey % 5 AS INTEGER) + 1] AS transport_mode, {_stats(p90=True, long_rate=True)}
FROM j GROUP BY 1"""
