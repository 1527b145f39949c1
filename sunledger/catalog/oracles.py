"""The registered queries again as plain SQL over the given tables."""

from __future__ import annotations

from collections.abc import Sequence

from sunledger.catalog import boosting_sql
from sunledger.catalog.boosting_sql import SQL_BOOST
from sunledger.functions import solar
from sunledger.operators.features import FEATURE_SETS, SITE_ATTRIBUTES

LABEL = '"Power(mW)"'
PREDICTION = '"Predicted_Power(mW)"'
ALL_SITES = sorted(str(k) for k in SITE_ATTRIBUTES)


def _round(expr: str, digits: int = 2) -> str:
    return f"(round_even(({expr}) * 1e{digits}, 0) / 1e{digits})"


def _mean(expr: str) -> str:
    nine = f"CAST({expr} AS DECIMAL(28,9))"
    total = f"CAST(sum({nine}) AS DOUBLE) + sum({expr} - CAST({nine} AS DOUBLE))"
    return f"(({total}) / count({expr}))"


def _with(ctes: Sequence[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# --- domain views ----------------------------------------------------------

SITE = "CAST(user_id % 17 + 1 AS INTEGER)"
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
POWER = f"power AS (SELECT event_id, {SITE} AS LocationCode, ts AS DateTime, value AS {LABEL} FROM events)"
MINUTE_POWER = (
    f"minute_power AS (SELECT event_id, {SITE} AS LocationCode, date_trunc('minute', ts) AS DateTime, "
    f"value AS {LABEL} FROM events)"
)
PREDICTED = (
    f"predicted AS (SELECT event_id, {SITE} AS LocationCode, ts AS DateTime, "
    f"value - 60.0::DOUBLE AS {PREDICTION} FROM events)"
)
WEATHER = f"""weather AS (
  SELECT event_id, ts AS time,
    CASE WHEN {K} % 7 = 0 OR {K} % 11 = 0 THEN NULL ELSE value END AS H_UVI,
    CASE WHEN {K} % 10 = 0 THEN NULL ELSE CAST({K} AS DOUBLE) END AS TEMP
  FROM events WHERE event_type = 'view')"""
HOURLY = f"""hourly AS (
  SELECT date_trunc('hour', ts) AS DateTime, {_mean('value')} AS Solarinsolation
  FROM events WHERE event_type = 'purchase' GROUP BY ALL)"""
QUARTERS = f"""quarters AS (
  SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS DateTime, {_mean('value')} AS GHI,
    max(value) AS DNI, min(value) AS DHI
  FROM events WHERE event_type = 'click' GROUP BY 1)"""
TENS = f"""tens AS (
  SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS DateTime,
    CASE WHEN count(*) > 1 THEN {_mean('value')} END AS mean_value, max(value) AS max_value
  FROM events WHERE event_type = 'click' GROUP BY 1)"""
QUESTIONS = f"""questions AS (
  SELECT event_id, strftime(ts, '%Y%m%d%H%M') || lpad(CAST({SITE} AS VARCHAR), 2, '0') AS serial,
    date_trunc('minute', ts) AS slot_start, {SITE} AS LocationCode
  FROM events WHERE event_type = 'signup')"""
MIXED = f"""mixed AS (
  SELECT event_id, event_id % 5 AS kind, date_trunc('minute', ts) AS slot_start, {SITE} AS LocationCode,
    CASE event_id % 5
      WHEN 1 THEN strftime(ts, '%Y%m%d%H%M') || lpad(CAST({SITE} AS VARCHAR), 2, '0') || '.0'
      WHEN 2 THEN strftime(ts, '%Y30%d%H%M') || lpad(CAST({SITE} AS VARCHAR), 2, '0')
      WHEN 3 THEN strftime(ts, '%Y%m%d%H%M') || 'xx'
      WHEN 4 THEN ' '
      ELSE strftime(ts, '%Y%m%d%H%M') || lpad(CAST({SITE} AS VARCHAR), 2, '0') END AS serial
  FROM events)"""
SOURCES = f"""sources AS (
  SELECT 0 AS source_rank, event_id, {SITE} AS LocationCode, ts AS DateTime, value AS {LABEL} FROM events
  UNION ALL
  SELECT 1, event_id, {SITE}, ts + CASE WHEN event_type = 'error' THEN INTERVAL 30 SECOND
    ELSE INTERVAL 0 SECOND END, value + 1000.0::DOUBLE
  FROM events WHERE event_type IN ('purchase', 'error'))"""


# --- reusable pieces -------------------------------------------------------


def _filled(columns: Sequence[str], source: str, order: str, keep: str, digits: int | None = 2) -> str:
    """Linear interpolation of null runs over the row positions of ``source``."""
    anchors, lines = [], []
    for c in columns:
        q = c.strip('"')
        anchors += [
            f"last_value({c} IGNORE NULLS) OVER back AS v0_{q}",
            f"first_value({c} IGNORE NULLS) OVER ahead AS v1_{q}",
            f"max(CASE WHEN {c} IS NOT NULL THEN pos END) OVER back AS p0_{q}",
            f"min(CASE WHEN {c} IS NOT NULL THEN pos END) OVER ahead AS p1_{q}",
        ]
        line = (
            f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN v0_{q} IS NULL THEN NULL WHEN v1_{q} IS NULL THEN v0_{q} "
            f"ELSE ((v1_{q} - v0_{q}) / (p1_{q} - p0_{q})) * (pos - p0_{q}) + v0_{q} END"
        )
        lines.append(f"{line if digits is None else _round(line, digits)} AS {c}")
    return (
        f"SELECT {keep}, {', '.join(lines)} FROM (SELECT *, {', '.join(anchors)} FROM "
        f"(SELECT *, row_number() OVER (ORDER BY {order}) AS pos FROM {source}) "
        "WINDOW back AS (ORDER BY pos ROWS UNBOUNDED PRECEDING), "
        "ahead AS (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"
    )


def _regrid(name: str, source: str, columns: Sequence[str], step: str, where: str = "") -> list[str]:
    """Reindex ``source`` to a grid from its first to its last timestamp and fill it linearly."""
    return [
        f"{name}_grid AS (SELECT unnest(generate_series(min(DateTime), max(DateTime), INTERVAL {step})) "
        f"AS DateTime FROM {source})",
        f"{name}_joined AS (SELECT g.DateTime, {', '.join('s.' + c for c in columns)} "
        f"FROM {name}_grid g LEFT JOIN {source} s ON g.DateTime = s.DateTime)",
        f"{name} AS (SELECT * FROM ({_filled(columns, f'{name}_joined', 'DateTime', 'DateTime')}) {where})",
    ]


COMPLETE = """complete AS (
  SELECT d.day + INTERVAL (h.hour) HOUR AS DateTime, coalesce(s.Solarinsolation, 0.0::DOUBLE) AS Solarinsolation
  FROM (SELECT DISTINCT CAST(DateTime AS DATE) AS day FROM hourly
        WHERE DateTime BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-10-30 23:59:59'
          AND hour(DateTime) BETWEEN 6 AND 17) d
  CROSS JOIN (SELECT unnest(range(6, 20)) AS hour) h
  LEFT JOIN (SELECT * FROM hourly WHERE hour(DateTime) BETWEEN 6 AND 17) s
    ON s.DateTime = d.day + INTERVAL (h.hour) HOUR)"""
STORED = (
    "stored AS (SELECT DateTime, CAST(printf('%.2f', Solarinsolation) AS DOUBLE) AS Solarinsolation FROM complete)"
)
INSOLATION = [
    HOURLY,
    COMPLETE,
    STORED,
    *_regrid("tenth", "stored", ["Solarinsolation"], "10 MINUTE"),
    "insolation_grid AS (SELECT unnest(generate_series(min(DateTime), max(DateTime), INTERVAL 1 MINUTE)) "
    "AS DateTime FROM tenth)",
    "insolation AS (SELECT g.DateTime, t.Solarinsolation FROM insolation_grid g "
    "ASOF LEFT JOIN tenth t ON g.DateTime >= t.DateTime)",
]
IRRADIANCE_TENS = [
    QUARTERS,
    *_regrid(
        "irradiance_tens",
        "quarters",
        ["GHI", "DNI", "DHI"],
        "10 MINUTE",
        "WHERE CAST(DateTime AS TIME) BETWEEN TIME '05:00:00' AND TIME '19:00:00'",
    ),
]
IRRADIANCE = [*IRRADIANCE_TENS, *_regrid("irradiance", "irradiance_tens", ["GHI", "DNI", "DHI"], "1 MINUTE")]


def _sun() -> str:
    place = {
        "utc_offset_h": solar.SITE_UTC_OFFSET_HOURS,
        "latitude": solar.SITE_LATITUDE,
        "longitude": solar.SITE_LONGITUDE,
        "pressure": solar.PRESSURE_HPA,
        "temperature": solar.TEMPERATURE_C,
        "altitude": 0.0,
    }
    constants = ", ".join(f"{value!r}::DOUBLE AS {name}" for name, value in place.items())
    inner = (
        f"SELECT DateTime, epoch(DateTime) AS sun_epoch_s, {constants} FROM "
        "(SELECT unnest(generate_series(day + INTERVAL 5 HOUR, day + INTERVAL 19 HOUR, INTERVAL 1 MINUTE)) "
        "AS DateTime FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events))"
    )
    for name, text in solar.STEPS:
        inner = f"SELECT *, {text} AS {name} FROM ({inner})"
    return (
        f"sun AS (SELECT * FROM (SELECT DateTime, {_round('azimuth_raw')} AS Azimuth, "
        f"{_round('elevation_raw')} AS Elevation FROM ({inner})) WHERE Elevation >= 0)"
    )


SUN = _sun()


def _latest(weather: str) -> str:
    """One weather row per timestamp: the one with the highest event id."""
    return (
        f"(SELECT time, H_UVI, TEMP FROM {weather} "
        "QUALIFY row_number() OVER (PARTITION BY time ORDER BY event_id DESC) = 1)"
    )


def _asof(name: str, left: str, weather: str, keep: str) -> str:
    near = "l.DateTime - w.time <= INTERVAL 10 MINUTE"
    return f"""{name} AS (
  SELECT {keep}, {_round(f"CASE WHEN {near} THEN w.H_UVI END", 1)} AS H_UVI,
    CASE WHEN {near} THEN w.TEMP END AS TEMP
  FROM {left} l ASOF LEFT JOIN {_latest(weather)} w ON l.DateTime >= w.time)"""


def _enriched(name: str, matched: str, keep: str, partition: str, order: str) -> str:
    """Forward-filled temperature and its interaction with the UV index."""
    window = f"({partition} ORDER BY {order} ROWS UNBOUNDED PRECEDING)"
    filled = f"(SELECT * REPLACE (last_value(TEMP IGNORE NULLS) OVER {window} AS TEMP) FROM {matched})"
    product = _round(f"({_round('H_UVI', 1)} + 0.01::DOUBLE) * TEMP")
    return f"{name} AS (SELECT {keep}, H_UVI, TEMP, {product} AS H_UVI_TEMP_interaction FROM {filled})"


REPAIRED = (
    "repaired AS (SELECT event_id, time, CAST(printf('%.2f', H_UVI) AS DOUBLE) AS H_UVI, "
    "CAST(printf('%.2f', TEMP) AS DOUBLE) AS TEMP FROM ("
    + _filled(["H_UVI", "TEMP"], "weather", "time, event_id", "event_id, time", digits=None)
    + "))"
)
ROW = f"l.event_id, l.LocationCode, l.DateTime, l.{LABEL}"
BARE_ROW = f"event_id, LocationCode, DateTime, {LABEL}"
SITES = (
    "sites AS (SELECT * FROM (VALUES "
    + ", ".join(f"({k}, {a}, {s})" for k, (a, s) in SITE_ATTRIBUTES.items())
    + ") AS t(LocationCode, angle, story))"
)
PARTIAL_SITES = "partial AS (SELECT * FROM sites WHERE LocationCode NOT IN (5, 11))"
CUTOFF = "(LocationCode NOT IN (1, 17) OR DateTime >= TIMESTAMP '2024-01-01 08:00:00')"
INSOLATION_SPLIT = [
    MINUTE_POWER,
    SUN,
    *INSOLATION,
    f"""judged AS (
  SELECT {ROW}, s.Azimuth, s.Elevation, i.Solarinsolation
  FROM minute_power l LEFT JOIN sun s ON l.DateTime = s.DateTime LEFT JOIN insolation i ON l.DateTime = i.DateTime)""",
]
ANY_NULL = "(Azimuth IS NULL OR Elevation IS NULL OR Solarinsolation IS NULL)"
DATETIME_TEXT = "strftime(DateTime, '%Y-%m-%d %H:%M:%S')"


def _feature_parts(rows: str, partition: str, order: str, cutoff: str) -> list[str]:
    measures = "H_UVI, TEMP, H_UVI_TEMP_interaction"
    return [
        WEATHER,
        REPAIRED,
        _asof("matched", rows, "repaired", ROW),
        _enriched("enriched", "matched", BARE_ROW, partition, order),
        SUN,
        *INSOLATION,
        f"""judged AS (
  SELECT {ROW}, {measures}, s.Azimuth, s.Elevation, i.Solarinsolation
  FROM (SELECT * FROM enriched WHERE {cutoff}) l JOIN sun s ON l.DateTime = s.DateTime
  LEFT JOIN insolation i ON l.DateTime = i.DateTime)""",
    ]


FEATURE_TAIL = [
    SITES,
    *IRRADIANCE,
    f"""feature_rows AS (
  SELECT j.*, coalesce(t.angle, 0) AS angle, coalesce(t.story, 0) AS story, r.DNI, r.DHI, r.GHI
  FROM (SELECT * FROM judged WHERE NOT {ANY_NULL}) j LEFT JOIN sites t ON j.LocationCode = t.LocationCode
  LEFT JOIN irradiance r ON j.DateTime = r.DateTime)""",
]
CLEAN_POWER = f"""clean AS (
  SELECT event_id, LocationCode, date_trunc('minute', DateTime) AS DateTime, {LABEL} FROM sources
  QUALIFY row_number() OVER (PARTITION BY LocationCode, date_trunc('minute', DateTime)
    ORDER BY DateTime, source_rank, event_id) = 1)"""
SERVING = f"""serving AS (
  SELECT q.event_id, q.LocationCode, q.slot_start + INTERVAL (m.i) MINUTE AS DateTime,
    CAST(NULL AS DOUBLE) AS {LABEL}
  FROM questions q CROSS JOIN (SELECT unnest(range(0, 10)) AS i) m)"""
TRAINING_PARTS = [
    SOURCES,
    CLEAN_POWER,
    *_feature_parts("clean", "PARTITION BY LocationCode", "DateTime", CUTOFF),
]
SILENT = "(SELECT * FROM insolation WHERE DateTime < TIMESTAMP '2024-01-20')"
MINUTES = f"""minutes AS (
  SELECT event_id, LocationCode, DateTime, {LABEL} FROM (
    SELECT *, ts_exact FROM (SELECT event_id, {SITE} AS LocationCode, date_trunc('minute', ts) AS DateTime,
      ts AS ts_exact, value AS {LABEL} FROM events))
  QUALIFY row_number() OVER (PARTITION BY LocationCode, DateTime ORDER BY ts_exact, event_id) = 1)"""
MERGED = f"""merged AS (
  SELECT event_id, LocationCode, DateTime,
    coalesce(CASE WHEN {LABEL} >= 100 THEN {LABEL} END,
      CASE WHEN minute(DateTime) <> 7 THEN greatest({LABEL} - 60.0::DOUBLE, 0.0::DOUBLE) END) AS {LABEL}
  FROM minutes)"""


def _one_hot(categories: Sequence[str]) -> str:
    return ", ".join(
        f'CASE WHEN LocationCode = {c} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "LocationCode_{c}"'
        for c in categories
    )


def _fold_of(key: str) -> str:
    return f"CAST('0x' || substr(md5({key} || '|42'), 1, 8) AS UBIGINT)"


def _fold(key: str) -> str:
    return f"CAST({_fold_of(key)} % 10 AS INTEGER)"


EVENT_KEY = "CAST(event_id AS VARCHAR)"
MEASURED = f"""measured AS (
  SELECT event_id, {SITE} AS LocationCode, value AS {LABEL},
    CASE WHEN {K} % 10 <> 0 THEN CAST({K} AS DOUBLE) END AS TEMP, 1.0::DOUBLE AS constant,
    CAST(hour(ts) AS DOUBLE) AS "Hour", CAST(minute(ts) AS DOUBLE) AS "Minute",
    CAST(month(ts) AS DOUBLE) AS "Month" FROM events)"""


def _correlations() -> str:
    hot = [f"LocationCode_{c}" for c in ALL_SITES]
    columns = ["TEMP", "constant", "Hour", "Minute", "Month", *hot, "Power(mW)"]
    wide = f"wide AS (SELECT *, {_one_hot(ALL_SITES)} FROM measured)"
    pairs = []
    for i, x in enumerate(columns):
        for y in columns[i:]:
            pairs.append((x, y))
    aggregates = ", ".join(f'corr("{x}", "{y}") AS c{i}' for i, (x, y) in enumerate(pairs))
    rows = []
    for i, (x, y) in enumerate(pairs):
        rows.append(f"('{x}', '{y}', c{i})")
        if x != y:
            rows.append(f"('{y}', '{x}', c{i})")
    lists = ", ".join(f"{{'x': {x}, 'y': {y}, 'r': {r}}}" for x, y, r in (t[1:-1].split(", ") for t in rows))
    one = f"one AS (SELECT {aggregates} FROM wide)"
    return _with(
        [MEASURED, wide, one, f"cells AS (SELECT unnest([{lists}]) AS cell FROM one)"],
        "SELECT cell.x AS x, cell.y AS y, "
        f"CASE WHEN isnan(cell.r) THEN NULL ELSE {_round('cell.r')} END AS r FROM cells",
    )


LEFT_OUT = [
    f"folded AS (SELECT {SITE} AS LocationCode, hour(ts) AS h, value AS y, {_fold(EVENT_KEY)} AS fold FROM events)",
    """sums AS (SELECT LocationCode, h, fold, sum(CAST(y AS DECIMAL(28,9))) AS s, count(*) AS n
  FROM folded GROUP BY ALL)""",
    """means AS (SELECT LocationCode, h, fold,
  CAST(sum(s) OVER cell - s AS DOUBLE) / nullif(sum(n) OVER cell - n, 0) AS p
  FROM sums WINDOW cell AS (PARTITION BY LocationCode, h))""",
    """scored AS (SELECT f.fold, f.y, m.p FROM folded f JOIN means m
  ON f.LocationCode = m.LocationCode AND f.h = m.h AND f.fold = m.fold WHERE m.p IS NOT NULL)""",
    """per_fold AS (SELECT fold, count(*) AS rows, sqrt(avg((y - p) * (y - p))) AS rmse,
  avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae,
  1 - avg((y - p) * (y - p)) / var_pop(y) AS r2 FROM scored GROUP BY fold)""",
]
METRICS = ["rmse", "mse", "mae", "r2"]
CALENDAR = ["Hour", "Minute", "Month"]
ROUNDED_METRICS = "fold, rows, " + ", ".join(f"{_round(c, 4)} AS {c}" for c in METRICS)


def _numeric(variant: str) -> list[str]:
    return [*FEATURE_SETS[variant], *CALENDAR]


def _model_rows(name: str, variant: str, parts: Sequence[str], more: str, condition: str) -> str:
    """A CTE of feature rows with calendar parts, as doubles."""
    measures = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in FEATURE_SETS[variant])
    calendar = ", ".join(f'CAST({c.lower()}(DateTime) AS DOUBLE) AS "{c}"' for c in CALENDAR)
    inner = _with(parts, f"SELECT LocationCode, DateTime, {measures}, {calendar}{more} FROM feature_rows WHERE {condition}")
    return f"{name} AS MATERIALIZED ({inner})"


def _boosted(variant: str, folds: int) -> list[str]:
    """CTEs of a fit on the training features."""
    key = "CAST(LocationCode AS VARCHAR) || '|' || CAST(DateTime AS VARCHAR)"
    more = f", {LABEL} AS label, CAST({_fold_of(key)} % {folds} AS INTEGER) AS fold"
    there = " AND ".join(f'"{c}" IS NOT NULL' for c in FEATURE_SETS[variant])
    rows = _model_rows("train_rows", variant, [*TRAINING_PARTS, *FEATURE_TAIL], more, f"{LABEL} IS NOT NULL AND {there}")
    fit = boosting_sql.boosting("train_rows", _numeric(variant), folds, SQL_BOOST)
    return [rows, *fit]


def _fold_scores(columns: str) -> str:
    return f"""SELECT {columns} FROM (SELECT fold, count(*) AS rows,
  sqrt(avg((label - margin) * (label - margin))) AS rmse, avg((label - margin) * (label - margin)) AS mse,
  avg(abs(label - margin)) AS mae,
  1 - avg((label - margin) * (label - margin)) / nullif(var_pop(label), 0) AS r2
  FROM m JOIN fitted g ON m.id = g.id AND m.fold = g.model GROUP BY fold)"""


def _boosted_serving(variant: str) -> str:
    parts = [
        QUESTIONS,
        SERVING,
        *_feature_parts("serving", "", "DateTime, LocationCode, event_id", "true"),
        *FEATURE_TAIL,
    ]
    serve = _model_rows("serve_rows", variant, parts, "", "true")
    scores = boosting_sql.scores("serve_rows", _numeric(variant), 10, SQL_BOOST)
    return _with(
        [*_boosted(variant, 10), serve, *scores],
        f"SELECT LocationCode, DateTime, {_round('score', 6)} AS {PREDICTION} FROM scored",
    )


ORACLES: dict[str, str] = {
    "slot_mean_answer": _with(
        [PREDICTED],
        f"SELECT LocationCode, time_bucket(INTERVAL 10 MINUTE, DateTime) AS slot_start, "
        f"{_round(f'greatest({_mean(PREDICTION)}, 0.0::DOUBLE)')} AS answer FROM predicted GROUP BY 1, 2",
    ),
    "slot_range_join": _with(
        [QUESTIONS, PREDICTED],
        f"""SELECT event_id, serial, {_round('CASE WHEN m IS NOT NULL THEN greatest(m, 0.0::DOUBLE) END')} AS answer,
  coalesce(printf('%.2f', {_round('CASE WHEN m IS NOT NULL THEN greatest(m, 0.0::DOUBLE) END')}), 'N/A') AS answer_text
FROM (SELECT q.event_id, q.serial, CASE WHEN count(p.DateTime) > 0 THEN {_mean('p.' + PREDICTION)} END AS m
  FROM questions q LEFT JOIN predicted p ON p.LocationCode = q.LocationCode
    AND p.DateTime BETWEEN q.slot_start AND q.slot_start + INTERVAL 9 MINUTE
  GROUP BY q.event_id, q.serial)""",
    ),
    "interval_means": _with(
        [PREDICTED],
        f"""SELECT q.event_id, q.LocationCode, q.start, q."end", count(p.DateTime) AS interval_rows,
  {_round('CASE WHEN count(p.DateTime) > 0 THEN ' + _mean('p.' + PREDICTION) + ' END', 6)} AS interval_mean
FROM (SELECT event_id, {SITE} AS LocationCode, date_trunc('second', ts) AS start,
    date_trunc('second', ts) + INTERVAL (event_id * 7919 % 100000) SECOND AS "end"
  FROM events WHERE event_type = 'signup') q
LEFT JOIN predicted p ON p.LocationCode = q.LocationCode AND p.DateTime BETWEEN q.start AND q."end"
GROUP BY ALL""",
    ),
    "slot_expand": _with(
        [MIXED],
        f"""SELECT event_id, serial, LocationCode, slot_start + INTERVAL (i) MINUTE AS DateTime,
  CAST(NULL AS DOUBLE) AS {LABEL}
FROM mixed CROSS JOIN (SELECT unnest(range(0, 10)) AS i) WHERE kind IN (0, 1)""",
    ),
    "serial_rejects": _with(
        [MIXED],
        """SELECT event_id, serial, CASE kind WHEN 2 THEN 'datetime' WHEN 3 THEN 'site' ELSE 'blank' END AS reason
FROM mixed WHERE kind IN (2, 3, 4)""",
    ),
    "sentinel_to_null": _with([WEATHER], "SELECT event_id, H_UVI, TEMP FROM weather"),
    "text_formats": f"""SELECT event_id,
  CASE WHEN {K} % 7 = 0 THEN '-99.00' WHEN {K} % 11 = 0 THEN 'abc' ELSE printf('%.2f', value) END AS uvi_text,
  printf('%.2f', event_id / 8.0::DOUBLE) AS eighths_text, strftime(ts, '%Y/%m/%d %H:%M') AS slash_text,
  date_trunc('second', ts) AS wall_clock, {_round('event_id / 8.0::DOUBLE')} AS eighths
FROM events WHERE event_type = 'view'""",
    "combine_sources": _with(
        [SOURCES],
        f"""SELECT LocationCode, DateTime, {LABEL}, event_id FROM sources
QUALIFY row_number() OVER (PARTITION BY LocationCode, DateTime ORDER BY source_rank, event_id) = 1""",
    ),
    "dedup_minute": _with([MINUTES], "SELECT * FROM minutes"),
    "clean_power": _with([SOURCES, CLEAN_POWER], f"SELECT LocationCode, DateTime, {LABEL}, event_id FROM clean"),
    "duplicate_report": _with(
        [MINUTE_POWER],
        "SELECT * FROM minute_power QUALIFY count(*) OVER (PARTITION BY LocationCode, DateTime) > 1",
    ),
    "station_start_cutoff": _with([POWER], f"SELECT * FROM power WHERE {CUTOFF}"),
    "null_counts": _with(
        [WEATHER],
        """SELECT 'time' AS "column", count(*) FILTER (WHERE time IS NULL) AS nulls FROM weather
UNION ALL SELECT 'H_UVI', count(*) FILTER (WHERE H_UVI IS NULL) FROM weather
UNION ALL SELECT 'TEMP', count(*) FILTER (WHERE TEMP IS NULL) FROM weather""",
    ),
    "interpolate_weather": _with(
        [WEATHER], _filled(["H_UVI", "TEMP"], "weather", "time, event_id", "event_id, time")
    ),
    "resample_10min_linear": _with(
        [HOURLY, *_regrid("tenth", "hourly", ["Solarinsolation"], "10 MINUTE")], "SELECT * FROM tenth"
    ),
    "reindex_10min_daylight": _with(IRRADIANCE_TENS, "SELECT * FROM irradiance_tens"),
    "upsample_1min_linear": _with(
        [TENS, *_regrid("minutely", "tens", ["mean_value", "max_value"], "1 MINUTE")], "SELECT * FROM minutely"
    ),
    "upsample_1min_ffill": _with(
        [
            TENS,
            "grid AS (SELECT unnest(generate_series(min(DateTime), max(DateTime), INTERVAL 1 MINUTE)) AS DateTime "
            "FROM tens)",
        ],
        "SELECT g.DateTime, t.mean_value, t.max_value FROM grid g ASOF LEFT JOIN tens t ON g.DateTime >= t.DateTime",
    ),
    "complete_day_grid": _with(
        [HOURLY, COMPLETE],
        "SELECT strftime(DateTime, '%Y/%m/%d %H:%M') AS DateTime, "
        "printf('%.2f', Solarinsolation) AS Solarinsolation FROM complete",
    ),
    "backfill_dates": """SELECT CAST(unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY)) AS DATE) AS date
FROM events""",
    "site_time_positions": f"""SELECT event_id, CAST({SITE} AS VARCHAR) AS site,
  row_number() OVER (ORDER BY CAST({SITE} AS VARCHAR), ts, event_id) - 1 AS position FROM events""",
    "forward_fill_by_site": f"""SELECT event_id, LocationCode, DateTime,
  last_value(TEMP IGNORE NULLS) OVER w AS TEMP, last_value(H_UVI IGNORE NULLS) OVER w AS H_UVI
FROM (SELECT event_id, {SITE} AS LocationCode, ts AS DateTime,
  CASE WHEN {K} % 10 < 2 THEN CAST({K} AS DOUBLE) END AS TEMP, CASE WHEN {K} % 50 = 7 THEN value END AS H_UVI
  FROM events)
WINDOW w AS (PARTITION BY LocationCode ORDER BY DateTime, event_id ROWS UNBOUNDED PRECEDING)""",
    "insolation_series": _with(INSOLATION, "SELECT * FROM insolation"),
    "irradiance_series": _with(IRRADIANCE, "SELECT * FROM irradiance"),
    "sun_position_grid": _with([SUN], "SELECT * FROM sun"),
    "asof_weather": _with(
        [POWER, WEATHER],
        f"""SELECT {ROW}, CASE WHEN l.DateTime - w.time <= INTERVAL 10 MINUTE THEN w.H_UVI END AS H_UVI,
  CASE WHEN l.DateTime - w.time <= INTERVAL 10 MINUTE THEN w.TEMP END AS TEMP
FROM power l ASOF LEFT JOIN {_latest('weather')} w ON l.DateTime >= w.time""",
    ),
    "asof_weather_by_site": _with(
        [
            POWER,
            f"stations AS (SELECT {SITE} AS LocationCode, ts AS time, value AS H_UVI FROM events "
            f"WHERE event_type = 'view' QUALIFY row_number() OVER (PARTITION BY {SITE}, ts ORDER BY event_id DESC) = 1)",
        ],
        f"""SELECT {ROW}, CASE WHEN l.DateTime - w.time <= INTERVAL 1 HOUR THEN w.H_UVI END AS H_UVI
FROM power l ASOF LEFT JOIN stations w ON l.LocationCode = w.LocationCode AND l.DateTime >= w.time""",
    ),
    "weather_features": _with(
        [
            POWER,
            WEATHER,
            _asof("matched", "power", "weather", ROW),
            _enriched("enriched", "matched", BARE_ROW, "PARTITION BY LocationCode", "DateTime, event_id"),
        ],
        "SELECT * FROM enriched",
    ),
    "unmatched_report": _with(
        [POWER, WEATHER, _asof("matched", "power", "weather", ROW)],
        """SELECT LocationCode, count(*) AS unmatched FROM matched
WHERE H_UVI IS NULL OR TEMP IS NULL GROUP BY LocationCode""",
    ),
    "join_sun_angle": _with(
        [MINUTE_POWER, SUN],
        f"SELECT {ROW}, s.Azimuth, s.Elevation FROM minute_power l JOIN sun s ON l.DateTime = s.DateTime",
    ),
    "join_insolation": _with(
        [MINUTE_POWER, *INSOLATION],
        f"SELECT {ROW}, i.Solarinsolation FROM minute_power l LEFT JOIN insolation i ON l.DateTime = i.DateTime",
    ),
    "join_irradiance": _with(
        [MINUTE_POWER, *IRRADIANCE],
        f"SELECT {ROW}, r.DNI, r.DHI, r.GHI FROM minute_power l LEFT JOIN irradiance r ON l.DateTime = r.DateTime",
    ),
    "accept_rows": _with(INSOLATION_SPLIT, f"SELECT * FROM judged WHERE NOT {ANY_NULL}"),
    "reject_rows": _with(
        INSOLATION_SPLIT, f"SELECT LocationCode, {DATETIME_TEXT} AS DateTime FROM judged WHERE {ANY_NULL}"
    ),
    "site_lookup_default": _with(
        [POWER, SITES, PARTIAL_SITES],
        f"""SELECT {ROW}, coalesce(p.angle, 0) AS angle, coalesce(p.story, 0) AS story
FROM power l LEFT JOIN partial p ON l.LocationCode = p.LocationCode""",
    ),
    "unmapped_sites": _with(
        [POWER, SITES, PARTIAL_SITES],
        "SELECT DISTINCT LocationCode FROM power WHERE LocationCode NOT IN (SELECT LocationCode FROM partial)",
    ),
    "calendar_features": _with(
        [POWER],
        f"""SELECT {ROW}, CAST(hour(DateTime) AS INTEGER) AS "Hour", CAST(minute(DateTime) AS INTEGER) AS "Minute",
  CAST(month(DateTime) AS INTEGER) AS "Month" FROM power l""",
    ),
    "onehot_sites": _with(
        [POWER],
        f"SELECT event_id, LocationCode, {_one_hot([c for c in ALL_SITES if c not in ('5', '11')])} FROM power",
    ),
    "site_categories": f"""SELECT CAST(row_number() OVER (ORDER BY site) - 1 AS INTEGER) AS slot, site
FROM (SELECT DISTINCT CAST({SITE} AS VARCHAR) AS site FROM events)""",
    "correlation_matrix": _correlations(),
    "feature_align": _with(
        [MEASURED],
        """SELECT event_id, "Minute", coalesce(TEMP, 0.0::DOUBLE) AS TEMP, 0.0::DOUBLE AS GHI,
  CASE WHEN LocationCode = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "LocationCode_1",
  0.0::DOUBLE AS "LocationCode_99" FROM measured""",
    ),
    "fold_assign": f"SELECT event_id, {_fold(EVENT_KEY)} AS fold FROM events",
    "fold_assign_day": f"SELECT event_id, {_fold('CAST(CAST(ts AS DATE) AS VARCHAR)')} AS fold FROM events",
    "fold_assign_balanced": f"""SELECT event_id,
  CAST((row_number() OVER (ORDER BY md5({EVENT_KEY} || '|42'), event_id) - 1) % 10 AS INTEGER) AS fold FROM events""",
    "fold_metrics": _with(
        LEFT_OUT,
        "SELECT fold, rows, " + ", ".join(f"{_round(c, 4)} AS {c}" for c in METRICS) + " FROM per_fold",
    ),
    "cv_summary": _with(
        LEFT_OUT,
        "SELECT " + ", ".join(f"{_round(f'avg({c})', 4)} AS {c}" for c in METRICS) + " FROM per_fold",
    ),
    "ensemble_mean": f"""SELECT event_id,
  {_round('(value * 0.9::DOUBLE + (value + 5.0::DOUBLE) + hour(ts) * 3.5::DOUBLE) / 3.0::DOUBLE', 6)} AS prediction
FROM events""",
    "pseudo_label_merge": _with([MINUTES, MERGED], "SELECT * FROM merged"),
    "pseudo_label_train": _with(
        [POWER, MINUTES, MERGED],
        "SELECT *, 'measured' AS label_source FROM power UNION ALL SELECT *, 'pseudo' FROM merged",
    ),
    "weather_json_flatten": f"""SELECT s.name || CAST({SITE} AS VARCHAR) AS StationId,
  date_trunc('second', ts) AS time,
  CASE WHEN {K} % 13 = 0 THEN 'n/a' ELSE printf('%.2f', value) END AS H_UVI,
  CASE WHEN s.name = 'A' THEN printf('%.2f', CAST({K} AS DOUBLE)) ELSE '0.00' END AS TEMP
FROM events CROSS JOIN (VALUES ('A'), ('B')) s(name)""",
    "irradiance_json_flatten": f"""SELECT date_trunc('minute', ts) AS DateTime, value AS GHI,
  value * 0.5::DOUBLE AS DNI, value * 0.25::DOUBLE AS DHI
FROM events WHERE hour(ts) BETWEEN 5 AND 18 AND {K} % 11 <> 0 AND {K} % 13 <> 5""",
    "irradiance_json_rejects": f"""SELECT date_trunc('minute', ts) AS DateTime, value AS GHI,
  value * 0.5::DOUBLE AS DNI, CAST(NULL AS DOUBLE) AS DHI
FROM events WHERE hour(ts) BETWEEN 5 AND 18 AND {K} % 11 = 0 AND {K} % 13 <> 5
UNION ALL SELECT NULL, value, value * 0.5::DOUBLE, CASE WHEN {K} % 11 <> 0 THEN value * 0.25::DOUBLE END
FROM events WHERE {K} % 13 = 5""",
    "csv_sink_scan": _with(
        [POWER],
        f"""SELECT event_id, LocationCode, DateTime,
  CAST(printf('%.1f', {LABEL}) AS DOUBLE) AS {LABEL} FROM power""",
    ),
    "station_line_accounting": """WITH judged AS (SELECT date_trunc('hour', ts) AS h, CASE
    WHEN event_id % 10 IN (3, 4) THEN 'malformed' WHEN event_id % 10 = 5 THEN 'untimed'
    WHEN ts < TIMESTAMP '2024-01-05' OR ts >= TIMESTAMP '2024-01-26' THEN 'outside'
    WHEN hour(ts) NOT BETWEEN 6 AND 17 THEN 'hours' ELSE 'kept' END AS outcome FROM events)
SELECT outcome, count(*) AS lines FROM judged WHERE outcome <> 'kept' GROUP BY 1
UNION ALL SELECT 'accepted', count(DISTINCT h) FROM judged WHERE outcome = 'kept'
UNION ALL SELECT 'repeat', count(*) - count(DISTINCT h) FROM judged WHERE outcome = 'kept'""",
    "question_file_scan": _with([QUESTIONS], "SELECT serial FROM questions"),
    "slash_series_scan": _with([HOURLY, COMPLETE, STORED], "SELECT * FROM stored"),
    "timestamp_coercion": """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN date_trunc('day', ts)
  ELSE date_trunc('second', ts) END AS DateTime FROM events WHERE event_id % 5 IN (0, 1, 2)""",
    "conditional_drop": _with([POWER], "SELECT * FROM power"),
    "station_first_rows": _with(
        [
            """hourly AS (SELECT date_trunc('hour', ts) AS DateTime, value AS Solarinsolation FROM events
  WHERE event_type = 'purchase' QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', ts) ORDER BY event_id) = 1)""",
            COMPLETE,
        ],
        "SELECT * FROM complete",
    ),
    "site_file_scan": _with(
        [POWER],
        f"""SELECT event_id, LocationCode, DateTime, {LABEL},
  CASE WHEN LocationCode % 2 = 1 THEN event_id / 4.0::DOUBLE END AS "Humidity(%)" FROM power""",
    ),
    "site_partition_sink": _with([POWER], "SELECT * FROM power"),
    "reject_json_sink": _with(
        INSOLATION_SPLIT, f"SELECT LocationCode, {DATETIME_TEXT} AS DateTime FROM judged WHERE {ANY_NULL}"
    ),
    "feed_dedup_stream": f"""SELECT DISTINCT s.name || CAST({SITE} AS VARCHAR) AS StationId,
  date_trunc('minute', ts) AS time, 'accepted' AS outcome FROM events CROSS JOIN (VALUES ('A'), ('B')) s(name)
WHERE event_id % 50 <> 7
UNION ALL SELECT s.name || CAST({SITE} AS VARCHAR), NULL, 'untimed'
FROM events CROSS JOIN (VALUES ('A'), ('B')) s(name) WHERE event_id % 50 = 7""",
    "training_feature_table": _with([*TRAINING_PARTS, *FEATURE_TAIL], "SELECT * FROM feature_rows"),
    "training_feature_rejects": _with(
        [p.replace("LEFT JOIN insolation i", f"LEFT JOIN {SILENT} i") for p in TRAINING_PARTS], f"SELECT LocationCode, {DATETIME_TEXT} AS DateTime FROM judged WHERE {ANY_NULL}"
    ),
    "gbt_oof_metrics": _with(
        _boosted("full", 10), _fold_scores(ROUNDED_METRICS)
    ),
    "gbt_node_table": _with(
        _boosted("full", 10),
        f"SELECT * REPLACE ({_round('value', 9)} AS value) FROM ({boosting_sql.node_rows(_numeric('full'), SQL_BOOST, 'LocationCode')})",
    ),
    "gbt_replay": _with(
        _boosted("base", 3),
        f"SELECT *, unnest(['retrain', 'rescore']) AS mode FROM ({_fold_scores(ROUNDED_METRICS)})",
    ),
    "gbt_ensemble_score": _boosted_serving("angle"),
    "gbt_table_score": _boosted_serving("angle"),
    "serving_feature_table": _with(
        [
            QUESTIONS,
            SERVING,
            *_feature_parts("serving", "", "DateTime, LocationCode, event_id", "true"),
            *FEATURE_TAIL,
        ],
        "SELECT * FROM feature_rows",
    ),
}
