"""SQL twins of the table definitions, used to check the Spark results with DuckDB."""

from __future__ import annotations

from headway import schema as S

# The sampling hash of a key with seed 42; texts of twelve hexadecimal digits order as numbers.
HASH = "substr(md5('42|' || CAST({key} AS VARCHAR)), 1, 12)"


def share_of_hash(share: float) -> str:
    return f"'{int(share * 16**12):012x}'"


HALF = share_of_hash(0.5)


def label_case(code: str) -> str:
    arms = " ".join(f"WHEN {k} THEN '{v}'" for k, v in S.CONDITION_LABELS.items())
    return f"CASE {code} {arms} END"


def pad(text: str) -> str:
    return f"CASE WHEN length({text}) < 2 THEN lpad({text}, 2, '0') ELSE {text} END"


def number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def right_closed(value: str, edges) -> str:
    arms = " ".join(f"WHEN {value} <= {number(float(e))} THEN {i}" for i, e in enumerate(edges[1:], 1))
    return f"CASE WHEN {value} < {number(float(edges[0]))} THEN NULL {arms} END"


TABLES = {
    "trips": f"""
SELECT event_id AS trip_id, CAST(ts AS DATE) AS service_date, CAST(hour(ts) AS BIGINT) AS hour,
       CAST(isodow(ts) - 1 AS BIGINT) AS weekday,
       CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
       {pad("CAST(user_id % 30 AS VARCHAR)")} AS route_id,
       CAST(event_id % 2 AS VARCHAR) AS direction_id, CAST(user_id AS VARCHAR) AS stop_id,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS time_point_order,
       nullif(event_type, 'error') AS point_type, ts AS actual_dt,
       (value - 50.0) * 60.0 AS delay_seconds, value - 50.0 AS delay_minutes
FROM events""",
    "conditions": f"""
SELECT timestamp_hour, air_temp_c, rel_humidity_pct, precip_mm, wind_dir_deg, wind_speed_kmh,
       pressure_hpa, cloud_cover, {label_case("coco")} AS weather_condition
FROM (SELECT date_trunc('hour', ts + INTERVAL 1 DAY) AS timestamp_hour, avg(value) AS air_temp_c,
             max(value) AS rel_humidity_pct, (count(*) % 12) * CAST('0.3' AS DOUBLE) AS precip_mm,
             CAST((min(user_id) * 37) % 360 AS DOUBLE) AS wind_dir_deg, min(value) AS wind_speed_kmh,
             CAST(count(*) + 1000 AS DOUBLE) AS pressure_hpa,
             CAST(max(user_id) % 9 AS DOUBLE) AS cloud_cover, min(event_id) % 30 + 1 AS coco
      FROM events GROUP BY 1)""",
    "weathered": """
SELECT t.*, date_trunc('hour', t.actual_dt) AS event_hour, air_temp_c, rel_humidity_pct, precip_mm,
       wind_dir_deg, wind_speed_kmh, pressure_hpa, cloud_cover, weather_condition
FROM trips t LEFT JOIN conditions c ON date_trunc('hour', t.actual_dt) = c.timestamp_hour""",
    "monthly": """
SELECT strftime(ts, '%Y-%m-%d') AS service_date,
       CASE WHEN event_type = 'error' THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS scheduled,
       strftime(ts + to_seconds(CAST(floor((value - 50.0) * 60.0) AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS actual,
       CAST(user_id % 30 AS VARCHAR) AS route_id, CAST(event_id % 2 AS VARCHAR) AS direction_id,
       CAST(user_id AS VARCHAR) AS stop_id,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS time_point_order,
       event_type AS point_type
FROM events""",
    "raw_arrivals": """
SELECT * FROM monthly WHERE service_date <= '2024-01-20'
UNION ALL
SELECT * FROM monthly WHERE service_date >= '2024-01-15'""",
    "timed": """
SELECT CAST(service_date AS DATE) AS service_date, route_id, direction_id, stop_id, time_point_order,
       point_type,
       CAST(service_date AS DATE) + CAST(TRY_CAST(scheduled AS TIMESTAMP) AS TIME) AS scheduled_dt,
       CAST(service_date AS DATE) + CAST(TRY_CAST(actual AS TIMESTAMP) AS TIME) AS actual_dt
FROM (SELECT DISTINCT * FROM raw_arrivals)""",
    "clean": """
SELECT *, CAST(epoch_us(actual_dt) - epoch_us(scheduled_dt) AS DOUBLE) / 1000000 AS delay_seconds,
       CAST(epoch_us(actual_dt) - epoch_us(scheduled_dt) AS DOUBLE) / 1000000 / 60 AS delay_minutes,
       CAST(hour(scheduled_dt) AS BIGINT) AS hour, CAST(isodow(scheduled_dt) - 1 AS BIGINT) AS weekday,
       CAST(CASE WHEN isodow(scheduled_dt) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend
FROM timed""",
    "shipments": f"""
SELECT CAST(o_orderdate AS DATE) AS service_date, CAST(floor(l_quantity) AS BIGINT) % 24 AS hour,
       CAST(isodow(o_orderdate) - 1 AS BIGINT) AS weekday,
       CAST(CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
       CAST(l_suppkey AS VARCHAR) AS route_id, l_linestatus AS direction_id,
       CAST(l_partkey AS VARCHAR) AS stop_id, CAST(l_linenumber AS BIGINT) AS time_point_order,
       l_returnflag AS point_type, o_orderdate AS scheduled_dt, l_shipdate AS actual_dt,
       date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) * CAST(3 AS DOUBLE) AS delay_seconds,
       l_extendedprice / 5000.0 AS air_temp_c, l_quantity * 2.0 AS rel_humidity_pct,
       l_discount * 10.0 AS precip_mm, CAST(l_partkey % 360 AS DOUBLE) AS wind_dir_deg,
       l_tax * 100.0 AS wind_speed_kmh, 1000.0 + l_quantity AS pressure_hpa,
       CAST(l_suppkey % 9 AS DOUBLE) AS cloud_cover,
       {label_case("l_suppkey % 30 + 1")} AS weather_condition
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "labelled": """
SELECT *, delay_seconds / 60.0 AS delay_minutes,
       CAST(CASE WHEN delay_seconds > 300.0 THEN 1 ELSE 0 END AS BIGINT) AS label,
       CASE WHEN service_date < DATE '1999-01-01' THEN 'train'
            WHEN service_date < DATE '2000-01-01' THEN 'val' ELSE 'test' END AS split
FROM shipments
WHERE delay_seconds BETWEEN -7200 AND 7200
  AND service_date >= DATE '1995-01-01' AND service_date < DATE '2002-01-01'""",
    "scored": """
SELECT trip_id, hour, time_point_order / CAST(9 AS DOUBLE) AS precip_mm,
       CAST(CASE WHEN delay_minutes >= 5.0 THEN 1 ELSE 0 END AS BIGINT) AS y_true,
       CAST(CASE WHEN time_point_order / CAST(99 AS DOUBLE) >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS y_pred,
       time_point_order / CAST(99 AS DOUBLE) AS y_proba
FROM trips""",
    "curve": """
SELECT y_proba AS threshold, pos, neg,
       CAST(sum(pos) OVER (ORDER BY y_proba DESC) AS BIGINT) AS tp,
       CAST(sum(neg) OVER (ORDER BY y_proba DESC) AS BIGINT) AS fp,
       CAST(sum(pos) OVER () AS BIGINT) AS p, CAST(sum(neg) OVER () AS BIGINT) AS n
FROM (SELECT y_proba, count(*) FILTER (y_true = 1) AS pos, count(*) FILTER (y_true = 0) AS neg
      FROM scored GROUP BY 1)""",
    "cells": """
SELECT count(*) FILTER (y_true = 0 AND y_pred = 0) AS tn, count(*) FILTER (y_true = 0 AND y_pred = 1) AS fp,
       count(*) FILTER (y_true = 1 AND y_pred = 0) AS fn, count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp
FROM scored""",
    "late": "SELECT * FROM weathered",
    "route_stats": """
SELECT route_id, hour, weekday, avg(delay_minutes) AS mean_delay, median(delay_minutes) AS median_delay,
       CAST(count(delay_minutes) AS DOUBLE) AS n_delay
FROM trips WHERE service_date < DATE '2024-01-21' GROUP BY 1, 2, 3""",
    "holiday_rules": """
SELECT y, make_date(y, m, d) AS day, TRUE AS shifts
FROM range(1980, 2041) r(y), (VALUES (1, 1), (6, 19), (7, 4), (11, 11), (12, 25)) f(m, d)
WHERE m <> 6 OR y >= 2021
UNION ALL
SELECT y, CAST(make_date(y, m, 1) + CAST((w - isodow(make_date(y, m, 1)) + 7) % 7 + 7 * (k - 1) AS INTEGER) AS DATE), FALSE
FROM range(1980, 2041) r(y), (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) f(m, w, k)
WHERE m <> 1 OR y >= 1986
UNION ALL
SELECT y, CAST(make_date(y, 5, 31) - CAST((isodow(make_date(y, 5, 31)) - 1) AS INTEGER) AS DATE), FALSE
FROM range(1980, 2041) r(y)""",
    "holidays": """
SELECT DISTINCT day FROM (
  SELECT day FROM holiday_rules
  UNION ALL SELECT CAST(day - 1 AS DATE) FROM holiday_rules WHERE shifts AND isodow(day) = 6
  UNION ALL SELECT CAST(day + 1 AS DATE) FROM holiday_rules WHERE shifts AND isodow(day) = 7)""",
}

# Which of the tables above a table reads.
NEEDS = {
    "weathered": ["trips", "conditions"],
    "raw_arrivals": ["monthly"],
    "timed": ["raw_arrivals"],
    "clean": ["timed"],
    "labelled": ["shipments"],
    "scored": ["trips"],
    "curve": ["scored"],
    "cells": ["scored"],
    "late": ["weathered"],
    "route_stats": ["trips"],
    "holidays": ["holiday_rules"],
}


def with_tables(sql: str, tables) -> str:
    """The query preceded by the definitions it needs, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in tables:
        add(name)
    if not ordered:
        return sql
    parts = ", ".join(f"{name} AS ({TABLES[name].strip()})" for name in ordered)
    return f"WITH {parts} {sql.strip()}"


# ---- gradient descent, a fixed number of steps -----------------------------

DESCENT_NUMERIC = ["hour", "weekday", "time_point_order"]
DESCENT_LEVELS = {
    "point_type": ["<missing>", "click", "purchase", "signup", "view"],
    "direction_id": ["0", "1"],
}


def descent_names() -> list[str]:
    names = [f"{c}_scaled" for c in DESCENT_NUMERIC]
    return names + [f"{c}_filled_onehot_{v}" for c, vs in DESCENT_LEVELS.items() for v in vs]


def descent_tables(steps: int, rate: float, alpha: float, eps: float, start=None) -> str:
    """CTEs ``x`` (features), ``w0`` .. ``w<steps>`` (weights, loss of the step) and ``g<step>`` (slopes).

    ``start`` holds the bias and the weights to start from, all zero by default.
    """
    size = len(descent_names())
    start = [0.0] * (size + 1) if start is None else [float(v) for v in start]
    features = [
        f"(t.{c} - (SELECT avg({c}) FROM trips)) / (SELECT stddev_pop({c}) FROM trips) AS x{i}"
        for i, c in enumerate(DESCENT_NUMERIC)
    ]
    i = len(DESCENT_NUMERIC)
    for column, levels in DESCENT_LEVELS.items():
        for level in levels:
            features.append(
                f"CASE WHEN coalesce({column}, '<missing>') = '{level}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS x{i}"
            )
            i += 1
    parts = [
        f"x AS (SELECT trip_id, CASE WHEN delay_minutes >= 5.0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS y, {', '.join(features)} FROM trips t)",
        f"w0 AS (SELECT {number(start[0])} AS b, {', '.join(f'{number(v)} AS w{j}' for j, v in enumerate(start[1:]))}, {number(0.0)} AS loss)",
    ]
    score = "b + " + " + ".join(f"w{j} * x{j}" for j in range(size))
    for step in range(steps):
        old = f"w{step}"
        parts.append(f"p{step} AS (SELECT x.*, {old}.*, 1 / (1 + exp(-({score}))) AS p FROM x, {old})")
        sums = ", ".join(f"avg((p - y) * x{j}) + {number(alpha)} * any_value(w{j}) AS g{j}" for j in range(size))
        keep = ", ".join(f"any_value(w{j}) AS w{j}" for j in range(size))
        parts.append(
            f"g{step} AS (SELECT any_value(b) AS b, {keep}, avg(p - y) AS gb, {sums}, "
            f"-avg(y * ln(p + {number(eps)}) + (1 - y) * ln(1 - p + {number(eps)})) AS entropy FROM p{step})"
        )
        new = [f"w{j} - {number(rate)} * g{j}" for j in range(size)]
        penalty = " + ".join(f"({n}) * ({n})" for n in new)
        parts.append(
            f"w{step + 1} AS (SELECT b - {number(rate)} * gb AS b, {', '.join(f'{n} AS w{j}' for j, n in enumerate(new))}, "
            f"entropy + {number(alpha / 2)} * ({penalty}) AS loss FROM g{step})"
        )
    return f"WITH trips AS ({TABLES['trips'].strip()}), " + ", ".join(parts)


def descent_weights(steps: int, rate: float, alpha: float, eps: float) -> str:
    rows = [f"SELECT 'bias' AS name, round(b, 6) AS value FROM w{steps}"]
    rows += [f"SELECT '{n}', round(w{j}, 6) FROM w{steps}" for j, n in enumerate(descent_names())]
    rows += [f"SELECT 'loss_{i}', round(loss, 6) FROM w{i}" for i in range(1, steps + 1)]
    return f"{descent_tables(steps, rate, alpha, eps)} {' UNION ALL '.join(rows)}"


def descent_stopped(steps: int, rate: float, alpha: float, eps: float, start, tol: float) -> str:
    """As ``descent_weights`` up to the first step whose slopes, the bias's included, have a norm below ``tol``."""
    size = len(descent_names())
    squares = " + ".join(f"g{j} * g{j}" for j in range(size))
    norms = " UNION ALL ".join(f"SELECT {i + 1} AS step, sqrt({squares} + gb * gb) AS norm FROM g{i}" for i in range(steps))
    stop = f"stop AS (SELECT coalesce(min(step) FILTER (norm < {number(tol)}), {steps}) AS stop FROM ({norms}))"
    rows = []
    for i in range(1, steps + 1):
        rows.append(f"SELECT 'bias' AS name, round(b, 6) AS value FROM w{i}, stop WHERE stop = {i}")
        rows += [f"SELECT '{n}', round(w{j}, 6) FROM w{i}, stop WHERE stop = {i}" for j, n in enumerate(descent_names())]
        rows.append(f"SELECT 'loss_{i}', round(loss, 6) FROM w{i}, stop WHERE stop >= {i}")
    return f"{descent_tables(steps, rate, alpha, eps, start)}, {stop} {' UNION ALL '.join(rows)}"


def descent_scores(steps: int, rate: float, alpha: float, eps: float) -> str:
    score = "b + " + " + ".join(f"w{j} * x{j}" for j in range(len(descent_names())))
    return (
        f"{descent_tables(steps, rate, alpha, eps)} SELECT trip_id, round({score}, 6) AS score, "
        f"round(1 / (1 + exp(-({score}))), 6) AS probability, "
        f"CAST(CASE WHEN 1 / (1 + exp(-({score}))) >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS predicted "
        f"FROM x, w{steps}"
    )


def descent_ranking(steps: int, rate: float, alpha: float, eps: float, n: int) -> str:
    rows = [f"SELECT '{name}' AS feature, w{j} AS w FROM w{steps}" for j, name in enumerate(descent_names())]
    return (
        f"{descent_tables(steps, rate, alpha, eps)} SELECT feature, round(w, 6) AS coefficient, "
        f"round(abs(w), 6) AS abs_value FROM ({' UNION ALL '.join(rows)}) ORDER BY abs(w) DESC, feature LIMIT {n}"
    )
