"""The registered queries in SQL, for a second engine to check against."""

from __future__ import annotations

_EVENT_READINGS = """
raw AS (
  SELECT strftime(ts, '%Y-%m-%dT%H') AS period,
         'R' || (user_id % 4) AS respondent,
         CASE WHEN event_id % 11 <> 0 THEN 'Region ' || (user_id % 4) END
           AS respondent_name,
         CASE event_type WHEN 'view' THEN 'D' WHEN 'click' THEN 'DF'
              WHEN 'purchase' THEN 'NG' WHEN 'signup' THEN 'TI' ELSE 'XX' END AS type,
         CASE WHEN event_id % 101 = 0 THEN 'n/a'
              WHEN event_id % 13 = 0 THEN NULL
              WHEN event_id % 17 = 0 THEN '0'
              WHEN event_id % 19 = 0
                   OR (event_type = 'signup' AND event_id % 2 = 0)
                THEN CAST(-value AS VARCHAR)
              ELSE CAST(value AS VARCHAR) END AS value,
         event_id AS ordinal
  FROM events),
readings AS (
  SELECT try_strptime(period, '%Y-%m-%dT%H') AS period, respondent, respondent_name,
         type, TRY_CAST(value AS DOUBLE) AS value, ordinal
  FROM raw),
bronze AS (
  SELECT period, respondent, respondent_name, type, value FROM readings
  QUALIFY row_number() OVER (PARTITION BY period, respondent, type
                             ORDER BY ordinal DESC) = 1)
"""

_LINEITEM_READINGS = """
cells AS (
  SELECT l_shipdate
           + CAST((l_orderkey * 7 + l_linenumber) % 24 AS INTEGER) * INTERVAL 1 HOUR
           AS period,
         s_nationkey, n_name,
         sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS d,
         sum(CAST(l_extendedprice * (1 - l_discount + l_tax) AS DECIMAL(18,4))) AS df,
         sum(CAST(l_quantity * 1000 AS DECIMAL(18,4))) AS ng,
         sum(CAST(l_extendedprice * (l_discount - l_tax) AS DECIMAL(18,4))) AS ti
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2, 3),
readings AS (
  SELECT period, 'N' || s_nationkey AS respondent, n_name AS respondent_name,
         type, CAST(v AS DOUBLE) AS value, 0 AS ordinal
  FROM (SELECT period, s_nationkey, n_name, 'D' AS type, d AS v FROM cells
        UNION ALL SELECT period, s_nationkey, n_name, 'DF', df FROM cells
        UNION ALL SELECT period, s_nationkey, n_name, 'NG', ng FROM cells
        UNION ALL SELECT period, s_nationkey, n_name, 'TI', ti FROM cells)),
bronze AS (SELECT period, respondent, respondent_name, type, value FROM readings)
"""

_TABLES = """
demand_rows AS (SELECT * FROM readings WHERE type IN ('D', 'DF')),
sparse_pivot AS (
  SELECT period, respondent,
         arg_min(respondent_name, ordinal) FILTER (respondent_name IS NOT NULL)
           AS respondent_name,
         arg_min(value, ordinal) FILTER (type = 'D' AND value IS NOT NULL)
           AS demand_mwh,
         arg_min(value, ordinal) FILTER (type = 'DF' AND value IS NOT NULL)
           AS forecast_demand_mwh
  FROM demand_rows GROUP BY period, respondent),
dense_pivot AS (
  SELECT period, respondent, respondent_name, demand_mwh, forecast_demand_mwh
  FROM (SELECT DISTINCT period FROM demand_rows)
  CROSS JOIN (SELECT DISTINCT respondent FROM demand_rows)
  LEFT JOIN sparse_pivot USING (period, respondent)),
silver_demand AS (
  SELECT *, demand_mwh - forecast_demand_mwh AS forecast_error_mwh,
         CASE WHEN demand_mwh > 0
              THEN (demand_mwh - forecast_demand_mwh) / demand_mwh * 100 END
           AS forecast_error_pct
  FROM dense_pivot),
silver_generation AS (
  SELECT period, respondent, respondent_name, value AS net_generation_mwh
  FROM bronze WHERE type = 'NG'),
silver_interchange AS (
  SELECT period, respondent, respondent_name, value AS total_interchange_mwh
  FROM bronze WHERE type = 'TI'),
gold_demand_daily AS (
  SELECT CAST(period AS DATE) AS date, respondent,
         arg_min(respondent_name, period) FILTER (respondent_name IS NOT NULL)
           AS respondent_name,
         avg(demand_mwh) AS avg_demand_mwh, max(demand_mwh) AS peak_demand_mwh,
         min(demand_mwh) AS min_demand_mwh,
         stddev_samp(demand_mwh) AS demand_stddev_mwh,
         count(demand_mwh) AS observation_count
  FROM silver_demand GROUP BY 1, 2),
gold_forecast_performance AS (
  SELECT CAST(period AS DATE) AS date, respondent,
         arg_min(respondent_name, period) FILTER (respondent_name IS NOT NULL)
           AS respondent_name,
         avg(abs(forecast_error_mwh)) AS mae_mwh,
         sqrt(avg(forecast_error_mwh * forecast_error_mwh)) AS rmse_mwh,
         100 * avg(CASE WHEN demand_mwh <> 0
                        THEN abs(forecast_error_mwh) / abs(demand_mwh) END) AS mape_pct,
         avg(forecast_error_mwh) AS forecast_bias_mwh,
         max(abs(forecast_error_mwh)) AS max_abs_error_mwh,
         count(forecast_error_mwh) AS observation_count
  FROM silver_demand GROUP BY 1, 2),
gold_grid_balance AS (
  SELECT period, respondent,
         coalesce(d.respondent_name, g.respondent_name, i.respondent_name)
           AS respondent_name,
         demand_mwh, net_generation_mwh, total_interchange_mwh,
         net_generation_mwh - demand_mwh AS generation_minus_demand_mwh,
         forecast_demand_mwh
  FROM silver_demand d
  FULL JOIN silver_generation g USING (period, respondent)
  FULL JOIN silver_interchange i USING (period, respondent)),
sparse_balance AS (
  SELECT period, respondent,
         coalesce(d.respondent_name, g.respondent_name, i.respondent_name)
           AS respondent_name,
         demand_mwh, net_generation_mwh, total_interchange_mwh,
         net_generation_mwh - demand_mwh AS generation_minus_demand_mwh
  FROM sparse_pivot d
  FULL JOIN silver_generation g USING (period, respondent)
  FULL JOIN silver_interchange i USING (period, respondent)),
latest AS (
  SELECT * FROM gold_grid_balance
  QUALIFY row_number() OVER (PARTITION BY respondent ORDER BY period DESC) = 1),
kpis AS (
  SELECT respondent,
         sum(mape_pct * observation_count)
             FILTER (mape_pct IS NOT NULL AND observation_count > 0)
           / nullif(sum(observation_count)
             FILTER (mape_pct IS NOT NULL AND observation_count > 0), 0)
           AS recent_forecast_mape_pct,
         sum(forecast_bias_mwh * observation_count)
             FILTER (forecast_bias_mwh IS NOT NULL AND observation_count > 0)
           / nullif(sum(observation_count)
             FILTER (forecast_bias_mwh IS NOT NULL AND observation_count > 0), 0)
           AS recent_forecast_bias_mwh
  FROM gold_forecast_performance
  WHERE date >= (SELECT max(date) FROM gold_forecast_performance) - 6
  GROUP BY respondent),
gold_regional_summary AS (
  SELECT respondent, respondent_name, period AS latest_period,
         demand_mwh AS latest_demand_mwh,
         forecast_demand_mwh AS latest_forecast_demand_mwh,
         net_generation_mwh AS latest_net_generation_mwh,
         total_interchange_mwh AS latest_total_interchange_mwh,
         recent_forecast_mape_pct, recent_forecast_bias_mwh
  FROM latest LEFT JOIN kpis USING (respondent)),
bounds AS (SELECT min(period) AS first_hour, max(period) AS last_hour FROM readings),
chunks AS (
  SELECT CAST(n AS INTEGER) AS chunk,
         first_hour + n * INTERVAL 121 HOUR AS start_hour,
         least(first_hour + n * INTERVAL 121 HOUR + INTERVAL 120 HOUR, last_hour)
           AS end_hour
  FROM bounds, range(10000) t(n)
  WHERE first_hour + n * INTERVAL 121 HOUR <= last_hour)
"""

_EVENTS = f"WITH {_EVENT_READINGS}, {_TABLES}"
_LINEITEM = f"WITH {_LINEITEM_READINGS}, {_TABLES}"

_HOUR = "strftime({0}, '%Y-%m-%dT%H')"
_STAMP = "strftime({0}, '%Y-%m-%dT%H:%M:%SZ')"
_DATE = "strftime({0}, '%Y-%m-%d')"


def _rounded(value: str, digits: int = 6) -> str:
    """Round as a decimal; see ``records`` for the reason."""
    return (
        f"CAST(round(CAST({value} AS DECIMAL(38,{digits + 4})), {digits}) AS DOUBLE)"
    )


def _select(columns: str, digits: int = 6) -> str:
    """Column list: ``ts:`` and ``day:`` print times, ``num:`` rounds."""
    out = []
    for item in columns.split():
        kind, _, name = item.rpartition(":")
        expression = {
            "": "{0}",
            "ts": _STAMP,
            "hour": _HOUR,
            "day": _DATE,
            "num": _rounded("{0}", digits),
        }[kind].format(name)
        out.append(f"{expression} AS {name}")
    return ", ".join(out)


_DEMAND = (
    "ts:period respondent respondent_name num:demand_mwh num:forecast_demand_mwh "
    "num:forecast_error_mwh num:forecast_error_pct"
)
_DAILY = (
    "day:date respondent respondent_name num:avg_demand_mwh num:peak_demand_mwh "
    "num:min_demand_mwh num:demand_stddev_mwh observation_count"
)
_PERFORMANCE = (
    "day:date respondent respondent_name num:mae_mwh num:rmse_mwh num:mape_pct "
    "num:forecast_bias_mwh num:max_abs_error_mwh observation_count"
)
_BALANCE = (
    "ts:period respondent respondent_name num:demand_mwh num:net_generation_mwh "
    "num:total_interchange_mwh num:generation_minus_demand_mwh"
)
_SUMMARY = (
    "respondent respondent_name ts:latest_period num:latest_demand_mwh "
    "num:latest_forecast_demand_mwh num:latest_net_generation_mwh "
    "num:latest_total_interchange_mwh num:recent_forecast_mape_pct "
    "num:recent_forecast_bias_mwh"
)


def _rows(source: str, columns: str, tail: str = "") -> str:
    return f"{_EVENTS} SELECT {_select(columns)} FROM {source} {tail}"


def _volume(source: str, columns: str) -> str:
    return f"{_LINEITEM} SELECT {_select(columns, 4)} FROM {source}"


def _sample(keys: str, key: tuple[str, ...], limit: int = 5) -> str:
    """The first keys of a query, in key order, as text."""
    formats = {"period": _STAMP, "date": _DATE}
    parts = " || ' ' || ".join(f"coalesce({formats.get(c, '{0}').format(c)}, 'null')" for c in key)
    order = ", ".join(f"{c} NULLS FIRST" for c in key)
    return f"(SELECT string_agg({parts}, ', ' ORDER BY {order}) FROM (SELECT * FROM ({keys}) ORDER BY {order} LIMIT {limit}))"


def _report(
    table: str,
    key: tuple[str, ...],
    non_negative: tuple[str, ...] = (),
    ordered: tuple[tuple[str, str], ...] = (),
    warn_negative: tuple[str, ...] = (),
    source: str | None = None,
) -> str:
    source = source or table
    grouped = ", ".join(key)
    # Check, column, failing condition, column of the least value, severity.
    rows: list[tuple] = [("not_null", c, f"{c} IS NULL", None, "error") for c in key]
    rows.append(("unique", grouped, None, None, "error"))
    rows += [("non_negative", c, f"{c} < 0", c, "error") for c in non_negative]
    rows += [("ordered", f"{high}, {low}", f"{high} < {low}", None, "error") for high, low in ordered]
    rows += [("warn_negative", c, f"{c} < 0", c, "warning") for c in warn_negative]
    checks = []
    for position, (check, column, fails, lowest, severity) in enumerate(rows):
        repeated = f"SELECT {grouped}, count(*) AS n FROM {source} GROUP BY {grouped} HAVING count(*) > 1"
        if fails:
            failures = f"count(*) FILTER ({fails})"
            keys = f"SELECT DISTINCT {grouped} FROM {source} WHERE {fails}"
        else:
            failures = f"max((SELECT coalesce(sum(n), 0) FROM ({repeated})))"
            keys = f"SELECT {grouped} FROM ({repeated})"
        minimum = f"min({lowest})" if lowest else "CAST(NULL AS DOUBLE)"
        checks.append(
            f"SELECT '{table}' AS table_name, {position} AS position, "
            f"'{check}' AS check_name, '{column}' AS column_name, "
            f"CAST({failures} AS BIGINT) AS failures, {_rounded(minimum)} AS min_value, "
            f"'{severity}' AS severity, any_value({_sample(keys, key)}) AS sample FROM {source}"
        )
    return f"{_EVENTS} " + " UNION ALL ".join(checks)


_HOURLY_KEY = ("period", "respondent")

_CONFLICTS = """
, renamed AS (
  SELECT period, respondent,
         CASE WHEN hour(period) % 2 = 0 THEN upper(respondent_name)
              ELSE respondent_name END AS respondent_name
  FROM silver_generation),
conflicts AS (
  SELECT DISTINCT 'generation' AS side, respondent, d.respondent_name AS demand_name,
         o.respondent_name AS other_name
  FROM silver_demand d JOIN renamed o USING (period, respondent)
  WHERE d.respondent_name <> o.respondent_name
  UNION ALL
  SELECT DISTINCT 'interchange', respondent, d.respondent_name, o.respondent_name
  FROM silver_demand d JOIN silver_interchange o USING (period, respondent)
  WHERE d.respondent_name <> o.respondent_name)
"""

_EXPORTS = (
    ("regional_summary", "gold_regional_summary", "gold_regional_summary", None),
    ("demand_daily", "gold_demand_daily", "gold_demand_daily", "date"),
    ("demand_hourly", "silver_demand", "silver_demand", "period"),
    (
        "forecast_performance",
        "gold_forecast_performance_daily",
        "gold_forecast_performance",
        "date",
    ),
    ("grid_balance", "gold_grid_balance_hourly", "gold_grid_balance", "period"),
)


def _export_meta() -> str:
    parts = []
    for name, table, source, window in _EXPORTS:
        where = f"WHERE {window} >= DATE '2024-01-18'" if window else ""
        days = "14" if window else "NULL"
        parts.append(
            f"SELECT '{name}' AS dataset, 'gold_export' AS source, "
            f"'{table}' AS \"table\", '2024-02-01T00:00:00Z' AS generated_at, "
            f"CAST({days} AS INTEGER) AS window_days, count(*) AS row_count "
            f"FROM {source} {where}"
        )
    return f"{_EVENTS} " + " UNION ALL ".join(parts)


# What a region that stops early leaves, with a grid for each backfill window.
_RAGGED = """
, ragged AS (
  SELECT *, CAST(floor((epoch(period) - (SELECT epoch(first_hour) FROM bounds)) / (169 * 3600)) AS INTEGER) AS win
  FROM demand_rows WHERE respondent <> 'R3' OR period < TIMESTAMP '2024-01-12 07:00:00'),
ragged_demand AS (
  SELECT period, respondent, p.respondent_name, p.demand_mwh, p.forecast_demand_mwh,
         p.demand_mwh - p.forecast_demand_mwh AS forecast_error_mwh,
         CASE WHEN p.demand_mwh > 0
              THEN (p.demand_mwh - p.forecast_demand_mwh) / p.demand_mwh * 100 END
           AS forecast_error_pct
  FROM (SELECT DISTINCT win, period FROM ragged)
  JOIN (SELECT DISTINCT win, respondent FROM ragged) USING (win)
  LEFT JOIN (SELECT * FROM sparse_pivot JOIN
               (SELECT DISTINCT period, respondent FROM ragged) USING (period, respondent)) p
    USING (period, respondent))
"""

# Tables rebuilt from the last reading per key, with a grid for each date.
_STREAMED = """
, landed AS (
  SELECT CAST(period AS DATE) AS day, period, respondent,
         max(respondent_name) FILTER (type IN ('D', 'DF')) AS demand_name,
         max(value) FILTER (type = 'D') AS demand_mwh,
         max(value) FILTER (type = 'DF') AS forecast_demand_mwh,
         max(respondent_name) FILTER (type = 'NG') AS generation_name,
         max(value) FILTER (type = 'NG') AS net_generation_mwh,
         max(respondent_name) FILTER (type = 'TI') AS interchange_name,
         max(value) FILTER (type = 'TI') AS total_interchange_mwh,
         bool_or(type IN ('D', 'DF')) AS has_demand
  FROM bronze WHERE type <> 'XX' GROUP BY ALL),
day_grid AS (
  SELECT day, period, respondent
  FROM (SELECT DISTINCT day, period FROM landed WHERE has_demand)
  JOIN (SELECT DISTINCT day, respondent FROM landed WHERE has_demand) USING (day)),
dense AS (
  SELECT coalesce(l.day, g.day) AS day, period, respondent, demand_mwh,
         forecast_demand_mwh, net_generation_mwh, total_interchange_mwh,
         coalesce(demand_name, generation_name, interchange_name) AS respondent_name,
         g.period IS NOT NULL AS in_demand
  FROM landed l FULL JOIN day_grid g USING (period, respondent)),
day_performance AS (
  SELECT day, respondent, count(demand_mwh - forecast_demand_mwh) AS n,
         avg(demand_mwh - forecast_demand_mwh) AS bias,
         100 * avg(CASE WHEN demand_mwh <> 0
                        THEN abs(demand_mwh - forecast_demand_mwh) / abs(demand_mwh) END) AS mape
  FROM dense WHERE in_demand GROUP BY day, respondent),
day_kpis AS (
  SELECT respondent,
         sum(mape * n) FILTER (mape IS NOT NULL AND n > 0)
           / nullif(sum(n) FILTER (mape IS NOT NULL AND n > 0), 0) AS recent_forecast_mape_pct,
         sum(bias * n) FILTER (bias IS NOT NULL AND n > 0)
           / nullif(sum(n) FILTER (bias IS NOT NULL AND n > 0), 0) AS recent_forecast_bias_mwh
  FROM day_performance
  WHERE day >= (SELECT max(day) FROM day_performance) - 6 GROUP BY respondent),
streamed AS (
  SELECT respondent, respondent_name, period AS latest_period,
         demand_mwh AS latest_demand_mwh, forecast_demand_mwh AS latest_forecast_demand_mwh,
         net_generation_mwh AS latest_net_generation_mwh,
         total_interchange_mwh AS latest_total_interchange_mwh,
         recent_forecast_mape_pct, recent_forecast_bias_mwh
  FROM (SELECT * FROM dense
        QUALIFY row_number() OVER (PARTITION BY respondent ORDER BY period DESC) = 1)
  LEFT JOIN day_kpis USING (respondent))
"""

_TABLE_NAMES = (
    "silver_demand",
    "silver_generation",
    "silver_interchange",
    "gold_demand_daily",
    "gold_forecast_performance_daily",
    "gold_grid_balance_hourly",
    "gold_regional_summary",
)


def oracle_sql() -> dict[str, str]:
    return {
        "stored_ragged_backfill": f"{_EVENTS} {_RAGGED} SELECT {_select(_DEMAND)} FROM ragged_demand",
        "refused_run": f"{_EVENTS} "
        + " UNION ALL ".join(
            f"""SELECT '{name}' AS table_name, CAST(0 AS BIGINT) AS stored, true AS refused,
                   (SELECT count(*) FROM readings WHERE type NOT IN ('NG', 'TI'))
                   + (SELECT count(*) FROM bronze WHERE type IN ('NG', 'TI')) AS offered"""
            for name in ("bronze_readings", *_TABLE_NAMES)
        ),
        "landed_pages": _rows("bronze", "ts:period respondent respondent_name type num:value"),
        "streamed_summary": f"{_EVENTS} {_STREAMED} SELECT {_select(_SUMMARY)} FROM streamed",
        "pruned_window_read": f"""{_EVENTS}
            SELECT {_select("ts:period respondent")}, respondent_name || ' {{old}} {{new}} "\\" }}{{ ' AS respondent_name,
                   type, {_rounded("value")} AS value
            FROM bronze b WHERE b.period BETWEEN TIMESTAMP '2024-01-10 12:00:00' AND TIMESTAMP '2024-01-16 00:00:00'""",
        "export_json": _rows("gold_demand_daily", _DAILY, "WHERE gold_demand_daily.date >= DATE '2024-01-18'"),
        "export_json_regional_summary": _rows("gold_regional_summary", _SUMMARY),
        "export_json_demand_hourly": _rows(
            "silver_demand",
            "ts:period respondent num:demand_mwh num:forecast_demand_mwh",
            "WHERE silver_demand.period >= TIMESTAMP '2024-01-18 00:00:00'",
        ),
        "export_json_forecast_performance": _rows(
            "gold_forecast_performance", _PERFORMANCE, "WHERE gold_forecast_performance.date >= DATE '2024-01-18'"
        ),
        "export_json_grid_balance": _rows(
            "gold_grid_balance",
            "ts:period respondent num:demand_mwh num:net_generation_mwh num:total_interchange_mwh "
            "num:generation_minus_demand_mwh",
            "WHERE gold_grid_balance.period >= TIMESTAMP '2024-01-18 00:00:00'",
        ),
        "contract_breaks": f"""{_EVENTS}
            SELECT 'readings' AS table_name, t.name AS column_name, t.problem,
                   (SELECT count(*) FROM readings) AS row_count
            FROM (VALUES ('type_name', 'lacking'), ('value_units', 'lacking'),
                         ('ordinal', 'not agreed')) t(name, problem)
            UNION ALL
            SELECT 'untyped_readings', t.name, t.problem,
                   (SELECT count(*) FROM readings WHERE value IS NOT NULL)
            FROM (VALUES ('type', 'lacking'), ('ordinal', 'not agreed'),
                         ('respondent_name', 'not agreed')) t(name, problem)""",
        "unnamed_demand": f"""{_EVENTS}
            SELECT {_select("ts:period respondent")}, CAST(NULL AS VARCHAR) AS respondent_name,
                   {_select("num:demand_mwh num:forecast_demand_mwh num:forecast_error_mwh num:forecast_error_pct")}
            FROM silver_demand""",
        "empty_input": f"{_EVENTS} "
        + " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM readings WHERE value > 1e300"
            for name in _TABLE_NAMES
        ),
        "demand_in_order": _rows("silver_demand", _DEMAND, "ORDER BY silver_demand.period, respondent"),
        "normalize_readings": _rows(
            "readings", "ordinal ts:period respondent respondent_name type num:value"
        ),
        "bronze_upsert": _rows(
            "bronze", "ts:period respondent respondent_name type num:value"
        ),
        "upsert_merge": f"""{_EVENTS},
            incoming AS (
              SELECT period, respondent, respondent_name, type, value * 2 AS value
              FROM bronze WHERE period >= TIMESTAMP '2024-01-14 00:00:00'),
            merged AS (
              SELECT * FROM incoming
              UNION ALL
              SELECT period, respondent, respondent_name, type, value FROM bronze b
              WHERE period < TIMESTAMP '2024-01-16 00:00:00' AND NOT EXISTS (
                SELECT 1 FROM incoming i WHERE i.period = b.period
                AND i.respondent = b.respondent AND i.type = b.type))
            SELECT {_select("ts:period respondent respondent_name type num:value")}
            FROM merged""",
        "silver_demand": _rows("silver_demand", _DEMAND),
        "silver_demand_sparse": f"""{_EVENTS}
            SELECT {_select(_DEMAND)} FROM (
              SELECT *, demand_mwh - forecast_demand_mwh AS forecast_error_mwh,
                CASE WHEN demand_mwh > 0
                     THEN (demand_mwh - forecast_demand_mwh) / demand_mwh * 100 END
                  AS forecast_error_pct
              FROM sparse_pivot)""",
        "silver_generation": _rows(
            "silver_generation",
            "ts:period respondent respondent_name num:net_generation_mwh",
        ),
        "silver_interchange": _rows(
            "silver_interchange",
            "ts:period respondent respondent_name num:total_interchange_mwh",
        ),
        "silver_range_read": _rows(
            "silver_demand",
            _DEMAND,
            "WHERE silver_demand.period >= TIMESTAMP '2024-01-10 12:00:00' "
            "AND silver_demand.period < TIMESTAMP '2024-01-16 00:00:00'",
        ),
        "gold_demand_daily": _rows("gold_demand_daily", _DAILY),
        "gold_forecast_performance": _rows("gold_forecast_performance", _PERFORMANCE),
        "gold_grid_balance": _rows("gold_grid_balance", _BALANCE),
        "gold_regional_summary": _rows("gold_regional_summary", _SUMMARY),
        "recent_forecast_kpis": _rows(
            "kpis", "respondent num:recent_forecast_mape_pct num:recent_forecast_bias_mwh"
        ),
        "latest_row_per_region": f"""{_EVENTS}
            SELECT respondent, {_STAMP.format("period")} AS latest_period,
                   respondent_name, {_rounded("demand_mwh")} AS latest_demand_mwh,
                   {_rounded("net_generation_mwh")} AS latest_net_generation_mwh,
                   {_rounded("total_interchange_mwh")} AS latest_total_interchange_mwh
            FROM latest""",
        "checkpoint": f"""{_EVENTS}
            SELECT {_STAMP.format("max(period)")} AS latest_period FROM readings""",
        "ingestion_window": f"""{_EVENTS}, w AS (
              SELECT date_trunc('hour', max(period) - INTERVAL 48 HOUR) AS s FROM readings)
            SELECT {_HOUR.format("s")} AS window_start,
                   CASE WHEN s + INTERVAL 168 HOUR < TIMESTAMP '2024-02-10 00:00:00'
                        THEN {_HOUR.format("s + INTERVAL 168 HOUR")} END AS window_end
            FROM w""",
        "backfill_windows": f"""{_EVENTS}
            SELECT chunk, {_HOUR.format("start_hour")} AS start,
                   {_HOUR.format("end_hour")} AS "end" FROM chunks""",
        "backfill_window_counts": f"""{_EVENTS}
            SELECT chunk, {_HOUR.format("start_hour")} AS start,
                   {_HOUR.format("end_hour")} AS "end", count(r.period) AS readings
            FROM chunks LEFT JOIN readings r
              ON r.period BETWEEN start_hour AND end_hour
            GROUP BY chunk, start_hour, end_hour""",
        "first_day_completion": _rows(
            "silver_demand",
            _DEMAND,
            "WHERE silver_demand.period >= TIMESTAMP '2024-01-10 00:00:00'",
        ),
        "recent_performance_read": f"""{_EVENTS}
            SELECT {_select("day:date respondent respondent_name num:mape_pct "
                            "num:forecast_bias_mwh observation_count")}
            FROM gold_forecast_performance p
            WHERE p.date >= (SELECT max(date) FROM gold_forecast_performance) - 6""",
        "stored_forecast_performance": _rows("gold_forecast_performance", _PERFORMANCE),
        "stored_regional_summary": _rows("gold_regional_summary", _SUMMARY),
        "dq_demand": _report(
            "silver_demand", _HOURLY_KEY, warn_negative=("demand_mwh",)
        ),
        "dq_generation": f"""{_EVENTS}, raw_generation AS (
              SELECT period, respondent FROM readings WHERE type = 'NG')
            """
        + _report("silver_generation", _HOURLY_KEY, source="raw_generation").removeprefix(
            _EVENTS
        ),
        "dq_gold_daily": _report(
            "gold_demand_daily",
            ("date", "respondent"),
            non_negative=("demand_stddev_mwh", "observation_count"),
            ordered=(("peak_demand_mwh", "min_demand_mwh"),),
        ),
        "dq_gold_performance": _report(
            "gold_forecast_performance_daily",
            ("date", "respondent"),
            non_negative=(
                "mae_mwh",
                "rmse_mwh",
                "mape_pct",
                "max_abs_error_mwh",
                "observation_count",
            ),
            source="gold_forecast_performance",
        ),
        "dq_gold_balance": _report(
            "gold_grid_balance_hourly", _HOURLY_KEY, source="gold_grid_balance"
        ),
        "dq_gold_summary": _report(
            "gold_regional_summary",
            ("respondent",),
            non_negative=("recent_forecast_mape_pct",),
        ),
        "dq_duplicate_grain": f"""{_EVENTS}
            SELECT {_STAMP.format("period")} AS period, respondent,
                   {_rounded("value")} AS net_generation_mwh
            FROM readings WHERE type = 'NG'
            QUALIFY count(*) OVER (PARTITION BY period, respondent) > 1""",
        "name_conflicts": f"{_EVENTS} {_CONFLICTS} SELECT * FROM conflicts",
        "name_conflict_counts": f"""{_EVENTS} {_CONFLICTS}
            SELECT side, count(*) AS conflicting_respondents,
                   string_agg(respondent || ': ' || names.demand_name || ' / ' || names.other_name, ', '
                              ORDER BY respondent) FILTER (place <= 3) AS sample
            FROM (SELECT *, row_number() OVER (PARTITION BY side ORDER BY respondent) AS place
                  FROM (SELECT side, respondent, min({{demand_name: demand_name, other_name: other_name}}) AS names
                        FROM conflicts GROUP BY ALL))
            GROUP BY side""",
        "top_peak_days": f"""{_EVENTS}
            SELECT {_select("day:date respondent respondent_name num:peak_demand_mwh")}
            FROM (SELECT * FROM gold_demand_daily
                  ORDER BY peak_demand_mwh DESC NULLS FIRST, date, respondent LIMIT 20)""",
        "forecast_accuracy": f"""{_EVENTS}
            SELECT respondent,
                   {_rounded("sum(mape_pct * observation_count) "
                             "/ nullif(sum(observation_count), 0)")} AS avg_mape_pct,
                   CAST(sum(observation_count) AS BIGINT) AS observations
            FROM gold_forecast_performance WHERE mape_pct IS NOT NULL
            GROUP BY respondent ORDER BY avg_mape_pct ASC NULLS LAST, respondent""",
        "forecast_bias": f"""{_EVENTS}
            SELECT respondent, {_rounded("avg(forecast_bias_mwh)")} AS avg_bias_mwh
            FROM gold_forecast_performance GROUP BY respondent
            ORDER BY avg_bias_mwh DESC NULLS FIRST, respondent""",
        "recent_balance": f"""{_EVENTS}
            SELECT {_select("ts:period respondent num:demand_mwh num:net_generation_mwh "
                            "num:generation_minus_demand_mwh")}
            FROM (SELECT * FROM gold_grid_balance
                  ORDER BY period DESC NULLS FIRST, respondent LIMIT 100)""",
        "summary_by_demand": f"""{_EVENTS}
            SELECT {_select(_SUMMARY)} FROM gold_regional_summary s
            ORDER BY s.latest_demand_mwh DESC NULLS LAST, s.respondent""",
        "grain_checks": f"""{_EVENTS}
            SELECT {_STAMP.format("period")} AS period, respondent, type,
                   count(*) AS row_count
            FROM readings r GROUP BY r.period, respondent, type HAVING count(*) > 1""",
        "coverage_check": f"""{_EVENTS}
            SELECT {_DATE.format("CAST(period AS DATE)")} AS date, respondent,
                   count(value) AS observation_count
            FROM readings GROUP BY CAST(period AS DATE), respondent
            HAVING count(value) > 24""",
        "export_demand_daily": _rows(
            "gold_demand_daily",
            _DAILY,
            "WHERE gold_demand_daily.date >= DATE '2024-01-18'",
        ),
        "export_meta": _export_meta(),
        "lineitem_demand_daily": _volume("gold_demand_daily", _DAILY),
        "lineitem_forecast_performance": _volume(
            "gold_forecast_performance", _PERFORMANCE
        ),
        "lineitem_grid_balance": _volume("sparse_balance", _BALANCE),
        "lineitem_regional_summary": _volume("gold_regional_summary", _SUMMARY),
    }
