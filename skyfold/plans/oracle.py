"""Independent DuckDB statements of every registered query (the oracle).

The flight columns are computed straight from ``events`` with the fixture
rule (no JSON step), so the Spark path (JSON → VARIANT → flatten) is checked
against an independent derivation. Percentages use the same integer
half-up rule as the library (H6); counts are cast to BIGINT and calendar
parts to INTEGER to match Spark's types.
"""

from __future__ import annotations

SENTINEL = "'_dbt_utils_surrogate_key_null_'"


def _pct(n: str, d: str) -> str:
    return f"CAST((20000 * ({n}) + NULLIF({d}, 0)) // (2 * NULLIF({d}, 0)) AS DOUBLE) / 100.0"


EVENTS_CTE = """
ev AS (
  SELECT event_id AS n, user_id AS u, ts, event_type, value,
         CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS BIGINT) AS k,
         CAST(ts AS DATE) AS ts_date
  FROM events
),
ev1 AS (
  SELECT *,
    CASE WHEN n % 2 = 0 THEN 'DEPARTURE' ELSE 'ARRIVAL' END AS direction,
    'A' || CAST(u % 6 AS VARCHAR) AS op,
    ((n // 2) % 4 = 3) AS marketing,
    'P' || CAST(u % 12 AS VARCHAR) AS other,
    ts_date - CAST(CASE WHEN n % 50 = 0 THEN 6 ELSE n % 3 END AS INTEGER) AS flight_date,
    CASE WHEN n % 223 = 0 THEN NULL WHEN n % 211 = 0 THEN 'Cancelled'
         ELSE CASE event_type WHEN 'signup' THEN 'scheduled' WHEN 'purchase' THEN 'landed'
              WHEN 'error' THEN 'cancelled' WHEN 'view' THEN 'active' WHEN 'click' THEN 'diverted' END
    END AS flight_status
  FROM ev
),
ev2 AS (
  SELECT *,
    CASE WHEN n % 401 = 0 THEN NULL ELSE op || CAST(100 + u % 60 AS VARCHAR) END AS opf,
    CASE WHEN marketing THEN 'M' || CAST(u % 3 AS VARCHAR) WHEN n % 97 = 0 THEN NULL ELSE op END AS airline_code,
    CASE WHEN n % 17 = 0 THEN NULL
         WHEN other = 'P3' AND ts_date >= DATE '2024-01-16' THEN 'Port P3 Renamed'
         ELSE 'Port ' || other END AS other_name,
    CAST(flight_date AS TIMESTAMP) + to_minutes(CAST(hour(ts) * 60 + minute(ts) AS BIGINT)) AS sched_dep,
    CAST(floor(value) AS BIGINT) - 5 AS base_delay
  FROM ev1
),
stg AS (
  SELECT
    md5(concat_ws('-', coalesce(CAST(flight_date AS VARCHAR), {s}),
                       coalesce(CASE WHEN marketing THEN coalesce(opf, 'M' || CAST(u % 3 AS VARCHAR) || CAST(900 + u % 60 AS VARCHAR)) ELSE opf END, {s}),
                       coalesce(direction, {s}))) AS flight_id,
    ts AS extracted_at, direction, 'HUB' AS target_airport,
    flight_date, flight_status,
    CASE WHEN marketing THEN 'M' || CAST(u % 3 AS VARCHAR) || CAST(900 + u % 60 AS VARCHAR) ELSE opf END AS flight_iata,
    CAST(NULL AS VARCHAR) AS flight_icao, CAST(NULL AS VARCHAR) AS flight_number,
    CASE WHEN direction = 'DEPARTURE' THEN 'HUB' ELSE other END AS dep_iata,
    CAST(NULL AS VARCHAR) AS dep_icao,
    CASE WHEN direction = 'DEPARTURE' THEN 'Port HUB' ELSE other_name END AS dep_airport_name,
    sched_dep,
    CASE WHEN flight_status IN ('landed', 'active', 'diverted') THEN sched_dep + to_minutes(base_delay) END AS actual_dep,
    CAST(NULL AS VARCHAR) AS terminal_dep,
    CASE WHEN n % 4 = 0 THEN NULL ELSE 'G' || CAST(k % 11 + 1 AS VARCHAR) END AS gate_dep,
    CAST(NULL AS VARCHAR) AS dep_timezone,
    CASE WHEN direction = 'DEPARTURE' THEN other ELSE 'HUB' END AS arr_iata,
    CAST(NULL AS VARCHAR) AS arr_icao,
    CASE WHEN direction = 'DEPARTURE' THEN other_name ELSE 'Port HUB' END AS arr_airport_name,
    sched_dep + to_minutes(60 + k) AS sched_arr,
    CASE WHEN flight_status IN ('landed', 'diverted') THEN sched_dep + to_minutes(60 + k + base_delay + n % 7 - 3) END AS actual_arr,
    CAST(NULL AS VARCHAR) AS terminal_arr,
    CASE WHEN n % 3 = 0 THEN NULL ELSE 'G' || CAST(n % 11 + 1 AS VARCHAR) END AS gate_arr,
    CASE WHEN n % 3 = 1 THEN NULL ELSE 'B' || CAST(k % 4 AS VARCHAR) END AS baggage,
    CAST(NULL AS VARCHAR) AS arr_timezone,
    airline_code AS airline_iata,
    CASE WHEN n % 13 = 0 OR airline_code IS NULL THEN NULL ELSE 'X' || airline_code END AS airline_icao,
    CASE WHEN n % 11 = 0 OR airline_code IS NULL THEN NULL
         WHEN airline_code = 'A1' AND ts_date >= DATE '2024-01-16' THEN 'Airline A1 Renamed'
         ELSE 'Airline ' || airline_code END AS airline_name,
    CAST(NULL AS VARCHAR) AS aircraft_icao24,
    CASE WHEN flight_status IN ('landed', 'active', 'diverted') THEN base_delay END AS delay_dep,
    CASE WHEN flight_status IN ('landed', 'diverted') THEN base_delay + n % 7 - 3 END AS delay_arr,
    CASE WHEN marketing THEN 'marketing' ELSE 'operating' END AS carrier_role,
    CASE WHEN marketing THEN op ELSE airline_code END AS operating_airline_iata,
    CASE WHEN marketing THEN coalesce(opf, 'M' || CAST(u % 3 AS VARCHAR) || CAST(900 + u % 60 AS VARCHAR)) ELSE opf END AS operating_flight_iata
  FROM ev2
)""".replace("{s}", SENTINEL)

STG_COLUMNS = """flight_id, extracted_at, direction, target_airport, flight_date, flight_status, flight_iata,
  flight_icao, flight_number, dep_iata, dep_icao, dep_airport_name, sched_dep, actual_dep, terminal_dep, gate_dep,
  dep_timezone, arr_iata, arr_icao, arr_airport_name, sched_arr, actual_arr, terminal_arr, gate_arr, baggage,
  arr_timezone, airline_iata, airline_icao, airline_name, aircraft_icao24, delay_dep, delay_arr, carrier_role,
  operating_airline_iata, operating_flight_iata"""


def dates_cte(start: str = "2024-01-01", end: str = "2030-12-31", name: str = "dates") -> str:
    return f"""
{name} AS (
  SELECT CAST(d AS DATE) AS date_id, CAST(d AS DATE) AS date_day,
    CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
    CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
    strftime(d, '%B') AS month_name, strftime(d, '%A') AS day_name,
    dayofweek(d) IN (0, 6) AS is_weekend, strftime(d, '%Y-%m') AS year_month
  FROM range(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL 1 DAY) t(d)
)"""


#: The calendar's span; a day outside it has no calendar columns.
FIRST_DAY, LAST_DAY = "2024-01-01", "2030-12-30"


def _best(parts: dict[str, str]) -> str:
    """The greatest of a group's rows, compared part by part (no part is NULL)."""
    return "max({" + ", ".join(f"'{k}': {v}" for k, v in parts.items()) + "})"


def airlines_cte(src: str = "stg", name: str = "airlines", as_of: str | None = None) -> str:
    cut = f" AND extracted_at <= TIMESTAMP '{as_of}'" if as_of else ""
    best = _best({
        "named": "airline_name IS NOT NULL", "coded": "airline_icao IS NOT NULL", "seen": "extracted_at",
        "title": "coalesce(airline_name, '')", "code": "coalesce(airline_icao, '')",
    })
    return f"""
{name} AS (
  SELECT airline_iata, if(b.named, b.title, NULL) AS airline_name, if(b.coded, b.code, NULL) AS airline_icao
  FROM (SELECT airline_iata, {best} AS b FROM {src} WHERE airline_iata IS NOT NULL{cut} GROUP BY airline_iata)
)"""


def airports_cte(src: str = "stg", name: str = "airports", as_of: str | None = None) -> str:
    cut = f" WHERE extracted_at <= TIMESTAMP '{as_of}'" if as_of else ""
    best = _best({"named": "port.title IS NOT NULL", "seen": "extracted_at", "title": "coalesce(port.title, '')"})
    return f"""
{name} AS (
  SELECT airport_iata, if(b.named, b.title, NULL) AS airport_name
  FROM (
    SELECT port.code AS airport_iata, {best} AS b
    FROM (SELECT extracted_at,
            unnest([{{'code': dep_iata, 'title': dep_airport_name}}, {{'code': arr_iata, 'title': arr_airport_name}}]) AS port
          FROM {src}{cut})
    WHERE port.code IS NOT NULL GROUP BY port.code)
)"""


#: Delay classes (label, above, up to and including, on time); a completed flight without a delay is in the last.
BUCKETS_CTE = """
buckets(label, above, upto, punctual) AS (
  VALUES ('On Time', -1000000000, 15, TRUE), ('15-30 min', 15, 30, FALSE), ('30-60 min', 30, 60, FALSE), ('60+ min', 60, 1000000000, FALSE)
)"""


def _calendar(day: str, prefix: str) -> str:
    """Calendar columns of a day, from the day itself."""
    within = f"if({day} BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}', {day}, NULL)"
    return f"""CAST(year({within}) AS INTEGER) AS {prefix}_year, CAST(month({within}) AS INTEGER) AS {prefix}_month,
    strftime({within}, '%A') AS {prefix}_day_name, isodow({within}) > 5 AS {prefix}_is_weekend"""


def _late(end: str) -> str:
    """Range join of a flight's delay at one end with its class."""
    delay = f"coalesce(f.delay_{end}, 999999999)"
    return f"LEFT JOIN buckets late_{end} ON f.actual_{end} IS NOT NULL AND {delay} > late_{end}.above AND {delay} <= late_{end}.upto"


#: Statuses of a cancelled flight.
CANCELLED = "'cancelled', 'canceled'"


def enriched_cte(src: str = "stg", airlines: str = "airlines", airports: str = "airports", name: str = "enriched") -> str:
    def port(code: str) -> str:
        return f"(SELECT p.airport_name FROM {airports} p WHERE p.airport_iata = f.{code})"

    def carrier(col: str) -> str:
        return f"(SELECT c.{col} FROM {airlines} c WHERE c.airline_iata = f.airline_iata)"

    return f"""
{name} AS (
  SELECT f.*,
    {carrier("airline_name")} AS dim_airline_name, {carrier("airline_icao")} AS dim_airline_icao,
    {port("dep_iata")} AS dim_dep_airport_name, {port("arr_iata")} AS dim_arr_airport_name,
    {_calendar("f.flight_date", "sched")},
    {_calendar("f.actual_operation_date", "actual")},
    late_dep.punctual AS is_on_time_dep, late_arr.punctual AS is_on_time_arr,
    late_dep.label AS delay_bucket_dep, late_arr.label AS delay_bucket_arr,
    coalesce(lower(f.flight_status) IN ({CANCELLED}), FALSE) AS is_cancelled
  FROM (SELECT *, CAST(ifnull(actual_dep, actual_arr) AS DATE) AS actual_operation_date FROM {src}) f
  {_late("dep")}
  {_late("arr")}
)"""


FCT_COLUMNS = """flight_id, flight_date, direction, flight_status, dep_iata, dep_airport_name, arr_iata, arr_airport_name,
  airline_iata, airline_name, airline_icao, flight_iata, operating_airline_iata, operating_flight_iata,
  sched_dep, sched_arr, actual_dep, actual_arr, delay_dep, delay_arr, gate_dep, gate_arr, baggage,
  terminal_dep, terminal_arr, aircraft_icao24, extracted_at, target_airport,
  dim_airline_name, dim_airline_icao, dim_dep_airport_name, dim_arr_airport_name,
  sched_year, sched_month, sched_day_name, sched_is_weekend,
  actual_operation_date, is_on_time_dep, is_on_time_arr, delay_bucket_dep, delay_bucket_arr, is_cancelled,
  actual_year, actual_month, actual_day_name, actual_is_weekend"""


#: Which of several records of a flight in one extract counts.
LATEST_TIES = """flight_status actual_arr actual_dep delay_dep delay_arr sched_dep sched_arr gate_dep gate_arr baggage terminal_dep terminal_arr
  airline_iata airline_name airline_icao flight_iata operating_airline_iata operating_flight_iata
  dep_iata dep_airport_name arr_iata arr_airport_name aircraft_icao24 target_airport""".split()


def fact_cte(src: str = "enriched", name: str = "fact", extra_where: str = "") -> str:
    return f"""
{name} AS (
  SELECT {FCT_COLUMNS} FROM {src}
  WHERE carrier_role = 'operating'{extra_where}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY flight_id ORDER BY extracted_at DESC,
    {", ".join(f"{c} DESC NULLS LAST" for c in LATEST_TIES)}) = 1
)"""


def model_with() -> str:
    return "WITH " + ",".join(
        [EVENTS_CTE, dates_cte(), BUCKETS_CTE, airlines_cte(), airports_cte(), enriched_cte(), fact_cte()]
    )


def kpi_select(keys: str) -> str:
    dep, arr = "direction = 'DEPARTURE'", "direction = 'ARRIVAL'"
    nc = f"flight_status NOT IN ({CANCELLED})"
    ci = lambda p: f"CAST(COUNT(*) FILTER (WHERE {p}) AS BIGINT)"
    return f"""SELECT {keys},
    CAST(COUNT(*) AS BIGINT) AS total_scheduled,
    {ci(nc)} AS total_actual,
    {ci(dep)} AS scheduled_dep,
    {ci(arr)} AS scheduled_arr,
    {ci(f"{dep} AND {nc}")} AS actual_dep,
    {ci(f"{arr} AND {nc}")} AS actual_arr,
    {ci(f"{dep} AND is_on_time_dep = TRUE")} AS on_time_dep,
    {ci(f"{arr} AND is_on_time_arr = TRUE")} AS on_time_arr,
    {ci("is_cancelled = TRUE")} AS cancelled_count,
    {_pct(ci(f"{dep} AND is_on_time_dep = TRUE"), ci(f"{dep} AND actual_dep IS NOT NULL"))} AS dep_otp_pct,
    {_pct(ci(f"{arr} AND is_on_time_arr = TRUE"), ci(f"{arr} AND actual_arr IS NOT NULL"))} AS arr_otp_pct,
    {_pct(ci("is_cancelled = TRUE"), "CAST(COUNT(*) AS BIGINT)")} AS cancellation_rate_pct"""


def tiles_select(keys: str = "") -> str:
    dep, arr = "direction = 'DEPARTURE'", "direction = 'ARRIVAL'"
    nc = f"flight_status NOT IN ({CANCELLED})"
    ci = lambda p: f"CAST(COUNT(*) FILTER (WHERE {p}) AS BIGINT)"
    lead = f"{keys}, " if keys else ""
    return f"""SELECT {lead}CAST(COUNT(*) AS BIGINT) AS total_scheduled,
    {ci(nc)} AS total_actual,
    {_pct(ci(f"{dep} AND is_on_time_dep = TRUE"), ci(f"{dep} AND actual_dep IS NOT NULL"))} AS dep_otp_pct,
    {_pct(ci(f"{arr} AND is_on_time_arr = TRUE"), ci(f"{arr} AND actual_arr IS NOT NULL"))} AS arr_otp_pct,
    {_pct(ci("is_cancelled = TRUE"), "CAST(COUNT(*) AS BIGINT)")} AS cancellation_rate_pct"""


def gates_cte(name: str = "gus") -> str:
    """Uses of a gate at either end of operating flights, per gate and airline."""
    return f"""
{name} AS (
  SELECT used.gate, operating_airline_iata AS airline_iata, dim_airline_name AS airline_name,
    CAST(sum(used.leaving) AS BIGINT) AS departure_count, CAST(sum(1 - used.leaving) AS BIGINT) AS arrival_count,
    CAST(count(*) AS BIGINT) AS total_flight_count
  FROM (SELECT operating_airline_iata, dim_airline_name,
          unnest([{{'gate': gate_dep, 'leaving': 1}}, {{'gate': gate_arr, 'leaving': 0}}]) AS used
        FROM enriched WHERE carrier_role = 'operating')
  WHERE used.gate IS NOT NULL GROUP BY ALL
)"""


def _m(body: str) -> str:
    return model_with() + "\n" + body


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    stg_only = "WITH " + EVENTS_CTE + "\n"
    q["stg_flights"] = stg_only + f"SELECT {STG_COLUMNS} FROM stg"
    q["surrogate_key_orders"] = f"""SELECT o_orderkey,
      md5(concat_ws('-', coalesce(CAST(o_orderkey AS VARCHAR), {SENTINEL}), coalesce(CAST(o_custkey AS VARCHAR), {SENTINEL}),
                         coalesce(CAST(o_orderdate AS VARCHAR), {SENTINEL}))) AS order_sk FROM orders"""
    q["dim_dates"] = (
        "WITH " + EVENTS_CTE + ",\n"
        + "bounds AS (SELECT min(flight_date) AS lo, max(flight_date) AS hi FROM stg),\n"
        + """span AS (SELECT CAST(d AS DATE) AS d FROM bounds, range(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d))
SELECT d AS date_id, d AS date_day,
    CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
    CAST(quarter(d) AS INTEGER) AS quarter, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
    CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
    strftime(d, '%B') AS month_name, strftime(d, '%A') AS day_name,
    dayofweek(d) IN (0, 6) AS is_weekend, strftime(d, '%Y-%m') AS year_month FROM span"""
    )
    q["dim_airlines_current"] = "WITH " + EVENTS_CTE + "," + airlines_cte() + "\nSELECT * FROM airlines"
    q["dim_airports_current"] = "WITH " + EVENTS_CTE + "," + airports_cte() + "\nSELECT * FROM airports"
    q["flights_enriched"] = _m("SELECT * FROM enriched")
    q["fct_flights"] = _m("SELECT * FROM fact")
    q["daily_airport_summary"] = _m(kpi_select("flight_date") + " FROM fact GROUP BY flight_date")
    q["daily_airport_operations"] = _m(
        kpi_select("actual_operation_date") + " FROM fact WHERE actual_operation_date IS NOT NULL GROUP BY actual_operation_date"
    )
    q["daily_airline_summary"] = _m(
        kpi_select("flight_date, airline_iata") + " FROM enriched WHERE airline_iata IS NOT NULL GROUP BY flight_date, airline_iata"
    )
    q["daily_airline_operations"] = _m(
        kpi_select("actual_operation_date, airline_iata")
        + " FROM enriched WHERE actual_operation_date IS NOT NULL AND airline_iata IS NOT NULL"
        + " GROUP BY actual_operation_date, airline_iata"
    )
    gate_usage = "," + gates_cte() + "\n"
    q["gate_usage_summary"] = model_with() + gate_usage + "SELECT * FROM gus"
    q["gate_share"] = model_with() + """, capacity AS (SELECT 11 AS gate_count),
used AS (SELECT flight_date, CAST(count(DISTINCT gate) AS BIGINT) AS gates_used
         FROM (SELECT flight_date, unnest([gate_dep, gate_arr]) AS gate FROM fact) WHERE gate IS NOT NULL GROUP BY flight_date)
SELECT flight_date, gates_used, CAST(c.gate_count AS BIGINT) AS gate_count,
  """ + _pct("gates_used", "CAST(c.gate_count AS BIGINT)") + """ AS pct_gates_used
FROM used, capacity c"""
    q["gate_share_weekly"] = model_with() + """, used AS (
  SELECT CAST(date_trunc('week', flight_date) AS DATE) AS week_start, unnest([gate_dep, gate_arr]) AS gate FROM fact),
shares AS (SELECT week_start, count(DISTINCT gate) AS gates_used FROM used WHERE gate IS NOT NULL GROUP BY week_start)
SELECT week_start, gates_used, CAST(11 AS BIGINT) AS gate_count, """ + _pct("gates_used", "CAST(11 AS BIGINT)") + """ AS pct_gates_used FROM shares"""
    q["top_gates"] = model_with() + gate_usage + """SELECT gate, CAST(SUM(total_flight_count) AS BIGINT) AS total_flights
FROM gus GROUP BY gate ORDER BY total_flights DESC, gate ASC LIMIT 5"""
    q["gate_heatmap"] = model_with() + gate_usage + """SELECT gate, airline_iata,
  CAST(SUM(total_flight_count) AS BIGINT) AS flights
FROM gus WHERE airline_iata IS NOT NULL GROUP BY ALL"""
    q["kpi_tiles"] = _m(tiles_select() + " FROM fact")
    q["kpi_tiles_airline"] = _m(tiles_select("airline_iata") + " FROM enriched WHERE airline_iata IS NOT NULL GROUP BY airline_iata")
    summary = ", summary AS (" + kpi_select("flight_date") + " FROM fact GROUP BY flight_date)\n"
    q["daily_volume"] = model_with() + summary + "SELECT flight_date, total_scheduled, total_actual FROM summary"
    q["otp_trend"] = model_with() + summary + """SELECT flight_date, 'dep' AS series, dep_otp_pct AS otp_pct FROM summary
UNION ALL SELECT flight_date, 'arr', arr_otp_pct FROM summary"""
    q["cancellation_trend"] = model_with() + summary + "SELECT flight_date, cancelled_count, cancellation_rate_pct FROM summary"
    q["airline_picklist"] = _m("SELECT DISTINCT airline_iata FROM enriched WHERE airline_iata IS NOT NULL")
    q["load_audit"] = stg_only + """SELECT CAST(extracted_at AS DATE) AS extract_date, direction, CAST(COUNT(*) AS BIGINT) AS record_count
FROM stg GROUP BY ALL"""
    q["load_audit_runs"] = stg_only + """SELECT extracted_at, direction, CAST(COUNT(*) AS BIGINT) AS record_count
FROM stg GROUP BY ALL ORDER BY extracted_at DESC"""
    raw_keys = """, rk AS (SELECT extracted_at, direction, strftime(flight_date, '%Y-%m-%d') AS flight_date, flight_iata, flight_status FROM stg)
"""
    q["duplicate_flights"] = stg_only[:-1] + raw_keys + """SELECT flight_date, flight_iata, direction, CAST(COUNT(*) AS BIGINT) AS frequency
FROM rk GROUP BY flight_date, flight_iata, direction HAVING COUNT(*) > 1 ORDER BY frequency DESC"""
    q["duplicate_detail"] = stg_only[:-1] + raw_keys + """SELECT * FROM rk
WHERE (flight_date, flight_iata, direction) IN (
  SELECT (flight_date, flight_iata, direction) FROM rk GROUP BY flight_date, flight_iata, direction HAVING COUNT(*) > 1)
ORDER BY extracted_at DESC"""
    q["load_audit_day"] = stg_only + """SELECT CAST(extracted_at AS DATE) AS extract_date, direction, count(*) AS record_count
FROM stg WHERE CAST(extracted_at AS DATE) = DATE '2024-01-17' GROUP BY ALL"""
    q["duplicate_flights_day"] = stg_only[:-1] + raw_keys + """SELECT flight_date, flight_iata, direction, count(*) AS frequency FROM rk
WHERE CAST(extracted_at AS DATE) = DATE '2024-01-17' GROUP BY ALL HAVING count(*) > 1"""
    q["duplicate_detail_flight"] = stg_only[:-1] + raw_keys + """SELECT * FROM rk WHERE flight_iata = 'A1101'
QUALIFY count(*) OVER (PARTITION BY flight_date, direction) > 1"""
    q["staging_freshness"] = stg_only + """SELECT max(extracted_at) AS latest, epoch(TIMESTAMP '2024-02-01' - max(extracted_at)) / 3600 AS age_hours,
  max(extracted_at) < TIMESTAMP '2024-01-31' AS stale FROM stg"""
    q["lineitem_sorted"] = """SELECT count(*) AS rows, min(l_shipdate) AS first_day, max(l_shipdate) AS last_day, CAST(0 AS BIGINT) AS overlaps FROM lineitem"""
    q["lineitem_latest"] = """SELECT * FROM lineitem
QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1"""
    q["lineitem_duplicates"] = """SELECT l_orderkey, l_linenumber, CAST(COUNT(*) AS BIGINT) AS frequency
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"""
    q["customer_geo"] = """SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name, r.r_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""
    q["orders_status_rollup"] = f"""SELECT o_orderstatus, CAST(COUNT(*) AS BIGINT) AS order_count,
  CAST(COUNT_IF(o_orderpriority = '1-URGENT') AS BIGINT) AS urgent_count,
  CAST(COUNT_IF(o_totalprice > 100000) AS BIGINT) AS large_count,
  {_pct("CAST(COUNT_IF(o_orderpriority = '1-URGENT') AS BIGINT)", "CAST(COUNT(*) AS BIGINT)")} AS urgent_pct
FROM orders GROUP BY o_orderstatus"""
    q.update(oracle_sql_incremental())
    return q


# -- incremental runs, snapshots, as-of, quality ---------------------------
BATCH1_BEFORE = "2024-01-20 00:00:00"
RUN1_AS_OF = "2024-01-19 23:59:59"
RUN2_AS_OF = "2024-01-30 23:59:59"
SNAP_A1, SNAP_A2 = "2024-01-15 23:59:59", "2024-01-30 23:59:59"
FCT_UPDATE = {
    "flight_status", "actual_dep", "actual_arr", "delay_dep", "delay_arr", "is_on_time_dep", "is_on_time_arr",
    "delay_bucket_dep", "delay_bucket_arr", "is_cancelled", "actual_operation_date", "actual_year",
    "actual_month", "actual_day_name", "actual_is_weekend",
}


def _fct_cols() -> list[str]:
    return [c.strip() for c in FCT_COLUMNS.replace("\n", " ").split(",") if c.strip()]


def two_runs_with(daily_extracts: bool = False) -> str:
    """``daily_extracts``: landing names give the day of an extract only."""
    events = EVENTS_CTE
    if daily_extracts:
        events = events.replace("ts AS extracted_at,", "CAST(date_trunc('day', ts) AS TIMESTAMP) AS extracted_at,")
    merged_cols = []
    for c in _fct_cols():
        if c == "flight_id":
            merged_cols.append("COALESCE(t.flight_id, s.flight_id) AS flight_id")
        elif c in FCT_UPDATE:
            merged_cols.append(f"CASE WHEN s.flight_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            merged_cols.append(f"CASE WHEN t.flight_id IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}")
    parts = [
        events,
        dates_cte(),
        BUCKETS_CTE,
        f"\nstg1 AS (SELECT * FROM stg WHERE extracted_at < TIMESTAMP '{BATCH1_BEFORE}')",
        airlines_cte("stg1", "airlines1", RUN1_AS_OF),
        airports_cte("stg1", "airports1", RUN1_AS_OF),
        enriched_cte("stg1", "airlines1", "airports1", "enriched1"),
        fact_cte("enriched1", "fact1"),
        airlines_cte("stg", "airlines2", RUN2_AS_OF),
        airports_cte("stg", "airports2", RUN2_AS_OF),
        enriched_cte("stg", "airlines2", "airports2", "enriched2"),
        fact_cte("enriched2", "src2", extra_where=" AND flight_date >= (SELECT max(flight_date) FROM fact1) - 3"),
        "\nmerged AS (SELECT " + ",\n  ".join(merged_cols)
        + "\n  FROM fact1 t FULL OUTER JOIN src2 s ON t.flight_id = s.flight_id)",
        "\nsummary1 AS (" + kpi_select("flight_date") + " FROM fact1 GROUP BY flight_date)",
        "\nbatch2 AS (" + kpi_select("flight_date")
        + " FROM merged WHERE flight_date >= (SELECT max(flight_date) FROM summary1) - 7 GROUP BY flight_date)",
    ]
    return "WITH " + ",".join(parts) + "\n"


def _scd_id(key: str, ts: str) -> str:
    return (f"md5(concat_ws('-', coalesce(CAST({key} AS VARCHAR), {SENTINEL}), "
            f"coalesce(CAST(TIMESTAMP '{ts}' AS VARCHAR), {SENTINEL})))")


def scd2_ctes(kind: str, name: str = "scd") -> str:
    """Two SCD2 snapshot runs (as-of SNAP_A1 then SNAP_A2) as CTEs."""
    if kind == "airline":
        key, attrs, src = "airline_iata", ["airline_name", "airline_icao"], airlines_cte
    else:
        key, attrs, src = "airport_iata", ["airport_name"], airports_cte
    cols = ", ".join([key, *attrs])
    changed = " OR ".join(f"t.{a} IS DISTINCT FROM s.{a}" for a in attrs)
    return ",".join([
        src("stg", f"{name}_src1", SNAP_A1),
        src("stg", f"{name}_src2", SNAP_A2),
        f"""
{name}_1 AS (
  SELECT {cols}, {_scd_id(key, SNAP_A1)} AS dbt_scd_id, TIMESTAMP '{SNAP_A1}' AS dbt_updated_at,
         TIMESTAMP '{SNAP_A1}' AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to
  FROM {name}_src1
),
{name} AS (
  SELECT {", ".join("t." + c for c in [key, *attrs])}, t.dbt_scd_id, t.dbt_updated_at, t.dbt_valid_from,
    CASE WHEN s.{key} IS NOT NULL AND ({changed}) THEN TIMESTAMP '{SNAP_A2}' ELSE t.dbt_valid_to END AS dbt_valid_to
  FROM {name}_1 t LEFT JOIN {name}_src2 s ON t.{key} = s.{key}
  UNION ALL
  SELECT {", ".join("s." + c for c in [key, *attrs])}, {_scd_id("s." + key, SNAP_A2)}, TIMESTAMP '{SNAP_A2}',
    TIMESTAMP '{SNAP_A2}', CAST(NULL AS TIMESTAMP)
  FROM {name}_src2 s LEFT JOIN {name}_1 t ON t.{key} = s.{key}
  WHERE t.{key} IS NULL OR {changed}
)""",
    ])


#: The data tests of every table, stated here once more, so that a check missing in the library is seen.
ROLES, DIRECTIONS = "'operating', 'marketing'", "'DEPARTURE', 'ARRIVAL'"
STATUSES = "'scheduled', 'active', 'landed', 'actual', 'cancelled', 'canceled', 'incident', 'diverted', ''"
DELAY_CLASSES = "'On Time', '15-30 min', '30-60 min', '60+ min'"
FLIGHT_KEYS = "flight_id flight_date direction dep_iata sched_dep sched_arr extracted_at target_airport"
CALENDAR = "sched_year sched_month sched_day_name sched_is_weekend is_cancelled"
DAY_COUNTS = ("total_scheduled total_actual scheduled_dep scheduled_arr actual_dep actual_arr on_time_dep on_time_arr cancelled_count"
              " cancellation_rate_pct")
PERCENTAGES = {c: (0, 100) for c in ("dep_otp_pct", "arr_otp_pct", "cancellation_rate_pct")}
CLASSES = {"delay_bucket_dep": DELAY_CLASSES, "delay_bucket_arr": DELAY_CLASSES}
NOT_NULL = {
    "stg_flights": FLIGHT_KEYS + " carrier_role",
    "dim_dates": "date_id date_day year month day quarter day_of_week day_of_year week_of_year month_name day_name is_weekend year_month",
    "int_flights_enriched": FLIGHT_KEYS + " carrier_role " + CALENDAR,
    "fct_flights": FLIGHT_KEYS + " " + CALENDAR,
    "gate_usage_summary": "gate airline_iata departure_count arrival_count total_flight_count",
    "daily_airport_summary": "flight_date " + DAY_COUNTS,
    "daily_airport_operations": "actual_operation_date " + DAY_COUNTS,
    "daily_airline_summary": "flight_date airline_iata " + DAY_COUNTS,
    "daily_airline_operations": "actual_operation_date airline_iata " + DAY_COUNTS,
    "dim_airlines": "airline_iata dbt_valid_from dbt_scd_id",
    "dim_airports": "airport_iata dbt_valid_from dbt_scd_id",
    "gate_capacity": "gate_count runway_count operating_hours_start operating_hours_end",
    "airline_reference": "airline_id airline_name",
}
ACCEPTED = {
    "stg_flights": {"direction": DIRECTIONS, "flight_status": STATUSES, "carrier_role": ROLES},
    "int_flights_enriched": {"direction": DIRECTIONS, "flight_status": STATUSES, "carrier_role": ROLES} | CLASSES,
    "fct_flights": {"direction": DIRECTIONS, "flight_status": STATUSES} | CLASSES,
    "airline_reference": {"active": "'Y', 'N'"},
}
BETWEEN = {
    "fct_flights": {"delay_dep": (-60, 1440), "delay_arr": (-60, 1440)},
    "daily_airport_summary": PERCENTAGES, "daily_airport_operations": PERCENTAGES,
    "daily_airline_summary": PERCENTAGES, "daily_airline_operations": PERCENTAGES,
}
UNIQUE = {
    "dim_dates": "date_id", "fct_flights": "flight_id", "daily_airport_summary": "flight_date", "daily_airport_operations": "actual_operation_date",
    "dim_airlines": "dbt_scd_id", "dim_airports": "dbt_scd_id", "airline_reference": "airline_id",
}
COMBINATIONS = {"daily_airline_summary": "flight_date airline_iata", "daily_airline_operations": "actual_operation_date airline_iata"}
OPEN_VERSIONS = {"dim_airlines": "airline_iata", "dim_airports": "airport_iata"}


def quality_checks() -> dict[tuple[str, str], str]:
    """(table, check name) to the number of failing rows."""
    out = {}
    for t, names in NOT_NULL.items():
        out |= {(t, f"not_null__{c}"): f"SELECT count(*) FROM {t} WHERE {c} IS NULL" for c in names.split()}
    for t, columns in ACCEPTED.items():
        out |= {(t, f"accepted_values__{c}"): f"SELECT count(*) FROM {t} WHERE {c} NOT IN ({v})" for c, v in columns.items()}
    for t, columns in BETWEEN.items():
        out |= {(t, f"between__{c}"): f"SELECT count(*) FROM {t} WHERE {c} NOT BETWEEN {lo} AND {hi}" for c, (lo, hi) in columns.items()}
    for t, c in UNIQUE.items():
        out[t, f"unique__{c}"] = f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
    for t, columns in COMBINATIONS.items():
        cols = columns.replace(" ", ", ")
        out[t, "unique_combination__" + columns.replace(" ", "__")] = f"SELECT count(*) FROM (SELECT {cols} FROM {t} GROUP BY {cols} HAVING count(*) > 1)"
    for t, c in OPEN_VERSIONS.items():
        out[t, f"one_open_version__{c}__dbt_valid_to"] = (
            f"SELECT count(DISTINCT {c}) - (SELECT count(*) FROM (SELECT {c} FROM {t} WHERE dbt_valid_to IS NULL GROUP BY {c} HAVING count(*) = 1)) FROM {t}"
        )
    for t in ("daily_airport_summary", "daily_airport_operations"):
        out[t, "scheduled_dep_not_below_actual_dep"] = f"SELECT count(*) FROM {t} WHERE scheduled_dep < actual_dep"
    out["stg_flights", "functional_dependency__flight_date__operating_flight_iata__direction__flight_id"] = """SELECT count(*) FROM (
      SELECT 1 FROM stg_flights GROUP BY flight_date, operating_flight_iata, direction HAVING count(DISTINCT coalesce(flight_id, '?')) > 1)"""
    out["stg_flights", "referenced_in__airline_iata__daily_airline_summary"] = """SELECT count(DISTINCT airline_iata) FROM stg_flights
      WHERE carrier_role = 'marketing' AND airline_iata NOT IN (SELECT airline_iata FROM daily_airline_summary)"""
    out["fct_flights", "fewer_rows__stg_flights"] = "SELECT greatest(0, count(*) - (SELECT count(*) FROM stg_flights) + 1) FROM fct_flights"
    return out


AIRLINE_REFERENCE = """SELECT CAST(ascii(substr(airline_iata, 1, 1)) * 100 + TRY_CAST(substr(airline_iata, 2, 8) AS INTEGER) AS INTEGER) AS airline_id,
  airline_name, CAST(NULL AS VARCHAR) AS alias, airline_iata AS iata, airline_icao AS icao,
  CAST(NULL AS VARCHAR) AS callsign, 'Country, Land' AS country,
  CASE WHEN airline_iata LIKE 'A%' THEN 'Y' ELSE 'N' END AS active
FROM airlines"""


def quality_sql() -> str:
    ctes = [
        EVENTS_CTE, dates_cte(), BUCKETS_CTE, airlines_cte(), airports_cte(), enriched_cte(), fact_cte(),
        "\nstg_flights AS (SELECT * FROM stg)",
        "\ndim_dates AS (SELECT * FROM dates)",
        "\nint_flights_enriched AS (SELECT * FROM enriched)",
        "\nfct_flights AS (SELECT * FROM fact)",
        gates_cte("gate_usage_summary"),
        "\ndaily_airport_summary AS (" + kpi_select("flight_date") + " FROM fact GROUP BY flight_date)",
        "\ndaily_airport_operations AS (" + kpi_select("actual_operation_date")
        + " FROM fact WHERE actual_operation_date IS NOT NULL GROUP BY actual_operation_date)",
        "\ndaily_airline_summary AS (" + kpi_select("flight_date, airline_iata")
        + " FROM enriched WHERE airline_iata IS NOT NULL GROUP BY flight_date, airline_iata)",
        "\ndaily_airline_operations AS (" + kpi_select("actual_operation_date, airline_iata")
        + " FROM enriched WHERE actual_operation_date IS NOT NULL AND airline_iata IS NOT NULL"
        + " GROUP BY actual_operation_date, airline_iata)",
        scd2_ctes("airline", "dim_airlines"),
        scd2_ctes("airport", "dim_airports"),
        "\ngate_capacity AS (SELECT 11 AS gate_count, 2 AS runway_count, '06:45' AS operating_hours_start, '23:00' AS operating_hours_end)",
        "\nairline_reference AS (" + AIRLINE_REFERENCE + ")",
    ]
    selects = [f"SELECT '{t}' AS table_name, '{n}' AS check_name, CAST(({body}) AS BIGINT) AS failing_rows" for (t, n), body in quality_checks().items()]
    return "WITH " + ",".join(ctes) + "\n" + "\nUNION ALL\n".join(selects)


def mart_two_runs(keys: list[str], first: str, second: str) -> str:
    """A mart built from ``first``; of the last 7 days the keys that ``second`` has are built anew."""
    cols, day = ", ".join(keys), keys[0]
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys if k != "flight_date")
    same = " AND ".join(f"n.{k} = o.{k}" for k in keys)
    return f""", old AS ({kpi_select(cols)} FROM {first} WHERE {known} GROUP BY ALL),
new AS ({kpi_select(cols)} FROM {second} WHERE {known} AND {day} >= (SELECT max({day}) FROM old) - 7 GROUP BY ALL)
SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE {same})
UNION ALL SELECT * FROM new"""


def oracle_sql_incremental() -> dict[str, str]:
    q = {}
    q["fct_flights_two_batches"] = two_runs_with() + "SELECT * FROM merged"
    q["fct_flights_bucketed_two_batches"] = q["fct_flights_two_batches"]
    q["daily_summary_two_batches"] = two_runs_with() + """SELECT * FROM summary1
WHERE flight_date NOT IN (SELECT flight_date FROM batch2)
UNION ALL SELECT * FROM batch2"""
    day = "actual_operation_date"
    q["daily_airport_operations_counted"] = two_runs_with() + kpi_select(day) + f" FROM merged WHERE {day} IS NOT NULL GROUP BY {day}"
    q["daily_airline_operations_counted"] = (
        two_runs_with() + kpi_select(f"{day}, airline_iata") + f" FROM enriched2 WHERE {day} IS NOT NULL AND airline_iata IS NOT NULL GROUP BY ALL"
    )
    differs = [f"if(b.{c} IS DISTINCT FROM a.{c}, '{c}', NULL)" for c in _fct_cols() if c != "flight_id"]
    q["rerun_diff"] = two_runs_with()[:-1] + "," + fact_cte("enriched2", "rebuilt") + f"""
SELECT * FROM (
  SELECT coalesce(b.flight_id, a.flight_id) AS flight_id,
    CASE WHEN b.flight_id IS NULL THEN 'added' WHEN a.flight_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
    CAST(b.flight_id IS NOT NULL AS BIGINT) AS rows_before, CAST(a.flight_id IS NOT NULL AS BIGINT) AS rows_after,
    CASE WHEN b.flight_id = a.flight_id THEN concat_ws(',', {", ".join(differs)}) END AS changed_columns
  FROM merged b FULL OUTER JOIN rebuilt a ON b.flight_id = a.flight_id)
WHERE changed_columns IS DISTINCT FROM ''"""
    for name, keys, first, second in (
        ("daily_airport_operations", ["actual_operation_date"], "fact1", "merged"),
        ("daily_airline_summary", ["flight_date", "airline_iata"], "enriched1", "enriched2"),
        ("daily_airline_operations", ["actual_operation_date", "airline_iata"], "enriched1", "enriched2"),
    ):
        q[f"{name}_two_batches"] = two_runs_with() + mart_two_runs(keys, first, second)
    q["airline_scd2"] = "WITH " + EVENTS_CTE + "," + scd2_ctes("airline") + "\nSELECT * FROM scd"
    q["airport_scd2"] = "WITH " + EVENTS_CTE + "," + scd2_ctes("airport") + "\nSELECT * FROM scd"
    best = _best({
        "named": "airline_name IS NOT NULL", "coded": "airline_icao IS NOT NULL", "seen": "extracted_at",
        "title": "coalesce(airline_name, '')", "code": "coalesce(airline_icao, '')",
    })
    q["airline_scd2_history"] = "WITH " + EVENTS_CTE + f""",
seen AS (
  SELECT airline_iata, airline_name, airline_icao, extracted_at, date_trunc('day', extracted_at - INTERVAL 1 MICROSECOND) + INTERVAL 1 DAY AS run
  FROM stg WHERE airline_iata IS NOT NULL),
known AS (
  SELECT airline_iata, runs.run AS run, {best} AS b
  FROM seen JOIN (SELECT DISTINCT run FROM seen) runs ON seen.run <= runs.run GROUP BY airline_iata, runs.run),
plain AS (SELECT airline_iata, run, if(b.named, b.title, NULL) AS airline_name, if(b.coded, b.code, NULL) AS airline_icao FROM known),
versions AS (
  SELECT * FROM plain
  WINDOW w AS (PARTITION BY airline_iata ORDER BY run)
  QUALIFY row_number() OVER w = 1 OR airline_name IS DISTINCT FROM lag(airline_name) OVER w OR airline_icao IS DISTINCT FROM lag(airline_icao) OVER w)
SELECT airline_iata, airline_name, airline_icao, md5(concat_ws('-', airline_iata, CAST(CAST(run AS TIMESTAMP) AS VARCHAR))) AS dbt_scd_id,
  CAST(run AS TIMESTAMP) AS dbt_updated_at, CAST(run AS TIMESTAMP) AS dbt_valid_from,
  CAST(lead(run) OVER (PARTITION BY airline_iata ORDER BY run) AS TIMESTAMP) AS dbt_valid_to
FROM versions"""
    q["flights_asof_airline"] = "WITH " + EVENTS_CTE + "," + scd2_ctes("airline") + """
SELECT s.flight_id, s.extracted_at, s.airline_iata, v.airline_name AS asof_airline_name, v.airline_icao AS asof_airline_icao
FROM stg s LEFT JOIN scd v ON s.airline_iata = v.airline_iata AND s.extracted_at >= v.dbt_valid_from
  AND (v.dbt_valid_to IS NULL OR s.extracted_at < v.dbt_valid_to)"""
    q["quality_report"] = quality_sql()
    q["ingest_stream"] = "WITH " + EVENTS_CTE + "\nSELECT " + STG_COLUMNS.replace(
        "extracted_at,", "CAST(date_trunc('day', extracted_at) AS TIMESTAMP) AS extracted_at,", 1
    ) + " FROM stg"
    q["ingest_redelivered"] = q["ingest_stream"]
    q["ingest_ledger"] = "WITH " + EVENTS_CTE + """,
lines AS (
  SELECT 'flights_' || lower(direction) || strftime(extracted_at, '_%Y%m%d_000000.json') AS landing_file, direction,
    CAST(date_trunc('day', extracted_at) AS TIMESTAMP) AS extracted_at,
    minute(extracted_at) = 7 OR (direction = 'ARRIVAL' AND CAST(extracted_at AS DATE) = DATE '2024-01-05') AS broken
  FROM stg)
SELECT landing_file, direction, extracted_at, count(*) FILTER (WHERE NOT broken) AS good_rows, count(*) FILTER (WHERE broken) AS rejected_rows,
  CASE WHEN bool_and(broken) THEN 'failed' WHEN bool_or(broken) THEN 'partial' ELSE 'loaded' END AS status
FROM lines GROUP BY ALL"""
    q["airline_reference"] = "WITH " + EVENTS_CTE + "," + airlines_cte() + "\n" + AIRLINE_REFERENCE
    q["airline_canonical"] = "WITH " + EVENTS_CTE + "," + airlines_cte() + """,
ref AS (
  SELECT CAST(ascii(substr(airline_iata, 1, 1)) * 100 + TRY_CAST(substr(airline_iata, 2, 8) AS INTEGER) AS INTEGER) AS airline_id,
    airline_iata AS iata, airline_name, 'Country, Land' AS country,
    CASE WHEN airline_iata LIKE 'A%' THEN 'Y' ELSE 'N' END AS active
  FROM airlines),
ref1 AS (SELECT * FROM ref WHERE active = 'Y' AND iata IS NOT NULL
         QUALIFY ROW_NUMBER() OVER (PARTITION BY iata ORDER BY airline_id) = 1)
SELECT s.flight_id, s.extracted_at, s.airline_iata, r.airline_name AS ref_airline_name, r.country AS ref_country
FROM stg s LEFT JOIN ref1 r ON s.airline_iata = r.iata"""
    q["stream_upsert"] = two_runs_with(daily_extracts=True) + "SELECT * FROM merged"
    q["daily_summary_replaced_window"] = two_runs_with() + """SELECT * FROM summary1
WHERE flight_date < (SELECT max(flight_date) FROM summary1) - 7 OR flight_date IS NULL
UNION ALL SELECT * FROM batch2"""
    q["unexpected_statuses"] = "WITH " + EVENTS_CTE + """
SELECT flight_status, CAST(COUNT(*) AS BIGINT) AS rows FROM stg
WHERE flight_status IS NOT NULL AND flight_status NOT IN
  ('scheduled', 'active', 'landed', 'actual', 'cancelled', 'canceled', 'incident', 'diverted', '')
GROUP BY flight_status"""
    return q
