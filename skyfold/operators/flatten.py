"""Staging: flatten raw JSON flight records into typed, keyed rows.

One spec table drives one ``select``: every path is a ``try_variant_get``,
so a missing path, an explicit JSON null or an unparsable value is NULL and
never fails the job. Names follow the downstream (canonical) spelling (D1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.functions.exprs import json_field, json_object_or_null
from skyfold.functions.keys import surrogate_key

# (output column, JSON path, kind); kind: string | date | local_ts
FLIGHT_PATHS: list[tuple[str, str, str]] = [
    ("flight_date", "$.flight_date", "date"),
    ("flight_status", "$.flight_status", "string"),
    ("flight_iata", "$.flight.iata", "string"),
    ("flight_icao", "$.flight.icao", "string"),
    ("flight_number", "$.flight.number", "string"),
    ("dep_iata", "$.departure.iata", "string"),
    ("dep_icao", "$.departure.icao", "string"),
    ("dep_airport_name", "$.departure.airport", "string"),
    ("sched_dep", "$.departure.scheduled", "local_ts"),
    ("actual_dep", "$.departure.actual", "local_ts"),
    ("terminal_dep", "$.departure.terminal", "string"),
    ("gate_dep", "$.departure.gate", "string"),
    ("dep_timezone", "$.departure.timezone", "string"),
    ("arr_iata", "$.arrival.iata", "string"),
    ("arr_icao", "$.arrival.icao", "string"),
    ("arr_airport_name", "$.arrival.airport", "string"),
    ("sched_arr", "$.arrival.scheduled", "local_ts"),
    ("actual_arr", "$.arrival.actual", "local_ts"),
    ("terminal_arr", "$.arrival.terminal", "string"),
    ("gate_arr", "$.arrival.gate", "string"),
    ("baggage", "$.arrival.baggage", "string"),
    ("arr_timezone", "$.arrival.timezone", "string"),
    ("airline_iata", "$.airline.iata", "string"),
    ("airline_icao", "$.airline.icao", "string"),
    ("airline_name", "$.airline.name", "string"),
    ("aircraft_icao24", "$.aircraft.icao24", "string"),
]

# (delay column, scheduled path, actual path): whole minutes, negative = early
DELAYS = [
    ("delay_dep", "$.departure.scheduled", "$.departure.actual"),
    ("delay_arr", "$.arrival.scheduled", "$.arrival.actual"),
]

STAGING_COLUMNS = (
    ["flight_id", "extracted_at", "direction", "target_airport"]
    + [name for name, _, _ in FLIGHT_PATHS[:5]]
    + ["flight_codeshared"]
    + [name for name, _, _ in FLIGHT_PATHS[5:]]
    + [d for d, _, _ in DELAYS]
    + ["carrier_role", "operating_airline_iata", "operating_flight_iata"]
)


def _extract(raw: Column, path: str, kind: str) -> Column:
    text = json_field(raw, path, "string")
    if kind == "date":
        return text.try_cast("date")
    if kind == "local_ts":
        # local wall-clock time: the offset is dropped, the clock reading kept (H1)
        return text.try_cast("timestamp_ntz")
    return text


def _instant(raw: Column, path: str) -> Column:
    return F.try_to_timestamp(json_field(raw, path, "string"))


def flatten_flights(raw: DataFrame, json_col: str = "raw_json") -> DataFrame:
    """Raw rows (``raw_json`` VARIANT + metadata) → staging rows.

    Adds the carrier role (P5), the operating airline / flight (P6) and the
    surrogate ``flight_id`` over (flight_date, operating_flight_iata,
    direction) (P7). Metadata columns of ``raw`` are passed through.
    """
    v = F.col(json_col)
    cols: dict[str, Column] = {name: _extract(v, path, kind) for name, path, kind in FLIGHT_PATHS}
    cols["flight_codeshared"] = json_object_or_null(v, "$.flight.codeshared")
    for name, sched, actual in DELAYS:
        cols[name] = F.timestamp_diff("MINUTE", _instant(v, sched), _instant(v, actual))
    unpacked = raw.select(
        "extracted_at", "direction", "target_airport", *[c.alias(n) for n, c in cols.items()]
    )
    cs = F.col("flight_codeshared")
    derived = unpacked.withColumns(
        {
            "carrier_role": F.when(cs.isNull(), "operating").otherwise("marketing"),
            "operating_airline_iata": F.coalesce(json_field(cs, "$.airline_iata"), F.col("airline_iata")),
            "operating_flight_iata": F.coalesce(json_field(cs, "$.flight_iata"), F.col("flight_iata")),
        }
    )
    keyed = derived.withColumn(
        "flight_id", surrogate_key("flight_date", "operating_flight_iata", "direction")
    )
    return keyed.select(*STAGING_COLUMNS)


def drop_variants(df: DataFrame) -> DataFrame:
    """Remove VARIANT columns (they cannot be grouped, sorted or compared)."""
    keep = [f.name for f in df.schema.fields if f.dataType.typeName() != "variant"]
    return df.select(*keep)
