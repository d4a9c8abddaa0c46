"""Raw flight records derived from the driver's ``events`` table.

Each event becomes one API record (a JSON object) of one extract, following
the integer rule of FIXTURES.md §3. The record is rendered as JSON text and
parsed back to VARIANT, so that the staging operator exercises the same
JSON path as real landing files. All work is column expressions: it scales
with ``events`` and runs inside whole-stage codegen up to ``to_json``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the fixture rule (FIXTURES.md §3).
HUB = "HUB"
HUB_NAME = "Port HUB"
RENAME_FROM = "2024-01-16"
LOCAL_OFFSET = "-05:00"
STATUS_BY_EVENT = {
    "signup": "scheduled",
    "purchase": "landed",
    "error": "cancelled",
    "view": "active",
    "click": "diverted",
}


def _s(c):
    return c.cast("string")


def _local_text(ts_col):
    return F.concat(F.date_format(ts_col, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(LOCAL_OFFSET))


def flight_record_columns(events: DataFrame) -> DataFrame:
    """Typed columns of the rule, one row per event (before JSON rendering)."""
    n = F.col("event_id")
    u = F.col("user_id")
    status_map = F.create_map(*[F.lit(x) for kv in STATUS_BY_EVENT.items() for x in kv])
    df = events.select(
        "event_id",
        "user_id",
        "ts",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )
    df = df.withColumns(
        {
            "ts_date": F.to_date("ts"),
            "direction": F.when(n % 2 == 0, "DEPARTURE").otherwise("ARRIVAL"),
            "op": F.concat(F.lit("A"), _s(u % 6)),
            "marketing": F.call_function("div", n, F.lit(2)) % 4 == 3,
            "other": F.concat(F.lit("P"), _s(u % 12)),
        }
    )
    df = df.withColumns(
        {
            "flight_date": F.date_sub(F.col("ts_date"), F.when(n % 50 == 0, 6).otherwise(n % 3).cast("int")),
            "flight_status": F.when(n % 223 == 0, F.lit(None).cast("string"))
            .when(n % 211 == 0, "Cancelled")
            .otherwise(status_map[F.col("event_type")]),
            "opf": F.when(n % 401 == 0, F.lit(None).cast("string")).otherwise(
                F.concat(F.col("op"), _s(100 + u % 60))
            ),
            "other_name": F.when(n % 17 == 0, F.lit(None).cast("string"))
            .when((F.col("other") == "P3") & (F.col("ts_date") >= F.lit(RENAME_FROM).cast("date")), "Port P3 Renamed")
            .otherwise(F.concat(F.lit("Port "), F.col("other"))),
        }
    )
    df = df.withColumns(
        {
            "airline_code": F.when(F.col("marketing"), F.concat(F.lit("M"), _s(u % 3)))
            .when(n % 97 == 0, F.lit(None).cast("string"))
            .otherwise(F.col("op")),
            "flight_code": F.when(
                F.col("marketing"), F.concat(F.lit("M"), _s(u % 3), _s(900 + u % 60))
            ).otherwise(F.col("opf")),
            "sched_dep_local": F.timestamp_add(
                "MINUTE",
                (F.hour("ts") * 60 + F.minute("ts")).cast("int"),
                F.col("flight_date").cast("timestamp_ntz"),
            ),
        }
    )
    code = F.col("airline_code")
    operated = F.col("flight_status").isin("landed", "active", "diverted")
    arrived = F.col("flight_status").isin("landed", "diverted")
    df = df.withColumns(
        {
            "airline_name": F.when((n % 11 == 0) | code.isNull(), F.lit(None).cast("string"))
            .when((code == "A1") & (F.col("ts_date") >= F.lit(RENAME_FROM).cast("date")), "Airline A1 Renamed")
            .otherwise(F.concat(F.lit("Airline "), code)),
            "airline_icao": F.when((n % 13 == 0) | code.isNull(), F.lit(None).cast("string")).otherwise(
                F.concat(F.lit("X"), code)
            ),
            "sched_arr_local": F.timestamp_add("MINUTE", (60 + F.col("k")).cast("int"), F.col("sched_dep_local")),
        }
    )
    delay = (F.floor("value") - 5).cast("int")
    df = df.withColumns(
        {
            "actual_dep_local": F.when(operated, F.timestamp_add("MINUTE", delay, F.col("sched_dep_local"))),
            "actual_arr_local": F.when(
                arrived, F.timestamp_add("MINUTE", delay + (n % 7 - 3).cast("int"), F.col("sched_arr_local"))
            ),
            "gate_dep": F.when(n % 4 == 0, F.lit(None).cast("string")).otherwise(
                F.concat(F.lit("G"), _s(F.col("k") % 11 + 1))
            ),
            "gate_arr": F.when(n % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("G"), _s(n % 11 + 1))),
            "baggage": F.when(n % 3 == 1, F.lit(None).cast("string")).otherwise(
                F.concat(F.lit("B"), _s(F.col("k") % 4))
            ),
        }
    )
    return df


def raw_flights_from_events(events: DataFrame, target_airport: str = HUB) -> DataFrame:
    """Raw table rows: ``raw_json VARIANT, extracted_at TIMESTAMP_NTZ,
    direction STRING, target_airport STRING`` (1.3 of FIXTURES.md)."""
    return raw_json_text_from_events(events, target_airport).select(
        F.parse_json("json_text").alias("raw_json"), "extracted_at", "direction", "target_airport"
    )


def raw_json_text_from_events(events: DataFrame, target_airport: str = HUB) -> DataFrame:
    """Same rows with the record still as JSON text (``json_text``)."""
    df = flight_record_columns(events)
    n = F.col("event_id")
    dep = F.col("direction") == "DEPARTURE"
    codeshared = F.when(
        F.col("marketing"), F.struct(F.col("op").alias("airline_iata"), F.col("opf").alias("flight_iata"))
    )
    record = F.struct(
        F.date_format("flight_date", "yyyy-MM-dd").alias("flight_date"),
        F.col("flight_status").alias("flight_status"),
        F.struct(F.col("flight_code").alias("iata"), codeshared.alias("codeshared")).alias("flight"),
        F.struct(
            F.when(dep, F.lit(target_airport)).otherwise(F.col("other")).alias("iata"),
            F.when(dep, F.lit(HUB_NAME)).otherwise(F.col("other_name")).alias("airport"),
            _local_text(F.col("sched_dep_local")).alias("scheduled"),
            F.when(F.col("actual_dep_local").isNotNull(), _local_text(F.col("actual_dep_local"))).alias("actual"),
            F.col("gate_dep").alias("gate"),
        ).alias("departure"),
        F.struct(
            F.when(dep, F.col("other")).otherwise(F.lit(target_airport)).alias("iata"),
            F.when(dep, F.col("other_name")).otherwise(F.lit(HUB_NAME)).alias("airport"),
            _local_text(F.col("sched_arr_local")).alias("scheduled"),
            F.when(F.col("actual_arr_local").isNotNull(), _local_text(F.col("actual_arr_local"))).alias("actual"),
            F.col("gate_arr").alias("gate"),
            F.col("baggage").alias("baggage"),
        ).alias("arrival"),
        F.struct(
            F.col("airline_code").alias("iata"),
            F.col("airline_icao").alias("icao"),
            F.col("airline_name").alias("name"),
        ).alias("airline"),
    )
    text = F.to_json(record, {"ignoreNullFields": "false"})
    # operating rows: codeshared is an explicit JSON null when n % 5 = 0, absent otherwise
    absent = (~F.col("marketing")) & (n % 5 != 0)
    # (one text expression: with one in each branch, the generated code would be too long for the JVM to compile)
    text = F.replace(text, F.when(absent, ',"codeshared":null').otherwise(""), F.lit(""))
    return df.select(
        text.alias("json_text"),
        F.col("ts").alias("extracted_at"),
        F.col("direction"),
        F.lit(target_airport).alias("target_airport"),
    )
