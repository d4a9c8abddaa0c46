"""Seeds: small static reference tables read as CSV with explicit types
(S9), and the airline reference file cleaning (S10)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.functions.exprs import sentinel_to_null

SEED_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "seeds")

CAPACITY_SCHEMA = "gate_count INT, runway_count INT, operating_hours_start STRING, operating_hours_end STRING"

AIRLINE_REFERENCE_COLUMNS = ["airline_id", "airline_name", "alias", "iata", "icao", "callsign", "country", "active"]
# The reference file's markers for a missing value.
MISSING_MARKERS = ("\\N", "-")


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV with an explicit schema (no inference, S9)."""
    return spark.read.csv(path, header=True, schema=schema)


def gate_capacity(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The one-row airport capacity seed."""
    return read_seed(spark, path or os.path.join(SEED_DIR, "gate_capacity.csv"), CAPACITY_SCHEMA)


def clean_airline_reference(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Airline reference rows from raw CSV lines.

    Each line is cut into fields by one pattern, in one pass: a field is
    quoted parts and characters other than commas and quotes. Rows whose width
    is not exactly 8 are skipped (an explicit width check: CSV
    DROPMALFORMED is not reliable under column pruning). ``\\N`` and ``-``
    (after trimming) become NULL; the active flag ``y``/``n`` is
    upper-cased. ``airline_id`` is an INT.
    """
    # with a comma after the last field, each field ends with one; unquoted below
    fields = F.regexp_extract_all(F.concat(F.col(value_col), F.lit(",")), F.lit(r'((?:"[^"]*+"|[^,"]++)*+),'), F.lit(1))
    rows = lines.select(fields.alias("f")).where(F.size("f") == len(AIRLINE_REFERENCE_COLUMNS))
    out = []
    for i, name in enumerate(AIRLINE_REFERENCE_COLUMNS):
        raw = F.col("f")[i]
        quoted = raw.startswith('"') & raw.endswith('"') & (F.length(raw) >= 2)
        inner = F.expr(f"substr(f[{i}], 2, length(f[{i}]) - 2)")
        field = F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(raw)
        v = sentinel_to_null(field, MISSING_MARKERS)
        if name == "active":
            v = F.when(F.lower(F.trim(v)).isin("y", "n"), F.upper(F.trim(v))).otherwise(v)
        if name == "airline_id":
            v = F.trim(v).try_cast("int")
        out.append(v.alias(name))
    return rows.select(*out)


def read_airline_reference(spark: SparkSession, path: str) -> DataFrame:
    """Headerless 8-column airline reference file → cleaned rows."""
    return clean_airline_reference(spark.read.text(path))
