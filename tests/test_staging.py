import datetime as dt

from pyspark.sql import functions as F

from skyfold.operators.flatten import STAGING_COLUMNS, flatten_flights


def _raw(spark, lines, direction="DEPARTURE"):
    df = spark.createDataFrame([(x,) for x in lines], "j string")
    return df.select(
        F.try_parse_json("j").alias("raw_json"),
        F.lit(dt.datetime(2027, 3, 14, 12, 0)).cast("timestamp_ntz").alias("extracted_at"),
        F.lit(direction).alias("direction"),
        F.lit("HUB").alias("target_airport"),
    )


def test_minimal_record_flattens_to_nulls(spark):
    stg = flatten_flights(_raw(spark, ['{"flight_date": "2027-03-14", "flight": {"iata": "QZ7"}}']))
    r = stg.first().asDict()
    assert stg.columns == STAGING_COLUMNS
    assert r["flight_date"] == dt.date(2027, 3, 14) and r["flight_iata"] == "QZ7"
    assert r["carrier_role"] == "operating" and r["operating_flight_iata"] == "QZ7"
    for c in ("flight_status", "dep_iata", "sched_dep", "actual_dep", "airline_iata", "delay_dep", "gate_arr"):
        assert r[c] is None


def test_codeshare_json_null_is_operating_object_is_marketing(spark):
    lines = [
        '{"flight_date":"2027-03-14","flight":{"iata":"AC1","codeshared":null},"airline":{"iata":"AC"}}',
        '{"flight_date":"2027-03-14","flight":{"iata":"UA9","codeshared":{"airline_iata":"AC","flight_iata":"AC1"}},'
        '"airline":{"iata":"UA"}}',
    ]
    rows = flatten_flights(_raw(spark, lines)).orderBy("flight_iata").collect()
    op, mk = rows
    assert op.carrier_role == "operating" and op.operating_airline_iata == "AC"
    assert mk.carrier_role == "marketing" and mk.operating_airline_iata == "AC" and mk.operating_flight_iata == "AC1"
    assert op.flight_id == mk.flight_id  # same physical flight, same key


def test_local_wall_time_kept_and_delay_from_instants(spark):
    line = ('{"flight_date":"2027-03-14","departure":{"iata":"HUB","scheduled":"2027-03-14T23:30:00-04:00",'
            '"actual":"2027-03-15T00:10:00-04:00"},"arrival":{"scheduled":"not a time"}}')
    r = flatten_flights(_raw(spark, [line])).first()
    assert r.sched_dep == dt.datetime(2027, 3, 14, 23, 30)  # local date stays 03-14 (H1)
    assert r.actual_dep == dt.datetime(2027, 3, 15, 0, 10)
    assert r.delay_dep == 40
    assert r.sched_arr is None  # bad text → NULL, no failure


def test_unparsable_line_gives_null_variant(spark):
    raw = _raw(spark, ["{not json"])
    assert raw.first().raw_json is None
