import datetime as dt
import os

from pyspark.sql import functions as F

from skyfold.sources.landing import read_landing, split_rejects, with_landing_metadata, write_landing
from skyfold.sources.seeds import clean_airline_reference, gate_capacity
from skyfold.streaming.ingest import ingest_available, read_raw

NOW = dt.datetime(2030, 1, 1, 0, 0)


def test_file_name_parse(spark):
    names = [
        "/l/flights_departure_20270314_060102.json",
        "/l/FLIGHTS_Arrival_20270314_060109.json",
        "/l/timetable.json",
        "/l/flights_charter_20270314_060109.json",
        "/l/landing_file=flights_departure_20270314_060102.json/part-0000.txt",
    ]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, p string")
    out = with_landing_metadata(df, F.col("p"), F.lit(NOW).cast("timestamp_ntz")).orderBy("i")
    got = [(r.direction, r.extracted_at) for r in out.collect()]
    assert got == [
        ("DEPARTURE", dt.datetime(2027, 3, 14, 6, 1, 2)),
        ("ARRIVAL", dt.datetime(2027, 3, 14, 6, 1, 9)),
        ("UNKNOWN", NOW),
        ("UNKNOWN", NOW),
        ("DEPARTURE", dt.datetime(2027, 3, 14, 6, 1, 2)),
    ]


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_pending_scan_top_level_json_only(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    assert read_landing(spark, land, "HUB").count() == 0  # missing folder → nothing
    _write(f"{land}/flights_departure_20270314_060102.json", '{"flight_date":"2027-03-14"}\n{"flight_date":"2027-03-14"}\n')
    _write(f"{land}/notes.txt", '{"flight_date":"2027-03-14"}\n')
    _write(f"{land}/archive/flights_arrival_20270314_060109.json", '{"flight_date":"2027-03-14"}\n')
    raw = read_landing(spark, land, "HUB")
    rows = raw.collect()
    assert len(rows) == 2 and {r.direction for r in rows} == {"DEPARTURE"}
    assert {r.target_airport for r in rows} == {"HUB"}


def test_rejects_split(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    _write(f"{land}/flights_arrival_20270314_060109.json", '{"a":1}\n{broken\n')
    good, bad = split_rejects(read_landing(spark, land, "HUB"))
    assert good.count() == 1 and bad.first().line == "{broken"


def test_streaming_ingest_loads_once_and_archives(spark, tmp_dir):
    land, raw = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "raw")
    ckpt, arch = os.path.join(tmp_dir, "ckpt"), os.path.join(tmp_dir, "archive")
    _write(f"{land}/flights_departure_20270314_060102.json", '{"flight_date":"2027-03-14"}\n' * 3)
    ingest_available(spark, land, raw, ckpt, "HUB", archive_dir=arch, max_files_per_trigger=1)
    assert read_raw(spark, raw).count() == 3
    ingest_available(spark, land, raw, ckpt, "HUB", archive_dir=arch)  # same files again: nothing new
    assert read_raw(spark, raw).count() == 3
    _write(f"{land}/flights_arrival_20260501_080000.json", '{"flight_date":"2026-05-01"}\n')
    ingest_available(spark, land, raw, ckpt, "HUB", archive_dir=arch, max_files_per_trigger=1)
    got = read_raw(spark, raw).groupBy("direction").count().collect()
    assert sorted((r.direction, r["count"]) for r in got) == [("ARRIVAL", 1), ("DEPARTURE", 3)]
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".json")]
    assert "flights_departure_20270314_060102.json" in archived  # moved once a later batch committed


def test_spark_written_landing_round_trip(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    recs = spark.createDataFrame(
        [('{"flight_date":"2027-03-14"}', "DEPARTURE", dt.datetime(2026, 4, 30, 6, 0))] * 5,
        "json_text string, direction string, extracted_at timestamp_ntz",
    )
    write_landing(recs, land)
    raw = read_landing(spark, land, "HUB")
    rows = raw.collect()
    assert len(rows) == 5 and {(r.direction, r.extracted_at) for r in rows} == {("DEPARTURE", dt.datetime(2026, 4, 30, 6))}


def test_airline_reference_cleaning(spark):
    lines = [
        '1,"Air One",\\N,A1,XA1,-,"Land, Country",y',
        "2,Two Air,-, - ,XA2,CALL,Land,N",
        "3,Short,Row,A3,XA3,CALL,Land",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    rows = sorted(clean_airline_reference(df).collect(), key=lambda r: r.airline_id)
    assert len(rows) == 2
    a, b = rows
    assert (a.airline_id, a.airline_name, a.alias, a.iata, a.callsign, a.country, a.active) == (
        1, "Air One", None, "A1", None, "Land, Country", "Y")
    assert (b.alias, b.iata, b.active) == (None, None, "N")


def test_capacity_seed(spark):
    r = gate_capacity(spark).first()
    assert (r.gate_count, r.runway_count, r.operating_hours_start, r.operating_hours_end) == (11, 2, "06:45", "23:00")


def test_upsert_stream_two_runs_keep_keys(spark, tmp_dir):
    from skyfold.plans.incremental import MARTS, FlightStore
    from skyfold.streaming.ingest import upsert_stream

    land = os.path.join(tmp_dir, "landing")
    rec = ('{"flight_date":"%s","flight_status":"%s","flight":{"iata":"AC1"},"departure":{"iata":"HUB",'
           '"scheduled":"%sT10:00:00-05:00"},"arrival":{"iata":"P1","scheduled":"%sT11:00:00-05:00"},'
           '"airline":{"iata":"AC","name":"Air C"}}')
    wh = os.path.join(tmp_dir, "wh")
    _write(f"{land}/flights_departure_20260501_060000.json", rec % ("2026-05-01", "scheduled", "2026-05-01", "2026-05-01") + "\n")
    s1 = upsert_stream(spark, land, FlightStore(spark, wh), os.path.join(tmp_dir, "ck"), "HUB")
    assert s1.fct_flights.first().flight_status == "scheduled"
    # later extract: same flight landed (update), plus a flight 10 days older than the stored max (ignored)
    _write(f"{land}/flights_departure_20260502_060000.json",
           rec % ("2026-05-01", "landed", "2026-05-01", "2026-05-01") + "\n"
           + (rec % ("2026-04-20", "landed", "2026-04-20", "2026-04-20")).replace("AC1", "AC2") + "\n")
    store = FlightStore(spark, wh)  # a second process: nothing but the folder is known
    s2 = upsert_stream(spark, land, store, os.path.join(tmp_dir, "ck"), "HUB")
    rows = s2.fct_flights.collect()
    assert [(r.flight_iata, r.flight_status) for r in rows] == [("AC1", "landed")]
    assert store.read_staging().count() == 3 and store.last_commit().run == 2
    assert [r.airline_name for r in s2.airline_best.collect()] == ["Air C"]
    assert s2.dim_airlines.where("dbt_valid_to IS NULL").count() == 1
    # a late extract without the airline's name: the best row and its version stay
    _write(f"{land}/flights_departure_20260430_060000.json",
           (rec % ("2026-05-01", "landed", "2026-05-01", "2026-05-01")).replace(',"name":"Air C"', ""))
    s3 = upsert_stream(spark, land, FlightStore(spark, wh), os.path.join(tmp_dir, "ck"), "HUB")
    assert [r.airline_name for r in s3.airline_best.collect()] == ["Air C"]
    assert s3.dim_airlines.where("dbt_valid_to IS NOT NULL").count() == 0
    assert set(s3.marts) == set(MARTS) and s3.marts["daily_airline_summary"].count() == 1


def test_batch_load_appends_raw_and_rejects(spark, tmp_dir):
    from skyfold.sources.landing import load_landing

    land = os.path.join(tmp_dir, "landing")
    _write(f"{land}/flights_departure_20270314_060102.json", '{"a":1}\n{"a":2}\nnot json\n')
    raw, rej = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "rej")
    load_landing(spark, land, raw, "HUB", reject_path=rej)
    load_landing(spark, land, raw, "HUB", reject_path=rej)  # a batch re-load appends again (no bookkeeping)
    assert spark.read.parquet(raw).count() == 4 and spark.read.parquet(rej).count() == 2


def test_freshness(spark):
    from skyfold.operators.quality import freshness

    df = spark.createDataFrame([(dt.datetime(2024, 1, 30, 12),)], "extracted_at timestamp_ntz")
    r = freshness(df, "extracted_at", "2024-01-31 12:00:00", 48).first()
    assert r.age_hours == 24.0 and r.stale is False
    r2 = freshness(df, "extracted_at", "2024-02-05 12:00:00", 48).first()
    assert r2.stale is True


def test_ledger_counts_every_file_and_agrees_with_what_was_observed(spark, tmp_dir):
    from skyfold.streaming.ingest import read_ledger

    land, ledger = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ledger")
    raw, ckpt = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "ckpt")
    good = '{"flight_date":"2027-03-14"}\n'
    _write(f"{land}/flights_departure_20270314_060102.json", good * 3)
    _write(f"{land}/flights_arrival_20270314_060109.json", good + "{broken\n\n" + good)
    _write(f"{land}/flights_arrival_20270315_060109.json", "none\nof these\n")
    _write(f"{land}/timetable.json", good)
    _write(f"{land}/empty.json", "\n")
    folder = f"{land}/landing_file=flights_departure_20270316_060000.json"
    _write(f"{folder}/part-0.txt", good * 2)
    _write(f"{folder}/part-1.txt", "broken\n")
    now = F.lit(NOW).cast("timestamp_ntz")
    first = ingest_available(spark, land, raw, ckpt, "HUB", now=now, max_files_per_trigger=1, ledger_path=ledger)
    rows = {r.landing_file: (r.direction, r.good_rows, r.rejected_rows, r.status) for r in read_ledger(spark, ledger).collect()}
    assert rows == {
        "flights_departure_20270314_060102.json": ("DEPARTURE", 3, 0, "loaded"),
        "flights_arrival_20270314_060109.json": ("ARRIVAL", 2, 1, "partial"),
        "flights_arrival_20270315_060109.json": ("ARRIVAL", 0, 2, "failed"),
        "timetable.json": ("UNKNOWN", 1, 0, "loaded"),
        "flights_departure_20270316_060000.json": ("DEPARTURE", 2, 1, "partial"),
    }
    assert (first.batches, first.loaded_rows, first.rejected_rows) == (7, 8, 4) and read_raw(spark, raw).count() == 8
    again = ingest_available(spark, land, raw, ckpt, "HUB", now=now, ledger_path=ledger)
    assert (again.loaded_rows, again.rejected_rows) == (0, 0) and read_ledger(spark, ledger).count() == 5


def test_redelivered_files_add_nothing(spark, tmp_dir):
    from skyfold.streaming.ingest import read_ledger

    land, ledger = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ledger")
    raw, ckpt = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "ckpt")
    twice = '{"a":1}\n{"a":1}\n{"a":2}\n'

    def drain():
        return ingest_available(spark, land, raw, ckpt, "HUB", ledger_path=ledger, skip_redelivered=True)

    _write(f"{land}/flights_departure_20270314_060102.json", twice)
    _write(f"{land}/first.json", '{"b":1}\n')
    _write(f"{land}/second.json", '{"b":1}\n')  # the same lines in one run, without an extract time
    one = drain()
    assert (one.loaded_rows, one.rejected_rows) == (4, 0)  # a line that a file holds twice counts twice
    _write(f"{land}/again=flights_departure_20270314_060102.json", '{"a":2}\n{"a":1}\n{"a":1}\n')  # other name and order
    _write(f"{land}/flights_departure_20270315_060102.json", twice)  # another extract: the same lines are news
    _write(f"{land}/third.json", '{"b":1}\n')
    two = drain()
    assert two.loaded_rows == 3 and read_raw(spark, raw).count() == 7
    again = {os.path.basename(r.file) for r in spark.read.parquet(ledger).where("redelivered").collect()}
    assert len(again) == 3 and again >= {"second.json", "third.json"}
    assert {r.landing_file: r.status for r in read_ledger(spark, ledger).collect()}["third.json"] == "redelivered"
