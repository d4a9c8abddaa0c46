"""Snapshot history in one pass, as-of lookup over time buckets, and distinct
counts from bitmaps."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skyfold.operators import dims, kpi
from skyfold.operators.joins import asof_version_lookup
from skyfold.session import cut_lineage

T, D = dt.datetime, dt.date
OBS = "airline_iata string, airline_name string, airline_icao string, extracted_at timestamp_ntz"
RUNS = [f"2024-01-{d:02d} 12:00:00" for d in (2, 4, 5, 9, 12)]


def observations(rng, n=120):
    rows = []
    for _ in range(n):
        at = T(2024, 1, 1) + dt.timedelta(minutes=rng.randint(0, 12 * 24 * 60))
        rows.append((rng.choice(["A", "B", "C", "D", None]), rng.choice([None, "one", "two"]), rng.choice([None, "X", "Y"]), at))
    rows += [("E", None, None, T(2024, 1, 3)), ("E", None, None, T(2024, 1, 6)), ("F", "late only", "Z", T(2024, 2, 1)), ("G", "at a run", None, T(2024, 1, 4, 12))]
    return rows


def repeated_snapshots(obs):
    snap = None
    for as_of in RUNS:
        best = dims.airline_best_rows(obs, as_of=as_of)
        snap = cut_lineage(dims.scd2_snapshot(best, "airline_iata", ["airline_name", "airline_icao"], as_of, existing=snap), "snap")
    return snap


def as_rows(df):
    return sorted(map(str, df.select("airline_iata", "airline_name", "airline_icao", *dims.SCD_COLUMNS).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_history_in_one_pass_equals_repeated_snapshots_on_any_split(spark, seed):
    rng = random.Random(seed)
    rows = observations(rng)
    run = dims.first_run("extracted_at", RUNS)
    want = as_rows(repeated_snapshots(spark.createDataFrame(rows, OBS)))
    assert len(want) > 6

    def steps(part):
        return dims.snapshot_steps(spark.createDataFrame(part, OBS), "airline_iata", dims.airline_step_rank(), run)

    whole = steps(rows)
    assert as_rows(dims.scd2_history(whole, "airline_iata", ["airline_name", "airline_icao"])) == want
    rng.shuffle(rows)  # three deliveries, each with late records
    merged = steps(rows[:10])
    for part in (rows[10:70], rows[70:]):
        merged = cut_lineage(dims.merge_steps(merged, steps(part), "airline_iata"), "steps")
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))
    assert as_rows(dims.scd2_history(merged, "airline_iata", ["airline_name", "airline_icao"])) == want


def test_a_late_record_splits_an_interval(spark):
    def steps(*rows):
        return dims.snapshot_steps(spark.createDataFrame(rows, OBS), "airline_iata", dims.airline_step_rank(), dims.day_end("extracted_at"))

    old = steps(("A", "one", "X", T(2024, 1, 1, 8)), ("A", "three", "X", T(2024, 1, 9, 8)))
    late = steps(("A", "two", "X", T(2024, 1, 5, 8)), ("A", None, "X", T(2024, 1, 6)))
    got = dims.scd2_history(dims.merge_steps(old, late, "airline_iata"), "airline_iata", ["airline_name", "airline_icao"])
    assert [(r.airline_name, r.dbt_valid_from.day, r.dbt_valid_to and r.dbt_valid_to.day) for r in got.orderBy("dbt_valid_from").collect()] == [
        ("one", 2, 6), ("two", 6, 10), ("three", 10, None)]


def test_day_end_is_the_next_midnight(spark):
    df = spark.createDataFrame([(T(2024, 1, 1),), (T(2024, 1, 1, 0, 0, 0, 1),), (T(2024, 1, 1, 23, 59, 59, 999999),), (None,)], "t timestamp_ntz")
    assert [r[0] for r in df.select(dims.day_end("t")).collect()] == [T(2024, 1, 1), T(2024, 1, 2), T(2024, 1, 2), None]


@pytest.mark.parametrize("bucket_days", [1, 3, 1000])
def test_asof_lookup_of_a_hot_key_with_many_versions(spark, bucket_days):
    rng = random.Random(3)
    starts = sorted({T(2024, 1, 1) + dt.timedelta(minutes=rng.randint(0, 40 * 1440)) for _ in range(400)})
    versions = [("hot", a, b, f"v{i}") for i, (a, b) in enumerate(zip(starts, [*starts[1:], None], strict=True))]
    versions += [("few", T(2023, 1, 1), T(2024, 1, 10), "old"), ("few", T(2024, 1, 10), None, "new"), ("closed", T(2023, 1, 1), T(2023, 6, 1), "gone"),
                 ("later", T(2030, 1, 1), None, "future"), ("turned", T(2024, 1, 9), T(2024, 1, 8), "inverted")]
    facts = [(i, rng.choice(["hot", "hot", "few", "closed", "later", "turned", "none", None]), T(2023, 12, 30) + dt.timedelta(minutes=rng.randint(0, 45 * 1440))) for i in range(3000)]
    facts += [(5000, "hot", None), (5001, "few", T(2024, 1, 10)), (5002, "hot", starts[7])]

    def valid(key, ts):
        return next((n for k, a, b, n in versions if key == k and ts and a <= ts and (b is None or ts < b)), None)

    f = spark.createDataFrame(facts, "id long, k string, ts timestamp_ntz")
    v = spark.createDataFrame(versions, "k string, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz, name string")
    out = asof_version_lookup(f, v, "k", "k", "ts", {"name": "asof"}, bucket_days=bucket_days)
    assert out.columns == ["id", "k", "ts", "asof"]
    assert sorted((r.id, r.asof) for r in out.collect()) == sorted((i, valid(k, ts)) for i, k, ts in facts)
    none = asof_version_lookup(f.limit(0), v, "k", "k", "ts", {"name": "asof"})
    assert none.count() == 0 and asof_version_lookup(f, v.limit(0), "k", "k", "ts", {"name": "asof"}).where("asof IS NOT NULL").count() == 0


def test_distinct_gates_from_merged_bitmaps(spark):
    rng = random.Random(8)
    rows = [(D(2024, 1, rng.randint(1, 28)), rng.choice([None, *"abcdefgh"]), rng.choice([None, *"ghijkl"])) for _ in range(300)] + [(None, "z", None), (D(2024, 2, 1), None, None)]
    schema = "flight_date date, gate_dep string, gate_arr string"
    parts = [spark.createDataFrame(rows[a:b], schema) for a, b in ((0, 40), (40, 200), (200, None))]
    known, days = None, None
    for p in parts:
        before = {} if known is None else {r.gate: r.number for r in known.collect()}
        known = cut_lineage(kpi.extend_dictionary(known, kpi.used_gates(p), "gate"), "numbers")
        now = {r.gate: r.number for r in known.collect()}
        assert sorted(now.values()) == list(range(1, len(now) + 1)) and before.items() <= now.items()  # dense, and numbers stay
        new = kpi.gate_days(p, known)
        days = new if days is None else kpi.merge_gate_days(days, new)
    capacity = spark.createDataFrame([(20,)], "gate_count int")
    for period in (F.col("flight_date"), F.date_trunc("week", "flight_date").cast("date").alias("w"), F.date_trunc("month", "flight_date").cast("date").alias("m")):
        got = {r[0]: r.gates_used for r in kpi.gate_share_by(days, period, capacity).collect()}
        gates = spark.createDataFrame(rows, schema).select(period.alias("p"), F.explode(F.array("gate_dep", "gate_arr")).alias("g")).where("g IS NOT NULL")
        assert got == {r.p: r.n for r in gates.groupBy("p").agg(F.count_distinct("g").alias("n")).collect()}


def test_gate_numbers_beyond_one_bitmap(spark):
    fact = spark.range(40_000).select(F.lit(D(2024, 1, 1)).alias("flight_date"), F.format_string("g%06d", "id").alias("gate_dep"), F.lit(None).cast("string").alias("gate_arr"))
    days = kpi.gate_days(fact, kpi.extend_dictionary(None, kpi.used_gates(fact), "gate"))
    assert days.count() == 2
    assert kpi.gate_share_by(days, F.col("flight_date"), spark.createDataFrame([(11,)], "gate_count int")).first().gates_used == 40_000
