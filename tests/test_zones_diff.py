"""Zone maps and table comparison."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skyfold.operators import diff, zones
from skyfold.plans import incremental
from skyfold.plans.flights import FlightModel
from skyfold.session import scratch_path
from test_plans import plan

SF = "/root/testdata/sf0.001"
D = dt.date


def test_zone_map_names_every_partition_that_can_hold_a_row(spark):
    rng = random.Random(4)
    rows = [(D(2024, 1, rng.randint(1, 20)) if rng.random() < 0.9 else None, D(2024, 1, rng.randint(1, 28)) if rng.random() < 0.7 else None) for _ in range(200)]
    rows += [(D(2024, 2, 1), None)]
    df = spark.createDataFrame(rows, "p date, c date")
    zm = zones.zone_map(df, "p", ["c"])
    for day in (1, 15, 27, 28):
        since = F.lit(D(2024, 1, day))
        names = zones.partitions_since(zm, "p", "c", since)
        assert set(names) == {p for p, c in rows if c and c >= D(2024, 1, day)}
        kept = zones.in_partitions(df, "p", names).where(F.col("c") >= since)
        assert sorted(map(str, kept.collect())) == sorted(map(str, df.where(F.col("c") >= since).collect()))
    again = spark.createDataFrame([(None, D(2030, 1, 1)), (D(2024, 3, 1), D(2024, 3, 2))], "p date, c date")
    now = {r.p: r.c_hi for r in zones.replace_partitions(zm, zones.zone_map(again, "p", ["c"]), "p").collect()}
    assert now[None] == D(2030, 1, 1) and now[D(2024, 3, 1)] == D(2024, 3, 2) and len(now) == len({p for p, _ in rows}) + 1


@pytest.fixture(scope="module")
def two_states(spark):
    """A store after two runs, its staging rows, and the marts' starts."""
    stg = FlightModel.from_tables(spark, SF).stg
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    store = incremental.FlightStore(spark, scratch_path(spark, "zones"))
    store.append_staging(stg.where(F.col("extracted_at") < cut), 1)
    incremental.run(None, "2024-01-19 23:59:59", store=store)
    store.append_staging(stg.where(F.col("extracted_at") >= cut), 2)
    return store, incremental.run(None, "2024-01-30 23:59:59", store=store)


@pytest.mark.parametrize("name", ["daily_airport_operations", "daily_airline_operations"])
def test_marts_by_day_of_operation_read_named_partitions_only(spark, two_states, name):
    store, state = two_states
    mart = incremental.MARTS[name]
    model = FlightModel(spark, store.read_staging())
    table_zones = state.fact_zones if mart.of_fact else store.read_staging_zones()
    since = F.lit(D(2024, 1, 28))
    pruned = incremental.mart_rows(mart, model, state.fct_flights, since, table_zones)
    filters = [ln for ln in plan(pruned).splitlines() if "PartitionFilters" in ln]
    assert filters and all("flight_date" in ln and "PartitionFilters: []" not in ln for ln in filters)
    whole = incremental.mart_rows(mart, model, state.fct_flights, since)
    assert sorted(map(str, pruned.collect())) == sorted(map(str, whole.collect())) and pruned.count() > 0
    names = zones.partitions_since(table_zones, "flight_date", "actual_operation_date", since)
    assert 0 < len(names) < state.fct_flights.select("flight_date").distinct().count()


def test_fact_zones_describe_the_stored_fact(two_states):
    store, state = two_states
    now = zones.zone_map(store.load().fct_flights, "flight_date", ["actual_operation_date"])
    assert sorted(map(str, now.collect())) == sorted(map(str, state.fact_zones.collect()))


SCHEMA = "p int, k long, a string, b double"


def diff_brute(before, after):
    """Multiset difference by key, in plain Python."""
    from collections import Counter

    b, a = Counter(before), Counter(after)
    gone, new = b - a, a - b
    out = {}
    for key in {r[1] for r in [*gone, *new]}:
        g = [r for r in gone.elements() if r[1] == key]
        n = [r for r in new.elements() if r[1] == key]
        names = ",".join(c for i, c in enumerate("p k a b".split()) if c != "k" and g[0][i] != n[0][i]) if len(g) == len(n) == 1 else None
        out[key] = ("added" if not g else "removed" if not n else "changed", len(g), len(n), names)
    return out


@pytest.mark.parametrize("named", [10_000, 0])
def test_diff_equals_plain_python(spark, monkeypatch, named):
    monkeypatch.setattr(diff, "NAMED_PARTITIONS", named)
    rng = random.Random(9)
    before = [(rng.choice([1, 2, 3, None]), k, rng.choice([None, "", "x"]), rng.choice([None, 0.5])) for k in range(60)]
    before += [(5, None, "null key", 1.0), (1, 7, "twice", 1.0), (1, 7, "twice", 1.0), (9, 500, None, None)]
    after = [r for r in before if r[1] != 3] + [(4, 100, "new", None), (1, 7, "twice", 1.0)]
    after = [(r[0], r[1], "changed", r[3]) if r[1] == 11 else (6, r[1], None, r[3]) if r[1] == 12 else r for r in after]
    after = [(r[0], r[1], "", None) if r[1] == 500 else r for r in after]  # NULL is not the empty string
    rng.shuffle(after)
    got = diff.diff_tables(spark.createDataFrame(before, SCHEMA), spark.createDataFrame(after, SCHEMA), ["k"], ["p"]).collect()
    assert {r.k: (r.change, r.rows_before, r.rows_after, r.changed_columns) for r in got} == diff_brute(before, after)


def test_digests_see_moved_nulls_and_ignore_order(spark):
    one = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, 2.0), (1, 2, None, 2.0)], SCHEMA)
    two = spark.createDataFrame([(1, 2, None, 2.0), (1, 1, "a", None), (1, 2, None, 2.0)], SCHEMA).repartition(3)
    assert diff.changed_partitions(one, two, ["p"]).count() == 0
    three = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, 2.0), (1, 3, None, 2.0)], SCHEMA)
    assert [tuple(r) for r in diff.changed_partitions(one, three, ["p"]).collect()] == [(1, 3, 3)]
    swapped = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    hashes = swapped.select(diff.row_hash(["a", "b"]).alias("h")).collect()
    assert hashes[0].h != hashes[1].h
    with pytest.raises(ValueError):
        diff.diff_tables(one, one.drop("b"), ["k"], ["p"])


def test_rerun_is_idempotent_by_digest(spark, two_states):
    """The same run again leaves every table as it was."""
    store, _ = two_states
    before = store.load()
    after = incremental.run(None, "2024-01-30 23:59:59", store=store)
    assert diff.diff_tables(before.dim_airlines, after.dim_airlines, ["airline_iata", "dbt_valid_from"], ["airline_iata"]).count() == 0
    for name, x in before.marts.items():
        keys = list(incremental.MARTS[name].keys)
        assert diff.diff_tables(x, after.marts[name], keys, keys[:1]).count() == 0, name


def test_only_differing_partitions_are_read_row_by_row(spark, tmp_path):
    base = spark.range(300).select((F.col("id") % 10).cast("int").alias("p"), F.col("id").alias("k"), F.lit("v").alias("a"))
    base.write.partitionBy("p").parquet(str(tmp_path / "one"))
    base.withColumn("a", F.when(F.col("k") == 13, "w").otherwise(F.col("a"))).write.partitionBy("p").parquet(str(tmp_path / "two"))
    out = diff.diff_tables(spark.read.parquet(str(tmp_path / "one")), spark.read.parquet(str(tmp_path / "two")), ["k"], ["p"])
    assert [tuple(r) for r in out.collect()] == [(13, "changed", 1, 1, "a")]
    filters = [ln for ln in plan(out).splitlines() if "PartitionFilters" in ln]
    assert len(filters) >= 2 and all("3" in ln and "PartitionFilters: []" not in ln for ln in filters)


@pytest.mark.parametrize("batches", [("2024-01-10", "2024-01-20")])
def test_marts_from_partial_counts_equal_a_rebuild_after_three_runs(spark, batches):
    """The third batch is late by more than a mart's look-back."""
    from skyfold.operators import kpi

    stg = FlightModel.from_tables(spark, SF).stg
    late = F.col("flight_date") < F.lit(D(2024, 1, 5))
    cuts = [F.lit(f"{b} 00:00:00").cast("timestamp_ntz") for b in batches]
    parts = [~late & (F.col("extracted_at") < cuts[0]), ~late & (F.col("extracted_at") >= cuts[0]), late]
    root = scratch_path(spark, "counts")
    for number, part in enumerate(parts, 1):
        store = incremental.FlightStore(spark, root, keep_counts=True)
        store.append_staging(stg.where(part), number)
        if number == 2:
            store.append_staging(stg.where(part), number)  # a retried batch replaces itself
        state = incremental.run(None, "2024-01-30 23:59:59", store=store)
    measured = FlightModel(spark, store.read_staging()).measured
    rebuilt = {
        "daily_airport_summary": kpi.flight_kpis(state.fct_flights, ["flight_date"]),
        "daily_airport_operations": kpi.flight_kpis(state.fct_flights, ["actual_operation_date"], not_null_keys=True),
        "daily_airline_summary": kpi.flight_kpis(measured.where("airline_iata IS NOT NULL"), ["flight_date", "airline_iata"]),
        "daily_airline_operations": kpi.flight_kpis(measured, ["actual_operation_date", "airline_iata"], not_null_keys=True),
    }
    for name, want in rebuilt.items():
        keys = list(incremental.MARTS[name].keys)
        assert state.marts[name].schema == store.load().marts[name].schema and state.marts[name].columns == want.columns
        assert diff.diff_tables(state.marts[name], want, keys, keys[:1]).count() == 0, name
    assert measured.where(late).count() > 0
