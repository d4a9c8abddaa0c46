import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyfold.operators import dims, kpi
from skyfold.operators.dedupe import duplicate_groups, latest_per_key, top1_per_key
from skyfold.operators.joins import asof_version_lookup, checked_broadcast
from skyfold.operators.materialize import (
    SchemaChangeError,
    check_schema,
    delete_insert,
    incremental_state,
    merge_upsert,
)

T = dt.datetime


def test_latest_per_key_with_hot_key_and_ties(spark):
    rows = [(1, T(2024, 1, 1, 0, 0, i % 50), f"v{i}") for i in range(3000)]  # one hot key
    rows += [(2, T(2024, 1, 1), "a"), (2, T(2024, 1, 2), "b"), (3, None, "x"), (3, T(2024, 1, 1), "y")]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v string").repartition(8)
    got = {r.k: (r.ts, r.v) for r in latest_per_key(df, ["k"], "ts", total_order=True).collect()}
    assert got[2] == (T(2024, 1, 2), "b")
    assert got[3] == (T(2024, 1, 1), "y")  # NULL ranks lowest
    assert got[1][0] == T(2024, 1, 1, 0, 0, 49)
    # deterministic choice among ties, whatever the partitioning
    again = latest_per_key(df.repartition(3), ["k"], "ts", total_order=True).where("k = 1").first().v
    assert again == got[1][1]


def test_top1_non_null_first(spark):
    df = spark.createDataFrame(
        [("A1", None, "XA1", T(2024, 1, 5)), ("A1", "Air One", None, T(2024, 1, 1)), ("A1", "Air One", "XA1", T(2024, 1, 2))],
        "airline_iata string, airline_name string, airline_icao string, extracted_at timestamp_ntz",
    )
    r = dims.airline_best_rows(df).first()
    assert (r.airline_name, r.airline_icao) == ("Air One", "XA1")


def test_duplicate_groups(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c")], "k long, v string")
    got = {(r.k, r.frequency) for r in duplicate_groups(df, ["k", "v"]).collect()}
    assert got == {(None, 2), (1, 2)}  # NULL keys form one group, as in SQL GROUP BY


def _flights(spark, rows):
    return spark.createDataFrame(
        rows,
        "flight_date date, direction string, flight_status string, is_on_time_dep boolean, is_on_time_arr boolean,"
        " is_cancelled boolean, actual_dep timestamp_ntz, actual_arr timestamp_ntz",
    )


def test_kpis_status_edge_cases(spark):
    d = dt.date(2024, 1, 1)
    rows = [
        (d, "DEPARTURE", "Cancelled", None, None, True, None, None),  # D8: counted as actual
        (d, "DEPARTURE", None, None, None, False, None, None),  # D9: scheduled, not actual
        (d, "DEPARTURE", "landed", True, None, False, T(2024, 1, 1, 9), None),
        (d, "ARRIVAL", "cancelled", None, None, True, None, None),
        (d, "ARRIVAL", "landed", None, False, False, None, T(2024, 1, 1, 10)),
    ]
    r = kpi.flight_kpis(_flights(spark, rows), ["flight_date"]).first()
    assert r.total_scheduled == 5 and r.total_actual == 3
    assert (r.scheduled_dep, r.actual_dep, r.actual_arr) == (3, 2, 1)
    assert (r.on_time_dep, r.on_time_arr, r.cancelled_count) == (1, 0, 2)
    assert (r.dep_otp_pct, r.arr_otp_pct, r.cancellation_rate_pct) == (100.0, 0.0, 40.0)


def test_merge_updates_only_listed_columns_and_keeps_stored_nulls(spark):
    target = spark.createDataFrame([(1, "old", None), (2, "keep", "g2")], "id long, status string, gate string")
    source = spark.createDataFrame([(1, "new", "gX"), (3, "ins", "g3")], "id long, status string, gate string")
    got = {r.id: (r.status, r.gate) for r in merge_upsert(target, source, ["id"], ["status"]).collect()}
    assert got == {1: ("new", None), 2: ("keep", "g2"), 3: ("ins", "g3")}


def test_delete_insert_and_null_keys(spark):
    target = spark.createDataFrame([(1, 10), (2, 20), (None, 99)], "k long, v long")
    batch = spark.createDataFrame([(2, 21), (3, 30)], "k long, v long")
    got = sorted(delete_insert(target, batch, ["k"]).collect(), key=lambda r: (r.k is None, r.k))
    assert [(r.k, r.v) for r in got] == [(1, 10), (2, 21), (3, 30), (None, 99)]  # H10: NULL key stays


def test_incremental_first_build_on_empty_target_and_schema_guard(spark):
    empty = spark.createDataFrame([], "k long, v long")
    rows = spark.createDataFrame([(1, 1)], "k long, v long")
    out = incremental_state(empty, lambda t: rows, lambda t, r: t.unionByName(r))
    assert out.count() == 1  # D21
    with pytest.raises(SchemaChangeError):
        check_schema(rows.withColumn("x", F.lit(1)), rows)


def test_scd2_snapshot_lifecycle(spark):
    s1 = spark.createDataFrame([("A", "Air A"), ("B", "Air B")], "k string, name string")
    snap1 = dims.scd2_snapshot(s1, "k", ["name"], "2024-01-01 00:00:00")
    s2 = spark.createDataFrame([("A", "Air A2"), ("C", None)], "k string, name string")
    snap2 = dims.scd2_snapshot(s2, "k", ["name"], "2024-01-02 00:00:00", existing=snap1)
    rows = sorted((r.k, r.name, str(r.dbt_valid_from), str(r.dbt_valid_to)) for r in snap2.collect())
    assert rows == [
        ("A", "Air A", "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
        ("A", "Air A2", "2024-01-02 00:00:00", "None"),
        ("B", "Air B", "2024-01-01 00:00:00", "None"),  # missing key stays open
        ("C", None, "2024-01-02 00:00:00", "None"),
    ]
    assert snap2.select("dbt_scd_id").distinct().count() == 4  # D19
    # unchanged (NULL-safe) → nothing new
    snap3 = dims.scd2_snapshot(s2, "k", ["name"], "2024-01-03 00:00:00", existing=snap2)
    assert snap3.count() == 4
    # as-of lookup picks the version valid at the fact time
    facts = spark.createDataFrame(
        [("A", T(2024, 1, 1, 12)), ("A", T(2024, 1, 5)), ("B", T(2023, 12, 1))], "k string, ts timestamp_ntz"
    )
    got = sorted(
        (r.k, str(r.ts), r.v)
        for r in asof_version_lookup(facts, checked_broadcast(snap2), "k", "k", "ts", {"name": "v"}).collect()
    )
    assert got == [("A", "2024-01-01 12:00:00", "Air A"), ("A", "2024-01-05 00:00:00", "Air A2"),
                   ("B", "2023-12-01 00:00:00", None)]


def test_date_spine_half_open(spark):
    d = dims.date_dimension(spark)
    assert d.count() == 2556 == dims.date_dimension_rows()
    assert d.agg(F.max("date_id")).first()[0] == dt.date(2030, 12, 30)


def test_top1_explicit_rank(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b")], "k long, r long, v string")
    assert top1_per_key(df, ["k"], [F.col("r")]).first().v == "b"


def test_canonical_airline_lookup_keeps_row_count(spark):
    from skyfold.operators.joins import canonical_airline_lookup

    ref = spark.createDataFrame(
        [(2, "Air Two", "AC", "Canada", "Y"), (1, "Air One", "AC", "Canada", "Y"), (3, "Old Air", "AC", "X", "N"),
         (4, "Other", "UA", "US", "N")],
        "airline_id int, airline_name string, iata string, country string, active string",
    )
    flights = spark.createDataFrame([("f1", "AC"), ("f2", "AC"), ("f3", "UA"), ("f4", None)], "fid string, airline_iata string")
    got = {r.fid: (r.ref_airline_name, r.ref_country) for r in canonical_airline_lookup(flights, ref).collect()}
    assert got == {"f1": ("Air One", "Canada"), "f2": ("Air One", "Canada"), "f3": (None, None), "f4": (None, None)}


def test_sorted_write_orders_files(spark, tmp_dir):
    from skyfold.operators.materialize import write_table

    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    write_table(df, tmp_dir + "/t", sort_by=["k"], files=4)
    back = spark.read.parquet(tmp_dir + "/t")
    parts = back.withColumn("f", F.input_file_name()).groupBy("f").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    ranges = sorted((r.lo, r.hi) for r in parts.collect())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))  # range-partitioned: no overlap
    assert back.count() == 1000


def test_actual_operation_date_is_coalesce_of_local_dates(spark):  # D10, H1
    from skyfold.operators.enrich import flight_measures

    df = spark.createDataFrame(
        [(T(2024, 1, 1, 23, 50), T(2024, 1, 2, 1, 0), 5, 70, "landed"),
         (None, T(2024, 1, 3, 0, 10), None, 3, "landed"),
         (None, None, None, None, None)],
        "actual_dep timestamp_ntz, actual_arr timestamp_ntz, delay_dep long, delay_arr long, flight_status string",
    )
    rows = flight_measures(df).collect()
    assert [r.actual_operation_date for r in rows] == [dt.date(2024, 1, 1), dt.date(2024, 1, 3), None]
    assert [r.is_cancelled for r in rows] == [False, False, False]
    assert [(r.delay_bucket_dep, r.delay_bucket_arr) for r in rows] == [
        ("On Time", "60+ min"), (None, "On Time"), (None, None)]


def test_delete_insert_window_empties_lost_days(spark):  # D22
    from skyfold.operators.materialize import delete_insert_window

    d = dt.date
    target = spark.createDataFrame([(d(2024, 1, 1), 1), (d(2024, 1, 5), 5), (d(2024, 1, 6), 6)], "day date, n long")
    batch = spark.createDataFrame([(d(2024, 1, 6), 60)], "day date, n long")
    plain = sorted((r.day.day, r.n) for r in delete_insert(target, batch, ["day"]).collect())
    window = sorted((r.day.day, r.n) for r in delete_insert_window(target, batch, "day", F.lit("2024-01-04").cast("date")).collect())
    assert plain == [(1, 1), (5, 5), (6, 60)]  # reference behaviour: 01-05 keeps its stale row
    assert window == [(1, 1), (6, 60)]  # replace_window: the whole look-back range is replaced


def test_checked_broadcast_falls_back_above_bound(spark):
    import contextlib
    import io

    from skyfold.operators.joins import lookup

    facts = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id"))
    dim = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    hinted = lookup(facts, checked_broadcast(dim, max_rows=100, known_rows=7), "k", "k", {"v": "v"})
    above = lookup(facts, checked_broadcast(dim, max_rows=3, known_rows=7), "k", "k", {"v": "v"})
    unknown = lookup(facts, checked_broadcast(dim, max_rows=100), "k", "k", {"v": "v"})
    assert sorted(hinted.collect()) == sorted(above.collect()) == sorted(unknown.collect())

    def has_hint(df):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(True)
        return "strategy=broadcast" in buf.getvalue()

    assert [has_hint(df) for df in (hinted, above, unknown)] == [True, False, False]


def test_unexpected_values(spark):
    from skyfold.operators.quality import unexpected_values

    df = spark.createDataFrame([("landed",), ("Cancelled",), ("Cancelled",), (None,), ("",)], "s string")
    got = {(r.s, r.rows) for r in unexpected_values(df, "s", ["landed", ""]).collect()}
    assert got == {("Cancelled", 2)}


def test_scd2_late_run_never_inverts_an_interval(spark):
    from skyfold.operators.dims import scd2_snapshot

    def src(v):
        return spark.createDataFrame([("k", v)], "k string, v string")

    one = scd2_snapshot(src("a"), "k", ["v"], "2026-01-10 00:00:00")
    two = scd2_snapshot(src("b"), "k", ["v"], "2026-01-05 00:00:00", existing=one)
    rows = sorted(two.collect(), key=lambda r: r.dbt_valid_from)
    assert [r.v for r in rows] == ["a", "b"] and rows[0].dbt_valid_from < rows[0].dbt_valid_to == rows[1].dbt_valid_from
    assert rows[0].dbt_scd_id != rows[1].dbt_scd_id


def test_latest_row_of_ties_is_the_same_under_any_partitioning(spark):
    from skyfold.plans.flights import FCT_COLUMNS, FACT_TIE_BREAKERS, operating_latest

    cols = [*FACT_TIE_BREAKERS]
    rows = spark.range(400).select(
        F.lit("f").alias("flight_id"), F.lit("operating").alias("carrier_role"), F.lit(1).alias("extracted_at"),
        *[(F.concat(F.lit("g"), F.col("id") % 40) if c == "gate_dep" else F.lit("x")).alias(c) for c in cols],
    )
    got = {operating_latest(rows.repartition(n)).first().gate_dep for n in (1, 2, 3, 7)}
    assert got == {"g9"} and "gate_dep" in FCT_COLUMNS


def test_gate_heatmap_long_and_wide(spark):
    from skyfold.operators.kpi import gate_heatmap

    use = spark.createDataFrame([("1", "A", 2), ("1", "A", 3), ("1", None, 9), ("2", "B", 1)], "gate string, airline_iata string, total_flight_count long")
    assert {tuple(r) for r in gate_heatmap(use).collect()} == {("1", "A", 5), ("2", "B", 1)}
    assert {tuple(r) for r in gate_heatmap(use, ["A", "B", "C"]).collect()} == {("1", 5, None, None), ("2", None, 1, None)}
