"""Registered queries: name → (spark, sf_dir) → DataFrame.

Each query reads the driver tables (flights are derived from ``events``)
and runs over whole tables. Output columns are aliased to the names used
by the DuckDB oracle in ``skyfold.plans.oracle``.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyfold.functions.exprs import conditional_count, safe_pct
from skyfold.functions.keys import surrogate_key
from skyfold.operators import dims, kpi
from skyfold.operators.dedupe import duplicate_groups, latest_per_key
from skyfold.operators.flatten import drop_variants
from skyfold.operators.joins import checked_broadcast, lookup
from skyfold.plans import reports
from skyfold.plans.flights import FlightModel
from skyfold.session import ensure_parallelism
from skyfold.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


_MODELS: dict[tuple[str, str], FlightModel] = {}
_MODEL_LOCK = threading.Lock()


def _model(spark: SparkSession, sf_dir: str) -> FlightModel:
    """One model per Spark application and data folder. DataFrames are
    immutable lazy plans, so queries share the model's relations (the
    plan is built once); every action still executes the whole plan."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _MODEL_LOCK:
        if key not in _MODELS:
            _MODELS[key] = FlightModel.from_tables(spark, sf_dir)
        return _MODELS[key]


# -- staging, keys, dimensions ----------------------------------------------
def q_stg_flights(spark, sf_dir):
    return drop_variants(_model(spark, sf_dir).stg)


def q_surrogate_key_orders(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", surrogate_key("o_orderkey", "o_custkey", "o_orderdate").alias("order_sk"))


def q_dim_dates(spark, sf_dir):
    """Date dimension over the span of the flight dates."""
    stg = _model(spark, sf_dir).stg
    return dims.date_dimension_of(dims.date_spine_covering(stg, "flight_date"))


def q_dim_airlines_current(spark, sf_dir):
    return dims.airline_best_rows(_model(spark, sf_dir).stg)


def q_dim_airports_current(spark, sf_dir):
    return dims.airport_best_rows(_model(spark, sf_dir).stg)


# -- enrichment, fact, marts --------------------------------------------------
def q_flights_enriched(spark, sf_dir):
    return drop_variants(_model(spark, sf_dir).enriched)


def q_fct_flights(spark, sf_dir):
    return _model(spark, sf_dir).fact


def q_daily_airport_summary(spark, sf_dir):
    return _model(spark, sf_dir).daily_airport_summary


def q_daily_airport_operations(spark, sf_dir):
    return _model(spark, sf_dir).daily_airport_operations


def q_daily_airline_summary(spark, sf_dir):
    return _model(spark, sf_dir).daily_airline_summary


def q_daily_airline_operations(spark, sf_dir):
    return _model(spark, sf_dir).daily_airline_operations


def q_gate_usage_summary(spark, sf_dir):
    return _model(spark, sf_dir).gate_usage_summary


def q_gate_share(spark, sf_dir):
    return _model(spark, sf_dir).gate_share()


def q_gate_share_weekly(spark, sf_dir):
    """Distinct gates by week from stored daily bitmaps; departures and
    arrivals come as two deliveries, the second with gates of its own."""
    from skyfold.session import cut_lineage
    from skyfold.sources.seeds import gate_capacity

    fact = _model(spark, sf_dir).fact_measured
    known, days = None, None
    for part in ("DEPARTURE", "ARRIVAL"):
        rows = fact.where(F.col("direction") == part)
        known = cut_lineage(kpi.extend_dictionary(known, kpi.used_gates(rows), "gate"), "gate_numbers")
        new = kpi.gate_days(rows, known)
        days = cut_lineage(new if days is None else kpi.merge_gate_days(days, new), "gate_days")
    week = F.date_trunc("week", "flight_date").cast("date").alias("week_start")
    return kpi.gate_share_by(days, week, gate_capacity(spark))


def q_top_gates(spark, sf_dir):
    return kpi.top_gates(_model(spark, sf_dir).gate_usage_summary, 5)


def q_gate_heatmap(spark, sf_dir):
    return kpi.gate_heatmap(_model(spark, sf_dir).gate_usage_summary)


# -- presentation ------------------------------------------------------------
def q_kpi_tiles(spark, sf_dir):
    return kpi.kpi_tiles(_model(spark, sf_dir).fact_measured)


def q_kpi_tiles_airline(spark, sf_dir):
    measured = _model(spark, sf_dir).measured
    return kpi.kpi_tiles(measured.where(F.col("airline_iata").isNotNull()), ["airline_iata"])


def q_daily_volume(spark, sf_dir):
    return reports.daily_volume(_model(spark, sf_dir).daily_airport_summary)


def q_otp_trend(spark, sf_dir):
    return reports.otp_trend(_model(spark, sf_dir).daily_airport_summary)


def q_cancellation_trend(spark, sf_dir):
    return reports.cancellation_trend(_model(spark, sf_dir).daily_airport_summary)


def q_airline_picklist(spark, sf_dir):
    return reports.airline_picklist(_model(spark, sf_dir).daily_airline_summary)


# -- audits ------------------------------------------------------------------
def q_load_audit(spark, sf_dir):
    return reports.load_audit(_model(spark, sf_dir).raw)


def q_load_audit_runs(spark, sf_dir):
    return reports.load_audit_runs(_model(spark, sf_dir).raw)


def q_duplicate_flights(spark, sf_dir):
    return reports.duplicate_flights(_model(spark, sf_dir).raw)


def q_duplicate_detail(spark, sf_dir):
    return reports.duplicate_detail(_model(spark, sf_dir).raw)


AUDIT_DAY, AUDIT_FLIGHT = "2024-01-17", "A1101"


def q_load_audit_day(spark, sf_dir):
    """Records of one extract day (F8)."""
    return reports.load_audit(_model(spark, sf_dir).raw, as_of=AUDIT_DAY)


def q_duplicate_flights_day(spark, sf_dir):
    return reports.duplicate_flights(_model(spark, sf_dir).raw, as_of=AUDIT_DAY)


def q_duplicate_detail_flight(spark, sf_dir):
    """Raw rows of one duplicated flight, newest first."""
    return reports.duplicate_detail(_model(spark, sf_dir).raw, flight_iata=AUDIT_FLIGHT)


def q_staging_freshness(spark, sf_dir):
    """Age of the newest extract."""
    from skyfold.operators.quality import freshness

    return freshness(_model(spark, sf_dir).stg, "extracted_at", "2024-02-01 00:00:00", 24)


# -- the same operators on non-flight tables --------------------------------
def q_lineitem_latest(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], "l_shipdate", F.col("l_partkey"), F.col("l_suppkey"))


def q_lineitem_duplicates(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return duplicate_groups(li, ["l_orderkey", "l_linenumber"], "frequency")


def q_lineitem_sorted(spark, sf_dir):
    """Line items stored in the order of their ship dates (O1), read back
    with the number of rows that begin before the file before ends."""
    from skyfold.operators.materialize import write_table
    from skyfold.session import scratch_path

    path = scratch_path(spark, "lineitem_sorted")
    write_table(read_table(spark, sf_dir, "lineitem"), path, sort_by=["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"])
    rows = spark.read.parquet(path).select("l_shipdate", F.col("_metadata.file_path").alias("file"))
    ranges = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    before = F.max("last").over(Window.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1))  # one row for each file
    return ranges.withColumn("before", before).agg(
        F.sum("n").alias("rows"), F.min("first").alias("first_day"), F.max("last").alias("last_day"), F.count_if(F.col("first") < F.col("before")).alias("overlaps")
    )


def q_customer_geo(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    nation = checked_broadcast(read_table(spark, sf_dir, "nation"))
    region = checked_broadcast(read_table(spark, sf_dir, "region"))
    out = lookup(c, nation, "c_nationkey", "n_nationkey", {"n_name": "n_name", "n_regionkey": "n_regionkey"})
    out = lookup(out, region, "n_regionkey", "r_regionkey", {"r_name": "r_name"})
    return out.select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name")


def q_orders_status_rollup(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    urgent = conditional_count(F.col("o_orderpriority") == "1-URGENT")
    total = F.count(F.lit(1))
    return o.groupBy("o_orderstatus").agg(
        total.alias("order_count"),
        urgent.alias("urgent_count"),
        conditional_count(F.col("o_totalprice") > 100000).alias("large_count"),
        safe_pct(urgent, total).alias("urgent_pct"),
    )


# -- incremental runs, snapshots, as-of lookup ------------------------------
BATCH1_BEFORE = "2024-01-20 00:00:00"
RUN1_AS_OF = "2024-01-19 23:59:59"
RUN2_AS_OF = "2024-01-30 23:59:59"
SNAPSHOT_AS_OF = ("2024-01-15 23:59:59", "2024-01-30 23:59:59")


def _two_run_store(spark, sf_dir, **options):
    """A store after two runs: extracts before 2024-01-20, then the rest.
    Each run opens the store as a process of its own would."""
    from skyfold.plans.incremental import FlightStore, run
    from skyfold.session import scratch_path

    stg = _model(spark, sf_dir).stg
    root = scratch_path(spark, "warehouse")
    first = F.col("extracted_at") < F.lit(BATCH1_BEFORE).cast("timestamp_ntz")
    for number, (batch, as_of) in enumerate(((stg.where(first), RUN1_AS_OF), (stg.where(~first), RUN2_AS_OF)), 1):
        store = FlightStore(spark, root, **options)
        store.append_staging(batch, number)
        run(None, as_of, store=store)
    return FlightStore(spark, root, **options)


def _two_runs(spark, sf_dir):
    return _two_run_store(spark, sf_dir).load()


def q_fct_flights_two_batches(spark, sf_dir):
    return _two_runs(spark, sf_dir).fct_flights


def q_fct_flights_bucketed_two_batches(spark, sf_dir):
    """The same two merges into a fact bucketed by flight."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _two_run_store(spark, sf_dir, buckets=buckets).load().fct_flights


def q_daily_summary_two_batches(spark, sf_dir):
    return _two_runs(spark, sf_dir).daily_airport_summary


def q_daily_airport_operations_two_batches(spark, sf_dir):
    return _two_runs(spark, sf_dir).marts["daily_airport_operations"]


def q_daily_airline_summary_two_batches(spark, sf_dir):
    return _two_runs(spark, sf_dir).marts["daily_airline_summary"]


def q_daily_airline_operations_two_batches(spark, sf_dir):
    return _two_runs(spark, sf_dir).marts["daily_airline_operations"]


def q_daily_summary_replaced_window(spark, sf_dir):
    """Like ``daily_summary_two_batches``, with the whole look-back range of
    days replaced (D22), so that a day without rows would disappear."""
    from skyfold.plans.incremental import FlightStore, run
    from skyfold.session import scratch_path

    stg = _model(spark, sf_dir).stg
    store = FlightStore(spark, scratch_path(spark, "warehouse"))
    first = F.col("extracted_at") < F.lit(BATCH1_BEFORE).cast("timestamp_ntz")
    run(stg.where(first), RUN1_AS_OF, store=store)
    return run(stg, RUN2_AS_OF, store=store, replace_window=True).daily_airport_summary


def q_daily_airport_operations_counted(spark, sf_dir):
    """The mart after two runs of a store that keeps partial counts: equal to
    a rebuild from the stored fact, whatever the age of a change."""
    return _two_run_store(spark, sf_dir, keep_counts=True).load().marts["daily_airport_operations"]


def q_daily_airline_operations_counted(spark, sf_dir):
    return _two_run_store(spark, sf_dir, keep_counts=True).load().marts["daily_airline_operations"]


def q_rerun_diff(spark, sf_dir):
    """What two incremental runs leave different from a full refresh of the
    same staging rows: late records outside the look-back, and columns that a
    merge does not update (T11)."""
    from skyfold.operators.diff import diff_tables
    from skyfold.plans.incremental import run

    store = _two_run_store(spark, sf_dir)
    incremental = store.load().fct_flights
    rebuilt = run(None, RUN2_AS_OF, store=store, full_refresh=True).fct_flights
    return diff_tables(incremental, rebuilt, ["flight_id"], ["flight_date"])


def _airline_snapshots(stg):
    from skyfold.session import cut_lineage

    snap = None
    for as_of in SNAPSHOT_AS_OF:
        src = dims.airline_best_rows(stg, as_of=as_of)
        snap = cut_lineage(
            dims.scd2_snapshot(src, "airline_iata", ["airline_name", "airline_icao"], as_of, existing=snap), "dim_airlines"
        )
    return snap


def q_airline_scd2(spark, sf_dir):
    return _airline_snapshots(_model(spark, sf_dir).stg)


def q_airport_scd2(spark, sf_dir):
    from skyfold.session import cut_lineage

    stg = _model(spark, sf_dir).stg
    snap = None
    for as_of in SNAPSHOT_AS_OF:
        src = dims.airport_best_rows(stg, as_of=as_of)
        snap = cut_lineage(dims.scd2_snapshot(src, "airport_iata", ["airport_name"], as_of, existing=snap), "dim_airports")
    return snap


def q_airline_scd2_history(spark, sf_dir):
    """All versions of the airlines over daily runs, in one pass. The records
    arrive in two parts that interleave in time (extracts of even and odd
    minutes), so the second part is full of late records."""
    from skyfold.session import cut_lineage

    stg = _model(spark, sf_dir).stg
    rank, run = dims.airline_step_rank(), dims.day_end("extracted_at")
    even = F.minute("extracted_at") % 2 == 0
    one, two = (dims.snapshot_steps(stg.where(part), "airline_iata", rank, run) for part in (even, ~even))
    steps = dims.merge_steps(cut_lineage(one, "airline_steps"), two, "airline_iata")
    return dims.scd2_history(steps, "airline_iata", ["airline_name", "airline_icao"])


def q_flights_asof_airline(spark, sf_dir):
    from skyfold.operators.joins import asof_version_lookup

    stg = _model(spark, sf_dir).stg
    versions = checked_broadcast(_airline_snapshots(stg))
    facts = stg.select("flight_id", "extracted_at", "airline_iata")
    return asof_version_lookup(
        facts, versions, "airline_iata", "airline_iata", "extracted_at",
        {"airline_name": "asof_airline_name", "airline_icao": "asof_airline_icao"},
    )


def q_quality_report(spark, sf_dir):
    """The data-test suite over every table of the model, as one plan: each
    table's row checks are one aggregation, and Spark reuses the shuffles of
    the shared enriched / fact relations across the checks (measured faster
    than materializing them first)."""
    from skyfold.plans.checks import flight_suite
    from skyfold.sources.seeds import gate_capacity

    m = _model(spark, sf_dir)
    enriched = drop_variants(m.enriched)
    fact = m.fact
    frames = {
        "stg_flights": drop_variants(m.stg),
        "dim_dates": dims.date_dimension(spark),
        "int_flights_enriched": enriched,
        "fct_flights": fact,
        "gate_usage_summary": kpi.gate_usage_summary(enriched),
        "daily_airport_summary": kpi.flight_kpis(fact, ["flight_date"]),
        "daily_airport_operations": kpi.flight_kpis(fact, ["actual_operation_date"], not_null_keys=True),
        "daily_airline_summary": kpi.flight_kpis(enriched.where(F.col("airline_iata").isNotNull()),
                                                 ["flight_date", "airline_iata"]),
        "daily_airline_operations": kpi.flight_kpis(enriched, ["actual_operation_date", "airline_iata"],
                                                    not_null_keys=True),
        "dim_airlines": _airline_snapshots(m.stg),
        "dim_airports": q_airport_scd2(spark, sf_dir),
        "gate_capacity": gate_capacity(spark),
        "airline_reference": _airline_reference(spark, sf_dir),
    }
    return flight_suite().run(frames)


# -- ingest and seeds ----------------------------------------------------------
def q_ingest_stream(spark, sf_dir):
    """Events → landing folders (one per direction and extract day) →
    streaming ingest (availableNow, archive, checkpoint) → staging rows."""
    from skyfold.session import scratch_path
    from skyfold.sources.fixtures import raw_json_text_from_events
    from skyfold.sources.landing import write_landing
    from skyfold.streaming.ingest import ingest_available, read_raw
    from skyfold.operators.flatten import flatten_flights

    base = scratch_path(spark, "ingest")
    records = raw_json_text_from_events(ensure_parallelism(read_table(spark, sf_dir, "events"))).withColumn(
        "extracted_at", F.date_trunc("day", "extracted_at").cast("timestamp_ntz")
    )
    write_landing(records, f"{base}/landing")
    ingest_available(
        spark, f"{base}/landing", f"{base}/raw", f"{base}/_checkpoint", "HUB",
        reject_path=f"{base}/rejects", archive_dir=f"{base}/archive",
    )
    return drop_variants(flatten_flights(read_raw(spark, f"{base}/raw")))


def q_ingest_ledger(spark, sf_dir):
    """Good and rejected lines of every landing file (S6), from the ledger
    that the streaming ingest writes. Lines extracted in minute 7 of an hour,
    and all arrivals of 5 January, are cut short before they land."""
    from skyfold.session import scratch_path
    from skyfold.sources.fixtures import raw_json_text_from_events
    from skyfold.sources.landing import write_landing
    from skyfold.streaming.ingest import ingest_available, read_ledger

    base = scratch_path(spark, "ingest_ledger")
    records = raw_json_text_from_events(ensure_parallelism(read_table(spark, sf_dir, "events")))
    day = F.date_trunc("day", "extracted_at").cast("timestamp_ntz")
    whole_file = (F.col("direction") == "ARRIVAL") & (F.to_date("extracted_at") == F.lit("2024-01-05").cast("date"))
    text = F.when(whole_file | (F.minute("extracted_at") == 7), F.left("json_text", F.lit(40))).otherwise(F.col("json_text"))
    write_landing(records.select(text.alias("json_text"), "direction", day.alias("extracted_at")), f"{base}/landing")
    ingest_available(
        spark, f"{base}/landing", f"{base}/raw", f"{base}/_checkpoint", "HUB", reject_path=f"{base}/rejects", ledger_path=f"{base}/ledger",
    )
    return read_ledger(spark, f"{base}/ledger")


def q_ingest_redelivered(spark, sf_dir):
    """Staging rows when every file of arrivals is delivered a second time
    under another name, and departures of one day a third time within the
    same run (R2): each record is staged once."""
    from skyfold.operators.flatten import flatten_flights
    from skyfold.session import cut_lineage, scratch_path
    from skyfold.sources.fixtures import raw_json_text_from_events
    from skyfold.sources.landing import landing_name
    from skyfold.streaming.ingest import ingest_available, read_raw

    base = scratch_path(spark, "ingest_redelivered")
    records = raw_json_text_from_events(ensure_parallelism(read_table(spark, sf_dir, "events")))
    name = landing_name(F.col("direction"), F.date_trunc("day", "extracted_at"))
    files = cut_lineage(records.select("direction", "extracted_at", F.col("json_text").alias("value"), name.alias("file")), "deliveries")

    def deliver(rows, way: str) -> None:
        rows.select("value", F.col("file").alias(way)).repartition(way).write.mode("append").partitionBy(way).text(f"{base}/landing")

    def drain() -> None:
        ingest_available(spark, f"{base}/landing", f"{base}/raw", f"{base}/_checkpoint", "HUB", ledger_path=f"{base}/ledger", skip_redelivered=True)

    deliver(files, "first")
    deliver(files.where((F.col("direction") == "DEPARTURE") & (F.to_date("extracted_at") == F.lit("2024-01-09").cast("date"))), "same_run")
    drain()
    deliver(files.where(F.col("direction") == "ARRIVAL"), "second")
    drain()
    return drop_variants(flatten_flights(read_raw(spark, f"{base}/raw")))


def _airline_reference(spark, sf_dir):
    """Airline reference file written from the observed airlines (with
    sentinels and a malformed 7-column line per airline), read back and
    cleaned (S10)."""
    from skyfold.session import scratch_path
    from skyfold.sources.seeds import read_airline_reference

    best = dims.airline_best_rows(_model(spark, sf_dir).stg)
    airline_id = F.ascii(F.substring("airline_iata", 1, 1)) * 100 + F.substring("airline_iata", 2, 8).try_cast("int")
    good = F.concat_ws(
        ",", airline_id.cast("string"), F.concat(F.lit('"'), F.coalesce("airline_name", F.lit("\\N")), F.lit('"')),
        F.lit("\\N"), F.col("airline_iata"), F.coalesce("airline_icao", F.lit("-")), F.lit(" - "),
        F.lit('"Country, Land"'), F.when(F.col("airline_iata").startswith("A"), "y").otherwise("n"),
    )
    bad = F.concat_ws(",", airline_id.cast("string"), F.col("airline_iata"), F.lit("x"), F.lit("x"), F.lit("x"),
                      F.lit("x"), F.lit("x"))
    lines = best.select(F.explode(F.array(good, bad)).alias("value"))
    path = scratch_path(spark, "airline_reference")
    lines.write.text(path)
    return read_airline_reference(spark, path)


def q_airline_reference(spark, sf_dir):
    return _airline_reference(spark, sf_dir)


def q_airline_canonical(spark, sf_dir):
    """Flights with the canonical airline of the reference seed."""
    from skyfold.operators.joins import canonical_airline_lookup

    flights = _model(spark, sf_dir).stg.select("flight_id", "extracted_at", "airline_iata")
    return canonical_airline_lookup(flights, _airline_reference(spark, sf_dir))


def q_unexpected_statuses(spark, sf_dir):
    """Status values outside the accepted list, with counts."""
    from skyfold.operators.quality import unexpected_values
    from skyfold.plans.checks import STATUSES

    return unexpected_values(_model(spark, sf_dir).stg, "flight_status", STATUSES)


def q_stream_upsert(spark, sf_dir):
    """Two scheduled runs of the streaming upsert (R2): extracts before
    2024-01-20 land and are drained, then the rest. Extract times come
    from the landing names (one per direction and day)."""
    from skyfold.plans.incremental import FlightStore
    from skyfold.session import scratch_path
    from skyfold.sources.fixtures import raw_json_text_from_events
    from skyfold.sources.landing import write_landing
    from skyfold.streaming.ingest import upsert_stream

    base = scratch_path(spark, "stream_upsert")
    records = raw_json_text_from_events(ensure_parallelism(read_table(spark, sf_dir, "events")))
    first = F.col("extracted_at") < F.lit(BATCH1_BEFORE).cast("timestamp_ntz")
    day = F.date_trunc("day", "extracted_at").cast("timestamp_ntz")
    for batch in (records.where(first), records.where(~first)):  # two scheduled runs
        write_landing(batch.withColumn("extracted_at", day), f"{base}/landing")
        store = FlightStore(spark, f"{base}/warehouse")  # a new process opens the store again
        state = upsert_stream(spark, f"{base}/landing", store, f"{base}/_checkpoint", "HUB")
    return state.fct_flights


QUERIES: dict[str, Query] = {
    "stg_flights": q_stg_flights,
    "surrogate_key_orders": q_surrogate_key_orders,
    "dim_dates": q_dim_dates,
    "dim_airlines_current": q_dim_airlines_current,
    "dim_airports_current": q_dim_airports_current,
    "flights_enriched": q_flights_enriched,
    "fct_flights": q_fct_flights,
    "daily_airport_summary": q_daily_airport_summary,
    "daily_airport_operations": q_daily_airport_operations,
    "daily_airline_summary": q_daily_airline_summary,
    "daily_airline_operations": q_daily_airline_operations,
    "gate_usage_summary": q_gate_usage_summary,
    "gate_share": q_gate_share,
    "gate_share_weekly": q_gate_share_weekly,
    "top_gates": q_top_gates,
    "gate_heatmap": q_gate_heatmap,
    "kpi_tiles": q_kpi_tiles,
    "kpi_tiles_airline": q_kpi_tiles_airline,
    "daily_volume": q_daily_volume,
    "otp_trend": q_otp_trend,
    "cancellation_trend": q_cancellation_trend,
    "airline_picklist": q_airline_picklist,
    "load_audit": q_load_audit,
    "load_audit_runs": q_load_audit_runs,
    "duplicate_flights": q_duplicate_flights,
    "duplicate_detail": q_duplicate_detail,
    "load_audit_day": q_load_audit_day,
    "duplicate_flights_day": q_duplicate_flights_day,
    "duplicate_detail_flight": q_duplicate_detail_flight,
    "staging_freshness": q_staging_freshness,
    "lineitem_latest": q_lineitem_latest,
    "lineitem_duplicates": q_lineitem_duplicates,
    "lineitem_sorted": q_lineitem_sorted,
    "customer_geo": q_customer_geo,
    "orders_status_rollup": q_orders_status_rollup,
    "fct_flights_two_batches": q_fct_flights_two_batches,
    "fct_flights_bucketed_two_batches": q_fct_flights_bucketed_two_batches,
    "daily_summary_two_batches": q_daily_summary_two_batches,
    "daily_airport_operations_two_batches": q_daily_airport_operations_two_batches,
    "daily_airline_summary_two_batches": q_daily_airline_summary_two_batches,
    "daily_airline_operations_two_batches": q_daily_airline_operations_two_batches,
    "daily_summary_replaced_window": q_daily_summary_replaced_window,
    "daily_airport_operations_counted": q_daily_airport_operations_counted,
    "daily_airline_operations_counted": q_daily_airline_operations_counted,
    "rerun_diff": q_rerun_diff,
    "airline_scd2": q_airline_scd2,
    "airport_scd2": q_airport_scd2,
    "airline_scd2_history": q_airline_scd2_history,
    "flights_asof_airline": q_flights_asof_airline,
    "quality_report": q_quality_report,
    "ingest_stream": q_ingest_stream,
    "ingest_ledger": q_ingest_ledger,
    "ingest_redelivered": q_ingest_redelivered,
    "airline_reference": q_airline_reference,
    "airline_canonical": q_airline_canonical,
    "unexpected_statuses": q_unexpected_statuses,
    "stream_upsert": q_stream_upsert,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
