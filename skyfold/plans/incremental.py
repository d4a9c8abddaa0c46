"""Incremental runs of the flight model.

A *run* takes the staging relation as it is at run time plus the stored
state of the previous run, and returns the new state:

* snapshots: SCD2 check strategy on the best airline / airport rows;
* ``fct_flights``: MERGE on ``flight_id`` of the operating, de-duplicated
  rows whose ``flight_date`` is within 3 days of the stored maximum,
  updating only the mutable columns;
* the four daily marts: DELETE+INSERT by their key columns of the days
  within 7 days of the stored maximum (or, with ``replace_window``, of the
  whole range of days).

Because ``flight_id`` hashes ``flight_date``, a merged key never leaves its
date: only the look-back dates of the fact are rewritten, and the rest of
the table passes through untouched (at scale: dynamic partition overwrite
of those dates only). Each state is checkpointed into the shared
checkpoint folder between runs, so a lost executor recomputes from the
stored state, never from the first batch. With a ``FlightStore`` a run
starts from what the last committed run has stored, in any process.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from skyfold.operators import dims, kpi
from skyfold.operators.enrich import flight_measures
from skyfold.operators.flatten import drop_variants
from skyfold.operators.joins import checked_broadcast
from skyfold.operators.materialize import (
    check_schema,
    delete_insert,
    delete_insert_window,
    high_water_mark,
    is_empty,
    merge_upsert,
    overwrite_partitions,
    table_exists,
    write_table,
)
from skyfold.plans.flights import (
    FACT_LOOKBACK_DAYS,
    FCT_COLUMNS,
    FCT_UPDATE_COLUMNS,
    MART_LOOKBACK_DAYS,
    FlightModel,
    operating_latest,
)
from skyfold.operators.zones import in_partitions, partitions_since, replace_partitions, zone_map
from skyfold.session import cut_lineage, fine_scans

#: Column whose range in every ``flight_date`` partition the zone maps keep.
ZONE_COLUMN = "actual_operation_date"


@dataclass
class FlightState:
    dim_airlines: DataFrame
    dim_airports: DataFrame
    fct_flights: DataFrame
    marts: dict[str, DataFrame]
    airline_best: DataFrame
    airport_best: DataFrame
    as_of: str
    fact_mark: dt.date | None  # largest flight_date of the fact
    fact_zones: DataFrame | None = None  # zone map of the fact's partitions (with a store)
    fact_counts: DataFrame | None = None  # partial counts of the fact (with a store that keeps them)

    @property
    def daily_airport_summary(self) -> DataFrame:
        return self.marts["daily_airport_summary"]


@dataclass(frozen=True)
class Mart:
    """A daily mart: key columns (the first is the day), and whether it reads
    the fact or every staging row."""

    keys: tuple[str, ...]
    of_fact: bool
    not_null: tuple[str, ...]


MARTS = {
    "daily_airport_summary": Mart(("flight_date",), True, ()),
    "daily_airport_operations": Mart(("actual_operation_date",), True, ("actual_operation_date",)),
    "daily_airline_summary": Mart(("flight_date", "airline_iata"), False, ("airline_iata",)),
    "daily_airline_operations": Mart(
        ("actual_operation_date", "airline_iata"), False, ("actual_operation_date", "airline_iata")
    ),
}


#: Keys of the partial counts kept with a store: finer than every mart that is rolled up from them.
FACT_COUNT_KEYS = ("flight_date", "actual_operation_date")
STAGING_COUNT_KEYS = ("flight_date", "actual_operation_date", "airline_iata")


class SnapshotModel(FlightModel):
    """Flight model whose dimensions are the current snapshot versions."""

    def __init__(self, stg: DataFrame, airlines_snapshot: DataFrame, airports_snapshot: DataFrame):
        super().__init__(stg.sparkSession, stg)
        self._airlines = checked_broadcast(
            dims.current_versions(airlines_snapshot).select("airline_iata", "airline_name", "airline_icao")
        )
        self._airports = checked_broadcast(
            dims.current_versions(airports_snapshot).select("airport_iata", "airport_name")
        )

    @property
    def airlines(self) -> DataFrame:  # type: ignore[override]
        return self._airlines

    @property
    def airports(self) -> DataFrame:  # type: ignore[override]
        return self._airports


AIRLINE_OBS = ["airline_iata", "airline_name", "airline_icao", "extracted_at"]
AIRPORT_OBS = ["airport_iata", "airport_name", "extracted_at"]


def best_observations(stg: DataFrame, as_of: str, previous: FlightState | None,
                      new_rows: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Best airline / airport observation per key, with its extract time.

    The ranking is a total order, so the best of all history equals the
    best of (previous best ∪ new rows): with ``new_rows`` a run reads only
    the new rows and the small previous best, never the whole history."""
    only_new = new_rows is not None and previous is not None
    src = (new_rows if only_new else stg).where(F.col("extracted_at") <= F.lit(as_of).cast("timestamp_ntz"))
    air = src.where(F.col("airline_iata").isNotNull()).select(*AIRLINE_OBS)
    apt = dims.airport_observations(src).select(*AIRPORT_OBS)
    if only_new:
        air = air.unionByName(previous.airline_best)
        apt = apt.unionByName(previous.airport_best)
    air_best = dims.top1_per_key(air, ["airline_iata"], dims.airline_rank())
    apt_best = dims.top1_per_key(apt, ["airport_iata"], dims.airport_rank())
    return air_best, apt_best


def snapshot_dims(stg: DataFrame, as_of: str, previous: FlightState | None,
                  best: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Run both SCD2 snapshots at ``as_of`` (before enrichment, D25)."""
    if best is not None:
        air_src = best[0].select("airline_iata", "airline_name", "airline_icao")
        apt_src = best[1].select("airport_iata", "airport_name")
    else:
        air_src, apt_src = dims.airline_best_rows(stg, as_of=as_of), dims.airport_best_rows(stg, as_of=as_of)
    airlines = dims.scd2_snapshot(
        air_src,
        "airline_iata",
        ["airline_name", "airline_icao"],
        as_of,
        existing=previous.dim_airlines if previous else None,
    )
    airports = dims.scd2_snapshot(
        apt_src,
        "airport_iata",
        ["airport_name"],
        as_of,
        existing=previous.dim_airports if previous else None,
    )
    return airlines, airports


def lookback_start(mark: dt.date | None) -> Column:
    """First date that a merge touches (NULL, so none, without dated rows)."""
    return F.date_sub(F.lit(mark).cast("date"), FACT_LOOKBACK_DAYS)


def fact_rows(model: FlightModel, mark: dt.date | None) -> DataFrame:
    """New fact rows of the 3-day look-back."""
    stg = drop_variants(model.stg).where(F.col("flight_date") >= lookback_start(mark))
    return model.enrich(operating_latest(stg)).select(*FCT_COLUMNS)


def merge_fact_window(target: DataFrame, rows: DataFrame, mark: dt.date | None) -> DataFrame:
    """MERGE restricted to the look-back dates of the target: the merged
    rows of every date >= max(flight_date) - 3 (flight_id determines
    flight_date, so no key of ``rows`` lives in an older date)."""
    window = target.where(F.col("flight_date") >= lookback_start(mark))
    return merge_upsert(window, rows, ["flight_id"], FCT_UPDATE_COLUMNS)


def merge_fact(target: DataFrame, rows: DataFrame, mark: dt.date | None) -> DataFrame:
    """Whole new fact: older dates and undated rows pass through, look-back
    dates are merged."""
    inside = F.coalesce(F.col("flight_date") >= lookback_start(mark), F.lit(False))
    return target.where(~inside).unionByName(merge_fact_window(target, rows, mark))


def mart_rows(mart: Mart, model: FlightModel, fact: DataFrame, since: Column | None, zones: DataFrame | None = None) -> DataFrame:
    """Rows of a mart, since a day. Marts by ``flight_date`` prune partitions
    by that filter; the others read the partitions that ``zones`` names."""
    src = fact if mart.of_fact else model.measured
    day = mart.keys[0]
    if since is not None and zones is not None and day == ZONE_COLUMN:
        src = in_partitions(src, "flight_date", partitions_since(zones, "flight_date", day, since))
    for c in mart.not_null:
        src = src.where(F.col(c).isNotNull())
    if since is not None:
        src = src.where(F.col(day) >= since)
    return kpi.flight_kpis(src, list(mart.keys))


def mart_table(mart: Mart, model: FlightModel, fact: DataFrame, target: DataFrame | None, replace_window: bool,
               zones: DataFrame | None = None) -> DataFrame:
    """New state of a mart; an absent or empty target is a first build.
    ``zones``: zone map of the table that the mart reads."""
    if target is None or is_empty(target):
        return mart_rows(mart, model, fact, None)
    day = mart.keys[0]
    since = F.date_sub(high_water_mark(target, day), MART_LOOKBACK_DAYS)
    batch = mart_rows(mart, model, fact, since, zones)
    check_schema(batch, target)
    if replace_window:
        return delete_insert_window(target, batch, day, since)
    return delete_insert(target, batch, list(mart.keys))


class FlightStore:
    """Physical tables of the incremental model under ``root``.

    Every run writes new version folders (``<table>/v<run>``) and, as its
    last step, appends one row to the ``commits`` table; readers and the next
    run see the tables of the last committed run only, so an attempt that
    fails changes nothing and its number is used again. ``fct_flights`` is
    partitioned by ``flight_date``: an incremental run rewrites only the
    look-back dates of the current version (dynamic partition overwrite of a
    checkpointed slice, so the write never reads its own target); the
    look-back starts at the *committed* mark, so a repeated attempt merges
    the same dates again. A full refresh writes a new version. One run at a
    time.
    """

    SMALL = ("dim_airlines", "dim_airports", "airline_best", "airport_best", "fact_zones", *MARTS)
    COMMIT = "run long, fact_run long, as_of string, fact_mark date"

    def __init__(self, spark, root: str, keep_counts: bool = False, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_counts = keep_counts
        self.buckets = buckets

    def last_commit(self) -> Row | None:
        path = f"{self.root}/commits"
        if not table_exists(self.spark, path):
            return None
        return self.spark.read.schema(self.COMMIT).parquet(path).orderBy(F.desc("run")).first()

    def commit(self, run: int, fact_run: int, as_of: str, fact_mark: dt.date | None) -> None:
        row = self.spark.createDataFrame([(run, fact_run, as_of, fact_mark)], self.COMMIT)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def load(self) -> FlightState | None:
        """State after the last committed run; None before the first one."""
        last = self.last_commit()
        if last is None:
            return None
        names = [*self.SMALL, "fact_counts"] if self.keep_counts else self.SMALL
        small = {name: self.spark.read.parquet(self.path(name, last.run)) for name in names}
        marts = {name: small.pop(name) for name in MARTS}
        return FlightState(fct_flights=self.read_fact(last.fact_run), marts=marts, as_of=last.as_of, fact_mark=last.fact_mark, **small)

    def path(self, name: str, run: int) -> str:
        return f"{self.root}/{name}/v{run:05d}"

    def write(self, df: DataFrame, name: str, run: int) -> DataFrame:
        write_table(df, self.path(name, run))
        return self.spark.read.parquet(self.path(name, run))

    def fact_path(self, run: int) -> str:
        return self.path("fct_flights" if not self.buckets else f"fct_flights_{self.buckets}", run)

    def bucketed_fact(self, run: int, like: DataFrame | None = None) -> str:
        """Name of the bucketed fact in this session's catalog; ``like`` gives
        the columns of a table that is not there yet."""
        path = self.fact_path(run)
        name = "skyfold_fact_" + hashlib.md5(path.encode()).hexdigest()
        if not self.spark.catalog.tableExists(name):
            schema = (like or self.spark.read.parquet(path)).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (flight_date) "
                f"CLUSTERED BY (flight_id) SORTED BY (flight_id) INTO {self.buckets} BUCKETS LOCATION '{path}'"
            )
            if like is None:
                self.spark.catalog.recoverPartitions(name)
        return name

    def read_fact(self, run: int) -> DataFrame:
        if self.buckets:
            return self.spark.table(self.bucketed_fact(run)).select(*FCT_COLUMNS)
        return self.spark.read.parquet(self.fact_path(run)).select(*FCT_COLUMNS)

    def _insert_buckets(self, df: DataFrame, run: int, like: DataFrame | None = None) -> None:
        """Replaces the dates of ``df``: one file for each date and bucket."""
        name = self.bucketed_fact(run, like)
        rows = df.repartition(self.buckets, "flight_id").select(*self.spark.table(name).columns)
        # an insert into a catalog table takes the mode from the session, not from the writer
        conf, mode = self.spark.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(mode)
        conf.set(mode, "dynamic")
        try:
            rows.write.mode("overwrite").insertInto(name)
        finally:
            conf.set(mode, before)

    def write_fact(self, df: DataFrame, run: int) -> DataFrame:
        if self.buckets:
            self._insert_buckets(df, run, like=df)
        else:
            write_table(by_date(df), self.fact_path(run), ["flight_date"])
        return self.read_fact(run)

    def write_fact_dates(self, df: DataFrame, run: int) -> DataFrame:
        if self.buckets:
            self._insert_buckets(df, run)
        else:
            overwrite_partitions(by_date(df), self.fact_path(run), ["flight_date"])
        return self.read_fact(run)

    @property
    def staging_path(self) -> str:
        return f"{self.root}/stg_flights"

    def append_staging(self, stg_batch: DataFrame, batch_id: int) -> DataFrame:
        """Append flattened rows, partitioned by (flight_date, batch_id).

        The look-back reads of later runs prune by ``flight_date``; a
        retried batch replaces exactly its own partitions (dynamic
        overwrite), so the append is idempotent. VARIANT columns are kept.
        """
        rows = stg_batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        with fine_scans(self.spark):
            overwrite_partitions(by_date(rows), self.staging_path, ["flight_date", "batch_id"])
            stored = self.spark.read.parquet(self.staging_path).where(F.col("batch_id") == batch_id)
            measured = flight_measures(drop_variants(stored))
            self._write_of_batch(zone_map(measured, "flight_date", [ZONE_COLUMN]), self.staging_zones_path, batch_id)
            if self.keep_counts:
                self._write_of_batch(kpi.partial_counts(measured, STAGING_COUNT_KEYS), self.staging_counts_path, batch_id)
        return stored.drop("batch_id")

    def _write_of_batch(self, df: DataFrame, path: str, batch_id: int) -> None:
        overwrite_partitions(df.withColumn("batch_id", F.lit(batch_id).cast("long")), path, ["batch_id"])

    def read_staging(self) -> DataFrame:
        return self.spark.read.parquet(self.staging_path).drop("batch_id")

    @property
    def staging_zones_path(self) -> str:
        return f"{self.root}/stg_zones"

    def read_staging_zones(self) -> DataFrame:
        """Zone map of the stored staging table: one row for each date and
        batch."""
        return self.spark.read.parquet(self.staging_zones_path).drop("batch_id")


    @property
    def staging_counts_path(self) -> str:
        return f"{self.root}/stg_counts"

    def read_staging_counts(self) -> DataFrame:
        return self.spark.read.parquet(self.staging_counts_path).drop("batch_id")


def by_date(df: DataFrame) -> DataFrame:
    """Rows of a date together before a partitioned write; AQE splits a hot
    date, and joins small ones, by size."""
    return df.hint("rebalance", F.col("flight_date"))


def run(
    stg: DataFrame | None,
    as_of: str,
    previous: FlightState | None = None,
    full_refresh: bool = False,
    store: FlightStore | None = None,
    new_rows: DataFrame | None = None,
    replace_window: bool = False,
) -> FlightState:
    """One scheduled run over the staging relation as of ``as_of`` (or as of
    the last run, if that was later).

    With a ``store`` the run starts from its last committed state, and the
    tables are written there (the production path); without, it starts from
    ``previous`` and each state is cut from its lineage into the checkpoint
    folder. ``stg`` None reads the store's own staging table, of which the
    marts by day of operation read the partitions that its zone map names.
    """
    with fine_scans(store.spark if stg is None else stg.sparkSession):
        return _run(stg, as_of, previous, full_refresh, store, new_rows, replace_window)


def _run(
    stg: DataFrame | None,
    as_of: str,
    previous: FlightState | None,
    full_refresh: bool,
    store: FlightStore | None,
    new_rows: DataFrame | None,
    replace_window: bool,
) -> FlightState:
    stg_zones = None
    if stg is None:
        stg, stg_zones = store.read_staging(), store.read_staging_zones()
    last = store.last_commit() if store else None
    if store:
        previous = store.load()
    prev = None if full_refresh else previous
    number = last.run + 1 if last else 1
    if prev is not None:
        as_of = max(as_of, prev.as_of)

    def keep(df: DataFrame, name: str) -> DataFrame:
        return store.write(df, name, number) if store else cut_lineage(df, name)

    best = best_observations(stg, as_of, prev, new_rows)
    best = keep(best[0], "airline_best"), keep(best[1], "airport_best")
    airlines, airports = snapshot_dims(stg, as_of, prev, best)
    airlines, airports = keep(airlines, "dim_airlines"), keep(airports, "dim_airports")
    model = SnapshotModel(stg, airlines, airports)

    first = prev is None or is_empty(prev.fct_flights)  # D21: empty target = first build
    fact_run = number if first or last is None else last.fact_run
    if first:
        fact = model.fact.select(*FCT_COLUMNS)
        fact = store.write_fact(fact, number) if store else cut_lineage(fact, "fct_flights")
        newest = fact
    else:
        rows = fact_rows(model, prev.fact_mark)
        check_schema(rows, prev.fct_flights)  # on_schema_change='fail'
        if store:
            newest = cut_lineage(merge_fact_window(prev.fct_flights, rows, prev.fact_mark), "fct_window")
            fact = store.write_fact_dates(newest, fact_run)
        else:
            newest = fact = cut_lineage(merge_fact(prev.fct_flights, rows, prev.fact_mark), "fct_flights")
    mark = newest.agg(F.max("flight_date")).first()[0]  # one value, of the rows just written
    if prev is not None and prev.fact_mark is not None:
        mark = max(mark or prev.fact_mark, prev.fact_mark)

    fact_zones = None
    if store:
        fact_zones = zone_map(newest, "flight_date", [ZONE_COLUMN])
        if not first:
            fact_zones = replace_partitions(prev.fact_zones, fact_zones, "flight_date")
        fact_zones = keep(fact_zones, "fact_zones")
    fact_counts = None
    if store and store.keep_counts:
        fact_counts = kpi.partial_counts(newest, FACT_COUNT_KEYS)
        if not first:
            fact_counts = replace_partitions(prev.fact_counts, fact_counts, "flight_date")
        fact_counts = keep(fact_counts, "fact_counts")

    def mart_now(name: str, mart: Mart) -> DataFrame:
        if fact_counts is not None:
            counts = fact_counts if mart.of_fact else store.read_staging_counts()
            return kpi.roll_up(counts.na.drop(subset=list(mart.not_null)) if mart.not_null else counts, mart.keys)
        zones = fact_zones if mart.of_fact else stg_zones
        return mart_table(mart, model, fact, prev.marts[name] if prev else None, replace_window, zones)

    marts = {name: keep(mart_now(name, mart), name) for name, mart in MARTS.items()}
    if store:
        store.commit(number, fact_run, as_of, mark)
    return FlightState(airlines, airports, fact, marts, best[0], best[1], as_of, mark, fact_zones, fact_counts)
