"""Incremental landing-file ingest with Structured Streaming.

``readStream`` over the top-level ``*.json`` entries of the landing folder,
``Trigger.AvailableNow`` so a scheduled run drains what is pending and
stops. The checkpoint remembers which files were loaded (a second run over
the same files adds nothing, S7). ``cleanSource=archive`` moves loaded
files to the archive folder after they are committed (S6; Spark archives a
file once the *next* micro-batch commits). Each micro-batch is written
idempotently by ``foreachBatch``: good rows append to the raw table under
a ``batch_id`` folder that a retried batch overwrites, unparsable lines
go to a reject table, and the ledger counts both for every file.

What happened is counted twice, independently: ``DataFrame.observe`` counts
the rows while the raw table is written, and the *outcome ledger*, written
with the batch, has good and rejected lines of every landing file. Files
without any line (or blank lines only) leave no trace in the ledger.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from skyfold.operators.materialize import table_exists
from skyfold.sources.landing import UNKNOWN_DIRECTION, file_outcomes, landing_file, landing_glob, split_rejects, to_raw


@dataclass(frozen=True)
class IngestResult:
    """What a run loaded: micro-batches, rows and lines as observed while
    they were written."""

    batches: int
    loaded_rows: int
    rejected_rows: int


def landing_stream(spark: SparkSession, landing_dir: str, target_airport: str, now: Column | None = None,
                   archive_dir: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(landing_glob(landing_dir)).select("value", "_metadata")
    return to_raw(lines, target_airport, now)


def file_ledger(batch: DataFrame, ledger_path: str, batch_id: int, skip_redelivered: bool) -> DataFrame:
    """Outcomes of a micro-batch's files, and whether each is a re-delivery:
    the same lines, direction and extract time as a file of an earlier batch,
    or of this one (the first name counts). Where the name gives no extract
    time, the lines alone decide."""
    files = file_outcomes(batch)
    if not skip_redelivered:
        return files.withColumn("redelivered", F.lit(False))
    spark = batch.sparkSession
    stamp = F.when(F.col("direction") != UNKNOWN_DIRECTION, F.col("extracted_at"))
    files = files.withColumn("_stamp", stamp)
    same = ["direction", "_stamp", "content"]
    again = F.row_number().over(Window.partitionBy(*same).orderBy("file")) > 1
    if table_exists(spark, ledger_path):
        # the batch is the folder's name: a retried batch does not meet its own first try
        earlier = spark.read.parquet(ledger_path).where((F.col("batch_id") < batch_id) & ~F.col("redelivered")).withColumn("_stamp", stamp)
        known = earlier.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(same)], F.lit(True).alias("_known")).distinct()
        match = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(same)]
        files = files.join(known, match[0] & match[1] & match[2], "left")
        again = again | F.col("_known").isNotNull()
    return files.withColumn("redelivered", again).select("file", "direction", "extracted_at", "good_rows", "rejected_rows", "content", "redelivered")


def write_ledger(batch: DataFrame, ledger_path: str | None, batch_id: int, skip_redelivered: bool = False) -> DataFrame:
    """Writes the ledger of a micro-batch to a folder that a retried batch
    overwrites; returns the batch without re-delivered files."""
    if not ledger_path:
        return batch
    path = f"{ledger_path}/batch_id={batch_id}"
    file_ledger(batch, ledger_path, batch_id, skip_redelivered).write.mode("overwrite").parquet(path)
    if not skip_redelivered:
        return batch
    gone = batch.sparkSession.read.parquet(path).where("redelivered").select(F.col("file").alias("_file"))
    return batch.join(gone, "_file", "left_anti")


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """One row for each landing file, over all batches and physical files:
    landing_file, direction, extracted_at, good_rows, rejected_rows, status
    (``loaded``: every line; ``partial``; ``failed``: none; ``redelivered``:
    nothing, since its files were loaded before under another name)."""
    files = spark.read.parquet(ledger_path).withColumn("landing_file", landing_file(F.col("file")))
    counts = [F.sum(F.when(F.col("redelivered"), 0).otherwise(F.col(n))).alias(n) for n in ("good_rows", "rejected_rows")]
    sums = files.groupBy("landing_file", "direction", "extracted_at").agg(*counts, F.bool_and("redelivered").alias("_again"))
    good, bad = F.col("good_rows"), F.col("rejected_rows")
    status = F.when(F.col("_again"), "redelivered").when(good == 0, "failed").when(bad == 0, "loaded").otherwise("partial")
    return sums.withColumn("status", status).drop("_again")


def _batch_writer(raw_path: str, reject_path: str | None, ledger_path: str | None, skip_redelivered: bool,
                  done: dict[int, dict]) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        # several sinks: parse the micro-batch once (persist), write all, release
        batch = batch.persist()
        try:
            new = write_ledger(batch, ledger_path, batch_id, skip_redelivered)
            seen = Observation()
            parsed = F.col("raw_json").isNotNull()
            counted = new.observe(seen, F.count_if(parsed).alias("good"), F.count_if(~parsed).alias("bad"))
            good, _ = split_rejects(counted)
            good.write.mode("overwrite").parquet(f"{raw_path}/batch_id={batch_id}")
            if reject_path:
                _, bad = split_rejects(new)
                bad.write.mode("overwrite").parquet(f"{reject_path}/batch_id={batch_id}")
            done[batch_id] = seen.get
        finally:
            batch.unpersist()

    return write


def ingest_available(
    spark: SparkSession,
    landing_dir: str,
    raw_path: str,
    checkpoint: str,
    target_airport: str,
    reject_path: str | None = None,
    archive_dir: str | None = None,
    now: Column | None = None,
    max_files_per_trigger: int | None = None,
    ledger_path: str | None = None,
    skip_redelivered: bool = False,
) -> IngestResult:
    """Drain pending landing files into the raw table; returns what the run
    loaded and rejected. ``ledger_path``: where the outcomes of every file
    go (see ``read_ledger``); with ``skip_redelivered``, a file that the
    ledger knows under another name adds nothing. (De-duplicating records in
    the state store would also drop lines that a file truly holds twice.)"""
    stream = landing_stream(spark, landing_dir, target_airport, now, archive_dir, max_files_per_trigger)
    done: dict[int, dict] = {}
    q = (
        stream.writeStream.foreachBatch(_batch_writer(raw_path, reject_path, ledger_path, skip_redelivered, done))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return IngestResult(len(done), sum(x["good"] for x in done.values()), sum(x["bad"] for x in done.values()))


def read_raw(spark: SparkSession, raw_path: str) -> DataFrame:
    """The raw table written by ``ingest_available`` (all batches)."""
    return spark.read.parquet(raw_path).drop("batch_id")


def upsert_stream(
    spark: SparkSession,
    landing_dir: str,
    store,
    checkpoint: str,
    target_airport: str,
    reject_path: str | None = None,
    archive_dir: str | None = None,
    now: Column | None = None,
    max_files_per_trigger: int | None = None,
    ledger_path: str | None = None,
    skip_redelivered: bool = False,
):
    """One scheduled run: drain pending landing files into the incremental
    model (R2). Returns the stored state after the run. The state is read
    from the store for every micro-batch, so a run may start in a new
    process, and a micro-batch that is tried again continues from the last
    committed run.

    Each micro-batch is flattened and appended to the stored staging table
    (the reference's staging view covers all loaded records); the model
    then runs over the whole staging table: snapshots from incrementally
    maintained best rows, the fact MERGE limited to the 3-day look-back
    from the stored maximum date (records older than that are ignored: the
    data-driven counterpart of a watermark), and the summary delete+insert.
    """
    from skyfold.operators.flatten import flatten_flights
    from skyfold.plans import incremental

    several = bool(ledger_path or reject_path)  # a batch that only staging reads is parsed once anyway

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        if several:
            batch = batch.persist()
        try:
            good, bad = split_rejects(write_ledger(batch, ledger_path, batch_id, skip_redelivered))
            if reject_path:
                bad.write.mode("overwrite").parquet(f"{reject_path}/batch_id={batch_id}")
            stg_batch = store.append_staging(flatten_flights(good), batch_id)
        finally:
            if several:
                batch.unpersist()
        as_of = stg_batch.agg(F.max("extracted_at").cast("string")).first()[0]  # one scalar
        if as_of is None:
            return
        incremental.run(None, as_of, store=store, new_rows=stg_batch)

    stream = landing_stream(spark, landing_dir, target_airport, now, archive_dir, max_files_per_trigger)
    q = (
        stream.writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return store.load()
