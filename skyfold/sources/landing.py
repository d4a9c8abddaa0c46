"""Landing files: NDJSON flight records named
``flights_{departure|arrival}_{YYYYMMDD}_{HHMMSS}.json`` (S1-S5, S8).

A landing *file* is either a single NDJSON file dropped into the landing
folder (as the extractor of the reference does) or a folder of that name
written by Spark (``write_landing``: one ``partitionBy`` folder per extract
run, since Spark writers cannot name their part files). Readers take only
the top level (``landing/*.json``), so ``archive/`` and other sub-folders
are ignored; the name of the file, else of its parent folder, gives the
direction and extract time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Landing file-name convention of the reference loader
# (matched case-insensitively: names are lower-cased before matching).
NAME_PATTERN = r"^(?:[^=/]*=)?flights_(departure|arrival)_(\d{8})_(\d{6})\.json"
UNKNOWN_DIRECTION = "UNKNOWN"

RAW_SCHEMA = "raw_json VARIANT, extracted_at TIMESTAMP_NTZ, direction STRING, target_airport STRING"


def with_landing_metadata(df: DataFrame, path_col: Column, now: Column | None = None) -> DataFrame:
    """Add ``direction`` and ``extracted_at`` parsed from a landing path.

    Case-insensitive; direction upper-cased; the timestamp is assembled from
    the two digit groups. No match → (``UNKNOWN``, ``now``), where ``now``
    defaults to the local current timestamp (pass one in for tests, H9).
    Written as stacked projections so that each regular expression runs
    once per row (a nested expression would re-evaluate them per use).
    """
    now_col = (now if now is not None else F.localtimestamp()).cast("timestamp_ntz")
    step = df.withColumns(
        {
            "_name": F.lower(F.substring_index(path_col, "/", -1)),
            "_parent": F.lower(F.substring_index(F.substring_index(path_col, "/", -2), "/", 1)),
        }
    )
    step = step.withColumn("_seg", F.when(F.col("_name").rlike(NAME_PATTERN), F.col("_name")).otherwise(F.col("_parent")))
    step = step.withColumns(
        {
            "_dir": F.regexp_extract("_seg", NAME_PATTERN, 1),
            "_stamp": F.concat(F.regexp_extract("_seg", NAME_PATTERN, 2), F.regexp_extract("_seg", NAME_PATTERN, 3)),
        }
    )
    step = step.withColumn("_ts", F.try_to_timestamp(F.col("_stamp"), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz"))
    matched = F.col("_dir") != ""
    return step.withColumns(
        {
            "direction": F.when(matched, F.upper("_dir")).otherwise(F.lit(UNKNOWN_DIRECTION)),
            "extracted_at": F.when(matched & F.col("_ts").isNotNull(), F.col("_ts")).otherwise(now_col),
        }
    ).drop("_name", "_parent", "_seg", "_dir", "_stamp", "_ts")


def to_raw(lines: DataFrame, target_airport: str, now: Column | None = None) -> DataFrame:
    """Text lines + ``_metadata`` → raw rows (S1, S3). Unparsable JSON gives
    a NULL ``raw_json``; blank lines are dropped."""
    tagged = with_landing_metadata(
        lines.where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("_path")),
        F.col("_path"),
        now,
    )
    return tagged.select(
        F.try_parse_json("value").alias("raw_json"),
        "extracted_at",
        "direction",
        F.lit(target_airport).alias("target_airport"),
        F.col("value").alias("_line"),
        F.col("_path").alias("_file"),
    )


def landing_glob(landing_dir: str) -> str:
    return f"{landing_dir.rstrip('/')}/*.json"


def read_landing(spark: SparkSession, landing_dir: str, target_airport: str, now: Column | None = None) -> DataFrame:
    """Batch scan of the pending landing files (S1, S5). A missing folder
    or no ``*.json`` entry gives an empty raw table."""
    try:
        lines = spark.read.text(landing_glob(landing_dir)).select("value", "_metadata")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RAW_SCHEMA + ", _line STRING, _file STRING")
    return to_raw(lines, target_airport, now)


def split_rejects(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good raw rows, rejected lines) by whether the JSON parsed."""
    good = raw.where(F.col("raw_json").isNotNull()).drop("_line", "_file")
    bad = raw.where(F.col("raw_json").isNull()).select(
        F.col("_line").alias("line"), "extracted_at", "direction", "target_airport"
    )
    return good, bad


def landing_file(path_col: Column) -> Column:
    """The landing file that a physical file belongs to: itself, or the
    folder of that name that Spark wrote. ``<column>=`` in front of a
    folder's name is left out."""
    name, parent = F.substring_index(path_col, "/", -1), F.substring_index(F.substring_index(path_col, "/", -2), "/", 1)
    is_part = ~F.lower(name).rlike(NAME_PATTERN) & F.lower(parent).rlike(NAME_PATTERN)
    return F.regexp_replace(F.when(is_part, parent).otherwise(name), "^[^=/]*=", "")


def file_outcomes(raw: DataFrame) -> DataFrame:
    """(file, direction, extracted_at, good_rows, rejected_rows, content) of
    every physical file of raw rows: one partial aggregation, so a large file
    is one row for each task that read it. ``content`` is an order-free
    digest of the lines: files with the same lines have the same."""
    parsed = F.col("raw_json").isNotNull()
    line = F.xxhash64("_line")
    sums = F.sum(line.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(line, 32))
    content = F.concat_ws("-", F.count(F.lit(1)), F.hex(F.bit_xor(line)), *sums)
    counts = F.count_if(parsed).alias("good_rows"), F.count_if(~parsed).alias("rejected_rows"), content.alias("content")
    return raw.groupBy(F.col("_file").alias("file"), "direction", "extracted_at").agg(*counts)


def landing_name(direction: Column, extracted_at: Column) -> Column:
    """``flights_{direction}_{YYYYMMDD}_{HHMMSS}.json``."""
    return F.concat(
        F.lit("flights_"), F.lower(direction), F.lit("_"), F.date_format(extracted_at, "yyyyMMdd_HHmmss"), F.lit(".json")
    )


def write_landing(records: DataFrame, landing_dir: str, json_col: str = "json_text") -> None:
    """Write NDJSON records, one landing folder per (direction, extract
    time) (S8). ``records`` has ``json_col``, ``direction``, ``extracted_at``.

    The rebalance lets AQE split a large extract over as many tasks as its
    size asks for (many part files in its folder) and join small ones.
    """
    out = records.select(
        landing_name(F.col("direction"), F.col("extracted_at")).alias("landing_file"),
        F.col(json_col).alias("value"),
    )
    (
        out.hint("rebalance", F.col("landing_file"))
        .write.mode("append")
        .partitionBy("landing_file")
        .text(landing_dir)
    )


def load_landing(
    spark: SparkSession,
    landing_dir: str,
    raw_path: str,
    target_airport: str,
    reject_path: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Batch load of the pending landing files: append the parsed rows to
    the raw table (S4) and unparsable lines to the reject table. Returns
    the appended raw rows (read back from the appended files is not
    possible, so the caller re-reads ``raw_path`` for the whole table).
    Use the streaming ingest for load-once bookkeeping and archiving."""
    raw = read_landing(spark, landing_dir, target_airport, now).persist()
    try:
        good, bad = split_rejects(raw)
        good.write.mode("append").parquet(raw_path)
        if reject_path:
            bad.write.mode("append").parquet(reject_path)
        return good
    finally:
        raw.unpersist()
