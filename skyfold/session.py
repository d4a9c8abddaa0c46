"""Session helpers: a local session for tests / bench, and the shared
checkpoint folder that cuts lineage between incremental steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Settings for a large cluster (100 TB inputs, ~1000 executors). They are
# recommendations for the cluster's own session builder, not applied here.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "skyfold") -> SparkSession:
    """Session used by tests and bench.py. On a cluster, build the session
    with the cluster's own settings instead; nothing here is required."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_CHECKPOINT_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read
    (SparkContext applies it at start-up). Where it is unset, a cluster
    session is refused; a local one (tests) gets
    a private folder under the system temp directory is created once per
    SparkContext and registered with ``setCheckpointDir``.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    if sc.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    key = sc.applicationId
    if key not in _LOCAL_CHECKPOINT_DIRS:
        path = tempfile.mkdtemp(prefix="skyfold-ckpt-")
        sc.setCheckpointDir(path)
        _LOCAL_CHECKPOINT_DIRS[key] = path
    return _LOCAL_CHECKPOINT_DIRS[key]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and
    read it back: the lineage is cut with one job (``Dataset.checkpoint``
    would compute an unpersisted plan twice), the result survives lost
    executors, and later readers get file statistics. Never a local
    checkpoint."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


#: Rows that one task takes from a source whose rows are expanded (one event becomes a JSON record).
ROWS_A_TASK = 100_000


def ensure_parallelism(df: DataFrame, minimum: int | None = None, rows: int = ROWS_A_TASK) -> DataFrame:
    """Round-robin ``df`` over as many partitions as the cluster's default
    parallelism has tasks, and as leave at most ``rows`` rows to each, so that
    a task does not grow with the source. A source that is dealt out like that
    is returned unchanged (no shuffle). Rows are counted by partition (parquet
    footers only): splits of a file without a row group of their own are
    empty, however many there are."""
    want = minimum or df.sparkSession.sparkContext.defaultParallelism
    counts = df.groupBy(F.spark_partition_id().alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    used, most, total = counts.agg(F.count(F.lit(1)), F.max("_n"), F.sum("_n")).first()
    if used >= want and most <= rows:
        return df
    return df.repartition(max(want, -(-(total or 0) // rows)))


#: Stored bytes that one task takes from a table whose rows are unpacked or sorted, and the number of
#: tasks from which on Spark gives each of them more instead.
SCAN_BYTES, SCAN_TASKS = 8 << 20, 10_000


@contextmanager
def fine_scans(spark: SparkSession) -> Iterator[None]:
    """Jobs inside read small splits. Spark deals files out to as many tasks
    as there are cores, up to ``spark.sql.files.maxPartitionBytes`` each, so
    the longest task grows with the input until then; compressed JSON records
    of that size are over a million."""
    wanted = {"spark.sql.files.maxPartitionBytes": f"{SCAN_BYTES}b", "spark.sql.files.maxPartitionNum": str(SCAN_TASKS)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
