"""Sharding by longest-processing-time scheduling (law ``bytes``).

Documents with equal texts form a group that stays in one shard. The groups
are scheduled largest first, each to the shard with the least load so far,
taken from a heap.

At any corpus size the schedule itself is small. Groups that weigh at least
``1 / (shards * fine)`` of the whole are jobs of their own; there are at most
``shards * fine`` of them. All lighter groups are dealt by hash over
``shards * bundles_per_shard`` bundles, and a bundle is one job. So the
driver orders a bounded number of jobs, whatever the input, and shard sizes
differ by about one bundle. A group heavier than a shard's fair share fills
its shard alone; nothing is split or dropped.

Rows never move to be sharded: a row's job follows from its text's hash, and
the job's shard is a broadcast of bounded size. Slots are numbered in two
steps (rows within hash cells of a shard, then the cells' offsets), so no
task numbers a whole shard.

Null texts count as empty. Equal 64-bit hashes of different texts only keep
two groups together. Repeated rows each get a slot. Ties of size are ordered
by job name, ties of load by shard number. Columns other than ``doc_id`` and
``text`` are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.session import cut_lineage

FINE = 64
BUNDLES_PER_SHARD = 512
CELLS_PER_SHARD = 256
OVERHEAD_BYTES = 8


def lpt(jobs: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int]]:
    """[(kind, key, size)] -> [(kind, key, shard)], longest first, each to
    the least-loaded shard."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for kind, key, size in sorted(jobs, key=lambda j: (-j[2], j[0], j[1])):
        load, shard = heapq.heappop(heap)
        out.append((kind, key, shard))
        heapq.heappush(heap, (load + size, shard))
    return out


def assign_shards(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    fine: int = FINE,
    bundles_per_shard: int = BUNDLES_PER_SHARD,
) -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    if shards < 1:
        raise ValueError("shards must be positive")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    n_bundles = shards * bundles_per_shard
    rows = cut_lineage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + OVERHEAD_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
            F.xxhash64(text).alias("_group"),
        ),
        "shard_rows",
    )
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    heavy = F.col("_bytes") * (shards * fine) >= F.lit(total)
    jobs = (
        groups.select(
            F.when(heavy, 0).otherwise(1).alias("_kind"),
            F.when(heavy, F.col("_group")).otherwise(F.pmod("_group", F.lit(n_bundles))).alias("_key"),
            "_bytes",
        )
        .groupBy("_kind", "_key")
        .agg(F.sum("_bytes").alias("_bytes"))
    )
    # at most shards * (fine + bundles_per_shard) rows, whatever the input
    plan = lpt([(r[0], r[1], r[2]) for r in jobs.collect()], shards)
    table = lambda kind: F.broadcast(  # noqa: E731  the same bound
        spark.createDataFrame([(k, s) for t, k, s in plan if t == kind], "_key long, _shard int")
    )
    placed = (
        rows.withColumn("_bundle", F.pmod("_group", F.lit(n_bundles)))
        .join(table(0).withColumnsRenamed({"_key": "_group", "_shard": "_own"}), "_group", "left")
        .join(table(1).withColumnsRenamed({"_key": "_bundle"}), "_bundle", "left")
        .withColumn("shard", F.coalesce("_own", "_shard"))
        .withColumn("_cell", F.pmod(F.xxhash64("doc_id", "_group"), F.lit(CELLS_PER_SHARD)))
    )
    cells = placed.groupBy("shard", "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("shard", "_cell").orderBy("doc_id", "_group")
    return (
        placed.join(F.broadcast(offsets), ["shard", "_cell"])  # at most shards * CELLS_PER_SHARD rows
        .withColumn("slot", F.col("_base") + F.row_number().over(within) - 1)
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
