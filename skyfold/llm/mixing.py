"""Mixing sources to target weights along a time-varying curriculum.

Targets. Sources, by name (code points, null last), take the weights in turn
and share all words by weight. No target is above ``most`` times its source's
words; what is over goes to the others by weight, until none is above. That
fixed point is min(most * words, level * weight), with the level found by
running sums over the sources ordered by most * words / weight.

Curriculum. Each weight comes with a schedule: its relative rate over the
training time 0 to 1, linear between knots. The schedule's integral, scaled to
the target, is the source's cumulative demand for words. The source's
documents, in an order dealt by a hash, follow each other without gaps, again
from the start when all are used; a document is due when the cumulative demand
reaches its first word, so its position is the inverse of the integral there
(a quadratic within each segment). The document that crosses the target is
cut there: a source gives exactly the whole words of its target, and every
document at most ``most`` times its own.

Scale. Texts are read once, to their sizes; nothing else is shuffled with
them. A source's running sum has two levels: hash buckets of about
``BUCKET_ROWS`` documents are summed in any task, their sums are added up by
source, and each bucket's documents follow in their own window; so a hot
source, or a hot id (the hash takes id and text), meets in no single task.
There is one row for each source, and one for each of a source's buckets.

Null or empty texts have size 0 and are never taken. Null ids are kept, null
sources are one source. Rows equal in source, id and text are dealt next to
each other. An empty table gives no rows. Only the named columns are read,
so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.session import cut_lineage

#: Words of a text.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Relative rate by time for each weight: large sources early, small ones late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
#: A source, and each of its documents, is used so many times at most.
MOST = 3
BUCKET_ROWS = 500


def segments(schedule: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """(share before, share after, start, rate, slope) of a schedule's linear
    pieces; shares are its integral, scaled to 1 at time 1."""
    times = [t for t, _ in schedule]
    if times[0] != 0 or times[-1] != 1 or any(a >= b for a, b in zip(times, times[1:], strict=False)) or min(w for _, w in schedule) < 0:
        raise ValueError("knots must rise from time 0 to 1, rates must not be negative")
    areas = [(b - a) * (u + v) / 2 for (a, u), (b, v) in zip(schedule, schedule[1:], strict=False)]
    if not sum(areas):
        raise ValueError("a schedule must have a rate above 0")
    out, done = [], 0.0
    for (a, u), (b, v), area in zip(schedule, schedule[1:], areas, strict=False):
        out.append((done / sum(areas), (done + area) / sum(areas), a, u / sum(areas), (v - u) / (b - a) / sum(areas)))
        done += area
    return out


def _due(share: Column, pieces: Column) -> Column:
    """The time at which the integral reaches ``share``."""
    piece = F.element_at(F.filter(pieces, lambda s: s["before"] <= share), -1)
    rest = share - piece["before"]
    root = F.sqrt(F.greatest(piece["rate"] * piece["rate"] + 2 * piece["slope"] * rest, F.lit(0.0)))
    return F.when(rest > 0, piece["start"] + 2 * rest / (piece["rate"] + root)).otherwise(piece["start"])


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, schedules=SCHEDULES, most: int = MOST) -> DataFrame:
    """(source, source_size, target, pieces) of (source, source_size)."""
    spark = sizes.sparkSession
    kind = "kind int, weight long, pieces array<struct<before: double, after: double, start: double, rate: double, slope: double>>"
    kinds = spark.createDataFrame([(k, w, segments(schedules[k % len(schedules)])) for k, w in enumerate(weights)], kind)
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("kind", (F.row_number().over(by_name) - 1) % len(weights)).join(kinds, "kind")
    # Ordered by what a unit of weight may take, the capped sources come first.
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(most * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_first())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    level = (left / F.sum("weight").over(rest)).alias("level")
    leveled = ranked.select("*", level)
    # The level is that of the first source that it does not fill; at least one has such a level, or all are full.
    free = F.when(F.col("weight") * F.col("level") <= most * F.col("source_size"), F.col("level"))
    found = leveled.withColumn("found", F.first(free, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    cap = (most * F.col("source_size")).cast("double")
    return found.select("source", "source_size", F.least(cap, F.coalesce(F.col("weight") * F.col("found"), cap)).alias("target"), "pieces")


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: Sequence[int] = WEIGHTS, schedules=SCHEDULES,
    most: int = MOST, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row for each document: id, size, source, source_size, target,
    taken and ``uses``, an array of (position, epoch, words): when the
    document is due, in which pass over its source, and how many of its first
    words are taken then."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    doc = F.col(f"`{id_col}`")
    key = F.md5(F.concat(F.coalesce(doc.cast("string"), F.lit("")), F.lit("|"), text).cast("binary"))
    sized = docs.select(doc.alias("id"), F.col(f"`{source_col}`").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), key.alias("key"))
    sized = cut_lineage(sized, "sizes")
    buckets = max(1, -(-sized.count() // bucket_rows))
    sized = sized.withColumn("bucket", F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % buckets)

    of_bucket = cut_lineage(sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")), "bucket_sizes")
    targets = source_targets(of_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, schedules, most)
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = of_bucket.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
    starts = starts.select(F.col("source").alias("of_source"), F.col("bucket").alias("of_bucket"), "bucket_start")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("bucket") == F.col("of_bucket")))
    placed = placed.drop("of_source").join(targets.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source")))

    goal = F.floor("target")

    def use(epoch: Column) -> Column:
        start = epoch * F.col("source_size") + F.col("bucket_start") + F.col("inside")
        words = F.greatest(F.least(F.col("size"), goal - start), F.lit(0))
        return F.struct(_due(start / F.col("target"), F.col("pieces")).alias("position"), epoch.cast("int").alias("epoch"), words.cast("long").alias("words"))

    uses = F.filter(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(most - 1).cast("long")), use), lambda u: u["words"] > 0)
    taken = F.aggregate("uses", F.lit(0).cast("long"), lambda a, u: a + u["words"])
    out = placed.withColumn("uses", F.when(F.col("target") >= 1, uses).otherwise(F.array().cast("array<struct<position: double, epoch: int, words: bigint>>")))
    return out.select(F.col("id").alias(id_col), "size", F.col("source").alias(source_col), "source_size", "target", taken.alias("taken"), "uses")


def training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each use of a document, range-sorted by its position."""
    uses = mixed.select(F.col(f"`{id_col}`"), F.inline("uses"))
    return uses.orderBy("position", F.col(f"`{id_col}`"), "epoch")


def by_first_position(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row for each document, range-sorted by its first position (null
    and last if it is not taken)."""
    first = F.get(F.col("uses"), 0)["position"]
    return mixed.withColumn("position", first).orderBy(F.col("position").asc_nulls_last(), F.col(f"`{id_col}`"))
