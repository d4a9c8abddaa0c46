"""URL rules judged through a Bloom filter cascade (exact, without joins).

A rule is ``host/`` or ``host/path/`` with a verdict. It fits its host and
all subdomains when the url's path starts with the rule's path; the longest
fitting rule wins. What a url's verdict is depends on its *key* alone: the
host and as much of the path as the longest rule path has. The distinct keys
of the corpus are the complete key universe of the cascade:

* level 1 is a Bloom filter of the listed (blocked) keys,
* level 2 one of the unlisted keys that level 1 wrongly contains,
* level 3 one of the listed keys that level 2 wrongly contains, and so on
  until a level has no false positive left.

A key is listed exactly if the first level that does not contain it has an
even number. Over the universe that is exact, so pages are judged where they
are read: no join, no shuffle of pages. Each level is built by Spark (bit
positions of the keys, OR-ed per word), and only its words reach the driver.

Size bound: keys are dealt over segments by hash, as many as keep both the
listed keys and the false positives to be expected among the unlisted ones
within ``max_filter_bytes`` a segment (with few listed keys in a large corpus,
level 2 is the larger one). Every level is checked when it is built; one that
is larger by more than ``SLACK`` doubles the segments. With one segment, pages
are judged where they are read. With several, their parsed hosts and paths
are dealt by segment in one shuffle, so that a task holds one segment and
pages are read once.

Null url, or a url without ``://``: host and path are empty, no rule fits,
the verdict is ``allow``. Repeated rows are judged one by one. A null
page_id is kept. Columns other than ``page_id`` and ``url`` are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm.bloom import build, contains
from skyfold.llm.text import U64
from skyfold.session import cut_lineage, scratch_path

MAX_FILTER_BYTES = 16 << 20
BITS_PER_KEY = 12
#: Share of keys that such a filter of 6 hash functions wrongly contains.
FALSE_POSITIVES = 0.0037
#: Times ``max_filter_bytes`` that a level may take.
SLACK = 1.5
MAX_LEVELS = 40


class LevelTooLarge(Exception):
    """A level of a segment's cascade is above the bound."""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    block: bool

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(text: str, verdict: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(host.lower(), slash + path or "/", verdict == "block")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty without ``://`` or for null."""
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule], value: str = "text") -> Column:
    """``value`` of the longest rule that fits, null if none does."""
    out = None
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text), reverse=True):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(getattr(r, value))) if out is None else out.when(fits, F.lit(getattr(r, value)))
    return out if out is not None else F.lit(None)


def key_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """What the verdict of a url depends on: host, and the path as far as
    any rule looks at it."""
    depth = max([len(r.path) for r in rules], default=0)
    return F.concat(host, F.lit("\x00"), F.substring(path, 1, depth))


# -- the cascade -------------------------------------------------------------


def member(levels: Sequence[np.ndarray], h: np.ndarray) -> np.ndarray:
    """Membership by the cascade: the first level that does not contain the
    key decides (even levels, counted from 1: listed)."""
    out = np.zeros(len(h), dtype=bool)
    open_ = np.arange(len(h))
    for k, words in enumerate(levels):
        inside = contains(words, h[open_], k + 1)
        out[open_[~inside]] = k % 2 == 1
        open_ = open_[inside]
    out[open_] = len(levels) % 2 == 1
    return out


def build_cascade(keys: DataFrame, max_levels: int = MAX_LEVELS, max_bytes: float = math.inf) -> list[np.ndarray]:
    """Levels of the cascade over the universe ``keys`` (columns ``h`` long,
    ``listed`` boolean; distinct), each of ``max_bytes`` at most."""
    spark = keys.sparkSession
    levels: list[np.ndarray] = []
    inserted, other = keys.where("listed"), keys.where(~F.col("listed"))
    while len(levels) < max_levels:
        n = inserted.count()
        if n == 0:
            break
        if n * BITS_PER_KEY / 8 > max_bytes:
            raise LevelTooLarge
        words = build(inserted, "h", max(1, math.ceil(n * BITS_PER_KEY / 64)), len(levels) + 1)
        levels.append(words)
        shared, level = spark.sparkContext.broadcast(words), len(levels)

        def passing(batches, shared=shared, level=level):
            for batch in batches:
                h = batch.column(0).to_numpy(zero_copy_only=False).view(U64)
                yield batch.filter(pa.array(contains(shared.value, h, level)))

        # the false positives of this level are the next one's members
        wrong = cut_lineage(other.mapInArrow(passing, keys.schema), "cascade")
        inserted, other = wrong, inserted
    else:
        raise RuntimeError("the cascade did not end: two keys of the universe share a hash")
    return levels


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``."""
    spark = pages.sparkSession
    judged = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_u")).select(
        "page_id", host_of(F.col("_u")).alias("host"), path_of(F.col("_u")).alias("path")
    )
    host, path = F.col("host"), F.col("path")
    keyed = judged.withColumn("h", F.xxhash64(key_of(host, path, rules)))
    universe = cut_lineage(
        keyed.groupBy("h").agg(F.bool_or(F.coalesce(fitting_rule(host, path, rules, "block"), F.lit(False))).alias("listed")),
        "url_keys",
    )
    n = {bool(r.listed): r["count"] for r in universe.groupBy("listed").count().collect()}
    largest = max(n.get(True, 0), n.get(False, 0) * FALSE_POSITIVES)
    segments = max(1, math.ceil(largest * BITS_PER_KEY / 8 / max_filter_bytes))
    while True:
        try:
            cascades = _build_segments(universe, segments, max_filter_bytes * SLACK)
            break
        except LevelTooLarge:
            segments *= 2

    def verdicts(batches):
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False).view(U64)
            blocked, segment = np.zeros(len(h), dtype=bool), _segment_of(h.view(np.int64), segments)
            for s in np.unique(segment).tolist():  # one, unless there is but one for all
                at = np.flatnonzero(segment == s)
                blocked[at] = member(cascades[s].value, h[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array(np.where(blocked, "block", "allow"))],
                ["page_id", "host", "path", "verdict"],
            )

    id_type = judged.schema["page_id"].dataType.simpleString()
    if segments > 1:
        keyed = keyed.repartitionById(segments, F.pmod("h", F.lit(segments)).cast("int"))
    out = keyed.mapInArrow(verdicts, f"page_id {id_type}, host string, path string, verdict string")
    return out.select("page_id", "host", "path", fitting_rule(host, path, rules).cast("string").alias("rule"), "verdict")


def _segment_of(h: np.ndarray, segments: int) -> np.ndarray:
    return h % segments  # NumPy's remainder is not negative, like pmod


def _build_segments(universe: DataFrame, segments: int, max_bytes: float) -> list:
    """A broadcast cascade for every segment of the universe."""
    spark = universe.sparkSession
    if segments > 1:
        at = scratch_path(spark, "url_key_segments")
        universe.withColumn("segment", F.pmod("h", F.lit(segments))).hint("rebalance", F.col("segment")).write.partitionBy("segment").parquet(at)
        stored = spark.read.schema("h long, listed boolean, segment int").parquet(at)
        of_segment = [stored.where(F.col("segment") == s).select("h", "listed") for s in range(segments)]
    else:
        of_segment = [universe]
    return [spark.sparkContext.broadcast(build_cascade(keys, max_bytes=max_bytes)) for keys in of_segment]


__all__ = ["Rule", "rule", "judge_urls", "build_cascade", "member"]
