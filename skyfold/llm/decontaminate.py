"""Benchmark decontamination by winnowing.

A *window* is ``window`` consecutive words of a benchmark item (an item of
fewer words is one window). Texts are winnowed: of the k-gram hashes in each
window only the smallest is kept as its fingerprint, so two texts that share
a whole window are sure to share a fingerprint. Training and benchmark
fingerprints are joined, and a hit is extended to the windows that chose the
fingerprint: they count if all their words are equal (compared as text).

With ``window`` = 10 words and k = 8, each window has 3 k-grams. Windows of
short items take k = their own length, so that nothing is missed.

Documents are read once. A Bloom filter over the benchmark's fingerprints
(fixed size, ``filter_words`` 64-bit words) drops the others where they are
made; what it lets through wrongly goes out in the join. Only hit windows
are shuffled, each with its own text, and a window meets one benchmark row,
however many documents or items hold it.

Results per row of ``docs``: ``doc_id, n_words, n_hit, n_items,
items_sha256, contaminated``. Null and empty texts have no words and no
hits. Repeated documents are judged one by one. Repeated items count once by
``item_id``; an item without id makes hits but is not counted in
``n_items``. An empty benchmark leaves every document clean. Extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.bloom import build, contains
from skyfold.llm.text import ALNUM_WORDS, U64, Words, column_buffers, doc_slices, gram_hashes, words_of
from skyfold.session import cut_lineage

WINDOW_WORDS = 10
GRAM_WORDS = 8
FILTER_WORDS = 1 << 17  # 1 MB


def _windows(words: Words, length: int, k: int, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, fingerprint, window hash) of all windows of ``length``
    words; ``whole``: only of texts that have exactly this length."""
    wh = gram_hashes(words.hash, length)
    if not len(wh):
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)
    grams = gram_hashes(words.hash, k)
    fp = grams[: len(wh)].copy()
    for j in range(1, length - k + 1):  # winnowing: the smallest of the window's grams
        np.minimum(fp, grams[j : j + len(wh)], out=fp)
    ok = words.room()[: len(wh)] >= length
    if whole:
        counts = words.counts()
        ok &= np.repeat(counts, counts)[: len(wh)] == length
    at = np.flatnonzero(ok)
    return at, fp[at], wh[at]


def _text(words: Words, first: int, length: int) -> str:
    low = words.lower
    return " ".join(low[words.start[x] : words.end[x]].tobytes().decode("utf-8", "replace") for x in range(first, first + length))


def _gram(length: int, window: int, k: int) -> int:
    return min(k, length) if length == window else length


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW_WORDS, k: int = GRAM_WORDS,
                      id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of the items: ``len, fp, wh, window, items`` (sorted
    item ids as strings)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            raw, offs = column_buffers(batch.column(1))
            for i, j in doc_slices(offs):
                words = words_of(raw, offs, i, j, ALNUM_WORDS)
                doc = words.doc_of()
                rows: list[tuple] = []
                short = np.unique(words.counts())
                for length in [window, *(int(x) for x in short if 0 < x < window)]:
                    for a, f, h in zip(*_windows(words, length, _gram(length, window, k), length < window), strict=True):
                        rows.append((ids[i + doc[a]], length, int(f.view(np.int64)), int(h.view(np.int64)), _text(words, a, length)))
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
                types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["item", "len", "fp", "wh", "window"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("_i"), F.col(text_col).alias("_t")).mapInArrow(
        run, "item string, len int, fp long, wh long, window string"
    )
    return rows.groupBy("len", "fp", "wh", "window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW_WORDS,
    k: int = GRAM_WORDS,
    filter_words: int = FILTER_WORDS,
) -> DataFrame:
    spark = docs.sparkSession
    wins = cut_lineage(benchmark_windows(benchmark, window, k), "benchmark_windows")
    lengths = sorted(r[0] for r in wins.select("len").distinct().collect())  # at most ``window`` values
    shared = spark.sparkContext.broadcast(build(wins, "fp", filter_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offs = column_buffers(batch.column(1))
            for i, j in doc_slices(offs):
                words = words_of(raw, offs, i, j, ALNUM_WORDS)
                doc = words.doc_of()
                found: list[tuple] = []
                for length in lengths:
                    at, fp, wh = _windows(words, length, _gram(length, window, k), False)
                    hit = np.flatnonzero(contains(shared.value, fp))
                    found += [
                        (int(doc[a]), int(a - words.first[doc[a]]), length, int(f), int(h), _text(words, a, length))
                        for a, f, h in zip(at[hit].tolist(), fp[hit].view(np.int64), wh[hit].view(np.int64), strict=True)
                    ]
                found.sort(key=lambda r: r[0])
                per_doc = np.searchsorted(np.array([r[0] for r in found], np.int64), np.arange(j - i + 1)).astype(np.int32)
                cols = list(zip(*found, strict=True)) if found else [[]] * 6
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
                names = ["start", "len", "fp", "wh", "window"]
                hits = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols[1:], types, strict=True)], names)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(words.counts().astype(np.int64)), pa.ListArray.from_arrays(pa.array(per_doc), hits)],
                    ["doc_id", "n_words", "hits"],
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t")).mapInArrow(
        run, f"doc_id {id_type}, n_words long, hits array<struct<start:long,len:int,fp:long,wh:long,window:string>>"
    )
    base = cut_lineage(base.withColumn("_row", F.monotonically_increasing_id()), "hits")
    spans = (
        base.select("_row", F.explode("hits").alias("h"))
        .select("_row", "h.*")
        .join(wins, ["len", "fp", "wh", "window"])  # joined by fingerprint; equal text: the window occurs
        .select("_row", F.struct(F.col("start").alias("s"), (F.col("start") + F.col("len")).alias("e")).alias("span"), "items")
    )
    per_doc = spans.groupBy("_row").agg(F.array_sort(F.collect_list("span")).alias("spans"), F.collect_set("items").alias("sets"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda acc, x: F.struct(
            (acc.n + F.greatest(F.lit(0).cast("long"), x.e - F.greatest(x.s, acc.upto))).alias("n"),
            F.greatest(acc.upto, x.e).alias("upto"),
        ),
        lambda acc: acc.n,
    )
    items = F.array_sort(F.array_distinct(F.flatten("sets")))
    per_doc = per_doc.select("_row", covered.alias("_hit"), items.alias("_items"))
    return base.join(per_doc, "_row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("_items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "_items"), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("_hit", F.lit(0)) > 0).alias("contaminated"),
    )
