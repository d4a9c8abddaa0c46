"""Language identification with bit-sliced n-gram Bloom filters.

Training keeps, for each language, its most frequent byte n-grams that are
not much more frequent in another language. All languages' Bloom filters
are stored as one table of bitmasks: row r holds bit l if position r is set
in language l's filter. Looking an n-gram up in its few positions and AND-ing
the masks gives all languages that contain it at once. Per document and
language the hits are counted, corrected for the filter's false positives

    share = (hits / n - fp) / (1 - fp)

with fp from the filter's true fill, and averaged over the n-gram orders. The
language with the largest share is predicted.

The classifier is fitted on a bounded sample: about ``max_docs_per_lang``
labelled documents of each language, chosen by a hash of their id. Every
document is predicted over its whole text. The tables that reach the driver
hold at most ``max_grams`` n-grams of each order and language.

A document without a letter (or null) is ``und`` with score 0. One with
letters but no usable n-gram gets the most frequent training language with
score 0. Ties go to the first language by name. Without training rows all
documents are ``und``. Repeated rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.text import LOWER, U64, column_buffers, doc_slices, mix64

ORDERS = (3, 5)
WEIGHTS = {3: 1.0, 5: 2.0}
MAX_DOCS_PER_LANG = 4000
MAX_GRAMS = 20_000
FOREIGN_RATIO = 0.3  # an n-gram stays if its rate is at least this share of its best language's
TABLE_BITS = 18
UNKNOWN = "und"

_B = np.arange(256)
_LETTER = ((_B >= 0x61) & (_B <= 0x7A)) | (_B >= 0x80)
_NORMAL = np.where(_LETTER[LOWER], LOWER, 0x20).astype(np.uint8)


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))


def grams(raw: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, document) of the byte n-grams of each document: letters, with
    at most two other characters (all read as blanks)."""
    b = _NORMAL[raw]
    m = len(b) - n + 1
    if m <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    code = np.zeros(m, dtype=U64)
    letters = np.zeros(m, dtype=np.uint8)
    for j in range(n):
        part = b[j : j + m]
        code |= part.astype(U64) << U64(8 * j)
        letters += part != 0x20
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ok = (letters >= max(2, n - 2)) & (doc[:m] == doc[n - 1 :])
    return code[ok], doc[:m][ok]


def _rows(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two table positions of every n-gram."""
    h = mix64(code + U64(0x51))
    mask = U64((1 << TABLE_BITS) - 1)
    return (h & mask).astype(np.int64), (h >> U64(32) & mask).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    fallback: str
    #: order -> (mask tables, one for each 64 languages; false-positive rate by language)
    tables: dict[int, tuple[list[np.ndarray], np.ndarray]]


def fit(labelled: DataFrame, max_docs_per_lang: int = MAX_DOCS_PER_LANG, max_grams: int = MAX_GRAMS) -> Model:
    """Model from columns ``doc_id, text, lang`` (rows with a null among
    text and lang are left out)."""
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # one row for each language
    languages = sorted(sizes)
    rate = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, max_docs_per_lang / sizes[k])))]) if languages else None
    if not languages:
        return Model([], UNKNOWN, {})
    chance = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(chance < F.element_at(rate, F.col("lang"))).select("lang", "text")
    number = {k: i for i, k in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(0).to_pylist()], dtype=np.int64)
            raw, offs = column_buffers(batch.column(1))
            parts: dict[tuple[int, int], list[np.ndarray]] = {}
            for i, j in doc_slices(offs):
                for n in ORDERS:
                    code, doc = grams(raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i], n)
                    of = lang[i + doc]
                    for k in np.unique(lang[i:j]):
                        parts.setdefault((n, int(k)), []).append(code[of == k])
            for (n, k), codes in parts.items():
                u, c = np.unique(np.concatenate(codes), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(u), n, np.int32)), pa.array(np.full(len(u), k, np.int32)), pa.array(u.view(np.int64)), pa.array(c.astype(np.int64))],
                    ["n", "lang", "gram", "c"],
                )

    counts = sample.mapInArrow(count, "n int, lang int, gram long, c long").groupBy("n", "lang", "gram").agg(F.sum("c").alias("c"))
    totals = counts.groupBy("n", "lang").agg(F.sum("c").alias("total"))
    share = counts.join(F.broadcast(totals), ["n", "lang"]).withColumn("p", F.col("c") / F.col("total"))
    best = F.max("p").over(Window.partitionBy("n", "gram"))
    rank = F.row_number().over(Window.partitionBy("n", "lang").orderBy(F.desc("c"), "gram"))
    kept = (
        share.withColumn("best", best)
        .where(F.col("p") >= FOREIGN_RATIO * F.col("best"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= max_grams)
        .select("n", "lang", "gram")
        .toArrow()  # at most languages * orders * max_grams rows
    )
    order, lang, gram = (kept.column(x).to_numpy() for x in ("n", "lang", "gram"))
    tables = {}
    for n in ORDERS:
        masks = []
        fill = np.zeros(len(languages))
        for first in range(0, len(languages), 64):
            width = min(64, len(languages) - first)
            table = np.zeros(1 << TABLE_BITS, dtype=np.uint8 if width <= 8 else np.uint64)
            for k in range(width):
                code = gram[(order == n) & (lang == first + k)].view(U64)
                for p in _rows(code):
                    table[p] |= table.dtype.type(1 << k)
                fill[first + k] = np.mean(table >> table.dtype.type(k) & table.dtype.type(1))
            masks.append(table)
        tables[n] = (masks, fill**2)
    return Model(languages, max(languages, key=lambda k: (sizes[k], k)), tables)


def _has_letter(raw: bytes) -> bool:
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))


def classify(model: Model, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the language or -1 for ``und``, score, whether it has a
    usable n-gram) of every document of a slice."""
    n_docs, n_langs = len(offsets) - 1, len(model.languages)
    share = np.zeros((n_docs, n_langs))
    weight = np.zeros(n_docs)
    for n, (masks, fp) in model.tables.items():
        code, doc = grams(raw, offsets, n)
        first = np.searchsorted(doc, np.arange(n_docs + 1))
        some = np.flatnonzero(np.diff(first))
        if not len(some):
            continue
        a, b = _rows(code)
        size = np.diff(first)[some]
        for s, table in enumerate(masks):
            both = table[a] & table[b]  # all languages that contain the n-gram
            for k in range(64 * s, min(64 * s + 64, n_langs)):
                bit = both >> table.dtype.type(k - 64 * s) & table.dtype.type(1)
                hits = np.add.reduceat(bit.astype(np.int32), first[some])
                share[some, k] += WEIGHTS[n] * np.clip((hits / size - fp[k]) / max(1e-9, 1 - fp[k]), 0, 1)
        weight[some] += WEIGHTS[n]
    share /= np.maximum(weight, 1e-9)[:, None]
    best = share.argmax(axis=1) if n_langs else np.zeros(n_docs, np.int64)
    score = share[np.arange(n_docs), best] if n_langs else np.zeros(n_docs)
    if n_langs:
        best = np.where(weight > 0, best, model.languages.index(model.fallback))
    ascii_letter = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum(_LETTER[LOWER[raw]] & (raw < 0x80), out=ascii_letter[1:])
    for d in np.flatnonzero(ascii_letter[offsets[1:]] == ascii_letter[offsets[:-1]]):
        if not _has_letter(raw[offsets[d] : offsets[d + 1]].tobytes()):
            best[d], score[d] = -1, 0.0
    return (best if n_langs else np.full(n_docs, -1)), score, weight > 0


def predict(docs: DataFrame, model: Model, text_col: str = "text", evidence_col: str | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` in place of columns of
    these names (and ``evidence_col``: whether the text has a usable n-gram);
    no shuffle."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    plain = docs.drop("lang_pred", "score", *([evidence_col] if evidence_col else []))
    names = plain.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        labels = np.array([*m.languages, UNKNOWN], dtype=object)
        for batch in batches:
            raw, offs = column_buffers(batch.column(at))
            langs, scores, evidence = [], [], []
            for i, j in doc_slices(offs):
                best, score, some = classify(m, raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                langs.append(labels[best])
                scores.append(score)
                evidence.append(some)
            pred = pa.array(np.concatenate(langs) if langs else [], pa.string())
            value = pa.array(np.concatenate(scores) if scores else [], pa.float64())
            cols, more = [*batch.columns, pred, value], []
            if evidence_col:
                cols.append(pa.array(np.concatenate(evidence) if evidence else [], pa.bool_()))
                more = [evidence_col]
            yield pa.RecordBatch.from_arrays(cols, [*names, "lang_pred", "score", *more])

    schema = plain.schema
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

    out = StructType([*schema.fields]).add("lang_pred", StringType()).add("score", DoubleType())
    if evidence_col:
        out = out.add(evidence_col, BooleanType())
    return plain.mapInArrow(run, out)
