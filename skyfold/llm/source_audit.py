"""Source divergence audit: how far apart the sources of a language are in
their use of terms, and which terms set a source apart.

Method. Texts are cut into terms once, in a table partitioned by language.
For each language a ``CountVectorizer`` with ``minDF`` and the largest
integer as ``vocabSize`` makes an exact sparse count vector of every
document. The vectors are summed by source, as ``Summarizer`` would, but over
their non-zero entries and in whole numbers. Pairs of sources are compared in
blocks of terms: with p0 the share of a term that a source does not have,

    sum |pa - pb| = V |pa0 - pb0|
                  + sum over a's terms of |pa - pb0| - |pa0 - pb0|
                  + sum over b's terms of |pa0 - pb| - |pa0 - pb0|
                  + sum over common terms of |pa - pb| - |pa - pb0| - |pa0 - pb| + |pa0 - pb0|

so only non-zero entries are visited, the one-sided sums by prefix sums.

Scale. Documents are shuffled once (balanced by language, a hot one is
split). Sums are pre-aggregated by (source, term) in every task, so a hot
source costs one row a term. Term blocks hold at most ``BLOCK_CELLS`` cells
(sources x terms), or as many as there are pairs of sources, and a block
sends one row for each pair, as the result has one. A vocabulary goes through
the driver, as ``CountVectorizer`` works: a fit asks for ``max_vocabulary``
terms and one more, so that its size is bounded, and where it gets that one
more, the language is fitted in parts by the terms' hash, twice as many until
none is cut off. So no term is left out, as with ``vocabSize`` at the largest
integer (which a ``max_vocabulary`` of ``ALL_TERMS`` asks for). One job for each language runs after the other: the
number of languages is taken to be small (names of languages).

Nulls count as '' in text, language and source. A text without terms, or an
empty one, counts as a document without terms; its group is reported all the
same. A language without kept terms has value 0 for every pair and no term
rows. Repeated rows count as often as they occur. Ties rank by the item's
UTF-8 bytes. An empty table gives no rows. Columns other than the three are
not read, so their names cannot clash. Texts of any length are cut as a
whole, a slice of documents at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.text import column_buffers, doc_slices, words_of
from skyfold.session import cut_lineage, scratch_path

_BYTES = np.arange(256)
#: Lower-case a-z and non-ASCII characters belong to a term.
TERM_BYTES = ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
#: A term's share is 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V)).
SCALE, PRIOR = 1_000_000_000, 5
MIN_DOCS, TOP_TERMS = 30, 50
#: The largest ``vocabSize``.
ALL_TERMS = (1 << 31) - 1
#: Terms of a vocabulary that pass through the driver at once, at most.
MAX_VOCABULARY = 4_000_000
#: Sources x terms in one task of the pair evaluation; as many as pairs of sources where these are more, up to a bound.
BLOCK_CELLS, MOST_CELLS = 1 << 14, 1 << 24
#: Bytes of text that are split into lists of terms at once.
LIST_BYTES = 1 << 20
#: Documents whose vectors are summed at once.
SUM_ROWS = 2500


def _cut_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang_no, source, text) to (source, terms, lang_no): the lower-cased
    terms of a text with one space between them."""
    for batch in batches:
        raw, offs = column_buffers(batch.column("text"))
        for i, j in doc_slices(offs):
            w = words_of(raw, offs, i, j, TERM_BYTES, hashes=False)
            more = np.ones(len(w.start), dtype=bool)
            more[w.first[1:][w.counts() > 0] - 1] = False  # the last term of a text
            keep, gap = TERM_BYTES[w.lower], w.end[more]
            keep[gap] = True
            w.lower[gap] = 0x20
            ends = np.concatenate([[0], np.cumsum(keep)])[offs[i : j + 1] - offs[i]].astype(np.int32)
            terms = pa.StringArray.from_buffers(j - i, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(w.lower[keep])))
            yield pa.RecordBatch.from_arrays([batch.column("source").slice(i, j - i), terms, batch.column("lang_no").slice(i, j - i)], ["source", "terms", "lang_no"])


def _term_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(source, terms) with the terms as a list."""
    for batch in batches:
        _, offs = column_buffers(batch.column("terms"))
        for i, j in doc_slices(offs, LIST_BYTES):
            part = batch.slice(i, j - i)
            lists = pc.split_pattern(part.column("terms"), " ")
            blank = pc.equal(part.column("terms"), "")
            if pc.any(blank).as_py():
                lists = pc.if_else(blank, pa.scalar([], lists.type), lists)
            yield pa.RecordBatch.from_arrays([part.column("source"), lists], ["source", "terms"])


def _part(term, parts: int):
    return F.pmod(F.xxhash64(term), F.lit(parts))


def _of_part(terms: str, part: int, parts: int):
    return F.filter(terms, lambda t: _part(t, parts) == part)


def _fit(rows: DataFrame, min_docs: int, most: int):
    """The fitted model, or None if no term occurs in ``min_docs`` documents
    (which CountVectorizer refuses). One term above ``most`` is asked for, so
    that no more reach the driver, and a vocabulary up to ``most`` is whole."""
    from pyspark.ml.feature import CountVectorizer  # not in the tasks' processes

    try:
        return CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=min(ALL_TERMS, most + 1)).fit(rows)
    except IllegalArgumentException as refused:
        if "vocabulary size should be > 0" in str(refused):
            return None
        raise


def _fit_parts(rows: DataFrame, min_docs: int, most: int) -> list:
    """(the texts' lists of terms, the model fitted on them): one for all
    terms, or as many parts by the terms' hash as keep each vocabulary whole."""
    parts = 1
    while True:
        fitted = []
        for part in range(parts):
            own = rows.withColumn("terms", _of_part("terms", part, parts)) if parts > 1 else rows
            model = _fit(own, min_docs, most)
            if model is not None and len(model.vocabulary) > most:
                break  # cut off
            fitted.append((own, model))
        else:
            return [(own, model) for own, model in fitted if model is not None]
        parts *= 2


def _sum_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(source, sparse count vector) to (source, idx, n), summed over some
    documents at a time."""
    for whole in batches:
        for x in range(0, whole.num_rows, SUM_ROWS):
            batch = whole.slice(x, SUM_ROWS)
            name, vector = pc.dictionary_encode(batch.column("source")), batch.column("vector")  # a vector is a struct here
            lists = vector.field("indices")
            idx, n = lists.flatten().to_numpy(), vector.field("values").flatten().to_numpy().astype(np.int64)
            size = pc.list_value_length(lists).to_numpy()
            key, at = np.unique((np.repeat(name.indices.to_numpy().astype(np.int64), size) << 32) + idx, return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, at, n)
            yield pa.RecordBatch.from_arrays([name.dictionary.take(pa.array(key >> 32)), pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(total)], ["source", "idx", "n"])


def count_terms(terms: DataFrame, min_docs: int, max_vocabulary: int) -> tuple[DataFrame, DataFrame]:
    """(source, idx, n, lang_no, part): the documents' count vectors summed by
    source; and (idx, term, lang_no, part) of every kept term. Both are
    written to the shared folder.

    terms: (lang_no, source, terms) by language."""
    spark = terms.sparkSession
    at_sums, at_words = scratch_path(spark, "source_sums"), scratch_path(spark, "vocabulary")
    found = False
    langs = sorted(r[0] for r in terms.select("lang_no").distinct().collect())
    for lang_no in langs:
        rows = terms.where(F.col("lang_no") == lang_no).select("source", "terms").mapInArrow(_term_lists, "source string, terms array<string>")
        for part, (own, model) in enumerate(_fit_parts(rows, min_docs, max_vocabulary)):
            found = True
            folder = f"lang_no={lang_no}/part={part}"
            sums = model.transform(own).select("source", "vector").mapInArrow(_sum_vectors, "source string, idx int, n long")
            sums.groupBy("source", "idx").agg(F.sum("n").alias("n")).write.parquet(f"{at_sums}/{folder}")
            words = model.vocabulary
            table = pa.table({"idx": pa.array(range(len(words)), pa.int32()), "term": pa.array(words, pa.string())})
            spark.createDataFrame(table).write.parquet(f"{at_words}/{folder}")
    shapes = "source string, idx int, n long, lang_no int, part int", "idx int, term string, lang_no int, part int"
    if not found:
        return spark.createDataFrame([], shapes[0]), spark.createDataFrame([], shapes[1])
    return tuple(spark.read.schema(s).parquet(p) for s, p in zip(shapes, (at_sums, at_words), strict=True))


def _share(count, total, v):
    """A term's share in whole numbers, exact at any count."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + F.lit(PRIOR)).cast("decimal(20,0)")
    below = F.greatest(total + F.lit(PRIOR) * v, F.lit(1)).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, below).cast("long")


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers start[k] .. start[k] + length[k] - 1 of all k, in a row."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - length), length)


def pair_sums(p0: np.ndarray, source: np.ndarray, term: np.ndarray, p: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For every source i, what it adds to the sums of |pi - pj| over the
    block's terms: (i, int64 array by j). The sum of a pair is what i adds at
    j and what j adds at i. (source, term, p): the non-zero entries."""
    n = len(p0)
    v = int(term.max()) + 1 if len(term) else 0
    order = np.lexsort((source, term))
    by_term, by_p = source[order], p[order]
    first = np.searchsorted(term[order], np.arange(v + 1))
    order = np.lexsort((term, source))
    own_term, own_p = term[order], p[order]
    begin = np.searchsorted(source[order], np.arange(n + 1))
    for i in range(n):
        t, x = own_term[begin[i] : begin[i + 1]], own_p[begin[i] : begin[i + 1]]
        gap = np.abs(p0 - p0[i])
        low = np.sort(x)
        before = np.concatenate([[0], np.cumsum(low)])
        k = np.searchsorted(low, p0)
        out = p0 * k - before[k] + (before[-1] - before[k]) - p0 * (len(x) - k) - len(x) * gap
        out[i + 1 :] += v * gap[i + 1 :]
        length = first[t + 1] - first[t]
        at = _ranges(first[t], length)
        j, mine, theirs = by_term[at], np.repeat(x, length), by_p[at]
        later = j > i
        j, mine, theirs = j[later], mine[later], theirs[later]
        np.add.at(out, j, np.abs(mine - theirs) - np.abs(mine - p0[j]) - np.abs(p0[i] - theirs) + gap[j])
        yield i, out


_PAIRS = "lang_no int, a string, b string, value long"


def _compare(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of all pairs of sources over one block of terms. Rows without a
    term are the language's sources, with their p0."""
    rows = pa.Table.from_batches(list(batches))
    is_group = rows["idx"].is_null()
    groups = rows.filter(is_group).sort_by("source")
    names = groups["source"].combine_chunks()
    entries = rows.filter(rows["idx"].is_valid())
    where = pc.index_in(entries["source"], value_set=names).to_numpy().astype(np.int64)
    number = (entries["part"].to_numpy().astype(np.int64) << 32) + entries["idx"].to_numpy().astype(np.int64)
    term = np.unique(number, return_inverse=True)[1]
    lang_no = key[0].as_py()
    held, size = [], 0
    for i, sums in pair_sums(groups["p"].to_numpy(), where, term, entries["p"].to_numpy()):
        others = np.delete(np.arange(len(sums)), i)
        low, high = np.minimum(others, i), np.maximum(others, i)
        held.append(pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(others), lang_no, np.int32)), names.take(pa.array(low)), names.take(pa.array(high)), pa.array(sums[others])], ["lang_no", "a", "b", "value"]
        ))
        size += len(others)
        if size >= 1 << 16:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def audit_sources(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS, top: int = TOP_TERMS,
    max_vocabulary: int = MAX_VOCABULARY, block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has the
    distance to every other source of the language, largest first, part
    ``term`` the ``top`` kept terms whose share is furthest above the
    language's."""
    spark = docs.sparkSession
    rows = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    names = sorted(r[0] for r in rows.select("lang").distinct().collect())
    langs = spark.createDataFrame(list(enumerate(names)), "lang_no int, lang string")
    at = scratch_path(spark, "terms")
    dealt = rows.join(langs, "lang").select("lang_no", "source", "text").hint("rebalance", F.col("lang_no"))
    cut = dealt.mapInArrow(_cut_terms, "source string, terms string, lang_no int")
    cut.write.partitionBy("lang_no").option("compression", "zstd").parquet(at)
    terms = spark.read.schema("source string, terms string, lang_no int").parquet(at)
    sums, words = count_terms(terms, min_docs, max_vocabulary)

    sizes = words.groupBy("lang_no").agg(F.count("*").alias("v"))
    totals = sums.groupBy("lang_no", "source").agg(F.sum("n").alias("total"))
    groups = terms.select("lang_no", "source").distinct().join(totals, ["lang_no", "source"], "left").join(sizes, "lang_no", "left")
    groups = cut_lineage(groups.select("lang_no", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v")), "source_totals")
    n = F.count("*")
    in_block = F.least(F.greatest(F.lit(block_cells), n * n), F.lit(MOST_CELLS))
    blocks = groups.groupBy("lang_no").agg(F.greatest(F.lit(1), F.ceil(n * F.max("v") / in_block)).cast("int").alias("blocks"))
    groups = groups.join(blocks, "lang_no").withColumn("p0", _share(F.lit(0), F.col("total"), F.col("v")))
    shares = sums.join(groups, ["lang_no", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("v")))

    cells = shares.select("lang_no", F.pmod("idx", "blocks").alias("block"), "source", "part", "idx", "p")
    each = groups.select("lang_no", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", F.lit(None).cast("int").alias("part"), F.lit(None).cast("int").alias("idx"), F.col("p0").alias("p"))
    sums_of_blocks = cells.unionByName(each).groupBy("lang_no", "block").applyInArrow(_compare, _PAIRS)
    unordered = sums_of_blocks.groupBy("lang_no", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = unordered.select("lang_no", "value", both.alias("at")).select("lang_no", F.col("at.source"), F.lit("pair").alias("part"), F.col("at.item"), "value")

    of_lang = sums.groupBy("lang_no", "part", "idx").agg(F.sum("n").alias("lang_n"))
    lang_totals = groups.groupBy("lang_no").agg(F.sum("total").alias("lang_total"), F.max("v").alias("lang_v"))
    usual = of_lang.join(lang_totals, "lang_no").select("lang_no", "part", "idx", _share(F.col("lang_n"), F.col("lang_total"), F.col("lang_v")).alias("q"))
    above = shares.join(usual, ["lang_no", "part", "idx"]).where(F.col("p") > F.col("q")).join(words, ["lang_no", "part", "idx"])
    above = above.select("lang_no", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    by_value = Window.partitionBy("lang_no", "source").orderBy(F.col("value").desc(), F.col("item"))
    best = above.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    ranked = pairs.withColumn("rank", F.row_number().over(by_value)).unionByName(best)
    return ranked.join(langs, "lang_no").select("lang", "source", "part", "item", "value", "rank")
