"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text is cut into paragraphs: lines, cut further after every word whose hash
falls into one of ``CUT`` classes, so that an edit only changes the pieces it
touches. Each piece is a 64-bit digest (a repeated piece gets its number mixed
in). A sketch has three sub-tables of cells (count, sum of digests, sum of
check hashes); every digest is added to one cell of each.

Subtracting the sketches of two versions cancels what both have. A cell that
holds a single digest gives it away, it is taken out of its other cells, and
so on (peeling), until the differing digests are all recovered. If cells
remain, the sketch was too small: both are built again with four times as
many cells. Likeness is the share of common pieces (Jaccard), exact because
peeling ends empty.

``fingerprint_table`` gives, for each document, its own sketch, that of an
edited version (the last quarter replaced by the beginning of the next
document by id, after the last comes the first), and likenesses. Rows are
dealt by ranges of id; the first document of every range is also sent to the
range before, so neighbours meet without a global sort. A range's bounds come
from a quantile sketch over the ids.

Null text counts as empty; an empty text has an empty sketch, alike (1.0) to
another empty one. Rows with the same id are ordered by text; rows without id
come first. A single row is its own next document. An empty table gives no
rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.blocks import bucket_count
from skyfold.llm.text import SPACE_WORDS, U64, Words, column_buffers, mix64, prefix_sums, range_hashes

CELLS = 24
CUT = 4
GROWTH = 4
SLICE_CHARS = 1 << 19
_CHECK = U64(0xA0761D6478BD642F)
_LOWEST = -(1 << 63)


def digests(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(digest, document) of the paragraphs of the texts of a slice."""
    w = Words(raw, offsets, SPACE_WORDS)
    n = len(w.start)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    doc = w.doc_of()
    line = np.concatenate([[0], np.cumsum(raw == 0x0A)])[w.start]
    last = np.ones(n, dtype=bool)
    last[:-1] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1]) | (w.hash[:-1] % U64(CUT) == 0)
    ends = np.flatnonzero(last)
    begins = np.concatenate([[0], ends[:-1] + 1])
    h = range_hashes(raw, w.start[begins], w.end[ends], prefix_sums(raw))
    of = doc[begins]
    order = np.lexsort((h, of))
    hs, ds = h[order], of[order]
    new = np.concatenate([[True], (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])])
    at = np.arange(len(hs))
    number = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix64(hs + number.astype(U64) * U64(0x9E3779B97F4A7C15)), ds


def _cells(key: np.ndarray, cells: int) -> list[np.ndarray]:
    part = cells // 3
    return [(mix64(key + U64(cells * 4 + t + 1)) % U64(part)).astype(np.int64) + t * part for t in range(3)]


class Sketches:
    """Sketches of several documents, one row each."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count = np.zeros(n * cells, np.int64)
        self.key = np.zeros(n * cells, U64)
        self.check = np.zeros(n * cells, U64)

    def add(self, key: np.ndarray, doc: np.ndarray, sign: np.ndarray | int = 1) -> None:
        sign = np.broadcast_to(np.asarray(sign, np.int64), key.shape)
        signed, check = key * sign.astype(U64), mix64(key ^ _CHECK) * sign.astype(U64)
        for c in _cells(key, self.cells):
            at = doc * self.cells + c
            np.add.at(self.count, at, sign)
            np.add.at(self.key, at, signed)
            np.add.at(self.check, at, check)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.n, self.cells)
        out.count, out.key, out.check = self.count - other.count, self.key - other.key, self.check - other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(digest, document, side) of what was recovered (side 1: only in
        the first, -1: only in the second) and which documents are done."""
        keys, docs, sides = [], [], []
        while True:
            at = np.flatnonzero((self.count == 1) | (self.count == -1))
            sign = self.count[at]
            key = self.key[at] * sign.astype(U64)
            pure = mix64(key ^ _CHECK) * sign.astype(U64) == self.check[at]
            if not pure.any():
                break
            found = pd.DataFrame({"d": at[pure] // self.cells, "k": key[pure], "s": sign[pure]}).drop_duplicates()
            d, k, s = found["d"].to_numpy(), found["k"].to_numpy(), found["s"].to_numpy()
            self.add(k, d, -s)
            keys.append(k)
            docs.append(d)
            sides.append(s)
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        done = ~left.reshape(self.n, self.cells).any(axis=1)
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        return cat(keys, U64), cat(docs, np.int64), cat(sides, np.int64), done

    def texts(self) -> list[str]:
        rows = np.zeros((self.n * self.cells,), dtype=[("c", "<i4"), ("k", "<u8"), ("h", "<u4")])
        rows["c"], rows["k"], rows["h"] = self.count, self.key, (self.check & U64(0xFFFFFFFF))
        rows = rows.reshape(self.n, self.cells)
        return [f"{self.cells}:" + base64.b64encode(r.tobytes()).decode() for r in rows]


def _select(key: np.ndarray, doc: np.ndarray, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The digests of the documents ``which``, renumbered."""
    number = np.full(n, -1)
    number[which] = np.arange(len(which))
    keep = number[doc] >= 0
    return key[keep], number[doc[keep]]


def differing(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int,
              sketches: tuple[Sketches, Sketches] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(digest, document, side) of all differing paragraphs of n pairs of
    versions, from sketches that grow until they can be peeled."""
    which, cells = np.arange(n), CELLS
    out: list[tuple] = []
    while len(which):
        if sketches is None:
            pair = []
            for key, doc in (a, b):
                s = Sketches(len(which), cells)
                s.add(*_select(key, doc, which, n))
                pair.append(s)
        else:
            pair = list(sketches)
        key, doc, side, done = pair[0].minus(pair[1]).peel()
        ok = done[doc]
        out.append((key[ok], which[doc[ok]], side[ok]))
        which, cells, sketches = which[~done], cells * GROWTH, None
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def likeness(a, b, n: int, sketches=None) -> np.ndarray:
    _, doc, _ = differing(a, b, n, sketches)
    d = np.bincount(doc, minlength=n)
    total = np.bincount(a[1], minlength=n) + np.bincount(b[1], minlength=n)
    return np.where(total + d > 0, (total - d) / np.maximum(1, total + d), 1.0)


def _sketch(texts: list[str], cells: int = CELLS) -> tuple[tuple[np.ndarray, np.ndarray], Sketches]:
    raw, offs = column_buffers(pa.array(texts, pa.large_string()))
    found = digests(raw, offs)
    s = Sketches(len(texts), cells)
    s.add(*found)
    return found, s


def compare_neighbours(texts: list[str]) -> dict[str, list]:
    """Results for all of ``texts`` but the last, each with its successor."""
    n = len(texts) - 1
    chars = [len(t) for t in texts[:n]]
    edited = [t[: c - c // 4] + nxt[: c // 4] for t, c, nxt in zip(texts, chars, texts[1:], strict=False)]
    own, sketch = _sketch(texts)
    changed, changed_sketch = _sketch(edited)

    def part(first: int) -> tuple[tuple, Sketches]:
        s = Sketches(n, CELLS)
        s.count, s.key, s.check = (x[first * CELLS : (first + n) * CELLS] for x in (sketch.count, sketch.key, sketch.check))
        keep = (own[1] >= first) & (own[1] < first + n)
        return (own[0][keep], own[1][keep] - first), s

    (here, here_s), (after, after_s) = part(0), part(1)
    return {
        "n_chars": chars,
        "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edited],
        "fingerprint": here_s.texts(),
        "edited_fingerprint": changed_sketch.texts(),
        "near_edited": likeness(here, changed, n, (here_s, changed_sketch)).tolist(),
        "near_next": likeness(here, after, n, (here_s, after_s)).tolist(),
    }


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST))
    n = bucket_count(spark)
    ids = plain.select(order.alias("k"))
    cuts = ids.agg(F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0]  # n - 1 numbers
    bounds = np.unique(np.array(cuts or [], dtype=np.int64))

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, k.to_numpy(), side="right").astype(np.int32))

    heads = ids.groupBy(range_of("k").alias("r")).agg(F.min("k").alias("k")).orderBy("r").collect()  # n rows at most
    head_keys = np.array([h[1] for h in heads], dtype=np.int64)
    targets = np.array([heads[i - 1][0] for i in range(len(heads))], dtype=np.int32)  # the first goes round to the last

    @F.pandas_udf("int")
    def also_to(k: pd.Series) -> pd.Series:
        x = k.to_numpy()
        at = np.minimum(np.searchsorted(head_keys, x), len(head_keys) - 1)
        return pd.Series(np.where(head_keys[at] == x, targets[at], -1).astype(np.int32))

    places = F.array(F.struct(range_of("k").alias("r"), F.lit(0).alias("guest")), F.struct(also_to("k").alias("r"), F.lit(1).alias("guest")))
    dealt = (
        plain.withColumn("k", order)
        .withColumn("at", F.explode(places))
        .where("at.r >= 0")
        .select("at.r", "at.guest", "k", "doc_id", "text")
        .repartitionById(n, F.col("r"))
        .sortWithinPartitions("r", "guest", "k", "text")
    )
    id_type = plain.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ids: list = []
        texts: list[str] = []
        size, ended, kind = 0, False, None

        def flush() -> pa.RecordBatch:
            out = compare_neighbours(texts)
            types = [kind, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            cols = [held_ids[: len(texts) - 1], *out.values()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", *out])

        for batch in batches:
            kind = batch.column("doc_id").type
            for guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("guest", "doc_id", "text")), strict=True):
                if guest and ended:
                    continue  # a further row with the next range's first id
                held_ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if guest or size >= SLICE_CHARS:
                    if len(texts) > 1:
                        yield flush()
                    ended = bool(guest)
                    held_ids, texts = ([], []) if ended else (held_ids[-1:], texts[-1:])
                    size = 0
                elif ended:
                    ended = False

    return dealt.mapInArrow(run, schema)
