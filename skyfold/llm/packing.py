"""Order-preserving packing of documents into token sequences.

Documents keep their order within a partition. Their tokens form one stream,
and dynamic programming chooses where to cut it into sequences of at most
``capacity`` tokens. A cut may stand at a document's end (free), at a
sentence's end or, within a long sentence, at a word's end; the last two pay
a truncation penalty. A sequence pays its padding to ``capacity``, unless its
length is a power of two, which is left as it is but pays a fixed charge.

    best(j) = min over cuts i < j with j - i <= capacity of
              best(i) + padding(j - i) + penalty(j)

Padding is linear in j - i, so the minimum over the sliding range is the
front of a monotone queue of ``best(i) + i``; powers of two are looked up.

Tokenizing needs the tokenizer for *new* parts of texts only: it drops white
space, never joins two words, and treats letters, digits and punctuation one
by one. The ids of known parts come from a dictionary of bounded size that
the tasks of a Python worker share.

Each partition is packed in blocks of about ``BLOCK_TOKENS`` tokens: all
sequences but the last of a block are final, and the open one goes on into
the next block. There is no shuffle; memory holds a block (or one longer
document). ``sequence_id`` is unique: partition number * 2**32 + counter.

Null text: empty, so a document of one token, the end id. Repeated rows are
packed one by one. Extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm.text import LOWER, U64, column_buffers, doc_slices, range_hashes

CAPACITY = 4096
END_ID = 2
SENTENCE_PENALTY = 12
WORD_PENALTY = 40
SMALL_CHARGE = 24  # of a sequence that ends at a power of two
SMALLEST_POWER = 128
MAX_GAP = 128  # tokens between two possible cuts
BLOCK_TOKENS = 1 << 18
WORD_CACHE = 3 << 20

PIECES = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


_CLASS = np.full(256, 3, dtype=np.uint8)  # digits' neighbours, apostrophes, non-ASCII: never a boundary beside them
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[0x61:0x7B] = 1
_CLASS[[x for x in range(0x21, 0x7F) if not (chr(x).isalnum() or x == 0x27)]] = 2
_CLASS[0x30:0x3A] = 4


def _pieces(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the parts that the tokenizer surely treats one by one:
    words, split where an ASCII letter, a digit and ASCII punctuation meet
    (not at apostrophes), and digits."""
    c = _CLASS[low]
    before = np.empty(len(c) + 1, dtype=np.uint8)
    before[0] = 0
    before[1:] = c
    before[offsets] = 0
    before = before[: len(c)]
    plain = (c != 3) & (before != 3)
    begin = (c != 0) & ((before == 0) | plain & ((before != c) | (c == 4)))
    start = np.flatnonzero(begin)
    # a part ends where the next begins or at white space or its document's end
    blank = np.append(c == 0, True)
    blank[offsets[1:]] = True
    blank[:-1] |= begin
    stops = np.flatnonzero(blank)
    return start, stops[np.searchsorted(stops, start, side="right")] if len(start) else start


class WordTokenizer:
    """Token ids of whole texts through a cache of the ids of their parts,
    looked up by 64-bit hash; only new parts go to the tokenizer."""

    def __init__(self, path: str, cache: int = WORD_CACHE):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.max = cache
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, U64)
        self.begin = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.stop = np.zeros(0, bool)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, parts: list[str]) -> None:
        ids = [e.ids for e in self.tok.encode_batch_fast(parts, add_special_tokens=False)]
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        begin = len(self.flat) + np.cumsum(length) - length
        stop = np.fromiter((any(c in ".!?" for c in p[-2:]) for p in parts), bool, len(parts))
        self.flat = np.concatenate([self.flat, np.fromiter((x for i in ids for x in i), np.uint32, int(length.sum()))])
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.begin, self.length, self.stop = (np.insert(a, at, b) for a, b in ((self.begin, begin), (self.length, length), (self.stop, stop)))

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets per text, cut class per token: 0 inside a part, 1
        end of a part, 2 end of a sentence) of the texts of one slice."""
        if b"<|" in raw.tobytes():  # perhaps a special token's string: texts as they are
            return self._encode_plain(raw, offsets)
        low = LOWER[raw]
        start, end = _pieces(low, offsets)
        hashes = range_hashes(low, start, end)
        distinct, first, use = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > self.max:
            self.clear()
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != distinct[inside]
        if new.any():
            data = low.tobytes()
            self._learn(distinct[new], [data[start[x] : end[x]].decode("utf-8", "replace") for x in first[new].tolist()])
            at = np.searchsorted(self.known, distinct)
        use = at[use]
        n = self.length[use]
        upto = np.zeros(len(n) + 1, dtype=np.int64)
        np.cumsum(n, out=upto[1:])
        total = int(upto[-1])
        ids = self.flat[np.repeat(self.begin[use] - upto[:-1], n) + np.arange(total)]
        ends = np.zeros(total, dtype=np.uint8)
        full = n > 0
        ends[upto[1:][full] - 1] = 1 + self.stop[use][full]
        return ids, upto[np.searchsorted(start, offsets)], ends

    def _encode_plain(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        texts = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        own = [np.array(e.ids, dtype=np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        first = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
        ids = np.concatenate(own)
        return ids, first, np.ones(len(ids), dtype=np.uint8)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def shared_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer and cache for all tasks of a Python worker."""
    if path not in _TOKENIZERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def choose_cuts(cuts: np.ndarray, penalty: np.ndarray, capacity: int = CAPACITY) -> list[int]:
    """Indices into ``cuts`` (ascending token positions after 0, the last is
    the end; gaps at most ``capacity``) where sequences end."""
    pos = [0, *cuts.tolist()]
    pen = [0, *penalty.tolist()]
    n = len(pos)
    best = [0] * n
    back = [0] * n
    at = {0: 0}
    queue: deque[int] = deque([0])
    powers = [p for p in (1 << x for x in range(capacity.bit_length())) if SMALLEST_POWER <= p < capacity]
    key = [0] * n
    for j in range(1, n):
        p = pos[j]
        low = p - capacity
        while pos[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        cost = key[i] + capacity - p
        for q in powers:
            x = at.get(p - q)
            if x is not None and best[x] + SMALL_CHARGE < cost:
                cost, i = best[x] + SMALL_CHARGE, x
        cost += pen[j]
        best[j], back[j], at[p] = cost, i, j
        k = key[j] = cost + p
        while queue and key[queue[-1]] >= k:
            queue.pop()
        queue.append(j)
    out, j = [], n - 1
    while j:
        out.append(j - 1)
        j = back[j]
    return out[::-1]


def _tail(length: int) -> list[int]:
    """Lengths of a partition's last sequences: the powers of two that make
    up what is left, so nothing is padded."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


def _cut_points(ends: np.ndarray, doc_ends: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Possible cuts of a block and their penalties: document ends, sentence
    ends, and ends of words (or, failing these, any token) in long gaps."""
    n = len(ends)
    cost = np.full(n + 1, -1, dtype=np.int64)
    cost[1:][ends == 2] = SENTENCE_PENALTY
    cost[doc_ends] = 0
    gap = min(MAX_GAP, capacity)
    strong = np.concatenate([[0], np.flatnonzero(cost[1:] >= 0) + 1, [n]])
    for a, b in zip(strong[:-1][np.diff(strong) > gap], strong[1:][np.diff(strong) > gap], strict=True):
        words = np.flatnonzero(ends[a:b] == 1) + a + 1
        at = a
        while b - at > gap:
            x = words[np.searchsorted(words, at + gap, side="right") - 1] if len(words) else 0
            at = int(x) if x > at else at + gap
            if cost[at] < 0:
                cost[at] = WORD_PENALTY
    cost[n] = max(cost[n], 0) if n in doc_ends else 0
    where = np.flatnonzero(cost[1:] >= 0) + 1
    return where, cost[where]


class _Packer:
    """Packs a partition's stream block by block."""

    def __init__(self, partition: int, capacity: int):
        self.sequence = partition << 32
        self.capacity = capacity
        self.docs: list[list] = []  # [id, tokens of the document, done of it, ids left, ends left]
        self.held = 0

    def add(self, doc_id, ids: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        self.docs.append([doc_id, len(ids), 0, ids, ends])
        self.held += len(ids)
        if self.held >= max(BLOCK_TOKENS, 16 * self.capacity):
            yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[tuple]:
        if not self.docs:
            return
        ends = np.concatenate([d[4] for d in self.docs])
        doc_ends = np.cumsum([len(d[3]) for d in self.docs])
        where, cost = _cut_points(ends, doc_ends, self.capacity)
        cuts = where[choose_cuts(where, cost, self.capacity)].tolist()
        if last:
            before = cuts[-2] if len(cuts) > 1 else 0
            cuts = cuts[:-1]
            for x in _tail(int(doc_ends[-1]) - before):
                before += x
                cuts.append(before)
        else:
            cuts = cuts[:-1]
        at, d = 0, 0
        for cut in cuts:
            offset = 0
            while at < cut:
                doc = self.docs[d]
                n = min(cut - at, len(doc[3]))
                yield doc[0], doc[2], n, zlib.crc32(doc[3][:n].tobytes()) & 0xFFFFFFFF, doc[1], self.sequence, offset
                doc[2], doc[3], doc[4] = doc[2] + n, doc[3][n:], doc[4][n:]
                at, offset = at + n, offset + n
                if not len(doc[3]):
                    d += 1
            self.sequence += 1
        self.docs = self.docs[d:]
        self.held = sum(len(x[3]) for x in self.docs)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = shared_tokenizer(tokenizer_path)
        packer = _Packer(TaskContext.get().partitionId(), capacity)
        id_type = None
        rows: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
            types = [id_type, *[pa.int64()] * 6]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        for batch in batches:
            id_type = batch.column(0).type
            ids = batch.column(0).to_pylist()
            raw, offs = column_buffers(batch.column(1))
            for i, j in doc_slices(offs):
                tokens, first, ends = tok.encode(raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                for d in range(j - i):
                    own = np.append(tokens[first[d] : first[d + 1]], np.uint32(end_id))
                    rows += packer.add(ids[i + d], own, np.append(ends[first[d] : first[d + 1]], np.uint8(2)))
                if len(rows) >= 5000:
                    yield batch_of(rows)
                    rows = []
        if id_type is not None:
            rows += packer.flush(True)
            yield batch_of(rows)

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t")).mapInArrow(run, PIECES.format(id=id_type))
