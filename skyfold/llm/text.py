"""Vectorised text kernels that the operators of this subpackage share.

All of them work on the UTF-8 bytes of an Arrow string column, a bounded
slice of documents at a time (``doc_slices``), so the working memory of a
task depends on the slice size (or on its longest single document), never
on the partition. Words are maximal runs of bytes of one class; every byte
of a multi-byte UTF-8 character is >= 0x80, so byte classes are exact for
the word definitions used here.

Word and n-gram hashes are 64 bit: a polynomial over random byte values,
finished with a mixing step. Equal words have equal hashes. Different ones
share a hash with a probability of about 2**-64 per pair.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 1 << 20

_BYTES = np.arange(256, dtype=np.uint8)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
#: Everything but space and \t..\r belongs to a word.
SPACE_WORDS = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Digits, lower-case a-z and non-ASCII characters belong to a word.
ALNUM_WORDS = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)

_M1, _M2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_S33 = U64(33)
_P = 0x9E3779B97F4A7C15
_Q = 0xD6E8FEB86659FD93
_PINV = pow(_P, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit hashes (a bijection)."""
    x = x ^ (x >> _S33)
    x = x * _M1
    x ^= x >> _S33
    x *= _M2
    x ^= x >> _S33
    return x


_BYTE_VALUES = mix64(np.arange(1, 257, dtype=U64) * U64(_Q))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=U64)
    out[0] = 1
    done = 1
    while done < n:  # doubling: out[done:2*done] = out[:done] * base**done
        take = min(done, n - done)
        out[done : done + take] = out[:take] * U64(pow(base, done, 1 << 64))
        done += take
    return out


class _PowerTables:
    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_P, n), _powers(_PINV, n)
        return self.up, self.down


_TABLES = _PowerTables()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, at least, of the base of the hashes of ranges, and
    those of its inverse."""
    return _TABLES.get(n)


def column_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    if n == 0 or col.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def doc_slices(offsets: np.ndarray, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive document ranges [i, j) of at most ``max_bytes`` together
    (one document alone may be longer)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: the basis of the hash of any byte range."""
    up, _ = _TABLES.get(len(data) + 1)
    total = np.empty(len(data) + 1, dtype=U64)
    total[0] = 0
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=total[1:])
    return total


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of byte ranges of one slice."""
    total = prefix_sums(data) if sums is None else sums
    _, down = _TABLES.get(len(data) + 1)
    return mix64((total[end] - total[start]) * down[start])


class Words:
    """Words of the documents of one slice.

    ``start``/``end``: byte ranges in ``lower`` (the lower-cased bytes of
    the slice); ``first``: for document d its words are
    ``first[d] .. first[d+1]``; ``hash``: 64-bit word hashes.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, hashes: bool = True):
        low = LOWER[raw]
        n = len(low)
        offs = offsets - offsets[0]
        inside = is_word[low]
        before = np.empty(n + 1, dtype=bool)
        before[0] = False
        before[1:] = inside
        before[offs] = False  # a document never continues the word of the one before
        self.start = np.flatnonzero(inside & ~before[:n])
        after = np.empty(n + 1, dtype=bool)
        after[:n] = inside
        after[n] = False
        after[offs] = False
        self.end = np.flatnonzero(inside & ~after[1:]) + 1
        self.lower = low
        self.first = np.searchsorted(self.start, offs)
        self.hash = range_hashes(low, self.start, self.end) if hashes else None

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        """Document index of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def room(self) -> np.ndarray:
        """Number of words from each word to the end of its document."""
        return np.repeat(self.first[1:], self.counts()) - np.arange(len(self.start))


def words_of(raw: np.ndarray, offsets: np.ndarray, i: int, j: int, is_word: np.ndarray, hashes: bool = True) -> Words:
    return Words(raw[offsets[i] : offsets[j]], offsets[i : j + 1], is_word, hashes)


_Q_POWERS = _powers(_Q, 64)


def gram_hashes(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that begin at each word (length len - k + 1);
    callers mask the ones that cross a document's end."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = word_hash[:n].copy()
    for j in range(1, k):
        out += word_hash[j : j + n] * U64(pow(_Q, j, 1 << 64))
    return mix64(out + U64(k))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every k-word shingle, in order; a document of
    fewer words, but not none, gives its whole sequence as one shingle."""
    counts = words.counts()
    g = gram_hashes(words.hash, k)
    keep = words.room()[: len(g)] >= k
    doc = words.doc_of()
    h, d = g[keep], doc[: len(g)][keep]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.empty(len(short), dtype=U64)
        for x, s in enumerate(short):
            w = words.hash[words.first[s] : words.first[s + 1]]
            extra[x] = gram_hashes(w, len(w))[0]
        h, d = np.concatenate([h, extra]), np.concatenate([d, short])
        order = np.argsort(d, kind="stable")
        h, d = h[order], d[order]
    return h, d


def distinct_sets(hashes: np.ndarray, docs: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes per document: (values, first) with the set of
    document d in ``values[first[d]:first[d+1]]``."""
    order = np.lexsort((hashes, docs))
    h, d = hashes[order], docs[order]
    if len(h):
        new = np.empty(len(h), dtype=bool)
        new[0] = True
        np.not_equal(h[1:], h[:-1], out=new[1:])
        new[1:] |= d[1:] != d[:-1]
        h, d = h[new], d[new]
    return h, np.searchsorted(d, np.arange(n_docs + 1))


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


# -- binary blocks: rows of packed arrays that Spark shuffles ---------------


def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as one compressed block (zstd)."""
    import zstandard

    head = [len(arrays)]
    body = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head += [ord(a.dtype.kind), a.dtype.itemsize, a.size]
        # byte planes: the equal high bytes of small numbers come together
        body.append(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes() if a.size and a.dtype.itemsize > 1 else a.tobytes())
    return zstandard.ZstdCompressor(level=level).compress(np.array(head, np.int64).tobytes() + b"".join(body))


def unpack(block: bytes) -> list[np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(block)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, 3 * n, 8).reshape(n, 3)
    out, at = [], 8 + 24 * n
    for kind, width, size in head.tolist():
        dtype = np.dtype(f"{chr(kind)}{width}")
        part = np.frombuffer(data, np.uint8, width * size, at)
        at += width * size
        out.append(np.ascontiguousarray(part.reshape(width, size).T).reshape(-1).view(dtype) if width > 1 and size else part.view(dtype))
    return out


def split_by(bucket: np.ndarray, n: int, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The rows of parallel arrays by bucket number (non-empty ones)."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(n + 1))
    arrays = [a[order] for a in arrays]
    for b in range(n):
        if cuts[b] < cuts[b + 1]:
            yield b, [a[cuts[b] : cuts[b + 1]] for a in arrays]
