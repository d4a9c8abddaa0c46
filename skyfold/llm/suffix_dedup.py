"""Removal of byte strings that occur more than once (200 bytes by default),
by a sampled suffix array sorted in a common-prefix-aware distributed merge.

A window is ``length`` bytes of one text. Its *anchor* is the position of its
smallest k-gram hash (k = length / 2, the leftmost if tied), so equal windows
have equal anchors, and about every ``length / 4``-th position is an anchor.
Only suffixes that start at anchors are sorted. The windows of an anchor run
from ``b`` bytes before it to ``length - b`` bytes after it, for a range of
b.

1. Every block sends the anchors' k-gram hashes, with a hash of the whole
   stretch that the anchor's windows cover, to the k-grams' buckets. An anchor
   whose k-gram occurs once has no repeated window; one whose stretch occurs
   twice has only repeated windows. Both are settled.
2. The others (around the borders of repeated passages) go to the merge.
   Each block sorts their suffixes and sends each bucket a front-coded run:
   the length of the prefix shared with the suffix before, and the rest. The
   bucket's task merges the runs with a loser tree that keeps the shared
   prefix with the last output for each run, so known prefixes are never
   compared again. The result is a sorted list with the common prefix of
   neighbours. Two windows with the same b are equal exactly if no neighbour
   between them shares less than ``length - b`` bytes and the b bytes before
   them are equal.
3. Every block removes the bytes of its repeated windows.

Texts are read as UTF-8 bytes; null counts as empty. Matches may overlap and
may lie in one document, but never cross documents. Strings are judged on
the input. Repeated documents are all removed where they have ``length``
bytes. Hash equality (64 bits) stands for equality of stretches and of the
bytes before an anchor. A text of any length is scanned in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructType

from skyfold.llm.blocks import ask, bucket_count, over_blocks, with_answers, write_blocks
from skyfold.llm.text import U64, doc_slices, mix64, pack, prefix_sums, range_hashes, split_by, unpack

LENGTH = 200
PIECE_BYTES = 1 << 20
_LOW32 = U64(0xFFFFFFFF)


class Anchors:
    """Anchors of a block: position, first and last window start, end of
    their document, k-gram hash and stretch hash, in order."""

    __slots__ = ("at", "first", "last", "end", "gram", "stretch")

    def __init__(self, parts: list[tuple]):
        cols = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 4 + [np.zeros(0, U64)] * 2
        self.at, self.first, self.last, self.end, self.gram, self.stretch = cols

    def buckets(self, n: int) -> np.ndarray:
        return (mix64(self.gram) % U64(n)).astype(np.int64)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def _piece(raw: np.ndarray, offsets: np.ndarray, base: int, length: int) -> tuple | None:
    k = length // 2
    n = len(raw)
    starts, ends = offsets[:-1], offsets[1:]
    long = ends - starts >= length
    if not long.any():
        return None
    sums = prefix_sums(raw)
    at = np.arange(n - k + 1)
    gram = range_hashes(raw, at, at + k, sums)
    least = _sliding_min((gram >> U64(32) << U64(32)) | at.astype(U64), length - k + 1)
    step = np.zeros(n + 1, dtype=np.int32)
    np.add.at(step, starts[long], 1)
    np.add.at(step, ends[long] - length + 1, -1)
    windows = np.flatnonzero(np.cumsum(step)[: len(least)] > 0)
    anchor = (least[windows] & _LOW32).astype(np.int64)
    cut = np.flatnonzero(np.diff(anchor)) + 1
    g0, g1 = np.concatenate([[0], cut]), np.concatenate([cut, [len(anchor)]]) - 1
    a, first, last = anchor[g0], windows[g0], windows[g1]
    stretch = mix64(range_hashes(raw, first, last + length, sums) + (a - first).astype(U64))
    end = ends[np.searchsorted(starts, a, side="right") - 1]
    return a + base, first + base, last + base, end + base, gram[a], stretch


def find_anchors(raw: np.ndarray, offsets: np.ndarray, length: int) -> Anchors:
    parts = []
    for i, j in doc_slices(offsets, PIECE_BYTES):
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= 2 * PIECE_BYTES:
            parts.append(_piece(raw[lo:hi], offsets[i : j + 1] - lo, lo, length))
            continue
        for at in range(lo, hi - length + 1, PIECE_BYTES):  # one long document, in overlapping pieces
            to = min(hi, at + PIECE_BYTES + length - 1)
            part = _piece(raw[at:to], np.array([0, to - at]), at, length)
            if part is not None:
                part[3][:] = hi
                parts.append(part)
    return Anchors([p for p in parts if p is not None])


# -- step 1: which anchors are repeated ---------------------------------------

ONCE, WHOLE, PARTLY, WHOLE_SENT = 0, 1, 2, 3


def judge_anchors(messages: list[bytes]) -> tuple[list[bytes], None]:
    """A code for every anchor that the blocks sent to one bucket."""
    parts = [unpack(m) for m in messages]
    sizes = [len(p[0]) for p in parts]
    gram, stretch = (np.concatenate([p[x] for p in parts]) for x in (0, 1))
    order = np.lexsort((stretch, gram))
    g, s = gram[order], stretch[order]
    new_gram = np.concatenate([[True], g[1:] != g[:-1]])
    new_both = new_gram | np.concatenate([[True], s[1:] != s[:-1]])
    of_gram, of_both = np.cumsum(new_gram) - 1, np.cumsum(new_both) - 1
    n_gram, n_both = np.bincount(of_gram), np.bincount(of_both)
    code = np.where(n_gram[of_gram] == 1, ONCE, np.where(n_both[of_both] > 1, WHOLE, PARTLY)).astype(np.uint8)
    some_partly = np.maximum.reduceat(code == PARTLY, np.flatnonzero(new_gram))[of_gram]
    code[(code == WHOLE) & new_both & some_partly] = WHOLE_SENT  # one of them stands for all in the merge
    out = np.empty(len(code), dtype=np.uint8)
    out[order] = code
    return [pack(x) for x in np.split(out, np.cumsum(sizes)[:-1])], None


# -- step 2: front-coded runs and their merge ---------------------------------


def front_code(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(shared prefix with the one before, length, remaining bytes joined)
    of sorted strings."""
    shared = np.zeros(len(suffixes), dtype=np.int32)
    for i in range(1, len(suffixes)):
        shared[i] = common_prefix(suffixes[i - 1], suffixes[i], 0)
    lens = np.fromiter(map(len, suffixes), np.int32, len(suffixes))
    return shared, lens, b"".join(s[h:] for s, h in zip(suffixes, shared.tolist(), strict=True))


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    lo, hi = known, n
    while hi - lo > 1:  # a[lo:hi] differ, all before lo is equal
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def merge_runs(runs: list[tuple[list[int], list[int], bytes]]) -> Iterator[tuple[int, int, int]]:
    """(run, index in run, prefix shared with the output before) in sorted
    order, by a loser tree.

    Each run's front item carries the prefix it shares with the last output.
    The one that shares more is smaller; only if both share the same, bytes
    are compared, from there on.
    """
    k = len(runs)
    cur: list[bytes | None] = [None] * k
    nxt = [0] * k
    pos = [0] * k

    def advance(r: int) -> int:
        shared, lens, rest = runs[r]
        i = nxt[r]
        if i == len(lens):
            cur[r] = None
            return -1
        h = shared[i]
        p = pos[r]
        q = p + lens[i] - h
        cur[r] = cur[r][:h] + rest[p:q] if h else rest[p:q]
        pos[r], nxt[r] = q, i + 1
        return h

    def duel(a: int, ha: int, b: int, hb: int) -> tuple[int, int, int, int]:
        """(winner, its prefix, loser, its prefix shared with the winner)."""
        if ha > hb:
            return a, ha, b, hb
        if hb > ha:
            return b, hb, a, ha
        x, y = cur[a], cur[b]
        if x is None or y is None:
            return (a, ha, b, hb) if y is None else (b, hb, a, ha)
        h = common_prefix(x, y, ha)
        if x[h : h + 1] <= y[h : h + 1]:
            return a, ha, b, h
        return b, hb, a, h

    size = 1
    while size < k:
        size *= 2
    loser: list[tuple[int, int]] = [(-1, -1)] * size
    fronts = []
    for r in range(size):
        if r < k:
            fronts.append((r, 0 if advance(r) >= 0 else -1))
        else:
            fronts.append((r, -1))
    cur += [None] * (size - k)
    level = fronts
    base = size
    while base > 1:
        base //= 2
        up = []
        for x in range(base):
            (a, ha), (b, hb) = level[2 * x], level[2 * x + 1]
            w, hw, lo, hl = duel(a, ha, b, hb)
            loser[base + x] = (lo, hl)
            up.append((w, hw))
        level = up
    w, hw = level[0]
    while cur[w] is not None:
        yield w, nxt[w] - 1, hw
        hw = advance(w)
        node = (size + w) >> 1
        while node:
            r, hr = loser[node]
            if hr > hw or hr == hw:
                w, hw, lo, hl = duel(w, hw, r, hr)
                loser[node] = (lo, hl)
            node >>= 1


def resolve(messages: list[bytes], length: int) -> tuple[list[bytes], None]:
    """Merge one bucket's runs; answer with a bit mask over b for every
    suffix of each block (in the order sent)."""
    parts = [unpack(m) for m in messages]
    k = length - length // 2  # b runs from 0 to k
    runs = [(p[0].tolist(), p[1].tolist(), p[2].tobytes()) for p in parts]
    merged = list(merge_runs(runs))
    first = np.concatenate([[0], np.cumsum([len(p[1]) for p in parts])])
    who = np.array([first[r] + i for r, i, _ in merged], dtype=np.int64)
    shared = np.array([h for _, _, h in merged], dtype=np.int32)
    least, most = (np.concatenate([p[x] for p in parts])[who].astype(np.int32) for x in (3, 4))
    before = np.concatenate([p[5] for p in parts])  # the bytes before each anchor, joined
    upto = np.cumsum(np.concatenate([p[4] for p in parts]).astype(np.int64))[who]
    hashed = np.zeros(len(who), dtype=U64)
    bits = np.zeros((len(who), (k + 8) // 8), dtype=np.uint8)
    shared[:1] = 0
    for b in range(k + 1):
        if b:
            far = np.flatnonzero(most >= b)
            hashed[far] = mix64(hashed[far] * U64(0x9E3779B97F4A7C15) + before[upto[far] - b].astype(U64) + U64(1))
        use = np.flatnonzero((least <= b) & (b <= most))
        if len(use) < 2:
            continue
        same_after = np.cumsum(shared < length - b)  # equal numbers: equal for length - b bytes
        key = mix64(hashed[use] + same_after[use].astype(U64) * U64(0xD6E8FEB86659FD93))
        order = np.argsort(key)
        eq = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(use), dtype=bool)
        twice[order[1:]] |= eq
        twice[order[:-1]] |= eq
        bits[use[twice], b >> 3] |= np.uint8(1 << (b & 7))
    out = np.empty_like(bits)
    out[who] = bits
    return [pack(x.reshape(-1)) for x in np.split(out, first[1:-1])], None


# -- the operator ---------------------------------------------------------------


def repeated_bytes(docs: DataFrame, text_col: str = "text", length: int = LENGTH, with_kept: bool = False) -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_bytes, n_removed,
    n_spans, kept_sha256`` (and ``kept``: the remaining text without
    characters of which only a part remains; null for null texts), in place
    of columns of these names."""
    spark = docs.sparkSession
    docs = docs.drop(*({"n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_kept else [])} - {text_col}))
    names = [c for c in docs.columns if c != text_col]
    n = bucket_count(spark)
    blocks = write_blocks(docs, text_col)

    def ask_anchors(raw, offs, _docs, _got):
        found = find_anchors(raw, offs, length)
        for b, (gram, stretch) in split_by(found.buckets(n), n, found.gram, found.stretch):
            yield b, pack(gram, stretch)

    codes = ask(blocks, ask_anchors, judge_anchors, n, "anchor_codes")

    def known(found: Anchors, got: dict) -> tuple[np.ndarray, np.ndarray]:
        """(code of every anchor, bucket of every anchor)."""
        code, bucket = np.zeros(len(found.at), np.uint8), found.buckets(n)
        for b, (at,) in split_by(bucket, n, np.arange(len(bucket))):
            code[at] = unpack(got["codes"][b])[0]
        return code, bucket

    def run_order(raw, found, at) -> tuple[np.ndarray, list[bytes]]:
        data = [raw[a : min(a + length, e)].tobytes() for a, e in zip(found.at[at].tolist(), found.end[at].tolist(), strict=True)]
        order = sorted(range(len(data)), key=data.__getitem__)
        return at[order], [data[x] for x in order]

    def ask_runs(raw, offs, _docs, got):
        found = find_anchors(raw, offs, length)
        code, bucket = known(found, got)
        sent = np.flatnonzero(code >= PARTLY)
        for b, (at,) in split_by(bucket[sent], n, sent):
            at, data = run_order(raw, found, at)
            shared, lens, rest = front_code(data)
            before = b"".join(raw[f:a].tobytes() for f, a in zip(found.first[at].tolist(), found.at[at].tolist(), strict=True))
            yield b, pack(
                shared, lens, np.frombuffer(rest, np.uint8), (found.at[at] - found.last[at]).astype(np.int16),
                (found.at[at] - found.first[at]).astype(np.int16), np.frombuffer(before, np.uint8),
            )

    settled = ask(with_answers(blocks, codes=codes), ask_runs, lambda m: resolve(m, length), n, "suffix_runs")
    out_names = [*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_kept else [])]
    schema = StructType([docs.schema[c] for c in names])
    for c in ("n_bytes", "n_removed", "n_spans"):
        schema.add(c, LongType())
    schema.add("kept_sha256", StringType())
    if with_kept:
        schema.add("kept", StringType())

    def finish(_block, raw, offs, rest, got):
        found = find_anchors(raw, offs, length)
        code, bucket = known(found, got)
        whole = (code == WHOLE) | (code == WHOLE_SENT)
        lo, hi = [found.first[whole]], [found.last[whole] + length]
        sent = np.flatnonzero(code >= PARTLY)
        for b, (at,) in split_by(bucket[sent], n, sent):
            at, _ = run_order(raw, found, at)
            bits = unpack(got["settled"][b])[0].reshape(len(at), -1)
            who, back = np.nonzero(np.unpackbits(bits, axis=1, bitorder="little"))
            lo.append(found.at[at[who]] - back)
            hi.append(lo[-1] + length)
        spans = _union(np.concatenate(lo), np.concatenate(hi), offs)
        of = np.searchsorted(offs, spans[:, 0], side="right") - 1
        first = np.searchsorted(of, np.arange(len(offs)))
        removed, sums, kept = [], [], []
        data = raw.tobytes()
        for d in range(len(offs) - 1):
            at, parts = int(offs[d]), []
            cut = 0
            for s, e in spans[first[d] : first[d + 1]].tolist():
                parts.append(data[at:s])
                at, cut = e, cut + e - s
            parts.append(data[at : offs[d + 1]])
            left = b"".join(parts)
            removed.append(cut)
            sums.append(hashlib.sha256(left).hexdigest())
            kept.append(left)
        cols = [pa.array(np.diff(offs)), pa.array(removed, pa.int64()), pa.array(np.diff(first)), pa.array(sums, pa.string())]
        if with_kept:
            absent = rest.column("absent").to_pylist()
            cols.append(pa.array([None if a else k.decode("utf-8", "ignore") for a, k in zip(absent, kept, strict=True)], pa.string()))
        yield pa.RecordBatch.from_arrays([*rest.columns[:-1], *cols], out_names)

    return over_blocks(with_answers(blocks, codes=codes, settled=settled), finish, schema)


def _union(lo: np.ndarray, hi: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Maximal runs of the union of intervals, kept apart at document
    borders; one row (start, end) each."""
    if not len(lo):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    doc = np.searchsorted(offsets, lo, side="right")
    new = np.concatenate([[True], (lo[1:] > hi[:-1]) | (doc[1:] != doc[:-1])])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(lo) - 1]])
    return np.stack([lo[new], hi[last]], axis=1)
