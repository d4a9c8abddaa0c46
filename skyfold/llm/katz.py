"""Language-model scores by Katz backoff (bigrams over unigrams).

    P(w | h) = d(c(hw)) * c(hw) / c(h)         if hw was seen in training
             = alpha(h) * P(w)                 otherwise, recursively
    P(w)     = d(c(w)) * c(w) / N              if w was seen
             = the mass that is left           for all other words together

d is the Good-Turing discount for counts up to 5 (Katz's form, which leaves
the mass of the singletons to unseen n-grams); alpha(h) is the left mass of
h divided by the left mass of its unseen words, so for each history the
probabilities of the vocabulary and the unknown word sum to 1. Where the
counts of counts give no discount between 0 and 1, (r - D) / r with D =
n1 / (n1 + 2 n2) is used. A history without a small count has one added to its
total, so that mass is left there too.

The counts are kept in tables partitioned by word (level 1) and by history
(level 2). Documents are read as blocks. Each block sends its distinct words
and their training counts to the words' buckets and gets the corpus counts
back; then the same for its distinct bigrams, by history. It scores its
documents from the answers. All documents are counted and scored, whole. No
table is collected or broadcast; the driver sees counts of counts only.

Null and empty texts are the end token alone. Repeated rows are scored, and
counted, one by one. Without training rows every word is unknown (score 0,
as the unknown word has all the mass). Words are identified by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StructType

from skyfold.llm.blocks import ask, bucket_count, over_blocks, reports, with_answers, write_blocks
from skyfold.llm.text import SPACE_WORDS, U64, doc_slices, mix64, pack, split_by, unpack, words_of

END = U64(0x1F2E3D4C5B6A7988)
K = 5
BLOCK_BYTES = 8 << 20


def good_turing(n: np.ndarray, k: int = K) -> np.ndarray:
    """Discounts d[0..k] (d[0] unused) from counts of counts n[0..k+1]."""
    d = np.ones(k + 1)
    big = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    a = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        star = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 1.0
        x = (star - a) / (1 - a) if a < 1 else 1.0
        d[r] = x if 0 < x < 1 else (r - big) / r
    return d


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return c * np.where(c < len(d), d[np.minimum(c, len(d) - 1)], 1.0)


class Unigrams:
    """Level 1: P(w) from a word's count."""

    def __init__(self, tokens: int, words: int, of_counts: np.ndarray):
        self.tokens, self.words, self.d = tokens, words, good_turing(of_counts)
        low = min(len(of_counts) - 1, K) + 1
        left = sum((1 - self.d[r]) * r * of_counts[r] for r in range(1, low))
        self.extra = 1.0 if tokens and left <= 0 else 0.0
        self.unknown = (left + self.extra) / (tokens + self.extra) if tokens else 1.0

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, discounted(c, self.d) / max(1.0, self.tokens + self.extra), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.tokens + 0.1 * (self.words + 1)))


def counts_of_counts(c: np.ndarray, k: int = K) -> np.ndarray:
    return np.bincount(c[c <= k + 1].astype(np.int64), minlength=k + 2)


class _Tokens:
    """Tokens of a block: words and one end for every document."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, held: np.ndarray):
        toks, docs = [], []
        for i, j in doc_slices(offsets):
            w = words_of(raw, offsets, i, j, SPACE_WORDS)
            toks.append(np.insert(w.hash, w.first[1:], END))
            docs.append(np.repeat(np.arange(i, j), w.counts() + 1))
        tok = np.concatenate(toks) if toks else np.zeros(0, U64)
        self.doc = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        self.n_docs = len(offsets) - 1
        self.words, self.use = np.unique(tok, return_inverse=True)
        self.train = ~held[self.doc]
        self.counts = np.bincount(self.use[self.train], minlength=len(self.words)).astype(np.int64)

    def pairs(self) -> None:
        """Distinct (history, word) of the block, by local numbers; history
        ``len(words)`` is the document's start."""
        start = np.concatenate([[True], self.doc[1:] != self.doc[:-1]]) if len(self.doc) else np.zeros(0, bool)
        h = np.where(start, len(self.words), np.roll(self.use, 1))
        key, self.pair_use = np.unique(h.astype(U64) << U64(32) | self.use.astype(U64), return_inverse=True)
        self.h, self.w = (key >> U64(32)).astype(np.int64), (key & U64(0xFFFFFFFF)).astype(np.int64)
        self.pair_counts = np.bincount(self.pair_use[self.train], minlength=len(key)).astype(np.int64)
        self.h_first = np.flatnonzero(np.concatenate([[True], self.h[1:] != self.h[:-1]])) if len(key) else np.zeros(0, np.int64)


def _narrow(x: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds all of x."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def count_words(messages: list[bytes], bucket_step: int) -> tuple[list[bytes], bytes]:
    """Level 1: corpus counts, and a number for every word of the bucket."""
    parts = [unpack(m) for m in messages]
    words, use = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    total = np.bincount(use, weights=np.concatenate([p[1] for p in parts]), minlength=len(words)).astype(np.int64)
    cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
    number = parts[0][2][0].astype(np.int64) + np.arange(len(words)) * bucket_step
    out = [pack(_narrow(total[x]), _narrow(number[x])) for x in np.split(use, cuts)]
    return out, pack(np.array([total.sum(), (total > 0).sum()]), counts_of_counts(total))


def count_pairs(messages: list[bytes], uni: Unigrams) -> tuple[list[bytes], bytes]:
    """Level 2: corpus counts of the bigrams of the bucket's histories, and
    what alpha needs: c(h), how many words follow h r times (r <= K), and
    the unigram mass of all words that follow h."""
    parts = [unpack(m) for m in messages]
    h = np.concatenate([np.repeat(p[0].astype(U64), p[1]) for p in parts])
    w = np.concatenate([p[2].astype(U64) for p in parts])
    c = np.concatenate([p[3] for p in parts]).astype(np.int64)
    cw = np.concatenate([p[4] for p in parts]).astype(np.int64)
    if max(int(h.max()), int(w.max())) < 1 << 32:
        order = np.argsort(h << U64(32) | w, kind="stable")
    else:
        order = np.lexsort((w, h))
    hs, ws = h[order], w[order]
    new_h = np.concatenate([[True], hs[1:] != hs[:-1]])
    new = new_h | np.concatenate([[True], ws[1:] != ws[:-1]])
    at = np.flatnonzero(new)
    total = np.add.reduceat(c[order], at)
    pair_of = np.empty(len(h), dtype=np.int64)
    pair_of[order] = np.cumsum(new) - 1
    h_at = np.flatnonzero(new_h[at])
    h_of_pair = np.cumsum(new_h[at]) - 1
    seen = total > 0
    mass = np.add.reduceat(np.where(seen, uni.p(cw[order][at]), 0.0), h_at)
    c_h = np.add.reduceat(total, h_at)
    small = [np.add.reduceat((total == r).astype(np.int64), h_at) for r in range(1, K + 1)]
    out, first = [], 0
    for p in parts:
        own = pair_of[first : first + len(p[2])]
        first += len(p[2])
        begin = np.cumsum(p[1].astype(np.int64)) - p[1]
        of_h = h_of_pair[own[begin]]
        counts = total[own]
        backs_off = np.add.reduceat((counts == 0).astype(np.int64), begin) > 0  # alpha is not needed elsewhere
        out.append(pack(
            _narrow(counts), _narrow(c_h[of_h]), np.where(backs_off, mass[of_h], 0.0), *(_narrow(np.where(backs_off, s[of_h], 0)) for s in small),
            sum(s[of_h] for s in small) > 0,
        ))
    return out, pack(counts_of_counts(total))


def score(docs: DataFrame, held_col: str, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_tokens, n_known,
    train_tokens, base_score, score`` in place of columns of these names.
    Rows whose boolean ``held_col`` is true are scored, not learned."""
    spark = docs.sparkSession
    docs = docs.drop(*({"n_tokens", "n_known", "train_tokens", "base_score", "score"} - {text_col, held_col}))
    names = [c for c in docs.columns if c != text_col]
    flag = f"c{names.index(held_col)}"
    n = bucket_count(spark)
    blocks = write_blocks(docs, text_col, BLOCK_BYTES)

    def tokens(raw, offs, rest) -> _Tokens:
        return _Tokens(raw, offs, np.array([bool(x) for x in rest.column(flag).to_pylist()], dtype=bool))

    def ask_words(raw, offs, rest, _got):
        t = tokens(raw, offs, rest)
        for b, (words, counts) in split_by((mix64(t.words) % U64(n)).astype(np.int64), n, t.words, t.counts):
            yield b, pack(words, _narrow(counts), np.array([b], np.int32))

    answers1 = ask(blocks, ask_words, lambda m: count_words(m, n), n, "word_counts")
    stats = [unpack(r) for r in reports(answers1)]
    uni = Unigrams(
        int(sum(s[0][0] for s in stats)), int(sum(s[0][1] for s in stats)),
        np.sum([s[1] for s in stats], axis=0) if stats else np.zeros(K + 2, np.int64),
    )

    def counted(t: _Tokens, got: dict) -> tuple[np.ndarray, np.ndarray]:
        """(corpus count, number) of the block's words."""
        count, number = np.zeros(len(t.words), np.int64), np.zeros(len(t.words) + 1, np.int64)
        for b, (at,) in split_by((mix64(t.words) % U64(n)).astype(np.int64), n, np.arange(len(t.words))):
            count[at], number[at] = unpack(got["level1"][b])
        number[:-1] += 1  # 0 is the start of a document
        return count, number

    def by_history(t: _Tokens, number: np.ndarray):
        """(bucket, its histories' positions in h_first, its pairs) in order."""
        sizes = np.diff(np.append(t.h_first, len(t.h)))
        bucket = (mix64(number[t.h[t.h_first]].astype(U64)) % U64(n)).astype(np.int64)
        for b, (hs,) in split_by(bucket, n, np.arange(len(t.h_first))):
            m = sizes[hs]
            yield b, hs, m, np.repeat(t.h_first[hs] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))

    def ask_pairs(raw, offs, rest, got):
        t = tokens(raw, offs, rest)
        count, number = counted(t, got)
        t.pairs()
        for b, hs, m, at in by_history(t, number):
            yield b, pack(
                _narrow(number[t.h[t.h_first[hs]]]), _narrow(m), _narrow(number[t.w[at]]), _narrow(t.pair_counts[at]), _narrow(count[t.w[at]])
            )

    level1 = with_answers(blocks, level1=answers1)
    answers2 = ask(level1, ask_pairs, lambda m: count_pairs(m, uni), n, "pair_counts")
    stats2 = [unpack(r)[0] for r in reports(answers2)]
    d2 = good_turing(np.sum(stats2, axis=0) if stats2 else np.zeros(K + 2, np.int64))

    out_names = [*names, "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = StructType([docs.schema[c] for c in names])
    for c in ("n_tokens", "n_known", "train_tokens"):
        schema.add(c, LongType())
    schema.add("base_score", DoubleType()).add("score", DoubleType())

    def finish(_block, raw, offs, rest, got):
        t = tokens(raw, offs, rest)
        count, number = counted(t, got)
        t.pairs()
        logp = np.zeros(len(t.h))
        p_word = uni.p(count)
        for b, _hs, m, at in by_history(t, number):
            counts, c_h, mass, *small, some_small = unpack(got["level2"][b])
            p = np.empty(len(at))
            c = counts.astype(np.int64)
            total, extra, alpha = history(c_h.astype(np.int64), mass, [s.astype(np.int64) for s in small], some_small.astype(bool), d2)
            of = np.repeat(np.arange(len(m)), m)
            seen = c > 0
            p[seen] = discounted(c[seen], d2) / (total + extra)[of[seen]]
            p[~seen] = alpha[of[~seen]] * p_word[t.w[at[~seen]]]
            logp[at] = np.log10(p)
        by_doc = lambda x: np.bincount(t.doc, weights=x, minlength=t.n_docs)
        tokens_of = np.bincount(t.doc, minlength=t.n_docs)
        cols = [
            tokens_of.astype(np.int64), by_doc((count > 0)[t.use].astype(float)).astype(np.int64),
            np.full(t.n_docs, uni.tokens, np.int64), by_doc(uni.base(count)[t.use]), by_doc(logp[t.pair_use]),
        ]
        yield pa.RecordBatch.from_arrays([*rest.columns[:-1], *map(pa.array, cols)], out_names)

    return over_blocks(with_answers(blocks, level1=answers1, level2=answers2), finish, schema)


def history(c_h: np.ndarray, mass: np.ndarray, small: list[np.ndarray], some_small: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(c(h), 1 where no count was discounted, alpha(h)) of histories."""
    extra = np.where(some_small, 0.0, 1.0)
    taken = sum((1 - d[r]) * r * s for r, s in enumerate(small, 1))
    total = c_h.astype(float)
    left = np.where(c_h > 0, (taken + extra) / (total + extra), 1.0)
    return total, extra, left / (1.0 - np.where(c_h > 0, mass, 0.0))
