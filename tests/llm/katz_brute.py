"""Katz backoff with plain dictionaries, for comparison."""

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^ \t-\r]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def discounts(counts, k=5):
    n = Counter(counts)
    big = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    a = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    out = {}
    for r in range(1, k + 1):
        d = None
        if a < 1 and n[r]:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a)
        out[r] = d if d is not None and 0 < d < 1 else (r - big) / r
    return out


class Brute:
    def __init__(self, texts):
        self.uni, self.bi = Counter(), defaultdict(Counter)
        for t in texts:
            h = "<s>"
            for w in tokens(t):
                self.uni[w] += 1
                self.bi[h][w] += 1
                h = w
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.d1 = discounts(self.uni.values())
        self.d2 = discounts([c for m in self.bi.values() for c in m.values()])
        left = sum((1 - self.d1.get(c, 1)) * c for c in self.uni.values())
        self.extra = 1 if self.n and left <= 0 else 0
        self.unknown = (left + self.extra) / (self.n + self.extra) if self.n else 1.0

    def p1(self, w):
        c = self.uni.get(w, 0)
        return self.d1.get(c, 1) * c / (self.n + self.extra) if c else self.unknown

    def p(self, h, w):
        if h not in self.bi:
            return self.p1(w)
        m = self.bi[h]
        total = sum(m.values()) + (0 if any(c <= 5 for c in m.values()) else 1)
        if w in m:
            return self.d2.get(m[w], 1) * m[w] / total
        left = 1 - sum(self.d2.get(c, 1) * c for c in m.values()) / total
        return left / (1 - sum(self.p1(x) for x in m)) * self.p1(w)

    def score(self, text):
        h, out, base, known, n = "<s>", 0.0, 0.0, 0, 0
        for w in tokens(text):
            out += math.log10(self.p(h, w))
            c = self.uni.get(w, 0)
            base += math.log10((c + 0.1) / (self.n + 0.1 * (self.v + 1)))
            known += c > 0
            n += 1
            h = w
        return n, known, base, out


def tokens(text):
    return [*WORD.findall((text or "").translate(ASCII)), "</s> end"]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 10 == 0
