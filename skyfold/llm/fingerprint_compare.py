"""Likeness of documents from their published fingerprints alone.

A published fingerprint has ``cells`` cells of (count, sum of digests, 32 bits
of the sum of check hashes). Two of one size are subtracted and peeled, as the
sketches they come from; where cells remain, the sketches are too small for
so many differences, and the answer is None: the documents share little, or a
larger sketch of the texts has to decide.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence

import numpy as np

from skyfold.llm.fingerprints import _CHECK, Sketches
from skyfold.llm.text import U64, mix64

_CELL = [("c", "<i4"), ("k", "<u8"), ("h", "<u4")]
_LOW = U64(0xFFFFFFFF)


class _Published(Sketches):
    """Sketches of which only 32 bits of the check sums are known."""

    def peel(self) -> np.ndarray:
        """Which documents could be peeled; their differing digests are
        counted in ``found``."""
        self.found = np.zeros(self.n, np.int64)
        for _ in range(self.cells * 4):  # 32 bits of check may take a wrong cell for a pure one: no endless peeling
            at = np.flatnonzero((self.count == 1) | (self.count == -1))
            sign = self.count[at]
            key = self.key[at] * sign.astype(U64)
            pure = (mix64(key ^ _CHECK) * sign.astype(U64) & _LOW) == (self.check[at] & _LOW)
            if not pure.any():
                break
            doc, keys, signs = at[pure] // self.cells, key[pure], sign[pure]
            order = np.lexsort((keys, doc))
            doc, keys, signs = doc[order], keys[order], signs[order]
            once = np.concatenate([[True], (doc[1:] != doc[:-1]) | (keys[1:] != keys[:-1])])
            doc, keys, signs = doc[once], keys[once], signs[once]
            self.add(keys, doc, -signs)
            np.add.at(self.found, doc, 1)
        left = (self.count != 0) | (self.key != 0) | ((self.check & _LOW) != 0)
        return ~left.reshape(self.n, self.cells).any(axis=1)


def _parse(fingerprints: Sequence[str]) -> tuple[np.ndarray, int]:
    heads, bodies = zip(*(f.split(":", 1) for f in fingerprints), strict=True)
    if len(set(heads)) > 1:
        raise ValueError("fingerprints of several sizes")
    cells = int(heads[0])
    return np.frombuffer(b"".join(map(base64.b64decode, bodies)), dtype=_CELL), cells


def compare_fingerprints(one: Sequence[str], other: Sequence[str]) -> list[float | None]:
    """Likeness (share of common paragraphs, 0 to 1) of pairs of published
    fingerprints; None where they are too small to tell."""
    if not one:
        return []
    (a, cells), (b, cells_b) = _parse(one), _parse(other)
    if cells != cells_b or len(a) != len(b):
        raise ValueError("fingerprints of several sizes")
    diff = _Published(len(one), cells)
    diff.count = a["c"].astype(np.int64) - b["c"]
    diff.key = a["k"].astype(U64) - b["k"].astype(U64)
    diff.check = (a["h"].astype(U64) - b["h"].astype(U64)) & _LOW
    total = sum(x["c"].reshape(-1, cells).sum(axis=1).astype(np.int64) // 3 for x in (a, b))  # a digest is in three cells
    done = diff.peel()
    like = [(t - d) / (t + d) if t + d else 1.0 for t, d in zip(total.tolist(), diff.found.tolist(), strict=True)]
    return [x if ok else None for x, ok in zip(like, done.tolist(), strict=True)]
