"""Source audit, prefix trie and mixing against plain Python, on small tables
with nulls, empty texts, ties, repeated rows and clashing extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from skyfold.llm import mixing, prefix_trie, source_audit

# -- source audit -----------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def audit_brute(rows, min_docs, top):
    docs = [(k or "", s or "", TERM.findall(lower(t or ""))) for k, s, t in rows]
    out = []
    for lang in {k for k, _, _ in docs}:
        df, counts, total = Counter(), defaultdict(Counter), Counter()
        for k, s, terms in docs:
            if k == lang:
                df.update(set(terms))
                counts[s].update(terms)
                total.update(terms)
        kept = [t for t in df if df[t] >= min_docs]
        v = len(kept)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * v) for t in kept}

        q = shares(total)
        p = {s: shares(c) for s, c in counts.items()}
        for s in p:
            far = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in p if o != s)
            out += [(lang, s, "pair", o, -f, r) for r, (f, _, o) in enumerate(far, 1)]
            above = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t, -f, r) for r, (f, _, t) in enumerate(above[:top], 1)]
    return sorted(out)


def audit_rows():
    rng = random.Random(3)
    words = ["the", "ÉTÉ", "été", "cat", "Dog", "x9y", "a-b", "lone", "naïve", "z"]
    rows = [(rng.choice(["en", "fr", None, ""]), rng.choice(["a", "b", "c", None, "é"]), " ".join(rng.choices(words, k=rng.randint(0, 12)))) for _ in range(90)]
    rows += [("en", "only numbers", "12 34 --"), ("en", "none", None), ("de", "x", None), ("de", "y", ""), ("qq", "one", "alone"), ("en", "long", "cat " * 3000)]
    return rows + rows[:5]


def as_rows(frame):
    return sorted(tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("max_vocabulary, block_cells", [(1000, 1 << 18), (3, 7)])
def test_audit_equals_plain_python(spark, max_vocabulary, block_cells):
    rows = audit_rows()
    docs = spark.createDataFrame([(*r, "value", 1) for r in rows], "lang string, source string, text string, item string, rank int")
    got = as_rows(source_audit.audit_sources(docs, min_docs=3, top=4, max_vocabulary=max_vocabulary, block_cells=block_cells))
    assert got == audit_brute(rows, 3, 4)


def test_audit_without_terms_or_rows(spark):
    schema = "lang string, source string, text string"
    few = [("en", "a", "cat"), ("en", "b", None), (None, "c", "dog")]
    assert as_rows(source_audit.audit_sources(spark.createDataFrame(few, schema))) == audit_brute(few, 30, 50)
    assert source_audit.audit_sources(spark.createDataFrame([], schema)).count() == 0


def test_pair_sums_equal_dense_sums():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n, v = int(rng.integers(1, 8)), int(rng.integers(0, 12))
        p0 = rng.integers(1, 50, n)
        dense = np.repeat(p0[:, None], v, axis=1)
        there = rng.random((n, v)) < 0.4
        if v:
            there[rng.integers(0, n, v), np.arange(v)] = True  # every kept term is in some source
        dense[there] = rng.integers(1, 90, int(there.sum()))
        source, term = np.nonzero(there)
        sums = np.zeros((n, n), np.int64)
        for i, x in source_audit.pair_sums(p0, source, term, dense[source, term]):
            sums[i] += x
        got = sums + sums.T
        want = np.abs(dense[:, None, :] - dense[None, :, :]).sum(axis=2)
        assert (got == want)[~np.eye(n, dtype=bool)].all()


# -- prefix trie ------------------------------------------------------------


def ordered(rows):
    """Conversations: lists of (role, text), ties as the operator breaks them."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            by[c].append((turn is not None, turn or 0, tie, (role, text)))
    return {c: [x[-1] for x in sorted(turns)] for c, turns in by.items()}


def lent(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
    return out


def trie_brute(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids = Counter(n[:-1] for n in members if n)
    out = []
    for n, m in members.items():
        below = [x for x in members if x[: len(n)] == n]
        ends = ",".join(str(c) for c in m if len(convs[c]) == len(n))
        out.append((
            m[0], len(n), members[n[:-1]][0] if n else None, len(m), kids[n], sum(not kids[x] for x in below),
            sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_rows(frame):
    return sorted((tuple(r) for r in frame.select(*NAMES).collect()), key=str)


def conversations():
    rng = random.Random(5)
    rows = []
    for c in [*range(40), 100, *range(105, 150), 205, 206, 207, -3, -100]:
        for turn in range(rng.randint(1, 7)):
            rows.append((c, turn, rng.choice(["user", None, "a"]), rng.choice(["", "hé", "long text", None, "x"])))
    rows += [(c, t, "user", "the same") for c in range(300, 380) for t in range(3)]  # copies of one conversation
    rows += [(400, None, "late", "null turn"), (400, 0, "b", "tie"), (400, 0, "a", "tie"), (400, 0, "a", "tie"), (None, 0, "lost", "row"), (401, 1, "u", "w" * 5000)]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, depth long, digest string, chars string"


@pytest.mark.parametrize("min_limit, max_heavy, shard_rows", [(2, 10_000, 20), (32, 100_000, 100_000), (1, 4, 1000)])
def test_trie_equals_plain_python(spark, min_limit, max_heavy, shard_rows):
    rows = conversations()
    frame = spark.createDataFrame([(*r, 7, "x", "y") for r in rows], SCHEMA)
    turns = prefix_trie.turn_rows(frame)
    own = prefix_trie.prefix_trie(prefix_trie.conversation_rows(turns), max_heavy, min_limit, shard_rows)
    assert trie_rows(own) == trie_brute(ordered(rows))
    again = prefix_trie.prefix_trie(prefix_trie.lend_heads(turns), max_heavy, min_limit, shard_rows)
    assert trie_rows(again) == trie_brute(lent(ordered(rows)))


def test_trie_of_nothing_and_of_long_lists_of_ends(spark, monkeypatch):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(prefix_trie.lend_heads(prefix_trie.turn_rows(none))).count() == 0
    rows = [(c, 0, "u", "hi") for c in range(20_000)]
    got = trie_rows(prefix_trie.prefix_trie(prefix_trie.conversation_rows(prefix_trie.turn_rows(spark.createDataFrame([(*r, 0, "", "") for r in rows], SCHEMA)))))
    assert got == trie_brute({c: [("u", "hi")] for c in range(20_000)})


def test_perfect_table():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000):
        keys = rng.integers(0, 1 << 63, (n, 2)).astype(np.uint64)
        table = prefix_trie.PerfectTable(keys)
        assert sorted(table.slots(keys)) == list(range(n))
        assert (table.slots(rng.integers(0, 1 << 63, (500, 2)).astype(np.uint64)) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.PerfectTable(np.zeros((2, 2), np.uint64))


# -- mixing -----------------------------------------------------------------


def targets_brute(sizes):
    """Shares the words by weight, again and again, as the contract says."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        share = {s: Fraction(left * weight[s], sum(weight[x] for x in free)) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {s: share.get(s, Fraction(3 * sizes[s])) for s in names}
        full |= over


def mix_rows():
    rng = random.Random(11)
    rows = [(d, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "big", "big", "big", "c", "é", None, "z"])) for d in range(300)]
    rows += [(None, "no id here", "a"), (None, "no id here", "a"), (5, None, "a"), (6, "", "c"), (7, "tiny one", "solo"), (8, None, "empty"), (9, "x\ty\x0bz  ", "c")]
    return rows + rows[:4]


@pytest.mark.parametrize("bucket_rows", [7, 4000])
def test_mix_keeps_its_contract(spark, bucket_rows):
    rows = mix_rows()
    docs = spark.createDataFrame([(*r, 1.0, "b") for r in rows], "doc_id long, text string, source string, position double, bucket string")
    got = mixing.by_first_position(mixing.mix_sources(docs, bucket_rows=bucket_rows)).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((d, s, size(t)) for d, t, s in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    want = targets_brute(sizes)
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.taken <= 3 * r.size
        assert r.taken == sum(u.words for u in r.uses) and (r.position is None) == (not r.taken)
        assert [u.epoch for u in r.uses] == list(range(len(r.uses))) and all(0 <= u.position <= 1 for u in r.uses)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    at = [r.position for r in got if r.position is not None]
    assert at == sorted(at)
    again = mixing.by_first_position(mixing.mix_sources(docs.repartition(5), bucket_rows=bucket_rows)).collect()
    assert Counter((r.doc_id, r.source, r.size, r.taken, r.position) for r in got) == Counter((r.doc_id, r.source, r.size, r.taken, r.position) for r in again)


def test_positions_follow_the_schedules(spark):
    """In the order of training, what was taken from a source up to a
    document is the integral of its schedule up to the document's position."""
    rows = [(d, "w " * 10, "abc"[d % 3]) for d in range(600)]
    schedules = (((0.0, 2.0), (0.5, 0.0), (1.0, 1.0)), ((0.0, 0.0), (1.0, 1.0)), ((0.0, 1.0), (0.25, 1.0), (1.0, 3.0)))
    mixed = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), schedules=schedules)
    order = mixing.training_order(mixed.withColumnRenamed("doc_id", "id"), "id").collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    source = {d: s for d, _, s in rows}
    target = {r.source: r.target for r in mixed.select("source", "target").distinct().collect()}

    def integral(knots, t):
        area = lambda end: sum(
            (min(b, end) - a) * (u + u + (v - u) * (min(b, end) - a) / (b - a)) / 2 for (a, u), (b, v) in zip(knots, knots[1:], strict=False) if a < end
        )
        return area(t) / area(1.0)

    done = Counter()
    for r in order:
        s = source[r.id]
        assert integral(schedules["abc".index(s)], r.position) * target[s] == pytest.approx(done[s], abs=1e-6)
        done[s] += r.words
    assert all(abs(done[s] - target[s]) <= 1 for s in target)


def test_mix_of_nothing(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.by_first_position(mixing.mix_sources(spark.createDataFrame([], schema))).count() == 0
    got = mixing.mix_sources(spark.createDataFrame([(1, None, "a"), (2, "", None)], schema)).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    with pytest.raises(ValueError):
        mixing.segments(((0.0, 1.0), (0.9, 1.0)))
