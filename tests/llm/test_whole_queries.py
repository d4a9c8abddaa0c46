"""Registered queries over the whole small tables, against plain Python."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from skyfold.llm import fingerprints, jaccard_join, packing, queries
from skyfold.llm.fingerprint_compare import compare_fingerprints
from skyfold.llm.text import column_buffers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def components(links, nodes):
    head = {n: n for n in nodes}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        head[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("bounds", [{}, {"family_sets": 5}, {"family_tokens": 1500}])
def test_op2_against_all_pairs(spark, texts, bounds):
    sets = {}
    for d, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets[d] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set())
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    got = jaccard_join.jaccard_components(queries.table(spark, SF, "documents"), **bounds).collect()  # families in one part or in several
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {d: (len(sets[d]), c) for d, c in components(links, sets).items()}
    assert len(links) > 5


def test_op3_predicts_held_out_languages(spark, texts):
    lang = {r.doc_id: r.lang for r in queries.table(spark, SF, "documents").select("doc_id", "lang").collect()}
    got = {r.doc_id: r for r in queries.op3_language_id(spark, SF).collect()}
    assert set(got) == set(texts) and all(0 <= r.score <= 1 for r in got.values())
    assert {d for d, r in got.items() if r.held_out} == {d for d in texts if zlib.crc32(str(d).encode()) % 4 == 2}
    has_letter = {d: any(c.isalpha() for c in t or "") for d, t in texts.items()}
    assert {d for d, r in got.items() if r.lang_pred == "und"} == {d for d in texts if not has_letter[d]}
    held = [d for d, r in got.items() if r.held_out and has_letter[d] and lang[d]]
    assert len(held) > 30 and sum(got[d].lang_pred == lang[d] for d in held) >= 0.97 * len(held)


def paragraphs(text):
    raw, offs = column_buffers(pa.array([text], pa.large_string()))
    return set(fingerprints.digests(raw, offs)[0].tolist())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_op4_against_sets_of_paragraphs(spark, texts):
    got = {r.doc_id: r for r in queries.op4_fingerprints(spark, SF).collect()}
    ids = sorted(texts)
    prints = defaultdict(set)
    for d, after in zip(ids, [*ids[1:], ids[0]], strict=True):
        own, following, r = texts[d] or "", texts[after] or "", got[d]
        edited = own[: len(own) - len(own) // 4] + following[: len(own) // 4]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(jaccard(paragraphs(own), paragraphs(edited)))
        assert r.near_next == pytest.approx(jaccard(paragraphs(own), paragraphs(following)))
        prints[own].add(r.fingerprint)
        prints[edited].add(r.edited_fingerprint)
    assert set(got) == set(ids) and all(len(p) == 1 for p in prints.values())


def test_published_fingerprints_can_be_compared(spark, texts):
    """Likeness from the strings alone is that of the query, or None where they are too small."""
    rows = queries.op4_fingerprints(spark, SF).orderBy("doc_id").collect()
    near = compare_fingerprints([r.fingerprint for r in rows], [r.edited_fingerprint for r in rows])
    following = compare_fingerprints([r.fingerprint for r in rows], [r.fingerprint for r in [*rows[1:], rows[0]]])
    for r, x, y in zip(rows, near, following, strict=True):
        assert x is None or x == pytest.approx(r.near_edited)
        assert y is None or y == pytest.approx(r.near_next)
    assert None in following and any(x is not None for x in near)
    # a word more at the end is at most two pieces: 24 cells tell that nearly always
    grown = [f"{texts[r.doc_id] or ''} more" for r in rows]
    small = compare_fingerprints([r.fingerprint for r in rows], fingerprints._sketch(grown)[1].texts())
    for r, x, t in zip(rows, small, grown, strict=True):
        assert x is None or x == pytest.approx(jaccard(paragraphs(texts[r.doc_id] or ""), paragraphs(t)))
    assert sum(x is not None for x in small) >= 0.95 * len(rows)
    assert compare_fingerprints([rows[0].fingerprint], [rows[0].fingerprint]) == [1.0] and compare_fingerprints([], []) == []
    with pytest.raises(ValueError):
        compare_fingerprints([rows[0].fingerprint], ["48:" + rows[0].fingerprint.split(":")[1] * 2])


def test_op5_keeps_groups_and_balances(spark, texts):
    rows = queries.op5_shard(spark, SF).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {d: (8 + len((t or "").encode()), zlib.crc32((t or "").encode())) for d, t in texts.items()}
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None} and {r.shard for r in rows} <= set(range(24))
    shard = {r.doc_id: r.shard for r in rows}
    groups, load, slots = defaultdict(set), Counter(), defaultdict(list)
    for r in rows:
        groups[texts[r.doc_id] or ""].add(shard[r.doc_id])
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in groups.values()) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    weight = Counter()
    for d, t in texts.items():
        weight[t or ""] += 8 + len((t or "").encode())
    # longest processing time: no shard is above the mean by more than the last group it took
    assert max(load.values()) <= sum(load.values()) / 24 + max(weight.values()) and max(load.values()) - min(load.values()) <= max(weight.values())


def test_op7_packs_every_id_once(spark, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    ids = {d: [*tok.encode(t or "", add_special_tokens=False).ids, 2] for d, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in queries.op7_pack(spark, SF).collect():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for spans, total in [*((pieces[d], len(ids[d])) for d in texts), *((s, None) for s in sequences.values())]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == total if total is not None else at <= 4096
    sizes = [sum(n for _, n in s) for s in sequences.values()]
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in sizes)
    assert padding <= 0.02 * sum(sizes)


def test_cuts_equal_an_exhaustive_search():
    rng = np.random.default_rng(7)
    cap = 512

    def cost(length):
        return packing.SMALL_CHARGE if length & (length - 1) == 0 and packing.SMALLEST_POWER <= length < cap else cap - length

    for _ in range(40):
        cuts = np.cumsum(rng.integers(40, 200, rng.integers(1, 11)))
        penalty = rng.choice([0, 12, 40], len(cuts))
        ends = [0, *cuts.tolist()]
        best = {0: 0}
        for j in range(1, len(ends)):
            best[j] = min(best[i] + cost(ends[j] - ends[i]) for i in range(j) if ends[j] - ends[i] <= cap) + int(penalty[j - 1])
        found = [-1, *packing.choose_cuts(cuts, penalty, cap)]
        total = sum(cost(ends[b + 1] - ends[a + 1]) + int(penalty[b]) for a, b in itertools.pairwise(found))
        assert found[-1] == len(cuts) - 1 and total == best[len(cuts)]


def test_op8_against_every_string(spark, texts):
    data = {d: (t or "").encode() for d, t in texts.items()}
    seen = Counter(t[i : i + 200] for t in data.values() for i in range(len(t) - 199))
    want = {}
    for d, t in data.items():
        cut = bytearray(len(t))
        end = 0
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                cut[max(i, end) : i + 200] = b"\x01" * (i + 200 - max(i, end))
                end = i + 200
        left = bytes(b for b, gone in zip(t, cut, strict=True) if not gone)
        want[d] = (len(t), sum(cut), len(re.findall(b"\x01+", bytes(cut))), hashlib.sha256(left).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op8_suffix_dedup(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("words", [12, 60])
def test_op2_chance_meetings_make_no_family(spark, monkeypatch, words):
    """Texts that share a passage with each of many others, but with none enough, do not travel; near copies do.
    Of 12 words, less than 85 % of a text's shingles are in another; of 60, more."""
    n, families = 12, []
    plain = jaccard_join.components
    monkeypatch.setattr(jaccard_join, "components", lambda edges: families.append(plain(edges)) or families[-1])
    texts = [" ".join(f"s{min(i, j)}x{max(i, j)}w{w}" for j in range(n) if j != i for w in range(words)) for i in range(n)]
    near = [f"n{w}" for w in range(200)]
    texts += [" ".join(near), " ".join(near[:199] + ["other"]), " ".join(near)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.n_links) for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == {i: (i, 0) for i in range(n)} | {n: (n, 1), n + 1: (n, 1), n + 2: (n, 1)}
    assert families[0].count() == 2


def test_op2_shared_tokens_and_able_sets():
    """Tokens of two sets count, those of two documents of one set do not; a block that misses a message keeps its sets."""
    u32, u64 = np.uint32, np.uint64
    sent = [
        jaccard_join.pack(np.array([7, 8, 9, 7], u32), np.array([0, 0, 1, 2], u32), np.array([55], u64)),  # the last is of set 55
        jaccard_join.pack(np.array([7, 5, 5, 6], u32), np.array([0, 1, 2, 2], u32), np.array([55, 77, 88, 88], u64)),
        jaccard_join.pack(np.array([9], u32), np.array([3], u32), np.zeros(0, u64)),
        jaccard_join.pack(np.array([6], u32), np.array([0], u32), np.array([88], u64)),
    ]
    answers = [jaccard_join.unpack(a) for a in jaccard_join.shared_tokens(sent)]
    assert [(int(n[0]), np.cumsum(x).tolist()) for n, x in answers] == [(4, [0, 1, 2]), (4, [0, 1, 2]), (1, [3]), (1, [])]
    head = jaccard_join.pack(np.array([1, 2, 3], u64), np.array([5, 4, 3]), np.array([3, 0, 3]))
    reply = lambda n, x: jaccard_join.pack(np.array([n]), np.diff(np.array(x, int), prepend=0).astype(u32))
    messages = [(0, reply(4, [0, 0, 1])), (jaccard_join.HEAD, head), (1, reply(2, [1, 1]))]
    assert jaccard_join.able_sets(messages, 85).tolist() == [1, 3]
    assert jaccard_join.able_sets(messages, 75).tolist() == [1, 2, 3]
    assert jaccard_join.able_sets(messages[:2], 85).tolist() == [1, 2, 3]
