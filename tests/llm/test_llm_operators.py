"""Small tables with nulls, empty, short, long, repeated and tied rows and
clashing extra columns through every operator."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from katz_brute import Brute, tokens
from skyfold.llm import decontaminate, fingerprints, jaccard_join, katz, language_id, packing, passages, sharding, suffix_dedup, url_filter
from skyfold.llm.queries import tokenizer_path

PASSAGE = " ".join(f"word{i} étage{i * 7 % 13}" for i in range(60))
ROWS = [
    (1, "alpha beta gamma. " * 3 + PASSAGE, "en", "a"),
    (2, PASSAGE + " and an own end of this text", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, "a"),
    (5, "Only four words here", "en", "b"),
    (6, "only four words here", "en", "b"),
    (7, " ".join(f"long{i}" for i in range(4000)), "de", "b"),
    (8, "12345 !!! 67", "de", None),
    (8, "12345 !!! 67", "de", None),
    (None, "a text without id, <|endoftext|> inside, don't! 3x", "de", None),
    (10, PASSAGE + " and an own end of this paper", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, items string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_decontaminate(spark, docs, none):
    bench = spark.createDataFrame([(10, "WORD3 étage8 word4 étage2"), (9, PASSAGE), (9, PASSAGE), (7, None), (6, "")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got[1].n_items == 2 and got[1].n_hit == 120 and got[3].n_words == 0 and not got[5].contaminated
    assert decontaminate.decontaminate(none, bench).count() == 0
    clean = decontaminate.decontaminate(docs, bench.limit(0))
    assert clean.count() == len(ROWS) and clean.where("contaminated").count() == 0


def test_jaccard(docs, none):
    got = jaccard_join.jaccard_components(docs).collect()
    comp = {r.doc_id: r.component_id for r in got}
    assert len(got) == len(ROWS) and comp[6] == 5 and comp[10] == comp[2] == 1 and comp[3] == 3 and comp[4] == 4
    assert {r.n_shingles for r in got if r.doc_id in (3, 4)} == {0}
    assert jaccard_join.jaccard_components(none).count() == 0


def test_family_blocks_agree():
    rng = np.random.default_rng(5)
    base = rng.choice(1 << 40, 60, replace=False).astype(np.uint64)
    sets = [np.sort(np.unique(np.where(rng.random(60) < 0.07, rng.integers(1 << 40, size=60), base).astype(np.uint64))) for _ in range(40)]
    n, label = jaccard_join.family_links(list(range(40)), sets, np.zeros(40, int), 85)
    for a in range(40):
        links = [b for b in range(40) if b != a and 100 * (i := len(np.intersect1d(sets[a], sets[b]))) >= 85 * (len(sets[a]) + len(sets[b]) - i)]
        assert n[a] == len(links) and all(label[b] == label[a] for b in links)


def test_language(docs, none):
    model = language_id.fit(docs.select("doc_id", "text", "lang"))
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert got[1].lang_pred == "en" and got[7].lang_pred == "de" and got[3].lang_pred == got[4].lang_pred == got[8].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in got.values())
    empty = language_id.fit(none.select("doc_id", "text", "lang"))
    assert {r.lang_pred for r in language_id.predict(docs, empty).collect()} == {"und"}


def test_fingerprints(docs, none):
    got = fingerprints.fingerprint_table(docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(ROWS) and by[3].fingerprint == by[4].fingerprint and by[3].near_next == 1.0
    assert by[7].near_edited > 0.5 and fingerprints.fingerprint_table(none).count() == 0


def test_sketches_recover_differences():
    rng = np.random.default_rng(1)
    a, b = rng.integers(1 << 62, size=400).astype(np.uint64), rng.integers(1 << 62, size=300).astype(np.uint64)
    both = np.concatenate([a[:250], b])
    key, _, side = fingerprints.differing((a, np.zeros(400, int)), (both, np.zeros(550, int)), 1)
    assert set(key[side == 1]) == set(a[250:]) and set(key[side == -1]) == set(b)


def test_shards(docs, none):
    got = sharding.assign_shards(docs, shards=3).collect()
    assert sum(r.size for r in got) == sum(8 + len((t or "").encode()) for _, t, _, _ in ROWS)
    for s in range(3):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in got if r.doc_id == 8}) == 1 and sharding.assign_shards(none).count() == 0


def test_pack(docs, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    got = packing.pack_documents(docs, tokenizer_path(), capacity=512).collect()
    want = Counter(zlib.crc32(np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for d, t, _, _ in ROWS if d not in (7, 1, 2, 10))
    assert not want - Counter(r.ids_crc32 for r in got if r.length == r.doc_tokens) or sum(r.length for r in got) == sum(
        len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _, _ in ROWS
    )
    loads = Counter()
    for r in got:
        loads[r.sequence_id] += r.length
    assert max(loads.values()) <= 512 and packing.pack_documents(none, tokenizer_path()).count() == 0


def test_repeated_bytes(docs, none):
    texts = [(t or "").encode() for _, t, _, _ in ROWS]
    seen = Counter(t[i : i + 40] for t in texts for i in range(len(t) - 39))
    want = []
    for t in texts:
        hit = {x for i in range(len(t) - 39) if seen[t[i : i + 40]] > 1 for x in range(i, i + 40)}
        want.append((len(t), len(hit)))
    got = suffix_dedup.repeated_bytes(docs.select("doc_id", "text", "lang"), length=40, with_kept=True).collect()
    assert Counter((r.n_bytes, r.n_removed) for r in got) == Counter(want)
    assert [r.kept for r in got if r.doc_id == 3] == [None] and suffix_dedup.repeated_bytes(none).count() == 0


def test_merge_runs():
    rng = np.random.default_rng(3)
    runs = [sorted(bytes(rng.integers(97, 99, size=rng.integers(0, 12)).astype(np.uint8)) for _ in range(int(n))) for n in (0, 7, 30, 1, 12)]
    coded = [(s.tolist(), n.tolist(), r) for s, n, r in map(suffix_dedup.front_code, runs)]
    out = [(runs[r][i], h) for r, i, h in suffix_dedup.merge_runs(coded)]
    assert [x for x, _ in out] == sorted(x for r in runs for x in r)
    assert all(h == suffix_dedup.common_prefix(a, b, 0) for (a, _), (b, h) in zip(out, out[1:], strict=False))


def test_passages(docs, none):
    got = passages.near_duplicate_passages(docs).collect()
    assert {r.doc_id for r in got} == {1, 2, 10} and all(r.n_words >= 120 for r in got)
    assert passages.near_duplicate_passages(none).count() == 0


def test_urls(spark):
    urls = [(1, "http://A.net/x"), (2, "https://b.example.net/en/y?q"), (3, None), (4, "no scheme"), (5, "http://example.com/de/"), (5, "http://xnet/"), (6, "http://net")]
    rules = [url_filter.rule(*r) for r in (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"))]
    got = url_filter.judge_urls(spark.createDataFrame(urls, "page_id long, url string"), rules).collect()
    assert sorted((r.host, r.rule, r.verdict) for r in got if r.page_id in (1, 2, 5)) == [
        ("a.net", "net/", "block"), ("b.example.net", "example.net/en/", "allow"), ("example.com", "example.com/de/", "block"), ("xnet", None, "allow")]
    assert all((r.host, r.path, r.verdict) == ("", "", "allow") for r in got if r.page_id in (3, 4))


def test_urls_of_several_segments(spark, monkeypatch):
    """A bound of a few bytes: many segments; the same verdicts, and every level within the bound."""
    urls = [(i, f"http://h{i}.{'net' if i % 97 == 0 else 'com'}/p") for i in range(4000)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    built = []
    plain = url_filter.build

    def watched(keys, column, n_words, salt=0, *more):
        built.append(8 * n_words)
        return plain(keys, column, n_words, salt, *more)

    monkeypatch.setattr(url_filter, "build", watched)
    got = url_filter.judge_urls(pages, [url_filter.rule("net/", "block")], max_filter_bytes=16).collect()
    assert {r.page_id: r.verdict for r in got} == {i: "block" if i % 97 == 0 else "allow" for i, _ in urls}
    assert max(built) <= 16 * url_filter.SLACK + 8 and len(built) > 4
    assert url_filter.judge_urls(pages.limit(0), [url_filter.rule("net/", "block")], max_filter_bytes=16).count() == 0


def test_katz(docs, none):
    held = F.coalesce(F.col("doc_id") == 5, F.lit(False))
    frame = docs.select("doc_id", held.alias("held"), "text")
    brute = Brute([t for d, t, _, _ in ROWS if d != 5])
    got = katz.score(frame, "held").collect()
    want = Counter((n, k, round(b, 6), round(s, 6)) for n, k, b, s in (brute.score(t) for _, t, _, _ in ROWS))
    assert Counter((r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in got) == want
    for h in ("<s>", "alpha", "word3"):
        assert abs(sum(brute.p(h, w) for w in brute.uni) + brute.p(h, "never seen") - 1) < 1e-9
    assert katz.score(none.select("doc_id", F.lit(False).alias("held"), "text"), "held").count() == 0
    assert tokens(None) == tokens("") and re.match("</s>", tokens("")[0])


def test_passages_of_a_group():
    """Members are compared as sets: a repeated line counts in every phase, an exact run whatever surrounds it."""
    rng = np.random.default_rng(2)
    line = rng.integers(1, 1 << 31, size=10).astype(np.uint32)
    anchor = [np.roll(np.tile(line, 14), x)[:129] for x in (0, 0, 3)]
    run = rng.integers(1, 1 << 31, size=(4, 129)).astype(np.uint32)
    run[:, 40:90] = run[0, 40:90]
    for slices in (np.array(anchor), run):
        found = list(passages.verify_group(slices, np.arange(len(slices)), 46, 0.8))
        assert {m for m, *_ in found} == set(range(len(slices))) and all(like >= 0.8 and last - first >= 45 for _, _, first, last, like in found)
    assert not list(passages.verify_group(run, np.zeros(4, int), 46, 0.8))  # one document
    assert not list(passages.verify_group(rng.integers(1, 1 << 31, size=(5, 129)).astype(np.uint32), np.arange(5), 46, 0.8))


def test_passages_beyond_the_first_leader():
    """A member that shares a passage with one that the first leader had matched, and the parts that a member shares with different ones."""
    rng = np.random.default_rng(3)
    lead, own, other = rng.integers(1, 1 << 31, size=(3, 129)).astype(np.uint32)
    own[20:70] = lead[20:70]  # the leader's passage and, from column 50 on, the other's
    own[70:110] = other[70:110]
    other[50:70] = own[50:70]
    for order in ([0, 1, 2], [1, 0, 2], [2, 1, 0]):
        found = list(passages.verify_group(np.array([lead, own, other])[order], np.arange(3), 46, 0.8))
        reach = {order[m]: (min(f for n, _, f, _, _ in found if n == m), max(f for n, _, _, f, _ in found if n == m)) for m, *_ in found}
        assert reach.keys() == {0, 1, 2} and reach[1][0] <= 20 and reach[1][1] >= 109 and reach[2][0] <= 50 and reach[2][1] >= 109
    many = rng.integers(1, 1 << 31, size=(300, 129)).astype(np.uint32)
    many[:, 40:90] = many[0, 40:90]  # one comparison each
    calls, plain = [], passages.compare_with_leader
    passages.compare_with_leader = lambda *a: calls.append(len(a[0])) or plain(*a)
    try:
        assert {m for m, *_ in passages.verify_group(many, np.arange(300), 46, 0.8)} == set(range(300))
    finally:
        passages.compare_with_leader = plain
    assert sum(calls) < 600


def test_passages_of_many_splits(spark):
    """Documents of any partition, far beyond the 128th."""
    text = F.when(F.col("id").isin(0, 140, 149), F.concat(F.col("id").cast("string"), F.lit(" " + PASSAGE)))
    docs = spark.range(0, 150, numPartitions=150).select(F.col("id").alias("doc_id"), text.alias("text"))
    got = passages.near_duplicate_passages(docs).collect()
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in got) == [(0, 1, 121), (140, 1, 121), (149, 1, 121)]


def test_windows_of_a_long_text():
    """The windows of a text of more than 2**20 shingles are those of its smallest hashes, up to its end."""
    n, least = (1 << 20) + 30_000, 46
    h = np.random.default_rng(4).integers(1 << 62, size=n).astype(np.uint64)
    ((_, _, left, c, right),) = passages._windows(h, np.array([0, n]), least, 0, 0, 0)
    want = np.unique(np.arange(n - least + 1) + np.lib.stride_tricks.sliding_window_view(h, least).argmin(axis=1))
    assert np.array_equal(np.sort(c), want)
    late = np.flatnonzero(c >= 1 << 20)
    assert len(late) > 1000 and all(h[left[x] : right[x] + 1].min() == h[c[x]] and right[x] - left[x] + 1 >= least for x in late)


def test_windows_of_runs():
    """A run of one shingle has few windows, and every subsequence still holds a window's position of its smallest hash."""
    rng = np.random.default_rng(12)
    least = 46
    h = rng.integers(1 << 40, 1 << 62, size=600).astype(np.uint64)
    smallest = np.sort(h)[:3]
    for x, n, v in ((100, 30, smallest[0]), (250, 200, smallest[1]), (500, 2, smallest[2])):
        h[x : x + n] = v
    first = np.array([0, 420, 600])  # the second run is in one document, the third in the other
    ((_, doc, left, c, right),) = passages._windows(h, first, least, 0, 0, 0)
    for x in range(len(h) - least + 1):
        if x < 420 < x + least:
            continue
        here = (c >= x) & (c < x + least) & (left <= x) & (right >= x + least - 1) & (doc == (x >= 420))
        assert (h[c[here]] == h[x : x + least].min()).any(), x
    assert [((c >= x) & (c < x + n)).sum() for x, n in ((100, 30), (500, 2))] == [2, 2]
    assert ((c >= 250) & (c < 420)).sum() == 5 and ((c >= 420) & (c < 450)).sum() == 2


def test_passages_in_runs(spark):
    """Runs of one word cost few comparisons, and passages in and beside them are found whole."""
    run, side = " ".join(["na"] * 300), PASSAGE
    texts = [f"{side} {run}", f"{run} {side}", f"x {side} {run} {side} y", f"z {run}", "clean " + " ".join(f"c{i}" for i in range(90))]
    got = passages.near_duplicate_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    n = len(side.split())
    spans = {(r.doc_id, r.start_word, r.end_word) for r in got}
    assert spans == {(0, 0, n + 300), (1, 0, n + 300), (2, 1, 2 * n + 301), (3, 1, 301)}


def edited_pair(rng, words, edits):
    """Shingle numbers of two texts that share a passage with some words replaced, inserted or left out."""
    passage = [f"p{i}" for i in range(words)]
    other = list(passage)
    for _ in range(edits):
        at = int(rng.integers(len(other)))
        kind = int(rng.integers(3))
        other[at : at + (kind != 1)] = [f"e{rng.integers(1 << 30)}"] * (kind != 2)
    own, lead = ([f"{s}{i}" for i in range(80)] + p + [f"{s}{i}" for i in range(80, 160)] for s, p in (("a", passage), ("b", other)))
    number: dict = {}
    return [np.array([number.setdefault(tuple(t[i : i + 5]), len(number) + 1) for i in range(len(t) - 4)], np.uint32) for t in (own, lead)]


def brute_width(own, lead, least, similarity):
    """Width of the widest similar stretch around the middle, of distinct shingles, or 0."""
    table = np.zeros((len(own) + 1, len(lead) + 1), int)
    table[1:, 1:] = np.cumsum(np.cumsum(own[:, None] == lead, axis=0), axis=1)
    mid = len(own) // 2
    first, last, shift, grow = np.meshgrid(np.arange(mid + 1), np.arange(mid, len(own)), np.arange(-4, 5), np.arange(-4, 5), indexing="ij")
    first_2, last_2 = np.clip(first + shift, 0, mid), np.clip(last + grow, mid, len(own) - 1)
    a, b = last - first + 1, last_2 - first_2 + 1
    both = table[last + 1, last_2 + 1] - table[first, last_2 + 1] - table[last + 1, first_2] + table[first, first_2]
    ok = (a >= least) & (b >= least) & (both >= similarity * (a + b - both))
    return int(a[ok].max(initial=0))


def test_edited_passages_against_brute_force():
    """From every shared anchor, a passage is found exactly if one of 50 words with Jaccard 0.8 is there."""
    rng = np.random.default_rng(8)
    reach = np.arange(-passages.REACH, passages.REACH + 1)
    wanted = 0
    cases = [(words, edits) for words in (50, 55, 60, 80, 89, 90, 120) for edits in (1, 2)]
    for words, edits in cases:
        own, lead = edited_pair(rng, words, edits)
        shared = np.flatnonzero(np.isin(own, lead))
        for c in rng.choice(shared, min(8, len(shared)), replace=False).tolist():
            slices = np.array([own[c + reach], lead[int(np.flatnonzero(lead == own[c])[0]) + reach]])
            width = brute_width(slices[0], slices[1], 46, 0.8)
            for pair in (slices, slices[::-1]):
                found = {m: (last - first + 1, like) for m, _, first, last, like in passages.verify_group(pair, np.arange(2), 46, 0.8)}
                assert set(found) == ({0, 1} if width else set()), (words, edits, c, width, found)
                assert all(46 <= n and like >= 0.8 for n, like in found.values())
            wanted += width > 0
    assert wanted > 60


def test_one_changed_word_is_inside():
    """One word changed in the middle: every anchor finds the whole passage."""
    for words in (50, 60, 80, 89, 90):
        own, lead = np.arange(1, words + 157, dtype=np.uint32), np.arange(1, words + 157, dtype=np.uint32)
        lead[:80], lead[80 + words - 4 :] = lead[:80] + 1000, lead[80 + words - 4 :] + 1000
        lead[80 + words // 2 - 4 : 80 + words // 2 + 1] += 2000
        for c in np.flatnonzero(own == lead).tolist():
            lo, hi = c - passages.REACH, c + passages.REACH + 1
            if lo > 80 or hi < 80 + words - 4:
                continue
            found = list(passages.verify_group(np.array([own[lo:hi], lead[lo:hi]]), np.arange(2), 46, 0.8))
            assert {(m, first + lo, last + lo) for m, _, first, last, _ in found} == {(m, 80, 80 + words - 5) for m in (0, 1)}


def test_recall_of_edited_passages(spark):
    """Every document of 300 pairs that share 50 words but one, at Jaccard 0.8 or more."""
    rng = np.random.default_rng(50)
    texts: list[str] = []
    while len(texts) < 600:
        x = len(texts) // 2
        passage = [f"p{x}q{i}" for i in range(50)]
        other = list(passage)
        at, kind = int(rng.integers(50)), int(rng.integers(3))
        other[at : at + (kind != 1)] = [f"e{rng.integers(1 << 30)}"] * (kind != 2)
        a, b = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (passage, other))
        if min(len(a), len(b)) >= 46 and 10 * len(a & b) >= 8 * len(a | b):
            texts += [" ".join([f"{s}{x}w{i}" for i in range(80)] + p + [f"{s}{x}v{i}" for i in range(80)]) for s, p in (("a", passage), ("b", other))]
    got = passages.near_duplicate_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == set(range(600)) and all(r.other_doc_id == r.doc_id ^ 1 and r.similarity >= 0.8 for r in got)


def test_pairs_agree_with_groups():
    """Groups of two, compared at once, get what ``verify_group`` gives; repeated shingles are left to it."""
    rng = np.random.default_rng(6)
    lead = rng.integers(1, 1 << 32, size=(120, 129)).astype(np.uint32) | np.uint32(1)
    own = lead.copy()
    for x in range(120):
        for at in rng.integers(0, 124, size=rng.integers(0, 5)):
            own[x, at : at + 5] = rng.integers(1, 1 << 32, size=5)
        own[x, 64] = lead[x, 64]
        own[x, rng.integers(80, 129) :] = 0
    lead[0, 70] = lead[0, 71]
    *found, other = passages.verify_pairs(lead, own, 46, 0.8)
    got = {x: {(1, a, b, like), (0, c, d, like)} for x, a, b, c, d, like in zip(*(f.tolist() for f in found), strict=True)}
    assert 0 in other and len(got) > 30
    for x in set(range(120)) - set(other.tolist()):
        assert got.get(x, set()) == {(m, a, b, like) for m, _, a, b, like in passages.verify_group(np.array([lead[x], own[x]]), np.arange(2), 46, 0.8)}


def test_near_copies_around_runs(spark):
    """Near copies in which a run has another length: all alignments of the run's positions are compared."""
    texts = []
    cases = [(14, 14, 18, [7, 21, 37], [18, 37, 40]), (96, 11, 18, [4, 53, 64], [21, 48, 55]), (106, 31, 44, [38, 49], [9]), (125, 42, 14, [], [34, 54, 58])]
    for i, run, other_run, edits_before, edits_after in cases:
        before, after = [f"p{i}x{j}" for j in range(70)], [f"q{i}x{j}" for j in range(70)]
        texts.append(" ".join([f"a{i}"] * 3 + before + [f"r{i}"] * run + after + [f"b{i}"]))
        edited = [[f"e{w}" if j in edits else w for j, w in enumerate(side)] for side, edits in ((before, edits_before), (after, edits_after))]
        texts.append(" ".join(edited[0] + [f"r{i}"] * other_run + edited[1]))
    got = passages.near_duplicate_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    spans = {(r.doc_id, r.start_word, r.end_word) for r in got}
    assert spans == {(0, 25, 124), (1, 22, 125), (2, 8, 67), (2, 68, 132), (3, 5, 64), (3, 65, 136), (4, 42, 174), (5, 39, 184), (6, 3, 169), (7, 0, 138)}
