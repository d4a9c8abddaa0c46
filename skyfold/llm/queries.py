"""The subpackage's registered queries (production parameters, whole tables)
and, where SQL can express one, its DuckDB oracle."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm import decontaminate as decon
from skyfold.llm import fingerprints, jaccard_join, katz, language_id, mixing, packing, passages, prefix_trie, sharding, source_audit, suffix_dedup, url_filter
from skyfold.session import cut_lineage

#: Environment variable that names another file of the packing tokenizer.
TOKENIZER_VARIABLE = "SKYFOLD_TOKENIZER"
TOKENIZER = "word_bpe_49k.json"
HELD_OUT = {"lang": (4, 2), "lm": (10, 0)}
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    if path := os.environ.get(TOKENIZER_VARIABLE):
        return path
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decon.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folds, out = HELD_OUT["lang"]
    held = F.coalesce(language_id.fold(F.col("doc_id"), folds) == out, F.lit(False))
    model = language_id.fit(docs.where(~held).select("doc_id", "text", "lang"))
    scored = language_id.predict(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_table(table(spark, sf_dir, "documents"))


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), shards=24)


def op6_near_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_duplicate_passages(table(spark, sf_dir, "documents"))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_filter.rule(*r) for r in URL_RULES]
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op10_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds, out = HELD_OUT["lm"]
    held = F.coalesce(language_id.fold(F.col("doc_id"), folds) == out, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", held.alias("held_out"), "text")
    return katz.score(docs, "held_out")


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit_sources(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = cut_lineage(prefix_trie.turn_rows(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie.prefix_trie(prefix_trie.lend_heads(turns))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.by_first_position(mixing.mix_sources(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_language_id": op3_language_id,
        "op4_fingerprints": op4_fingerprints,
        "op5_shard": op5_shard,
        "op6_near_passages": op6_near_passages,
        "op7_pack": op7_pack,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_url_filter": op9_url_filter,
        "op10_katz_lm": op10_katz_lm,
        "op11_source_audit": op11_source_audit,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_mixing": op13_mixing,
    }


_OP1 = """
WITH iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM dw),
occ AS (
  SELECT p.doc_id, p.i, l.n, win.item_id
  FROM pos p CROSS JOIN (SELECT DISTINCT n FROM win) l
  JOIN win ON win.n = l.n AND win.t = array_to_string(p.w[p.i : p.i + l.n - 1], ' ')
  WHERE p.i + l.n - 1 <= len(p.w)),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM occ) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

_OP2 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(len(w), 4) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
z AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS id FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b, x.id AS own, y.id AS other FROM o JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w
  UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b)
SELECT w.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, c.component_id, CAST(coalesce(k.n_links, 0) AS BIGINT) AS n_links
FROM w LEFT JOIN z USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(DISTINCT other) AS n_links FROM l WHERE own <> other GROUP BY a) k USING (doc_id)
"""

_OP9 = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
j AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM j
"""

_OP11 = """
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT lang, source, r, unnest(w) AS item FROM d),
k AS (SELECT lang, item FROM t GROUP BY lang, item HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, item, count(*) AS n FROM t JOIN k USING (lang, item) GROUP BY lang, source, item),
s AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0) AS total, coalesce(max(v), 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN c USING (lang, source) LEFT JOIN v USING (lang) GROUP BY g.lang, g.source),
p AS (
  SELECT s.lang, s.source, k.item, coalesce(n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 5) // (total + 5 * v) AS p
  FROM s JOIN k USING (lang) LEFT JOIN c USING (lang, source, item)),
q AS (
  SELECT lang, item, 1 + CAST(1000000000 AS HUGEINT) * (n + 5) // (total + 5 * v) AS q
  FROM (SELECT lang, item, sum(n) AS n FROM c GROUP BY lang, item) JOIN (SELECT lang, sum(total) AS total, max(v) AS v FROM s GROUP BY lang) USING (lang)),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b USING (lang, item) GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
  UNION ALL
  SELECT lang, source, 'term', item, p - q FROM p JOIN q USING (lang, item) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= 50
"""

_OP12 = """
WITH t AS (
  SELECT conv_id AS c, turn, length(coalesce(text, '')) AS chars,
         sha256(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, k, chars, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) AS pos FROM t),
h AS (
  SELECT c, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, z: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)))) % 6 AS h
  FROM (SELECT DISTINCT c FROM o)),
r AS (
  SELECT c, k, chars, row_number() OVER (PARTITION BY c ORDER BY pos) AS d
  FROM (SELECT h.c, o.pos, o.k, o.chars FROM h JOIN o ON o.c = h.c - h.c % 100 WHERE o.pos <= h.h
        UNION ALL SELECT o.c, o.pos, o.k, o.chars FROM h JOIN o ON o.c = h.c WHERE o.pos > h.h)),
p AS (
  SELECT c, 0 AS d, '' AS path, 0 AS chars FROM h
  UNION ALL SELECT c, d, string_agg(k, '') OVER (PARTITION BY c ORDER BY d), chars FROM r),
n AS (SELECT path, any_value(d) AS d, any_value(chars) AS chars, count(*) AS n, min(c) AS c FROM p GROUP BY path),
ends AS (
  SELECT path, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM (SELECT c, arg_max(path, d) AS path FROM p GROUP BY c) GROUP BY path),
kids AS (SELECT path[1 : 64 * (d - 1)] AS path, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN kids USING (path)),
below AS (
  SELECT a.path, count(*) FILTER (WHERE b.kids = 0) AS leaves, sum((b.n - 1) * b.chars) AS saved
  FROM m a JOIN m b ON starts_with(b.path, a.path) GROUP BY a.path)
SELECT m.c AS conv_id, CAST(m.d AS BIGINT) AS depth, up.c AS parent_conv_id, CAST(m.n AS BIGINT) AS n_convs, CAST(m.kids AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM m JOIN below USING (path) LEFT JOIN ends USING (path) LEFT JOIN m up ON m.d > 0 AND up.path = m.path[1 : 64 * (m.d - 1)]
"""

_OP13 = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), '|', coalesce(text, ''))) AS key FROM documents),
b AS (SELECT *, CAST('0x' || substr(key, 1, 8) AS BIGINT) % greatest(1, (SELECT (count(*) + 499) // 500 FROM d)) AS bucket FROM d),
s AS (
  SELECT *, CASE kind WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, CASE kind WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1.0 ELSE 0.5 END AS rate
  FROM (SELECT source, sum(size) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind FROM d GROUP BY source)),
f AS (
  SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS FIRST)),
g AS (SELECT *, least(3.0 * source_size, weight * (SELECT first(level ORDER BY 3 * source_size / weight, source NULLS FIRST) FROM f WHERE weight * level <= 3 * source_size)) AS target FROM f),
p AS (
  SELECT b.doc_id, b.size, g.source_size, g.target, rate,
         coalesce(sum(b.size) OVER (PARTITION BY b.source ORDER BY bucket, key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
  FROM b JOIN g ON b.source IS NOT DISTINCT FROM g.source),
t AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS goal, c / target AS share,
         greatest(0, least(size, floor(target) - c)) + greatest(0, least(size, floor(target) - c - source_size))
         + greatest(0, least(size, floor(target) - c - 2 * source_size)) AS taken FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN CASE WHEN share > 0 THEN 2 * share / (rate + sqrt(greatest(rate * rate + 2 * (2 - 2 * rate) * share, 0))) ELSE 0.0 END END AS position
FROM t
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": _OP1, "op2_jaccard_join": _OP2, "op9_url_filter": _OP9, "op11_source_audit": _OP11, "op12_prefix_trie": _OP12, "op13_mixing": _OP13}
