"""Registered queries over the text tables: name -> (job, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from detlake.llm import (decontaminate, exact_dedup, jaccard_join, license_scan, packing, prefix_trie, quality_classifier, quality_rules,
                         sharding, suffix_dedup, toxicity, url_filter, whitening)

_REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(job):
        _REGISTRY[name] = (job, sql)
        return job
    return add


def jobs() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: job for name, (job, _) in _REGISTRY.items()}


def oracles() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _REGISTRY.items() if sql}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op6_jaccard_join", rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex({LOWERED}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
     WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
u AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
p AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.t = b.t AND a.doc_id <> b.doc_id
     GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT a, b FROM p UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.b, s.doc_id)) AS component_id
FROM s LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON m.a = s.doc_id""")
def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.similarity_components(table(spark, folder, "documents"), 3, 90, 100)


@query("op5_suffix_dedup", r"""
WITH d AS MATERIALIZED (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
p AS MATERIALIZED (SELECT doc_id, 1000 * k AS o, substr(h, CAST(2000 * k + 1 AS BIGINT), 2398) AS s
  FROM (SELECT doc_id, h, unnest(range(0, CAST((len(h) // 2 - 200) // 1000 + 1 AS BIGINT))) AS k FROM d WHERE len(h) >= 400)),
g AS MATERIALIZED (SELECT doc_id, o + i AS i, md5(substr(s, 2 * i + 1, 400)) AS g FROM (SELECT doc_id, o, s, unnest(range(0, CAST(len(s) // 2 - 199 AS BIGINT))) AS i FROM p)),
r AS (SELECT doc_id, i FROM g JOIN (SELECT g FROM g GROUP BY g HAVING count(*) > 1) USING (g)),
b AS (SELECT doc_id, i, sum(CASE WHEN i - l <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS s
      FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) AS l FROM r)),
s AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM b GROUP BY doc_id, s),
k AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f FROM s),
m AS (SELECT doc_id, sum(z - a) AS n, count(*) AS c, max(z) AS e, string_agg(substr(h, 2 * f + 1, 2 * (a - f)), '' ORDER BY a) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(c, 0) AS BIGINT) AS n_spans,
       sha256(from_hex(coalesce(kept, '') || substr(h, CAST(2 * coalesce(e, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN m USING (doc_id)""")
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.removals(table(spark, folder, "documents"))


# trained models: SQL cannot express them; held-out accuracy is tested
@query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


# greedy tiling and packing depend on the order of their steps; SQL cannot express them; brute force is in the tests
@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_packing")
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def _rule_sql() -> str:
    terms = []
    for expression, least, most in quality_rules.RULES.values():
        above, below = expression.split(" / ")
        terms += [f"coalesce({above} * 1.0e0 / nullif({below}, 0) >= {least}, true)"] * (least is not None)
        terms += [f"coalesce({above} * 1.0e0 / nullif({below}, 0) <= {most}, true)"] * (most is not None)
    return " AND ".join(terms)


@query("op3_quality_rules", rf"""
WITH w AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS MATERIALIZED (SELECT doc_id, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS g FROM (SELECT doc_id, w, unnest(range(0, len(w) - 2)) AS i FROM w WHERE len(w) >= 3)),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) CROSS JOIN (VALUES (0), (1), (2)) v(k) WHERE c > 1 GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '{quality_rules.SYMBOLS}', '')) AS BIGINT) AS n_symbols, length(t) - length(translate(t, '!?', '')) AS n_marks,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
  len(list_filter(w, lambda x: list_contains({quality_rules.STOP_WORDS}, lower(x)))) AS n_stop, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
x AS (SELECT *, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_rule_sql()} AS kept FROM x""")
def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, folder, "documents"))


def _crc_steps() -> list[int]:
    """What each byte does to a CRC-32."""
    def step(c: int) -> int:
        return c >> 1 ^ 0xEDB88320 if c & 1 else c >> 1
    out = list(range(256))
    for _ in range(8):
        out = [step(c) for c in out]
    return out


@query("op4_sharding", f"""
WITH b AS (SELECT doc_id, source, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
d AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS stratum, CAST(len(h) // 2 + 8 AS BIGINT) AS size,
  xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(h, '..'), lambda x: CAST('0x' || x AS BIGINT))),
      lambda a, x: xor({_crc_steps()}[(xor(a, x) & 255) + 1], a >> 8)), 4294967295) AS text_crc32 FROM b),
k AS (SELECT *, CAST('0x' || substr(md5('shards:' || doc_id || ':' || text_crc32), 1, 12) AS BIGINT) AS key FROM d),
r AS (SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY key, doc_id, text_crc32, size) - 1
  + CAST('0x' || substr(md5('shards:' || stratum), 1, 12) AS BIGINT) / 281474976710656.0e0) / count(*) OVER (PARTITION BY stratum) AS share FROM k),
p AS (SELECT *, row_number() OVER (ORDER BY share, stratum, key, doc_id, text_crc32, size) - 1 AS i, count(*) OVER () AS n FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(i * 24 // n AS INTEGER) AS shard, i - (i * 24 // n * n + 23) // 24 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p""")
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.stratified_shards(table(spark, folder, "documents"))


def _url_sql() -> str:
    fits = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN " for h, _, p in (text.partition("/") for text, _ in _longest())]
    rule = " ".join(f"{f}'{text}'" for f, (text, _) in zip(fits, _longest()))
    word = " ".join(f"{f}'{verdict}'" for f, (_, verdict) in zip(fits, _longest()))
    bad = " OR ".join(f"regexp_matches({_LOWER_URL}, '{url_filter.regex(p)}')" for p in url_filter.PATTERNS)
    return f"SELECT page_id, host, path, CASE {rule} END AS rule, coalesce(CASE {word} END, CASE WHEN host <> '' AND ({bad}) THEN 'block' END, 'allow') AS verdict FROM h"


def _longest() -> list[tuple[str, str]]:
    return sorted(url_filter.BASE_RULES, key=lambda r: -len(r[0]))


_LOWER_URL = "translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op7_url_filter", f"""
WITH r AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, url, translate(coalesce(regexp_extract(rest, '(?s)^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1), '') AS path FROM r)
{_url_sql()}""")
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(table(spark, folder, "pages"))


def _phrase_sql() -> str:
    return ", ".join("list_filter(range(0, len(w) - {0}), lambda i: {1}) AS p{2}".format(len(p) - 1, " AND ".join(f"w[i + {k + 1}] = '{word}'" for k, word in enumerate(p)), n)
                     for n, p in enumerate(license_scan.PHRASES.values()))


def _template_sql() -> str:
    return ", ".join("('{}', {}, {})".format(name, license_scan.span(text), sorted({*text.split()})) for name, text in license_scan.TEMPLATES.items())


def _span_sql() -> str:
    return ", ".join(f"({n})" for n in sorted({license_scan.span(text) for text in license_scan.TEMPLATES.values()}))


@query("op9_license_scan", rf"""
WITH d AS MATERIALIZED (SELECT doc_id, {LOWERED} AS t FROM documents),
w AS (SELECT doc_id, list_filter(string_split_regex(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM d),
p AS (SELECT doc_id, len(w) AS n, {_phrase_sql()} FROM w),
b AS (SELECT doc_id, n, flatten([{", ".join(f"p{i}" for i in range(len(license_scan.PHRASES)))}]) AS places,
  list_filter([{", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{name}' END" for i, name in enumerate(license_scan.PHRASES))}], lambda x: x IS NOT NULL) AS names FROM p),
l AS (SELECT doc_id, span, w[i:i + 2 * span - 1] AS l FROM (SELECT doc_id, w, span, unnest(range(1, greatest(len(w), 1) + 1, span)) AS i FROM w CROSS JOIN (VALUES {_span_sql()}) s(span))),
f AS (SELECT doc_id, name, len(list_intersect(own, l)) * 1.0e0 / len(own) AS share FROM l JOIN (VALUES {_template_sql()}) v(name, span, own) USING (span) WHERE 100 * len(list_intersect(own, l)) >= 80 * len(own)),
m AS (SELECT doc_id, list(DISTINCT name) AS more, max(share) AS share FROM f GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
  array_to_string(list_sort(names), ',') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(names, coalesce(more, [])))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0e0 ELSE coalesce(share, 0.0e0) END AS score FROM b LEFT JOIN m USING (doc_id)""")
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scanned(table(spark, folder, "documents"))


@query("op11_exact_dedup", f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, {LOWERED} AS norm FROM documents) WINDOW w AS (PARTITION BY norm)""")
def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.copies(table(spark, folder, "documents"), largest=True)


# eigenvectors have no SQL form; a plain covariance is the yardstick of the tests
@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


@query("op13_prefix_trie", f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
l AS MATERIALIZED (SELECT conv_id, list({{r: r, t: t}} ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || t)) AS l FROM t GROUP BY conv_id),
h AS (SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(lower(hex(encode(CAST(conv_id AS VARCHAR)))), '..'), lambda x: CAST('0x' || x AS BIGINT))),
   lambda a, x: xor({_crc_steps()}[(xor(a, x) & 255) + 1], a >> 8)), 4294967295) % 6 AS h FROM l),
b AS MATERIALIZED (SELECT h.conv_id, coalesce(b.l, h.l[1:0])[1:h] || h.l[h + 1:] AS l FROM h LEFT JOIN l b ON b.conv_id = h.conv_id - h.conv_id % 100),
p AS (SELECT conv_id, l, d, d = len(l) AS ends FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM b)),
k AS MATERIALIZED (SELECT conv_id, d, ends, l[1:d] AS k, sha256(CAST(to_json(l[1:d]) AS VARCHAR)) AS id FROM p),
n AS MATERIALIZED (SELECT id, d, min(conv_id) AS conv_id, count(*) AS n, any_value(k) AS k, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS e FROM k GROUP BY id, d),
a AS MATERIALIZED (SELECT id AS node, up, sha256(CAST(to_json(k[1:up]) AS VARCHAR)) AS id, CASE WHEN d > 0 THEN (n - 1) * length(k[d].t) ELSE 0 END AS own, d FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM n)),
c AS MATERIALIZED (SELECT id, count(*) AS kids FROM a WHERE up = d - 1 GROUP BY id),
s AS (SELECT a.id, sum(a.own) AS saved, count(*) FILTER (WHERE c.kids IS NULL) AS leaves FROM a LEFT JOIN c ON c.id = a.node GROUP BY a.id)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.kids, 0) AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.e) AS ends_sha256
FROM n JOIN s USING (id) LEFT JOIN c USING (id) LEFT JOIN a ON a.node = n.id AND a.up = n.d - 1 LEFT JOIN n u ON u.id = a.id""")
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
