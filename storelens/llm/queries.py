"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storelens.llm import (
    divergence, filter_audit, html_text, jaccard_join, license_scan, mixing, packing, pii, quality, sharding, simhash, url_filter, vector_dedup)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan_licenses(_table(spark, sf_dir, "documents")))


def op5_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), shards=40)


def op2_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op3_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


def op4_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "mix_tokens", "mix_epoch", "mix_block", "mix_weight", "mix_order")


def op6_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op7_prefix_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.fingerprint_documents(_table(spark, sf_dir, "documents")))


def op9_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op10_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(_table(spark, sf_dir, "documents")))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_ordinal_quality, op3_page_text, op4_temperature_mix, op5_ring_shards, op6_window_packing, op7_prefix_tree_join, op8_simhash,
    op9_vector_graph, op10_pii_spans, op11_filter_audit, op12_url_filter, op13_source_divergence)}
#: Operators 7, 11 and 13 in plain SQL: all pairs that share a shingle, and reachability; every order's steps by window; every
#: pair of sources times every word. The other operators rest on fitted models, hashes, tokenizers or a graph index, which SQL
#: cannot express; tests/llm holds them against brute force.
ORACLE_SQL: dict[str, str] = {"op7_prefix_tree_join": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ \\t\\n\\x0B\\f\\r]+') AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.y FROM reach r JOIN link l ON r.b = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = d.doc_id
""", "op11_filter_audit": """
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
first AS (SELECT body, min(doc_id) AS low FROM t GROUP BY body),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
d AS (
  SELECT part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         (CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 10 * length(body) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN coalesce(low < t.doc_id, false) THEN 'E' ELSE '' END) AS fails
  FROM t JOIN first USING (body) LEFT JOIN l ON l.doc_id = t.doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY part, fails),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS flt, substr(filter_order, 1, step::INT - 1) AS before
      FROM o, range(1, 6) r(step)),
h AS (SELECT part, filter_order, step, flt, fails, n, good, toxic, contains(fails, flt) AS hit,
             fails <> '' AND before <> '' AND regexp_matches(fails, '[' || CASE WHEN before = '' THEN '-' ELSE before END || ']') AS gone
      FROM c, s),
r AS (SELECT part, filter_order, step, flt,
             sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN gone AND hit THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = flt THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN NOT gone AND hit THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN NOT gone AND hit THEN toxic ELSE 0 END) AS toxic_lost
      FROM h GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, flt))::BIGINT AS shapley
FROM r
""", "op13_source_divergence": """
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS body
           FROM documents),
w AS (SELECT i, lang, source, unnest(regexp_extract_all(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS total FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS n_lang FROM k GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source FROM d GROUP BY ALL),
ng AS (SELECT lang, source, sum(n)::HUGEINT AS n_group FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total, v.v, v.n_lang,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(ng.n_group, 0) + v.v) AS p
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN ng ON ng.lang = g.lang AND ng.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
all_pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(pairs.value, 0) AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
q AS (SELECT lang, source, term AS item, p, 1 + (1000000000::HUGEINT * (total + 1)) // (n_lang + v) AS q FROM p WHERE n > 0),
terms AS (SELECT lang, source, item, (p - q) * (p - q) // q AS value FROM q WHERE p > q),
r AS (SELECT lang, source, 'pair' AS part, item, value,
             row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM all_pairs
      UNION ALL
      SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM r WHERE part = 'pair' OR rank <= 200
"""}
