"""The registered queries of the operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from millrace.llm.byte_bpe import decode, digest, encode, token_bytes
from millrace.llm.common import read
from millrace.llm.decontaminate import find_overlaps
from millrace.llm.exact_dedup import exact_dedup
from millrace.llm.filter_audit import audit_filters
from millrace.llm.html_extract import extract_pages
from millrace.llm.language_id import identify_languages
from millrace.llm.licenses import scan_licenses
from millrace.llm.merkle import manifest
from millrace.llm.minhash import link_near_copies
from millrace.llm.quality import score_quality
from millrace.llm.token_file import read_token_files, write_token_files
from millrace.llm.toxicity import score_toxicity
from millrace.llm.url_filter import Rule, filter_urls
from millrace.registry import Query
from millrace.session import scratch_dir

#: Fixed by the contract of op1: the id after each document.
END_ID = 2

#: Fixed by the contract of op3: verdict, host, path.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    write_token_files(read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return read_token_files(spark, path).select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"), digest_all=True)


OP2_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"), RULES)


OP3_SQL = r"""
WITH RECURSIVE rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
p AS (
  SELECT page_id, html, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages),
q AS (
  SELECT page_id, html,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(rest, '^[^/?#]*[^?#]*([^#]*)', 1), '') AS query
  FROM p),
tags AS (
  SELECT host, path, host || path || query AS a, unnest([
    regexp_extract(regexp_extract(html, '(?i)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?i)\bhref\s*=\s*["'']?([^\s"''>]+)', 1),
    regexp_extract(regexp_extract(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?i)\burl\s*=\s*["'']?([^"''>]+)', 1)
    ]) AS target FROM q WHERE host <> ''),
links AS (
  SELECT a, CASE WHEN contains(target, '://') THEN target WHEN starts_with(target, '//') THEN 'x:' || target
    WHEN starts_with(target, '/') THEN 'x://' || host || target
    ELSE 'x://' || host || coalesce(nullif(regexp_extract(path, '^(.*/)?'), ''), '/') || target END AS b
  FROM (SELECT a, host, path, trim(replace(target, '&amp;', '&')) AS target FROM tags) WHERE target <> ''),
edge AS (SELECT a, substr(b, position('://' IN b) + 3) AS b FROM links
  UNION SELECT substr(b, position('://' IN b) + 3), a FROM links),
node AS (
  SELECT a AS id, regexp_extract(a, '^([^/?#]*)', 1) AS host, regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path FROM edge),
bad AS (
  SELECT id FROM (
    SELECT n.id, arg_max(r.verdict, length(r.host || r.path)) AS verdict FROM node n JOIN rules r
    ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path) GROUP BY n.id)
  WHERE verdict = 'block'
  UNION SELECT e.b FROM bad JOIN edge e ON e.a = bad.id),
own AS (
  SELECT q.page_id, q.host, q.path, q.host || q.path || q.query AS id,
    (SELECT arg_max(r.host || r.path, length(r.host || r.path)) FROM rules r
      WHERE (q.host = r.host OR ends_with(q.host, '.' || r.host)) AND starts_with(q.path, r.path)) AS rule,
    (SELECT arg_max(r.verdict, length(r.host || r.path)) FROM rules r
      WHERE (q.host = r.host OR ends_with(q.host, '.' || r.host)) AND starts_with(q.path, r.path)) AS verdict
  FROM q)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN id IN (SELECT id FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM own
"""

def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return digest(decode(encoded, token_bytes(spark, ranks)))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_near_copies(read(spark, sf_dir, "documents"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
f AS (
  SELECT doc_id, part, (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (l.good) AS good, count(*) FILTER (l.toxic) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
letter AS (SELECT x, (2 ** i)::INT AS bit FROM (VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3), ('E', 4)) v(x, i)),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
m AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM m
"""


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read(spark, sf_dir, "documents"))


def _leaf_sql(text: str) -> str:
    field = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}, '-')".format
    return "sha256(" + " || ".join(field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


OP13_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree, {_leaf_sql('text')} AS leaf,
    {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered,
    xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),
      lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::UBIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda k: 0::UBIGINT)),
        lambda v, k: xor(v >> 1, 3988292384::UBIGINT * (v & 1)))), 4294967295::UBIGINT) AS crc
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    row_number() OVER () AS id FROM d),
lv AS (
  SELECT tree, 0 AS level, idx, leaf AS h FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM lv) WHERE n > 1 GROUP BY tree, level, idx // 16),
subs AS (SELECT tree, max(level) AS level, arg_max(h, level) AS h, row_number() OVER (ORDER BY tree) - 1 AS rank FROM lv GROUP BY tree),
tv AS (
  SELECT 0 AS level, rank AS idx, h FROM subs
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS n FROM tv) WHERE n > 1 GROUP BY level, idx // 16),
nodes AS (SELECT * FROM lv UNION ALL SELECT 't', level, idx, h FROM tv),
runs AS (SELECT tree, level, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM nodes GROUP BY tree, level, idx // 16),
ups AS (
  SELECT r.tree, r.level, r.run, r.hs FROM runs r JOIN (SELECT tree, max(level) AS last FROM nodes GROUP BY tree) USING (tree)
  WHERE level < last),
way AS (
  SELECT id, tree, 0 AS level, idx, CASE WHEN crc % 5 = 0 THEN lowered ELSE leaf END AS fold, '' AS proof FROM leaves
  UNION ALL
  SELECT w.id, coalesce(s.new_tree, w.tree), coalesce(s.new_level, w.level + 1), coalesce(s.rank, w.idx // 16),
    CASE WHEN s.rank IS NOT NULL THEN fold ELSE
      sha256(array_to_string(list_transform(hs, lambda h, i: CASE WHEN i = w.idx % 16 + 1 THEN fold ELSE h END), '')) END,
    CASE WHEN s.rank IS NOT NULL THEN proof ELSE
      proof || array_to_string(list_filter(hs, lambda h, i: i <> w.idx % 16 + 1), '') END
  FROM way w LEFT JOIN ups u ON u.tree = w.tree AND u.level = w.level AND u.run = w.idx // 16
  LEFT JOIN (SELECT tree, level, rank, 't' AS new_tree, 0 AS new_level FROM subs) s ON s.tree = w.tree AND s.level = w.level
  WHERE u.tree IS NOT NULL OR s.tree IS NOT NULL),
ends AS (SELECT id, arg_max(fold, level) AS fold, arg_max(proof, level) AS proof FROM way WHERE tree = 't' GROUP BY id),
root AS (SELECT arg_max(h, level) AS root FROM tv)
SELECT doc_id, leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM leaves JOIN ends USING (id) JOIN subs s USING (tree), root
"""

QUERIES: dict[str, Query] = {
    "op1_token_ids": Query(op1_token_ids),
    "op2_exact_dedup": Query(op2_exact_dedup, OP2_SQL),
    "op3_url_filter": Query(op3_url_filter, OP3_SQL),
    "op4_byte_bpe": Query(op4_byte_bpe),
    "op5_toxicity": Query(op5_toxicity),
    "op6_minhash_dedup": Query(op6_minhash_dedup),
    "op7_html_extract": Query(op7_html_extract),
    "op8_decontaminate": Query(op8_decontaminate),
    "op9_quality": Query(op9_quality),
    "op10_license_scan": Query(op10_license_scan),
    "op11_filter_audit": Query(op11_filter_audit, OP11_SQL),
    "op12_language_id": Query(op12_language_id),
    "op13_merkle_manifest": Query(op13_merkle_manifest, OP13_SQL),
}
