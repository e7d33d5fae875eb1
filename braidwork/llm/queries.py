"""The operators as queries over the tables of a folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exponion, langid, licences, mixing, packing, ppm, repetition, resampling, sigtree, spans, telephony, tokenfiles, urlfilter
from .common import documents

TOKENIZER = "byte_bpe_50k.json"


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir), (5, 2, 1), 1.5, 2.0).select("doc_id", "size", "source_size", "target", "taken")


def op2_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), 1024, 2, remembered=400_000)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.read_token_files(tokenfiles.write_token_files(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), 0))


def op4_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sigtree.jaccard_components(documents(spark, sf_dir), 5, 75)


def op5_telephony_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = documents(spark, sf_dir).select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("payload"))
    return telephony.media_features(telephony.store_audio(payloads, telephony.CODECS, 8000), 4000)


def op6_automaton_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans.remove_repeated_spans(documents(spark, sf_dir).select("doc_id", "text"), 13)
    return found.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"), F.sha2("__kept", 256).alias("kept_sha256"))


def op7_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.ppm_scores(documents(spark, sf_dir), 7, 2)


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return urlfilter.judge_urls(pages, urlfilter.rule_table(spark, urlfilter.RULES), "allow")


def op9_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return repetition.repetition_report(documents(spark, sf_dir)).select(*names)


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(documents(spark, sf_dir), 0.75)


def op11_kneser_ney_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(documents(spark, sf_dir), 4, 2)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance_resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 5, 20, 10_000, 42)


def op13_exponion_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exponion.cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 16, 3, 64, 64.0, 1)


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM s),
r AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS ratio, (sum(source_size) OVER ()) * 1.5::DOUBLE AS words, sum(weight) OVER () AS all_weight FROM w),
v AS (SELECT *, (words - coalesce(sum(cap) OVER o, 0)) / (all_weight - coalesce(sum(weight) OVER o, 0)) AS lvl FROM r
      WINDOW o AS (ORDER BY ratio, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, coalesce(max(CASE WHEN lvl <= ratio THEN lvl END) OVER () * weight, cap)) AS target FROM v),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             CASE WHEN t.source_size > 0 THEN floor(floor(t.target) / t.source_size) ELSE 0 END AS epochs
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - before)))::BIGINT AS taken
FROM p
"""

OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a AS x, b AS y FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM (SELECT id AS doc_id, min(root) AS component_id FROM r GROUP BY id) LEFT JOIN n USING (doc_id)
"""

OP6_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
f AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM win JOIN f USING (g) WHERE m < doc_id),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN (
  SELECT x.doc_id, count(c.pos) AS n_removed, string_agg(word, ' ' ORDER BY x.pos) FILTER (c.pos IS NULL) AS kept FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.pos = c.pos GROUP BY x.doc_id) k ON k.doc_id = w.doc_id
"""

OP9_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM w),
win AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (VALUES (3), (5), (6), (7), (8), (9), (10)) t(k) WHERE len(ws) >= k)),
rep AS (SELECT doc_id, k, i, count(*) OVER (PARTITION BY doc_id, k, g) AS n, row_number() OVER (PARTITION BY doc_id, k, g ORDER BY i) AS nth FROM win),
cov AS (SELECT DISTINCT doc_id, k, unnest(range(i, i + k)) AS pos FROM rep WHERE CASE WHEN k = 3 THEN n > 1 ELSE nth > 1 END),
per AS (SELECT doc_id, k, count(*) AS covered, sum(length(word)) AS chars FROM cov JOIN x USING (doc_id, pos) GROUP BY doc_id, k),
grams AS (
  SELECT doc_id, max(covered) FILTER (k = 3) AS n_repeat_words, max(chars) FILTER (k = 5) AS c5, max(chars) FILTER (k = 6) AS c6, max(chars) FILTER (k = 7) AS c7, max(chars) FILTER (k = 8) AS c8,
         max(chars) FILTER (k = 9) AS c9, max(chars) FILTER (k = 10) AS c10 FROM per GROUP BY doc_id),
ln AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS nth FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS line_chars FROM ln WHERE nth > 1 GROUP BY doc_id),
b AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(line_chars, 0) AS line_chars,
         coalesce(c5, 0) AS c5, coalesce(c6, 0) AS c6, coalesce(c7, 0) AS c7, coalesce(c8, 0) AS c8, coalesce(c9, 0) AS c9, coalesce(c10, 0) AS c10
  FROM w LEFT JOIN grams USING (doc_id) LEFT JOIN dup USING (doc_id)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, greatest(word_chars, 1)::DOUBLE AS whole FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND line_chars / whole <= 0.30::DOUBLE AND n_symbols <= 0.10::DOUBLE * n_words AND c5 / whole <= 0.15::DOUBLE AND c6 / whole <= 0.14::DOUBLE AND c7 / whole <= 0.13::DOUBLE
         AND c8 / whole <= 0.12::DOUBLE AND c9 / whole <= 0.11::DOUBLE AND c10 / whole <= 0.10::DOUBLE AS kept
FROM v
"""

OP8_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n FROM u),
r(says, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (
  SELECT n, arg_max(r.h || r.p, length(r.h || r.p)) AS rule, arg_max(says, length(r.h || r.p)) AS says
  FROM h JOIN r ON (h.host = r.h OR ends_with(h.host, '.' || r.h)) AND starts_with(h.path, r.p) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict FROM h LEFT JOIN m USING (n)
"""

# the CRC of bytes is folded from its table, which is made from the polynomial
OP12_SQL = r"""
WITH RECURSIVE bits(n, k, v) AS (
  SELECT range::UBIGINT, 0, range::UBIGINT FROM range(256)
  UNION ALL SELECT n, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM bits WHERE k < 8),
tab AS MATERIALIZED (SELECT list(v ORDER BY n) AS t FROM bits WHERE k = 8),
doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
item AS (
  SELECT coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM benchmark),
texts AS (SELECT r, ws FROM doc UNION ALL SELECT 0, ws FROM item),
feat AS MATERIALIZED (
  SELECT r, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM texts, (VALUES (1), (2), (3)) n(k) WHERE len(ws) >= k)),
hashed AS MATERIALIZED (
  SELECT g, (xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(range(octet_length(encode(g))), lambda i: ('0x' || substr(hex(encode(g)), (2 * i + 1)::INT, 2))::UBIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b)::INT + 1]))) % 10000)::INT AS bucket
  FROM (SELECT DISTINCT g FROM feat), tab),
fb AS MATERIALIZED (SELECT r, bucket FROM feat JOIN hashed USING (g)),
cnt AS (SELECT bucket, count(*) FILTER (r > 0) AS s, count(*) FILTER (r = 0) AS t FROM fb GROUP BY bucket),
tot AS (SELECT count(*) FILTER (r > 0) AS s, count(*) FILTER (r = 0) AS t FROM fb),
gain AS (
  SELECT bucket, floor(1000.0::DOUBLE * ln((c.t + 1)::DOUBLE * (tot.s::DOUBLE + 10000) / ((c.s + 1)::DOUBLE * (tot.t::DOUBLE + 10000))))::BIGINT AS gain FROM cnt c, tot),
w AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM fb JOIN gain USING (bucket) WHERE r > 0 GROUP BY r),
d AS (
  SELECT r, doc_id, len(ws) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT AS h FROM doc LEFT JOIN w USING (r)),
s AS (
  SELECT *, weight + floor(-1000.0::DOUBLE * ln(-ln((h::DOUBLE + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score, n_words >= 20 AS eligible FROM d),
k AS (SELECT *, row_number() OVER (PARTITION BY eligible ORDER BY score DESC, doc_id ASC NULLS LAST) AS place, count(*) FILTER (eligible) OVER () AS n FROM s)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND place <= 5 * n // 100 THEN place END::BIGINT AS rank FROM k
"""


def op13_sql(rounds: int = 3, k: int = 16, seed: int = 1) -> str:
    """The rounds one after the other: every distance, the smallest, the new centroids."""
    head = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
x AS MATERIALIZED (SELECT r, unnest(v) AS x, unnest(range(64)) AS i FROM kept),
c0 AS MATERIALIZED (
  SELECT c, unnest(v) AS x, unnest(range(64)) AS i
  FROM (SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), vec_id NULLS LAST, v) - 1 AS c FROM kept) WHERE c < {k})"""
    nearest = """,
a{n} AS MATERIALIZED (
  SELECT r, c, d FROM (SELECT r, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS place
    FROM (SELECT r, c, sum((x.x - c.x) * (x.x - c.x))::BIGINT AS d FROM x JOIN c{n} c USING (i) GROUP BY r, c)) WHERE place = 1)"""
    move = """,
m{n} AS (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{n} JOIN x USING (r) GROUP BY c, i),
c{m} AS MATERIALIZED (SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, x) AS x FROM c{n} LEFT JOIN m{n} USING (c, i))"""
    steps = "".join(nearest.format(n=n) + move.format(n=n, m=n + 1) for n in range(rounds)) + nearest.format(n=rounds)
    return head + steps + f""",
h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN h USING (c)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_source_mix, op2_sum_of_squares_packing, op3_token_files, op4_jaccard_groups, op5_telephony_media,
        op6_automaton_spans, op7_ppm_scores, op8_url_rules, op9_repetition_rules, op10_licence_scan,
        op11_kneser_ney_languages, op12_importance_resampling, op13_exponion_clusters,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_source_mix": OP1_SQL, "op4_jaccard_groups": OP4_SQL, "op6_automaton_spans": OP6_SQL, "op8_url_rules": OP8_SQL, "op9_repetition_rules": OP9_SQL,
        "op12_importance_resampling": OP12_SQL, "op13_exponion_clusters": op13_sql(),
    }
