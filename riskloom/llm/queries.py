"""The operators' registered queries: thin digests over whole tables, with oracle SQL where
SQL can express the result."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    decontaminate,
    exact_dedup,
    hard_negatives,
    harmonic_packing,
    license_scan,
    line_dedup,
    lm_score,
    near_dedup,
    packing,
    spelling,
    suffix_dedup,
    toxicity,
    url_filter,
)
from riskloom.llm.base import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            see_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return deco


def see_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a cluster that ships
    it another way, such as --py-files, is left alone)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op1_decontaminate",
    f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: array_to_string(w[i : i + least(10, len(w)) - 1], ' '))) AS win
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT dw.doc_id, dw.i, dw.size, bw.item_id FROM dw JOIN bw USING (size, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item_id)) AS items FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


@query(
    "op2_exact_dedup",
    r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ 	-
]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""",
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op5_line_dedup",
    r"""
WITH l AS (
  SELECT doc_id, i, x AS line, translate(regexp_replace(regexp_replace(x, '^[ 	-
]+', ''), '[ 	-
]+$', ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(s) AS x, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))),
k AS (SELECT k, max(doc_id) AS top FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.doc_id, i, line, top IS NOT NULL AND l.doc_id <> top AS gone FROM l LEFT JOIN k USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


@query("op7_best_fit_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.tokens(table(spark, sf_dir, "documents"), packing.default_tokenizer()))


@query(
    "op8_minhash_near_dedup",
    r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
e AS (SELECT x AS u, y AS v FROM link UNION ALL SELECT y, x FROM link),
r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
m AS (SELECT u, min(least(u, v)) AS c FROM r GROUP BY u)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id, coalesce(m.c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.u = w.doc_id""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("llr_per_byte")


@query(
    "op9_url_filter",
    r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, coalesce(html, '') AS html,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
tag AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS t FROM p),
link AS (
  SELECT DISTINCT url, replace(CASE
    WHEN regexp_matches(t, '(?is)^<link\b[^>]*\brel\s*=\s*["'']?canonical\b') THEN regexp_extract(t, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
    WHEN regexp_matches(t, '(?is)^<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(t, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)
    END, '&amp;', '&') AS l
  FROM tag WHERE url IS NOT NULL),
target AS (
  SELECT url, CASE
    WHEN contains(l, '://') THEN l
    WHEN starts_with(l, '//') THEN regexp_replace(regexp_extract(url, '(?s)^(.*?://)', 1), '//$', '') || l
    WHEN starts_with(l, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || l
    ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:/[^?#]*)?)/[^/?#]*(?:[?#].*)?$', 1) || '/' || l END AS l
  FROM link WHERE l <> ''),
u AS (SELECT url FROM p UNION SELECT l FROM target),
h AS (
  SELECT url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_replace(regexp_replace(coalesce(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), ''), '(^|&)(ref|utm_[a-z]+|gclid|fbclid)=[^&]*', '', 'gi'), '^&', '') AS asked
  FROM u),
n AS (
  SELECT url, CASE WHEN host = '' THEN url ELSE host || regexp_replace(regexp_replace(path, '(/index)?\.html?$', ''), '/+$', '') || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END END AS node,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM h),
e AS (
  SELECT a.node AS x, b.node AS y FROM target JOIN n a ON a.url = target.url JOIN n b ON b.url = target.l
  UNION SELECT b.node, a.node FROM target JOIN n a ON a.url = target.url JOIN n b ON b.url = target.l),
r AS (SELECT DISTINCT node AS x, node AS y FROM n WHERE node IS NOT NULL UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
seen AS (
  SELECT r.x AS node, bool_or(rule IN ('example.net/en/', 'org/fr/')) AS allowed, bool_or(rule IN ('net/', 'example.com/de/')) AS blocked
  FROM r JOIN n ON n.node = r.y GROUP BY r.x)
SELECT p.page_id, p.host, p.path, n.rule,
       CASE WHEN n.rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN n.rule IS NOT NULL THEN 'block'
            WHEN NOT coalesce(allowed, FALSE) AND blocked THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN n ON n.url = p.url LEFT JOIN seen ON seen.node = n.node""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).drop("target")


@query("op6_lm_score")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents")).drop("per_token")


@query(
    "op4_suffix_dedup",
    r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM d WHERE length(h) >= 400)),
again AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
r AS (SELECT doc_id, i, i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 AS gap FROM w SEMI JOIN again USING (k)),
g AS (SELECT doc_id, i, count(*) FILTER (WHERE gap) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
span AS (SELECT doc_id, min(i) AS lo, max(i) + 200 AS hi FROM g GROUP BY doc_id, run),
cut AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS last FROM span),
part AS (
  SELECT doc_id, last, substr(h, 2 * last + 1, 2 * (lo - last)) AS p FROM cut JOIN d USING (doc_id)
  UNION ALL
  SELECT doc_id, hi, substr(h, 2 * hi + 1) FROM (SELECT doc_id, max(hi) AS hi FROM span GROUP BY doc_id) JOIN d USING (doc_id)),
kept AS (SELECT doc_id, string_agg(p, '' ORDER BY last) AS h FROM part GROUP BY doc_id),
size AS (SELECT doc_id, count(*) AS n, sum(hi - lo) AS b FROM span GROUP BY doc_id)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(b, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN kept USING (doc_id)""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    names = F.array_join(F.array_sort(F.array_distinct(F.col("found.license"))), ",")
    return rows.select("doc_id", "n_words", F.size("found").cast("long").alias("n_found"), names.alias("licenses"), F.coalesce(F.array_max("found.coverage"), F.lit(0.0)).alias("best_coverage"))


@query(
    "op11_hard_negatives",
    """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, p.id ORDER BY s.score DESC, s.id) AS INT) AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


@query(
    "op12_spelling_variants",
    r"""
WITH RECURSIVE bits AS (SELECT b, b AS c, 0 AS k FROM range(256) AS r(b) UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
hexes AS (SELECT map(list(printf('%02X', b)), list(b)) AS m FROM range(256) AS r(b)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
kinds AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
coded AS (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM kinds),
bytes AS (SELECT run, n, list_transform(range(length(x) // 2), lambda i: m[x[2 * i + 1 : 2 * i + 2]]) AS y FROM coded, hexes),
summed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, y), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM bytes, crc),
made AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM summed),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS v FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
  UNION SELECT less.word, w.word, w.n FROM less JOIN w ON w.word = less.v
  UNION SELECT w.word, less.word, less.n FROM less JOIN w ON w.word = less.v),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS m FROM near GROUP BY word),
formed AS (SELECT best.word, min(near.near) AS form, m FROM best JOIN near ON near.word = best.word AND near.near_n = m JOIN w ON w.word = best.word WHERE m >= 10 * w.n GROUP BY best.word, m),
chain AS (SELECT word, word AS root, 0 AS k FROM w UNION ALL SELECT chain.word, formed.form, k + 1 FROM chain JOIN formed ON formed.word = chain.root),
root AS (SELECT word, arg_max(root, k) AS root FROM chain GROUP BY word)
SELECT w.word, formed.form, root.root, w.n, coalesce(n_near, 0) AS n_near, formed.m AS form_n
FROM w JOIN root USING (word) LEFT JOIN best USING (word) LEFT JOIN formed USING (word)""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query("op13_harmonic_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic_packing.pack(table(spark, sf_dir, "documents"), harmonic_packing.default_tokenizer())
