"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from .chunk_prints import neighbour_likeness
from .collocations import collocations
from .common import read
from .conversation_repair import repair_damaged
from .exact_dedup import exact_classes
from .mixing import mix_sources
from .packing import pack
from .pseudonyms import pseudonymise
from .quotation import reply_order
from .sharding import shard_rows
from .simhash import simhash_components
from .site_quality import site_quality
from .toxicity import toxicity
from .url_rules import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql.strip()
        return fn
    return add


@query(r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_classes(read(spark, sf_dir, "documents"))


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), folds=5)


@query()
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents"), weights=(5, 2, 1), max_repeat=3)


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), length=4096, end_id=1)


#: (host, path, verdict)
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


@query(r"""
WITH p AS (SELECT page_id, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END, '') AS rest
           FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rule_host, rule_path, rule, verdict) AS (VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
             ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')),
m AS (SELECT u.page_id, u.host, u.path, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
      FROM u LEFT JOIN r ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host)) AND starts_with(u.path, r.rule_path)
      GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m""")
def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(read(spark, sf_dir, "pages"), rules)


@query()
def op6_quotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_order(read(spark, sf_dir, "conversations"))


#: The key of the registered query; a pipeline brings its own secret.
PSEUDONYM_KEY = "linkledger-registered-query"


@query()
def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(read(spark, sf_dir, "documents"), PSEUDONYM_KEY)


@query()
def op8_chunk_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_likeness(read(spark, sf_dir, "documents"))


@query()
def op9_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), folds=5)


@query()
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)


@query()
def op11_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(read(spark, sf_dir, "documents"), shards=24)


@query(r"""
WITH RECURSIVE bits AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
             string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
             lambda c, b: xor(c >> 8, bits.t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, bits),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS again
  FROM keyed WHERE kind <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), again) AS no FROM damaged),
seen AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY no) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         role[1] AS initial, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY no) AS before
  FROM r),
-- states: nothing, a system, a user or an assistant turn so far
added(state, letters, then_state, body) AS (VALUES
  ('n', '', 'n', []::VARCHAR[]), ('n', 'I', 'u', ['user:']), ('n', 'II', 'a', ['user:', 'assistant:']),
  ('s', '', 's', []::VARCHAR[]), ('s', 'I', 'u', ['user:']), ('s', 'II', 'a', ['user:', 'assistant:']),
  ('u', '', 'u', []::VARCHAR[]), ('u', 'I', 'a', ['assistant:']),
  ('a', '', 'a', []::VARCHAR[]), ('a', 'I', 'u', ['user:'])),
moved(state, letter, target, keeps) AS (VALUES
  ('n', 'D', 'n', ''), ('s', 'D', 's', ''), ('u', 'D', 'u', ''), ('a', 'D', 'a', ''),
  ('n', 'R', 'u', ''), ('s', 'R', 'u', ''), ('a', 'R', 'u', ''), ('u', 'R', 'a', ''),
  ('n', 'K', 's', 's'), ('n', 'K', 'u', 'u'), ('s', 'K', 'u', 'u'), ('a', 'K', 'u', 'u'), ('u', 'K', 'a', 'a')),
step AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS no, 'n' AS state,
         {'cost': 0, 'audit': '', 'body': []::VARCHAR[]} AS best FROM seen
  UNION ALL
  SELECT s.conv_id, s.no + 1, m.target, min({
           'cost': s.best.cost + (2 * length(i.letters) + CASE m.letter WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
                   + CASE WHEN m.letter <> 'D' AND x.fault = 'truncated' THEN 1 ELSE 0 END)::INTEGER,
           'audit': s.best.audit || i.letters || m.letter,
           'body': s.best.body || i.body || CASE m.letter WHEN 'D' THEN []::VARCHAR[]
                   WHEN 'K' THEN [x.role || ':' || x.text]
                   ELSE [CASE m.target WHEN 'u' THEN 'user:' ELSE 'assistant:' END || x.text] END})
  FROM step s JOIN seen x ON x.conv_id IS NOT DISTINCT FROM s.conv_id AND x.no = s.no + 1
  JOIN added i ON i.state = s.state JOIN moved m ON m.state = i.then_state
  WHERE (m.letter = 'D' OR x.fault NOT IN ('blank', 'duplicate')) AND (m.letter <> 'K' OR x.initial = m.keeps)
  GROUP BY ALL),
size AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated,
                count(*) FILTER (no > 1 AND NOT coalesce(before || initial IN ('su', 'ua', 'au'), false)) AS illegal
         FROM seen GROUP BY conv_id),
done AS (
  SELECT z.conv_id, min({'cost': s.best.cost + 2 * length(i.letters), 'audit': s.best.audit || i.letters,
                         'body': s.best.body || i.body}) AS best
  FROM size z JOIN step s ON s.conv_id IS NOT DISTINCT FROM z.conv_id AND s.no = z.n
  JOIN added i ON i.state = s.state AND i.then_state IN ('n', 'a')
  GROUP BY z.conv_id)
SELECT e.conv_id, coalesce(z.gaps, 0)::BIGINT AS gaps, coalesce(z.blank, 0) AS blank, coalesce(z.duplicate, 0) AS duplicate,
       coalesce(z.truncated, 0) AS truncated, coalesce(z.illegal, 0) AS illegal, coalesce(d.best.cost, 0)::BIGINT AS cost,
       coalesce(d.best.audit, '') AS audit, sha256(coalesce(array_to_string(d.best.body, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e
LEFT JOIN size z ON z.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM e.conv_id""")
def op12_hirschberg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(read(spark, sf_dir, "conversations"))


@query(r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
      FROM w, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k),
f AS (SELECT lang, g, len(g) AS k, count(*) AS f FROM g GROUP BY lang, g),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
gone AS (SELECT lang, g[1:2] AS g, f FROM c WHERE k = 3 UNION ALL SELECT lang, g[2:3], f FROM c WHERE k = 3),
kept AS (SELECT c.* FROM c WHERE NOT EXISTS (SELECT 1 FROM gone o WHERE o.lang = c.lang AND o.g = c.g AND 100 * o.f >= 50 * c.f)),
cut AS (SELECT kept.lang, kept.g, kept.f AS a, x.f AS l, y.f AS r, s.j,
               (1000000::HUGEINT * kept.f * kept.f // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM kept JOIN (VALUES (1), (2)) AS s(j) ON s.j < kept.k
        JOIN f x ON x.lang = kept.lang AND x.g = kept.g[1:s.j] JOIN f y ON y.lang = kept.lang AND y.g = kept.g[s.j + 1:]),
lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
ranked AS (SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER (
             PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"), least=10, top=2000, absorbed=50)


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
