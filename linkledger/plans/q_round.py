"""Registered queries over one full crawl round on the test data (SURVEY D6, D7,
E5, E6, E8, F2, G4, H2, H9, I3): the discovered URLs of every page, the pages
table as fetch results, all page titles as the mention vocabulary and the
titles, with derived names, as the entity table."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from ..operators.frontier import entity_queue_head
from ..operators.load import rejected_sources
from ..operators.state import empty_state, queue_lengths
from . import inputs
from .q_ingest import _HITS_SQL, responses, seeds
from .q_pages import profiled, title_entities, title_vocabulary
from .q_urls import AS_OF, _FIRSTS_SQL
from .registry import ROUND, register
from .rounds import gazetteer_extractor, run_round, run_seed_round
from .sqltext import (action_expr, d, derived_priority_expr, events_ctes, fetched_ctes, names_ctes, page_ctes, pint,
                      priority_expr, relevance_expr, trust_expr, url_parts, vocab_ents_ctes)


def _r(c):
    return F.round(c, ROUND)


def crawl_round(spark, sf):
    prof = profiled(spark, sf)
    st0 = empty_state(spark, entity=title_entities(prof))
    return run_round(st0, inputs.discovered(spark, sf), inputs.fetched_pages(spark, sf),
                     gazetteer_extractor(title_vocabulary(prof)), AS_OF)


@lru_cache(maxsize=2)
def round_sql(disc: str | None = None) -> str:
    """CTE chain of the round over ``disc`` (all discovered URLs), ending in pages_out, refs, rejq,
    derived, feedback."""
    return f"""{events_ctes(disc)}, {_FIRSTS_SQL},
frontier AS (SELECT row_number() OVER (ORDER BY first_seq) AS url_id, norm_url AS full_url,
                    {priority_expr('relevance', trust_expr('norm_url'))} AS priority,
                    {pint(priority_expr('relevance', trust_expr('norm_url')))} AS priority_int FROM firsts),
ranked AS (SELECT *, row_number() OVER (ORDER BY priority_int DESC, priority DESC, url_id) AS drain_rank FROM frontier),
{fetched_ctes()},
routed AS (SELECT r.url_id, r.full_url, r.priority_int, r.drain_rank, x.status, x.html, {action_expr('x.status')} AS action
           FROM ranked r LEFT JOIN fetched x USING (full_url)),
rp AS (SELECT url_id AS page_id, full_url AS url, html FROM routed WHERE action = 'parse'),
{page_ctes('rp', 'rprof')},
good AS (SELECT * FROM rprof WHERE has_body AND text_concat_len >= 10),
{page_ctes('pages', 'prof')},
{vocab_ents_ctes('prof')},
{names_ctes('good', 'r')},
pin AS (SELECT g.page_id AS url_id, g.url AS full_url, ro.priority_int AS parent, ro.drain_rank,
               coalesce(pm.names, []::VARCHAR[]) AS names, coalesce(pm.rejected, []::VARCHAR[]) AS rejected,
               {relevance_expr('lower(g.text)', 'list_transform(g.headers, lambda h: lower(h))',
                               'coalesce(pm.names, []::VARCHAR[])', 'ro.priority_int')} AS relevance,
               g.hrefs
        FROM good g JOIN routed ro ON ro.url_id = g.page_id LEFT JOIN pmr pm ON pm.page_id = g.page_id),
refs AS (SELECT e.entity_id, p.url_id, p.relevance FROM pin p, unnest(p.names) AS t(name)
         JOIN (SELECT name, min(entity_id) AS entity_id FROM ents GROUP BY name) e ON e.name = t.name),
rej0 AS (SELECT t.name, p.relevance * {d(100)} AS priority, p.drain_rank FROM pin p, unnest(p.rejected) AS t(name)),
rejq AS (SELECT name, arg_max(priority, drain_rank) AS priority FROM rej0 GROUP BY name),
lk0 AS ({url_parts('pin', 'full_url', 'url_id, full_url, parent, names, hrefs, drain_rank')}),
lk AS (SELECT DISTINCT url_id, link FROM (
         SELECT url_id, CASE WHEN h = '' THEN full_url WHEN _s IN ('http', 'https') AND _n <> ''
                             AND regexp_matches(h, '^/[^/;\\s]') THEN _s || '://' || _n || h END AS link
         FROM lk0, unnest(hrefs) AS t(h)) WHERE link LIKE 'http%'),
home AS (SELECT url_id, _s || '://' || _n || '/' AS homepage, parent, names, drain_rank FROM lk0),
derived AS (SELECT url_id, homepage AS url, CAST(least(100, parent) AS DOUBLE) AS priority, true AS is_homepage, drain_rank FROM home
            UNION ALL
            SELECT l.url_id, l.link, {derived_priority_expr('l.link', 'h.names', 'h.parent')}, false, h.drain_rank
            FROM lk l JOIN home h USING (url_id) WHERE l.link <> h.homepage),
feedback AS (SELECT (SELECT max(seq) FROM disc) + row_number() OVER (ORDER BY drain_rank, is_homepage DESC, url) AS seq,
                    url, priority AS relevance, is_homepage, url_id FROM derived)"""


@register("build_references", f"""
WITH {round_sql()}
SELECT entity_id, url_id, round(relevance, 9) AS relevance FROM refs""")
def q_build_references(spark, sf):
    out = crawl_round(spark, sf)
    return out.references.select("entity_id", "url_id", _r(F.col("relevance")).alias("relevance"))


@register("references_repeated_pages", f"""
WITH {round_sql()}
SELECT entity_id, url_id, round(relevance, 9) AS relevance FROM refs""")
def q_references_repeated_pages(spark, sf):
    """Every page landed twice, and once more as a later fetch without a response: the
    references are those of one fetch of each URL."""
    prof = profiled(spark, sf)
    pages = inputs.fetched_pages(spark, sf)
    later = pages.withColumn("page_id", F.col("page_id") + F.lit(10**9)).withColumn("status", F.lit(404))
    out = run_round(empty_state(spark, entity=title_entities(prof)), inputs.discovered(spark, sf),
                    pages.unionByName(pages).unionByName(later), gazetteer_extractor(title_vocabulary(prof)), AS_OF)
    return out.references.select("entity_id", "url_id", _r(F.col("relevance")).alias("relevance"))


@register("frontier_round2")
def q_frontier_round2(spark, sf):
    """Two rounds: what the first feeds back is the second's batch, and the pages that
    were demoted in the first answer in the second. Sequence numbers of both
    feedbacks, which go on without a gap or a repeat."""
    prof = profiled(spark, sf)
    extract = gazetteer_extractor(title_vocabulary(prof))
    one = run_round(empty_state(spark, entity=title_entities(prof)), inputs.discovered(spark, sf),
                    inputs.fetched_pages(spark, sf), extract, AS_OF)
    again = inputs.fetched_pages(spark, sf).withColumn("status", F.lit(200))
    two = run_round(one.state, one.feedback.select("seq", "url", "relevance"), again, extract, AS_OF)
    return (one.feedback.select(F.lit(1).alias("round"), "seq", "url", _r(F.col("relevance")).alias("relevance"))
            .unionByName(two.feedback.select(F.lit(2).alias("round"), "seq", "url", _r(F.col("relevance")).alias("relevance"))))


#: What the seeds' searches have found: distinct hits of each seed, numbered by seed and URL.
_SEARCHED_SQL = f"""WITH {_HITS_SQL},
found AS (SELECT DISTINCT pos, url, CASE WHEN pos % 2 = 0 THEN {d(1)} ELSE {d(0.99)} END AS relevance
          FROM hits WHERE pos IN (SELECT c_custkey FROM customer))
SELECT row_number() OVER (ORDER BY pos, url) AS seq, url, relevance FROM found"""


@register("full_round", f"""
WITH {round_sql(_SEARCHED_SQL)}
SELECT entity_id, url_id, round(relevance, 9) AS relevance FROM refs""")
def q_full_round(spark, sf):
    """From seeds to feedback: search queries and their landed responses, distinct hits
    of each seed, the discovered batch, and the round over it."""
    prof = profiled(spark, sf)
    out = run_seed_round(empty_state(spark, entity=title_entities(prof)), seeds(spark, sf).withColumn(
        "initial_search", F.col("pos") % 2 == 0), responses(spark, sf), inputs.fetched_pages(spark, sf),
        gazetteer_extractor(title_vocabulary(prof)), AS_OF)
    return out.references.select("entity_id", "url_id", _r(F.col("relevance")).alias("relevance"))


@register("rejected_queue", f"""
WITH {round_sql()}
SELECT name, round(priority, 9) AS priority, {pint('priority')} AS priority_int FROM rejq""")
def q_rejected_queue(spark, sf):
    out = crawl_round(spark, sf)
    return out.state.entity_queue.select("name", _r(F.col("priority")).alias("priority"), "priority_int")


@register("rejected_sources", f"""
WITH {round_sql()}
SELECT t.name, p.full_url AS source_url, round(p.relevance * {d(100)}, 9) AS priority FROM pin p, unnest(p.rejected) AS t(name)""")
def q_rejected_sources(spark, sf):
    return rejected_sources(crawl_round(spark, sf).pages).select("name", "source_url", _r(F.col("priority")).alias("priority"))


@register("frontier_round", f"""
WITH {round_sql()}
SELECT seq, url, round(relevance, 9) AS relevance, is_homepage, url_id FROM feedback""")
def q_frontier_round(spark, sf):
    out = crawl_round(spark, sf)
    return out.feedback.select("seq", "url", _r(F.col("relevance")).alias("relevance"), "is_homepage", "url_id")


@register("queue_lengths", f"""
WITH {round_sql()}
SELECT 'url_queue' AS queue, count(*) AS n FROM routed WHERE action = 'demote'
UNION ALL SELECT 'entity_queue', count(*) FROM rejq""")
def q_queue_lengths(spark, sf):
    return queue_lengths(crawl_round(spark, sf).state)


@register("entity_queue_head", f"""
WITH {round_sql()}
SELECT name, round(priority, 9) AS priority, {pint('priority')} AS priority_int FROM rejq
ORDER BY {pint('priority')} DESC, priority DESC, name LIMIT 5""")
def q_entity_queue_head(spark, sf):
    head = entity_queue_head(crawl_round(spark, sf).state.entity_queue, 5)
    return head.select("name", _r(F.col("priority")).alias("priority"), "priority_int")


@register("state_summary", f"""
WITH {round_sql()}
SELECT 'discovered' AS stage, count(*) AS n FROM disc
UNION ALL SELECT 'validated', count(*) FROM frontier
UNION ALL SELECT 'removed', count(*) FROM routed WHERE action = 'remove'
UNION ALL SELECT 'demoted', count(*) FROM routed WHERE action = 'demote'
UNION ALL SELECT 'parsed', count(*) FROM routed WHERE action = 'parse'
UNION ALL SELECT 'transformed', count(*) FROM pin
UNION ALL SELECT 'references', count(*) FROM refs
UNION ALL SELECT 'rejected', count(*) FROM rej0
UNION ALL SELECT 'fed_back', count(*) FROM feedback""")
def q_state_summary(spark, sf):
    """Items per stage of the round, as labelled counts in one job."""
    out = crawl_round(spark, sf)
    disc = inputs.discovered(spark, sf)
    parts = [
        ("discovered", disc),
        ("validated", out.routed),
        ("removed", out.routed.where(F.col("action") == "remove")),
        ("demoted", out.routed.where(F.col("action") == "demote")),
        ("parsed", out.routed.where(F.col("action") == "parse")),
        ("transformed", out.pages),
        ("references", out.references),
        ("rejected", out.pages.select(F.explode("rejected"))),
        ("fed_back", out.feedback),
    ]
    res = None
    for label, df in parts:
        c = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("stage"), "n")
        res = c if res is None else res.unionByName(c)
    return res
