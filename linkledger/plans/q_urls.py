"""Registered queries: URL rules, scores, domain fold, frontier (SURVEY B1-B8,
B13-B15, C2, D4, E3, E4, F1, F4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scoring, urls
from ..operators import frontier as fr
from ..operators.quality import quality_fold
from ..operators.state import empty_state
from . import inputs
from .registry import ROUND, register
from .sqltext import (action_expr, d, discovered_cte, domain_expr, events_ctes, fetched_ctes, norm_expr, pint,
                      priority_expr, quality_fold_expr, trust_expr, url_parts)

AS_OF = "2024-01-01 00:00:00"


def _r(c):
    return F.round(c, ROUND)


# ------------------------------------------------------------------ B1-B4, B6

@register("normalize_url", f"""
WITH p AS ({url_parts('pages', 'url', 'page_id, url')})
SELECT page_id, url, {norm_expr()} AS norm_url FROM p""")
def q_normalize_url(spark, sf):
    p = inputs.table(spark, sf, "pages", "page_id", "url")
    return p.select("page_id", "url", urls.normalize_url("url").alias("norm_url"))


@register("url_domain", f"""
WITH p AS ({url_parts('pages', 'url', 'page_id')})
SELECT page_id, {domain_expr(norm_expr())} AS domain FROM p""")
def q_url_domain(spark, sf):
    p = inputs.table(spark, sf, "pages", "page_id", "url")
    return p.select("page_id", urls.url_domain(urls.normalize_url("url")).alias("domain"))


@register("url_host", f"""
WITH p0 AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN url ELSE 'http://' || url END AS u FROM pages),
p AS ({url_parts('p0', 'u', 'page_id')})
SELECT page_id, split_part(_n, ':', 1) AS host FROM p""")
def q_url_host(spark, sf):
    p = inputs.table(spark, sf, "pages", "page_id", "url")
    return p.select("page_id", urls.url_host("url").alias("host"))


@register("homepage", f"""
WITH p AS ({url_parts('pages', 'url', 'page_id')})
SELECT page_id, _s || '://' || _n || '/' AS homepage FROM p""")
def q_homepage(spark, sf):
    p = inputs.table(spark, sf, "pages", "page_id", "url")
    return p.select("page_id", urls.homepage("url").alias("homepage"))


@register("url_trust", f"""
WITH p AS ({url_parts('pages', 'url', 'page_id')}),
n AS (SELECT page_id, {norm_expr()} AS norm_url FROM p)
SELECT page_id, norm_url, round({trust_expr('norm_url')}, 9) AS trust FROM n""")
def q_url_trust(spark, sf):
    p = inputs.table(spark, sf, "pages", "page_id", "url").withColumn("norm_url", urls.normalize_url("url"))
    return p.select("page_id", "norm_url", _r(urls.url_trust("norm_url")).alias("trust"))


# ------------------------------------------------------------------ B7, B8

@register("frontier_priority", f"""
WITH {events_ctes()}
SELECT seq, norm_url, round({priority_expr('relevance', trust_expr('norm_url'))}, 9) AS priority,
       {pint(priority_expr('relevance', trust_expr('norm_url')))} AS priority_int
FROM ev""")
def q_frontier_priority(spark, sf):
    ev = fr.frontier_scores(fr.discovered_events(inputs.discovered(spark, sf)))
    return ev.select("seq", "norm_url", _r(F.col("priority")).alias("priority"), "priority_int")


# ------------------------------------------------------------------ E3, E4, B13, B14

def _fold_sql(step: float) -> str:
    return f"""
WITH {events_ctes()}
SELECT domain, count(*) AS visit_count,
       round({quality_fold_expr('list(relevance ORDER BY seq)', step)}, 9) AS quality_score
FROM ev GROUP BY domain"""


@register("domain_quality", _fold_sql(scoring.QUALITY_STEP))
def q_domain_quality(spark, sf):
    ev = fr.discovered_events(inputs.discovered(spark, sf))
    out = quality_fold(ev.select("domain", "seq", "relevance"))
    return out.select("domain", "visit_count", _r(F.col("quality_score")).alias("quality_score"))


@register("domain_quality_step02", _fold_sql(scoring.QUALITY_STEP_LOAD))
def q_domain_quality_step02(spark, sf):
    ev = fr.discovered_events(inputs.discovered(spark, sf))
    out = quality_fold(ev.select("domain", "seq", "relevance"), step=scoring.QUALITY_STEP_LOAD)
    return out.select("domain", "visit_count", _r(F.col("quality_score")).alias("quality_score"))


@register("domain_visits", f"""
WITH {events_ctes()}
SELECT domain, count(*) AS visit_count, min(seq) AS first_seq FROM ev GROUP BY domain""")
def q_domain_visits(spark, sf):
    ev = fr.discovered_events(inputs.discovered(spark, sf))
    return ev.groupBy("domain").agg(F.count(F.lit(1)).alias("visit_count"), F.min("seq").alias("first_seq"))


# ------------------------------------------------------------------ D4

def _known_urls(spark, sf):
    """A url table: the normalized URLs of even page ids (the rest are new)."""
    p = inputs.table(spark, sf, "pages", "page_id", "url")
    return p.where(F.col("page_id") % 2 == 0).select(urls.normalize_url("url").alias("full_url")).distinct()


_KNOWN_SQL = f"""known0 AS ({url_parts('pages', 'url', 'page_id')}),
known AS (SELECT DISTINCT {norm_expr()} AS full_url FROM known0 WHERE page_id % 2 = 0)"""

_FIRSTS_SQL = """firsts AS (SELECT norm_url, min(seq) AS first_seq, arg_min(relevance, seq) AS relevance,
                         arg_min(domain, seq) AS domain, count(*) AS sightings FROM ev GROUP BY norm_url)"""


@register("new_urls", f"""
WITH {events_ctes()}, {_KNOWN_SQL}, {_FIRSTS_SQL}
SELECT norm_url, first_seq, sightings, round(relevance, 9) AS relevance FROM firsts
WHERE norm_url NOT IN (SELECT full_url FROM known)""")
def q_new_urls(spark, sf):
    firsts = fr.first_sightings(fr.discovered_events(inputs.discovered(spark, sf)))
    new, _ = fr.split_new_seen(firsts, _known_urls(spark, sf))
    return new.select("norm_url", "first_seq", "sightings", _r(F.col("relevance")).alias("relevance"))


@register("seen_urls", f"""
WITH {events_ctes()}, {_KNOWN_SQL}, {_FIRSTS_SQL}
SELECT norm_url, first_seq, sightings FROM firsts WHERE norm_url IN (SELECT full_url FROM known)""")
def q_seen_urls(spark, sf):
    firsts = fr.first_sightings(fr.discovered_events(inputs.discovered(spark, sf)))
    _, seen = fr.split_new_seen(firsts, _known_urls(spark, sf))
    return seen.select("norm_url", "first_seq", "sightings")


# ------------------------------------------------------------------ validate -> frontier

def validated(spark, sf):
    st0 = empty_state(spark)
    return fr.validate_batch(inputs.discovered(spark, sf), st0, AS_OF)


_FRONTIER_SQL = f"""{events_ctes()}, {_FIRSTS_SQL},
frontier AS (SELECT row_number() OVER (ORDER BY first_seq) AS url_id, norm_url AS full_url,
                    {priority_expr('relevance', trust_expr('norm_url'))} AS priority,
                    {pint(priority_expr('relevance', trust_expr('norm_url')))} AS priority_int
             FROM firsts)"""


@register("frontier_head", f"""
WITH {_FRONTIER_SQL}
SELECT url_id, full_url, round(priority, 9) AS priority, priority_int FROM frontier
ORDER BY priority_int DESC, priority DESC, url_id LIMIT 10""")
def q_frontier_head(spark, sf):
    st, _ = validated(spark, sf)
    h = fr.frontier_head(st.url_queue, st.url, 10)
    return h.select("url_id", "full_url", _r(F.col("priority")).alias("priority"), "priority_int")


@register("frontier_rank", f"""
WITH {_FRONTIER_SQL}
SELECT url_id, full_url, row_number() OVER (ORDER BY priority_int DESC, priority DESC, url_id) AS drain_rank
FROM frontier""")
def q_frontier_rank(spark, sf):
    st, _ = validated(spark, sf)
    return fr.frontier_rank(st.url_queue, st.url).select("url_id", "full_url", "drain_rank")


@register("status_routing", f"""
WITH {_FRONTIER_SQL}, {fetched_ctes()},
r AS (SELECT f.url_id, f.full_url, f.priority_int, x.status FROM frontier f LEFT JOIN fetched x USING (full_url))
SELECT url_id, full_url, status, {action_expr('status')} AS action,
       CASE WHEN {action_expr('status')} = 'demote' THEN round(greatest({d(0)}, priority_int * {d(0.75)}), 9) END AS new_priority,
       CASE WHEN {action_expr('status')} = 'demote' THEN {pint(f'greatest({d(0)}, priority_int * {d(0.75)})')} END AS new_priority_int
FROM r""")
def q_status_routing(spark, sf):
    st, _ = validated(spark, sf)
    front = st.url_queue.join(st.url.select("url_id", "full_url"), "url_id")
    routed = fr.route_fetched(front, inputs.fetched_pages(spark, sf, with_html=False), "page_id")
    return routed.select("url_id", "full_url", "status", "action", _r(F.col("new_priority")).alias("new_priority"),
                         scoring.priority_int("new_priority").alias("new_priority_int"))


@register("domain_state", f"""
WITH {events_ctes()}
SELECT domain AS domain_name, row_number() OVER (ORDER BY min(seq)) AS domain_id, count(*) AS visit_count,
       round({quality_fold_expr('list(relevance ORDER BY seq)', scoring.QUALITY_STEP)}, 9) AS quality_score
FROM ev GROUP BY domain""")
def q_domain_state(spark, sf):
    st, _ = validated(spark, sf)
    return st.domain.select("domain_name", "domain_id", "visit_count", _r(F.col("quality_score")).alias("quality_score"))
