"""Registered queries: entity popularity (E8) and domain authority."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls
from ..operators import pages as pg
from ..operators.rank import bipartite_authority, entity_popularity, pagerank
from ..session import cut_lineage, scratch_root
from ..sources.popularity import Popularity
from .q_pages import _BASE_SQL, _PROF, _link_sql, profiled
from .q_round import crawl_round, round_sql
from .registry import ROUND, register
from .sqltext import d, domain_expr, url_parts

ITERATIONS = 5


@register("entity_popularity", f"""
WITH {round_sql()}
SELECT r.entity_id, count(*) AS "references", count(DISTINCT r.url_id) AS distinct_urls,
       count(DISTINCT {domain_expr('f.full_url')}) AS distinct_domains
FROM refs r JOIN frontier f USING (url_id) GROUP BY r.entity_id""")
def q_entity_popularity(spark, sf):
    st = crawl_round(spark, sf).state
    return entity_popularity(st.reference, st.url, st.source, st.domain)


@register("popularity_kept_up", f"""
WITH {round_sql()}
SELECT r.entity_id, count(*) AS "references", count(DISTINCT r.url_id) AS distinct_urls,
       count(DISTINCT {domain_expr('f.full_url')}) AS distinct_domains
FROM refs r JOIN frontier f USING (url_id) GROUP BY r.entity_id""")
def q_popularity_kept_up(spark, sf):
    """The references of a round, added in three batches."""
    st = crawl_round(spark, sf).state
    refs = cut_lineage(st.reference)
    url, source = cut_lineage(st.url), cut_lineage(st.source)
    kept = Popularity(spark, scratch_root(spark, "popularity"))
    for k in range(3):
        kept.add(refs.where(F.pmod(F.xxhash64("entity_id", "url_id"), F.lit(3)) == k), url, source, k + 1)
    return kept.totals()


def _authority_sql() -> str:
    steps = []
    prev = "r0"
    for i in range(1, ITERATIONS + 1):
        steps.append(f"""w{i} AS (SELECT e.item, sum({prev}.r / e.dk) AS w FROM ed e JOIN {prev} USING (domain) GROUP BY e.item),
b{i} AS (SELECT e.domain, sum(w{i}.w / e.ik) AS s FROM ed e JOIN w{i} USING (item) GROUP BY e.domain),
m{i} AS (SELECT coalesce(sum(r), {d(0)}) AS dm FROM {prev} WHERE domain NOT IN (SELECT domain FROM ed)),
r{i} AS (SELECT nodes.domain, {d(0.15)} / cnt.n + {d(0.85)} * (coalesce(b{i}.s, {d(0)}) + m{i}.dm / cnt.n) AS r
         FROM nodes LEFT JOIN b{i} USING (domain), m{i}, cnt)""")
        prev = f"r{i}"
    return f"""WITH {_PROF}, {_BASE_SQL},
lk AS (SELECT DISTINCT page_id, link FROM (SELECT page_id, {_link_sql('h')} AS link FROM base1, unnest(hrefs) AS t(h))
       WHERE link LIKE 'http%'),
pd AS (SELECT page_id, {domain_expr('full_url')} AS domain FROM base),
lp AS ({url_parts('lk', 'link', 'page_id')}),
e AS (SELECT DISTINCT pd.domain, lp._p AS item FROM lp JOIN pd USING (page_id)),
nodes AS (SELECT DISTINCT domain FROM pd),
cnt AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes),
ed AS (SELECT e.domain, e.item, dd.dk, ii.ik FROM e
       JOIN (SELECT domain, count(*) AS dk FROM e GROUP BY domain) dd USING (domain)
       JOIN (SELECT item, count(*) AS ik FROM e GROUP BY item) ii USING (item)),
r0 AS (SELECT domain, {d(1)} / cnt.n AS r FROM nodes, cnt),
{",\n".join(steps)}
SELECT domain, round(r, 9) AS authority FROM {prev}"""


@register("domain_authority", _authority_sql())
def q_domain_authority(spark, sf):
    prof = profiled(spark, sf)
    pd_ = prof.select("page_id", urls.url_domain("full_url").alias("domain"))
    links = pg.page_links(prof, "page_id", "full_url")
    edges = links.join(pd_, "page_id").select("domain", urls.path("link").alias("item"))
    out = bipartite_authority(edges, pd_.select("domain"), iterations=ITERATIONS)
    return out.select("domain", F.round("authority", ROUND).alias("authority"))


def _pagerank_sql() -> str:
    steps, prev = [], "r0"
    for i in range(1, ITERATIONS + 1):
        steps.append(f"""s{i} AS (SELECT e.dst AS node, sum({prev}.r / o.k) AS s FROM e JOIN o USING (src) JOIN {prev} ON {prev}.node = e.src GROUP BY e.dst),
m{i} AS (SELECT coalesce(sum(r), {d(0)}) AS dm FROM {prev} WHERE node NOT IN (SELECT src FROM o)),
r{i} AS (SELECT nodes.node, {d(0.15)} / cnt.n + {d(0.85)} * (coalesce(s{i}.s, {d(0)}) + m{i}.dm / cnt.n) AS r
         FROM nodes LEFT JOIN s{i} USING (node), m{i}, cnt)""")
        prev = f"r{i}"
    return f"""WITH {_PROF}, {_BASE_SQL},
e AS (SELECT DISTINCT full_url AS src, link AS dst FROM (SELECT full_url, {_link_sql('h')} AS link FROM base1, unnest(hrefs) AS t(h))
      WHERE link LIKE 'http%'),
nodes AS (SELECT src AS node FROM e UNION SELECT dst FROM e UNION SELECT full_url FROM base),
cnt AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes),
o AS (SELECT src, count(*) AS k FROM e GROUP BY src),
r0 AS (SELECT node, {d(1)} / cnt.n AS r FROM nodes, cnt),
{",\n".join(steps)}
SELECT node, round(r, 9) AS rank FROM {prev}"""


@register("pagerank", _pagerank_sql())
def q_pagerank(spark, sf):
    """Directed: pages and the URLs that they link to."""
    prof = profiled(spark, sf)
    edges = (pg.page_links(prof, "page_id", "full_url").join(prof.select("page_id", "full_url"), "page_id")
             .select(F.col("full_url").alias("src"), F.col("link").alias("dst")))
    nodes = prof.select(F.col("full_url").alias("node")).unionByName(edges.select(F.col("dst").alias("node")))
    return pagerank(nodes, edges, iterations=ITERATIONS).select("node", F.round("rank", ROUND).alias("rank"))
