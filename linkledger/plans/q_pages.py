"""Registered queries: page profile and links, mention spotting, trigram
similarity, resolution, page relevance and derived links (SURVEY B4, B5, B9,
B10, B17, B18, C1, C3, D1-D3, E7, G1-G3, J1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import trigram, urls
from ..operators import pages as pg
from ..operators.html_profile import profile_pages
from ..operators.mentions import PHRASE, spot_capitalised, spot_gazetteer
from ..operators.resolve import exact_match, page_mentions, resolve_mentions
from ..operators.similarity import fuzzy_best_match, nearest_match, register_fuzzy_search
from ..session import cut_lineage
from . import inputs
from .registry import ROUND, register
from .sqltext import (d, derived_priority_expr, names_ctes, page_ctes, relevance_expr, sim, trigrams, url_parts,
                      vocab_ents_ctes)


def _r(c):
    return F.round(c, ROUND)


# ------------------------------------------------------------------ shared Spark inputs

def profiled(spark, sf):
    """Profile of every page, keyed by page_id, with its normalized URL as base.
    Checkpointed (reliably) because several branches of a plan read it and the
    HTML parse is the one Python stage."""
    p = inputs.table(spark, sf, "pages", "page_id", "url", "html")
    prof = profile_pages(p, ["page_id", "url"]).withColumn("full_url", urls.normalize_url("url"))
    return cut_lineage(prof.repartition("page_id"))      # profiles are spread, html is not


def title_vocabulary(prof):
    return prof.select(F.col("title").alias("name")).where(F.col("name").isNotNull()).distinct()


def title_entities(prof):
    """Entity table for the page flows: all titles, the lowest page id of each as its id; by that
    id % 3 the name is the title, the title and more, or the title backwards."""
    of = (prof.where(F.col("title").isNotNull()).groupBy("title").agg(F.min("page_id").alias("entity_id")))
    kind = F.col("entity_id") % 3
    name = F.when(kind == 0, F.col("title")).when(kind == 1, F.concat("title", F.lit(" x"))).otherwise(F.reverse("title"))
    return of.select("entity_id", name.alias("name"), F.lit(None).cast("string").alias("address"))


def page_names(spark, sf, prof=None):
    """(page_id, names, rejected) from spotting + resolution."""
    prof = profiled(spark, sf) if prof is None else prof
    spotted = cut_lineage(spot_gazetteer(prof.select("page_id", "text"), title_vocabulary(prof), "page_id"))
    resolved = resolve_mentions(spotted.select("mention"), title_entities(prof))
    return page_mentions(spotted, resolved, "page_id")


def page_inputs(spark, sf, prof):
    """Meaningful pages with parent priority and validated names (empty if none)."""
    names = page_names(spark, sf, prof).select("page_id", "names")
    return (pg.meaningful(prof).select("page_id", "full_url")
            .join(names, "page_id", "left")
            .select("page_id", "full_url", inputs.parent_priority("page_id").alias("parent_priority"),
                    F.coalesce("names", F.array().cast("array<string>")).alias("names")))


# ------------------------------------------------------------------ shared SQL chains

_PROF = page_ctes("pages")

_NAMES_SQL = f"""{_PROF},
{vocab_ents_ctes()},
{names_ctes('prof')}"""

_BASE_SQL = f"""base0 AS ({url_parts('prof', 'url', 'page_id, has_body, text_concat_len, hrefs')}),
base AS (SELECT page_id, has_body, text_concat_len, hrefs, _s || '://' || _n || _p AS full_url FROM base0),
base1 AS ({url_parts('base', 'full_url')})"""


def _link_sql(h: str) -> str:
    """SQL form of the JVM fast path of B5 (the test hrefs are all root-relative)."""
    return (f"CASE WHEN {h} = '' THEN full_url WHEN _s IN ('http', 'https') AND _n <> '' "
            f"AND regexp_matches({h}, '^/[^/;\\s]') THEN _s || '://' || _n || {h} END")


# ------------------------------------------------------------------ B18, C1

#: A page of fewer than ten characters.
TINY = "<html><body><p> a few </p><b> !</b></body></html>"


@register("page_profile", f"""
WITH {_PROF}
SELECT page_id, has_body, text, CAST(text_concat_len AS INTEGER) AS text_concat_len, title,
       len(headers) AS n_headers, list_sort(headers) AS header_texts, len(hrefs) AS n_section_links,
       list_sort(hrefs) AS section_hrefs FROM prof""")
def q_page_profile(spark, sf):
    prof = profiled(spark, sf)
    return prof.select("page_id", "has_body", "text", "text_concat_len", "title",
                       F.size("headers").alias("n_headers"),
                       F.array_sort(F.transform("headers", lambda h: h["text"])).alias("header_texts"),
                       F.size(F.filter("links", lambda l: l["section"].isNotNull())).alias("n_section_links"),
                       F.array_sort(F.transform(F.filter("links", lambda l: l["section"].isNotNull()),
                                                lambda l: l["href"])).alias("section_hrefs"))


@register("meaningful_pages", f"""
WITH kinds AS (SELECT page_id, url, CASE page_id % 5 WHEN 0 THEN replace(html, '<body', '<section') WHEN 1 THEN '{TINY}' ELSE html END AS html
               FROM pages),
{page_ctes("kinds")}
SELECT page_id FROM prof WHERE has_body AND text_concat_len >= 10""")
def q_meaningful_pages(spark, sf):
    """All pages; every fifth has lost its body, and another fifth its text."""
    kind = F.col("page_id") % 5
    html = F.when(kind == 0, F.replace("html", F.lit("<body"), F.lit("<section"))).when(kind == 1, F.lit(TINY)).otherwise(F.col("html"))
    p = inputs.table(spark, sf, "pages", "page_id", "html").withColumn("html", html)
    return pg.meaningful(profile_pages(p, ["page_id"])).select("page_id")


# ------------------------------------------------------------------ C3, B5, G1

@register("page_links", f"""
WITH {_PROF}, {_BASE_SQL}
SELECT DISTINCT page_id, link FROM (SELECT page_id, {_link_sql('h')} AS link FROM base1, unnest(hrefs) AS t(h))
WHERE link LIKE 'http%'""")
def q_page_links(spark, sf):
    return pg.page_links(profiled(spark, sf), "page_id", "full_url")


@register("resolve_links", f"""
WITH {_PROF}, {_BASE_SQL}
SELECT page_id, h AS href, {_link_sql('h')} AS link FROM base1, unnest(hrefs) AS t(h)""")
def q_resolve_links(spark, sf):
    prof = profiled(spark, sf)
    return (prof.select("page_id", "full_url", F.explode("links").alias("l"))
            .where(F.col("l.section").isNotNull())
            .select("page_id", F.col("l.href").alias("href"), pg.resolve_link("full_url", F.col("l.href")).alias("link")))


# Each form against each page URL. _s, _n, _p: scheme, host and path of the page;
# its folder is the path up to the last slash, and the folder above it.
_FOLDER = "regexp_replace(_p, '[^/]*$', '')"
LINK_FORMS = [
    ("https://other.example.org/a/../b?q=1", "'https://other.example.org/a/../b?q=1'"),
    ("//cdn.example.org/x", "_s || '://cdn.example.org/x'"), ("/top/./a/../b", "_s || '://' || _n || '/top/b'"),
    ("next.html", f"_s || '://' || _n || {_FOLDER} || 'next.html'"),
    ("../up", f"_s || '://' || _n || regexp_replace({_FOLDER}, '[^/]+/$', '') || 'up'"),
    ("./", f"_s || '://' || _n || {_FOLDER}"), ("?page=2", "full_url || '?page=2'"), ("#end", "full_url || '#end'"),
    ("", "full_url"), ("http://[bad/", "NULL"), ("//]bad/x", "NULL"), ("mailto:a@b.example", "'mailto:a@b.example'"),
    (" /blank\t ", "_s || '://' || _n || '/blank '")]
_FORMS_SQL = " UNION ALL ".join(f"SELECT page_id, {k} AS form, {e} AS link FROM base1" for k, (_, e) in enumerate(LINK_FORMS))


@register("resolve_link_forms", f"""
WITH {_PROF}, {_BASE_SQL}
{_FORMS_SQL}""")
def q_resolve_link_forms(spark, sf):
    p = inputs.table(spark, sf, "pages", "page_id", "url").withColumn("full_url", urls.normalize_url("url"))
    forms = F.array(*(F.lit(h) for h, _ in LINK_FORMS))
    return (p.select("page_id", "full_url", F.posexplode(forms).alias("form", "href"))
            .select("page_id", "form", pg.resolve_link("full_url", "href").alias("link")))


# ------------------------------------------------------------------ J1

@register("capitalised_mentions", f"""
WITH {_PROF}
SELECT DISTINCT page_id, mention FROM (
  SELECT page_id, unnest(regexp_extract_all(text, '{PHRASE.replace("'", "''")}')) AS mention FROM prof)
WHERE len(string_split(mention, ' ')) >= 2""")
def q_capitalised_mentions(spark, sf):
    return spot_capitalised(profiled(spark, sf).select("page_id", "text"), "page_id")


@register("spot_mentions", f"""
WITH {_NAMES_SQL}
SELECT page_id, mention FROM spotted""")
def q_spot_mentions(spark, sf):
    prof = profiled(spark, sf)
    return spot_gazetteer(prof.select("page_id", "text"), title_vocabulary(prof), "page_id")


# ------------------------------------------------------------------ B17

@register("trigram_similarity", f"""
SELECT p_partkey, p_name, p_type, round({sim(trigrams('p_name'), trigrams('p_type'))}, 9) AS similarity FROM part""")
def q_trigram_similarity(spark, sf):
    p = inputs.table(spark, sf, "part", "p_partkey", "p_name", "p_type")
    return p.select("p_partkey", "p_name", "p_type", _r(trigram.similarity("p_name", "p_type")).alias("similarity"))


# ------------------------------------------------------------------ D1, D2, D3

_CUST_SQL = f"""gz AS (SELECT c_custkey AS entity_id, c_name AS name, n_name AS address
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
mall AS (SELECT DISTINCT mention FROM (
           SELECT CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN left(c_name, length(c_name) - 1)
                  ELSE replace(c_name, 'Customer', 'Custmoer') END AS mention FROM customer
           UNION ALL SELECT p_name FROM part)),
pairs AS (SELECT mention, entity_id, name, address, {sim('mt', 'gt')} AS c
          FROM (SELECT mention, {trigrams('mention')} AS mt FROM mall), (SELECT *, {trigrams('name')} AS gt FROM gz))"""

_FUZZY_SQL = f"""{_CUST_SQL},
best AS (SELECT mention, arg_max(entity_id, (c, -entity_id)) AS entity_id, arg_max(name, (c, -entity_id)) AS matched_name,
                max(c) AS confidence FROM pairs WHERE c > {d(0.75)} GROUP BY mention)"""


@register("exact_resolve", f"""
WITH {_CUST_SQL},
allm AS (SELECT DISTINCT mention FROM (SELECT mention FROM mall UNION ALL SELECT name FROM gz))
SELECT a.mention, min(g.entity_id) AS entity_id
FROM allm a LEFT JOIN (SELECT entity_id, name FROM gz UNION ALL SELECT 1000000 - entity_id, name FROM gz WHERE entity_id % 3 = 0
                       UNION ALL SELECT -entity_id, name FROM gz WHERE entity_id % 5 = 0) g ON g.name = a.mention
GROUP BY a.mention""")
def q_exact_resolve(spark, sf):
    m = inputs.mentions(spark, sf).unionByName(inputs.gazetteer(spark, sf).select(F.col("name").alias("mention")))
    gz = inputs.gazetteer(spark, sf)
    key = F.col("entity_id")
    twice = gz.where(key % 3 == 0).withColumn("entity_id", 1_000_000 - key)      # a repeat with a higher id
    below = gz.where(key % 5 == 0).withColumn("entity_id", -key)                 # and one with a lower id
    return exact_match(m, gz.unionByName(twice).unionByName(below))


@register("fuzzy_resolve", f"""
WITH {_FUZZY_SQL}
SELECT mention, entity_id, matched_name, round(confidence, 9) AS confidence FROM best""")
def q_fuzzy_resolve(spark, sf):
    out = fuzzy_best_match(inputs.mentions(spark, sf), inputs.gazetteer(spark, sf))
    return out.select("mention", "entity_id", "matched_name", _r(F.col("confidence")).alias("confidence"))


@register("fuzzy_search_sql", f"""
WITH {_FUZZY_SQL}
SELECT mention, entity_id, matched_name, round(confidence, 9) AS confidence,
       round({sim(trigrams('mention'), trigrams('matched_name'))}, 9) AS pair_similarity FROM best""")
def q_fuzzy_search_sql(spark, sf):
    """The search as a user of SQL asks it, over a view, and its function on each pair found."""
    inputs.mentions(spark, sf).createOrReplaceTempView("fuzzy_search_input")
    register_fuzzy_search(spark, inputs.gazetteer(spark, sf))
    return spark.sql("SELECT mention, entity_id, matched_name, round(confidence, 9) AS confidence, "
                     "round(fuzzy_search_similarity(mention, matched_name), 9) AS pair_similarity FROM fuzzy_search_matches")


_NEAREST_SQL = """best AS (SELECT mention, arg_max(entity_id, (c, -entity_id)) AS entity_id, arg_max(name, (c, -entity_id)) AS matched_name,
                max(c) AS confidence FROM pairs WHERE c > 0 GROUP BY mention)"""


@register("nearest_match", f"""
WITH {_CUST_SQL}, {_NEAREST_SQL}
SELECT mention, entity_id, matched_name, round(coalesce(confidence, 0), 9) AS confidence FROM mall LEFT JOIN best USING (mention)""")
def q_nearest_match(spark, sf):
    """The nearest entity of each mention, also below the threshold of acceptance."""
    out = nearest_match(inputs.mentions(spark, sf), inputs.gazetteer(spark, sf))
    return out.select("mention", "entity_id", "matched_name", _r(F.col("confidence")).alias("confidence"))


@register("resolve_mentions", f"""
WITH {_FUZZY_SQL},
near AS (SELECT mention, arg_max(name, (c, -entity_id)) AS name FROM pairs WHERE c > 0 GROUP BY mention),
allm AS (SELECT DISTINCT mention FROM (SELECT mention FROM mall UNION ALL SELECT name FROM gz)),
ex AS (SELECT a.mention, min(g.entity_id) AS entity_id FROM allm a JOIN gz g ON g.name = a.mention GROUP BY a.mention)
SELECT a.mention, coalesce(ex.entity_id, b.entity_id) AS entity_id,
       CASE WHEN ex.entity_id IS NOT NULL THEN a.mention ELSE b.matched_name END AS matched_name,
       round(CASE WHEN ex.entity_id IS NOT NULL THEN {d(1)} ELSE b.confidence END, 9) AS confidence,
       CASE WHEN ex.entity_id IS NOT NULL THEN 'exact' WHEN b.entity_id IS NOT NULL THEN 'fuzzy' ELSE 'none' END AS method,
       coalesce(ex.entity_id, b.entity_id) IS NOT NULL AS accepted,
       CASE WHEN coalesce(ex.entity_id, b.entity_id) IS NULL THEN n.name END AS nearest_name
FROM allm a LEFT JOIN ex USING (mention) LEFT JOIN best b ON b.mention = a.mention AND ex.entity_id IS NULL
LEFT JOIN near n ON n.mention = a.mention""")
def q_resolve_mentions(spark, sf):
    m = inputs.mentions(spark, sf).unionByName(inputs.gazetteer(spark, sf).select(F.col("name").alias("mention")))
    out = resolve_mentions(m, inputs.gazetteer(spark, sf), nearest=True)
    return out.select("mention", "entity_id", "matched_name", _r(F.col("confidence")).alias("confidence"),
                      "method", "accepted", "nearest_name")


# ------------------------------------------------------------------ E7

@register("page_mentions", f"""
WITH {_NAMES_SQL}
SELECT page_id, names, rejected FROM pm""")
def q_page_mentions(spark, sf):
    return page_names(spark, sf)


# ------------------------------------------------------------------ B10

@register("page_relevance", f"""
WITH {_NAMES_SQL},
pin AS (SELECT p.page_id, lower(p.text) AS lt, list_transform(p.headers, lambda h: lower(h)) AS lh,
               CAST(p.page_id % 101 AS INTEGER) AS parent, coalesce(pm.names, []) AS names
        FROM prof p LEFT JOIN pm USING (page_id) WHERE p.has_body AND p.text_concat_len >= 10)
SELECT page_id, round({relevance_expr('lt', 'lh', 'names', 'parent')}, 9) AS relevance FROM pin""")
def q_page_relevance(spark, sf):
    prof = profiled(spark, sf)
    rel = pg.with_relevance(pg.meaningful(prof), page_inputs(spark, sf, prof), "page_id")
    return rel.select("page_id", _r(F.col("relevance")).alias("relevance"))


# ------------------------------------------------------------------ G2, G3, B9

@register("derived_links", f"""
WITH {_NAMES_SQL}, {_BASE_SQL},
links AS (SELECT DISTINCT page_id, link FROM (SELECT page_id, {_link_sql('h')} AS link FROM base1, unnest(hrefs) AS t(h))
          WHERE link LIKE 'http%'),
pin AS (SELECT b.page_id, b._s || '://' || b._n || '/' AS homepage, CAST(b.page_id % 101 AS INTEGER) AS parent,
               coalesce(pm.names, []) AS names
        FROM base1 b LEFT JOIN pm USING (page_id) WHERE b.has_body AND b.text_concat_len >= 10)
SELECT page_id, homepage AS url, round(CAST(least(100, parent) AS DOUBLE), 9) AS priority, true AS is_homepage FROM pin
UNION ALL
SELECT l.page_id, l.link AS url, round({derived_priority_expr('l.link', 'p.names', 'p.parent')}, 9) AS priority, false AS is_homepage
FROM links l JOIN pin p USING (page_id) WHERE l.link <> p.homepage""")
def q_derived_links(spark, sf):
    prof = profiled(spark, sf)
    pin = page_inputs(spark, sf, prof)
    links = pg.page_links(pg.meaningful(prof), "page_id", "full_url")
    out = pg.derived_links(links, pin, "page_id")
    return out.select("page_id", "url", _r(F.col("priority")).alias("priority"), "is_homepage")


@register("derived_priority", f"""
WITH {_NAMES_SQL}, {_BASE_SQL},
links AS (SELECT DISTINCT page_id, link FROM (SELECT page_id, {_link_sql('h')} AS link FROM base1, unnest(hrefs) AS t(h))
          WHERE link LIKE 'http%'),
pin AS (SELECT b.page_id, b._s || '://' || b._n || '/' AS homepage, CAST(b.page_id % 101 AS INTEGER) AS parent,
               coalesce(pm.names, []) AS names
        FROM base1 b LEFT JOIN pm USING (page_id) WHERE b.has_body AND b.text_concat_len >= 10)
SELECT l.page_id, l.link AS url, len(p.names) AS n_names,
       round({derived_priority_expr('l.link', 'p.names', 'p.parent')}, 9) AS priority
FROM links l JOIN pin p USING (page_id) WHERE l.link <> p.homepage""")
def q_derived_priority(spark, sf):
    """B9 alone: the estimated priority of every non-homepage derived link."""
    prof = profiled(spark, sf)
    pin = page_inputs(spark, sf, prof)
    links = pg.page_links(pg.meaningful(prof), "page_id", "full_url")
    out = pg.derived_links(links, pin, "page_id").where(~F.col("is_homepage"))
    return (out.join(pin.select("page_id", F.size("names").alias("n_names")), "page_id")
            .select("page_id", "url", "n_names", _r(F.col("priority")).alias("priority")))
