"""Registered queries: seed scan and batches, search queries and results, page
scan, entity load, state writes and checks (SURVEY A1-A6, B11, B12, D5, D8,
E1, E2, H1, H3-H8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scoring, urls
from ..operators import state as stt
from ..operators.frontier import one_fetch
from ..sources import search as srch
from ..session import scratch_root
from ..sources.seeds import read_json_lines, seed_batch
from ..sources.snapshots import read_saved_folders, write_saved_pages
from . import inputs
from .q_urls import AS_OF, _FRONTIER_SQL, validated
from .registry import ROUND, register
from .sqltext import d, domain_expr, fetched_ctes, norm_expr, pint, quality_fold_expr, url_parts

RESPONSE_SIZE = 20       # URLs per search response (the reference asks for at most 20)


def _r(c):
    return F.round(c, ROUND)


# ------------------------------------------------------------------ A1

@register("seed_scan", """
SELECT event_id AS pos, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_seed_scan(spark, sf):
    """The events' properties, landed as JSON Lines and read as seed records are."""
    ev = inputs.table(spark, sf, "events", "event_id", "props")
    path = f"{scratch_root(spark, 'seed-scan')}/seeds"
    line = F.concat(F.lit('{"pos": '), F.col("event_id").cast("string"), F.lit(', "item": '), F.col("props"), F.lit("}"))
    ev.select(line.alias("value")).write.text(path)
    return read_json_lines(spark, path, "pos long, item struct<k: int>").select("pos", F.col("item.k").alias("k"))


# ------------------------------------------------------------------ A7

@register("saved_pages", """
SELECT url, md5(html) AS html_md5, length(html) AS n_chars FROM pages""")
def q_saved_pages(spark, sf):
    """Every page, landed as one JSON document a file and read back."""
    root = scratch_root(spark, "saved-pages")
    write_saved_pages(inputs.table(spark, sf, "pages", "url", "html"), f"{root}/pages")
    return read_saved_folders(spark, f"{root}/pages", f"{root}/profile", lambda p: p.select(
        "url", F.md5(F.col("html").cast("binary")).alias("html_md5"), F.length("html").cast("long").alias("n_chars")))


# ------------------------------------------------------------------ A2, A3, B11

def seeds(spark, sf):
    c = inputs.table(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey")
    n = inputs.table(spark, sf, "nation", "n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("pos"), F.col("c_name").alias("name"), F.col("n_name").alias("location"))


_SEEDS_SQL = "seeds AS (SELECT c_custkey AS pos, c_name AS name, n_name AS location FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"


@register("seed_batch", f"""
WITH {_SEEDS_SQL}
SELECT pos, name, location, true AS initial_search FROM seeds WHERE pos >= 5 AND pos < 15""")
def q_seed_batch(spark, sf):
    return seed_batch(seeds(spark, sf), last_index=5, batch_size=10).select("pos", "name", "location", "initial_search")


@register("search_queries", f"""
WITH {_SEEDS_SQL}
SELECT pos, 1 AS query_idx, concat_ws(' ', trim(name), trim(location), 'restaurant review') AS query FROM seeds
UNION ALL
SELECT pos, 2, 'review "' || trim(name) || '" ' || trim(location) FROM seeds""")
def q_search_queries(spark, sf):
    return srch.search_queries(seeds(spark, sf))


# ------------------------------------------------------------------ A5, B12, E1, E2

def responses(spark, sf):
    """Search responses landed as JSON text, built from the pages table: response
    r = page_id div 20 holds those URLs, r belongs to seed r div 2 as query
    r mod 2 + 1. Every seventh response comes once more without the ``web`` key."""
    p = inputs.table(spark, sf, "pages", "page_id", "url").withColumn("r", F.floor(F.col("page_id") / RESPONSE_SIZE))
    grouped = p.groupBy("r").agg(F.collect_list(F.struct("url")).alias("results"))   # <= 20 per group
    full = grouped.withColumn("body", F.to_json(F.struct(F.struct("results").alias("web"))))
    bare = grouped.where(F.col("r") % 7 == 3).withColumn("body", F.lit("{}"))
    return full.unionByName(bare).select((F.floor(F.col("r") / 2)).alias("pos"), (F.col("r") % 2 + 1).alias("query_idx"),
                                         "body")


_HITS_SQL = f"""hits AS (SELECT CAST(floor(floor(page_id / {RESPONSE_SIZE}) / 2) AS BIGINT) AS pos,
                     CAST(floor(page_id / {RESPONSE_SIZE}) % 2 + 1 AS BIGINT) AS query_idx, url
              FROM pages)"""


@register("hits_per_query", f"""
WITH {_HITS_SQL}
SELECT pos, query_idx, count(*) AS n_urls FROM hits GROUP BY pos, query_idx""")
def q_hits_per_query(spark, sf):
    return srch.hits_per_query(srch.result_urls(responses(spark, sf)))


@register("search_hits", f"""
WITH {_HITS_SQL}
SELECT DISTINCT pos, url, CASE WHEN pos % 2 = 0 THEN {d(1)} ELSE {d(0.99)} END AS relevance FROM hits""")
def q_search_hits(spark, sf):
    hits = srch.result_urls(responses(spark, sf))
    sd = hits.select("pos").distinct().withColumn("initial_search", F.col("pos") % 2 == 0)
    return srch.seed_hits(hits, sd)


# ------------------------------------------------------------------ A6

@register("page_scan", f"""
WITH {fetched_ctes()}
SELECT full_url, page_id, status, parent_priority FROM fetched""")
def q_page_scan(spark, sf):
    one = one_fetch(inputs.fetched_pages(spark, sf, with_html=False), "page_id")
    return one.select("full_url", "page_id", "status", inputs.parent_priority("page_id").alias("parent_priority"))


# ------------------------------------------------------------------ A4, H1

def _customer_entities(spark, sf):
    return inputs.gazetteer(spark, sf).select("name", "address").unionByName(
        seeds(spark, sf).where(F.col("pos") % 2 == 1).select("name", F.col("location").alias("address")))


@register("gazetteer_load", f"""
WITH {_SEEDS_SQL}
SELECT row_number() OVER (ORDER BY name, location) AS entity_id, name, location AS address
FROM (SELECT DISTINCT name, location FROM seeds)""")
def q_gazetteer_load(spark, sf):
    empty = stt.empty_table(spark, "entity")
    table, _ = stt.insert_if_absent(empty, _customer_entities(spark, sf), ["name", "address"], "entity_id")
    return table


@register("insert_if_absent", f"""
WITH {_SEEDS_SQL},
old AS (SELECT pos AS entity_id, name, location AS address FROM seeds WHERE pos % 2 = 0),
new AS (SELECT DISTINCT name, location AS address FROM seeds s
        WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.name = s.name AND o.address = s.location))
SELECT entity_id, name, address FROM old
UNION ALL
SELECT (SELECT max(entity_id) FROM old) + row_number() OVER (ORDER BY name, address), name, address FROM new""")
def q_insert_if_absent(spark, sf):
    old = inputs.gazetteer(spark, sf).where(F.col("entity_id") % 2 == 0)       # what is there already
    batch = seeds(spark, sf).select("name", F.col("location").alias("address"))
    table, _ = stt.insert_if_absent(old, batch, ["name", "address"], "entity_id")
    return table


# ------------------------------------------------------------------ H3, H4, H5

def _queue(spark, sf):
    p = inputs.table(spark, sf, "pages", "page_id")
    pr = (F.col("page_id") % 101).cast("double")
    return p.select(F.col("page_id").alias("url_id"), pr.alias("priority"), scoring.priority_int(pr).alias("priority_int"))


def _batch(spark, sf):
    p = inputs.table(spark, sf, "pages", "page_id")
    pr = ((F.col("page_id") * 7) % 101).cast("double")
    last = p.select((F.col("page_id") * 2).alias("url_id"), pr.alias("priority"),
                    scoring.priority_int(pr).alias("priority_int"), F.col("page_id").alias("seq"))
    # each key has come before in the same batch, with another priority
    other = ((F.col("page_id") * 3) % 101).cast("double")
    return last.unionByName(p.select((F.col("page_id") * 2).alias("url_id"), other.alias("priority"),
                                     scoring.priority_int(other).alias("priority_int"), (F.col("page_id") - 10**9).alias("seq")))


_QB_SQL = f"""q0 AS (SELECT page_id AS url_id, CAST(page_id % 101 AS DOUBLE) AS priority FROM pages),
b0 AS (SELECT page_id * 2 AS url_id, CAST((page_id * 7) % 101 AS DOUBLE) AS priority, page_id AS seq FROM pages)"""


@register("queue_upsert", f"""
WITH {_QB_SQL}
SELECT url_id, priority, {pint('priority')} AS priority_int FROM q0 WHERE url_id NOT IN (SELECT url_id FROM b0)
UNION ALL
SELECT url_id, arg_max(priority, seq), {pint('arg_max(priority, seq)')} FROM b0 GROUP BY url_id""")
def q_queue_upsert(spark, sf):
    return stt.queue_upsert(_queue(spark, sf), _batch(spark, sf), "url_id", "seq")


@register("queue_update", f"""
WITH {_QB_SQL}
SELECT q0.url_id, coalesce(b0.priority, q0.priority) AS priority, {pint('coalesce(b0.priority, q0.priority)')} AS priority_int
FROM q0 LEFT JOIN b0 USING (url_id)""")
def q_queue_update(spark, sf):
    return stt.queue_update(_queue(spark, sf), _batch(spark, sf), "url_id", "seq")


@register("queue_remove", f"""
WITH {_QB_SQL}
SELECT url_id, priority, {pint('priority')} AS priority_int FROM q0 WHERE url_id NOT IN (SELECT url_id FROM b0)""")
def q_queue_remove(spark, sf):
    return stt.queue_remove(_queue(spark, sf), _batch(spark, sf), "url_id")


# ------------------------------------------------------------------ H6

@register("touch_urls", f"""
WITH {fetched_ctes()},
seen AS (SELECT DISTINCT {norm_expr()} AS full_url FROM ({url_parts('pages', 'url')}) WHERE page_id % 2 = 0)
SELECT f.full_url, CASE WHEN s.full_url IS NOT NULL THEN strftime(TIMESTAMP '{AS_OF}', '%Y-%m-%d %H:%M:%S') END AS last_crawled
FROM fetched f LEFT JOIN seen s USING (full_url)""")
def q_touch_urls(spark, sf):
    f = one_fetch(inputs.fetched_pages(spark, sf, with_html=False), "page_id")
    url = f.select(F.col("page_id").alias("url_id"), F.lit(None).cast("long").alias("source_id"), "full_url",
                   F.lit(None).cast("timestamp").alias("first_seen"), F.lit(None).cast("timestamp").alias("last_crawled"))
    p = inputs.table(spark, sf, "pages", "page_id", "url")
    seen = p.where(F.col("page_id") % 2 == 0).select(urls.normalize_url("url").alias("full_url"))
    out = stt.touch_urls(url, seen, AS_OF)
    return out.select("full_url", F.date_format("last_crawled", "yyyy-MM-dd HH:mm:ss").alias("last_crawled"))


# ------------------------------------------------------------------ D5, H7

_DOMAIN_IDS_SQL = """dids AS (SELECT domain, row_number() OVER (ORDER BY min(seq)) AS domain_id FROM ev GROUP BY domain)"""


@register("domain_lookup", f"""
WITH {_FRONTIER_SQL}, {_DOMAIN_IDS_SQL},
dq AS (SELECT domain, round({quality_fold_expr('list(relevance ORDER BY seq)', scoring.QUALITY_STEP)}, 9) AS quality_score
       FROM ev GROUP BY domain)
SELECT f.full_url, dd.domain AS domain_name, dd.domain_id, dd.domain_id AS source_id, dq.quality_score
FROM frontier f JOIN firsts fi ON fi.norm_url = f.full_url JOIN dids dd ON dd.domain = fi.domain JOIN dq ON dq.domain = fi.domain""")
def q_domain_lookup(spark, sf):
    st, _ = validated(spark, sf)
    return (st.url.select("full_url", "source_id").join(st.source.select("source_id", "domain_id"), "source_id")
            .join(st.domain.select("domain_id", "domain_name", "quality_score"), "domain_id")
            .select("full_url", "domain_name", "domain_id", "source_id", _r(F.col("quality_score")).alias("quality_score")))


# ------------------------------------------------------------------ D8

@register("cascade_delete", f"""
WITH {_FRONTIER_SQL}, {_DOMAIN_IDS_SQL},
kept AS (SELECT domain, domain_id FROM dids WHERE domain NOT LIKE 'blog.%'),
u AS (SELECT f.url_id, f.full_url, k.domain_id FROM frontier f JOIN firsts fi ON fi.norm_url = f.full_url JOIN kept k ON k.domain = fi.domain),
r AS (SELECT c.c_custkey AS entity_id, f.url_id FROM customer c JOIN frontier f ON f.url_id = c.c_custkey % 40 + 1)
SELECT 'domain' AS tbl, domain_id AS a, domain AS b FROM kept
UNION ALL SELECT 'source', domain_id, CAST(domain_id AS VARCHAR) FROM kept
UNION ALL SELECT 'url', url_id, full_url FROM u
UNION ALL SELECT 'url_queue', url_id, NULL FROM u
UNION ALL SELECT 'entity', c_custkey, c_name FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT 'reference', r.entity_id, CAST(r.url_id AS VARCHAR) FROM r JOIN u USING (url_id) WHERE r.entity_id % 3 <> 0""")
def q_cascade_delete(spark, sf):
    """The keys that are left in all six tables after deleting domains and entities."""
    st, _ = validated(spark, sf)
    c = inputs.table(spark, sf, "customer", "c_custkey", "c_name")
    key = F.col("c_custkey")
    st = st.with_(
        entity=c.select(key.alias("entity_id"), F.col("c_name").alias("name"), F.lit(None).cast("string").alias("address")),
        reference=c.select(key.alias("entity_id"), (key % 40 + 1).alias("url_id"), F.lit(0.5).alias("relevance"),
                           F.lit(AS_OF).cast("timestamp").alias("discovered_at"))
        .join(st.url.select("url_id"), "url_id", "left_semi"))
    after = stt.cascade_delete(st, domains=st.domain.where(F.col("domain_name").startswith("blog.")).select("domain_name"),
                               entities=st.entity.where("entity_id % 3 = 0").select("entity_id"))
    parts = [("domain", after.domain, "domain_id", "domain_name"), ("source", after.source, "domain_id", "domain_id"),
             ("url", after.url, "url_id", "full_url"), ("url_queue", after.url_queue, "url_id", None),
             ("entity", after.entity, "entity_id", "name"), ("reference", after.reference, "entity_id", "url_id")]
    out = None
    for name, df, a, b in parts:
        rows = df.select(F.lit(name).alias("tbl"), F.col(a).cast("long").alias("a"),
                         (F.col(b) if b else F.lit(None)).cast("string").alias("b"))
        out = rows if out is None else out.unionByName(rows)
    return out


# ------------------------------------------------------------------ H8

# Tables with planted violations: keys taken modulo, so that names repeat, and
# values that leave their range for some keys.
_PLANTED_SQL = """dom AS (SELECT page_id AS domain_id, CASE WHEN page_id % 13 <> 0 THEN 'd' || (page_id % 50) END AS domain_name,
                 (page_id % 31 - 15) / 12.0 AS quality_score FROM pages),
src AS (SELECT page_id AS source_id, page_id % 40 AS domain_id, CASE WHEN page_id % 9 <> 0 THEN 't' || (page_id % 2) END AS source_type FROM pages),
ent AS (SELECT c_custkey AS entity_id, CASE WHEN c_custkey % 17 <> 0 THEN 'n' || (c_custkey % 60) END AS name,
               CASE WHEN c_custkey % 5 <> 0 THEN 'a' || (c_custkey % 3) END AS address FROM customer),
u AS (SELECT page_id AS url_id, CASE WHEN page_id % 11 <> 0 THEN url END AS full_url FROM pages
      UNION ALL SELECT page_id, url FROM pages WHERE page_id % 4 = 0),
ref AS (SELECT c_custkey AS entity_id, (c_custkey % 23 - 4) / 15.0 AS relevance FROM customer),
uq AS (SELECT CASE WHEN page_id % 19 <> 0 THEN page_id % 70 END AS url_id, page_id % 120 - 10 AS priority_int FROM pages),
eq AS (SELECT CASE WHEN c_custkey % 29 <> 0 THEN 'n' || (c_custkey % 80) END AS name, c_custkey % 110 - 4 AS priority_int FROM customer)"""


def _planted(spark, sf):
    p = inputs.table(spark, sf, "pages", "page_id", "url")
    c = inputs.table(spark, sf, "customer", "c_custkey")
    k, e = F.col("page_id"), F.col("c_custkey")

    def named(prefix, key, n):
        return F.concat(F.lit(prefix), (key % n).cast("string"))

    st = stt.empty_state(spark)
    return st.with_(
        domain=p.select(k.alias("domain_id"), F.when(k % 13 != 0, named("d", k, 50)).alias("domain_name"),
                        F.lit(0).cast("long").alias("visit_count"), ((k % 31 - 15) / 12.0).alias("quality_score")),
        source=p.select(k.alias("source_id"), (k % 40).alias("domain_id"), F.when(k % 9 != 0, named("t", k, 2)).alias("source_type")),
        entity=c.select(e.alias("entity_id"), F.when(e % 17 != 0, named("n", e, 60)).alias("name"),
                        F.when(e % 5 != 0, named("a", e, 3)).alias("address")),
        url=p.select(k.alias("url_id"), F.when(k % 11 != 0, F.col("url")).alias("full_url")).unionByName(
            p.where(k % 4 == 0).select(k.alias("url_id"), F.col("url").alias("full_url"))),
        reference=c.select(e.alias("entity_id"), ((e % 23 - 4) / 15.0).alias("relevance")),
        url_queue=p.select(F.when(k % 19 != 0, k % 70).alias("url_id"), (k % 120 - 10).alias("priority_int")),
        entity_queue=c.select(F.when(e % 29 != 0, named("n", e, 80)).alias("name"), (e % 110 - 4).alias("priority_int")))


def _dup_sql(rule: str, table: str, *keys: str) -> str:
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (f"SELECT '{rule}' AS rule, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations "
            f"FROM (SELECT count(*) AS n FROM {table} WHERE {known} GROUP BY {', '.join(keys)})")


def _count_sql(rule: str, table: str, broken: str) -> str:
    return f"SELECT '{rule}' AS rule, count(*) AS violations FROM {table} WHERE {broken}"


_RULES_SQL = " UNION ALL ".join([
    _count_sql("domain.quality_range", "dom", "quality_score < -1 OR quality_score > 1"),
    _count_sql("domain.name_not_null", "dom", "domain_name IS NULL"), _dup_sql("domain.name_unique", "dom", "domain_name"),
    _count_sql("source.type_not_null", "src", "source_type IS NULL"),
    _dup_sql("source.domain_type_unique", "src", "domain_id", "source_type"),
    _count_sql("entity.name_not_null", "ent", "name IS NULL"), _dup_sql("entity.name_address_unique", "ent", "name", "address"),
    _count_sql("url.full_url_not_null", "u", "full_url IS NULL"), _dup_sql("url.full_url_unique", "u", "full_url"),
    _count_sql("reference.relevance_range", "ref", "relevance < 0 OR relevance > 1"),
    _count_sql("url_queue.priority_range", "uq", "priority_int < 0 OR priority_int > 100"),
    _dup_sql("url_queue.url_id_unique", "uq", "url_id"), _count_sql("url_queue.url_id_not_null", "uq", "url_id IS NULL"),
    _count_sql("entity_queue.priority_range", "eq", "priority_int < 0 OR priority_int > 100"),
    _dup_sql("entity_queue.name_unique", "eq", "name"), _count_sql("entity_queue.name_not_null", "eq", "name IS NULL")])


@register("constraint_report", f"WITH {_PLANTED_SQL} {_RULES_SQL}")
def q_constraint_report(spark, sf):
    return stt.constraint_report(_planted(spark, sf))
