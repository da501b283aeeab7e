"""URL frontier: the validate step as a batch job (D4, E3, E4, H1, H3, H6),
status routing of fetched pages (C2, B15), and priority order (F1, F4).

A batch of discovered URLs is (seq long, url string, relevance double); ``seq``
is the total order the fold and the first-sighting rules depend on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scoring, urls
from ..session import cut_lineage
from .quality import quality_fold
from .state import GraphState, assign_dense_ids, merged, next_id, touch_urls

SOURCE_TYPE = "webpage"


def discovered_events(discovered: DataFrame) -> DataFrame:
    """B1 + B2 on a discovered batch: adds norm_url and domain."""
    return discovered.select(
        F.col("seq").cast("long").alias("seq"),
        "url",
        F.col("relevance").cast("double").alias("relevance"),
    ).withColumn("norm_url", urls.normalize_url("url")).withColumn("domain", urls.url_domain("norm_url"))


def frontier_scores(events: DataFrame) -> DataFrame:
    """B6-B8 on (norm_url, relevance)."""
    return (
        events.withColumn("trust", urls.url_trust("norm_url"))
        .withColumn("priority", scoring.frontier_priority("relevance", "trust"))
        .withColumn("priority_int", scoring.priority_int("priority"))
    )


def first_sightings(events: DataFrame) -> DataFrame:
    """E1-style dedupe: the first event (min seq) of each normalized URL."""
    return events.groupBy("norm_url").agg(
        F.min("seq").alias("first_seq"),
        F.min_by(F.struct("relevance", "domain", "url"), F.col("seq")).alias("_f"),
        F.count(F.lit(1)).alias("sightings"),
    ).select("norm_url", "first_seq", "sightings", "_f.*")


def split_new_seen(firsts: DataFrame, url_table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """left_anti / left_semi of batch URLs against the url table."""
    known = url_table.select(F.col("full_url").alias("norm_url"))
    return firsts.join(known, "norm_url", "left_anti"), firsts.join(known, "norm_url", "left_semi")


def validate_changes(discovered: DataFrame, state: GraphState, as_of: str, quality_kwargs: dict | None = None,
                     quality: DataFrame | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """One validate pass over a discovered batch: the rows of each table that it writes, new or in
    place of the row with their id, and the new frontier rows (url_id, full_url, priority,
    priority_int). ``quality`` (domain, visit_count, quality_score), if given, is the fold of the
    batch's domains, made elsewhere."""
    ev = discovered_events(discovered)

    # domains: visits and ordered quality fold, new ones get ids by first sighting
    dstate = state.domain.select(F.col("domain_name").alias("domain"), "visit_count", "quality_score")
    # the batch is read twice, for the fold and for the first sightings; all four tables follow from these two
    if quality is None:
        folded = quality_fold(ev.select("domain", "seq", "relevance"), dstate, **(quality_kwargs or {}))
    else:
        known = dstate.select("domain", F.lit(False).alias("_new"))
        folded = quality.join(known, "domain", "left").withColumn("is_new", F.coalesce("_new", F.lit(True)))
    folded = cut_lineage(folded)
    firsts = cut_lineage(frontier_scores(first_sightings(ev)))
    dom_first = firsts.groupBy("domain").agg(F.min("first_seq").alias("first_seq"))
    new_dom = folded.where("is_new").join(dom_first, "domain").select(
        F.col("domain").alias("domain_name"), "visit_count", "quality_score", "first_seq")
    new_dom = assign_dense_ids(new_dom, ["first_seq"], "domain_id", next_id(state.domain, "domain_id"))
    upd = folded.where(~F.col("is_new")).select(F.col("domain").alias("domain_name"), "visit_count", "quality_score")
    domains = (state.domain.select("domain_id", "domain_name").join(upd, "domain_name")
               .select("domain_id", "domain_name", "visit_count", "quality_score")
               .unionByName(new_dom.select("domain_id", "domain_name", "visit_count", "quality_score")))

    # sources: a 'webpage' source for every touched domain that has none
    touched = domains.join(dom_first.withColumnRenamed("domain", "domain_name"), "domain_name")
    need_src = touched.join(state.source.select("domain_id"), "domain_id", "left_anti").select(
        "domain_id", F.lit(SOURCE_TYPE).alias("source_type"), "first_seq")
    sources = assign_dense_ids(need_src, ["first_seq"], "source_id", next_id(state.source, "source_id")).select(
        "source_id", "domain_id", "source_type")

    # urls: first sighting decides insert vs touch; priority from its relevance
    new_u, seen_u = split_new_seen(firsts, state.url)
    src_by_domain = state.source.unionByName(sources).groupBy("domain_id").agg(F.min("source_id").alias("source_id")) \
        .join(domains.select("domain_id", F.col("domain_name").alias("domain")), "domain_id")
    # one row per domain, itself a shuffle output: AQE broadcasts it from its
    # measured size, else splits the partition of a domain owning many new URLs
    new_u = new_u.join(src_by_domain.select("domain", "source_id"), "domain", "left")
    new_u = assign_dense_ids(new_u, ["first_seq"], "url_id", next_id(state.url, "url_id"))
    ts = F.lit(as_of).cast("timestamp")
    seen = seen_u.select(F.col("norm_url").alias("full_url"))
    again = touch_urls(state.url.join(seen, "full_url", "left_semi"), seen, as_of)
    found = new_u.select("url_id", "source_id", F.col("norm_url").alias("full_url"),
                         ts.alias("first_seen"), ts.alias("last_crawled"))
    queued = new_u.select("url_id", F.col("norm_url").alias("full_url"), "priority", "priority_int")
    return {"domain": domains, "source": sources, "url": again.unionByName(found),
            "url_queue": queued.select("url_id", "priority", "priority_int")}, queued


def validate_batch(discovered: DataFrame, state: GraphState, as_of: str,
                   quality_kwargs: dict | None = None) -> tuple[GraphState, DataFrame]:
    """One validate pass over a discovered batch.

    Returns (next state, new frontier rows (url_id, full_url, priority, priority_int))."""
    changes, queued = validate_changes(discovered, state, as_of, quality_kwargs)
    return merged(state, changes), queued


# ---------------------------------------------------------------- C2 / B15

def status_action(status) -> Column:
    """No response or any 4xx -> remove; 500/502/503/504 -> demote; else parse."""
    s = F.col(status) if isinstance(status, str) else status
    return (
        F.when(s.isNull(), F.lit("remove"))
        .when((s >= 400) & (s < 500), F.lit("remove"))
        .when(s.isin(scoring.RETRY_STATUSES), F.lit("demote"))
        .otherwise(F.lit("parse"))
    )


def one_fetch(fetched: DataFrame, order_col: str) -> DataFrame:
    """(full_url, status, order_col): of repeated fetches of a URL the first by
    ``order_col``. Only these three columns are read, never the page itself."""
    return (fetched.groupBy("full_url").agg(F.min_by(F.struct("status", order_col), F.col(order_col)).alias("_f"))
            .select("full_url", "_f.*"))


def route_fetched(frontier: DataFrame, fetched: DataFrame, order_col: str) -> DataFrame:
    """Attach each frontier URL's fetch result and action.

    ``frontier``: (url_id, full_url, priority_int); ``fetched``: (full_url, status,
    ``order_col``), any number of rows a URL. A frontier URL without a fetch row
    counts as no response."""
    return frontier.join(one_fetch(fetched, order_col), "full_url", "left").withColumn("action", status_action("status")).withColumn(
        "new_priority", F.when(F.col("action") == "demote", scoring.decayed_priority("priority_int")))


# ---------------------------------------------------------------- F1 / F4

def priority_order() -> list[Column]:
    """Stored integer priority first (as the queue column holds it), then the
    exact priority, then url_id for a deterministic tie-break."""
    return [F.col("priority_int").desc(), F.col("priority").desc(), F.col("url_id").asc()]


def frontier_head(url_queue: DataFrame, url_table: DataFrame, n: int = 1) -> DataFrame:
    """the n highest-priority URLs (batch pop; TakeOrderedAndProject)."""
    return (url_queue.join(url_table.select("url_id", "full_url"), "url_id")
            .orderBy(*priority_order()).limit(n)
            .select("url_id", "full_url", "priority", "priority_int"))


def entity_queue_head(entity_queue: DataFrame, n: int = 1) -> DataFrame:
    """the n highest-priority names, ties by name."""
    return (entity_queue.orderBy(F.col("priority_int").desc(), F.col("priority").desc(), F.col("name").asc()).limit(n)
            .select("name", "priority", "priority_int"))


def frontier_rank(url_queue: DataFrame, url_table: DataFrame) -> DataFrame:
    """whole-frontier drain order as a dense 1-based rank (range-partitioned,
    no single-partition window)."""
    j = url_queue.join(url_table.select("url_id", "full_url"), "url_id")
    return assign_dense_ids(j, priority_order(), "drain_rank", 1)
