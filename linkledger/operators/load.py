"""Load stage: D7 reference build, H2 append, H9 rejected-mention queue, G4 feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scoring
from .resolve import entity_by_name
from .state import assign_dense_ids, queue_upsert


def build_references(pages: DataFrame, url_table: DataFrame, entity: DataFrame, as_of: str) -> DataFrame:
    """Page (full_url, relevance, names) -> url by full_url -> entity by name.
    A page whose URL is unknown is skipped whole; an unknown name skips its row.
    Returns (entity_id, url_id, relevance, discovered_at)."""
    pu = pages.select("full_url", "relevance", "names").join(url_table.select("url_id", "full_url"), "full_url")
    named = pu.select("url_id", "relevance", F.explode("names").alias("name"))
    byname = entity_by_name(entity).select("name", "entity_id")   # shuffle output: AQE sizes the join
    return named.join(byname, "name").select(
        "entity_id", "url_id", "relevance", F.lit(as_of).cast("timestamp").alias("discovered_at"))


def append_references(reference: DataFrame, new_rows: DataFrame) -> DataFrame:
    """H2: references always append (a re-crawl adds rows)."""
    return reference.unionByName(new_rows.select(*reference.columns))


def rejected_queue(entity_queue: DataFrame, pages: DataFrame, order_col: str) -> DataFrame:
    """H9: upsert (mention, relevance*100) for every rejected mention; the last
    page in ``order_col`` order wins on a repeated name."""
    rej = pages.select(order_col, "relevance", F.explode("rejected").alias("name"))
    batch = rej.select(
        "name", scoring.rejected_priority("relevance").alias("priority"),
        scoring.priority_int(scoring.rejected_priority("relevance")).alias("priority_int"),
        F.col(order_col).alias("seq"))
    return queue_upsert(entity_queue, batch, "name", "seq")


def rejected_sources(pages: DataFrame) -> DataFrame:
    """H9: (name, source_url, priority) for every rejected mention and page."""
    return pages.select(F.explode("rejected").alias("name"), F.col("full_url").alias("source_url"),
                        scoring.rejected_priority("relevance").alias("priority"))


def feedback(derived: DataFrame, order_cols: list, start_seq: int) -> DataFrame:
    """Derived (url, priority) pairs become the next discovered batch, with
    ``relevance`` = the 0..100 priority, numbered in ``order_cols`` order."""
    fb = derived.select(*[c for c in derived.columns])
    fb = assign_dense_ids(fb, order_cols, "seq", start_seq)
    return fb.select("seq", "url", F.col("priority").alias("relevance"), *[c for c in fb.columns
                                                                        if c not in ("seq", "url", "priority")])
