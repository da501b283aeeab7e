"""Per-domain visit count and order-dependent clamped quality fold.

Each discovered URL of a domain applies ``q -> clamp(q + step*(rel - .5), -1, 1)``
in ``seq`` order; the first sighting of an unknown domain sets 0.0 instead.
Maps of the form ``x -> min(max(x + d, lo), hi)`` are closed under composition:

    (d1, lo1, hi1) then (d2, lo2, hi2) = (d1 + d2, c2(lo1), c2(hi1)),
    c2(v) = min(max(v + d2, lo2), hi2)

so the fold runs as a tree: contiguous ``seq`` chunks of at most ``chunk_size``
events are folded in parallel (a bounded ``collect_list``), then chunk triples
are composed in order, ``fan_in`` at a time, until one triple per domain is
left. No group ever holds more than ``max(chunk_size, fan_in)`` elements, so a
domain that owns a third of all events is split over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import QUALITY_HI, QUALITY_LO, QUALITY_STEP

_BIG = 1.0e300


def _triple(d, lo, hi) -> Column:
    return F.struct(d.alias("d"), lo.alias("lo"), hi.alias("hi"))


def _compose(acc: Column, x: Column) -> Column:
    """acc then x."""
    def c2(v):
        return F.least(F.greatest(v + x["d"], x["lo"]), x["hi"])
    return _triple(acc["d"] + x["d"], c2(acc["lo"]), c2(acc["hi"]))


def _identity() -> Column:
    return _triple(F.lit(0.0), F.lit(-_BIG), F.lit(_BIG))


def _fold_sorted(arr: Column) -> Column:
    return F.aggregate(arr, _identity(), _compose)


def fold_chunks(events: DataFrame, chunk_size: int) -> DataFrame:
    """(domain, chunk, n, t_all, t_skip) of (domain, chunk, seq, delta), at most ``chunk_size`` events
    a chunk: the triple of all its events, and of all but the first."""
    def triples(l: Column) -> Column:
        return _fold_sorted(F.transform(l, lambda e: _triple(e["delta"], F.lit(QUALITY_LO), F.lit(QUALITY_HI))))
    return (events.groupBy("domain", "chunk").agg(F.sort_array(F.collect_list(F.struct("seq", "delta"))).alias("l"))
            .select("domain", "chunk", F.size("l").cast("long").alias("n"), triples(F.col("l")).alias("t_all"),
                    triples(F.slice("l", 2, chunk_size)).alias("t_skip")))


def compose_nodes(nodes: DataFrame, parent: Column) -> DataFrame:
    """(domain, chunk, n, t_all, t_skip) of the parents of such nodes, children in order."""
    l = F.sort_array(F.collect_list(F.struct("chunk", "n", "t_all", "t_skip")))
    return nodes.withColumn("_p", parent).groupBy("domain", "_p").agg(l.alias("l"), F.sum("n").alias("n")).select(
        "domain", F.col("_p").alias("chunk"), "n", _fold_sorted(F.transform("l", lambda e: e["t_all"])).alias("t_all"),
        _fold_sorted(F.transform("l", lambda e, i: F.when(i == 0, e["t_skip"]).otherwise(e["t_all"]))).alias("t_skip"))


def applied(triple: Column, start: Column) -> Column:
    """The value that a triple makes of ``start``."""
    return F.least(F.greatest(start + triple["d"], triple["lo"]), triple["hi"])


def quality_fold(
    events: DataFrame,
    state: DataFrame | None = None,
    *,
    domain_col: str = "domain",
    seq_col: str = "seq",
    relevance_col: str = "relevance",
    step: float = QUALITY_STEP,
    chunk_size: int = 4096,
    fan_in: int = 1024,
) -> DataFrame:
    """Fold a batch of discovered-URL events into per-domain (visits, quality).

    ``events``: (domain, seq, relevance); ``seq`` is a unique total order.
    ``state``: optional (domain, visit_count, quality_score) before the batch.
    Returns (domain, visit_count, quality_score, is_new) for touched domains.
    """
    spark = events.sparkSession
    ev = events.select(
        F.col(domain_col).alias("domain"),
        F.col(seq_col).cast("long").alias("seq"),
        (F.lit(step) * (F.col(relevance_col).cast("double") - F.lit(0.5))).alias("delta"),
    )
    if state is None:
        state = spark.createDataFrame([], "domain string, visit_count long, quality_score double")
    st = state.select("domain", F.col("visit_count").cast("long"), F.col("quality_score").cast("double"))

    # level 0: bounded chunks of contiguous seq, folded in order; chunk ids
    # start at 0 so that every level halves the id range by fan_in
    bounds = ev.agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).first()
    seq0 = 0 if bounds["lo"] is None else int(bounds["lo"])
    chunks = fold_chunks(ev.withColumn("chunk", F.floor((F.col("seq") - F.lit(seq0)) / F.lit(chunk_size)).cast("long")), chunk_size)
    # per domain: first chunk and whether the start value is known
    per_domain = chunks.groupBy("domain").agg(
        F.min("chunk").alias("first_chunk"), F.sum("n").alias("n_events")
    )
    known = per_domain.join(st, "domain", "left")
    chunk_t = chunks.join(known.select("domain", "first_chunk", "quality_score"), "domain").select(
        "domain", "chunk",
        F.when((F.col("chunk") == F.col("first_chunk")) & F.col("quality_score").isNull(), F.col("t_skip"))
        .otherwise(F.col("t_all")).alias("t"),
    )

    # compose levels until one triple per domain (levels from the seq span)
    n_chunks = 1 if bounds["hi"] is None else int((int(bounds["hi"]) - seq0) // chunk_size) + 1
    levels = 0 if n_chunks <= 1 else math.ceil(math.log(n_chunks, fan_in) + 1e-12)
    level = chunk_t
    for _ in range(levels):
        level = (
            level.withColumn("parent", F.floor(F.col("chunk") / F.lit(fan_in)).cast("long"))
            .groupBy("domain", "parent")
            .agg(F.sort_array(F.collect_list(F.struct(F.col("chunk").alias("c"), F.col("t")))).alias("l"))
            .select("domain", F.col("parent").alias("chunk"), _fold_sorted(F.transform("l", lambda e: e["t"])).alias("t"))
        )
    final = level.groupBy("domain").agg(
        _fold_sorted(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "t"))), lambda e: e["t"])).alias("t")
    )

    start = F.coalesce(F.col("quality_score"), F.lit(0.0))
    return final.join(known, "domain").select(
        "domain",
        (F.coalesce(F.col("visit_count"), F.lit(0)) + F.col("n_events")).alias("visit_count"),
        F.least(F.greatest(start + F.col("t")["d"], F.col("t")["lo"]), F.col("t")["hi"]).alias("quality_score"),
        F.col("visit_count").isNull().alias("is_new"),
    )


def quality_fold_plain(events: DataFrame, *, domain_col="domain", seq_col="seq",
                       relevance_col="relevance", step: float = QUALITY_STEP) -> DataFrame:
    """Reference form for small inputs and tests: one ordered fold per domain
    over an unknown-domain start (first event sets 0.0)."""
    l = F.sort_array(F.collect_list(F.struct(F.col(seq_col).alias("s"), F.col(relevance_col).alias("r"))))
    return (
        events.groupBy(F.col(domain_col).alias("domain"))
        .agg(l.alias("l"))
        .select(
            "domain",
            F.size("l").cast("long").alias("visit_count"),
            F.aggregate(
                F.slice("l", 2, 1 << 30), F.lit(0.0),
                lambda acc, x: F.greatest(F.lit(QUALITY_LO), F.least(acc + F.lit(step) * (x["r"] - F.lit(0.5)), F.lit(QUALITY_HI))),
            ).alias("quality_score"),
        )
    )
