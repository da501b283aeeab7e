"""E8 entity popularity by backlinks, E9 domain authority (PageRank-style).

Authority is an iterative join + aggregate: ranks (one row per node) meet the
edge list, mass is summed per target, and a reliable checkpoint every few
iterations keeps the lineage short. Edges with their weights are materialised once.
Nodes without out-edges spread their mass evenly over all nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

DAMPING = 0.85


def entity_popularity(reference: DataFrame, url_table: DataFrame, source: DataFrame,
                      domain: DataFrame) -> DataFrame:
    """Per entity: references, distinct urls, distinct domains."""
    j = (reference.select("entity_id", "url_id")
         .join(url_table.select("url_id", "source_id"), "url_id")
         .join(source.select("source_id", "domain_id"), "source_id"))
    return j.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("references"),
        F.countDistinct("url_id").alias("distinct_urls"),
        F.countDistinct("domain_id").alias("distinct_domains"),
    )


def _rank_loop(nd: DataFrame, node: str, n: int, flow, linked: DataFrame, iterations: int, damping: float,
               checkpoint_every: int) -> DataFrame:
    """Iterate ranks over ``flow`` (ranks -> (node, s)). The mass of nodes without
    links is what the linked ones do not hold, as ranks sum to 1: it is added as
    one aggregated row of the same job, so an iteration starts no job of its own."""
    known = nd.join(linked.select(node).withColumn("_linked", F.lit(True)), node, "left")
    known = cut_lineage(known.select(node, F.coalesce("_linked", F.lit(False)).alias("_linked")))
    ranks = known.select(node, "_linked", F.lit(1.0 / n).alias("r"))
    for i in range(iterations):
        idle = ranks.where(~F.col("_linked")).agg(F.coalesce(F.sum("r"), F.lit(0.0)).alias("idle"))
        ranks = (known.join(flow(ranks), node, "left").join(F.broadcast(idle))     # one row
                 .select(node, "_linked", (F.lit((1 - damping) / n) + F.lit(damping) * (
                     F.coalesce("s", F.lit(0.0)) + F.col("idle") / F.lit(n))).alias("r")))
        if (i + 1) % checkpoint_every == 0 and i + 1 < iterations:
            ranks = cut_lineage(ranks)
    return ranks.select(node, "r")


def pagerank(nodes: DataFrame, edges: DataFrame, iterations: int = 5, damping: float = DAMPING,
             checkpoint_every: int = 2) -> DataFrame:
    """Directed PageRank. ``nodes``: (node); ``edges``: (src, dst), deduplicated
    here. Returns (node, rank); ranks sum to 1."""
    nd = cut_lineage(nodes.select("node").distinct())
    e = edges.select("src", "dst").distinct()
    outdeg = e.groupBy("src").agg(F.count(F.lit(1)).alias("k"))
    ew = cut_lineage(e.join(outdeg, "src").select("src", "dst", (F.lit(1.0) / F.col("k")).alias("w")))

    def flow(ranks: DataFrame) -> DataFrame:
        return (ew.join(ranks.select(F.col("node").alias("src"), "r"), "src")
                .groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("r") * F.col("w")).alias("s")))

    out = _rank_loop(nd, "node", nd.count(), flow, ew.select(F.col("src").alias("node")).distinct(), iterations,
                     damping, checkpoint_every)
    return out.withColumnRenamed("r", "rank")


def bipartite_authority(edges: DataFrame, nodes: DataFrame, iterations: int = 5, damping: float = DAMPING,
                        checkpoint_every: int = 2) -> DataFrame:
    """Authority over a domain <-> item bipartite graph (items: link paths or
    entities). Each iteration walks domain -> item -> domain:
    ``w(item) = sum r(d)/deg(d)``, ``r'(d) = (1-a)/n + a*(sum w(item)/deg(item) + dangling/n)``.

    ``edges``: (domain, item); ``nodes``: (domain) including domains without edges."""
    nd = cut_lineage(nodes.select("domain").distinct())
    e = cut_lineage(edges.select("domain", "item").distinct())
    ddeg = e.groupBy("domain").agg(F.count(F.lit(1)).alias("dk"))
    ideg = e.groupBy("item").agg(F.count(F.lit(1)).alias("ik"))
    ed = cut_lineage(e.join(ddeg, "domain").join(ideg, "item"))

    def flow(ranks: DataFrame) -> DataFrame:
        # both sides are sized by adaptive execution, which also splits a hot item
        w = ed.join(ranks.select("domain", "r"), "domain").groupBy("item").agg(F.sum(F.col("r") / F.col("dk")).alias("w"))
        return ed.join(w, "item").groupBy("domain").agg(F.sum(F.col("w") / F.col("ik")).alias("s"))

    out = _rank_loop(nd, "domain", nd.count(), flow, ed.select("domain").distinct(), iterations, damping, checkpoint_every)
    return out.withColumnRenamed("r", "authority")
