"""Resolve mentions against the entity table, exact first, then
trigram-fuzzy above .75; per-page validated set and rejected list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .similarity import fuzzy_best_match, nearest_match

FUZZY_THRESHOLD = 0.75


def entity_by_name(entity: DataFrame) -> DataFrame:
    """Name -> one entity (names repeat in a gazetteer; the lowest id wins)."""
    return entity.groupBy("name").agg(F.min_by(F.struct("entity_id", "address"), F.col("entity_id")).alias("e")) \
        .select("name", F.col("e.entity_id").alias("entity_id"), F.col("e.address").alias("address"))


def exact_match(mentions: DataFrame, entity: DataFrame, mention_col: str = "mention") -> DataFrame:
    """Case-sensitive name equality; (mention, entity_id) or NULL id."""
    byname = entity_by_name(entity)
    m = mentions.select(F.col(mention_col).alias("mention")).distinct()
    return m.join(byname.select(F.col("name").alias("mention"), "entity_id"), "mention", "left")


def resolve_mentions(mentions: DataFrame, entity: DataFrame, mention_col: str = "mention",
                     threshold: float = FUZZY_THRESHOLD, nearest: bool = False) -> DataFrame:
    """D3: distinct mentions -> exact -> left_anti remainder -> fuzzy.

    Returns (mention, entity_id, matched_name, confidence, method, accepted).
    ``method`` is exact / fuzzy / none; ``matched_name`` is the entity name the
    mention resolves to (the name kept in the validated set). A rejected mention
    keeps its own text; with ``nearest`` it also gets nearest_name and
    nearest_confidence, its best entity below the threshold (else null)."""
    m = mentions.select(F.col(mention_col).alias("mention")).where(F.col("mention").isNotNull()).distinct()
    ex = exact_match(m, entity).where(F.col("entity_id").isNotNull())
    exact = ex.select("mention", "entity_id", F.col("mention").alias("matched_name"),
                      F.lit(1.0).alias("confidence"), F.lit("exact").alias("method"))
    rest = m.join(ex.select("mention"), "mention", "left_anti")
    fz = fuzzy_best_match(rest, entity, threshold).select(
        "mention", "entity_id", "matched_name", "confidence", F.lit("fuzzy").alias("method"))
    hits = exact.unionByName(fz)
    out = m.join(hits, "mention", "left").select(
        "mention", "entity_id", "matched_name", "confidence",
        F.coalesce("method", F.lit("none")).alias("method"),
        F.col("entity_id").isNotNull().alias("accepted"),
    )
    if nearest:
        near = nearest_match(out.where("not accepted").select("mention"), entity).select(
            "mention", F.col("matched_name").alias("nearest_name"), F.col("confidence").alias("nearest_confidence"))
        out = out.join(near, "mention", "left")
    return out


def page_mentions(page_mentions_df: DataFrame, resolved: DataFrame, key: str) -> DataFrame:
    """Per page the validated set of resolved names and the rejected list.

    ``page_mentions_df``: (key, mention) with one row per distinct mention of the
    page (the extractor returns distinct strings)."""
    j = page_mentions_df.join(resolved.select("mention", "accepted", "matched_name"), "mention")
    return j.groupBy(key).agg(
        F.array_sort(F.collect_set(F.when(F.col("accepted"), F.col("matched_name")))).alias("names"),
        F.array_sort(F.collect_list(F.when(~F.col("accepted"), F.col("mention")))).alias("rejected"),
    )
