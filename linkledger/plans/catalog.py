"""Imports every query module so that the registry is complete, and defines the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import q_ingest, q_pages, q_rank, q_round, q_stream, q_urls  # noqa: F401
from .registry import ROUND


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per domain: visits, quality and its highest-priority frontier URL."""
    from ..operators.frontier import priority_order  # noqa: F401

    st, queued = q_urls.validated(spark, sf_dir)
    dom = st.domain
    top = (queued.join(st.url.select("url_id", "source_id"), "url_id")
           .join(st.source.select("source_id", "domain_id"), "source_id")
           .groupBy("domain_id")
           .agg(F.max_by(F.struct("full_url", "priority", "priority_int"),
                         F.struct(F.col("priority_int"), F.col("priority"), -F.col("url_id"))).alias("top")))
    return dom.join(top, "domain_id", "left").select(
        "domain_id", "domain_name", "visit_count", F.round("quality_score", ROUND).alias("quality_score"),
        F.col("top.full_url").alias("top_url"), F.round("top.priority", ROUND).alias("top_priority"),
        F.col("top.priority_int").alias("top_priority_int"))
