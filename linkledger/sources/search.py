"""Search queries per seed and search-result scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import seed_relevance

RESULTS_SCHEMA = "web struct<results: array<struct<url: string>>>"


def search_queries(seeds: DataFrame) -> DataFrame:
    """Two query strings per seed (trimmed name and location)."""
    name, loc = F.trim("name"), F.trim("location")
    q1 = F.concat_ws(" ", name, loc, F.lit("restaurant review"))
    q2 = F.concat(F.lit('review "'), name, F.lit('" '), loc)
    return seeds.select("pos", F.posexplode(F.array(q1, q2)).alias("qi", "query")) \
        .select("pos", (F.col("qi") + 1).alias("query_idx"), "query")


def result_urls(responses: DataFrame, body_col: str = "body") -> DataFrame:
    """A5: ``web.results[].url`` of each response; a missing key gives no rows."""
    parsed = F.from_json(body_col, RESULTS_SCHEMA)
    urls = F.coalesce(parsed["web"]["results"], F.array().cast("array<struct<url:string>>"))
    keys = [c for c in responses.columns if c != body_col]
    return responses.select(*keys, F.explode(urls).alias("r")).select(*keys, F.col("r.url").alias("url"))


def hits_per_query(hits: DataFrame) -> DataFrame:
    """URLs per query, duplicates counted."""
    return hits.groupBy("pos", "query_idx").agg(F.count(F.lit(1)).alias("n_urls"))


def seed_hits(hits: DataFrame, seeds: DataFrame) -> DataFrame:
    """E1 + B12: distinct URLs per seed over its queries, with the seed relevance."""
    return (hits.select("pos", "url").distinct()
            .join(seeds.select("pos", "initial_search"), "pos")
            .select("pos", "url", seed_relevance("initial_search").alias("relevance")))
