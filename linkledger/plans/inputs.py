"""Inputs derived by Spark from the landed test tables (whole tables, no subsets).

discovered URLs  every page URL twice: seq = page_id with relevance
                 ((page_id*7) % 11)/10 (seed scale), then seq = page_id + 1e12
                 with ((page_id*3) % 11)/2.5 (a second sighting, larger scale)
fetched pages    every page; of repeated URLs the lowest page_id counts; status
                 0->404, 1->503, 2->no response, 3->403, 4->501, else 200 by page_id % 10
parent priority  page_id % 101
gazetteer        all customers (entity_id = custkey, address = nation)
mentions         all customer names, by custkey % 3 as they are, without the last
                 character, or with two letters changed about, plus part names
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls

SECOND_SIGHTING_OFFSET = 1_000_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages", "page_id", "url")
    first = p.select(
        F.col("page_id").alias("seq"), "url",
        (((F.col("page_id") * 7) % 11).cast("double") / F.lit(10.0)).alias("relevance"),
    )
    second = p.select(
        (F.col("page_id") + F.lit(SECOND_SIGHTING_OFFSET)).alias("seq"), "url",
        (((F.col("page_id") * 3) % 11).cast("double") / F.lit(2.5)).alias("relevance"),
    )
    return first.unionByName(second)


def fetch_status(page_id) -> F.Column:
    m = F.col(page_id) % 10
    return (F.when(m == 0, F.lit(404)).when(m == 1, F.lit(503)).when(m == 2, F.lit(None))
            .when(m == 3, F.lit(403)).when(m == 4, F.lit(501)).otherwise(F.lit(200)).cast("int"))


def parent_priority(page_id) -> F.Column:
    return (F.col(page_id) % 101).cast("int")


def fetched_pages(spark: SparkSession, sf_dir: str, with_html: bool = True) -> DataFrame:
    """Every landed page as a fetch; a URL that landed more than once has more rows."""
    cols = ["page_id", "url", "html"] if with_html else ["page_id", "url"]
    p = table(spark, sf_dir, "pages", *cols).withColumn("full_url", urls.normalize_url("url"))
    return p.withColumn("status", fetch_status("page_id")).withColumn("parent_priority", parent_priority("page_id"))


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("name"),
                    F.col("n_name").alias("address")))


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name")
    p = table(spark, sf_dir, "part", "p_name")
    name, kind = F.col("c_name"), F.col("c_custkey") % 3
    spelt = (F.when(kind == 0, name).when(kind == 1, F.substring(name, F.lit(1), F.length(name) - 1))
             .otherwise(F.replace(name, F.lit("Customer"), F.lit("Custmoer"))))
    return c.select(spelt.alias("mention")).unionByName(p.select(F.col("p_name").alias("mention")))
