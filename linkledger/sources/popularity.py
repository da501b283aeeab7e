"""Entity popularity kept up by batches of references, not counted again.

A batch adds, per entity, its references, the URLs that are new for the entity, and the domains
that are. What is new is known from the pairs of earlier batches: only the pairs of the
entities in the batch are read, by a semi-join on their bucket and id. Totals are files by
batch; the last one of an entity counts. ``_log`` commits a batch; a replay is skipped."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TOTALS = "entity_id long, references long, distinct_urls long, distinct_domains long, _version long"
_PAIRS = "entity_id long, url_id long, domain_id long, bucket int"
COUNTS = ("references", "distinct_urls", "distinct_domains")


class Popularity:
    """The totals below ``base``; pairs are dealt into ``buckets`` by entity."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = 16):
        self.spark, self.base, self.buckets = spark, base.rstrip("/"), buckets

    def _versions(self) -> list[int]:
        try:
            return [r[0] for r in self.spark.read.schema("version long").parquet(f"{self.base}/_log").orderBy("version").collect()]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _pairs(self, versions: list[int], buckets: list[int]) -> DataFrame:
        """Pairs of the batches in some buckets."""
        out = self.spark.createDataFrame([], _PAIRS)
        for v in versions:
            path = f"{self.base}/pairs/batch={v}"
            out = out.unionByName(self.spark.read.schema(_PAIRS).option("basePath", path).parquet(path))
        return out.where(F.col("bucket").isin(buckets))

    def _totals(self, versions: list[int]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], _TOTALS).drop("_version")
        paths = [f"{self.base}/totals/batch={v}" for v in versions]
        return (self.spark.read.schema(_TOTALS).parquet(*paths).groupBy("entity_id")
                .agg(F.max_by(F.struct(*COUNTS), F.col("_version")).alias("_t")).select("entity_id", "_t.*"))

    def totals(self) -> DataFrame:
        """(entity_id, references, distinct_urls, distinct_domains)"""
        return self._totals(self._versions())

    def add(self, references: DataFrame, url_table: DataFrame, source: DataFrame, version: int) -> bool:
        """Add a batch of references (entity_id, url_id); False if ``version`` is committed already."""
        done = self._versions()
        if version in done:
            return False
        bucket = F.pmod(F.hash("entity_id"), F.lit(self.buckets))
        batch = (references.select("entity_id", "url_id").join(url_table.select("url_id", "source_id"), "url_id")
                 .join(source.select("source_id", "domain_id"), "source_id").withColumn("bucket", bucket))
        mine = f"{self.base}/pairs/batch={version}"
        # the pairs of the batch, with what it has of each, are written first and read from there
        (batch.groupBy("entity_id", "url_id", "domain_id", "bucket").agg(F.count(F.lit(1)).alias("n"))
         .write.mode("overwrite").partitionBy("bucket").parquet(mine))
        new = self.spark.read.schema(_PAIRS + ", n long").option("basePath", mine).parquet(mine)
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]         # at most ``buckets``
        old = self._pairs(done, touched).join(new.select("entity_id").distinct(), "entity_id", "left_semi")
        urls = new.join(old.select("entity_id", "url_id"), ["entity_id", "url_id"], "left_anti")
        domains = new.join(old.select("entity_id", "domain_id"), ["entity_id", "domain_id"], "left_anti")
        more = (new.groupBy("entity_id").agg(F.sum("n").alias("_r"))
                .join(urls.groupBy("entity_id").agg(F.countDistinct("url_id").alias("_u")), "entity_id", "left")
                .join(domains.groupBy("entity_id").agg(F.countDistinct("domain_id").alias("_d")), "entity_id", "left"))
        known = self._totals(done).select("entity_id", *(F.col(c).alias(f"_{c}") for c in COUNTS))
        (more.join(known, "entity_id", "left")
         .select("entity_id", *((F.coalesce(f"_{c}", F.lit(0)) + F.coalesce(x, F.lit(0))).cast("long").alias(c)
                                for c, x in zip(COUNTS, ("_r", "_u", "_d"))), F.lit(version).cast("long").alias("_version"))
         .write.mode("overwrite").parquet(f"{self.base}/totals/batch={version}"))
        self.spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{self.base}/_log")
        return True
