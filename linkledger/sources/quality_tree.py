"""The ordered quality fold of a domain as a persisted segment tree.

Events keep their place in ``seq`` whenever they arrive. A leaf holds the events of one
domain in ``chunk_size`` consecutive numbers; its triples (of all events, and of all but
the first) and those of the nodes above it, ``fan_in`` children each, are kept as
append-only files. A batch adds its events to the log, folds the leaves that it touches anew from
the log, and then only the nodes above those, so it costs what it touches, and a late event
with a low number gives the same quality as if it had come in time.

The log is partitioned by eras of chunks, and a batch reads the eras it touches. Nodes
are merged when read, the last version of a node counts; every ``compact_after`` batches they
are written together. ``_log`` commits a batch; one that is committed already is skipped."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scoring import QUALITY_STEP
from ..operators.quality import applied, compose_nodes, fold_chunks

_LOG = "version long, snapshot long"
_TRIPLE = "struct<d:double,lo:double,hi:double>"
_NODE = f"domain string, chunk long, n long, t_all {_TRIPLE}, t_skip {_TRIPLE}, _version long, level int"
_EVENT = "domain string, chunk long, seq long, delta double, _version long, era long"


class QualityTree:
    """The fold below ``base``. ``origin`` (domain, visit_count, quality_score) is what domains have from
    before the first event. Numbers run from 0 to ``chunk_size * fan_in ** levels``; others raise."""

    def __init__(self, spark: SparkSession, base: str, origin: DataFrame | None = None, step: float = QUALITY_STEP,
                 chunk_size: int = 4096, fan_in: int = 1024, levels: int = 3, era: int = 1 << 20, compact_after: int = 16):
        self.spark, self.base, self.origin, self.step = spark, base.rstrip("/"), origin, step
        self.chunk_size, self.fan_in, self.levels, self.era, self.compact_after = chunk_size, fan_in, levels, era, compact_after

    def _entries(self) -> list:
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.base}/_log").orderBy("version").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _node_path(self, version: int, level: int) -> str:
        return f"{self.base}/nodes/batch={version}/level={level}"

    def _nodes(self, entries: list, level: int, also: int | None = None) -> DataFrame:
        """The last version of each node of a level."""
        snapshot = entries[-1]["snapshot"] if entries else 0
        paths = [f"{self.base}/nodes/snapshot={snapshot}/level={level}"] if snapshot else []
        paths += [self._node_path(e["version"], level) for e in entries if e["version"] > snapshot]
        paths += [self._node_path(also, level)] if also is not None else []
        if not paths:
            return self.spark.createDataFrame([], _NODE).drop("level")
        fields = _NODE.replace(", level int", "")
        return (self.spark.read.schema(fields).parquet(*paths).groupBy("domain", "chunk")
                .agg(F.max_by(F.struct("n", "t_all", "t_skip", "_version"), F.col("_version")).alias("_r"))
                .select("domain", "chunk", "_r.*"))

    def _write_nodes(self, nodes: DataFrame, version: int, level: int) -> DataFrame:
        path = self._node_path(version, level)
        nodes.withColumn("_version", F.lit(version).cast("long")).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def add(self, events: DataFrame, version: int) -> DataFrame:
        """Add (domain, seq, relevance) as ``version``, unless it is committed; (domain, visit_count,
        quality_score) of the domains that it touches."""
        entries = self._entries()
        path = f"{self.base}/events/batch={version}"
        if not any(e["version"] == version for e in entries):
            entries = self._add(events, version, entries, path)
        touched = self._read_events([path], None).select("domain").distinct()
        return self._quality(entries, touched)

    def _read_events(self, paths: list[str], eras: list[int] | None) -> DataFrame:
        df = None
        for p in paths:                                # each batch has its own partition folders
            one = self.spark.read.schema(_EVENT).option("basePath", p).parquet(p)
            df = one if df is None else df.unionByName(one)
        return df if eras is None else df.where(F.col("era").isin(eras))

    def _add(self, events: DataFrame, version: int, entries: list, path: str) -> list:
        seq = F.col("seq").cast("long")
        chunk = F.floor(seq / F.lit(self.chunk_size)).cast("long")
        (events.select("domain", chunk.alias("chunk"), seq.alias("seq"),
                       (F.lit(self.step) * (F.col("relevance").cast("double") - F.lit(0.5))).alias("delta"),
                       F.lit(version).cast("long").alias("_version"))
         .withColumn("era", F.floor(F.col("chunk") / F.lit(self.era)).cast("long"))
         .write.mode("overwrite").partitionBy("era").parquet(path))
        new = self._read_events([path], None)
        low, high, eras = new.agg(F.min("seq"), F.max("seq"), F.collect_set("era")).first()
        if low is not None and (low < 0 or high >= self.chunk_size * self.fan_in ** self.levels):
            raise ValueError(f"events from {low} to {high} do not fit a tree of {self.levels} levels")
        touched = new.select("domain", "chunk").distinct()
        paths = [f"{self.base}/events/batch={e['version']}" for e in entries] + [path]
        leaves = self._read_events(paths, eras).join(touched, ["domain", "chunk"], "left_semi")
        at = self._write_nodes(fold_chunks(leaves.select("domain", "chunk", "seq", "delta"), self.chunk_size), version, 0)
        parent = F.floor(F.col("chunk") / F.lit(self.fan_in)).cast("long")
        for level in range(1, self.levels + 1):
            over = at.select("domain", parent.alias("_parent")).distinct()
            children = self._nodes(entries, level - 1, version).withColumn("_parent", parent).join(
                over, ["domain", "_parent"], "left_semi").drop("_parent", "_version")
            at = self._write_nodes(compose_nodes(children, parent), version, level)
        snapshot = entries[-1]["snapshot"] if entries else 0
        if sum(e["version"] > snapshot for e in entries) + 1 >= self.compact_after:
            for level in range(self.levels + 1):
                self._nodes(entries, level, version).write.mode("overwrite").parquet(
                    f"{self.base}/nodes/snapshot={version}/level={level}")
            snapshot = version
        self.spark.createDataFrame([(version, snapshot)], _LOG).coalesce(1).write.mode("append").parquet(f"{self.base}/_log")
        return self._entries()

    def _quality(self, entries: list, touched: DataFrame) -> DataFrame:
        root = self._nodes(entries, self.levels).join(touched, "domain", "left_semi")      # one a domain
        if self.origin is None:
            return root.select("domain", F.col("n").alias("visit_count"),
                               applied(F.col("t_skip"), F.lit(0.0)).alias("quality_score"))
        known = self.origin.select("domain", F.col("visit_count").alias("_v"), F.col("quality_score").alias("_q"))
        # the first event of a domain that nothing is known of sets 0.0
        return root.join(known, "domain", "left").select(
            "domain", (F.coalesce("_v", F.lit(0)) + F.col("n")).alias("visit_count"),
            F.when(F.col("_q").isNull(), applied(F.col("t_skip"), F.lit(0.0)))
            .otherwise(applied(F.col("t_all"), F.col("_q"))).alias("quality_score"))

    def quality(self) -> DataFrame:
        """(domain, visit_count, quality_score) of all domains with events."""
        entries = self._entries()
        return self._quality(entries, self._nodes(entries, self.levels).select("domain"))
