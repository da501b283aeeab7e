"""The state as append-only change files over a snapshot, merged when read.

A batch writes, for each table that it touches, the rows that are new or changed and the
keys that are gone, below ``base/change=<version>``; what it writes follows the batch, not
the state. A line in ``base/_log`` commits it: (version, the snapshot it builds on, the
tables it has). A reader takes the snapshot and the changes that are committed after it; of
the rows of a key the last change counts. A batch that is run again overwrites its
own files as long as they are not committed, and is skipped once they are.

Every ``compact_after`` changes, the merged state becomes the next snapshot (its own
version of ``snapshots.write_state``), and later batches build on that. Files of older
snapshots and changes stay for readers of older versions; ``expire`` names them.

Rules are checked on what changed before a batch is committed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import KEYS, SCHEMAS, GraphState, change_report, empty_state, merged, raise_if_broken
from .snapshots import read_state, write_state

COMPACT_AFTER = 16
_LOG = "version long, snapshot long, tables array<string>"


class ChangeLog:
    """The state below ``base``. ``initial`` is what version 0 has."""

    def __init__(self, spark: SparkSession, base: str, initial: GraphState | None = None, compact_after: int = COMPACT_AFTER):
        self.spark, self.base, self.compact_after = spark, base.rstrip("/"), compact_after
        self.initial = initial

    def _entries(self) -> list:
        """The log, one row a version, ascending."""
        try:
            log = self.spark.read.schema(_LOG).parquet(f"{self.base}/_log")
            return log.orderBy("version").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":      # only a missing log means that nothing is committed
                raise
            return []

    def version(self) -> int:
        entries = self._entries()
        return entries[-1]["version"] if entries else 0

    def read(self) -> GraphState:
        """The state of the last committed version."""
        return self._read(self._entries())

    def _read(self, entries: list) -> GraphState:
        snapshot = entries[-1]["snapshot"] if entries else 0
        state = read_state(self.spark, f"{self.base}/snapshots", snapshot) if snapshot else (
            self.initial or empty_state(self.spark))
        after = [e for e in entries if e["version"] > snapshot]
        changes, gone = {}, {}
        for table in SCHEMAS:
            paths = [self._path(e["version"], table) for e in after if table in e["tables"]]
            if not paths:
                continue
            if table == "sequence":                        # the last row counts
                changes[table] = self._rows(table, paths[-1:]).select(*self._columns(table))
            elif table not in KEYS:
                changes[table] = self._rows(table, paths).select(*self._columns(table))
            else:
                key = KEYS[table]
                last = (self._rows(table, paths).groupBy(key).agg(F.max_by(F.struct("*"), F.col("_version")).alias("_r"))
                        .select("_r.*"))
                changes[table] = last.where("not _gone").select(*self._columns(table))
                gone[table] = last.where("_gone").select(key)
        return merged(state, changes, gone)

    def _columns(self, table: str) -> list[str]:
        return [c.split()[0] for c in SCHEMAS[table].split(", ")]

    def _path(self, version: int, table: str) -> str:
        return f"{self.base}/change={int(version)}/{table}"

    def _rows(self, table: str, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(f"{SCHEMAS[table]}, _version long, _gone boolean").parquet(*paths)

    def commit(self, version: int, changes: dict[str, DataFrame], gone: dict[str, DataFrame] | None = None) -> bool:
        """Write and commit one batch as ``version``; False if that is committed already. A batch that
        breaks a rule raises and is not committed."""
        entries = self._entries()
        if entries and entries[-1]["version"] >= version:
            return False
        gone = gone or {}
        tables = sorted({*changes, *gone})
        for table in tables:
            columns = self._columns(table)
            parts = []
            if table in changes:
                parts.append(changes[table].select(*columns, F.lit(version).cast("long").alias("_version"), F.lit(False).alias("_gone")))
            if table in gone:
                away = gone[table].select(KEYS[table]).distinct()
                if table in changes:                       # what the batch has written anew is not gone
                    away = away.join(changes[table].select(KEYS[table]), KEYS[table], "left_anti")
                parts.append(away.select(*(F.col(c) if c == KEYS[table] else F.lit(None).alias(c) for c in columns),
                                         F.lit(version).cast("long").alias("_version"), F.lit(True).alias("_gone")))
            rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
            rows.write.mode("overwrite").parquet(self._path(version, table))
        snapshot = entries[-1]["snapshot"] if entries else 0
        state = self._read([*entries, {"version": version, "snapshot": snapshot, "tables": tables}])
        written = {t: self._rows(t, [self._path(version, t)]).where("not _gone") for t in tables if t in changes}
        raise_if_broken(change_report(state, written))
        if sum(e["version"] > snapshot for e in entries) + 1 >= self.compact_after:
            write_state(state, f"{self.base}/snapshots", version)
            snapshot = version
        self.spark.createDataFrame([(version, snapshot, tables)], _LOG).coalesce(1).write.mode("append").parquet(f"{self.base}/_log")
        return True

    def expire(self) -> list[str]:
        """Folders that the last version no longer reads."""
        entries = self._entries()
        if not entries:
            return []
        last = entries[-1]["snapshot"]
        old = sorted({e["snapshot"] for e in entries} - {0, last})
        return ([f"{self.base}/change={e['version']}" for e in entries if e["version"] <= last]
                + [f"{self.base}/snapshots/v={s}" for s in old])
