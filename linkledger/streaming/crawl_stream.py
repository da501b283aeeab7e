"""Incremental runs with Structured Streaming.

Landed inputs (discovered-URL batches, or page tables they are derived from)
are read with ``readStream``; every micro-batch runs the same batch jobs
through ``foreachBatch`` against the committed state and commits what it changed as
version ``batch_id + 1`` of a ``ChangeLog``, so it writes what the batch touches and not
the state. Domain quality is kept as a ``QualityTree``: an event that comes late takes
its place in the order of ``seq``. A replayed batch whose version is already committed is
skipped, so the sink is idempotent and the query resumes exactly from its checkpoint after
a failure. ``Trigger.AvailableNow`` drains what has landed and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.frontier import discovered_events, validate_changes
from ..operators.state import GraphState
from ..session import cut_lineage
from ..sources.changes import ChangeLog
from ..sources.quality_tree import QualityTree

ToDiscovered = Callable[[DataFrame], DataFrame]


class _Store:
    """The change log and the quality tree of one stream."""

    def __init__(self, spark: SparkSession, base: str, initial: GraphState | None):
        self.log = ChangeLog(spark, base, initial)
        origin = None if initial is None else initial.domain.select(
            F.col("domain_name").alias("domain"), "visit_count", "quality_score")
        self.tree = QualityTree(spark, f"{base.rstrip('/')}/quality", origin)

    def fold(self, discovered: DataFrame, version: int) -> DataFrame:
        return self.tree.add(discovered_events(discovered).select("domain", "seq", "relevance"), version)


def _run(source: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True) -> None:
    writer = source.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    writer.start().awaitTermination()


def validate_stream(spark: SparkSession, source: DataFrame, to_discovered: ToDiscovered, state_base: str,
                    checkpoint: str, as_of: str, initial: GraphState | None = None,
                    available_now: bool = True) -> GraphState:
    """Run the validate step over a streaming source until it is drained.

    ``source`` is a streaming DataFrame; ``to_discovered`` turns a micro-batch
    into (seq, url, relevance). Returns the last committed state."""
    store = _Store(spark, state_base, initial)

    def process(batch: DataFrame, batch_id: int) -> None:
        if store.log.version() > batch_id:
            return                                   # replay of a committed batch
        found = cut_lineage(to_discovered(batch))
        changes, _ = validate_changes(found, store.log.read(), as_of, quality=store.fold(found, batch_id + 1))
        store.log.commit(batch_id + 1, changes)

    _run(source, process, checkpoint, available_now)
    return store.log.read()


def round_stream(spark: SparkSession, source: DataFrame, to_discovered: ToDiscovered, fetched: DataFrame,
                 extractor, state_base: str, checkpoint: str, as_of: str,
                 initial: GraphState | None = None, feedback_dir: str | None = None) -> GraphState:
    """Every micro-batch of discovered URLs runs a whole crawl round
    (validate, extract, transform, load) against the committed state.
    The round's feedback (derived links) is appended to ``feedback_dir`` as
    parquet, where it can be landed as the input of a later run."""
    from ..plans.rounds import run_round

    store = _Store(spark, state_base, initial)

    def process(batch: DataFrame, batch_id: int) -> None:
        if store.log.version() > batch_id:
            return
        found = cut_lineage(to_discovered(batch))
        out = run_round(store.log.read(), found, fetched, extractor, as_of, quality=store.fold(found, batch_id + 1))
        if feedback_dir is not None:
            out.feedback.select("seq", "url", "relevance").write.mode("overwrite").parquet(
                f"{feedback_dir.rstrip('/')}/batch={batch_id}")
        store.log.commit(batch_id + 1, out.changes, out.gone)

    _run(source, process, checkpoint)
    return store.log.read()
