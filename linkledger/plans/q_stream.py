"""Registered streaming queries: discovered URLs land in slices of
their order, and after each the stream is run with Trigger.AvailableNow, so that
every micro-batch takes up the state that the one before it committed. The result
must equal the batch run, so it is checked against the batch's oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.state import empty_state
from ..session import scratch_root
from ..streaming.crawl_stream import round_stream, validate_stream
from ..streaming.feeds import seed_stream
from . import inputs
from .q_ingest import _SEEDS_SQL, seeds
from .q_pages import profiled, title_entities, title_vocabulary
from .q_urls import AS_OF
from .registry import ORACLES, ROUND, register
from .rounds import gazetteer_extractor

DISCOVERED = "seq long, url string, relevance double"
SLICES = 3


def _landed_in_turn(spark, sf, root, run):
    """Land the discovered URLs in slices of their sequence, and ``run`` the stream on each."""
    disc = inputs.discovered(spark, sf).select("seq", "url", "relevance")
    cuts = disc.agg(F.percentile_approx("seq", [k / SLICES for k in range(1, SLICES)])).first()[0] or []
    state = None
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        part = disc.where((F.lit(lo is None) | (F.col("seq") > F.lit(lo))) & (F.lit(hi is None) | (F.col("seq") <= F.lit(hi))))
        part.write.mode("append").parquet(f"{root}/landed")
        state = run(spark.readStream.schema(DISCOVERED).parquet(f"{root}/landed"))
    return state


@register("stream_domain_state", ORACLES["domain_state"])
def q_stream_domain_state(spark, sf):
    root = scratch_root(spark, "stream-domain-state")
    st = _landed_in_turn(spark, sf, root, lambda src: validate_stream(
        spark, src, lambda batch: batch, f"{root}/state", f"{root}/checkpoint", AS_OF))
    return st.domain.select("domain_name", "domain_id", "visit_count",
                            F.round("quality_score", ROUND).alias("quality_score"))


@register("stream_late_events", ORACLES["domain_quality"])
def q_stream_late_events(spark, sf):
    """Slices in no order of their sequence: events that come late take their place, so visits and
    quality are those of the batch."""
    root = scratch_root(spark, "stream-late-events")
    disc = inputs.discovered(spark, sf).select("seq", "url", "relevance")
    st = None
    for k in range(SLICES):
        disc.where(F.pmod(F.xxhash64("seq"), F.lit(SLICES)) == SLICES - 1 - k).write.mode("append").parquet(f"{root}/landed")
        st = validate_stream(spark, spark.readStream.schema(DISCOVERED).parquet(f"{root}/landed"), lambda batch: batch,
                             f"{root}/state", f"{root}/checkpoint", AS_OF)
    return st.domain.select(F.col("domain_name").alias("domain"), "visit_count",
                            F.round("quality_score", ROUND).alias("quality_score"))


@register("seed_stream", f"""
WITH {_SEEDS_SQL}
SELECT pos, name, location, true AS initial_search FROM seeds""")
def q_seed_stream(spark, sf):
    """Seed records that land in three lots, the stream started anew after each."""
    root = scratch_root(spark, "seed-stream")
    all_ = seeds(spark, sf).select("pos", "name", "location", F.lit(None).cast("string").alias("source_url"))
    for k in range(SLICES):
        all_.where(F.col("pos") % SLICES == k).write.mode("append").json(f"{root}/landed")
        seed_stream(spark, f"{root}/landed", f"{root}/out", f"{root}/checkpoint", files_per_batch=1)
    out = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/out")
    return out.select("pos", "name", "location", "initial_search")


@register("stream_round")
def q_stream_round(spark, sf):
    """A whole round for each slice; the references of all of them."""
    root = scratch_root(spark, "stream-round")
    prof = profiled(spark, sf)
    st = _landed_in_turn(spark, sf, root, lambda src: round_stream(
        spark, src, lambda batch: batch, inputs.fetched_pages(spark, sf), gazetteer_extractor(title_vocabulary(prof)),
        f"{root}/state", f"{root}/checkpoint", AS_OF, initial=empty_state(spark, title_entities(prof)),
        feedback_dir=f"{root}/feedback"))
    return (st.reference.join(st.url.select("url_id", "full_url"), "url_id")
            .select("entity_id", "full_url", F.round("relevance", ROUND).alias("relevance")))
