"""Mixing sources to target weights by entropy balancing.

Targets: the sources share all words by weight; a target stops at ``max_repeat``
times its source's size and the excess is shared again, which is the level
``min(cap, level * weight)`` that uses all words up.

Rates: of all document rates in [0, max_repeat] that give each source its target,
take the one closest in entropy to 1. Its dual has one unknown a source, and the
rate of a document is ``min(max_repeat, exp(lambda_source * size / scale))``. Newton
steps on the logarithm of the dual's gradient run for all sources at once, each as
one grouped aggregation over the (source, size) histogram; a bracket keeps steps
that would leave it. Sums are decimal, so they do not depend on their order, and
reruns agree.

Copies: documents of a source stand in order of size, and each takes the whole
copies that the running sum of rates passes. Neighbours have like sizes, so what
one loses the next makes up, and a source ends within about one document of its
target, whatever phase the sum starts with; of ``PHASES`` phases, each source takes
the one that ends nearest. Ranks inside a (source, size) group come from one range-partitioned sort,
so a group of any size is spread over many tasks.

Defined results: null text has size 0 and is taken with 0 words; the null source
is a source of its own, last in order; rows that repeat count each, as do rows that
share an id; a null id is ranked like any other; an empty table gives an empty result;
a source that does not reach its target within the rounds raises. Other columns are not
read.
"""

from __future__ import annotations

import math
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.state import assign_dense_ids
from ..session import cut_lineage, ensure_checkpoint_dir
from .common import whole_text

WORD = r"[^\x20\x09-\x0D]+"
EXACT = "decimal(38,6)"
PHASES = 64


def _source_key(col: str | Column) -> Column:
    """Never null, and ordered as the sources are by code point with null last."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), c))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeat: int = 3) -> DataFrame:
    """(_src, source_size, target) from (_src, source_size)."""
    ranked = assign_dense_ids(sizes, ["_src"], "_rank", 0)
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    src = cut_lineage(ranked.select(
        "_src", "source_size", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")).alias("_w"),
        (F.col("source_size") * max_repeat).cast("double").alias("_cap")))
    level = 0.0
    while True:  # the level only rises, and each round but the last caps a source more
        full = F.col("_cap") < F.lit(level) * F.col("_w")
        all_words, capped, open_weight = src.agg(
            F.sum("source_size"), F.sum(F.when(full, F.col("_cap")).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("_w")))).first()
        risen = (all_words - capped) / open_weight if open_weight else level
        if not risen > level * (1 + 1e-12):
            break
        level = risen
    return src.select("_src", "source_size", F.least("_cap", F.lit(level) * F.col("_w")).alias("target"))


def _tilt(lam, size, scale, max_repeat: int):
    return F.least(F.lit(float(max_repeat)), F.exp(F.least(lam * size / scale, F.lit(50.0))))


def balance(hist: DataFrame, targets: DataFrame, max_repeat: int = 3, tolerance: float = 1e-7,
            max_rounds: int = 60) -> DataFrame:
    """(_src, _lam, _scale): the dual solution. ``hist``: (_src, size, n)."""
    scale = hist.where("size > 0").groupBy("_src").agg(
        (F.sum((F.col("n") * F.col("size") * F.col("size")).cast(EXACT)).cast("double")
         / F.sum(F.col("n") * F.col("size"))).alias("_scale"))
    state = cut_lineage(targets.where("source_size > 0").join(scale, "_src").select(
        "_src", "target", "_scale", F.lit(0.0).alias("_lam"),
        # a target at the cap takes every rate to max_repeat
        (F.col("target") >= F.col("source_size") * max_repeat * (1 - 1e-9)).alias("_full"),
        F.lit(-math.inf).alias("_lo"), F.lit(math.inf).alias("_hi"), F.lit(False).alias("_done")))
    for _ in range(max_rounds):
        x = F.col("size") / F.col("_scale")
        rate = _tilt(F.col("_lam"), F.col("size"), F.col("_scale"), max_repeat)
        words = F.col("n") * F.col("size") * rate
        sums = hist.where("size > 0").join(state.where("not _done and not _full"), "_src").groupBy("_src").agg(
            F.sum(words.cast(EXACT)).cast("double").alias("_f"),
            F.sum(F.when(rate < max_repeat, words * x).otherwise(0.0).cast(EXACT)).cast("double").alias("_df"))
        near = F.abs(F.col("_f") - F.col("target")) <= F.col("target") * tolerance
        lo = F.when(F.col("_f") <= F.col("target"), F.col("_lam")).otherwise(F.col("_lo"))
        hi = F.when(F.col("_f") >= F.col("target"), F.col("_lam")).otherwise(F.col("_hi"))
        step = F.col("_lam") - F.log(F.col("_f") / F.col("target")) * F.col("_f") / F.nullif(F.col("_df"), F.lit(0.0))
        inside = (step > F.col("_l")) & (step < F.col("_h"))
        middle = (F.when(F.col("_l") == -math.inf, F.col("_h") - F.greatest(F.lit(1.0), F.abs("_h")))
                  .when(F.col("_h") == math.inf, F.col("_l") + F.greatest(F.lit(1.0), F.abs("_l")))
                  .otherwise((F.col("_l") + F.col("_h")) / 2))
        moved = state.join(sums, "_src", "left").withColumn("_l", lo).withColumn("_h", hi)
        stop = F.col("_f").isNull() | near
        state = cut_lineage(moved.select(
            "_src", "target", "_scale",
            F.when(stop, F.col("_lam")).when(inside, step).otherwise(middle).alias("_lam"), "_full",
            F.col("_l").alias("_lo"), F.col("_h").alias("_hi"), stop.alias("_done")))
        if state.where("not _done").isEmpty():
            break
    else:
        raise ArithmeticError(f"{state.where('not _done').count()} sources are not balanced after {max_rounds} rounds")
    return state.select("_src", F.when(F.col("_full"), F.lit(math.inf)).otherwise(F.col("_lam")).alias("_lam"), "_scale")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[float, ...] = (5, 2, 1), max_repeat: int = 3) -> DataFrame:
    """Per row: id, size, source_size, target, copies, taken."""
    rows = docs.select(F.col(id_col).alias("_id"), _source_key(source_col).alias("_src"), _words(text_col).alias("size"))
    return _mixed(rows, weights, max_repeat).select(
        F.col("_id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _words(text_col: str | Column) -> Column:
    return F.regexp_count(whole_text(text_col), F.lit(WORD)).cast("long")


def _mixed(rows: DataFrame, weights: tuple[float, ...], max_repeat: int, more: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` (_id, _src, size and ``more``, which orders rows of one id) with source_size, target, copies."""
    rows = cut_lineage(rows)
    hist = cut_lineage(rows.groupBy("_src", "size").agg(F.count(F.lit(1)).alias("n")))
    targets = cut_lineage(source_targets(
        hist.groupBy("_src").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, max_repeat))
    dual = balance(hist, targets, max_repeat)
    # one row for each distinct size of a source: as many as the longest document has words at most
    before = Window.partitionBy("_src").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rate = _tilt(F.col("_lam"), F.col("size"), F.col("_scale"), max_repeat)
    tilted = hist.where("size > 0").join(dual, "_src").withColumn("_rate", rate.cast("decimal(16,12)"))
    plan = tilted.select("_src", "size", "_rate", F.coalesce(
        F.sum((F.col("n") * F.col("_rate")).cast("decimal(38,12)")).over(before), F.lit(0)).alias("_run"))
    plan = cut_lineage(plan)

    def passed(k, phase):
        return F.floor((F.col("_run") + k * F.col("_rate")).cast("double") + phase)

    tried = plan.join(hist, ["_src", "size"]).select(
        "_src", "size", "n", "_run", "_rate", F.explode(F.sequence(F.lit(0), F.lit(PHASES - 1))).alias("_p"))
    phase = F.col("_p") / float(PHASES)
    ends = tried.groupBy("_src", "_p").agg(
        F.sum(F.col("size") * (passed(F.col("n"), phase) - passed(F.lit(0), phase))).alias("_ends"))
    phases = ends.join(targets, "_src").groupBy("_src").agg(
        F.min_by(phase, F.struct(F.abs(F.col("_ends") - F.col("target")), F.col("_p"))).alias("_phase"))

    ranked = assign_dense_ids(rows, ["_src", "size", F.xxhash64("_id"), "_id", *more], "_pos", 0)
    first = ranked.groupBy("_src", "size").agg(F.min("_pos").alias("_first"))
    groups = first.join(plan, ["_src", "size"], "left").join(targets.join(phases, "_src", "left"), "_src")
    k = F.col("_pos") - F.col("_first")
    copies = F.coalesce(F.least(F.lit(max_repeat), passed(k + 1, F.col("_phase")) - passed(k, F.col("_phase"))),
                        F.lit(0)).cast("long")
    return ranked.join(groups, ["_src", "size"]).withColumn("copies", copies).select(
        "_id", *more, "size", "source_size", "target", "copies")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[float, ...] = (5, 2, 1), max_repeat: int = 3) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as the mix takes it. Rows are told
    apart by a number that one written scan gives them, so null and shared ids are rows like others."""
    folder = f"{ensure_checkpoint_dir(docs.sparkSession).rstrip('/')}/mixing-{uuid4().hex}"
    whole = docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"))
    whole.write.option("compression", "zstd").parquet(folder)
    held = docs.sparkSession.read.parquet(folder)
    text, source, key = (F.col("_doc").getField(c) for c in (text_col, source_col, id_col))
    rows = held.select(key.alias("_id"), _source_key(source).alias("_src"), _words(text).alias("size"), "_row")
    taken = _mixed(rows, weights, max_repeat, ("_row",)).where("copies > 0").select(F.col("_row").alias("_at"), "copies")
    return (held.join(taken, F.col("_row") == F.col("_at"))
            .select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).select("_doc.*"))
