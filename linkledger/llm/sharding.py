"""Sharding by proportional stratified interleaving.

Rows are shuffled within their source: they are sorted by source and a seeded hash of
their id and text, so the rank of a row within its source is its place in the shuffle.
A row's fractional rank, (rank + phase of its source) / rows of the source, spreads
every source evenly over [0, 1). All rows are sorted by it and cut into runs of equal
count, so each shard holds each source in the proportion that the whole has, to
within a few rows, and shard sizes differ by one row at most (law ``rows``). The phase,
a hash of the source, keeps sources of one or two rows from meeting in the middle.

Both sorts are range-partitioned over all rows, so a source with most rows is spread
like any other; nothing is grouped in one task. The text is read once, in the first
scan. Copies are rows like others: this law places rows, it does not keep equal texts
together.

Defined results: null text has no bytes, so size 8 and checksum 0; a null source is a
source of its own; null ids and repeated rows are placed like others (rows equal in id,
size and checksum may change places); with fewer rows than shards, some shards stay
empty; an empty table gives an empty result. Other columns are not read, unless asked
for as ``row``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.state import assign_dense_ids
from ..session import cut_lineage
from .common import whole_text

SHARDS = 24
SEED = 20_011


def shard_rows(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", seed: int = SEED, whole: bool = False) -> DataFrame:
    """Per row: id, size, text_crc32, law, shard, slot, grown_shard; with ``whole`` also
    ``row``, a struct of all its columns, which then travels through both sorts."""
    text = whole_text(text_col)
    carried = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if whole else []
    rows = cut_lineage(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), *carried))
    mixed = F.xxhash64(F.lit(seed), F.col("_id"), F.col("text_crc32"), F.col("size"))
    shuffled = assign_dense_ids(rows.withColumn("_mixed", mixed),
                                ["_source", "_mixed", "_id", "text_crc32", "size"], "_pos", 0)
    sources = shuffled.groupBy(F.col("_source").alias("_of")).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    phase = F.pmod(F.xxhash64(F.lit(seed), F.col("_of")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    ranked = shuffled.join(sources, F.col("_source").eqNullSafe(F.col("_of"))).withColumn(
        "_at", (F.col("_pos") - F.col("_first") + phase) / F.col("_rows"))
    woven = assign_dense_ids(ranked.drop("_of", "_first", "_rows", "_mixed"), ["_at", "_pos"], "_place", 0)
    total = F.lit(rows.count())
    # place p goes to shard floor(p * shards / total), so shard s begins at ceil(s * total / shards)
    shard = F.call_function("div", F.col("_place") * shards, total)
    first = F.call_function("div", shard * total + (shards - 1), F.lit(shards))
    return woven.select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"), (F.col("_place") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *(["row"] if whole else []))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source", seed: int = SEED) -> None:
    """The rows themselves, with ``slot`` and ``row``, in a folder ``shard=<k>`` for each shard,
    where files and the rows in them follow the order of the slots. A shard may be many files."""
    placed = shard_rows(docs, shards, id_col, text_col, source_col, seed, whole=True)
    (placed.select("shard", "slot", "row").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
