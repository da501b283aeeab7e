"""SimHash near-dedup: majority fingerprints over word shingles, linked when few bits differ.

Candidates come from a segment-popcount embedding. A fingerprint maps to the
bit counts of its sixteen 4-bit segments; a differing bit moves one count by
one, so the Manhattan distance of two embeddings never exceeds the number of
differing bits. Both sides cover the grid cells around their point, up to radii
that add up to the maximum distance: the balls of two points meet in a cell
exactly when their Manhattan distance is within it. Cells are an equi-join key,
and a pair is verified on the fingerprints as it meets, so nothing within the
distance is lost and no pair beyond it leaves the join.

Copies collapse first: the join sees each distinct fingerprint once. The number
of cells around a point depends on the maximum distance alone (33 for two bits).

Defined results: null or blank text has fingerprint zero and is linked like any
other; fewer words than a shingle make one shingle; a null id is never smallest;
rows that repeat are in one component; an empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import map_texts
from .components import components

SEED = 42
SEGMENTS = 16
#: Shingle hashes that are counted at once, which bounds the memory of a long text.
BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """A bit is 1 if it is set in over half the shingles' XXH64; unsigned."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # on bytes, both see ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, n, BLOCK):
        h = np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts[k:k + BLOCK], ends[k:k + BLOCK])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp long) per row."""
    def start():
        return lambda texts: (None, [np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)])

    return map_texts(docs, id_col, text_col, start, "fp long")


def _embedding(fp: Column) -> Column:
    """The sixteen segment counts as the digits of a base-16 number."""
    ones = F.lit(0x1111111111111111)
    return sum((F.shiftrightunsigned(fp, k).bitwiseAND(ones) for k in range(1, 4)), fp.bitwiseAND(ones))


def _ball(radius: int) -> list[int]:
    """Offsets, as base-16 numbers, of all grid points within a Manhattan radius."""
    reach = {(0,) * SEGMENTS}
    for _ in range(radius):
        reach |= {p[:i] + (p[i] + d,) + p[i + 1:] for p in reach for i in range(SEGMENTS) for d in (-1, 1)}
    return sorted(sum(d << 4 * i for i, d in enumerate(p)) for p in reach)


def near_pairs(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b) with a < b: all pairs of the distinct fingerprints ``fp`` that differ in
    1 to ``max_bits`` bits. Digits stay distinct in the cell number up to radius 3."""
    if not 0 <= max_bits <= 6:
        raise ValueError("max_bits must be 0 to 6")

    def cells(radius: int, name: str) -> DataFrame:
        offsets = F.explode(F.array(*(F.lit(x).cast("long") for x in _ball(radius))))
        return (fps.select(F.col("fp").alias(name), _embedding(F.col("fp")).alias("_e"), offsets.alias("_o"))
                .select(name, (F.col("_e") + F.col("_o")).alias("_cell")))

    wide, narrow = (max_bits + 1) // 2, max_bits // 2
    apart = F.col("x") < F.col("y") if wide == narrow else F.col("x") != F.col("y")
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits
    met = cells(wide, "x").alias("l").join(
        cells(narrow, "y").alias("r"), (F.col("l._cell") == F.col("r._cell")) & apart & near)
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits), component_id (the smallest id that
    links reach, its own included)."""
    rows = cut_lineage(fingerprints(docs, id_col, text_col, shingle))
    fps = cut_lineage(rows.groupBy("fp").agg(F.min("_id").alias("_least")))
    member = components(near_pairs(fps, max_bits), "a", "b").select(F.col("node").alias("fp"), "component")
    named = fps.join(member, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("_least").alias("component_id"))
    named = named.select("fp", "component").join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp").select(
        F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: Ids to drop that are broadcast at most; more are joined.
BROADCAST_IDS = 1 << 20


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                max_bits: int = 2) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose id is the smallest of their
    component. Rows with a null id are no one's copy and stay."""
    groups = simhash_components(docs, id_col, text_col, shingle, max_bits)
    copies = cut_lineage(groups.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_copy")).distinct())
    # whole texts are shuffled only where the ids of what goes are too many
    copies = F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies
    return docs.join(copies, F.col(id_col) == F.col("_copy"), "left_anti")
