"""Exact dedup: group by a 128-bit content hash, compare bytes inside the groups,
keep the row with the smallest id.

One shuffle carries each distinct text once per map task (grouping on hash and
bytes collapses a hot group of copies before it moves); the other two carry
hashes. All of it is built-in functions.

Defined results: null text counts as empty; a null id is never smallest (a class
of null ids only has a null ``keep_id``, and its rows stay); rows that repeat an
id and its text are all marked as the kept row, and ``drop_copies`` leaves one of
them; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import one_space, whole_text


def content_hash(text: Column) -> Column:
    """128 bits over the UTF-8 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    ``digest`` only routes and groups: texts that share it and differ in bytes
    fall into different classes."""
    norm = docs.select(F.col(id_col).alias("_id"), one_space(whole_text(text_col)).alias("_norm"))
    rows = norm.select("_id", digest(F.col("_norm")).alias("_h"),
                       F.unhex(F.sha2(F.col("_norm").cast("binary"), 256)).alias("_s"))
    classes = (norm.groupBy(digest(F.col("_norm")).alias("_h"), "_norm")
               .agg(F.min("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .select("_h", F.unhex(F.sha2(F.col("_norm").cast("binary"), 256)).alias("_s"), "keep_id", "group_size"))
    # a hot class is one row on the right, and its rows on the left are split by adaptive execution
    return (rows.join(classes, ["_h", "_s"])
            .select(F.col("_id").alias(id_col), "keep_id", "group_size",
                    F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("_s")).alias("text_sha256")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows of ``docs`` with all their columns, one row for each class.

    The join and the last step, which leaves one of rows that repeat, need the same
    partitioning, so texts move twice in all."""
    norm = one_space(whole_text(text_col))
    never_null = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))
    kept = (docs.select(F.col(id_col).alias("_id"), norm.alias("_norm"))
            .groupBy(content_hash(F.col("_norm")).alias("_h"), "_norm")
            .agg(F.min("_id").alias("_keep"))
            .select(F.coalesce(F.concat(F.lit("="), F.col("_keep").cast("string")), F.lit("")).alias("_key"), "_h"))
    return (docs.withColumn("_key", never_null).withColumn("_h", content_hash(norm))
            .join(kept, ["_key", "_h"], "left_semi")
            .dropDuplicates(["_key", "_h"]).drop("_key", "_h"))
