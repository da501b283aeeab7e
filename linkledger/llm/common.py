"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the operators understand it.
BLANK = r"[\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(col: str | Column = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def one_space(text: Column) -> Column:
    """Every run of ASCII white space becomes one space. Single spaces, by far the
    most common runs, are left to stand, so the pattern rarely matches."""
    return F.regexp_replace(text, rf"[\x09-\x0D]{BLANK}*|\x20{BLANK}+", " ")


def hash_fold(key: str | Column, folds: int = 5) -> Column:
    """crc32 of the key as text, modulo ``folds``: which fold a row is held out in."""
    c = F.col(key) if isinstance(key, str) else key
    return F.crc32(c.cast("string").cast("binary")) % folds


def _run_texts(batches: Iterator[pa.RecordBatch], start: Callable, names: list[str]) -> Iterator[pa.RecordBatch]:
    work = start()
    for b in batches:
        rows, columns = work(b.column(1).to_pylist())
        ids = b.column(0) if rows is None else b.column(0).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, *(c if isinstance(c, pa.Array) else pa.array(c) for c in columns)],
                                         names=["_id", *names])


def map_texts(docs: DataFrame, id_col: str, text_col: str, start: Callable[[], Callable[[list[str]], Any]],
              fields: str) -> DataFrame:
    """Python over batches of whole texts; ids of any type pass by unseen, null or not.

    ``start`` is called once in a task and gives the function for its batches: a list
    of texts to (row numbers, or None for one row a text; the columns of ``fields``)."""
    src = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    names = [f.split()[0] for f in fields.split(", ")]
    return src.mapInArrow(partial(_run_texts, start=start, names=names),
                          f"_id {src.schema['_id'].dataType.simpleString()}, {fields}")
