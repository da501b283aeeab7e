"""A1-A3: seed records and resumable batches.

A seed file is one top-level JSON array (read whole, so one task per file) or,
for large inputs, JSON Lines with an explicit ``pos`` column (split by Spark).
Position is the contract: records keep their index in the file. Progress is a
one-row table (last_index, date_time) stored next to the job's other state;
it is saved before the batch is handed on (at-most-once), a missing or
unreadable tracker counts as 0.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED_SCHEMA = "name string, location string, source_url string"


def read_json_array(spark: SparkSession, path: str, schema: str = SEED_SCHEMA) -> DataFrame:
    """Items of a top-level JSON array with their 0-based position. A missing
    file raises (path not found); malformed JSON raises (FAILFAST)."""
    raw = spark.read.text(path, wholetext=True)
    arr = F.from_json("value", f"array<struct<{schema.replace(' string', ':string')}>>", {"mode": "FAILFAST"})
    return raw.select(F.posexplode(arr).alias("pos", "item")).select(F.col("pos").cast("long"), "item.*")


def read_json_lines(spark: SparkSession, path: str, schema: str = "pos long, " + SEED_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def seed_batch(seeds: DataFrame, last_index: int, batch_size: int = 10) -> DataFrame:
    """[last_index, last_index + batch_size) by position, flagged as an initial search."""
    return (seeds.where((F.col("pos") >= last_index) & (F.col("pos") < last_index + batch_size))
            .withColumn("initial_search", F.lit(True)))


def load_progress(spark: SparkSession, path: str) -> int:
    """0 for a tracker that is missing or is no table with that column; storage errors are raised."""
    try:
        rows = spark.read.parquet(path).select("last_index").collect()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "UNRESOLVED_COLUMN.WITH_SUGGESTION",
                                "UNRESOLVED_COLUMN.WITHOUT_SUGGESTION"):
            return 0
        raise
    except (PySparkException, Py4JJavaError) as e:
        if "FAILED_READ_FILE.CANNOT_READ_FILE_FOOTER" in str(e) or "is not a Parquet file" in str(e):
            return 0
        raise
    return int(rows[0]["last_index"]) if rows and rows[0]["last_index"] is not None else 0


def save_progress(spark: SparkSession, path: str, last_index: int, as_of: str) -> None:
    (spark.createDataFrame([(int(last_index), as_of)], "last_index long, date_time string")
     .coalesce(1).write.mode("overwrite").parquet(path))


def next_seed_batch(spark: SparkSession, seeds: DataFrame, progress_path: str, as_of: str,
                    batch_size: int = 10) -> DataFrame:
    """A2: read the tracker, save the advanced index, return the batch."""
    last = load_progress(spark, progress_path)
    batch = seed_batch(seeds, last, batch_size)
    n = batch.count()
    save_progress(spark, progress_path, last + n, as_of)
    return batch
