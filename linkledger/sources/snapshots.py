"""Landed page scans and versioned parquet snapshots of the graph tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import SCHEMAS, GraphState, check_constraints

PAGE_SCHEMA = "url string, html string"
PAGES_PER_FOLDER = 256       # saved pages that a folder holds at most
FOLDERS_PER_ROUND = 64       # folders read at a time; Spark lists more than 32 in tasks
LISTING_CACHE = "spark.sql.hive.filesourcePartitionFileCacheSize"


def read_saved_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One ``{url, html}`` JSON document per file."""
    return spark.read.schema(PAGE_SCHEMA).option("multiLine", True).json(path)


def write_saved_pages(pages: DataFrame, path: str) -> None:
    """One ``{url, html}`` JSON document per file, in folders of at most
    ``PAGES_PER_FOLDER``, each of one task; the driver moves folders, not files."""
    doc = F.to_json(F.struct("url", "html"), {"pretty": "true"}).alias("value")
    folder = F.expr(f"monotonically_increasing_id() div {PAGES_PER_FOLDER}").alias("folder")
    pages.select(doc, folder).write.option("maxRecordsPerFile", 1).partitionBy("folder").text(path)


def read_saved_folders(spark: SparkSession, path: str, to: str, made_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``made_of`` makes, row by row, of the pages that ``write_saved_pages``
    left below ``path``, landed as parquet at ``to``. A read keeps a record of each of its
    files in the driver, so folders are read in rounds and the driver
    never holds more than the files of one."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    folders = [f.getPath().toString() for f in listed if f.isDirectory()]
    if not folders:
        return made_of(read_saved_pages(spark, path))
    cores = spark.sparkContext.defaultParallelism
    step = max(FOLDERS_PER_ROUND, cores // 4)      # with very many cores, 64 files for each
    kept = spark.conf.get(LISTING_CACHE)
    spark.conf.set(LISTING_CACHE, "0")             # else 250 MB of listings outlive their rounds
    try:
        for k in range(0, len(folders), step):
            pages = read_saved_pages(spark, folders[k:k + step])
            made_of(pages).coalesce(max(step, cores)).write.mode("append").parquet(to)
    finally:
        spark.conf.set(LISTING_CACHE, kept)
    return spark.read.parquet(to)


def write_state(state: GraphState, base: str, version: int) -> str:
    """Every table under ``base/v=<version>/<table>``; the version is recorded
    in ``base/_versions`` only after all tables are written, so a reader never
    sees a partial snapshot and a rerun of the same version overwrites it. A state
    that breaks a constraint is not committed."""
    spark = state.domain.sparkSession
    root = f"{base.rstrip('/')}/v={int(version)}"
    for name, df in state.tables().items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    check_constraints(read_state(spark, base, version))
    spark.createDataFrame([(int(version),)], "version long").write.mode("append").parquet(f"{base.rstrip('/')}/_versions")
    return root


def read_state(spark: SparkSession, base: str, version: int) -> GraphState:
    root = f"{base.rstrip('/')}/v={int(version)}"
    return GraphState(**{name: spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}") for name in SCHEMAS})


def latest_version(spark: SparkSession, base: str) -> int | None:
    """Highest committed snapshot version under ``base`` (None if there is none)."""
    try:
        versions = spark.read.parquet(f"{base.rstrip('/')}/_versions")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":      # only a missing manifest means that nothing is committed
            raise
        return None
    v = versions.agg({"version": "max"}).first()[0]
    return None if v is None else int(v)
