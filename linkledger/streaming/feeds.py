"""The feeds of a continuous run, each a streaming query with a checkpoint of its own.

    seeds      JSON Lines -> flagged seed batches, and the search queries that they ask
    responses  landed answers -> discovered URLs of the queries that were asked
    pages      landed fetches -> profiles; html is parsed once, when it lands
    rounds     discovered URLs and fed-back links -> one crawl round a micro-batch

A feed hands on to the next one through a folder with a subfolder for each of its
batches, which a batch that is run again overwrites, so each row is handed on once whatever
fails between. The links that a round finds land in the folder that the rounds read from:
what one call of ``drain`` feeds back is the input of the next.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scoring import seed_relevance
from ..operators.html_profile import profile_pages
from ..operators.state import GraphState, assign_dense_ids
from ..sources.search import result_urls, search_queries
from ..sources.seeds import SEED_SCHEMA
from .crawl_stream import _run, round_stream

SEEDS = "pos long, " + SEED_SCHEMA
RESPONSES = "pos long, query_idx int, body string"
PAGES = "page_id long, full_url string, status int, html string"
DISCOVERED = "seq long, url string, relevance double"
#: Numbers of discovered URLs that a batch of answers may give out.
BATCH_NUMBERS = 1 << 24


def _landed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What all batches of a feed have handed on."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def seed_stream(spark: SparkSession, landed: str, out: str, checkpoint: str, files_per_batch: int | None = None) -> None:
    """A2: seed records as they land, handed on as initial searches, each once."""
    source = spark.readStream.schema(SEEDS)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)

    def hand_on(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("initial_search", F.lit(True)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run(source.option("mode", "FAILFAST").json(landed), hand_on, checkpoint)


@dataclass(frozen=True)
class Feeds:
    """Folders of the landed inputs, and ``work`` for what the feeds hand on."""

    seeds: str
    responses: str
    pages: str
    work: str

    def _at(self, name: str) -> str:
        return f"{self.work.rstrip('/')}/{name}"

    def ask(self, spark: SparkSession) -> DataFrame:
        """The search queries of all seeds so far: (pos, query_idx, query)."""
        seed_stream(spark, self.seeds, self._at("seeds"), self._at("checkpoints/seeds"))
        return search_queries(_landed(spark, self._at("seeds"), SEEDS + ", initial_search boolean"))

    def discover(self, spark: SparkSession) -> None:
        """Answers to queries that were asked: distinct hits of a seed in a batch, numbered by seed and URL."""
        seeds = _landed(spark, self._at("seeds"), SEEDS + ", initial_search boolean")

        def hand_on(batch: DataFrame, batch_id: int) -> None:
            asked = search_queries(seeds).select("pos", "query_idx")
            hits = (result_urls(batch.join(asked, ["pos", "query_idx"], "left_semi")).select("pos", "url").distinct()
                    .join(seeds.select("pos", "initial_search").distinct(), "pos"))
            numbered = assign_dense_ids(hits, ["pos", "url"], "seq", 1 + batch_id * BATCH_NUMBERS)
            numbered.select("seq", "url", seed_relevance("initial_search").alias("relevance")).write.mode("overwrite").parquet(
                f"{self._at('discovered')}/found-batch={batch_id}")

        _run(spark.readStream.schema(RESPONSES).json(self.responses), hand_on, self._at("checkpoints/responses"))

    def read_pages(self, spark: SparkSession) -> None:
        """Fetches with their profile in the place of their html."""
        def hand_on(batch: DataFrame, batch_id: int) -> None:
            profile_pages(batch, ["page_id", "full_url", "status"]).write.mode("overwrite").parquet(
                f"{self._at('pages')}/batch={batch_id}")

        _run(spark.readStream.schema(PAGES).parquet(self.pages), hand_on, self._at("checkpoints/pages"))

    def rounds(self, spark: SparkSession, extractor, as_of: str, initial: GraphState | None = None) -> GraphState:
        """A round over what is discovered or fed back and has not been in a round."""
        pages = spark.read.option("recursiveFileLookup", "true").parquet(self._at("pages"))
        found = spark.readStream.schema(DISCOVERED).option("recursiveFileLookup", "true").parquet(self._at("discovered"))
        return round_stream(spark, found, lambda batch: batch, pages, extractor, self._at("state"),
                            self._at("checkpoints/rounds"), as_of, initial, feedback_dir=f"{self._at('discovered')}/fed-back")

    def drain(self, spark: SparkSession, extractor, as_of: str, initial: GraphState | None = None) -> GraphState:
        """All that has landed, once through; the state after it."""
        self.ask(spark)
        self.discover(spark)
        self.read_pages(spark)
        return self.rounds(spark, extractor, as_of, initial)
