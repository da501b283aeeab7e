"""linkledger: entity-mention and source-authority analytics as Spark DataFrame jobs.

Layout
------
functions/  Column -> Column rules (URL parsing, scores, trigram sets)
sources/    scans of landed inputs and snapshot sinks
operators/  DataFrame -> DataFrame jobs (frontier, quality fold, pages,
            similarity join, resolution, load, ranking)
plans/      composed jobs: one crawl round, test-data inputs, registered queries
streaming/  Structured Streaming drivers over the same batch jobs
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
