"""Feeds of a continuous run against the batch jobs."""

import json

from pyspark.sql import functions as F

from linkledger.operators.state import empty_state
from linkledger.plans.rounds import discovered_from_search, gazetteer_extractor, run_round
from linkledger.streaming.feeds import Feeds, seed_stream

AS_OF = "2024-01-01 00:00:00"
HTML = ("<html><head><title>{t}</title></head><body><nav><a href='/{n}'>m</a></nav>"
        "<h1>{t}</h1><p>A review of {t} and its chef, with the wine list.</p></body></html>")
PAGES = [("https://food.org/a", 200, "Fancy Bistro", "menu"), ("https://eat.com/b", 200, "Chez Olivia", "more"),
         ("https://eat.com/c", 503, "Chez Olivia", "x"), ("https://food.org/menu", 200, "Chez Olivia", "a"),
         ("https://eat.com/", 200, "Fancy Bistro", "b")]


def rows_of(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def test_seeds_are_handed_on_once(spark, tmp_path):
    landed, out = tmp_path / "landed", str(tmp_path / "out")
    landed.mkdir()

    def land(k, lo, hi):
        (landed / f"{k}.json").write_text("".join(
            json.dumps({"pos": p, "name": f"n{p}", "location": None, "source_url": ""}) + "\n" for p in range(lo, hi)))

    def handed():
        return sorted(r["pos"] for r in spark.read.option("recursiveFileLookup", "true").parquet(out).where("initial_search").collect())
    land("a", 0, 7)
    land("b", 7, 9)
    seed_stream(spark, str(landed), out, str(tmp_path / "ckpt"), files_per_batch=1)
    assert handed() == list(range(9))
    land("c", 9, 12)
    seed_stream(spark, str(landed), out, str(tmp_path / "ckpt"), files_per_batch=1)
    # a commit that was lost: the batch is run again and overwrites its own folder
    (tmp_path / "ckpt" / "commits" / "2").unlink()
    (tmp_path / "ckpt" / "commits" / ".2.crc").unlink()
    seed_stream(spark, str(landed), out, str(tmp_path / "ckpt"), files_per_batch=1)
    assert handed() == list(range(12))


def test_feeds_with_feedback_equal_the_batch_jobs(spark, tmp_path):
    for name in ("seeds", "responses", "pages"):
        (tmp_path / name).mkdir()
    seeds = [(0, "Fancy Bistro", "Paris", ""), (1, "Chez Olivia", "Rome", "")]
    (tmp_path / "seeds" / "a.json").write_text("".join(json.dumps(dict(zip(("pos", "name", "location", "source_url"), s))) + "\n" for s in seeds))
    body = lambda *urls: json.dumps({"web": {"results": [{"url": u} for u in urls]}})
    answers = [(0, 1, body("https://food.org/a?x=1", "https://eat.com/b")), (1, 2, body("https://eat.com/c", "https://eat.com/b")),
               (7, 1, body("https://not.asked/"))]
    (tmp_path / "responses" / "a.json").write_text("".join(json.dumps(dict(zip(("pos", "query_idx", "body"), a))) + "\n" for a in answers))
    fetched = spark.createDataFrame([(k, u, s, HTML.format(t=t, n=n)) for k, (u, s, t, n) in enumerate(PAGES)],
                                    "page_id long, full_url string, status int, html string")
    fetched.write.mode("append").parquet(str(tmp_path / "pages"))
    entity = spark.createDataFrame([(1, "Fancy Bistro", "Paris"), (2, "Chez Olivia", None)], "entity_id long, name string, address string")
    extract = gazetteer_extractor(entity.select("name"))
    feeds = Feeds(*(str(tmp_path / x) for x in ("seeds", "responses", "pages", "work")))
    feeds.drain(spark, extract, AS_OF, empty_state(spark, entity))
    two = feeds.drain(spark, extract, AS_OF, empty_state(spark, entity))        # what the first fed back

    records = spark.createDataFrame(seeds, "pos long, name string, location string, source_url string").withColumn("initial_search", F.lit(True))
    found = discovered_from_search(records, spark.createDataFrame(answers, "pos long, query_idx int, body string"))
    first = run_round(empty_state(spark, entity), found, fetched, extract, AS_OF)
    second = run_round(first.state, first.feedback.select("seq", "url", "relevance"), fetched, extract, AS_OF)
    for table, df in second.state.tables().items():
        assert rows_of(two.tables()[table]) == rows_of(df), table
    assert {r["entity_id"] for r in two.reference.collect()} == {1, 2} and two.reference.count() > first.references.count()
