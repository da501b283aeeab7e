"""Seeds, progress tracker, search results, snapshots, streaming = batch."""

import json
import os

import pytest
from pyspark.sql import functions as F

from linkledger.operators.frontier import validate_batch
from linkledger.operators.state import empty_state
from linkledger.sources import search as srch
from linkledger.sources.seeds import load_progress, next_seed_batch, read_json_array, save_progress
from linkledger.sources.changes import ChangeLog
from linkledger.sources.snapshots import latest_version, read_saved_pages, read_state, write_state
from linkledger.streaming.crawl_stream import validate_stream

SEEDS = [{"name": f"Test Restaurant {i}", "location": f"City {chr(64 + i)}", "source_url": f"http://example.com/{i}"}
         for i in range(1, 21)]


def test_json_array_batches_and_progress(spark, tmp_path):
    f = tmp_path / "seeds.json"
    f.write_text(json.dumps(SEEDS))
    seeds = read_json_array(spark, str(f))
    assert seeds.count() == 20
    prog = str(tmp_path / "progress")
    assert load_progress(spark, prog) == 0                      # missing tracker
    save_progress(spark, prog, 5, "2024-01-01T00:00:00")
    firsts = []
    for _ in range(3):
        b = next_seed_batch(spark, seeds, prog, "2024-01-01T00:00:00", batch_size=5).orderBy("pos").collect()
        firsts.append(b[0]["name"])
        assert all(r["initial_search"] for r in b)
    assert firsts == ["Test Restaurant 6", "Test Restaurant 11", "Test Restaurant 16"]
    save_progress(spark, prog, 19, "x")
    tail = next_seed_batch(spark, seeds, prog, "x", batch_size=3).collect()
    assert [r["name"] for r in tail] == ["Test Restaurant 20"]
    assert next_seed_batch(spark, seeds, prog, "x", batch_size=3).count() == 0


def test_corrupt_inputs(spark, tmp_path):
    bad = tmp_path / "bad.json"
    bad.write_text("[{\"name\": ")
    with pytest.raises(Exception):
        read_json_array(spark, str(bad)).collect()
    with pytest.raises(Exception):
        read_json_array(spark, str(tmp_path / "missing.json")).collect()
    junk = tmp_path / "prog"
    junk.mkdir()
    (junk / "part-0.parquet").write_text("not parquet")
    assert load_progress(spark, str(junk)) == 0


def test_search_results_and_queries(spark):
    seeds = spark.createDataFrame([(0, " Fancy Bistro ", "Paris ", True)], "pos long, name string, location string, initial_search boolean")
    q = [r["query"] for r in srch.search_queries(seeds).orderBy("query_idx").collect()]
    assert q == ["Fancy Bistro Paris restaurant review", 'review "Fancy Bistro" Paris']
    resp = spark.createDataFrame([
        (0, 1, json.dumps({"web": {"results": [{"url": "https://a.com"}, {"url": "https://b.com"}]}})),
        (0, 2, json.dumps({"web": {"results": [{"url": "https://a.com"}]}})),
        (0, 3, json.dumps({})),
    ], "pos long, query_idx int, body string")
    hits = srch.result_urls(resp)
    assert {(r["query_idx"], r["n_urls"]) for r in srch.hits_per_query(hits).collect()} == {(1, 2), (2, 1)}
    sh = srch.seed_hits(hits, seeds).collect()
    assert sorted(r["url"] for r in sh) == ["https://a.com", "https://b.com"] and all(r["relevance"] == 1.0 for r in sh)


def test_snapshots_and_saved_pages(spark, tmp_path):
    d = spark.createDataFrame([(1, "https://x.org/a", 0.5)], "seq long, url string, relevance double")
    st, _ = validate_batch(d, empty_state(spark), "2024-01-01 00:00:00")
    base = str(tmp_path / "state")
    assert latest_version(spark, base) is None
    write_state(st, base, 1)
    assert latest_version(spark, base) == 1
    back = read_state(spark, base, 1)
    assert back.url.first()["full_url"] == "https://x.org/a"
    pdir = tmp_path / "saved"
    pdir.mkdir()
    (pdir / "p1.json").write_text(json.dumps({"url": "https://a.com", "html": "<html>\n<body>x</body></html>"}, indent=2))
    assert read_saved_pages(spark, str(pdir)).first()["url"] == "https://a.com"


def test_saved_pages_are_read_in_rounds(spark, tmp_path, monkeypatch):
    """No read of the query has more files than a round, and every page has a file of its own."""
    import hashlib

    from linkledger.plans import catalog  # noqa: F401
    from linkledger.plans.registry import QUERIES
    from linkledger.sources import snapshots

    monkeypatch.setattr(snapshots, "PAGES_PER_FOLDER", 4)
    monkeypatch.setattr(snapshots, "FOLDERS_PER_ROUND", 2)
    reads = []

    def read(spark, path, plain=read_saved_pages):
        reads.append(plain(spark, path))
        return reads[-1]

    monkeypatch.setattr(snapshots, "read_saved_pages", read)
    rows = [(i, f"https://a.org/{i}", f"<p>é\n{i} \"x\"</p>") for i in range(19)]
    rows += [(19, None, "<p>"), (20, "https://a.org/n", None), (21, None, None), (3, *rows[3][1:])]
    (spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
     .write.parquet(str(tmp_path / "pages.parquet")))
    got = [tuple(r) for r in QUERIES["saved_pages"](spark, str(tmp_path)).collect()]
    exp = [(u, h and hashlib.md5(h.encode()).hexdigest(), h and len(h)) for _, u, h in rows]
    assert sorted(got, key=str) == sorted(exp, key=str)
    files = [f for df in reads for f in df.inputFiles()]
    assert len(reads) >= 3 and max(len(df.inputFiles()) for df in reads) <= 8
    assert len(files) == len(set(files)) == len(rows)
    assert spark.conf.get(snapshots.LISTING_CACHE) != "0"


def test_saved_pages_of_an_empty_table(spark, tmp_path):
    from linkledger.plans import catalog  # noqa: F401
    from linkledger.plans.registry import QUERIES

    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    out = QUERIES["saved_pages"](spark, str(tmp_path))
    assert out.columns == ["url", "html_md5", "n_chars"] and out.collect() == []


def test_stream_equals_batch_across_micro_batches(spark, tmp_path):
    rows = [(i, f"https://d{i % 3}.example.org/p{i % 7}?q={i}", ((i * 7) % 11) / 10.0) for i in range(60)]
    src = tmp_path / "landed"
    df = spark.createDataFrame(rows, "seq long, url string, relevance double")
    df.where("seq < 30").coalesce(1).write.parquet(str(src / "b1"))
    df.where("seq >= 30").coalesce(1).write.parquet(str(src / "b2"))
    stream = (spark.readStream.schema("seq long, url string, relevance double").option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(str(src)))
    st = validate_stream(spark, stream, lambda b: b, str(tmp_path / "state"), str(tmp_path / "ckpt"),
                         "2024-01-01 00:00:00")
    assert ChangeLog(spark, str(tmp_path / "state")).version() == 2
    batch, _ = validate_batch(df, empty_state(spark), "2024-01-01 00:00:00")
    got = {r["domain_name"]: (r["visit_count"], round(r["quality_score"], 9)) for r in st.domain.collect()}
    exp = {r["domain_name"]: (r["visit_count"], round(r["quality_score"], 9)) for r in batch.domain.collect()}
    assert got == exp
    assert {r["full_url"] for r in st.url.collect()} == {r["full_url"] for r in batch.url.collect()}


def test_round_stream_references(spark, tmp_path):
    from linkledger.plans.rounds import gazetteer_extractor, run_round
    from linkledger.streaming.crawl_stream import round_stream

    html = ("<html><head><title>{t}</title></head><body><nav><a href='/menu'>m</a></nav>"
            "<h1>{t}</h1><p>A review of {t} and its chef, with the wine list.</p></body></html>")
    pages = [("https://food.org/a", 200, html.format(t="Fancy Bistro")),
             ("https://eat.com/b", 200, html.format(t="Chez Olivia")),
             ("https://eat.com/c", 503, "")]
    fetched = spark.createDataFrame([(k, *p) for k, p in enumerate(pages)],
                                    "page_id long, full_url string, status int, html string")
    entity = spark.createDataFrame([(1, "Fancy Bistro", "Paris"), (2, "Chez Olivia", None)],
                                   "entity_id long, name string, address string")
    vocab = spark.createDataFrame([("Fancy Bistro",), ("Chez Olivia",), ("Le Nope",)], "name string")
    rows = [(1, "https://food.org/a?x=1", 0.9), (2, "https://eat.com/b", 0.8), (3, "https://eat.com/c", 0.7)]
    src = tmp_path / "landed"
    df = spark.createDataFrame(rows, "seq long, url string, relevance double")
    df.where("seq = 1").coalesce(1).write.parquet(str(src / "b1"))
    df.where("seq > 1").coalesce(1).write.parquet(str(src / "b2"))
    stream = (spark.readStream.schema("seq long, url string, relevance double").option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(str(src)))
    st = round_stream(spark, stream, lambda b: b, fetched, gazetteer_extractor(vocab), str(tmp_path / "state"),
                      str(tmp_path / "ckpt"), "2024-01-01 00:00:00", initial=empty_state(spark, entity),
                      feedback_dir=str(tmp_path / "fb"))
    refs = {(r["entity_id"], r["url_id"]) for r in st.reference.collect()}
    assert refs == {(1, 1), (2, 2)}
    # the 503 page stays queued with a decayed priority, parsed pages leave the queue
    q = st.url_queue.collect()
    assert [r["url_id"] for r in q] == [3] and q[0]["priority"] == 0.75 and q[0]["priority_int"] == 1
    batch = run_round(empty_state(spark, entity), df, fetched, gazetteer_extractor(vocab), "2024-01-01 00:00:00")
    assert {(r["entity_id"], r["url_id"]) for r in batch.references.collect()} == refs
    fb = spark.read.parquet(str(tmp_path / "fb")).collect()
    assert {r["url"] for r in fb} >= {"https://food.org/", "https://food.org/menu", "https://eat.com/menu"}
