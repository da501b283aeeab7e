"""Operators on small literal fixtures: fold monoid, frontier, status routing,
queues, similarity join vs brute force, PageRank, pages, dense ids."""

import random

import pytest
from pyspark.sql import functions as F

from linkledger.functions import trigram
from linkledger.operators import frontier as fr
from linkledger.operators import pages as pg
from linkledger.operators import state as stt
from linkledger.operators.html_profile import profile_html, profile_pages
from linkledger.operators.quality import quality_fold, quality_fold_plain
from linkledger.operators.rank import bipartite_authority, pagerank
from linkledger.operators.similarity import fuzzy_best_match


def python_fold(rels, start=None, step=0.1):
    q = start
    for r in rels:
        q = 0.0 if q is None else max(-1.0, min(q + step * (r - 0.5), 1.0))
    return q


def test_quality_monoid_equals_plain_fold(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["a", "b", "hot"]) if i % 3 else "hot", i, rnd.choice([0.0, 0.3, 0.9, 4.0, 40.0, -3.0]))
            for i in range(600)]
    ev = spark.createDataFrame(rows, "domain string, seq long, relevance double")
    tree = {r["domain"]: (r["visit_count"], r["quality_score"])
            for r in quality_fold(ev, chunk_size=7, fan_in=3).collect()}
    plain = {r["domain"]: (r["visit_count"], r["quality_score"]) for r in quality_fold_plain(ev).collect()}
    for d, (n, q) in plain.items():
        expect = python_fold([r for dd, _, r in sorted(rows, key=lambda x: x[1]) if dd == d])
        assert tree[d][0] == n
        assert tree[d][1] == pytest.approx(expect, abs=1e-12)
        assert q == pytest.approx(expect, abs=1e-12)


def test_quality_fold_continues_from_state(spark):
    ev = spark.createDataFrame([("a", 1, 0.9), ("a", 2, 0.1), ("n", 3, 0.7)], "domain string, seq long, relevance double")
    st = spark.createDataFrame([("a", 5, 0.2)], "domain string, visit_count long, quality_score double")
    out = {r["domain"]: r for r in quality_fold(ev, st).collect()}
    assert out["a"]["visit_count"] == 7 and not out["a"]["is_new"]
    assert out["a"]["quality_score"] == pytest.approx(python_fold([0.9, 0.1], start=0.2))
    assert out["n"]["visit_count"] == 1 and out["n"]["quality_score"] == 0.0 and out["n"]["is_new"]


def test_validate_new_and_known_url(spark):
    st0 = stt.empty_state(spark)
    d1 = spark.createDataFrame([(1, "https://example.com/review?x=1", 0.9)], "seq long, url string, relevance double")
    st1, q1 = fr.validate_batch(d1, st0, "2024-01-01 00:00:00")
    dom = st1.domain.first()
    assert (dom["domain_name"], dom["visit_count"], dom["quality_score"]) == ("example.com", 1, 0.0)
    row = q1.first()
    assert row["full_url"] == "https://example.com/review" and 0 < row["priority"] <= 1
    # known URL: visits and quality move, nothing new is queued
    st1b = st1.with_(domain=st1.domain.withColumn("visit_count", F.lit(5).cast("long"))
                     .withColumn("quality_score", F.lit(0.2)))
    d2 = spark.createDataFrame([(2, "https://example.com/review#top", 0.7)], "seq long, url string, relevance double")
    st2, q2 = fr.validate_batch(d2, st1b, "2024-01-02 00:00:00")
    assert q2.count() == 0
    dom = st2.domain.first()
    assert dom["visit_count"] == 6 and dom["quality_score"] == pytest.approx(0.22)
    assert st2.url.first()["last_crawled"].isoformat().startswith("2024-01-02")
    assert st2.url.count() == 1 and st2.source.count() == 1


def test_status_routing(spark):
    front = spark.createDataFrame([(1, "u1", 50), (2, "u2", 50), (3, "u3", 80), (4, "u4", 75), (5, "u5", 20)],
                                  "url_id long, full_url string, priority_int int")
    fetched = spark.createDataFrame([("u2", 404, 1), ("u3", 503, 2), ("u4", 200, 3), ("u5", 501, 4), ("u4", 404, 5),
                                     ("u4", 200, 3)], "full_url string, status int, fetch long")
    routed = fr.route_fetched(front, fetched, "fetch").collect()
    assert len(routed) == 5
    out = {r["url_id"]: (r["action"], r["new_priority"]) for r in routed}
    assert out == {1: ("remove", None), 2: ("remove", None), 3: ("demote", 60.0), 4: ("parse", None), 5: ("parse", None)}


def test_queue_head_upsert_update_remove(spark):
    urlt = spark.createDataFrame([(1, "https://a/1"), (2, "https://a/2")], "url_id long, full_url string")
    q = spark.createDataFrame([(1, 10.0, 10), (2, 80.0, 80)], "url_id long, priority double, priority_int int")
    assert fr.frontier_head(q, urlt).first()["priority_int"] == 80
    q2 = stt.queue_update(q, spark.createDataFrame([(1, 99.0, 99), (7, 5.0, 5)], "url_id long, priority double, priority_int int"), "url_id")
    assert {r["url_id"]: r["priority_int"] for r in q2.collect()} == {1: 99, 2: 80}
    twice = spark.createDataFrame([(1, 30.0, 30, 1), (1, 20.0, 20, 2)], "url_id long, priority double, priority_int int, seq long")
    assert {r["url_id"]: r["priority_int"] for r in stt.queue_update(q, twice, "url_id", "seq").collect()} == {1: 20, 2: 80}
    eq = spark.createDataFrame([("PQ1", 20.0, 20), ("PQ2", 90.0, 90)], "name string, priority double, priority_int int")
    head = eq.orderBy(F.col("priority_int").desc(), "name").first()
    assert (head["name"], head["priority_int"]) == ("PQ2", 90)
    eq2 = stt.queue_upsert(eq, spark.createDataFrame([("PQ1", 55.0, 55, 1), ("PQ3", 1.0, 1, 2)],
                                                     "name string, priority double, priority_int int, seq long"), "name")
    assert {r["name"]: r["priority_int"] for r in eq2.collect()} == {"PQ1": 55, "PQ2": 90, "PQ3": 1}
    assert stt.queue_remove(eq2, spark.createDataFrame([("PQ2",), ("nope",)], "name string"), "name").count() == 2


def test_dense_ids_match_rank(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"))
    out = stt.assign_dense_ids(df.repartition(5), ["k"], "rid", 100).collect()
    assert sorted((r["k"], r["rid"]) for r in out) == [(k, 100 + k) for k in range(1000)]


def test_insert_if_absent_null_keys(spark):
    t = spark.createDataFrame([(1, "Olivia", "A St")], "entity_id long, name string, address string")
    b = spark.createDataFrame([("Olivia", "A St"), ("Olivia", "B St"), ("Nox", None), ("Nox", None)],
                              "name string, address string")
    nxt, ins = stt.insert_if_absent(t, b, ["name", "address"], "entity_id")
    assert nxt.count() == 4 and sorted(r["entity_id"] for r in ins.collect()) == [2, 3, 4]


def brute_best(ms, gz, t=0.75):
    import numpy as np
    def tg(s):
        import re
        out = set()
        for w in re.split(r"[^\w]+|_", s.lower()):
            if w:
                p = "  " + w + " "
                out.update(p[i:i + 3] for i in range(len(w) + 1))
        return out
    res = {}
    for m in set(ms):
        a = tg(m)
        best = None
        for gid, name in gz:
            b = tg(name)
            u = len(a | b)
            c = float(np.float32(len(a & b) / u)) if u else 0.0
            if c > t and (best is None or (c, -gid) > (best[1], -best[0])):
                best = (gid, c)
        if best:
            res[m] = best
    return res


def test_fuzzy_join_equals_brute_force(spark):
    rnd = random.Random(3)
    base = ["Fancy Bistro", "Chez Olivia", "Olivia", "Le Petit Four", "Sushi Yasuda", "Blue Hill", "Atelier Crenn",
            "Customer#000000010", "Customer#000000011", "Customer#000000111"]
    gz = [(i + 1, n) for i, n in enumerate(base)]
    ms = [n for n in base] + ["fancy bistro", "Chez Olivias", "Customer#000000012", "Le Petit Fours", "Blue Hills",
                              "nothing alike", "Sushi"] + [rnd.choice(base)[:-1] for _ in range(20)]
    g = spark.createDataFrame([(i, n, None) for i, n in gz], "entity_id long, name string, address string")
    m = spark.createDataFrame([(x,) for x in ms], "mention string")
    got = {r["mention"]: (r["entity_id"], r["confidence"]) for r in fuzzy_best_match(m, g).collect()}
    exp = brute_best(ms, gz)
    assert set(got) == set(exp)
    for k, (gid, c) in exp.items():
        assert got[k][0] == gid and got[k][1] == pytest.approx(c, abs=1e-7)


def test_pagerank_matches_power_iteration(spark):
    import numpy as np
    edges = [(0, 1), (1, 2), (2, 0), (2, 1), (3, 2)]   # node 4 dangling
    n = 5
    nodes = spark.createDataFrame([(i,) for i in range(n)], "node long")
    e = spark.createDataFrame(edges, "src long, dst long")
    got = {r["node"]: r["rank"] for r in pagerank(nodes, e, iterations=20).collect()}
    r = np.full(n, 1 / n)
    out = {i: [d for s, d in edges if s == i] for i in range(n)}
    for _ in range(20):
        nr = np.full(n, 0.15 / n)
        dm = sum(r[i] for i in range(n) if not out[i])
        for i in range(n):
            for d in out[i]:
                nr[d] += 0.85 * r[i] / len(out[i])
        nr += 0.85 * dm / n
        r = nr
    assert sum(got.values()) == pytest.approx(1.0)
    for i in range(n):
        assert got[i] == pytest.approx(r[i], abs=1e-12)


def test_bipartite_authority_sums_to_one(spark):
    e = spark.createDataFrame([("a", "/x"), ("b", "/x"), ("b", "/y")], "domain string, item string")
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "domain string")
    out = {r["domain"]: r["authority"] for r in bipartite_authority(e, nodes, iterations=5).collect()}
    assert sum(out.values()) == pytest.approx(1.0)
    assert out["b"] > out["a"] > out["c"]


def test_profile_and_links(spark):
    html = ("<html><head><title>T &amp; Co</title><script>var a='</p>';</script></head><body>"
            "<nav><a href='/n1'>n</a></nav><main><a href='/m'>m</a></main><main><a href='/skip'>s</a></main>"
            "<div><p><a href='../up'>u</a></p></div><p><a href='/bare'>b</a></p>"
            "<h1>Michelin Guide</h1><h2>Fancy <b>Bistro</b></h2><!-- c --><footer><a href='/f'>f</a></footer></body></html>")
    p = profile_html(html)
    assert p["title"] == "T & Co" and p["has_body"]
    assert [h["text"] for h in p["headers"]] == ["Michelin Guide", "FancyBistro"]
    assert "var a" not in p["text"] and p["text"].startswith("T & Co n m s u b Michelin Guide Fancy Bistro")
    df = spark.createDataFrame([(1, "https://ex.com/a/b", html)], "k long, full_url string, html string")
    prof = profile_pages(df, ["k", "full_url"])
    links = {r["link"] for r in pg.page_links(prof, "k", "full_url").collect()}
    assert links == {"https://ex.com/n1", "https://ex.com/m", "https://ex.com/up"}


def test_derived_links_homepage_first(spark):
    links = spark.createDataFrame([(1, "https://deriv1.com"), (1, "https://example.com/")], "k long, link string")
    pages = spark.createDataFrame([(1, "https://example.com/page", 40, ["Fancy Bistro"])],
                                  "k long, full_url string, parent_priority int, names array<string>")
    out = pg.derived_links(links, pages, "k").collect()
    assert len(out) == 2
    home = [r for r in out if r["is_homepage"]][0]
    assert home["url"] == "https://example.com/" and home["priority"] == 40


def test_empty_and_missing_html():
    assert profile_html(None)["has_body"] is False
    assert profile_html("<html><body>short</body></html>")["text_concat_len"] == 5
