"""Page stage on bad input, rounds over repeated fetches, state rules, extraction without a gazetteer."""

import random
import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from linkledger import session
from linkledger.functions.trigram import similarity
from linkledger.operators import frontier as fr
from linkledger.operators import pages as pg
from linkledger.operators import rank
from linkledger.operators import state as stt
from linkledger.operators.html_profile import profile_html, profile_pages
from linkledger.operators.mentions import spot_capitalised, spot_gazetteer
from linkledger.operators.resolve import resolve_mentions
from linkledger.operators.similarity import fuzzy_best_match, nearest_match, register_fuzzy_search
from linkledger.plans.rounds import discovered_from_search, gazetteer_extractor, run_round
from linkledger.sources.snapshots import latest_version, write_state
from linkledger.sources.search import search_queries

PAGE = ("<html><head><title>{t}</title></head><body><nav><a href='/menu'>m</a></nav>"
        "<h1>{t}</h1><p>A review of {t} and its chef, with the wine list.</p></body></html>")
AS_OF = "2024-01-01 00:00:00"


def test_links_resolve_as_the_standard_says(spark):
    bases = ["http://a.example/b/c/d.html", "https://a.example/", "http://a.example", "http://A.example:80/x//y/", "https://u@h/p;q/r"]
    hrefs = ["", "/", "//", "x", "./x", "../x", "../../../x", "..", "./", "x/..", "/x/../y", "?q", "?", "#f", "?q#f", ";p", "x;p?q#f",
             "a/b;c/d", "//h/x/../y", "http://z/x/../y;k", "http:x", "https:x", "mailto:a@b", "http://[bad/", "http://[::1]:80/",
             "//]x/", "\tx\n", "  /x  ", "a//b", "/a//b", "x?/../y", "1:x", "http://℀x/", "/...", "HTTP://Z/a"]
    rng = random.Random(7)
    bits = ["a", "/", "//", ".", "..", "?", "#", ";", ":", "é", "http:", "[", "]"]
    hrefs += ["".join(rng.choice(bits) for _ in range(rng.randint(1, 7))) for _ in range(300)]
    rows = [(b, h) for b in bases for h in hrefs]

    def plain(b, h):
        try:
            return urljoin(b, h)
        except ValueError:
            return None
    df = spark.createDataFrame(rows, "b string, h string")
    resolved = df.select("b", "h", pg.resolve_link("b", "h").alias("link"))
    assert [(r["b"], r["h"], r["link"]) for r in resolved.collect()] == [(b, h, plain(b, h)) for b, h in rows]
    assert "Python" not in resolved._jdf.queryExecution().executedPlan().toString()
    assert spark.createDataFrame([(None, "x"), ("http://a/", None)], "b string, h string").select(
        pg.resolve_link("b", "h").alias("link")).where("link is not null").count() == 0


def test_a_page_that_cannot_be_parsed_costs_its_own_row(spark):
    bad = "<body><![foo[x]]></body>"
    assert profile_html(bad)["parse_error"] and not profile_html("<body>fine</body>")["parse_error"]
    df = spark.createDataFrame([(1, bad), (2, "<body>long enough text</body>"), (3, None)], "k int, html string")
    prof = profile_pages(df, ["k"])
    assert {r["k"]: r["parse_error"] for r in prof.collect()} == {1: True, 2: False, 3: False}
    assert [r["k"] for r in pg.meaningful(prof).collect()] == [2]


def test_raw_text_keeps_words_that_markup_cuts():
    p = profile_html("<body>Fancy Bis<b>tro</b><li>Chez</li><li>Olivia</li><script>no</script></body>")
    assert p["raw_text"] == "Fancy BistroChezOlivia" and p["text"] == "Fancy Bis tro Chez Olivia"


def round_inputs(spark):
    pages = [(1, "https://food.org/a", 200, PAGE.format(t="Fancy Bistro")), (2, "https://eat.com/b", 503, PAGE.format(t="Chez Olivia")),
             (3, "https://eat.com/c", 404, "")]
    fetched = spark.createDataFrame(pages, "page_id long, full_url string, status int, html string")
    entity = spark.createDataFrame([(1, "Fancy Bistro", "Paris"), (2, "Chez Olivia", None)], "entity_id long, name string, address string")
    disc = spark.createDataFrame([(1, "https://food.org/a?x=1", 0.9), (2, "https://eat.com/b", 0.8), (3, "https://eat.com/c", 0.7)],
                                 "seq long, url string, relevance double")
    return fetched, entity, disc, gazetteer_extractor(entity.select("name"))


def test_repeated_fetches_give_one_reference(spark):
    fetched, entity, disc, extract = round_inputs(spark)
    later = fetched.withColumn("page_id", F.col("page_id") + 100).withColumn("status", F.lit(404))
    out = run_round(stt.empty_state(spark, entity), disc, fetched.unionByName(fetched).unionByName(later), extract, AS_OF)
    assert [(r["entity_id"], r["url_id"]) for r in out.references.collect()] == [(1, 1)]
    assert "html" not in out.routed.columns


def test_numbering_goes_on_over_rounds(spark):
    fetched, entity, disc, extract = round_inputs(spark)
    one = run_round(stt.empty_state(spark, entity), disc, fetched, extract, AS_OF)
    two = run_round(one.state, one.feedback.select("seq", "url", "relevance"), fetched.withColumn("status", F.lit(200)), extract, AS_OF)
    a, b = ([r["seq"] for r in x.feedback.orderBy("seq").collect()] for x in (one, two))
    assert a and b and a + b == list(range(4, 4 + len(a) + len(b)))
    assert two.state.sequence.first()["next_seq"] == b[-1] + 1
    assert {(r["entity_id"], r["url_id"]) for r in two.state.reference.collect()} == {(1, 1), (2, 2)}


def test_html_is_not_shuffled(spark):
    fetched, _, _, _ = round_inputs(spark)
    one = fr.one_fetch(fetched, "page_id")
    assert "html" not in one._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]


def test_search_to_discovered(spark):
    seeds = spark.createDataFrame([(0, " A ", "X", True), (1, "B", None, False)], "pos long, name string, location string, initial_search boolean")
    body = '{"web": {"results": [{"url": "https://a/1"}, {"url": "https://a/2"}]}}'
    answers = spark.createDataFrame([(0, 1, body), (0, 2, body), (1, 1, "{}"), (9, 1, body)], "pos long, query_idx long, body string")
    assert search_queries(seeds).count() == 4
    got = sorted(tuple(r) for r in discovered_from_search(seeds, answers, 5).collect())
    assert got == [(5, "https://a/1", 1.0), (6, "https://a/2", 1.0)]


def test_a_state_that_breaks_a_rule_is_not_committed(spark, tmp_path):
    st = stt.empty_state(spark, spark.createDataFrame([(1, None, None)], "entity_id long, name string, address string"))
    with pytest.raises(stt.ConstraintError, match="entity.name_not_null: 1"):
        write_state(st, str(tmp_path), 1)
    assert latest_version(spark, str(tmp_path)) is None
    (tmp_path / "_versions").mkdir()
    (tmp_path / "_versions" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        latest_version(spark, str(tmp_path))


def test_a_cluster_must_name_its_checkpoint_folder(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_names_outside_the_gazetteer_are_found(spark):
    docs = spark.createDataFrame([(1, "we met at Fancy Bistro du Nord, near Chez Olivia. Then home"), (2, "nothing here"), (3, None)],
                                 "url_id long, text string")
    assert sorted(r["mention"] for r in spot_capitalised(docs, "url_id").collect()) == ["Chez Olivia", "Fancy Bistro du Nord"]
    for key in ("k", "i", "h", "tok"):
        got = spot_gazetteer(docs.withColumnRenamed("url_id", key), spark.createDataFrame([("chez olivia",)], "name string"), key)
        assert [(r[key], r["mention"]) for r in got.collect()] == [(1, "chez olivia")]


def test_similarity_join_makes_each_pair_once(spark):
    names = [f"Customer#{k:06d}" for k in range(300)]
    m = spark.createDataFrame([(n.replace("#", " "),) for n in names[::2]], "mention string")
    g = spark.createDataFrame([(k, n, None) for k, n in enumerate(names)], "entity_id long, name string, address string")
    got = {r["mention"]: r["matched_name"] for r in fuzzy_best_match(m, g).collect()}
    assert got == {n.replace("#", " "): n for n in names[::2]}


def test_fuzzy_search_from_sql(spark):
    g = spark.createDataFrame([(111, "Fancy Resto", "321 Street"), (2, "Other", None)], "entity_id long, name string, address string")
    spark.createDataFrame([("Fancy Restos",), ("zzz",)], "mention string").createOrReplaceTempView("fuzzy_search_input")
    register_fuzzy_search(spark, g)
    got = spark.sql("SELECT entity_id, matched_name, address, confidence FROM fuzzy_search_matches").collect()
    assert [(r[0], r[1], r[2]) for r in got] == [(111, "Fancy Resto", "321 Street")] and got[0][3] > 0.75
    pairs = [("word", "words", 4 / 7), ("word", "two words", 4 / 11), ("a", "a", 1), ("a", "b", 0), ("", "", 0)]
    for a, b, want in pairs:
        assert spark.sql(f"SELECT fuzzy_search_similarity('{a}', '{b}')").first()[0] == pytest.approx(want, abs=1e-6)


def test_rejects_are_named_after_their_nearest_entity(spark):
    g = spark.createDataFrame([(1, "Fancy Resto Paris", None), (2, "Other", None)], "entity_id long, name string, address string")
    m = spark.createDataFrame([("Fancy Place",), ("Other",), ("xyz",)], "mention string")
    got = {r["mention"]: (r["method"], r["nearest_name"]) for r in resolve_mentions(m, g, nearest=True).collect()}
    assert got == {"Fancy Place": ("none", "Fancy Resto Paris"), "Other": ("exact", None), "xyz": ("none", None)}


def test_the_nearest_entity_has_no_threshold(spark):
    name = "colours of bright morning umbrellas"
    g = spark.createDataFrame([(1, "Zebra", "x"), (3, name, None), (2, name, "y")], "entity_id long, name string, address string")
    m = spark.createDataFrame([("cold anvil",), ("xyz",), ("",), (None,)], "mention string")
    got = {r["mention"]: r for r in nearest_match(m, g).collect()}
    assert got.keys() == {"cold anvil", "xyz", ""}
    near = got["cold anvil"]
    assert (near["entity_id"], near["address"]) == (2, "y") and 0 < near["confidence"] < 0.1
    want = g.limit(4).where("entity_id = 2").select(similarity(F.lit("cold anvil"), "name")).first()[0]
    assert near["confidence"] == want
    assert all(got[x]["entity_id"] is None and got[x]["confidence"] == 0 for x in ("xyz", ""))


def test_pagerank_with_dangling_nodes(spark):
    edges = [("a", "b"), ("b", "c"), ("a", "c"), ("d", "a"), ("a", "b")]
    nodes = ["a", "b", "c", "d", "e"]
    r = {n: 0.2 for n in nodes}
    for _ in range(7):
        links = set(edges)
        out = {n: [y for x, y in links if x == n] for n in nodes}
        idle = sum(r[n] for n in nodes if not out[n])
        r = {n: 0.15 / 5 + 0.85 * (sum(r[x] / len(out[x]) for x in nodes if n in out[x]) + idle / 5) for n in nodes}
    got = rank.pagerank(spark.createDataFrame([(n,) for n in nodes], "node string"),
                        spark.createDataFrame(edges, "src string, dst string"), iterations=7).collect()
    assert {x["node"]: x["rank"] for x in got} == pytest.approx(r)


def test_a_run_of_any_length_is_one_name(spark):
    import re as plain

    from linkledger.operators.mentions import PHRASE
    upper = plain.compile(PHRASE.replace(r"\p{Lu}", "[A-ZÀ-ÖØ-Þ]").replace(r"[\p{L}\p{N}'’&-]", r"(?:[^\W_]|['’&-])"))
    texts = ["Chez Olivia de la Mer and Bob. New York of", "x" + "Ab Cd " * 3 + "\nEf of the Gh", "A\x01B C\x02 D E", "the Of de A & B", "",
             "Éa Öb, Cd et Ef", "AB CD&E F'G H-I"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {(r["k"], r["mention"]) for r in spot_capitalised(df, "k").collect()}
    assert got == {(k, m[0]) for k, t in enumerate(texts) for m in upper.finditer(t) if len(m[0].split(" ")) >= 2}
    long = " ".join(["Word"] * 100_000)
    (r,) = spot_capitalised(spark.createDataFrame([(1, "a " + long + " b")], "k int, text string"), "k").collect()
    assert r["mention"] == long


def test_anchored_spotting_equals_a_search_in_the_tokens(spark, monkeypatch):
    import random

    from linkledger.operators import mentions as m
    rng = random.Random(3)
    words = [f"w{k}" for k in range(9)]
    names = sorted({" ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 2, 3, 4, 9]))) for _ in range(60)})
    names += [None, "", " - ", "W1  w2", "w1-W2", "never met w1", "é ß"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 90))) for _ in range(40)] + [None, "", "w1", "É, ß!", "w0 " * 400]
    want = set()
    for k, t in enumerate(texts):
        page = " " + " ".join(w for w in re.split(r"[^\w]+", (t or "").lower()) if w) + " "
        for n in names:
            toks = " ".join(w for w in re.split(r"[^\w]+", (n or "").lower()) if w)
            if toks and f" {toks} " in page:
                want.add((k, n))
    docs = spark.createDataFrame(list(enumerate(texts)), "k int, text string").repartition(3)
    vocab = spark.createDataFrame([(n,) for n in names], "name string")
    for span, held in ((512, m.BROADCAST_BYTES), (7, -1)):
        monkeypatch.setattr(m, "SPAN", span)
        monkeypatch.setattr(m, "BROADCAST_BYTES", held)
        assert {(r["k"], r["mention"]) for r in spot_gazetteer(docs, vocab, "k").collect()} == want
    assert spot_gazetteer(docs, vocab.limit(0), "k").count() == 0
