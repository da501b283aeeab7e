import random
import zlib

import pytest

from linkledger.llm.toxicity import KneserNey, drop_toxic, labelled_sample, toxicity

from .cases import DOCS, no_docs, odd_docs, prose

LABELS = "doc_id long, quality int, toxic int"
INSULTS = ["grumbold", "grumbolds", "vexnit", "vexnits", "zorkface"]


def corpus(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = prose(k + seed * 1000, 60).split(" ")
        toxic = k % 4 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(INSULTS)
        rows.append((k, " ".join(words), "en", f"s{k % 3}", 0))
        labels.append((k, 1, int(toxic)))
    return spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)


def test_probabilities_of_a_context_sum_to_one():
    model = KneserNey({"\x02\x02\x02\x02a": 3, "\x02\x02\x02ab": 2, "\x02\x02ab\x03": 2, "\x02\x02\x02ac": 1},
                      {"\x02a": 6, "ab": 4, "ac": 1, "b\x03": 4, "c\x03": 1})
    letters = ["a", "b", "c", "\x03"]
    for context in ["\x02\x02\x02\x02", "\x02\x02\x02a", "\x02\x02ab", "zzzz"]:
        total = sum(model.probability(context + x) for x in [*letters, "?"])   # and one letter never seen
        assert total == pytest.approx(1.0)


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus(spark)
    got = {r["doc_id"]: r for r in toxicity(docs, labels).collect()}
    assert len(got) == 400
    held = [k for k, r in got.items() if r["held_out"]]
    assert sorted(held) == [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    right = sum(got[k]["predicted"] == (k % 4 == 0) for k in held)
    assert right >= 0.95 * len(held)


def test_held_out_labels_sources_and_ids_do_not_matter(spark):
    from pyspark.sql import functions as F

    docs, labels = corpus(spark)
    first = {r["doc_id"]: r["score"] for r in toxicity(docs, labels).collect()}
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    changed = labels.withColumn("toxic", F.when(fold == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity(docs.withColumn("source", F.lit("x")).withColumn("lang", F.lit(None).cast("string")), changed)
    assert {r["doc_id"]: r["score"] for r in again.collect()} == pytest.approx(first)


def test_an_expression_is_found_in_a_long_text(spark):
    """Held-out recall on documents of which one or two words in 1,500 are insults."""
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(500):
        words = prose(k, 1500 if k % 2 else 80).split(" ")
        if k % 5 == 0:
            for _ in range(rng.randint(1, 2)):
                words[rng.randrange(len(words))] = rng.choice(INSULTS)
        rows.append((k, " ".join(words), "en", "s", 0))
        labels.append((k, 1, int(k % 5 == 0)))
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = {r["doc_id"]: r for r in toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()}
    held = [k for k, r in got.items() if r["held_out"]]
    toxic = [k for k in held if k % 5 == 0]
    assert len(toxic) >= 10 and sum(got[k]["predicted"] for k in toxic) >= 0.9 * len(toxic)
    assert not any(got[k]["predicted"] for k in held if k % 5)


def test_word_ratios_by_hand(spark):
    from math import log1p

    from linkledger.llm.toxicity import EXPRESSION, UNIT, WHOLE, word_ratios

    counts = {"insult": (40, 2, 9, 0, 12), "rare": (3, 0, 3, 0, 0), "plain": (900, 60, 20, 55, 18)}
    rows = [(WHOLE + w, *c) for w, c in counts.items()]
    n = sum(c[0] for c in counts.values())
    totals = {"n": n} | {f"d_n{half}{label}": sum(min(c[1 + 2 * half + label], EXPRESSION) for c in counts.values())
                         for half in (0, 1) for label in (0, 1)}
    got = {r["gram"][1:]: (r["h0"] * UNIT, r["h1"] * UNIT) for r in word_ratios(
        spark.createDataFrame(rows, "gram string, n long, n00 long, n01 long, n10 long, n11 long"), totals).collect()}
    for w, c in counts.items():
        for half in (0, 1):
            gain = [log1p(max(c[1 + 2 * half + label] - EXPRESSION, 0) * n / c[0]
                          / sum(min(x[1 + 2 * half + label], EXPRESSION) for x in counts.values())) for label in (0, 1)]
            assert got[w][half] == pytest.approx(max(gain[1] - gain[0], 0), abs=1e-6)
    assert got["rare"] == (0.0, 0.0) and got.keys() == counts.keys()


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_expressions_are_counted_over_all_documents(spark, monkeypatch, most):
    from collections import Counter

    from linkledger.llm import toxicity as m
    monkeypatch.setattr(m, "BROADCAST_WORDS", most)
    monkeypatch.setattr(m, "REMEMBERED", 30)                       # many blocks
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefghijklmnop") * 2 for _ in range(rng.randint(0, 9))) for _ in range(200)] + [None]
    known = {k: (k % 2, k % 3 % 2) for k in range(0, 90)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    held = m.blocks(docs, spark.createDataFrame([(k, *v) for k, v in known.items()], "_lid long, _half int, _label int"), "doc_id", "text")
    places, words, totals = m.expressions(held)
    shown = [set((t or "").split()) for t in texts]
    n = Counter(w for x in shown for w in x)
    by = {c: Counter(w for k, v in known.items() if v == c for w in shown[k]) for c in m.CLASSES}
    often = {w for w in n if any(by[half, 1][w] > m.EXPRESSION for half in (0, 1))}
    assert {r["gram"][1:]: tuple(r)[1:] for r in words.select("gram", "n", *m.COUNTS).collect()} == {
        w: (n[w], *(by[c][w] for c in m.CLASSES)) for w in often}
    assert totals == {"n": sum(n.values())} | {f"d_{x}": sum(min(v, m.EXPRESSION) for v in by[c].values()) for x, c in zip(m.COUNTS, m.CLASSES)}
    assert {r["gram"][1:] for r in places.collect()} == often


def test_ids_of_any_type_come_back(spark):
    docs, labels = corpus(spark, 60)
    named = docs.withColumn("doc_id", docs.doc_id.cast("string"))
    got = toxicity(named, labels.withColumn("doc_id", labels.doc_id.cast("string")))
    assert got.schema["doc_id"].dataType.simpleString() == "string"
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(str(k) for k in range(60))


def test_odd_rows_and_labels(spark):
    docs, labels = corpus(spark)
    bad = spark.createDataFrame([(None, 1, 1), (1, 1, None), (2, None, 0), (2, 0, 1), (2, 1, 0)], LABELS)
    odd = odd_docs(spark)
    got = toxicity(odd.select(docs.columns).unionByName(docs), labels.unionByName(bad)).collect()
    assert len(got) == odd.count() + 400 and all(r["score"] is not None for r in got)
    kept = drop_toxic(odd, labels)
    assert kept.columns == odd.columns


def test_without_labels_of_a_class(spark):
    docs, labels = corpus(spark, 40)
    assert {r["score"] for r in toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert {r["score"] for r in toxicity(docs, labels.where("toxic = 1")).collect()} == {1.0}
    assert {r["score"] for r in toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity(no_docs(spark), labels).count() == 0
    assert drop_toxic(docs, labels.limit(0)).count() == 40


def test_the_sample_is_bounded_and_outside_the_held_out_fold(spark):
    _, labels = corpus(spark)
    got = [r["_lid"] for r in labelled_sample(labels, "doc_id", "toxic", 5, 50).collect()]
    assert len(got) == 50 and all(zlib.crc32(str(k).encode()) % 5 for k in got)


def test_the_corpus_is_shared_at_the_full_order(spark):
    """Every n-gram of unlabelled and labelled documents, by the tables as by hand."""
    from collections import Counter
    from math import log

    from linkledger.llm.toxicity import BEGIN, END, UNIT, blocks, gram_counts, gram_ratios

    labelled = [("grumbold men", 0, 1), ("kind old men", 0, 0), ("vexnit men grumbolds", 1, 1), ("kind women", 1, 0)]
    plain = ["grumbold zebra quagga", "zebra zebras", "", None, "kind zebroid \U00010400\U00010401"]
    docs = spark.createDataFrame([*((k, t) for k, (t, _, _) in enumerate(labelled)),
                                  *((k + 10, t) for k, t in enumerate(plain))], "doc_id long, text string")
    known = spark.createDataFrame([(k, h, y) for k, (_, h, y) in enumerate(labelled)], "_lid long, _half int, _label int")
    counts = gram_counts(blocks(docs, known, "doc_id", "text"))

    def top(texts):
        out = Counter()
        for w in " ".join(t or "" for t in texts).lower().split():
            x = BEGIN * 4 + w + END
            out.update(x[i:i + 5] for i in range(len(x) - 4))
        return out

    shared = top([*(t for t, _, _ in labelled), *plain])
    assert {r["gram"]: r["n"] for r in counts.collect()} == shared      # rare ones of unlabelled rows too
    got = {r["gram"]: r for r in gram_ratios(counts).collect()}
    assert got.keys() == shared.keys()
    for name, halves in (("h0", (0,)), ("h1", (1,))):
        toxic, ordinary = (KneserNey(top([t for t, h, y in labelled if y == label and h in halves]), shared)
                           for label in (1, 0))
        for g, r in got.items():
            assert r[name] * UNIT == pytest.approx(log(toxic.probability(g) / ordinary.probability(g)), abs=1e-6)
