import math

import pytest
from pyspark.sql import functions as F

from linkledger.llm.site_quality import features, fit, site_quality

from .cases import DOCS, no_docs, odd_docs, odd_rows, prose

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, n=300):
    rows, labels = [], []
    for k in range(n):
        bad = k % 3 == 0
        text = prose(k, 50)
        rows.append((k, " | ".join(text.split()) if bad else text, f"l{k % 2}", f"s{k % 7}", 0))
        if k % 2:
            labels.append((k, 0 if bad else 1, 0))
    return spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(labels, LABELS)


def test_held_out_and_unlabelled_documents_are_told_apart(spark):
    docs, labels = corpus(spark)
    got = {r["doc_id"]: r for r in site_quality(docs, labels).collect()}
    assert len(got) == 300
    wrong = [k for k, r in got.items() if r["predicted"] != (k % 3 != 0)]
    assert len(wrong) <= 3


def test_posteriors_match_brute_force(spark):
    """Scores by the sums of all others of a path and a host, with the weights that the rows imply."""
    docs, labels = corpus(spark, 120)
    site = {r["doc_id"]: (r["source"], r["lang"]) for r in docs.collect()}
    got = {r["doc_id"]: r for r in site_quality(docs, labels).collect()}
    p = {k: round(r["evidence"], 9) for k, r in got.items()}
    rate = sum(p.values()) / len(p)

    def strength(groups, around):
        n = sum(map(len, groups))
        mean = [sum(g) / len(g) for g in groups]
        within = sum((x - m) ** 2 for g, m in zip(groups, mean) for x in g) / (n - len(groups))
        between = (sum(len(g) * (m - a) ** 2 for g, m, a in zip(groups, mean, around)) - len(groups) * within) / n
        return 1e6 if between <= 0 else min(1e6, max(1.0, rate * (1 - rate) / between - 1))

    hosts, paths = {}, {}
    for k, (h, q) in site.items():
        hosts.setdefault(h, []).append(p[k])
        paths.setdefault((h, q), []).append(p[k])
    kh = strength(list(hosts.values()), [rate] * len(hosts))
    kp = strength(list(paths.values()), [sum(hosts[h]) / len(hosts[h]) for h, _ in paths])
    for k, (h, q) in site.items():
        host = (sum(hosts[h]) - p[k] + kh * rate) / (len(hosts[h]) - 1 + kh)
        path = (sum(paths[h, q]) - p[k] + kp * host) / (len(paths[h, q]) - 1 + kp)
        odds = sum(s * math.log(x / (1 - x)) for s, x in ((1, p[k]), (1, path), (-1, rate)))
        assert got[k]["host_posterior"] == pytest.approx(host, abs=1e-5)
        assert got[k]["path_posterior"] == pytest.approx(path, abs=1e-5)
        assert got[k]["score"] == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-4)


def test_sparse_sites_stay_near_the_global_rate_and_large_ones_speak(spark):
    """Texts that the evidence cannot tell apart, from sites that differ."""
    docs, labels = corpus(spark)
    mixed = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit("bad.example")).otherwise(F.lit("good.example")))
    new = spark.createDataFrame([(9000, prose(3, 50), "l0", "bad.example", 0), (9001, prose(3, 50), "l0", "new.example", 0),
                                 (9002, prose(3, 50), "l0", "good.example", 0)], DOCS)
    got = {r["doc_id"]: r for r in site_quality(mixed.unionByName(new), labels).collect()}
    assert got[9000]["path_posterior"] < got[9001]["path_posterior"] < got[9002]["path_posterior"]
    assert got[9000]["score"] < got[9002]["score"]
    rate = sum(r["evidence"] for r in got.values()) / len(got)
    assert got[9001]["path_posterior"] == pytest.approx(rate, abs=0.02)


def test_odd_rows(spark):
    docs, labels = corpus(spark)
    got = site_quality(odd_docs(spark), labels.unionByName(spark.createDataFrame([(None, 1, 1), (1, None, 0), (1, 0, 0)], LABELS)))
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == sorted((r[0] for r in odd_rows()), key=str)
    assert {r["evidence"] for r in site_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert site_quality(no_docs(spark), labels).count() == 0


def test_features_of_odd_texts():
    for text in ["", " \n", "é" * 10, prose(1, 20_000), " ", "a\x00b"]:
        assert all(map(math.isfinite, features(text)))
    assert fit(*(__import__("numpy").zeros(s) for s in ((3, 11), 3))) is None
