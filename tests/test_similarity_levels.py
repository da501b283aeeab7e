"""Similarity by levels over rare sets of trigrams."""

import random

import pytest
from pyspark.sql import functions as F

from linkledger.functions.trigram import similarity
from linkledger.operators import similarity as sm


def _names(n, seed):
    r = random.Random(seed)
    words = ["north", "south", "bistro", "bistros", "café", "customer", "custmoer", "grill", "a", "x"]
    out = []
    for _ in range(n):
        name = " ".join(r.choice(words) if r.random() < .7 else f"{r.randrange(2000):06d}" for _ in range(r.randrange(1, 5)))
        out.append(name if r.random() < .8 else name[:r.randrange(1, len(name) + 1)] * r.choice((1, 2)))
    return out


def _brute(m, g, above):
    pairs = m.distinct().crossJoin(g).withColumn("c", similarity("mention", "name")).where(above(F.col("c")))
    best = pairs.groupBy("mention").agg(F.max(F.struct("c", -F.col("entity_id"))).alias("b")).select("mention", "b.c", F.col("b.col2").alias("e"))
    return {r["mention"]: (-r["e"], r["c"]) for r in best.collect()}


@pytest.mark.parametrize("few", [0, 1 << 22])
def test_levels_equal_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(sm, "FEW_PAIRS", few)
    m = spark.createDataFrame([(x,) for x in [*_names(150, 1), "", "#", "zzqq", None]], "mention string").cache()
    rows = [(k, x, f"a{k}") for k, x in enumerate([*_names(200, 2), "", None, "south", "South!"])]
    g = spark.createDataFrame(rows, "entity_id long, name string, address string").cache()

    def found(df):
        got = df.collect()
        assert all((r["matched_name"], r["address"]) == rows[r["entity_id"]][1:] for r in got if r["entity_id"] is not None)
        return {r["mention"]: (r["entity_id"], r["confidence"]) for r in got}

    near = found(sm.nearest_match(m, g))
    assert len(near) == m.where("mention is not null").distinct().count()
    assert {k: v for k, v in near.items() if v[0] is not None} == _brute(m, g, lambda c: c > 0)
    for t, strict in ((0.75, True), (0.5, False)):
        assert found(sm.fuzzy_best_match(m, g, t, strict=strict)) == _brute(m, g, lambda c: c > t if strict else c >= t)


def test_names_of_one_template_make_few_pairs(spark):
    names = [f"Customer#{k:09d}" for k in range(4000)]
    m = sm._mention_sets(spark.createDataFrame([(n[:-1],) for n in names], "mention string"), "mention")
    g = sm._entity_sets(spark.createDataFrame([(k, n, None) for k, n in enumerate(names * 2)], "entity_id long, name string, address string"))
    assert g.count() < 4001                          # a name that comes twice is one
    shared = sm._shared_trigrams(m, g)
    pairs = sm._pairs_at(sm._ordered(m, shared), sm._ordered(g, shared), 0.85)
    assert 0 < pairs.count() < 20 * 4000
