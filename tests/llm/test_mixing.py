import math
import random
import re

import pytest

from pyspark.sql import functions as F

from linkledger.llm.mixing import balance, mix_sources, mixed_rows, source_targets

from .cases import DOCS, no_docs, odd_docs, odd_rows, prose


def levels(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        weight = sum(w[s] for s in names if s not in full)
        t = {s: cap * sizes[s] if s in full else left * w[s] / weight for s in names}
        above = {s for s in names if s not in full and t[s] > cap * sizes[s] * (1 + 1e-12)}
        if not above:
            return t
        full |= above


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_share_the_excess_until_none_is_above(spark):
    sizes = {"a": 10, "b": 1000, "c": 3000, "d": 50, "e": 7, None: 900}
    table = spark.createDataFrame([("1" if s is None else "0" + s, n) for s, n in sizes.items()],
                                  "_src string, source_size long")
    got = {r["_src"]: r["target"] for r in source_targets(table).collect()}
    for s, t in levels(sizes).items():
        assert got["1" if s is None else "0" + s] == pytest.approx(t)


def test_rows(spark):
    rows = odd_rows()
    total = {}
    for r in rows:
        total[r[3]] = total.get(r[3], 0) + size(r[1])
    source = {r[0]: r[3] for r in rows}
    want = levels(total)
    got = mix_sources(odd_docs(spark)).collect()
    assert sorted(((r["doc_id"], r["size"]) for r in got), key=str) == sorted(((r[0], size(r[1])) for r in rows), key=str)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == total[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]


def many(spark, n=3000):
    rows = [(k, prose(k, 5 + k * 7 % 60), "en", "big" if k % 3 else f"s{k % 4}", 0) for k in range(n)]
    rows += [(n + k, "the same few words", "en", "big", 0) for k in range(n // 2)]   # one hot group
    return spark.createDataFrame(rows, DOCS).repartition(5)


def test_taken_words_come_near_the_targets_and_reruns_agree(spark):
    docs = many(spark)
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    runs = [sorted((r["doc_id"], r["taken"], r["target"]) for r in mix_sources(docs.repartition(p)).collect()) for p in (2, 7)]
    assert runs[0] == runs[1]
    taken, target = {}, {}
    for key, words, t in runs[0]:
        s = source[key]
        taken[s] = taken.get(s, 0) + words
        target[s] = t
    for s in target:
        assert abs(taken[s] - target[s]) <= max(5, 0.01 * target[s])


def test_rows_are_taken_whatever_their_ids(spark):
    """Null ids and ids that rows of different sizes share are told apart."""
    docs = many(spark).unionByName(odd_docs(spark, clash=False)).where("text is null or length(text) < 5000")
    odd = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 3 == 1, 7).otherwise(F.col("doc_id"))
                          ).withColumn("_row", F.lit(1)).withColumn("copies", F.lit("own"))
    got = mixed_rows(odd)
    assert got.columns == odd.columns
    size = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    taken = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.sum(size).alias("n")).collect()}
    target = levels({r["source"]: r["n"] for r in odd.groupBy("source").agg(F.sum(size).alias("n")).collect()})
    assert None in {r["doc_id"] for r in got.collect()}
    for s, t in target.items():
        assert abs(taken.get(s, 0) - t) <= max(100, 0.02 * t), s
    often = got.groupBy("text", "source").count().join(odd.groupBy("text", "source").agg(F.count(F.lit(1)).alias("n")), ["text", "source"])
    assert often.where("count > 3 * n").isEmpty()


def plain_rates(sizes, target, most):
    """Bisection on the dual, one source."""
    scale = sum(s * s for s in sizes) / sum(sizes)
    lo, hi = -1e4, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        total = sum(s * min(most, math.exp(min(700, mid * s / scale))) for s in sizes)
        lo, hi = (mid, hi) if total < target else (lo, mid)
    return lo


def test_the_dual_by_bisection(spark):
    rng = random.Random(2)
    sizes = {f"s{k}": [rng.randint(1, 90) for _ in range(rng.randint(2, 40))] for k in range(6)}
    target = {s: sum(x) * rng.choice([0.2, 0.7, 1.0, 1.9, 2.7]) for s, x in sizes.items()}
    hist = spark.createDataFrame([(s, n, x.count(n)) for s, x in sizes.items() for n in set(x)], "_src string, size long, n long")
    targets = spark.createDataFrame([(s, sum(x), target[s]) for s, x in sizes.items()], "_src string, source_size long, target double")
    for r in balance(hist, targets, 3).collect():
        assert r["_lam"] == pytest.approx(plain_rates(sizes[r["_src"]], target[r["_src"]], 3), abs=1e-4)
    with pytest.raises(ArithmeticError):
        balance(hist, targets, 3, max_rounds=1)


def test_no_rows_and_no_words(spark):
    assert mix_sources(no_docs(spark)).count() == 0
    empty = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", None, 0)], DOCS)
    assert sorted((r["doc_id"], r["size"], r["taken"]) for r in mix_sources(empty).collect()) == [(1, 0, 0), (2, 0, 0)]
