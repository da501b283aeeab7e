import random
import re
from collections import Counter

import pytest

from linkledger.llm import collocations as m
from linkledger.llm.collocations import collocations

from .cases import CLASH, no_docs, odd_docs, odd_rows

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least=10, top=2000, absorbed=50):
    """The definition, phrase by phrase."""
    out = []
    by = {}
    for lang, text in rows:
        by.setdefault("und" if lang is None else lang, []).append(text or "")
    for lang, texts in by.items():
        f, n = Counter(), 0
        for text in texts:
            text = re.sub("[A-Z]", lambda x: x[0].lower(), text)
            for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", text):
                words = [w for w in re.split("[ \t]", piece) if w]
                n += len(words)
                for size in (1, 2, 3):
                    for at in range(len(words) - size + 1):
                        f[tuple(words[at:at + size])] += 1
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in candidates.items() if len(p) == 3 for q in (p[:2], p[1:])
                if q in candidates and 100 * a >= absorbed * candidates[q]}
        found = []
        for p, a in candidates.items():
            if p not in gone:
                score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                            for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, k, p.decode(), -a, left, right, n, -s)
                for k, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def random_docs(seed):
    rng = random.Random(seed)
    words = ["The", "the", "a", "b\x01", "b", "é", "ñu", "New", "York", "new", "x\x1fy", "city"]
    return [(rng.choice([None, "und", "en", "fr"]),
             "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n"])
                     for _ in range(rng.randint(0, 60)))) for _ in range(120)]


@pytest.mark.parametrize("seed,size", [(1, 1 << 24), (2, 300)])
def test_equals_the_definition(spark, monkeypatch, seed, size):
    monkeypatch.setattr(m, "BLOCK_BYTES", size)
    docs = random_docs(seed)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    assert rows_of(collocations(df)) == plain(docs)
    assert rows_of(collocations(df, least=3, top=7, absorbed=90)) == plain(docs, 3, 7, 90)


def test_odd_rows(spark):
    want = plain([(r[2], r[1]) for r in odd_rows()])
    assert len(want) > 100 and rows_of(collocations(odd_docs(spark))) == want
    assert set(CLASH) <= set(odd_docs(spark).columns)


def test_nothing(spark):
    assert collocations(no_docs(spark)).count() == 0
    assert collocations(spark.createDataFrame([(None, None), ("en", " \n")], "lang string, text string")).count() == 0


def test_a_long_text_is_cut_at_the_end_of_pieces_only(monkeypatch):
    monkeypatch.setattr(m, "BLOCK_BYTES", 10)
    text = b"one two three four, five six seven eight nine ten. x"
    assert list(m._cut(text)) == [b"one two three four", b" five six seven eight nine ten", b" x"]
    assert list(m._cut(b"no end in this text at all")) == [b"no end in this text at all"]


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_000_000
    row = spark.createDataFrame([(big, big + 1, big + 3)], "n long, l long, r long").select(
        m._score("n", "l", "r").alias("s")).first()
    assert row["s"] == 1_000_000 * big * big // ((big + 1) * (big + 3))


def test_hot_pairs_over_many_partitions(spark):
    """One pair that begins or ends most triples is spread over partitions and still added up."""
    docs = [("en", f"hot pair w{k % 40} hot pair. z{k % 12} hot pair") for k in range(600)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(collocations(df)) == plain(docs)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
