import random
import re

import numpy as np
import xxhash

from linkledger.llm.components import components
from linkledger.llm.simhash import fingerprint, near_pairs, one_of_each, simhash_components

from .cases import no_docs, odd_docs, odd_rows, prose


def plain_fingerprint(text, shingle=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    grams = [" ".join(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) << bit for bit in range(64))


def closure(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_fingerprints_match_the_definition():
    for text in ["", " \t\n", "One", "One two", "ÀB Cd é\x1cf g", prose(1, 50), prose(2, 700)]:
        assert fingerprint(text) == plain_fingerprint(text)


def test_near_pairs_lose_none(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)] + [0, 2**64 - 1, 2**63]
    fps = set(base)
    for x in base:
        for flips in (1, 2, 3, 4, 5):
            for _ in range(3):
                y = x
                for bit in rng.sample(range(64), flips):
                    y ^= 1 << bit
                fps.add(y)
    fps = sorted(fps)
    signed = {x: x - 2**64 if x >= 2**63 else x for x in fps}
    table = spark.createDataFrame([(signed[x],) for x in fps], "fp long")
    for most in (0, 1, 2, 3, 4):
        got = sorted(tuple(r) for r in near_pairs(table, most).collect())
        want = sorted(tuple(sorted((signed[x], signed[y]))) for k, x in enumerate(fps) for y in fps[k + 1:]
                      if (x ^ y).bit_count() <= most)
        assert got == want


def test_components_of_paths_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 202), (202, 200)]
    random.Random(1).shuffle(links)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == closure({x for ab in links for x in ab}, links)


def test_rows_match_brute_force(spark):
    rows = odd_rows()
    prints = [plain_fingerprint(r[1]) for r in rows]
    keys = sorted(set(prints))
    links = [(x, y) for k, x in enumerate(keys) for y in keys[k + 1:] if (x ^ y).bit_count() <= 2]
    group = closure(keys, links)
    least = {}
    for r, fp in zip(rows, prints):
        if r[0] is not None:
            least[group[fp]] = min(least.get(group[fp], r[0]), r[0])
    want = sorted(((r[0], f"{fp:016x}", least.get(group[fp])) for r, fp in zip(rows, prints)), key=str)
    got = sorted((tuple(r) for r in simhash_components(odd_docs(spark)).collect()), key=str)
    assert got == want


def test_one_of_each_group_stays(spark):
    docs = odd_docs(spark)
    groups = simhash_components(docs).collect()
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    stay = sorted((r["doc_id"] for r in groups if r["doc_id"] is None or r["doc_id"] == r["component_id"]), key=str)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == stay


def test_empty_table(spark):
    assert simhash_components(no_docs(spark)).count() == 0
    assert one_of_each(no_docs(spark)).count() == 0


def test_long_texts_are_counted_in_blocks(monkeypatch):
    from linkledger.llm import simhash

    whole = fingerprint(prose(4, 3000))
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert fingerprint(prose(4, 3000)) == whole
    assert np.uint64(whole) >= 0
