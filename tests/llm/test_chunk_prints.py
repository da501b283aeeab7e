import hashlib
import random

import numpy as np
import pytest

from linkledger.llm import chunk_prints as cp

from .cases import DOCS, no_docs, odd_docs, odd_rows, prose


def test_gear_hash_is_the_rolling_one():
    data = random.Random(1).randbytes(500)
    h, want = 0, []
    for b in data:
        h = ((h << 1) + int(cp._GEAR[b])) % 2**32
        want.append(h)
    assert cp._gear_hash(np.frombuffer(data, np.uint8)).tolist() == want


def test_boundaries_keep_their_lengths_and_blocks_do_not_matter(monkeypatch):
    data = prose(5, 4000).encode()
    ends = cp.boundaries(data)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and (sizes[:-1] >= cp.LEAST).all() and (sizes <= cp.MOST).all()
    monkeypatch.setattr(cp, "BLOCK", 1000)
    assert cp.boundaries(data) == ends


def test_an_insertion_moves_chunks_only_near_itself():
    text = prose(6, 3000)
    moved = text[:5000] + " inserted words " + text[5000:]
    assert cp.containment(cp.chunk_set(text), cp.chunk_set(moved)) > 0.95
    assert cp.containment(cp.chunk_set(text), cp.chunk_set(text)) == 1.0


def brute(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = []
    for k, (key, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 3
        e = text[:len(text) - n] + after[:n]
        a, b, c = map(cp.chunk_set, (text, e, after))
        out.append((key, len(text), hashlib.sha256(e.encode()).hexdigest(), cp.written(a), cp.written(b),
                    pytest.approx(cp.containment(a, b)), pytest.approx(cp.containment(a, c))))
    return out


@pytest.mark.parametrize("ranges", [1, 2, 5, 40])
def test_neighbours_match_brute_force(spark, ranges):
    rows = [r for r in odd_rows() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = sorted((tuple(r) for r in cp.neighbour_likeness(docs, ranges=ranges).collect()), reverse=True)
    assert got == brute([(r[0], r[1]) for r in rows])


def test_odd_rows(spark):
    got = cp.neighbour_likeness(odd_docs(spark)).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == sorted((r[0] for r in odd_rows()), key=str)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    one = cp.neighbour_likeness(spark.createDataFrame([(5, "only one text here", "en", "s", 0)], DOCS)).collect()
    assert [(r["doc_id"], r["near_next"]) for r in one] == [(5, 1.0)]
    assert cp.neighbour_likeness(no_docs(spark)).count() == 0
    nulls = spark.createDataFrame([(None, "a", "en", "s", 0), (None, "b", "en", "s", 0)], DOCS)
    assert [r["doc_id"] for r in cp.neighbour_likeness(nulls).collect()] == [None, None]


def test_equal_texts_have_equal_fingerprints(spark):
    got = cp.fingerprints(odd_docs(spark)).collect()
    by = {r["doc_id"]: (r["n_chars"], r["fingerprint"]) for r in got}
    assert by[3] == by[33] and by[30] == by[31] == (0, "") and by[3] != by[34]
