import hashlib
import re

from pyspark.sql import functions as F

from linkledger.llm.exact_dedup import drop_copies, exact_classes

from .cases import CLASH, no_docs, odd_docs, odd_rows


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute():
    groups = {}
    for key, text, *_ in odd_rows():
        groups.setdefault(normal(text), []).append(key)
    out = []
    for text, keys in groups.items():
        keep = min((k for k in keys if k is not None), default=None)
        out += [(k, keep, len(keys), k == keep, hashlib.sha256(text.encode()).hexdigest()) for k in keys]
    return sorted(out, key=str)


def test_classes_match_brute_force(spark):
    got = [tuple(r) for r in exact_classes(odd_docs(spark)).collect()]
    assert sorted(got, key=str) == brute()


def test_texts_with_equal_hashes_are_told_apart_by_their_bytes(spark):
    def weak(text):
        return F.unhex(F.lit(""))

    got = [tuple(r) for r in exact_classes(odd_docs(spark), digest=weak).collect()]
    assert sorted(got, key=str) == brute()


def test_drop_copies_keeps_one_whole_row_of_each_class(spark):
    docs = odd_docs(spark)
    got = drop_copies(docs)
    assert got.columns == docs.columns and set(CLASH) <= set(got.columns)
    kept = sorted((r["doc_id"] for r in got.collect()), key=str)
    assert kept == sorted({keep for _, keep, *_ in brute()}, key=str)


def test_empty_table(spark):
    assert exact_classes(no_docs(spark)).count() == 0
    assert drop_copies(no_docs(spark)).count() == 0
