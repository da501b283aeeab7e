import zlib
from collections import Counter

from pyspark.sql import functions as F

from linkledger.llm.sharding import shard_rows, write_shards

from .cases import no_docs, odd_docs, odd_rows


def check_law(rows, shards):
    held = {}
    for r in rows:
        held.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in held.values())
    sizes = [len(held.get(k, ())) for k in range(shards)]
    assert set(held) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert {(r["law"], r["grown_shard"]) for r in rows} <= {("rows", None)}


def test_odd_rows_are_all_placed_once(spark):
    rows = shard_rows(odd_docs(spark), 5).collect()
    check_law(rows, 5)
    want = Counter((k, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t, *_ in odd_rows())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want


def test_fewer_rows_than_shards_and_none(spark):
    rows = shard_rows(odd_docs(spark).limit(3), 24).collect()
    check_law(rows, 24)
    assert len(rows) == 3 and shard_rows(no_docs(spark)).count() == 0


def plain_places(rows, shards, seed_key, phase):
    """The definition in one list: rank in the shuffle of the source, fractional rank, equal cuts."""
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    woven = []
    for source, own in by.items():
        own.sort(key=seed_key)
        woven += [((k + phase[source]) / len(own), r["doc_id"]) for k, r in enumerate(own)]
    woven.sort()
    return {key: p * shards // len(woven) for p, (_, key) in enumerate(woven)}


def test_every_shard_matches_the_mixture_and_the_definition(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 700).cast("string")).alias("text"),
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 5 > 0, None)
        .otherwise(F.concat(F.lit("s"), (F.col("id") % 70).cast("string"))).alias("source"))
    out = shard_rows(docs, 24, seed=7)
    got = {r["doc_id"]: r["shard"] for r in out.collect()}
    assert got == {r["doc_id"]: r["shard"] for r in shard_rows(docs.repartition(5), 24, seed=7).collect()}
    assert got != {r["doc_id"]: r["shard"] for r in shard_rows(docs, 24, seed=8).collect()}
    rows = docs.withColumn("key", F.xxhash64(F.lit(7), "doc_id", F.crc32(F.col("text").cast("binary")),
                                             (F.octet_length("text") + 8).cast("long"))).collect()
    check_law(out.collect(), 24)
    phase = {r["source"]: r["p"] for r in docs.select("source").distinct().select(
        "source", (F.pmod(F.xxhash64(F.lit(7), "source"), F.lit(1 << 20)) / (1 << 20)).alias("p")).collect()}
    assert got == plain_places(rows, 24, lambda r: r["key"], phase)
    total = Counter(r["source"] for r in rows)
    for k in range(24):
        own = Counter(r["source"] for r in rows if got[r["doc_id"]] == k)
        assert all(abs(own[s] - n / 24) <= 3 for s, n in total.items())


def test_written_shards_hold_whole_rows_in_order(spark, tmp_path):
    docs = odd_docs(spark).withColumn("slot", F.lit("own"))
    write_shards(docs, f"{tmp_path}/out", 3)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == docs.count()
    assert Counter(map(str, back.select("row.*").collect())) == Counter(map(str, docs.collect()))
    assert [r["n"] for r in back.groupBy("shard").agg(F.countDistinct("slot").alias("n")).orderBy("shard").collect()] \
        == [len(odd_rows()) // 3 + (k < len(odd_rows()) % 3) for k in range(3)]
