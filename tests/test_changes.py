"""The state as change files, the persisted quality fold, checks on changes."""

import os
import random

import pytest
from pyspark.sql import functions as F

from linkledger.operators import state as stt
from linkledger.operators.frontier import validate_batch, validate_changes
from linkledger.operators.quality import quality_fold_plain
from linkledger.sources.changes import ChangeLog
from linkledger.sources.quality_tree import QualityTree

AS_OF = "2024-01-01 00:00:00"
DISC = "seq long, url string, relevance double"


def rows_of(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def urls(seqs):
    return [(k, f"https://d{k % 5}.example.org/p{k % 11}?q={k}", ((k * 7) % 11) / 10.0) for k in seqs]


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


def test_changes_merge_to_the_state_of_the_batches(spark, tmp_path):
    """Inserts, updates, removals, a replay and two compactions."""
    log = ChangeLog(spark, str(tmp_path), compact_after=2)
    state = stt.empty_state(spark)
    for version, seqs in enumerate([range(0, 9), range(9, 20), range(20, 24), range(24, 40)], 1):
        batch = spark.createDataFrame(urls(seqs), DISC)
        changes, _ = validate_changes(batch, log.read(), AS_OF)
        gone = {"url_queue": spark.createDataFrame([(version - 1,)], "url_id long")}
        assert log.commit(version, changes, gone)
        assert not log.commit(version, changes)                      # committed already
        state, _ = validate_batch(batch, state, AS_OF)
        state = state.with_(url_queue=stt.queue_remove(state.url_queue, gone["url_queue"], "url_id"))
        state = stt.GraphState(**{t: df.checkpoint() for t, df in state.tables().items()})
        back = ChangeLog(spark, str(tmp_path), compact_after=2).read()      # as after a restart
        for table, df in state.tables().items():
            assert rows_of(back.tables()[table]) == rows_of(df), (version, table)
    assert log.version() == 4 and len(log.expire()) == 5           # four changes and the first snapshot


def test_what_is_not_committed_is_not_read_and_is_written_again(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path))
    one, _ = validate_changes(spark.createDataFrame(urls(range(4)), DISC), log.read(), AS_OF)
    log.commit(1, one)
    before = {t: rows_of(df) for t, df in log.read().tables().items()}
    bad = {"url_queue": spark.createDataFrame([(1, 500.0, 500)], stt.SCHEMAS["url_queue"]),
           "domain": spark.createDataFrame([(77, "d0.example.org", 1, 0.0), (78, None, 1, 7.0)], stt.SCHEMAS["domain"])}
    with pytest.raises(stt.ConstraintError) as e:
        log.commit(2, bad)
    for rule in ("url_queue.priority_range: 1", "domain.name_unique: 1", "domain.name_not_null: 1", "domain.quality_range: 1"):
        assert rule in str(e.value)
    assert {t: rows_of(df) for t, df in log.read().tables().items()} == before and log.version() == 1
    two, _ = validate_changes(spark.createDataFrame(urls(range(4, 8)), DISC), log.read(), AS_OF)
    assert log.commit(2, two) and log.read().url.count() == 8


def test_bytes_written_follow_the_batch(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path))
    many = spark.range(60_000).select(F.col("id").alias("seq"), F.concat(
        F.lit("https://d"), F.col("id") % 3000, F.lit(".example.org/p"), F.col("id")).alias("url"), F.lit(0.5).alias("relevance"))
    log.commit(1, validate_changes(many, log.read(), AS_OF)[0])
    log.commit(2, validate_changes(spark.createDataFrame(urls(range(10**6, 10**6 + 5)), DISC), log.read(), AS_OF)[0])
    assert size(tmp_path / "change=2") < 0.05 * size(tmp_path / "change=1")


def test_the_report_on_changes_is_that_of_the_state(spark):
    rows = [(1, "a", 1, 0.5), (2, "a", 1, 2.0), (3, None, 1, 0.0), (4, "b", 1, 0.0)]
    state = stt.empty_state(spark).with_(domain=spark.createDataFrame(rows, stt.SCHEMAS["domain"]))
    whole = {r["rule"]: r["violations"] for r in stt.constraint_report(state).collect()}
    changed = {r["rule"]: r["violations"] for r in stt.change_report(state, {"domain": state.domain}).collect()}
    assert changed == {k: v for k, v in whole.items() if k.startswith("domain.")} and whole["domain.name_unique"] == 1
    fine = stt.change_report(state, {"domain": state.domain.where("domain_name = 'b'")}).collect()
    assert all(r["violations"] == 0 for r in fine)
    assert stt.change_report(state, {"sequence": state.sequence}).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_late_events_take_their_place(spark, tmp_path, seed):
    rng = random.Random(seed)
    events = [(f"d{rng.choice([0, 0, 0, 1, 2])}", k * rng.choice([1, 1, 7]) + 64 * k, rng.choice([-30.0, 0.0, 0.4, 9.0])) for k in range(150)]
    rng.shuffle(events)
    cuts = sorted(rng.sample(range(150), 3))
    tree = QualityTree(spark, str(tmp_path), chunk_size=16, fan_in=4, levels=6, era=8, compact_after=2)
    schema = "domain string, seq long, relevance double"
    for version, (a, b) in enumerate(zip([0, *cuts], [*cuts, 150]), 1):
        batch = spark.createDataFrame(events[a:b], schema)
        out = tree.add(batch, version)
        want = {tuple(r[:2]): r[2] for r in rows_of(quality_fold_plain(spark.createDataFrame(events[:b], schema)))}
        assert {tuple(r[:2]): r[2] for r in rows_of(tree.quality())} == pytest.approx(want, abs=1e-8)
        again = rows_of(tree.add(batch, version))                    # a replay changes nothing
        assert again == rows_of(out) and {r[0] for r in again} == {e[0] for e in events[a:b]}


def test_what_is_known_before_the_first_event_counts(spark, tmp_path):
    schema = "domain string, seq long, relevance double"
    origin = spark.createDataFrame([("old", 5, 0.2)], "domain string, visit_count long, quality_score double")
    tree = QualityTree(spark, str(tmp_path), origin)
    tree.add(spark.createDataFrame([("old", 9, 1.0), ("new", 3, 1.0)], schema), 1)
    assert rows_of(tree.quality()) == [("new", 1, 0.0), ("old", 6, 0.25)]
    with pytest.raises(ValueError):
        tree.add(spark.createDataFrame([("old", -1, 1.0)], schema), 2)
    assert rows_of(tree.quality()) == [("new", 1, 0.0), ("old", 6, 0.25)]


def test_popularity_is_kept_up(spark, tmp_path):
    from linkledger.operators.rank import entity_popularity
    from linkledger.sources.popularity import Popularity

    rng = random.Random(5)
    url = spark.createDataFrame([(u, u % 7, f"u{u}", None, None) for u in range(40)], stt.SCHEMAS["url"])
    source = spark.createDataFrame([(s, s % 3, "webpage") for s in range(7)], stt.SCHEMAS["source"])
    domain = spark.createDataFrame([(d, f"d{d}", 1, 0.0) for d in range(3)], stt.SCHEMAS["domain"])
    refs = [(rng.randint(1, 5) if k < 90 else 9, rng.randrange(40), 0.5, None) for k in range(110)]
    kept = Popularity(spark, str(tmp_path), buckets=3)
    assert kept.totals().count() == 0
    for version, (a, b) in enumerate([(0, 30), (30, 31), (31, 100), (100, 110)], 1):
        batch = spark.createDataFrame(refs[a:b], stt.SCHEMAS["reference"])
        assert kept.add(batch, url, source, version) and not kept.add(batch, url, source, version)
        want = entity_popularity(spark.createDataFrame(refs[:b], stt.SCHEMAS["reference"]), url, source, domain)
        assert rows_of(Popularity(spark, str(tmp_path), buckets=3).totals()) == rows_of(want)
