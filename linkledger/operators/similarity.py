"""Best gazetteer match per mention by trigram similarity, exact, without
comparing all pairs.

Best first, in levels of falling similarity: each level finds all pairs at or above it, so a
mention that has one is done, ties included, and only the rest goes on.

Two sets of n and gn trigrams with Jaccard >= s share at least o = s/(1+s) * (n+gn). Order
the trigrams that both sides have by rarity, the same total order on both sides: the
first k that two such sets share lie among the first ``L - o + k`` of each, L of them in all.
So candidates come from an equi-join on hashes of k trigrams, which are rare where a
single trigram is not: names of one template share most of theirs, and a bounded alphabet has few.
o and k follow from the sizes on both sides, k also from how many names have them (``_plan``).
A row of that join is a few numbers; a 128-bit signature of each set bounds what two share,
so nearly all pairs that are too far apart end there.

Every candidate is verified exactly; the best one per mention is kept with a map-side
partial ``max_by`` (ties: lowest id). Mentions are deduplicated first, and of entities with equal
sets the lowest id stands for all. All joins are sized by adaptive execution from measured
shuffle output; candidate pairs are never collected per trigram group.
"""

from __future__ import annotations

import json
from itertools import combinations
from math import ceil, comb

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.trigram import shared_at_most, signatures, similarity_of_sets, trigrams
from ..session import cut_lineage

#: Slack of an overlap for each trigram on both sides: float error only lets more pairs in.
_EPS = 1e-6
#: Similarities that are asked for one after the other; after the last, any trigram in common will do.
LEVELS = (1.0, 0.85, 0.75, 0.65, 0.5, 0.35, 0.2, 0.1)
#: So many pairs of open mentions and entities at most are met by single trigrams at once.
FEW_PAIRS = 1 << 22
#: Keys of a set for one size of the other side at most, and trigrams in a key.
MOST_KEYS, MOST_IN_KEY = 64, 6


def _size_class(n: Column) -> Column:
    """Sizes up to 32 are told apart, larger ones within a tenth."""
    return F.when(n <= 32, n).otherwise(F.lit(32) + F.ceil(F.log(n / 32) / F.log(F.lit(1.1)))).cast("int")


def _mention_sets(mentions: DataFrame, mention_col: str) -> DataFrame:
    """(id, mention, tg, n), one row per distinct string."""
    m = mentions.select(F.col(mention_col).alias("mention")).where(F.col("mention").isNotNull()).distinct()
    return cut_lineage(m.withColumn("tg", trigrams("mention")).withColumn("n", F.size("tg"))
                       .withColumn("id", F.monotonically_increasing_id()))


def _entity_sets(gazetteer: DataFrame) -> DataFrame:
    """(id, entity_id, name, address, tg, n) of the entities that have a trigram, the lowest
    entity_id of each set."""
    lowest = F.max_by(F.struct("entity_id", "name", "address"), F.struct(-F.col("entity_id"))).alias("e")
    names = gazetteer.select("entity_id", "name", "address").where(F.col("name").isNotNull()).groupBy("name").agg(lowest).select("e.*")
    one = names.withColumn("tg", F.array_sort(trigrams("name"))).where(F.size("tg") > 0).groupBy("tg").agg(lowest)
    return cut_lineage(one.select("e.*", "tg", F.size("tg").alias("n"), F.monotonically_increasing_id().alias("id")))


def _shared_trigrams(m: DataFrame, g: DataFrame) -> DataFrame:
    """(t, w): the trigrams that both sides have, and how many pairs each would make."""
    def times(sets: DataFrame, name: str) -> DataFrame:
        return sets.select(F.explode("tg").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias(name))
    return times(m, "_m").join(times(g, "_g"), "t").select("t", (F.col("_m").cast("double") * F.col("_g")).alias("w"))


def _ordered(sets: DataFrame, shared: DataFrame) -> DataFrame:
    """(id, n, sig, cls, live): live are the trigrams that the other side has too, rarest first.
    Sets without any are left out."""
    live = (sets.select("id", F.explode("tg").alias("t")).join(shared, "t").groupBy("id")
            .agg(F.sort_array(F.collect_list(F.struct("w", "t"))).alias("_o")).select("id", F.transform("_o", lambda x: x["t"]).alias("live")))
    return cut_lineage(sets.select("id", "n", signatures("tg").alias("sig"), _size_class(F.col("n")).alias("cls")).join(live, "id"))


def _sizes(ordered: DataFrame) -> list:
    """Per size class: the least n, the most live trigrams, and how many sets."""
    return ordered.groupBy("cls").agg(F.min("n").alias("n"), F.max("n").alias("top"), F.max(F.size("live")).alias("live"),
                                      F.count(F.lit(1)).alias("sets")).collect()


def _needed(s: float, n, gn):
    return (n + gn) * (s / (1 + s) - _EPS)


def _plan(ms: list, gs: list, s: float) -> list[dict]:
    """(m_cls, g_cls, o, k): for two size classes, what two sets must share at least and the trigrams of a key.
    More of them make fewer pairs and more keys; the least sum of both is taken, where pairs are guessed: one
    of 200 shares a rare trigram, one of ten of those another."""
    out = []
    for a in ms:
        for b in gs:
            o = max(1, ceil(_needed(s, a["n"], b["n"])))
            if min(a["live"], b["live"]) < o or a["top"] < b["n"] * s - 1e-3 or b["top"] < a["n"] * s - 1e-3:
                continue

            def cost(k: int) -> float:
                x, y = comb(a["live"] - o + k, k), comb(b["live"] - o + k, k)
                if k > 1 and max(x, y) > MOST_KEYS:
                    return float("inf")
                return a["sets"] * x + b["sets"] * y + a["sets"] * b["sets"] * x / (200 * 10.0 ** (k - 1))
            out.append({"m_cls": a["cls"], "g_cls": b["cls"], "o": o, "k": min(range(1, min(o, MOST_IN_KEY) + 1), key=cost)})
    return out


def _keyed(ordered: DataFrame, plan: DataFrame, choices: DataFrame, own: str, other: str) -> DataFrame:
    """(key, id, n, sig): for each size class of the other side, the hashes of all k of a set's
    first ``L - o + k`` trigrams."""
    rows = (ordered.join(F.broadcast(plan), ordered["cls"] == plan[own]).withColumn("p", F.size("live") - F.col("o") + F.col("k"))
            .where(F.col("p") >= F.col("k")))
    cls = [F.col("m_cls"), F.col("g_cls")]
    one = rows.where("k = 1").select("id", "n", "sig", *cls, F.explode(F.slice("live", F.lit(1), F.col("p"))).alias("t")).select(
        F.xxhash64(*cls, F.array("t")).alias("key"), "id", "n", "sig")
    more = (rows.where("k > 1").join(F.broadcast(choices), ["p", "k"])
            .select("id", "n", "sig", *cls, "live", F.explode("choices").alias("c"))
            .select(F.xxhash64(*cls, F.transform("c", lambda i: F.get("live", i))).alias("key"), "id", "n", "sig"))
    return one.unionByName(more)


def _table(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """A few rows that the driver made, without a Python worker."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{ddl}>>")))


def _choices(spark: SparkSession) -> DataFrame:
    """(p, k, choices): all k of the places 0 to p - 1."""
    rows = [{"p": p, "k": k, "choices": list(combinations(range(p), k))}
            for k in range(2, MOST_IN_KEY + 1) for p in range(k, MOST_KEYS + 1) if comb(p, k) <= MOST_KEYS]
    return _table(spark, rows, "p: int, k: int, choices: array<array<int>>")


def _pairs_at(open_: DataFrame, entities: DataFrame, s: float | None) -> DataFrame | None:
    """(id, gid): at least the pairs of similarity ``s`` and more; without s, all that share a trigram."""
    g = entities.select(F.col("id").alias("gid"), F.col("n").alias("gn"), F.col("sig").alias("gsig"), "live")
    if s is None:
        return (open_.select("id", F.explode("live").alias("t")).join(g.select("gid", F.explode("live").alias("t")), "t")
                .select("id", "gid").distinct())
    rows = _plan(_sizes(open_), _sizes(entities), s)
    if not rows:
        return None
    spark = open_.sparkSession
    plan, choices = _table(spark, rows, "m_cls: int, g_cls: int, o: int, k: int"), _choices(spark)
    mk = _keyed(open_, plan, choices, "m_cls", "g_cls")
    gk = _keyed(entities, plan, choices, "g_cls", "m_cls").select(
        "key", F.col("id").alias("gid"), F.col("n").alias("gn"), F.col("sig").alias("gsig"))
    return mk.join(gk, "key").where(shared_at_most("n", "sig", "gn", "gsig") >= _needed(s, F.col("n"), F.col("gn"))).select(
        "id", "gid").distinct()


def _best(pairs: DataFrame, m: DataFrame, g: DataFrame) -> DataFrame:
    """(id, b): the entity of the highest confidence, then the lowest id, of (id, gid)."""
    scored = (pairs.join(m.select("id", "tg"), "id")
              .join(g.select(F.col("id").alias("gid"), F.col("entity_id"), F.col("tg").alias("gtg")), "gid")
              .select("id", "gid", "entity_id", similarity_of_sets("tg", "gtg").alias("confidence")))
    return scored.groupBy("id").agg(F.max_by(F.struct("gid", "confidence"), F.struct(F.col("confidence"), -F.col("entity_id"))).alias("b"))


def _best_first(m: DataFrame, g: DataFrame, levels: list, last_strict: float | None) -> DataFrame:
    """(id, entity_id, matched_name, address, confidence) of the mentions that have an entity at one of the
    ``levels`` (falling; None: any trigram in common). Above ``last_strict`` only, where that is given."""
    shared = cut_lineage(_shared_trigrams(m, g))
    open_, entities = _ordered(m, shared), _ordered(g, shared)
    n_entities, done = entities.count(), []
    for at, s in enumerate(levels):
        n_open = open_.count()
        if not n_open * n_entities:
            break
        few = n_open * n_entities <= FEW_PAIRS
        pairs = _pairs_at(open_, entities, None if few else s)
        if pairs is not None:
            least = levels[-1] if few else s
            kept = F.lit(True) if least is None else F.col("b.confidence") >= least
            if last_strict is not None:
                kept = kept & (F.col("b.confidence") > last_strict)
            done.append(cut_lineage(_best(pairs, m, g).where(kept)))
        if few or at == len(levels) - 1:
            break
        if pairs is not None:
            open_ = cut_lineage(open_.join(done[-1].select("id"), "id", "left_anti"))
    best = _table(m.sparkSession, [], "id: long, b: struct<gid: long, confidence: double>")
    for found in done:
        best = best.unionByName(found)
    return (best.select("id", F.col("b.gid").alias("gid"), F.col("b.confidence").alias("confidence"))
            .join(g.select(F.col("id").alias("gid"), "entity_id", F.col("name").alias("matched_name"), "address"), "gid")
            .select("id", "entity_id", "matched_name", "address", "confidence"))


def fuzzy_best_match(mentions: DataFrame, gazetteer: DataFrame, threshold: float = 0.75,
                     mention_col: str = "mention", strict: bool = True) -> DataFrame:
    """Best entity per distinct mention with similarity above ``threshold``
    (strictly, as the resolver requires; ``strict=False`` keeps >=).

    ``gazetteer``: (entity_id, name, address). Returns (mention, entity_id,
    matched_name, address, confidence); mentions without such a match are absent."""
    m, g = _mention_sets(mentions, mention_col).where("n > 0"), _entity_sets(gazetteer)
    levels = [s for s in LEVELS if s > threshold] + [threshold if threshold > 0 else None]
    best = _best_first(m, g, levels, threshold if strict else None)
    return m.select("id", "mention").join(best, "id").drop("id")


def nearest_match(mentions: DataFrame, gazetteer: DataFrame, mention_col: str = "mention") -> DataFrame:
    """The best entity of each distinct mention, same columns as ``fuzzy_best_match``, at any
    similarity. One that shares no trigram with any has a null entity and confidence 0."""
    m, g = _mention_sets(mentions, mention_col), _entity_sets(gazetteer)
    best = _best_first(m, g, [*LEVELS, None], None)
    return m.select("id", "mention").join(best, "id", "left").drop("id").withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))


def register_fuzzy_search(spark: SparkSession, gazetteer: DataFrame, name: str = "fuzzy_search",
                          threshold: float = 0.75) -> None:
    """The search as SQL: ``SELECT * FROM <name>_matches`` over a view ``<name>_input``
    (mention) that the caller creates first, and ``<name>_similarity(a, b)`` for any pair
    of strings. The view runs the prefix-filtered join over all rows of the input."""
    def grams(x: str) -> str:
        words = f"filter(split(regexp_replace(lower({x}), '[^\\\\p{{L}}\\\\p{{N}}]+', ' '), ' '), w -> length(w) > 0)"
        return (f"array_distinct(flatten(transform({words}, "
                "w -> transform(sequence(1, length(w) + 1), i -> substring(concat('  ', w, ' '), i, 3)))))")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}_similarity(a STRING, b STRING) RETURNS DOUBLE RETURN "
              f"SELECT CASE WHEN size(array_union(x, y)) > 0 THEN CAST(CAST(size(array_intersect(x, y)) / "
              f"size(array_union(x, y)) AS FLOAT) AS DOUBLE) ELSE CAST(0 AS DOUBLE) END "
              f"FROM (SELECT {grams('a')} AS x, {grams('b')} AS y)")
    fuzzy_best_match(spark.table(f"{name}_input"), gazetteer, threshold).createOrReplaceTempView(f"{name}_matches")
