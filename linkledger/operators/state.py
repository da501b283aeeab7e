"""Graph state tables and their batch writes.

Every write takes the current table plus a batch DataFrame and returns the
next table; nothing is mutated in place. Tables (all DataFrames):

    domain     (domain_id long, domain_name string, visit_count long, quality_score double)
    source     (source_id long, domain_id long, source_type string)
    entity     (entity_id long, name string, address string)
    url        (url_id long, source_id long, full_url string, first_seen timestamp, last_crawled timestamp)
    reference  (entity_id long, url_id long, relevance double, discovered_at timestamp)
    url_queue  (url_id long, priority double, priority_int int)
    entity_queue (name string, priority double, priority_int int)
    sequence   (next_seq long)   one row at most: the number that the next fed-back URL gets
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SCHEMAS = {
    "domain": "domain_id long, domain_name string, visit_count long, quality_score double",
    "source": "source_id long, domain_id long, source_type string",
    "entity": "entity_id long, name string, address string",
    "url": "url_id long, source_id long, full_url string, first_seen timestamp, last_crawled timestamp",
    "reference": "entity_id long, url_id long, relevance double, discovered_at timestamp",
    "url_queue": "url_id long, priority double, priority_int int",
    "entity_queue": "name string, priority double, priority_int int",
    "sequence": "next_seq long",
}


@dataclass(frozen=True)
class GraphState:
    domain: DataFrame
    source: DataFrame
    entity: DataFrame
    url: DataFrame
    reference: DataFrame
    url_queue: DataFrame
    entity_queue: DataFrame
    sequence: DataFrame

    def with_(self, **kw) -> "GraphState":
        return replace(self, **kw)

    def tables(self) -> dict[str, DataFrame]:
        return {k: getattr(self, k) for k in SCHEMAS}


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def empty_state(spark: SparkSession, entity: DataFrame | None = None) -> GraphState:
    t = {k: empty_table(spark, k) for k in SCHEMAS}
    if entity is not None:
        t["entity"] = entity
    return GraphState(**t)


#: What tells the rows of a table apart; references only append, of the sequence the last row counts.
KEYS = {"domain": "domain_id", "source": "source_id", "entity": "entity_id", "url": "url_id", "url_queue": "url_id",
        "entity_queue": "name"}


def replaced(table: DataFrame, rows: DataFrame, key: str, gone: DataFrame | None = None) -> DataFrame:
    """``table`` with ``rows`` new or in place of those with their key, without the keys of ``gone``.
    The changed side is the small one; adaptive execution sizes it from what it measures."""
    away = rows.select(key) if gone is None else rows.select(key).unionByName(gone.select(key))
    return table.join(away, key, "left_anti").select(*table.columns).unionByName(rows.select(*table.columns))


def merged(state: GraphState, changes: dict[str, DataFrame], gone: dict[str, DataFrame] | None = None) -> GraphState:
    """The state after a batch: ``changes`` (rows by table) and ``gone`` (keys by table) applied."""
    def after(table: str) -> DataFrame:
        now, rows, away = state.tables()[table], changes.get(table), (gone or {}).get(table)
        if table == "sequence":
            return now if rows is None else rows
        if table not in KEYS:
            return now if rows is None else now.unionByName(rows.select(*now.columns))
        if rows is None:
            return now if away is None else now.join(away.select(KEYS[table]), KEYS[table], "left_anti")
        return replaced(now, rows, KEYS[table], away)
    return GraphState(**{t: after(t) for t in SCHEMAS})


# ---------------------------------------------------------------- dense ids

def assign_dense_ids(df: DataFrame, order_cols: list[str], id_col: str, start: int) -> DataFrame:
    """Add ``id_col = start + rank`` (0-based) in ``order_cols`` order, without a
    global window: range-partition and sort, checkpoint to pin partition
    membership, count rows per partition, and add each partition's offset
    (one row per partition: a broadcast bounded by the partition count).
    Ties in ``order_cols`` get distinct ids in arbitrary order.
    """
    ordered = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    tagged = cut_lineage(
        ordered.withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    local = tagged.withColumn("_idx", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        local.join(F.broadcast(offsets), "_pid")
        .withColumn(id_col, (F.lit(int(start)) + F.col("_off") + F.col("_idx")).cast("long"))
        .drop("_pid", "_mid", "_idx", "_off")
    )


def next_id(table: DataFrame, id_col: str) -> int:
    """max(id) + 1 (1 for an empty table); a single scalar to the driver."""
    return int(table.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).first()["m"]) + 1


# ---------------------------------------------------------------- H1

def insert_if_absent(table: DataFrame, batch: DataFrame, key: list[str], id_col: str,
                     order_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """H1: rows of ``batch`` whose ``key`` is not in ``table`` get fresh ids
    (max id + dense position by ``order_col``, else by key). Rows already present
    are left as they are. A key with a NULL part never equals another one (as
    for a unique constraint), so such rows are always inserted.

    Returns (next table, inserted rows)."""
    rest = [c for c in batch.columns if c not in key]
    has_null = F.lit(False)
    for k in key:
        has_null = has_null | F.col(k).isNull()
    plain = batch.where(~has_null)
    if order_col is None:
        if rest:
            raise ValueError(f"an order column must say which row of a repeated key gives {rest}")
        plain = plain.dropDuplicates(key)
    else:
        plain = (plain.groupBy(*key).agg(F.min_by(F.struct(*rest), F.col(order_col)).alias("_r"))
                 .select(*key, "_r.*"))
    fresh = plain.join(table.select(*key), key, "left_anti").unionByName(batch.where(has_null))
    order = [order_col] if order_col else key + rest
    inserted = assign_dense_ids(fresh, order, id_col, next_id(table, id_col))
    inserted = inserted.select(*[F.col(c) if c in inserted.columns else F.lit(None).alias(c) for c in table.columns])
    return table.unionByName(inserted), inserted


# ---------------------------------------------------------------- H3-H5

def queue_upsert(queue: DataFrame, batch: DataFrame, key: str, seq_col: str = "seq") -> DataFrame:
    """H3: on key conflict the newest batch priority replaces the old one; within a
    batch the last row by ``seq`` wins. Map-side partial max_by per key."""
    prio_cols = [c for c in queue.columns if c != key]
    old = queue.select(key, *prio_cols, F.lit(-1).cast("long").alias("_o"), F.lit(0).alias("_b"))
    new = batch.select(key, *prio_cols, F.col(seq_col).cast("long").alias("_o"), F.lit(1).alias("_b"))
    return (
        old.unionByName(new)
        .groupBy(key)
        .agg(F.max_by(F.struct(*prio_cols), F.struct("_b", "_o")).alias("_r"))
        .select(key, "_r.*")
    )


def queue_update(queue: DataFrame, batch: DataFrame, key: str, seq_col: str | None = None) -> DataFrame:
    """H4: new priority for keys present in the queue; absent keys have no effect. Of a
    key's rows in one batch the last by ``seq_col`` wins, the highest without one."""
    prio_cols = [c for c in queue.columns if c != key]
    new = F.struct(*[F.col(c).alias(f"_new_{c}") for c in prio_cols])
    b = batch.groupBy(key).agg((F.max_by(new, F.col(seq_col)) if seq_col else F.max(new)).alias("_r")).select(key, "_r.*")
    j = queue.join(b, key, "left")
    return j.select(key, *[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) for c in prio_cols])


def queue_remove(queue: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """H5: remove keys; absent keys have no effect."""
    return queue.join(keys.select(key).distinct(), key, "left_anti")


# ---------------------------------------------------------------- H6

def touch_urls(url: DataFrame, seen: DataFrame, as_of) -> DataFrame:
    """H6: last_crawled = greatest(last_crawled, as_of) for seen full_urls."""
    s = seen.select("full_url").distinct().withColumn("_seen", F.lit(True))
    j = url.join(s, "full_url", "left")
    ts = F.lit(as_of).cast("timestamp")
    return j.select(
        "url_id", "source_id", "full_url", "first_seen",
        F.when(F.col("_seen"), F.greatest(F.coalesce(F.col("last_crawled"), ts), ts))
        .otherwise(F.col("last_crawled")).alias("last_crawled"),
    )


# ---------------------------------------------------------------- H8

#: What no row may have: rule -> (table, condition).
ROW_RULES = {
    "domain.quality_range": ("domain", "quality_score < -1 or quality_score > 1"),
    "domain.name_not_null": ("domain", "domain_name is null"),
    "source.type_not_null": ("source", "source_type is null"),
    "entity.name_not_null": ("entity", "name is null"),
    "url.full_url_not_null": ("url", "full_url is null"),
    "reference.relevance_range": ("reference", "relevance < 0 or relevance > 1"),
    "url_queue.priority_range": ("url_queue", "priority_int < 0 or priority_int > 100"),
    "url_queue.url_id_not_null": ("url_queue", "url_id is null"),
    "entity_queue.priority_range": ("entity_queue", "priority_int < 0 or priority_int > 100"),
    "entity_queue.name_not_null": ("entity_queue", "name is null"),
}
#: What no two rows may share, unless a part of it is null: rule -> (table, columns).
UNIQUE_RULES = {
    "domain.name_unique": ("domain", ["domain_name"]),
    "source.domain_type_unique": ("source", ["domain_id", "source_type"]),
    "entity.name_address_unique": ("entity", ["name", "address"]),
    "url.full_url_unique": ("url", ["full_url"]),
    "url_queue.url_id_unique": ("url_queue", ["url_id"]),
    "entity_queue.name_unique": ("entity_queue", ["name"]),
}


def _report(rows: dict[str, DataFrame], whole: dict[str, DataFrame]) -> DataFrame:
    """(rule, violations): row rules over ``rows``, unique rules over ``whole``, for the tables given."""
    parts = []
    for table, df in rows.items():
        own = {r: c for r, (t, c) in ROW_RULES.items() if t == table}
        if own:
            counted = df.agg(*(F.coalesce(F.count_if(F.expr(c)), F.lit(0)).cast("long").alias(r) for r, c in own.items()))
            parts.append(counted.select(F.inline(F.array(*(
                F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").alias("violations")) for r in own)))))
    for rule, (table, keys) in UNIQUE_RULES.items():
        if table in whole:
            parts.append(whole[table].dropna(subset=keys).groupBy(*keys).count().where("count > 1").agg(
                F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("violations"))
                .select(F.lit(rule).alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def constraint_report(state: GraphState) -> DataFrame:
    """H8: one row per rule with its violation count (a write fails if any > 0)."""
    return _report(state.tables(), state.tables())


def change_report(state: GraphState, changed: dict[str, DataFrame]) -> DataFrame:
    """H8 for a batch: the rules of the tables in ``changed`` over the rows that it wrote, and, for
    unique columns, over the rows of ``state`` (which holds them) that share a value with those."""
    def touched(table: str, df: DataFrame) -> DataFrame:
        keys = {c for t, cols in UNIQUE_RULES.values() if t == table for c in cols}
        own = [c for c in state.tables()[table].columns if c in keys]
        return state.tables()[table].select(*own).join(df.select(*own).distinct(), own, "left_semi")

    unique = {t for t, _ in UNIQUE_RULES.values()}
    ruled = unique | {t for t, _ in ROW_RULES.values()}
    changed = {t: df for t, df in changed.items() if t in ruled}
    if not changed:
        return state.domain.sparkSession.createDataFrame([], "rule string, violations long")
    return _report(changed, {t: touched(t, df) for t, df in changed.items() if t in unique})


class ConstraintError(ValueError):
    """A state that breaks its rules; the message names each rule and its count."""


def raise_if_broken(report: DataFrame) -> None:
    """One row a rule reaches the driver."""
    broken = report.where("violations > 0").collect()
    if broken:
        raise ConstraintError(", ".join(f"{r['rule']}: {r['violations']}" for r in broken))


def check_constraints(state: GraphState) -> None:
    raise_if_broken(constraint_report(state))


# ---------------------------------------------------------------- D8

def cascade_delete(state: GraphState, domains: DataFrame | None = None,
                   entities: DataFrame | None = None) -> GraphState:
    """Deleting domains removes their sources -> urls -> references and queue
    rows; deleting entities removes their references. One left_anti per child."""
    st = state
    if domains is not None:
        dom = st.domain.join(domains.select("domain_name").distinct(), "domain_name", "left_semi")
        gone_src = st.source.join(dom.select("domain_id"), "domain_id", "left_semi")
        gone_url = st.url.join(gone_src.select("source_id"), "source_id", "left_semi")
        st = st.with_(
            domain=st.domain.join(dom.select("domain_id"), "domain_id", "left_anti"),
            source=st.source.join(gone_src.select("source_id"), "source_id", "left_anti"),
            url=st.url.join(gone_url.select("url_id"), "url_id", "left_anti"),
            reference=st.reference.join(gone_url.select("url_id"), "url_id", "left_anti"),
            url_queue=st.url_queue.join(gone_url.select("url_id"), "url_id", "left_anti"),
        )
    if entities is not None:
        ent = st.entity.join(entities.select("entity_id").distinct(), "entity_id", "left_semi")
        st = st.with_(
            entity=st.entity.join(ent.select("entity_id"), "entity_id", "left_anti"),
            reference=st.reference.join(ent.select("entity_id"), "entity_id", "left_anti"),
        )
    return st


# ---------------------------------------------------------------- E5

def queue_lengths(state: GraphState) -> DataFrame:
    """E5: COUNT(*) of each queue."""
    a = state.url_queue.agg(F.count(F.lit(1)).alias("n")).select(F.lit("url_queue").alias("queue"), "n")
    b = state.entity_queue.agg(F.count(F.lit(1)).alias("n")).select(F.lit("entity_queue").alias("queue"), "n")
    return a.unionByName(b)
