"""URL filters by a sort-merge range join of pages with nested host rules.

A host's key is its labels in reverse, each closed by a dot: ``a.example.net`` is
``net.example.a.``. A rule's host covers exactly the keys that start with its own
key, an interval of the sorted order, and two intervals nest or are disjoint. So
one sweep over pages and rules in key order can keep a stack of the rule hosts
that are active, and judge each page against the stack.

Pages and rules are sorted by range partitioning; the page id is part of the
order, so a host with a third of all pages is spread over partitions. A
partition can begin inside intervals that opened before it. Those are the
ancestors of its first key, at most one for each label, and a join of the first
keys with the rules finds them.

A rule is a host and a path: it fits its host and all subdomains where the page's
path starts with the rule's. Of the rules that fit, the longest (host and path)
wins, the longer host on a tie; without one, ``default`` holds.

Defined results: a null url, or one without ``://``, has empty host and path and
gets the default; a null id is kept; repeated rows are judged each; of rules that
repeat a host and path, ``block`` wins; rules with a null part are ignored; empty
tables of either kind work. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def url_host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    at = F.instr(url, "://")
    host = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*", 0)
    return F.coalesce(F.when(at > 0, F.translate(host, ascii_uppercase, ascii_lowercase)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.coalesce(F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class ActiveRules:
    """The stack of nested rule hosts that a sweep in key order has open."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, dict[str, tuple[str, str]], list[int]]] = []

    def close(self, key: str) -> None:
        """Drop the intervals that end before ``key``."""
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, path: str, rule: str, verdict: str) -> None:
        self.close(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}, []))
        _, paths, lengths = self.stack[-1]
        if paths.setdefault(path, (rule, verdict))[1] != verdict:
            paths[path] = (rule, "block")
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def judge(self, path: str) -> tuple[str, str] | None:
        """The longest rule that fits, from the innermost host outwards."""
        best = None
        for _, paths, lengths in reversed(self.stack):
            for n in lengths:
                hit = paths.get(path[:n]) if n <= len(path) else None
                if hit:
                    if best is None or len(hit[0]) > len(best[0]):
                        best = hit
                    break
        return best


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """Per page: id, host, path, rule, verdict. ``rules``: (host, path, verdict)."""
    url = F.col(url_col)
    page = pages.select(F.col(id_col).alias("_id"), url_host(url).alias("host"), url_path(url).alias("path")).select(
        host_key(F.col("host")).alias("_key"), F.lit(1).alias("_kind"), "_id", "host", "path",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    rule = rules.where("host is not null and path is not null and verdict is not null").select(
        host_key(F.lower("host")).alias("_key"), F.lit(0).alias("_kind"),
        F.lit(None).cast(page.schema["_id"].dataType).alias("_id"), F.lower("host").alias("host"), "path",
        F.concat(F.lower("host"), "path").alias("rule"), "verdict").distinct()
    order = ["_key", "_kind", "_id"]
    swept = cut_lineage(page.unionByName(rule).repartitionByRange(*order, "path").sortWithinPartitions(*order)
                        .withColumn("_part", F.spark_partition_id()))

    firsts = swept.groupBy("_part").agg(F.min("_key").alias("_first"))
    labels = F.split(F.col("_first"), r"\.")
    above = firsts.select("_part", F.explode(F.transform(
        F.sequence(F.lit(1), F.array_size(labels) - 1),
        lambda k: F.concat(F.array_join(F.slice(labels, 1, k), "."), F.lit(".")))).alias("_key"))
    open_at: dict[int, list[tuple[str, str, str, str]]] = {}
    # for each partition, the rules of its first key's ancestors
    for r in above.join(rule, "_key").select("_part", "_key", "path", "rule", "verdict").collect():
        open_at.setdefault(r["_part"], []).append((r["_key"], r["path"], r["rule"], r["verdict"]))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        active = None
        for b in batches:
            rows, judged = [], []
            columns = (b.column(c).to_pylist() for c in ("_part", "_key", "_kind", "host", "path", "rule", "verdict"))
            for row, (part, key, kind, host, path, rule_, verdict) in enumerate(zip(*columns)):
                if active is None:
                    active = ActiveRules()
                    for inherited in sorted(open_at.get(part, ())):
                        active.open(*inherited)
                if kind == 0:
                    active.open(key, path, rule_, verdict)
                    continue
                active.close(key)
                rows.append(row)
                judged.append(active.judge(path) or (None, default))
            seen = b.take(pa.array(rows, pa.int64()))
            rule_, verdict = map(list, zip(*judged)) if judged else ([], [])
            yield pa.RecordBatch.from_arrays(
                [seen.column("_id"), seen.column("host"), seen.column("path"), pa.array(rule_, pa.string()),
                 pa.array(verdict, pa.string())], names=["_id", "host", "path", "rule", "verdict"])

    kind = page.schema["_id"].dataType.simpleString()
    return swept.mapInArrow(sweep, f"_id {kind}, host string, path string, rule string, verdict string"
                            ).withColumnRenamed("_id", id_col)
