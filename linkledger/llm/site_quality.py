"""Quality classifier by hierarchical empirical Bayes over document, path and host.

Evidence: a logistic model of a text's form (shares of letters, signs and capitals,
repetition, word lengths; each in bins) gives every document a probability of
being good. It is fitted on at most ``max_labelled`` labelled rows outside the
held-out fold, a documented bound.

Sites: documents are summed by host and path, paths by host, hosts overall. A
host's posterior shrinks its mean probability toward the global one, and a path's
toward its host's. How strongly is estimated from the sums themselves: the spread
of means between hosts (or between paths within hosts), beyond what their sizes
explain, gives the weight of the prior in documents. A sparse site so says little,
and one that has shown many documents is believed.

A document's score is its own evidence with the prior odds moved from the global
rate to its path's, its own share taken out of the sums. Sums by key are partial
before the shuffle; the site tables have one row a path.

Defined results: null text counts as empty; a null host or path is a host or path
of its own; labels repeated for an id count as good if one does; null labels and
ids of labels are ignored; without labels of both classes the evidence is 0.5 for
all; repeated rows each count and score alike; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import hash_fold, whole_text

MAX_LABELLED = 20_000
BINS = 12
#: Code points beyond ASCII count as letters.
_LETTER, _CAPITAL, _DIGIT, _BLANK, _SIGN = range(5)
_CLASS = np.array([_BLANK if c < 33 else _DIGIT if 48 <= c < 58 else _CAPITAL if 65 <= c < 91 else
                   _LETTER if 97 <= c < 123 else _SIGN for c in range(128)] + [_LETTER], np.uint8)
FEATURES = 11


def features(text: str) -> list[float]:
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    letters, capitals, digits, blanks, signs = np.bincount(_CLASS[np.minimum(points, 128)], minlength=5).tolist()
    dense = max(1, len(points) - blanks)
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x]
    again = sum(a == b for a, b in zip(words, words[1:]))
    return [np.log2(1 + len(words)), (letters + capitals) / dense, capitals / dense, digits / dense, signs / dense,
            len(set(words)) / n ** 0.9, dense / n, sum(len(w) <= 3 for w in words) / n, again / n,
            1 - len(set(lines)) / max(1, len(lines)), len(lines) / n]


def _binned(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """One column for each bin of each feature, and a constant."""
    out = np.zeros((len(x), FEATURES * BINS + 1))
    for f in range(FEATURES):
        out[np.arange(len(x)), f * BINS + np.searchsorted(cuts[f], x[:, f])] = 1
    out[:, -1] = 1
    return out


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray] | None:
    """(cuts, weights) of the evidence; None without both classes."""
    if not 0 < y.sum() < len(y):
        return None
    cuts = np.quantile(x, np.arange(1, BINS) / BINS, axis=0).T
    a, b = _binned(x, cuts), np.zeros(FEATURES * BINS + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(b)), a.T @ (y - p) - ridge * b)
        b += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return cuts, b


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = pa.array([features(t) for t in b.column(0).to_pylist()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([x, b.column(1)], names=["x", "y"])


def _evidence_of(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if held.value is None or not len(b):
            p = np.full(len(b), 0.5)
        else:
            cuts, weights = held.value
            z = _binned(np.array([features(t) for t in b.column(0).to_pylist()]), cuts) @ weights
            p = 1 / (1 + np.exp(-np.clip(z, -12, 12)))
        yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(p)], names=[*b.schema.names[1:], "p"])


def evidence(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, host: Column,
             path: Column, folds: int, max_labelled: int) -> DataFrame:
    """(_id, _host, _path, p): the classifier's probability of each document."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (hash_fold(id_col, folds) != 0))
             .groupBy(F.col(id_col).alias("_lid")).agg(F.max(F.when(F.col(label_col) == 1, 1.0).otherwise(0.0)).alias("_y"))
             .orderBy(F.xxhash64("_lid"), "_lid").limit(max_labelled))
    src = docs.select(whole_text(text_col).alias("_text"), F.col(id_col).alias("_id"), host.alias("_host"), path.alias("_path"))
    # at most max_labelled rows of two numbers are broadcast, and as many of a few numbers come back
    seen = (src.join(F.broadcast(known), F.col("_id") == F.col("_lid")).select("_text", "_y")
            .mapInArrow(_features_of, "x array<double>, y double").toPandas())
    fitted = None
    if len(seen):
        x = np.array(seen["x"].tolist())
        order = np.lexsort((*x.T, seen["y"].to_numpy()))      # a fixed order, so that reruns agree
        fitted = fit(x[order], seen["y"].to_numpy()[order])
    held = docs.sparkSession.sparkContext.broadcast(fitted)
    kind = src.schema["_id"].dataType.simpleString()
    return src.mapInArrow(partial(_evidence_of, held=held), f"_id {kind}, _host string, _path string, p double")


def _strength(spread: float | None, rate: float) -> float:
    """Documents that the prior counts for, from the variance of means between groups."""
    if spread is None or spread <= 0:
        return 1e6
    return min(1e6, max(1.0, rate * (1 - rate) / spread - 1))


def _between(groups: DataFrame, of: str, around: Column) -> float | None:
    """Variance of group means around ``around``, less what their sizes explain."""
    mean = F.col(f"s{of}") / F.col(f"n{of}")
    many = groups.where(F.col(f"n{of}") > 1)
    got = many.agg(F.sum(F.col(f"n{of}") * (mean - around) ** 2), F.sum(f"q{of}"), F.sum(f"n{of}"), F.count("*")).first()
    off, squares, n, count = got
    if not count or n <= count:
        return None
    within = squares / (n - count)                    # pooled variance of a document about its group's mean
    return (off - count * within) / n


def site_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 host: Column | None = None, path: Column | None = None, label_col: str = "quality",
                 folds: int = 5, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per row: id, evidence, path_posterior, host_posterior, score, predicted, held_out.
    ``host`` and ``path`` are columns of ``docs``, by default its source and language."""
    def key(c: Column) -> Column:
        return F.when(c.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), c.cast("string")))

    host, path = key(F.col("source") if host is None else host), key(F.col("lang") if path is None else path)
    docs_p = cut_lineage(evidence(docs, labels, id_col, text_col, label_col, host, path, folds, max_labelled))

    exact = F.col("p").cast("decimal(20,9)")          # sums that do not depend on their order
    paths = docs_p.groupBy("_host", "_path").agg(
        F.count(F.lit(1)).alias("np"), F.sum(exact).cast("double").alias("sp"),
        F.sum((F.col("p") * F.col("p")).cast("decimal(20,9)")).cast("double").alias("_pp"))
    paths = cut_lineage(paths.withColumn("qp", F.greatest(F.lit(0.0), F.col("_pp") - F.col("sp") ** 2 / F.col("np"))))
    hosts = cut_lineage(paths.groupBy("_host").agg(
        F.sum("np").alias("nh"), F.sum(F.col("sp").cast("decimal(30,9)")).cast("double").alias("sh"),
        F.sum(F.col("_pp").cast("decimal(30,9)")).cast("double").alias("_hh"))
        .withColumn("qh", F.greatest(F.lit(0.0), F.col("_hh") - F.col("sh") ** 2 / F.col("nh"))))
    n, s = hosts.agg(F.sum("nh"), F.sum("sh")).first()
    rate = min(1 - 1e-6, max(1e-6, s / n)) if n else 0.5
    kh = _strength(_between(hosts, "h", F.lit(rate)), rate)
    sites = paths.join(hosts.select("_host", "nh", "sh"), "_host")
    kp = _strength(_between(sites, "p", F.col("sh") / F.col("nh")), rate)

    # the document's own share is taken out before its site speaks about it
    h = (F.col("sh") - F.col("p") + kh * rate) / (F.col("nh") - 1 + kh)
    q = (F.col("sp") - F.col("p") + kp * F.col("host_posterior")) / (F.col("np") - 1 + kp)

    def logit(x: Column) -> Column:
        x = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), x))
        return F.log(x / (1 - x))

    odds = logit(F.col("p")) + logit(F.col("path_posterior")) - logit(F.lit(rate))
    # rows of a hot path meet one row, and adaptive execution splits them
    return (docs_p.join(sites.select("_host", "_path", "np", "sp", "nh", "sh"), ["_host", "_path"])
            .withColumn("host_posterior", h).withColumn("path_posterior", q)
            .withColumn("score", 1 / (1 + F.exp(-odds)))
            .select(F.col("_id").alias(id_col), F.col("p").alias("evidence"), "path_posterior", "host_posterior",
                    "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                    (F.coalesce(hash_fold("_id", folds), F.lit(0)) == 0).alias("held_out")))
