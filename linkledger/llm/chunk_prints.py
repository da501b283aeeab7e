"""Document fingerprints by content-defined chunking.

A gear hash of the last 32 bytes, computed for all positions of a text at once,
proposes boundaries; chunk lengths are normalised with a strict mask before the
usual length and a loose one after it, between a least and a greatest length.
Because a boundary depends on the bytes just before it, an edit moves chunks only
near itself. A fingerprint is the set of distinct chunk digests, each weighted by
the bytes that it covers, and the likeness of one to another is the share of its
weight whose digests the other has as well (containment).

Neighbours in id order are compared in one pass: ids are cut into ranges of
about equal counts, and each range also gets the first document of the range
that follows it, so each document meets the next one while its range is read in
order. Texts move once, compressed.

Defined results: null text counts as empty; an empty fingerprint contains, and
is contained in, an empty one only (1.0, else 0.0); a null id comes after all
others in descending order; rows that repeat an id follow each other by text; a
single document is its own next; an empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, whole_text

LEAST, USUAL, MOST = 16, 48, 256
LOOSE, STRICT = 0x1F << 27, 0x7F << 25   # 5 and 7 of the best mixed bits; every strict boundary is a loose one
#: Texts beyond this many bytes are hashed in blocks, which overlap by the gear's window.
BLOCK = 1 << 22
WINDOW = 32

_GEAR = np.random.Generator(np.random.PCG64(2019)).integers(0, 1 << 32, 256, dtype=np.uint32)


def _gear_hash(data: np.ndarray) -> np.ndarray:
    """At each byte, the gear hash of the window that ends there: doubling spans."""
    h = _GEAR[data]
    span = 1
    while span < WINDOW:
        shifted = h[:-span] << np.uint32(span)
        h = h.copy()
        h[span:] += shifted
        span *= 2
    return h


def boundaries(data: bytes) -> list[int]:
    """Chunk ends, the last one the text's end."""
    n = len(data)
    loose, strict = [], []
    for at in range(0, n, BLOCK):
        lead = min(at, WINDOW - 1)
        h = _gear_hash(np.frombuffer(data, np.uint8, min(n, at + BLOCK) - at + lead, at - lead))[lead:]
        where = np.flatnonzero((h & np.uint32(LOOSE)) == 0)
        loose += (where + (at + 1)).tolist()
        strict += (where[(h[where] & np.uint32(STRICT)) == 0] + (at + 1)).tolist()
    ends, start = [], 0
    while n - start > LEAST:
        usual, most = start + USUAL, start + MOST
        k = bisect_left(strict, start + LEAST)
        if k < len(strict) and strict[k] < usual:
            end = strict[k]
        else:
            k = bisect_left(loose, usual)
            end = loose[k] if k < len(loose) and loose[k] < most else most
        if end >= n:
            break
        ends.append(end)
        start = end
    return ends + [n] if n else []


def chunk_set(text: str) -> dict[int, int]:
    """Chunk digest -> bytes covered."""
    from xxhash import xxh3_64_intdigest

    data = text.encode()
    out: dict[int, int] = {}
    start = 0
    for end in boundaries(data):
        d = xxh3_64_intdigest(data[start:end]) >> 16
        out[d] = out.get(d, 0) + end - start
        start = end
    return out


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """The share of a's weight that b holds: of a chunk, at most as much as b has."""
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    return sum(min(w, b[d]) for d, w in a.items() if d in b) / sum(a.values())


def written(chunks: dict[int, int]) -> str:
    """As text: digest:weight in order of digest."""
    return " ".join(f"{d:012x}:{w}" for d, w in sorted(chunks.items()))


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the next text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, fingerprint (of the whole text)."""
    def start():
        return lambda texts: (None, [pa.array([len(t) for t in texts], pa.int64()),
                                     [written(chunk_set(t)) for t in texts]])

    return map_texts(docs, id_col, text_col, start, "n_chars long, fingerprint string").withColumnRenamed("_id", id_col)


LOWEST = -(1 << 63)

NEIGHBOURS = T.StructType([
    T.StructField("_key", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType())])


def neighbour_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       ranges: int | None = None) -> DataFrame:
    """Per row, with the next document in descending order of a long id (after the
    last comes the first): id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. ``ranges`` defaults to the session's
    number of shuffle partitions; one long for each reaches the driver."""
    spark = docs.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("_key"))
    cuts = order.agg(F.percentile_approx("_key", [k / n for k in range(1, n)] or [0.5], max(10_000, 20 * n))).first()[0]
    # range k holds the keys in (cuts[k - 1], cuts[k]]
    cuts = sorted(set(cuts or []))

    def highest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            top = b.groupby(np.searchsorted(cuts, b["_key"].to_numpy(np.int64)))["_key"].max()
            yield pd.DataFrame({"_range": top.index, "_top": top.to_numpy()})

    tops = sorted((r[0], r[1]) for r in order.mapInPandas(highest, "_range int, _top long").groupBy("_range")
                  .agg(F.max("_top")).collect())
    # what follows range k in descending order is the top of the range below; below the lowest, the highest
    sent_to = {key: tops[(k + 1) % len(tops)][0] for k, (_, key) in enumerate(tops)}

    def squeeze(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            key = b["_key"].to_numpy(np.int64)
            z = [pack(t.encode()) for t in b["_text"]]
            own = pd.DataFrame({"_range": np.searchsorted(cuts, key), "_after": 0, "_key": key, "_z": z})
            yield own
            also = own[own["_key"].isin(sent_to)]
            if len(also):
                yield also.assign(_range=also["_key"].map(sent_to), _after=1)

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from hashlib import sha256

        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        prev = None
        for b in batches:
            out = []
            for key, after, z in zip(b["_key"], b["_after"], b["_z"]):
                if after and prev is None:
                    continue                         # the range is done, or holds nothing
                text = unpack(z).decode()
                chunks = chunk_set(text)
                if prev is not None:
                    p_key, p_text, p_chunks = prev
                    e = edited(p_text, text)
                    e_chunks = chunk_set(e)
                    out.append((p_key, len(p_text), sha256(e.encode()).hexdigest(), written(p_chunks),
                                written(e_chunks), containment(p_chunks, e_chunks), containment(p_chunks, chunks)))
                prev = None if after else (key, text, chunks)
            if out:
                yield pd.DataFrame(out, columns=NEIGHBOURS.names)

    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("_key"),
                      whole_text(text_col).alias("_text"))
    dealt = src.mapInPandas(squeeze, "_range int, _after int, _key long, _z binary")
    return (dealt.repartitionById(max(1, len(cuts) + 1), F.col("_range"))
            .sortWithinPartitions(F.col("_after"), F.col("_key").desc(), F.col("_z"))
            .drop("_range")
            .mapInPandas(sweep, NEIGHBOURS)
            .select(F.nullif("_key", F.lit(LOWEST)).alias(id_col), *NEIGHBOURS.names[1:]))
