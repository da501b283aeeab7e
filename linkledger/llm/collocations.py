"""Phrase collocation mining over count streams in prefix and suffix order.

Words are numbered as an external language-model estimator does it: one pass cuts the
texts into blocks, each with its own vocabulary, and the words that the corpus holds
often enough get ids through a join with each block's vocabulary. A block then gives the
counts of its word triples (the third may be missing at the end of a piece), once each.

Counting is a sweep over those triples in order: range-partitioned and sorted by
(first, second, third) word, equal triples and the pairs that begin them are
neighbours, so their sums need no table. Runs at the edge of a partition are passed on
in parts and added up.

Counts of single words, pairs and triples form one stream. Sorted in prefix order, (w),
(w x), (w x y) follow each other, and a sweep in lockstep attaches to each phrase the
counts of the words that begin it, and to each pair its most frequent extension to the
right. Sorted in suffix order, by last word first, the same sweep gives the counts
of the words that end it and its most frequent extension to the left. A partition takes
over the open word and pair of its first row; these go through the driver, one row a
partition. Nothing else does, and no count is looked up by hash.

Only words, pairs and triples counted ``least`` times or more matter to the result: a
candidate's parts are at least as frequent as itself.

Defined results: null text is empty, null lang counts as ``und``; empty and blank texts
give nothing; rows that repeat count each; texts are cut nowhere but at the ends of
pieces, however long; ties are ordered by the phrase's UTF-8 bytes; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.state import assign_dense_ids
from ..session import cut_lineage, ensure_checkpoint_dir
from .common import whole_text

LEAST, TOP, ABSORBED = 10, 2000, 50
SALTS = 64
UNKNOWN_LANG = "und"
#: Bytes of text of a block; a longer text is cut at the end of a piece.
BLOCK_BYTES = 1 << 24

_PIECE_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
_WORD, _BLANK, _END = 0, 1, 2
#: What each byte is; bytes of longer UTF-8 characters are part of words.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = _BLANK
KIND[list(b".,;:!?\x0A\x0B\x0C\x0D")] = _END
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


# ---------------------------------------------------------------- blocks

_BLOCK_FIELDS = [("block", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("no", pa.int32()),
                 ("n", pa.int64()), ("words", pa.binary())]
BLOCKS = "block long, lang string, word string, no int, n long, words binary"


def _press(x: np.ndarray) -> bytes:
    """Numbers of 32 bits: all first bytes, then all second ones, and so on."""
    raw = x.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpress(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


def word_numbers(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The distinct words, and the texts as numbers of words from 1, with 0 between pieces."""
    text = np.frombuffer(b"\n".join(texts), np.uint8)
    kind = KIND[text]
    inside = kind == _WORD
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = np.flatnonzero(begins)
    if not len(at):
        return pa.array([], pa.string()), np.zeros(0, np.int32)
    pieces = np.cumsum(kind == _END, dtype=np.int32)[at]
    ends = np.append(np.cumsum(inside, dtype=np.int32)[at] - 1, np.count_nonzero(inside)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(LOWER[text[inside]]))
    coded = words.dictionary_encode()
    new = np.diff(pieces, prepend=pieces[0]) > 0
    numbers = np.zeros(len(at) + int(new.sum()), np.int32)
    numbers[np.arange(len(at)) + np.cumsum(new)] = coded.indices.to_numpy() + 1
    return coded.dictionary, numbers


def _block(number: int, lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    words, numbers = word_numbers(texts)
    if not len(words):
        return
    counts = np.bincount(numbers, minlength=len(words) + 1)[1:]
    k = len(words)
    schema = pa.schema(_BLOCK_FIELDS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(k, number)), pa.array([lang] * k), words, pa.array(np.arange(1, k + 1, dtype=np.int32)),
         pa.array(counts.astype(np.int64)), pa.nulls(k, pa.binary())], schema=schema)
    yield pa.RecordBatch.from_pylist([{"block": number, "lang": lang, "n": k, "words": _press(numbers)}], schema=schema)


def _cut(text: bytes) -> Iterator[bytes]:
    """The text in parts of about a block, cut where pieces end."""
    at = 0
    while len(text) - at > BLOCK_BYTES and (end := _PIECE_END.search(text, at + BLOCK_BYTES)):
        yield text[at:end.start()]
        at = end.end()
    yield text[at:]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    held: dict[str, list[bytes]] = {}
    size = 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            for part in _cut(text):
                held.setdefault(lang, []).append(part)
                size += len(part) + 1
                if size >= BLOCK_BYTES:
                    for number, (of, texts) in enumerate(held.items(), number):
                        yield from _block(number, of, texts)
                    held, size, number = {}, 0, number + 1
    for number, (of, texts) in enumerate(held.items(), number):
        yield from _block(number, of, texts)


def _kept(df: DataFrame) -> DataFrame:
    """Written to the checkpoint folder and read again, packed closer than a checkpoint."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/collocations-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# ---------------------------------------------------------------- counts

TRIPLES = "a long, b long, c long, n long"


def _triples(known: pa.Table, block: pa.Table) -> pa.Table:
    """(a, b, c, n): the ids of two or three neighbours in a piece, the third 0 where there
    is none; words that the corpus holds too rarely end a piece."""
    empty = pa.table([pa.array([], pa.int64())] * 4, names=list("abcn"))
    if not block.num_rows or not known.num_rows:
        return empty
    local = np.zeros(block.column("n")[0].as_py() + 1, np.int64)
    local[known.column("no").to_numpy()] = np.arange(1, known.num_rows + 1)
    ids = np.append(0, known.column("id").to_numpy())
    x = np.append(local[_unpress(block.column("words")[0].as_py())], (0, 0))
    here = np.flatnonzero((x[:-2] > 0) & (x[1:-1] > 0))
    k = len(ids)
    pairs, pair = np.unique(x[here] * k + x[here + 1], return_inverse=True)
    triples, n = np.unique(pair * k + x[here + 2], return_counts=True)
    first = pairs[triples // k]
    return pa.table([ids[first // k], ids[first % k], ids[triples % k], n.astype(np.int64)], names=list("abcn"))


class Runs:
    """Sums over neighbours with equal keys, of columns that come in batches."""

    def __init__(self, least: int):
        self.least = least
        self.open: tuple | None = None
        self.first = True

    def add(self, keys: list[np.ndarray], n: np.ndarray) -> list[np.ndarray]:
        """The runs that have ended, as the key's columns and the sum: those of ``least`` or more,
        and the first, which may have begun in the partition before."""
        if self.open is not None:
            keys = [np.append(k, c) for k, c in zip(self.open, keys)]
            n = np.append(self.open[-1], n)
        if not len(n):
            return [*keys, n]
        new = np.zeros(len(n), bool)
        new[0] = True
        for c in keys:
            new[1:] |= c[1:] != c[:-1]
        at = np.flatnonzero(new)
        columns = [*(c[at] for c in keys), np.add.reduceat(n, at)]
        self.open = tuple(c[-1] for c in columns)
        columns = [c[:-1] for c in columns]
        told = columns[-1] >= self.least
        if self.first and len(told):
            told[0], self.first = True, False
        return [c[told] for c in columns]

    def end(self) -> list[np.ndarray]:
        """The last run, which may go on in the next partition."""
        return [np.array([c], np.int64) for c in self.open or ()]


def _numbers(b: pa.RecordBatch, names: str) -> list[np.ndarray]:
    return [b.column(c).to_numpy() for c in names]


def _batch(columns: list[np.ndarray], names: str | list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list(names))


def sums_in_order(triples: DataFrame, least: int) -> DataFrame:
    """(a, b, c, n) of the triples (c > 0) and pairs (c = 0) counted ``least`` times or more."""
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triple, pair = Runs(least), Runs(least)

        def told(three: list[np.ndarray], two: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if three:
                yield _batch([c[three[2] > 0] for c in three], "abcn")
            if two:
                yield _batch([two[0], two[1], np.zeros_like(two[0]), two[2]], "abcn")

        for b in batches:
            a, b_, c, n = _numbers(b, "abcn")
            yield from told(triple.add([a, b_, c], n), pair.add([a, b_], n))
        yield from told(triple.end(), pair.end())

    ordered = triples.repartitionByRange("a", "b", "c").sortWithinPartitions("a", "b", "c")
    return (ordered.mapInArrow(sweep, TRIPLES).groupBy("a", "b", "c").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least))


# ---------------------------------------------------------------- lockstep sweeps

def _beside(keep: np.ndarray, n: np.ndarray, before: int) -> np.ndarray:
    """For each row the count at the last row that ``keep`` marks, itself included."""
    last = np.maximum.accumulate(np.where(keep, np.arange(len(n)), -1))
    return np.where(last >= 0, n[last], before)


def sweep_stream(grams: DataFrame) -> DataFrame:
    """(a, b, c, n, one, two, more) of the phrases in ``grams`` (a, b, c, n), which has all words
    (b = c = 0), pairs (c = 0) and triples, sorted by (a, b, c): ``one`` is the count of a, ``two``
    that of (a, b), ``more`` the highest count of a triple that extends the pair. A pair's
    ``more`` comes in rows of its own, without n."""
    order = ["a", "b", "c"]
    stream = cut_lineage(grams.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_part", F.spark_partition_id()))
    firsts = stream.groupBy("_part").agg(F.min(F.struct(*order)).alias("_f")).select("_part", "_f.*")
    words = stream.where("b = 0").select("a", F.col("n").alias("one"))
    pairs = stream.where("b > 0 and c = 0").select("a", "b", F.col("n").alias("two"))
    # one row a partition
    open_at = {r["_part"]: (r["one"] or 0, r["two"] or 0)
               for r in firsts.join(words, "a", "left").join(pairs, ["a", "b"], "left").collect()}

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "c", "n", "one", "two", "more"]
        one = two = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if one is None:
                one, two = open_at[batch.column("_part")[0].as_py()]
            a, b, c, n = _numbers(batch, "abcn")
            ones, twos = _beside(b == 0, n, one), _beside((b > 0) & (c == 0), n, two)
            one, two = ones[-1], twos[-1]
            phrase, triple = b > 0, c > 0
            yield _batch([*(x[phrase] for x in (a, b, c, n, ones)), np.where(triple, twos, 0)[phrase],
                          np.zeros(int(phrase.sum()), np.int64)], names)
            a, b, n = a[triple], b[triple], n[triple]
            if len(n):
                at = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                none = np.zeros(len(at), np.int64)
                yield _batch([a[at], b[at], none, none, none, none, np.maximum.reduceat(n, at)], names)

    return stream.mapInArrow(sweep, TRIPLES + ", one long, two long, more long")


def _big(c: str) -> Column:
    return F.col(c).cast("decimal(19,0)")


def _score(a: str, left: str, right: str) -> Column:
    """Floor of a million times a * a / (left * right), in whole numbers of up to 38 digits."""
    square = (_big(a) * _big(a)).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", square, _big(left) * _big(right))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP,
                 absorbed: int = ABSORBED) -> DataFrame:
    """Per lang its first ``top`` phrases of 2 or 3 words: lang, rank, phrase, a, l, r, n, score.
    A pair goes if a triple around it has ``absorbed`` per cent of its count or more."""
    lang = F.coalesce(F.col(lang_col), F.lit(UNKNOWN_LANG))
    held = _kept(docs.select(lang.alias("lang"), whole_text(text_col).alias("text")).mapInArrow(_blocks, BLOCKS))
    counts = cut_lineage(held.where("word is not null").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    totals = counts.groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("_total"))
    words = cut_lineage(assign_dense_ids(counts.where(F.col("n") >= least), ["lang", "word"], "id", 1))

    known = held.where("word is not null").join(words.select("lang", "word", "id"), ["lang", "word"]).select(
        F.col("block").alias("_block"), "no", "id")
    whole = held.where("word is null").select("block", F.col("n").cast("int").alias("n"), "words")
    triples = _kept(known.groupBy("_block").cogroup(whole.groupBy("block")).applyInArrow(_triples, TRIPLES))

    grams = cut_lineage(sums_in_order(triples, least)).unionByName(
        words.select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("c"), "n"))
    fore = sweep_stream(grams).select(
        "a", "b", "c", "n", F.col("one").alias("l1"), F.col("two").alias("l2"),
        F.lit(0).cast("long").alias("r1"), F.lit(0).cast("long").alias("r2"), "more")
    last = F.when(F.col("c") > 0, F.col("c")).when(F.col("b") > 0, F.col("b")).otherwise(F.col("a"))
    back = sweep_stream(grams.select(
        last.alias("a"), F.when(F.col("c") > 0, F.col("b")).when(F.col("b") > 0, F.col("a")).otherwise(0).alias("b"),
        F.when(F.col("c") > 0, F.col("a")).otherwise(0).alias("c"), "n")).select(
        F.when(F.col("c") > 0, F.col("c")).otherwise(F.col("b")).alias("a"),
        F.when(F.col("c") > 0, F.col("b")).otherwise(F.col("a")).alias("b"),
        F.when(F.col("c") > 0, F.col("a")).otherwise(0).alias("c"), "n",
        F.lit(0).cast("long").alias("l1"), F.lit(0).cast("long").alias("l2"),
        F.col("two").alias("r1"), F.col("one").alias("r2"), "more")
    # a pair's one cut lies before its last word
    phrases = fore.unionByName(back).groupBy("a", "b", "c").agg(
        *(F.max(c).alias(c) for c in ("n", "l1", "l2", "r1", "r2", "more"))).where(
        (F.col("c") > 0) | (100 * F.col("more") < absorbed * F.col("n")))
    first = F.struct(F.when(F.col("c") > 0, _score("n", "l1", "r1")).otherwise(_score("n", "l1", "r2")).alias("score"),
                     F.lit(1).alias("k"), F.col("l1").alias("l"),
                     F.when(F.col("c") > 0, F.col("r1")).otherwise(F.col("r2")).alias("r"))
    second = F.when(F.col("c") > 0, F.struct(_score("n", "l2", "r2").alias("score"), F.lit(2).alias("k"),
                                             F.col("l2").alias("l"), F.col("r2").alias("r")))
    scored = phrases.select("a", "b", "c", "n", F.least(first, second).alias("_cut")).select(
        "a", "b", "c", F.col("n").alias("_n"), "_cut.score", "_cut.l", "_cut.r")

    named = scored.join(words.select(F.col("id").alias("a"), "lang", F.col("word").alias("_1")), "a")
    for of, name in (("b", "_2"), ("c", "_3")):
        named = named.join(words.select(F.col("id").alias(of), F.col("word").alias(name)), of, "left")
    ranked = assign_dense_ids(named.select(
        "lang", F.concat_ws(" ", "_1", "_2", "_3").alias("phrase"), F.col("_n").alias("a"), "l", "r", "score",
        (-F.col("score")).alias("_s"), (-F.col("_n")).alias("_a")), ["lang", "_s", "_a", "phrase"], "_pos", 1)
    # a lang may have most of the phrases: its one row goes to SALTS tasks, and its phrases by place
    starts = (ranked.groupBy(F.col("lang").alias("_lang")).agg(F.min("_pos").alias("_first")).join(totals, "_lang")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    rank = F.col("_pos") - F.col("_first") + 1
    same = (F.col("lang") == F.col("_lang")) & (F.pmod("_pos", F.lit(SALTS)).cast("int") == F.col("_salt"))
    return ranked.join(starts, same).where(rank <= top).select(
        "lang", rank.alias("rank"), "phrase", "a", "l", "r", F.col("_total").alias("n"), "score")
