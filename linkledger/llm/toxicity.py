"""Toxicity by class-conditional Kneser-Ney models.

Models of toxic and of ordinary labelled documents are compared by their
log-likelihoods at two lengths, each normalised by it:

  whole text    character models of words. Each backs off from five characters down to
                three through continuation counts of its own class, and from there to
                one model that both share, of the full order, over the words of every
                document of the corpus, labelled or not. Inflected forms of a known
                stem are met through the stem.
  expression    a word. Its count is the Kneser-Ney one, of distinct documents that
                show it; a class takes ``EXPRESSION`` off it and backs off to the
                counts that all documents of the corpus give. The best expression
                speaks for the text, so a few insults count in a long one; one that the
                toxic class has not shown so often, or the ordinary one more, has ratio 0.

What is gathered: one pass counts the n-grams of blocks of documents, and packs the words of
each block. Counts are summed; n-grams are scored in tables that are joined by n-gram, and
each block meets the ratios of its own, so nothing that grows with the corpus is held by
the driver or by a worker. Of words, those that the labelled rows show often enough are
counted over all blocks. Class counts come from at most ``max_labelled`` labelled rows (those
first in a hash order), the only bound.

The labelled rows are dealt into two halves with models of their own. The two ratios
become a probability by logistic regression on the labelled rows, each scored by the
models of the other half; all rows are scored by both, and the two results are
averaged as log-odds.

Ratios are rounded to 2^-24, so sums do not depend on their order. Blocks carry the ids, so
scores need no join to get back to rows.

Defined results: null or wordless text has ratios 0; labels repeated for an id
count as toxic if one does; null labels and null ids of labels are ignored; with
no toxic labels every score is 0.0, with no ordinary ones 1.0; rows that repeat
score alike; an empty table gives an empty result. Nothing but the text enters a
score.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import cut_lineage, ensure_checkpoint_dir
from .common import hash_fold, whole_text

ORDER, SHARED = 5, 2
DISCOUNT = 0.75
#: What a class takes off the number of its documents that show a word.
EXPRESSION = 3.0
#: Characters at ratio 0 that each text has besides its own, so that a word or two decide little.
PRIOR = 30
MAX_LABELLED = 20_000
#: Words, and distinct words, of the documents of a block.
BLOCK_WORDS, REMEMBERED = 1 << 21, 1 << 18
#: Ratios of n-grams are whole multiples of this.
UNIT = 2.0 ** -24

BEGIN, END = "\x02", "\x03"
_WORD = re.compile(r"[^\W\d_]+")


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


# ---------------------------------------------------------------- counts

#: (half, label), in the order of the counts n00, n01, n10, n11.
CLASSES = [(half, label) for half in (0, 1) for label in (0, 1)]
COUNTS = [f"n{half}{label}" for half, label in CLASSES]
#: Ahead of a word, in the column of n-grams.
WHOLE = "\x01"
#: Words of the labelled sample that are broadcast at most; more are shuffled with the blocks' words.
BROADCAST_WORDS = 1 << 20


def _block_type(id_type: str) -> str:
    return ("block long, gram string, n long, " + "".join(f"{c} long, " for c in COUNTS) +
            f"words binary, places binary, docs array<struct<id:{id_type},key:binary,chars:long,half:int,label:int>>")


def _pressed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpressed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _press(x: np.ndarray) -> bytes:
    """Numbers of 64 bits, their first bytes, then their second ones, and so on."""
    return _pressed(x.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpress(data: bytes) -> np.ndarray:
    return np.frombuffer(_unpressed(data), np.uint8).reshape(8, -1).T.copy().view("<i8").ravel()


def _grams(word: str, order: int = ORDER) -> list[str]:
    """One n-gram for each character and the word's end."""
    x = BEGIN * (order - 1) + word + END
    return [x[i:i + order] for i in range(len(x) - order + 1)]


def _gram_table(vocabulary: list[str]) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """Numbers of the n-grams; those of all the words in a row; how many each word has."""
    numbers: defaultdict = defaultdict()
    numbers.default_factory = numbers.__len__
    sizes = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary)) + 1
    at = np.fromiter((numbers[g] for w in vocabulary for g in _grams(w)), np.int32, int(sizes.sum()))
    return numbers, at, sizes


def _block(number: int, vocabulary: dict[str, int], found: list[np.ndarray], docs: list[dict], schema: pa.Schema
           ) -> Iterator[pa.RecordBatch]:
    words = np.concatenate(found)
    doc = np.repeat(np.arange(len(found)), [len(f) for f in found])
    v = len(vocabulary)
    # one row of the documents, their words, and (document, word), sorted, with how often
    pairs, times = np.unique(doc * max(v, 1) + words, return_counts=True)
    yield pa.RecordBatch.from_pylist([{
        "block": number, "docs": docs, "words": _pressed(" ".join(vocabulary).encode()),
        "places": _press(np.concatenate([np.diff(pairs, prepend=0), times]))}], schema=schema)
    if not v:
        return
    kind = np.array([-1 if d["label"] is None else 2 * d["half"] + d["label"] for d in docs])[doc]
    per_word = [np.bincount(words, minlength=v), *(np.bincount(words[kind == k], minlength=v) for k in range(len(CLASSES)))]
    numbers, at, sizes = _gram_table(list(vocabulary))
    counts = [np.bincount(at, np.repeat(n, sizes), len(numbers)).astype(np.int64) for n in per_word]
    rest = [pa.nulls(len(numbers), schema.field(c).type) for c in ("words", "places", "docs")]
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(numbers), number)), pa.array(list(numbers)),
                                      *map(pa.array, counts), *rest], schema=schema)


def _blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32

    def fresh() -> tuple:
        vocabulary: defaultdict = defaultdict()
        vocabulary.default_factory = vocabulary.__len__
        return vocabulary, [], []

    vocabulary, found, docs = fresh()
    held = 0
    for b in batches:
        for text, id_, key, half, label in zip(*(b.column(k).to_pylist() for k in range(5))):
            words = _words(text)
            found.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
            docs.append({"id": id_, "key": key, "chars": sum(map(len, words)) + len(words), "half": half, "label": label})
            held += len(words) + 1
            if held >= BLOCK_WORDS or len(vocabulary) >= REMEMBERED:
                yield from _block(number, vocabulary, found, docs, schema)
                vocabulary, found, docs = fresh()
                number, held = number + 1, 0
    if docs:
        yield from _block(number, vocabulary, found, docs, schema)


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _kept(df: DataFrame) -> DataFrame:
    """Written to the checkpoint folder and read again, packed closer than a checkpoint."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/toxicity-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def blocks(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Blocks of documents: for each a row of its documents with their words, and a row for
    each n-gram of the highest order with its counts there, over all documents and over the
    labelled ones by half and label."""
    # the right side has at most max_labelled rows of three numbers
    src = (docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
           .join(F.broadcast(known), F.col("_id") == F.col("_lid"), "left")
           .select("_text", "_id", _text_key(F.col("_text")).alias("_key"), "_half", "_label"))
    kind = _block_type(src.schema["_id"].dataType.simpleString())
    schema = to_arrow_schema(_parsed(src, kind))
    return _kept(src.mapInArrow(partial(_blocks, schema=schema), kind))


def _parsed(df: DataFrame, fields: str) -> StructType:
    return df.sparkSession.createDataFrame([], fields).schema


def gram_counts(held: DataFrame) -> DataFrame:
    """(gram, n, n00 .. n11) of the n-grams of the highest order: all of them."""
    return held.where("gram is not null").groupBy("gram").agg(*(F.sum(c).alias(c) for c in ["n", *COUNTS]))


def _shown(vocabulary: str, places: bytes) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words of a block, and what each document shows of them: (document, word), once each."""
    words = vocabulary.split()
    raw = _unpress(places)
    doc, word = np.divmod(np.cumsum(raw[:len(raw) // 2]), max(len(words), 1))
    return words, doc, word


def _class_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n00 .. n11): documents of each class that show a word, by block; without a word, how
    many words all documents of the block show, in the first count."""
    for b in batches:
        for vocabulary, places, docs in zip(*(b.column(c).to_pylist() for c in ("words", "places", "docs"))):
            words, doc, word = _shown(_unpressed(vocabulary).decode(), places)
            kind = np.array([-1 if d["label"] is None else 2 * d["half"] + d["label"] for d in docs])[doc]
            counts = np.stack([np.bincount(word[kind == k], minlength=len(words)) for k in range(len(CLASSES))])
            seen = np.flatnonzero(counts.any(axis=0))
            total = [[len(word)], [0], [0], [0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([WHOLE, *(WHOLE + words[k] for k in seen)]),
                 *(pa.array(np.append(t, c[seen]).astype(np.int64)) for t, c in zip(total, counts))], names=["gram", *COUNTS])


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, gram, n): the words of each block and how many of its documents show them."""
    for b in batches:
        for number, vocabulary, places in zip(*(b.column(c).to_pylist() for c in ("block", "words", "places"))):
            words, _, word = _shown(_unpressed(vocabulary).decode(), places)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(words), number)), pa.array([WHOLE + w for w in words], pa.string()),
                 pa.array(np.bincount(word, minlength=len(words)).astype(np.int64))], names=["block", "gram", "n"])


def expressions(held: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Words that more than ``EXPRESSION`` toxic documents of a half of the labelled rows show:
    where they are (block, gram, n), their counts (gram, n, n00 .. n11) over all documents, and
    the totals of all words: n, and d_<count>, what is taken off each class."""
    packed = held.where("gram is null").select("block", "words", "places", "docs")
    classes = cut_lineage(packed.mapInArrow(_class_words, "gram string, " + ", ".join(f"{c} long" for c in COUNTS))
                          .groupBy("gram").agg(*(F.sum(c).alias(c) for c in COUNTS)))
    word = F.col("gram") != WHOLE
    totals = classes.agg(F.max(F.when(~word, F.col(COUNTS[0]))).alias("n"), *(
        F.sum(F.when(word, F.least(F.col(c), F.lit(EXPRESSION)))).alias(f"d_{c}") for c in COUNTS)).first().asDict()
    told = cut_lineage(classes.where(word & (F.greatest("n01", "n11") > EXPRESSION)))
    # as many at most as the labelled sample holds
    asked = F.broadcast(told) if told.count() <= BROADCAST_WORDS else told
    places = _kept(packed.select("block", "words", "places").mapInArrow(_block_words, "block long, gram string, n long")
                   .join(asked.select("gram"), "gram", "left_semi").select("block", "gram", "n"))
    counts = places.groupBy("gram").agg(F.sum("n").alias("n")).join(told, "gram")
    return places, cut_lineage(counts), totals


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, folds: int, max_labelled: int) -> DataFrame:
    """(_lid, _half, _label) outside the held-out fold."""
    train = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (hash_fold(id_col, folds) != 0))
    return (train.groupBy(F.col(id_col).alias("_lid"))
            .agg(F.max(F.when(F.col(label_col) == 1, 1).otherwise(0)).cast("int").alias("_label"))
            .orderBy(F.xxhash64("_lid"), "_lid").limit(max_labelled)
            .select("_lid", F.pmod(F.xxhash64("_lid"), F.lit(2)).cast("int").alias("_half"), "_label"))


# ---------------------------------------------------------------- models

class KneserNey:
    """One class, as the tables below have it, for n-grams that fit in memory. The n-grams
    of ``shared`` may be of any order from two."""

    def __init__(self, top: dict[str, int], shared: dict[str, int]):
        self.own: dict[str, float] = {}
        self.back: dict[str, float] = {}
        self.shared_own: dict[str, float] = {}
        self.shared_back: dict[str, float] = {}
        self.order = max(map(len, shared), default=SHARED)
        level = top
        for _ in range(ORDER, SHARED, -1):
            level = self._add(level, self.own, self.back)
        level = shared
        for _ in range(self.order, 1, -1):
            level = self._add(level, self.shared_own, self.shared_back)
        n = sum(level.values())
        self.letter = {g: (c - DISCOUNT) / n for g, c in level.items()}
        self.floor = (DISCOUNT * len(level) / n if n else 1.0) / (len(level) + 1)

    @staticmethod
    def _add(counts: dict[str, int], own: dict[str, float], back: dict[str, float]) -> Counter:
        """What an n-gram adds, and a context's share for the order below; the counts of that."""
        total, kinds, below = Counter(), Counter(), Counter()
        for g, n in counts.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
            below[g[1:]] += 1
        for g, n in counts.items():
            own[g] = max(n - DISCOUNT, 0) / total[g[:-1]]
        for h, n in total.items():
            back[h] = DISCOUNT * kinds[h] / n
        return below

    def probability(self, gram: str) -> float:
        """Of the last character after the others; a context that is not known is passed over."""
        p, share = 0.0, 1.0
        for own, back, shortest, g in ((self.own, self.back, SHARED, gram),
                                       (self.shared_own, self.shared_back, 1, gram[-self.order:])):
            while len(g) > shortest:
                h = g[:-1]
                if h in back:
                    p += share * own.get(g, 0.0)
                    share *= back[h]
                g = g[1:]
        return p + share * (self.letter.get(gram[-1], 0.0) + self.floor)


#: The models: each is fitted on one half of the labelled rows.
MODELS = {"h0": (0,), "h1": (1,)}
_SIDES = [f"{m}_{label}" for m in MODELS for label in (0, 1)]


def _in_context(level: DataFrame, order: int, sides: list[str]) -> DataFrame:
    """With t_<side> and k_<side>: the sum and the number of what is known after the context."""
    # a context has at most as many rows as there are letters
    context = Window.partitionBy(F.substring("gram", 1, order - 1))
    return level.select("gram", *sides, *(F.sum(c).over(context).alias(f"t_{c}") for c in sides),
                        *(F.sum((F.col(c) > 0).cast("long")).over(context).alias(f"k_{c}") for c in sides))


def _own(side: str) -> Column:
    """What the n-gram adds; 0 where the side does not know the context."""
    return F.when(F.col(f"t_{side}") > 0, F.greatest(F.col(side) - F.lit(DISCOUNT), F.lit(0.0)) / F.col(f"t_{side}")).otherwise(0.0)


def _back(side: str) -> Column:
    """The share of the context for the order below; 1 where the side does not know it."""
    return F.when(F.col(f"t_{side}") > 0, F.lit(DISCOUNT) * F.col(f"k_{side}") / F.col(f"t_{side}")).otherwise(1.0)


def gram_ratios(counts: DataFrame) -> DataFrame:
    """(gram, h0, h1): log-likelihood ratio, toxic to ordinary, of each n-gram by each of
    the ``MODELS``, in ``UNIT``."""
    top = counts.select("gram", "n", *(
        sum((F.col(f"n{half}{label}") for half in halves), F.lit(0)).alias(f"{m}_{label}")
        for m, halves in MODELS.items() for label in (0, 1)))
    sides = ["n", *_SIDES]
    levels = {ORDER: top}
    for order in range(ORDER - 1, 0, -1):
        kept = sides if order > SHARED else ["n"]
        levels[order] = _kept(levels[order + 1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(*(
            F.sum((F.col(c) > 0).cast("long")).alias(c) for c in kept)))
    n, kinds = levels[1].agg(F.sum("n"), F.count(F.lit(1))).first()
    floor = (DISCOUNT * kinds / n if n else 1.0) / (kinds + 1)
    # p_n: the shared model; p_<side>, s_<side>: what the side adds, and leaves to the shared model
    below = levels[1].select("gram", ((F.col("n") - F.lit(DISCOUNT)) / F.lit(float(n or 1)) + F.lit(floor)).alias("p_n"))
    for order in range(2, ORDER + 1):
        own = [c for c in sides if order > SHARED or c == "n"]
        # counts go through the shuffles, what is made of them comes after
        at = _in_context(levels[order], order, own).withColumn("_below", F.expr("substring(gram, 2)"))
        joined = at.join(below.withColumnRenamed("gram", "_below"), "_below")
        out = [F.col("gram"), (_own("n") + _back("n") * F.col("p_n")).alias("p_n")]
        for c in own[1:]:
            lower = (F.col(f"p_{c}"), F.col(f"s_{c}")) if order > SHARED + 1 else (F.lit(0.0), F.lit(1.0))
            out += [(_own(c) + _back(c) * lower[0]).alias(f"p_{c}"), (_back(c) * lower[1]).alias(f"s_{c}")]
        below = joined.select(out)

    def p(side: str) -> Column:
        return F.col(f"p_{side}") + F.col(f"s_{side}") * F.col("p_n")
    return below.select("gram", *(
        F.round(F.log(p(f"{m}_1") / p(f"{m}_0")) / F.lit(UNIT)).cast("int").alias(m) for m in MODELS))


def word_ratios(words: DataFrame, totals: dict[str, int]) -> DataFrame:
    """(gram, h0, h1) of the words: log-likelihood ratio of each against what is left to the shared
    counts, so that it is 0 for one that neither class has shown often enough; and where it
    speaks for the ordinary class."""
    def gain(half: int, label: int) -> Column:
        c = f"n{half}{label}"
        # (count - EXPRESSION) / all counts of the class, over its share left * n / all counts of the corpus
        scale = float(totals["n"] or 0) / float(totals[f"d_{c}"] or 1)
        return F.log1p(F.greatest(F.col(c) - F.lit(EXPRESSION), F.lit(0.0)) * F.lit(scale) / F.col("n"))
    return words.select("gram", *(F.round(F.greatest(gain(h, 1) - gain(h, 0), F.lit(0.0)) / F.lit(UNIT)).cast("int").alias(f"h{h}") for h in (0, 1)))


#: What is told of a text by each model: the mean ratio of its characters, the best of its words.
FEATURES = [f"{x}_{m}" for m in MODELS for x in ("mean", "best")]


def _add_up(block: pa.Table, ratios: pa.Table, schema: pa.Schema) -> pa.Table:
    """The documents of one block with their ``FEATURES``."""
    docs = block.column("docs").to_pylist()[0]
    vocabulary = _unpressed(block.column("words")[0].as_py()).decode().split()
    places = _unpress(block.column("places")[0].as_py())
    pairs, times = np.cumsum(places[:len(places) // 2]), places[len(places) // 2:]
    numbers, at, sizes = _gram_table(vocabulary)
    word_at = np.repeat(np.arange(len(vocabulary)), sizes)
    known = pa.array([*numbers, *(WHOLE + w for w in vocabulary)], pa.string())
    rows = pc.index_in(ratios.column("gram"), value_set=known).to_numpy()
    size = np.array([d["chars"] for d in docs]) + PRIOR
    out = []
    for m in MODELS:
        value = np.zeros(len(known), np.int64)
        value[rows] = ratios.column(m).to_numpy()
        gram, own = np.split(value, [len(numbers)])
        total, best = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
        if vocabulary:
            word = np.bincount(word_at, gram[at], len(vocabulary)).astype(np.int64)
            doc, number = np.divmod(pairs, len(vocabulary))
            np.add.at(total, doc, word[number] * times)
            np.maximum.at(best, doc, own[number])
        out += [total * UNIT / size, best * UNIT]
    return pa.table([pa.array([d[c] for d in docs], schema.field(c).type) for c in ("id", "key", "half", "label")] +
                    [pa.array(x) for x in out], schema=schema)


def text_ratios(held: DataFrame, ratios: DataFrame, words: DataFrame) -> DataFrame:
    """(id, key, half, label, and the ``FEATURES``) of each document. The mean is over the
    characters of the words, a word's end counted as one, and the prior's. ``words``: (block, gram,
    h0, h1) of the words that have a ratio; others have 0."""
    grams = (held.where("gram is not null").select(F.col("block").alias("_block"), "gram").join(ratios, "gram")
             .select("_block", "gram", *MODELS).unionByName(words.select(F.col("block").alias("_block"), "gram", *MODELS)))
    docs = held.where("gram is null").select("block", "words", "places", "docs")
    doc = docs.schema["docs"].dataType.elementType
    kind = ", ".join([f"{c} {doc[c].dataType.simpleString()}" for c in ("id", "key", "half", "label")] +
                     [f"{f} double" for f in FEATURES])
    schema = to_arrow_schema(_parsed(held, kind))
    return docs.groupBy("block").cogroup(grams.groupBy("_block")).applyInArrow(
        lambda block, found: _add_up(block, found, schema), kind)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 100) -> tuple[list[float], float]:
    """Slopes and constant, by damped Newton steps on the standardised ratios."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    a = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    b = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(b)), a.T @ (y - p) - ridge * b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return (b[:-1] / scale).tolist(), float(b[-1] - (b[:-1] * mean / scale).sum())


def _scores(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int,
            max_labelled: int) -> DataFrame | float:
    """(id, key, score) of each row; or a constant score where a class has no labels."""
    held = blocks(docs, labelled_sample(labels, id_col, label_col, folds, max_labelled), id_col, text_col)
    counts = _kept(gram_counts(held))
    ordinary, toxic = counts.agg(F.sum(F.col("n00") + F.col("n10")), F.sum(F.col("n01") + F.col("n11"))).first()
    if not toxic:
        return 0.0
    if not ordinary:
        return 1.0
    places, words, totals = expressions(held)
    said = word_ratios(words, totals).where("h0 > 0 or h1 > 0")
    texts = _kept(text_ratios(held, gram_ratios(counts), places.join(said, "gram")))
    # three numbers for each row of the bounded sample, in a fixed order
    other = [F.when(F.col("half") == 0, F.col(f"{x}_h1")).otherwise(F.col(f"{x}_h0")).alias(x) for x in ("mean", "best")]
    seen = texts.where("label is not null").select(*other, "label").toPandas().sort_values(["mean", "best", "label"])
    slopes, base = _logistic(seen[["mean", "best"]].to_numpy(), seen["label"].to_numpy())
    z = sum((F.col(f) * F.lit(slopes[k % 2] / len(MODELS)) for k, f in enumerate(FEATURES)), F.lit(base))
    return texts.select("id", "key", (1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))))).alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", folds: int = 5, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per row: id, held_out, score, predicted. ``labels``: the id and a 0/1 label."""
    scores = _scores(docs, labels, id_col, text_col, label_col, folds, max_labelled)
    scored = (docs.select(F.col(id_col).alias("id"), F.lit(scores).alias("score")) if isinstance(scores, float)
              else scores.select("id", "score"))
    return scored.select(F.col("id").alias(id_col),
                         (F.coalesce(hash_fold("id", folds), F.lit(0)) == 0).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Texts to drop that are broadcast at most, by their 128-bit hash; more are joined by it.
BROADCAST_KEYS = 1 << 20


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic", folds: int = 5, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    scores = _scores(docs, labels, id_col, text_col, label_col, folds, max_labelled)
    if isinstance(scores, float):
        return docs.where(F.lit(scores < 0.5))
    toxic = cut_lineage(scores.where("score >= 0.5").select(F.col("key").alias("_key")).distinct())
    # whole texts are shuffled only where the hashes of what goes are too many
    toxic = F.broadcast(toxic) if toxic.count() <= BROADCAST_KEYS else toxic
    return docs.join(toxic, _text_key(whole_text(text_col)) == F.col("_key"), "left_anti")
