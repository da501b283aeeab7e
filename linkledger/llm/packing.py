"""Best-fit packing of tokenised documents into sequences of a fixed length.

Planning works on counts, not documents: the histogram of piece lengths has at
most as many rows as a sequence has tokens. Best-fit decreasing runs over it on
the driver, placing many pieces of one length at once into the fullest sequences
that still fit, and gives runs of slots: pieces of one length with ranks in a
range take consecutive sequences at one offset. Pieces get their rank within
their length from one range-partitioned sort and join the runs.

Only documents longer than a sequence are cut. Full pieces are sequences as they
are.

Defined results: null text is empty, and is its end token alone; rows that repeat
are packed each; equal lengths are placed in order of id and piece; a null id
comes first; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import assign_dense_ids
from ..session import cut_lineage
from .common import map_texts

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
LENGTH = 4096
#: Bytes of texts that are taken apart at once.
BLOCK_BYTES = 1 << 23
#: Words whose ids a worker process remembers, in each of two generations.
REMEMBERED = 1 << 18
#: New words that are encoded as one text.
JOINED = 4096
#: Runs are broadcast up to this number; a run has five longs.
BROADCAST_RUNS = 200_000

PIECES = "piece int, start long, length long, ids_crc32 long"

# What each byte is. The tokenizer drops white space and takes a run of letters, or of
# other signs, for itself, so a text is cut there: at ASCII blanks, and between a letter and
# an ASCII sign. Nothing is cut next to other characters, digits (each by itself), an
# apostrophe (contractions) and the bar (special tokens).
_BLANK, _OTHER, _LETTER, _SIGN = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[list(b" \t\r\n")] = _BLANK
_KIND[[c for c in range(128) if chr(c).isalpha()]] = _LETTER
_KIND[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~")] = _SIGN
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPECIAL = re.compile(rb"<\|(?:start|end)oftext\|>")
#: Words of nothing but letters that are composed as they stand.
_LETTERS = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+")
_WORD_END = "</w>"


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the number of each word in the texts, and how many words end with
    each text."""
    text = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kind = _KIND[text]
    latin = np.flatnonzero(text[:-1] == 0xC3)              # two bytes, a letter but for the signs of times and division
    latin = latin[(text[latin + 1] != 0x97) & (text[latin + 1] != 0xB7)]
    kind[latin] = kind[latin + 1] = _LETTER
    inside = kind != _BLANK
    begins = inside.copy()
    before, after = kind[:-1], kind[1:]
    begins[1:] &= (before == _BLANK) | (before != after) & (before >= _LETTER) & (after >= _LETTER)
    at = np.flatnonzero(begins)
    ends = np.append(np.cumsum(inside, dtype=np.int32)[at] - 1, np.count_nonzero(inside)).astype(np.int32)
    # special tokens are known by their case
    lower = _LOWER[text[inside]]
    data = text[inside] if _SPECIAL.search(lower.tobytes()) else lower
    coded = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(data)).dictionary_encode()
    closed = np.cumsum([len(t) + 1 for t in texts]) - 1
    return coded.dictionary, coded.indices.to_numpy(), np.searchsorted(at, closed)


class WordIds:
    """Word -> its ids as little-endian 32-bit bytes. Words met lately are remembered: once the
    young ones are too many, they become the old ones, and those are forgotten.

    New words of letters are encoded together, by the tokenizer without the steps that leave
    them as they are; each ends with its only token that ends a word."""

    def __init__(self, tokenizer):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = tokenizer
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.plain = Tokenizer.from_str(tokenizer.to_str())
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(tokenizer.get_vocab_size(), bool)
        self.ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith(_WORD_END)]] = True

    def of(self, words: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        found = [young.get(w) for w in words]
        new = []
        for k, ids in enumerate(found):
            if ids is None:
                ids = old.get(words[k])
                if ids is None:
                    new.append(k)
                else:
                    found[k] = young[words[k]] = ids
        for k, ids in zip(new, self.encode([words[k] for k in new])):
            found[k] = young[words[k]] = ids
        if len(young) > REMEMBERED:
            self.young, self.old = {}, young
        return found

    def encode(self, words: list[str]) -> list[bytes]:
        letters = [w for w in words if _LETTERS.fullmatch(w)]
        rest = [w for w in words if not _LETTERS.fullmatch(w)]
        known = {w: np.array(e.ids, "<u4").tobytes()
                 for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))}
        joined = [" ".join(letters[k:k + JOINED]).lower() for k in range(0, len(letters), JOINED)]
        ids = np.array([i for e in self.plain.encode_batch_fast(joined, add_special_tokens=False) for i in e.ids], "<u4")
        past = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        raw = ids.tobytes()
        known |= {w: raw[4 * first:4 * end] for w, first, end in zip(letters, [0, *past], past)}
        return [known[w] for w in words]


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    """One for a worker process, so tasks go on with what earlier ones have met."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return WordIds(Tokenizer.from_file(path))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def text_ids(texts: list[bytes], known: WordIds, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, each closed by ``end_id``, and where each text ends."""
    words, numbers, closed = words_of(texts)
    ids = [*known.of(words.to_pylist()), end_id.to_bytes(4, "little")]
    size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
    first = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(ids), "<u4")
    numbers = np.insert(numbers, closed, len(words))
    each = size[numbers]
    ends = np.cumsum(each)
    out = flat[np.repeat(first[numbers] - (ends - each), each) + np.arange(ends[-1])]
    return out, ends[closed + np.arange(len(texts))]


def _blocks(texts: list[str]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text.encode())
        size += len(held[-1])
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """(_id, piece, start, length, ids_crc32): each document's ids, closed by
    ``end_id``, in pieces of ``length``. ``path`` is the vocabulary file's place on
    the workers; None looks it up there."""
    def start():
        known = _word_ids(path or tokenizer_path())

        def pieces(texts: list[str]):
            out = []
            row = 0
            for block in _blocks(texts):
                ids, ends = text_ids(block, known, end_id)
                begin = 0
                for end in ends.tolist():
                    for piece, at in enumerate(range(begin, end, length)):
                        part = ids[at:min(at + length, end)]
                        out.append((row, piece, at - begin, len(part), zlib.crc32(part)))
                    row, begin = row + 1, end
            rows, piece, at, size, crc = map(list, zip(*out)) if out else ([], [], [], [], [])
            return rows, [pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (at, size, crc))]
        return pieces

    return map_texts(docs, id_col, text_col, start, PIECES)


def plan_slots(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: runs (piece length, first rank, past the last
    rank, first sequence, offset). Pieces of ``length`` itself are not planned."""
    runs, sequences = [], 0
    room: list[int] = []                           # distinct free lengths, ascending
    open_: dict[int, list[tuple[int, int]]] = {}   # free length -> (first sequence, number)

    def leave(free: int, first: int, n: int) -> None:
        if free and n:
            if free not in open_:
                insort(room, free)
                open_[free] = []
            open_[free].append((first, n))

    for size in sorted((x for x in counts if x < length), reverse=True):
        rank, left = 0, counts[size]
        while left:
            k = bisect_left(room, size)
            if k < len(room):
                free = room[k]
                first, n = open_[free].pop()
                if not open_[free]:
                    del open_[free], room[k]
            else:
                free, first, n = length, sequences, max(1, left // (length // size))
                sequences += n
            # a sequence takes all that fit before the next one takes any
            deep = min(free // size, left)
            use = min(n, left // deep)
            for layer in range(deep):
                runs.append((size, rank, rank + use, first, length - free + layer * size))
                rank += use
            left -= deep * use
            leave(free, first + use, n - use)
            leave(free - deep * size, first, use)
    return runs


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark: SparkSession = docs.sparkSession
    pieces = cut_lineage(token_pieces(docs, id_col, text_col, path, length, end_id))
    ranked = assign_dense_ids(pieces, ["length", "_id", "piece"], "_pos", 0)
    counts = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, total = {}, 0
    for size in sorted(counts):
        first[size] = total
        total += counts[size]
    runs = plan_slots(counts, length)
    # full pieces are the last in the sort: sequences after the planned ones
    planned = max((s + hi - lo for _, lo, hi, s, _ in runs), default=0)
    runs.append((length, 0, counts.get(length, 0), planned, 0))
    slots = spark.createDataFrame([(size, first.get(size, 0) + lo, first.get(size, 0) + hi, s, at)
                                   for size, lo, hi, s, at in runs],
                                  "_size long, _lo long, _hi long, _first long, offset long")
    if len(runs) <= BROADCAST_RUNS:
        slots = F.broadcast(slots)
    at = (F.col("length") == F.col("_size")) & (F.col("_pos") >= F.col("_lo")) & (F.col("_pos") < F.col("_hi"))
    return ranked.join(slots, at).select(
        F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32",
        (F.col("_first") + F.col("_pos") - F.col("_lo")).alias("sequence_id"), "offset")
