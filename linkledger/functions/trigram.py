"""Trigram sets and similarity, following the public pg_trgm definition:
lower-case, words are runs of letters/digits, each word padded with two spaces
in front and one behind, the set of its 3-character substrings; similarity is
|A n B| / |A u B| rounded to float4, then widened to double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_SPLIT = r"[^\p{L}\p{N}]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(s) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(_col(s)), WORD_SPLIT, " "), " "), lambda w: F.length(w) > 0)


def trigrams(s) -> Column:
    return F.array_distinct(F.flatten(F.transform(
        words(s),
        lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1),
                              lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, 3)),
    )))


def similarity_of_sets(a, b) -> Column:
    a, b = _col(a), _col(b)
    inter = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - inter
    return F.when(union > 0, (inter / union).cast("float").cast("double")).otherwise(F.lit(0.0))


def similarity(s1, s2) -> Column:
    return similarity_of_sets(trigrams(s1), trigrams(s2))


def signatures(tg) -> Column:
    """128 bits in two longs, one set for each trigram's hash: what two sets can share at most is known from theirs."""
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, 1), F.lit(64)).cast("int"))
    hashes = F.transform(_col(tg), lambda t: F.xxhash64(t))
    word = lambda k: F.aggregate(F.filter(hashes, lambda h: F.pmod(h, F.lit(2)) == k), F.lit(0).cast("long"),
                                 lambda s, h: s.bitwiseOR(bit(h)))
    return F.struct(word(0).alias("a"), word(1).alias("b"))


def shared_at_most(n, sig, other_n, other_sig) -> Column:
    """A bit that only one set has is a trigram that the other lacks."""
    n, sig, other_n, other_sig = map(_col, (n, sig, other_n, other_sig))

    def lacked(x: Column, y: Column) -> Column:
        return sum((F.bit_count(x[w].bitwiseAND(F.bitwise_not(y[w]))) for w in ("a", "b")), F.lit(0))
    return F.least(n - lacked(sig, other_sig), other_n - lacked(other_sig, sig))
