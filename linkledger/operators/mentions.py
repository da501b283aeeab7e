"""Mention extraction over page text.

The extractor is pluggable: any function (DataFrame of (key, text)) ->
DataFrame of (key, mention) can be passed to the page stage, for instance a
``mapInPandas`` model that is loaded once per Python worker. The built-in one
spots gazetteer names by an anchor index, see ``spot_gazetteer``; a hit emits
the gazetteer name as the mention (distinct per page). ``spot_capitalised`` needs no
gazetteer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.trigram import WORD_SPLIT
from ..session import cut_lineage

#: Bytes of anchored names that may be broadcast, and what a row has besides its name.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64
#: Tokens of a page that are looked at together, at least.
SPAN = 512


def tokens(s) -> Column:
    c = F.col(s) if isinstance(s, str) else s
    return F.filter(F.split(F.regexp_replace(F.lower(c), WORD_SPLIT, " "), " "), lambda w: F.length(w) > 0)


def _pair(left: Column, right: Column) -> Column:
    return F.xxhash64(left, F.lit(" "), right)


def _pairs(toks: Column) -> Column:
    """A hash for each two neighbours, in order."""
    return F.zip_with(F.slice(toks, F.lit(1), F.greatest(F.size(toks) - 1, F.lit(0))),
                      F.slice(toks, F.lit(2), F.greatest(F.size(toks) - 1, F.lit(0))), _pair)


def page_spans(docs: DataFrame, key: str, text_col: str, longest: int) -> DataFrame:
    """(_key, _span, _at, _tok): each page's tokens in spans of at least ``SPAN``. A span has
    ``longest`` - 1 tokens of its neighbours on both sides, the first at ``_at`` - 1 tokens
    ahead of its own, so a name that begins or is anchored in it lies within it."""
    size, more = max(SPAN, 2 * longest), longest - 1
    cut = docs.select(F.col(key).alias("_key"), tokens(text_col).alias("_all")).where(F.size("_all") > 0)
    first = F.col("_span") * size                     # own tokens begin here, from 0
    begin = F.greatest(first - more, F.lit(0))
    return (cut.select("_key", "_all", F.explode(F.sequence(F.lit(0), F.floor((F.size("_all") - 1) / size).cast("int"))).alias("_span"))
            .select("_key", "_span", (first - begin).alias("_at"), F.lit(size).alias("_own"),
                    F.slice("_all", begin + 1, first - begin + size + more).alias("_tok")))


def spot_gazetteer(docs: DataFrame, gazetteer: DataFrame, key: str, text_col: str = "text",
                   name_col: str = "name") -> DataFrame:
    """(key, text) x gazetteer(name) -> distinct (key, mention).

    Names and pages are cut into the same lower-cased letter/digit tokens. A name of
    several tokens is anchored at its rarest pair of neighbours, as pages count them; one
    with a pair that no page has is dropped at once. Pages give one hash for each place,
    which meets the anchors; what meets is compared token by token with the page, so hashes
    decide nothing. Names of one token meet the distinct tokens of each page.

    Long pages are looked at in spans, so no row is longer than a span."""
    names = cut_lineage(gazetteer.select(F.col(name_col).alias("_mention")).where(F.col("_mention").isNotNull()).distinct()
                        .withColumn("_name", tokens("_mention")).where(F.size("_name") > 0)
                        .withColumn("_k", F.size("_name")))
    longest = names.agg(F.max("_k")).first()[0]
    if longest is None:
        return docs.select(key, F.lit(None).cast("string").alias("mention")).where(F.lit(False))
    spans = page_spans(docs, key, text_col, longest)
    single = _spot_words(spans, names.where("_k = 1"))
    found = single if longest == 1 else single.unionByName(_spot_anchored(spans, names.where("_k > 1")))
    return found.distinct().select(F.col("_key").alias(key), F.col("_mention").alias("mention"))


def _spot_words(spans: DataFrame, names: DataFrame) -> DataFrame:
    """(_key, _mention) of the names of one token."""
    words = spans.select("_key", F.explode(F.array_distinct("_tok")).alias("_word")).distinct()
    return words.join(names.select(F.col("_name")[0].alias("_word"), "_mention"), "_word").select("_key", "_mention")


def _spot_anchored(spans: DataFrame, names: DataFrame) -> DataFrame:
    """(_key, _mention) of the names of several tokens."""
    # one hash for each place; a pair of a span's own place i has the place's number in the span
    places = spans.select("_key", "_span", "_at", "_own", F.posexplode(_pairs(F.col("_tok"))).alias("_i", "_pair")).where(
        (F.col("_i") >= F.col("_at")) & (F.col("_i") < F.col("_at") + F.col("_own"))).select("_key", "_span", "_i", "_pair")
    asked = names.select("_mention", F.size("_name").alias("_n"), F.posexplode(_pairs(F.col("_name"))).alias("_j", "_pair"))
    counts = places.join(asked.select("_pair").distinct(), "_pair", "left_semi").groupBy("_pair").agg(
        F.count(F.lit(1)).alias("_times"))
    anchors = (asked.join(counts, "_pair").groupBy("_mention", "_n").agg(
        F.min(F.struct("_times", "_j", "_pair")).alias("_a"), F.count(F.lit(1)).alias("_met"))
        .where(F.col("_met") == F.col("_n") - 1)                    # each pair of the name is on some page
        .select("_mention", F.col("_a._j").alias("_j"), F.col("_a._pair").alias("_pair")))
    anchors = cut_lineage(anchors.join(names.select("_mention", "_name", "_k"), "_mention"))
    held = anchors.agg(F.sum(F.octet_length("_mention") * 2 + F.lit(ROW_BYTES) * F.col("_k"))).first()[0] or 0
    # names of a proven size go to the places; larger gazetteers are shuffled with them
    small = held <= BROADCAST_BYTES
    hits = places.join(F.broadcast(anchors) if small else anchors, "_pair")
    tok = spans.select("_key", "_span", "_tok")
    return (hits.join(tok, ["_key", "_span"])
            .where((F.col("_i") >= F.col("_j")) & (F.slice("_tok", F.col("_i") - F.col("_j") + 1, F.col("_k")) == F.col("_name")))
            .select("_key", "_mention"))


#: A capitalised word, and what may stand between two of them inside one name.
CAPITALISED = r"\p{Lu}[\p{L}\p{N}'’&-]*"
BETWEEN = r" (?:(?:of|the|de|la|le|du|des|and|et|&) )?"
PHRASE = rf"{CAPITALISED}(?:{BETWEEN}{CAPITALISED})*"
#: Marks around capitalised words. No name holds them; in a page they end one, as a line does.
_OPEN, _CLOSE = "\x01", "\x02"


def spot_capitalised(docs: DataFrame, key: str, text_col: str = "text", min_words: int = 2) -> DataFrame:
    """(key, text) -> distinct (key, mention): maximal runs of capitalised words on one
    line, joined by blanks or a short connecting word, of at least ``min_words``
    words, as ``PHRASE`` says. It needs no vocabulary, so it finds names outside the gazetteer.

    Words are marked and marks that meet are taken out, since the regex engine recurses
    on a group that repeats: a run may have any length."""
    marked = F.regexp_replace(F.translate(F.col(text_col), _OPEN + _CLOSE, "\n\n"), f"({CAPITALISED})", f"{_OPEN}$1{_CLOSE}")
    joined = F.regexp_replace(marked, f"{_CLOSE}({BETWEEN}){_OPEN}", "$1")
    spans = F.regexp_extract_all(joined, F.lit(f"{_OPEN}([^{_CLOSE}]*){_CLOSE}"), F.lit(1))
    return (docs.select(F.col(key).alias("_key"), F.explode(spans).alias("_mention"))
            .where(F.size(F.split("_mention", " ")) >= min_words)
            .select(F.col("_key").alias(key), F.col("_mention").alias("mention")).distinct())
