"""Chat formatting by quotation linking.

A message is parsed into its own words and its quoted passages, with the level
that their ``>`` marks nest to; a line that announces a quotation ("On ... wrote:")
goes with the passage that follows it. Passages are normalised (lower case, one
space between words) and hashed at four grains: the whole run of quoted lines of a
level, its paragraphs, its lines, and the sentences of its paragraphs, however those
are wrapped. A message's own words are hashed likewise. A quotation of less than a
sentence, that is no line either, has no original.

A quoted passage is joined to its original: the first message of the conversation
whose own words hold it, if that message is earlier; else the first message of any
other conversation. Firsts are grouped minima, so a line that a third of all
messages share is one row on the side that is joined to, and no pairs of messages
are made. Of the grains of a passage the one with most words that finds an
original speaks for it.

A message answers the latest message of its conversation that it quotes at the
lowest level that is linked; one without such a quotation starts a thread.
Threads are found by pointer doubling, and a conversation is put into reply order:
threads in order of their first message, each message after the one it answers.

Defined results: null text counts as empty; a null conversation or turn is left
out of linking, is a thread of its own, and comes first; messages that repeat a
turn are each kept, and answer, or are answered, as one; an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.state import assign_dense_ids
from ..session import cut_lineage
from .common import whole_text

_MARKS = re.compile(r"^(?:[ \t]*>)+")
_LINES = re.compile(r"\r\n|\r|\n")
# after a full stop, with or without a closing mark; without a space where the script has none
_SENTENCES = re.compile("(?<=[.!?\u2026])\\s+|(?<=[.!?\u2026][\"')\\]\u201d\u2019\u00bb])\\s+|(?<=[\u3002\uff01\uff1f])")
_ANNOUNCES = re.compile(r"^\s*on\b.*\bwrote:\s*$", re.IGNORECASE)

PASSAGE = "struct<level:int,passage:int,words:int,hash:long>"
PARSED = f"body string, own array<long>, quotes array<{PASSAGE}>"


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def _hash(text: str) -> int:
    from xxhash import xxh3_64_intdigest

    h = xxh3_64_intdigest(text)
    return h - (1 << 64) if h >= 1 << 63 else h


def _units(lines: list[str]) -> dict[str, int]:
    """Normalised text -> number of words, for the whole, its paragraphs, sentences and lines."""
    units = [normalised(" ".join(lines)), *map(normalised, lines)]
    paragraph: list[str] = []
    for line in [*lines, ""]:
        if line.strip():
            paragraph.append(line)
        else:
            joined = " ".join(paragraph)
            units += map(normalised, [joined, *_SENTENCES.split(joined)])
            paragraph = []
    return {u: u.count(" ") + 1 for u in units if u}


def parse(text: str) -> tuple[str, list[int], list[dict]]:
    """(own words, hashes of what they hold, quoted passages)."""
    own: list[str] = []
    runs: list[tuple[int, list[str]]] = []
    for line in _LINES.split(text):
        marks = _MARKS.match(line)
        if marks:
            level = marks.group().count(">")
            rest = line[marks.end():]
            if _ANNOUNCES.match(rest):
                continue
            if not runs or runs[-1][0] != level:
                runs.append((level, []))
            runs[-1][1].append(rest)
            if own and own[-1] is not None:
                while own and (not own[-1] or _ANNOUNCES.match(own[-1])):
                    own.pop()
                own.append("")
        else:
            if runs and runs[-1][0]:
                runs.append((0, []))                       # own words end a run of quoted lines
            own.append(line)
    body = "\n".join(own).strip()
    quotes = [{"level": level, "passage": k, "words": n, "hash": _hash(u)}
              for k, (level, lines) in enumerate(runs) if level for u, n in _units(lines).items()]
    return body, sorted({_hash(u) for u in _units(_LINES.split(body))}), quotes


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.struct(
        [("level", pa.int32()), ("passage", pa.int32()), ("words", pa.int32()), ("hash", pa.int64())]))]
    for b in batches:
        got = [parse(t) for t in b.column("_text").to_pylist()]
        new = [pa.array([g[k] for g in got], kind) for k, kind in enumerate(kinds)]
        kept = [c for c in b.schema.names if c != "_text"]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *new], names=[*kept, "body", "own", "quotes"])


def link_quotations(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, passage, to_conv, to_turn) from parsed messages: each quoted
    passage that has an original, with that original."""
    said = messages.where("conv is not null and turn is not null").select("conv", "turn", F.explode("own").alias("hash"))
    here = said.groupBy("conv", "hash").agg(F.min("turn").alias("first_turn"))
    # the earliest two conversations that say it, so that a passage can look past its own
    anywhere = here.groupBy("hash").agg(F.min(F.struct("conv", "first_turn")).alias("a"))
    second = here.join(anywhere, "hash").where(F.col("conv") != F.col("a.conv")).groupBy("hash").agg(
        F.min(F.struct("conv", "first_turn")).alias("b"))
    quoted = (messages.where("conv is not null and turn is not null and size(quotes) > 0")
              .select("conv", "turn", F.explode("quotes").alias("q")).select("conv", "turn", "q.*"))
    near = quoted.join(here, ["conv", "hash"], "left").join(anywhere, "hash", "left").join(second, "hash", "left")
    other = F.when(F.col("a.conv") != F.col("conv"), F.col("a")).otherwise(F.col("b"))
    found = near.select(
        "conv", "turn", "level", "passage", "words",
        F.when(F.col("first_turn") < F.col("turn"), F.struct(F.col("conv"), F.col("first_turn"))).otherwise(other).alias("to"),
        (F.col("first_turn") < F.col("turn")).alias("inside")).where("to is not null")
    best = found.groupBy("conv", "turn", "level", "passage").agg(
        F.max(F.struct(F.coalesce("inside", F.lit(False)).alias("inside"), F.col("words"), F.col("to"))).alias("m"))
    return best.select("conv", "turn", "level", "passage", F.col("m.to.conv").alias("to_conv"),
                       F.col("m.to.first_turn").alias("to_turn"))


def _thread_starts(replies: DataFrame) -> DataFrame:
    """(conv, turn, start) from (conv, turn, answers), by pointer doubling: the rounds
    grow with the logarithm of the longest thread."""
    at = cut_lineage(replies.select("conv", "turn", F.col("answers").alias("start")))
    while True:
        up = at.select("conv", F.col("turn").alias("start"), F.col("start").alias("_next"))
        moved = cut_lineage(at.join(up, ["conv", "start"], "left").select(
            "conv", "turn", F.coalesce("_next", "start").alias("start"), F.col("_next").isNotNull().alias("_moved")))
        at = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return at


def reply_order(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """Per message: conversation, turn, role, position (in reply order, from 0),
    answers (a turn or null), thread (its first turn), quotes and linked (numbers of
    quoted passages, and of those with an original), text (own words only)."""
    kind = {c: conversations.schema[c].dataType.simpleString() for c in (conv_col, turn_col, role_col)}
    src = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                               whole_text(text_col).alias("_text"))
    messages = cut_lineage(src.mapInArrow(
        _parsed, f"conv {kind[conv_col]}, turn {kind[turn_col]}, role {kind[role_col]}, {PARSED}"))
    links = cut_lineage(link_quotations(messages))
    nearest = links.where("to_conv = conv").groupBy("conv", "turn").agg(F.min("level").alias("level"))
    answers = (links.where("to_conv = conv").join(nearest, ["conv", "turn", "level"])
               .groupBy("conv", "turn").agg(F.max("to_turn").alias("answers")))
    linked = links.groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("linked"))
    about = cut_lineage(linked.join(answers, ["conv", "turn"], "left"))
    starts = _thread_starts(about.where("answers is not null"))
    about = about.join(starts, ["conv", "turn"], "left")
    ordered = (messages.join(about, ["conv", "turn"], "left")
               .withColumn("thread", F.coalesce("start", "turn"))
               .withColumn("quotes", F.array_size(F.array_distinct(F.transform("quotes", lambda q: q["passage"]))).cast("long"))
               .select("conv", "turn", "role", "answers", "thread", "quotes",
                       F.coalesce("linked", F.lit(0)).alias("linked"), F.col("body").alias("text")))
    placed = assign_dense_ids(ordered, ["conv", "thread", "turn", "role", F.xxhash64("text")], "_pos", 0)
    first = placed.groupBy("conv").agg(F.min("_pos").alias("_first")).withColumnRenamed("conv", "_conv")
    return (placed.join(first, F.col("conv").eqNullSafe(F.col("_conv")))
            .select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col),
                    (F.col("_pos") - F.col("_first")).alias("position"), "answers", "thread", "quotes", "linked",
                    F.col("text").alias(text_col)))
