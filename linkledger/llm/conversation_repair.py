r"""Conversation structure repair by Hirschberg's divide and conquer.

A repaired conversation's role initials read ``(s?(ua)+)?``: nothing, or an optional
system turn and then user and assistant in turns. An edit script turns what is there
into that; each row is kept (K, 0), given the role that fits (R, 2) or deleted (D, 3), and
empty turns may be inserted anywhere (I, 2). Blank rows and duplicates must go; a truncated
row that stays costs 1 more. Of the cheapest scripts the one whose letters are
ASCII-least is taken.

Where the script stands is one of four states: nothing yet, after a system, a user or
an assistant turn. The costs of what can still be done are four numbers a state. A run of
rows is solved by halves: forward costs over the first half and backward costs over the
second meet in the middle, the crossings of least total are kept, and the first half is
solved with them as its ends, so the audit-least of them is found by the same recursion;
its state begins the second half. Only two vectors are held at each depth, so space is
linear in the rows.

Long conversations go the same way through Spark. Rows are sorted by conversation and
turn over all partitions, and cut into blocks of bounded size. A block's 4 x 4 cost matrix stands for it;
matrices are multiplied in a tree to give each block the backward costs behind it, blocks
are then solved for each state that they may begin in, and the maps from begin to end
state, composed in a tree, tell each block the state that it does begin in. No task
holds more than a block of rows or ``FAN`` matrices, whatever the length of a conversation.
Only the digest of a repaired conversation is sequential by nature: one task
streams its turns in order, holding one batch and the audit's letters.

Order: turn, null first; rows of one turn by role, then by a digest of their text.

Defined results: null role or text counts as one space; a null id is a conversation of its
own; null turns come first and take no part in gaps; a conversation of no rows, or only
of rows that must go, is repaired to nothing; repeated rows are duplicates; texts of any
length are read once for their faults; an empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.state import assign_dense_ids
from ..session import cut_lineage
from .common import BLANK

#: Rows of a block, and blocks or groups of blocks that are composed at once.
BLOCK, FAN = 4096, 1024

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}
FINE, TRUNCATED, GOES = 0, 1, 2
RETYPE, DELETE, INSERT = 2, 3, 2
NEVER = 1 << 60
#: The state after a further turn of the conversation, if it is not a system's.
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: States that inserted turns lead to. More of them would go in a circle.
INSERTED = {NOTHING: [NOTHING, USER, ASSISTANT], SYSTEM: [SYSTEM, USER, ASSISTANT],
            USER: [USER, ASSISTANT], ASSISTANT: [ASSISTANT, USER]}
#: What the turns inserted behind the last row cost, by the state there.
ENDS = [0, 2 * INSERT, INSERT, 0]

Rows = list[tuple[int, int]]       # (state that the role would lead to or 0, fault)


def _moves(state: int, row: tuple[int, int]) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, state after) of what can be done with a row."""
    role, fault = row
    yield "D", DELETE, state
    if fault != GOES:
        if role == NEXT[state] or role == SYSTEM and state == NOTHING:
            yield "K", fault, role
        yield "R", RETYPE + fault, NEXT[state]


def forward(rows: Rows, costs: list[int]) -> list[int]:
    """The least cost to be in each state behind the rows, from those ahead of them."""
    for row in rows:
        after = [NEVER] * 4
        for state in STATES:
            if costs[state] < NEVER:
                for inserts, at in enumerate(INSERTED[state]):
                    for _, cost, to in _moves(at, row):
                        after[to] = min(after[to], costs[state] + inserts * INSERT + cost)
        costs = after
    return costs


def backward(rows: Rows, costs: list[int]) -> list[int]:
    """The least cost from each state ahead of the rows, from those behind them."""
    for row in reversed(rows):
        best = [min(cost + costs[to] for _, cost, to in _moves(state, row)) for state in STATES]
        costs = [min(min(inserts * INSERT + best[at] for inserts, at in enumerate(INSERTED[state])), NEVER)
                 for state in STATES]
    return costs


def solve(rows: Rows, begin: int, ends: list[int]) -> tuple[list[str], int]:
    """The letters for each row, inserted turns ahead of it, and the state behind the rows: least
    in cost, with what ``ends`` adds, then ASCII-least."""
    if len(rows) == 1:
        _, letters, end = min((inserts * INSERT + cost + ends[to], "I" * inserts + letter, to)
                              for inserts, at in enumerate(INSERTED[begin])
                              for letter, cost, to in _moves(at, rows[0]))
        return [letters], end
    half = len(rows) // 2
    there = forward(rows[:half], [0 if state == begin else NEVER for state in STATES])
    back = backward(rows[half:], ends)
    least = min(x + y for x, y in zip(there, back))
    crossings = [y if x + y == least else NEVER for x, y in zip(there, back)]
    first, middle = solve(rows[:half], begin, crossings)
    second, end = solve(rows[half:], middle, ends)
    return first + second, end


def script(letters: str, state: int) -> Iterator[tuple[str, int]]:
    """(letter, state after) of each edit; K of a system turn is told by the caller."""
    for x in letters:
        if x in "IR":
            state = NEXT[state]
        yield x, state


# ---------------------------------------------------------------- blocks

def _by_runs(df: DataFrame, keys: list[str], order: list[Column], work: Callable[[list[dict]], list[dict]],
             schema: str) -> DataFrame:
    """``work`` on the rows of each key in order, a bounded number, as dicts."""
    out = pa.schema([(f.name, pa.list_(pa.int64()) if f.dataType.typeName() == "array" else
                      {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.dataType.typeName()])
                     for f in df.sparkSession.createDataFrame([], schema).schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        done: list[dict] = []
        key = None
        for b in batches:
            for row in b.to_pylist():
                own = [row[k] for k in keys]
                if held and own != key:
                    done += work(held)
                    held = []
                    if len(done) >= BLOCK:
                        yield pa.RecordBatch.from_pylist(done, schema=out)
                        done = []
                key = own
                held.append(row)
        if held:
            done += work(held)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=out)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _then(x: list[int], y: list[int]) -> list[int]:
    """Cost matrices (begin x end, in a row): the one, then the other."""
    return [min(min(x[4 * i + k] + y[4 * k + j] for k in STATES), NEVER) for i in STATES for j in STATES]


def _before(matrix: list[int], ends: list[int]) -> list[int]:
    return [min(min(matrix[4 * i + j] + ends[j] for j in STATES), NEVER) for i in STATES]


def _map_then(x: list[int], y: list[int]) -> list[int]:
    return [y[end] if end >= 0 else -1 for end in x]


def _spread(blocks: DataFrame, then: Callable, past: Callable, at_edge: list[int], from_end: bool) -> DataFrame:
    """(c, block, value, given) for ``blocks`` (c, block, value): what ``past`` makes of ``at_edge``
    through all the blocks of c behind this one, or, unless ``from_end``, ahead of it. Values
    are composed by ``then`` in a tree of fan ``FAN``."""
    parent = F.call_function("div", F.col("block"), F.lit(FAN)).alias("parent")
    levels = [blocks]
    while (levels[-1].agg(F.max("block")).first()[0] or 0) > 0:
        def merged(rows: list[dict]) -> list[dict]:
            value = rows[0]["value"]
            for r in rows[1:]:
                value = then(value, r["value"])
            return [{"c": rows[0]["c"], "block": rows[0]["parent"], "value": value}]
        levels.append(cut_lineage(_by_runs(levels[-1].select("c", "block", "value", parent), ["c", "parent"],
                                           [F.col("block")], merged, "c long, block long, value array<long>")))

    given = levels[-1].select("c", "block", "value", F.array(*(F.lit(x).cast("long") for x in at_edge)).alias("given"))
    for level in reversed(levels[:-1]):
        def passed(rows: list[dict]) -> list[dict]:
            out, at = [], rows[0]["given"]
            for r in rows:
                out.append({"c": r["c"], "block": r["block"], "value": r["value"], "given": at})
                at = past(r["value"], at)
            return out
        above = given.select(F.col("c").alias("_c"), F.col("block").alias("_parent"), "given")
        below = level.select("c", "block", "value", parent)
        given = cut_lineage(_by_runs(
            below.join(above, (F.col("c") == F.col("_c")) & (F.col("parent") == F.col("_parent"))).drop("_c", "_parent"),
            ["c", "parent"], [F.col("block").desc() if from_end else F.col("block").asc()], passed,
            "c long, block long, value array<long>, given array<long>"))
    return given


def _rows(codes: bytes) -> Rows:
    return [(x & 3, x >> 2) for x in codes]


def _summed(rows: list[dict]) -> list[dict]:
    """A block's row: its codes, its cost matrix, and how many neighbours' initials are illegal."""
    own = [r for r in rows if not r["ahead"]]
    illegal = sum((x["role"], y["role"]) not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))
                  for x, y in zip(rows, rows[1:]))
    known = [(r["role"], r["fault"]) for r in own]
    matrix = [cost for begin in STATES for cost in forward(known, [0 if s == begin else NEVER for s in STATES])]
    return [{"c": own[0]["c"], "block": own[0]["block"], "first": own[0]["pos"], "illegal": illegal, "value": matrix,
             "codes": bytes(role | fault << 2 for role, fault in known)}] if own else []


def _exits(rows: list[dict]) -> list[dict]:
    """For each state that a block may begin in, the state that its best script ends in."""
    out = []
    for r in rows:
        known = _rows(r["codes"])
        begins = [NOTHING] if r["block"] == 0 else STATES
        ends = [solve(known, s, r["given"])[1] if s in begins and _before(r["value"], r["given"])[s] < NEVER else -1
                for s in STATES]
        out.append({"c": r["c"], "block": r["block"], "value": ends})
    return out


def _edits(rows: list[dict]) -> list[dict]:
    """An edit a row: (c, pos of the row that it is of or ahead of, sub, edit, role, cost)."""
    out = []
    for r in rows:
        known, state = _rows(r["codes"]), r["begin"]
        letters, end = solve(known, state, r["given"])
        for k, (x, (role, fault)) in enumerate(zip(letters, known)):
            pos = r["first"] + k
            for sub, (letter, after) in enumerate(script(x, state)):
                state = (role if letter == "K" else after)
                stays = fault if letter in "KR" else 0
                out.append({"c": r["c"], "pos": pos, "sub": sub, "edit": letter,
                            "role": ROLES[state] if letter in "IR" else None,
                            "cost": {"K": 0, "R": RETYPE, "D": DELETE, "I": INSERT}[letter] + stays})
        if r["last"]:
            pos, sub = r["first"] + len(known) - 1, 4
            for letter, state in script("I" * (ENDS[end] // INSERT), end):
                out.append({"c": r["c"], "pos": pos, "sub": sub, "edit": letter, "role": ROLES[state], "cost": INSERT})
                sub += 1
    return out


# ---------------------------------------------------------------- operator

def _or_space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


class Repair:
    """The edits of all conversations, and what was found in them.

    ``edits``: id, place (ascending in a conversation), edit, turn, role, text, fault, cost; one row
    for each row (K, R, D) and for each inserted turn (I). Those with another edit than D, by
    place, are the repaired conversations.
    ``faults``: id, gaps, illegal and ``c``, a number of the conversation."""

    def __init__(self, convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text"):
        self.conv_col = conv_col
        given = convs.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                             _or_space(role_col).alias("role"), _or_space(text_col).alias("text"))
        self.ordered = assign_dense_ids(given.withColumn("_digest", F.md5(F.col("text").cast("binary"))),
                                        ["conv", "turn", "role", "_digest"], "pos", 0)
        ids = self.ordered.groupBy("conv").agg(
            F.min("pos").alias("c"),
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"))
        self.ids = cut_lineage(ids)
        blocks = self._blocks()
        self.faults = self.ids.join(blocks.groupBy(F.col("c").alias("_c")).agg(F.sum("illegal").alias("illegal")),
                                    F.col("c") == F.col("_c")).select(F.col("conv").alias(conv_col), "c", "gaps", "illegal")
        self.edits = self._script(blocks)

    def _blocks(self) -> DataFrame:
        text, role = F.col("text"), F.substring("role", 1, 1)
        tail = F.expr(r"right(rtrim('\t\n\u000B\f\r ', text), 1)")
        coded = self.ordered.select(
            "conv", "pos", F.coalesce(*(F.when(role == k, v) for k, v in INITIALS.items()), F.lit(0)).alias("role"),
            F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("_key"),
            (~text.rlike(rf"[^{BLANK[1:]}")).alias("_blank"), (~tail.isin(".", "!", "?")).alias("_open"))
        numbered = coded.join(self.ids.select(F.col("conv").alias("_conv"), "c"),
                              F.col("conv").eqNullSafe(F.col("_conv"))).drop("conv", "_conv")
        repeated = numbered.groupBy(F.col("c").alias("_c"), F.col("_key").alias("_k")).agg(
            F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
        marked = numbered.join(repeated, (F.col("c") == F.col("_c")) & (F.col("_key") == F.col("_k")), "left")
        self.marks = cut_lineage(marked.select(
            "c", "pos", "role",
            F.when(F.col("_blank"), "blank").when(F.col("pos") > F.col("_first"), "duplicate")
            .when(F.col("_open"), "truncated").alias("fault")))
        no = F.col("pos") - F.col("c")
        block = F.call_function("div", no, F.lit(BLOCK))
        rows = self.marks.select(
            "c", "pos", F.col("role").cast("long").alias("role"),
            F.when(F.col("fault") == "truncated", TRUNCATED).when(F.col("fault").isNull(), FINE).otherwise(GOES)
            .cast("long").alias("fault"),
            # the last row of a block is also seen, ahead of its own rows, by the next one
            F.explode(F.when(no % BLOCK == BLOCK - 1, F.array(block, block + 1)).otherwise(F.array(block))).alias("block"),
            block.alias("_own")).withColumn("ahead", (F.col("block") > F.col("_own")).cast("long")).drop("_own")
        return cut_lineage(_by_runs(rows, ["c", "block"], [F.col("pos")], _summed,
                                    "c long, block long, first long, illegal long, value array<long>, codes binary"))

    def _script(self, blocks: DataFrame) -> DataFrame:
        key = ["c", "block"]
        after = _spread(blocks.select(*key, "value"), _then, _before, ENDS, from_end=True)
        ahead = cut_lineage(blocks.drop("value").join(after, key))
        exits = _by_runs(ahead.select(*key, "codes", "value", "given"), key, [], _exits,
                         "c long, block long, value array<long>")
        begins = _spread(cut_lineage(exits), _map_then, lambda ends, at: [ends[at[0]]], [NOTHING], from_end=False)
        last = blocks.groupBy("c").agg(F.max("block").alias("_last"))
        told = (ahead.join(begins.select(*key, F.col("given")[0].alias("begin")), key).join(last, "c")
                .select(*key, "first", "codes", "given", "begin", (F.col("block") == F.col("_last")).cast("long").alias("last")))
        edits = _by_runs(told, key, [], _edits, "c long, pos long, sub long, edit string, role string, cost long")
        done = edits.join(self.marks.select("pos", "fault"), "pos").withColumnRenamed("role", "_role")
        own = F.col("edit") != "I"
        return cut_lineage(done.join(self.ordered.select("pos", "conv", "turn", "role", "text"), "pos").select(
            F.col("conv").alias(self.conv_col), "c", (F.col("pos") * 8 + F.col("sub")).alias("place"), "edit",
            F.when(own, F.col("turn")).alias("turn"), F.coalesce("_role", "role").alias("role"),
            F.when(own, F.col("text")).otherwise("").alias("text"), F.when(own, F.col("fault")).alias("fault"), "cost"))

    def repaired(self) -> DataFrame:
        """The turns of the repaired conversations: id, place, turn, role, text."""
        return self.edits.where("edit <> 'D'").select(self.conv_col, "place", "turn", "role", "text")

    def audits(self) -> DataFrame:
        """Per conversation with rows: id, gaps, blank, duplicate, truncated, illegal, cost, audit,
        repaired_sha256."""
        faults = ["blank", "duplicate", "truncated"]

        def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = found = None
            out: list[dict] = []

            def close() -> None:
                if found is not None:
                    digest, _, letters, counts, cost = found
                    out.append({"c": c, **counts, "cost": cost, "audit": "".join(letters),
                                "repaired_sha256": digest.hexdigest()})
            for b in batches:
                for r in b.to_pylist():
                    if found is None or r["c"] != c:
                        close()
                        c, found = r["c"], [hashlib.sha256(), False, [], dict.fromkeys(faults, 0), 0]
                    found[2].append(r["edit"])
                    found[4] += r["cost"]
                    if r["fault"]:
                        found[3][r["fault"]] += 1
                    if r["edit"] != "D":
                        found[0].update(("\n" * found[1] + f"{r['role']}:{r['text']}").encode())
                        found[1] = True
                if len(out) >= BLOCK:
                    yield pa.RecordBatch.from_pylist(out)
                    out.clear()
            close()
            if out:
                yield pa.RecordBatch.from_pylist(out)

        # a digest takes the turns in order: streamed, not gathered
        streamed = (self.edits.select("c", "place", "edit", "role", F.when(F.col("edit") != "D", F.col("text")).alias("text"),
                                      "fault", "cost")
                    .repartition("c").sortWithinPartitions("c", "place").mapInArrow(
            told, "c long, " + "".join(f"{x} long, " for x in faults) + "cost long, audit string, repaired_sha256 string"))
        return self.faults.join(streamed, "c").select(
            self.conv_col, "gaps", *faults, "illegal", "cost", "audit", "repaired_sha256")


def damage(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text) with faults by crc32(``conv:turn``) % 20: 0 drops the row, 1 empties its
    text, 2 removes its sentence ends, 3 repeats it, 4 sets role user. Nulls are written as one space."""
    kind = F.crc32(F.concat(_or_space(conv_col), F.lit(":"), _or_space(turn_col)).cast("binary")) % 20
    return convs.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), _or_space(role_col).alias("role"),
                        _or_space(text_col).alias("text"), kind.alias("_kind")).where("_kind <> 0").select(
        "conv", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
    ).drop("_copy")


def repair_damaged(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """The audits of all conversations after ``damage``, of those too that lost all their rows."""
    audits = Repair(damage(convs, conv_col, turn_col, role_col, text_col), "conv").audits()
    every = convs.select(F.col(conv_col).alias("_conv")).distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(audits, F.col("_conv").eqNullSafe(F.col("conv")), "left").select(
        F.col("_conv").alias(conv_col), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
