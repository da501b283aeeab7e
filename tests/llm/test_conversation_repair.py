import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from linkledger.llm import conversation_repair as m
from linkledger.llm.conversation_repair import Repair, repair_damaged

CONVS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
FORM = re.compile("(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_scripts(rows):
    """Cheapest, then least, by a table over prefixes that holds whole scripts; the states are the
    role initials' own regular expression: what may still come to fit."""
    # kept by (is anything there, last initial)
    table = {"": (0, "", ())}
    after = {"": "su", "s": "u", "u": "a", "a": "u"}

    def inserted(table):
        out = dict(table)
        for _ in range(3):
            for last, (cost, audit, turns) in list(out.items()):
                for x in after[last]:
                    if x != "s":
                        new = (cost + 2, audit + "I", (*turns, ({"u": "user", "a": "assistant"}[x], "")))
                        out[x] = min(out.get(x, new), new)
        return out

    for role, text, fault in rows:
        new = {}

        def put(last, entry):
            new[last] = min(new.get(last, entry), entry)
        for last, (cost, audit, turns) in inserted(table).items():
            put(last, (cost + 3, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            more = fault == "truncated"
            for x in after[last]:
                if role[:1] == x:
                    put(x, (cost + more, audit + "K", (*turns, (role, text))))
                if x != "s":
                    put(x, (cost + 2 + more, audit + "R", (*turns, ({"u": "user", "a": "assistant"}[x], text))))
        table = new
    return min(v for k, v in inserted(table).items() if k in ("", "a"))


def plain_audit(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged(rows) if r[0] == conv),
                     key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        faults, seen = [], set()
        for _, _, role, text in own:
            shown = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen
                          else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        initials = [r[2][:1] for r in own]
        cost, audit, kept = plain_scripts([(r[2], r[3], f) for r, f in zip(own, faults)])
        assert FORM.fullmatch("".join(r[0][0] for r in kept))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
                    sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def random_convs(seed, convs=40, longest=12):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "usher", "", None, "s"]
    texts = ["Yes.", "no", "What? ", "a\n.", "b!\t\n", "\t", "", None, "é.", ".\x0b", "x\x1c", "y.\x85"]
    rows = []
    for conv in [None, *range(convs)]:
        for k in range(rng.randint(1, longest)):
            turn = rng.choice([k, k, k, k + 1, None])
            rows.append((conv, turn, rng.choice(roles[:rng.choice([4, 5, 10])]), rng.choice(texts) if rng.random() < .5 else f"t{k}."))
    return rows


@pytest.mark.parametrize("seed,block,fan", [(1, 4096, 1024), (2, 3, 2), (3, 2, 3)])
def test_equals_the_table_of_whole_scripts(spark, monkeypatch, seed, block, fan):
    monkeypatch.setattr(m, "BLOCK", block)
    monkeypatch.setattr(m, "FAN", fan)
    rows = random_convs(seed)
    rows += [(99, k, "user" if k % 3 else "assistant", f"{k}" + "." * (k % 5 > 0)) for k in range(70)]
    assert rows_of(repair_damaged(spark.createDataFrame(rows, CONVS).repartition(3))) == plain_audit(rows)


def test_halves_find_the_least_of_all_scripts():
    rng = random.Random(5)
    for _ in range(300):
        rows = [(rng.choice([0, 1, 2, 3]), rng.choice([0, 0, 1, 2])) for _ in range(rng.randint(1, 5))]
        role = {0: "x", 1: "system", 2: "user", 3: "assistant"}
        fault = {0: "", 1: "truncated", 2: "blank"}
        cost, audit, _ = plain_scripts([(role[r], "", fault[f]) for r, f in rows])
        letters, end = m.solve(rows, m.NOTHING, m.ENDS)
        assert "".join(letters) + "I" * (m.ENDS[end] // 2) == audit
        assert m.backward(rows, m.ENDS)[m.NOTHING] == cost
        there = m.forward(rows, [0, m.NEVER, m.NEVER, m.NEVER])
        assert min(x + y for x, y in zip(there, m.ENDS)) == cost


def test_short_scripts_against_every_script():
    """The table itself, against all words over K, R, D and I."""
    rng = random.Random(6)
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), "", rng.choice(["", "", "truncated", "blank"]))
                for _ in range(rng.randint(0, 3))]
        best = None
        for size in range(len(rows), len(rows) + 5):
            for word in product("DIKR", repeat=size):
                if size - word.count("I") != len(rows):
                    continue
                made, cost, at, last = "", 0, 0, ""
                for x in word:
                    if x == "I":
                        last, cost = step[last], cost + 2
                        made += last
                        continue
                    role, _, fault = rows[at]
                    at += 1
                    if x == "D":
                        cost += 3
                    elif fault == "blank":
                        break
                    else:
                        last = role[0] if x == "K" else step[last]
                        if last not in step:
                            break
                        made += last
                        cost += (fault == "truncated") + 2 * (x == "R")
                else:
                    if FORM.fullmatch(made) and (best is None or (cost, "".join(word)) < best):
                        best = (cost, "".join(word))
        assert plain_scripts(rows)[:2] == best


def test_edits_are_real_turns(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "user", ""), (1, 3, "user", "Why"),
            (2, 0, "tool", "Out.")]
    repair = Repair(spark.createDataFrame(rows, CONVS))
    got = [(r["conv_id"], r["edit"], r["turn"], r["role"], r["text"], r["fault"], r["cost"])
           for r in repair.edits.orderBy("conv_id", "place").collect()]
    assert got == [(1, "K", 0, "system", "Be brief.", None, 0), (1, "I", None, "user", "", None, 2),
                   (1, "K", 1, "assistant", "Hello.", None, 0), (1, "D", 2, "user", "", "blank", 3),
                   (1, "D", 3, "user", "Why", "truncated", 3), (2, "D", 0, "tool", "Out.", None, 3)]
    assert [(r["conv_id"], r["role"], r["text"]) for r in repair.repaired().orderBy("conv_id", "place").collect()] \
        == [(1, "system", "Be brief."), (1, "user", ""), (1, "assistant", "Hello.")]


def test_empty_table_clashing_columns_and_a_long_text(spark):
    from pyspark.sql import functions as F

    assert repair_damaged(spark.createDataFrame([], CONVS)).count() == 0
    rows = [(k, t, "user" if t % 2 == 0 else "assistant", "x. " * 100_000 + "\t" * 100_000) for k in range(3) for t in range(4)]
    df = spark.createDataFrame(rows, CONVS).select("*", *(F.lit(1).alias(c) for c in (
        "c", "pos", "block", "fault", "edit", "cost", "conv", "gaps", "audit", "place", "given")))
    assert rows_of(repair_damaged(df)) == plain_audit(rows)
