import re

from linkledger.llm.quotation import normalised, parse, reply_order

SCHEMA = "conv_id long, turn int, role string, text string"
TALK = [
    (1, 0, "user", "Hello there, how do I sort a list?\nIt has numbers."),
    (1, 1, "assistant", "On Monday, user wrote:\n> Hello there, how do I   SORT a list?\n> It has numbers.\n\n"
                        "Use sorted().\n\nIt is stable."),
    (1, 2, "user", "> > Hello there, how do I sort a list?\n> Use sorted().\nThanks."),
    (1, 3, "user", "> It has numbers.\nwhat about strings?"),
    (1, 4, "user", "no quotation"),
    (2, 0, "user", "> Use sorted().\nI saw this elsewhere"),
    (2, 1, "assistant", None),
]


def talk(spark, rows):
    return reply_order(spark.createDataFrame(rows, SCHEMA)).collect()


def test_parse_levels_and_own_words():
    body, own, quotes = parse(TALK[2][3])
    assert body == "Thanks." and len(own) == 1 and [q["level"] for q in quotes] == [2, 1]
    body, _, quotes = parse(TALK[1][3])
    assert body == "Use sorted().\n\nIt is stable." and {q["level"] for q in quotes} == {1}
    assert {q["words"] for q in quotes} == {11, 8, 3}
    assert parse("") == ("", [], []) and parse(">\n> ") == ("", [], [])
    assert normalised(" A\tb\n\nC ") == "a b c"


def test_replies_and_order(spark):
    got = {(r["conv_id"], r["turn"]): r for r in talk(spark, TALK)}
    assert {k: r["answers"] for k, r in got.items()} == {
        (1, 0): None, (1, 1): 0, (1, 2): 1, (1, 3): 0, (1, 4): None, (2, 0): None, (2, 1): None}
    assert {k: r["thread"] for k, r in got.items() if k[0] == 1} == {(1, 0): 0, (1, 1): 0, (1, 2): 0, (1, 3): 0, (1, 4): 4}
    assert got[1, 2]["quotes"] == 2 and got[1, 2]["linked"] == 2 and got[2, 0]["linked"] == 1
    assert not any(">" in r["text"] for r in got.values())


def test_threads_stand_together_and_answers_follow(spark):
    rows = [(7, 0, "u", "first topic"), (7, 1, "u", "second topic"), (7, 2, "a", "> first topic\nfirst answer"),
            (7, 3, "a", "> second topic\nsecond answer"), (7, 4, "u", "> > first topic\n> first answer\nfirst thanks")]
    got = sorted(talk(spark, rows), key=lambda r: r["position"])
    assert [r["turn"] for r in got] == [0, 2, 4, 1, 3] and [r["position"] for r in got] == [0, 1, 2, 3, 4]


def brute(rows):
    """Each quoted passage against all messages; the answer of each message."""
    said = {(c, t): parse(x or "")[1] for c, t, _, x in rows}
    out = {}
    for c, t, _, x in rows:
        hits = {}
        for q in parse(x or "")[2]:
            first = min((u for (d, u), own in said.items() if d == c and q["hash"] in own), default=None)
            if first is not None and first < t:
                best = hits.get((q["level"], q["passage"]))
                hits[q["level"], q["passage"]] = max(best or (0, 0), (q["words"], first))
        low = min((level for level, _ in hits), default=None)
        out[c, t] = max((first for (level, _), (_, first) in hits.items() if level == low), default=None)
    return out


def test_random_talk_matches_brute_force(spark):
    import random

    rng = random.Random(4)
    lines = [f"line number {k} says {k * k}" for k in range(12)]
    rows = []
    for c in range(6):
        for t in range(15):
            text = []
            for _ in range(rng.randint(0, 3)):
                text.append("> " * rng.randint(1, 3) + rng.choice(lines))
            for _ in range(rng.randint(0, 2)):
                text.append(rng.choice(lines))
            rows.append((c, t, rng.choice("ua"), "\n".join(text)))
    got = {(r["conv_id"], r["turn"]): r["answers"] for r in talk(spark, rows)}
    assert got == brute(rows)


def test_a_long_thread_and_a_line_that_all_share(spark):
    rows = [(1, 0, "u", "start\nhi all")] + [(1, t, "u", f"> part {t - 1}\nhi all\npart {t}" if t > 1 else "> start\nhi all\npart 1")
                                             for t in range(1, 40)]
    got = sorted(talk(spark, rows), key=lambda r: r["position"])
    assert [r["turn"] for r in got] == list(range(40)) and {r["thread"] for r in got} == {0}
    assert [r["answers"] for r in got] == [None, *range(39)]


def test_odd_rows(spark):
    rows = TALK + [(None, 0, "u", "> Use sorted().\nx"), (3, None, "u", "> no quotation"), (1, 4, "user", "no quotation"),
                   (4, 0, None, ""), (4, 1, "u", "word " * 50_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F
    got = reply_order(df.select("*", *(F.lit(1).alias(c) for c in ["own", "quotes", "thread", "conv", "level", "hash"]))).collect()
    assert len(got) == len(rows) and sum(r["conv_id"] is None for r in got) == 1
    assert [r["linked"] for r in got if r["turn"] is None] == [0]
    assert talk(spark, TALK[:0]) == []


def test_sentences_of_a_line_and_of_a_wrapped_paragraph_match_a_search_of_the_text(spark):
    import random

    rng = random.Random(6)
    rows = [(0, 0, "a", "Use sorted(). It is stable."), (0, 1, "u", "> Use sorted().\nThanks a lot!")]
    for c in range(1, 6):
        said = []
        for t in range(8):
            own = " ".join(f"Sentence {c}{t}{k} has {rng.randrange(99)} \"words\" in it{rng.choice(['.', '!', '?'])}" for k in range(4))
            quoted = rng.choice(said) if said else ""
            k = rng.randrange(3)
            part = " ".join(re.findall(r"Sentence.*?[.!?]", quoted)[k:k + 2]).split(" ")
            wrapped = [" ".join(part[i:i + 5]) for i in range(0, len(part), 5)]
            rows.append((c, t, "u", "".join(f"> {x}\n" for x in wrapped if x) + "\n" + own))
            said.append(own)
    got = {(r["conv_id"], r["turn"]): r["answers"] for r in talk(spark, rows)}
    own = {(c, t): normalised(" ".join(x for x in text.split("\n") if x[:1] != ">")) for c, t, _, text in rows}
    want = {}
    for c, t, _, text in rows:
        q = normalised(" ".join(x[1:] for x in text.split("\n") if x[:1] == ">"))
        want[c, t] = min((u for d, u in own if d == c and u < t and q in own[d, u]), default=None) if q else None
    assert got == want and got[0, 1] == 0 and sum(x is not None for x in got.values()) > 20
