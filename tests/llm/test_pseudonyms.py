import random
import re

import pytest
from pyspark.sql import functions as F

from linkledger.llm.pseudonyms import KINDS, luhn_sum, permute, pseudonymise

from .cases import CLASH, no_docs, odd_docs, odd_rows

FORMS = {"email": r"[A-Za-z0-9_%+.-]+@[a-z0-9.-]+\.[a-z]+", "ip": r"\d+\.\d+\.\d+\.\d+", "ssn": r"\d{3}-\d\d-\d{4}"}


def run(spark, *texts, key="k"):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in pseudonymise(docs, key).orderBy("doc_id").collect()]


def luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10


def shape(text):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", text)))


def test_the_network_is_a_permutation_that_the_key_and_tweak_choose(spark):
    seen = set()
    for a, b in [(7, 5), (10, 10), (13, 1), (26, 26)]:
        for key, tweak in [("k", "t"), ("k", "u"), ("l", "t")]:
            got = spark.range(a * b).select(permute(F.col("id"), F.lit(a).cast("long"), F.lit(b).cast("long"),
                                                    F.lit(tweak), key).alias("y")).collect()
            out = tuple(r["y"] for r in got)
            assert sorted(out) == list(range(a * b))
            seen.add(out)
    assert len(seen) == 12


def test_values_keep_their_format_and_stay_linked(spark):
    texts = ["mail Ab.Cd-12@mail0.example.com now", "(+1 (487) 555-7209) 10.20.30.255", "4736-9625-7309-9581 x",
             "4736962573099581, 4736 9625 7309 9581", "on 2024-02-29 29.02.2024 02/29/2024.", "123-45-6789",
             "ab.cd-12@mail0.example.com", "+49 30 1234 5678"]
    rows = run(spark, *texts)
    for text, r in zip(texts, rows):
        assert r["text"] != text and sum(r[f"n_{k}"] for k in KINDS) >= 1
        if not r["n_ip"]:
            assert shape(r["text"]) == shape(text)
    card = rows[3]["text"].split(", ")[0]
    assert luhn(card) == 0 and rows[3]["text"].split(", ")[1].replace(" ", "") == card
    assert rows[2]["text"].split(" ")[0].replace("-", "") == card
    assert rows[0]["text"].split(" ")[1].lower() == rows[6]["text"]
    assert rows[1]["text"].startswith("(+1 (") and rows[1]["n_phone"] == 1
    ip = rows[1]["text"].split(" ")[-1].split(".")
    assert len(ip) == 4 and all(0 <= int(x) <= 255 for x in ip)
    iso, dotted, slashed = rows[4]["text"][3:-1].split(" ")
    y, m, d = iso.split("-")
    assert dotted == f"{d}.{m}.{y}" and slashed == f"{m}/{d}/{y}" and "1800-01-01" <= iso <= "2199-12-31"
    assert run(spark, texts[0])[0]["text"] == rows[0]["text"]
    assert run(spark, texts[0], key="other")[0]["text"] != rows[0]["text"]


def test_what_fails_its_check_stays(spark):
    texts = ["4736962573099582", "2024-02-30 31.04.2024 13/01/2024", "999.1.1.1 1.2.3.4.5 3.14", "call 555-7209", "x@y",
             "version 2.0.", "", "a" * 100 + "@", "+12 34", None]
    for text, r in zip(texts, run(spark, *texts)):
        assert r["text"] == text and all(r[f"n_{k}"] == 0 for k in KINDS)


@pytest.mark.parametrize("text,kind,value", [
    ("card 4736-9625-7309-9581 12/27", "card", "4736-9625-7309-9581"), ("4736962573099581 737", "card", "4736962573099581"),
    ("2 4736 9625 7309 9581", "card", "4736 9625 7309 9581"), ("12345 2024-02-29", "date", "2024-02-29"),
    ("id 98765 123-45-6789", "ssn", "123-45-6789"), ("root@10.20.30.40", "ip", "10.20.30.40"),
    ("No.4736962573099581", "card", "4736962573099581"), ("+33 6 12 34 56 78", "phone", "+33 6 12 34 56 78"),
    ("415-555-0132", "phone", "415-555-0132"), ("415.555.0132.", "phone", "415.555.0132"),
    ("3714 496353 98431 9", "card", "3714 496353 98431"), ("4736 9625 7309 9581 3rd", "card", "4736 9625 7309 9581"),
    ("x 47 3696 2573 0995 81", "card", "47 3696 2573 0995 81")])
def test_valid_values_are_found_beside_other_digits(spark, text, kind, value):
    (r,) = run(spark, text)
    assert {k: r[f"n_{k}"] for k in KINDS} == {k: int(k == kind) for k in KINDS}
    at = text.index(value)
    out = r["text"]
    assert out[:at] == text[:at] and out.endswith(text[at + len(value):]) and out != text
    assert kind == "ip" or shape(out) == shape(text)


def test_patterns_do_not_recurse(spark):
    """Each of these is one text that a group repeated without a bound would overflow on."""
    n = 100_000
    texts = ["x@" + "a." * n, "x@" + "ab." * n + "com", "a." * n + "@b.com", "1 " * n, "1-" * n, "12 " * n + "x", "1." * n,
             "+" + "1 " * n, "(12) " * n, "4" * n, "1234 " * n]
    for text, r in zip(texts, run(spark, *texts)):
        assert shape(r["text"]) == shape(text)


# An independent finder: positions and plain character tests, no shared patterns.

DIGITS, WORD = set("0123456789"), set("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def fits(form, text, at):
    """The end of ``form`` at a place: 9 is a digit, other characters are themselves; or None."""
    for k, c in enumerate(form):
        x = text[at + k:at + k + 1]
        if not (x in DIGITS if c == "9" else x == c) or x == "":
            return None
    return at + len(form)


def real_day(text):
    import datetime
    y, m, d = {"-": lambda: text.split("-"), ".": lambda: text.split(".")[::-1],
               "/": lambda: (lambda p: (p[2], p[0], p[1]))(text.split("/"))}[next(c for c in text if c not in DIGITS)]()
    try:
        return 1800 <= datetime.date(int(y), int(m), int(d)).year < 2200
    except ValueError:
        return False


def formed(text, at):
    """(end, kind) of an ip, date, ssn or dashed phone at a place that no letter or digit precedes."""
    before = text[max(0, at - 2):at]
    behind = lambda seps: len(before) == 2 and before[0] in DIGITS and before[1] in seps
    if not behind("."):
        end, octets = at, []
        while len(octets) < 4 and end < len(text) and text[end] in DIGITS:
            stop = end
            while stop < len(text) and text[stop] in DIGITS:
                stop += 1
            octets.append(text[end:stop])
            end = stop + 1 if len(octets) < 4 and text[stop:stop + 1] == "." else stop
            if end == stop:
                break
        well = all(len(o) < 4 and int(o) < 256 and (len(o) < 3 or o[0] in "12") for o in octets)
        if len(octets) == 4 and well and not (text[end:end + 1] == "." and text[end + 1:end + 2] in DIGITS):
            return end, "ip"
    for form in ("9999-99-99", "99.99.9999", "99/99/9999"):
        end = fits(form, text, at)
        if end and not behind("./-") and text[end:end + 1] not in DIGITS:
            return end, "date" if real_day(text[at:end]) else None
    end = fits("999-99-9999", text, at)
    follows = lambda end, seps: text[end:end + 1] in seps and text[end + 1:end + 2] in DIGITS and end + 1 < len(text)
    if end and not behind(".-") and text[end:end + 1] not in DIGITS and not follows(end, "-"):
        return end, "ssn"
    for form in ("999-999-9999", "999.999.9999"):
        end = fits(form, text, at)
        if end and not behind(" .-") and text[end:end + 1] not in DIGITS and not follows(end, ".-"):
            return end, "phone"
    return None


def cards_of(text):
    """(begin, end) of cards in a piece without other values."""
    out, at = [], 0
    while at < len(text):
        stop = at
        while stop < len(text) and text[stop] in DIGITS | {" ", "-"}:
            stop += 1
        begins = text[at] in DIGITS and (at == 0 or text[at - 1] not in WORD) and not (
            at > 1 and text[at - 1] in ".," and text[at - 2] in DIGITS)
        if not begins or stop - at < 13:
            at += 1
            continue
        run = text[at:stop]
        groups, k = [], 0
        while k < len(run):
            if run[k] in DIGITS:
                end = k
                while end < len(run) and run[end] in DIGITS:
                    end += 1
                groups.append((k, end))
                k = end
            else:
                k += 1
        letter = stop < len(text) and text[stop] in WORD

        def good(i, j):
            if letter and groups[j][1] == len(run):
                return False
            digits = "".join(run[a:b] for a, b in groups[i:j + 1])
            return 13 <= len(digits) <= 19 and luhn(digits) == 0

        def seps(i, j):
            return [run[groups[k][1]:groups[k + 1][0]] for k in range(i, j)]
        last = len(groups) - 1
        if all(len(x) == 1 for x in seps(0, last)) and good(0, last):
            out.append((at + groups[0][0], at + groups[last][1]))
        else:
            starts = {}
            for i in range(len(groups)):
                for size in (5, 4, 3, 1):
                    j = i + size - 1
                    if j > last or not good(i, j) or size > 1 and (run[groups[i][0]] not in "23456"
                                                                   or len(set(seps(i, j))) > 1 or len(seps(i, j)[0]) > 1):
                        continue
                    n = [b - a for a, b in groups[i:j + 1]]
                    if (size == 1 or size == 5 and n[:4] == [4] * 4 and n[4] < 4 or size == 4 and n[:3] == [4] * 3 and n[3] < 5
                            or size == 3 and n[:2] == [4, 6] and n[2] in (4, 5)):
                        starts[i] = size
                        break
            out += [(at + groups[i][0], at + groups[i + size - 1][1]) for i, size in starts.items()
                    if not any(i - d in starts and starts[i - d] > d for d in range(1, 5))]
        at = stop + 1
    return out


def find_all(text):
    """(begin, end, kind) of all values but e-mail and bracketed or international phones."""
    out, pieces, at, begin = [], [], 0, 0
    while at < len(text):
        hit = formed(text, at) if text[at] in DIGITS and (at == 0 or text[at - 1] not in WORD) else None
        if hit:
            out += [(at, hit[0], hit[1])] if hit[1] else []
            pieces.append((begin, at))
            at = begin = hit[0]
        else:
            at += 1
    pieces.append((begin, len(text)))
    for a, b in pieces:
        out += [(a + x, a + y, "card") for x, y in cards_of(text[a:b])]
    return sorted(out)


def test_finds_what_an_independent_finder_finds(spark):
    rng = random.Random(4)
    values = ["4736962573099581", "4736 9625 7309 9581", "4736-9625-7309-9581", "3714 496353 98431", "2024-02-29", "2024-02-30", "29.02.2024",
              "02/29/2024", "123-45-6789", "10.20.30.40", "999.1.1.1", "415-555-0132", "415.555.0132", "1", "12", "2024", "737", "98765",
              "4736962573099582", "5105 1051 0510 5100", "6011000990139424"]
    joins = [" ", " ", " ", ", ", "-", ".", "/", "  ", " x ", "No.", "a", "é", ") ", "\n", "@", "--"]
    texts = ["".join(rng.choice(values) + rng.choice(joins) for _ in range(rng.randint(1, 6))) for _ in range(1500)]
    for text, r in zip(texts, run(spark, *texts)):
        spans = find_all(text)
        want = {k: sum(s[2] == k for s in spans) for k in KINDS}
        assert {k: r[f"n_{k}"] for k in KINDS} == want, (text, spans, r["text"])
        if not want["ip"]:
            assert len(r["text"]) == len(text)
            assert {k for k, (x, y) in enumerate(zip(text, r["text"])) if x != y} <= {k for a, b, _ in spans for k in range(a, b)}


def test_matches_at_both_ends_and_side_by_side(spark):
    r = run(spark, "1.2.3.4 5.6.7.8,1.2.3.4")[0]
    a, rest = r["text"].split(" ")
    b, c = rest.split(",")
    assert a == c and a != b and r["n_ip"] == 3


def test_luhn_sum(spark):
    numbers = ["4736962573099581", "79927398713", "0", "18"]
    got = spark.createDataFrame([(x,) for x in numbers], "x string").select((luhn_sum(F.col("x")) % 10).alias("s")).collect()
    assert [r["s"] for r in got] == [luhn(x) for x in numbers]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = pseudonymise(docs, "k").collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(((r[0], r[1]) for r in odd_rows()), key=str)
    assert not set(CLASH) & set(got[0].asDict()) and pseudonymise(no_docs(spark), "k").count() == 0
    long = " ".join(["word"] * 20_000 + ["a.b@c.de"] * 500)
    r = run(spark, long)[0]
    assert r["n_email"] == 500 and len(r["text"]) == len(long)
