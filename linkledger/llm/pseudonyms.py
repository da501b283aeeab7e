"""PII: format-preserving Feistel pseudonyms for validated numbers, dates and addresses.

Found and validated in the text:
  email   local part and domain; the local part's letters and digits are permuted
  ip      four octets of at most 255, permuted as one 32-bit number
  date    yyyy-mm-dd, dd.mm.yyyy or mm/dd/yyyy, a real day; permuted within 400 years
  ssn     ddd-dd-dddd
  card    13 to 19 digits that pass the Luhn check; permuted digits get a new check digit.
          By themselves they may have single blanks or hyphens anywhere; beside other
          digits, as in "2 4736 9625 7309 9581 12/27", they are one group or stand in the
          usual ones (4-4-4-4, 4-6-5 and the like) and begin with 2 to 6
  phone   an international or bracketed number of 10 to 15 digits, or ddd-ddd-dddd or
          ddd.ddd.dddd; a leading +1 stays

A value is a number below N = a * b. Each round splits it as (left, right) = divmod by
b, adds a keyed hash of the right part to the left modulo a, and puts the two back
the other way round. That is a permutation for any a and b, so a pseudonym has the
format of its value, equal values get equal pseudonyms in all documents, and the
holder of the key can undo them. Separators, brackets and case stay in place.

Built-in functions only, no shuffle: a text without a match is passed on after one
scan, else its matches are rewritten between the pieces that they split it into.

Defined results: null text stays null with counts of 0; candidates that fail their
check stay, and cards are still looked for beside them; of an address the first 33
labels count; a value of a very small format, such as a one-letter name, may map to
itself; repeated rows are treated alike; an empty table gives an empty result.
Columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KINDS = ("email", "ip", "date", "ssn", "card", "phone")

# No pattern repeats a group without a bound: the regex engine recurses there.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_FREE = r"(?<![A-Za-z0-9])"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9_%+.-])[A-Za-z0-9_%+.-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,32}[A-Za-z]{2,}",
    "ip": rf"{_FREE}(?<![0-9]\.){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    "date": rf"{_FREE}(?<![0-9][./-])"
            r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9])",
    "ssn": rf"{_FREE}(?<![0-9][.-])[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![0-9]|-[0-9])",
    "phone": rf"{_FREE}(?:\+[0-9]{{1,3}}[ .-]?)?\([0-9]{{2,4}}\)[ .-]?[0-9]{{3,4}}[ .-]?[0-9]{{3,4}}(?![0-9])"
             rf"|{_FREE}(?<!\+)\+[0-9](?:[ .-]?[0-9]){{9,14}}(?![0-9])"
             rf"|{_FREE}(?<![0-9][ .-])[0-9]{{3}}-[0-9]{{3}}-[0-9]{{4}}(?![0-9]|[.-][0-9])"
             rf"|{_FREE}(?<![0-9][ .-])[0-9]{{3}}\.[0-9]{{3}}\.[0-9]{{4}}(?![0-9]|[.-][0-9])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Where cards may be: digits, blanks and hyphens, and a letter that closes them.
RUN = rf"{_FREE}(?<![0-9][.,])[0-9][0-9 -]{{12,}}+[A-Za-z]?"
#: A run that is one card, however it is grouped.
WHOLE = r"[0-9](?:[ -]?[0-9]){12,18}"
#: Cards that begin at a group of digits among others: the usual groups, or one group.
GROUPED = [r"[2-6][0-9]{3}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}\1[0-9]{1,3}", r"[2-6][0-9]{3}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}",
           r"[2-6][0-9]{3}([ -])[0-9]{6}\1[0-9]{4,5}", r"[0-9]{13,19}"]
#: Groups of digits of a card among others, at most; and its characters, with the one behind it.
_GROUPS, _SPAN = 5, 25


def _div(x: Column, y: Column) -> Column:
    return F.call_function("div", x, y)


def _with(value: Column, f) -> Column:
    """f(value), the value computed once however often f uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _power(base: int, n: Column, most: int) -> Column:
    """base ** n for n from 0 to ``most``, as a long."""
    return F.element_at(F.array(*(F.lit(base ** k).cast("long") for k in range(most + 1))), (n + 1).cast("int"))


def _each(n: Column, f) -> Column:
    """f(1) .. f(n) joined to a string; empty for n below 1."""
    return F.array_join(F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), f), "")


def _hash(key: str, tweak: Column, r: Column, right: Column) -> Column:
    """60 bits of a keyed digest."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, r.cast("string"), right.cast("string"), F.lit(key)), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permute(x: Column, a: Column, b: Column, tweak: Column, key: str) -> Column:
    """A keyed permutation of 0 .. a * b - 1 (at most 10**18), by a Feistel network."""
    def turn(v: Column, r: Column) -> Column:
        return a * (v % b) + (_div(v, b) + _hash(key, tweak, r, v % b) % a) % a

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), turn)


def _digits(d: Column, n: Column, kind: str, key: str) -> Column:
    """Another string of n digits (1 to 18) for the digits ``d``."""
    tweak = F.concat_ws(":", F.lit(kind), n.cast("string"))
    half = _div(n, F.lit(2))
    out = permute(d.cast("long"), _power(10, n - half, 9), _power(10, half, 9), tweak, key)
    return F.lpad(out.cast("string"), n.cast("int"), "0")


def _letters(w: Column, n: Column, key: str) -> Column:
    """Another string of n lower-case letters (1 to 12)."""
    chars = F.filter(F.split(w, ""), lambda c: c != "")
    number = F.aggregate(chars, F.lit(0).cast("long"), lambda v, c: v * 26 + (F.ascii(c) - 97))
    half = _div(n, F.lit(2))
    out = permute(number, _power(26, n - half, 6), _power(26, half, 6), F.concat_ws(":", F.lit("letters"), n.cast("string")), key)
    return _with(out, lambda v: _each(n.cast("int"), lambda k: F.char(97 + _div(v, _power(26, n - k, 12)) % 26)))


def _in_chunks(s: Column, size: int, f) -> Column:
    """f over the pieces of up to ``size`` characters."""
    n = F.length(s)
    return _each(F.ceil(n / size).cast("int"),
                 lambda k: f(F.substring(s, (k - 1) * size + 1, F.lit(size)), F.least(F.lit(size), n - (k - 1) * size)))


def _refill(form: Column, digits: Column, letters: Column | None = None) -> Column:
    """``form`` with its digits, and letters if given, replaced in order; case stays."""
    def at(k: Column) -> Column:
        c = F.substring(form, k, F.lit(1))
        so_far = F.substring(form, F.lit(1), k)
        nth = lambda s, kind: F.substring(s, F.length(F.regexp_replace(so_far, kind, "")), F.lit(1))
        out = F.when(c.between("0", "9"), nth(digits, "[^0-9]"))
        if letters is not None:
            out = (out.when(c.between("a", "z"), nth(letters, "[^A-Za-z]"))
                   .when(c.between("A", "Z"), F.upper(nth(letters, "[^A-Za-z]"))))
        return out.otherwise(c)
    return _each(F.length(form), at)


def _only(m: Column, kind: str) -> Column:
    return F.regexp_replace(m, f"[^{kind}]", "")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a string of digits, check digit last."""
    n = F.length(digits)

    def add(total: Column, k: Column) -> Column:
        d = F.substring(digits, n - k + 1, F.lit(1)).cast("int")
        return total + F.when(k % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _email(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    digits = _in_chunks(_only(local, "0-9"), 18, lambda d, n: _digits(d, n, "email", key))
    letters = _in_chunks(F.lower(_only(local, "A-Za-z")), 12, lambda w, n: _letters(w, n, key))
    return _with(F.struct(digits.alias("d"), letters.alias("w")), lambda new: F.concat(
        _refill(local, new["d"], new["w"]), F.substring(m, F.length(local) + 1, F.length(m))))


def _ip(m: Column, key: str) -> Column:
    octets = F.split(m, r"\.")
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda v, o: v * 256 + o.cast("long"))
    half = F.lit(1 << 16).cast("long")
    return _with(permute(number, half, half, F.lit("ip"), key), lambda v: F.concat_ws(
        ".", *(_div(v, F.lit(256 ** k)) % 256 for k in (3, 2, 1, 0))))


#: 400 years are 146,097 days, that is 773 * 189.
_FIRST_DAY, _DAY_PARTS = "1800-01-01", (773, 189)
_DATE_FORMS = {r"^[0-9]{4}-": "yyyy-MM-dd", r"^[0-9]{2}\.": "dd.MM.yyyy", r"^[0-9]{2}/": "MM/dd/yyyy"}


def _date(m: Column, key: str) -> Column | None:
    """Null if it is no day of the 400 years."""
    out = F.lit(None).cast("string")
    for form, pattern in _DATE_FORMS.items():
        day = F.date_diff(F.try_to_timestamp(m, F.lit(pattern)).cast("date"), F.lit(_FIRST_DAY).cast("date"))
        a, b = (F.lit(x).cast("long") for x in _DAY_PARTS)
        moved = F.date_add(F.lit(_FIRST_DAY).cast("date"), permute(day, a, b, F.lit("date"), key).cast("int"))
        out = F.when(m.rlike(form), F.when(day.between(0, 146_096), F.date_format(moved, pattern))).otherwise(out)
    return out


def _card(m: Column, key: str) -> Column:
    """Null if the check digit is wrong."""
    digits = _only(m, "0-9")
    body = _digits(F.substring(digits, F.lit(1), F.length(digits) - 1), F.length(digits) - 1, "card", key)
    new = _with(body, lambda d: F.concat(d, ((10 - luhn_sum(F.concat(d, F.lit("0"))) % 10) % 10).cast("string")))
    return F.when(luhn_sum(digits) % 10 == 0, _with(new, lambda d: _refill(m, d)))


def _phone(m: Column, key: str) -> Column:
    """Null if there are too few or too many digits."""
    fixed = F.when(m.startswith("+1"), F.lit("+1")).otherwise(F.lit(""))
    rest = F.substring(m, F.length(fixed) + 1, F.length(m))
    digits = _only(rest, "0-9")
    new = _with(_digits(digits, F.length(digits), "phone", key), lambda d: F.concat(fixed, _refill(rest, d)))
    return F.when(F.length(_only(m, "0-9")).between(10, 15), new)


def _ssn(m: Column, key: str) -> Column:
    return _with(_digits(_only(m, "0-9"), F.lit(9), "ssn", key), lambda d: _refill(m, d))


_PSEUDONYMS = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone}


def pseudonym(m: Column, key: str) -> Column:
    """(kind, value) of a match of ``ANY``; kind null, and the value as it is, if it fails its check."""
    def checked(kind: str) -> Column:
        return _with(_PSEUDONYMS[kind](m, key), lambda new: F.struct(
            F.when(new.isNotNull(), F.lit(kind)).alias("kind"), F.coalesce(new, m).alias("value")))

    out = F.struct(F.lit(None).cast("string").alias("kind"), m.alias("value"))
    for kind in reversed(PATTERNS):
        out = F.when(m.rlike(f"^(?:{PATTERNS[kind]})$"), checked(kind)).otherwise(out)
    return out


def _known(cards: Column) -> Column:
    """The first that is there and has the right check digit."""
    return F.get(F.filter(cards, lambda c: (F.length(c) > 0) & (luhn_sum(_only(c, "0-9")) % 10 == 0)), F.lit(0))


def _cards_among(run: Column, key: str) -> Column:
    """(number of cards, text) of a run that is no card as a whole: a card may begin at each group
    of digits. Of cards that overlap, the one behind gives way."""
    # the digits, what stands between them, and what follows each begin, as far as a card may go
    parts = F.struct(
        F.regexp_extract_all(run, F.lit("[0-9]+"), F.lit(0)).alias("digits"), F.split(run, "[0-9]+").alias("gaps"),
        F.regexp_extract_all(run, F.lit(rf"(?<![0-9])(?=([0-9][0-9A-Za-z -]{{0,{_SPAN - 1}}}))[0-9]+"), F.lit(1)).alias("ahead"))

    def spans(cards: Column, i: Column) -> Column:
        """Whether a card that begins up to ``_GROUPS`` groups ahead of group i holds it."""
        held = F.lit(False)
        for d in range(1, _GROUPS):
            held = held | F.coalesce(F.regexp_count(F.get(cards, i - d), F.lit("[0-9]+")) > d, F.lit(False))
        return held

    def written(p: Column, cards: Column) -> Column:
        out = F.transform(p["digits"], lambda g, i: F.when(
            F.get(cards, i).isNotNull(), F.concat(F.get(p["gaps"], i), _card(F.get(cards, i), key)))
            .when(spans(cards, i), F.lit("")).otherwise(F.concat(F.get(p["gaps"], i), g)))
        return F.struct(F.array_size(F.filter(cards, lambda c: c.isNotNull())).alias("n"),
                        F.concat(F.array_join(out, ""), F.element_at(p["gaps"], -1)).alias("text"))

    return _with(parts, lambda p: _with(
        F.transform(p["ahead"], lambda w: _known(F.array(*(F.regexp_extract(w, f"^{g}(?![0-9A-Za-z])", 0) for g in GROUPED)))),
        lambda found: _with(F.transform(found, lambda c, i: F.when(~spans(found, i), c)), lambda cards: written(p, cards))))


def _cards(text: Column, key: str) -> Column:
    """(number of cards, text) of a text."""
    def of_run(run: Column) -> Column:
        one = F.regexp_extract(run, f"^({WHOLE})(?![0-9A-Za-z])[ -]*[A-Za-z]?$", 1)
        return _with(_known(F.array(one)), lambda card: F.when(card.isNotNull(), F.struct(
            F.lit(1).alias("n"), F.concat(_card(card, key), F.substring(run, F.length(card) + 1, F.length(run))).alias("text")
        )).otherwise(_cards_among(run, key)))

    runs = F.transform(F.regexp_extract_all(text, F.lit(RUN), F.lit(0)), of_run)
    joined = _with(runs, lambda done: F.struct(
        F.aggregate(done, F.lit(0), lambda n, r: n + r["n"]).alias("n"),
        F.array_join(F.zip_with(F.split(text, RUN), F.array_append(F.transform(done, lambda r: r["text"]), F.lit("")),
                                lambda gap, run: F.concat(gap, run)), "").alias("text")))
    return F.when(text.rlike(RUN), joined).otherwise(F.struct(F.lit(0).alias("n"), text.alias("text")))


def _count(kinds: Column, kind: str) -> Column:
    return F.array_size(F.filter(kinds, lambda x: x == kind)).cast("long")


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text with pseudonyms, and for each kind the number of values
    replaced (n_email, n_ip, ...)."""
    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    text = F.col("text")
    # what has a form of its own first; cards in the pieces between, one more than there are matches
    found = src.withColumn("_new", F.when(text.rlike(ANY), F.transform(
        F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda m: pseudonym(m, key))).otherwise(
        F.array().cast("array<struct<kind:string,value:string>>"))).withColumn(
        "_gaps", F.when(text.rlike("[0-9][0-9 -]{12}"), F.transform(F.split(text, ANY), lambda g: _cards(g, key))))
    gaps = F.coalesce(F.transform("_gaps", lambda g: g["text"]), F.split(text, ANY))
    whole = F.array_join(F.zip_with(gaps, F.array_append(F.transform("_new", lambda x: x["value"]), F.lit("")),
                                    lambda gap, value: F.concat(gap, value)), "")
    kinds = F.transform("_new", lambda x: x["kind"])
    cards = F.coalesce(F.aggregate("_gaps", F.lit(0), lambda n, g: n + g["n"]), F.lit(0)).cast("long")
    plain = text.isNull() | (F.array_size("_new") == 0) & F.col("_gaps").isNull()
    return found.select(
        F.col("_id").alias(id_col), F.when(plain, text).otherwise(whole).alias("text"),
        *((cards if k == "card" else _count(kinds, k)).alias(f"n_{k}") for k in KINDS))
