"""URL rules as Column expressions (JVM-side, inside whole-stage codegen).

The split follows the generic URI syntax: optional ``scheme:``, optional
``//authority``, then the path up to the first ``?`` or ``#``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# URI split pattern and the schemes whose last path segment may
# carry ";params" (these are cut from the path when normalizing).
URL_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"
PARAM_SCHEMES = [
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp",
    "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel",
]

# URL trust rule.
TRUSTED_TLD = r"\.(org|gov|edu)(/|$)"
HIGH_TRUST_WORDS = ["news", "magazine", "guide", "review"]
MID_TRUST_WORDS = ["weekly", "reader", "journal", "digest", "critic", "insider"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _clean(url) -> Column:
    # leading C0 controls / spaces go, tabs and line breaks anywhere go
    u = F.regexp_replace(_col(url), r"^[\x00-\x20]+", "")
    return F.regexp_replace(u, r"[\t\r\n]", "")


def scheme(url) -> Column:
    return F.lower(F.regexp_extract(_clean(url), URL_SPLIT, 1))


def netloc(url) -> Column:
    return F.regexp_extract(_clean(url), URL_SPLIT, 2)


def path(url) -> Column:
    p = F.regexp_extract(_clean(url), URL_SPLIT, 3)
    return F.when(scheme(url).isin(PARAM_SCHEMES), F.regexp_replace(p, r";[^/]*$", "")).otherwise(p)


def normalize_url(url) -> Column:
    """B1: scheme://netloc + path; query, fragment and last-segment ;params dropped."""
    return F.concat(scheme(url), F.lit("://"), netloc(url), path(url))


def url_domain(norm_url) -> Column:
    """B2: text after the first '//' up to the next '/' of a normalized URL."""
    u = _col(norm_url)
    pos = F.instr(u, "//")
    tail = F.when(pos > 0, u.substr(pos + 2, F.length(u) + 1)).otherwise(u)
    return F.substring_index(tail, "/", 1)


def url_host(url) -> Column:
    """Host of a URL (``http://`` assumed when there is no ``://``), port cut at ':'."""
    u = _col(url)
    full = F.when(F.instr(u, "://") > 0, u).otherwise(F.concat(F.lit("http://"), u))
    return F.substring_index(netloc(full), ":", 1)


def homepage(url) -> Column:
    """Scheme://netloc/ (scheme kept, lower-cased)."""
    return F.concat(scheme(url), F.lit("://"), netloc(url), F.lit("/"))


def _any_of(words: list[str]) -> str:
    return "|".join(map(re.escape, words))


#: Points by what a URL holds: of the rules of one line, the first that fits counts.
TRUST_BASE = 0.5
TRUST_RULES = [[(TRUSTED_TLD, 0.5)],
               [("(?i)" + _any_of(HIGH_TRUST_WORDS), 0.5), ("(?i)" + _any_of(MID_TRUST_WORDS), 0.3)]]


def url_trust(url) -> Column:
    """The base and the points of ``TRUST_RULES``, clamped to [0, 1]."""
    u = _col(url)

    def points(rules: list[tuple[str, float]]) -> Column:
        fits = [F.when(u.rlike(pattern), F.lit(value)) for pattern, value in rules]
        return F.coalesce(*fits, F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), sum(map(points, TRUST_RULES), F.lit(TRUST_BASE))))
