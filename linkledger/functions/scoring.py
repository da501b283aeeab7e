"""Score formulas as Column expressions.

Two scales coexist, as in the crawl being modelled: relevance of seeds is in
[0, 1], relevance of derived links is a 0..100 priority. Both go through the
same formulas; callers name which one they pass.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights and constants of the scoring rules.
PRIORITY_W_RELEVANCE = 0.65
PRIORITY_W_TRUST = 0.35
QUALITY_STEP = 0.1            # per discovered URL (validate)
QUALITY_STEP_LOAD = 0.2       # the alternative step of the load stage
QUALITY_LO, QUALITY_HI = -1.0, 1.0
DECAY = 0.75                  # priority factor on 500/502/503/504
RETRY_STATUSES = [500, 502, 503, 504]
SEED_RELEVANCE_INITIAL = 1.0
SEED_RELEVANCE_REPEAT = 0.99
DERIVED_W_PARENT, DERIVED_W_URL, DERIVED_W_COUNT = 0.5, 0.3, 0.2
DERIVED_COUNT_NORM = 5.0
RELEVANCE_W_HEADER, RELEVANCE_W_LENGTH, RELEVANCE_W_KEYWORD, RELEVANCE_W_PARENT = 0.2, 0.2, 0.3, 0.3
RELEVANCE_TEXT_CHARS = 3000.0
RELEVANCE_KEYWORD_NORM = 5.0
RELEVANCE_KEYWORDS = ["review", "menu", "dish", "chef", "restaurant", "michelin", "wine list"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def frontier_priority(relevance, trust) -> Column:
    """.65 * relevance + .35 * trust, unclamped."""
    return _col(relevance) * F.lit(PRIORITY_W_RELEVANCE) + _col(trust) * F.lit(PRIORITY_W_TRUST)


def priority_int(priority) -> Column:
    """Value as stored in an integer priority column (half away from zero)."""
    return F.round(_col(priority), 0).cast("int")


def seed_relevance(initial_search) -> Column:
    """B12."""
    return F.when(_col(initial_search), F.lit(SEED_RELEVANCE_INITIAL)).otherwise(F.lit(SEED_RELEVANCE_REPEAT))


def quality_step(old, relevance, step: float = QUALITY_STEP) -> Column:
    """clamp(old + step*(relevance - .5), -1, 1)."""
    delta = F.lit(step) * (_col(relevance) - F.lit(0.5))
    return F.greatest(F.lit(QUALITY_LO), F.least(_col(old) + delta, F.lit(QUALITY_HI)))


def decayed_priority(priority) -> Column:
    """max(0, .75 * priority)."""
    return F.greatest(F.lit(0.0), _col(priority) * F.lit(DECAY))


def rejected_priority(relevance) -> Column:
    """Relevance * 100."""
    return _col(relevance) * F.lit(100)


def _weighted(terms: list[tuple[float, Column]], top: float) -> Column:
    """The sum of weight * term, each term a share, on a scale of 0 to ``top``; clamped to it."""
    total = reduce(add, (F.lit(weight) * term for weight, term in terms))
    return F.least(F.lit(top), F.greatest(F.lit(0.0), total * F.lit(top)))


def _share(names: Column, holds) -> Column:
    """The share of the names that ``holds`` is true of; 0 without names."""
    return F.coalesce(F.size(F.filter(names, holds)) / F.nullif(F.array_size(names), F.lit(0)), F.lit(0.0))


def _filled(amount: Column, enough: float) -> Column:
    """How much of ``enough`` is there, 1 at most."""
    return F.least(amount / F.lit(enough), F.lit(1.0))


def derived_priority(url, names, parent_priority) -> Column:
    """B9, 0 to 100: the parent's priority, the share of ``names`` (the distinct validated
    entity names of the page) inside the url, and how many there are, five counting as full."""
    names, low = _col(names), F.lower(_col(url))
    return _weighted([
        (DERIVED_W_PARENT, _col(parent_priority) / F.lit(100.0)),
        (DERIVED_W_URL, _share(names, lambda n: low.contains(F.lower(n)))),
        (DERIVED_W_COUNT, _filled(F.coalesce(F.array_size(names), F.lit(0)), DERIVED_COUNT_NORM))], 100.0)


def page_relevance(text_lower, header_texts_lower, names, parent_priority, keywords: list[str] | None = None) -> Column:
    """B10, 0 to 1: the share of ``names`` inside any one header, the length of the text, the
    number of keywords in it, and the parent's priority. Texts come lower-cased."""
    text, headers = _col(text_lower), _col(header_texts_lower)
    words = F.array(*map(F.lit, RELEVANCE_KEYWORDS if keywords is None else keywords))
    return _weighted([
        (RELEVANCE_W_HEADER, _share(_col(names), lambda n: F.exists(headers, lambda h: h.contains(F.lower(n))))),
        (RELEVANCE_W_LENGTH, _filled(F.length(text), RELEVANCE_TEXT_CHARS)),
        (RELEVANCE_W_KEYWORD, _filled(F.size(F.filter(words, text.contains)), RELEVANCE_KEYWORD_NORM)),
        (RELEVANCE_W_PARENT, _col(parent_priority) / F.lit(100.0))], 1.0)
