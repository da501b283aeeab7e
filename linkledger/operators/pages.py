"""Page stage after the profile: C1 meaningful filter, C3/G1 section links with
B5 resolution, G2/G3 derived links with B9 priorities, B10 page relevance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scoring, urls

# The parts of a reference after cleaning (scheme, authority, path,
# query, fragment), the bracketed hosts that are valid, and the code points whose
# compatibility form holds a URL delimiter.
REFERENCE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(?:\?([^#]*))?(?:#([\s\S]*))?$"
BRACKETED_HOST = r"^[^\[\]]*\[(?:[0-9A-Fa-f:]+(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3})?(?:%[^\[\]]+)?|[vV][0-9A-Fa-f]+\.[^\[\]]+)\](?::[^\[\]]*)?$"
HIDDEN_DELIMITERS = "[⁇⁈⁉℀℁℅℆⩴︓︖﹕﹖﹟﹫＃／：？＠]"


def _clean(url: Column) -> Column:
    # leading C0 controls / spaces go, tabs and line breaks anywhere go
    return F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def _without_dots(segments: Column) -> Column:
    """Path segments with ``.`` and ``..`` taken out; a trailing one leaves a directory."""
    kept = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.lit(0), F.array_size(done) - 1)))
        .when(s == ".", done).otherwise(F.array_append(done, s)))
    return F.when(F.element_at(segments, -1).isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)


def resolve_link(base, href) -> Column:
    """``href`` against the http(s) page URL ``base``, in built-in functions.

    Absolute, ``//host``, ``/rooted``, relative, ``?query`` and ``#fragment`` forms;
    dot segments are removed from a joined path, and empty segments where it is relative. A
    reference with another scheme is returned as it is. A malformed authority, a
    null part, or a relative reference on a base that is not http(s) gives null."""
    b = F.col(base) if isinstance(base, str) else base
    raw = F.col(href) if isinstance(href, str) else href
    h, bc = _clean(raw), _clean(b)

    def part(u: Column, k: int) -> Column:
        return F.coalesce(F.regexp_extract(u, REFERENCE, k), F.lit(""))

    bscheme, bhost = F.lower(part(bc, 1)), F.substring(part(bc, 2), 3, 1 << 30)
    # a scheme is cut off only where it is the page's own: "http:x" is relative on an http page
    scheme = F.lower(part(h, 1))
    authority, path, query, fragment = part(h, 2), part(h, 3), part(h, 4), part(h, 5)
    host = F.substring(authority, 3, 1 << 30)
    plain = F.regexp_replace(path, r";[^/]*$", "")
    params = F.substring(path, F.length(plain) + 2, 1 << 30)
    bpath = part(bc, 3)

    def put(at: Column, where: Column, semi: Column, ask: Column) -> Column:
        rooted = F.when((where != "") & ~where.startswith("/"), F.concat(F.lit("/"), where)).otherwise(where)
        return F.concat(bscheme, F.lit("://"), at, rooted,
                        F.when(semi != "", F.concat(F.lit(";"), semi)).otherwise(F.lit("")),
                        F.when(ask != "", F.concat(F.lit("?"), ask)).otherwise(F.lit("")),
                        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")))

    bplain = F.regexp_replace(bpath, r";[^/]*$", "")
    bparams = F.substring(bpath, F.length(bplain) + 2, 1 << 30)
    stem = F.split(bplain, "/")
    stem = F.when(F.element_at(stem, -1) != "", F.slice(stem, F.lit(1), F.array_size(stem) - 1)).otherwise(stem)
    whole = F.concat(stem, F.split(plain, "/"))
    inner = F.filter(F.slice(whole, F.lit(2), F.greatest(F.lit(0), F.array_size(whole) - 2)), lambda s: s != "")
    relative = F.when(F.array_size(whole) < 2, whole).otherwise(
        F.concat(F.slice(whole, 1, 1), inner, F.slice(whole, -1, 1)))
    segments = F.when(plain.startswith("/"), F.split(plain, "/")).otherwise(relative)
    joined = F.array_join(_without_dots(segments), "/")
    joined = F.when(joined == "", F.lit("/")).otherwise(joined)

    bracket = host.contains("[") | host.contains("]")
    bad_host = (bracket & ~host.rlike(BRACKETED_HOST)) | host.rlike(HIDDEN_DELIMITERS)
    other = (scheme != "") & (scheme != bscheme)
    return (F.when(b.isNull() | raw.isNull(), F.lit(None).cast("string"))
            .when(raw == "", b)
            .when((authority != "") & bad_host, F.lit(None).cast("string"))
            .when(other, raw)
            .when(~bscheme.isin("http", "https"), F.lit(None).cast("string"))
            .when(host != "", put(host, plain, params, query))
            .when((plain == "") & (params == ""), put(bhost, bplain, bparams, F.when(query != "", query).otherwise(part(bc, 4))))
            .otherwise(put(bhost, joined, params, query)))


def meaningful(profiles: DataFrame) -> DataFrame:
    """Keep pages with a <body> and at least 10 characters of stripped text. A page
    that could not be parsed has neither."""
    return profiles.where(F.col("has_body") & (F.col("text_concat_len") >= 10))


def page_links(profiles: DataFrame, key: str, base_col: str) -> DataFrame:
    """C3 + B5 + G1: distinct absolute http(s) links found inside link sections."""
    return (
        profiles.select(key, base_col, F.explode("links").alias("l"))
        .where(F.col("l.section").isNotNull())
        .select(key, base_col, resolve_link(base_col, F.col("l.href")).alias("link"))
        .where(F.col("link").startswith("http"))
        .select(key, "link").distinct()
    )


def derived_links(links: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """G2/G3 + B9: per page the homepage with min(100, parent) plus every other
    link with its estimated priority.

    ``links``: (key, link); ``pages``: (key, full_url, parent_priority, names)."""
    pg = pages.select(key, "full_url", "parent_priority", "names").withColumn("homepage", urls.homepage("full_url"))
    home = pg.select(key, F.col("homepage").alias("url"),
                     F.least(F.lit(100), F.col("parent_priority")).cast("double").alias("priority"),
                     F.lit(True).alias("is_homepage"))
    other = (links.join(pg, key)
             .where(F.col("link") != F.col("homepage"))
             .select(key, F.col("link").alias("url"),
                     scoring.derived_priority("link", "names", "parent_priority").alias("priority"),
                     F.lit(False).alias("is_homepage")))
    return home.unionByName(other)


def with_relevance(profiles: DataFrame, pages: DataFrame, key: str,
                   keywords: list[str] | None = None) -> DataFrame:
    """B10 per page. ``pages``: (key, parent_priority, names)."""
    j = profiles.select(key, "text", "headers").join(pages.select(key, "parent_priority", "names"), key)
    return j.select(
        key,
        scoring.page_relevance(
            F.lower("text"), F.transform("headers", lambda h: F.lower(h["text"])), "names", "parent_priority",
            keywords,
        ).alias("relevance"),
    )
