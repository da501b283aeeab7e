"""DuckDB SQL text mirroring the Column rules, for the oracle side of the
registered queries. Each helper returns a CTE body or an expression string.
Double literals carry an exponent so DuckDB types them DOUBLE, not DECIMAL.
"""

from __future__ import annotations

from ..functions.scoring import (DERIVED_W_COUNT, DERIVED_W_PARENT, DERIVED_W_URL, PRIORITY_W_RELEVANCE,
                                 PRIORITY_W_TRUST, RELEVANCE_KEYWORDS)
from ..functions.urls import HIGH_TRUST_WORDS, MID_TRUST_WORDS, PARAM_SCHEMES, TRUSTED_TLD, URL_SPLIT
from .inputs import SECOND_SIGHTING_OFFSET


def d(x: float) -> str:
    return f"{float(x)!r}e0" if "e" not in repr(float(x)) else repr(float(x))


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def url_parts(src: str, url: str, extra: str = "*") -> str:
    """SELECT adding _s (scheme), _n (netloc), _p (path, params cut) of ``url``."""
    clean = f"regexp_replace(regexp_replace({url}, '^[\\x00-\\x20]+', ''), '[\\t\\r\\n]', '', 'g')"
    schemes = ", ".join(q(s) for s in PARAM_SCHEMES)
    return f"""SELECT {extra},
  lower(regexp_extract({clean}, {q(URL_SPLIT)}, 1)) AS _s,
  regexp_extract({clean}, {q(URL_SPLIT)}, 2) AS _n,
  CASE WHEN lower(regexp_extract({clean}, {q(URL_SPLIT)}, 1)) IN ({schemes})
       THEN regexp_replace(regexp_extract({clean}, {q(URL_SPLIT)}, 3), ';[^/]*$', '')
       ELSE regexp_extract({clean}, {q(URL_SPLIT)}, 3) END AS _p
FROM {src}"""


def norm_expr() -> str:
    return "(_s || '://' || _n || _p)"


def domain_expr(u: str) -> str:
    return f"split_part(CASE WHEN strpos({u}, '//') > 0 THEN substr({u}, strpos({u}, '//') + 2) ELSE {u} END, '/', 1)"


def trust_expr(u: str) -> str:
    hi = " OR ".join(f"contains(lower({u}), {q(w)})" for w in HIGH_TRUST_WORDS)
    mid = " OR ".join(f"contains(lower({u}), {q(w)})" for w in MID_TRUST_WORDS)
    return (f"greatest({d(0)}, least({d(0.5)} + CASE WHEN regexp_matches({u}, {q(TRUSTED_TLD)}) THEN {d(0.5)} ELSE {d(0)} END"
            f" + CASE WHEN {hi} THEN {d(0.5)} WHEN {mid} THEN {d(0.3)} ELSE {d(0)} END, {d(1)}))")


def priority_expr(rel: str, trust: str) -> str:
    return f"({rel} * {d(PRIORITY_W_RELEVANCE)} + {trust} * {d(PRIORITY_W_TRUST)})"


def pint(x: str) -> str:
    return f"CAST(round({x}) AS INTEGER)"


def discovered_cte() -> str:
    return f"""SELECT page_id AS seq, url, CAST((page_id * 7) % 11 AS DOUBLE) / {d(10)} AS relevance FROM pages
UNION ALL
SELECT page_id + {SECOND_SIGHTING_OFFSET} AS seq, url, CAST((page_id * 3) % 11 AS DOUBLE) / {d(2.5)} AS relevance FROM pages"""


def events_ctes(disc: str | None = None) -> str:
    """CTEs disc -> ev0 -> ev (seq, url, relevance, norm_url, domain)."""
    return f"""disc AS ({disc or discovered_cte()}),
ev0 AS ({url_parts('disc', 'url')}),
ev AS (SELECT seq, url, relevance, {norm_expr()} AS norm_url, {domain_expr(norm_expr())} AS domain FROM ev0)"""


def quality_fold_expr(list_expr: str, step: float) -> str:
    """Ordered clamped fold of a relevance list whose first element sets 0.0."""
    return (f"list_reduce(list_prepend({d(0)}, ({list_expr})[2:]), lambda a, x: "
            f"greatest({d(-1)}, least(a + {d(step)} * (x - {d(0.5)}), {d(1)})))")


def status_expr(pid: str) -> str:
    return (f"CASE {pid} % 10 WHEN 0 THEN 404 WHEN 1 THEN 503 WHEN 2 THEN NULL WHEN 3 THEN 403 "
            f"WHEN 4 THEN 501 ELSE 200 END")


def fetched_ctes() -> str:
    """CTEs pg0 -> fetched (full_url, page_id, url, html, status, parent_priority)."""
    return f"""pg0 AS ({url_parts('pages', 'url')}),
pg1 AS (SELECT page_id, url, html, {norm_expr()} AS full_url FROM pg0),
fetched AS (SELECT full_url, min(page_id) AS page_id, arg_min(url, page_id) AS url, arg_min(html, page_id) AS html,
                   {status_expr('min(page_id)')} AS status, CAST(min(page_id) % 101 AS INTEGER) AS parent_priority
            FROM pg1 GROUP BY full_url)"""


def action_expr(s: str) -> str:
    return (f"CASE WHEN {s} IS NULL THEN 'remove' WHEN {s} >= 400 AND {s} < 500 THEN 'remove' "
            f"WHEN {s} IN (500, 502, 503, 504) THEN 'demote' ELSE 'parse' END")


def derived_priority_expr(url: str, names: str, parent: str) -> str:
    n = f"coalesce(len({names}), 0)"
    hits = f"len(list_filter({names}, lambda r: contains(lower({url}), lower(r))))"
    share = f"(CASE WHEN {n} > 0 THEN {hits} / {n} ELSE {d(0)} END)"
    comb = (f"({d(DERIVED_W_PARENT)} * ({parent} / {d(100)}) + {d(DERIVED_W_URL)} * {share}"
            f" + {d(DERIVED_W_COUNT)} * least({n} / {d(5)}, {d(1)}))")
    return f"least({d(100)}, greatest({d(0)}, {comb} * {d(100)}))"


KEYWORDS_SQL = ", ".join(q(k) for k in RELEVANCE_KEYWORDS)


# ------------------------------------------------------------------ page text (regex form of the profile)

def unescape(x: str) -> str:
    out = x
    for ent, ch in (("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&lt;", "<"), ("&gt;", ">"),
                    ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " ")):
        out = f"replace({out}, '{ent}', '{ch}')"
    return f"replace({out}, '&amp;', '&')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\pZ]+|[\\s\\pZ]+$', '', 'g')"


def pieces(x: str) -> str:
    """Stripped, decoded, non-empty text pieces between tags."""
    return (f"list_filter(list_transform(string_split_regex({x}, '<[^>]*>'), lambda t: {strip(unescape('t'))}),"
            f" lambda t: t <> '')")


def page_ctes(src: str = "pages", p: str = "prof") -> str:
    """CTE ``p`` (page_id, url, has_body, text, text_concat_len, title, headers, hrefs)."""
    clean = ("regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script\\s*>', ' ', 'g'),"
             " '(?is)<style\\b[^>]*>.*?</style\\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g')")
    anchors = "'(?i)<a\\s[^>]*href=\"([^\"]*)\"'"
    return f"""{p}0 AS (SELECT page_id, url, html, {clean} AS h0 FROM {src}),
{p}1 AS (SELECT page_id, url, regexp_matches(html, '(?i)<body[\\s>/]') AS has_body, {pieces('h0')} AS pcs,
                 CASE WHEN regexp_matches(h0, '(?is)<title[^>]*>') THEN
                   array_to_string({pieces("regexp_extract(h0, '(?is)<title[^>]*>(.*?)</title', 1)")}, '') END AS title,
                 list_transform(list_concat(regexp_extract_all(h0, '(?is)<h1[^>]*>(.*?)</h1\\s*>', 1),
                                            regexp_extract_all(h0, '(?is)<h2[^>]*>(.*?)</h2\\s*>', 1),
                                            regexp_extract_all(h0, '(?is)<h3[^>]*>(.*?)</h3\\s*>', 1)),
                                lambda h: array_to_string({pieces('h')}, '')) AS headers,
                 list_concat(regexp_extract_all(regexp_extract(h0, '(?is)<nav[^>]*>(.*?)</nav\\s*>', 1), {anchors}, 1),
                             regexp_extract_all(regexp_extract(h0, '(?is)<main[^>]*>(.*?)</main\\s*>', 1), {anchors}, 1),
                             flatten(list_transform(regexp_extract_all(h0, '(?is)<div[^>]*>(.*?)</div\\s*>', 1),
                                                    lambda dv: regexp_extract_all(dv, {anchors}, 1))),
                             flatten(list_transform(regexp_extract_all(h0, '(?is)<h[1-3][^>]*>(.*?)</h[1-3]\\s*>', 1),
                                                    lambda hv: regexp_extract_all(hv, {anchors}, 1)))) AS hrefs
          FROM {p}0),
{p} AS (SELECT page_id, url, has_body, array_to_string(pcs, ' ') AS text, length(array_to_string(pcs, '')) AS text_concat_len,
                title, headers, list_transform(hrefs, lambda x: {unescape('x')}) AS hrefs FROM {p}1)"""


def tokens_joined(x: str) -> str:
    return (f"array_to_string(list_filter(string_split(regexp_replace(lower({x}), '[^\\pL\\pN]+', ' ', 'g'), ' '),"
            f" lambda w: w <> ''), ' ')")


def trigrams(x: str) -> str:
    words = f"list_filter(string_split(regexp_replace(lower({x}), '[^\\pL\\pN]+', ' ', 'g'), ' '), lambda w: w <> '')"
    return (f"list_distinct(flatten(list_transform({words}, lambda w: list_transform(range(1, length(w) + 2),"
            f" lambda i: substr('  ' || w || ' ', i, 3)))))")


def sim(a: str, b: str) -> str:
    i = f"len(list_intersect({a}, {b}))"
    return (f"CASE WHEN len({a}) + len({b}) - {i} > 0 THEN CAST(CAST({i} / (len({a}) + len({b}) - {i}) AS FLOAT) AS DOUBLE)"
            f" ELSE {d(0)} END")


def vocab_ents_ctes(prof: str = "prof") -> str:
    """Extractor vocabulary (all titles) and entity table (of all titles, with derived names)."""
    return f"""vocab AS (SELECT DISTINCT title AS name, {tokens_joined('title')} AS tj FROM {prof}
          WHERE title IS NOT NULL AND {tokens_joined('title')} <> ''),
ents AS (SELECT min(page_id) AS entity_id, CASE min(page_id) % 3 WHEN 0 THEN title WHEN 1 THEN title || ' x' ELSE reverse(title) END AS name
         FROM {prof} WHERE title IS NOT NULL GROUP BY title)"""


def names_ctes(docs: str, t: str = "") -> str:
    """Spotting + resolution over ``docs`` (page_id, text): spotted{t}, resolved{t}, pm{t}."""
    return f"""ptok{t} AS (SELECT page_id, ' ' || {tokens_joined('text')} || ' ' AS pt FROM {docs}),
spotted{t} AS (SELECT DISTINCT p.page_id, v.name AS mention FROM ptok{t} p JOIN vocab v ON contains(p.pt, ' ' || v.tj || ' ')),
ms{t} AS (SELECT DISTINCT mention FROM spotted{t}),
ex{t} AS (SELECT ms.mention, min(e.entity_id) AS entity_id FROM ms{t} ms JOIN ents e ON e.name = ms.mention GROUP BY ms.mention),
fzc{t} AS (SELECT ms.mention, e.entity_id, e.name, {sim(trigrams('ms.mention'), trigrams('e.name'))} AS c
        FROM ms{t} ms, ents e WHERE ms.mention NOT IN (SELECT mention FROM ex{t})),
fz{t} AS (SELECT mention, arg_max(entity_id, (c, -entity_id)) AS entity_id, arg_max(name, (c, -entity_id)) AS name
       FROM fzc{t} WHERE c > {d(0.75)} GROUP BY mention),
resolved{t} AS (SELECT ms.mention, coalesce(ex.entity_id, fz.entity_id) AS entity_id,
                    CASE WHEN ex.entity_id IS NOT NULL THEN ms.mention ELSE fz.name END AS matched_name,
                    coalesce(ex.entity_id, fz.entity_id) IS NOT NULL AS accepted
             FROM ms{t} ms LEFT JOIN ex{t} ex USING (mention) LEFT JOIN fz{t} fz USING (mention)),
pm{t} AS (SELECT s.page_id, coalesce(list_sort(list_distinct(list(r.matched_name) FILTER (WHERE r.accepted))), []::VARCHAR[]) AS names,
              coalesce(list_sort(list(s.mention) FILTER (WHERE NOT r.accepted)), []::VARCHAR[]) AS rejected
       FROM spotted{t} s JOIN resolved{t} r USING (mention) GROUP BY s.page_id)"""


def relevance_expr(lt: str, lh: str, names: str, parent: str) -> str:
    from ..functions.scoring import RELEVANCE_KEYWORDS as _K
    kw = ", ".join(q(k) for k in _K)
    hs = (f"(CASE WHEN len({names}) > 0 THEN len(list_filter({names}, lambda r: len(list_filter({lh}, lambda h: contains(h, lower(r)))) > 0))"
          f" / len({names}) ELSE {d(0)} END)")
    ls = f"least(length({lt}) / {d(3000)}, {d(1)})"
    ks = f"least(len(list_filter([{kw}], lambda k: contains({lt}, k))) / {d(5)}, {d(1)})"
    return (f"least({d(1)}, greatest({d(0)}, {d(0.2)} * {hs} + {d(0.2)} * {ls} + {d(0.3)} * {ks}"
            f" + {d(0.3)} * ({parent} / {d(100)})))")
