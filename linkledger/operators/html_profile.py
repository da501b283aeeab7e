"""Page profile of raw HTML, one ``mapInArrow`` job over the pages table.

The per-row helper is a small tag-stack walk on the standard-library parser:
an end tag pops to its matching open tag (ignored if none is open), void tags
are never pushed, nothing is closed implicitly. Text of script, style,
template and ruby-annotation containers, comments and declarations is left
out; character references are decoded. Everything after the parse (filters,
link resolution, scores) is Spark SQL over the returned struct.

A page that the parser refuses gives an empty profile with parse_error set, so it
costs its own row only.

Output columns: has_body, text (stripped strings joined by one space), raw_text
(all strings as they stand, joined without separator), text_concat_len (length of
the stripped strings joined without separator), parse_error, title, headers array<struct<tag, text>>, links array<struct<href, section>>
(section: innermost link-bearing section around the anchor, NULL outside one).
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Elements that never hold content, string containers whose text
# is not page text, header tags, and tags whose anchors count as page links.
VOID_TAGS = frozenset([
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem",
    "meta", "param", "source", "track", "wbr", "basefont", "bgsound", "command", "frame",
    "image", "isindex", "nextid", "spacer",
])
HIDDEN_TEXT_TAGS = frozenset(["script", "style", "template", "rt", "rp"])
HEADER_TAGS = ("h1", "h2", "h3")
ALWAYS_SECTION_TAGS = frozenset(["div", "h1", "h2", "h3"])
FIRST_ONLY_SECTION_TAGS = frozenset(["main", "nav"])

PROFILE_SCHEMA = (
    "has_body boolean, text string, raw_text string, text_concat_len int, parse_error boolean, title string, "
    "headers array<struct<tag:string,text:string>>, links array<struct<href:string,section:string>>"
)
PROFILE_TYPES = {
    "has_body": pa.bool_(), "text": pa.string(), "raw_text": pa.string(), "text_concat_len": pa.int32(),
    "parse_error": pa.bool_(), "title": pa.string(),
    "headers": pa.list_(pa.struct([("tag", pa.string()), ("text", pa.string())])),
    "links": pa.list_(pa.struct([("href", pa.string()), ("section", pa.string())])),
}
#: Bytes of html that are parsed before their profiles leave the worker; a longer page goes alone.
PARSED_AT_ONCE = 1 << 20


class _Profiler(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[list] = []          # [tag, section_label or None, header_buf or None]
        self.hidden = 0
        self.buf: list[str] = []
        self.pieces: list[str] = []
        self.raw: list[str] = []
        self.concat_len = 0
        self.has_body = False
        self.seen_first: set[str] = set()
        self.headers: list[dict] = []
        self.links: list[dict] = []
        self.title: str | None = None
        self._title_buf: list[str] | None = None

    # text nodes are cut at every markup event
    def _flush(self):
        if not self.buf:
            return
        s = "".join(self.buf)
        self.buf = []
        if self.hidden:
            return
        self.raw.append(s)
        st = s.strip()
        if not st:
            return
        self.pieces.append(st)
        self.concat_len += len(st)
        for e in self.stack:
            if e[2] is not None:
                e[2].append(st)
        if self._title_buf is not None:
            self._title_buf.append(st)

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag == "body":
            self.has_body = True
        if tag == "a":
            href = None
            for k, v in attrs:
                if k == "href":
                    href = "" if v is None else v
            if href is not None:
                section = None
                for e in reversed(self.stack):
                    if e[1] is not None:
                        section = e[1]
                        break
                self.links.append({"href": href, "section": section})
        if tag in VOID_TAGS:
            return
        label = None
        if tag in ALWAYS_SECTION_TAGS:
            label = tag
        elif tag in FIRST_ONLY_SECTION_TAGS and tag not in self.seen_first:
            self.seen_first.add(tag)
            label = tag
        header = [] if tag in HEADER_TAGS else None
        self.stack.append([tag, label, header])
        if tag in HIDDEN_TEXT_TAGS:
            self.hidden += 1
        if tag == "title" and self.title is None and self._title_buf is None:
            self._title_buf = []

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                for e in self.stack[i:]:
                    self._close(e)
                del self.stack[i:]
                return

    def _close(self, e):
        if e[0] in HIDDEN_TEXT_TAGS:
            self.hidden -= 1
        if e[2] is not None:
            self.headers.append({"tag": e[0], "text": "".join(e[2])})
        if e[0] == "title" and self._title_buf is not None and self.title is None:
            self.title = "".join(self._title_buf)
            self._title_buf = None

    def handle_data(self, data):
        self.buf.append(data)

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def unknown_decl(self, data):
        self._flush()
        if data.upper().startswith("CDATA["):
            self.buf.append(data[len("CDATA["):])
            self._flush()

    def finish(self) -> dict:
        self.close()
        self._flush()
        for e in reversed(self.stack):     # unclosed headers still count
            self._close(e)
        self.stack = []
        # headers are listed in closing order; only membership is used downstream
        return {
            "has_body": self.has_body,
            "text": " ".join(self.pieces),
            "raw_text": "".join(self.raw),
            "text_concat_len": self.concat_len,
            "parse_error": False,
            "title": self.title,
            "headers": self.headers,
            "links": self.links,
        }


def _empty(parse_error: bool) -> dict:
    return {"has_body": False, "text": "", "raw_text": "", "text_concat_len": 0, "parse_error": parse_error, "title": None,
            "headers": [], "links": []}


def profile_html(html: str | None) -> dict:
    if html is None:
        return _empty(False)
    p = _Profiler()
    try:
        p.feed(html)
        return p.finish()
    except (AssertionError, ValueError, IndexError):      # what the parser raises on markup that it cannot follow
        return _empty(True)


def parts(batch: pa.RecordBatch, html_col: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in order, in slices of at most ``most`` bytes of html or of one row."""
    begin = held = 0
    for k, n in enumerate(pc.binary_length(batch.column(html_col)).to_pylist()):
        if k > begin and held + (n or 0) > most:
            yield batch.slice(begin, k - begin)
            begin, held = k, 0
        held += n or 0
    if begin < batch.num_rows:
        yield batch.slice(begin)


def profile_pages(pages: DataFrame, key_cols: list[str], html_col: str = "html") -> DataFrame:
    """Run the profile over a pages DataFrame; returns key_cols + profile columns.
    The html column is consumed where it is read and is not carried further. A worker
    holds an Arrow batch of html and the profiles of one part of it."""
    keys = list(key_cols)
    src = pages.select(*keys, html_col)
    most = PARSED_AT_ONCE
    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields if f.name in keys)

    def run(batches):
        for batch in batches:
            for part in parts(batch, html_col, most):
                prof = [profile_html(h) for h in part.column(html_col).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in keys] + [pa.array([p[c] for p in prof], t) for c, t in PROFILE_TYPES.items()],
                    names=[*keys, *PROFILE_TYPES])

    return src.mapInArrow(run, f"{key_schema}, {PROFILE_SCHEMA}")
