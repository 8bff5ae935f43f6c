"""Main text of web pages: structure first, then differences from the nearest page.

A page is read into blocks of text. What stands in elements that name themselves as
menus, headers, footers, sidebars, notices, adverts, forms or comments is left out.
Where a page marks its article, the article's blocks are its text, but for lines that
the pages around it on its host all have too, in the same order: a bar or an advert that
does not name itself. One page beside it would not do as a witness, since articles quote
the same sentence or licence. Where a page marks none, it is paired with the page of the same host whose path is nearest to its own
(of the two beside it in the order of paths, the one with the longer common prefix),
their lines are aligned by longest common subsequence, and lines that both share are
deleted, as template. A pair that shares most of its words is a copy rather than two
pages of one template; nothing is deleted then.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from keyfold.llm import words

#: Share of its words from which a page counts as a copy of the page beside it.
COPY_SHARE = 0.8

#: So many pages on each side are witnesses of what a marked article holds of the template;
#: so many different ones at least must say the same.
AROUND, WITNESSES = 6, 4

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?\]\]>|<(?!(?:svg|math)\b[^>]*/>)(?P<raw>script|style|noscript|template|svg|iframe|textarea|select|object|math|canvas|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|</?[a-z][^>]*(?:>|\Z)|<[!?/][^>]*>", re.S | re.I)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_PART = re.compile(r"[^a-z0-9]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
_SPACES = frozenset("br td th option img".split())
_OUT = frozenset("aside button dialog datalist footer form head label menu nav search".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Parts of class and id names of what is not the article.
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs consent cookie cookies gdpr "
    "footer footnav header masthead menu menus modal nav navbar navigation navi newsletter notice notices notification pager pagination "
    "popup promo promos promotion recommended related rail share sharing sidebar sidebars sidenav signup skip social sponsor sponsored "
    "sponsors subscribe subscription toolbar topbar widget widgets".split())
_TALK = frozenset("comment comments commentlist disqus discussion feedback replies reply respond responses reviews".split())


def _kind(name: str, rest: str, in_article: bool) -> str:
    """'out', 'talk' or '' for an opening tag."""
    talk = out = False
    for m in _ATTRIBUTE.finditer(rest):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" and m.start() == m.end() - 6:
            out = True
        elif key == "role":
            out |= value.strip() in _ROLES
        elif key in ("class", "id"):
            for token in value.split():
                parts = set(_PART.split(token))
                talk |= bool(parts & _TALK)
                # a heading block inside the article is the article's own
                out |= bool(parts & _NAMES) and not (in_article and "header" in parts)
    if talk:
        return "talk"
    if name in ("body", "html", "main"):
        return ""
    return "out" if out or name in _OUT or name == "header" and not in_article else ""


def blocks(page: str | None) -> tuple[list[str], bool]:
    """Text blocks of a page in order, and whether they are from a marked article."""
    page = page or ""
    inside: list[tuple[int, str]] = []      # (0: of the page, 1: of an article; text)
    text: list[str] = []
    stack: list[tuple[str, str, bool]] = []  # name, kind, opens an article
    count: Counter = Counter()
    out = talk = article = at = 0

    def end() -> None:
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            if line:
                inside.append((int(article > 0), line))
            text.clear()

    def pop() -> None:
        nonlocal out, talk, article
        name, kind, opened = stack.pop()
        count[name] -= 1
        out -= kind == "out"
        talk -= kind == "talk"
        article -= opened

    for m in _MARKUP.finditer(page):
        if not out and not talk and m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in _SPACES:
            text.append(" ")
        if m["close"]:
            if name in _BLOCKS:
                end()
            if count[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in _BLOCKS:
            end()
            # an unclosed head, paragraph or item ends here
            if name == "body" and count["head"] or name == "li" and stack and stack[-1][0] == "li" or stack and stack[-1][0] == "p":
                while stack[-1][0] not in ("head", "p", "li"):
                    pop()
                pop()
        if name in _VOID or m["rest"].endswith("/"):
            continue
        kind = _kind(name, m["rest"], article > 0)
        if name in ("article", "main") and not kind and out and not talk:
            # wrappers named after what stands beside the article
            stack = [(n, "" if k == "out" and n == "div" else k, o) for n, k, o in stack]
            out = sum(k == "out" for _, k, _ in stack)
        opened = name in ("article", "main") and not kind and not out and not talk
        stack.append((name, kind, opened))
        count[name] += 1
        out += kind == "out"
        talk += kind == "talk"
        article += opened
    if not out and not talk:
        text.append(page[at:])
    end()
    marked = [line for own, line in inside if own]
    return (marked, True) if marked else ([line for _, line in inside], False)


def shared_lines(a: list[str], b: list[str]) -> list[int]:
    """Numbers of the lines of ``a`` in a longest common subsequence with ``b``.

    Rows of the table are bit vectors; every 64th is kept and the others are made again
    on the way back, so that memory stays small for long pages.
    """
    both = set(a) & set(b)
    at = [i for i, line in enumerate(a) if line in both]
    y = [line for line in b if line in both]
    where: dict[str, int] = {}
    for j, line in enumerate(y):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(y)) - 1

    def step(v: int, line: str) -> int:
        u = v & where[line]
        return (v + u | v - u) & full

    kept, v = [full], full
    for n, i in enumerate(at, 1):
        v = step(v, a[i])
        if n % 64 == 0:
            kept.append(v)
    out, col, row, rows, base = [], len(y), len(at), [], -1
    while row and col:
        if base < 0 or not base <= row - 1 < base + len(rows) - 1:
            base = (row - 1) // 64 * 64
            rows = [kept[base // 64]]
            for i in at[base:min(base + 64, len(at))]:
                rows.append(step(rows[-1], a[i]))
        if rows[row - base] >> (col - 1) & 1:
            col -= 1
        else:
            row -= 1
            if row and not rows[row - base] >> (col - 1) & 1:
                continue
            out.append(at[row])
            col -= 1
    return out[::-1]


def difference(own: list[str], other: list[str]) -> list[str]:
    """Lines of a page without those it shares with the other, unless it is a copy of it."""
    shared = set(shared_lines(own, other))
    size = [len(line.split()) for line in own]
    if sum(size[i] for i in shared) >= COPY_SHARE * sum(size):
        return own
    return [line for i, line in enumerate(own) if i not in shared]


def article(own: list[str], around: list[list[str]]) -> list[str]:
    """Lines of a marked article without those that all different pages around it share with it."""
    if len(around) < WITNESSES or not set(own).intersection(*around):
        return own
    size = [len(line.split()) for line in own]
    shared, witnesses = set(range(len(own))), 0
    for other in {tuple(p): p for p in around}.values():
        same = shared_lines(own, other)
        if sum(size[i] for i in same) < COPY_SHARE * sum(size):
            shared.intersection_update(same)
            witnesses += 1
    return [line for i, line in enumerate(own) if i not in shared] if witnesses >= WITNESSES else own


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` (blocks joined by line breaks) and ``n_chars``.

    A null or empty page, or one without text, gives an empty text. A page without url
    is paired with none. Rows stay one to one, repeated ones too. Pages are dealt by
    ranges of host, path and id, so a host of any size is spread over tasks; at the
    border of a range a page has one page beside it instead of two, and fewer around it.
    """
    key = F.lower(F.coalesce(F.regexp_extract(F.col(url), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    path = F.coalesce(F.regexp_extract(F.col(url), "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit(""))
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), key.alias("host"), path.alias("path"), F.col(page).alias("page"))

    def read(batches):
        for batch in batches:
            for at, to, _, _ in words.chunks(batch.column(4)):
                part = batch.slice(at, to - at)
                got = [blocks(p) for p in part.column(4).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], pa.array([g[0] for g in got], pa.list_(pa.string())), pa.array([g[1] for g in got], pa.bool_())],
                    names=["id", "url", "host", "path", "lines", "marked"])

    kept = [T.StructField(f.name, f.dataType) for f in rows.schema.fields[:4]]
    parsed = rows.mapInArrow(read, T.StructType([*kept, T.StructField("lines", T.ArrayType(T.StringType())), T.StructField("marked", T.BooleanType())]))
    ordered = parsed.repartitionByRange("host", "path", "id").sortWithinPartitions("host", "path", "id")

    def compare(batches):
        def settle(before, own, after):
            """Text of a page between the pages around it, nearest last and nearest first."""
            lines = own[4]
            if own[5] and own[2]:
                lines = article(lines, [p[4] for p in (*before, *after) if p[2] == own[2]])
            elif own[2]:
                beside = [p for p in (*list(before)[-1:], *list(after)[:1]) if p[2] == own[2]]
                if beside:
                    lines = difference(lines, max(beside, key=lambda p: _common(p[3], own[3]))[4])
            return own[0], own[1], "\n".join(lines)

        def rows_of():
            for batch in batches:
                for at in range(0, len(batch), 64):
                    yield from zip(*(c.to_pylist() for c in batch.slice(at, 64).columns))

        def settled():
            before, after = deque(maxlen=AROUND), deque()
            for row in rows_of():
                after.append(row)
                if len(after) > AROUND:
                    own = after.popleft()
                    yield settle(before, own, after)
                    before.append(own)
            while after:
                own = after.popleft()
                yield settle(before, own, after)
                before.append(own)

        done, size = [], 0
        for row in settled():
            done.append(row)
            size += len(row[2])
            if size > words.CHUNK_BYTES or len(done) >= 4096:
                yield made(done)
                done, size = [], 0
        if done:
            yield made(done)

    kinds = [to_arrow_type(rows.schema["id"].dataType), pa.string(), pa.string()]

    def made(done):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)], names=["id", "url", "text"])

    out = T.StructType([*kept[:2], T.StructField("text", T.StringType())])
    return ordered.mapInArrow(compare, out).select(
        F.col("id").alias(page_id), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
