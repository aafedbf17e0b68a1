"""Main text of web pages: block structure, and differencing against the nearest page of the host."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwright.llm.common import Scratch, parallelism

# ---------------------------------------------------------------- blocks of one page

#: Elements whose text is never part of an article.
DROPPED = frozenset("nav footer aside form script style noscript template iframe svg canvas object select button textarea dialog menu head title datalist audio video map math".split())
#: Elements read up to their own end tag, whatever stands inside.
RAW = frozenset("script style template noscript iframe textarea title svg".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
#: Elements that begin and end a block of text.
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that hold running text themselves, as opposed to bare text in a container.
PROSE = HEADINGS | frozenset("p li pre blockquote dd dt td th figcaption caption".split())
CONTAINERS = frozenset("article aside body details div dl fieldset figure footer header html main nav ol section table ul blockquote center".split())
#: Words of class and id names, and role values, that mark page furniture.
FURNITURE = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertisements advertising alert banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer discussion disqus dropdown footer gdpr header hidden login masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion recommended related replies reply respond responses search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription teaser teasers toc toolbar topbar tracking widget widgets".split()
)
#: Beside one of these in a name, "header" means an article's own header.
OWN_HEADER = frozenset("article content entry post story".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())

#: Markup that begins at a "<", with quoted attribute values, and the same without regard to quotes.
_OPENERS = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/><]*)"
_QUOTED = re.compile(_OPENERS + r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_PLAIN = re.compile(_OPENERS + r"([^>]*+)>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")

KEPT, OPEN, BARE, FURNISHING = 0, 1, 2, 3


def _furniture(attributes: str) -> bool | str:
    """Whether an element's attributes mark it as page furniture or as hidden; "header" for an article's own header."""
    if not attributes or attributes.isspace():
        return False
    own_header = ""
    for name, *values in _ATTR.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            for one in value.split():
                parts = {x.lower() for x in _NAME_PARTS.findall(one)}
                marks = parts & FURNITURE
                if marks == {"header"} and parts & OWN_HEADER:
                    own_header = "header"
                elif marks:
                    return True
        elif name == "role":
            if value.lower() in ROLES:
                return True
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return own_header or False


def _markup(html: str) -> Iterator[tuple[int, re.Match | None, int]]:
    """(end of the text before, match, place after) of each piece of markup, then (end, None, end).

    Time is linear in the page: what may be a tag but is not closed under quotes turns quotes off for the rest, and
    behind the last ">" nothing is searched.
    """
    expression, last, at = _QUOTED, html.rfind(">"), 0
    while True:
        at = html.find("<", at)
        if at < 0 or at > last:
            break
        m = expression.match(html, at)
        if not m and expression is _QUOTED and html[at + 1 : at + 3].lstrip("/")[:1].isalpha():
            expression = _PLAIN
            m = expression.match(html, at)
        if not m:
            at += 1
            continue
        again = yield at, m, m.end()
        at = again or m.end()
    cut = html.find("<!--", last + 1)
    yield len(html) if cut < 0 else cut, None, len(html)


def page_blocks(html: str) -> list[tuple[str, int]]:
    """All text blocks of a page in order, with their zones.

    FURNISHING: in an element that marks page furniture by its kind, role or the words of its class and id, or, on a
    page with an article (else a main) element, outside that. Blocks of the article, and a main element's h1 before it, are
    KEPT in prose elements and BARE directly in containers. On a page without one, blocks are OPEN. Headings stay where
    an article has a header; other text of it is furnishing.
    """
    lines: list[tuple[str, int, bool, bool]] = []  # text, article level (-1: furnishing), in prose, top heading
    stack: list[tuple[str, bool, int]] = []  # element, whether furniture, article level
    unclosed: dict[str, int] = {}
    bad = level = 0
    prose = heading = bad_block = top = False
    header_in_article = 0
    parts: list[str] = []
    waste: list[str] = []

    def flush() -> None:
        nonlocal bad_block
        for held, at_level in ((parts, level), (waste, -1)):
            if held:
                text = _SPACE.sub(" ", unescape("".join(held))).strip()
                held.clear()
                if text:
                    lines.append((text, at_level, prose, top))
        bad_block = False

    def close(depth: int) -> None:
        nonlocal bad, level, header_in_article
        while len(stack) > depth:
            name, was_bad, before = stack.pop()
            unclosed[name.rstrip("*")] -= 1
            bad -= was_bad
            header_in_article -= name.endswith("*")
            level = before

    at, pieces = 0, _markup(html)
    stop, m, after = next(pieces)
    while True:
        if stop > at:
            (waste if bad or bad_block or header_in_article and not heading else parts).append(html[at:stop])
        if not m:
            break
        at, skip = after, None
        name = (m[2] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                (waste if bad else parts).append(m[0][9:-3].replace("&", "&amp;").replace("<", "&lt;"))
        elif m[1]:  # an end tag
            if name in BLOCK:
                flush()
                if name in PROSE:
                    prose = heading = top = False
            if unclosed.get(name):
                depth = len(stack) - 1
                while stack[depth][0].rstrip("*") != name:
                    depth -= 1
                close(depth)
        else:
            if name in BLOCK:
                flush()
                if name in PROSE:
                    prose, heading, top = True, name in HEADINGS, name == "h1"
                elif name in CONTAINERS:
                    prose = heading = top = False
            elif name == "br":
                (waste if bad or bad_block else parts).append(" ")
            if name in RAW:
                closing = re.compile(rf"</{re.escape(name)}\b", re.I).search(html, at)
                over = html.find(">", closing.end()) if closing else -1
                at = skip = over + 1 if over >= 0 else len(html)
            elif name not in VOID and not (m[3].endswith("/") and name not in BLOCK):
                if name == "body":
                    close(0)
                marked = False if name in ("html", "body", "main", "article") else _furniture(m[3])
                in_article = marked == "header" or level and name == "header" and marked is not True
                is_bad = not in_article and (name in DROPPED or name == "header" or bool(marked))
                if name in PROSE and name != "blockquote":
                    bad_block = is_bad  # such elements often lack an end tag: they last until the next block
                elif is_bad or name in CONTAINERS:
                    stack.append((name + "*" if in_article else name, is_bad, level))
                    unclosed[name] = unclosed.get(name, 0) + 1
                    bad += is_bad
                    header_in_article += bool(in_article)
                    if not bad and name in ("article", "main"):
                        level = 2 if name == "article" else max(level, 1)
        stop, m, after = pieces.send(skip)
    flush()
    best = max((x[1] for x in lines), default=0)
    if best < 1:
        return [(text, FURNISHING if at_level < 0 else OPEN) for text, at_level, *_ in lines]
    own = [at_level == best or at_level > 0 and is_top for _, at_level, _, is_top in lines]
    return [(text, FURNISHING if not inside else KEPT if in_prose else BARE) for (text, _, in_prose, _), inside in zip(lines, own)]


def page_lines(html: str) -> list[tuple[str, int]]:
    """The text blocks of a page outside its furniture, in order, with their zones."""
    return [(text, zone) for text, zone in page_blocks(html) if zone != FURNISHING]


# ---------------------------------------------------------------- differencing


#: Cells of the table of two sequences that are held at once; of larger tables some rows are held and those between made again.
_MOST_CELLS = 1 << 28


def common_subsequence(a: list, b: list) -> list[int]:
    """Indices in `a` of a longest common subsequence of `a` and `b`.

    Equal ends are set aside. Sequences with few matches are aligned by increasing runs, others by bits, one row of
    the table an integer. Both find the same one of all longest: from the end, each match is at the least place in `b`, then the
    least in `a`, that the length up to it allows. So the choice, and the cells held at once, change time and memory only.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    rows, columns = range(head, len(a) - tail), range(head, len(b) - tail)
    places: dict = {}
    for j in columns:
        places.setdefault(b[j], []).append(j)
    rows = [i for i in rows if a[i] in places]
    here = {a[i] for i in rows}
    columns = [j for j in columns if b[j] in here]
    if sum(len(places[a[i]]) for i in rows) <= 16 * (len(rows) + len(columns)):
        middle = _by_runs(a, rows, places)
    else:
        middle = _by_bits(a, rows, b, columns)
    return [*range(head), *middle, *range(len(a) - tail, len(a))]


def _by_runs(a: list, rows: list[int], places: dict) -> list[int]:
    ends: list[int] = []
    links: list = []
    for i in rows:
        for j in reversed(places[a[i]]):
            k = bisect_left(ends, j)
            if k < len(ends) and ends[k] == j:
                continue
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k] = j
                links[k] = link
    found, link = [], links[-1] if links else None
    while link:
        found.append(link[0])
        link = link[1]
    return found[::-1]


def _by_bits(a: list, rows: list[int], b: list, columns: list[int]) -> list[int]:
    """A column's bit is 0 in a row where the longest subsequence up to that row grows at that column."""
    own: dict = {}
    for k, j in enumerate(columns):
        own[b[j]] = own.get(b[j], 0) | 1 << k
    found: list[int] = []

    def states(first: int, after: int, state: int, c: int, every: int) -> list[int]:
        """The state before row `first`, up to column c, and that after each `every` rows."""
        full = (1 << c) - 1
        state &= full
        table = [state]
        for r in range(first, after):
            match = state & own[a[rows[r]]]
            state = (state + match | state - match) & full
            if (r + 1 - first) % every == 0:
                table.append(state)
        return table

    def back(first: int, after: int, state: int, c: int) -> int:
        """Add the matches in some rows up to column c, from the last; the column they leave."""
        n = after - first
        if n > 16 and n * c > _MOST_CELLS:
            every = -(-n // 16)
            table = states(first, after, state, c, every)
            for k in range((n - 1) // every, -1, -1):
                c = back(first + k * every, min(after, first + (k + 1) * every), table[k], c)
            return c
        table, r = states(first, after, state, c, 1), n
        while r and c:
            if table[r] >> c - 1 & 1:
                c -= 1
                continue
            r -= 1
            if table[r] >> c - 1 & 1:  # grows here first: a match
                found.append(rows[first + r])
                c -= 1
        return c

    back(0, len(rows), (1 << len(columns)) - 1, len(columns))
    return found[::-1]


@dataclass
class Page:
    """What differencing reads of a page: where it is, the blocks that may be deleted, and digest and words of those that may not."""

    host: str
    path: str
    lines: list[str]
    kept: int
    kept_words: int


def nearness(a: Page, b: Page) -> tuple[int, int]:
    """Equal leading path segments, then equal leading characters."""
    x, y = a.path.split("/"), b.path.split("/")
    segments = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    same = next((k for k, (p, q) in enumerate(zip(a.path, b.path)) if p != q), min(len(a.path), len(b.path)))
    return segments, same


#: Words, as of a date, that a page may have beside what it shares with its copy.
COPY_REST = 3


def _words(lines: Iterable[str]) -> int:
    return sum(len(x.split()) for x in lines)


def shared_lines(page: Page, others: Iterable[Page | None], copy_share: float) -> list[int]:
    """Places of the page's blocks that the nearest of its neighbours has too.

    Of a neighbour that shares more than `copy_share` of the blocks' text the page is a copy if neither has more than
    COPY_REST words beside it: that says nothing about furniture, and the next neighbour is asked. With more words of its
    own on either side, however short, the shared text is furniture.
    """
    near = [o for o in others if o is not None and o.host == page.host]
    for other in sorted(near, key=lambda o: nearness(page, o), reverse=True) if page.lines else ():
        shared = common_subsequence(page.lines, other.lines)
        both = _words(page.lines[k] for k in shared)
        rest = max(_words(page.lines), _words(other.lines)) - both
        if page.kept != other.kept:
            rest += max(page.kept_words, other.kept_words)
        if rest > COPY_REST or sum(len(page.lines[k]) for k in shared) <= copy_share * sum(map(len, page.lines)):
            return shared
    return []


# ---------------------------------------------------------------- operator

_PAGES = "host string, path string, ord long, d1 long, d2 long, kept long, kept_words long, lines string"
_DEALT = "bucket int, context boolean, " + _PAGES
_GONE = "host string, d1 long, d2 long, gone array<int>"
_BLOCKS = "page_id long, url string, host string, d1 long, d2 long, lines string, zones binary"
_TEXTS = "page_id long, url string, text string, n_chars long, n_shared long, n_furniture long"
_KEY = ("host", "path", "ord")
_COPY = ("host", "d1", "d2")


def _batch(columns: dict[str, list], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    named = [x.split(" ") for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[name], kinds[kind]) for name, kind in named], [name for name, _ in named])


def _digests(lines: list[str], zones: bytes) -> tuple[int, int]:
    whole = hashlib.blake2b("\n".join(lines).encode("utf-8", "surrogatepass") + b"\0" + zones, digest_size=16).digest()
    return int.from_bytes(whole[:8], "little", signed=True), int.from_bytes(whole[8:], "little", signed=True)


def main_text(pages: DataFrame, copy_share: float = 0.8) -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars, n_shared, n_furniture.

    A page's text blocks come from its elements. Pages of a host with equal blocks are copies, of which the first by path
    stands for all. These are sorted by host and URL path, and each is compared with the nearer of its two neighbours: the blocks that are
    not prose of an article are aligned by longest common subsequence, and shared ones are deleted (n_shared). Of the rest, blocks in
    elements that mark menus, headers, footers, sidebars, notices, adverts, forms or comments, by kind, role or the words
    of class and id names, go too (n_furniture): so a page without a neighbour, or with furniture of its own, loses it as well. Prose inside an
    article or main element is certain and is never deleted, so articles that occur twice stay whole.

    Character references are decoded, white space inside a block is one space, blocks are joined by
    two line feeds. Null or empty html gives an empty text; null URLs form a host of their own; repeated rows are kept; a null
    page_id stays null; very long pages count whole, in time that grows with their length; extra columns are ignored; an empty table gives no rows. Sorting is by
    ranges of (host, path, page_id), so a host with a third of all pages is spread over tasks; the pages at range edges are
    sent to both sides, which makes the result independent of the number of ranges. Only range edges reach the driver. Copies meet their
    deletions in a join that skew handling can split.
    """
    spark = pages.sparkSession
    url = F.coalesce("url", F.lit(""))
    authority = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""))
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)?([^?#]*)", 1)
    order = F.coalesce(F.col("page_id").cast("long"), F.lit(-(2**63)))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), path.alias("path"), order.alias("ord"), "html")

    def loose(batches):
        for batch in batches:
            held = {c: batch.column(c).to_pylist() for c in _KEY} | {c: [] for c in ("d1", "d2", "kept", "kept_words", "lines")}
            for html in batch.column("html").to_pylist():
                blocks = page_blocks(html or "")
                kept = [x for x, z in blocks if z == KEPT]
                d1, d2 = _digests([x for x, _ in blocks], bytes(z for _, z in blocks))
                row = (d1, d2, _digests(kept, b"")[0], _words(kept), "\n".join(x for x, z in blocks if z != KEPT))
                for c, value in zip(("d1", "d2", "kept", "kept_words", "lines"), row):
                    held[c].append(value)
            yield _batch(held, _PAGES)

    n = parallelism(spark)
    scratch = Scratch(spark)
    first = F.min(F.struct("path", "ord")).alias("at")
    same = [F.any_value(c).alias(c) for c in ("kept", "kept_words", "lines")]
    one = keyed.select(*_KEY, "html").mapInArrow(loose, _PAGES).groupBy(*_COPY).agg(first, *same)
    one = scratch.put(one.select("host", "at.path", "at.ord", "d1", "d2", "kept", "kept_words", "lines"))
    ranged = one.select(*_KEY).repartitionByRange(n, *_KEY)
    key = F.struct(*_KEY)
    edges = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
    edges = sorted((tuple(e["lo"]), tuple(e["hi"])) for e in edges)
    lows, highs = [e[0] for e in edges], [e[1] for e in edges]

    def deal(batches):
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in _KEY)))
            rows, buckets, context = [], [], []
            for k, at in enumerate(keys):
                own = bisect_right(lows, at) - 1
                for bucket in (own, *([own - 1] if own and lows[own] == at else []), *([own + 1] if own + 1 < len(highs) and highs[own] == at else [])):
                    rows.append(k)
                    buckets.append(bucket)
                    context.append(bucket != own)
            if rows:
                own = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(context), *own.columns], ["bucket", "context", *own.schema.names])

    def differ(batches):
        def rows() -> Iterator[tuple[int, bool, tuple, Page]]:
            for batch in batches:
                names = ("bucket", "context", "host", "path", "d1", "d2", "kept", "kept_words", "lines")
                for bucket, context, host, path, d1, d2, kept, kept_words, lines in zip(*(batch.column(c).to_pylist() for c in names)):
                    yield bucket, context, (host, d1, d2), Page(host, path, lines.split("\n") if lines else [], kept, kept_words)

        out: list[tuple] = []
        before = now = None
        for after in _with_end(rows()):
            if now is not None and not now[1]:
                others = [x[3] for x in (before, after) if x is not None and x[0] == now[0]]
                gone = shared_lines(now[3], others, copy_share)
                if gone:
                    out.append((*now[2], gone))
                if len(out) >= 1000:
                    yield _batch(dict(zip((*_COPY, "gone"), zip(*out))), _GONE)
                    out.clear()
            before, now = now, after
        if out:
            yield _batch(dict(zip((*_COPY, "gone"), zip(*out))), _GONE)

    ranges = max(1, len(edges))
    dealt = one.mapInArrow(deal, _DEALT).repartitionById(ranges, F.col("bucket"))
    gone = scratch.put(dealt.sortWithinPartitions("bucket", *_KEY, "d1", "d2").mapInArrow(differ, _GONE))
    scratch.keep(gone)

    def blocks(batches):
        for batch in batches:
            held = {c: batch.column(c).to_pylist() for c in ("page_id", "url", "host")} | {c: [] for c in ("d1", "d2", "lines", "zones")}
            for html in batch.column("html").to_pylist():
                found = page_blocks(html or "")
                lines, zones = [x for x, _ in found], bytes(z for _, z in found)
                for c, value in zip(("d1", "d2", "lines", "zones"), (*_digests(lines, zones), "\n".join(lines), zones)):
                    held[c].append(value)
            yield _batch(held, _BLOCKS)

    def texts(batches):
        for batch in batches:
            held = {c: batch.column(c).to_pylist() for c in ("page_id", "url")} | {c: [] for c in ("text", "n_chars", "n_shared", "n_furniture")}
            for lines, zones, gone in zip(*(batch.column(c).to_pylist() for c in ("lines", "zones", "gone"))):
                deletable = [k for k, z in enumerate(zones) if z != KEPT]
                shared = {deletable[k] for k in gone or ()}
                split = lines.split("\n") if lines else []
                text = "\n\n".join(x for k, x in enumerate(split) if zones[k] != FURNISHING and k not in shared)
                row = (text, len(text), len(shared), sum(z == FURNISHING for z in zones) - sum(zones[k] == FURNISHING for k in shared))
                for c, value in zip(("text", "n_chars", "n_shared", "n_furniture"), row):
                    held[c].append(value)
            yield _batch(held, _TEXTS)

    whole = keyed.select("page_id", "url", "host", "html").mapInArrow(blocks, _BLOCKS)
    return whole.join(gone, [*_COPY], "left").select("page_id", "url", "lines", "zones", "gone").mapInArrow(texts, _TEXTS)


def _with_end(rows: Iterator) -> Iterator:
    """The rows, and None after the last."""
    yield from rows
    yield None

