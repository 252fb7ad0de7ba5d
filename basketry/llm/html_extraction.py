"""Main text of web pages by structure and nearest-URL page differencing.

A page is cut into text lines, one for each block.  What stands in menus, headers, footers,
sidebars, forms and the like is left out by element, role and class.  A class counts by its first
or last part, unless it tells a page's topic or layout (``category-social``, ``with-sidebar``), and
not for an element that holds an article or more than half of the page's text; comments may be
longer than that.  Every page is paired with the pages of its host
whose URL paths are nearest, leaving out its near copies (print versions, the same page of another
day), which share four fifths of the text of the shorter one.  The lines of two such pages that
aren't copies of each other are aligned with its own by longest common subsequences, and lines
shared with both, which come from the template, are deleted; where the host has one such page only,
lines shared with it are.  A page with nothing but copies keeps all lines.

A check of structure follows: where article or main elements hold a fifth or more of the text that
differencing left, they are the text, with the licence lines and passages that they share with other
pages; smaller ones, and those that are the same on every page, are cards beside it.

Differencing alone can't give right results: pages whose menus differ share no template lines,
and articles repeat licence lines and passages of each other, which belong to the text.

Pages are sorted by host, path and id into cells of bounded size; a host with many pages spans many
cells.  A page whose nearest pages may lie beyond its cell is decided afterwards, with what the host
has before and after the cell: the nearest three pages on each side that aren't copies of each other,
however many cells away.  Two of them at least are no copies of the page.

Defined results: a null or empty page has an empty text; an url without a host is paired with
others of its kind; unclosed elements end with the page; repeated rows are extracted each.
"""

import math
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from functools import cache
from html.parser import HTMLParser
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import shared
from basketry.llm import words
from basketry.llm.url_filters import host_of

shared.ship(__name__)

#: Bytes of pages in a cell, and keys that are read to place the borders of cells; both change cost only.
CELL_BYTES = 4 << 20
BORDER_KEYS = 20_000
#: Share of the shorter page's text from which two pages are near copies.
COPY = 0.8
#: Share of the page's text from which its article and main elements are the text.
ARTICLE_SHARE = 0.2

# Elements of the HTML standard by what they do to text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(
    "audio button canvas datalist dialog embed form head iframe input label map menu noscript object "
    "option picture script select style svg template textarea title video".split()
)
_FRAME = frozenset("aside footer header nav".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody tfoot thead tr "
    "ul".split()
)
_SPACE = frozenset("br td th".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu navigation search".split())
# Parts of class and id names that mark what isn't the text.
_NAMES = frozenset(
    "ad ads adbox adslot advert advertisement advertising adverts banner breadcrumb breadcrumbs comment "
    "commentlist comments consent cookie cookies disqus footer gdpr header login masthead menu modal nav "
    "navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related "
    "replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription teaser toolbar widget widgets".split()
)
# Those of visitors' texts, which may be longer than the page's own.
_TALK = frozenset("comment commentlist comments disqus replies reply respond".split())
# First parts of names that tell what a page is about or how it is laid out.
_TELLS = frozenset(
    "cat category content format has hentry is label layout no not page post section subject tag tags tax "
    "taxonomy term theme topic type with without".split()
)
_NAME = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _marks(name: str) -> str | None:
    """The part of a class or id name that marks what isn't the text."""
    parts = _NAME.findall(_CAMEL.sub(" ", name).lower())
    if not parts:
        return None
    if parts[0] in _NAMES:
        return parts[0]
    return parts[-1] if parts[-1] in _NAMES and parts[0] not in _TELLS else None


class _Lines(HTMLParser):
    """Collects ``(parts, inside an article or main element)`` of all blocks that may be text.

    A part is a text and the numbers of the elements around it that a class or id marks.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[list, bool]] = []
        self.open: list[tuple[str, bool, bool, int]] = []  # element, left out, article or main, mark
        self.parts: list[tuple[str, tuple]] = []
        self.talk: list[bool] = []  # of every marked element: visitors' texts
        self.met: set[int] = set()  # marked elements that hold an article

    def _skips(self) -> bool:
        return any(out for _, out, _, _ in self.open)

    def _inside(self) -> bool:
        return any(main for _, _, main, _ in self.open)

    def _end_block(self) -> None:
        if self.parts:
            self.blocks.append((self.parts, self._inside()))
        self.parts = []

    def _left_out(self, tag: str, named: dict) -> bool:
        if tag in _SILENT or (tag in _FRAME and not (tag == "header" and self._inside())):
            return True
        if "hidden" in named or named.get("aria-hidden") == "true" or named.get("role", "").lower() in _ROLES:
            return True
        return bool(_HIDDEN.search(named.get("style", "").lower()))

    def _mark(self, tag: str, named: dict) -> int:
        """Number of an element that a class or id marks, or -1."""
        if tag in ("html", "body", "main") or not ("class" in named or "id" in named):
            return -1
        names = (named.get("class", "") + " " + named.get("id", "")).split()
        marks = {m for m in map(_marks, names) if m}
        if not marks:
            return -1
        self.talk.append(not marks.isdisjoint(_TALK))
        return len(self.talk) - 1

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self._end_block()
        elif tag in _SPACE:
            self.parts.append((" ", ()))
        if tag in _VOID:
            return
        if tag == "body" or (tag in _BLOCK and self.open and self.open[-1][0] == "head"):
            # A head that isn't closed ends where the body's content begins.
            self.open = [x for x in self.open if x[0] != "head"]
        named = {k: v or "" for k, v in attrs}
        left_out, mark = self._left_out(tag, named), self._mark(tag, named)
        if tag in ("p", "li", "td", "th", "tr", "option", "dt", "dd") and self.open and self.open[-1][0] == tag:
            self.open.pop()
        own = tag in ("article", "main") and not left_out
        if own and mark < 0:
            # Menus and adverts hold no articles: what is still open was never closed.
            self.met.update(m for _, _, _, m in self.open if m >= 0)
            self.open = [(t, out and t in ("script", "style", "template"), main, m) for t, out, main, m in self.open]
        self.open.append((tag, left_out, own, mark))

    def handle_endtag(self, tag):
        if tag in _BLOCK:
            self._end_block()
        elif tag in _SPACE:
            self.parts.append((" ", ()))
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        if not self._skips():
            self.parts.append((data, tuple(m for _, _, _, m in self.open if m >= 0)))

    def lines(self) -> list[tuple[str, bool]]:
        """``(text, inside)`` of the blocks, without the marked elements that are left out."""
        size, sizes = 0, [0] * len(self.talk)
        for parts, _ in self.blocks:
            for text, marks in parts:
                length = len(text.strip())
                size += length
                for m in marks:
                    sizes[m] += length
        dropped = {
            m for m, n in enumerate(sizes) if m not in self.met and (2 * n <= size or (self.talk[m] and n < size))
        }
        out = []
        for parts, inside in self.blocks:
            text = " ".join("".join(t for t, marks in parts if dropped.isdisjoint(marks)).split())
            if text:
                out.append((text, inside))
        return out


def page_lines(html: str | None) -> tuple[list[str], list[bool]]:
    """Lines of a page, and which of them are in its article or main elements."""
    if not html:
        return [], []
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser._end_block()
    lines = parser.lines()
    return [text for text, _ in lines], [inside for _, inside in lines]


def main_lines(lines: list[str], inside: list[bool], template: set[int] = frozenset()) -> tuple[list[str], bool]:
    """The text without the lines of the template, and whether article or main elements are it.

    They are, whole, if they hold enough of what isn't template; a line that a page repeats counts once.
    """
    own = [k for k in range(len(lines)) if k not in template] or range(len(lines))
    size = sum(map(len, {lines[k] for k in own}))
    main = sum(map(len, {lines[k] for k in own if inside[k]}))
    if main and main >= ARTICLE_SHARE * size:
        return [x for x, within in zip(lines, inside, strict=True) if within], True
    return [lines[k] for k in own], False


def text_lines(html: str | None) -> tuple[list[str], bool]:
    """Lines of a page by itself, and whether they are those of its article or main elements."""
    lines, inside = page_lines(html)
    return main_lines(lines, inside) if lines else ([], True)


def common(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Lines that both begin or end with belong to one; the rest is Hunt and Szymanski's.
    """
    begin, shorter = 0, min(len(a), len(b))
    while begin < shorter and a[begin] == b[begin]:
        begin += 1
    end = 0
    while end < shorter - begin and a[-1 - end] == b[-1 - end]:
        end += 1
    out = {*range(begin), *range(len(a) - end, len(a))}
    where = defaultdict(list)
    for j in range(begin, len(b) - end):
        where[b[j]].append(j)
    ends: list[int] = []
    last: list = []
    for i in range(begin, len(a) - end):
        for j in reversed(where.get(a[i], ())):
            k = bisect_left(ends, j)
            link = (i, last[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                last.append(link)
            elif j < ends[k]:
                ends[k], last[k] = j, link
    link = last[-1] if last else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def _nearness(a: str, b: str) -> int:
    """Length of the common beginning."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _alike(a: list[str], b: list[str]) -> bool:
    """Whether two pages are near copies."""
    least = COPY * min(sum(map(len, a)), sum(map(len, b)))
    return sum(len(a[i]) for i in common(a, b)) >= least


class _Host:
    """The pages of a host in a cell, by path; near copies are put together once found.

    ``goes_on`` tells whether the host may have pages before and after those of the cell.
    """

    def __init__(self, paths: list[str], lines_of, goes_on: tuple[bool, bool] = (False, False)):
        self.paths = paths
        self.lines_of = lines_of
        self.goes_on = goes_on
        self.parent = list(range(len(paths)))
        self.unlike: set[tuple[int, int]] = set()

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def copies(self, i: int, j: int) -> bool:
        if self.root(i) == self.root(j):
            return True
        pair = (min(i, j), max(i, j))
        if pair in self.unlike:
            return False
        if _alike(self.lines_of(i), self.lines_of(j)):
            self.parent[max(self.root(i), self.root(j))] = min(self.root(i), self.root(j))
            return True
        self.unlike.add(pair)
        return False

    def nearest(self, i: int):
        """The other pages, the nearest paths first, from ``i`` outwards; None where the host goes on beyond the cell."""
        low, high, count = i - 1, i + 1, len(self.paths)
        before = _nearness(self.paths[i], self.paths[low]) if low >= 0 else -1
        after = _nearness(self.paths[i], self.paths[high]) if high < count else -1
        while True:
            if (low < 0 and self.goes_on[0]) or (high >= count and self.goes_on[1]):
                yield None
                return
            if low < 0 and high >= count:
                return
            if before >= after:
                yield low
                low -= 1
                before = _nearness(self.paths[i], self.paths[low]) if low >= 0 else -1
            else:
                yield high
                high += 1
                after = _nearness(self.paths[i], self.paths[high]) if high < count else -1

    def template(self, i: int) -> set[int] | None:
        """Places of the lines of a page that come from the template; None if pages beyond the cell decide."""
        own = self.lines_of(i)
        partners: list[int] = []
        for j in self.nearest(i) if own else ():
            if j is None:
                return None
            # Pages without text say nothing of the template.
            if not self.lines_of(j) or self.copies(i, j) or any(self.copies(p, j) for p in partners):
                continue
            partners.append(j)
            if len(partners) == 2:
                break
        return set.intersection(*(common(own, self.lines_of(j)) for j in partners)) if partners else set()

    def unlike_pages(self, places, most: int, but: int | None = None) -> list[int]:
        """The first pages of ``places`` that have text and aren't copies of each other, nor of ``but``."""
        found: list[int] = []
        for j in places:
            if not self.lines_of(j) or (but is not None and self.copies(but, j)):
                continue
            if not any(self.copies(p, j) for p in found):
                found.append(j)
                if len(found) == most:
                    break
        return found

    def beside(self, i: int) -> list[tuple[int, int]]:
        """``(side, page)``: what a page may be paired with on each side, nearest first."""
        sides = range(i - 1, -1, -1), range(i + 1, len(self.paths))
        return [(side, j) for side, places in enumerate(sides) for j in self.unlike_pages(places, 2, i)]

    def ends(self) -> list[tuple[int, int]]:
        """``(side, page)``: what a walk meets that comes in at the beginning (0) or at the end (1)."""
        places = range(len(self.paths))
        return [(side, j) for side, way in enumerate((places, places[::-1])) for j in self.unlike_pages(way, _SEEN)]


#: Pages on each side of a cell that are no copies of each other: two for a page to be paired with, and its own copies.
_SEEN = 3
_NEAR = "array<struct<side: int, path: string, lines: binary, size: bigint>>"
# Kinds of rows that a cell gives: texts, pages to be decided with other cells, and what other cells may meet.
_TEXT, _OPEN, _ENDS = 0, 1, 2


def _unpacked(lines: bytes, size: int) -> list[str]:
    if not size:
        return []
    return pa.decompress(lines, decompressed_size=size, codec="zstd", asbytes=True).decode().split("\n")


def _main_text(own: list[str], main: bytes, template: set[int]) -> str:
    inside = pa.decompress(main, decompressed_size=len(own), codec="zstd", asbytes=True)
    return "\n".join(main_lines(own, [bool(x) for x in inside], template)[0])


def _views(ends: pa.Table) -> pa.Table:
    """What each cell of a host has before and after it, from the ends of the host's cells."""
    rows = sorted(zip(ends["cell"].to_pylist(), ends["near"].to_pylist(), strict=True), key=lambda r: r[0])
    seen: list[list] = [[] for _ in rows]
    for side, way in ((0, range(len(rows))), (1, range(len(rows) - 1, -1, -1))):
        view: list[tuple[dict, list[str]]] = []
        for n in way:
            seen[n] += [{**page, "side": side} for page, _ in view]
            found: list[tuple[dict, list[str]]] = []
            # Who looks back meets a cell from its end.
            own = [(x, _unpacked(x["lines"], x["size"])) for x in rows[n][1] if x["side"] == 1 - side]
            for page, lines in [*own, *view]:
                if len(found) < _SEEN and not any(_alike(lines, other) for _, other in found):
                    found.append((page, lines))
            view = found
    near = pa.array(seen, ends.schema.field("near").type)
    return pa.table({"host": ends["host"], "cell": pa.array([r[0] for r in rows], pa.int32()), "near": near})


def _decided(pages: pa.Table, views: pa.Table) -> pa.Table:
    """Texts of the open pages of a cell, with what the host has around the cell."""
    lines_of = cache(_unpacked)
    around = [x for near in views["near"].to_pylist() for x in near]
    texts = []
    for path, lines, size, main, near in zip(
        *(pages[c].to_pylist() for c in ("path", "lines", "size", "main", "near")), strict=True
    ):
        own = lines_of(lines, size)
        met = sorted([*near, *around], key=lambda x: (-_nearness(path, x["path"]), x["side"]))
        partners: list[list[str]] = []
        for page in met:
            other = lines_of(page["lines"], page["size"])
            if not _alike(own, other) and not any(_alike(p, other) for p in partners):
                partners.append(other)
                if len(partners) == 2:
                    break
        template = set.intersection(*(common(own, p) for p in partners)) if partners else set()
        texts.append(_main_text(own, main, template))
    return pa.table({"page_id": pages["page_id"], "url": pages["url"], "text": pa.array(texts, pa.string())})


def _borders(pages: DataFrame) -> list[str]:
    """Keys at which cells begin: they decide which task does what, not what is compared.

    They cut the bytes of about ``BORDER_KEYS`` distinct keys, chosen by a hash, into equal parts.
    """
    size, count = pages.agg(F.sum(F.octet_length("html")), F.count("*")).first()
    cells = math.ceil((size or 0) / CELL_BYTES)
    if cells < 2:
        return []
    step = max(1, math.ceil(count / BORDER_KEYS))
    some = pages.where(F.pmod(F.xxhash64("key"), F.lit(step)) == 0)
    sizes = some.groupBy("key").agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0))).alias("size"))
    found = sorted((r[0], r[1]) for r in sizes.collect())
    total = sum(n for _, n in found)
    borders, done = set(), 0
    for key, n in found if total else ():
        if done and done * cells // total != (done + n) * cells // total:
            borders.add(key)
        done += n
    return sorted(borders)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text`` of every page."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host = F.coalesce(host_of(url), F.lit(""))
    path = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    number = F.lpad(F.coalesce(F.col(id_col).cast("string"), F.lit("")), 20, "0")
    picked = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.concat_ws("\x01", host, path, number).alias("key"),
        F.col(html_col).alias("html"),
    )
    kind = words.kind_of(picked, "page_id")
    borders = _borders(picked)

    def parse(batches):
        for batch in batches:
            keys = batch.column(2).to_pylist()
            lines, main, sizes = [], [], []
            for html in batch.column(3).to_pylist():
                own, inside = page_lines(html)
                text = "\n".join(own).encode()
                lines.append(pa.compress(text, codec="zstd", asbytes=True) if text else b"")
                main.append(pa.compress(bytes(inside), codec="zstd", asbytes=True) if own else b"")
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array([bisect_right(borders, k) for k in keys], pa.int32()),
                    pa.array(main, pa.binary()),
                    pa.array(lines, pa.binary()),
                    pa.array(sizes, pa.int64()),
                ],
                ["page_id", "url", "key", "cell", "main", "lines", "size"],
            )

    def finish(cell, table):
        number = cell[0].as_py()
        table = table.sort_by("key").combine_chunks()
        keys = [k.split("\x01") for k in table["key"].to_pylist()]
        columns = {c: table[c].to_pylist() for c in ("page_id", "url", "main", "lines", "size")}
        packed, sizes, main = columns["lines"], columns["size"], columns["main"]
        edges = [borders[n].split("\x01")[0] if 0 <= n < len(borders) else None for n in (number - 1, number)]
        rows = []

        def near(host, of_host, places):
            return [
                {"side": side, "path": host.paths[j], "lines": packed[of_host[j]], "size": sizes[of_host[j]]}
                for side, j in places
            ]

        for name, run in groupby(range(len(keys)), key=lambda i: keys[i][0]):
            of_host = list(run)
            lines_of_page = cache(lambda n, of_host=of_host: _unpacked(packed[of_host[n]], sizes[of_host[n]]))
            goes_on = edges[0] == name, edges[1] == name
            host = _Host([keys[i][1] for i in of_host], lines_of_page, goes_on)
            for n, i in enumerate(of_host):
                row = {"page_id": columns["page_id"][i], "url": columns["url"][i], "kind": _TEXT, "text": ""}
                if own := lines_of_page(n):
                    template = host.template(n)
                    if template is None:
                        row |= {"kind": _OPEN, "text": None, "host": name, "cell": number, "path": host.paths[n]}
                        row |= {c: columns[c][i] for c in ("main", "lines", "size")}
                        row["near"] = near(host, of_host, host.beside(n))
                    else:
                        row["text"] = _main_text(own, main[i], template)
                rows.append(row)
            if any(goes_on):
                rows.append({"kind": _ENDS, "host": name, "cell": number, "near": near(host, of_host, host.ends())})
        schema = pa.schema(
            [
                table.schema.field("page_id"),
                ("url", pa.string()),
                ("text", pa.string()),
                ("kind", pa.int32()),
                ("host", pa.string()),
                ("cell", pa.int32()),
                ("path", pa.string()),
                ("main", pa.binary()),
                ("lines", pa.binary()),
                ("size", pa.int64()),
                (
                    "near",
                    pa.list_(
                        pa.struct(
                            [("side", pa.int32()), ("path", pa.string()), ("lines", pa.binary()), ("size", pa.int64())]
                        )
                    ),
                ),
            ]
        )
        return pa.Table.from_pylist(rows, schema)

    parsed = picked.mapInArrow(
        parse, f"page_id {kind}, url string, key string, cell int, main binary, lines binary, size bigint"
    )
    texts = f"page_id {kind}, url string, text string"
    cells = parsed.groupBy("cell").applyInArrow(
        finish,
        f"{texts}, kind int, host string, cell int, path string, main binary, lines binary, size bigint, near {_NEAR}",
    )
    if not borders:
        return cells.select("page_id", "url", "text")
    cells = shared.stage(cells, "cells", "zstd")
    views = (
        cells.where(F.col("kind") == _ENDS)
        .select("host", "cell", "near")
        .groupBy("host")
        .applyInArrow(_views, f"host string, cell int, near {_NEAR}")
    )
    pages_left = cells.where(F.col("kind") == _OPEN).drop("text", "kind")
    decided = pages_left.groupBy("host", "cell").cogroup(views.groupBy("host", "cell")).applyInArrow(_decided, texts)
    return cells.where(F.col("kind") == _TEXT).select("page_id", "url", "text").unionByName(decided)
