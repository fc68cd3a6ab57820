"""Main text of web pages by deducing the template that pages of a host share.

Every start tag, told apart by its path of structural elements, is a token. Its
occurrence vector says how often it occurs on each page of the host. Tokens with equal
vectors form an equivalence class; the vectors themselves are never gathered, two
sums over hashed pages stand for them. Large and frequent classes are valid, and those whose
tokens occur once a page nest by their paths into the host's template. The innermost slot
of the template that holds all text in which the host's pages differ, and most of
their text, is the place of the article, but never a part of an element that says it is the
article; from it the remaining slots are extracted, without what is marked as something else.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_slices, renamed
from millrace.operators.joins import fits_broadcast
from millrace.session import settle

#: A valid class has so many tokens and occurs on this share of a host's pages.
CLASS_TOKENS = 3
FREQUENT = 0.5
#: Share of a host's text that the article's slot holds, beside all that differs between pages.
MOST_TEXT = 0.6

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|math|iframe|object|title)\b[^>]*>"
    r".*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|[^<]+|<",
    re.S | re.I)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_ROLE = re.compile(r"\brole\s*=\s*[\"']?main\b", re.I)
_PART = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")
_RAW = re.compile(r"<(?:script|style|noscript|template|textarea|svg|math|iframe|object|title)\b", re.I)
_QUOTE = re.compile("[\"']")

#: Elements that make up a path.
STRUCTURAL = frozenset(
    "html head body article main section div nav header footer aside form ul ol dl table thead tbody tr "
    "td th figure dialog details menu fieldset blockquote pre h1 h2 h3 h4 h5 h6".split())
#: Elements that part blocks of text.
BLOCK = STRUCTURAL | frozenset("p br hr li dt dd figcaption caption summary address option".split())
#: Elements whose text is not the article's.
APART = frozenset("head nav footer aside form menu dialog button select label fieldset legend".split())
#: Words of class, id and role that say the same, alone or with words for places and boxes.
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination footer masthead cookie cookies consent "
    "notice notices alert popup modal overlay newsletter subscribe signup login share sharing social "
    "related recommended comment comments reply replies disqus respond widget toolbar complementary "
    "contentinfo search skip".split())
PLACE_WORDS = frozenset(
    "box block bar area container wrapper wrap inner outer holder panel link links item items button buttons "
    "icon icons form section content body top bottom left right main primary secondary site page post posts "
    "article articles entry".split())
#: Elements whose ids are names to link to, often made from a heading.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_63 = (1 << 63) - 1
#: Elements that say what the article is.
ARTICLE = ("article", "main")
#: Parts of a table end parts of their kind that are open in it: (ended, not beyond).
ENDS = {"td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
        "tr": (("tr", "td", "th"), ("table",)), "thead": (("thead", "tbody", "tr", "td", "th"), ("table",)),
        "tbody": (("thead", "tbody", "tr", "td", "th"), ("table",))}


@dataclass(slots=True)
class Element:
    """An element with its surroundings: what is said of those holds of it too."""

    path: int
    around: Element | None
    depth: int
    apart: bool
    #: Whether it says it is the article, and whether it or one around it does.
    article: bool
    in_article: bool
    in_slot: bool


def _pieces(page: str) -> Iterator[re.Match]:
    """Matches of ``_TOKEN``; a tag that never ends fails once, not again at each ``<`` in it."""
    last, dead, at = page.rfind(">"), 0, 0
    while at < len(page):
        if page[at] == "<" and not page.startswith(("<!", "<?"), at) and (
                at > last or (at < dead and not _RAW.match(page, at))):
            piece = _LESS.match(page, at)
        else:
            piece = _TOKEN.match(page, at)
            if piece[0] == "<" and _NAME.match(page, at):
                quote = _QUOTE.search(page, at)
                dead = quote.start() if quote else len(page)
        yield piece
        at = piece.end()


_LESS = re.compile("()<")


def _apart(name: str, tag: str, inside_article: bool) -> bool:
    if name in APART or (name == "header" and not inside_article):
        return True
    if name in ("html", "body") or name in ARTICLE:
        return False
    linked = name in HEADINGS or (name == "section" and inside_article)
    for mark in _MARK.finditer(tag):
        if linked and mark[1].lower() == "id":
            continue
        if any(map(_says_apart, (mark[2] or mark[3] or mark[4] or "").lower().split())):
            return True
    return False


def _says_apart(word: str) -> bool:
    """Whether a class, id or role as a whole says so: "ad-box", but not "share-prices"."""
    parts = {p for p in _PART.findall(word) if not p.isdigit()}
    return not APART_WORDS.isdisjoint(parts) and parts <= APART_WORDS | PLACE_WORDS


def _label(name: str, tag: str) -> str:
    marks = [(m[2] or m[3] or m[4] or "").lower() for m in _MARK.finditer(tag) if m[1].lower() != "id"]
    return name + "." + ".".join(marks) if marks else name


class _Open:
    """The open elements, and where each name stands among them."""

    def __init__(self, root: Element):
        self.names, self.elements, self.places = [""], [root], {}

    def put(self, name: str, element: Element) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)
        self.elements.append(element)

    def last(self, names) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def end(self, at: int) -> None:
        """Close the element at place ``at`` and all in it."""
        for name in self.names[at:]:
            self.places[name].pop()
        del self.names[at:], self.elements[at:]


def walk(page: str, slot: int | None = None) -> Iterator[tuple[str, Element, str]]:
    """What happens in a page: ('open', element, name), ('text', innermost element, text) and
    ('break', innermost element, ''). Time and memory are linear in the page."""
    open_ = _Open(Element(0, None, 0, False, False, False, slot == 0))
    for token in _pieces(page):
        piece = token[0]
        if token[1] or piece.startswith(("<!", "<?")):
            continue
        name = _NAME.match(piece) if piece[0] == "<" else None
        if name is None:
            yield "text", open_.elements[-1], piece
            continue
        name = name[1].lower()
        if name in BLOCK:
            yield "break", open_.elements[-1], ""
        keeps = name in STRUCTURAL or name in APART
        if piece[1] == "/":
            if keeps and (at := open_.last([name])):
                open_.end(at)
            continue
        if name in ENDS:
            ended, within = ENDS[name]
            while (at := open_.last(ended)) > open_.last(within):
                open_.end(at)
        around = open_.elements[-1]
        path = xxhash.xxh64_intdigest(_label(name, piece), around.path) >> 1
        article = name in ARTICLE or _ROLE.search(piece) is not None
        element = Element(path, around, around.depth + 1,
                          around.apart or _apart(name, piece, around.in_article), article,
                          around.in_article or article, around.in_slot or path == slot)
        yield "open", element, name
        if keeps and not piece.endswith("/>"):
            open_.put(name, element)


def tokens(page: str) -> dict[int, list]:
    """Per start-tag token of a page: [occurrences, depth, characters of text in it, sum of
    the hashes of those texts and their places, kind].

    The kind is 1 for an element that says it is the article, -1 for others inside one.
    """
    found: dict[int, list] = {0: [1, 0, 0, 0, 0]}
    parent = {0: 0}
    for kind, e, value in walk(page):
        if kind == "open":
            kind = 1 if e.article else -1 if e.around.in_article else 0
            own = found.setdefault(e.path, [0, e.depth, 0, 0, kind])
            own[0] += 1
            parent[e.path] = e.around.path
        elif kind == "text" and not e.apart:
            value = value.strip()
            if value:
                own = found[e.path]
                own[2] += len(value)
                own[3] += xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"), e.path)
    # A path names its parent's, so what is inside adds up level by level.
    for path in sorted(parent, key=lambda p: -found[p][1])[:-1]:
        around, own = found[parent[path]], found[path]
        around[2] += own[2]
        around[3] += own[3]
    return found


def host_of(url: str | None) -> str:
    """Host of a URL, lower-cased, without user or port."""
    rest = (url or "").partition("://")[2] or (url or "").removeprefix("//")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].rpartition("@")[2].partition(":")[0].lower()


def templates(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """(host, slot): the token whose element is the place of the host's article.

    Tokens are summed per host and token with map-side aggregation, so a host with a third
    of all pages weighs no more than another. Text beside the slot is the same on all
    pages that have it. Hosts have no row whose classes are too small, whose pages with
    the template do not differ, or that have text which differs beside the article or
    main element that holds most of it: there each page's own elements tell.
    """
    source = renamed(pages, key=id_col, url=url_col, html=html_col).withColumn(
        "page", F.xxhash64("key", "url", "html"))

    def work(batch):
        rows = []
        for url, page, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            host = host_of(url)
            found = tokens(text or "")
            whole = found[0][3]
            for token, (n, depth, chars, own, kind) in found.items():
                seen = f"{page}/{n}"
                rows.append((host, token, n, depth, chars,
                             xxhash.xxh64_intdigest(seen, 1) >> 32, xxhash.xxh64_intdigest(seen, 2) >> 32,
                             own & _63, whole - own & _63, kind))
        if rows:
            kinds = (pa.string(), *[pa.int64()] * 9)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)],
                ["host", "token", "n", "depth", "chars", "v1", "v2", "own", "beside", "kind"])

    found = map_slices(source.select("url", "page", "html"), "html",
                       "host string, token bigint, n bigint, depth bigint, chars bigint, "
                       "v1 bigint, v2 bigint, own bigint, beside bigint, kind bigint", work)
    told = settle(found.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("n").alias("n"), F.min("depth").alias("depth"),
        F.sum("chars").alias("chars"), F.sum("v1").alias("v1"),
        F.sum("v2").alias("v2"), F.max("kind").alias("kind"),
        (F.min("own") != F.max("own")).alias("differs"),
        (F.min("beside") == F.max("beside")).alias("same_beside")))
    whole = told.where("token = 0").select("host", F.col("pages").alias("all_pages"),
                                           F.col("chars").alias("all_chars"))
    classes = (told.where("token <> 0").groupBy("host", "pages", "v1", "v2")
               .agg(F.count(F.lit(1)).alias("tokens")).where(f"tokens >= {CLASS_TOKENS}"))
    once = told.where("token <> 0 AND n = pages").join(classes, ["host", "pages", "v1", "v2"])
    holds_all = F.col("differs") & F.col("same_beside")
    return (once.join(whole, "host")
            .where((F.col("pages") >= F.greatest(F.lit(2.0), FREQUENT * F.col("all_pages")))
                   & (F.col("chars") >= MOST_TEXT * F.col("all_chars")) & (F.col("chars") > 0)
                   & (F.col("kind") >= 0) & (holds_all | (F.col("kind") == 1)))
            .groupBy("host").agg(
                F.max_by("token", F.when(holds_all, F.struct("kind", "depth", "token"))).alias("slot"),
                F.max(F.when(holds_all, F.col("kind"))).alias("best"), F.max("kind").alias("marked"))
            .where("best = marked").select("host", "slot"))


def main_text(page: str | None, slot: int | None = None) -> str:
    """Text of the slot, block by block, without what is marked as something else.

    Without a slot, or on a page that lacks it, of its article elements; without those
    either, of the page.
    """
    events = list(walk(page or "", slot))

    def collect(inside):
        blocks, line = [], []
        for kind, around, value in events:
            if kind == "break":
                blocks.append("".join(line))
                line = []
            elif kind == "open":
                continue
            elif not around.apart and inside(around):
                line.append(html.unescape(value))
            elif line and not line[-1].endswith(" "):
                line.append(" ")
        blocks.append("".join(line))
        clean = (_SPACE.sub(" ", b).strip() for b in blocks)
        return "\n".join(b for b in clean if b)

    found = ""
    if slot is not None:
        found = collect(lambda around: around.in_slot)
    if not found:
        found = collect(lambda around: around.in_article)
    return found or collect(lambda around: True)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row (page_id, url, text, n_chars) per row of ``pages``, from the whole html.

    Character references are decoded, white space inside a block becomes one space, blocks are
    trimmed and joined by one line end; nothing else is dropped or cut. A page without text
    has an empty one, as has NULL html. Pages without a URL or host form a host of
    their own. Rows that repeat keep a row each; ids are only carried. An empty table
    gives no rows; other columns are not read.
    """
    slots = settle(templates(pages, id_col, url_col, html_col))
    source = renamed(pages, page_id=id_col, url=url_col, html=html_col)
    kind = source.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, text string, n_chars bigint"
    if fits_broadcast(slots):
        known = dict(map(tuple, slots.collect()))
        shared = pages.sparkSession.sparkContext.broadcast(known)

        def slots_of(batch):
            return [shared.value.get(host_of(u)) for u in batch.column(1).to_pylist()]
    else:
        def with_host(batch):
            hosts = [host_of(u) for u in batch.column(1).to_pylist()]
            return batch.append_column("host", pa.array(hosts, pa.string()))

        named = map_slices(source, "html", f"page_id {kind}, url string, html string, host string", with_host)
        source = named.join(slots, "host", "left").select("page_id", "url", "html", "slot")

        def slots_of(batch):
            return batch.column(3).to_pylist()

    def work(batch):
        texts = [main_text(page, slot) for page, slot in zip(batch.column(2).to_pylist(), slots_of(batch))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_slices(source, "html", schema, work)
