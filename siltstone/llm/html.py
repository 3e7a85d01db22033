"""Main text of web pages by removal of site templates.

Every page is parsed into a tree; each block element has a slot (the chain of names, classes and ids that leads to it)
and a hash of its whole subtree. Spark counts the hashes per host and slot over pages of different content. A slot
whose different subtrees mostly recur on several pages of the host is template, as a menu that has some variants: all
that stands in it is deleted. A container that recurs on ``least_pages`` pages or more is deleted wherever it stands.
Paragraphs that many articles share stay, for most paragraphs of their slot are on one page only.

Hosts with fewer than ``enough_pages`` pages of different content are too small to tell a variant from an article; there
names of elements and classes tell menus, adverts, headers, footers and notices, and the article element what is left.
Reader comments and forms are no template (each page has its own) and go by name everywhere, as do scripts and styles.

Copies of one page count once, so that a page that is often copied is not its host's template.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from siltstone.llm.common import col, cut, free_name, lean, small_enough, texts_of

#: Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes template".split())
HIDDEN = RAW | frozenset("head form button select option svg math canvas object dialog audio video map".split())
FURNITURE = frozenset("nav header footer aside menu".split())
BLOCK = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address hr nav header footer aside form fieldset details summary center menu dialog hgroup search legend".split())
CONTAINER = frozenset("section div ul ol dl table figure nav header footer aside fieldset details blockquote menu".split())
ROOT = frozenset("html body main article".split())
ENDS_P = BLOCK - {"html", "body", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "li", "dt", "dd", "figcaption", "summary", "legend"}
#: Elements that end one another, and those that an end doesn't reach beyond.
GROUPS = (({"p"}, CONTAINER | ROOT | {"form", "li", "td", "th"}), ({"li"}, {"ul", "ol", "menu"}), ({"dt", "dd"}, {"dl"}), ({"td", "th"}, {"tr", "table"}), ({"tr"}, {"table", "tbody", "thead", "tfoot"}), ({"option"}, {"select"}))
#: By name: the groups in which it ends an element, and the groups that it changes the reach of (1 as one of them, 0 as a bar).
ENDS = {n: [k for k, (own, _) in enumerate(GROUPS) if n in own or k == 0 and n in ENDS_P] for n in BLOCK | {"option"}}
REACH = {n: [(k, n in own) for k, (own, bars) in enumerate(GROUPS) if n in own or n in bars] for n in BLOCK | {"option", "select"}}
#: Words in a class, id or role that mark what is not the article: reader comments, and parts of the site.
COMMENTS = frozenset("comment comments disqus replies respond".split())
MARKS = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent notice notices gdpr popup modal newsletter subscribe subscription share sharing social related recommended widget login signup search searchform pagination pager toolbar complementary contentinfo alert".split())

#: Rows that are sent on at once.
ROWS = 10_000
#: How many tags without an end outside of quotes are looked for to a page's end; of more, the first ``>`` ends each.
OPEN_QUOTES = 50
TAG = re.compile(r"""</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?=[a-zA-Z])""", re.S)
QUOTED = re.compile(r"""<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
PLAIN = re.compile(r"<([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
MARKED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")
NO_WORDS: frozenset[str] = frozenset()
SURROGATE = "surrogatepass"


def names_of(attributes: str) -> list[str]:
    """Values of class, id and role."""
    return [(m[2] or m[3] or m[4] or "").lower() for m in MARKED.finditer(attributes)]


def digest(text: str, seed: int = 0) -> int:
    """A signed hash."""
    x = xxhash.xxh64_intdigest(text.encode("utf-8", SURROGATE), seed)
    return x - 2**64 if x >= 2**63 else x


class Element:
    """An open element. ``scopes`` has, per group of elements that end one another, the place of the open one in reach."""

    __slots__ = ("name", "node", "slot", "hidden", "rank", "scopes", "parts", "begin", "holds_root")

    def __init__(self, name: str, node: int, slot: int, hidden: bool, rank: int, scopes: list[int], begin: int):
        self.name, self.node, self.slot, self.hidden, self.rank, self.scopes, self.begin = name, node, slot, hidden, rank, scopes, begin
        self.parts, self.holds_root = [name], False


class Page:
    """Parses a page in time linear in its length. ``blocks`` has the text blocks with the rank of what they stand in (2
    article, 1 main, 0 else), ``subtrees`` the block elements with text: (slot, hash, number, whether a container).

    The elements of the numbers in ``without`` are left out, and what names mark as the site's if ``named``.
    """

    def __init__(self, html: str, without: frozenset[int] = frozenset(), named: bool = False):
        self.without, self.named, self.count, self.opened = without, named, 0, {}
        self.blocks: list[tuple[int, str]] = []
        self.block: list[str] = []
        self.subtrees: list[tuple[int, int, int, bool]] = []
        self.stack = [Element("", -1, 0, False, 0, [0] * len(GROUPS), 0)]
        at = 0
        for begin, end, name, attributes, closing in tokens(html):
            if begin > at:
                self.text(html[at:begin])
            at = end
            if name is None:
                continue
            if closing:
                self.close(name)
            else:
                self.open(name, attributes)
        if at < len(html):
            self.text(html[at:])
        while len(self.stack) > 1:
            self.pop()
        self.flush()

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if top.name in RAW or not raw:
            top.parts.append(raw)
            return
        decoded = unescape(raw) if "&" in raw else raw
        top.parts.append(decoded)
        if not top.hidden:
            self.block.append(decoded)

    def flush(self) -> None:
        if self.block:
            if text := " ".join("".join(self.block).split()):
                self.blocks.append((self.stack[-1].rank, text))
            self.block = []

    def open(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self.flush()
        for k in ENDS.get(name, ()):
            self.cut(self.stack[-1].scopes[k])
        top = self.stack[-1]
        if name in VOID:
            top.parts.append(name)
            if name == "br" and not top.hidden:
                self.block.append(" ")
            return
        marks = names_of(attributes) if attributes else []
        if marks:
            top.parts.append(" ".join(marks))
        words = {w for m in marks for w in WORDS.findall(m)} if marks and name not in ("html", "body") else NO_WORDS
        node, self.count = self.count, self.count + 1
        hidden = top.hidden or name in HIDDEN or node in self.without or not words.isdisjoint(COMMENTS)
        hidden = hidden or self.named and (name in FURNITURE or not words.isdisjoint(MARKS))
        rank = top.rank
        if not hidden and (name in ("article", "main") or "main" in marks):
            rank = max(rank, 2 if name == "article" else 1)
            k = len(self.stack) - 1
            while k >= 0 and not self.stack[k].holds_root:
                self.stack[k].holds_root = True
                k -= 1
        scopes = top.scopes
        if name in REACH:
            scopes = [*scopes]
            for k, own in REACH[name]:
                scopes[k] = len(self.stack) if own else 0
        slot = digest(name + " " + " ".join(marks), top.slot % 2**64)
        self.stack.append(Element(name, node, slot, hidden, rank, scopes, len(self.blocks)))
        self.opened[name] = self.opened.get(name, 0) + 1

    def close(self, name: str) -> None:
        if name in BLOCK:
            self.flush()
        if name == "p":
            self.cut(self.stack[-1].scopes[0])
        elif self.opened.get(name):
            while self.stack[-1].name != name:
                self.pop()
            self.pop()

    def cut(self, at: int) -> None:
        """Ends the element at this place of the stack and all in it; 0 is none."""
        while at and len(self.stack) > at:
            self.pop()

    def pop(self) -> None:
        e = self.stack[-1]
        if e.name in BLOCK:
            self.flush()
        self.stack.pop()
        self.opened[e.name] -= 1
        x = digest("\0".join(e.parts))
        self.stack[-1].parts.append(f"{x:x}")
        if e.name in BLOCK and e.name not in ("html", "body") and len(self.blocks) > e.begin:
            self.subtrees.append((e.slot, x, e.node, e.name in CONTAINER and not e.holds_root))

    def lines(self) -> list[str]:
        """All blocks; of names those of the article, without one of the main element, without that of the page."""
        best = max((r for r, _ in self.blocks), default=0) if self.named else 0
        return [t for r, t in self.blocks if r >= best]

    def content(self) -> int:
        """A hash by which copies of a page are told: of the article's blocks, without an article of those longer than
        the mean (menus have shorter ones); 0 for a page without text."""
        best = max((r for r, _ in self.blocks), default=0)
        mine = [t for r, t in self.blocks if r == best]
        total = sum(map(len, mine))
        return digest("\n".join(t for t in mine if best or len(t) * len(mine) >= total)) if mine else 0


def tokens(html: str) -> Iterator[tuple[int, int, str | None, str, bool]]:
    """Begin, end, name (None for comments and the like), attributes, whether it closes; raw text is skipped whole.
    A tag that doesn't end is text."""
    at, failed, lower = 0, 0, None
    last = html.rfind(">")
    while (m := TAG.search(html, at)) is not None:
        begin, at = m.span()
        if m[1] is not None:
            yield begin, at, m[1].lower(), "", True
            continue
        if at - begin > 1:
            yield begin, at, None, "", False
            continue
        if begin > last:
            return
        m = QUOTED.match(html, begin) if failed < OPEN_QUOTES else None
        if m is None:
            failed += 1
            m = PLAIN.match(html, begin)
        name, at = m[1].lower(), m.end()
        yield begin, at, name, m[2], False
        if name in RAW:
            lower = lower if lower is not None else html.lower()
            if len(lower) != len(html):  # a letter's lower case may be two
                found = re.compile("</" + name, re.I).search(html, at)
                at = found.start() if found else len(html)
            else:
                found = lower.find("</" + name, at)
                at = found if found >= 0 else len(html)


def subtrees(pages: DataFrame, key: str, host: str, html: str) -> DataFrame:
    """Block elements with text of each page: key, host, content (of the page), slot, hash, node, container; and a row
    with slot and hash 0 for the page itself."""
    names = ["key", "host", "content", "slot", "hash", "node", "container"]
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for k, h, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2)), strict=True):
                page = Page(raw)
                content = page.content()
                rows += [(k, h, content, 0, 0, -1, False), *((k, h, content, *s) for s in page.subtrees)]
                if len(rows) >= ROWS:
                    yield packed(rows)
                    rows = []
        if rows:
            yield packed(rows)

    return pages.select(key, host, html).mapInArrow(lean(run), "key long, host long, content long, slot long, hash long, node int, container boolean")


def templates(found: DataFrame, least_pages: int, enough_pages: int, least_share: float) -> tuple[DataFrame, DataFrame]:
    """(host, slot) of hosts with enough pages, of which slot 0 stands for the host itself, and (host, hash) of containers.

    One count per host, slot and subtree over pages of different content; of a frequent host the subtrees spread it.
    """
    counts = cut(found.groupBy("host", "slot", "hash", "content").agg(F.bool_or("container").alias("container")).groupBy("host", "slot", "hash").agg(F.count("*").alias("n"), F.bool_or("container").alias("container")))
    large = counts.where((F.col("slot") == 0) & (F.col("n") >= enough_pages)).select("host")
    slots = counts.where("slot != 0").groupBy("host", "slot").agg(F.sum("n").alias("n"), F.count("*").alias("kinds"), F.count_if(F.col("n") > 1).alias("again"))
    slots = slots.where((F.col("n") >= least_pages) & (F.col("again") >= least_share * F.col("kinds"))).select("host", "slot")
    slots = slots.join(large, "host").unionByName(large.withColumn("slot", F.lit(0).cast("long")))
    return slots, counts.where("container").groupBy("host", "hash").agg(F.sum("n").alias("n")).where(F.col("n") >= least_pages).select("host", "hash")


def extract(pages: DataFrame, url: str = "url", html: str = "html", least_pages: int = 10, enough_pages: int = 150, least_share: float = 0.5, most_broadcast: int = 1_000_000) -> DataFrame:
    """``pages`` with ``text`` (blocks joined by one newline; empty if none) and ``n_chars`` (its code points).

    A slot of a host with ``enough_pages`` is template if it is on ``least_pages`` and ``least_share`` of its different
    subtrees recur. A null html is an empty page; a null URL has the empty host. Pages of equal host and html are
    treated alike, so repeated rows get repeated results; a page is parsed in time linear in its length, however long or
    deep. Columns named text or n_chars are replaced, all others kept; an empty table gives none.
    Up to ``most_broadcast`` elements to delete are broadcast to the rest of the table, more are joined by shuffle.
    """
    pages = pages.drop("text", "n_chars")
    key, drop, owner = (free_name(pages, x) for x in ("__key", "__drop", "__host"))
    named = F.lower(F.regexp_extract(F.coalesce(col(url), F.lit("")), r"://([^/?#]*)", 1))
    keyed = pages.withColumn(owner, F.xxhash64(named)).withColumn(key, F.xxhash64(F.col(owner), col(html)))
    found = cut(subtrees(keyed, key, owner, html))
    slots, containers = templates(found, least_pages, enough_pages, least_share)
    gone = found.join(slots, ["host", "slot"]).select("key", "node").unionByName(found.where("container").join(containers, ["host", "hash"]).select("key", "node"))
    gone = cut(gone.distinct())
    drops = gone.groupBy(F.col("key").alias(key)).agg(F.collect_set("node").alias(drop))
    keyed = keyed.join(F.broadcast(drops) if small_enough(gone, most_broadcast) else drops, key, "left").drop(key, owner)
    where, which, kept = keyed.columns.index(html), keyed.columns.index(drop), [k for k, c in enumerate(keyed.columns) if c != drop]
    names = [keyed.columns[k] for k in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for raw, nodes in zip(texts_of(batch.column(where)), batch.column(which).to_pylist(), strict=True):
                nodes = frozenset(nodes or ())
                texts.append("\n".join(Page(raw, nodes, -1 not in nodes).lines()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*names, "text", "n_chars"])

    return keyed.mapInArrow(lean(run), StructType([*pages.schema.fields, StructField("text", StringType()), StructField("n_chars", LongType())]))
