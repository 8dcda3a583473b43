"""HTML extraction with consensus host paths.

1. Every page is read into elements and text pieces.  A container, or the page itself
   for what stands outside of all, earns the text of the blocks it holds directly, half
   of what its children hold, and nothing for text in links or in furniture (menus,
   headers, footers, sidebars, notices, adverts, forms, comments).  ``article`` and
   ``main`` earn what they hold at any depth.
2. Each page votes, with its containers' shares of its text, for their generalised
   paths: tags and classes from the root, numbers written as ``#``, as a digest that
   goes on from the parent's, so that deep nesting costs no more.  Spark adds the
   votes up per host and path with partial sums, so a host holding a third of all
   pages is a few rows per task, and takes each host's winner.
3. The pages are read again and the text of every container with the winning path is
   taken, in page order, so an article spread over such containers stays whole.  Where
   the page lacks that path, its own best container's path takes its place.

Text: character references are decoded, white space in a block becomes one space,
blocks follow in page order with one line end between, and furniture is left out.
``br`` is white space.

Defined results: null or empty html, and pages without text outside furniture, give
the empty text; broken markup is closed where a browser would close it for ``p``,
``li``, ``td`` and the like, and else at the end; a url without a host belongs to the
host ''; rows repeating a page are each extracted; an empty table gives an empty
result; extra columns pass through ``extract``, but one named like its result is replaced; pages of any length are read whole.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarmac.llm.common import map_arrow, others, saved, small_side, table, unused

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NUMBER = re.compile(r"\d+")
WORD_CUT = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DEEP = {"article": 1.25, "main": 1.1}  # earn so much of what they hold at any depth
RAW = set("script style textarea title noscript template svg iframe object select math".split())
BLOCK = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody
td tfoot th thead tr ul""".split())
FURNITURE = set("nav aside footer form button dialog menu label input select head".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Words of class and id names of furniture; they count first or last in a name.
NAMES = set("""ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion
menu nav navbar navigation breadcrumb breadcrumbs toolbar topbar footer sidebar aside widget widgets cookie cookies
consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social related
recommended recommendations comment comments disqus respond reply replies pagination pager skip search form
copyright""".split())
HEADERS = set("header masthead topper".split())
NOT_NAMES = set("has with no without is".split())
KEEP = set("html body main article".split())
# An opening tag of the key closes open elements of the values.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
STOPS = set("ul ol dl table article section div main body aside nav header footer form blockquote".split())


class Page:
    """Elements in page order, and text pieces with the element each stands in."""

    def __init__(self, source: str):
        self.parent, self.tag, self.path, self.bad, self.end = [-1], [""], [b""], [False], [0]
        self.link, self.inside, self.block, self.depth = [False], [False], [0], [0]
        self._open_tags: Counter = Counter()
        self.pieces: list = []   # (element, text), or None at a block's edge
        self._read(source)

    def _read(self, source: str) -> None:
        stack, at, low = [0], 0, None
        for m in TOKEN.finditer(source):
            if m.start() < at:
                continue
            if m.start() > at:
                self.pieces.append((stack[-1], source[at:m.start()]))
            at = m.end()
            tag = m.group(2)
            if tag is None:
                continue
            tag = tag.lower()
            if m.group(1):
                self._close(stack, tag)
                continue
            if tag in BLOCK:
                self._implied(stack, {"p"}, STOPS - {"div"} | {"td", "li"})
            if tag in CLOSES:
                self._implied(stack, CLOSES[tag], {"ul", "ol", "dl", "table"})
            if tag == "br":
                self.pieces.append((stack[-1], " "))
            if tag in VOID:
                if tag in BLOCK:
                    self.pieces.append(None)
                continue
            if tag in RAW:
                low = source.lower() if low is None else low
                close = low.find(f"</{tag}", at)
                stop = source.find(">", close) if close >= 0 else -1
                at = stop + 1 if stop >= 0 else len(source)
                continue
            self._open(stack, tag, m.group(3))
        if at < len(source):
            self.pieces.append((stack[-1], source[at:]))
        while stack:
            self.end[stack.pop()] = len(self.tag)
        self._open_tags.clear()

    def _open(self, stack: list, tag: str, text: str) -> None:
        up = stack[-1]
        given = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(text)} if "=" in text or text.strip() else {}
        classes = given.get("class", "").split()
        name = tag + "".join("." + NUMBER.sub("#", c) for c in sorted(set(classes)))
        bad = self.bad[up] or self._furniture(tag, classes, given, self.inside[up])
        self.parent.append(up)
        self.tag.append(tag)
        self.path.append(blake2b(self.path[up] + name.encode("utf-8", "surrogatepass"), digest_size=16).digest())
        self.block.append(len(self.tag) - 1 if tag in BLOCK else self.block[up])
        self.depth.append(self.depth[up] + 1)
        self._open_tags[tag] += 1
        self.bad.append(bad)
        self.link.append(self.link[up] or tag == "a")
        self.inside.append(self.inside[up] or tag in ("article", "main"))
        self.end.append(0)
        stack.append(len(self.tag) - 1)
        if tag in BLOCK:
            self.pieces.append(None)

    @staticmethod
    def _furniture(tag: str, classes: list, given: dict, inside: bool) -> bool:
        if tag in FURNITURE or tag == "header" and not inside or given.get("role", "").lower() in ROLES:
            return True
        if "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get(
                "style", "").replace(" ", "").lower():
            return True
        if tag in KEEP and tag != "article":
            return False
        for name in [*classes, given.get("id", "")]:
            words = [w for w in WORD_CUT.split(NUMBER.sub("", name)) if w]
            if words and words[0].lower() not in NOT_NAMES:
                ends = {words[0].lower(), words[-1].lower()}
                if ends & NAMES or not inside and ends & HEADERS:
                    return True
        return False

    def _pop(self, stack: list) -> None:
        node = stack.pop()
        self.end[node] = len(self.tag)
        self._open_tags[self.tag[node]] -= 1
        if self.tag[node] in BLOCK:
            self.pieces.append(None)

    def _close(self, stack: list, tag: str) -> None:
        walk = self._open_tags[tag] or tag == "p" and (self._open_tags["table"] or self._open_tags["body"])
        for i in range(len(stack) - 1, 0, -1) if walk else ():
            if self.tag[stack[i]] == tag:
                while len(stack) > i:
                    self._pop(stack)
                return
            if self.tag[stack[i]] in ("table", "body") and tag not in ("html", "body", "table"):
                return
        if tag == "p":
            self.pieces.append(None)

    def _implied(self, stack: list, tags: set, stops: set) -> None:
        if not any(self._open_tags[t] for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if self.tag[stack[i]] in tags:
                while len(stack) > i:
                    self._pop(stack)
                return
            if self.tag[stack[i]] in stops:
                return

    def scores(self) -> dict:
        """Share of the page's text that each container earns; 0 is the page."""
        holds = [0.0] * len(self.tag)
        below = [0] * len(self.tag)
        for piece in self.pieces:
            if piece is None or self.bad[piece[0]] or self.link[piece[0]]:
                continue
            n = len(piece[1].strip())
            if not n:
                continue
            node = self.block[piece[0]]
            # a paragraph, heading, item or cell speaks for the element around it
            if node and self.tag[node] not in ("div", "section", "article", "main", "body"):
                node = self.parent[node]
            holds[node] += n
            below[node] += n
            if node:
                holds[self.parent[node]] += n / 2
        for node in range(len(self.tag) - 1, 0, -1):  # children come after their parents
            below[self.parent[node]] += below[node]
            if self.tag[node] in DEEP:
                holds[node] = max(holds[node], below[node] * DEEP[self.tag[node]])
        return {i: h / below[0] for i, h in enumerate(holds) if h}

    def best(self, path: bytes | None) -> list[int]:
        """The containers of ``path``, else those of the path whose container earns most; 0 is the page."""
        scores = self.scores()
        if not any(self.path[i] == path for i in scores):
            path = self.path[max(scores, key=lambda i: (scores[i], -i))] if scores else b""
        return [i for i, p in enumerate(self.path) if p == path]

    def text(self, nodes: list[int]) -> str:
        """Text of the containers, none of which holds another; each starts a block."""
        within = [-1] * len(self.tag)
        for node in nodes:
            within[node:self.end[node]] = [node] * (self.end[node] - node)
        blocks, block, last = [], [], -1
        for piece in [*self.pieces, None]:
            node = -1 if piece is None else within[piece[0]]
            if block and (piece is None or node >= 0 and node != last):
                text = " ".join(entities.unescape("".join(block)).split())
                if text:
                    blocks.append(text)
                block = []
            if node >= 0:
                last = node
                if not self.bad[piece[0]]:
                    block.append(piece[1])
        return "\n".join(blocks)


def _votes(batches):
    for batch in batches:
        hosts, paths, depths, votes = [], [], [], []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(source or "")
            for node, share in page.scores().items():
                hosts.append(host)
                paths.append(page.path[node])
                depths.append(page.depth[node])
                votes.append(share)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.binary()),
                                          pa.array(depths, pa.int32()), pa.array(votes, pa.float64())],
                                         ["host", "path", "depth", "vote"])


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, path): the path with most votes of each host; ties to the less deep, then greater digest."""
    each = map_arrow(pages.select(host_of(pages[url_col]).alias("host"), pages[html_col].alias("html")),
                     _votes, "host string, path binary, depth int, vote double")
    # votes in whole millionths, so that their sum does not depend on the order of adding
    summed = each.groupBy("host", "path", "depth").agg(F.sum(F.round(F.col("vote") * 1e6).cast("long")).alias("votes"))
    top = F.max(F.struct("votes", (-F.col("depth")).alias("short"), "path"))
    return summed.groupBy("host").agg(top.alias("top")).select("host", F.col("top.path").alias("path"))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of every page; a column named ``out``, in any case, gives way to it."""
    names = others(pages, out)
    paths = small_side(saved(host_paths(pages, url_col, html_col), "host-paths"))
    own = unused(pages, "winning_path")
    rows = pages.join(paths, host_of(pages[url_col]) == paths["host"], "left").select(
        *[pages[c] for c in names], paths["path"].alias(own))
    kind = pages.select(*names).withColumn(out, F.lit("").cast("string")).schema

    def run(batches):
        for batch in batches:
            texts = []
            for source, path in zip(batch.column(html_col).to_pylist(), batch.column(own).to_pylist()):
                page = Page(source or "")
                texts.append(page.text(page.best(path)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(texts, pa.string())],
                                             [*names, out])

    return map_arrow(rows, run, kind)


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
