"""The main text of web pages by paths on which the pages of a host agree.

Each page is read into a tree, its containers are scored by the text that they hold outside links and
outside what is no article (menus, forms, notices, comments and so on), and the page votes for the
container that holds nearly all of it. Votes go to generalised paths, tags with classes whose digits
don't count, and Spark counts them by host. Then every page is read again, and the container at its
host's path is taken, so that a page whose own text misleads (a short article beside a long notice)
follows the others. A page without such a container keeps its own choice.

What is left out of the container: elements whose tag, role, class or id says that they are no article.
A header within an article keeps its headings. Forms and layout elements that hold the article stay.

Defined cases: null html is empty and gives an empty text; null urls and urls without a host are one
host; pages of one row vote for themselves; equal votes go to the smaller path; repeated rows stay and
vote as often; very long pages are read whole; unclosed tags end with the element around them, unclosed
comments, scripts and tags with the page; unknown references stay as they are; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read, salted_join

# The tags of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("body div section article main td center fieldset form header".split())
BLOCKS = CONTAINERS | HEADINGS | frozenset(
    "html head address aside blockquote caption dd details dialog dir dl dt figcaption figure footer hr legend li menu nav ol option optgroup p pre search summary table tbody tfoot th thead tr ul".split()
)
#: A start tag ends an open one of these, up to an element of the other set.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"})}
#: Never part of an article.
NO_ARTICLE = frozenset("nav aside footer button select datalist svg canvas object audio video dialog menu search".split())
NO_ROLE = frozenset("navigation banner complementary contentinfo search dialog alertdialog alert menu menubar toolbar form".split())
ARTICLE = frozenset(("article", "main"))

#: Words of class names and ids. The first are never part of an article; the second are layout, unless the article lies inside.
NO_WORD = re.compile(r"ads?|adv|advert\w*|adsense|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notices?|comment\w*|disqus|repl(?:y|ies)|respond|share|sharing|social|related|recommend\w*|newsletter\w*|subscribe|subscription|signup|login|popup|breadcrumbs?|pager|pagination|nav|navbar|navigation|footer|copyright")
LAYOUT_WORD = re.compile(r"header|masthead|sidebars?|side|menu|topbar|toolbar|banner|widgets?|modal|overlay|alert|search|form")
GOOD_WORD = re.compile(r"article|post|entry|story|content|main|text|body")
#: After these a word tells what an element has or lacks, not what it is.
ABOUT = frozenset("has with without no is".split())

TOKEN = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]{0,65536}\"|'[^']{0,65536}')*+(?=>)|[^>]*)(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}

#: Shares of the text: a container of its parent's for the choice to go down to it, and of a host's votes for a path to overrule pages.
NEARLY_ALL, AGREED = 0.97, 0.5
FAVOUR = {"article": 1.5, "main": 1.3}
GOOD_FAVOUR = 1.15
#: Bytes of hosts and paths that may be broadcast.
BROADCAST_BYTES = 8 << 20

#: What an element is: usual, no article, layout, or a header.
USUAL, NO, LAYOUT, HEADER = range(4)


@lru_cache(maxsize=1 << 14)
def _described(tag: str, attributes: str) -> tuple[str, int, bool, bool]:
    """(label in paths, kind, whether its names speak for an article, whether it is one) of an element."""
    values = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
    classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in values.get("class", "").split()})
    label = ".".join([tag, *classes])
    role = values.get("role", "").strip().lower()
    words = [w.lower() for name in (*values.get("class", "").split(), values.get("id", "")) for w in ("", *NAME.findall(name))]
    told = [w for before, w in zip(["", *words], words) if before not in ABOUT]
    is_article = tag in ARTICLE or role in ARTICLE
    if tag in NO_ARTICLE or role in NO_ROLE or any(NO_WORD.fullmatch(w) for w in told if w) and tag not in ("html", "body"):
        kind = NO
    elif tag in ("html", "body") or is_article:
        kind = USUAL
    elif tag == "header" or any(w == "header" for w in told):
        kind = HEADER
    else:
        kind = LAYOUT if tag == "form" or any(LAYOUT_WORD.fullmatch(w) for w in told if w) else USUAL
    return label, kind, any(GOOD_WORD.fullmatch(w) for w in told if w), is_article


class Page:
    """The elements of a page in the order of their start tags, and its pieces of text."""

    def __init__(self, html: str) -> None:
        self.tag, self.attributes, self.parent, self.last = [""], [""], [-1], [0]
        self.pieces: list[tuple[int, int, str]] = []  # element, number of the block, text
        self._read(html)
        self._judge()

    def _read(self, html: str) -> None:
        stack, count, block, at = [0], {}, 0, 0
        end = len(html)

        def close(k: int) -> None:
            while len(stack) > k:
                x = stack.pop()
                self.last[x] = len(self.tag) - 1
                count[self.tag[x]] -= 1

        def close_within(names: frozenset | set, limits: frozenset | set) -> None:
            if any(count.get(n) for n in names):
                for k in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[k]] in names:
                        return close(k)
                    if self.tag[stack[k]] in limits:
                        return

        while at < end:
            m = TOKEN.search(html, at)
            text = html[at : m.start() if m else end]
            if text:
                self.pieces.append((stack[-1], block, text))
            if not m:
                break
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if tag in RAW:
                if not m[1]:
                    stop = RAW_END[tag].search(html, at)
                    at = stop.end() if stop else end
                continue
            if tag in BLOCKS or tag == "br":
                block += tag != "br"
                if tag == "br":
                    self.pieces.append((stack[-1], block, " "))
            if m[1]:
                if count.get(tag) and tag not in ("html", "body"):
                    close_within({tag}, frozenset() if tag in BLOCKS else BLOCKS)
                continue
            if tag in BLOCKS:
                close_within({"p"}, BLOCKS - {"p"})
                if tag in ENDS:
                    close_within(*ENDS[tag])
            if tag in VOID or tag in ("html", "body") and count.get(tag):
                continue
            self.tag.append(tag)
            self.attributes.append(m[3])
            self.parent.append(stack[-1])
            self.last.append(0)
            stack.append(len(self.tag) - 1)
            count[tag] = count.get(tag, 0) + 1
        count[""] = 1
        close(0)

    def _judge(self) -> None:
        n = len(self.tag)
        told = [_described(t, a) for t, a in zip(self.tag, self.attributes)]
        self.good, self.is_article = [x[2] for x in told], [x[3] for x in told]
        holds = [False] * n  # an article that isn't itself left out
        for x in range(n - 1, 0, -1):
            if (self.is_article[x] and told[x][1] != NO) or (holds[x] and told[x][1] != NO):
                holds[self.parent[x]] = True
        inside, left, heading, linked = [False] * n, [False] * n, [False] * n, [False] * n
        header = [False] * n
        for x in range(1, n):
            up, kind = self.parent[x], told[x][1]
            inside[x] = inside[up] or self.is_article[x] or self.good[x]
            heading[x] = heading[up] or self.tag[x] in HEADINGS
            linked[x] = linked[up] or self.tag[x] == "a"
            header[x] = header[up] or kind == HEADER and not holds[x] and inside[up]
            left[x] = left[up] or kind == NO or not holds[x] and (kind == LAYOUT or kind == HEADER and not inside[up])
        self.kept = [p for p in self.pieces if not left[p[0]] and (not header[p[0]] or heading[p[0]])]
        # a container's score: characters outside links, half of them if no paragraph holds them
        container, loose, score, first = [0] * n, [True] * n, [0.0] * n, [0] * n
        for x in range(1, n):
            own = self.tag[x] in CONTAINERS
            container[x] = x if own else container[self.parent[x]]
            loose[x] = own or loose[self.parent[x]] and self.tag[x] not in BLOCKS
        for x, _, text in self.kept:
            size = len(text) if not text.isspace() else 0
            score[container[x]] += size * (0.05 if linked[x] else 1.0) * (0.5 if loose[x] else 1.0)
        for x in range(1, n):
            if self.tag[x] == "h1" and not left[x]:
                first[container[x]] += 1
        self.children: list[list[int]] = [[] for _ in range(n)]
        for x in range(n - 1, 0, -1):
            if container[x] == x:
                up = container[self.parent[x]]
                score[up] += score[x]
                first[up] += first[x]
                self.children[up].append(x)
        self.container, self.score, self.first, self.told = container, score, first, told

    def path(self, x: int) -> str:
        out = []
        while x > 0:
            out.append(self.told[x][0])
            x = self.parent[x]
        return "/".join(reversed(out))

    def choice(self) -> int:
        """The container that holds nearly all of the text: from the page down to an article, or as far as little is lost and no title."""
        x = 0
        while not self.is_article[x] or self.tag[x] == "main":
            favour = lambda c: self.score[c] * FAVOUR.get(self.tag[c], GOOD_FAVOUR if self.good[c] else 1.0)
            best = max(self.children[x], key=lambda c: (favour(c), -c), default=0)
            if not best or not self.score[best] or favour(best) < NEARLY_ALL * self.score[x] or self.first[best] < self.first[x] and not self.is_article[best]:
                break
            x = best
        return x

    def at(self, path: str) -> int | None:
        """The container at a path, the one of the highest score if there are several."""
        label = path.rpartition("/")[2]
        found = [x for x in range(1, len(self.tag)) if self.container[x] == x and self.told[x][0] == label and self.score[x] and self.path(x) == path]
        return max(found, key=lambda x: (self.score[x], -x), default=None)

    def text(self, x: int) -> str:
        """The kept text in an element: blocks by one space, white space in a block as one space."""
        blocks: dict[int, list[str]] = {}
        for at, block, text in self.kept:
            if x <= at <= self.last[x]:
                blocks.setdefault(block, []).append(unescape(text) if "&" in text else text)
        return " ".join(filter(None, (" ".join("".join(b).split()) for b in blocks.values())))


def extract(html: str, path: str | None = None, agreed: bool = False) -> str:
    """The main text of a page; path: of its host, agreed: whether most pages of the host voted for it."""
    page = Page(html)
    own = page.choice()
    other = page.at(path) if path else None
    if other is not None and other != own:
        above = other <= own <= page.last[other]
        if (agreed or 2 * page.score[other] >= page.score[own]) and not (above and page.is_article[own] and not page.is_article[other]):
            own = other
    return page.text(own)


def vote(html: str) -> str:
    """The path of a page's own choice; none for a page without text."""
    page = Page(html)
    x = page.choice()
    return page.path(x) if page.score[x] else ""


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, agreed) for every host of pages (url, html); an empty path if no page of it has text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [vote(h.as_py() or "") for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.string())], ["host", "path"])

    votes = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    # of equal votes the smaller path: a maximum over the votes, then a minimum over the paths
    most = votes.groupBy("host").agg(F.max(F.when(F.col("path") != "", F.col("n"))).alias("most"), F.sum("n").alias("all"))
    won = F.min(F.when((F.col("path") != "") & (F.col("n") == F.col("most")), F.col("path")))
    found = votes.join(most, "host").groupBy("host").agg(F.coalesce(won, F.lit("")).alias("path"), F.coalesce(F.first("most") >= AGREED * F.first("all"), F.lit(False)).alias("agreed"))
    return cut(found, "host-paths")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    paths = host_paths(pages)
    size = paths.agg(F.sum(F.octet_length("host") + F.octet_length("path"))).first()[0] or 0
    hosted = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    if size <= BROADCAST_BYTES:
        asked = hosted.join(F.broadcast(paths), "host")
    else:
        asked = salted_join(hosted.withColumn("__spread", F.xxhash64("page_id", "url")), paths, "host", "__spread")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py() or "", p, a) for h, p, a in zip(batch.column("html"), batch.column("path").to_pylist(), batch.column("agreed").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = dict(pages.dtypes)
    return asked.select("page_id", "url", "html", "path", "agreed").mapInArrow(run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read(spark, sf_dir, "pages"))
