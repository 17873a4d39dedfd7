"""Main text of web pages by composite text density.

Every element of the page's tree has a density: its characters per tag, lowered
where many of them stand in links. An element's density sum is the sum over its
children; the element with the largest sum holds the article. The least density
on the path from there up to the body is the threshold: below every element that
reaches it, the subtree with the largest sum is text as well. So is, on the way
up to the article, main or body, all that stands beside it and is not mostly links.
"""

import functools
import html
import math
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendlake.llm.common import table

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
CONTAINERS = frozenset("#page html body main article section div center td blockquote form".split())
NOISE_TAGS = RAW | frozenset("head nav header footer aside menu button select input label option dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 legend".split())
#: Words in class, id or role that mark what is no part of an article.
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement adsense banner sponsor sponsored promo promotion sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices alert popup modal overlay "
    "comment comments reply replies disqus respond related recommended share sharing social newsletter subscribe "
    "subscription login signup search toolbar widget pagination pager complementary contentinfo sidebars menus adsbygoogle "
    "masthead widgets popups outbrain taboola".split()
)
#: Words that say where or in what form something stands; beside a noise word they change nothing.
PLACE_WORDS = frozenset(
    "list lists area section body box boxes slot slots bar bars container wrapper wrap item items thread threads site page main "
    "left right top bottom post posts user users reader readers form article entry block blocks inner outer content unit zone "
    "panel module group row column col card cards title heading link links text primary secondary global mobile desktop sticky "
    "fixed button buttons icons holder".split()
)
#: A value that begins with one of these speaks of what is elsewhere.
NEGATIONS = frozenset("no has with without not non".split())
#: Headings of what is no part of an article.
NOISE_HEADING = re.compile(
    r"\W*(\d+\W+)?((reader |user )?comments?|leave a (comment|reply)|join the (conversation|discussion)|related( \w+)?|you (may|might) also like"
    r"|recommended( for you)?|more from .*|share this.*|advertisement|sponsored( content)?|newsletter|sign up.*|subscribe.*)"
    r"(\W*\(?\d+\)?)?\W*", re.I)
#: Opening the first ends an open element of the second kind.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
#: Looking for an element to end stops at these.
BARRIERS = frozenset("html body article section main div table td th ul ol dl blockquote aside form nav header footer".split())

# In a tag, a quoted value may hold ">"; no way of reading it is tried twice.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</[a-zA-Z][^>]*(?:>|\Z)"""
    r"""|<[a-zA-Z](?>=\s*"[^"]*"|=\s*'[^']*'|[^>])*+(?:>|\Z)""", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


def _is_noise_word(word):
    """A noise word, alone or written together with a word for its place."""
    if word in NOISE_WORDS:
        return True
    return any(word[:k] in NOISE_WORDS and word[k:] in PLACE_WORDS or word[:k] in PLACE_WORDS and word[k:] in NOISE_WORDS
               for k in range(2, len(word) - 1))


@functools.lru_cache(100_000)
def _marks(value):
    """Whether a class, id or role says that an element is no part of an article.

    It has a noise word, and its other words only say where or how it stands. A
    value that begins with a negation, or with a word of another kind, does not count.
    """
    words = [w.lower() for w in re.findall("[A-Z]?[a-z]+|[A-Z]+", value)]
    if not words or words[0] in NEGATIONS:
        return False
    noise = [w in PLACE_WORDS or _is_noise_word(w) for w in words]
    return all(noise) and any(w not in PLACE_WORDS for w in words)


def _is_marked(text):
    """Whether class, id or role of a tag mark what is no part of an article."""
    return any(
        a.group(1).lower() in ("class", "id", "role") and any(map(_marks, "".join(g or "" for g in a.groups()[1:]).split()))
        for a in _ATTRIBUTE.finditer(text, _NAME.match(text).end())
    )


class Page:
    """The tree of a page as parallel lists, parents before children, and its pieces of text in page order."""

    def __init__(self, source):
        self.tag, self.parent, self.noise = ["#page"], [-1], [False]
        self.pieces = []  # (node, raw text), or (-1, "") where a block begins or ends
        self._open = [0]
        self._marked, self._endless = [False], set()
        self._read(source)
        self._spread()

    def _read(self, source):
        at, end = 0, len(source)
        while at < end:
            token = _TOKEN.search(source, at)
            stop = token.start() if token else end
            if stop > at:
                self.pieces.append((self._open[-1], source[at:stop]))
            if not token:
                return
            at = token.end()
            if source[stop + 1] in "!?":
                continue
            name = _NAME.match(source, stop).group(1).lower()
            if source[stop + 1] == "/":
                self._close(name)
                continue
            self._start(name, token.group())
            if name in RAW and not (name in ("svg", "math") and token.group().endswith("/>")):
                closing = None if name in self._endless else re.compile(
                    f"</{re.escape(name)}(?=[\\s/>])", re.I).search(source, at)
                if closing:
                    at = closing.start()
                elif name in ("script", "style"):
                    return
                else:  # without an end it holds nothing
                    self._endless.add(name)
                    self._close(name)

    def _start(self, name, text):
        if name == "body" and "body" in self.tag:
            return
        if name in BLOCK:
            self.pieces.append((-1, ""))
            self._end_open({"p"})
        if name in ENDS:
            self._end_open(ENDS[name])
        if name == "br":
            self.pieces.append((self._open[-1], " "))
        up = self._open[-1]
        self.tag.append(name)
        self.parent.append(up)
        self.noise.append(
            self.noise[up] or name in NOISE_TAGS and not (name == "header" and self._inside("article")))
        self._marked.append(name == "form" or name not in ("html", "body", "article", "main") and _is_marked(text))
        if name not in VOID and not (text.endswith("/>") and name not in BLOCK):
            self._open.append(len(self.tag) - 1)

    def _spread(self):
        """Marked elements are noise with all below them.

        A container with most of the page's text is not, unless an article or main
        part has come before it: what follows is then beside it.
        """
        chars, words = [0] * len(self.tag), {}
        for node, raw in self.pieces:
            if node >= 0 and not self.noise[node]:
                text = " ".join(raw.split())
                chars[node] += len(text)
                if self.tag[node] in HEADINGS:
                    words[node] = words.get(node, "") + text
        self._mark_by_heading(words)
        for i in range(len(self.tag) - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
        first = next((i for i in range(len(self.tag)) if self.tag[i] in ("article", "main") and not self.noise[i]
                      and not self._marked[i] and chars[i]), len(self.tag))
        within = [False] * len(self.tag)
        for i in range(1, len(self.tag)):
            up = self.parent[i]
            within[i] = i == first or within[up]
            kept = self.tag[i] in CONTAINERS and 2 * chars[i] > chars[0] and (i < first or within[i])
            self.noise[i] = self.noise[i] or self.noise[up] or self._marked[i] and not kept

    def _mark_by_heading(self, words):
        """A section, list or division that begins with a heading such as "Comments" is marked."""
        started = [False] * len(self.tag)
        for node, raw in self.pieces:
            if node < 0 or self.noise[node] or not raw.strip():
                continue
            path, at = [], node
            while at > 0 and not started[at]:
                started[at] = True
                path.append(at)
                at = self.parent[at]
            heading = next((i for i in path if self.tag[i] in HEADINGS), None)
            if heading is not None and NOISE_HEADING.fullmatch(words.get(heading, "")):
                for i in path:
                    if i != heading and self.tag[i] in ("section", "div", "ul", "ol"):
                        self._marked[i] = True

    def _inside(self, name):
        return any(self.tag[i] == name for i in self._open)

    def _end_open(self, names):
        for k in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[k]]
            if tag in names:
                del self._open[k:]
                return
            if tag in BARRIERS:
                return

    def _close(self, name):
        if name in BLOCK:
            self.pieces.append((-1, ""))
        if name in ("html", "body"):
            return
        for k in range(len(self._open) - 1, 0, -1):
            if self.tag[self._open[k]] == name:
                del self._open[k:]
                return


def densities(page):
    """Composite text density of every node, and the sum over its children."""
    n = len(page.tag)
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[page.parent[i]] or page.tag[i] == "a"
    for node, raw in page.pieces:
        if node >= 0 and not page.noise[node]:
            size = len(" ".join(raw.split()))
            chars[node] += size
            links[node] += size if linked[node] else 0
    for i in range(n - 1, 0, -1):
        if not page.noise[i]:
            up = page.parent[i]
            chars[up] += chars[i]
            links[up] += links[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + (page.tag[i] == "a")
    body = page.tag.index("body") if "body" in page.tag else 0
    share = links[body] / max(1, chars[body])
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if chars[i] and not page.noise[i]:
            c, lc, t, lt = chars[i], max(1, links[i]), max(1, tags[i]), max(1, link_tags[i])
            base = math.log(c / max(1, c - links[i]) * links[i] + share * c + math.e)
            density[i] = c / t * max(0.0, math.log(c / lc * t / lt)) / base
        if i:
            total[page.parent[i]] += density[i]
    page.chars, page.links = chars, links
    return body, density, total


def _mostly_links(chars, links):
    return 2 * links > chars


def surroundings(page, top, body):
    """(nodes that are text with all below them, nodes whose own pieces are) of what stands around node ``top``.

    The outermost article or main around it is text as a whole, unless it is
    mostly links, and ends the way up. In other containers, which may be the
    body, blocks are judged one by one, and running text together with its
    inline elements.
    """
    path = [top]
    while path[-1] != body:
        path.append(page.parent[path[-1]])
    named = [k for k, i in enumerate(path) if page.tag[i] in ("article", "main")]
    path = path[:named[-1] + 1] if named else path
    below = {i: [] for i in path}
    for i in range(body + 1, len(page.tag)):
        if page.parent[i] in below and not page.noise[i]:
            below[page.parent[i]].append(i)
    whole, own = [], []
    for inner, i in zip(path, path[1:]):
        if _mostly_links(page.chars[i], page.links[i]):
            continue
        if page.tag[i] in ("article", "main"):
            whole.append(i)
            continue
        blocks = [j for j in below[i] if page.tag[j] in BLOCK or j == inner]
        inline = [j for j in below[i] if page.tag[j] not in BLOCK and j != inner]
        whole += [j for j in blocks if j != inner and not _mostly_links(page.chars[j], page.links[j])]
        if not _mostly_links(page.chars[i] - sum(page.chars[j] for j in blocks),
                             page.links[i] - sum(page.links[j] for j in blocks)):
            whole += inline
            own.append(i)
    return whole, own


def main_text(source):
    """The article of one page; empty for a null, empty or textless page."""
    if not source:
        return ""
    page = Page(source)
    body, density, total = densities(page)
    n = len(page.tag)
    # Of each subtree, the container with the largest sum, the outermost of equal ones. A paragraph with much of
    # its text in one inline element is no article, so only elements that hold blocks compete.
    sums = [total[i] if page.tag[i] in CONTAINERS else -1.0 for i in range(n)]
    best = list(range(n))
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        if not page.noise[i] and sums[best[i]] > sums[best[up]]:
            best[up] = best[i]
    top = best[body]
    threshold, at = density[top], top
    while at != body and page.parent[at] >= 0:
        at = page.parent[at]
        threshold = min(threshold, density[at])
    chosen = [i == top for i in range(n)]
    for i in range(body, n):
        if density[i] >= threshold and density[i] > 0:
            chosen[best[i]] = True
    whole, own = surroundings(page, top, body)
    for i in whole:
        chosen[i] = True
    kept = [False] * n
    for i in range(n):
        kept[i] = not page.noise[i] and (chosen[i] or i > 0 and kept[page.parent[i]])
    for i in own:
        kept[i] = not page.noise[i]
    blocks, block = [], []
    for node, raw in [*page.pieces, (-1, "")]:
        if node >= 0:
            if kept[node]:
                block.append(html.unescape(raw))  # a reference does not go on in another element
        elif block:
            text = " ".join("".join(block).split())
            if text:
                blocks.append(text)
            block = []
    return "\n\n".join(blocks)


@F.pandas_udf(T.StringType())
def _main_texts(pages: pd.Series) -> pd.Series:
    return pages.map(main_text, na_action=None)


def extract_main_text(pages):
    """``pages(page_id, url, html)`` as page_id, url, ``text`` and ``n_chars`` in code points.

    A null page is empty and has an empty text. Each page stands for itself:
    repeated rows give repeated results, an empty table an empty one. Elements
    that page authors mark as menus, adverts, comments and the like never count,
    nor do forms, unless one holds most of the page's text. Other columns are
    left aside whatever their names; a very long page is one task's work.
    """
    texts = pages.select("page_id", "url", _main_texts("html").alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op3_text_density(spark, sf_dir):
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages"))
