"""Main text of web pages by composite text density.

Every node of a page's tree gets its link-adjusted characters per tag: characters over tags,
scaled down where much of the text stands in links compared with the page as a whole. A node's
density sum is that of its children. The node with the largest density sum is the core of the
article; the least density on the path from ``body`` to it is the threshold. Around the core,
siblings along the path belong to the article where they reach the threshold and are flow text
or look like the path's own node (same tag and class). An ``article`` or ``main`` element around the
core bounds the search: inside an ``article`` everything belongs to it but lists and boxes below the
threshold whose text is mostly links; outside of it other ``article`` elements do that reach the
threshold, anywhere in the same ``main`` or beside the first. In a ``main`` without an ``article`` the core
and what stands around it are taken as on other pages, and headings and paragraphs beside the path. Menus, adverts, forms, comments and
the like are recognised by element, role and by words of ``class`` and ``id``; they count neither
for densities nor for the text. A form that holds an ``article`` or ``main`` or most of the page's
text, and a part with a suspicious name that holds most of the text and its main heading, are only
wrappers. Names of headings, and ids of sections in an article that may be their titles, say nothing.

Blocks are runs of text between block-level tags, with white space as one blank; ``br`` is white
space. They are joined by two line ends. A null or empty page, or one without text, gives an
empty text. Broken markup is read as far as it goes: missing end tags are implied, unmatched ones
ignored. Whole pages of any size and depth are read without recursion. Null ids and repeated rows
are carried; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from logrisk.llm.rows import map_rows

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
_FLOW = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure section".split())
#: Flow text that may be short without being a box of its own.
_PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure".split())
#: Elements that never hold article text.
_NOISE = frozenset(
    "head title script style noscript template iframe object embed svg canvas audio video map math form button input"
    " select textarea datalist fieldset dialog menu nav footer aside".split()
)
_NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
#: Words of class and id that name a part which is not the article.
_NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner banners"
    " cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay newsletter"
    " subscribe subscription signup signin login register sidebar sidebars aside menu menus nav navbar navigation"
    " breadcrumb breadcrumbs footer masthead topbar toolbar pagination pager share sharing social related recommended"
    " recommendations widget widgets comment comments commentlist respond reply replies disqus discussion search"
    " copyright skip".split()
)
#: The words that count in the id of a section of an article; others may be its title.
_APART_WORDS = frozenset(
    "ad ads adv advert adverts advertisement adsense newsletter comment comments commentlist respond reply replies"
    " disqus".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Noise that may be the wrapper of a whole page.
_WRAPPERS = frozenset("form fieldset".split())
#: Parts of an article that are left out where they are lists of links.
_LINK_LISTS = frozenset("ul ol dl div section table".split())
_KEPT = frozenset("html body article main".split())
#: Comments, ended or not, outside of scripts and styles.
_COMMENTS = re.compile(r"<(script|style)\b.*?</\1|<!--.*?-->|<!--", re.S | re.I)
#: The logarithm's base tends to 1 on a page without links; its own logarithm stays above this.
_LEAST_BASE = 0.01
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Open elements that a start tag closes, and the elements that stop the search for them.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
_BOUNDS = frozenset("table td th caption button object body html".split())


class Page(HTMLParser):
    """A page's nodes in document order and its pieces of text."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.look, self.noise = ["#page"], [-1], [""], [""]
        self.pieces: list[tuple[int, int, str]] = []  # node, block, text
        self.open, self.opened, self.block = [0], Counter(), 0
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _CLOSES:
            self._close_implied(*_CLOSES[tag])
        elif tag not in _INLINE:
            self._close_implied({"p"}, _BOUNDS)
        if tag not in _INLINE:
            self.block += 1
        elif tag == "br":
            self.pieces.append((self.open[-1], self.block, " "))
            return
        values = {name: value or "" for name, value in attrs}
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        self.look.append(f"{tag} {values.get('class', '')}")
        self.noise.append(self._is_noise(tag, values))
        if tag not in _VOID:
            self.open.append(node)
            self.opened[tag] += 1

    def _close(self, depth: int) -> None:
        self.opened.subtract(self.tag[node] for node in self.open[depth:])
        del self.open[depth:]

    def _is_noise(self, tag: str, values: dict) -> str:
        """Why an element is noise: by what it ``is``, as ``hidden``, as a ``form``, by its ``role`` or
        its ``name``; empty for others."""
        if tag in _WRAPPERS or values.get("role", "").lower() == "form":
            kind = "form"
        else:
            kind = "is" if tag in _NOISE else ""
        if kind == "is":
            return kind
        if "hidden" in values or values.get("aria-hidden") == "true":
            return "hidden"
        if "display:none" in values.get("style", "").replace(" ", "").lower():
            return "hidden"
        if kind:
            return kind
        if tag == "header":
            return "" if self.opened["article"] or self.opened["main"] else "hidden"
        if values.get("role", "").lower() in _NOISE_ROLES:
            return "role"
        if tag in _KEPT or tag in _HEADINGS:
            return ""
        words = self._words(values.get("class", ""))
        ids = self._words(values.get("id", ""))
        if tag == "section" and self.opened["article"]:
            ids &= _APART_WORDS
        return "name" if (words | ids) & _NOISE_WORDS else ""

    @staticmethod
    def _words(name: str) -> set[str]:
        return {word.lower() for word in _WORDS.findall(name)}

    def _close_implied(self, tags: set, stops: set) -> None:
        if not any(self.opened[tag] for tag in tags):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[depth]]
            if name in tags:
                self._close(depth)
                self.block += 1
                if tags == {"p"} or len(tags) == 1:
                    return
                return self._close_implied(tags, stops)
            if name in stops:
                return

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag not in _INLINE:
            self.block += 1
        if not self.opened[tag]:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[depth]] == tag:
                self._close(depth)
                return
            if tag in _INLINE and self.tag[self.open[depth]] not in _INLINE:
                return

    def handle_data(self, data: str) -> None:
        self.pieces.append((self.open[-1], self.block, data))


def _settle_noise(page: Page) -> list[bool]:
    """Noise passed on to all descendants, unless it is a mere wrapper. An element with a suspicious
    name or role, or a form, does not hide an ``article`` or ``main``; nor does a form hide most of
    the page's text, nor a name most of the text with its main heading."""
    n = len(page.tag)
    holds, titled, size = [False] * n, [False] * n, [0] * n
    for node, _, text in page.pieces:
        size[node] += len("".join(text.split()))
    hidden = [False] * n
    for i in range(1, n):
        hidden[i] = page.noise[i] in ("is", "hidden") or hidden[page.parent[i]]
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        holds[up] |= holds[i] or page.tag[i] in ("article", "main")
        if not hidden[i]:
            titled[up] |= titled[i] or page.tag[i] == "h1"
            size[up] += size[i]
    noise = [False] * n
    for i in range(1, n):
        kind, most = page.noise[i], 2 * size[i] > size[0]
        wrapper = holds[i] or most and (kind == "form" or kind == "name" and titled[i])
        noise[i] = bool(kind) and not (wrapper and kind != "is") or noise[page.parent[i]]
    return noise


def densities(page: Page, noise: list[bool]) -> tuple[list[float], list[bool]]:
    """Composite text density of every node, 0 for noise, and whether most of its text is links."""
    n = len(page.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = page.tag[i] == "a" or in_link[page.parent[i]]
    for node, _, text in page.pieces:
        if not noise[node]:
            size = len("".join(text.split()))
            chars[node] += size
            link_chars[node] += size * in_link[node]
    for i in range(n - 1, 0, -1):
        if not noise[i]:
            up = page.parent[i]
            chars[up] += chars[i]
            link_chars[up] += link_chars[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i] + in_link[i]
    share = link_chars[0] / max(1, chars[0])
    out = [0.0] * n
    for i in range(n):
        if noise[i] or not chars[i]:
            continue
        c, t, lc, lt = chars[i], max(1, tags[i]), max(1, link_chars[i]), max(1, link_tags[i])
        base = math.log(c / max(1, c - link_chars[i]) * link_chars[i] + share * c + math.e)
        out[i] = c / t * math.log(max(1.0, c / lc * t / lt)) / max(_LEAST_BASE, math.log(base))
    return out, [2 * lc > c and lt > 1 for c, lc, lt in zip(chars, link_chars, link_tags)]


def main_text(html: str | None) -> str:
    """The article of a page, blocks joined by two line ends."""
    if not html:
        return ""
    if html.rfind("<!--") > html.rfind("-->"):
        open_comment = (m.start() for m in _COMMENTS.finditer(html) if m[0] == "<!--")
        html = html[: next(open_comment, len(html))]
    page = Page(html)
    noise = _settle_noise(page)
    if not any(not noise[node] and text.strip() for node, _, text in page.pieces):
        return ""
    inside = _article(page, noise, *densities(page, noise))
    blocks: list[str] = []
    current, parts = None, []
    for node, block, text in [*page.pieces, (0, None, "")]:
        if block != current:
            blocks.append(" ".join("".join(parts).split()))
            current, parts = block, []
        if inside[node] and not noise[node]:
            parts.append(text)
    return "\n\n".join(block for block in blocks if block)


def _article(page: Page, noise: list[bool], density: list[float], links: list[bool]) -> list[bool]:
    """Which nodes belong to the article."""
    n = len(page.tag)
    sums = [0.0] * n
    for i in range(1, n):
        sums[page.parent[i]] += density[i]
    core = max((i for i in range(n) if not noise[i]), key=lambda i: (sums[i], density[i], -i))
    path = [core]
    while path[-1]:
        path.append(page.parent[path[-1]])
    threshold = min(density[i] for i in path)
    frame = [i for i in path if page.tag[i] in ("article", "main")]
    bare = None if not frame or any(page.tag[i] == "article" for i in frame) else frame[-1]
    if bare is not None:
        path, frame = path[: path.index(bare) + 1], []
        threshold = min(density[i] for i in path)
    root, dropped, on_path = [False] * n, [False] * n, set(path)
    if frame:
        first = frame[0] if page.tag[frame[0]] == "article" else frame[-1]
        bound = next((i for i in reversed(frame) if page.tag[i] == "main"), None)
        root[first] = True
        within = [False] * n
        for i in range(1, n):
            up = page.parent[i]
            within[i] = up == bound or within[up]
            if page.tag[i] == "article" and not noise[i] and i not in on_path and density[i] >= threshold:
                root[i] = within[i] if bound is not None else up == page.parent[first]
            listed = page.tag[i] in _LINK_LISTS and i not in on_path and links[i]
            dropped[i] = dropped[up] or listed and density[i] < threshold
    else:
        root[core] = True
        step = {up: child for child, up in zip(path, path[1:])}
        for i in range(1, n):
            beside = step.get(page.parent[i])
            listed = bare is not None and page.tag[i] in _LINK_LISTS and i not in on_path and links[i]
            dropped[i] = dropped[page.parent[i]] or listed and density[i] < threshold
            if beside is None or i in on_path or noise[i] or not density[i]:
                continue
            if density[i] < threshold:
                root[i] = bare is not None and page.tag[i] in _PLAIN and not links[i]
            else:
                root[i] = page.tag[i] in _FLOW or page.look[i] == page.look[beside]
    inside = root[:]
    for i in range(1, n):
        inside[i] = (inside[i] or inside[page.parent[i]]) and not dropped[i]
    return inside


SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every page."""

    def make():
        def work(ids, urls, htmls):
            return ids, urls, [main_text(html) for html in htmls]

        return work

    return map_rows(pages.select("page_id", "url", "html"), make, SCHEMA)
