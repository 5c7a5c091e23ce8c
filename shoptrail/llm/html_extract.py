"""Main text of web pages by composite text density.

Every node of the page's tree has its characters per tag, corrected for links: text spread over few
tags with few links is dense. The sum of the children's densities is greatest at the node that
holds the article's paragraphs. The least density on the way from there to the body is the threshold
for what else belongs to the text: every block that reaches it stays, wherever it stands. Elements and class, id or
role words that name menus, adverts and the like are evidence against a block; an article element is evidence for it, which
only words for readers' comments outweigh.
"""

from __future__ import annotations

import re
from html import unescape
from math import e, log

from pyspark.sql import DataFrame

from shoptrail.llm.common import per_text

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_RAW = {"script", "style", "textarea", "title", "xmp", "noframes"}
_NEVER = {"head", "script", "style", "noscript", "template", "textarea", "title", "xmp", "noframes", "svg", "math", "iframe", "object", "canvas", "audio", "video", "nav", "footer", "aside", "menu", "form", "button", "select", "dialog"}
_BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# What a start tag ends if it is open, and where the search for it stops.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
_CLOSES_P = _BLOCKS - {"body", "html", "caption", "tbody", "tfoot", "thead", "tr"}
# Words of class, id and role values that mark what is not the article.
_BOILERPLATE = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs "
    "header masthead footer sidebar aside complementary contentinfo cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe "
    "subscription signup login search share sharing social related recommended pagination pager toolbar widget comment comments disqus respond reply replies".split()
)
_READERS = set("comment comments disqus respond reply replies".split())
_ATTRIBUTES = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*)>""")
_LOOSE_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMES = re.compile(r"[^0-9a-z]+")


class Page:
    """The tree of one page as parallel lists; children come after their parents."""

    def __init__(self, html: str):
        self.tag, self.parent, self.out, self.in_link = ["#root"], [-1], [False], [False]
        self.article = [False]
        self.chars = [0]
        self.open: dict[str, int] = {}  # open elements of each tag
        self.parts: list[tuple[int, str | None]] = []  # (node, text), or (node, None) for the edge of a block
        self.body = 0
        self._read(html)

    def _open(self, tag: str, attributes: str, above: int) -> int:
        node = len(self.tag)
        marked = tag in _NEVER
        if not marked and attributes and tag not in ("html", "body", "main"):
            for name, value in _ATTRIBUTES.findall(attributes):
                if name.lower() == "hidden" or name.lower() == "aria-hidden" and "true" in value:
                    marked = True
                elif not (_READERS if tag == "article" else _BOILERPLATE).isdisjoint(_NAMES.split(value.lower())):
                    marked = True
        elif tag == "header":
            marked = True
        if marked and self.article[above] and (tag == "header" or "header" in _NAMES.split(attributes.lower())) and tag not in _NEVER:
            marked = False  # the article's own head
        self.tag.append(tag)
        self.parent.append(above)
        self.out.append(self.out[above] or marked)
        self.in_link.append(self.in_link[above] or tag == "a")
        self.article.append(self.article[above] or tag == "article")
        self.chars.append(0)
        return node

    def _text(self, node: int, raw: str) -> None:
        if raw and not self.out[node]:
            text = unescape(raw) if "&" in raw else raw
            self.parts.append((node, text))
            self.chars[node] += len("".join(text.split()))

    def _read(self, html: str) -> None:
        stack, at, last = [0], 0, html.rfind(">")
        lower = None
        while at < len(html):
            begin = html.find("<", at)
            if begin >= 0 and html.startswith("<!--", begin):
                self._text(stack[-1], html[at:begin])
                stop = html.find("-->", begin + 4)
                at = stop + 3 if stop >= 0 else len(html)
                continue
            if begin < 0 or begin > last:
                self._text(stack[-1], html[at:])
                break
            if html.startswith(("<!", "<?"), begin):
                self._text(stack[-1], html[at:begin])
                at = html.find(">", begin) + 1
                continue
            found = _TAG.match(html, begin) or _LOOSE_TAG.match(html, begin)
            if not found:  # a bare "<" is text
                self._text(stack[-1], html[at : begin + 1])
                at = begin + 1
                continue
            self._text(stack[-1], html[at:begin])
            at, tag = found.end(), found[1].lower()
            if html[begin + 1] == "/":
                self._close(tag, stack)
                continue
            self._imply(tag, stack)
            if tag in ("html", "body") and self.open.get(tag):
                continue
            node = self._open(tag, found[2], stack[-1])
            if tag == "body":
                self.body = node
            if tag == "br":
                self._text(stack[-1], " ")
            elif tag in _BLOCKS:
                self.parts.append((node, None))
            if tag in _VOID:
                continue
            if tag in _RAW:
                if lower is None:
                    lower = html.lower()
                stop = lower.find("</" + tag, at) if len(lower) == len(html) else -1
                if stop < 0:
                    end = re.compile("</" + tag, re.I).search(html, at)
                    stop = end.start() if end else len(html)
                close = html.find(">", stop)
                at = close + 1 if close >= 0 else len(html)
                continue
            stack.append(node)
            self.open[tag] = self.open.get(tag, 0) + 1

    def _imply(self, tag: str, stack: list[int]) -> None:
        """End what ``tag`` may not stand in."""
        if tag in _CLOSES_P:
            self._end({"p"}, {"table", "td", "th", "caption", "button", "object", "article", "section", "div", "body", "li", "blockquote"}, stack)
        if tag in _HEADINGS and self.tag[stack[-1]] in _HEADINGS:
            self._pop(stack)
        if tag in _ENDS:
            self._end(*_ENDS[tag], stack)
        elif tag in _BLOCKS and self.tag[stack[-1]] == "head" or tag in ("article", "div", "p", "nav") and any(self.tag[n] == "head" for n in stack[1:3]):
            self._end({"head"}, set(), stack)

    def _end(self, ended: set[str], stop: set[str], stack: list[int]) -> None:
        if not any(self.open.get(tag) for tag in ended):
            return
        for i in range(len(stack) - 1, 0, -1):
            if self.tag[stack[i]] in ended:
                while len(stack) > i:
                    self._pop(stack)
                return
            if self.tag[stack[i]] in stop:
                return

    def _close(self, tag: str, stack: list[int]) -> None:
        if tag == "br":
            self._text(stack[-1], " ")
        if not self.open.get(tag):
            return
        for i in range(len(stack) - 1, 0, -1):
            if self.tag[stack[i]] == tag:
                while len(stack) > i:
                    self._pop(stack)
                return
            if self.tag[stack[i]] in ("body", "html"):
                return

    def _pop(self, stack: list[int]) -> None:
        node = stack.pop()
        self.open[self.tag[node]] -= 1
        if self.tag[node] in _BLOCKS:
            self.parts.append((node, None))
        elif self.tag[node] in ("td", "th"):
            self.parts.append((node, " "))

    def densities(self) -> tuple[list[float], list[float], list[int], list[int]]:
        """Composite text density and sum of the children's, characters and link characters of each node."""
        n = len(self.tag)
        chars, links = list(self.chars), [c if own else 0 for c, own in zip(self.chars, self.in_link, strict=True)]
        tags, link_tags = [0] * n, [int(t == "a") for t in self.tag]
        for node in range(n - 1, 0, -1):
            if not self.out[node]:
                above = self.parent[node]
                chars[above] += chars[node]
                links[above] += links[node]
                tags[above] += tags[node] + 1
                link_tags[above] += link_tags[node]
        share = links[self.body] / max(1, chars[self.body])
        density, total = [0.0] * n, [0.0] * n
        for node in range(n - 1, -1, -1):
            if self.out[node] or not chars[node]:
                continue
            c, t, lc, lt = chars[node], max(1, tags[node]), max(1, links[node]), max(1, link_tags[node])
            base = log(c / max(1, c - links[node]) * links[node] + share * c + e)
            density[node] = c / t * max(0.0, log(max(1.0, c / lc * t / lt)) / max(log(base), 1.0))
            if node:
                total[self.parent[node]] += density[node]
        return density, total, chars, links

    def main_text(self) -> str:
        density, total, chars, links = self.densities()
        n = len(self.tag)
        inside = [False] * n
        inside[self.body] = True
        for node in range(self.body + 1, n):
            inside[node] = inside[self.parent[node]]
        best = max((i for i in range(n) if inside[i]), key=lambda i: (total[i], chars[i], -i))
        path = [best]
        while path[-1] not in (self.body, 0):
            path.append(self.parent[path[-1]])
        threshold = min(density[i] for i in path)
        root, joined_below = self.body, best != self.body
        kept = [False] * n
        kept[root] = True
        if joined_below:  # loose text of the body, with the inline elements in it, unless most of it is links
            loose = [i for i in range(root + 1, n) if self.parent[i] == root and not self.out[i] and self.tag[i] not in _BLOCKS]
            kept[root] = 2 * sum(links[i] for i in loose) <= self.chars[root] + sum(chars[i] for i in loose)
        on_path = {*path}
        for node in range(root + 1, n):
            above = self.parent[node]
            follows = kept[above] and not (joined_below and above == root and self.tag[node] in _BLOCKS)
            kept[node] = not self.out[node] and (follows or joined_below and inside[node] and max(density[node], total[node]) >= threshold)
            if kept[node] and node not in on_path and self.tag[node] in ("div", "section", "ul", "ol", "table") and density[node] < threshold and 2 * links[node] > chars[node]:
                kept[node] = False  # a list of links in the text
        blocks, block = [], []
        for node, text in self.parts:
            if not kept[node]:
                continue
            if text is not None:
                block.append(text)
            elif block:
                if joined := " ".join("".join(block).split()):
                    blocks.append(joined)
                block = []
        if joined := " ".join("".join(block).split()):
            blocks.append(joined)
        return "\n\n".join(blocks)


def extract_text(html: str) -> str:
    return Page(html).main_text() if html else ""


def extract_pages(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """``keep``, text and n_chars for each row of ``pages``.

    A null or empty page, and one without text, gives an empty text. Broken markup is read as browsers
    do: ends are implied, what never ends reaches to the page's end. Each page is read alone.
    """

    def make():
        def step(values: list[str]) -> dict[str, list]:
            texts = [extract_text(v) for v in values]
            return {"text": texts, "n_chars": [len(t) for t in texts]}

        return step

    return per_text(pages, keep, html, make, "text string, n_chars long")
