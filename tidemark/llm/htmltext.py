"""Main text of web pages by tree scoring.

A page is parsed into a tree of blocks. Every paragraph gives points, for being
there, for its commas and for its length, to its parent in full, to the
grandparent by half and to higher ancestors by less. A container's points are
discounted by the share of its text that sits in links. The best container and
those of its siblings that look like it are kept, without what is marked as
something else (menus, forms, adverts, comments ...).

Pages are independent rows, so nothing is shuffled. A null page counts as empty;
a page without text gives the empty string; repeated rows give repeated results.
Broken markup never fails: stray end tags are ignored, open elements end where
HTML lets them end or with the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# How HTML classes its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe noframes textarea title svg math canvas object xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr nobr".split()
)
# Elements that are never part of an article.
DROPPED = frozenset(
    "script style noscript template iframe noframes head title nav footer aside form button select option input textarea "
    "fieldset menu dialog svg math canvas object embed video audio xmp".split()
)
PARAGRAPH = frozenset("p pre blockquote td li dd h1 h2 h3 h4 h5 h6".split())
# A start tag on the left ends an open element on the right, up to a boundary.
ENDS = {
    **{t: ("p",) for t in (
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre "
        "section table ul figure figcaption details summary".split())},
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",),
    "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th"), "body": ("head",),
}
BOUNDARY = {
    "li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)),
    "tr": frozenset(("table",)), "td": frozenset(("table",)), "th": frozenset(("table",)),
    "tbody": frozenset(("table",)), "tfoot": frozenset(("table",)),
}
STOPS = frozenset("article aside section div table td th body button main blockquote form figure li".split())

# Words of a class, id or role that say what a block is. A block of the first kind is never the
# article, however long; one of the second kind may be a layout's name for what holds the article.
NEVER = frozenset(
    """ad ads advert adverts advertisement advertising advertorial adsense sponsor sponsors sponsored promo promos promotion
    breadcrumb breadcrumbs footer masthead comment comments disqus respond reply replies cookie cookies consent gdpr newsletter
    subscribe subscription signup login related recommend recommended recommendation recommendations pagination pager
    contentinfo complementary""".split()
)
LAYOUT = frozenset(
    """nav navi navbar navigation menu menubar header sidebar sidebars side rail widget widgets notice notices notification
    notifications alert alerts popup modal overlay banner share sharing social toolbar skip hidden search""".split()
)
# Words that say nothing themselves: the word before them does, as in "comment-list" or "related-posts".
HOLDERS = frozenset(
    """list lists box boxes block blocks area section sections wrapper wrap container inner outer form bar link links item items
    title content body holder panel panels group row column col buttons button icons posts articles stories news products
    left right top bottom primary secondary main 1 2 3""".split()
)
# What such a word begins with is a state of something else, as in "has-sidebar".
STATES = frozenset("has no not with without is show hide js".split())
ARTICLE = re.compile(r"(?:^|[\s_-])(?:article|articlebody|post|entry|main|content|story)(?:$|[\s_-])", re.IGNORECASE)
HALF = 0.5  # share of a page's text that makes a layout element or a form the page itself


def role(marks: str) -> int:
    """What the words of a class, id or role say: 2 never part of an article, 1 a layout element, 0 nothing."""
    found = 0
    for token in marks.split():
        words = re.sub(r"([a-z0-9])([A-Z])", r"\1-\2", token).lower().replace("_", "-").strip("-").split("-")
        if words[0] in STATES:
            continue
        while len(words) > 1 and words[-1] in HOLDERS:
            words.pop()
        found = max(found, 2 if words[-1] in NEVER else 1 if words[-1] in LAYOUT else 0)
    return found


TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)",
    re.DOTALL,
)
MARKS = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)


class Page:
    """The tree of a page: parallel lists, one entry per element; 0 is the root."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent, self.marks, self.parts = ["#root"], [-1], [""], [[]]
        self.dropped = [False]
        self.parse(html)

    def parse(self, html: str) -> None:
        at, end = 0, len(html)
        # Where each open tag lies in the stack, so that a stray tag costs nothing however deep the page is.
        self.stack, self.places, self.stops = [0], {}, []
        stack, tags, parts = self.stack, self.tag, self.parts
        while at < end:
            m = TOKEN.search(html, at) if html.find(">", at) >= 0 else None
            if m is None:
                # No tag can end any more; a comment may be open.
                parts[stack[-1]].append(html[at:].split("<!--", 1)[0])
                break
            if m.start() > at:
                parts[stack[-1]].append(html[at : m.start()])
            at, name = m.end(), m[2]
            if name is None:
                continue
            name = name.lower()
            if m[1]:
                self.close(name)
                continue
            self.end_open(name)
            node = len(tags)
            tags.append(name)
            self.parent.append(stack[-1])
            parts.append([])
            parts[stack[-1]].append(node)
            marks = self.read_marks(m[3]) if len(m[3]) > 2 else ""
            self.marks.append(marks)
            self.dropped.append(name in DROPPED or marks == "!" or (name == "header" and not self.in_article()))
            if name in RAW and not m[3].endswith("/>"):
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, at)
                at = close.end() if close else end
            elif name not in VOID and not (m[3].endswith("/>") and name not in INLINE | PARAGRAPH | STOPS):
                self.places.setdefault(name, []).append(len(stack))
                if name in STOPS:
                    self.stops.append(len(stack))
                stack.append(node)

    def cut(self, place: int) -> None:
        """Close the open element at this place of the stack, and all inside it."""
        for node in self.stack[place:]:
            name = self.tag[node]
            self.places[name].pop()
            if name in STOPS:
                self.stops.pop()
        del self.stack[place:]

    def last(self, names) -> int:
        """The highest place in the stack of an open element with one of these names; 0 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def end_open(self, name: str) -> None:
        """End the open elements that a start tag ends, up to a boundary."""
        while name in ENDS and (place := self.last(ENDS[name])):
            bound = self.last(BOUNDARY[name]) if name in BOUNDARY else self.stops[-1] if self.stops else 0
            # A boundary may itself be among what ends here, as a cell is.
            if bound > place:
                return
            self.cut(place)

    def in_article(self) -> bool:
        return bool(self.last(("article", "main")))

    @staticmethod
    def read_marks(attributes: str) -> str:
        """The class, id and role words; "!" for a hidden element."""
        found = []
        for m in MARKS.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" and value.lower() != "until-found" or name == "aria-hidden" and value.lower() == "true":
                return "!"
            if name == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
                    return "!"
            elif name != "hidden" and name != "aria-hidden":
                found.append(value)
        return " ".join(found)

    def close(self, name: str) -> None:
        place = self.last((name,))
        if place and not (name in INLINE and self.stops and self.stops[-1] > place):
            self.cut(place)

    def text(self) -> str:
        self.measure()
        kept = self.choose()
        blocks: list[str] = []
        for node in kept:
            self.collect(node, blocks)
        return "\n".join(blocks)

    def role(self, node: int) -> int:
        if self.dropped[node]:
            return 1 if self.tag[node] in ("form", "fieldset") and self.marks[node] != "!" else 2
        marks = self.marks[node]
        if marks and self.tag[node] not in INLINE and self.tag[node] not in ("html", "body", "article", "main"):
            return role(marks)
        return 0

    def measure(self) -> None:
        """Text length, link length and commas of every element, leaves first."""
        n = len(self.tag)
        roles = [0, *map(self.role, range(1, n))]
        # How much text outside of links is in each element, and outside of what is never part of an article.
        mass, gone = [0] * n, [False] * n
        for i in range(1, n):
            gone[i] = gone[self.parent[i]] or roles[i] == 2
        for i in range(n - 1, -1, -1):
            if not gone[i] and self.tag[i] != "a":
                mass[i] += sum(len(part.strip()) for part in self.parts[i] if isinstance(part, str))
                if i:
                    mass[self.parent[i]] += mass[i]
        self.out = out = [False] * n
        for i in range(1, n):
            out[i] = out[self.parent[i]] or roles[i] == 2 or (roles[i] == 1 and mass[i] <= HALF * mass[0])
        self.size, self.links, self.commas, self.points = [0] * n, [0] * n, [0] * n, [0.0] * n
        own = [0] * n  # text outside of blocks inside the element
        for i in range(n - 1, -1, -1):
            if out[i]:
                continue
            for part in self.parts[i]:
                if isinstance(part, str):
                    if length := len(part.strip()):
                        self.size[i] += length
                        own[i] += length
                        self.commas[i] += part.count(",") + part.count("、") + part.count("，")
                elif not out[part]:
                    self.size[i] += self.size[part]
                    self.links[i] += self.links[part]
                    if self.tag[part] in INLINE:
                        own[i] += own[part]
                        self.commas[i] += self.commas[part]
            if self.tag[i] == "a":
                self.links[i] = self.size[i]
        for i in range(1, n):
            if out[i] or not own[i] or self.tag[i] in INLINE:
                continue
            if self.tag[i] in PARAGRAPH or own[i] >= 25:
                share = 1 + self.commas[i] + min(own[i] / 100, 3)
                share *= 1 - self.links[i] / max(1, self.size[i])
                up, level = self.parent[i], 1
                if self.tag[i] not in PARAGRAPH:
                    self.points[i] += share
                while up > 0 and level <= 5:
                    self.points[up] += share / (1 if level == 1 else 2 if level == 2 else 3 * level)
                    up, level = self.parent[up], level + 1

    def score(self, node: int) -> float:
        density = self.links[node] / max(1, self.size[node])
        bonus = 1.0
        if self.tag[node] in ("article", "main"):
            bonus = 1.5
        elif self.marks[node] and ARTICLE.search(self.marks[node]):
            bonus = 1.25
        return self.points[node] * (1 - density) * bonus

    def choose(self) -> list[int]:
        """The best container and its kept siblings, in page order."""
        best, most = 0, 0.0
        for i in range(1, len(self.tag)):
            if not self.out[i] and self.points[i] > 0 and (value := self.score(i)) > most:
                best, most = i, value
        if not best:
            return [0]
        # The article as a whole, if the best container is one part of it.
        up, whole = best, 0
        while up > 0:
            if self.tag[up] in ("article", "main") and (not whole or self.tag[up] == "article"):
                whole = up
                if self.tag[up] == "article":
                    break
            up = self.parent[up]
        best = whole or best
        if self.tag[best] in ("html", "body", "#root"):
            return [best]
        kept = []
        for part in self.parts[self.parent[best]]:
            if isinstance(part, str) or self.out[part]:
                continue
            density = self.links[part] / max(1, self.size[part])
            like = self.score(part) >= max(3.0, 0.2 * most)
            loose = self.tag[part] == "p" and self.size[part] > 80 and density < 0.25
            if part == best or like or loose:
                kept.append(part)
        return kept

    def collect(self, top: int, blocks: list[str]) -> None:
        """Append the text of each block below ``top``, white space made single."""
        line: list[str] = []

        def end() -> None:
            if line:
                if words := " ".join(unescape("".join(line)).split()):
                    blocks.append(words)
                line.clear()

        work: list[tuple[int, int]] = [(top, 0)]
        while work:
            node, at = work.pop()
            parts, inline = self.parts[node], self.tag[node] in INLINE
            if at == 0 and not inline:
                end()
            while at < len(parts):
                part = parts[at]
                at += 1
                if isinstance(part, str):
                    line.append(part)
                elif self.out[part]:
                    if self.tag[part] not in INLINE:
                        end()
                elif self.tag[part] == "br" or self.tag[part] == "wbr":
                    line.append(" " if self.tag[part] == "br" else "")
                else:
                    work += [(node, at), (part, 0)]
                    break
            else:
                if not inline:
                    end()
        end()


def main_text(html: str | None) -> str:
    return Page(html).text() if html else ""


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per page: the ``keep`` columns, its main ``text`` and ``n_chars`` code points."""
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column(len(keep)).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), sizes], [*keep, "text", "n_chars"])

    return pages.select(*keep, html_col).mapInArrow(run, f"{kinds}, text string, n_chars long")
