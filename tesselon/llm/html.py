"""HTML extraction by tree scoring.

A lenient parser builds a tree; parts that are no article by their element or by the words of their class, id or role
are left out. Each paragraph earns points for its length and commas and passes them to its ancestors, less with each
step. A container's points are discounted by the share of its text that stands in links; the best one and those of its
siblings that are alike are kept, with the article element around them if there is one.

Outside an article a part is left out by any word of its names, inside it only by a name that says nothing else: a class
`social-history` is text, `social-links` is not. Lists of links stand for menus before the first paragraph, and where
nothing introduces them; after a heading or paragraph they are part of the text.
"""

from __future__ import annotations

import html as entities
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow

# Element names by their part in HTML, and words that name a part of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes template xmp svg".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body br caption html legend option tbody td tfoot th thead tr".split())
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
DROPPED = frozenset("aside audio button canvas datalist dialog fieldset footer form head input map menu nav progress select video".split()) | RAW
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre td blockquote dd".split())
ARTICLES = frozenset("article main".split())
NOT_ARTICLE = frozenset(
    "ad ads advert adverts advertisement advertisements advertorial adsense adslot adbox sponsor sponsored sponsors promo promos promotion banner banners cookie cookies consent gdpr notice notices alert alerts announcement popup modal overlay lightbox toast newsletter subscribe subscription signup login signin paywall nav navbar navigation navi menu menus breadcrumb breadcrumbs sidebar sidebars aside rail widget widgets footer footers masthead topbar comment comments commentlist respond disqus reply replies share sharing sharebar social related recommended recommendations recirculation popular trending pagination pager toolbar search searchbox skip copyright disclaimer hidden noprint outbrain taboola".split()
)
#: Words that say nothing about a part of a page but its place or form.
NEUTRAL = frozenset(
    "area articles bar block body bottom box button buttons card center col column container content element floating footer form full group header heading holder icon icons inline inner item items js large left link links list main mobile module more news panel post posts right row section site slot small space sticky stories title toggle top unit wide wrap wrapper zone".split()
)
LISTS = frozenset("ul ol dl table".split())
HEADER_WORDS = frozenset("header headers pageheader siteheader".split())
ARTICLE_WORDS = frozenset("article articlebody post story entry content main maincontent body text".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split())

_OPEN = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|(!--)|([!?/]))")
_PLAIN = re.compile(r"[^>\"']*")
_ATTR = re.compile(r"""\b(class|id|role|itemprop|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Za-z][a-z]*|[0-9]+")


def _says(names: list[list[str]], words: frozenset[str]) -> bool:
    """Whether one of the names, each a list of its words, consists of such words and of nothing that has a meaning."""
    for part in names:
        if "".join(part) in words:
            return True
        rest = [w for w in part if w not in NEUTRAL and not w.isdigit()]
        if rest and all(w in words for w in rest):
            return True
    return False


class Page:
    """The tree of a page: parallel lists of nodes in page order, and runs of text with the node that they stand in."""

    def __init__(self, html: str, by_name: bool = True):
        self.tag, self.parent, self.out, self.like, self.in_article = ["#"], [-1], [False], [False], [False]
        self.in_content, self.before, self.youngest = [False], [-1], [-1]  # the sibling before each node, and its last child
        self.runs: list[tuple[int, str | None]] = []  # None: a block begins or ends
        self.by_name = by_name
        # The open elements, where in the stack each name is open, and where blocks are: nothing walks the stack.
        self.stack, self.places, self.blocks = [0], {}, []
        self._parse(html)

    def _parse(self, html: str) -> None:
        at, n, unclosed = 0, len(html), set()
        stack, runs = self.stack, self.runs
        while at < n:
            m = _OPEN.search(html, at)
            if not m:
                runs.append((stack[-1], html[at:]))
                return
            if m.start() > at:
                runs.append((stack[-1], html[at : m.start()]))
            at = m.end()
            if m[3]:
                end = html.find("-->", at - 2)  # <!--> is a whole comment
                at = n if end < 0 else end + 3
                continue
            if m[4]:
                end = html.find(">", at)
                at = n if end < 0 else end + 1
                continue
            name, start = m[2].lower(), at
            while True:  # to the end of the tag, past quoted values
                at = _PLAIN.match(html, at).end()
                if at >= n or html[at] == ">":
                    break
                quote, back = html[at], at - 1
                while back >= start and html[back].isspace():
                    back -= 1
                if quote not in unclosed and back >= start and html[back] == "=":
                    end = html.find(quote, at + 1)
                    if end >= 0:
                        at = end + 1
                        continue
                    unclosed.add(quote)
                at += 1
            if at >= n:
                return  # an unfinished tag ends the page
            attrs = html[start:at]
            at += 1
            if m[1]:
                self._close(name)
                continue
            self._open(name, attrs)
            if name in RAW and not attrs.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
                self._cut(len(stack) - 1)
                if not end:
                    return
                at = html.find(">", end.end()) + 1 or n
            elif name in VOID or attrs.endswith("/") and name not in BLOCK and name not in ("a", "b", "i", "em", "strong", "span"):
                self._cut(len(stack) - 1)

    def _place(self, *names: str) -> int:
        """The highest place in the stack where one of the names is open, 0 for none."""
        return max((p[-1] for n in names if (p := self.places.get(n))), default=0)

    def _cut(self, place: int) -> None:
        """Close everything from a place of the stack on."""
        while len(self.stack) > place:
            name = self.tag[self.stack.pop()]
            self.places[name].pop()
            if name in BLOCK:
                self.blocks.pop()

    def _open(self, name: str, attrs: str) -> None:
        if name in CLOSES_P and self.blocks and self.tag[self.stack[self.blocks[-1]]] == "p" and self.blocks[-1] > self._place("button", "object"):
            self._cut(self.blocks[-1])
        if name in CLOSED_BY:
            ends, scope = CLOSED_BY[name]
            edge = self._place(*scope)
            while (at := self._place(*ends)) > edge:
                self._cut(at)
        if name in ("html", "body") and self.places.get(name):
            return  # a second one adds nothing
        up, me = self.stack[-1], len(self.tag)
        self.tag.append(name)
        self.parent.append(up)
        self.before.append(self.youngest[up])
        self.youngest[up] = me
        self.youngest.append(-1)
        names, role, prop = [], "", ""
        gone = name in DROPPED
        if attrs.strip():
            for a in _ATTR.finditer(attrs):
                key, value = a[1].lower(), a[2] or a[3] or a[4] or ""
                if key in ("class", "id"):
                    names += [[w.lower() for w in _WORD.findall(part)] for part in value.split()]
                elif key == "role":
                    role = value.lower()
                elif key == "itemprop":
                    prop = value.lower()
                elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    gone = True
        named = {w for part in names for w in (*part, "".join(part))}
        article = name in ARTICLES or role in ("main", "article") or prop == "articlebody"
        inside = self.in_article[up] or article
        if self.by_name and name not in ("html", "body"):
            own = self.in_content[up]
            no_article = _says(names, NOT_ARTICLE) if own else bool(named & NOT_ARTICLE)
            gone |= role in ROLES or no_article and not (article and not named & {"comment", "comments", "commentlist", "reply", "ad", "ads", "advert", "sponsored", "promo", "related"}) and name not in HEADINGS
            gone |= (name == "header" or bool(named & HEADER_WORDS)) and not inside
        header = (name == "header" or _says(names, HEADER_WORDS) and name not in HEADINGS) and inside and not article
        # Of a header inside the article only its headings are kept.
        state = self.out[up]
        if gone or state is True:
            state = True
        elif header:
            state = None
        elif state is None and name in HEADINGS:
            state = False
        self.out.append(state)
        self.like.append(article or bool(named & ARTICLE_WORDS))
        self.in_article.append(inside)
        self.in_content.append(self.in_content[up] or self.like[me] and name != "body")
        if name in BLOCK:
            self.runs.append((me, None))
            self.blocks.append(len(self.stack))
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append(me)

    def _close(self, name: str) -> None:
        at = self._place(name)
        if not at:
            if name in ("br", "p"):
                self.runs.append((self.stack[-1], None))
            return
        block = name in BLOCK or name in DROPPED
        if not block and self.blocks and self.blocks[-1] > at:  # a wrongly nested inline end
            return
        if block and name not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot") and self._place("table") > at:
            return
        if name in ("p", "div", "span", "li", "section") and self._place(*ARTICLES) > at:
            return
        if name in BLOCK:
            self.runs.append((self.parent[self.stack[at]], None))
        self._cut(at)

    def article(self) -> str:
        """The text of the best container and those siblings that are alike."""
        tag, parent, out = self.tag, self.parent, self.out
        n = len(tag)
        own, size, links, commas, linked = [0] * n, [0] * n, [0] * n, [0] * n, [False] * n
        for i in range(1, n):
            linked[i] = tag[i] == "a" or linked[parent[i]]
        for i, text in self.runs:
            if text is None or out[i] is not False:
                continue
            k = len(" ".join(text.split()))
            if k:
                own[i] += k
                size[i] += k
                commas[i] += text.count(",") + text.count("，") + text.count("、")
                if linked[i]:
                    links[i] += k
        for i in range(n - 1, 0, -1):
            p = parent[i]
            if tag[i] not in BLOCK:  # its text is the paragraph's own
                own[p] += own[i]
                commas[p] += commas[i]
            size[p] += size[i]
            links[p] += links[i]
        score = [0.0] * n
        for i in range(1, n):
            if out[i] is not False or not own[i] or tag[i] not in BLOCK or tag[i] == "li" and links[i] * 2 > size[i]:
                continue
            points = min(own[i] / 100, 3) + commas[i] + (1 if tag[i] in PARAGRAPHS else 0.5)
            points *= 1 - links[i] / max(1, size[i])
            at, step = (i if tag[i] not in PARAGRAPHS and tag[i] not in HEADINGS else parent[i]), 0
            while at > 0 and step < 5:
                score[at] += points / (1 if step == 0 else 2 if step == 1 else 3 * step)
                at, step = parent[at], step + 1
        best, top = 0, 0.0
        for i in range(1, n):
            if out[i] is not False or not size[i] or tag[i] in ("html",) or tag[i] not in BLOCK:
                continue
            value = score[i] + (50 if tag[i] in ARTICLES and size[i] else 10 if self.like[i] and tag[i] != "body" else 0)
            value *= 1 - links[i] / max(1, size[i])
            if tag[i] == "body":
                value *= 0.6
            score[i] = value
            if value > top:
                best, top = i, value
        if not best:
            best = next((i for i in range(n) if tag[i] == "body"), 0)
        up = best
        while up > 0:  # the article around it, if there is one
            if tag[up] in ARTICLES:
                best = up
            if tag[up] == "article":
                break
            up = parent[up]
        kept = {best}
        if best > 0 and tag[best] not in ("body", "main"):
            for i in range(1, n):
                if parent[i] != parent[best] or i == best or out[i] is not False or not size[i]:
                    continue
                dense = links[i] / size[i]
                if tag[i] == tag[best] == "article":
                    continue  # another article
                if tag[i] == "h1" and i < best and tag[best] != "article" or dense < 0.25 and (tag[i] == "p" and size[i] > 80 and tag[best] != "article" or score[i] >= max(10, 0.2 * top) and tag[best] != "article"):
                    kept.add(i)
        inside, holds = [False] * n, [False] * n  # holds: a paragraph or a list
        for i in range(n - 1, 0, -1):
            holds[parent[i]] |= holds[i] or bool(size[i]) and out[i] is False and (tag[i] in PARAGRAPHS or tag[i] in LISTS)
        first = n  # the first paragraph that is no link
        for i in range(n):
            inside[i] = i in kept or i > 0 and inside[parent[i]]
            if not inside[i] or not size[i] or out[i] is not False:
                continue
            if first == n and (tag[i] in PARAGRAPHS or tag[i] in BLOCK and own[i] >= 80) and links[i] * 2 < size[i]:
                first = i
            if i not in kept and links[i] * 10 > size[i] * 7 and (tag[i] in LISTS or tag[i] in ("div", "section")):
                if first == n or tag[i] not in LISTS and not holds[i]:
                    inside[i] = False
                elif tag[i] in LISTS and not self.in_article[i]:
                    inside[i] = self.before[i] > 0 and tag[self.before[i]] in HEADINGS | PARAGRAPHS
        parts = []
        for i, text in self.runs:
            if text is None:
                parts.append(" ")
            elif inside[i] and out[i] is False:
                parts.append(entities.unescape(text) if "&" in text else text)
        return " ".join("".join(parts).split())


def main_text(html: str | None) -> str:
    """The text of the article of a page, empty if there is none. White space is one space; blocks are joined by one."""
    if not html or html.isspace():
        return ""
    text = Page(html).article()
    return text or Page(html, by_name=False).article()


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "text", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns `keep` and the article's text of each row; null or empty pages, and those without an article, give "".

    Rows stay as they are, repeated ones too. Pages of any length and depth are read whole, in time that grows with their
    length; bytes that are no UTF-8 become U+FFFD. Other columns are not read, so their names cannot clash; no rows give
    none.
    """
    from pyspark.sql import types as T

    given = pages.select(*(F.col(c) for c in keep), F.col(html_col).cast("string").alias("__html"))
    names = [*keep, text_col]

    def run(batches):
        import pyarrow as pa

        from .words import texts

        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([main_text(h) for h in texts(part.column(part.num_columns - 1))], pa.string())], names)

    return map_arrow(given, run, T.StructType([*given.schema.fields[:-1], T.StructField(text_col, T.StringType())]))
