import random
import re
import time
from html.parser import HTMLParser

import pytest

pytest.importorskip("tesselon.llm")

from tesselon.llm.html import extract_text, main_text  # noqa: E402

P1 = "The first paragraph of the story is long enough, has commas, and says a lot about rivers and hills in spring."
P2 = "The second paragraph goes on about the same rivers, the boats on them, and the people who live on these boats."
BODY = f"<h1>A &amp; B</h1><p>{P1}</p><p>{P2}</p>"
WANT = f"A & B {P1} {P2}"
MENU = "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>"


@pytest.mark.parametrize(
    "html",
    [
        f"<html><body>{MENU}<article>{BODY}</article><footer>&copy; Site</footer></body></html>",
        f"<body><div id=header><a href=/>Logo</a> Site name</div><div class='content'>{BODY}</div><div class='sidebar'><h3>Popular</h3><p>Some other words that are, of course, not the story, but long enough to look like it, really.</p></div></body>",
        f"<body><main><div class=post>{BODY}</div><section id=comments><h2>Comments</h2><p>I think that this is a great story, thank you, dear author, for writing all of it.</p></section></main></body>",
        f"<body><div class='cookie-notice'>We use cookies, as all sites do, to make this one better, faster, and nicer for you.</div><article>{BODY}<div class='share'>Share this</div><aside>Read also</aside><form><label>Mail</label><input><button>Send</button></form></article></body>",
        f"<body><table><tr><td><a href=1>one</a> <a href=2>two</a> <a href=3>three</a><td><h1>A &#38; B</h1><p>{P1}<p>{P2}</table>",
        f"<article><header><h1>A & B</h1><p class=byline>By someone</p></header><p>{P1}</p><!-- <p>no</p> --><script>if (a < b) document.write('<p>no</p>')</script><style>p {{}}</style><p>{P2}</p>",
        f"<body><div><div><article class=post>{BODY}</article><article class=comment><p>First, I would like to say, this is a comment and nothing more than that, really.</p></article></div></div>",
        f"<BODY><DIV CLASS=\"ad\">Buy, buy, buy, now, here, today, cheap, good, new, free.</DIV><ARTICLE><H1>A &amp; B</H1><P>{P1}<P>{P2}</ARTICLE>",
        f"<article>{BODY}<ul class=related-posts><li><a href=1>Another story</a></ul></article><div hidden><p>{P1}</p></div><noscript>Turn on scripts</noscript>",
    ],
)
def test_article_alone(html):
    assert main_text(html) == WANT


def test_inline_markup_and_white_space():
    assert main_text("<article><h1>T</h1><p>a <b>bo</b>ld\n\t word<br>next&nbsp;line <i>x</i>, y &eacute;&#x1F642;</p><ul><li>one</li><li>two</li></ul></article>") == "T a bold word next line x, y é🙂 one two"


def test_short_article_beside_longer_notices():
    assert main_text(f"<body><div class=ad>{P1}</div><article><h1>Tiny.</h1><p><b>Tiny.<br></article><footer>{P2}</footer>") == "Tiny. Tiny."


@pytest.mark.parametrize("html", [None, "", "  ", "<html></html>", "<!-- a", "<script>x", "<nav><a>x</a></nav>" * 2, "<p"])
def test_no_article(html):
    assert main_text(html) in ("", "x x", "xx")


def test_broken_and_large_pages():
    assert main_text("just text < 5 and > 3") == "just text < 5 and > 3"
    assert main_text('<article><p class="a>text</p><p title=\'it"s\'>more, words</p></article>').endswith("more, words")
    deep = "<div>" * 20_000 + f"<p>{P1}</p>" + "</div>" * 20_000
    assert main_text(deep) == P1
    wide = "<article>" + "<p>word, word</p>" * 50_000 + "</article>"
    assert main_text(wide) == " ".join(["word, word"] * 50_000)
    assert main_text('<a href="' * 20_000 + "x") is not None


def test_rows(spark):
    rows = [(1, "u", f"<article>{BODY}</article>", "clash"), (2, None, None, "clash"), (2, None, "", "clash"), (None, "u", "<p>x", "clash")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted((r["page_id"] or -1, r["url"], r["text"]) for r in extract_text(df).collect()) == sorted([(1, "u", WANT), (2, None, ""), (2, None, ""), (-1, "u", "x")], key=lambda r: (r[0], r[2]))
    assert extract_text(df.limit(0)).collect() == []


def test_article_text_is_not_dropped_by_its_names():
    for inner in (
        f'<div class="social-history"><p>{P2}</p></div>',
        f'<section id="search-algorithms"><h2>Search</h2><p>{P2}</p></section>',
        f"<h2>Sources</h2><ul><li><a href=1>{P1}</a></li><li><a href=2>Two</a></li></ul>",
        f"<p><a href=1>{P2}</a></p>",
        f"<div><p><a href=1>{P2}</a></p></div>",
        "<p>So <math><mi>x</mi> <mo>=</mo> <mn>2</mn></math>, and <output>4</output> <object data=a.svg>a chart</object>.</p>",
    ):
        assert main_text(f"<body>{MENU}<article><h1>T</h1><p>{P1}</p>{inner}</article></body>").split() == " ".join(["T", P1, re.sub("<[^>]*>", "", re.sub("</?(p|h2|ul|li|div|section)\\b[^>]*>", " ", inner))]).split()
    for name in ("social-links", "share-buttons", "related-posts", "cookie_notice", "adSlot3", "sidebar left", "newsletterSignup"):
        assert main_text(f"<body><article><h1>T</h1><p>{P1}</p><div class='{name}'><p>{P2}</p></div></article></body>") == f"T {P1}"
    assert main_text(f"<body><article><ul><li><a href=1>One</a></li></ul><p>{P1}</p><div><a href=2>Next</a></div></article></body>") == P1


@pytest.mark.parametrize("page", ["<b>" * 20_000 + "</i>" * 20_000, "<p><td>" + "<b>" * 20_000 + "<div></div>" * 20_000, "<ul>" + "<b>" * 20_000 + "<li>" * 20_000, "<a " + "x='1' " * 60_000 + ">t</a>", "<a " + "x='" * 60_000 + ">t</a>", "<article>" + "<div>" * 20_000 + "</p>" * 20_000, "<body>" * 20_000 + "<i>" * 20_000 + "</body>" * 20_000])
def test_time_grows_with_the_length(page):
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 5


class Oracle(HTMLParser):
    """The text of the article by the standard library's parser: what is marked data-skip and its like is left out."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.text, self.depth, self.skip, self.inside = [], 0, None, None
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in ("br", "img", "hr", "input"):
            self.text.append(" ")
            return
        self.depth += 1
        if tag in ("p", "div", "li", "ul", "ol", "h1", "h2", "blockquote", "section", "table", "tr", "td"):
            self.text.append(" ")
        if tag == "article" and self.inside is None:
            self.inside = self.depth
        if self.skip is None and (("data-skip", None) in attrs or tag in ("script", "style")):
            self.skip = self.depth

    def handle_endtag(self, tag):
        if tag in ("p", "div", "li", "ul", "ol", "h1", "h2", "blockquote", "section", "table", "tr", "td"):
            self.text.append(" ")
        if self.skip == self.depth:
            self.skip = None
        if self.inside == self.depth:
            self.inside = 0
        self.depth -= 1

    def handle_data(self, data):
        if self.inside and self.skip is None:
            self.text.append(data)


def page(r):
    """A random page, well formed, with one article; what is no article carries data-skip."""
    words = ["river", "boat", "straße", "été", "x&lt;y", "a&amp;b", "n&#176;5", "caf&eacute;", "&#x1F642;", "end.", "so,", "and"]

    def text(n):
        return r.choice([" ", "\n", "  ", " \t"]).join(r.choice(words) for _ in range(n))

    def inline(n):
        t = r.choice(["b", "i", "em", "span", "a", "code", "sup"])
        return f"{text(n)} <{t}{' href=/x' if t == 'a' else ''}>{text(2)}</{t}>{r.choice(['', '<br>', '<!-- no -->'])} {text(3)}"

    junk = [
        lambda: f"<aside data-skip>{text(30)}</aside>",
        lambda: f"<div class='{r.choice(['ad', 'share-buttons', 'newsletter', 'related-posts', 'comments'])}' data-skip><p>{text(30)}</p></div>",
        lambda: f"<form action=/s data-skip><input name=q> {text(4)}</form>",
        lambda: f"<script>document.write('<p>{text(5)}</p>')</script>",
        lambda: f"<style>p{{color:red}} {text(3)}</style>",
    ]
    parts = [
        lambda: f"<p>{inline(r.randrange(5, 60))}</p>",
        lambda: f"<h2>{text(3)}</h2><p>{text(20)}</p>",
        lambda: f"<ul>{''.join(f'<li>{inline(4)}</li>' for _ in range(r.randrange(1, 5)))}</ul>",
        lambda: f"<blockquote><p>{text(12)}</p></blockquote>",
        lambda: f"<div class='{r.choice(['social-history', 'text', 'lead'])}'><p>{inline(9)}</p></div>",
        lambda: f"<table><tr><td>{text(3)}</td><td>{text(2)}</td></tr></table>",
    ]
    body = [f"<h1>{text(4)}</h1>", f"<p>{text(25)}</p>"] + [r.choice(parts if r.random() < 0.8 else junk)() for _ in range(r.randrange(12))]
    outside = [lambda: f"<nav data-skip><ul><li><a href=/>{text(2)}</a></li></ul></nav>", lambda: f"<header data-skip><p>{text(9)}</p></header>", *junk]
    around = [r.choice(outside)() for _ in range(r.randrange(5))]
    k = r.randrange(len(around) + 1)
    return f"<!DOCTYPE html><html><head><title>{text(3)}</title></head><body>{''.join(around[:k])}<article>{''.join(body)}</article>{''.join(around[k:])}<footer data-skip>{text(9)}</footer></body></html>"


@pytest.mark.parametrize("seed", range(200))
def test_random_pages_match_the_standard_parser(seed):
    html = page(random.Random(seed))
    assert main_text(html) == " ".join("".join(Oracle(html).text).split())
