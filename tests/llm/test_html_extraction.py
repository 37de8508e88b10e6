import html as entities
import random
import re
import time
from collections import Counter
from html.parser import HTMLParser

import pytest

from datasheaf.llm import html_extraction as h


def article(page):
    """Text of the article element, by hand."""
    m = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)
    x = re.sub(r"<[^>]*(?:>|\Z)", lambda t: "\x01" if re.match(r"</?(?:p|h1)\b", t[0]) else " " if t[0].startswith("<br") else "", m[1] if m else "")
    return " ".join(filter(None, (re.sub(r"\s+", " ", entities.unescape(b)).strip() for b in x.split("\x01"))))


def test_pages(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    got = h.extract_pages(pages).collect()
    assert len(got) == len(source)
    for r in got:
        assert r.text == article(source[r.page_id]) and r.n_chars == len(r.text)


LONG = "A long paragraph, with several commas, and enough words to be read as text."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain", "plain"),
        ("<p>a&amp;b &copy; &#233;<br>c</p>", "a&b © é c"),
        (f"<div class=nav><a href=x>Home</a></div><div id=content><h1>T</h1><p>{LONG}</p><p>Short.</p></div><div class=footer><p>{LONG}</p></div>", f"T {LONG} Short."),
        (f"<main><p>{LONG}</p><aside><p>{LONG}</p></aside><form><p>{LONG}</p></form><div class='comments'><p>{LONG}</p></div><script>x='<p>'</script></main>", LONG),
        (f"<div><p>{LONG}</p></div><div><ul><li><a href=x>{LONG}</a></li></ul></div>", LONG),
        (f"<article><p>{LONG}<p>Next<table><tr><td>cell</td></tr></table><!-- no --></article", f"{LONG} Next cell"),
        ("<p>cut <b", "cut"),
        ("<p title=\"a>it's <b data=it's>fine</b></p>", "it's fine"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        # scripts hold what looks like markup
        (f"<script>for(i=0;i<n;i++){{f(i)}}</script><article><p>{LONG}</p></article>", LONG),
        (f"<script>if(a<b && c)x='</p>'</script><article><p>{LONG}</p></article>", LONG),
        (f'<script>var s="<!--"</script><article><p>{LONG}</p></article><!-- x -->', LONG),
        (f"<STYLE>a<b</STYLE ><textarea><p>{LONG}</textarea><p>{LONG}</p>", LONG),
        (f"<!-->{LONG}<!-- x --!>", LONG),
        ('<p title="a<b>c" data-x=\'>\'>fine</p>', "fine"),
        # names around the article, and inside it
        (f"<div class='post header'><article><p>{LONG}</p></article></div>", LONG),
        (f"<section class='social'><div><p>{LONG}</p><p>{LONG}</p></div></section><div class=ad>Buy</div>", f"{LONG} {LONG}"),
        (f"<div id='comments-on-art'><article><p>{LONG}</p><div class=comments><p>{LONG}</p></div></article></div>", LONG),
        (f"<article><p>{LONG}</p><p id=share>{LONG}</p><div class=share>Share this</div></article>", f"{LONG} {LONG}"),
        (f"<form id=aspnet><div class=nav><a href=x>Home</a></div><div><p>{LONG}</p></div></form>", LONG),
        (f"<div><p>{LONG}</p></div><div class=comments>" + f"<p>{LONG}</p>" * 5 + "</div>", LONG),
        # paragraphs that are plain elements
        (f"<div><h2>T</h2><div>{LONG * 20}</div><div>{LONG * 2}</div><ul><li>{LONG}</li></ul><div><a href=x>{LONG}</a></div></div>", f"T {LONG * 20} {LONG * 2} {LONG}"),
    ],
)
def test_cases(page, text):
    assert h.extract(page) == text


@pytest.mark.parametrize("part", ["<p title='", "<b>", "<td><b><div>", "</x>", "<!--", "<div class=ad>", "<div class=ad>x", "<article>x", '<a b="', "<script>"])
def test_hostile_pages_are_linear(part):
    began = time.perf_counter()
    h.extract(part * 20000 + 'x"')
    assert time.perf_counter() - began < 20


def plain_scores(page):
    """Points of each container by its id, with the standard library's parser: every paragraph gives to four ancestors."""

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.open, self.points, self.chars, self.linked, self.text = [], Counter(), Counter(), Counter(), ""

        def handle_starttag(self, tag, attrs):
            self.open.append((tag, dict(attrs).get("id", tag)))
            if tag == "p":
                self.text = ""

        def handle_endtag(self, tag):
            self.open.pop()
            if tag == "p" and len(self.text) >= 25:
                for up, (_, x) in enumerate(reversed(self.open[-4:])):
                    self.points[x] += (1 + self.text.count(",") + min(len(self.text) / 100, 3)) / 2**up

        def handle_data(self, data):
            tags = [t for t, _ in self.open]
            if "p" in tags:
                self.text += data
                for _, x in self.open:
                    self.chars[x] += len(data)
                    self.linked[x] += len(data) * ("a" in tags)

    plain = Plain()
    plain.feed(page)
    return {x: n * (1 - plain.linked[x] / plain.chars[x]) for x, n in plain.points.items()}


def random_page(rng):
    n = 0

    def words(k):
        return " ".join(rng.choice(["alpha", "beta,", "gamma", "delta."]) for _ in range(k))

    def part(depth):
        nonlocal n
        n, me, inner = n + 1, n, ""
        for _ in range(rng.randint(1, 4)):
            kind, text = rng.random(), words(rng.randint(1, 60))
            if kind < 0.3 and depth < 5:
                inner += part(depth + 1)
            elif kind < 0.45:
                inner += "<script>if (a<b) x = '<!--' + '</p>';</script>"
            else:
                inner += f"<p><a href=x>{text}</a></p>" if kind > 0.85 else f"<p>{text}</p>"
        return f"<div id=n{me}>{inner}</div>"

    return "<html><body>" + "".join(part(0) for _ in range(4)) + "</body></html>"


def test_scoring_without_an_article_element(monkeypatch):
    """Random pages of nested containers: all points, discounted, are the plain implementation's."""
    rng = random.Random(8)
    made = []
    real = h.furniture_of
    monkeypatch.setattr(h, "furniture_of", lambda tag, attributes: made.append(attributes.partition("id=")[2] or tag) or real(tag, attributes))
    for _ in range(200):
        page = random_page(rng)
        made.clear()
        root = h.tree(page)
        name = dict(zip([e for e in h.below(root) if e is not root], made, strict=True))
        h.measure(root)
        h.acquit(root)
        got = {name[e]: e.score * (1 - h.link_density(e)) for e in h.weigh(root) if e.score and e is not root}
        assert got == pytest.approx({k: v for k, v in plain_scores(page).items()})


def test_rows(spark):
    pages = spark.createDataFrame([(1, "u", None, "t"), (None, None, "<p>x</p>", "t"), (2, "u", "", "t"), (2, "u", "", "t")], "page_id bigint, url string, html string, text string")
    got = h.extract_pages(pages)
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got.collect()) == [("1", "", 0), ("2", "", 0), ("2", "", 0), ("None", "x", 1)]
    assert h.extract_pages(pages.limit(0)).count() == 0
