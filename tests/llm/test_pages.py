"""Reading of pages: broken markup, hidden elements, hostile pages, and the supplied pages against a plain reader."""

from __future__ import annotations

import time
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest

from barloom.llm import htmltext


def texts(page):
    return [b.text for b in htmltext.blocks(page)]


@pytest.mark.parametrize(
    "page, want",
    [
        ('<article><p>one <svg class="i"/> two</p><p>three</p></article>', ["one two", "three"]),
        ("<article><p>one <math/> two</p><p>three</p></article>", ["one two", "three"]),
        ('<p>a<svg><path d="x"/><title>no</title><g><text>no</text></g></svg>b</p>', ["ab"]),
        ("<p>a<svg><g><path></g></svg><p>b", ["a", "b"]),
        ("<p>a<svg><g><p>b</p><p>c</p>", ["a", "b", "c"]),
        ("<svg><foreignObject><p>no</p></foreignObject></svg><p>yes</p>", ["yes"]),
        ("<svg><svg></svg>no</svg>yes", ["yes"]),
        ("<p><a href=/foo/>link</a> text</p>", ["link text"]),
        ("<p>a</p><object><p>x</p><object>y</object>z</object><p>w</p>", ["a", "w"]),
        ("<p>a</p><object><p>kept", ["a", "kept"]),
        ("<noscript><p>no</p></noscript><p>b</p><select><option>1<option>2</select>", ["b"]),
        ("<object><!-- </object> --><p>kept</p>", ["kept"]),
        ("<p>&<b>amp;</b> &amp;lt; &copy 2020 &#x41;&nbsp;z</p>", ["&amp; &lt; © 2020 A z"]),
        ("a</>b</ x>c<?php x ?>d<!-->e<!--x-->f<!DOCTYPE html>", ["abcdef"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
        ("<title>x</title><script>'</p>'</script><style>p{}</style>t", ["t"]),
        ("<script>x", []),
        ('<script data-x="</script>">no</script>yes', ["yes"]),
        ("<p>one<p>two<div>three</div>four", ["one", "two", "three", "four"]),
        ("<ul><li>a<ul><li>b</ul><li>c</ul>", ["a", "b", "c"]),
        ("a < b and c > d <b>e</b>", ["a < b and c > d e"]),
        ("line<br>break <i>in</i>side<hr>after", ["line break inside", "after"]),
        ("", []),
    ],
)
def test_blocks(page, want):
    assert texts(page) == want


def test_paths_and_links():
    got = htmltext.blocks('<div class="mainNav top" id=x><a href="/y">link</a> and <p>text</p></div><p><a>open</div>')
    assert [(b.path, b.linked) for b in got] == [(("div", ".main", ".nav", ".top", ".x"), 4), (("div", ".main", ".nav", ".top", ".x", "p"), 0), (("p",), 4)]


HOSTILE = ("<a ", '<a "', "<div>x", "<i>", "<b><i>x</b>", "<a x=", "<p class='", "&", "<svg><svg>", "<object>", "<!--", '<a x="', "</p>", "<td>", "<svg/>", "<script>", "<title/>", "<svg><desc>", "<div><p>", "</", "<![CDATA[", "<li><ul>", "<a href=/>", "=" * 9)


@pytest.mark.parametrize("part", HOSTILE)
def test_hostile_pages_take_linear_time(part):
    """200 kB and more of each: seconds would mean work that grows with the square of the length."""
    n = max(20_000, 200_000 // len(part))
    for page in (part * n + '"', (part + '"') * n, "<div " + part * n + ">x"):
        began = time.perf_counter()
        htmltext.blocks(page)
        assert time.perf_counter() - began < 5


def test_deep_pages_keep_their_text_and_bounded_paths():
    got = htmltext.blocks("".join(f"<div class='a{k} b'>t{k} " for k in range(3000)) + "</div>" * 3000 + "<p>end</p>")
    assert [b.text for b in got] == [*(f"t{k}" for k in range(3000)), "end"] and max(len(b.path) for b in got) <= (htmltext.OUTER + htmltext.INNER) * 3
    assert got[-1].path == ("p",)


def test_long_pages_are_labelled_as_short_ones():
    """In parts, with the state carried on, the labels are those of the whole."""
    model = htmltext.train()
    page = [b for p in htmltext.made_pages(60, seed=5) for b, _ in p]
    whole = model.predict(htmltext.batch([htmltext.vectors(page)]))[0]
    assert abs(whole - model.predict_long(page, step=37)).max() < 1e-4


class Article(HTMLParser):
    """Text of the article element, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.parts.append(" ")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        self.parts.append(" " if tag in ("p", "h1", "article") else "")

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_supplied_pages_against_a_plain_reader(folder):
    pages = pq.read_table(f"/root/testdata/{folder}/pages.parquet")["html"].to_pylist()
    got = htmltext.extract_texts(htmltext.train(), ["" if p is None else p for p in pages])
    for page, text in zip(pages, got, strict=True):
        plain = Article()
        plain.feed(page or "")
        assert text == " ".join("".join(plain.parts).split())


FOREIGN = [
    # Pages of other makes than the generator's: what must be in the text, and what must not.
    (
        """<html><body><div id="masthead"><a href="/">The Daily</a><a href="/s">Sport</a></div><div class="cookie-consent">We use cookies to make this site work. Accept all</div>
        <main><article class="post"><header><h1>Bridge reopens after nine months</h1></header><p>The old bridge over the river was opened again on Monday, nine months after the flood.</p>
        <figure><img src="x.jpg"></figure><p>Engineers replaced two of its four piers, and the road on it is wider than before.</p><blockquote><p>It is better than it ever was, said the mayor.</p></blockquote>
        <ul><li>Two lanes for cars</li><li>One lane for bicycles</li></ul></article></main><aside class="related"><h3>Related</h3><a href="/1">Flood of the century</a><a href="/2">New school</a></aside>
        <section id="comments"><h2>3 comments</h2><div class="comment"><p>Finally! I had to drive around for months.</p></div></section><footer><p>© 2021 The Daily. All rights reserved.</p></footer></body></html>""",
        ["Bridge reopens after nine months", "nine months after the flood.", "two of its four piers", "better than it ever was", "One lane for bicycles"],
        ["Sport", "cookies", "Flood of the century", "drive around", "All rights reserved"],
    ),
    (
        """<body><table><tr><td><ul class=menu><li><a href=a.html>Home</a><li><a href=b.html>Recipes</a><li><a href=c.html>About</a></ul></td><td><div class="content"><h1>Bread without kneading</h1>
        <p>Mix flour, water, salt and a little yeast in a bowl, cover it and wait until tomorrow, at least eighteen hours.<p>Fold the dough twice, let it rest for two hours more, and bake it in a very hot pot.</div></td></tr></table>
        <div class=advert>Buy the best pots here, now cheaper!</div><form action=/news><label>Your address</label><input name=a><button>Subscribe</button></form><div class="footer">Contact | Imprint</div>""",
        ["Bread without kneading", "eighteen hours.", "very hot pot."],
        ["Recipes", "best pots", "Subscribe", "Imprint"],
    ),
]


@pytest.mark.parametrize("k", range(len(FOREIGN)))
def test_pages_of_other_makes(k):
    page, inside, outside = FOREIGN[k]
    (text,) = htmltext.extract_texts(htmltext.train(), [page])
    assert all(x in text for x in inside), text
    assert not any(x in text for x in outside), text
