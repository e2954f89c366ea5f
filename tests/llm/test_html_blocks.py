"""Line blocks against an independent reading of the given pages, wrappers that names must not lose, and hostile pages."""

import time
from html.parser import HTMLParser

import pytest
from conftest import SF001

from riskloom.llm import html_text

STORY = "Long text of the story goes on here. " * 8
TEXT = STORY.strip()


class Article(HTMLParser):
    """Text of <article> or <main> by the standard library's parser, without anything that is named or tagged as furniture."""

    SKIP = {"nav", "aside", "footer", "form", "script", "style", "noscript", "button", "select", "iframe", "textarea", "svg"}
    VOID = {"br", "img", "hr", "meta", "link", "input", "wbr", "source"}
    INLINE = {"a", "b", "i", "em", "strong", "span", "u", "small", "code", "sup", "sub"}
    NAMES = ("comment", "ad", "advert", "sidebar", "share", "related", "cookie", "newsletter", "promo", "banner", "notice", "menu")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.parts = [], [[]]

    def handle_starttag(self, tag, attrs):
        if tag not in self.INLINE:
            self.parts.append([])
        if tag in self.VOID:
            return
        names = " ".join(v or "" for k, v in attrs if k in ("class", "id")).lower().replace("-", " ").replace("_", " ").split()
        self.open.append((tag, tag in self.SKIP or any(n.startswith(x) for n in names for x in self.NAMES)))

    def handle_endtag(self, tag):
        if tag not in self.INLINE:
            self.parts.append([])
        if any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if any(t in ("article", "main") for t, _ in self.open) and not any(off for _, off in self.open):
            self.parts[-1].append(data)

    def text(self):
        return " ".join(x for x in (" ".join("".join(p).split()) for p in self.parts) if x)


def test_given_pages_match_an_independent_reading(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    checked = 0
    for page, text in got.items():
        parser = Article()
        parser.feed(html[page] or "")
        parser.close()
        if parser.text():
            assert text == parser.text()
            checked += 1
    assert checked > len(html) / 2


@pytest.mark.parametrize("html", [
    f"<div class='content has-sidebar'><p>{STORY}</p></div>",
    f"<div class='post no-comments'><article><p>{STORY}</p></article></div>",
    f"<div id='main-menu-story'><p>{STORY}</p></div>",
    f"<form id=aspnet><div><p>{STORY}</p></div></form>",
    f"<div class=sidebar><p>{STORY}</p></div><div class=menu>one two</div>",
    f"<ul class='main-nav'><li>a<li>b</ul><div>{STORY}</div><div class='comment-list'>{STORY * 4}</div><div class='site-footer'>x</div>",
    f"<div>{STORY}</div><ul><li><a href=x>{STORY}</a></ul>",
])
def test_wrappers_are_not_lost_and_furniture_is(html):
    assert html_text.main_text(html) == TEXT


def test_line_blocks_decide_without_article_tags():
    """The surge is found in plain divs; short lines among long ones stay, lines beyond a dive go."""
    links = "<li><a href=x>link</a></li>" * 5
    html = f"<div>Home</div><ul>{links}</ul><div>{STORY}</div><div>Ok.</div><div>{STORY}</div><ul>{links}</ul><div>Tiny end</div>"
    assert html_text.main_text(html) == f"{TEXT} Ok. {TEXT}"


def test_article_keeps_short_lines_after_adverts():
    ads = "<div class='ads'>buy<p>now</p><p>ok</p><p>x</p></div>"
    html = f"<article><p>{STORY}</p>{ads}<p>The end.</p></article><p>outside</p><div class='comments'><p>{STORY * 3}</p></div>"
    assert html_text.main_text(html) == f"{TEXT} The end."


@pytest.mark.parametrize("html", [
    "<a " * 350_000, "<!" * 500_000, '<a x="' * 160_000, "<a '" * 250_000, "<div>" * 200_000, "<div><p>" * 100_000 + "</span>" * 30_000,
    "&amp" * 250_000, "<script>" * 125_000, "<b><i>" * 100_000 + "</b></i>" * 50_000, "<!--" * 250_000,
])
def test_hostile_pages_take_time_in_proportion(html):
    def seconds(text):
        at = time.perf_counter()
        html_text.main_text(text)
        return time.perf_counter() - at

    half = seconds(html[: len(html) // 2])
    assert seconds(html) < max(6 * half, 1.0) and seconds(html) < 5


def test_columns_that_clash_nulls_and_repeated_rows(spark):
    rows = [(1, "u", f"<p>{STORY}</p>", "x", "y"), (1, "u", f"<p>{STORY}</p>", "x", "y"), (None, None, None, None, None), (2, "v", "", "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars string")
    got = sorted(map(tuple, html_text.extract(df).collect()), key=repr)
    assert got == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=repr)
    assert html_text.extract(df.limit(0)).collect() == []
