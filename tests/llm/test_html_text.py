"""Main text: the article of varied pages, character references, broken and extreme markup."""

from __future__ import annotations

import time

import pytest

from arbor.llm import html_text

from .helpers import clashing, rows

P1 = "First paragraph, with commas, and enough text to count as prose in any page."
P2 = "Second paragraph, also long, with commas, and some more words at the end."

PAGES = {
    "article": (f"<html><head><title>T</title><script>var t='</p>';</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav>"
                f"<!-- ad --><div class='ad'>Buy, buy, buy, now</div><article><h1>Head</h1><p><b>{P1}<br><p>{P2}</p></article>"
                f"<footer>&copy; x</footer></body></html>", f"Head\n\n{P1}\n\n{P2}"),
    "divs": (f"<body><div id=header>Menu, a, b</div><div class=wrap><div class='post'><p>{P1}</p><p>{P2}</p><ul><li>one<li>two</ul></div>"
             f"<div class=sidebar><p>{P1} side</p></div></div><div id=comments><p>{P1} {P2} reader</p></div>", f"{P1}\n\n{P2}\n\none\n\ntwo"),
    "forms": (f"<main><h2>Head</h2><p>{P1}</p><form><p>Name, mail, and so on, please</p><input></form><div class='cookie-notice'>We, use, "
              f"cookies</div><p>{P2}</p></main>", f"Head\n\n{P1}\n\n{P2}"),
    "links": (f"<div class=x><p><a href=1>one, two, three, four</a></p><p><a href=2>five, six, seven, eight, nine</a></p></div>"
              f"<div class=y><p>{P1}</p><p>{P2}</p></div>", f"{P1}\n\n{P2}"),
    "references": ("<article><p>a &amp; b &lt;c&gt; &#233; &#x1F600; &nbsp;d &eacute &copy x&am</p></article>", "a & b <c> é 😀 d é © x&am"),
    "space": ("<article><p>\n  a\t b \n\n c</p>\n\n<p>  </p><p>d</p></article>", "a b c\n\nd"),
    "plain": ("no markup, at all", "no markup, at all"),
    "unclosed": ("<p>only", "only"),
    "cut": (f"<article><p>{P1}</p><p>{P2} <a hre", f"{P1}\n\n{P2}"),
    "hidden": (f"<article><p>{P1}</p><p hidden>no</p><p style='display: none'>no</p><p>{P2}</p></article>", f"{P1}\n\n{P2}"),
    "cells": ("<article><table><tr><td>a, b<td>c<tr><td>d</table></article>", "a, b\n\nc\n\nd"),
    "names": (f"<body class='no-sidebar'><div class='main with-sidebar'><div class='post-header'>By, someone, today</div><p>{P1}</p>"
              f"<div class='post-comments'><p>{P2}</p></div><div class='ad-content'>Buy, now, buy</div><p>{P2}</p></div>",
              f"By, someone, today\n\n{P1}\n\n{P2}"),
    "title beside": (f"<div class=page><h1>Title</h1><div class=c><p>{P1}</p><p>{P2}</p></div></div>", f"Title\n\n{P1}\n\n{P2}"),
    "short end": (f"<body><div class=x><p>{P1}</p><p>{P2}</p></div><p>Short end.</p><p><a href=/>More, of, this</a></p></body>", f"{P1}\n\n{P2}\n\nShort end."),
    "topic names": (f"<article><p>{P1}</p><div class='social-history'><p>{P1}</p><p>{P2}</p><p>{P2}</p></div><div class='social'><p>Tell, your, friends</p></div>"
                    f"</article>", f"{P1}\n\n{P1}\n\n{P2}\n\n{P2}"),
    "only names": (f"<div class='widget'><p>{P1}</p></div>", P1),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages(name):
    page, want = PAGES[name]
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("page", ["<div>" * 50_000 + "deep, text", "<a " * 50_000, "<b>" * 30_000 + "<p>x" * 3000, "</i>" * 50_000 + "<p>x",
                                  "<p>" + "word, " * 200_000, "<li>" * 20_000, "<!-- " * 20_000, "<script>" * 20_000, "<p a='" * 20_000])
def test_extreme_markup_takes_linear_time(page):
    t = time.time()
    html_text.main_text(page)
    assert time.time() - t < 10


def test_table(spark):
    own = [(i, f"u{i}", p) for i, (p, _) in enumerate(PAGES.values())] + [(90, None, None), (0, "u0", PAGES["article"][0]), (None, "x", "<p>y")]
    got = html_text.extract(clashing(spark.createDataFrame(own, "page_id long, url string, html string")))
    want = [(i, f"u{i}", t, len(t)) for i, (_, t) in enumerate(PAGES.values())]
    want += [(90, None, "", 0), want[0], (None, "x", "y", 1)]
    assert rows(got) == sorted(want, key=repr)
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
