"""The tree model on pages whose names are taken off, on layouts that name nothing or name too much, and on odd pages."""

from __future__ import annotations

import re
import time

import pandas as pd
import pytest

from rollmart.llm import html_extraction

LONG = "A long paragraph of the article with many words in it, which goes on for a while so that it is long enough. " * 3
TEXT = LONG.strip()


def learned(pages):
    [counts] = html_extraction._count_labelled(iter([pd.DataFrame({"html": pages})]))
    return html_extraction.potentials({tuple(key): n for *key, n in counts.itertuples(index=False)})


@pytest.fixture(scope="module")
def pages(spark):
    return [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]


@pytest.fixture(scope="module", params=["trained", "untrained"])
def known(request, pages):
    return learned(pages[::2]) if request.param == "trained" else html_extraction.potentials({})


def nameless(html):
    html = re.sub(r"<(/?)(nav|article|header|footer|aside|main)\b", r"<\1div", html)
    return re.sub(r'\s(class|id|role)="[^"]*"', "", html)


def test_held_out_pages_without_names_keep_their_text(pages, known):
    want = [html_extraction.main_text(html, known) for html in pages[1::2]]
    got = [html_extraction.main_text(nameless(html), known) for html in pages[1::2]]
    assert all(want) and sum(a == b for a, b in zip(got, want)) >= 0.95 * len(want)


PROBES = {
    "tables": (
        f"<table><tr><td><a href=/>Home</a></td><td><a href=/a>About</a></td></tr></table><table><tr><td><h1>Title here</h1>"
        f"<p>{LONG}</p><p>Short.</p></td></tr></table><table><tr><td>Copyright 2020 <a href=/t>Terms</a></td></tr></table>",
        f"Title here {TEXT} Short.",
    ),
    "plain divisions": (
        f"<div><a>Home</a> <a>News</a></div><div><h1>Title</h1><p>{LONG}</p><p>short one.</p></div><div>Copyright 2020 Terms</div>",
        f"Title {TEXT} short one.",
    ),
    "words in names of running text": (
        f"<article><h1>T</h1><h2 id=search>Search trees</h2><p id=share>Shares rose</p><section id=related><p>{LONG}</p></section>"
        f"<p class=ad-free>No ads</p><p><span class=menu>Menus</span> of <em id=footer>notes</em></p></article>",
        f"T Search trees Shares rose {TEXT} No ads Menus of notes",
    ),
    "comments and a sidebar by id": (
        f'<article><h1>T</h1><p>{LONG}</p><div id="comments"><p>{LONG}</p></div></article><div id=sidebar><p>{LONG}</p></div>', f"T {TEXT}",
    ),
    "a form around the page": (f"<form id=f><div class=menu><a>x</a></div><article><h1>T</h1><p>{LONG}</p></article></form>", f"T {TEXT}"),
    "sections of an article": (
        f"<div><ul><li><a>A</a></li></ul></div><div><h1>T</h1><section><p>{LONG}</p></section><section><h2>U</h2><p>{LONG}</p></section></div>",
        f"T {TEXT} U {TEXT}",
    ),
}


@pytest.mark.parametrize("name", PROBES)
def test_layouts(known, name):
    html, want = PROBES[name]
    assert html_extraction.main_text(html, known) == want


@pytest.mark.parametrize("piece", ["<title>", "<div></b>", "<b>", "<b><p>x", "<a href='", "<", "<ul><li><b>", "<select>", "</p>"])
def test_odd_pages_take_time_in_proportion(known, piece):
    def seconds(n):
        started = time.process_time()
        html_extraction.main_text(piece * n, known)
        return time.process_time() - started

    small = max(seconds(100_000 // len(piece)), 0.01)
    assert seconds(800_000 // len(piece)) < 24 * small
