"""Pages of other shapes than the labelled ones, and pages of any length."""

from __future__ import annotations

import time

import pytest

from tidemark.llm import html
from tidemark.llm.labelled_pages import pages

LONG = (
    "The boat had left the harbour early and the crew was tired after many hours of work, so nobody saw the small light "
    "that appeared in the west. It came closer while they slept, and in the morning it was gone again."
)
MENU = '<ul><li><a href="/1">Home</a></li><li><a href="/2">About us</a></li><li><a href="/3">Contact</a></li></ul>'

#: Name, page, and its main text.
SHAPES = [
    ("plain division", f"<body><div><p>{LONG}</p><p>{LONG}</p></div></body>", [LONG, LONG]),
    ("one paragraph", f"<body><p>{LONG}</p></body>", [LONG]),
    ("encyclopedia", f'<body><div id="mw-navigation">{MENU}</div><div class="mw-parser-output"><p>{LONG}</p><h2>History</h2><p>{LONG}</p></div><div id=footer>Edited</div></body>', [LONG, "History", LONG]),
    ("site header", f"<body><header><h1>Site name</h1></header><article><h1>Title</h1><p>{LONG}</p></article><footer>Imprint</footer></body>", ["Title", LONG]),
    ("article header", f"<body><nav>{MENU}</nav><article><header><h1>Title</h1></header><p>{LONG}</p></article></body>", ["Title", LONG]),
    ("reply box", f'<body><article><h1>Title</h1><p>{LONG}</p></article><div id="respond"><h3>Leave a reply</h3><p>I liked this text very much</p></div></body>', ["Title", LONG]),
    ("thread", f'<body><div class="topic"><h1>Question</h1><div class="message"><p>{LONG}</p></div></div><div class="replies"><div class="reply"><p>{LONG}</p></div></div></body>', ["Question", LONG]),
    ("script with a slash", f"<body><article><p>{LONG}</p><script src=x />var a = 1;</script><p>{LONG}</p></article></body>", [LONG, LONG]),
    ("layout by table", f"<table><tr><td>{MENU}</td><td><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></td></tr></table>", ["Title", LONG, LONG]),
    ("copies of a block", f"<body><main><p>{LONG}</p><p>{LONG}</p></main></body>", [LONG, LONG]),
]


@pytest.fixture(scope="module")
def model():
    return html.train(pages())


@pytest.mark.parametrize("name, page, want", SHAPES, ids=[shape[0] for shape in SHAPES])
def test_shapes_the_model_has_not_seen(model, name, page, want):
    assert html.main_text(f"<html><head><title>T</title></head>{page}</html>", model) == "\n".join(want)


def test_an_empty_table_of_pages(spark):
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_time_grows_with_the_page_alone():
    def took(n):
        began = time.process_time()
        html.parse("<body>" + "<font>x" * n + "<p>y" * n + "<b><i>z" * n)
        return time.process_time() - began

    took(500)
    assert took(16_000) < 12 * max(took(4_000), 0.02)
