"""Hand-labelled pages in layouts that the test tables do not have, compared block by block."""

import duckdb
import pytest

from vigil.llm import html

FOLDER = "/root/testdata/sf0.01"
SAID = "The council met on Tuesday evening to talk about the new bridge, and many people came."
MENU = '<nav><ul><li><a href="a">Home</a></li><li><a href="b">News</a></li></ul></nav>'


@pytest.fixture(scope="module")
def labeller():
    pages = duckdb.execute(f"SELECT html FROM '{FOLDER}/pages.parquet' ORDER BY page_id").fetchall()
    return html.train(html.training_pages([p[0] for p in pages[:300]]))


PAGES = {
    "short list": (
        f"{MENU}<article><h1>Pancakes at home</h1><p>{SAID}</p><ul><li>two eggs</li>"
        "<li>some flour</li><li>a cup of milk</li></ul><p>Mix it all, and wait for ten minutes "
        "before you fry them.</p></article><footer>Copyright 2024</footer>",
        ["Pancakes at home", SAID, "two eggs", "some flour", "a cup of milk",
         "Mix it all, and wait for ten minutes before you fry them."],
    ),
    "table and one-word paragraph": (
        f'<div class="menu"><a href="a">Home</a></div><article><h1>Costs</h1><p>{SAID}</p><table>'
        "<tr><th>Item</th><th>Sum</th></tr><tr><td>Steel</td><td>12</td></tr></table>"
        "<h3>Why</h3><p>Because.</p></article>",
        ["Costs", SAID, "Item", "Sum", "Steel", "12", "Why", "Because."],
    ),
    "figure, list and quote": (
        f"<header><h2>Site</h2></header><main><p>{SAID}</p><figure><img src='x'><figcaption>The "
        "old bridge</figcaption></figure><ul><li>cheap</li><li>strong</li></ul><blockquote>We "
        "need it.</blockquote></main><aside><p>Read also our letter.</p></aside>",
        [SAID, "The old bridge", "cheap", "strong", "We need it."],
    ),
    "named sections": (
        '<article><h1>Shares fall</h1><section class="share-price"><h2>Price</h2>'
        f'<p>{SAID}</p></section><section id="discussion"><h2>Discussion</h2><p>It is a long '
        'story, as all say.</p></section></article><div class="share-buttons"><a href="a">Tweet'
        '</a></div><section id="comments"><p>Nice one!</p></section>',
        ["Shares fall", "Price", SAID, "Discussion", "It is a long story, as all say."],
    ),
    "footer without links": (
        f'<div class="content"><h1>Rain</h1><p>{SAID}</p><p>No.</p></div>'
        '<div class="footer"><p>All rights reserved 2024</p></div>',
        ["Rain", SAID, "No."],
    ),
}


@pytest.mark.parametrize("name", PAGES)
def test_every_block_of_the_article_and_no_other(labeller, name):
    body, want = PAGES[name]
    page = f"<html><head><title>T</title></head><body>{body}</body></html>"
    assert html.main_text([page], labeller)[0].split("\n\n") == want


def test_container_names_are_split_only_where_every_part_is_known():
    path = lambda name: html.blocks(f'<div class="{name}">x</div>')[0][0]
    assert path("share-price") == "div.share-price"
    assert path("share-buttons") == "div.share.buttons"
    assert path("cookieNotice wide") == "div.cookie.notice.wide"
    assert html.taught([f"article {path('share-price')} p", f"article {path('share-buttons')}"]) == [
        True, False,
    ]
