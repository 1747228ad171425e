from __future__ import annotations

import pytest

from ontime.llm import html_extraction

FIELDS = "page_id long, url string, html string, host string, skeleton string, text string"


def extracted(spark, pages):
    rows = [(i, u, h, "x", "y", "z") for i, (u, h) in enumerate(pages)]
    found = html_extraction.main_texts(spark, spark.createDataFrame(rows, FIELDS)).collect()
    assert len(found) == len(pages)
    assert all(r.n_chars == len(r.text) for r in found)
    return [r.text for r in sorted(found, key=lambda r: r.page_id)]


FURNITURE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head>
<body><header><h2>Site</h2></header><nav><ul><li><a href="/a">Menu</a></li><li><a href="/b">Other</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><aside><p>Side</p></aside><form><label>Search</label><input></form>%s
<section id="comments"><article class="comment"><p>Reader says</p></article></section><footer><p>&copy; foot</p></footer></body></html>"""

CASES = {
    "<article><h1>Title</h1><p>One  <b>bold</b>word</p><p>Two &amp; &eacute;&#33;</p></article>": "Title\n\nOne boldword\n\nTwo & é!",
    "<main><div>First<br>line<p>Second</div></main>": "First line\n\nSecond",
    "<article><p>Text<div class='ad'>Buy</div><p>More<script>x<1</script></article>": "Text\n\nMore",
    "<article><p>Never closed &am": "Never closed &am",
    "<article></article>": "",
    "<ARTICLE><P>Upper</P><!-- no <p>comment</p> --><ul><li>a</li><li>b</li></ul></ARTICLE>": "Upper\n\na\n\nb",
    "<article><p>1 < 2 and a<b</p></article>": "1 < 2 and a",
    "<article><p>x</p><nav><a href=x>next</a></nav><p style='display:none'>hidden</p></article>": "x",
}


def test_cases(spark):
    pages = [("http://a.org/", FURNITURE % body) for body in CASES]
    got = extracted(spark, pages)
    for text, (body, expected) in zip(got, CASES.items(), strict=True):
        if "Never closed" in body:
            assert text.startswith("Never closed")
        else:
            assert text == expected, body


def test_unclosed_menu_does_not_swallow_the_article(spark):
    page = "<body><nav><ul><li><a href=x>m</a><article><p>Body text</p></article></body>"
    assert extracted(spark, [("http://a.org/", page)]) == ["Body text"]


def test_pages_without_article_lose_what_all_pages_of_the_host_share(spark):
    page = "<body><div>Welcome to our site</div><div><a href=x>Linked words here</a></div><div>Story %s</div></body>"
    pages = [("http://a.org/", page % i) for i in range(5)]
    pages.append(("http://b.org/", page % "alone"))
    got = extracted(spark, pages)
    assert got[:5] == [f"Story {i}" for i in range(5)]
    assert got[5] == "Welcome to our site\n\nStory alone"


def test_nulls_empties_repeats_and_long_pages(spark):
    long = "<article>" + "<p>word</p>" * 30_000 + "</article>"
    pages = [(None, None), (None, ""), ("no scheme", "plain"), ("http://a.org/", long), ("http://a.org/", long), ("http://a.org/", "<" * 5000), ("http://c.org/", "<a href='" * 200)]
    got = extracted(spark, pages)
    assert got[:3] == ["", "", "plain"]
    assert got[3] == got[4] == "\n\n".join(["word"] * 30_000)


def test_empty_table(spark):
    pages = spark.createDataFrame([], FIELDS)
    assert html_extraction.main_texts(spark, pages).collect() == []


def symbols(items):
    return [item.symbol for item in items]


def test_runs_are_folded_into_groups():
    items = html_extraction.folded("<ul> <li> #r </li> <li> #r </li> <li> #r </li> </ul> #r #r".split())
    assert symbols(items) == ["<ul>", "(<li> #r </li>)+", "</ul>", "(#r)+"]
    assert [slot for item in items for slot in item.slots] == [[0, 1, 2], [3, 4]]


@pytest.mark.parametrize(
    ("first", "second", "wrapper"),
    [
        ("a #r b", "a #r b", "a #r b"),
        ("a b", "a #r b", "a #r? b"),
        ("a (<li>_#r)+ b", "a <li> #r b", "a (<li>_#r)+ b"),
        ("a <li> #r b", "a (<li>_#r)+ b", "a (<li>_#r)+ b"),
        ("a x b", "a y b", "a x? y? b"),
    ],
)
def test_alignment(first, second, wrapper):
    split = lambda text: [part.replace("_", " ") for part in text.split()]
    assert html_extraction.merged(split(first), split(second)) == split(wrapper)
    places = html_extraction.aligned_slots(split(wrapper), split(first))
    assert places == [0] * html_extraction.slot_count(first)


def test_many_skeletons_are_merged_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(html_extraction, "MERGE_GROUP", 3)
    pages = [("http://a.org/", "<article>" + "".join(f"<h{1 + (i >> k) % 2}>t{k}</h{1 + (i >> k) % 2}>" for k in range(5)) + "</article>") for i in range(32)]
    assert extracted(spark, pages) == ["\n\n".join(f"t{k}" for k in range(5))] * 32


NAMED = {
    '<div class="content has-sidebar"><article><p>Text</p></article></div>': "Text",
    '<div class="no-sidebar"><article><p>Text</p></article></div>': "Text",
    '<div class="sidebar"><p>Out</p><div id="social"><article><p>Text</p></article></div></div>': "Text",
    '<div class="widget"><nav><ul><li>x<main><p>Text</p></main></div>': "Text",
    '<article class="post comments-open"><p>Text</p></article>': "Text",
    '<article class="promo"><p>Text</p></article>': "Text",
    '<article><h2 id="related-work">A</h2><section id="social"><p>B</p></section><div id="search-results">C</div></article>': "A\n\nB\n\nC",
    "<article><p>If <math><mi>x</mi></math> <label>then</label> y</p></article>": "If x then y",
    '<article><p>Text</p><article class="comment-body"><p>C</p></article></article>': "Text",
    '<article><p>Text</p><div id="comments"><article class="user"><p>C</p></article></div></article>': "Text",
    '<article><p>Text</p><div class="site-footer">F</div><p class="related">R</p></article>': "Text",
    '<article><p>Text</p><div class="ad-slot">A</div><div class="related-posts"><p>R</p></div></article>': "Text",
    '<article><p>Text</p><div class="author-bio"><p>B</p></div><div class="inline-ad">A</div></article>': "Text",
    '<article><p>Text</p><div class="user-comments"><p>C</p></div><div id="reader-comments">D</div></article>': "Text",
    '<article><h2 id="slot-machines">A</h2><p class="unit">B</p><div class="biology">C</div></article>': "A\n\nB\n\nC",
    '<aside class="widget"><article><p>Out</p></article></aside><article data-id="ad"><p>Text</p></article>': "Text",
}


def test_names_count_as_a_whole_and_drop_no_article(spark):
    pages = [("http://a.org/", f"<body>{body}</body>") for body in NAMED]
    for text, (body, expected) in zip(extracted(spark, pages), NAMED.items(), strict=True):
        assert text == expected, body


def test_copies_of_a_page_do_not_make_its_text_furniture(spark):
    page = "<body><h1>Title</h1><p>Lead</p><div>Body in one block</div><div><a href=x>Links</a></div></body>"
    wrapped = "<body><h1>Title</h1><p>Lead</p>%s<div>Body in one block</div></body>"
    other = "<body><h1>Title %d</h1><p>Lead %d</p><table><tr><td>Cell %d</td></tr></table></body>"
    whole = "Title\n\nLead\n\nBody in one block"
    pages = [(f"http://a.org/{i}", page) for i in range(3)]
    pages += [(f"http://b.org/{i}", page) for i in range(300)]
    pages += [(f"http://c.org/{i}", page) for i in range(5)]
    pages += [(f"http://c.org/o{i}", other % (i, i, i)) for i in range(5)]
    pages += [(f"http://d.org/{i}", wrapped % ("<hr>" * i)) for i in range(5)]
    got = extracted(spark, pages)
    assert set(got[:308]) == {whole}
    assert got[308:313] == [f"Title {i}\n\nLead {i}\n\nCell {i}" for i in range(5)]
    assert got[313:] == [whole] * 5


def test_a_title_before_the_article_is_told_by_the_wrapper(spark):
    """What differs over the host's pages goes with the article, what does not stays out."""
    page = (
        "<body><div>Welcome to our site</div><h1>Title %d</h1><p>Lead %d</p>"
        "<p><a href=x>Story number %d</a></p><article><p>Text %d</p></article><p>After %d</p></body>"
    )
    pages = [(f"http://a.org/{i}", page % (i, i, i, i, i)) for i in range(6)]
    pages += [(f"http://b.org/{i}", page % (1, 1, 1, 1, 1)) for i in range(6)]
    got = extracted(spark, pages)
    assert got[:6] == [f"Title {i}\n\nLead {i}\n\nText {i}" for i in range(6)]
    assert got[6:] == ["Text 1"] * 6
