"""Main text by minimum cuts: the flow against all labellings, and pages of several builds."""

import random
from itertools import product

import pytest

from patronlens.llm import mincut


def labelling_cost(weights, links, labels):
    """What the unlike terminals and the cut edges of a labelling add up to."""
    ends = sum((-w if keep else w) for w, keep in zip(weights, labels, strict=True) if (w < 0) == keep and w)
    return ends + sum(c for a, b, c in links if labels[a] != labels[b])


@pytest.mark.parametrize("seed", range(30))
def test_the_cut_is_the_cheapest_labelling(seed):
    rng = random.Random(seed)
    n = rng.randrange(1, 9)
    weights = [rng.choice([0, 1, -1]) * rng.randrange(1, 12) / 2 for _ in range(n)]
    links = [(rng.randrange(n), rng.randrange(n), rng.randrange(1, 9) / 2) for _ in range(rng.randrange(0, 16))]
    links = [(a, b, c) for a, b, c in links if a != b]
    network = mincut.Network(weights)
    for a, b, c in links:
        network.join(a, b, c)
    network.saturate()
    got = network.source_side()
    want = min(labelling_cost(weights, links, labels) for labels in product([False, True], repeat=n))
    assert labelling_cost(weights, links, got) == pytest.approx(want)


def test_labels_of_a_page_are_the_cheapest():
    page = mincut.read("<div><p>Some words of an article that goes on.<p>Short<ul><li><a>One</a><li><a>Two</a></ul><p>More words, and more, and an end.</div>")
    weights = [*mincut.odds(page), *([0.0] * len(page.elements))]
    links = list(mincut.edges(page))
    n = len(page.blocks)
    cost = {labels: labelling_cost(weights, links, labels) for labels in product([False, True], repeat=len(weights))}
    best = min(cost, key=cost.get)
    assert list(best[:n]) == mincut.content(page) == [True, True, False, False, True]


PROSE = [f"Sentence {i} of the story tells what happened there, and who saw it." for i in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in PROSE)
MENU = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>News &amp; more</a></li></ul>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><style>p{{}}</style></head><body><nav>{MENU}</nav><article>{BODY}</article><footer>&copy; me.</footer></body></html>",
        f"<body><div id=top-menu>{MENU}</div><div class='page with-sidebar'><main>{BODY}</main><div class=sidebar><p>Read this too, a long text of another story, please.</p></div></div>",
        f"<body>{MENU}<div>{BODY}</div>{MENU}<div><a href=/x>Imprint</a> | <a href=/y>Contact</a></div>",
        f"<article>{BODY}<section class='comments'><article><p>I think so too, and I have seen it as well, my friend.</p></article></section></article>",
        f"<article>{BODY}<div class='ad'>Buy this now, it is the best that there is, and cheap.</div><form><p>Write to us, we would like to hear.</p><input></form></article>",
        f"<div role=banner><h1>The Daily Page</h1></div><div class=content>{BODY}</div><div class='cookie-notice'><p>We use cookies to make this page better for you.</p></div>",
        f"<aside><p>On the side there is a text with many words in it, too.</p></aside><script>var t='</p><p>never shown, never, at all, in no way.</p>'</script><article>{BODY}",
        f"<body hidden-thing><!-- <p>not this</p> --><header><p>Welcome to this page, dear reader of it.</p></header>{BODY}<!-- open",
    ],
)
def test_page_builds(page):
    assert mincut.main_text(page) == "\n".join(PROSE)


def test_short_blocks_between_paragraphs_stay():
    page = f"<article><header><h1>A title</h1></header>{BODY}<p>No.</p><p>1</p>{BODY}</article>"
    assert mincut.main_text(page) == "\n".join(["A title", *PROSE, "No.", "1", *PROSE])


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("<", ""), ("<article>", ""), ("<article>a &lt; b<article", "a < b"),
        ("<article><p>a\n\t b&nbsp;&#x263A;&eacute;<br>c<b>d</b>e <i>f</i></p></article>", "a b ☺é cde f"),
        ("<article><p class=\"x>y\">one<p id=it's>two</article>", "one\ntwo"),
        ("<article><p>x</b></div></p>y</article>", "x\ny"),
        ("<article><pre>a\n  b</pre><table><tr><td>c<td>d</table></article>", "a b\nc\nd"),
    ],
)
def test_odd_markup(html, text):
    assert mincut.main_text(html) == text


def test_very_long_and_hostile_pages_take_time_in_proportion():
    page = "<nav><a>x</a></nav>" + "<div>" * 20_000 + "<p>Words of a story, many of them, follow here.</p><ul><li><a>m</a></ul>" * 20_000
    assert mincut.main_text(page).count("\n") == 19_999
    assert mincut.main_text("<article>" + '<x a="' * 50_000) == ""
    assert mincut.main_text("<article><p " + "y" * 300_000 + ">z") == "z"


def test_tables_of_pages(spark):
    rows = [(1, "u", f"<nav>{MENU}</nav>{BODY}", "t", 3), (None, None, None, None, None), (1, "u", f"<nav>{MENU}</nav>{BODY}", "t", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = mincut.extract(pages, ["page_id", "url"]).orderBy(mincut.F.col("page_id").asc_nulls_first()).collect()
    text = "\n".join(PROSE)
    assert [tuple(r) for r in got] == [(None, None, "", 0)] + 2 * [(1, "u", text, len(text))]
    assert mincut.extract(pages.limit(0), ["page_id"]).count() == 0
    listed = mincut.blocks(pages, ["page_id", "text"]).where("_content").orderBy("page_id", "_block").collect()
    assert [r._text for r in listed[::2]] == PROSE and {r.text for r in listed} == {"t"}
    assert all(r._text in rows[0][2][r._start : r._end] for r in listed)
