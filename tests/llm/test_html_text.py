import random

import pytest

from flowsift.llm.html_text import extract, page_lines, shared_lines

SCHEMA = "page_id long, url string, html string"


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.randint(0, rng.choice([2, 6])) for _ in range(rng.randint(0, 18))]
        b = [rng.randint(0, 5) for _ in range(rng.randint(0, 18))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        kept = [x for x, f in zip(a, shared_lines(a, b), strict=True) if f]
        rest = iter(b)
        assert len(kept) == best[-1][-1] and all(x in rest for x in kept)


@pytest.mark.parametrize(
    "html,main",
    [
        ("<nav>m</nav><article><h1>T &amp; U</h1><p>a <b>b</b>c<br>d\n e</article><footer>f</footer>", "T & U a bc d e"),
        ("<div class='ad'>x</div><main><p>y<script>if(a<b){}</script><form>q</form></p></main>", "y"),
        ("<article>a<div class='comments'><p>no</p></div><aside>no</aside>b</article>", "a b"),
        ("<nav><ul><li>m<article><p>x</article>", "x"),
        ("<article><p>&eacute;&#233;&nbsp;z &lt;b&gt;", "éé z <b>"),
        ("<div id='cookie-notice'>c</div><div class='post-content'>p</div></div></span>", "p"),
    ],
)
def test_main_region(html, main):
    assert " ".join(t for r, t in page_lines(html) if r == "main") == main


def page(*lines):
    return "<html><body>" + "".join(f"<p>{x}</p>" for x in lines) + "</body></html>"


def test_differencing_with_the_nearest_page(spark, stored):
    rows = [
        (1, "http://h.org/a/1", page("Site", "one", "Imprint")),
        (2, "https://H.org/a/2?x=1", page("Site", "two", "both", "Imprint")),
        (3, "http://h.org/z", page("Other", "far")),
        (4, "http://lonely.org/a", page("only", "page")),
        (5, "http://copy.org/1", page("same", "text")),
        (6, "http://copy.org/2", page("same", "text")),
        (7, None, page("nowhere")),
        (8, "http://h.org/a/3", None),
        (9, "http://h.org/b", "<article>Site</article>"),
        (1, "http://h.org/a/1", page("Site", "one", "Imprint")),
    ]
    got = {r.page_id: r for r in extract(stored(rows, SCHEMA)).collect()}
    want = {1: "one", 2: "two both", 3: "Other far", 4: "only page", 5: "same text", 6: "same text", 7: "nowhere", 8: "", 9: "Site"}
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert extract(stored(rows, SCHEMA)).count() == len(rows) and extract(stored([], SCHEMA)).count() == 0


@pytest.mark.parametrize(
    "html,main",
    [
        ("<article class='post comments-open'>a</article>", "a"),
        ("<main class='no-sidebar'>a</main>", "a"),
        ("<div id='content' class='share-enabled'>a</div>", "a"),
        ("<form action='/'><article>a</article></form>", "a"),
        ("<div class='has-sidebar'><article>a</article></div>", "a"),
        ("<div class='ad'>x<article>a</article>", "a"),
        ("<article><p class='ad'>x<p>text<ul><li class='ad'>x<li>y</ul>z</article>", "text y z"),
        ("<article>a<div class='comments'><article class='comment'>no</article></div><div class='social-share'>no</div></article>", "a"),
    ],
)
def test_class_words_do_not_take_the_article(html, main):
    assert " ".join(t for r, t in page_lines(html) if r == "main") == main


def test_a_page_of_dropped_lines_is_compared(spark, stored):
    rows = [(1, "http://h.org/1", "<head><title>T</title></head><div class='ad'>Site</div><div class='notice'>one</div>"),
            (2, "http://h.org/2", page("Site", "two"))]
    assert {r.page_id: r.text for r in extract(stored(rows, SCHEMA)).collect()} == {1: "one", 2: "two"}


@pytest.mark.parametrize(
    "html",
    [
        "<article>story</article><div id='comments'><ol><li><article class='comment-body'>reader</article></ol></div>",
        "<article>story</article><div class='related'><article>teaser</article></div>",
        "<main>story</main><div class='comments'><article>reader</article><div class='content'>reader</div></div>",
        "<article>story</article><article class='comment'>reader</article><article class='comment-body'>reader</article>",
        "<div class='related'><article>teaser<div class='post-content'>teaser</div></article></div><article>story</article>",
        "<article>story</article><section class='replies'><div itemprop='articleBody'>reader</div></section>",
        "<div class='ad'/>advert</div><article>story</article>",
        "<div class='comments'><article>story</article></div>",
        "<form><article>story</article><input name='q'></form><div class='related'><article>teaser</article></div>",
        "<article>story<div class='comment-list'/>reader</div></article>",
    ],
)
def test_comments_and_teasers_are_not_the_story(html):
    assert " ".join(t for r, t in page_lines(html) if r == "main") == "story"


def test_very_long_page_and_equal_neighbours(spark, stored):
    long = "".join(f"<p>line {i}</p>" for i in range(6000))
    rows = [
        (1, "http://h.org/b", page("Site", "mine", "left", "right")),
        (2, "http://h.org/a", page("Site", "left")),
        (3, "http://h.org/c", page("Site", "right")),
        (4, "http://long.org/1", f"<body>{long}<p>one</p>"),
        (5, "http://long.org/2", f"<body>{long}<p>two</p>"),
    ]
    got = {r.page_id: r.text for r in extract(stored(rows, SCHEMA)).collect()}
    # Of two neighbours that are as near, the one before is taken.
    assert got[1] == "mine right" and got[4] == "one" and got[5] == "two"


def test_pages_with_a_main_region_are_compared_too(spark, stored):
    rows = [
        (1, "http://h.org/a/1", "<article><p>Site<p>one</article><div class='ad'>x</div>"),
        (2, "http://h.org/a/2", "<article><p>Site<p>two<p>both</article>"),
        (3, "http://far.org/1", "<article><p>Site<p>both</article>"),
        *[(k, None, "<main>Site</main>") for k in range(4, 8)],
    ]
    got = {r.page_id: (r.text, r.n_shared) for r in extract(stored(rows, SCHEMA)).collect()}
    # Shared lines are found on every page; those that the markup names as main come back.
    want = {1: ("Site one", 1), 2: ("Site two both", 1), 3: ("Site both", 0)}
    assert got == want | {k: ("Site", 0) for k in range(4, 8)}
