import math

import numpy as np

from tollhouse.llm import html_text
from tollhouse.llm.html_text import CHUNK, extracted, main_text

LONG = "This paragraph is long enough to be the text that somebody came to read on this page, and then some more of it."

PAGE = f"""<!DOCTYPE html><html><head><title>Title</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<!-- ad --><div class="ad">Buy this now.</div><div class="cookie-notice">We use cookies.</div>
<article><h1>Head &amp; line</h1><p><b>{LONG}<br><p>Short.</p><p>A&nbsp;&lt;b&gt; &eacute;  x<i>y</i>z</p><form><input value="q">Sign up<button>Go</button></form>
<div class="share-buttons">Share it</div><p>{LONG} End.</p><section id="comments"><article class="comment"><p>{LONG} said a reader.</p></article></section></article>
<aside>{LONG} Not this.</aside><footer>&copy; us</footer></body></html>"""


def test_article():
    assert main_text(PAGE) == f"Head & line {LONG} Short. A <b> é xyz {LONG} End."


def test_no_article_element():
    page = f"<body><div class='menu'>a b</div><div><a href=x>one</a> <a href=y>two</a></div><div id=content><h2>Top</h2><p>{LONG}</p><p>Be.</p><p>{LONG}</p></div><div><a href=1>p</a><a href=2>q</a></div></body>"
    assert main_text(page) == f"Top {LONG} Be. {LONG}"
    assert main_text(f"<p>{LONG}<p>{LONG}") == f"{LONG} {LONG}"


def test_several_articles_and_main():
    page = "<body><nav>x</nav><article><p>First " + LONG + "</p></article><div class='ads'>ad</div><article><p>Second " + LONG + "</p></article></body>"
    assert main_text(page) == f"First {LONG} Second {LONG}"
    assert main_text(f"<main><p>{LONG}</p><p>tail</p></main><p>outside</p>") == f"{LONG} tail"


def test_unclosed_and_broken():
    assert main_text(f"<nav><ul><li>menu<li>more<article><p>{LONG}") == LONG
    assert main_text(f"<form action=x><article><p>{LONG}</p></article></form>") == LONG
    assert main_text(f"<article><p>{LONG}</div></p></span><p>rest</article>") == f"{LONG} rest"
    assert main_text("<script>never closed " + LONG) == ""
    assert main_text(f"<article><p>{LONG}</p><!-- never closed <p>x</p>").startswith(LONG)
    assert main_text("") == "" and main_text("   ") == "" and main_text("plain words") == "plain words"


def test_very_deep_pages():
    for tag in ("div", "b", "ul><li", "p><b"):
        page = "<article>" + f"<{tag}>" * 20_000 + LONG + "<script>no</script><p>end" + "</div>" * 20_000
        assert main_text(page) == f"{LONG} end"


def test_pieces_of_the_stream_make_no_difference():
    page = PAGE.replace("Short.", "Short. " + "&amp;é " * CHUNK)
    assert main_text(page) == f"Head & line {LONG} Short. " + ("&é " * CHUNK).strip() + f" A <b> é xyz {LONG} End."


def test_rows(spark):
    rows = [(1, "u", PAGE), (2, None, None), (2, None, None), (None, "v", ""), (3, "w", f"<article>{LONG}</article>")]
    pages = spark.createDataFrame([(*r, "clash", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int").repartition(2)
    got = sorted((tuple(r) for r in extracted(pages).collect()), key=repr)
    assert got == sorted(((i, u, main_text(h or ""), len(main_text(h or ""))) for i, u, h in rows), key=repr)
    assert extracted(pages.limit(0)).collect() == []


def test_names_of_the_layout_do_not_hide_the_article():
    aside = "<div class='sidebar'><p>Side text here.</p></div>"
    for name in ("content-sidebar-wrap", "page-with-sidebar", "share-page", "ad-free"):
        assert main_text(f"<body><div class='{name}'><main><p>{LONG}</p><p>{LONG}</p></main>{aside}</div></body>") == f"{LONG} {LONG}"
        assert main_text(f"<body><div class='{name}'><article><p>{LONG}</p><p>{LONG}</p></article>{aside}</div></body>") == f"{LONG} {LONG}"
    assert main_text(f"<body><div class='menu'>a b</div><div class='content-sidebar-wrap'><p>{LONG}</p><p>{LONG}</p></div></body>") == f"{LONG} {LONG}"


def test_sections_of_an_article_are_told_by_their_text():
    for name in ("related-work", "market-share"):
        links = "<div class='related'><a href=x>One more thing to read</a> <a href=y>And another</a></div><div class='share'>Share</div>"
        page = f"<article><p>{LONG}</p><section id='{name}'><p>{LONG} Own.</p></section><p>{LONG}</p>{links}</article>"
        assert main_text(page) == f"{LONG} {LONG} Own. {LONG}"


def test_comments_and_teasers_stay_out():
    comments = f"<div id='comments'><p>{LONG * 9}</p></div><div class='related'><article><p>{LONG} Teaser.</p></article></div>"
    assert main_text(f"<body><article><p>{LONG}</p></article>{comments}</body>") == LONG
    assert main_text(f"<body><div><p>{LONG}</p><p>{LONG}</p></div><div id='comments'><p>{LONG * 9}</p></div></body>") == f"{LONG} {LONG}"


def test_names_and_tags_count_at_any_depth():
    inner = f"<p>{LONG}</p><div class='ad'>Buy this.</div><b><i hidden>no</i></b><form>Sign up</form><div id='comments'><p>{LONG}</p></div>"
    for depth in (3, 700, 5_000):
        assert main_text("<article>" + "<div>" * depth + inner + "</div>" * depth + "<p>end</article>") == f"{LONG} end"
        assert main_text("<div>" * depth + f"<main><p>{LONG}</p></main><p>outside</p>" + "</div>" * depth) == LONG


def blocks_of(page):
    parser = html_text._Blocks()
    parser.feed(page)
    parser.close()
    parser.cut()
    return parser.blocks


PLAIN = f"<body><div>a <b>b</b> <i>c</i></div><div><a href=x>one</a> <a href=y>two</a></div><div id=content><h2>Top</h2><p>{LONG}</p><p>Be.</p><p>{LONG}</p></div><div><a href=1>p</a><a href=2>q</a></div></body>"


def test_ratios_against_plain_loops():
    for page in (PAGE, PLAIN, f"<p>{LONG}<p>x<p><b>y</b><i>z</i>"):
        blocks = blocks_of(page)
        ratio = [max(len(b.text) - b.links, 0) / (1 + b.tags) for b in blocks]
        smooth = []
        for i in range(len(ratio)):
            near = [(math.exp(-0.5 * (i - j) ** 2), ratio[j]) for j in range(len(ratio)) if abs(i - j) <= 2]
            smooth.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
        mean = sum(smooth) / len(smooth)
        least = min(math.sqrt(sum((s - mean) ** 2 for s in smooth) / len(smooth)), max(smooth))
        want = [s >= least - 1e-9 and 2 * b.links <= len(b.text) for s, b in zip(smooth, blocks)]
        assert html_text._content(blocks).tolist() == want


def test_ratios_decide_without_an_article(monkeypatch):
    tags = "<div><b>tag</b> <i>word</i></div>" * 30
    page = f"<body>{tags}<div id=content><h2>Top</h2><p>{LONG}</p><p>Be.</p><p>{LONG}</p></div>{tags}</body>"
    assert main_text(page) == f"Top {LONG} Be. {LONG}"
    monkeypatch.setattr(html_text, "_content", lambda blocks, alone=False: np.ones(len(blocks), bool))
    assert main_text(page).startswith("tag word tag word")
