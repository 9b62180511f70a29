"""Extraction on hand-written pages, and on what could make a parser slow."""

import time

import pytest

from spotweave.llm import html_text

# Unlike the pages that the trees are trained on: (source, blocks of the main text).
P1 = "The council approved the new bridge on Tuesday after three hours of debate, ending a dispute that had lasted for most of the decade."
P2 = "Construction will begin in spring. Engineers expect the work to take two years, and the old crossing will stay open until then."
P3 = "Residents of the eastern bank, who have long asked for a shorter way into town, welcomed the decision."
PAGES = [
    # a server page: one form around everything
    (f'<html><body><form id="aspnetForm" method="post"><input type="hidden" name="__VIEWSTATE" value="x"><div class="topbar"><a href="/">Home</a> <a href="/n">News</a> <a href="/s">Sport</a></div><div class="content"><h1>Bridge approved</h1><p>{P1}</p><p>{P2}</p><p>{P3}</p></div><div class="footer">Copyright 2019 Town Paper. All rights reserved.</div></form></body></html>',
     ["Bridge approved", P1, P2, P3]),
    # formulas and drawings within paragraphs
    (f'<body><nav><a href=a>One</a><a href=b>Two</a></nav><main><h1>On areas</h1><p>The area is <math><mi>a</mi><mo>=</mo><mn>4</mn></math> in all, as the first book says, and that settles the matter.</p><p>{P2} <svg width=4><path d="M0"/></svg>So it goes.</p></main><footer>Contact us</footer></body>',
     ["On areas", "The area is a=4 in all, as the first book says, and that settles the matter.", P2 + " So it goes."]),
    # a blog with a sign-up form and comments
    (f'<html><body><header class="site-header"><h1>My Blog</h1></header><article class="post"><h2>A long walk</h2><p>{P1}</p><p>{P3}</p><form class="newsletter" action="/join"><p>Join our list and never miss a post.</p><input name="mail"><button>Join</button></form><p>{P2}</p></article><section id="comments"><h3>2 comments</h3><div class="comment"><p>Lovely piece, thank you for writing it.</p></div><div class="comment"><p>I disagree with every word.</p></div></section></body></html>',
     ["A long walk", P1, P3, P2]),
    # lists and a quotation in the article, a sidebar beside it
    (f'<html><body><div id="wrap"><aside class="sidebar"><h3>Popular</h3><ul><li><a href="1">Ten tips</a></li><li><a href="2">Nine tricks</a></li></ul></aside><div class="entry-content"><h1>What changed</h1><p>{P1}</p><ul><li>The toll is gone for good, said the mayor.</li><li>Lorries may cross at night, but not by day.</li></ul><blockquote><p>{P3}</p></blockquote><p>{P2}</p></div></div><div class="cookie-banner"><p>We use cookies to improve your visit. Please accept them.</p><button>Accept</button></div></body></html>',
     ["What changed", P1, "The toll is gone for good, said the mayor.", "Lorries may cross at night, but not by day.", P3, P2]),
    # unclosed tags and tables for layout
    (f'<table><tr><td class="menu"><a href=1>Start</a><br><a href=2>Archive</a><td class="main"><h2>Old style</h2><p>{P1}<p>{P2}<p>{P3}</table><div class="ad">Buy one boat, get one free. Only this week.</div>',
     ["Old style", P1, P2, P3]),
    # a script within a paragraph
    (f'<body><div class="story"><h1>Tracked</h1><p>{P1}<script>track("</p>")</script> More on this tomorrow, we are told.</p><p>{P3}</p></div><div class="related"><h4>Related</h4><ul><li><a href=1>Bridge plans shown</a></li></ul></div></body>',
     ["Tracked", P1 + " More on this tomorrow, we are told.", P3]),
]


@pytest.mark.parametrize("i", range(len(PAGES)))
def test_hand_written_pages(i):
    source, want = PAGES[i]
    assert html_text.extract([source], html_text.train()) == ["\n".join(want)]


def test_form_around_the_page_hides_nothing():
    for source, want in PAGES:
        inside = source.replace("<body>", "<body><form method=post>").replace("</body>", "</form></body>")
        assert html_text.extract([inside], html_text.train()) == ["\n".join(want)]


@pytest.mark.parametrize("source", ["<ul>{n}</section>{n}", "<p><button><ul>{n}<h1>{n}", "<table><td>{n}<tr>{n}", "<dl>{n}<dd>{n}"])
def test_time_grows_with_length(source):
    def seconds(n):
        first, second = [x for x in source.split("{n}") if x]
        page, begin = first * n + second * n, time.perf_counter()
        html_text.Page(page)
        return time.perf_counter() - begin

    assert seconds(40_000) < 12 * seconds(10_000) + 0.2
