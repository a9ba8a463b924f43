"""Time of awkward pages, names of classes, and pages that mark nothing."""

import random
import time

import pytest

from terrace.llm import html_text

TEXT = "The council met on Monday and agreed, after a long debate about the costs, to build a new bridge over the river next year."
SAID = "I think that this is all wrong and that the buses should go round by the old road as they always have done here."
TREE = html_text.train(html_text.labelled())


@pytest.mark.parametrize(
    "page",
    ["<div>" * n + "x" + "</p>" * n if kind == 0 else "<div>" * n + "</div>" * n if kind == 1 else "<button>a " * n if kind == 2 else "<svg>" * n + "</b>" * n if kind == 3 else "<p>a</div></span>" * n if kind == 4 else "<a href=x>b " * n for kind in range(6) for n in (60_000,)],
    ids=["unmatched ends", "deep", "unclosed buttons", "unclosed drawings", "stray ends", "unclosed links"],
)
def test_time_is_linear(page):
    began = time.perf_counter()
    html_text.main_text(page, TREE)
    assert time.perf_counter() - began < 5


JUNK = ["comments-area", "fb-comments", "disqus_thread", "responses", "discussion", "related-articles", "privacy-notice", "popup-overlay", "subscribe-form", "leaderboard-ad", "advertising-label", "alert-box", "outbrain", "taboola", "user-comments", "sponsored-content", "adsbygoogle", "cookieNotice", "comment-list", "site-footer", "newsletter-signup"]


@pytest.mark.parametrize("name", JUNK)
@pytest.mark.parametrize("inside", [True, False])
def test_named_junk_goes(name, inside):
    for junk in (f'<div class="{name}"><p>{SAID}</p></div>', f'<div id="{name}"><p>{SAID}</p></div>'):
        page = f"<body><article><h1>Bridge</h1><p>{TEXT}</p><p>{TEXT}</p>{junk if inside else ''}</article>{'' if inside else junk}</body>"
        assert html_text.main_text(page, TREE) == f"Bridge {TEXT} {TEXT}"


@pytest.mark.parametrize("name", ["has-comments", "tag-news", "with-sidebar", "related-work", "no-ads", "comments-open", "category-sponsored", "post-header", "loading", "shadow", "headline", "padding-top", "navy", "leader", "page-with-comments", "comment-count"])
def test_other_names_stay(name):
    assert html_text.named(name) == ""


def test_headline_in_a_bare_header():
    page = f"<body><header><h1>Bridge for the town</h1></header><p>{TEXT}</p><p>{TEXT}</p></body>"
    assert html_text.main_text(page, TREE) == f"Bridge for the town {TEXT} {TEXT}"
    marked = f"<body><header><h1>The Daily</h1></header><article><h1>Bridge</h1><p>{TEXT}</p></article></body>"
    assert html_text.main_text(marked, TREE) == f"Bridge {TEXT}"
    assert "Home" not in html_text.main_text(f"<body><header><nav><h2>Home</h2></nav></header><p>{TEXT}</p><p>{TEXT}</p></body>", TREE)


def test_pages_that_mark_nothing():
    """Paragraphs between menus of links and named or unnamed junk, without article or main."""
    random.seed(4)
    right = total = 0
    for k in range(60):
        paragraphs = [" ".join(random.choices(TEXT.split(), k=random.randint(25, 80))) for _ in range(random.randint(2, 6))]
        menu = "".join(f"<li><a href=/{j}>{random.choice(['Home', 'News', 'About us', 'Contact'])}</a></li>" for j in range(random.randint(3, 8)))
        junk = random.choice([f'<div class="{random.choice(JUNK)}"><p>{SAID}</p></div>', "<div><a href=a>Read more stories</a></div><div><a href=b>All the latest news</a></div>", ""])
        page = f"<body><div><ul>{menu}</ul></div><h1>A bridge for the town at last</h1>{''.join(f'<p>{p}</p>' for p in paragraphs)}{junk}<div><a href=i>Imprint 2024</a></div></body>"
        expected = " ".join(["A bridge for the town at last", *paragraphs]).split()
        found = html_text.main_text(page, TREE).split()
        right += len(found) if found == expected else 0
        total += len(expected)
        assert SAID not in html_text.main_text(page, TREE)
    assert right > 0.9 * total


def test_skipped_elements():
    assert html_text.main_text(f"<p>{TEXT}<svg><title>a<style>b</svg> end</p><p>{TEXT}</p>", TREE) == f"{TEXT} end {TEXT}"
    assert html_text.main_text(f"<button>a<article><p>{TEXT}</p></article></button>", TREE) == TEXT
