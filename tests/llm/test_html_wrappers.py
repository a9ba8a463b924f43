"""Wrappers around an article don't cost its text; generated pages give back the text that went in."""

import random
from html import escape

import pytest

from terrace.llm import html_text

TEXT = "The council met on Monday and agreed, after a long debate about the costs, to build a new bridge over the river next year."
TREE = html_text.train(html_text.labelled())


@pytest.mark.parametrize(
    "tag",
    [
        'article class="post tag-news"',
        'main class="content with-sidebar"',
        'div class="has-header-image"',
        'section id="related-work"',
        'article class="widget"',
        'div class="widget"',
        'div class="overflow-hidden"',
        'div title="the hidden truth"',
        'main class="has-sidebar"',
        'div class="content-sidebar-wrap"',
        'div class="site no-comments"',
        'div id=page class="header-fixed nav-open"',
    ],
)
def test_named_wrappers(tag):
    assert html_text.main_text(f"<body><nav>Home</nav><{tag}><h1>Bridge</h1><p>{TEXT}</p></{tag.split()[0]}></body>", TREE).endswith(TEXT)


def test_named_wrapper_of_an_article():
    assert html_text.main_text(f'<main><h1>Bridge</h1><div class="sidebar"><article><p>{TEXT}</p><p class="share">Share this page now</p></article></div></main>', TREE).endswith(TEXT)
    page = f'<article><p>{TEXT}</p></article><section class="comments"><article class="comment"><p>I disagree with this very much.</p></article></section>'
    assert html_text.main_text(page, TREE) == TEXT


@pytest.mark.parametrize("tag", ["form", "button", "select", "noscript", "canvas", "svg"])
def test_unclosed_parts_end_with_their_block(tag):
    page = f"<body><div><{tag}>Menu</div><div><h1>Bridge</h1><p>{TEXT}</p></div></body>"
    assert html_text.main_text(page, TREE).endswith(TEXT)


def test_forms():
    assert html_text.main_text(f"<body><form action=x><h1>Bridge</h1><p>{TEXT}</p><p>Short one.</p></form></body>", TREE) == f"Bridge {TEXT} Short one."
    assert html_text.main_text("<body><form><article><h1>Bridge</h1><p>Short one.</p></article></form></body>", TREE) == "Bridge Short one."
    assert html_text.main_text(f"<p>{TEXT}</p><form>Your name<input><button>Send</button></form>", TREE) == TEXT
    assert html_text.main_text(f"<p>{TEXT} <button>Send</button> <svg><text>x</text></svg></p><script>var a = 1", TREE) == TEXT
    long = html_text.main_text("<button>x " * 20_000 + f"<p>{TEXT}</p>", TREE)  # in linear time
    assert long.endswith(TEXT)


def test_unclosed_links_end_with_their_block():
    assert html_text.main_text(f"<p><a href=x>See also<p>{TEXT}<p>{TEXT}", TREE).endswith(f"{TEXT} {TEXT}")
    assert html_text.main_text(f'<a name="top"><p>{TEXT}<p>{TEXT}', TREE) == f"{TEXT} {TEXT}"
    assert [b.link_density for b in html_text.blocks("<a href=x><p>One</p><p>Two</p></a><p>Three")] == [1, 1, 0]


@pytest.mark.parametrize("token", ["site-header", "ad-slot-2", "cookieBanner", "navbar", "post-comments", "sidebar_left", "SOCIAL-links", "ads"])
def test_names(token):
    assert html_text.named(token)
    assert html_text.main_text(f"<div class='x {token}'><p>{TEXT}</p></div><p>{TEXT}<p>{TEXT}", TREE) == f"{TEXT} {TEXT}"


@pytest.mark.parametrize("token", ["has-sidebar", "tag-news", "no-comments", "header-image-left-aligned", "gradient", "shadow", "related-work", "entry-header", "category-social"])
def test_other_names(token):
    assert not html_text.named(token)


def test_tree_uses_words_and_neighbours():
    def used(tree):
        return set() if len(tree) == 1 else {tree[0]} | used(tree[2]) | used(tree[3])

    assert {0, 1, 2, 3, 4} & used(TREE) >= {0, 2, 3, 4}  # own words, words after, own links, links before
    rows = html_text.labelled()
    assert ((html_text.content(TREE, rows[:, :-1]) >= 0.5) == rows[:, -1]).mean() > 0.94


def page(rng):
    """A page and its main text, put together from parts whose kind is known."""
    words = [x.strip(",.") for x in TEXT.split()] + ["&", "<b>", "naïve", "5 < 6", "\u00a0x"]

    def prose(low, high):
        return [rng.choice(words) for _ in range(rng.randint(low, high))]

    def marked(w):
        out = []
        for x in w:
            x = escape(x)
            out.append(rng.choice([x, x, x, x, f"<b>{x}</b>", f"<a href='/{rng.random()}'>{x}</a>", f"<em class=header>{x}</em>", f"{x}<!-- {x} -->"]))
        return rng.choice([" ", "\n  ", "\t"]).join(out)

    def block(low, high, tag):
        w = prose(low, high)
        text.append(" ".join(" ".join(w).split()))
        return f"<{tag}>{marked(w)}" + rng.choice([f"</{tag}>", ""] if tag == "p" else [f"</{tag}>"])

    text: list[str] = []
    menu = "<ul>" + "".join(f"<li><a href=/{k}>{escape(rng.choice(words))}</a>" for k in range(rng.randint(1, 8))) + "</ul>"
    junk = [f"<nav>{menu}</nav>", f"<div class=menu>{menu}</div>", f"<div class='cookie-notice x'><p>{marked(prose(5, 60))}</div>", f"<aside>{marked(prose(3, 90))}</aside>", f"<div id=ad-{rng.randint(1, 9)}>{marked(prose(1, 40))}</div>",
            f"<form>{marked(prose(1, 5))}<input name=q></form>", f"<script>var x = '<p>{escape(rng.choice(words))}</p>'</script>", "<style>p{}</style>", f"<div style='display: none'>{marked(prose(4, 40))}</div>", f"<div hidden>{marked(prose(4, 40))}</div>"]
    tag = rng.choice(["article", "main", "main class='content has-sidebar'", "article id=post-7 class='post tag-news'"])
    body = [f"<{tag}>", block(1, 9, "h1")]
    for _ in range(rng.randint(1, 12)):
        body.append(block(*rng.choice([(1, 1), (2, 8), (20, 90)]), rng.choice(["p", "p", "p", "h2", "li", "blockquote", "div class=overflow-hidden"]).split()[0]) if rng.random() < 0.8 else rng.choice(junk))
    body.append(f"</{tag.split()[0]}>")
    reply = f"<section class=comments><article class=comment><p>{marked(prose(3, 200))}</p></article></section>"
    around = rng.choice([("", ""), ("<div class='site no-comments'>", "</div>"), ("<div id=wrapper class=nav-open>", "</div>"), ("<form action=x>", "</form>")])
    before, after = rng.sample(junk, rng.randint(0, 4)), rng.sample(junk, rng.randint(0, 4)) + rng.choice([[], [reply]])
    source = ["<!DOCTYPE html><html><head><title>t</title></head><body>", *before, around[0], *body, around[1], *after, f"<footer>&copy; {marked(prose(1, 12))}</footer></body></html>"]
    return "".join(source), " ".join(x for x in text if x)


def test_generated_pages():
    rng = random.Random(5)
    for k in range(200):
        source, text = page(rng)
        assert html_text.main_text(source, TREE) == text, (k, source)
