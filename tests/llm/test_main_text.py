"""Main text: labelled pages, what the clusters decide, names as hints, depth."""

from __future__ import annotations

import random
import time

import pytest

from retailcast.llm import html_text
from retailcast.llm.html_text import main_text

R = random.Random(11)


def words(n: int) -> str:
    return " ".join("".join(R.choice("abcdeilmnorst") for _ in range(R.randint(2, 8))) for _ in range(n))


def labelled(seed: int) -> tuple[str, str]:
    """A page without any telling name or tag around its article, and the article."""
    R.seed(seed)
    blocks = [("h2", words(4))] + [("p", words(R.randint(25, 60))) for _ in range(R.randint(3, 8))]
    blocks[3:3] = [("p", words(2))]
    menu = "".join(f"<li>{words(2)}</li>" for _ in range(R.randint(8, 15)))
    more = "".join(f"<p><a href=/{i}>{words(3)}</a></p>" for i in range(R.randint(4, 9)))
    inner = "".join(f"<{t}>{x}</{t}>" for t, x in blocks)
    return (f"<body><div><ul>{menu}</ul>{inner}<div>{more}</div></div><div><span>{words(3)}</span></div></body>",
            "\n".join(x for _, x in blocks))


@pytest.mark.parametrize("seed", range(20))
def test_clusters_find_the_article(seed, monkeypatch):
    page, want = labelled(seed)
    assert main_text(page) == want
    monkeypatch.setattr(html_text, "clusters", lambda ratios, sigma: [True] * len(ratios))
    assert main_text(page) != want  # the ratio step is what finds it


ARTICLE = "<article><h2 id=share-price>Share price</h2><p>" + "long text here " * 30 + "</p><h2 id='related-work'>Related</h2><p id=search>Short.</p><p>" + "and more of it " * 20 + "</p>%s</article>"
TEXT = "Share price\n" + ("long text here " * 30).strip() + "\nRelated\nShort.\n" + ("and more of it " * 20).strip()


@pytest.mark.parametrize("around", [
    "%s", "<div class='layout has-sidebar'>%s<div class=sidebar><p>" + "side text " * 30 + "</p></div></div>",
    "<form id=aspnetForm><div class=nav-menu><a href=x>a</a></div>%s<input></form>", "<div class='widget-area with-sidebar'>%s</div>",
    "<div class=cookie-bar><p>" + "we use cookies " * 30 + "</p></div>%s<section id=comments><article><p>" + "readers say " * 300 + "</p></article></section>",
    "%s<div class=comment-list><div><p>" + "readers say " * 300 + "</p></div></div>", "<header><p>" + "site " * 50 + "</p></header>%s<form><p>" + "sign up " * 40 + "</p></form>"])
def test_names_are_hints(around):
    assert main_text("<body>" + around % (ARTICLE % "") + "</body>") == TEXT


def test_boilerplate_inside_an_article():
    extra = "<div class='newsletter-box'>Join</div><div class=ad><p>" + "buy this now " * 20 + "</p></div><aside>More</aside><div class=widget-text><p>" + "a block of its own " * 20 + "</p></div>"
    assert main_text(ARTICLE % extra) == TEXT + "\n" + ("a block of its own " * 20).strip()


def test_odd_pages():
    assert [main_text(x) for x in ("", "<nav>x</nav>", "<div class=ad>x</div>", "<form>", "plain", "<p>&amp;&nbsp; a <b>b</b>\n c", "<p>a<![odd thing>b<![if !IE]>c<![endif]>", "a <![open")] == ["", "", "", "", "plain", "& a b c", "abc", "a <![open"]


def test_time_is_linear_in_depth():
    for page in ("<div>x" * 20_000, "<li><ul>" + "<div>x" * 20_000 + "<li>y</li>" * 20_000, "<div>" * 20_000 + "<p>x" * 20_000):
        begin = time.process_time()
        assert main_text(page)
        assert time.process_time() - begin < 5
