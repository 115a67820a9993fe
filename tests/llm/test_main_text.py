"""Main text: the cut against all labellings, pages of several kinds, odd rows."""

import itertools
import random

import pytest

from tidemark.llm import main_text as M

LONG = "This sentence has a good many words, as the sentences of articles do, and it ends as they end."


def cost(balances, edges, labels):
    value = sum(b if b > 0 else 0 for b, kept in zip(balances, labels) if not kept)
    value += sum(-b for b, kept in zip(balances, labels) if kept and b < 0)
    return value + sum(c for (i, j), c in edges.items() if labels[i] != labels[j])


@pytest.mark.parametrize("seed", range(60))
def test_cut_is_the_least(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 9)
    balances = [rng.randint(-9, 9) for _ in range(n)]
    edges = {(i, j): rng.randint(1, 6) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.5}
    every = [(cost(balances, edges, x), sum(x), x) for x in itertools.product([False, True], repeat=n)]
    best = min(every)
    got = M.minimum_cut(balances, edges)
    assert (cost(balances, edges, got), sum(got)) == best[:2]


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("   ", ""), ("<p></p>", ""), ("<script>var a = '<p>x</p>';</script>", ""),
    (f"<article><h1>Title</h1><p>{LONG}<p>Short.</article>", f"Title {LONG} Short."),
    (f"<article><p>a &lt;b&gt; &amp; &copy; &#233;\n\t c</p><p>{LONG}</p></article>", f"a <b> & © é c {LONG}"),
    (f"<nav><a href='/'>Home</a></nav><article><p>{LONG}</p><div class='ad'>{LONG}</div><p>{LONG}</p></article>", f"{LONG} {LONG}"),
    (f"<header><h1>Site</h1></header><div><p>{LONG}</p><p>{LONG}</p></div><footer><p>{LONG}</p></footer>", f"{LONG} {LONG}"),
    (f"<main><p>{LONG}</p><section id=comments><p>{LONG}</p></section><aside>{LONG}</aside></main>", LONG),
    (f"<div class='sidebar'><p>{LONG}</p></div><div id='cookie-notice'>{LONG}</div><article><p>{LONG}</p></article>", LONG),
    (f"<article><p>{LONG}</p><form><label>Your mail</label><input><button>Send</button></form></article>", LONG),
    (f"<article><p>one <b>two</b>three<br>four</p><p>{LONG}", f"one twothree four {LONG}"),
    (f"<article><p title='a > b'>{LONG}</p><!-- <p>gone</p> --></article>", LONG),
    (f"<article><p>{LONG}</p><p>cut <b", f"{LONG} cut"),
    (f"<body><p>{LONG}</p><ul><li>one</li><li>two</li></ul><p>{LONG}</p></body>", f"{LONG} one two {LONG}"),
])
def test_pages(page, want):
    assert M.main_text(page or "") == want


MENU = "<div>" + "".join(f"<p><a href='/{w}'>{w}</a></p>" for w in ("Home", "World", "Sports", "Weather")) + "</div>"


@pytest.mark.parametrize("page, want", [
    # No element, class or id tells the parts: the menus go, and so does a link between them.
    (f"{MENU}<div><p>{LONG}</p><p>Interval</p><p>{LONG}</p></div>{MENU}<div><p><a href='/'>Back to the start</a></p></div>{MENU}",
     f"{LONG} Interval {LONG}"),
    # Two lines that end no sentence, first and last of the text.
    (f"{MENU}<div><p>Some words</p><p>{LONG}</p><p>{LONG}</p><p>The end</p></div>{MENU}", f"Some words {LONG} {LONG} The end"),
    # An advert does not take the line behind it along, and a line behind the article that nothing else holds is not of it.
    (f"<article><p>{LONG}</p></article><div class='ad'><p>Buy</p></div><div>Interval</div>", LONG),
    (f"<article><p>{LONG}</p></article><div>Top</div>", LONG),
])
def test_pages_without_telling_names(page, want):
    assert M.main_text(page) == want


def test_the_cut_mends_labels(monkeypatch):
    """The same page without smoothness edges loses the short lines of its text."""
    page = f"{MENU}<div><p>Some words</p><p>{LONG}</p><p>Interval</p><p>{LONG}</p></div>{MENU}"
    assert M.main_text(page) == f"Some words {LONG} Interval {LONG}"
    for name in ("NEXT", "SAME_PARENT", "ACROSS"):
        monkeypatch.setattr(M, name, 0)
    assert M.main_text(page) == f"{LONG} {LONG}"


def test_edges_cross_the_border(monkeypatch):
    """A line of no part follows the one part it touches when its own signs are weaker than the edge."""
    monkeypatch.setattr(M, "ACROSS", 3)
    assert M.main_text(f"<article><p>{LONG}</p></article><div>Top</div>") == f"{LONG} Top"


def test_a_page_of_very_many_blocks():
    page = "<div>" + f"<p>{LONG}</p><p>x</p><ul><li><a>l</a></li></ul>" * 5000 + "</div>"
    assert M.main_text(page).count(LONG) == 5000


def test_generated_pages_and_odd_rows(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = M.extract(pages).collect()
    assert len(got) == pages.count() and all(r.n_chars == len(r.text) > 0 and "<" not in r.text for r in got)
    odd = spark.createDataFrame([(None, None, None, "x"), (1, "u", "", "x"), (1, "u", "", "x")], "page_id long, url string, html string, text string")
    assert [(r.text, r.n_chars) for r in M.extract(odd).collect()] == [("", 0)] * 3
    assert M.extract(pages.where("false")).isEmpty()
