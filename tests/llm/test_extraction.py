import itertools
import random
import time

from cartloom.llm import extraction
from cartloom.llm.shared import prepared
from tests.llm.shared import rows

PROSE = "This is a paragraph of the article, with some words in it. And it has a second sentence."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class='has-sidebar'>{body}</body></html>"


CASES = {
    "menus and footers": (
        f"<nav><ul><li><a href=a>A</a><li><a href=b>B</a></ul></nav><article><h1>Head</h1><p>{PROSE}</p></article><footer>x</footer>",
        ["Head", PROSE],
    ),
    "adverts, forms, asides, comments inside the article": (
        f"<article><p>{PROSE}</p><div class=ad><p>{PROSE}</p></div><form><p>{PROSE}</p></form><aside>{PROSE}</aside>"
        f"<p>Short.</p><section id=comments><article><p>{PROSE}</p></article></section></article>",
        [PROSE, "Short."],
    ),
    "white space, references, inline markup": (
        "<article><p> a\n <b>b</b>\t&amp;&lt;c&gt;&nbsp;d<br>e</p><p><i></i> </p></article>",
        ["a b &<c> d e"],
    ),
    "unclosed and cut off": (f"<article><h1>H</h1><p><b>{PROSE}<br><p>two<ul><li>x<li>y", ["H", PROSE, "two", "x", "y"]),
    "scripts and notices": (
        f"<div class=cookie-notice><p>{PROSE}</p></div><script>var t = '<p>no</p>';</script><main><p>{PROSE}</p></main>",
        [PROSE],
    ),
    "no article element": (f"<div class=menu><a href=x>one</a> <a href=y>two</a></div><div><p>{PROSE}</p><p>{PROSE}</p></div>", [PROSE, PROSE]),
    "site header and article header": (
        f"<header><h1>Site</h1></header><article><header><h1>Head</h1></header><p>{PROSE}</p></article>",
        ["Head", PROSE],
    ),
    "only boilerplate": ("<nav><a href=x>one</a></nav><footer>two</footer>", []),
}


def test_labelled_pages():
    for name, (body, expected) in CASES.items():
        assert extraction.main_blocks(page(body)) == expected, name


def test_minimum_cut_against_all_labellings():
    rng = random.Random(1)
    for _ in range(150):
        n = rng.randrange(1, 8)
        scores = [rng.choice([-3, -2, -1, 0, 1, 2, 3]) + rng.random() for _ in range(n)]
        edges = [(a, b, rng.random() * 2) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(labels):
            unary = sum(max(s, 0) if not own else max(-s, 0) for s, own in zip(scores, labels))
            return unary + sum(w for a, b, w in edges if labels[a] != labels[b])

        best = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(extraction.minimum_cut(scores, edges)) - best) < 1e-6


def test_closeness_overrules_a_weak_classifier():
    """A short block between paragraphs of one parent goes with them."""
    body = f"<div><p>{PROSE}</p><p>So</p><p>{PROSE}</p></div>"
    assert extraction.main_blocks(page(body)) == [PROSE, "So", PROSE]


def test_rows(spark):
    long = f"<article>{'<p>' + PROSE + '</p>' * 3000}</article>"
    data = [(1, "u", page(CASES["no article element"][0])), (2, None, None), (3, "u", ""), (None, "u", long), (1, "u", "<p"), (1, "u", "<p")]
    frame = prepared(spark).createDataFrame([(*r, "x") for r in data], "page_id long, url string, html string, text string")
    found = rows(extraction.extract(frame).drop("n_blocks"))
    expected = [(i, u, "\n".join(extraction.main_blocks(h))) for i, u, h in data]
    assert found == sorted([(i, u, t, len(t)) for i, u, t in expected], key=repr)
    assert extraction.extract(frame.limit(0)).count() == 0


def test_many_blocks():
    assert len(extraction.main_blocks(page("<article>" + "<p>One more. </p>" * 20_000 + "</article>"))) == 20_000


def test_formulas_and_bylines_stay():
    formula = "<math><mi>x</mi><mo>=</mo><mn>3</mn></math>"
    body = f"<article><h1>Head</h1><p class=byline>By A. Writer</p><p>{PROSE} Let {formula} be the value.</p></article>"
    assert extraction.main_blocks(page(body)) == ["Head", "By A. Writer", f"{PROSE} Let x=3 be the value."]


def test_deep_nesting_takes_linear_time():
    n = 100_000
    pages = [
        "<span>" * n + "x" + "</div>" * n, "<article>" + "<i>" * n + "</div>" * n + f"<p>{PROSE}</p></article>",
        "<div>" * n + "x" + "</div>" * n, "<article>" * n + PROSE, "<p>" + "<b>a<br>" * n, "<nav>" + "<main>" * n + PROSE,
    ]
    start = time.perf_counter()
    texts = [extraction.main_blocks(page(p)) for p in pages]
    assert time.perf_counter() - start < 120
    assert texts[1] == texts[3] == [PROSE]
