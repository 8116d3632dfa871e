from __future__ import annotations

import pytest

from tamis.llm import html_text

SCHEMA = "page_id long, url string, html string"
WORDS = "these are the words of a paragraph that says something"
PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x='</p>';</script></head>"
    "<body class='has-sidebar'><header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
    "<div class='ad'>Buy this now</div>{}<aside>More of it</aside><div id='comments'><p>I say so</p></div>"
    "<form><input><button>Go</button></form><footer>&copy; all</footer></body></html>"
)


def _text(html, weights=None):
    return html_text.main_text(html, weights or {})


@pytest.mark.parametrize(
    ("body", "want"),
    [
        (f"<article><h1>A &amp; B</h1><p>{WORDS}</p></article>", f"A & B\n{WORDS}"),
        (f"<main><p>{WORDS}<p><b>two</b>three<br>four</main>", f"{WORDS}\ntwothree four"),
        (f"<article><p>x</p><div class=share>Tweet</div><p>{WORDS}</article>", f"x\n{WORDS}"),
        (f"<article><header><h1>Head</h1></header>{WORDS}<!-- <p>no --></article>", f"Head\n{WORDS}"),
        (f"<article><p>a\n\t b&nbsp;c</p><ul><li>1<li>2</ul>{WORDS}</article>", f"a b c\n1\n2\n{WORDS}"),
        (f"<article><p>1 < 2 &lt; 3 &#233; &unknown;</p>{WORDS}", f"1 < 2 < 3 é &unknown;\n{WORDS}"),
        (f"<div><p>{WORDS}</p><p>{WORDS}</p></div>", f"{WORDS}\n{WORDS}"),
        ("", ""),
    ],
)
def test_pages(body, want):
    assert _text(PAGE.format(body)) == want or (not body and _text(PAGE.format(body)) == "")


def test_the_region_has_the_largest_sum():
    found = html_text.blocks(PAGE.format(f"<div>{WORDS}</div>" * 3 + "<p>x</p>" * 2))
    weights = {"p": -3.0, "div": -0.5}
    start, stop = html_text.region(found, weights)

    def total(a, b):
        score = sum(x.words * (html_text.AGAINST if x.boilerplate else 1) for x in found[a:b])
        return score + sum(weights.get(t, html_text.PLAIN) for x in found[a + 1 : b] for t in x.tags)

    sums = {(a, b): total(a, b) for a in range(len(found)) for b in range(a + 1, len(found) + 1)}
    assert total(start, stop) == max(sums.values())


def test_broken_markup():
    for html in ("<", "<p", "a<b", "<p title='x>y</p>", "</p></div>text", "<script>x", "<!-- x", "<![CDATA[x y]]>"):
        _text(html)
    assert _text("</p></div>text here") == "text here"
    assert _text("<p>one<script>if (a</b) '</p>'</script> two</p>") == "one two"
    assert len(_text("<p>" + "word " * 50_000)) == 249_999
    assert _text("<div>" * 3000 + "deep words are here") == "deep words are here"


def test_weights_come_from_labelled_pages(spark):
    rows = [(i, "u", PAGE.format(f"<article><p>{WORDS}</p><p>{WORDS}</p></article>")) for i in range(20)]
    weights = html_text.learn(spark.createDataFrame(rows, SCHEMA))
    assert weights["li"] < weights["p"] < 0 and min(weights.values()) >= -6
    plain = [(1, "u", f"<div><p>{WORDS}</p></div>")]
    assert html_text.learn(spark.createDataFrame(plain, SCHEMA)) == {}


def test_edge_cases(spark):
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, None), (None, "u", ""), (2, "u", f"<article>{WORDS}\U0001f600</article>"), (2, "u", "\x00")]
    rows += [(3, "v", PAGE.format(f"<article><p>{WORDS}</p></article>"))] * 2
    frame = spark.createDataFrame(rows, SCHEMA)
    got = html_text.extract(frame).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id == 3] == [WORDS] * 2
    more = frame.selectExpr("*", "'t' AS text", "1 AS n_chars", "'p' AS tag", "2 AS inside")
    assert html_text.extract(more).count() == len(rows)


def _pages(n, name="ad", marks=True):
    """Pages whose only trace of an advert is its class, and their article."""
    out = []
    for i in range(n):
        words = [f"{WORDS} {i} {k}" for k in range(3)]
        article = "".join(f"<p>{w}</p>" for w in words)
        inner = f"<article>{article}</article>" if marks else f"<div>{article}</div>"
        advert = f"<div class='{name}'>Buy {i} now and save a lot of money today with this offer of ours</div>"
        out.append((f"<body><nav>Home</nav>{advert}{inner}{advert}<footer>all rights</footer></body>", "\n".join(words)))
    return out


def _random_weights(weights, seed):
    import random

    rng = random.Random(seed)
    return {name: rng.uniform(-6, 6) if name[0] in ".#*" else rng.uniform(-6, -0.02) for name in weights}


def _share(pages, weights, marks):
    return sum(html_text.main_text(html, weights, marks) == want for html, want in pages) / len(pages)


@pytest.mark.parametrize("name", ["ad", "zq17"])
def test_learned_weights_decide(spark, name):
    """Names that no list has, and pages without marks: the weights find the text, random ones don't."""
    rows = [(i, "u", html) for i, (html, _) in enumerate(_pages(40, name))]
    weights = html_text.learn(spark.createDataFrame(rows, SCHEMA))
    assert weights[f".{name}"] <= html_text.OUT and weights[html_text.OUTSIDE] <= html_text.OUT
    for marked, look in ((True, True), (True, False), (False, True)):
        pages = _pages(40, name, marked)
        assert _share(pages, weights, look) == 1
        by_chance = [_share(pages, _random_weights(weights, seed), look) for seed in range(40)]
        assert sum(by_chance) / 40 < 0.8
    assert _share(_pages(40, "zq17", False), {}, True) == 0  # nothing tells without weights


def test_names_of_wrappers_are_not_boilerplate(spark):
    """A name around all of the page says nothing; one that only labelled texts have speaks for them."""
    rows = [(i, "u", f"<div class='page'>{html}</div>") for i, (html, _) in enumerate(_pages(30, "zq17"))]
    weights = html_text.learn(spark.createDataFrame(rows, SCHEMA))
    assert abs(weights[".page"]) < 0.1
    assert len(html_text.learn(spark.createDataFrame(rows[:2], SCHEMA)).keys() & {".page", ".zq17"}) <= 2
