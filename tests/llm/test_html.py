"""Main text and cuts."""

import itertools
import random
import re

import numpy as np
import pytest

from riskloom.llm import html as H
from riskloom.llm import mincut
from riskloom.llm.queries import op6_main_text


def cost(lean, edges, labels):
    return sum(max(0, -v) if x else max(0, v) for v, x in zip(lean, labels, strict=True)) + sum(c for a, b, c in edges if labels[a] != labels[b])


def test_cuts_are_least():
    draw = random.Random(2)
    for _ in range(1500):
        n = draw.randint(1, 8)
        lean = [draw.randint(-20, 20) for _ in range(n)]
        edges = [(draw.randrange(n), draw.randrange(n), draw.randint(0, 12)) for _ in range(draw.randint(0, 12))]
        best = min(cost(lean, edges, x) for x in itertools.product([False, True], repeat=n))
        assert cost(lean, edges, mincut.label(lean, edges)) == best
        assert cost(lean, edges, mincut._cut(lean, [e for e in edges if e[0] != e[1]])) == best
    assert mincut.label([], []) == []


ZERO = H.PRIOR  # no looks, containers alone


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("<html><body><nav><a href=x>Home</a></nav><article><h1>T</h1><p>One\n two&nbsp;<b>three</b>&amp;<p>Four</article><footer>end</footer>", "T\nOne two three&\nFour"),
        ("<article>A<br>B<script>var x='</p>'</script><style>p{}</style> C<!-- gone --></article>", "A B C"),
        ("<article><p>Text<aside>side</aside><form><input>ask</form><div class='comments'><p>reader</div><p>More</article>", "Text\nMore"),
        ("<main><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></main>", "a\nb\nc\nd"),
        ("<div id=cookie-notice>We use cookies</div><article>Long&lt;tag&gt; &eacute;&#233;</article><div class=ad>Buy</div>", "Long<tag> éé"),
        ("<article><p>cut off at &am</p><p>last <b", "cut off at &am\nlast"),
        ("<article><div hidden>no</div><div style='display: none'>no</div><p>yes</div></p></article></article>", "no\nno\nyes"),
        ("<article><p>A <math><mi>x</mi><mo>+</mo><mn>1</mn></math> B<noscript><p>C</p></noscript><p><svg><text>D</text></svg><button>E</button></article>", "A x+1 B\nC\nD\nE"),
        ("<article><header><h1>Head</h1></header><p>x</article><header>site</header>", "Head\nx"),
        ("<article>a < b and c > d</article>", "a < b and c > d"),
    ],
)
def test_pages(page, text):
    assert H.extract(page, ZERO) == text


@pytest.mark.parametrize("name", ["layout has-sidebar", "content-sidebar-wrap", "post comments-open", "ad-free article"])
def test_theme_classes_are_no_hints(name):
    body = "<h1>Title</h1><p>First part.</p><p>Second part.</p>"
    for page in (f"<div class='{name}'><article>{body}</article></div>", f"<main><div class='{name}'>{body}</div></main>"):
        assert H.extract(page, ZERO) == "Title\nFirst part.\nSecond part."


def test_an_article_ends_a_hint_above_it():
    body = "<h1>Title</h1><p>First part.</p>"
    for page in (f"<div class=sidebar><article>{body}</article></div>", f"<div class='comments'><main>{body}</main></div>", f"<main><div id=social><article>{body}</article></div></main>"):
        assert H.extract(page, ZERO) == "Title\nFirst part."
    # an article in a thread, in an article, or in an element of boilerplate stays out
    thread = "<div class=comments><div class=comment><article>reader</article></div></div>"
    for page in (f"<main><p>Text</p>{thread}</main>", "<article><p>Text</p><div class=widget><article>teaser</article></div></article>", "<main><p>Text</p><aside><article>teaser</article></aside></main>"):
        assert H.extract(page, ZERO) == "Text"


def test_a_hint_can_be_outweighed_and_teaches_nothing(spark):
    sure = H.PRIOR.copy()
    sure[[9, -1]] = 3.0, -5.0
    page = "<article><p>Text.</p><p class=notice>A notice that belongs to it.</p><p>More.</p></article>"
    assert H.extract(page, sure) == "Text.\nA notice that belongs to it.\nMore."
    assert H.extract(page, ZERO) == "Text.\nMore."
    pages = [(k, f"<article><p>Long enough to be text, number {k}.</p><div class=ad>Long enough to be text, too.</div></article>") for k in range(20)]
    assert np.array_equal(H.fit(spark.createDataFrame(pages, "url int, html string")), H.PRIOR)  # one kind of blocks only


def test_smoothness_joins_a_doubtful_block():
    told = "A long sentence of the story that goes on, with commas, and ends well."
    page = f"<body><div><p>{told}</p><p>Hm ok</p><p>{told}</p></div></body>"
    weights = np.zeros(len(H.PRIOR))
    weights[0], weights[9] = 2.0, -4.0  # long is good
    leans = H.leans(H.parse(page), weights)
    assert leans[1] < 0 < leans[0] and H.extract(page, weights).split("\n")[1] == "Hm ok"


def test_pages_whose_containers_say_nothing(spark):
    """Held-out pages as plain div: classifier and cut against what the elements said; the cut is no worse."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").orderBy("page_id").limit(500).collect()]
    seen = [H.examples(H.parse(p)) for p in pages[:200]]
    weights = H.train(np.concatenate([x for x, _ in seen]), np.concatenate([y for _, y in seen]).astype(float))
    right, alone, n = 0, 0, 0
    for page in pages[200:]:
        truth = [b.article and not b.boilerplate for b in H.parse(page)]
        assert H.labels(H.parse(page), weights) == truth
        plain = H.parse(re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", page).replace(' class="ad"', ""))
        right += sum(a == b for a, b in zip(H.labels(plain, weights), truth, strict=True))
        alone += sum((v > 0) == b for v, b in zip(H.leans(plain, weights), truth, strict=True))
        n += len(truth)
    assert right >= alone and right / n > 0.99


def test_short_and_hot_samples_are_bounded(spark):
    """Copies of one page, with or without a key, are one example."""
    page = "<nav><a>Home</a></nav><article><p>Some text, as it is.</p></article>"
    df = spark.createDataFrame([(None, page)] * 50 + [("u", page)] * 50 + [("v", None)], "url string, html string")
    one = H.train(*(lambda x, y: (x, y.astype(float)))(*H.examples(H.parse(page))))
    assert np.allclose(H.fit(df), one)


def test_deep_and_long_pages():
    assert H.extract("<div>" * 20_000 + "<article>x</article>", ZERO) == "x"
    many = "<article>" + "<p>word</p>" * 5000 + "</article>"
    assert H.extract(many, ZERO).count("\n") == 4999
    assert H.extract("<article>" + "<a title='" * 2000, ZERO) == ""


def test_table_of_pages(spark, sf_dir):
    rows = op6_main_text(spark, sf_dir).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    import html as entities

    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = [" ".join(entities.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert r["text"] == "\n".join(x for x in parts if x) and r["n_chars"] == len(r["text"])


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, "u", None, "t"), (1, "u", None, "t"), (None, None, "<article>x</article>", "t")], "page_id long, url string, html string, text string")
    weights = H.fit(df)
    out, name = H.extract_all(df, weights)
    assert name == "text_1" and sorted(r[name] for r in out.collect()) == ["", "", "x"]
    assert H.extract_all(df.limit(0), H.fit(df.limit(0)))[0].collect() == []
