"""Main text of pages: blocks, gradients, labels step by step, held-out pages."""

import re

import numpy as np
import pytest

from trendlake.llm.extraction import (
    PLAIN, BiLstm, _padded, generated_page, leaf_blocks, main_texts, op12_extraction, sampled_words, train_block_model, vectors_of,
)

PAGES = "page_id long, url string, html string, text string, _html string, score double"
BODY = "A first paragraph that is long enough to be read as a part of the article, with two sentences. Here is the other one."


def pages_of(spark, rows):
    return spark.createDataFrame([(i, f"http://a/{i}", h, "old", "x", 0.5) for i, h in rows], PAGES)


@pytest.fixture(scope="module")
def model(spark):
    return train_block_model(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


@pytest.mark.parametrize("page, texts", [
    (None, []), ("", []), ("  plain \n text ", ["plain text"]), ("<p>a<p>b<div>c</div>d", ["a", "b", "c", "d"]),
    ("<p>a &amp; b&lt;c&gt; &eacute; &#233; &nbsp; x &unknown; &am", ["a & b<c> é é x &unknown; &am"]),
    ("<p>a<b>b</b> <i>c</i>d<br>e</p>", ["ab cd e"]), ("a<!-- <p>no</p> -->b<!-- open <p>x", ["ab"]),
    ("<head><title>t</title><style>p{}</style><script>var t='</p>';</script></head>x", ["x"]), ("x<script>if(a<b)", ["x"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]), ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("1 < 2 and <3", ["1 < 2 and <3"]), ("<p title='a > b'>t</p><p title=\"x>y\" class=c>u", ["t", "u"]), ("<p>a</p><a href='x", ["a"]),
    ("<P CLASS=x>A</P></div></p>B", ["A", "B"]), ("<!DOCTYPE html><?xml v?><svg><text>no</text></svg>y<svg/>z", ["yz"]), ("<template>x", ["x"]),
])
def test_blocks(page, texts):
    assert [b.text for b in leaf_blocks(page)] == texts


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "inside" + "</div>" * 20_000
    assert [b.text for b in leaf_blocks(deep)] == ["inside"]
    assert len(leaf_blocks("<p>x y z</p>" * 50_000)) == 50_000


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(0)
    network = BiLstm(width=5, hidden=3)
    network.weights = {k: w.astype(np.float64) for k, w in network.weights.items()}
    vectors = draw.standard_normal((6, 4, 5))
    real = (np.arange(6)[:, None] < np.array([6, 3, 1, 5])).astype(np.float64)
    labels = (draw.random((6, 4)) < 0.5) * real

    def loss():
        z = network.logits(vectors, real)
        return ((np.log1p(np.exp(z)) - z * labels) * real).sum() / real.sum()

    grads = network.gradients(vectors, real, labels)
    for k, w in network.weights.items():
        for _ in range(8):
            at = tuple(draw.integers(0, n) for n in w.shape)
            keep, step = w[at], 1e-5
            w[at] = keep + step
            up = loss()
            w[at] = keep - step
            down = loss()
            w[at] = keep
            assert grads[k][at] == pytest.approx((up - down) / (2 * step), abs=1e-7)


def step_by_step(network, page):
    """Labels of one page, block after block, without batches or padding."""
    w, h = network.weights, network.hidden
    sides = {}
    for d in "fb":
        state, cell, out = np.zeros(h), np.zeros(h), []
        for x in page if d == "f" else page[::-1]:
            g = w[f"in_{d}"] @ x + w[f"bias_{d}"][:, 0] + w[f"rec_{d}"] @ state
            forget, take, show = (1 / (1 + np.exp(-g[i * h:(i + 1) * h])) for i in range(3))
            cell = forget * cell + take * np.tanh(g[3 * h:])
            state = show * np.tanh(cell)
            out.append(state)
        sides[d] = out if d == "f" else out[::-1]
    return [float(w["out"][0] @ np.concatenate(s) + w["start"][0, 0]) for s in zip(sides["f"], sides["b"])]


def test_batches_give_what_single_steps_give(model):
    pages = vectors_of([generated_page(PLAIN, seed)[1] for seed in range(900, 930)] + [[]])
    for page, kept in zip(pages, model.labels(pages)):
        logits = step_by_step(model, page)
        assert all(k == (z >= 0) for k, z in zip(kept, logits) if abs(z) > 1e-3) and len(kept) == len(page)
    vectors, real = _padded(pages[:5])
    assert np.allclose(model.logits(vectors, real)[:len(pages[0]), 0], step_by_step(model, pages[0]), atol=1e-3)


def test_held_out_generated_pages(model):
    words = sorted({w for seed in range(5) for b in generated_page(PLAIN, seed)[1] for w in b.text.split()})
    right = total = 0
    for seed in range(50_000, 50_200):
        _, blocks, labels = generated_page(words, seed)
        right += int((model.labels(vectors_of([blocks]))[0] == (labels > 0)).sum())
        total += len(labels)
    assert right / total > 0.97


def test_query_gives_the_articles(spark):
    """The whole table against a search for the article element; every page is as its only element says."""
    folder = "/root/testdata/sf0.01"
    rows = op12_extraction(spark, folder).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r["page_id"]], re.S).group(1)
        assert r["text"] == "\n\n".join(b.text for b in leaf_blocks(article)) and r["n_chars"] == len(r["text"])


def test_regions_around_an_article(spark, model):
    """Hand-made pages: each region goes, the article stays whole."""
    article = f"<h1>The title of the page</h1><p>{BODY}</p><p>Short.</p><ul><li>One point of the list</li></ul><p>{BODY}</p>"
    text = f"The title of the page\n\n{BODY}\n\nShort.\n\nOne point of the list\n\n{BODY}"
    regions = [
        "<nav><a href=/>Home</a> <a href=/b>About</a></nav>", "<header><h2>The Daily Post</h2></header>", "<footer>&copy; 2024 Example</footer>",
        "<aside class=sidebar><h3>Most read</h3><ul><li><a href=/x>Another story</a></ul></aside>", "<div class='cookie-banner'>We use cookies. <button>Accept</button></div>",
        "<div class=ad>Buy now</div>", "<form><label>Email address</label><input><button>Send</button></form>", "<style>p{}</style><script>var a;</script>",
        f"<section id=comments><h3>Comments</h3><div class=comment><p>I liked this very much, thank you for writing it.</p></div><div class=comment><p>{BODY}</p></div></section>",
    ]
    rows = [(i, f"<html><body>{r}<article>{article}</article></body></html>") for i, r in enumerate(regions[:-1])]
    rows += [(100 + i, f"<html><body><nav><a href=/>Home</a></nav><main>{article}</main>{r}</body></html>") for i, r in enumerate(regions)]
    found = {r["page_id"]: r["text"] for r in main_texts(pages_of(spark, rows), model).collect()}
    assert [i for i, t in found.items() if t != text] == []


def test_awkward_rows(spark, model):
    rows = [(1, None), (2, ""), (None, f"<article><p>{BODY}</p></article>"), (3, "   "), (3, "<script>x</script>"), (4, "<p>"), (5, "<article>" + f"<p>{BODY}</p>" * 3000 + "</article>")]
    rows += [(None, f"<article><p>{BODY}</p></article>")] * 3
    out = main_texts(pages_of(spark, rows), model)
    assert out.columns == ["page_id", "url", "_html", "score", "text"]
    found = [(r["page_id"], r["text"], r["_html"]) for r in out.collect()]
    assert len(found) == len(rows) and all(x == "x" for *_, x in found)
    assert sorted((i, t) for i, t, _ in found if i in (1, 2, 3, 4)) == [(1, ""), (2, ""), (3, ""), (3, ""), (4, "")]
    assert [t for i, t, _ in found if i is None] == [BODY] * 4 and [t for i, t, _ in found if i == 5] == ["\n\n".join([BODY] * 3000)]
    assert main_texts(pages_of(spark, []), model).count() == 0
    assert sampled_words(pages_of(spark, []), 5) == PLAIN
    # Equal pages are one: the sample stays within its bound.
    many = pages_of(spark, [(i, f"<p>{BODY}</p>") for i in range(300)])
    assert sampled_words(many, 5) == BODY.split()
