"""Quality, toxicity and HTML labellers: exact inference, gradients, held-out accuracy."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from vigil.llm import html, quality, toxicity
from vigil.llm.common import table
from vigil.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    first = np.array([0, 1, 4, 9])
    unary, change = rng.normal(size=(9, 2)), rng.normal(size=(2, 2))
    ones, pairs = quality.forward_backward(first, unary, change)
    for a, b in zip(first, first[1:]):
        total, one, pair = 0.0, np.zeros(b - a), np.zeros((b - a, 2, 2))
        for states in itertools.product((0, 1), repeat=int(b - a)):
            s = sum(unary[a + i, y] for i, y in enumerate(states))
            s = np.exp(s + sum(change[x, y] for x, y in zip(states, states[1:])))
            total += s
            one += s * np.array(states)
            for i, (x, y) in enumerate(zip(states, states[1:])):
                pair[i, x, y] += s
        assert np.allclose(ones[a:b], one / total)
        assert np.allclose(pairs[a:b], pair / total)


def test_line_features_do_not_depend_on_the_batch():
    texts = ["a b.\nC!! D!!\n\n", None, "", "x", "same same same\nz"]
    together = quality.lines(pa.array(texts))
    assert np.diff(together.first).tolist() == [4, 1, 1, 1, 2]
    for i, text in enumerate(texts):
        alone = quality.lines(pa.array([text], pa.string()))
        part = together.features[together.first[i] : together.first[i + 1]]
        assert np.allclose(part, alone.features)


def test_ftrl_finds_the_telling_feature_and_stays_sparse():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        label = int(i % 4 == 0)
        at = rng.choice(np.arange(10, 500), 30, replace=False)
        rows.append((np.append(at, 3) if label else at, label))
    weights = toxicity.train(rows, bits=9, epochs=3)
    assert weights[3] == weights.max() > 1
    assert (weights[:-1] != 0).mean() < 0.2


def test_lstm_gradients():
    rng = np.random.default_rng(0)
    model = html.BiLstm(width=5, hidden=3)
    model.weights["out"] = rng.normal(size=6)
    x, sizes = rng.normal(size=(4, 3, 5)), np.array([4, 2, 1])
    y = (rng.random((4, 3)) < 0.5).astype(float)

    def loss():
        scores, _ = model.forward(x, sizes)
        real = np.arange(4)[:, None] < sizes
        each = np.logaddexp(0, scores) - y * scores
        return each[real].sum() / real.sum()

    slopes = model.gradients(x, sizes, y)
    for name, weight in model.weights.items():
        flat, slope = weight.reshape(-1), slopes[name].reshape(-1)
        for i in rng.choice(len(flat), min(6, len(flat)), replace=False):
            before = flat[i]
            flat[i] = before + 1e-6
            up = loss()
            flat[i] = before - 1e-6
            down = loss()
            flat[i] = before
            assert np.isclose((up - down) / 2e-6, slope[i], atol=1e-6)


def test_padding_does_not_reach_real_places():
    model = html.BiLstm(width=4, hidden=3)
    model.weights["out"] = np.ones(6)
    x = np.random.default_rng(1).normal(size=(6, 2, 4))
    x[3:, 1] = 0.0
    both, _ = model.forward(x, np.array([6, 3]))
    x[3:, 1] = 9.0
    assert np.allclose(both[:3, 1], model.forward(x, np.array([6, 3]))[0][:3, 1])
    alone, _ = model.forward(x[:3, 1:], np.array([3]))
    assert np.allclose(both[:3, 1], alone[:, 0])


def test_blocks():
    page = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style>'
        '<script>var t="</p>";</script></head><body><nav><ul><li><a href="x>y">m</a><li>n</ul></nav>'
        "<!-- <p>no</p> --><article class='Post-body main'><p><b>a &amp; b<br>c<p> d\n e&nbsp;f "
        "</article><footer>&copy; z</footer>tail"
    )
    assert [(p.split()[-1], t) for p, t, _ in html.blocks(page)] == [
        ("title", "T"), ("li", "m"), ("li", "n"), ("p", "a & b c"), ("p", "d e f"),
        ("footer", "© z"), ("body", "tail"),
    ]
    assert html.blocks(page)[1][2] == 1.0
    assert "article.post.body.main" in html.blocks(page)[3][0]
    for broken in ("<p", "<p>a<", "a < b > c", "<<p>>x", '<a href="', "<script>x", "<!-- x", "</p>y"):
        html.blocks(broken)


def test_skipped_elements_end_where_html_ends_them():
    said = lambda page: [t for _, t, _ in html.blocks(page)]
    for element in (
        '<svg-icon name="x"></svg-icon>', "<select-box>", "<template-x/>", "<object-y >", "<style-z>",
        '<svg class="i"/>', '<svg title="a > b" />', "<svg/>", "<svg><path d='M0'/></svg>",
        "<svg>a<svg>b</svg>c</svg>", "<script>a</scripty>b</script >", "<STYLE>p</style\n>",
        "<textarea><p>a</textarea>", "<template><p>a<template>b</template></p>c</template>",
        "<noscript><p>no</p></noscript>", "<select><option>a</select>",
        "<object><object>a</object>b</object>",
    ):
        assert said(f"<p>One</p>{element}<p>Two</p>") == ["One", "Two"], element
        assert said(f"<p>One</p>{element}<p>Two</p><svg><g/></svg><p>Three") == ["One", "Two", "Three"]
    for open_only in ("<svg>", "<svg class=a/>", "<select>", "<object>", "<template>", "<noscript>"):
        assert said(f"<p>One</p>{open_only}<p>Two</p>") == ["One", "Two"]
    assert said("<p>One</p><svg><p>Two</p><svg>x</svg><p>Three</p>") == ["One", "Two", "Three"]
    assert said("<p>One</p><script>x<p>Two</p>") == ["One"]


def test_attributes_are_read_as_html_does():
    said = lambda page: [t for _, t, _ in html.blocks(page)]
    long = "<p>leak</p> " * 5000
    assert said(f"""<p>One</p><div data-json='{long}' srcdoc = "{long}"><p>Two</p></div>""") == ["One", "Two"]
    assert said("<p>One</p><a title=don't>Two</a><p>Three it's></p>") == ["One", "Two", "Three it's>"]
    assert said("<p>One</p><a it's x='>'>Two</a><p>Three's</p>") == ["One", "Two", "Three's"]
    assert said("""<p>One</p><a href="x>Two</a><p>Three</p>""") == ["One", "Two", "Three"]
    assert said("<p>One</p><a b=>Two</a><p a=b/>Three") == ["One", "Two", "Three"]
    assert said("<p>One</p><svg d='a>b' /><p>Two</p></svg>x < y <z a=") == ["One", "Two", "x < y <z a="]
    html.blocks("<a b='" * 200_000)
    html.blocks("<a b=x " * 200_000)
    html.blocks("</script " * 100_000 + "<script>" + "</script " * 100_000)


@pytest.fixture(scope="module")
def labeller():
    import duckdb

    pages = duckdb.execute(f"SELECT html FROM '{FOLDER}/pages.parquet' ORDER BY page_id").fetchall()
    return html.train(html.training_pages([p[0] for p in pages[:120]]))


def test_other_layouts(labeller):
    page = """<html><body><header><h2>Site</h2></header><div class="cookie-notice"><p>We use
    cookies.</p></div><main><h1>Head</h1><p>First paragraph, rather long and plain.</p>
    <aside class="ad"><p>Buy this now.</p></aside><p>Second paragraph.</p></main>
    <section id="comments"><p>Nice one!</p></section><form><p>Join us</p></form></body></html>"""
    want = "Head\n\nFirst paragraph, rather long and plain.\n\nSecond paragraph."
    assert html.main_text([None, page, ""], labeller) == ["", want, ""]


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r for r in table(spark, FOLDER, "labels").collect()}
    for name, label, folds, out in (
        ("op4_quality_classifier", "quality", 3, 1), ("op6_toxicity", "toxic", 5, 0),
    ):
        rows = QUERIES[name](spark, FOLDER).collect()
        assert len(rows) == 1000
        for r in rows:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out)
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        held = [(r.predicted, truth[r.doc_id][label]) for r in rows if r.held_out and r.doc_id in truth]
        assert np.mean([a == b for a, b in held]) > 0.93


def test_defined_cases_of_classifiers(spark):
    docs = spark.createDataFrame(
        [(1, "good text here.", 0.1, "p"), (2, None, 0.2, "p"), (None, "", None, None),
         (1, "good text here.", 0.1, "p")],
        "doc_id long, text string, score double, predicted string",
    )
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, label int")
    for known in (labels, labels.limit(0)):
        for fit, score in ((quality.fit, quality.score), (toxicity.fit, toxicity.score)):
            rows = score(docs, fit(docs, known)).collect()
            assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
            if known is not labels:
                assert {r.score for r in rows} == {0.5}
    assert quality.score(docs.limit(0), quality.fit(docs, labels)).collect() == []


def test_html_defined_cases(spark, labeller):
    pages = spark.createDataFrame(
        [(1, "u", None, 3), (1, "u", "", 3), (None, None, "<article><p>x y z.</p></article>", 3)],
        "page_id long, url string, html string, text int",
    )
    rows = html.extract(pages, labeller).collect()
    assert sorted((r.n_chars, r.text) for r in rows)[:2] == [(0, ""), (0, "")]
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html.extract(pages.limit(0), html.fit(pages.limit(0))).collect() == []
