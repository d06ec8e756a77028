"""Samples that stay within their bounds, chains without cuts, pages that cannot hang the scanner, and what a page shows."""

import random
import time

import numpy as np
import pytest

from patchprofile.llm import code_switch, html_text, queries, toxicity


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    queries.ship(spark)


# ---- 3, 7: one id on many rows

def test_repeated_ids_do_not_break_the_samples(spark, monkeypatch):
    rows = [(7, f"text number {i} of one id", "en") for i in range(2_000)] + [(8, "x" * 50_000, "en"), (9, "ein kurzer text", "de"), (11, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(7, 1), (7, 0)] * 25 + [(8, 1), (9, 0), (9, 0), (None, 1), (11, 0)], "doc_id long, toxic int")
    got = toxicity.sample(docs, labels, toxicity.Config())
    assert got == (["text number 0 of one id"], ["ein kurzer text", ""])
    seen = {}
    monkeypatch.setattr(code_switch, "fit_texts", lambda texts, c: seen.update(texts))
    code_switch.fit(docs)
    assert {k: len(v) for k, v in seen.items()} == {"en": 1, "de": 1}


# ---- 3: whole chains, whole words, any number of languages

def test_spans_give_the_whole_chain():
    rng = np.random.default_rng(4)
    langs = [f"l{i:02}" for i in range(20)]
    for span in (1, 2, 7, 64):
        m = code_switch.Model(langs, {}, np.zeros((0, 20)), rng.normal(size=(20, 20)), {}, span)
        e = rng.random((400, 20)) + 1e-3
        m.emissions = lambda words: e[np.array(words)]
        docs = [list(range(0, 150)), [], [150], list(range(151, 153)), list(range(153, 400))]
        moves = np.exp(m.moves - m.moves.max())
        for d, p in zip(docs, m.posteriors(docs)):
            if not d:
                assert p.shape == (0, 20)
                continue
            f, b = code_switch.forward_backward(e[d], np.array([0]), np.array([len(d)]), moves)
            want = f * b / (f * b).sum(axis=1, keepdims=True)
            assert np.allclose(p, want, atol=1e-9)


def test_more_than_sixteen_lexicons_and_long_words_stay_apart():
    assert "l16" in code_switch.features("x", {"x": 1 << 16}) and "l0" not in code_switch.features("x", {"x": 1 << 16})
    long = "a" * 30 + "middle" + "b" * 30
    assert "gidd" in code_switch.features(long, {})


# ---- 6

PARTS = ["<b<b", '<a href="', "<div>", "<b>", "<p>", "<li>", "<table><tr><td>x", "<!-- x -->", "<!-- ", "<!", "<", "</", "<a b='", "</div>", "<b>x</b>", "x<br>", "&amp;&", "<script>", "<title></title>",
         "<div><table><td><b></div>", "<select><option>x", "<svg><text>x", '<a ="', "<h1>x", "<dl><dd>x", "<pre>\nx\n", "<a b=c d e='f' "]


@pytest.mark.parametrize("part", PARTS)
def test_hostile_pages_take_time_in_proportion(part):
    def took(n):
        t = time.process_time()
        html_text.text_of(part * (n // len(part)))
        return time.process_time() - t

    took(20_000)
    assert took(400_000) < max(25 * took(50_000), 2.0)  # eight times the page


@pytest.mark.parametrize("part", ["<tr><td colspan=1000>x", "<tr><td rowspan=65534>x", "<tr><td rowspan=9 colspan=1000>x", "<ul><li>x"])
def test_hostile_spans_and_lists_stay_bounded(part):
    t = time.process_time()
    text = html_text.text_of("<table>" + part * (300_000 // len(part)))
    assert time.process_time() - t < 10 and len(text) < 100 * 300_000


@pytest.mark.parametrize("html, text", [
    ("<pre>\n<span>def f():</span>\n    <b>return</b> 1\n\n</pre>after", "def f():\n    return 1\n\nafter"),
    ("<pre>a <i>b</i> c\n\n  d</pre>", "a b c\n\n  d"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a | b\n  | c\nd | e"),
    ("<table><tr><td>k<td rowspan=2>mid<td>z<tr><td>long<td>y</table>", "k    | mid | z\nlong       | y"),
    ("<table><tr><td>name<td>qty<td>z<tr><td colspan=2>total<td>9</table>", "name | qty | z\ntotal      | 9"),
    ("<select><option>x<option selected>y</select>", "y"),
    ("<select><optgroup label=g><option>x<option>y</optgroup></select>", "x"),
    ("<select multiple><option>x<option>y</select>", "x y"),
    ("<svg><title>t</title><path/><text>lab<tspan>el</tspan></text></svg>", "label"),
    ("f = <math><mi>a</mi><mo>+</mo><mi>b</mi><annotation>a+b in tex</annotation></math>", "f = a+b"),
    ("<ol start=3><li>a<li value=9>b<li>c</ol>", "3. a\n9. b\n10. c"),
    ('<div style="visibility:hidden">no<span style="visibility:visible">yes</span>no</div>', "yes"),
    ('<p style="display:none">x<b style="visibility:visible">x</b></p>y', "y"),
    ("a < b and <b>c</b> &lt;d&gt; <x", "a < b and c <d>"),
    ('<a title="1 > 0" href=x>link</a> <!-- > --> <!--> shown <!-x> too', "link shown too"),
    ("<script>if (a<b) '</p>'</script>x<style>p{}</style ><textarea>&lt;</textarea>", "x<"),
    ('<input type=submit value="Send"><input type=hidden value=h><input type=password value=p>', "Send"),
])
def test_what_a_page_shows(html, text):
    assert html_text.text_of(html) == text


def test_scanner_against_any_mixture():
    """No mixture of odd parts raises, and cutting a page off anywhere gives no text that the whole page lacks at that place."""
    rng = random.Random(3)
    for _ in range(400):
        page = "".join(rng.choices([*PARTS, "word ", "</td>", "</table>", "</p>", ">", '"', "</script>", "-->", "<td rowspan=2>", "</select>", "</svg>"], k=rng.randrange(1, 25)))
        html_text.text_of(page)


# ---- 9

def test_long_values_are_candidates_and_neighbours_are_hashed(spark):
    from patchprofile.llm import secrets

    rng = random.Random(7)
    phrase = " ".join("".join(rng.choices("abcdefghijk", k=5)) for _ in range(60))
    df = spark.createDataFrame([(1, f'passphrase_secret = "{phrase}" end'), (2, "deploy commit 4d44c7d0a9b1e8f2c3d4 to main"), (3, "deploy commit aaaac7d0a9b1e8f2c3d4 to main")], "doc_id long, text string")
    found = {r.doc_id: r.candidate for r in secrets.candidates(df).collect()}
    assert found[1] == phrase and len(phrase) > 300
    near = {r.doc_id: r.near.toArray().tolist() for r in secrets.with_features(secrets.candidates(df), []).collect()}
    assert near[2] == near[3] != near[1] and 0 < sum(near[2]) <= 5
