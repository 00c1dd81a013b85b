"""HTML extraction, personal data and language ID: fixtures, brute force, held-out accuracy."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter
from html import unescape
from itertools import product

import numpy as np
import pytest

from pintime.llm import html_extract, language_id, personal_data
from pintime.llm.common import table
from pintime.llm.labelled_pages import composed
from pintime.llm.personal_data import base_spans, luhn
from tests.llm.helpers import ODD_TEXTS, SF, frame

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script>
</head><body><header>My Site <a href=1>Home</a></header><div class="cookie-banner">We use cookies to
improve this page and to learn how you use it, please accept.</div><nav><ul><li><a>Menu</a></li></ul>
</nav><article><h1>Title &amp; more</h1><p>First   para,<br>with <b>bo</b>ld text &copy now.<p>Second
para &lt;b&gt; is longer than the first one was, I think.<div class="advert">Buy now! It is the best
offer ever made in this shop, so come in.</div><!-- no <p>comment</p> --><ul><li>one<li>two</ul>
</article><section class="comments"><p>Nice article! I liked it a lot, in particular the second part,
which was long enough.</p></section><aside>Other stories</aside><form>Subscribe <input></form>
<footer>&copy; me</footer></body></html>"""


def test_page_of_all_kinds():
    got = html_extract.main_text(PAGE, html_extract.trained())
    assert got == ("Title & more First para, with bold text © now. Second para <b> is longer than the "
                   "first one was, I think. one two")


def test_messages_are_exact_marginals():
    model = html_extract.Model({}, np.array([[0.4, -1.2], [-0.7, 0.9]]))
    parents, odds = [-1, 0, 0, 1, 1, 2], [0.3, -1.0, 0.8, 1.5, -0.2, 0.1]
    _, _, full = model.messages(parents, odds)
    weight = np.zeros((6, 2))
    for ys in product((0, 1), repeat=6):
        score = sum(o * y for o, y in zip(odds, ys, strict=True)) + sum(
            model.pair[ys[p], ys[k]] for k, p in enumerate(parents) if k)
        for k, y in enumerate(ys):
            weight[k, y] += np.exp(score)
    assert full == pytest.approx((np.log(weight[:, 1]) - np.log(weight[:, 0])).tolist())


def test_probability_of_no_main_text_is_exact():
    rng = random.Random(2)
    for _ in range(20):
        pair = np.array([[rng.gauss(0, 1) for _ in range(2)] for _ in range(2)])
        n = rng.randint(1, 8)
        parents = [-1] + [rng.randrange(k) for k in range(1, n)]
        odds = [rng.gauss(0, 2) for _ in range(n)]
        weight = lambda y: np.exp(sum(o * a for o, a in zip(odds, y, strict=True)) + sum(
            pair[y[parents[k]], y[k]] for k in range(1, n)))
        total = sum(weight(y) for y in itertools.product((0, 1), repeat=n))
        model = html_extract.Model({}, pair)
        belief, _, _ = model.messages(parents, odds)
        assert model.empty(parents, belief) == pytest.approx(weight((0,) * n) / total)


SHORT = {
    "<article><p>Rain fell all day.</p><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul>"
    "</article>": "Rain fell all day.",
    "<article><p>Rain fell all day.</p><form><input></form><p>It stopped at night.</p></article>":
        "Rain fell all day. It stopped at night.",
    "<article><header><h1>Rain</h1></header><p>Rain fell all day.</p><footer>By Ann</footer>"
    "</article>": "Rain Rain fell all day.",
    "<div><h1>Rain</h1><p>Rain fell all day.</p><p>It stopped at night.</p></div>":
        "Rain Rain fell all day. It stopped at night.",
    "<p>Rain fell all day. It stopped at night.</p>": "Rain fell all day. It stopped at night.",
    "<article><h1>Physics</h1><p>Energy <math><mi>E</mi>=<mi>mc</mi></math> is the formula.</p>"
    "<p>It is well known.</p></article>": "Physics Energy E=mc is the formula. It is well known.",
}


@pytest.mark.parametrize("page", SHORT)
def test_short_pages_have_text(page):
    got = html_extract.main_text(page, html_extract.trained())
    assert got.startswith(SHORT[page])


def test_held_out_shapes():
    """Pages that the model was not trained on: other seeds, and holders it never saw."""
    others = ["div class=text", "section id=story", "td", "div class=page", "div class=x12",
              "div itemprop=articleBody"]
    for pages in (composed(300, 99), composed(300, 77, others)):
        both = got = want = empty = 0
        for page in pages:
            nodes, pieces = html_extract.labelled(page)
            truth = html_extract.joined(pieces, [n.label == 1 for n in nodes]).split()
            text = html_extract.main_text(re.sub(" y=[01]", "", page), html_extract.trained())
            a, b = Counter(truth), Counter(text.split())
            both, got, want = both + (a & b).total(), got + b.total(), want + a.total()
            empty += not text
        assert both / got >= 0.98 and both / want >= 0.95 and empty / len(pages) <= 0.05


def test_unclosed_elements_take_linear_time():
    started = time.time()
    for page in ("<p>" + "<b>x" * 100_000 + "</i>" * 100_000, "<div>" * 50_000 + "</p>" * 50_000,
                 "<ul><li><ul>" + "<div>" * 30_000 + "<li></li>" * 30_000,
                 "<p>" + "<b>" * 50_000 + "<div></div>" * 50_000):
        html_extract.parse(page)
    assert time.time() - started < 30


def test_articles_of_the_pages_table(spark):
    rows = html_extract.op5_html(spark, "/root/testdata/sf0.01").collect()
    html = {r.page_id: r.html for r in table(spark, "/root/testdata/sf0.01", "pages").collect()}
    assert len(rows) == len(html)
    for r in rows:
        page = html[r.page_id]
        inner = page[page.index("<article>") + 9:].partition("</article>")[0]
        want = " ".join(unescape(re.sub(r"<[^>]*>?", " ", inner)).split())
        assert r.text == want and r.n_chars == len(want)


def test_odd_pages(spark):
    pages = [None, "", "<", "no markup here at all.", "<p>cut off in a ta", "<p>x</p><!-- open",
             "<script>never closed", "<article><p>a &am", "<div>" * 3000 + "deep text, it is here.",
             "<article>" + "<p>word word word.</p>" * 3000 + "</article>"]
    df = spark.createDataFrame([(i, f"u{i}", h, "clash") for i, h in enumerate(pages)],
                               "page_id long, url string, html string, text string")
    rows = {r.page_id: r._text for r in html_extract.extract(df).collect()}
    assert rows[0] == rows[1] == "" and rows[3] == "no markup here at all."
    assert rows[6] == "" and rows[7] == "a &am"
    assert rows[9] == " ".join(["word word word."] * 3000)
    assert html_extract.extract(df.limit(0)).count() == 0


PATTERNS = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    out = []
    for kind, rx in enumerate(PATTERNS):
        for m in rx.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == 0 or kind == 1 and all(
                    int(x[-4:]) <= 255 and not x[:-4].strip("0") for x in m[0].split("."))
                    or kind == 2 and 14 <= len(digits) <= 19 and luhn(digits)
                    or kind == 3 and 10 <= len(digits) <= 15):
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_are_the_patterns():
    rng = random.Random(5)
    parts = ["a", "1", "22", ".", "@", "-", "+", " ", "(", ")", "255.", "4111111111111111", "b.c",
             "a@b.c", "+1 (452) 555-7764", "10.0.0.1", "é", "\n"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert base_spans(text) == plain_spans(text), text


def test_numbers_of_any_length():
    for text in ("0" * 5000 + "1.2.3.4", "1.2.3." + "9" * 5000, "0" * 6000 + "255.0.00.000",
                 "256.1.1.1", "1.1.1.0256", "00.0.0.0", "+" + "1" * 5000, "4" * 5000):
        assert base_spans(text) == plain_spans(text), text[:40]
    assert len(base_spans("0" * 5000 + "1.2.3.4")) == 1
    (base, _), = personal_data.find(["0" * 5000 + "1.2.3.4 (" + "7" * 30 + ")"], None)
    assert base == [(0, 5007, 1)]


def test_features_see_whole_words():
    long = personal_data._own_features("(" + "1" * 30 + ")", "1" * 30)
    assert long[personal_data._F["(digits)"]] == 1.0
    late = personal_data._own_features("1" * 70 + "x", "1" * 70)
    assert late[personal_data._F["letters"]] == 1.0


def test_long_runs_take_no_quadratic_time():
    for text in ("a" * 200_000, "1" * 200_000, "a." * 100_000 + "@", "@" * 100_000,
                 "1.1." * 50_000, "+1 " * 50_000):
        base_spans(text)


def test_repeated_numbers_get_one_label(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    field = personal_data.fit(docs)
    text = "card 4111111111111111 is here. Much later 4111111111111111 12 appears in the text"
    (base, added), = personal_data.find([text], field)
    assert base == [(5, 21, 2)] and added == [(42, 58, 2)]
    assert personal_data.redact(text, base + added) == (
        "card [CARD] is here. Much later [CARD] 12 appears in the text")
    # base patterns alone lose it
    assert personal_data.find([text[22:]], None) == [([], [])]


def test_repeated_numbers_with_blanks_get_one_label(spark):
    field = personal_data.fit(table(spark, "/root/testdata/sf0.1", "documents"))
    card, phone = "4111 1111 1111 1111", "+44 20 7946 0958"
    for first, again, kind in ((card, f"{card} 12", "CARD"), (phone, f"{phone} 1234", "PHONE"),
                               (card.replace(" ", ""), f"{card} 12", "CARD")):
        text = f"first {first} is here. Much later {again} appears in the text"
        assert personal_data.find([text[len(first) + 7:]], None) == [([], [])]
        (base, added), = personal_data.find([text], field)
        rest = again.rpartition(" ")[2]
        assert personal_data.redact(text, base + added) == (
            f"first [{kind}] is here. Much later [{kind}] {rest} appears in the text")


def test_a_distant_occurrence_reaches_every_repeat(spark):
    field = personal_data.fit(table(spark, "/root/testdata/sf0.1", "documents"))
    many = "and 4111 1111 1111 1111 13 there. " * 40
    (base, added), = personal_data.find([many + "card 4111 1111 1111 1111 is here"], field)
    assert len(base) == 1 and len(added) == 40
    g = personal_data.graph(["x 123456 y" * 40])
    assert (g.links[:, 0] == 0).all() and len(g.links) == 39


def test_loopy_messages_are_exact_on_a_tree():
    rng = np.random.default_rng(2)
    g = personal_data.Graph(np.zeros(4, int), np.arange(4), np.arange(4) + 1,
                            rng.random((4, len(personal_data.FEATURES))),
                            np.array([[0, 1], [1, 2], [1, 3]]), 2)
    field = personal_data.Field(rng.normal(size=(len(personal_data.FEATURES), 5)),
                                rng.normal(size=(5, 5)), rng.normal(size=(5, 5)))
    p, both = personal_data.infer(g, field, rounds=80)
    unary, weight = g.x @ field.unary, np.zeros((4, 5))
    for ys in product(range(5), repeat=4):
        s = sum(unary[i, y] for i, y in enumerate(ys))
        s += field.chain[ys[0], ys[1]] + field.chain[ys[1], ys[2]] + field.skip[ys[1], ys[3]]
        for i, y in enumerate(ys):
            weight[i, y] += np.exp(s)
    assert p == pytest.approx(weight / weight.sum(axis=1, keepdims=True), abs=1e-3)
    assert both[0].sum(axis=1) == pytest.approx(p[0], abs=1e-3)


def test_personal_data_rows(spark):
    texts = [*ODD_TEXTS, "mail é a.b@c.de, ip 10.0.0.1 and +1 (452) 555-7764; 300.1.1.1"]
    df = frame(spark, texts)
    rows = {r.doc_id: r for r in personal_data.personal_data(df, personal_data.fit(df)).collect()}
    for d, t in enumerate(texts):
        base = plain_spans(t or "")
        names = ",".join(f"{personal_data.KINDS[k]}:{s}:{e}" for s, e, k in base)
        assert rows[d].base_sha256 == hashlib.sha256(names.encode()).hexdigest()
        assert set(filter(None, names.split(","))) <= set(rows[d].spans.split(","))
    last = rows[len(texts) - 1]
    assert (last.n_email, last.n_ip, last.n_card, last.n_phone) == (1, 1, 0, 1)
    none = frame(spark, ["no such thing", None])
    assert personal_data.fit(none) is None
    assert personal_data.personal_data(none.limit(0), None).count() == 0


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = language_id.op10_language_id(spark, sf).join(
        table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == 1000 and 200 < len(held) < 300
    assert (held.lang == held.lang_pred).mean() >= 0.99
    assert got.score.between(0, 1).all()


def test_language_mixtures_and_odd_texts(spark):
    docs = table(spark, SF, "documents")
    model = language_id.fit(docs)
    by_lang = {r.lang: r.text for r in docs.where("n_chars between 600 and 3000").collect()}
    both = by_lang["de"][:600] + "\n" + by_lang["es"][:600]
    share, _ = language_id.mixtures([both, by_lang["de"][:600]], model)
    de, es = model.languages.index("de"), model.languages.index("es")
    assert set(np.flatnonzero(share[0] > 0.2)) == {de, es} and share[1, de] > 0.9
    rows = {r.doc_id: r for r in language_id.identify(frame(spark, ODD_TEXTS), model).collect()}
    for d, t in enumerate(ODD_TEXTS):
        known = any(c.isalpha() for c in t or "")
        assert (rows[d].lang_pred in model.languages) if known else (
            (rows[d].lang_pred, rows[d].score) == ("und", 0.0))
    empty = language_id.fit(docs.limit(0))
    assert empty.languages == []
    assert {r.lang_pred for r in language_id.identify(frame(spark, ["abc"]), empty).collect()} == {
        "und"}


def plain_mixture(text, model):
    """EM over the learned languages, then the penalised choice among the nested sets of the
    likeliest ones, with plain loops."""
    slots = len(model.probability)
    _, found = language_id.trigrams([text], slots)
    counts = Counter(found.tolist())
    k, n = len(model.languages), sum(counts.values())
    if not n:
        return [0.0] * k

    def step(pi):
        out = [0.0] * k
        for slot, c in counts.items():
            joint = [model.probability[slot][j] * pi[j] for j in range(k)]
            whole = math.fsum(joint)
            out = [o + c * x / whole for o, x in zip(out, joint, strict=True)]
        return [o / n for o in out]

    pi = [1 / k] * k
    for _ in range(language_id.ROUNDS):
        pi = step(pi)
    order = sorted(range(k), key=lambda j: -pi[j])
    best = None
    for size in range(1, k + 1):
        part = [max(pi[j], 1e-12) if j in order[:size] else 0.0 for j in range(k)]
        part = [x / sum(part) for x in part]
        for _ in range(language_id.REFITS if size > 1 else 0):
            part = step(part)
        fit = math.fsum(c * math.log(math.fsum(model.probability[s][j] * part[j] for j in range(k)))
                        for s, c in counts.items()) / 3
        score = fit - language_id.PENALTY * size * math.log(n + 1) / 2
        if best is None or score > best[0]:
            best = score, part
    return best[1]


def test_language_mixtures_against_plain_loops(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = language_id.fit(docs)
    texts = [r.text for r in docs.limit(60).collect() if r.text and len(r.text) < 4000]
    en, de = texts[0], next(r.text for r in docs.where("lang = 'de'").collect() if r.text)
    texts += [en[:400] + " " + de[:300], en[:40], "a", "", "123 456", "日本語", en[:900] + de[:200]]
    shares, letters = language_id.mixtures(texts, model)
    for i, t in enumerate(texts):
        assert shares[i].tolist() == pytest.approx(plain_mixture(t, model), abs=1e-9), t[:60]
        assert letters[i] == 0 or shares[i].sum() == pytest.approx(1)


def test_query_predicts_by_the_plain_mixture(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    model = language_id.fit(docs.where(~language_id.held_out()))
    got = {r.doc_id: r for r in language_id.op10_language_id(spark, sf).collect()}
    rows = docs.collect()
    assert set(got) == {r.doc_id for r in rows}
    for r in rows[:80]:
        want, g = plain_mixture(r.text or "", model), got[r.doc_id]
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if max(want, default=0) == 0:
            assert (g.lang_pred, g.score) == ("und", 0.0)
        else:
            assert g.lang_pred == model.languages[want.index(max(want))]
            assert g.score == pytest.approx(max(want), abs=1e-9)
