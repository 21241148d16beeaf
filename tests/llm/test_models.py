"""op5, op6, op7: extraction, quality, language."""

import collections
import html
import random
import re
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tenderloom.llm import html_text as H
from tenderloom.llm import language_id as L
from tenderloom.llm import quality as Q
from tenderloom.llm import queries

FOLDER = "/root/testdata/sf0.01"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>
<!-- <p>no</p> --><div class="ad">Buy now, cheap things for all</div><article><header>By line</header><h1>Title &amp; more</h1><p><b>First   paragraph
goes on.<br><p>Second &eacute; one with many words in it.</p><aside>Side</aside><form>Send</form><div class="comments"><p>Reader says a lot of things here</p></div></article>
<div id="cookie-notice">We use cookies</div><footer>&copy; foot</footer>"""


def test_page():
    assert H.main_text(PAGE, {}) == "Title & more\nFirst paragraph goes on.\nSecond é one with many words in it."
    assert H.main_text("", {}) == "" and H.main_text("<nav>only menu</nav>", {}) == ""
    assert H.main_text("plain words only", {}) == "plain words only"
    assert H.main_text("<p>Short.</p><ul><li>one</li><li><a href='/'>two</a></li></ul>", {}) == "Short.\none\ntwo"
    assert H.main_text(f"<article><p>Before.</p><aside>{'side ' * 500}</aside><p>After.</p></article>", {}) == "Before.\nAfter."
    assert H.main_text("<p>cut off <b>here <a href='x", {"word": 2.0}).startswith("cut off")


@pytest.mark.parametrize("unit", ["<a ", '<a b="', "<svg>", "<a <", "<script></script", "<!", "<a '>\"", "&#1", "</", "<p class='x ", "<a b=\"'>"])
def test_malformed_pages_take_linear_time(unit):
    page = unit * (1_000_000 // len(unit))
    began = time.process_time()
    H.main_text(page, {})
    H.main_text("<a \"><p>" + page, {})
    assert time.process_time() - began < 8  # about 1 s; quadratic ways take hours


def test_odd_markup():
    for page in ("&#" + "9" * 5000 + ";", "&#x" + "f" * 5000, "&#" + "0" * 5000 + "9" * 8):
        assert H.main_text(page, {}) == "\ufffd"
    assert H.main_text("<p>&#000000000065;&#x00000041 b</p>", {"p": -0.1}) == "AA b"
    assert H.main_text('<p title="a > b">one <b title=\'<p>\'>two</b> three</p>', {"p": -0.1, "b": -0.1}) == "one two three"
    assert H.main_text("<p>1 < 2 and 3 <4</p>", {"p": -0.1}) == "1 < 2 and 3 <4"
    assert H.main_text("<p>one <!-- > no --> two <![CDATA[ > no ]]>three</p>", {"p": -0.1}) == "one two three"
    kept = '<main><div class="post-header"><h1>Title</h1></div><div class="related-work"><p>Others did much of this before us.</p></div><p>Last words of it.</p></main>'
    assert H.main_text(kept, {}) == "Title\nOthers did much of this before us.\nLast words of it."
    for name in ("comments", "reader-comments", "commentList", "cookie-notice", "ad", "ad-slot", "site-header", "share-buttons", "x y sidebar_left"):
        assert H.main_text(f'<article><p>Some words.</p><div class="{name}"><p>not these words</p></div></article>', {}) == "Some words.", name


def test_region_is_the_best_contiguous_one():
    rng = np.random.default_rng(3)
    for _ in range(200):
        parts = [("text", "", "w " * int(rng.integers(1, 5)), bool(rng.random() < 0.3)) if rng.random() < 0.5 else ("open", "p", "", False) for _ in range(12)]
        value = [(0 if out else 1) * len(t.split()) if k == "text" else -2.0 for k, _, t, out in parts]
        sums = {(a, b): sum(value[a:b]) for a in range(12) for b in range(a + 1, 13)}
        a, b = H.region(parts, {"word": 1.0, "p": -2.0})
        assert (sums[a, b] if b else 0) == max(0, max(sums.values()))


def labelled(spark, junk):
    """Pages whose junk has names that no list knows, before and after the article and of more words than some articles."""
    words = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    rows = []
    for k in range(40):
        article = f"<h1>{words(k, 3)}</h1>" + "".join(f"<p>{words(k, 2 + 5 * (k % 9))}.</p>" for _ in range(1 + k % 4))
        rows.append((k, f'<body><div class="{junk}"><p>{words("a", 9)}</p></div><article>{article}</article><section id="{junk}-2"><p>{words("b", 14)}</p></section></body>', "\n".join(re.sub("<[^>]*>", " ", b).strip() for b in re.split("(?<=</h1>)|(?<=</p>)", article) if b)))
    return spark.createDataFrame(rows, "page_id long, html string, want string")


@pytest.mark.parametrize("junk", ["qx-17", "zz_blurb"])
def test_the_scan_decides_by_learned_names(spark, junk):
    df = labelled(spark, junk)
    weights = H.learn_weights(df)
    assert weights[f"class:{junk}"] < -1 and weights[f"in class:{junk}"] == H.DARK
    for r in df.collect():
        assert H.main_text(r.html, weights) == r.want
        assert H.main_text(re.sub("(</?)article>", r"\1div>", r.html), weights) == r.want  # the label is no input
        assert H.main_text(r.html, {}) != r.want


def test_given_pages_need_no_lists(spark, monkeypatch):
    """Without the lists all texts stay; with the whole page instead of the scan's region they don't."""
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    weights, rows = H.learn_weights(pages), pages.collect()
    texts = [H.main_text(r.html, weights) for r in rows]
    monkeypatch.setattr(H, "OUTSIDE", H.HIDDEN)
    monkeypatch.setattr(H, "NAMES", frozenset())
    assert [H.main_text(r.html, weights) for r in rows] == texts
    monkeypatch.setattr(H, "region", lambda parts, weights: (0, len(parts)))
    assert np.mean([H.main_text(r.html, weights) != t for r, t in zip(rows, texts)]) > 0.9


def test_op5_regions_by_all_bounds(spark):
    """The registered query's texts are those of the region that is best among all pairs of bounds."""
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    weights = H.learn_weights(pages)
    got = {r.page_id: r.text for r in queries.op5_html_text(spark, FOLDER).collect()}
    for r in pages.collect():
        parts = H.pieces(r.html)
        until = np.append(0, np.cumsum(H.scores(parts, weights)))
        sums = np.triu(until[None, :] - until[:, None], 1)
        a, b = H.region(parts, weights)
        assert sums.max() == pytest.approx(until[b] - until[a]) and sums.max() > 0
        first, last = np.argwhere(sums > sums.max() - 1e-9)[0]
        own = [html.unescape(t) for k, _, t, dark in parts[first:last] if k == "text" and not dark]
        assert "".join("".join(own).split()) == "".join(got[r.page_id].split())


def test_extract_edge_rows(spark):
    df = spark.createDataFrame([(1, "u", None, "old"), (2, "u", "", "old"), (3, "u", PAGE, "old")], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in H.extract(df, H.learn_weights(df)).collect()}
    assert got[1] == got[2] == ("", 0) and got[3][1] == len(got[3][0]) > 0
    assert H.extract(df.limit(0), {}).count() == 0
    assert H.learn_weights(df.limit(0)) == {}


def test_pages_hold_documents(spark):
    """Pages were made from documents: the article is a heading and one document's text, read here with plain patterns."""
    docs = {" ".join(t.split()) for (t,) in duckdb.sql(f"SELECT text FROM '{FOLDER}/documents.parquet'").fetchall()}
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{FOLDER}/pages.parquet'").fetchall())
    rows = queries.op5_html_text(spark, FOLDER).collect()
    assert len(rows) == len(pages)
    assert np.mean([" ".join(" ".join(r.text.split("\n")[1:]).split()) in docs for r in rows]) > 0.99
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br>" in b else "", re.sub(r"<br>", " ", b))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_statistics_are_finite():
    x = Q.statistics(pa.array([None, "", " ", "a", "É" * 10, "word " * 5000, "!!! 123"]))
    assert x.shape == (7, Q.D) and np.isfinite(x).all()


def test_quality_on_held_out_rows(spark):
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{FOLDER}/labels.parquet'").fetchall())
    rows = [r for r in queries.op6_quality(spark, FOLDER).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows]) > 0.93
    good, bad = ([r.score for r in rows if labels[r.doc_id] == k] for k in (1, 0))
    assert np.mean([[g > b for g in good] for b in bad]) > 0.97


def test_quality_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "text", 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    from pyspark.sql import functions as F

    out = Q.score_quality(docs, labels, F.lit(True)).collect()
    assert len(out) == 3 and all(r.score == 1.0 and r.predicted == 1 for r in out)
    assert {r.score for r in Q.score_quality(docs, labels.limit(0), F.lit(True)).collect()} == {0.5}
    assert Q.score_quality(docs.limit(0), labels, F.lit(True)).count() == 0


def test_discriminant_matches_densities():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(Q.D, Q.D))
    cov = a @ a.T + np.eye(Q.D)
    lower = np.linalg.cholesky(cov)
    m = Q.Discriminant(np.stack([np.zeros(Q.D), np.ones(Q.D)]), np.stack([np.linalg.inv(lower)] * 2), 0.0)
    x = rng.normal(size=(5, Q.D))
    inv = np.linalg.inv(cov)
    want = [Q.TEMPER * 0.5 * (r @ inv @ r - (r - 1) @ inv @ (r - 1)) for r in x]
    assert np.allclose(np.log(m.scores(x) / (1 - m.scores(x))), want)


def kneser_ney(counts, order):
    """p(character, context) by the textbook's recursion over plain dictionaries."""
    words = [(L.BEGIN + w + L.END, k) for w, k in counts.items()]
    raw = collections.Counter()
    for w, k in words:
        for i in range(1, len(w)):
            for j in range(max(0, i - order + 1), i + 1):
                raw[w[j : i + 1]] += k
    grams = {g for g in raw if len(g) == order or g[0] == L.BEGIN}
    count = {g: raw[g] for g in grams}
    for n in range(order - 1, 0, -1):  # how many characters stand before a shorter one
        for g in {g for g in raw if len(g) == n and g[0] != L.BEGIN}:
            count[g] = len({x[0] for x in raw if len(x) == n + 1 and x[1:] == g})
    alphabet = {g for g in count if len(g) == 1}
    discount = {}
    for n in range(1, order + 1):
        ones, twos = (sum(c == k and len(g) == n for g, c in count.items()) for k in (1, 2))
        discount[n] = ones / (ones + 2 * twos) if ones and twos else 0.5

    def p(c, h):
        lower = p(c, h[1:]) if h else 1 / (len(alphabet) + 1000)
        follow = {g[-1]: k for g, k in count.items() if len(g) == len(h) + 1 and g[:-1] == h}
        if not follow:
            return lower
        d, total = discount[len(h) + 1], sum(follow.values())
        return max(follow.get(c, 0) - d, 0) / total + d * len(follow) / total * lower

    return p, alphabet


@pytest.mark.parametrize("order", [2, 3, 5])
def test_model_is_interpolated_kneser_ney(order):
    """Against an independent implementation; over the alphabet and the thousand unseen characters, probabilities sum to 1."""
    rng = random.Random(order)
    counts = {"".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))): rng.randint(1, 4) for _ in range(25)}
    model, (p, alphabet) = L.CharacterModel.fitted(counts, order), kneser_ney(counts, order)
    contexts = {(L.BEGIN + w)[: k + 1][-(order - 1) :] for w in counts for k in range(len(w) + 1)}
    contexts = {h for h in contexts if len(h) == order - 1 or h[0] == L.BEGIN}
    for h in sorted(contexts):
        total = 0.0
        for c in sorted(alphabet) + ["ß"]:
            codes = L.codes_of(h + c)
            place = np.arange(len(codes)) + (0 if h[0] == L.BEGIN else order)
            got = np.exp(model.log_probabilities(L.gram_hashes(codes, order), place))[-1]
            assert got == pytest.approx(p(c, h), rel=1e-9)
            total += got * (1000 if c == "ß" else 1)
        assert total == pytest.approx(1.0, abs=1e-9)


def test_rejection_is_calibrated(spark):
    """Texts of languages that were not learned go, those of learned ones stay, however short."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    models = L.fit_languages(docs)
    foreign = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.", "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        "xqzj vkwq zzxp qqpw vbnm jkjk wrtq pqxz kkjw xxqz", "日本語のテキストがここにありますので読んでください", "Все люди рождаются свободными и равными в своем достоинстве",
    ]
    own = [" ".join(t.split()[:n]) for (t,) in duckdb.sql(f"SELECT text FROM '{FOLDER}/documents.parquet' WHERE len(text) > 300 AND NOT regexp_matches(text, '[0-9=@#$%]')").fetchall()[:300] for n in (5, 30)]
    rejected = L.judged(models, pa.array(foreign + own))[3]
    assert rejected[: len(foreign)].all() and rejected[len(foreign) :].mean() <= 0.005
    whole = L.judged(models, pa.array([t for (t,) in duckdb.sql(f"SELECT text FROM '{FOLDER}/documents.parquet'").fetchall()]))[3]
    assert whole.mean() < 0.005


def test_very_long_text_and_repeats():
    models = L.LanguageModels(["a", "b"], [L.CharacterModel.fitted({"aba": 2, "aab": 1}), L.CharacterModel.fitted({"bbc": 2})])
    models.calibrate(np.zeros(0, int), np.zeros((0, 2)), np.zeros(0))
    lang, score, entropy, _ = L.judged(models, pa.array(["aba " * 500_000, "aba", "aba", "b" * 2_000_000]))
    assert lang == ["a", "a", "a", "b"] and entropy[0] == pytest.approx(entropy[1]) and entropy[1] == entropy[2]
    x = Q.statistics(pa.array(["word " * 500_000, "w" * 3_000_000]))
    assert np.isfinite(x).all()


def test_language_on_held_out_rows(spark):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{FOLDER}/documents.parquet'").fetchall())
    rows = queries.op7_language_id(spark, FOLDER).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert np.mean([r.rejected for r in rows]) < 0.01 and all(0 <= r.score <= 1 for r in rows)


def test_language_edge_rows(spark):
    learn = spark.createDataFrame([(i, t, g, 0) for i, (t, g) in enumerate([("the cat and the dog are in the house", "en"), ("le chat et le chien sont dans la maison", "fr")] * 20)] + [(99, None, "en", 0), (98, "x", None, 0)], "doc_id long, text string, lang string, score int")
    models = L.fit_languages(learn)
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "123 !?", 1), (4, "the dog", 1), (5, "le chien", 1), (6, "…", 1), (6, "…", 1)], "doc_id long, text string, score int")
    got = [(r.doc_id, r.lang_pred) for r in L.identify(docs, models).collect()]
    assert sorted(got) == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "fr"), (6, "und"), (6, "und")]
    assert {r.doc_id for r in L.drop_rejected(docs, models).collect()} >= {4, 5}
    assert L.fit_languages(learn.limit(0)) is None
    assert {r.lang_pred for r in L.identify(docs, None).collect()} == {"und"}
    assert L.identify(docs.limit(0), models).count() == 0
