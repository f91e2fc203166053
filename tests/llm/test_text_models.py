"""Piece sampling, language model, classifiers and block labeller."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adherence.llm import html_blocks, lm, piece_lattice, toxicity, zstd_quality
from adherence.llm.common import fold, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.01"


def docs_df(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], SCHEMA)


# ---------------------------------------------------------- piece sampling
@pytest.fixture(scope="module")
def lattices():
    return piece_lattice.Lattices(piece_lattice.read_pieces())


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs",)), max_size=80), st.integers(0, 99))
def test_round_trip(text, key):
    lat = _shared_lattices()
    (ids,) = lat.encode([text], [str(key)])
    assert lat.decode(ids.tolist()).decode() == text


_LAT = []


def _shared_lattices():
    if not _LAT:
        _LAT.append(piece_lattice.Lattices(piece_lattice.read_pieces()))
    return _LAT[0]


def test_sampling_follows_path_weights(lattices):
    pieces = piece_lattice.read_pieces()
    word = "then in"
    marked = piece_lattice.SPACE + word.replace(" ", piece_lattice.SPACE)

    def paths(at):
        if at == len(marked):
            yield 0.0, ()
            return
        for p, i, rank in pieces["normal"]:
            if marked.startswith(p, at):
                for w, rest in paths(at + len(p)):
                    yield w - math.log(rank + piece_lattice.ZIPF_SHIFT), (i, *rest)
    found = list(paths(0))
    z = sum(math.exp(w) for w, _ in found)
    n = 40_000
    drawn = Counter(tuple(x.tolist()) for x in lattices.encode([word] * n, [str(k) for k in range(n)]))
    assert set(drawn) <= {p for _, p in found}
    for w, p in found:
        share = math.exp(w) / z
        assert abs(drawn[p] / n - share) < 5 * math.sqrt(share / n) + 1e-3


def test_long_runs_and_memo(lattices):
    texts = ["q" * 5000 + "é" * 300 + "日本" * 200, "a" * 70, " " * 200, "▁▁ \x00\n\n x"]
    first = lattices.encode(texts, ["a"] * 4)
    lattices.forget()
    lattices.encode(["other words before"], ["b"])
    again = lattices.encode(texts, ["a"] * 4)
    for x, y, t in zip(first, again, texts):
        assert x.tolist() == y.tolist() and lattices.decode(x.tolist()).decode() == t


@pytest.mark.parametrize("sharpness", [1.0, 4.0])
@pytest.mark.parametrize("times", [30, 3000])
def test_runs_without_pieces(times, sharpness):
    pieces = piece_lattice.read_pieces()
    known = {c for p, _, _ in pieces["normal"] for c in p}
    rune, beast = "\u16a0", "\U0001f984"
    assert rune not in known and beast not in known
    lat = piece_lattice.Lattices(pieces, sharpness)
    texts = [rune * times, beast * times, "ab" + beast * times + "cd ef", (rune + beast) * times + "\nend", "plain words"]
    for ids, t in zip(lat.encode(texts, ["k"] * len(texts)), texts):
        assert lat.decode(ids.tolist()).decode() == t
    assert len(lat.encode([beast * times], ["k"])[0]) == 4 * times + 1  # four byte pieces each, and the space before


def test_encode_frame(spark):
    pairs = [(1, "Hello there, world\nand more"), (2, ""), (3, None), (None, "no id"), (5, "x" * 2_000_000 + " end"),
             (1, "Hello there, world\nand more")] + [(k, "some words %d" % k) for k in range(10, 60)]
    d = docs_df(spark, pairs).withColumns({"ids": F.lit(1), "key": F.lit(2)})
    got = piece_lattice.encode(d.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, piece_lattice.encode(d.repartition(1)).collect()))
    assert all(r["lossless"] for r in got) and len(got) == len(pairs)
    assert [r["ids"] for r in got if r["doc_id"] == 3] == [None] and [r["ids"] for r in got if r["doc_id"] == 2] == [[]]
    back = piece_lattice.decode(piece_lattice.encode(d)).collect()
    assert sorted(map(str, [(r[0], r[1]) for r in back])) == sorted(map(str, pairs))
    assert piece_lattice.encode(d.limit(0)).count() == 0


# ---------------------------------------------------------- language model
def test_scores_against_brute_force(spark):
    docs = table(spark, SF, "documents").limit(150)
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    texts += [(5000, None), (5001, ""), (None, "no id here"), (5002, "A a A"), (5002, "A a A"), (5003, "lang " * 300_000)]
    d = docs_df(spark, texts).withColumns({"row": F.lit(1), "token": F.lit("t"), "base": F.lit(2)}).repartition(3)
    got = lm.score(d).collect()
    words = lambda t: (t or "").encode().lower().split() + [b" "]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in texts if not held(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), 4)) for i, t in texts)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4))
                  for r in got) == want
    out = [r for r in got if r["held_out"] and 30 < r["n_tokens"] < 100_000]
    assert out and all(r["score"] < 0 for r in got)
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert lm.score(d.limit(0)).count() == 0


def test_model_is_normalised(spark):
    """The shares of all known tokens and one unseen per class sum to 1."""
    train = docs_df(spark, [(k, "one two three two %d" % (k % 7)) for k in range(60)])
    counts = lm.token_counts(train)
    model, hot, n, v = lm.fit(train, counts)
    c = {r["token"]: r["n"] for r in counts.collect()}
    assert sum(c.values()) == n == 60 * 6 and len(c) == v
    f = lm.features(*[lm.sequences([b"two three one"], model.singles)[k] for k in (0, 2)])
    soft = np.exp(lm.log_softmax(model.weights, model.bias, f))
    assert np.allclose(soft.sum(axis=1), 1, atol=1e-5)
    per = Counter()
    for w, k in c.items():
        cls = 0 if w == lm.END else int(lm.token_classes(*lm.hash_words(w.encode())[1:], model.singles)[0])
        if cls >= lm.SINGLES:
            per[cls] += k + 1
    for k in range(lm.SINGLES, lm.CLASSES):
        assert per[k] + 1 == model.class_total[k]


def test_word_hashes_do_not_depend_on_place():
    data = b"ab cd  ab\ncd ab"
    _, h, tail = lm.hash_words(data)
    assert h[0] == h[2] == h[4] and h[1] == h[3] != h[0] and tail[0] == tail[2]
    long = b"word " * 500_000 + b"last"
    h2, _, per = lm.sequences([long, b"word last"], np.empty(0, np.uint64))
    assert per.tolist() == [500_002, 3] and h2[0] == h2[499_999] == h2[-3] and h2[500_000] == h2[-2]


# ------------------------------------------------------------- classifiers
def segments_brute(scores):
    """All maximal-scoring segments by definition: the best segment, then the
    same on its left and on its right."""
    best = max(((sum(scores[a:b]), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
               key=lambda x: (round(x[0], 9), x[1], -x[3]), default=(0,))
    if best[0] <= 1e-9:
        return []
    _, _, a, b = best
    left = [(x, y) for x, y in segments_brute(scores[:a])]
    return left + [(a, b - 1)] + [(x + b, y + b) for x, y in segments_brute(scores[b:])]


@pytest.mark.parametrize("seed", range(25))
def test_maximal_segments(seed):
    rnd = random.Random(seed)
    n = rnd.randint(1, 40)
    hits = [(p, rnd.randint(1, 40) / 8 + rnd.random() / 1000) for p in range(n) if rnd.random() < 0.4]
    scores = [-1.0] * n
    for p, s in hits:
        scores[p] = s
    assert [(a, b) for a, b, _ in toxicity.maximal_segments(hits, drift=1.0)] == segments_brute(scores)
    for a, b, s in toxicity.maximal_segments(hits, drift=1.0):
        assert abs(s - sum(scores[a:b + 1])) < 1e-9


def test_segments_take_linear_time():
    hits = [(3 * k, 1.0 + (k % 5) / 10) for k in range(200_000)]
    assert len(toxicity.maximal_segments(hits, drift=1.0)) > 1


def _accuracy(spark, query, label):
    got = query(spark, SF).join(table(spark, SF, "labels"), "doc_id").filter("held_out").collect()
    ones = [r["predicted"] == 1 for r in got if r[label] == 1]
    noughts = [r["predicted"] == 0 for r in got if r[label] == 0]
    return np.mean(ones), np.mean(noughts)


def test_held_out_quality(spark):
    assert min(_accuracy(spark, zstd_quality.op4_zstd_quality, "quality")) > 0.8


def test_held_out_toxicity(spark):
    ones, noughts = _accuracy(spark, toxicity.op6_toxic_segments, "toxic")
    assert ones > 0.4 and noughts > 0.9  # 41 toxic texts to learn from here


@pytest.mark.parametrize("mod,label", [(zstd_quality, "quality"), (toxicity, "toxic")])
def test_classifier_edges(spark, mod, label):
    pairs = [(k, ("good plain text number %d here " % k if k % 2 else "bad $$$ idiot stuff %d " % k) * 5) for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2, 1 - k % 2) for k in range(60)] + [(None, 1, 1), (3, 1, 0), (7, None, None), (999, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    pairs += [(100, None), (101, ""), (None, "no id"), (3, pairs[3][1]), (102, "word " * 400_000)]
    d = docs_df(spark, pairs).withColumns({"score": F.lit(1), "y": F.lit(2), "part": F.lit(3)}).repartition(3)
    out = mod.score(d, mod.fit(d, labels)).collect()
    assert len(out) == len(pairs) and all(0 <= r["score"] <= 1 for r in out)
    none = labels.limit(0)
    assert {round(r["score"], 9) for r in mod.score(d, mod.fit(d, none)).collect()} == {0.5}
    one = labels.filter(F.col(label) == 1)
    assert mod.score(d, mod.fit(d, one)).filter("score < 0.5").count() == 0
    assert mod.score(d.limit(0), mod.fit(d.limit(0), labels)).count() == 0


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = fold(F.col("doc_id"), 5) == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, zstd_quality.score(docs, zstd_quality.fit(docs, x)).collect())) for x in (labels, turned))
    assert a == b


# --------------------------------------------------------------- web pages
PAGE = """<html><head><title>T</title></head><body><header><div class="logo">My Site</div><nav><a href=/>Home</a>
<a href=/b>News</a></nav></header><div class="cookie-banner">We use cookies on this site. <button>OK</button></div>
<div id="content"><h1>The big   story</h1><p>First paragraph of the <b>story</b> is here, with <a href=x>a link</a> and more.
<p>Second &eacute; &amp;
 paragraph, also quite long and full of words.<script>var a = "<p>no</p>";</script></div>
<aside><h3>Popular</h3><ul><li><a href=1>Other story one</a></li></ul></aside>
<section id="comments"><h3>3 comments</h3><div class="comment"><p>I really liked this story a lot, thanks.</p></div></section>
<form><label>Email</label><input></form><!-- <p>gone</p> --><footer><p>&copy; 2024 My Site.</p></footer></body></html>"""


def test_blocks():
    got = [b.text for b in html_blocks.blocks_of(PAGE)]
    assert got == ["My Site", "Home News", "We use cookies on this site.", "OK", "The big story",
                   "First paragraph of the story is here, with a link and more.",
                   "Second é & paragraph, also quite long and full of words.", "Popular", "Other story one", "3 comments",
                   "I really liked this story a lot, thanks.", "Email", "© 2024 My Site."]
    assert html_blocks.blocks_of(None) == html_blocks.blocks_of("") == html_blocks.blocks_of("<div><p") == []
    assert [b.text for b in html_blocks.blocks_of("a &am <b>c</b>d < 5 <!-- open")] == ["a &am cd < 5"]
    html_blocks.blocks_of("<div>" * 3000 + "<a b='" * 3000)  # ends


def test_extract(spark):
    pages = table(spark, SF, "pages")
    odd = spark.createDataFrame([(9001, None, None), (9002, "u", ""), (None, "u", PAGE), (9003, "u", PAGE),
                                 (9003, "u", PAGE), (9004, "u", "<article>" + "<p>long text here.</p>" * 3000)], pages.schema)
    every = pages.unionByName(odd).withColumns({"text": F.lit("x"), "n_chars": F.lit(1)})
    model = html_blocks.fit(every, made_pages=500, epochs=3)
    got = html_blocks.extract(every, model).collect()
    assert len(got) == pages.count() + 6

    def truth(page):  # these pages all have one article element
        m = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
        parts = re.sub(r"<[^>]*>?", " ", re.sub(r"</?(?:h1|p)>", "\0", m[1])).split("\0")
        import html
        clean = [re.sub(r"[\x20\x09-\x0D]+", " ", html.unescape(x)).strip() for x in parts]
        return "\n\n".join(x for x in clean if x)

    want = {r["page_id"]: truth(r["html"]) for r in pages.collect()}
    same = [r["text"] == want[r["page_id"]] for r in got if r["page_id"] in want]
    assert np.mean(same) > 0.99
    text = {r["page_id"]: r["text"] for r in got}
    assert text[9001] == text[9002] == "" and text[9003] == text[None]
    assert "First paragraph" in text[9003] and "cookies" not in text[9003] and "liked" not in text[9003] and "©" not in text[9003]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_blocks.extract(every.limit(0), html_blocks.fit(every.limit(0), made_pages=40, epochs=1)).count() == 0


def test_labeller_gradient():
    """The hand-written gradient against finite differences."""
    rnd = random.Random(1)
    pages = [html_blocks.made_page(rnd, ["alpha", "beta", "gamma"]) for _ in range(4)]
    feats = html_blocks.Features()([p for p, _ in pages])
    sizes = np.array([len(p) for p, _ in pages])
    y = np.array([v for _, ys in pages for v in ys])
    model = {k: v.astype(np.float64) for k, v in html_blocks.new_model().items()}

    def loss(m):
        p = np.clip(html_blocks.label(m, feats, sizes), 1e-12, 1 - 1e-12)
        return -np.mean(np.where(y == 1, np.log(p), np.log(1 - p)))

    x, mask, step, page = html_blocks._padded(html_blocks._inputs(model, feats), sizes)
    f, kept = html_blocks._run(x, mask, model["xf"], model["hf"], model["cf"], False)
    b, _ = html_blocks._run(x, mask, model["xb"], model["hb"], model["cb"], True)
    p = html_blocks._sig((np.concatenate([f, b], axis=2) @ model["out"] + model["bias"][0])[step, page])
    d = np.zeros(x.shape[:2])
    d[step, page] = (p - y) / len(y)
    d_f = (d[:, :, None] * model["out"])[:, :, :html_blocks.HIDDEN].astype(np.float32)
    dx, dh, dc, _ = html_blocks._run_back(x, kept, model["xf"], model["hf"], d_f)
    for name, grad, at in itertools.product(("xf", "hf"), (None,), ((0, 0), (3, 30), (10, 70))):
        grad = {"xf": dx, "hf": dh}[name]
        up, down = ({**model, name: model[name].copy()} for _ in range(2))
        up[name][at] += 1e-2
        down[name][at] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - grad[at]) < 1e-4


@pytest.mark.parametrize("n", [60, 700])
def test_windows_sample_the_paths_of_the_whole_lattice(lattices, n):
    rnd = random.Random(n)
    for key in (1, 2 ** 63 + 5):
        chunk = " " + "".join(rnd.choice("abcdefghijklmnop日é🙂") for _ in range(n))
        ids, _ = lattices.sample(np.array(lattices.add([chunk])), np.array([key], np.uint64))
        assert lattices.sample_long(chunk, key, window=37).tolist() == ids.tolist()


def test_a_long_text_without_blanks_takes_little_memory(lattices):
    import tracemalloc
    text = "日本語abc🙂x" * 25_000
    lattices.encode(["warm"], ["w"])
    tracemalloc.start()
    ids, other = lattices.encode([text, "two words"], ["k", "l"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert lattices.decode(ids) == text.encode() and lattices.decode(other) == b"two words"
    assert peak < 60e6  # the dense arrays of the whole chunk would take more than 400 MB


def test_article_text_of_formulas_objects_and_unclosed_elements_is_kept():
    from adherence.llm.html_blocks import blocks_of
    page = ("<article><p>Energy is <math><mi>E</mi></math> here.</p><noscript><p>fallback text</p></noscript><p>after</p>"
            "<object>x <p>rest</p><p>more</p></article>")
    assert [b.text for b in blocks_of(page)] == ["Energy is E here.", "fallback text", "after", "x", "rest", "more"]
    assert [b.text for b in blocks_of("<p>a</p><textarea>no</textarea><iframe>no</iframe><p>b<script>no</script>c</p><select><option>no</select><p>d")] \
        == ["a", "bc", "d"]
    assert [b.text for b in blocks_of("<p>a</p><textarea><p>b</p>")] == ["a", "b"]   # never closed: it hides nothing
    assert [b.text for b in blocks_of("<p>a</p><script>var b")] == ["a"]
