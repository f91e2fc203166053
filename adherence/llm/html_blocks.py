"""Operator 1: main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks (runs of text between block-level tags). Every
block has a tag-path vector (mean of vectors hashed from the tags, class and
id words on its path, and pairs of neighbours), a hashed-word vector (mean
over all its words) and some plain figures (length, share of linked text,
punctuation, place). A bidirectional LSTM in numpy reads the blocks of the
whole page in both directions and labels each as article or not. The article
blocks, in page order, are the text.

Training happens in ``fit``, on a bounded sample: ``SAMPLE_PAGES`` pages, whose
blocks are labelled only where their markup says outright what they are
(article, main; nav, footer, aside, form, advert, comments and so on), and
``MADE_PAGES`` pages composed from words of that sample in many layouts, also
without telling markup, so that the neighbours have to decide. The model has a
fixed size and is broadcast; pages are then read whole, without a shuffle.

Defined results: null or empty html, and pages without an article, give the
empty text; unclosed elements and truncated pages are read to their end, but
for an unclosed script, style or comment, which by HTML's rules takes the rest;
formulas, drawings, objects and noscript are text like any other, for the
labeller to judge; a block that scores exactly 0.5 is taken; very long pages are
read whole, their blocks labelled ``CELLS`` at a time with the context that
both directions carry; repeated rows give equal results; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.llm.common import table
from adherence.llm.labelled import first_by_hash

SAMPLE_PAGES, MADE_PAGES = 300, 1200
MAX_FIT_CHARS = 50_000  # longer pages are not fitted on
PATHS, WORDS = 4096, 2048
DIM_PATH, DIM_WORD, PLAIN, HIDDEN = 20, 12, 8, 24
EPOCHS, BATCH, RATE = 4, 48, 0.01
CELLS = 8192  # blocks, padding included, labelled at a time
MEMO = 300_000

# ------------------------------------------------------------------ blocks
#: Elements whose content is no text of the page (code, templates, the head, form
#: fields), and elements that do not end a block (formulas and drawings among them).
HIDDEN_TAGS = frozenset("script style template head title textarea select iframe annotation annotation-xml".split())
CODE = frozenset("script style".split())
SILENT = HIDDEN_TAGS - {"head", "title"}  # they end no block
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark "
                   "q s samp small span strike strong sub sup time tt u var wbr nobr "
                   "math semantics mrow mi mn mo ms mtext mfrac msqrt mroot msub msup msubsup munder mover munderover mspace "
                   "svg g text tspan path object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the key ends an open element of the value.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
_TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_BLANK = re.compile(r"[\x20\x09-\x0D]+")
_CUT_TAG = re.compile(r"<[/a-zA-Z!?][^>]*\Z")


class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple[str, ...], linked: int):
        self.text, self.path, self.linked = text, path, linked


def _element(tag: str, attrs: str) -> tuple[str, ...]:
    """The tag and the words of its class, id and role."""
    out = [tag]
    if "=" in attrs:
        for m in _NAMES.finditer(attrs):
            out += ["." + w.lower() for w in _PARTS.findall(m[1] or m[2] or m[3] or "")]
    return tuple(out)


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, ...]] = []
    parts: list[str] = []
    state = {"linked": 0, "path": ()}

    def flush():
        if parts:
            text = _BLANK.sub(" ", "".join(parts)).strip(" ")
            if text:
                out.append(Block(text, state["path"], min(state["linked"], len(text))))
            parts.clear()
        state["linked"] = 0

    def add(raw: str):
        text = _html.unescape(raw) if "&" in raw else raw
        if not parts and not text.strip(" \t\n\r\f\v"):
            return
        if not parts:
            state["path"] = tuple(x for e in stack for x in e)
        parts.append(text)
        if any(e[0] == "a" for e in stack[-4:]):
            state["linked"] += len(text.strip())

    at = 0
    while True:
        m = _TAG.search(page, at)
        if m is None:
            rest = _CUT_TAG.sub("", page[at:])
            if rest:
                add(rest)
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:  # end tag
            if tag == "br" or tag not in INLINE:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        if tag == "br":
            if parts:
                parts.append(" ")
            continue
        if tag not in INLINE and tag not in SILENT:
            flush()
            # What this start tag ends: paragraphs and inline elements, siblings.
            k = len(stack)
            while k and stack[k - 1][0] in INLINE:
                k -= 1
            if k < len(stack) and not (k and stack[k - 1][0] == "p"):
                pass  # inline elements around blocks stay open
            elif k and stack[k - 1][0] == "p":
                del stack[k - 1:]
            for j in range(len(stack) - 1, max(len(stack) - 6, -1), -1):
                if stack[j][0] in CLOSES.get(tag, ()):
                    del stack[j:]
                    break
                if stack[j][0] in ("ul", "ol", "table", "div", "dl", "select"):
                    break
        if tag in HIDDEN_TAGS:
            if tag == "head":
                body = re.compile(r"</head\s*>|<body", re.I).search(page, at)
                at = body.start() if body else at
            elif not m[3].endswith("/"):
                end = re.compile(r"</" + re.escape(tag) + r"[^>]*>", re.I).search(page, at)
                # Code without an end is code to the end; anything else hides nothing then.
                at = end.end() if end else len(page) if tag in CODE else at
            continue
        if tag not in VOID and not m[3].endswith("/"):
            stack.append(_element(tag, m[3]))
            if len(stack) > 200:  # broken nesting: the path keeps its ends
                del stack[100]
    flush()
    return out


# ---------------------------------------------------------------- features
class _Memo(dict):
    def __init__(self, size: int):
        super().__init__()
        self.size = size

    def __missing__(self, key: str) -> int:
        if len(self) > MEMO:
            self.clear()
        self[key] = h = zlib.crc32(key.encode("utf-8", "replace")) % self.size
        return h


class Features:
    """Numbers of the blocks of many pages at once."""

    def __init__(self):
        self.word, self.path = _Memo(WORDS), _Memo(PATHS)

    def __call__(self, pages: list[list[Block]]):
        """(path buckets, their counts, word buckets, their counts, plain)."""
        paths, n_path, words, n_word, plain = [], [], [], [], []
        for blocks in pages:
            for k, b in enumerate(blocks):
                p = list(map(self.path.__getitem__, b.path))
                p += [self.path[a + ">" + c] for a, c in zip(b.path[-6:], b.path[-5:])]
                p.append(self.path["leaf " + (b.path[-1] if b.path else "")])
                w = b.text.lower().split() or [""]
                paths += p
                n_path.append(len(p))
                words += map(self.word.__getitem__, w)
                n_word.append(len(w))
                n = len(b.text)
                marks = b.text.count(".") + b.text.count(",")
                plain.append((np.log1p(len(w)) / 5, b.linked / n, min(marks / len(w), 1.0), k / len(blocks),
                              min(len(blocks), 100) / 100, float(b.text[-1] in ".!?:;\"'"), float("©" in b.text),
                              float(len(w) < 4)))
        return (np.array(paths, np.int64), np.array(n_path, np.int64), np.array(words, np.int64),
                np.array(n_word, np.int64), np.array(plain, np.float32).reshape(-1, PLAIN))


# ------------------------------------------------------------------- model
def _sig(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_model(seed: int = 7) -> dict[str, np.ndarray]:
    g = np.random.default_rng(seed)
    d = DIM_PATH + DIM_WORD + PLAIN
    m = {"paths": np.zeros((PATHS, DIM_PATH)), "words": np.zeros((WORDS, DIM_WORD)), "out": g.normal(0, 0.2, 2 * HIDDEN),
         "bias": np.zeros(1)}
    m["paths"] += g.normal(0, 0.05, m["paths"].shape)
    m["words"] += g.normal(0, 0.05, m["words"].shape)
    for way in ("f", "b"):
        m["x" + way] = g.normal(0, d ** -0.5, (d, 4 * HIDDEN))
        m["h" + way] = g.normal(0, HIDDEN ** -0.5, (HIDDEN, 4 * HIDDEN))
        m["c" + way] = np.zeros(4 * HIDDEN)
    return {k: v.astype(np.float32) for k, v in m.items()}


def _run(x, mask, wx, wh, c0, back: bool):
    """One direction over (blocks, pages, inputs); states and what the
    gradient needs."""
    steps, pages, _ = x.shape
    z = x @ wx + c0
    h = c = np.zeros((pages, HIDDEN), np.float32)
    out, kept = np.zeros((steps, pages, HIDDEN), np.float32), []
    for t in (range(steps - 1, -1, -1) if back else range(steps)):
        g = z[t] + h @ wh
        i, f, o = _sig(g[:, :HIDDEN]), _sig(g[:, HIDDEN:2 * HIDDEN] + 1), _sig(g[:, 2 * HIDDEN:3 * HIDDEN])
        u = np.tanh(g[:, 3 * HIDDEN:])
        c2 = f * c + i * u
        tc = np.tanh(c2)
        on = mask[t][:, None]
        out[t] = o * tc * on
        kept.append((t, h, c, i, f, o, u, tc, on))
        h, c = out[t] + (1 - on) * h, on * c2 + (1 - on) * c
    return out, kept


def _run_back(x, kept, wx, wh, d_out):
    dz = np.zeros(x.shape[:2] + (4 * HIDDEN,), np.float32)
    dwh = np.zeros_like(wh)
    dh = dc = np.zeros(x.shape[1:2] + (HIDDEN,), np.float32)
    for t, h, c, i, f, o, u, tc, on in reversed(kept):
        d = (d_out[t] + dh) * on
        e = dc * on + d * o * (1 - tc * tc)
        dz[t] = np.concatenate([e * u * i * (1 - i), e * c * f * (1 - f), d * tc * o * (1 - o), e * i * (1 - u * u)], axis=1)
        dwh += h.T @ dz[t]
        dh = dz[t] @ wh.T + dh * (1 - on)
        dc = e * f + dc * (1 - on)
    flat = dz.reshape(-1, 4 * HIDDEN)
    return x.reshape(-1, x.shape[2]).T @ flat, dwh, flat.sum(axis=0), dz @ wx.T


def _inputs(model, feats):
    paths, n_path, words, n_word, plain = feats
    a = np.add.reduceat(model["paths"][paths], np.cumsum(n_path) - n_path, axis=0) / n_path[:, None]
    # The sums over words are taken slice by slice: texts can be long.
    b = np.zeros((len(n_word), DIM_WORD), np.float32)
    owner = np.repeat(np.arange(len(n_word)), n_word)
    for at in range(0, len(words), 1 << 18):
        o = owner[at:at + (1 << 18)]
        begin = np.flatnonzero(np.concatenate(([True], o[1:] != o[:-1])))
        b[o[begin]] += np.add.reduceat(model["words"][words[at:at + (1 << 18)]], begin, axis=0)
    return np.concatenate([a, b / n_word[:, None], plain], axis=1).astype(np.float32)


def _padded(rows: np.ndarray, sizes: np.ndarray):
    """(blocks, pages, inputs) and mask; the index of each row in them."""
    page = np.repeat(np.arange(len(sizes)), sizes)
    step = np.arange(len(page)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    x = np.zeros((int(sizes.max()), len(sizes), rows.shape[1]), np.float32)
    x[step, page] = rows
    mask = np.zeros(x.shape[:2], np.float32)
    mask[step, page] = 1
    return x, mask, step, page


def label(model, feats, sizes: np.ndarray) -> np.ndarray:
    """Probability of article for each block of pages of ``sizes`` blocks."""
    x, mask, step, page = _padded(_inputs(model, feats), sizes)
    f, _ = _run(x, mask, model["xf"], model["hf"], model["cf"], False)
    b, _ = _run(x, mask, model["xb"], model["hb"], model["cb"], True)
    return _sig((np.concatenate([f, b], axis=2) @ model["out"] + model["bias"][0])[step, page])


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, seed: int = 7) -> dict[str, np.ndarray]:
    """Fit on pages with a label per block: 1 article, 0 other, -1 unknown."""
    model, features = new_model(seed), Features()
    rnd = np.random.default_rng(seed)
    mean, power, turn = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(3))
    pages = sorted((p for p in pages if p[0]), key=lambda p: len(p[0]))
    batches = [pages[a:a + BATCH] for a in range(0, len(pages), BATCH)]
    ready = [(features([p for p, _ in b]), np.array([len(p) for p, _ in b]), np.array([y for _, ys in b for y in ys]))
             for b in batches]
    count = 0
    for _ in range(epochs):
        for k in rnd.permutation(len(ready)):
            feats, sizes, y = ready[k]
            rows = _inputs(model, feats)
            x, mask, step, page = _padded(rows, sizes)
            f, kf = _run(x, mask, model["xf"], model["hf"], model["cf"], False)
            b, kb = _run(x, mask, model["xb"], model["hb"], model["cb"], True)
            both = np.concatenate([f, b], axis=2)
            p = _sig((both @ model["out"] + model["bias"][0])[step, page])
            known = y >= 0
            d = np.zeros(x.shape[:2], np.float32)
            d[step, page] = np.where(known, p - y, 0) / max(known.sum(), 1)
            grad = {"out": np.einsum("tp,tph->h", d, both), "bias": np.array([d.sum()], np.float32)}
            d_both = d[:, :, None] * model["out"]
            grad["xf"], grad["hf"], grad["cf"], df = _run_back(x, kf, model["xf"], model["hf"], d_both[:, :, :HIDDEN])
            grad["xb"], grad["hb"], grad["cb"], db = _run_back(x, kb, model["xb"], model["hb"], d_both[:, :, HIDDEN:])
            dx = (df + db)[step, page]
            paths, n_path, words, n_word, _ = feats
            for name, ids, n, part in (("paths", paths, n_path, dx[:, :DIM_PATH]),
                                       ("words", words, n_word, dx[:, DIM_PATH:DIM_PATH + DIM_WORD])):
                g = np.zeros_like(model[name])
                np.add.at(g, ids, np.repeat(part / n[:, None], n, axis=0))
                grad[name] = g
            count += 1
            for name, g in grad.items():  # Adam
                mean[name] = 0.9 * mean[name] + 0.1 * g
                power[name] = 0.999 * power[name] + 0.001 * g * g
                model[name] = (model[name] - RATE * (mean[name] / (1 - 0.9 ** count))
                               / (np.sqrt(power[name] / (1 - 0.999 ** count)) + 1e-8)).astype(np.float32)
    return model


# ---------------------------------------------------------- training pages
#: Names on a path that say outright that a block is not the article.
OTHER_NAMES = frozenset("nav footer aside form button select option menu .nav .navigation .menu .footer .sidebar .aside .ad "
                        ".ads .advert .advertisement .adsbygoogle .sponsored .sponsor .promo .banner .cookie .cookies .consent "
                        ".gdpr .notice .comment .comments .commentlist .respond .disqus .breadcrumb .breadcrumbs .related "
                        ".share .social .newsletter .subscribe .widget .masthead .copyright .pagination".split())
ARTICLE_NAMES = frozenset("article main".split())


def outright(block: Block) -> int:
    """1, 0 or -1 (unknown) from a block's own markup."""
    names = set(block.path)
    if names & OTHER_NAMES:
        return 0
    if names & ARTICLE_NAMES:
        return 1
    return 0 if "header" in names else -1


_ARTICLE = ["article", "main", "main article", "div.post", "div#content", "div.entry-content", "section.story",
            "div.article-body", "div.content div", "div", "div div", "section", "table tr td", "div.page-content",
            "div.text", "div#main", "div.post-body", "main div.prose", "article div.body", "center", ""]
_OTHER = {
    "nav": ["nav ul li a", "div.menu ul li a", "div#navigation a", "ul.nav-list li a", "header nav a", "div.breadcrumbs a",
            "div ul li a", "div.top-bar a", "div#menu p a", "div.pagination a", "table tr td a", "header ul li a"],
    "header": ["header div.logo", "header p", "div.masthead h2", "div#header p", "div.site-header span", "header h1",
               "div.header div", "header div.tagline"],
    "footer": ["footer", "footer p", "div#footer p", "div.site-footer div", "div.copyright", "footer div small",
               "footer ul li a", "div.footer-links a", "div.legal p"],
    "sidebar": ["aside h3", "aside p", "aside div.widget p", "div.sidebar p", "div#secondary ul li a", "div.widget ul li a",
                "div.sidebar h3", "aside ul li", "div.right-column p"],
    "notice": ["div.cookie-notice p", "div#consent p", "div.gdpr-banner", "div.alert", "div.cookie-banner span",
               "div.notice p", "div.modal p", "section.notification p"],
    "ad": ["div.ad", "div.advert p", "section.sponsored p", "div.promo", "ins.adsbygoogle", "div#ad-top", "div.banner p",
           "article div.ad", "article div.promo p", "main aside p", "div.sponsor a", "div.advertisement"],
    "form": ["form label", "form p", "form.newsletter p", "div.subscribe form", "form select option", "form button",
             "div.search form", "article form p", "fieldset legend"],
    "comments": ["section.comments ol li p", "div#comments div.comment p", "div.comment-list article p", "ul.commentlist li p",
                 "section#respond p", "div.discussion div p", "div.comments article div", "article section.comments p",
                 "div.comments h3", "div#disqus p"],
    "related": ["div.related ul li a", "div.share a", "ul.social li a", "section.related h3", "div.tags a", "div.more a",
                "div.author-box p", "article div.related a"],
}
_NOTE = "we use cookies accept privacy policy our site agree settings".split()
_LEGAL = "© all rights reserved copyright terms contact imprint".split()


def _made_path(spec: str) -> tuple[str, ...]:
    out = []
    for e in spec.split():
        tag, *names = re.split(r"(?=[.#])", e)
        out += [tag] + ["." + w for n in names for w in _PARTS.findall(n[1:])]
    return tuple(out)


def made_page(rnd: random.Random, words: list[str]) -> tuple[list[Block], list[int]]:
    """A page composed of article and other blocks, with labels."""
    def some(lo, hi, dots=True, own=()):
        n = rnd.randint(lo, hi)
        w = [rnd.choice(own) if own and rnd.random() < 0.4 else rnd.choice(words) for _ in range(n)]
        text = " ".join(w)
        return text[:1].upper() + text[1:] + ("." if dots and rnd.random() < 0.85 else "")

    base = ["html", "body"] if rnd.random() < 0.9 else ["body"]
    base += [x for x in (rnd.choice(["div.wrapper", "div.container", "div#page", "div", ""]),) if x and rnd.random() < 0.4]
    blocks, labels = [], []

    def put(spec: str, text: str, y: int, linked: float = 0.0):
        path = _made_path(" ".join(base) + " " + spec)
        blocks.append(Block(text, path, int(len(text) * linked)))
        labels.append(y)

    def other(kind: str):
        spec = rnd.choice(_OTHER[kind])
        link = 1.0 if spec.endswith(" a") else 0.0
        if kind in ("nav", "related") or link:
            for _ in range(rnd.randint(2, 10)):
                put(spec, some(1, 3 if kind == "nav" else 9, False), 0, link)
        elif kind == "notice":
            put(spec, some(4, 25, True, _NOTE), 0)
        elif kind == "footer":
            for _ in range(rnd.randint(1, 3)):
                put(spec, ("© " if rnd.random() < 0.6 else "") + some(2, 18, True, _LEGAL if rnd.random() < 0.5 else ()), 0)
        elif kind == "comments":
            for _ in range(rnd.randint(1, 6)):
                put(spec, some(3, 60), 0, 0.1 * (rnd.random() < 0.2))
        elif kind == "form":
            for _ in range(rnd.randint(1, 4)):
                put(spec, some(1, 8, False), 0)
        else:
            for _ in range(rnd.randint(1, 4)):
                put(spec, some(2, 30), 0)

    for kind in ("header", "nav", "notice", "ad", "form"):
        if rnd.random() < {"nav": 0.85, "ad": 0.5, "header": 0.5}.get(kind, 0.2):
            other(kind)
    if rnd.random() < 0.1:
        other("sidebar")
    spec = rnd.choice(_ARTICLE[:3] if rnd.random() < 0.45 else _ARTICLE)
    n = 0 if rnd.random() < 0.03 else rnd.choice([1, 2, 3, 4, 5, 6, 8, 10, 14, 20])
    if n and rnd.random() < 0.75:
        put(spec + " " + rnd.choice(["h1", "h2", "header h1", "h1 span"]), some(2, 14, False), 1)
    for _ in range(n):
        if rnd.random() < 0.06:
            put(spec + " " + rnd.choice(["div.ad", "aside p", "div.promo p", "div.newsletter p"]), some(2, 25), 0)
        leaf = rnd.choice(["p", "p", "p", "p", "p", "p b", "p b", "p", "h2", "h3", "blockquote", "ul li", "ol li", "pre", "div",
                           "table tr td", "figure figcaption"])
        long = leaf in ("p", "p b", "blockquote", "div")
        put(spec + " " + leaf, some(*((1, 12) if not long else (1, 25) if rnd.random() < 0.3 else (10, 160))), 1,
            0.2 * (rnd.random() < 0.1))
    for kind in ("related", "comments", "sidebar", "ad", "form", "footer"):
        if rnd.random() < {"footer": 0.85, "comments": 0.4}.get(kind, 0.25):
            other(kind)
    return blocks, labels


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, made_pages: int = MADE_PAGES, epochs: int = EPOCHS) -> dict:
    """The model, from a bounded sample of the pages (first in hash order)."""
    short = (pages.select(F.col("html").cast("string").alias("html"))
                  .filter(F.col("html").isNotNull() & (F.char_length("html") <= MAX_FIT_CHARS))
                  .withColumn("h", F.xxhash64("html")))
    n = short.select("h").count()
    cut = first_by_hash(short.select("h").distinct(), "h", sample_pages, n).agg(F.max("h")).first()[0]
    rows = (short.filter(F.col("h") <= F.lit(-(1 << 63) if cut is None else cut))
                 .groupBy("h").agg(F.min("html").alias("html")).orderBy("h").limit(sample_pages).collect())
    real = [blocks_of(r["html"]) for r in rows]
    words = sorted({w for p in real for b in p for w in b.text.split()[:200]})
    if len(words) < 50:
        words += ["w%d" % k for k in range(50)]
    rnd = random.Random(11)
    made = [made_page(rnd, words) for _ in range(made_pages)]
    return train(made + [(p, [outright(b) for b in p]) for p in real], epochs)


# -------------------------------------------------------------- extraction
def extract_pages(pages: list[str | None], model: dict, features: Features) -> list[tuple[str, int, int]]:
    """(text, blocks, article blocks) of each page."""
    cut = [blocks_of(p) for p in pages]
    out: list = [("", 0, 0)] * len(pages)
    order = sorted((k for k in range(len(pages)) if cut[k]), key=lambda k: len(cut[k]))
    at = 0
    while at < len(order):
        to = at + 1
        while to < len(order) and len(cut[order[to]]) * (to + 1 - at) <= CELLS:
            to += 1
        part = order[at:to]
        at = to
        sizes = np.array([len(cut[k]) for k in part])
        keep = label(model, features([cut[k] for k in part]), sizes) >= 0.5
        begin = 0
        for k, n in zip(part, sizes.tolist()):
            article = [b.text for b, y in zip(cut[k], keep[begin:begin + n]) if y]
            out[k] = ("\n\n".join(article), n, len(article))
            begin += n
    return out


def extract(pages: DataFrame, model: dict) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks, n_article of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # fixed size

    def run(batches):
        features = Features()
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                got = extract_pages(part.column(2).to_pylist(), shared.value, features)
                text, n, m = zip(*got)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(text, pa.string()), pa.array(list(map(len, text)), pa.int64()),
                     pa.array(n, pa.int64()), pa.array(m, pa.int64())],
                    names=["page_id", "url", "text", "n_chars", "n_blocks", "n_article"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_article long")


def op1_html_blocks(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
