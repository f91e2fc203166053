"""Operator 12: substring dedup over a de Bruijn graph of word windows.

The edges of the graph are the windows of ``window`` consecutive words; an edge
leads from the window's words but the last to its words but the first. A word
goes when a window over it also starts in a document of a smaller id.

1. Edges. A window counts as an edge when its anchor, the smallest hash of
   its ``ANCHOR``-word runs, is in more than one document: equal windows have
   equal anchors, and one anchor stands for several windows, so this search
   moves a small part of the hashes.
2. Source coordinates. Edges (96 hash bits) meet in buckets, which find the
   first coordinate (smallest document, place) of every edge, and answer each
   bundle of documents that holds the edge in a later document.
3. Paths. The bundles are joined with the answers, and every document walks
   the graph: repeated edges compact to one path as long as nothing branches,
   that is as long as the source coordinate advances by one with the walk.
4. Verification. Distinct paths are joined with their source documents, and
   the words there are compared by a 160-bit digest of their bytes. If one
   differs (a collision of hashes), all is done again with other hashes.

Whatever a bundle holds many times it sends once (see ``bundles``), so a
passage of very many documents meets in one bucket only once per bundle, and
its paths are made distinct before they are sent to the source. The texts are
shuffled once per plan: steps 1 to 3 share the exchange.

Defined results: a null or empty text has no words; documents shorter than the
window keep all; a null id is larger than every other id; rows of one id, and
so repeated rows, do not remove each other's words; long texts are split as a
whole, which takes some 60 bytes a word for the document at hand; an empty
table gives no rows; other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.llm.bundles import MAX_BUCKETS, bundle_count, bundled, pack, unpack
from adherence.llm.common import checkpointed, table

WINDOW = 13
ANCHOR = 8
SEEDS = 5
MEMO = 300_000
BROADCAST_IDS = 2_000_000  # source documents (8 bytes each) that are sent to all tasks
_LAST = 2 ** 63 - 1  # a null id
_U = np.uint64


class WordHashes(dict):
    """Two 64-bit hashes of a word by its bytes; the memo holds places in ``raw``."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed, self.raw = seed, bytearray()

    def digest(self, word: bytes) -> bytes:
        return xxhash.xxh3_128_digest(word, self.seed)

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        self.raw += self.digest(word)
        return at

    def of(self, words: list[bytes]) -> np.ndarray:
        """A row of two hashes for each word."""
        if len(self) > MEMO:
            self.clear()
            self.raw.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.frombuffer(self.raw, np.uint64).reshape(-1, 2)[at]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def runs(words: np.ndarray, k: int, step: int) -> np.ndarray:
    """Hash of the k words from every place on."""
    n = max(len(words) - k + 1, 0)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * _U(step) + words[j: j + n]
    return mixed(h)


class Bundle:
    """The windows of a bundle's documents, which are put in order of id.

    ``doc`` and ``at`` have a window's document (by its place in ``ids``) and
    first word, ``high`` and ``low`` its hashes, ``anchor`` its anchor."""

    def __init__(self, rows: pa.Table, window: int, hashes: WordHashes):
        ids = np.array([_LAST if i is None else i for i in rows.column("doc_id").to_pylist()], np.int64)
        texts = [x or b"" for x in rows.column("body").to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.ids, self.texts = ids[order], [texts[i] for i in order]
        words = [hashes.of(t.split()) for t in self.texts]
        self.n_words = [len(w) for w in words]
        ends = np.cumsum(self.n_words)
        both = np.concatenate([*words, np.empty((0, 2), np.uint64)])
        del words
        one, two = np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])
        doc = np.repeat(np.arange(len(ends)), self.n_words)
        place = np.arange(len(doc))
        # Windows that end in the document they start in.
        good = np.flatnonzero(place + window <= np.repeat(ends, self.n_words))
        k = min(ANCHOR, window)
        grams = runs(one, k, 0xD6E8FEB86659FD93)
        least = grams[good]
        for j in range(1, window - k + 1):
            np.minimum(least, grams[good + j], out=least)
        self.anchor, self.doc = least, doc[good]
        self.at = place[good] - (ends - self.n_words)[self.doc]
        self.high = runs(one, window, 0x9E3779B97F4A7C15)[good]
        self.low = (runs(two, window, 0xA0761D6478BD642F)[good] >> _U(32)).astype(np.uint32)


def grouped(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): a stable order by (high, low), and where groups start."""
    order = np.argsort(high, kind="stable")
    h, w = high[order], low[order]
    if ((h[1:] == h[:-1]) & (w[1:] != w[:-1])).any():  # rare: one hash, two words sequences
        order = np.lexsort((low, high))
        h, w = high[order], low[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
    return order, np.flatnonzero(new)


def cut(high: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted hashes: a bucket is a range of hashes."""
    bounds = [(b << 64) // buckets for b in range(1, buckets)]
    edges = [0, *np.searchsorted(high, np.array(bounds, np.uint64)).tolist(), len(high)]
    for b, (lo, hi) in enumerate(zip(edges, edges[1:])):
        if hi > lo:
            yield b, lo, hi


def _delta(sorted_: np.ndarray) -> np.ndarray:
    return np.diff(sorted_, prepend=_U(0))


class Steps:
    """The steps as functions of Arrow tables, as Spark's group operations take them."""

    def __init__(self, window: int, buckets: int, seed: int, new_hashes: Callable[[int], WordHashes] = WordHashes):
        self.window, self.buckets, self.seed, self.new_hashes = window, buckets, seed, new_hashes

    def _bundle(self, rows: pa.Table) -> Bundle:
        global _HASHES
        if _HASHES is None or _HASHES.seed != self.seed or type(_HASHES) is not self.new_hashes:
            _HASHES = self.new_hashes(self.seed)
        return Bundle(rows, self.window, _HASHES)

    @staticmethod
    def _anchors(b: Bundle) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors in order, and which of them are in several documents."""
        order = np.argsort(b.anchor, kind="stable")
        a, ids = b.anchor[order], b.ids[b.doc[order]]
        starts = np.flatnonzero(np.diff(a, prepend=~a[:1])) if len(a) else np.empty(0, np.int64)
        if not len(starts):
            return a, np.empty(0, bool)
        return a[starts], np.minimum.reduceat(ids, starts) < np.maximum.reduceat(ids, starts)

    def anchors(self, rows: pa.Table) -> pa.Table:
        """Bundle -> (bucket, bundle, data): its distinct anchors."""
        a, _ = self._anchors(self._bundle(rows))
        bundle = rows.column("bundle")[0].as_py()
        return _rows([(k, bundle, pack(_delta(a[lo:hi]))) for k, lo, hi in cut(a, self.buckets)], FACTS)

    def shared(self, rows: pa.Table) -> pa.Table:
        """Bucket of anchors -> (bundle, bucket, data): a bit for each anchor
        that a bundle sent, set where another bundle has it too."""
        sent = sorted(zip(rows.column("bundle").to_pylist(), rows.column("data").to_pylist()))
        lists = [np.cumsum(unpack(d, np.uint64)[0], dtype=np.uint64) for _, d in sent]
        _, back, n = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        many, at, out = n[back] > 1, 0, []
        bucket = rows.column("bucket")[0].as_py()
        for (bundle, _), own in zip(sent, lists):
            out.append((bucket, bundle, np.packbits(many[at: at + len(own)]).tobytes()))
            at += len(own)
        return _rows(out, FACTS)

    def edges(self, rows: pa.Table, bits: pa.Table) -> pa.Table:
        """Bundle and bits -> (bucket, bundle, data): the distinct windows with
        a shared anchor and the first coordinate of each in the bundle."""
        if not len(rows):
            return _rows([], FACTS)
        b = self._bundle(rows)
        a, several = self._anchors(b)
        given = dict(zip(bits.column("bucket").to_pylist(), bits.column("data").to_pylist()))
        for k, lo, hi in cut(a, self.buckets):
            several[lo:hi] |= np.unpackbits(np.frombuffer(given[k], np.uint8), count=hi - lo).astype(bool)
        keep = np.flatnonzero(several[np.searchsorted(a, b.anchor)]) if len(a) else np.empty(0, np.int64)
        high, low = b.high[keep], b.low[keep]
        order, starts = grouped(high, low)
        first = order[starts]  # windows are in order of (id, place): the first of a group is its first coordinate
        high, low, ids, at = high[first], low[first], b.ids[b.doc[keep[first]]], b.at[keep[first]].astype(np.uint32)
        bundle = rows.column("bundle")[0].as_py()
        return _rows([(k, bundle, pack(_delta(high[lo:hi]), low[lo:hi], ids[lo:hi], at[lo:hi]))
                      for k, lo, hi in cut(high, self.buckets)], FACTS)

    def sources(self, rows: pa.Table) -> pa.Table:
        """Bucket of edges -> (bundle, bucket, data): for every edge that a
        bundle has in a later document, its first coordinate."""
        sent = sorted(zip(rows.column("bundle").to_pylist(), rows.column("data").to_pylist()))
        cols = [unpack(d, np.uint64, np.uint32, np.int64, np.uint32) for _, d in sent]
        sizes = [len(c[0]) for c in cols]
        high = np.concatenate([np.cumsum(c[0], dtype=np.uint64) for c in cols])
        low, ids, at = (np.concatenate([c[i] for c in cols]) for i in (1, 2, 3))
        order, starts = grouped(high, low)
        group = np.zeros(len(order), np.int64)
        group[starts] = 1
        group = np.cumsum(group) - 1
        least = np.minimum.reduceat(ids[order], starts)
        is_first = ids[order] == least[group]
        where = np.flatnonzero(is_first)
        where = where[np.diff(group[where], prepend=-1) > 0]  # one for each group
        source = np.empty(len(order), np.int64)
        source[order] = order[where][group]
        later = ids[source] < ids
        bucket = rows.column("bucket")[0].as_py()
        out, lo = [], 0
        for (bundle, _), n in zip(sent, sizes):
            own = lo + np.flatnonzero(later[lo: lo + n])
            lo += n
            if len(own):
                s = source[own]
                out.append((bucket, bundle, pack(_delta(high[own]), low[own], ids[s], at[s])))
        return _rows(out, FACTS)

    def walk(self, rows: pa.Table, answers: pa.Table, with_text: bool) -> pa.Table:
        """Bundle and answers -> the documents without their repeated words,
        and the paths that were walked in each."""
        if not len(rows):
            return _rows([], _result(with_text))
        b = self._bundle(rows)
        sent = sorted(zip(answers.column("bucket").to_pylist(), answers.column("data").to_pylist()))
        cols = [unpack(d, np.uint64, np.uint32, np.int64, np.uint32) for _, d in sent]
        known = [np.concatenate(x) for x in zip(*[(np.cumsum(c[0], dtype=np.uint64), *c[1:]) for c in cols])] if cols else None
        # The first coordinate in this bundle, or the one that was answered.
        order, starts = grouped(b.high, b.low)
        group = np.zeros(len(order), np.int64)
        group[starts] = 1
        group = np.cumsum(group) - 1
        first = order[starts]
        src_id, src_at = b.ids[b.doc[first]], b.at[first].copy()
        if known is not None and len(first):
            high, low, ids, at = known
            for step in range(2):  # two answers with one high hash lie side by side
                place = np.minimum(np.searchsorted(high, b.high[first]) + step, len(high) - 1)
                hit = np.flatnonzero((high[place] == b.high[first]) & (low[place] == b.low[first]))
                hit = hit[ids[place[hit]] < src_id[hit]]
                src_id[hit], src_at[hit] = ids[place[hit]], at[place[hit]]
        own_id, own_at = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        own_id[order], own_at[order] = src_id[group], src_at[group]
        gone = own_id < b.ids[b.doc] if len(b.doc) else np.empty(0, bool)
        # A path goes on where window, place and source advance together.
        go_on = np.zeros(len(gone), bool)
        go_on[1:] = (gone[1:] & gone[:-1] & (b.doc[1:] == b.doc[:-1]) & (own_id[1:] == own_id[:-1])
                     & (own_at[1:] == own_at[:-1] + 1))
        heads = np.flatnonzero(gone & ~go_on)
        tails = np.flatnonzero(gone & ~np.append(go_on[1:], False))
        out, h = [], 0
        for d, text in enumerate(b.texts):
            n, spans = b.n_words[d], []
            words = None
            cover = np.zeros(n + 1, np.int64)
            while h < len(heads) and b.doc[heads[h]] == d:
                words = text.split() if words is None else words
                lo, hi = int(b.at[heads[h]]), int(b.at[tails[h]]) + self.window
                cover[lo] += 1
                cover[hi] -= 1
                spans.append({"start": lo, "words": hi - lo, "source": int(own_id[heads[h]]), "place": int(own_at[heads[h]]),
                              "digest": _digest(words[lo:hi])})
                h += 1
            if spans:
                stays = np.cumsum(cover[:n]) == 0
                kept = b" ".join([w for w, s in zip(words, stays.tolist()) if s])
                removed = n - int(stays.sum())
            else:
                kept, removed = b" ".join(text.split()), 0
            doc_id = None if b.ids[d] == _LAST else int(b.ids[d])
            out.append((doc_id, n, removed, kept.decode("utf-8", "replace") if with_text else hashlib.sha256(kept).hexdigest(), spans))
        return _rows(out, _result(with_text))


_HASHES: WordHashes | None = None
FACTS = pa.schema([("bucket", pa.int32()), ("bundle", pa.int32()), ("data", pa.binary())])
_SPAN = pa.struct([("start", pa.int64()), ("words", pa.int64()), ("source", pa.int64()), ("place", pa.int64()), ("digest", pa.binary())])
FACTS_DDL = "bucket int, bundle int, data binary"
SPAN_DDL = "array<struct<start: long, words: long, source: long, place: long, digest: binary>>"


def _result(with_text: bool) -> pa.Schema:
    return pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                      ("kept_text" if with_text else "kept_sha256", pa.string()), ("spans", pa.list_(_SPAN))])


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=20).digest()


def _walked(docs: DataFrame, n: int, steps: Steps, id_col: str, text_col: str, with_text: bool) -> DataFrame:
    """Steps 1 to 3 as one plan."""
    rows = bundled(docs, n, id_col, text_col)
    anchors = rows.groupBy("bundle").applyInArrow(lambda t: steps.anchors(t), FACTS_DDL)
    bits = anchors.groupBy("bucket").applyInArrow(lambda t: steps.shared(t), FACTS_DDL)
    edges = rows.groupBy("bundle").cogroup(bits.groupBy("bundle")).applyInArrow(
        lambda t, found: steps.edges(t, found), FACTS_DDL)
    answers = edges.groupBy("bucket").applyInArrow(lambda t: steps.sources(t), FACTS_DDL)
    out = f"doc_id long, n_words long, n_removed long, {'kept_text' if with_text else 'kept_sha256'} string, spans {SPAN_DDL}"
    return rows.groupBy("bundle").cogroup(answers.groupBy("bundle")).applyInArrow(
        lambda left, right: steps.walk(left, right, with_text), out)


def false_paths(walked: DataFrame, docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Step 4: the distinct paths whose words are not at their source."""
    paths = (walked.select(F.explode("spans").alias("s")).select("s.source", "s.place", "s.words", "s.digest")
                   .groupBy("source", "place", "words", "digest").agg(F.count("*").alias("n")).drop("n"))
    paths = checkpointed(paths)
    sources = paths.select("source").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("source"), F.col(text_col).cast("string").cast("binary").alias("body"))
    few = sources.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    texts = texts.join(F.broadcast(sources) if few else sources, "source", "left_semi")

    def verify(asked: pa.Table, found: pa.Table) -> pa.Table:
        """Paths and documents of some sources; rows of one id are one source."""
        texts: dict[int, list] = {}
        for i, body in zip(found.column("source").to_pylist(), found.column("body").to_pylist()):
            texts.setdefault(i, []).append((body or b"").split())
        bad = [(s, p) for s, p, w, d in zip(*(asked.column(c).to_pylist() for c in ("source", "place", "words", "digest")))
               if not any(_digest(t[p: p + w]) == d for t in texts.get(s, ()))]
        return _rows(bad, pa.schema([("source", pa.int64()), ("place", pa.int64())]))

    deal = F.pmod(F.xxhash64("source"), F.lit(4 * n)).cast("int")
    return (paths.withColumn("deal", deal).groupBy("deal").cogroup(texts.withColumn("deal", deal).groupBy("deal"))
                 .applyInArrow(verify, "source long, place long"))


def remove_repeated_spans(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                          with_text: bool = True, new_hashes: Callable[[int], WordHashes] = WordHashes) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, spans) of every document; with
    ``with_text=False`` the SHA-256 of the kept words instead of the words.
    ``spans`` has the verified paths: first word, number of words, and the
    source document and place that has them first."""
    n = bundle_count(docs, text_col)
    for seed in range(SEEDS):
        steps = Steps(window, min(n, MAX_BUCKETS), seed, new_hashes)
        walked = checkpointed(_walked(docs, n, steps, id_col, text_col, with_text))
        if false_paths(walked, docs, n, id_col, text_col).isEmpty():
            return walked
    raise RuntimeError(f"hash collisions with {SEEDS} seeds")


def op12_substring_dedup(spark, sf_dir: str) -> DataFrame:
    rows = remove_repeated_spans(table(spark, sf_dir, "documents"), with_text=False)
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")
