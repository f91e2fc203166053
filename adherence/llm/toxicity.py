"""Operator 6: toxicity by maximum-scoring segments.

Learning: features are words in lower case and, for words of five letters or
more, their first four letters. A feature's count in a class is its number of
different places, (word before, word), so copies of a text count once. With a
symmetric Dirichlet prior, log-odds between toxic and other texts and their
standard errors follow; features beyond ``MIN_Z`` and ``MIN_ODDS`` are kept.

Scoring: a word scores its own log-odds where it is known (none for words that
other texts use themselves), else those of its first letters; any other word
costs ``DRIFT``. One linear scan finds all maximal-scoring segments of the text. By
extreme-value theory, a text of n words without toxic passages has about
K n exp(-lambda S) segments of score S or more; what a segment has beyond that,
max(0, lambda S - ln(K n)), is its evidence. The evidence of all segments is
summed, and a logistic curve turns it into the score.

Bound of fitting (a documented parameter): ``PER_CLASS`` labelled texts of each
label; half of them for the counts, half for lambda, K and the curve. The
features that are kept come from these texts' words, which bounds what is
sent to the tasks. Scoring reads whole texts in slices, in one pass without a
shuffle.

Defined results: a null or empty text has no segments; a null doc_id is not
held out; with labels of one kind or none, every score is that kind's
smoothed share; a score of exactly the threshold is toxic; repeated rows are scored alike; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.llm.common import checkpointed, fold, table
from adherence.llm.labelled import FOLDS, labelled_sample, logistic, platt

PER_CLASS = 4000
PRIOR = 1.0
MIN_Z, MIN_ODDS = 3.0, 1.5
DRIFT = 0.1
SLICE = 1 << 20
MEMO_WORDS = 500_000
THRESHOLD = 0.5
_WORD = re.compile(r"[^\W\d_]+")
_CUT = re.compile(r"[^\w]")


def words_of(text: str | None):
    """Lists of words, slice by slice; slices end between words."""
    text = text or ""
    at = 0
    while at < len(text):
        to = at + SLICE
        if to < len(text):
            found = _CUT.search(text, to)
            to = found.end() if found else len(text)
        yield _WORD.findall(text[at:to].lower())
        at = to


def features_of(word: str) -> tuple[str, ...]:
    return (word, "^" + word[:4]) if len(word) >= 5 else (word,)


# ---------------------------------------------------------------- learning
def place_counts(sample: DataFrame) -> DataFrame:
    """(feature, toxic, other): different places of each feature by class."""
    def run(batches):
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen, before = set(), ""
                for part in words_of(t):
                    for w in part:
                        place = xxhash.xxh64_intdigest(f"{before} {w}") >> 1
                        seen.update((f, place) for f in features_of(w))
                        before = w
                if seen:
                    f, p = zip(*seen)
                    yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(p), pa.array([y] * len(f), pa.int32())],
                                                     names=["feature", "place", "y"])

    rows = sample.select("y", "text").mapInArrow(run, "feature string, place long, y int").distinct()
    one = F.when(F.col("y") == 1, 1).otherwise(0)
    return rows.groupBy("feature").agg(F.sum(one).alias("toxic"), F.sum(1 - one).alias("other"))


def log_odds(counts: DataFrame) -> dict[str, float]:
    """Log-odds of the significant features, and 0 for common words that begin
    like one."""
    whole = counts.filter(~F.col("feature").startswith("^"))
    nt, no, v = whole.agg(F.sum("toxic"), F.sum("other"), F.count("*")).first()
    nt, no = (nt or 0) + PRIOR * v, (no or 0) + PRIOR * v
    if not v:
        return {}
    a, b = F.col("toxic") + PRIOR, F.col("other") + PRIOR
    odds = F.log(a / nt) - F.log(b / no)
    kept = (counts.select("feature", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z"))
                  .filter((F.col("z") >= MIN_Z) & (F.col("odds") >= MIN_ODDS)).select("feature", "odds"))
    # Words that other texts use themselves don't follow their first letters.
    heads = kept.filter(F.col("feature").startswith("^")).select(F.substring("feature", 2, 4).alias("head"))
    plain = (whole.filter((F.char_length("feature") >= 5) & (F.col("other") > 0))
                  .withColumn("head", F.substring("feature", 1, 4)).join(heads, "head", "left_semi")
                  .join(kept, "feature", "left_anti").select("feature", F.lit(0.0).alias("odds")))
    return {r["feature"]: r["odds"] for r in kept.unionByName(plain).collect()}  # words of the sample


# ----------------------------------------------------------------- scoring
class WordScores(dict):
    """word -> its own log-odds where known, else those of its first letters,
    0 for none; a bounded memo."""

    def __init__(self, odds: dict[str, float]):
        super().__init__()
        self.odds = odds

    def __missing__(self, word: str) -> float:
        if len(self) > MEMO_WORDS:
            self.clear()
        known = [self.odds[f] for f in features_of(word) if f in self.odds]
        self[word] = s = known[0] if known else 0.0
        return s


def hits_of(text: str | None, scores: WordScores) -> tuple[int, list[tuple[int, float]]]:
    """(words, [(position, score) of the words that score])."""
    n, hits = 0, []
    for part in words_of(text):
        s = np.fromiter(map(scores.__getitem__, part), float, len(part))
        hits += [(n + int(i), float(s[i])) for i in np.flatnonzero(s)]
        n += len(part)
    return n, hits


def maximal_segments(hits: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, last word, score), in one
    scan over the scoring words; words between two of them cost ``drift``.

    A candidate keeps the sums left of it and up to its end, and the nearest
    earlier candidate with a smaller left sum, so looking back takes constant
    amortised time."""
    found: list[tuple[int, int, float, float, int]] = []
    total, last = 0.0, -1
    for p, s in hits:
        total -= drift * (p - last - 1)
        begin, left = p, total
        total += s
        last = p
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append((begin, p, left, total, j))
                break
            begin, left = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, r - l) for a, b, l, r, _ in found]


def evidence_of(n: int, segments: list[tuple[int, int, float]], lam: float, k: float) -> float:
    limit = math.log(max(k * n, 1e-9)) if n else 0.0
    return sum(max(0.0, lam * s - max(limit, 0.0)) for _, _, s in segments)


def extreme_values(clean: list[tuple[int, list[tuple[int, float]]]]) -> tuple[float, float]:
    """(lambda, K) from texts without toxic passages: lambda solves
    E exp(lambda s) = 1 over their words, K matches their segments."""
    n = sum(w for w, _ in clean)
    s = np.array([x for _, h in clean for _, x in h])
    if not n or not len(s):
        return 1.0, 1.0 / max(n, 1)

    def excess(lam):
        return (np.exp(lam * s).sum() + (n - len(s)) * math.exp(-lam * DRIFT)) / n - 1

    lo, hi = 1e-6, 1.0
    if excess(lo) >= 0:  # the words' mean is not negative
        return 0.1, 1.0
    while excess(hi) < 0 and hi < 64:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if excess(mid) < 0 else (lo, mid)
    at = float(np.median(s))
    many = sum(x >= at for _, h in clean for _, _, x in maximal_segments(h))
    return lo, max(many, 1) / n * math.exp(lo * at)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> tuple:
    """(log-odds, lambda, K, slope, intercept)."""
    sample = checkpointed(labelled_sample(docs, labels, label, per_class))
    odds = log_odds(place_counts(sample.filter("part = 0")))

    def run(batches):  # per text its words, hits, label: no texts
        scores = WordScores(odds)
        for b in batches:
            got = [hits_of(t, scores) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for n, _ in got], pa.int64()),
                 pa.array([[p for p, _ in h] for _, h in got], pa.list_(pa.int64())),
                 pa.array([[s for _, s in h] for _, h in got], pa.list_(pa.float64()))], names=["y", "n", "at", "s"])

    rest = sample.filter("part = 1").select("y", "text", "doc_id").orderBy("doc_id").select("y", "text")
    rows = rest.mapInArrow(run, "y int, n long, at array<long>, s array<double>").collect()  # bounded
    texts = [(r["y"], r["n"], list(zip(r["at"], r["s"]))) for r in rows]
    lam, k = extreme_values([(n, h) for y, n, h in texts if y == 0])
    x = np.array([math.log1p(evidence_of(n, maximal_segments(h), lam, k)) for _, n, h in texts])
    return odds, lam, k, *platt(x, np.array([y for y, _, _ in texts], float), 0.5)


def score(docs: DataFrame, model: tuple) -> DataFrame:
    """doc_id, score, evidence and the significant passages (first and last
    word, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # words of the sample
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        odds, lam, k, slope, intercept = shared.value
        scores = WordScores(odds)
        for b in batches:
            evidence, passages = [], []
            for t in b.column(1):
                n, hits = hits_of(t.as_py(), scores)
                found = maximal_segments(hits)
                evidence.append(evidence_of(n, found, lam, k))
                limit = max(math.log(max(k * n, 1e-9)), 0.0) if n else 0.0
                passages.append([{"first": a, "last": z, "score": s} for a, z, s in found if lam * s > limit])
            e = np.array(evidence, float)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(logistic(slope * np.log1p(e) + intercept)), pa.array(e), pa.array(passages, kind)],
                names=["doc_id", "score", "evidence", "passages"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, evidence double, "
                                "passages array<struct<first:long,last:long,score:double>>")


def op6_toxic_segments(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    d = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return d.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
