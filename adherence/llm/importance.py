"""Operator 13: target-distribution importance resampling.

Documents are drawn so that their hashed words and word pairs follow a target
corpus. The features of a text are its runs of 1 to ``max_run`` consecutive
words; a feature's bucket is the CRC-32 of its UTF-8 bytes modulo ``buckets``.
With s of the corpus' S features and t of the target's T in a bucket, its gain
is floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))). A document's weight
is the floored mean gain of its features; seeded Gumbel noise is added, and
the highest scores are drawn without replacement.

CRCs are computed in length buckets: the distinct features of a batch are
grouped by byte length into two-dimensional uint8 matrices, the CRCs of all
rows of a matrix are advanced column by column, and the results are scattered
back to the places of the features. (Features of more than ``LONG`` bytes,
which come alone in their length, are handed to zlib's CRC-32 one by one.)

Plan: one scan of the texts writes every document's bucket numbers (two bytes
a feature before packing) to the checkpoint folder; from there they are
counted (every task adds up its own ``buckets`` counters, so what is shuffled
does not follow the text) and weighed with the gains (``buckets`` numbers, the
bound of what is sent to the tasks); one range shuffle of the scores (no
texts) ranks the documents.

Defined results: a null or empty text, or one without words, has no features
and weight 0; long texts are read in slices of ``SLICE`` bytes, cut between
words; ties go to the smaller doc_id; a null id counts as the text 'null' in
the noise and is larger than every other id; repeated rows are documents of
their own, in any order among themselves; an empty table gives no rows, and
an empty target gives gains all the same; other columns are ignored."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.llm.bundles import pack, ragged, unpack
from adherence.llm.common import checkpointed, table

BUCKETS, MAX_RUN, SEED, PERCENT, MIN_WORDS = 10_000, 2, 7, 25, 20
SLICE = 1 << 21  # bytes of text split into words at a time
STEP_WORDS = 300_000  # words whose features are hashed at a time
LONG = 1024  # bytes of a feature that a matrix still takes
CELLS = 1 << 22  # bytes of a matrix

#: Every byte: letters lower-cased, digits and bytes of other characters kept, the rest a space.
FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256))


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


CRC = _crc_table()


def crc_columns(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a uint8 matrix, all rows a column at a time."""
    state = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for col in np.ascontiguousarray(matrix.T):
        state = CRC[(state ^ col) & np.uint32(0xFF)] ^ (state >> np.uint32(8))
    return ~state


def crc_of_runs(store: np.ndarray, starts: np.ndarray, lengths: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """CRC-32 of word runs: ``runs`` has the word numbers of a feature in each
    row; the bytes of a word, with a space behind, lie in ``store``."""
    sizes = lengths[runs].sum(axis=1) + runs.shape[1] - 1
    out = np.empty(len(runs), np.uint32)
    order = np.argsort(sizes.astype(np.uint16) if sizes.max(initial=0) < 1 << 16 else sizes, kind="stable")  # short keys: a radix sort
    edges = np.flatnonzero(np.diff(sizes[order], prepend=-1))
    for lo, hi in zip(edges, [*edges[1:], len(order)]):
        size = int(sizes[order[lo]])
        step = max(1, CELLS // max(size, 1))
        for at in range(lo, hi, step):
            rows = order[at: min(at + step, hi)]
            words = runs[rows]
            # Words with the space behind each follow one another; the last space falls off.
            take = ragged(starts[words].ravel(), lengths[words].ravel() + 1)
            bytes_ = store[take].reshape(len(rows), size + 1)[:, :size]
            if size > LONG:
                out[rows] = [zlib.crc32(r.tobytes()) for r in bytes_]
            else:
                out[rows] = crc_columns(bytes_)
    return out


class _Words(dict):
    """Numbers of words in the order of their first place."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some SLICE bytes of it at a time."""
    folded = text.translate(FOLD)
    at = 0
    while at < len(folded):
        to = folded.find(b" ", at + SLICE)
        to = len(folded) if to < 0 else to
        yield folded[at:to].split()
        at = to


def steps(texts: list[bytes], max_run: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(numbers, documents, words): word numbers in text order with the index
    of their document, for some STEP_WORDS words at a time. Where a document is
    cut, its last words come before its next part once more, so that no run is
    lost; they have the index -1 - d."""
    parts: list[list[bytes]] = []
    docs: list[int] = []
    n = 0

    def numbered():
        seen = _Words()
        ids = np.fromiter(map(seen.__getitem__, chain.from_iterable(parts)), np.int64)
        return ids, np.repeat(np.array(docs, np.int64), [len(p) for p in parts]), list(seen)

    for d, text in enumerate(texts):
        for words in word_slices(text):
            parts.append(words)
            docs.append(d)
            n += len(words)
            if n >= STEP_WORDS:
                yield numbered()
                last = [w for p, of in zip(parts[-max_run:], docs[-max_run:]) if of in (d, -1 - d) for w in p]
                parts, docs, n = [last[len(last) - min(len(last), max_run - 1):]], [-1 - d], 0
    if n:
        yield numbered()


def feature_buckets(texts: list[bytes], buckets: int, max_run: int = MAX_RUN) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, buckets, words per document of this step) of all features."""
    for ids, docs, words in steps(texts, max_run):
        whole = np.where(docs < 0, -1 - docs, docs)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        store = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        starts = np.cumsum(lengths + 1) - lengths - 1
        of, found = [], []
        code = ids
        for run in range(1, max_run + 1):
            m = len(ids) - run + 1
            if m <= 0:
                break
            # Numbers of the distinct runs, from those of the runs one shorter.
            _, first, code = np.unique(ids if run == 1 else code[:m] * len(words) + ids[run - 1:],
                                       return_index=True, return_inverse=True)
            crc = crc_of_runs(store, starts, lengths, np.stack([ids[first + j] for j in range(run)], axis=1))
            # A run lies in one document and ends in a word that is new here.
            good = (whole[:m] == whole[run - 1:]) & (docs[run - 1:] >= 0)
            found.append((crc % np.uint32(buckets)).astype(np.int64)[code[good]])
            of.append(whole[:m][good])
        yield np.concatenate(of), np.concatenate(found), np.bincount(docs[docs >= 0], minlength=len(texts))


def bucketed(docs: DataFrame, buckets: int = BUCKETS, id_col: str | None = "doc_id", text_col: str = "text",
             max_run: int = MAX_RUN) -> DataFrame:
    """(doc_id, n_words, found): the buckets of all features of a document, as
    packed 16- or 32-bit numbers in no order."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or b"" for x in batch.column(1).to_pylist()]
            parts: list[list[bytes]] = [[] for _ in texts]
            words = np.zeros(len(texts), np.int64)
            for of, found, new in feature_buckets(texts, buckets, max_run):
                words += new
                order = np.argsort(of, kind="stable")
                edges = np.flatnonzero(np.diff(of[order], prepend=-1))
                found = found[order].astype(kind)
                for lo, hi in zip(edges, [*edges[1:], len(order)]):
                    parts[of[order[lo]]].append(found[lo:hi].tobytes())
            packed = [pack(np.frombuffer(b"".join(p), kind)) for p in parts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(packed, pa.binary())],
                                             ["doc_id", "n_words", "found"])

    doc_id = F.col(id_col) if id_col else F.lit(None)
    return (docs.select(doc_id.cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("body"))
                .mapInArrow(hashed, "doc_id long, n_words long, found binary"))


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features by bucket over all rows of ``bucketed``."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            found = [unpack(x, kind)[0] for x in batch.column(0).to_pylist()]
            total += np.bincount(np.concatenate([*found, np.empty(0, kind)]), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)  # the bound of what is collected
    for r in rows.select("found").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(share in the target / share in the source)), smoothed."""
    b, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (s_all + b) / ((float(s) + 1) * (t_all + b))))
                     for s, t in zip(source, target)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of rows of ``bucketed``."""
    kind = np.uint16 if len(gain) <= 1 << 16 else np.uint32

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [gain[unpack(x, kind)[0]] for x in batch.column("found").to_pylist()]
            n = np.array([len(g) for g in own], np.int64)
            weight = np.array([int(g.sum()) // max(len(g), 1) for g in own], np.int64)
            score = weight + np.array([noise(i, seed) for i in batch.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"),
                                              *(pa.array(x, pa.int64()) for x in (n, weight, score))],
                                             ["doc_id", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3 ... for the best ``percent`` of the rows
    with ``min_words`` words or more, null for others.

    The rows are ordered by a range shuffle and numbered inside their
    partition; the ranks of partitions follow from their sizes, one row each."""
    fit = F.col("n_words") >= min_words
    best = rows.repartitionByRange(~fit, F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.xxhash64(*rows.columns))
    placed = checkpointed(best.sortWithinPartitions(~fit, F.col("score").desc(), F.col("doc_id").asc_nulls_last())
                              .withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    sizes = placed.filter(fit).groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()  # a row per partition
    before, n = {}, 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        before[r["part"]], n = n, n + r["n"]
    drawn = n * percent // 100
    if not before:
        return placed.drop("place").withColumn("rank", F.lit(None).cast("long"))
    offset = placed.sparkSession.createDataFrame(list(before.items()), "part long, before long")
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (placed.withColumn("part", part).join(F.broadcast(offset), "part", "left")
                  .withColumn("rank", F.when(fit & (rank <= drawn), rank)).drop("place", "part", "before"))


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT,
             min_words: int = MIN_WORDS, max_run: int = MAX_RUN, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document;
    the drawn ones have a rank. Join on the id for the drawn texts."""
    rows = checkpointed(bucketed(docs, buckets, id_col, text_col, max_run))
    wanted = bucketed(target, buckets, None, target_col, max_run)
    gain = gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets))
    return ranked(scored(rows, gain, seed), percent, min_words)


def op13_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """Documents drawn towards the benchmark texts."""
    rows = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
