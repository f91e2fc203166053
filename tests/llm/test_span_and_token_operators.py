"""Operators 11 to 13 against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from adherence.llm import alignment, importance, substrings
from adherence.llm.bundles import pack, ragged, unpack
from conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG_TEXT = " ".join(f"w{i % 977}" for i in range(6_000))


def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def odd_documents(spark):
    """Nulls, empty and blank texts, repeated rows, ties, a long text, columns
    with the names that the operators use themselves."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "short text"), (5, passage), (5, passage), (6, "head " + passage + " tail"),
            (None, passage), (None, "x " + passage), (7, LONG_TEXT), (8, "Ünï 日本 🙂 a" * 30), (9, "x" * 30_000), (10, passage.upper())]
    return spark.createDataFrame([(t, i, "clash", 1, "s") for i, t in rows], "text string, doc_id long, bundle string, score int, spans string")


def test_packed_columns_come_back():
    g = np.random.default_rng(1)
    cols = [np.sort(g.integers(0, 2 ** 63, 50).astype(np.uint64)), g.integers(-5, 5, 50), g.integers(0, 99, 50).astype(np.uint32)]
    back = unpack(pack(*cols), np.uint64, np.int64, np.uint32)
    assert all((a == b).all() for a, b in zip(cols, back))
    assert all(len(x) == 0 for x in unpack(pack(*(c[:0] for c in cols)), np.uint64, np.int64, np.uint32))
    assert ragged(np.array([5, 0, 9]), np.array([2, 0, 3])).tolist() == [5, 6, 9, 10, 11]


# ---------------------------------------------------------- operator 11
def aligned_by_hand(docs):
    """The contract redone with whole-text encodings by the files' own libraries."""
    import sentencepiece
    from tokenizers import Tokenizer
    a_side = Tokenizer.from_file(alignment.A_FILE)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=alignment.B_FILE)
    of = alignment.byte_alphabet()
    a_bytes = {i: bytes(of[c] for c in w) for w, i in a_side.get_vocab().items() if i != 50256}
    b_bytes = [bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode()
               for i in range(b_side.get_piece_size())]
    per, count = [], Counter()
    for doc_id, text in docs:
        text = text or ""
        whole = (" " + text).encode()
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        if not text or b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            per.append((doc_id, None))
            continue
        ends = [np.cumsum([len(of_[i]) for i in ids]).tolist() for of_, ids in ((a_bytes, a), (b_bytes, b))]
        links, j = [], 0
        for i, x in enumerate(a):
            while ends[1][j] <= (ends[0][i - 1] if i else 0):
                j += 1
            k = j
            while k < len(b) and (k == j or ends[1][k - 1] < ends[0][i]):
                links.append((x, b[k]))
                k += 1
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            i2, j2 = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        per.append((doc_id, (len(a), len(b), links, groups)))
        count.update(set(links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return sorted(((i, 0, 0, 0, 0, 0, 0, "") if got is None else
                   (i, got[0], got[1], len(got[3]), len(got[2]), sum(count[k] == best[k[0]] for k in got[2]),
                    sum(count[k] for k in got[2]), hashlib.sha256(";".join(got[3]).encode()).hexdigest()) for i, got in per), key=str)


def test_alignment_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(alignment, "bundle_count", lambda *a: 3)
    docs = documents(spark)
    got = alignment.align(docs, with_groups=False).collect()
    assert sorted(map(tuple, got), key=str) == aligned_by_hand([(r.doc_id, r.text) for r in docs.collect()])


def test_alignment_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "bundle_count", lambda *a: 2)
    more = ["  two  blanks ", "\nline", "a\t b", "under▁score", "fi ﬁ １", "<|endoftext|> <s> </s>", "é ́x", "a b 　c", "it's the end\r\n\r\n"]
    extra = spark.createDataFrame([(t, 100 + k, "c", 1, "s") for k, t in enumerate(more)], odd_documents(spark).schema)
    docs = odd_documents(spark).unionByName(extra)
    got = alignment.align(docs, with_groups=False).collect()
    assert sorted(map(tuple, got), key=str) == aligned_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    texts = alignment.align(docs.filter("doc_id = 4")).first()
    assert texts.groups.count(";") == texts.n_groups - 1 and texts.n_a > 0
    assert alignment.align(docs.limit(0)).count() == 0


def test_chunks_are_encoded_as_the_whole_text():
    """Random texts of blanks, marks and characters that one side changes."""
    import pyarrow as pa
    enc = alignment.Encoders()
    rnd = random.Random(3)
    parts = ["a", "the", "é", "▁", " ", "  ", "\n", "\t", " ", "　", "​", "ﬁ", "１", "<s>", "'s", "12", "日本", "🙂", "́", "\x00", "..."]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(1, 20))) for _ in range(1500)]
    rows = alignment.Aligned(pa.table({"body": [t.encode() for t in texts]}), alignment.Chunks(enc))
    for t, (n_a, n_b, *_) in zip(texts, rows.stats.T.tolist()):
        a, b = enc.both(" " + t)
        whole = (" " + t).encode()
        spelt = b"".join(enc.a_bytes[i] for i in a) == whole == b"".join(enc.b_bytes[i] for i in b)
        assert (n_a, n_b) == ((len(a), len(b)) if spelt else (0, 0)), repr(t)


def test_overlaps_are_the_union_of_both_directions():
    a, b = alignment.overlaps(np.array([0, 3, 4]), np.array([0, 2, 4, 6]))
    assert list(zip(a.tolist(), b.tolist())) == [(0, 0), (0, 1), (1, 1), (2, 2), (2, 3)]


# ---------------------------------------------------------- operator 12
def removed_by_hand(docs, window=13):
    last, first = 2 ** 63, {}
    rows = [(last if i is None else i, WORD.findall(t or "")) for i, t in docs]
    for i, w in rows:
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, last), i)
    out = []
    for i, w in rows:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((None if i == last else i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bundles", [1, 7])
def test_spans_equal_brute_force(spark, monkeypatch, bundles):
    monkeypatch.setattr(substrings, "bundle_count", lambda *a: bundles)
    docs = documents(spark)
    got = substrings.remove_repeated_spans(docs).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    want = removed_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got), key=str) == want and sum(w[2] for w in want) > 0


def test_spans_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(substrings, "bundle_count", lambda *a: 3)
    docs = odd_documents(spark)
    got = substrings.remove_repeated_spans(docs)
    rows = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()]
    assert sorted(rows, key=str) == removed_by_hand([(r.doc_id, r.text) for r in docs.collect()])
    path = got.filter("doc_id = 6").first().spans
    assert [(p.start, p.words, p.source, p.place) for p in path] == [(1, 40, 5, 0)]
    assert substrings.remove_repeated_spans(docs.limit(0)).count() == 0
    digest = substrings.remove_repeated_spans(docs, with_text=False).filter("doc_id = 6").first()
    assert digest.kept_sha256 == hashlib.sha256(b"head tail").hexdigest()


def test_a_path_ends_where_the_source_branches(spark, monkeypatch):
    """Two sources one after the other give two paths; windows across them stay."""
    monkeypatch.setattr(substrings, "bundle_count", lambda *a: 2)
    one, two = (" ".join(f"{c}{i}" for i in range(20)) for c in "ab")
    docs = spark.createDataFrame([(1, one), (2, two), (3, f"{one} {two}")], "doc_id long, text string")
    row = substrings.remove_repeated_spans(docs).filter("doc_id = 3").first()
    assert [(p.start, p.words, p.source, p.place) for p in row.spans] == [(0, 20, 1, 0), (20, 20, 2, 0)] and row.n_removed == 40


def test_a_collision_is_found_and_done_again(spark, monkeypatch):
    class Weak(substrings.WordHashes):  # with the first seed all words of one first letter hash alike
        def digest(self, word):
            return substrings.WordHashes.digest(self, word[:1] if self.seed == 0 else word)

    monkeypatch.setattr(substrings, "bundle_count", lambda *a: 1)
    rows = [(k, " ".join(f"a{(k * 7919 + i * 31) % 9973}" for i in range(30))) for k in range(6)]
    rows.append((9, rows[2][1] + " tail"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    steps = substrings.Steps(13, 1, 0, Weak)
    walked = substrings._walked(docs, 1, steps, "doc_id", "text", True)
    assert walked.agg(F.sum("n_removed")).first()[0] > 30           # the weak hash takes too much,
    assert not substrings.false_paths(walked, docs, 1).isEmpty()    # and the sources tell
    got = substrings.remove_repeated_spans(docs, new_hashes=Weak).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == removed_by_hand(rows)


# ---------------------------------------------------------- operator 13
def drawn_by_hand(docs, target, buckets=10_000, percent=25, seed=7):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = {i: i + 32 for i in range(65, 91)}

    def features(t):
        w = word.findall((t or "").translate(low))
        return len(w), [zlib.crc32(x.encode()) % buckets for x in (*w, *(f"{a} {b}" for a, b in zip(w, w[1:])))]
    rows = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for *_, f in rows for b in f), Counter(b for x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for i, n, f in rows:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[:percent * len(fit) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=str)


def test_resampling_equals_brute_force(spark):
    docs, target = documents(spark), spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    got = importance.resample(docs, target).collect()
    assert sorted(map(tuple, got), key=str) == drawn_by_hand([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])


def test_resampling_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(importance, "STEP_WORDS", 500)  # documents are cut within a step
    monkeypatch.setattr(importance, "SLICE", 300)
    docs, target = odd_documents(spark), spark.createDataFrame([("p1 p2 p3 w5 w6",), (None,)], "text string")
    got = importance.resample(docs, target, percent=50).collect()
    want = drawn_by_hand([(r.doc_id, r.text) for r in docs.collect()], ["p1 p2 p3 w5 w6"], percent=50)
    # rows of one id and text tie: which of them has which rank is open
    strip = lambda rows: sorted((tuple(r)[:5] for r in rows), key=str)
    assert strip(got) == strip(want) and sorted(r[5] for r in got if r[5]) == sorted(r[5] for r in want if r[5])
    assert importance.resample(docs.limit(0), target).count() == 0
    assert importance.resample(docs, target.limit(0)).filter("rank IS NOT NULL").count() == 2
    none = importance.resample(docs.filter("doc_id < 4"), target)
    assert [tuple(r)[1:4] + (r["rank"],) for r in none.collect()] == [(0, 0, 0, None)] * 3


def test_crcs_by_columns_equal_zlib():
    rnd = random.Random(5)
    words = [bytes(rnd.randrange(33, 256) for _ in range(rnd.choice([1, 2, 5, 9, 700]))) for _ in range(400)]
    store = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths + 1) - lengths - 1
    runs = np.array([[rnd.randrange(400) for _ in range(3)] for _ in range(900)])
    got = importance.crc_of_runs(store, starts, lengths, runs)
    assert got.tolist() == [zlib.crc32(b" ".join(words[i] for i in r)) for r in runs.tolist()]


def test_longer_runs_and_other_bucket_counts(spark):
    docs = documents(spark).limit(40)
    rows = importance.bucketed(docs, buckets=70_000, max_run=3)
    counts = importance.bucket_counts(rows, 70_000)
    want = Counter()
    word, low = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), {i: i + 32 for i in range(65, 91)}
    for r in docs.collect():
        w = word.findall((r.text or "").translate(low))
        want.update(zlib.crc32(" ".join(w[k:k + n]).encode()) % 70_000 for n in (1, 2, 3) for k in range(len(w) - n + 1))
    assert {int(b): int(n) for b, n in enumerate(counts) if n} == dict(want)
