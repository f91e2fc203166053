"""Exact dedup, line dedup and SimHash near-dedup against brute force."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from adherence.llm import exact_dedup, line_dedup, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def docs_df(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], SCHEMA)


# ------------------------------------------------------------- exact dedup
PAIRS = [(1, "a b"), (2, "ab"), (3, " a\tb\n"), (4, None), (5, ""), (6, " "), (7, "b a"), (None, "ab "), (9, "x" * 300_000),
         (8, "x" * 150_000 + " " + "x" * 150_000), (10, "ba"), (10, "ba"), (11, "é e"), (12, "ée")]


def exact_brute(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[SPACE.sub("", t or "")].append((i, len(t or "")))
    out = []
    for norm, rows in groups.items():
        key = lambda r: (-r[1], r[0] if r[0] is not None else 1 << 63)
        best = min(rows, key=key)
        for r in rows:
            out.append((r[0], best[0], len(rows), key(r) == key(best), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, weak):
    d = docs_df(spark, PAIRS).repartition(3)
    digest = (lambda norm: F.char_length(norm).cast("string")) if weak else exact_dedup.sha256
    got = [tuple(r) for r in exact_dedup.exact_groups(d, salts=3, digest=digest).collect()]
    want = exact_brute(PAIRS)
    if weak:  # one digest for several contents: the groups stay apart
        got, want = [g[:4] for g in got], [w[:4] for w in want]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_exact_groups_empty_and_clashing(spark):
    d = docs_df(spark, PAIRS[:3]).withColumns({"digest": F.lit(1), "norm": F.lit(2), "salt": F.lit(3), "rank": F.lit(4)})
    assert exact_dedup.exact_groups(d).count() == 3
    assert exact_dedup.exact_groups(docs_df(spark, PAIRS).limit(0)).count() == 0


# -------------------------------------------------------------- line dedup
def lines_brute(pairs):
    """Chunks by the documented rule; later places of repeated ones go."""
    def number(x):
        return int(hashlib.md5(x.encode()).hexdigest()[:8], 16)

    def chunks(t):
        ls = t.split("\n")
        out = []
        for i, x in enumerate(ls):
            n = len(SPACE.split(x.strip(" \t\n\x0b\f\r"))) if x.strip(" \t\n\x0b\f\r") else 0
            prev = len(ls[i - 1].split()) if i else 0
            if i == 0 or n > 50 or prev > 50 or (number(ls[i - 1]) * 31 + (number(ls[i - 2]) if i > 1 else 0)) % 3 == 0:
                out.append([])
            out[-1].append(x)
        return out

    places = defaultdict(set)
    for i, t in pairs:
        t = t or ""
        for pos, c in enumerate(chunks(t)):
            body = "\n".join(c)
            n = len(body.split())
            if n >= 10 and (len(c) > 1 or n > 50):
                places[body].add((i if i is not None else 1 << 62, pos, hashlib.md5(t.encode()).hexdigest()))
    out = []
    for i, t in pairs:
        kept, gone = [], 0
        for pos, c in enumerate(chunks(t or "")):
            body = "\n".join(c)
            place = (i if i is not None else 1 << 62, pos, hashlib.md5((t or "").encode()).hexdigest())
            if body in places and place != min(places[body]):
                gone += 1
            else:
                kept.append(body)
        out.append((i, "\n".join(kept) if gone else t, gone))
    return sorted(out, key=str)


def line_pairs():
    rnd = random.Random(4)
    words = ["w%d" % k for k in range(300)]
    line = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage, block = line(70), [line(8) for _ in range(12)]
    pairs = []
    for i in range(30):
        own = [line(rnd.randint(3, 20)) for _ in range(rnd.randint(1, 8))]
        if i % 3 == 0:
            own.insert(rnd.randint(0, len(own)), passage)
        if i % 4 == 0:
            k = rnd.randint(0, len(own))
            own[k:k] = block
        pairs.append((i, "\n".join(own)))
    pairs += [(40, None), (41, ""), (42, "\n\n\n"), (43, pairs[0][1]), (44, pairs[0][1]), (44, pairs[0][1]), (None, pairs[5][1]),
              (45, "long " * 60_000), (46, passage)]
    return pairs


@pytest.mark.parametrize("weak", [False, True])
def test_line_dedup(spark, weak):
    pairs = line_pairs()
    d = docs_df(spark, pairs).repartition(4)
    how = {"chunk_hash": lambda c: F.char_length(c).cast("long")} if weak else {}
    got = line_dedup.remove_repeated(d, removed_col="gone", **how)
    assert sorted([(r["doc_id"], r["text"], r["gone"]) for r in got.collect()], key=str) == lines_brute(pairs)
    assert got.filter("text is not null and n_chars <> char_length(text)").count() == 0
    by_id = {r["doc_id"]: r["text"] for r in got.collect()}
    passage = [t for i, t in pairs if i == 46][0]
    assert sum(passage in (t or "") for t in by_id.values()) == 1  # the long passage stays once


def test_chunks_restore_the_text(spark):
    d = docs_df(spark, line_pairs())
    chunks = line_dedup.chunks_of(F.coalesce("text", F.lit("")))
    joined = F.array_join(F.transform(chunks, lambda c: c["body"]), "\n")
    assert d.filter(joined != F.coalesce("text", F.lit(""))).count() == 0


def test_line_dedup_empty_and_clashing(spark):
    d = docs_df(spark, line_pairs()[:10]).withColumns({"key_id": F.lit(1), "drop_pos": F.lit("x"), "hash": F.lit(2)})
    out = line_dedup.remove_repeated(d)
    assert out.columns == d.columns and out.count() == 10
    assert line_dedup.remove_repeated(d.limit(0)).count() == 0


# ----------------------------------------------------------------- simhash
def fingerprint_brute(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = [x for x in SPACE.split(low) if x]
    if not w:
        return 0
    sh = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c", "A b C d", "É a b c d e", "x y " * 700, "Ä ö\tü ß " * 3])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == fingerprint_brute(text)


def classes(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        up[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]


def family(seed, n, heads):
    """Fingerprints in clusters: chains of small changes around some heads."""
    rnd = random.Random(seed)
    base = [rnd.getrandbits(64) for _ in range(heads)]
    out = set(base)
    while len(out) < n:
        x = rnd.choice(base) if rnd.random() < 0.3 else rnd.choice(sorted(out)[:50])
        for _ in range(rnd.randint(1, 6)):
            x ^= 1 << rnd.randrange(64)
        out.add(x)
    return np.array(sorted(out), np.uint64)


def test_linked_pairs():
    fps = family(1, 400, 20)
    ends = np.full(len(fps), len(fps))
    got = {(int(a), int(b)) for x, y in simhash.linked_pairs(fps, ends, chunk=777) for a, b in zip(x, y)}
    assert got == {(a, b) for a, b in itertools.combinations(range(len(fps)), 2) if bin(int(fps[a] ^ fps[b])).count("1") <= 4}


@pytest.mark.parametrize("cap", [10_000, 30, 6])
def test_components(spark, cap):
    fps = family(2, 300, 12)
    pairs = [(a, b) for a, b in itertools.combinations(range(len(fps)), 2) if bin(int(fps[a] ^ fps[b])).count("1") <= 4]
    nodes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long").repartition(3)
    got = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes, cap=cap, task_rows=100)).collect()}
    want = classes(len(fps), pairs)
    roots = [got.get(int(x), int(x)) for x in fps.view(np.int64)]
    assert [roots.index(r) for r in roots] == [want.index(w) for w in want]


def test_near_dedup(spark):
    rnd = random.Random(5)
    words = ["v%d" % k for k in range(500)]
    base = [" ".join(rnd.choice(words) for _ in range(400)) for _ in range(4)]
    pairs = [(i, base[i % 4] + (" tail" if i % 3 else "")) for i in range(40)]
    pairs += [(100, None), (101, "  "), (None, base[0]), (102, "solo text of its own"), (102, "solo text of its own"),
              (None, "without id, alone here"), (103, " ".join(rnd.choice(words) for _ in range(50_000)))]
    d = docs_df(spark, pairs).withColumns({"fp": F.lit(1), "row": F.lit(2), "salt": F.lit(3)}).repartition(3)
    got = simhash.near_dedup(d).collect()
    fps = [fingerprint_brute(t) for _, t in pairs]
    want = classes(len(pairs), [(a, b) for a, b in itertools.combinations(range(len(pairs)), 2)
                                if bin(fps[a] ^ fps[b]).count("1") <= 4])
    least = {c: min([i for (i, _), w in zip(pairs, want) if w == c and i is not None], default=None) for c in set(want)}
    assert sorted([(r["doc_id"], r["fp"] & (2 ** 64 - 1), r["component_id"]) for r in got], key=str) == sorted(
        [(i, f, least[w]) for (i, _), f, w in zip(pairs, fps, want)], key=str)
    kept = simhash.one_of_each(d)
    assert kept.columns == d.columns
    assert sorted([r["doc_id"] for r in kept.collect()], key=str) == sorted(least.values(), key=str)
    assert simhash.near_dedup(d.limit(0)).count() == 0 and simhash.one_of_each(d.limit(0)).count() == 0
