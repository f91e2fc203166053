"""Quality rules and source mixing against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from adherence.llm import mixing, quality_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def metrics_brute(t):
    w = [x for x in SPACE.split(t or "") if x]
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(inside),
            n < 20 or 100 * len(inside) > 30 * n)


def rule_rows():
    rnd = random.Random(3)
    words = ["the", "a", "of", "é", "straße"] + ["word%d" % k for k in range(60)]
    rows = []
    for i in range(260):
        t = " ".join(rnd.choice(words) for _ in range(rnd.choice([5, 19, 20, 21, 60, 150])))
        if i % 9 == 0:
            t = "\n".join([t, "again and again", "again and again"])
        if i % 13 == 0:
            t = (t + "\t") * 3
        if i % 17 == 0:
            t = " ".join(x + "$%" for x in t.split())
        rows.append((i, t, rnd.choice(["en", "de"]), rnd.choice(["s1", "s2"]), len(t)))
    rows += [(900, None, None, None, None), (901, "", "en", "s1", 0), (902, " \n\x0b ", "en", None, 3), (None, rows[3][1], "en", "s1", 1),
             (903, "x " * 40_000, "en", "s1", 80_000), (903, "x " * 40_000, "en", "s1", 80_000), (904, "a b c d e f g h", "en", "s1", 15)]
    return rows


def test_metrics_and_verdicts(spark):
    rows = rule_rows()
    d = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = quality_rules.quality_rules(d).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted([(r["doc_id"], *[r[c] for c in names]) for r in got], key=str) == sorted(
        [(r[0], *metrics_brute(r[1])) for r in rows], key=str)
    # The thresholds: quartiles of the sketch cells of a group of enough rows.
    assert len(rows) - 20 > quality_rules.MIN_GROUP
    ok = [r for r in got if not r["base_failed"]]

    def cell(v):
        s = max(v.bit_length() - 5, 0)
        return v >> s << s

    for r in got:
        group = [x for x in ok if (x["lang"], x["source"]) == (r["lang"], r["source"])]
        if len(group) < quality_rules.MIN_GROUP:
            group = [x for x in ok if x["lang"] == r["lang"]]
        if len(group) < quality_rules.MIN_GROUP:
            group = ok
        fine = not r["base_failed"]
        for m, (lo, hi) in quality_rules.METRICS.items():
            v = sorted(cell(x[m]) for x in group)
            q1, q3 = v[-(-len(v) // 4) - 1], v[-(-3 * len(v) // 4) - 1]
            fine = fine and r[m] <= q3 + 3 * (q3 - q1) + hi and (lo is None or r[m] >= q1 - 3 * (q3 - q1) - lo)
        assert r["kept"] == fine


def test_filter_documents_with_clashing_columns(spark):
    rows = rule_rows()
    d = spark.createDataFrame(rows, SCHEMA).withColumns({"n_words": F.lit(-1), "kept": F.lit("k"), "q10_kept": F.lit(0),
                                                         "symbols": F.lit(5), "words_": F.lit(1)})
    out = quality_rules.filter_documents(d)
    assert out.columns == d.columns
    kept = quality_rules.quality_rules(d).filter("kept")
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(r["doc_id"]) for r in kept.collect())
    assert out.filter("n_words <> -1 or kept <> 'k'").count() == 0
    assert quality_rules.quality_rules(d.limit(0)).count() == 0 and quality_rules.filter_documents(d.limit(0)).count() == 0


# ------------------------------------------------------------------ mixing
def mix_rows():
    rnd = random.Random(8)
    rows, i = [], 0
    for source, n in (("big", 700), ("mid", 120), ("small", 25), (None, 10)):
        for _ in range(n):
            rows.append((i, "t " * rnd.randint(1, 60), "en", source, 1))
            i += 1
    rows += [(i, None, "en", "mid", 0), (i + 1, "", "en", "nothing", 0), (None, "null id", "en", "mid", 1),
             (3, rows[3][1], "en", "big", 1), (i + 2, "w " * 40_000, "en", "big", 1)]
    return rows


@pytest.mark.parametrize("evenness,repeats", [(0.5, 4.0), (0.9, 3.0), (0.0, 50.0), (1.0, 1000.0)])
def test_mix_meets_entropy_or_repeats(spark, evenness, repeats):
    rows = mix_rows()
    d = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = mixing.mix(d, evenness=evenness, max_repeats=repeats).collect()
    total = Counter()
    longest = Counter()
    for _, t, _, s, _ in rows:
        total[s] += len((t or "").split())
        longest[s] = max(longest[s], len((t or "").split()))
    total = {s: n for s, n in total.items() if n}
    everything = sum(total.values())
    p = {s: n / everything for s, n in total.items()}

    def weights(t):
        z = sum(x ** t for x in p.values())
        return {s: x ** t / z for s, x in p.items()}

    def entropy(w):
        return -sum(x * math.log(x) for x in w.values())
    target = entropy(p) + evenness * (math.log(len(p)) - entropy(p))
    lo, hi = 0.0, 1.0  # plain bisection
    for _ in range(60):
        mid = (lo + hi) / 2
        w = weights(mid)
        good = entropy(w) <= target and max(w[s] / p[s] for s in p) <= repeats
        lo, hi = (lo, mid) if good else (mid, hi)
    drawn = Counter()
    for r in got:
        drawn[r["source"]] += r["tokens"]
    for s, w in weights(hi).items():
        assert w * everything - longest[s] - 2 <= drawn[s] <= w * everything + 2 + 1e-4 * everything
    assert set(drawn) <= set(p)


def test_mix_draws_blocks_in_order(spark):
    """Whole passes take every row as often; the partial pass takes a prefix
    of its permutation, to within one row of the quota."""
    rows = mix_rows()
    d = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = mixing.mix(d).collect()
    per = defaultdict(list)
    for r in got:
        per[r["source"]].append(r)
    want = Counter((r[0], r[3], len((r[1] or "").split())) for r in rows)
    for s, draws in per.items():
        last = max(r["epoch"] for r in draws)
        for e in range(last):
            assert Counter((r["doc_id"], s, r["tokens"]) for r in draws if r["epoch"] == e) == Counter(
                {k: v for k, v in want.items() if k[1] == s})
        final = Counter((r["doc_id"], s, r["tokens"]) for r in draws if r["epoch"] == last)
        assert all(v <= want[k] for k, v in final.items())
        assert all(0 <= r["position"] for r in draws)
    again = mixing.mix(d.repartition(2))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, got), key=str)


def test_mix_documents(spark):
    d = spark.createDataFrame(mix_rows(), SCHEMA).withColumns({"epoch": F.lit(7), "doc": F.lit(1), "row_hash": F.lit("h")})
    out = mixing.mix_documents(d)
    assert out.columns == d.columns and out.filter("epoch <> 7").count() == 0
    assert sorted(r["doc_id"] or -1 for r in out.collect()) == sorted(r["doc_id"] or -1 for r in mixing.mix(d).collect())
    assert mixing.mix(d.limit(0)).count() == 0 and mixing.mix_documents(d.limit(0)).count() == 0
    assert mixing.mix(d.withColumn("text", F.lit(None).cast("string"))).count() == 0
