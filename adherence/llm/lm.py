"""Operator 9: language-model scoring with a hashed maximum-entropy model.

log P(token | history) = log P(class | history) + log P(token | class).

* The most frequent tokens are classes of their own; all others fall into
  classes by their last two bytes, which tell languages and word kinds apart.
* P(class | history) is a softmax over hashed indicator features: the word
  before, the two words before (bigram), and the word before that alone
  (skip). The weight table has a fixed size.
* P(token | class) = (c + 1) / (N_class + V_class + 1), c being the token's
  count in training; a class gives its last share to unseen tokens.

Training: token counts come from all training texts (partial counts per
task, then a shuffle). The softmax is trained in rounds; a round takes one
hash share of all training texts, every task makes adaptive gradient steps
from the shared weights over its rows, and the tasks' updates are averaged by
how often a feature occurred - one native aggregate whose result has the size
of the weight table, for any input.

Scoring needs c of every token of every text. Tokens with at least
``HOT_SHARE`` of all (so at most 1 / HOT_SHARE of them) are broadcast and
looked up in the pass that computes the softmax; the others leave it as
(row, token, occurrences) and meet the counts in a shuffle join without hot
keys. The sums return to the row by its number.

Defined results: a null text counts as empty and has one token, the end; a
null doc_id is not held out; repeated rows are scored alike and count as
often as they come; with no training text every count is zero; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.llm.common import checkpointed, fold, table

END = " "  # cannot be a word
SINGLES, SUFFIXES = 31, 32
CLASSES = SINGLES + SUFFIXES
SIZES = (1 << 13, 1 << 14, 1 << 13)  # feature buckets: before, bigram, skip
ROWS = sum(SIZES)
assert ROWS <= 1 << 16
HOT_SHARE = 1e-5
ROUNDS = 2
RATE = 0.15
STEP_TOKENS = 4096
TASK_TOKENS = 4_000_000
COUNTER_WORDS = 400_000
BATCH_BYTES = 1 << 20
_P = 0x100000001B3
_U = np.uint64
_END_HASH = _U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def words_in(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII space only


# ------------------------------------------------------------------ counts
def token_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, n) over all words and one end per row."""
    def run(batches):
        seen: Counter = Counter()

        def flush():
            tokens = pa.array(list(seen), pa.binary()).cast(pa.string())
            n = pa.array(np.fromiter(seen.values(), np.int64, len(seen)))
            seen.clear()
            return pa.RecordBatch.from_arrays([tokens, n], names=["token", "n"])

        for b in batches:
            for x in b.column(0):
                seen.update(words_in(x.as_py()))
                seen[END.encode()] += 1
                if len(seen) > COUNTER_WORDS:
                    yield flush()
        yield flush()

    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "token string, n long")
    return parts.groupBy("token").agg(F.sum("n").alias("n"))


# ------------------------------------------------------- words as numbers
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd multiplier and of its inverse modulo 2 to the 64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, BATCH_BYTES + 64)
        for name, base in (("up", _P), ("down", pow(_P, -1, 1 << 64))):
            a = np.full(size, _U(base))
            a[0] = 1
            _POWERS[name] = np.cumprod(a, dtype=_U)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> _U(27))) * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, hash, last two bytes) of the words of lower-case bytes."""
    b = np.frombuffer(data, np.uint8)
    word = np.concatenate(([False], ~_SPACE[b], [False]))
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _powers(len(b) + 1)
    total = np.concatenate(([_U(0)], np.cumsum((b.astype(_U) + _U(1)) * up[:-1], dtype=_U)))
    h = mixed((total[end] - total[start]) * down[start])
    before = np.where(end - start > 1, b[np.maximum(end - 2, 0)], 0) if len(start) else np.empty(0, np.uint8)
    return start, h, (b[end - 1].astype(np.int64) << 8 | before) if len(start) else np.empty(0, np.int64)


def suffix_class(tail: np.ndarray) -> np.ndarray:
    return (SINGLES + mixed(tail.astype(_U)) % _U(SUFFIXES)).astype(np.int64)


def token_classes(h: np.ndarray, tail: np.ndarray, singles: np.ndarray) -> np.ndarray:
    """Class per word; ``singles`` are the hashes of the words with a class
    of their own, in order (class 0 is the end)."""
    out = suffix_class(tail)
    if len(singles):
        order = np.argsort(singles)
        at = np.minimum(np.searchsorted(singles[order], h), len(singles) - 1)
        hit = singles[order][at] == h
        out[hit] = 1 + order[at[hit]]
    return out


def sequences(texts: list[bytes], singles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, class, tokens per text) of all tokens, an end after each text.
    Long texts are hashed in pieces cut at white space."""
    hs, cs, per = [], [], []
    group: list[bytes] = []

    def flush():
        if not group:
            return
        data = b" ".join(group)
        sizes = np.array([len(x) + 1 for x in group])
        start, h, tail = hash_words(data)
        who = np.searchsorted(np.cumsum(sizes), start, "right")
        n = np.bincount(who, minlength=len(group))
        at = np.arange(len(h)) + who
        allh, allc = np.full(len(h) + len(group), _END_HASH), np.zeros(len(h) + len(group), np.int64)
        allh[at], allc[at] = h, token_classes(h, tail, singles)
        hs.append(allh)
        cs.append(allc)
        per.append(n + 1)
        group.clear()

    room = 0
    for t in texts:
        if len(t) > BATCH_BYTES:
            flush()
            room, at, parts = 0, 0, []
            while at < len(t):
                to = at + BATCH_BYTES
                if to < len(t):  # cut before the last white space
                    cut = max(t.rfind(s, at, to) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
                    to = cut if cut > at else min([p for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")
                                                   if (p := t.find(s, to)) >= 0] or [len(t)])
                parts.append(hash_words(t[at:to])[1:])
                at = to
            h, tail = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            hs.append(np.append(h, _END_HASH))
            cs.append(np.append(token_classes(h, tail, singles), 0))
            per.append(np.array([len(h) + 1]))
            continue
        if room + len(t) > BATCH_BYTES:
            flush()
            room = 0
        group.append(t)
        room += len(t) + 1
    flush()
    if not hs:
        return np.empty(0, _U), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(hs), np.concatenate(cs), np.concatenate(per)


def features(h: np.ndarray, per: np.ndarray) -> np.ndarray:
    """(tokens, 3) rows of the weight table."""
    first = np.cumsum(per) - per
    one = np.roll(h, 1)
    two = np.roll(h, 2)
    one[first] = _END_HASH
    two[first] = _END_HASH
    two[first[per > 1] + 1] = _END_HASH
    a = one % _U(SIZES[0])
    b = mixed(one * _U(3) + two) % _U(SIZES[1]) + _U(SIZES[0])
    c = mixed(two ^ _U(0xABCD)) % _U(SIZES[2]) + _U(SIZES[0] + SIZES[1])
    return np.stack([a, b, c], axis=1).astype(np.int64)


def _shifted(weights: np.ndarray, bias: np.ndarray, f: np.ndarray) -> np.ndarray:
    z = weights.take(f[:, 0], axis=0)
    z += weights.take(f[:, 1], axis=0)
    z += weights.take(f[:, 2], axis=0)
    z += bias
    z -= z.max(axis=1, keepdims=True)
    return z


def log_softmax(weights: np.ndarray, bias: np.ndarray, f: np.ndarray) -> np.ndarray:
    z = _shifted(weights, bias, f)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


def softmax(weights: np.ndarray, bias: np.ndarray, f: np.ndarray) -> np.ndarray:
    z = _shifted(weights, bias, f)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


# ---------------------------------------------------------------- training
class Model:
    """Fixed-size parameters; ``singles`` are the tokens with their own class."""

    def __init__(self, singles: list[str], class_n: np.ndarray, class_v: np.ndarray):
        self.singles = hash_list(singles)
        self.class_total = (class_n + class_v + 1).astype(np.float64)
        share = class_n + 1.0
        self.bias = np.log(share / share.sum()).astype(np.float32)
        self.weights = np.zeros((ROWS, CLASSES), np.float32)


def hash_list(words: list[str]) -> np.ndarray:
    return np.concatenate([hash_words(w.encode())[1] for w in words]) if words else np.empty(0, _U)


def _texts(batches, column: int):
    """Lists of lower-case texts of bounded size."""
    part, room = [], 0
    for b in batches:
        for x in b.column(column):
            t = (x.as_py() or "").encode("utf-8", "replace").lower()
            if part and room + len(t) > BATCH_BYTES:
                yield part
                part, room = [], 0
            part.append(t)
            room += len(t)
    if part:
        yield part


def local_updates(lists, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Adaptive gradient steps over the texts; (change of the weights, how
    often each row of the table occurred)."""
    w = model.weights.copy()
    seen, power = np.zeros(ROWS, np.int64), np.full(ROWS, 1e-6, np.float32)
    met, place, classes = np.zeros(ROWS, bool), np.zeros(ROWS, np.int64), np.arange(CLASSES)
    for texts in lists:
        h, cls, per = sequences(texts, model.singles)
        f = features(h, per)
        seen += np.bincount(f.reshape(-1), minlength=ROWS)
        for at in range(0, len(h), STEP_TOKENS):
            rows, target = f[at:at + STEP_TOKENS], cls[at:at + STEP_TOKENS]
            g = softmax(w, model.bias, rows)
            g[np.arange(len(g)), target] -= 1.0
            g = g.astype(np.float64).reshape(-1)
            for k in range(rows.shape[1]):
                met[rows[:, k]] = True
                r = np.flatnonzero(met)
                met[r] = False
                place[r] = np.arange(0, len(r) * CLASSES, CLASSES)
                # Sums per (row, class): one weighted count over all cells.
                cell = (place[rows[:, k]][:, None] + classes).reshape(-1)
                grad = np.bincount(cell, g, len(r) * CLASSES).astype(np.float32).reshape(-1, CLASSES)
                power[r] += np.einsum("ij,ij->i", grad, grad) / CLASSES
                grad *= (-RATE / np.sqrt(power[r]))[:, None]
                w[r] += grad
    return w - model.weights, seen


def train_round(docs: DataFrame, model: Model, tokens: int) -> None:
    """One round over ``docs`` (text): local steps in every task, averaged. A
    task sends a change of the whole table, so there are as many as the
    ``tokens`` of all training texts ask for, however many files hold them."""
    docs = docs.coalesce(max(1, -(-tokens // TASK_TOKENS)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"w{k}" for k in range(CLASSES)]

    def run(batches):
        change, seen = local_updates(_texts(batches, 0), shared.value)
        rows = np.flatnonzero(seen)
        for at in range(0, len(rows), 4096):
            r = rows[at:at + 4096]
            part = change[r].T
            yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(seen[r]), *[pa.array(x) for x in part]],
                                             names=["row", "seen", *names])

    updates = docs.mapInArrow(run, "row long, seen long, " + ", ".join(f"{c} float" for c in names))
    total = F.sum("seen")
    mean = updates.groupBy("row").agg(*[(F.sum(F.col(c) * F.col("seen")) / total).cast("float").alias(c) for c in names])
    found = mean.toArrow()  # at most ROWS rows
    if found.num_rows:
        model.weights[found.column("row").to_numpy()] += np.stack([found.column(c).to_numpy() for c in names], axis=1)


def fit(train: DataFrame, counts: DataFrame) -> tuple[Model, dict[str, int], int, int]:
    """(model, hot token counts, N, V). ``train`` has text; ``counts`` is read
    several times."""
    n, v = counts.agg(F.sum("n"), F.count("*")).first()
    n = n or 0
    words = counts.filter(F.col("token") != END)
    # At most 1 / HOT_SHARE tokens can have that share of all.
    hot = {r["token"]: r["n"] for r in counts.filter(F.col("n") >= max(1, int(n * HOT_SHARE) + 1)).collect()}
    singles = [t for t, _ in sorted(hot.items(), key=lambda x: (-x[1], x[0])) if t != END][: SINGLES - 1]
    hot[END] = max([r["n"] for r in counts.filter(F.col("token") == END).collect()] or [0])
    own = hash_list(singles)

    def per_class(batches):
        sums, kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for b in batches:
            if b.num_rows:
                _, h, tail = hash_words("\n".join(b.column(0).to_pylist()).encode())
                c = token_classes(h, tail, own)
                sums += np.bincount(c, b.column(1).to_numpy(), CLASSES).astype(np.int64)
                kinds += np.bincount(c, minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(sums), pa.array(kinds)],
                                         names=["c", "n", "v"])

    rows = (words.mapInArrow(per_class, "c long, n long, v long").groupBy("c")
                 .agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect())  # one row per class
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in rows:
        class_n[r["c"]], class_v[r["c"]] = r["n"], r["v"]
    class_n[0], class_v[0] = hot[END], 1
    model = Model(singles, class_n, class_v)
    part = F.pmod(F.xxhash64("text"), F.lit(ROUNDS))
    for k in range(ROUNDS if n else 0):
        train_round(train.filter(part == k).select("text"), model, n)
    return model, hot, n, v


# ----------------------------------------------------------------- scoring
def _score_rows(docs: DataFrame, model: Model, hot: dict[str, int]) -> DataFrame:
    """Per text one row with ``base`` (doc_id, tokens, the softmax part of the
    score) and its sums over hot tokens, and one row per other token."""
    shared = docs.sparkSession.sparkContext.broadcast((model, {k.encode(): v for k, v in hot.items()}))

    def run(batches):
        from pyspark import TaskContext
        model, hot = shared.value
        logs = {k: float(np.log10(v + 1.0)) for k, v in hot.items()}
        single = [0.0] * CLASSES
        for k, v in logs.items():
            if k == END.encode():
                single[0] = v
            else:
                c = int(token_classes(*hash_words(k)[1:], model.singles)[0])
                if c < SINGLES:
                    single[c] = v
        # Added per token of a class, to the sum of log10 (c + 1).
        within = np.where(np.arange(CLASSES) < SINGLES, -np.array(single), -np.log10(model.class_total))
        number = TaskContext.get().partitionId() << 36
        for b in batches:
            ids = b.column(0)
            done = 0
            for texts in _texts([b], 1):
                h, cls, per = sequences(texts, model.singles)
                f = features(h, per)
                soft = np.empty(len(h))
                for at in range(0, len(h), STEP_TOKENS):
                    z = _shifted(model.weights, model.bias, f[at:at + STEP_TOKENS])
                    own = z[np.arange(len(z)), cls[at:at + STEP_TOKENS]]
                    soft[at:at + STEP_TOKENS] = own - np.log(np.exp(z, out=z).sum(axis=1))
                first = np.cumsum(per) - per
                other = np.add.reduceat(soft / np.log(10.0) + within[cls], first)
                tokens, times, of = [], [], []
                sums, known = np.empty(len(texts)), np.empty(len(texts), np.int64)
                for k, t in enumerate(texts):
                    n = Counter(t.split())
                    s, m = logs[END.encode()], int(hot[END.encode()] > 0)
                    rest = len(tokens)
                    for w, c in n.items():
                        x = logs.get(w)
                        if x is None:
                            tokens.append(w)
                            times.append(c)
                        else:
                            s += c * x
                            m += c
                    of.append(len(tokens) - rest)
                    sums[k], known[k] = s, m
                rows = np.arange(number, number + len(texts))
                number += len(texts)
                n, m = len(texts), len(tokens)
                # A base row's token holds a space, so it joins with no count.
                names = [b" %d" % x for x in rows] + tokens
                last = pa.nulls(m, pa.struct([("doc_id", pa.int64()), ("tokens", pa.int64()), ("other", pa.float64()),
                                              ("known", pa.int64()), ("logs", pa.float64())]))
                base = pa.StructArray.from_arrays(
                    [ids.slice(done, n), pa.array(per), pa.array(other), pa.array(known), pa.array(sums)],
                    names=["doc_id", "tokens", "other", "known", "logs"])
                done += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((rows, np.repeat(rows, of)))),
                     pa.array(names, pa.binary()).cast(pa.string()),
                     pa.array(np.concatenate((np.zeros(n, np.int64), np.array(times, np.int64)))),
                     pa.concat_arrays([base, last])], names=["row", "token", "times", "base"])

    kind = "struct<doc_id:long,tokens:long,other:double,known:long,logs:double>"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"row long, token string, times long, base {kind}")


def score(docs: DataFrame, mod: int = 7, held: int = 2) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text); see the query's contract."""
    train = docs.filter(F.coalesce(fold(F.col("doc_id"), mod) != held, F.lit(True)))
    counts = checkpointed(token_counts(train))
    model, hot, n, v = fit(train, counts)
    rows = _score_rows(docs, model, hot)
    known = F.col("n").isNotNull()
    logs = F.when(known, F.col("times") * F.log10(F.col("n") + 1)).otherwise(F.col("base.logs"))
    out = (rows.join(counts, "token", "left")
               .select("row", F.when(known, F.col("times")).otherwise(F.col("base.known")).alias("known"),
                       logs.alias("logs"), F.col("base.doc_id").alias("doc_id"), F.col("base.tokens").alias("tokens"),
                       F.col("base.other").alias("other"))
               .groupBy("row").agg(F.sum("known").alias("n_known"), F.sum("logs").alias("logs"),
                                   F.max("doc_id").alias("doc_id"), F.max("tokens").alias("n_tokens"),
                                   F.max("other").alias("other")))
    scale = float(np.log10(n + (v + 1))) if n + v + 1 > 0 else 0.0
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), mod) == held, F.lit(False)).alias("held_out"),
                      "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                      (F.col("logs") - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
                      (F.col("logs") + F.col("other")).alias("score"))


def op9_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
