"""Operator 10: quality rules with adaptive thresholds (native).

Each text gets integer metrics, computed inside the row by built-in functions.
Fixed base rules reject very short and very repetitive texts. All other
limits adapt: per language and source, a mergeable quantile sketch of every
metric gives quartiles, and a text fails when a metric lies beyond the far
fence of its own group. The thresholds are joined back and filter the rows.

The sketch is a log-linear histogram of non-negative integers: a value keeps
its leading ``SKETCH_BITS`` binary digits (relative error at most 1/16), a
cell is (group, metric, cell start) with a count, and sketches merge by adding
counts. So map-side aggregation merges them before the shuffle, a hot source
arrives as a few hundred cells per task, and the result does not depend on
the order of merging. A group has at most about 16 x 40 cells per metric.
Groups with fewer than ``MIN_GROUP`` texts use the sketch of their language,
then that of the whole table: the same cells, merged further.

Defined results: a null text has no words and fails the base rules; a null
language or source is a group of its own; repeated rows are judged alike;
an empty table gives no rows; columns of the input with clashing names are
ignored by the query and kept by ``filter_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adherence.llm.common import checkpointed, fresh, let, table, words_of
from adherence.session import work_path

SKETCH_BITS = 5
MIN_GROUP = 200
#: Sketches for this many (language, source) groups are broadcast; each
#: threshold row has under 200 bytes, so the bound is about 20 MB.
BROADCAST_GROUPS = 100_000
WINDOW = 8
#: metric: (slack below the lower fence or None, slack above the upper fence).
#: The far fence is three inter-quartile ranges from the quartile; the slack
#: keeps a group without spread from rejecting ordinary texts.
METRICS = {
    "symbols": (None, 100),        # symbol characters per 1000 words
    "word_length": (200, 300),     # hundredths of a code point per word
    "dup_lines": (None, 400),      # repeated lines per 1000 lines
    "repeats": (None, 250),        # words in repeated windows per 1000 words
    "capitals": (None, 250),       # A-Z per 1000 word characters
}


def repeated_words(words: Column) -> Column:
    """Words inside ``WINDOW``-word windows that occur twice or more in the
    text (first occurrence included). Windows are compared by XXH64, built by
    joining hashes of 2, 4 and 8 words. A text without a repeated 4-word
    window has no longer one and is done; only texts with a repeated window
    are sorted, and the covered words are counted from the gaps between repeated window
    positions, so the cost is n log n for any repetition pattern."""
    n = F.size(words)

    def joined(a, k):  # hash of element i and element i + k
        return F.zip_with(a, F.slice(a, F.lit(1 + k), F.greatest(F.size(a) - k, F.lit(0))),
                          lambda x, y: F.xxhash64(x, y))

    def first(a, k):
        return F.slice(a, F.lit(1), n - (k - 1))

    pairs = first(joined(words, 1), 2)
    fours = first(let(pairs, lambda a: joined(a, 2)), 4)  # XXH64 of 4-word windows

    def covered(h):
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def positions(p):
            twice = F.filter(p, lambda x, k: ((k > 0) & (F.get(p, k - 1)["h"] == x["h"]))
                             | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False)))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def total(q):
            return F.aggregate(F.transform(q, lambda v, k: F.least(F.lit(WINDOW),
                                                                   F.coalesce(F.get(q, k + 1) - v, F.lit(WINDOW)))),
                               F.lit(0).cast("long"), lambda acc, v: acc + v)
        return let(let(ranked, positions), total)

    zero = F.lit(0).cast("long")
    return F.when(n < WINDOW, zero).otherwise(
        let(fours, lambda f: F.when(F.size(F.array_distinct(f)) == F.size(f), zero)
            .otherwise(let(first(joined(f, 4), 8), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), zero)
                           .otherwise(covered(h))))))


def with_metrics(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with the base counts and the scaled integer metrics of each
    text, all named ``prefix`` + name."""
    p = prefix
    text = F.coalesce(F.col(text_col), F.lit(""))
    words, lines, caps = fresh([*docs.columns, *(p + c for c in METRICS)], "words_", "lines_", "caps_")
    d = docs.withColumns({
        words: words_of(F.col(text_col)),
        lines: F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        p + "n_symbols": (F.char_length(text) - F.char_length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long"),
        caps: (F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))).cast("long"),
    })
    d = d.withColumns({
        p + "n_words": F.size(words).cast("long"),
        p + "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
        p + "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(F.col(lines)))).cast("long"),
        p + "n_lines": F.size(lines).cast("long"),
        p + "n_repeat_words": repeated_words(F.col(words)),
    }).drop(words, lines)

    def per(x, y, scale):
        return F.when(F.col(y) > 0, F.expr(f"{scale} * `{x}` div `{y}`")).otherwise(F.lit(0).cast("long"))

    return d.withColumns({
        p + "symbols": per(p + "n_symbols", p + "n_words", 1000),
        p + "word_length": per(p + "word_chars", p + "n_words", 100),
        p + "dup_lines": per(p + "n_dup_lines", p + "n_lines", 1000),
        p + "repeats": per(p + "n_repeat_words", p + "n_words", 1000),
        p + "capitals": per(caps, p + "word_chars", 1000),
        p + "base_failed": (F.col(p + "n_words") < 20)
        | (100 * F.col(p + "n_repeat_words") > 30 * F.col(p + "n_words")),
    }).drop(caps)


def _cell(name: str) -> Column:
    """Start of the sketch cell of a column of non-negative integers."""
    return F.expr(f"CASE WHEN `{name}` < {2 ** SKETCH_BITS} THEN `{name}` ELSE shiftleft(shiftright(`{name}`, "
                  f"length(bin(`{name}`)) - {SKETCH_BITS}), length(bin(`{name}`)) - {SKETCH_BITS}) END")


def sketches(metrics: DataFrame, lang: str = "lang", source: str = "source", prefix: str = "") -> DataFrame:
    """Cells (level, lang, source, metric, cell, n) of the texts that pass
    the base rules; levels 0 group, 1 language, 2 all."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"),
                                         _cell(prefix + m).alias("cell")) for m in METRICS]))
    cells = (metrics.filter(~F.col(prefix + "base_failed"))
                    .select(F.col(lang).alias("lang"), F.col(source).alias("source"), pairs.alias("c"))
                    .groupBy("lang", "source", "c.metric", "c.cell").agg(F.count("*").alias("n")))
    cells = checkpointed(cells)  # small: cells, not rows; read three times
    by_lang = cells.groupBy("lang", "metric", "cell").agg(F.sum("n").alias("n"))
    by_all = cells.groupBy("metric", "cell").agg(F.sum("n").alias("n"))
    none = F.lit(None).cast("string")
    cols = ["level", "lang", "source", "metric", "cell", "n"]
    return (cells.withColumn("level", F.lit(0)).select(*cols)
            .unionByName(by_lang.withColumns({"level": F.lit(1), "source": none}).select(*cols))
            .unionByName(by_all.withColumns({"level": F.lit(2), "lang": none, "source": none}).select(*cols)))


def thresholds(cells: DataFrame) -> DataFrame:
    """One row per (lang, source) group with ``lo_<metric>`` / ``hi_<metric>``
    from the group's sketch, or its language's, or the whole table's."""
    key = ["level", "lang", "source", "metric"]
    w = Window.partitionBy(*key)
    run = cells.withColumns({"upto": F.sum("n").over(w.orderBy("cell")), "all": F.sum("n").over(w)})
    q = run.groupBy(*key).agg(
        F.max("all").alias("n"),
        F.min(F.when(4 * F.col("upto") >= F.col("all"), F.col("cell"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("all"), F.col("cell"))).alias("q3"))
    aggs = [F.max("n").alias("n")]
    for m, (lo, hi) in METRICS.items():
        own = F.col("metric") == m
        iqr = 3 * (F.col("q3") - F.col("q1"))
        aggs.append(F.max(F.when(own, F.col("q3") + iqr + F.lit(hi))).alias(f"hi_{m}"))
        if lo is not None:
            aggs.append(F.max(F.when(own, F.col("q1") - iqr - F.lit(lo))).alias(f"lo_{m}"))
    flat = q.groupBy("level", "lang", "source").agg(*aggs)
    limits = [c for c in flat.columns if c[:3] in ("hi_", "lo_")]
    group = flat.filter("level = 0").drop("level")
    lang = flat.filter("level = 1").select(F.col("lang").alias("lang1"), F.col("n").alias("n1"),
                                           *[F.col(c).alias(c + "1") for c in limits])
    every = flat.filter("level = 2").select(*[F.col(c).alias(c + "2") for c in limits])
    both = (group.join(lang, F.col("lang").eqNullSafe(F.col("lang1")), "left")
                 .join(F.broadcast(every.limit(1)), F.lit(True), "left"))  # one row
    return both.select("lang", "source", *[
        F.when(F.col("n") >= MIN_GROUP, F.col(c)).when(F.col("n1") >= MIN_GROUP, F.col(c + "1"))
         .otherwise(F.col(c + "2")).alias(c) for c in limits])


def judge(metrics: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source", prefix: str = "",
          kept: str = "kept") -> DataFrame:
    """Join the thresholds of each row's group; ``kept`` is false for base
    failures and for rows beyond a threshold."""
    limits = checkpointed(limits)
    names = [c for c in limits.columns if c not in ("lang", "source")]
    inner = dict(zip(["lang", "source", *names], fresh(metrics.columns, "t_lang", "t_source", *["t_" + c for c in names])))
    t = limits.select(*[F.col(a).alias(b) for a, b in inner.items()])
    if limits.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        t = F.broadcast(t)
    joined = metrics.join(t, F.col(lang).eqNullSafe(F.col(inner["lang"]))
                          & F.col(source).eqNullSafe(F.col(inner["source"])), "left")
    ok = ~F.col(prefix + "base_failed")
    for m, (lo, _) in METRICS.items():
        ok = ok & (F.col(prefix + m) <= F.col(inner[f"hi_{m}"]))
        if lo is not None:
            ok = ok & (F.col(prefix + m) >= F.col(inner[f"lo_{m}"]))
    return joined.withColumn(kept, F.coalesce(ok, F.lit(False))).drop(*inner.values())


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, base counts, metrics, ``base_failed``, ``kept``
    of every row. The metrics are written once to the checkpoint folder (no
    texts) and read for the sketches and for the verdicts."""
    m = checkpointed(with_metrics(docs.select("doc_id", "text", "lang", "source")).drop("text"))
    return judge(m, thresholds(sketches(m)))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were (of types
    that Parquet has)."""
    before = docs.columns
    p = fresh([c + x for c in before for x in ("", "_")], "q10_")[0]
    while any(c.lower().startswith(p) for c in before):
        p = "_" + p
    # The texts are measured once: rows and metrics are written to the shared
    # folder, the sketches read the metrics alone, the verdict reads both.
    path = work_path(docs.sparkSession, "quality_rules", unique=True)
    with_metrics(docs, prefix=p).write.option("compression", "zstd").parquet(path)
    m = docs.sparkSession.read.parquet(path)
    limits = thresholds(sketches(m, prefix=p))
    return judge(m, limits, prefix=p, kept=p + "kept").filter(F.col(p + "kept")).select(*[F.col(f"`{c}`") for c in before])


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    d = quality_rules(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    "kept")


def _sql() -> str:
    def cell(m):
        return (f"CASE WHEN {m} < 32 THEN {m} ELSE ({m} >> (length(bin({m})) - 5)::BIGINT) "
                f"<< (length(bin({m})) - 5)::BIGINT END")
    cells = "\n  UNION ALL ".join(f"SELECT lang, source, '{m}' AS metric, {cell(m)} AS cell FROM m WHERE NOT base_failed"
                                  for m in METRICS)
    lims, tests = [], []
    for m, (lo, hi) in METRICS.items():
        lims.append(f"max(CASE WHEN metric = '{m}' THEN q3 + 3 * (q3 - q1) + {hi} END) AS hi_{m}")
        tests.append(f"{m} <= hi_{m}")
        if lo is not None:
            lims.append(f"max(CASE WHEN metric = '{m}' THEN q1 - 3 * (q3 - q1) - {lo} END) AS lo_{m}")
            tests.append(f"{m} >= lo_{m}")
    names = [x.rsplit(" AS ", 1)[1] for x in lims]
    pick = ", ".join(f"CASE WHEN g.n >= {MIN_GROUP} THEN g.{c} WHEN l.n >= {MIN_GROUP} THEN l.{c} ELSE a.{c} END AS {c}"
                     for c in names)
    return rf"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (
  SELECT rid, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS g
  FROM (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w)),
dup AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (
  SELECT rid, sum(least({WINDOW}, nxt - i)) AS n FROM (
    SELECT rid, i, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i), i + {WINDOW}) AS nxt FROM dup) GROUP BY rid),
b AS (
  SELECT doc_id, lang, source, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(text) - length(regexp_replace(text, '[A-Z]+', '', 'g')))::BIGINT AS caps,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)),
m AS (
  SELECT *, CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbols,
         CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_length,
         CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines,
         CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeats,
         CASE WHEN word_chars > 0 THEN 1000 * caps // word_chars ELSE 0 END AS capitals,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b),
c AS (
  {cells}),
lev AS (
  SELECT 0 AS level, lang, source, metric, cell FROM c
  UNION ALL SELECT 1, lang, NULL, metric, cell FROM c UNION ALL SELECT 2, NULL, NULL, metric, cell FROM c),
h AS (SELECT level, lang, source, metric, cell, count(*) AS n FROM lev GROUP BY ALL),
r AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, metric ORDER BY cell) AS upto,
         sum(n) OVER (PARTITION BY level, lang, source, metric) AS total FROM h),
q AS (
  SELECT level, lang, source, metric, max(total) AS n, min(CASE WHEN 4 * upto >= total THEN cell END) AS q1,
         min(CASE WHEN 4 * upto >= 3 * total THEN cell END) AS q3 FROM r GROUP BY level, lang, source, metric),
f AS (SELECT level, lang, source, max(n) AS n, {", ".join(lims)} FROM q GROUP BY level, lang, source),
t AS (
  SELECT g.lang, g.source, {pick} FROM f g
  LEFT JOIN f l ON l.level = 1 AND l.lang IS NOT DISTINCT FROM g.lang LEFT JOIN f a ON a.level = 2
  WHERE g.level = 0)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND {" AND ".join(tests)}, false) AS kept
FROM m LEFT JOIN t ON t.lang IS NOT DISTINCT FROM m.lang AND t.source IS NOT DISTINCT FROM m.source
"""


SQL = _sql()
