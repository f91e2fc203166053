"""Operator 3: line dedup by content-defined chunks (native).

A text is cut into lines at ``\\n``. A rolling hash over the hashes of each
line and the line before it decides where a chunk ends, so an insertion or
deletion moves only the boundaries near it. A line of more than
``PASSAGE_WORDS`` words always ends the chunk before it and its own, so a long
passage is a chunk of its own wherever it is inserted. Chunks of several lines
and at least ``MIN_WORDS`` words, and such single passages, that occur more than once in the whole table are
removed everywhere but at their first place (smallest doc_id, then position),
after a comparison of their bytes.

Plan: chunk contents are grouped by (hash, content) - the byte comparison -
with map-side combining, so a chunk that a third of all texts share reaches a
task as one row per map task. What returns is one small row per repeated
chunk; places (row, position, hash, no content) are joined with it, reduced
to a list of positions per row (bounded by that row's own text) and joined to
the texts. A hash with several contents (a collision) is matched by content.

Defined results: a null text stays null; a text whose chunks all go becomes
the empty text; a null doc_id comes last; rows with equal id and text count
as one place and get the same result; an empty table gives no rows; further
columns pass through unchanged (``n_chars``, where present, is set anew).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adherence.llm.common import checkpointed, fresh, let, salted_join, table
from adherence.session import work_path

#: A chunk ends, on average, after this many lines.
EVERY = 3
PASSAGE_WORDS = 50
MIN_WORDS = 10
_MAX = 2 ** 63 - 1


def _number(text: Column) -> Column:
    """The first 32 bits of the MD5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _facts(lines: Column) -> Column:
    """Hash and number of words of every line."""
    return F.transform(lines, lambda x: F.struct(_number(x).alias("h"), _n_words(x).alias("w")))


def _starts(facts: Column) -> Column:
    """Indexes (from 0) of the lines that begin a chunk."""
    return F.filter(
        F.sequence(F.lit(0), F.size(facts) - 1),
        lambda i: (i == 0) | (F.get(facts, i)["w"] > PASSAGE_WORDS) | (F.get(facts, i - 1)["w"] > PASSAGE_WORDS)
        | ((F.get(facts, i - 1)["h"] * 31
            + F.when(i > 1, F.get(facts, F.greatest(i - 2, F.lit(0)))["h"]).otherwise(0)) % EVERY == 0))


def _n_words(line: Column) -> Column:
    inner = F.btrim(line, F.lit(" \t\n\x0b\f\r"))
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, r"[\x20\x09-\x0D]+")))


def chunks_of(text: Column) -> Column:
    """array<struct<lines, words, body>> of a text; joining the bodies by
    ``\\n`` gives the text back."""
    def cut(a):
        return let(_facts(a), lambda f: let(_starts(f), lambda s: F.transform(s, lambda b, k: chunk(
            a, f, b + 1, F.coalesce(F.get(s, k + 1), F.size(a)) - b))))

    def chunk(a, f, at, n):
        words = F.aggregate(F.slice(f, at, n), F.lit(0), lambda acc, x: acc + x["w"])
        return F.struct(n.alias("lines"), words.alias("words"), F.array_join(F.slice(a, at, n), "\n").alias("body"))
    return let(F.split(text, "\n"), cut)


def _row_key(id_col: str, text: Column) -> list[Column]:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(_MAX)).alias("id"), F.md5(text).alias("md5")]


def _place() -> Column:
    """(id, position, text) of a chunk as one number, so that a hash aggregate
    can keep the smallest and largest; rows of one id are told apart by the
    first 32 bits of the MD5 of their text."""
    wide = "decimal(38,0)"
    return (F.col("id").cast(wide) * F.expr("CAST('9223372036854775808' AS DECIMAL(19,0))")
            + (F.shiftleft(F.col("pos").cast("long"), 32)
               + F.conv(F.substring("md5", 1, 8), 16, 10).cast("long")).cast(wide)).cast(wide)


def repeated_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(id, md5, drop): positions of the chunks to remove from each text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*_row_key(id_col, text), F.posexplode(chunks_of(text)).alias("pos", "c"))
    rows = (rows.select("id", "md5", "pos", "c.lines", "c.body", "c.words")
                .filter((F.col("words") >= MIN_WORDS) & ((F.col("lines") > 1) | (F.col("words") > PASSAGE_WORDS)))
                .withColumn("hash", chunk_hash(F.col("body"))))
    # Cut once: the chunks that may go are written, and read for the groups
    # (with their bodies) and for the places (without).
    path = work_path(docs.sparkSession, "line_dedup", unique=True)
    rows.drop("lines", "words").withColumn("place", _place()).write.option("compression", "zstd").parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    groups = (rows.groupBy("hash", "body").agg(F.min("place").alias("first"), F.max("place").alias("last"))
                  .groupBy("hash").agg(F.count("*").alias("contents"), F.min("first").alias("first"),
                                       F.max(F.col("first") != F.col("last")).alias("repeated"))
                  .filter("repeated"))
    groups = checkpointed(groups)
    light = rows.select("id", "md5", "pos", "hash", "place")
    # The places of a very common chunk are dealt over salts.
    hits = salted_join(light, groups.filter("contents = 1").select("hash", "first"), "hash", ["id", "md5", "pos"])
    hits = hits.filter("place != first").select("id", "md5", "pos")
    collided = groups.filter("contents > 1").select("hash")
    if not collided.isEmpty():
        mixed = rows.join(collided, "hash", "left_semi")
        firsts = mixed.groupBy("hash", "body").agg(F.min("place").alias("first"))
        mixed = salted_join(mixed.withColumn("one", F.struct("hash", "body")),
                            firsts.select(F.struct("hash", "body").alias("one"), "first"), "one", ["id", "md5", "pos"])
        hits = hits.unionByName(mixed.filter("place != first").select("id", "md5", "pos"))
    return hits.groupBy("id", "md5").agg(F.collect_set("pos").alias("drop"))


def remove_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    removed_col: str | None = None,
                    chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """``docs`` with the repeated chunks taken out of the text; with
    ``removed_col``, the number of chunks removed from each."""
    before = docs.columns
    kid, kmd5, drop = fresh([*before, removed_col or ""], "key_id", "key_md5", "drop_pos")
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = repeated_places(docs, id_col, text_col, chunk_hash)
    out = out.select(F.col("id").alias(kid), F.col("md5").alias(kmd5), F.col("drop").alias(drop))
    a, b = _row_key(id_col, text)
    keyed = docs.withColumns({kid + "_l": a, kmd5 + "_l": b})
    joined = keyed.join(out, (F.col(kid + "_l") == F.col(kid)) & (F.col(kmd5 + "_l") == F.col(kmd5)), "left")
    kept = F.filter(chunks_of(text), lambda c, i: ~F.array_contains(F.col(drop), i))
    joined = joined.withColumn(text_col, F.when(F.col(drop).isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(kept, lambda c: c["body"]), "\n")))
    if "n_chars" in before and text_col != "n_chars":
        joined = joined.withColumn("n_chars", F.when(F.col(drop).isNull(), F.col("n_chars"))
                                   .otherwise(F.char_length(F.col(text_col)).cast("long")))
    cols = [F.col(f"`{c}`") for c in before]
    if removed_col:
        cols.append(F.when(F.col(drop).isNull(), 0).otherwise(F.size(drop)).cast("long").alias(removed_col))
    return joined.select(*cols)


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    d = remove_repeated(table(spark, sf_dir, "documents"), removed_col="chunks_removed")
    return d.select("doc_id", "text", "n_chars", "chunks_removed")


SQL = rf"""
WITH d AS (
  SELECT coalesce(doc_id, {_MAX}) AS id, doc_id, text, n_chars, md5(coalesce(text, '')) AS m,
         string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT id, m, i, lines[i + 1] AS line FROM (SELECT DISTINCT id, m, lines, unnest(range(0, len(lines))) AS i FROM d)),
h AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS hash,
         len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words FROM l),
p AS (
  SELECT *, lag(hash) OVER w AS h1, coalesce(lag(hash, 2) OVER w, 0) AS h2, lag(words) OVER w AS w1
  FROM h WINDOW w AS (PARTITION BY id, m ORDER BY i)),
s AS (
  SELECT id, m, i, line, words, sum(CASE WHEN i = 0 OR words > {PASSAGE_WORDS} OR w1 > {PASSAGE_WORDS}
         OR (h1 * 31 + h2) % {EVERY} = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY id, m ORDER BY i) - 1 AS pos FROM p),
c AS (
  SELECT id, m, pos, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n, sum(words) AS words
  FROM s GROUP BY id, m, pos),
e AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY id, pos, m) AS k,
         words >= {MIN_WORDS} AND (n > 1 OR words > {PASSAGE_WORDS}) AS able FROM c),
g AS (
  SELECT id, m, count(*) FILTER (able AND k > 1) AS removed,
         coalesce(string_agg(body, chr(10) ORDER BY pos) FILTER (NOT (able AND k > 1)), '') AS rest
  FROM e GROUP BY id, m)
SELECT d.doc_id, CASE WHEN removed > 0 THEN rest ELSE d.text END AS text,
       CASE WHEN removed > 0 THEN length(rest)::BIGINT ELSE d.n_chars END AS n_chars, removed AS chunks_removed
FROM d JOIN g USING (id, m)
"""
