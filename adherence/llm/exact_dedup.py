"""Operator 5: exact dedup by skew-safe combining.

Texts are equal when identical after deleting white space. Rows are combined
in three stages, and every stage compares the full normalised content, since
the content itself is part of the grouping key (the digest only leads):

1. local: Spark's map-side aggregation merges equal texts inside a partition;
2. salted: groups of (digest, salt, content), with the salt drawn from the
   row, so copies of one text meet in ``salts`` tasks and not in one;
3. global: the salt winners, at most ``salts`` rows per text, are combined.

The way back needs no content: a salted lookup (digest, salt) -> class. Only
where one digest covers several contents (never seen for SHA-256, forced in
the tests by a weak digest) are the rows of that digest matched by content.

Defined results: a null text counts as empty; a null doc_id is larger than
every other id; repeated rows count as many times as they come (identical
ids and texts are all marked kept, as nothing tells them apart); an empty
table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adherence.llm.common import checkpointed, table, text_or_empty

SALTS = 64
_MAX = 2 ** 63 - 1
_SHIFT = "CAST('18446744073709551616' AS DECIMAL(20,0))"  # 2 to the 64


def normalised(text: Column) -> Column:
    """The text without white space."""
    return F.array_join(F.split(text, r"[\x20\x09-\x0D]+"), "")


def sha256(norm: Column) -> Column:
    return F.sha2(norm, 256)


def _rank(n: Column, doc_id: Column) -> Column:
    """(code points, smaller id first) as one number: a fixed-width value
    that a hash aggregate can update in place."""
    wide = "decimal(38,0)"
    inverse = F.lit(_MAX).cast(wide) - F.coalesce(doc_id, F.lit(_MAX)).cast(wide)
    return (n.cast(wide) * F.expr(_SHIFT) + inverse).cast(wide)


def _id_of(rank: Column) -> Column:
    return (F.lit(_MAX).cast("decimal(38,0)") - rank % F.expr(_SHIFT)).cast("long")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                 digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per input row: the id, ``keep_id``, ``group_size``, ``kept``
    and ``digest`` of the normalised text."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.char_length(text).alias("n"),
                       normalised(text).alias("norm"))
    rows = rows.select("id", "n", "norm", digest(F.col("norm")).alias("digest"),
                       F.pmod(F.xxhash64("id", "n"), F.lit(salts)).cast("int").alias("salt"))
    salted = (rows.groupBy("digest", "salt", "norm")
                  .agg(F.max(_rank(F.col("n"), F.col("id"))).alias("rank"), F.count("*").alias("size")))
    classes = (salted.groupBy("digest", "norm")
                     .agg(F.max("rank").alias("rank"), F.sum("size").alias("size")))
    # One row per digest; more than one content behind it is a collision.
    by_digest = checkpointed(classes.groupBy("digest").agg(F.count("*").alias("contents"), F.max("rank").alias("rank"),
                                                           F.max("size").alias("size")))
    light = checkpointed(rows.select("id", "n", "digest", "salt"))
    lookup = light.select("digest", "salt").distinct().join(by_digest.filter("contents = 1"), "digest")
    out = light.join(lookup, ["digest", "salt"])
    cols = ["id", "n", "digest", "rank", "size"]
    out = out.select(*cols)
    collided = by_digest.filter("contents > 1").select("digest")
    if not collided.isEmpty():
        by_content = rows.join(collided, "digest", "left_semi").join(classes, ["digest", "norm"])
        out = out.unionByName(by_content.select(*cols))
    keep = _id_of(F.col("rank"))
    best = _rank(F.col("n"), F.col("id")) == F.col("rank")
    return out.select(F.col("id").alias(id_col),
                      F.when(keep == _MAX, None).otherwise(keep).alias("keep_id"),
                      F.col("size").cast("long").alias("group_size"), best.alias("kept"), "digest")


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    d = exact_groups(table(spark, sf_dir, "documents"))
    return d.withColumnRenamed("digest", "text_sha256")


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
g AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
