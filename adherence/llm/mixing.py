"""Operator 8: mixing sources to target weights by temperature.

Source token shares p are raised to an exponent t in [0, 1] and normalised:
t = 1 keeps the shares, t = 0 makes all sources equal. The exponent is
bisected (32 midpoints a pass, in one small job each) until the entropy of
the weights meets the target, then raised further where a source would be
repeated more than ``max_repeats`` times. The weights times the token budget
are the sources' quotas: whole passes over a source, then one partial pass.

Rows are dealt to blocks by a hash, each pass puts the blocks of a source in a
new pseudo-random order, and the partial pass takes blocks in that order
until the quota is used up; inside the block on the border, rows are taken
in hash order. So the choice of a row follows from its own hashes and one
small row per source (whole passes, border block, border row): no window or
sort ever holds the rows of a source, only its block sums, of which there
are at most ``MAX_BLOCKS`` a source.

Defined results: a null source is a source of its own; a source without
tokens has no weight and is not drawn; repeated rows are drawn alike; an
empty table gives no rows; a budget of less than a source's first row in the
order draws nothing from it; other columns pass through unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adherence.llm.common import SPACE_RE, checkpointed, fresh, table

BLOCK_TOKENS = 20_000
MAX_BLOCKS = 65_536
#: Where between the entropy of the shares (0) and of equal weights (1).
EVENNESS = 0.5
MAX_REPEATS = 4.0
SEED = 20_240
POINTS, PASSES = 32, 6
#: Plans of up to so many sources (under 100 bytes each) are broadcast.
BROADCAST_SOURCES = 100_000
_RANGE = 2 ** 53


def n_tokens(text: Column) -> Column:
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(inner == "", 0).otherwise(F.size(F.split(inner, SPACE_RE))).cast("long")


def _row_hash(id_col: str, text_col: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), F.lit(_RANGE))


def _block_place(source: Column, epoch: Column, block: Column) -> Column:
    """Place of a block in the order of a pass; blocks that share one go together."""
    return F.pmod(F.xxhash64(F.lit(SEED), F.coalesce(source, F.lit("\x00null")), epoch, block), F.lit(_RANGE))


def bisect(shares: DataFrame, evenness: float = EVENNESS, max_repeats: float = MAX_REPEATS,
           budget_ratio: float = 1.0) -> tuple[float, float]:
    """(exponent, sum of powers) for a table with one ``p`` per source. Every
    pass is one aggregate over the sources for 33 exponents at once; 33 rows
    come to the driver, whatever the number of sources."""
    def at(points: list[float]) -> list[tuple]:
        g = F.explode(F.array(*[F.lit(x) for x in points])).alias("t")
        rows = (shares.select("p", g).groupBy("t")
                      .agg(F.sum(F.pow("p", F.col("t"))).alias("z"),
                           F.sum(F.pow("p", F.col("t")) * F.log("p")).alias("zl"),
                           F.max(F.pow("p", F.col("t") - 1)).alias("most"), F.count("*").alias("n")).collect())
        return sorted((r["t"], r["z"], math.log(r["z"]) - r["t"] * r["zl"] / r["z"], r["most"] / r["z"], r["n"])
                      for r in rows)

    ends = at([0.0, 1.0])
    if not ends:
        return 1.0, 1.0
    own, even = ends[-1][2], math.log(ends[-1][4])
    target = own + evenness * (even - own)

    def fits(row) -> bool:  # both grow easier with the exponent
        return row[2] <= target + 1e-12 and row[3] * budget_ratio <= max_repeats + 1e-12

    lo, hi = 0.0, 1.0  # hi fits, or is the best there is
    for _ in range(PASSES):
        rows = at([lo + (hi - lo) * k / POINTS for k in range(POINTS + 1)])
        good = [i for i, r in enumerate(rows) if fits(r)]
        i = good[0] if good else POINTS
        lo, hi, z = rows[max(i - 1, 0)][0], rows[i][0], rows[i][1]
        if i == 0:
            break
    return hi, z


def plan_mix(rows: DataFrame, evenness: float = EVENNESS, max_repeats: float = MAX_REPEATS,
             budget_ratio: float = 1.0) -> DataFrame:
    """One row per source: tokens, weight, quota, whole passes, the places
    up to which the partial pass takes blocks and rows. ``rows`` has source,
    row_hash and tokens, and is read several times."""
    per = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")).filter("tokens > 0")
    per = checkpointed(per)
    total = per.agg(F.sum("tokens")).first()[0] or 0
    shares = per.withColumn("p", F.col("tokens") / F.lit(max(total, 1)))
    exponent, z = bisect(shares, evenness, max_repeats, budget_ratio)
    budget = int(total * budget_ratio)
    plan = shares.withColumn("weight", F.pow("p", F.lit(exponent)) / F.lit(z))
    plan = plan.withColumns({"quota": F.floor(F.col("weight") * budget).cast("long"), "exponent": F.lit(exponent),
                             "n_blocks": F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("long")})
    plan = plan.withColumns({"passes": F.expr("quota div tokens")})
    plan = checkpointed(plan.withColumn("rest", F.col("quota") - F.col("passes") * F.col("tokens")))
    placed = _attach(rows, plan.select("source", "passes", "n_blocks", "rest"))
    placed = placed.withColumn("place", _block_place(F.col("source"), F.col("passes"), F.pmod("row_hash", "n_blocks")))
    blocks = placed.groupBy("source", "place", "rest").agg(F.sum("tokens").alias("tokens"))
    upto = F.sum("tokens").over(Window.partitionBy("source").orderBy("place"))
    # The border block: the first that no longer fits.
    border = (blocks.withColumn("upto", upto).filter("upto > rest").groupBy("source")
                    .agg(F.min(F.struct("place", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left"))).alias("b"))
                    .select(F.col("source").alias("source_b"), F.col("b.place").alias("cut_place"),
                            F.col("b.left").alias("left")))
    border = checkpointed(border)
    inside = _attach(placed.select("source", "place", "row_hash", "tokens"),
                     border.withColumnRenamed("source_b", "source")).filter("place = cut_place")
    order = F.sum("tokens").over(Window.partitionBy("source").orderBy("row_hash"))
    last = (inside.groupBy("source", "row_hash", "left").agg(F.sum("tokens").alias("tokens"))
                  .withColumn("upto", order).filter("upto <= left")
                  .groupBy(F.col("source").alias("source_r")).agg(F.max("row_hash").alias("cut_row")))
    out = (plan.join(border, F.col("source").eqNullSafe(F.col("source_b")), "left")
               .join(last, F.col("source").eqNullSafe(F.col("source_r")), "left"))
    return checkpointed(out.drop("source_b", "source_r", "left"))


def _attach(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the columns of their source's plan; other sources' rows go."""
    other = fresh([*rows.columns, *plan.columns], "plan_source")[0]
    p = plan.withColumnRenamed("source", other)
    if plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        p = F.broadcast(p)
    return rows.join(p, F.col("source").eqNullSafe(F.col(other))).drop(other)


def draw(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with source and row_hash), each as often as the plan draws
    it, with ``epoch`` (number of the pass), ``block`` and ``position``: how
    far through its source's quota it comes, so sorting by it mixes sources."""
    d = _attach(rows, plan.select("source", "tokens_all", "quota", "passes", "n_blocks", "cut_place", "cut_row"))
    block = F.pmod("row_hash", "n_blocks")
    place = _block_place(F.col("source"), F.col("passes"), block)
    once_more = (F.when(F.col("cut_place").isNull(), False).when(place < F.col("cut_place"), True)
                 .when(place == F.col("cut_place"), F.coalesce(F.col("row_hash") <= F.col("cut_row"), F.lit(False)))
                 .otherwise(False))
    times = F.col("passes") + once_more.cast("long")
    d = d.withColumn("block", block).withColumn("epoch", F.explode(F.when(times > 0, F.sequence(F.lit(0).cast("long"), times - 1))))
    at = _block_place(F.col("source"), F.col("epoch"), F.col("block")) / F.lit(float(_RANGE))
    part = F.col("quota") / F.col("tokens_all")
    return (d.withColumn("position", (F.col("epoch") + at) / part)
             .drop("tokens_all", "quota", "passes", "n_blocks", "cut_place", "cut_row"))


def _light(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                       _row_hash(id_col, text_col).alias("row_hash"), n_tokens(F.col(f"`{text_col}`")).alias("tokens"))


def mix(docs: DataFrame, evenness: float = EVENNESS, max_repeats: float = MAX_REPEATS,
        budget_ratio: float = 1.0) -> DataFrame:
    """doc_id, source, tokens, epoch, block, position: one row per drawing."""
    rows = checkpointed(_light(docs, "doc_id", "text", "source"))  # no texts
    plan = plan_mix(rows, evenness, max_repeats, budget_ratio).withColumnRenamed("tokens", "tokens_all")
    return draw(rows, plan).drop("row_hash")


def mix_documents(docs: DataFrame, evenness: float = EVENNESS, max_repeats: float = MAX_REPEATS,
                  budget_ratio: float = 1.0) -> DataFrame:
    """The rows of ``docs`` as often as they are drawn, columns unchanged.
    The texts are neither shuffled nor sorted."""
    rows = checkpointed(_light(docs, "doc_id", "text", "source"))
    plan = plan_mix(rows, evenness, max_repeats, budget_ratio).withColumnRenamed("tokens", "tokens_all")
    packed = docs.select(F.col("source").alias("source"), _row_hash("doc_id", "text").alias("row_hash"),
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return draw(packed, plan).select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def op8_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
