"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.session import ensure_checkpoint_dir

#: The white space of every contract here: space and the controls 9 to 13.
SPACE_CHARS = " \t\n\x0b\f\r"
SPACE_RE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    """Null counts as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (null: empty)."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: inside a
    higher-order function a plain reference would be inlined and computed
    again for every element."""
    return F.transform(F.array(value), body)[0]


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """Column names for internal use that clash with none of ``taken``."""
    taken = {c.lower() for c in taken}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's text, modulo ``mod`` (null for a null id)."""
    return F.crc32(doc_id.cast("string")) % F.lit(mod)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows to the session's shared checkpoint folder and go on
    from there: lineage is cut and a lost executor loses nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def salted_join(rows: DataFrame, small: DataFrame, key: str, spread: str | list[str], how: str = "inner",
                salts: int = 32) -> DataFrame:
    """``rows`` joined with ``small`` (one row per ``key``) where one key may
    hold most rows: rows are dealt by (key, salt from ``spread``), and the
    small side is first looked up once for each such pair."""
    salt = fresh([*rows.columns, *small.columns], "salt")[0]
    salted = rows.withColumn(salt, F.pmod(F.xxhash64(*([spread] if isinstance(spread, str) else spread)), F.lit(salts)).cast("int"))
    pairs = salted.select(key, salt).distinct().join(small, key)
    return salted.join(pairs, [key, salt], how).drop(salt)
