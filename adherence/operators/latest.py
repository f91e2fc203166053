"""Last write wins per key (T1) and differential feeds (K6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(order) -> Column:
    if isinstance(order, Column):
        return order
    if isinstance(order, str):
        return F.col(order)
    return F.struct(*[F.col(c) for c in order])


def latest_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str], order) -> DataFrame:
    """Per key, the values of the row that is last in ``order`` (a column, a
    column name or a list of names compared left to right).

    One aggregate: partial ``max_by`` on the map side, one shuffle on the
    keys, so a hot key is reduced before the exchange and never collected
    into one task. Ties in ``order`` pick one of the tied rows."""
    packed = F.struct(*[F.col(v) for v in values])
    return (df.groupBy(*keys)
              .agg(F.max_by(packed, _order(order)).alias("_v"))
              .select(*keys, *[F.col("_v")[v].alias(v) for v in values]))


def apply_differential(entities: DataFrame, id_col: str = "entity_id", deleted_col: str = "is_deleted",
                       order="arrival_order", values: Sequence[str] | None = None) -> DataFrame:
    """Differential feed semantics: per entity id the latest entity wins and
    an entity whose latest version is deleted is dropped."""
    values = list(values or [c for c in entities.columns if c != id_col])
    if deleted_col not in values:
        values.append(deleted_col)
    latest = latest_per_key(entities, [id_col], values, order)
    return latest.filter(~F.coalesce(F.col(deleted_col), F.lit(False)))


def apply_feeds(entities: DataFrame, id_col: str = "entity_id", deleted_col: str = "is_deleted", full_col: str = "is_full",
                order: str = "arrival_order", values: Sequence[str] | None = None) -> DataFrame:
    """Feeds of both kinds: a full-dataset feed replaces everything that came
    before it, differential feeds change single entities. ``order`` is the
    arrival of the feed of a row, ``full_col`` says whether that feed is full."""
    values = list(values or [c for c in entities.columns if c not in (id_col, full_col, order)])
    start = entities.filter(F.col(full_col)).agg(F.max(order).alias("_start"))  # one row
    live = entities.join(F.broadcast(start), F.col("_start").isNull() | (F.col(order) >= F.col("_start")))
    return apply_differential(live.drop("_start"), id_col, deleted_col, order, values)
