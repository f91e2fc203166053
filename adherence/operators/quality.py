"""Data-quality checks as DataFrames.

Every check yields report rows ``(table, check, column, violations, sample)``;
nothing is raised until ``enforce`` is called after all checks ran, so a
table is never published before the checks of the others (the reference
overwrites each table before testing integrity).

Per table, row, null and type counts come from one global aggregate without a
shuffle of rows; uniqueness shuffles the key columns alone. Samples are the
five smallest violating keys, taken with a per-partition top-k, never by
collecting a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from adherence.schemas import REPORT_SCHEMA

SAMPLE_N = 5
FATAL_CHECKS = {"required_columns", "type_match", "null_check", "unique_check", "foreign_key"}


class DataQualityError(ValueError):
    """Raised by ``enforce`` with every failing check in the message."""


def null_or_empty(df: DataFrame, col: str) -> Column:
    """NULL, or the empty string for text columns only (comparing a
    number with '' would be a cast error under ANSI)."""
    c = F.col(f"`{col}`")
    if isinstance(df.schema[col].dataType, StringType):
        return c.isNull() | (c == "")
    return c.isNull()


def _bad_type(df: DataFrame, col: str, target) -> Column | None:
    """Q3: a non-empty text value that does not cast to the declared type."""
    if not isinstance(df.schema[col].dataType, StringType) or isinstance(target, StringType):
        return None
    c = F.trim(F.col(f"`{col}`"))
    return (c != "") & c.try_cast(target).isNull()


def key_text(keys: Sequence[str]) -> Column:
    """A key tuple as text, ``a|b``; NULL parts print as NULL."""
    return F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("NULL")) for k in keys])


def _row(table: str, check: str, column, violations: Column, sample: Column | None = None) -> list[Column]:
    return [F.lit(table).alias("table"), F.lit(check).alias("check"),
            F.lit(column).cast("string").alias("column"), violations.cast("bigint").alias("violations"),
            (sample if sample is not None else F.lit(None)).cast("array<string>").alias("sample")]


def sample_of(df: DataFrame, keys: Sequence[str], n: int = SAMPLE_N) -> DataFrame:
    """O3: the ``n`` smallest key tuples as one sorted array (bounded)."""
    top = df.select(*keys).orderBy(*keys).limit(n)
    return top.agg(F.array_sort(F.collect_list(key_text(keys))).alias("sample"))


COUNTED = ("row_count", "null_check", "type_match")


def counted_checks(df: DataFrame, schema: StructType | None = None, non_nullable: Iterable[str] | None = None,
                   checks: Iterable[str] = COUNTED) -> list[tuple[str, str | None, Column]]:
    """(check, column, aggregate) of the checks that a count over the rows
    decides (Q3, Q4, Q6): one global aggregate, no shuffle of rows."""
    cols = set(df.columns)
    if non_nullable is None:
        non_nullable = [f.name for f in schema.fields if not f.nullable] if schema is not None else []
    found: list[tuple[str, str | None, Column]] = []
    if "row_count" in checks:
        found.append(("row_count", None, F.count(F.lit(1))))
    if "null_check" in checks:
        found += [("null_check", c, F.count_if(null_or_empty(df, c))) for c in non_nullable if c in cols]
    if "type_match" in checks and schema is not None:
        bad = [(f.name, _bad_type(df, f.name, f.dataType)) for f in schema.fields if f.name in cols]
        found += [("type_match", c, F.count_if(x)) for c, x in bad if x is not None]
    return found


def unique_check(df: DataFrame, table: str, keys: Sequence[str], sample_n: int = SAMPLE_N) -> DataFrame:
    """Q5: excess rows of repeated keys, and the smallest such keys. One shuffle
    of the key columns alone, read by both branches (the same exchange). A key
    with a column that the table lacks says nothing and is reported so."""
    label = ",".join(keys)
    if any(k not in df.columns for k in keys):
        return df.sparkSession.createDataFrame([(table, "skipped", label, None, None)], REPORT_SCHEMA)
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    count = grouped.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("v"))
    dups = sample_of(grouped.filter(F.col("_n") > 1), keys, sample_n)
    unique = count.join(F.broadcast(dups), F.lit(True), "left")  # one row each
    return unique.select(*_row(table, "unique_check", label, F.col("v"), F.col("sample")))


def table_checks(df: DataFrame, table: str, keys: Sequence[str] | None = None,
                 schema: StructType | None = None, non_nullable: Iterable[str] | None = None,
                 sample_n: int = SAMPLE_N, checks: Iterable[str] = (*COUNTED, "unique_check")) -> DataFrame:
    """Q3 + Q4 + Q5 + Q6 for one table, or those named in ``checks``.

    ``df`` is the table as read (text columns for CSV, typed otherwise);
    ``schema`` the declared schema: its non-nullable fields are null-checked
    and text columns declared with another type are type-checked."""
    parts = []
    counted = counted_checks(df, schema, non_nullable, checks)
    if counted:
        totals = df.agg(*[agg.alias(f"c_{i}") for i, (_, _, agg) in enumerate(counted)])
        rows = [F.struct(*_row(table, check, column, F.col(f"c_{i}"))) for i, (check, column, _) in enumerate(counted)]
        # One aggregate row -> one report row per check, via an array of structs.
        parts.append(totals.select(F.inline(F.array(*rows))))
    if keys and "unique_check" in checks:
        parts.append(unique_check(df, table, list(keys), sample_n))
    out = parts[0] if parts else df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def staged_checks(df: DataFrame, path: str, table: str, keys: Sequence[str] | None = None,
                  schema: StructType | None = None, non_nullable: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(staged table, report): ``df`` written to ``path``, with the counts of Q3,
    Q4 and Q6 observed while it is written, so that they take no scan of their
    own; Q5 reads the key columns of what was written."""
    counted = counted_checks(df, schema, non_nullable)
    seen = Observation(f"{table} while staging")
    df.observe(seen, *[agg.alias(f"c_{i}") for i, (_, _, agg) in enumerate(counted)]).write.mode("overwrite").parquet(path)
    counts = seen.get
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    report = df.sparkSession.createDataFrame(
        [(table, check, column, counts[f"c_{i}"], None) for i, (check, column, _) in enumerate(counted)], REPORT_SCHEMA)
    return staged, report.unionByName(unique_check(staged, table, list(keys))) if keys else report


def foreign_key(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str,
                child_table: str = "child", parent_table: str = "parent",
                sample_n: int = SAMPLE_N) -> DataFrame:
    """Q7: number of distinct child values absent from the parent, and a
    sample of five. A NULL child value matches nothing and is counted."""
    missing = missing_keys(child, parent, child_col, parent_col)
    label = f"{child_col}->{parent_table}.{parent_col}"
    cnt = missing.agg(F.count(F.lit(1)).alias("v"))
    smp = sample_of(missing, [child_col], sample_n)
    return cnt.join(F.broadcast(smp), F.lit(True), "left").select(
        *_row(child_table, "foreign_key", label, F.col("v"), F.col("sample")))


def missing_keys(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Distinct child values with no parent (left anti join); the column
    names may differ. Only the child side is de-duplicated: the anti join
    needs no distinct parent. NULL child values are kept."""
    c = child.select(F.col(child_col)).distinct()
    p = parent.select(F.col(parent_col).alias("_pk"))
    return c.join(p, c[child_col] == p["_pk"], "left_anti")


def header_checks(spark: SparkSession, table: str, header: Sequence[str], schema: StructType,
                  required: Iterable[str]) -> DataFrame:
    """Q1 (missing required columns, fatal) and Q2 (surplus columns, warning)
    from the file header; one row per finding."""
    names = set(schema.fieldNames())
    rows = [(table, "required_columns", c, 1, []) for c in sorted(set(required) - set(header))]
    rows += [(table, "extra_columns", c, 1, []) for c in header if c not in names]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def integrity(tables: dict[str, DataFrame], links) -> DataFrame:
    """``foreign_key`` for each (child, column, parent, column)."""
    parts = [foreign_key(tables[c], tables[p], cc, pc, c, p) for c, cc, p, pc in links
             if c in tables and p in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def failures(report: DataFrame) -> DataFrame:
    """Report rows that fail (fatal check with violations > 0)."""
    return report.filter(F.col("check").isin(*FATAL_CHECKS) & (F.col("violations") > 0))


def enforce(report: DataFrame) -> None:
    """Raise ``DataQualityError`` when any fatal check failed, naming all of
    them: there is one row per table, check and column, so their number does
    not depend on the data."""
    bad = failures(report).orderBy("table", "check", "column").collect()
    if bad:
        lines = [f"{r['table']}.{r['column']}: {r['check']} {r['violations']} "
                 f"(sample {list(r['sample'] or [])})" for r in bad]
        raise DataQualityError(f"data quality failed ({len(bad)} checks):\n" + "\n".join(lines))
