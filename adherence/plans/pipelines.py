"""User-facing batch pipelines: load_static."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from adherence import schemas as SC
from adherence.operators import quality as Q
from adherence.session import work_path
from adherence.sources import tables as T
from adherence.sources.csv import load_csv, typed_view


@dataclass
class StaticLoad:
    report: DataFrame
    tables: dict[str, DataFrame]
    published: dict[str, int]


def load_static(spark: SparkSession, folder: str, out_root: str | None = None,
                names=SC.TABLE_ORDER, links=SC.CODED_LINKS, enforce: bool = True,
                stage: bool = True) -> StaticLoad:
    """For each timetable file: header checks, one-pass table checks,
    then the links; publish every table only when all checks pass.

    With ``stage`` each CSV is parsed once into parquet under the shared
    checkpoint folder, and its rows, nulls and types are counted by that write;
    the other checks and publishing read the columnar copy."""
    reports, typed = [], {}
    stage_root = work_path(spark, "stage", unique=True)
    for name in names:
        schema = SC.STATIC_SCHEMAS[name]
        t = load_csv(spark, f"{folder.rstrip('/')}/{name}.txt", schema, name)
        reports.append(Q.header_checks(spark, name, t.header, schema, SC.REQUIRED_COLUMNS[name]))
        if stage:
            raw, found = Q.staged_checks(t.raw, f"{stage_root}/{name}", name, SC.PRIMARY_KEYS[name], schema)
        else:
            raw, found = t.raw, Q.table_checks(t.raw, name, SC.PRIMARY_KEYS[name], schema)
        typed[name] = typed_view(raw, schema)
        reports.append(found)
    if links:
        reports.append(Q.integrity(typed, links))
    report = reports[0]
    for r in reports[1:]:
        report = report.unionByName(r)
    published: dict[str, int] = {}
    if enforce:
        Q.enforce(report)
    if out_root is not None:
        for name, df in typed.items():
            published[name] = T.publish(spark, df, f"{out_root.rstrip('/')}/dim_{name}")
    return StaticLoad(report, typed, published)
