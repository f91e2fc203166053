"""Headed CSV with a declared schema.

Columns bind by header name, not position; every value is read as text and
cast with ``try_cast``, so a bad number becomes NULL in the typed frame and is
counted by the type check instead of vanishing silently."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


# Fixed value: marker the CSV parser returns for an unquoted empty field.
NULL_MARKER = "\u0000"


class MissingSourceError(FileNotFoundError):
    """A needed file is absent."""


@dataclass
class CsvTable:
    name: str
    raw: DataFrame                      # header columns, all text
    typed: DataFrame                    # declared columns, declared types
    schema: StructType
    header: list[str] = field(default_factory=list)

    @property
    def missing(self) -> list[str]:
        return [f.name for f in self.schema.fields if f.name not in self.header]

    @property
    def extra(self) -> list[str]:
        names = set(self.schema.fieldNames())
        return [c for c in self.header if c not in names]


def read_raw(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """All columns as text, names from the header. An empty unquoted field is
    NULL, a quoted empty field stays the empty string."""
    try:
        return (spark.read.option("header", True).option("inferSchema", False)
                .option("mode", "PERMISSIVE").option("emptyValue", "")
                # an unquoted empty field gives the parser's null marker -> NULL;
                # a quoted empty field ("") stays the empty string
                .option("nullValue", NULL_MARKER)
                .csv(path))
    except Exception as ex:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(ex) or "Path does not exist" in str(ex):
            raise MissingSourceError(f"{name or path}: file not found at {path}") from ex
        raise


def typed_view(raw: DataFrame, schema: StructType) -> DataFrame:
    """Declared columns by name, cast with try_cast; an absent column is NULL."""
    have = set(raw.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f"`{f.name}`")
            cols.append((c if isinstance(f.dataType, StringType) else F.trim(c).try_cast(f.dataType))
                        .alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def load_csv(spark: SparkSession, path: str, schema: StructType, name: str | None = None) -> CsvTable:
    """Read a headed CSV against a declared schema."""
    raw = read_raw(spark, path, name)
    return CsvTable(name or path, raw, typed_view(raw, schema), schema, list(raw.columns))
