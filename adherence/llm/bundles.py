"""Bundles of documents for the operators that look at a document together
with facts gathered from all documents.

A bundle holds some megabytes of whole texts. Which bundle a document is in
follows from its id and text alone, so a recomputed task finds the same
bundles. Facts go from bundles to buckets (by a hash of the fact) and answers
come back from the buckets to the bundles; whatever a bundle holds many times
it sends once, so a fact of very many documents reaches its bucket at most
once per bundle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text of a bundle: the smaller while there are few bundles.
SMALL_BUNDLE, LARGE_BUNDLE, MANY = 4 << 20, 32 << 20, 8192
#: Most buckets that facts are dealt to.
MAX_BUCKETS = 1 << 16


def bundle_count(docs: DataFrame, text_col: str = "text", small: int = SMALL_BUNDLE) -> int:
    """Bundles for these documents, from one count of their bytes."""
    n = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("n")).first()["n"] or 0
    return int(max(1, min(MANY, -(-n // small)), -(-n // LARGE_BUNDLE)))


def bundled(docs: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, body, bundle): the id as long, the text as UTF-8 bytes."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("body"))
    return rows.withColumn("bundle", F.pmod(F.xxhash64("doc_id", "body"), F.lit(n)).cast("int"))


def pack(*columns: np.ndarray) -> bytes:
    """Number columns of equal length as bytes: byte planes, then zstandard,
    so high bytes that are all zero cost nothing."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() if len(c) else b"" for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(data: bytes, *dtypes) -> list[np.ndarray]:
    """The columns that ``pack`` was given."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    sizes = [np.dtype(t).itemsize for t in dtypes]
    n, out, at = len(raw) // sum(sizes), [], 0
    for t, size in zip(dtypes, sizes):
        planes = raw[at: at + n * size].reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(t).reshape(n))
        at += n * size
    return out


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i]+1, ... (counts[i] of them) in a row."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


def bodies(table: pa.Table) -> list[bytes]:
    """The texts of a bundle; null is empty."""
    return [x or b"" for x in table.column("body").to_pylist()]
