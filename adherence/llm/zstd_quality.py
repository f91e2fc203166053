"""Operator 4: quality classifier by compression.

Two zstandard dictionaries are built, from texts labelled good and bad. A text
is compressed with either; the difference of the compressed sizes, divided by
the square root of its size, says which kind it resembles, and a logistic
curve fitted on other labelled texts turns that into a probability (for equal
shares of good and bad texts).

Bounds of fitting (documented parameters): ``PER_CLASS`` labelled texts of each
label, of up to ``MAX_CHARS`` characters; half of them build the dictionaries,
half fit the curve. Only the two dictionaries and the curve leave the driver.
Scoring compresses every whole text, streaming, in one pass without a shuffle.

Defined results: a null or empty text gets the score of no difference; a null
doc_id is not held out; with labels of one kind or none, every score is that
kind's smoothed share; repeated rows are scored alike; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.llm.common import fold, table
from adherence.llm.labelled import FOLDS, labelled_sample, logistic, platt

PER_CLASS = 2000
MAX_CHARS = 20_000
DICT_BYTES = 400_000
LEVEL = 3
THRESHOLD = 0.3


def build_dictionary(texts: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary; too few texts to train give their plain bytes."""
    total = sum(map(len, texts))
    try:
        return zstandard.train_dictionary(min(size, max(total // 4, 1024)), texts, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-size:]


class Sizes:
    """Compressed sizes of a text with the two dictionaries."""

    def __init__(self, good: bytes, bad: bytes, level: int = LEVEL):
        self._c = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=level)
            self._c.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False,
                                                    write_content_size=False, write_dict_id=False))

    def difference(self, text: str | None) -> float:
        data = (text or "").encode("utf-8", "replace")
        if not data:
            return 0.0
        good, bad = (len(c.compress(data)) for c in self._c)
        return (bad - good) / len(data) ** 0.5


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> tuple:
    """(good dictionary, bad dictionary, slope, intercept)."""
    sample = labelled_sample(docs.filter(F.char_length("text") <= MAX_CHARS), labels, label, per_class)
    rows = sorted((r["doc_id"], r["y"], r["part"], r["text"]) for r in sample.collect())  # bounded
    built = [[t.encode("utf-8", "replace") for _, y, p, t in rows if p == 0 and y == k] for k in (1, 0)]
    good, bad = (build_dictionary(x) for x in built)
    sizes = Sizes(good, bad)
    rest = [(sizes.difference(t), y) for _, y, p, t in rows if p == 1]
    x, y = np.array([a for a, _ in rest]), np.array([b for _, b in rest], float)
    return good, bad, *platt(x, y, 0.5)


def score(docs: DataFrame, model: tuple) -> DataFrame:
    """doc_id, score and the size difference of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of fixed size

    def run(batches):
        good, bad, slope, intercept = shared.value
        sizes = Sizes(good, bad)
        for b in batches:
            x = np.fromiter((sizes.difference(t.as_py()) for t in b.column(1)), float, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(logistic(slope * x + intercept)), pa.array(x)],
                                             names=["doc_id", "score", "difference"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, difference double")


def op4_zstd_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    d = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return d.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
