"""Running a stream in turns: land rows, process what is there, go on.

A stream that is started with ``availableNow`` ends when it has read all that
is landed; started again from its checkpoint it goes on with what has come
since. Backfills, tests and the registered queries use this to fix what
arrives before what."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adherence.session import SHUFFLES_GO, settings

NOW = {"availableNow": True}

#: State lies on disk (RocksDB), with a bounded share of it in memory; Spark's
#: default keeps all of it in the heap, for two versions.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd"}


def in_turns(parts: Sequence[DataFrame], folder: str, start: Callable[[], StreamingQuery],
             each: Callable[[StreamingQuery], None] | None = None) -> None:
    """Append each of ``parts`` to ``folder`` and run the stream over it."""
    for part in parts:
        part.write.mode("append").parquet(folder)
        query = start()
        query.awaitTermination()
        if each is not None:
            each(query)


def parts_by(rows: DataFrame, order: str, n: int) -> list[DataFrame]:
    """``rows`` in ``n`` parts by ranges of a number column, lowest first."""
    low, high = rows.agg(F.min(order), F.max(order)).first()
    if low is None:
        return [rows]
    place = F.least(F.floor((F.col(order) - F.lit(low)) * n / F.lit(high - low + 1)), F.lit(n - 1))
    return [rows.filter(place == k) for k in range(n)]


def dropped_late(query: StreamingQuery) -> int:
    """Rows that the watermark kept out of a finished run's state. A windowed
    aggregate counts them after its map-side combine: one for each group,
    window and task."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])


def state_rows(query: StreamingQuery) -> int:
    """Rows of state at the end of a finished run."""
    last = [p for p in query.recentProgress if p["stateOperators"]]
    return sum(int(op["numRowsTotal"]) for op in last[-1]["stateOperators"]) if last else 0


def append_stream(rows: DataFrame, sink: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Rows of an append-mode stream into a Parquet folder, each once."""
    with settings(rows.sparkSession, SHUFFLES_GO | STATE_ON_DISK):  # a stream keeps the settings it is started with
        return (rows.writeStream.format("parquet").outputMode("append").option("path", sink).option("compression", "zstd")
                    .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start())
