"""Vehicle positions (R3): feeds made from flat positions, and a stream that
takes each position once."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.streaming.feed import decode, encode_message, split_rejects
from adherence.streaming.flatten import vehicle_positions

POSITION = ("latitude", "longitude", "bearing", "speed")
INPUT = ("feed_key", "feed_ts", "vehicle_id", "vehicle_label", "trip_id", "route_id", *POSITION, "current_stop_sequence",
         "current_status", "stop_id", "vehicle_ts")


def _entity(row: dict) -> dict:
    """A vehicle's entity; what is null stays absent."""
    some = lambda d: {k: v for k, v in d.items() if v is not None} or None
    return {"id": str(row["vehicle_id"]), "vehicle": {
        "vehicle": some({"id": row["vehicle_id"], "label": row["vehicle_label"]}),
        "trip": some({"trip_id": row["trip_id"], "route_id": row["route_id"]}),
        "position": some({k: row[k] for k in POSITION}),
        **{k: row[k] for k in ("current_stop_sequence", "current_status", "stop_id")}, "timestamp": row["vehicle_ts"]}}


def encode_vehicle_feeds(rows: DataFrame) -> DataFrame:
    """Flat positions (columns ``INPUT``) -> one feed per ``feed_key``, with
    one entity per row in order of vehicle and time. Rows are dealt by feed and
    sorted, so a task holds one feed at a time."""
    df = rows.select(*INPUT).repartition("feed_key").sortWithinPartitions("feed_key", "vehicle_id", "vehicle_ts")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def made(key, ts, entities):
            header = {"gtfs_realtime_version": "2.0", "timestamp": ts}
            return {"feed_key": key, "feed_ts": ts, "value": encode_message({"header": header, "entity": entities})}

        key = ts = None
        entities: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["feed_key"] != key and entities:
                    out.append(made(key, ts, entities))
                    entities = []
                key, ts = row["feed_key"], row["feed_ts"]
                entities.append(_entity(row))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema())
        if entities:
            yield pa.RecordBatch.from_pylist([made(key, ts, entities)], schema=schema())

    def schema():
        import pyarrow as pa
        return pa.schema([("feed_key", pa.string()), ("feed_ts", pa.int64()), ("value", pa.binary())])

    return df.mapInArrow(run, "feed_key string, feed_ts bigint, value binary")


def positions_once(records: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """A stream of feed records -> vehicle positions, each (vehicle, time) once:
    a position that a later feed repeats is dropped as long as the watermark
    has not passed it, and so is its state after that. A position without a
    time of its own has its feed's."""
    good, _ = split_rejects(decode(records, keep=[]))
    at = F.coalesce("vehicle_ts", "feed_ts")
    seen = vehicle_positions(good).withColumn("vehicle_ts", at).withColumn("seen_at", F.timestamp_seconds("vehicle_ts"))
    return (seen.withWatermark("seen_at", watermark).dropDuplicatesWithinWatermark(["vehicle_id", "vehicle_ts"])
                .drop("seen_at"))
