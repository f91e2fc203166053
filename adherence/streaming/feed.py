"""Binary real-time feed (proto2) <-> nested DataFrame rows.

The message layout is declared here as a descriptor built from the public
field numbers; no generated module is used. Decoding runs in ``mapInArrow``:
Arrow batches in, Arrow batches out, one Python call per batch. It yields
one row per entity (a feed can be a whole network, so it is never kept as
one nested row), with NULL for every absent optional field (presence, not
default value), and a reject row with the error text for bytes that do not
parse. Everything after the decode is built-in Spark expressions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate, chain, compress, count, islice, repeat
from operator import attrgetter

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Message layout of the public real-time transit feed format
# (proto2). (field name, field number, type, label); label o=optional,
# r=required, * = repeated; type is a scalar name, a message or an enum.
PACKAGE = "adherence.rt"
ENUMS = {
    "Incrementality": [("FULL_DATASET", 0), ("DIFFERENTIAL", 1)],
    "StopRelationship": [("SCHEDULED", 0), ("SKIPPED", 1), ("NO_DATA", 2), ("UNSCHEDULED", 3)],
    "TripRelationship": [("SCHEDULED", 0), ("ADDED", 1), ("UNSCHEDULED", 2), ("CANCELED", 3),
                         ("REPLACEMENT", 5), ("DUPLICATED", 6), ("DELETED", 7), ("NEW", 8)],
    "VehicleStopStatus": [("INCOMING_AT", 0), ("STOPPED_AT", 1), ("IN_TRANSIT_TO", 2)],
}
MESSAGES = {
    "FeedMessage": [("header", 1, "FeedHeader", "r"), ("entity", 2, "FeedEntity", "*")],
    "FeedHeader": [("gtfs_realtime_version", 1, "string", "r"), ("incrementality", 2, "Incrementality", "o"),
                   ("timestamp", 3, "uint64", "o")],
    "FeedEntity": [("id", 1, "string", "r"), ("is_deleted", 2, "bool", "o"),
                   ("trip_update", 3, "TripUpdate", "o"), ("vehicle", 4, "VehiclePosition", "o")],
    "TripUpdate": [("trip", 1, "TripDescriptor", "r"), ("stop_time_update", 2, "StopTimeUpdate", "*"),
                   ("vehicle", 3, "VehicleDescriptor", "o"), ("timestamp", 4, "uint64", "o"),
                   ("delay", 5, "int32", "o")],
    "StopTimeEvent": [("delay", 1, "int32", "o"), ("time", 2, "int64", "o"), ("uncertainty", 3, "int32", "o"),
                      ("scheduled_time", 4, "int64", "o")],
    "StopTimeUpdate": [("stop_sequence", 1, "uint32", "o"), ("arrival", 2, "StopTimeEvent", "o"),
                       ("departure", 3, "StopTimeEvent", "o"), ("stop_id", 4, "string", "o"),
                       ("schedule_relationship", 5, "StopRelationship", "o")],
    "TripDescriptor": [("trip_id", 1, "string", "o"), ("start_time", 2, "string", "o"),
                       ("start_date", 3, "string", "o"), ("schedule_relationship", 4, "TripRelationship", "o"),
                       ("route_id", 5, "string", "o"), ("direction_id", 6, "uint32", "o")],
    "VehicleDescriptor": [("id", 1, "string", "o"), ("label", 2, "string", "o")],
    "Position": [("latitude", 1, "float", "r"), ("longitude", 2, "float", "r"), ("bearing", 3, "float", "o"),
                 ("odometer", 4, "double", "o"), ("speed", 5, "float", "o")],
    "VehiclePosition": [("trip", 1, "TripDescriptor", "o"), ("position", 2, "Position", "o"),
                        ("current_stop_sequence", 3, "uint32", "o"), ("current_status", 4, "VehicleStopStatus", "o"),
                        ("timestamp", 5, "uint64", "o"), ("stop_id", 7, "string", "o"),
                        ("vehicle", 8, "VehicleDescriptor", "o")],
}

_SCALAR_PB = {"string": 9, "bool": 8, "int32": 5, "uint32": 13, "int64": 3, "uint64": 4, "float": 2,
              "double": 1}
_SCALAR_SQL = {"string": "string", "bool": "boolean", "int32": "int", "uint32": "bigint", "int64": "bigint",
               "uint64": "bigint", "float": "float", "double": "double"}
_LABEL_PB = {"o": 1, "r": 2, "*": 3}

_CLASSES: dict[str, type] = {}


def _build_classes() -> dict[str, type]:
    """Message classes from the declared layout (built once per process)."""
    if _CLASSES:
        return _CLASSES
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    fdp = descriptor_pb2.FileDescriptorProto(name="adherence_rt.proto", package=PACKAGE, syntax="proto2")
    for ename, values in ENUMS.items():
        e = fdp.enum_type.add(name=ename)
        for vname, num in values:
            e.value.add(name=f"{ename.upper()}_{vname}", number=num)
    for mname, fields in MESSAGES.items():
        m = fdp.message_type.add(name=mname)
        for fname, num, ftype, label in fields:
            f = m.field.add(name=fname, number=num, label=_LABEL_PB[label])
            if ftype in _SCALAR_PB:
                f.type = _SCALAR_PB[ftype]
            elif ftype in ENUMS:
                f.type, f.type_name = 14, f".{PACKAGE}.{ftype}"
            else:
                f.type, f.type_name = 11, f".{PACKAGE}.{ftype}"
    pool = descriptor_pool.DescriptorPool()
    fd = pool.Add(fdp) if hasattr(pool, "Add") else None
    fd = pool.FindFileByName("adherence_rt.proto") if fd is None or not hasattr(fd, "message_types_by_name") else fd
    for mname in MESSAGES:
        _CLASSES[mname] = message_factory.GetMessageClass(pool.FindMessageTypeByName(f"{PACKAGE}.{mname}"))
    return _CLASSES


def message_class(name: str) -> type:
    return _build_classes()[name]


# ------------------------------------------------------------ Spark schemas
def _sql_type(ftype: str, depth: int = 0) -> str:
    if ftype in _SCALAR_SQL:
        return _SCALAR_SQL[ftype]
    if ftype in ENUMS:
        return "string"
    inner = ", ".join(f"`{n}`: {_field_sql(t, lab)}" for n, _, t, lab in MESSAGES[ftype])
    return f"struct<{inner}>"


def _field_sql(ftype: str, label: str) -> str:
    t = _sql_type(ftype)
    return f"array<{t}>" if label == "*" else t


def message_ddl(name: str) -> str:
    """Spark type (DDL) of a message."""
    return _sql_type(name)


_CHECKED: dict[str, list] = {}


def _checked_fields(mname: str) -> list:
    """The fields of a message that hold, at some depth, text or an unsigned
    64-bit number."""
    if mname not in _CHECKED:
        _CHECKED[mname] = [(fname, ftype, label) for fname, _, ftype, label in MESSAGES[mname]
                           if ftype in ("string", "uint64") or ftype in MESSAGES and _checked_fields(ftype)]
    return _CHECKED[mname]


def check_values(msg, mname: str) -> None:
    """Raise where a field cannot be a Spark value: an unsigned 64-bit number
    of 2^63 or more, or text that is not UTF-8."""
    for fname, ftype, label in _checked_fields(mname):
        if label == "*":
            if ftype in MESSAGES:
                for item in getattr(msg, fname):
                    check_values(item, ftype)
        elif msg.HasField(fname):
            v = getattr(msg, fname)
            if ftype in MESSAGES:
                check_values(v, ftype)
            elif ftype == "uint64":
                if v >= 1 << 63:
                    raise ValueError(f"{mname}.{fname} is out of range: {v}")
            else:
                (v.decode("utf-8") if isinstance(v, bytes) else v.encode("utf-8"))


# ------------------------------------------------------------ decode
FEED_META_DDL = ("header struct<gtfs_realtime_version: string, incrementality: string, timestamp: bigint>")


def _decoded_ddl(root: str, level: str, passthrough: list[tuple[str, str]]) -> str:
    pt = [f"`{n}` {t}" for n, t in passthrough]
    if root == "FeedMessage" and level == "entity":
        body = [FEED_META_DDL, "entity_pos int", f"entity {message_ddl('FeedEntity')}"]
    elif root == "FeedMessage":
        body = [FEED_META_DDL, f"entity array<{message_ddl('FeedEntity')}>"]
    else:
        body = [f"message {message_ddl(root)}"]
    return ", ".join(pt + body + ["decode_error string"])


def decode(df: DataFrame, value_col: str = "value", root: str = "FeedMessage", level: str = "entity",
           keep: Sequence[str] | None = None) -> DataFrame:
    """Decode binary messages.

    ``root`` is the message each record holds (``FeedMessage`` for whole
    feeds, ``TripUpdate`` for bare trip updates). For feeds, ``level='entity'``
    gives one row per entity with ``entity_pos`` (P5 done while decoding,
    so a huge feed never becomes one row), ``level='feed'`` one row per
    feed. Columns in ``keep`` (default: all but the value) are passed
    through. Records that fail to parse give one row with ``decode_error``
    set and NULL payload; see ``split_rejects``."""
    if root not in MESSAGES:
        raise ValueError(f"unknown message {root!r}")
    keep = [c for c in (keep if keep is not None else df.columns) if c != value_col]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    passthrough = [(c, types[c]) for c in keep]
    out_ddl = _decoded_ddl(root, level, passthrough)
    src = df.select(*keep, F.col(value_col).alias("__value"))
    arrow_schema = _arrow_schema(out_ddl)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            yield from _decoded_batch(batch, keep, root, level, arrow_schema)

    return src.mapInArrow(run, out_ddl)


#: Bounds of what is decoded at once: entities (of a longer feed, entity rows
#: leave in slices of as many), and bytes of records.
CHUNK_ENTITIES, CHUNK_BYTES = 8192, 4 << 20


def _decoded_batch(batch, keep: Sequence[str], root: str, level: str, schema) -> Iterator:
    """The rows of a batch of records, column by column."""
    cls = message_class(root)
    parsed, errors, entities, size = [], [], 0, 0
    for i, value in enumerate(batch.column("__value")):
        raw = value.as_py()
        try:
            if raw is None:
                raise ValueError("no value")
            msg = cls()
            msg.ParseFromString(raw)
            parsed.append((i, msg))
        except Exception as ex:  # noqa: BLE001 - a bad record becomes a reject row
            errors.append((i, f"{type(ex).__name__}: {ex}"))
            continue
        entities += len(msg.entity) if root == "FeedMessage" else 1
        size += len(raw)
        if entities >= CHUNK_ENTITIES or size >= CHUNK_BYTES:
            yield from _decoded_rows(batch, keep, parsed, errors, root, level, schema)
            parsed, errors, entities, size = [], [], 0, 0
    yield from _decoded_rows(batch, keep, parsed, errors, root, level, schema)


def _decoded_rows(batch, keep, parsed: list, errors: list, root: str, level: str, schema) -> Iterator:
    """Everything that can fail is done before the first row leaves, so a bad
    record gives one reject row and nothing else."""
    import pyarrow as pa
    kinds = [schema.field(k).type for k in range(len(keep), len(schema.names) - 1)]
    try:
        payloads = list(_payloads(parsed, root, level, kinds))
    except Exception:  # noqa: BLE001 - find the records with a value that is none
        good = []
        for i, msg in parsed:
            try:
                check_values(msg, root)
                good.append((i, msg))
            except Exception as ex:  # noqa: BLE001
                errors.append((i, f"{type(ex).__name__}: {ex}"))
        payloads = list(_payloads(good, root, level, kinds))
    if errors:
        payloads.append(([i for i, _ in errors], [pa.nulls(len(errors), kind) for kind in kinds]))
    for k, (rows, columns) in enumerate(payloads):
        at = pa.array(rows, pa.int32())
        told = [e for _, e in errors] if errors and k == len(payloads) - 1 else [None] * len(rows)
        if rows:
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in keep), *columns, pa.array(told, pa.string())],
                                             schema=schema)


def _payloads(parsed: list, root: str, level: str, kinds: list) -> Iterator[tuple[list[int], list]]:
    """Places in the batch and payload columns of parsed records."""
    import pyarrow as pa
    rows, msgs = [i for i, _ in parsed], [m for _, m in parsed]
    if root != "FeedMessage":
        yield rows, [_structs(msgs, root, kinds[0])]
        return
    headers = _structs([m.header for m in msgs], "FeedHeader", kinds[0])
    if level == "feed":
        yield rows, [headers, _field(msgs, "entity", "FeedEntity", "*", kinds[1])]
        return
    found = ((k, pos, e) for k, m in enumerate(msgs) for pos, e in enumerate(m.entity))
    while part := list(islice(found, CHUNK_ENTITIES)):
        of, places, entities = zip(*part)
        yield [rows[k] for k in of], [headers.take(pa.array(of, pa.int32())), pa.array(places, kinds[1]),
                                      _structs(entities, "FeedEntity", kinds[2])]


def _structs(msgs: Sequence, mname: str, kind):
    """Messages as an Arrow struct array; an absent optional field is null."""
    import pyarrow as pa
    if not msgs:
        return pa.array([], kind)
    return pa.StructArray.from_arrays([_field(msgs, fname, ftype, label, kind.field(k).type)
                                       for k, (fname, _, ftype, label) in enumerate(MESSAGES[mname])], fields=list(kind))


def _field(msgs: Sequence, fname: str, ftype: str, label: str, kind):
    """One field of all messages as an Arrow array."""
    import pyarrow as pa
    get = attrgetter(fname)
    if label == "*":
        lists = [get(m) for m in msgs]
        items = list(chain.from_iterable(lists))
        values = _structs(items, ftype, kind.value_type) if ftype in MESSAGES else pa.array(items, kind.value_type)
        return pa.ListArray.from_arrays(pa.array(accumulate(map(len, lists), initial=0), pa.int32()), values, type=kind)
    has, held = None, []
    if ftype not in MESSAGES and msgs[0].HasField(fname):
        held = list(map(get, msgs))  # a field that differs from its default is there
        has = repeat(True) if ftype not in ENUMS and all(held) else None
    if has is None:
        has = list(map(type(msgs[0]).HasField, msgs, repeat(fname)))
        held = list(map(get, compress(msgs, has)))
    if not held:
        return pa.nulls(len(msgs), kind)
    if ftype in ENUMS:
        names = {num: name for name, num in ENUMS[ftype]}
        held = [names.get(v) or str(v) for v in held]
    values = _structs(held, ftype, kind) if ftype in MESSAGES else pa.array(held, kind)
    if len(held) == len(msgs):
        return values
    place = count()
    return values.take(pa.array([next(place) if h else None for h in has], pa.int32()))


def first_update(raw):
    """The first trip update of a feed's bytes; None for a feed without one
    and for bytes that do not decode."""
    try:
        feed = message_class("FeedMessage")()
        feed.ParseFromString(raw if isinstance(raw, bytes) else bytes(raw))
        found = next((e.trip_update for e in feed.entity if e.HasField("trip_update")), None)
        if found is not None:
            _check_trip_update(found)
        return found
    except Exception:  # noqa: BLE001 - a bad record has no update
        return None


def _check_trip_update(update) -> None:
    """``check_values`` for the usual case: what a field holds is read once,
    and a text that is empty or a number of 0 cannot be wrong."""
    trip = update.trip
    "".join((trip.trip_id, trip.start_time, trip.start_date, trip.route_id,
             *[s.stop_id for s in update.stop_time_update]))  # a text that is not UTF-8 comes as bytes
    if update.timestamp >= 1 << 63 or update.HasField("vehicle"):
        check_values(update, "TripUpdate")


def _arrow_schema(ddl: str):
    """Arrow schema of a Spark DDL string, built on the driver (parsing DDL
    needs the JVM) and shipped to the workers inside the closure."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    return to_arrow_schema(_parse_datatype_string(ddl))


def split_rejects(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, reject rows) of a decoded frame."""
    good = decoded.filter(F.col("decode_error").isNull()).drop("decode_error")
    bad = decoded.filter(F.col("decode_error").isNotNull())
    return good, bad


def checked(df: DataFrame, value_col: str = "value", root: str = "FeedMessage") -> DataFrame:
    """S9 for given bytes: ``df`` with ``n_entities`` (null for other roots) and
    ``decode_error``, null where the bytes are a message that can be published.
    The bytes stay as they are; nothing is unfolded into rows."""
    names = df.columns
    out = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + ["n_entities int", "decode_error string"])
    schema = _arrow_schema(out)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        cls = message_class(root)
        for batch in batches:
            sizes, errors = [], []
            for value in batch.column(value_col):
                raw, size, error = value.as_py(), None, None
                try:
                    if raw is None:
                        raise ValueError("no value")
                    msg = cls()
                    msg.ParseFromString(raw)
                    check_values(msg, root)
                    size = len(msg.entity) if root == "FeedMessage" else None
                except Exception as ex:  # noqa: BLE001 - bad bytes are a reject
                    error = f"{type(ex).__name__}: {ex}"
                sizes.append(size)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sizes, pa.int32()),
                                              pa.array(errors, pa.string())], schema=schema)

    return df.mapInArrow(run, out)


def publish_checked(feeds: DataFrame, publish, value_col: str = "value", root: str = "FeedMessage") -> DataFrame:
    """Hand the good records to ``publish`` (a function of a frame, such as
    ``land_records`` with its folder); the rejects with their error."""
    from adherence.session import checkpointed
    rows = checkpointed(checked(feeds, value_col, root))  # parsed once for both
    publish(rows.filter("decode_error IS NULL").drop("decode_error", "n_entities"))
    return rows.filter("decode_error IS NOT NULL").drop("n_entities")


# ------------------------------------------------------------ encode
def _fill(msg, mname: str, data: dict) -> None:
    for fname, _, ftype, label in MESSAGES[mname]:
        v = data.get(fname)
        if v is None:
            continue
        if label == "*":
            for item in v:
                if ftype in MESSAGES:
                    _fill(getattr(msg, fname).add(), ftype, item)
                else:
                    getattr(msg, fname).append(item)
        elif ftype in MESSAGES:
            _fill(getattr(msg, fname), ftype, v)
        elif ftype in ENUMS:
            setattr(msg, fname, dict(ENUMS[ftype])[v] if isinstance(v, str) else int(v))
        else:
            setattr(msg, fname, v)


def encode_message(data: dict, mname: str = "FeedMessage") -> bytes:
    """Serialize nested dicts as a message (tests and fixtures)."""
    msg = message_class(mname)()
    _fill(msg, mname, data)
    return msg.SerializeToString()


ENCODE_INPUT = ("feed_key", "feed_ts", "trip_id", "route_id", "start_date", "trip_delay", "stop_id",
                "stop_sequence", "arrival_time", "departure_time")


def encode_feeds(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Flat stop updates -> binary feeds (``value``) with ``feed_key``
    and ``feed_ts``.

    Input columns: ``feed_key`` (one feed per key), ``feed_ts`` (header
    time), ``trip_id``, ``route_id``, ``start_date``, ``trip_delay``,
    ``stop_id``, ``stop_sequence``, ``arrival_time``, ``departure_time``
    (NULL = absent). Rows are hash-partitioned on the feed key and sorted,
    so the encoder streams through them: one entity per trip, one feed per
    key. The message of the current feed is held in memory, as a feed is one
    record in the end."""
    df = rows.select(*[F.col(c) for c in ENCODE_INPUT])
    df = (df.repartition(partitions, "feed_key") if partitions else df.repartition("feed_key"))
    # By the key's hash first: the texts of keys often begin alike.
    df = df.sortWithinPartitions(F.xxhash64("feed_key"), "feed_key", "trip_id", "stop_sequence", "stop_id", "arrival_time",
                                 "departure_time")
    out_ddl = "feed_key string, feed_ts bigint, value binary, n_entities int, n_stops int"

    return df.mapInArrow(lambda batches: _feed_batches(batches), out_ddl)


def _feed_chunks(batches: Iterator) -> Iterator[list]:
    """The feeds of sorted rows as lists of (key, time, bytes, entities, stops)."""
    for part in _feed_batches(batches):
        yield list(zip(*(c.to_pylist() for c in part.columns)))


def _feed_batches(batches: Iterator) -> Iterator:
    """Record batches of whole feeds of sorted rows, of bounded number and size;
    the rows of a feed that goes on are kept until it ends."""
    import pyarrow as pa
    kept: list = []
    for batch in batches:
        for lo in range(0, batch.num_rows, 2 * CHUNK_ENTITIES):
            part = batch.slice(lo, 2 * CHUNK_ENTITIES)
            key = part.column("feed_key")
            last = int(_runs(key)[-1])  # the rows before are of feeds that have ended
            ended = last or kept and not key[0].equals(kept[-1].column("feed_key")[-1])
            if ended:
                yield from _encoded(pa.Table.from_batches([*kept, part.slice(0, last)]))
                kept = []
            kept.append(part.slice(last))
    if kept:
        yield from _encoded(pa.Table.from_batches(kept))


def _encoded(rows) -> Iterator:
    """Record batches of the feeds of ``rows``, cut by their size."""
    out = _feeds(rows)
    lo, sizes = 0, np.cumsum(pc.binary_length(out.column("value")).to_numpy())
    while lo < out.num_rows:
        hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + CHUNK_BYTES, "right")))
        yield out.slice(lo, hi - lo)
        lo = hi


def _runs(*columns) -> np.ndarray:
    """Where runs of equal values (null equals null) of the columns begin."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        if n > 1:
            here, before = c.slice(1), c.slice(0, n - 1)
            changed = pc.fill_null(pc.not_equal(here, before), False)
            new[1:] |= pc.or_(changed, pc.xor(pc.is_null(here), pc.is_null(before))).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


class _Bytes:
    """Byte strings, one a row, as pieces that are written once all lengths are
    known. A piece is (rows, places in the joined strings, what stands there): a
    byte, numbers to be written as varints, or (bytes, starts, lengths)."""

    def __init__(self, sizes: np.ndarray, pieces: list):
        self.sizes, self.pieces = sizes, pieces

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    @classmethod
    def of(cls, sizes: np.ndarray, what) -> _Bytes:
        return cls(sizes, [(np.arange(len(sizes)), np.cumsum(sizes) - sizes, what)])

    @classmethod
    def varints(cls, values: np.ndarray) -> _Bytes:
        return cls.of(_varint_sizes(values), values)

    @classmethod
    def texts(cls, column) -> _Bytes:
        """A column of text; null is empty."""
        c = column.fill_null("")
        at = np.frombuffer(c.buffers()[1], np.int32)[c.offset: c.offset + len(c) + 1].astype(np.int64)
        data = np.frombuffer(c.buffers()[2], np.uint8) if c.buffers()[2] is not None else np.empty(0, np.uint8)
        return cls.of(np.diff(at), (data, at[:-1], np.diff(at)))

    def field(self, number: int, there: np.ndarray | None = None, length: bool = True) -> _Bytes:
        """Each as a field: its tag, its length (not for numbers) and itself;
        nothing where it is not ``there``."""
        tag = _Bytes.of(np.ones(len(self.sizes), np.int64), number << 3 | 2 * length)
        out = _Bytes.rowwise(tag, *([_Bytes.varints(self.sizes)] if length else []), self)
        if there is None or there.all():
            return out
        sizes = np.where(there, out.sizes, 0)
        shift = np.cumsum(sizes) - sizes - out.starts
        pieces = []
        for rows, at, what in out.pieces:
            keep = there[rows]
            what = what if isinstance(what, int) else what[keep] if isinstance(what, np.ndarray) else \
                (what[0], what[1][keep], what[2][keep])
            pieces.append((rows[keep], (at + shift[rows])[keep], what))
        return _Bytes(sizes, pieces)

    @classmethod
    def rowwise(cls, *parts: _Bytes) -> _Bytes:
        """The parts of each row, joined."""
        sizes = sum(p.sizes for p in parts)
        to, pieces = np.cumsum(sizes) - sizes, []
        for p in parts:
            shift = to - p.starts
            pieces += [(rows, at + shift[rows], what) for rows, at, what in p.pieces]
            to = to + p.sizes
        return cls(sizes, pieces)

    def grouped(self, starts: np.ndarray) -> _Bytes:
        """The rows from each of ``starts`` to the next, joined."""
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(self.sizes))))
        return _Bytes(np.add.reduceat(self.sizes, starts), [(group[rows], at, what) for rows, at, what in self.pieces])

    def array(self):
        import pyarrow as pa
        total = int(self.sizes.sum())
        if total >= 1 << 31:
            raise ValueError("feeds of 2 GB or more cannot be one record")
        data = np.empty(total, np.uint8)
        for _, at, what in self.pieces:
            if isinstance(what, int):
                data[at] = what
            elif isinstance(what, tuple):
                source, starts, sizes = what
                step = np.arange(int(sizes.sum()))
                own = np.cumsum(sizes) - sizes
                data[np.repeat(at - own, sizes) + step] = source[np.repeat(starts - own, sizes) + step]
            else:
                v, left = what.astype(np.uint64), _varint_sizes(what)
                while len(v):
                    data[at] = (v & np.uint64(0x7F)).astype(np.uint8) | ((left > 1) << 7).astype(np.uint8)
                    more = left > 1
                    at, v, left = at[more] + 1, v[more] >> np.uint64(7), left[more] - 1
        at = np.concatenate(([0], np.cumsum(self.sizes))).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(self.sizes), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data.tobytes())])


def _varint_sizes(values: np.ndarray) -> np.ndarray:
    v = values.astype(np.uint64)
    sizes, highest, k = np.ones(len(v), np.int64), v.max(initial=0), 1
    while k < 10 and highest >= 1 << 7 * k:
        sizes += v >= np.uint64(1 << 7 * k)
        k += 1
    return sizes


def _numbers(column, number: int, lowest: int, highest: int) -> _Bytes:
    """A column of whole numbers as a field; a null is left out."""
    v, there = column.cast("int64").fill_null(0).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
    if len(v) and not lowest <= v.min() <= v.max() <= highest:
        raise ValueError(f"Value out of range: {v.min()} to {v.max()}")
    return _Bytes.varints(v).field(number, there, length=False)


def _text(column):
    """``str`` of each value."""
    import pyarrow as pa
    if pa.types.is_integer(column.type) or pa.types.is_string(column.type):
        return column.cast("string")
    return pa.array([None if v is None else str(v) for v in column.to_pylist()], pa.string())


def _feeds(rows):
    """The feeds of sorted rows as a record batch, a feed for each run of its key
    and an entity for each run of a trip in it. The messages are written from
    the inside out, all of a level at once: a message is its fields, each with
    its tag and, but for numbers, its length before it."""
    import pyarrow as pa
    c = {name: rows.column(name).combine_chunks() for name in ENCODE_INPUT}
    feeds, entities = _runs(c["feed_key"]), _runs(c["feed_key"], c["trip_id"])
    long = (-(1 << 63), (1 << 63) - 1)

    def text(column, number):
        return _Bytes.texts(column).field(number, column.is_valid().to_numpy(zero_copy_only=False))

    def event(column, number):
        time = _numbers(column, 2, *long)
        return time.field(number, time.sizes > 0)

    stops = _Bytes.rowwise(_numbers(c["stop_sequence"], 1, 0, (1 << 32) - 1), event(c["arrival_time"], 2),
                           event(c["departure_time"], 3), text(_text(c["stop_id"]), 4))
    of = {name: c[name].take(pa.array(entities)) for name in ("trip_id", "route_id", "start_date", "trip_delay")}
    trip_id = _text(of["trip_id"])
    trip = _Bytes.rowwise(text(trip_id, 1), text(_text(of["start_date"]), 3), text(_text(of["route_id"]), 5))
    if not trip.sizes.all():
        raise ValueError("Message FeedMessage is missing required fields: a trip has no id, route and start date")
    update = _Bytes.rowwise(trip.field(1), stops.field(2).grouped(entities), _numbers(of["trip_delay"], 5, -(1 << 31), (1 << 31) - 1))
    body = _Bytes.rowwise(_Bytes.texts(trip_id.fill_null("None")).field(1), update.field(3))
    time = c["feed_ts"].take(pa.array(feeds))
    version = _Bytes.texts(pa.array(["2.0"] * len(feeds), pa.string())).field(1)
    header = _Bytes.rowwise(version, _numbers(time, 3, 0, long[1]))
    first = np.searchsorted(entities, feeds)  # the feeds' first entities
    value = _Bytes.rowwise(header.field(1), body.field(2).grouped(first))
    counts = (np.diff(np.append(x, n)) for x, n in ((first, len(entities)), (feeds, rows.num_rows)))
    return pa.RecordBatch.from_arrays([c["feed_key"].take(pa.array(feeds)), time, value.array(),
                                       *(pa.array(n, pa.int32()) for n in counts)], schema=_enc_schema())


def _enc_schema():
    import pyarrow as pa
    return pa.schema([("feed_key", pa.string()), ("feed_ts", pa.int64()), ("value", pa.binary()),
                      ("n_entities", pa.int32()), ("n_stops", pa.int32())])


def split_trip_updates(feeds: DataFrame, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Feeds -> one record per trip update (bare ``TripUpdate`` bytes), the
    record format a trip-update log job reads. Bad feeds give no records."""
    keep = list(keep)
    types = {f.name: f.dataType.simpleString() for f in feeds.schema.fields}
    out_ddl = ", ".join([f"`{c}` {types[c]}" for c in keep] + ["entity_pos int", "value binary"])
    src = feeds.select(*keep, F.col(value_col).alias("__value"))
    schema = _arrow_schema(out_ddl)

    def run(batches):
        import pyarrow as pa
        cls = message_class("FeedMessage")
        for batch in batches:
            rows, places, values, size = [], [], [], 0

            def records():
                at = pa.array(rows, pa.int32())
                return pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in keep), pa.array(places, pa.int32()),
                                                   pa.array(values, pa.binary())], schema=schema)

            for i, value in enumerate(batch.column("__value")):
                m = cls()
                try:
                    m.ParseFromString(value.as_py())
                except Exception:  # noqa: BLE001
                    continue
                for pos, e in enumerate(m.entity):
                    if e.HasField("trip_update"):
                        rows.append(i)
                        places.append(pos)
                        values.append(e.trip_update.SerializeToString())
                        size += len(values[-1])
                        if len(rows) >= CHUNK_ENTITIES or size >= CHUNK_BYTES:
                            yield records()
                            rows, places, values, size = [], [], [], 0
            if rows:
                yield records()

    return src.mapInArrow(run, out_ddl)
