"""Operator 2: SimHash near-dedup with bit-sliced comparison.

Fingerprints: texts in lower case (A-Z only), words ``[^\\x20\\x09-\\x0D]+``,
4-word shingles with repeats, XXH64 (seed 42) of each; a bit is set where over
half of the hashes have it. Fingerprints link at ``RADIUS`` or fewer differing
bits; a component is what links reach.

Candidates: of 5 bands of a fingerprint's 64 bits, at least one is equal in
two fingerprints that differ in 4 bits. Distinct fingerprints are grouped by
(band, value). A group that holds more than ``CAP`` fingerprints is cut by 5
sub-bands of the remaining bits (again one is equal), up to three levels; what
is still larger is cut into chunks, and pairs of chunks are compared. All of
this is exact: nothing is capped or dropped.

Comparison: in a task, sorted fingerprints are stored as vertical bit planes,
64 lanes to a machine word. Each (fingerprint, block) pair XORs plane by plane
and counts the differing bits of all 64 lanes at once in carry-save binary
counters; pairs whose lanes have all gone beyond the radius are abandoned
every few planes. Links are united inside the task, which returns at most one
edge per fingerprint and never all pairs of a group.

Components: edges are contracted in rounds, every node hooking on to its
neighbour with the smallest hash of that round, until none are left. Nothing
but edges and labels moves, and nothing is collected on the driver.

Defined results: a null or blank text has fingerprint zero and is linked like
any other; a null doc_id belongs to its component, whose id is the smallest
doc_id that is not null; repeated rows get one row each; an empty table gives
no rows; other columns are ignored by the query, and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adherence.llm.common import checkpointed, salted_join, table

SHINGLE = 4
RADIUS = 4
CAP = 8192
#: Fingerprints that one comparison task should get.
TASK_ROWS = 16384
LEVELS = 3
_FEW = 1 << 18  # shingles hashed at a time


# ------------------------------------------------------------ fingerprints
def shingle_hashes(text: str, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of the shingles, in bounded batches of 8-byte rows."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return
    joined = b" ".join(words)
    if len(words) <= size:
        yield np.frombuffer(xxhash.xxh64_digest(joined, 42), np.uint8).reshape(1, 8)
        return
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))[: len(words) - size + 1]
    ends = np.concatenate((gaps, [len(joined)]))[size - 1:]
    digest = xxhash.xxh64_digest
    for at in range(0, len(starts), _FEW):
        found = [digest(joined[a:b], 42) for a, b in zip(starts[at:at + _FEW].tolist(), ends[at:at + _FEW].tolist())]
        yield np.frombuffer(b"".join(found), np.uint8).reshape(-1, 8)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint as an unsigned number."""
    ones, n = np.zeros(64, np.int64), 0
    for rows in shingle_hashes(text or "", size):
        n += len(rows)
        for at in range(0, len(rows), 255):  # sums of up to 255 bits fit a byte
            part = np.unpackbits(rows[at:at + 255], axis=1)
            ones += np.add.reduce(part, axis=0, dtype=np.uint8)
    if not n:
        return 0
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, row, fp): ``row`` is a hash of the text, ``fp`` the
    fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(x.as_py(), size) for x in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "row", "fp"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, row long, fp long")


# -------------------------------------------------------------- comparison
def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(64, blocks) words: bit l of word [p, b] is bit p (from the highest)
    of fingerprint 64 * b + l."""
    blocks = -(-len(fps) // 64)
    padded = np.zeros(blocks * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.astype(">u8").view(np.uint8).reshape(blocks, 64, 8), axis=2)
    lanes = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(lanes).view("<u8").reshape(64, blocks).astype(np.uint64)


def linked_pairs(fps: np.ndarray, ends: np.ndarray, radius: int = RADIUS, chunk: int = 1 << 16):
    """Yield index arrays (a, b), a < b < ends[a], of fingerprints within the
    radius; ``ends[a]`` is where the group of fingerprint ``a`` ends."""
    n = len(fps)
    planes = bit_planes(fps)
    at = np.arange(n, dtype=np.int64)
    first, last = (at + 1) // 64, (ends - 1) // 64
    count = np.where(ends > at + 1, last - first + 1, 0)
    upto = np.cumsum(count)
    one, full = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)
    for lo in range(0, int(upto[-1]) if n else 0, chunk):
        pair = np.arange(lo, min(lo + chunk, int(upto[-1])))
        q = np.searchsorted(upto, pair, "right")
        block = first[q] + pair - (upto[q] - count[q])
        # Lanes of the block that lie in (q, end of its group).
        begin = np.clip(q + 1 - 64 * block, 0, 64).astype(np.uint64)
        stop = np.clip(ends[q] - 64 * block, 0, 64).astype(np.uint64)
        below = np.where(stop == 64, full, (one << (stop % np.uint64(64))) - one)
        alive = below & ~np.where(begin == 64, full, (one << (begin % np.uint64(64))) - one)
        fp = fps[q]
        counters = [np.zeros(len(q), np.uint64) for _ in range(3)]
        for p in range(64):
            bit = (fp >> np.uint64(63 - p)) & one
            carry = planes[p, block] ^ (np.uint64(0) - bit)
            for k in range(3):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            # A carry out is 8; the radius is compared with the 3-bit count.
            alive &= ~(carry | _beyond(counters, radius))
            if p % 4 == 3:
                keep = np.flatnonzero(alive)
                if not len(keep):
                    break
                if len(keep) < len(alive):
                    q, block, fp, alive = q[keep], block[keep], fp[keep], alive[keep]
                    counters = [c[keep] for c in counters]
        hit = np.flatnonzero(alive)
        if len(hit):
            lanes = np.unpackbits(alive[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, lane = np.nonzero(lanes)
            yield q[hit][row], 64 * block[hit][row] + lane


def _beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose 3-bit count is over the radius (at most 6)."""
    c0, c1, c2 = counters
    if radius == 4:
        return c2 & (c0 | c1)
    out = np.zeros_like(c0)
    for v in range(radius + 1, 8):
        m = ~np.zeros_like(c0)
        for k, c in enumerate((c0, c1, c2)):
            m &= c if v >> k & 1 else ~c
        out |= m
    return out


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked items one label, in place: the smallest index."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:  # pointer jumping
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def edges_in_group(fps: np.ndarray, keys: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(fp, fp of its root) for linked fingerprints with equal keys."""
    order = np.lexsort((fps, keys))
    fps, keys = fps[order], keys[order]
    ends = np.searchsorted(keys, keys, "right")
    label = np.arange(len(fps))
    for a, b in linked_pairs(fps, ends, radius):
        unite(label, a, b)
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


# -------------------------------------------------------------- candidates
def band_masks(levels: int = LEVELS, bands: int = RADIUS + 1) -> list[list[int]]:
    """masks[l][path]: bits fixed by that path of bands; the path of child c
    of path p is bands * p + c."""
    def split(bits: list[int]) -> list[list[int]]:
        return [list(x) for x in np.array_split(np.array(bits), bands)]

    out, paths = [], [(0, list(range(64)))]
    for _ in range(levels):
        paths = [(used | sum(1 << int(b) for b in part), [b for b in rest if b not in part])
                 for used, rest in paths for part in split(rest)]
        out.append([used for used, _ in paths])
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(nodes: DataFrame, cap: int = CAP, task_rows: int = TASK_ROWS, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``nodes.fp`` that connect
    all that are within the radius. ``nodes`` is read several times."""
    bands = radius + 1
    masks = band_masks(bands=bands)
    n = nodes.count()
    groups = max(1, -(-n // task_rows))  # tasks per band; follows the data
    rows = nodes.select("fp").withColumn("path", F.lit(0))
    ready = []
    for level in range(LEVELS):
        children = F.array(*[F.struct(F.lit(i).alias("path"), F.lit(_signed(m)).alias("mask"))
                             for i, m in enumerate(masks[level])])
        keyed = rows.select("fp", F.explode(F.slice(children, F.col("path") * bands + 1, bands)).alias("c"))
        keyed = keyed.select("fp", F.col("c.path").alias("path"), F.col("fp").bitwiseAND(F.col("c.mask")).alias("key"))
        hot = keyed.groupBy("path", "key").agg(F.count("*").alias("m")).filter(F.col("m") > cap)
        hot = checkpointed(hot)
        if hot.isEmpty():
            ready.append(keyed)
            break
        ready.append(keyed.join(hot, ["path", "key"], "left_anti").select("fp", "path", "key"))
        rows = keyed.join(hot, ["path", "key"])
    else:
        # Chunks of a group of m; a pair of chunks is a task's work.
        k = F.ceil(F.col("m") / (cap // 2)).cast("int")
        c = F.pmod(F.xxhash64("fp"), k).cast("int")
        pair = F.transform(F.sequence(F.lit(0), k - 1),
                           lambda j: F.struct(F.least(c, j).alias("i"), F.greatest(c, j).alias("j")))
        chunked = rows.select("fp", "path", "key", F.explode(pair).alias("p"))
        ready.append(chunked.select("fp", "path", F.xxhash64("key", "p.i", "p.j").alias("key")))

    def compare(rows: pa.Table) -> pa.Table:
        fps = rows.column("fp").to_numpy().view(np.uint64)
        a, b = edges_in_group(fps, rows.column("key").to_numpy(), radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    out = None
    for level, keyed in enumerate(ready):
        # A few thousand fingerprints to a task; equal keys go together.
        task = F.pmod(F.xxhash64("key"), F.lit(groups))
        part = (keyed.withColumns({"level": F.lit(level), "task": task}).groupBy("level", "path", "task")
                     .applyInArrow(compare, "a long, b long"))
        out = part if out is None else out.unionByName(part)
    return out


# -------------------------------------------------------------- components
def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); equal roots, equal
    component."""
    e = checkpointed(edges.filter("a <> b").distinct())
    nodes = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
    steps = []
    while not e.isEmpty():
        turn = F.lit(len(steps))
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", turn).alias("h"), F.col("b").alias("b"))).alias("m"))
        up = near.select(F.col("a").alias("node"),
                         F.when(F.col("m.h") < F.xxhash64("a", turn), F.col("m.b")).otherwise(F.col("a")).alias("up"))
        up = checkpointed(up)
        steps.append(up)
        one = up.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        two = up.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        e = checkpointed(e.join(one, "a").join(two, "b").filter("ua <> ub")
                          .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct())
    out = nodes.withColumn("root", F.col("node"))
    for up in steps:
        step = up.select(F.col("node").alias("root"), "up")
        out = out.join(step, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return out


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
               radius: int = RADIUS) -> DataFrame:
    """(doc_id, row, fp, component_id) of every row; see ``fingerprints``."""
    rows = checkpointed(fingerprints(docs, id_col, text_col, size))
    nodes = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = checkpointed(components(links(nodes, radius=radius)).withColumnRenamed("node", "fp"))
    linked = roots.join(nodes, "fp")
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = salted_join(linked.select("fp", "root"), ids, "root", "fp").select("fp", "component_id", F.lit(True).alias("in"))
    labels = nodes.join(ids, "fp", "left").select(
        "fp", F.when(F.col("in"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))
    return salted_join(rows, labels, "fp", ["doc_id", "row"], salts=64).select(*rows.columns, "component_id")


def one_of_each(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the
    smallest doc_id (ties: smallest hash of the text)."""
    found = near_dedup(docs, size=size, radius=radius)
    # A component without any doc_id goes by its smallest fingerprint's row.
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    unknown = F.when(F.col("component_id").isNull(), F.col("fp"))
    keep = (found.withColumn("unknown", unknown).groupBy("component_id", "unknown").agg(F.min(order).alias("k"))
                 .select(F.coalesce("k.doc_id", F.lit(-1)).alias("k_id"), F.col("k.row").alias("k_row"),
                         F.col("k.none").alias("k_none")))
    a, b = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.xxhash64(F.col("text"))
    keep = checkpointed(keep)
    kept = docs.join(keep, (a == F.col("k_id")) & (b == F.col("k_row")) & (F.col("doc_id").isNull() == F.col("k_none")),
                     "left_semi")
    twice = found.groupBy("doc_id", "row").count().filter("count > 1")
    if not twice.isEmpty():  # repeated rows
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept


def op2_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    d = near_dedup(table(spark, sf_dir, "documents"))
    return d.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
