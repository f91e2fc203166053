"""Operator 7: SentencePiece encoding and decoding by sampled segmentation.

Every way to cut a text into pieces of a SentencePiece vocabulary is a path
through a lattice. Forward filtering sums the path weights up to each place;
backward sampling then draws the last piece, the one before it, and so on, so
a path comes with exactly its share of the weight. The sums are logarithms, so
a run of characters without a piece, of any length, underflows nowhere. Draws are numbers of a
counter generator (row key, chunk, step): the same row gives the same pieces
in any partition, order or retry.

No piece of the vocabulary has a space after another character, and none has
a line feed, so the lattice falls apart at spaces and line feeds into chunks,
exactly. The forward sums of a chunk are kept per worker (a bounded memo) as
cumulated edge probabilities per place; backward steps are then taken for all
chunks of a batch at once in numpy.

Weights: the vocabulary file has merge ranks and no probabilities, so a piece
of rank r weighs 1 / (r + ``ZIPF_SHIFT``), to the power ``sharpness``.
Characters without a piece become byte pieces (as does the space mark
U+2581 itself where the text has it), so decoding gives every text back.

A chunk of more than ``WINDOW`` characters (a text without blanks) is filtered
window by window: the forward sums at the borders are kept, and the windows
are filtered once more, from the last to the first, to sample in them. Memory
then follows the window, time the length.

Defined results: a null text gives null ids and a null text; the empty text
gives no ids; a null row key is a key of its own; repeated rows get equal
ids; an empty table gives no rows; other columns are ignored by the query.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.llm.common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
ZIPF_SHIFT = 2.7
SHARPNESS = 1.0
#: Chunks kept per worker, and characters sampled at a time.
MEMO_CHUNKS = 150_000
BATCH_CHARS = 750_000
LONG_CHUNK = 64
WINDOW = 1 << 13
_DENSE = 128
_CELLS = 1 << 16  # places of chunks filtered at once
_CHUNK = re.compile(r"\n| +[^ \n]*|[^ \n]+")
_SCALE = math.log(10.0)  # per character; equal for all paths of a chunk


def read_pieces(model: str = MODEL) -> dict:
    """Pieces, byte ids and ranks of a model file (some hundred kB)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    normal, byte_ids, out = [], {}, []
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
            out.append(bytes([int(p[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            out.append(b"")
        else:
            normal.append((p, i, -sp.get_score(i)))
            out.append(p.replace(SPACE, " ").encode())
    assert len(byte_ids) == 256, "the vocabulary needs byte pieces"
    assert not any(SPACE in p.lstrip(SPACE) or "\n" in p for p, _, _ in normal)
    return {"normal": normal, "bytes": [byte_ids[b] for b in range(256)], "out": out}


class _Growing:
    """A numpy array that grows at its end."""

    def __init__(self, dtype):
        self._a, self._n = np.empty(1 << 16, dtype), 0

    def __len__(self) -> int:
        return self._n

    def extend(self, x: np.ndarray) -> None:
        to = self._n + len(x)
        if to > len(self._a):
            more = np.empty(max(to, len(self._a) * 3 // 2), self._a.dtype)
            more[: self._n] = self._a[: self._n]
            self._a = more
        self._a[self._n:to] = x
        self._n = to

    @property
    def all(self) -> np.ndarray:
        return self._a[: self._n]


class Lattices:
    """Forward-filtered lattices of chunks and backward sampling on them.

    A node is a place in a chunk; the nodes of a chunk follow each other, so
    the node before an edge of length d is ``node - d``. The edges of a node
    lie together with cumulated probabilities."""

    def __init__(self, pieces: dict, sharpness: float = SHARPNESS):
        self.byte_ids, self.out = np.array(pieces["bytes"], np.int32), pieces["out"]
        self.depth = max(len(p) for p, _, _ in pieces["normal"])
        tree, use = [{}, {}], {}  # node 0 is dead, 1 the root
        ids, logw = {}, {}
        for p, i, rank in pieces["normal"]:
            node = 1
            for ch in p:
                use[ch] = use.get(ch, 0) + 1
                if ch not in tree[node]:
                    tree[node][ch] = len(tree)
                    tree.append({})
                node = tree[node][ch]
            ids[node] = i
            logw[node] = -sharpness * math.log(max(rank, 0.0) + ZIPF_SHIFT) + _SCALE * len(p)
        # Code 0: in no piece; the most used characters have a dense table.
        chars = sorted(use, key=lambda c: (-use[c], c))
        self.code = np.zeros(0x110000, np.int32)
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.code[0x20], self.code[ord(SPACE)] = self.code[ord(SPACE)], 0
        code = {c: i + 1 for i, c in enumerate(chars)}
        self.dense = np.zeros((len(tree), _DENSE), np.int32)
        rare = []
        for node, down in enumerate(tree):
            for ch, to in down.items():
                if code[ch] < _DENSE:
                    self.dense[node, code[ch]] = to
                else:
                    rare.append((node << 20 | code[ch], to))
        rare.sort()
        self.rare_key = np.array([k for k, _ in rare] + [1 << 62], np.int64)
        self.rare_to = np.array([t for _, t in rare] + [0], np.int32)
        self.node_id, self.node_w = np.full(len(tree), -1, np.int32), np.zeros(len(tree))
        self.node_id[list(ids)] = list(ids.values())
        self.node_w[list(logw)] = list(logw.values())
        self.byte_w = -sharpness * math.log(len(pieces["out"]) + ZIPF_SHIFT)
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.first = _Growing(np.int32)      # node -> its first edge, -1 at a chunk's begin
        self.cum = _Growing(np.float32)      # edge -> cumulated probability
        self.piece = _Growing(np.int32)      # edge -> id, or -1 - character for its bytes
        self.length = _Growing(np.int32)     # edge -> characters

    def _follow(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        to = self.dense[node, np.minimum(code, _DENSE - 1) * (code < _DENSE)]
        rare = np.flatnonzero(code >= _DENSE)
        if len(rare):
            key = node[rare].astype(np.int64) << 20 | code[rare]
            at = np.searchsorted(self.rare_key, key)
            to[rare] = np.where(self.rare_key[at] == key, self.rare_to[at], 0)
        return to

    def add(self, chunks: list[str]) -> np.ndarray:
        """Filter forward through the lattices of ``chunks``; their end nodes."""
        sizes = np.array([len(c) for c in chunks])
        ends = np.empty(len(chunks), np.int64)
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            to = at + 1
            wide = max(8, int(sizes[order[at]] * 1.5))
            to = at + min(int(np.searchsorted(sizes[order[at:]], wide, "right")), max(1, _CELLS // wide))
            part = order[at:to]
            ends[part] = self._filter([chunks[i] for i in part], sizes[part])
            at = to
        return ends

    def _filter(self, chunks: list[str], sizes: np.ndarray) -> np.ndarray:
        n, wide, deep = len(chunks), int(sizes[-1]), min(self.depth, int(sizes[-1]))
        raw = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        inside = np.arange(wide) < sizes[:, None]
        text = np.zeros((n, wide + deep), np.int64)
        text[:, :wide][inside] = raw
        code = np.zeros((n, wide + deep), np.int32)
        code[:, :wide][inside] = self.code[raw]
        flat, stride = code.reshape(-1), wide + deep
        weight = np.full((n, wide + 1, deep), -np.inf)  # logarithms, then probabilities
        ident = np.zeros((n, wide + 1, deep), np.int32)
        row, place = np.nonzero(inside)
        state = np.ones(len(row), np.int32)
        for d in range(deep):
            state = self._follow(state, flat[row * stride + place + d])
            on = state > 0
            if not d:
                alone = ~(on & (self.node_id[state] >= 0))
                if alone.any():  # the bytes of a character without a piece
                    r, c = row[alone], place[alone]
                    ch = text[r, c]
                    weight[r, c + 1, 0] = self.byte_w * (1 + (ch > 0x7F) + (ch > 0x7FF) + (ch > 0xFFFF)) + _SCALE
                    ident[r, c + 1, 0] = -1 - ch
            row, place, state = row[on], place[on], state[on]
            if not len(row):
                break
            known = self.node_id[state] >= 0
            r, c, s = row[known], place[known] + d + 1, state[known]
            weight[r, c, d], ident[r, c, d] = self.node_w[s], self.node_id[s]
        alpha = np.full((n, wide + deep), -np.inf)  # logarithms, shifted by deep - 1 places
        alpha[:, deep - 1] = 0.0
        ended = np.searchsorted(sizes, np.arange(wide + 1)).tolist()  # chunks come by length
        for j in range(1, wide + 1):
            k = ended[j]
            p = weight[k:, j] + alpha[k:, j - 1:j - 1 + deep][:, ::-1]
            if n - k < 64:  # fewer calls
                alpha[k:, j + deep - 1] = np.logaddexp.reduce(p, axis=1)
                continue
            top = p.max(axis=1)
            p -= top[:, None]
            alpha[k:, j + deep - 1] = top + np.log(np.exp(p, out=p).sum(axis=1))
        here = alpha[:, deep - 1:]
        here[np.isneginf(here)] = 0.0  # beyond the end, where there are no edges
        for d in range(deep):
            weight[:, 1:, d] += alpha[:, deep - 1 - d:deep - 1 - d + wide] - here[:, 1:]
        np.exp(weight, out=weight)
        # Long pieces, mostly the likelier ones, come first at a node.
        row, place, d = np.nonzero(weight[:, :, ::-1])
        d = deep - 1 - d
        base = np.cumsum(sizes + 1) - (sizes + 1)
        node = base[row] + place
        prob = weight[row, place, d]
        nodes = int(base[-1] + sizes[-1] + 1)
        per = np.bincount(node, minlength=nodes)
        inner = np.ones(nodes, bool)
        inner[base] = False
        assert per[inner].all(), "a place of a chunk has no edge"
        start = np.cumsum(per) - per
        upto = np.cumsum(prob)
        cum = upto - (upto - prob)[start[node]]
        cum[(start + per - 1)[per > 0]] = 2.0  # no draw passes the last edge
        first = (start + len(self.cum)).astype(np.int32)
        first[base] = -1
        offset = len(self.first)
        self.first.extend(first)
        self.cum.extend(cum)
        self.piece.extend(ident[row, place, d])
        self.length.extend(d + 1)
        return offset + base + sizes

    def sample(self, ends: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of all paths one after the other, pieces per path) for end
        nodes and random keys."""
        first, cum, piece, size = self.first.all, self.cum.all, self.piece.all, self.length.all
        who, node, key, steps = np.arange(len(ends)), ends, keys, []
        length = np.zeros(len(ends), np.int64)
        edge = first[node]
        while len(who):
            u = uniform(key, len(steps))
            over = np.flatnonzero(u >= cum[edge])
            while len(over):
                edge[over] += 1
                over = over[u[over] >= cum[edge[over]]]
            steps.append((who, piece[edge]))
            length[who] += 1
            node = node - size[edge]
            edge = first[node]
            on = np.flatnonzero(edge >= 0)
            who, node, key, edge = who[on], node[on], key[on], edge[on]
        last = np.cumsum(length) - 1
        out = np.empty(int(length.sum()), np.int32)
        for t, (who, ids) in enumerate(steps):
            out[last[who] - t] = ids
        if len(out) and out.min() < 0:
            out, length = self._bytes(out, length)
        return out, length

    # ------------------------------------------------------- long chunks
    def _edges(self, chunk: str, lo: int, hi: int) -> tuple[list, list, list, list]:
        """(first edge of each place, lengths, weights, ids) of the edges that
        end in the places lo + 1 to hi, those of a place longest first."""
        begin = max(0, lo - self.depth + 1)
        raw = np.frombuffer(chunk[begin:hi].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        code = np.zeros(len(raw) + self.depth, np.int32)
        code[:len(raw)] = self.code[raw]
        at, state, found = np.arange(len(raw)), np.ones(len(raw), np.int32), []
        for d in range(self.depth):
            state = self._follow(state, code[at + d])
            on = state > 0
            if not d:  # characters without a piece of their own
                alone = np.flatnonzero(~(on & (self.node_id[state] >= 0)))
                ch = raw[alone]
                byte = self.byte_w * (1 + (ch > 0x7F) + (ch > 0x7FF) + (ch > 0xFFFF)) + _SCALE
                found.append((alone + 1, np.ones(len(alone), np.int64), byte, -1 - ch))
            at, state = at[on], state[on]
            known = self.node_id[state] >= 0
            node = state[known]
            found.append((at[known] + d + 1, np.full(len(node), d + 1), self.node_w[node], self.node_id[node].astype(np.int64)))
        end, size, weight, ident = (np.concatenate(x) for x in zip(*found))
        end = end + (begin - lo - 1)  # places of the window from 0
        inside = np.flatnonzero((end >= 0) & (end < hi - lo))
        order = inside[np.lexsort((-size[inside], end[inside]))]
        firsts = np.searchsorted(end[order], np.arange(hi - lo + 1))
        return firsts.tolist(), size[order].tolist(), np.exp(weight[order]).tolist(), ident[order].tolist()

    def _forward(self, alpha: list[float], edges: tuple, cums: list | None = None) -> list[float]:
        """Forward sums past a window, up to a factor; ``alpha`` and the result
        are those of the last ``depth`` places. ``cums`` gets the cumulated edge
        probabilities of every place."""
        firsts, size, weight, _ = edges
        alpha = list(alpha)
        for a, b in zip(firsts, firsts[1:]):
            parts = [alpha[-size[k]] * weight[k] for k in range(a, b)]
            total = sum(parts)
            if cums is not None:
                upto = 0.0
                cums.append([upto := upto + x / total for x in parts])
            alpha.append(total)
            if not 1e-100 < total < 1e100:
                alpha[-self.depth:] = [x / total for x in alpha[-self.depth:]]
        return alpha[-self.depth:]

    def sample_long(self, chunk: str, key: int, window: int = 0) -> np.ndarray:
        """Pieces of one path through a long chunk."""
        window = window or WINDOW
        alpha = [0.0] * (self.depth - 1) + [1.0]
        borders = []
        for lo in range(0, len(chunk), window):
            borders.append(alpha)
            alpha = self._forward(alpha, self._edges(chunk, lo, min(lo + window, len(chunk))))
        out, place, step, draws = [], len(chunk), 0, []
        for w in range(len(borders) - 1, -1, -1):
            lo = w * window
            edges, cums = self._edges(chunk, lo, min(lo + window, len(chunk))), []
            self._forward(borders[w], edges, cums)
            while place > lo:
                if step % window == 0:
                    draws = uniforms(key, step, window)
                cum = cums[place - lo - 1]
                u, k = draws[step % window], 0
                while k < len(cum) - 1 and u >= cum[k]:
                    k += 1
                k += edges[0][place - lo - 1]
                out.append(edges[3][k])
                place -= edges[1][k]
                step += 1
        ids = np.array(out[::-1], np.int32)
        return self._bytes(ids, np.array([len(ids)]))[0] if len(ids) and ids.min() < 0 else ids

    def _bytes(self, out: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put byte pieces in the place of characters without a piece."""
        marked = np.flatnonzero(out < 0)
        raw = [chr(-1 - x).encode("utf-8", "replace") for x in out[marked].tolist()]
        times = np.ones(len(out), np.int64)
        times[marked] = [len(x) for x in raw]
        path = np.repeat(np.arange(len(length)), length)
        full = np.repeat(out, times)
        full[full < 0] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return full, np.bincount(path, times, len(length)).astype(np.int64)

    def encode(self, texts: list[str], row_keys: list[str]) -> list[np.ndarray]:
        """Sampled ids of each text."""
        if len(self.memo) > MEMO_CHUNKS or len(self.cum) > 40 * MEMO_CHUNKS:
            self.forget()
        chunks, counts, seeds = [], [], []
        for text, key in zip(texts, row_keys):
            found = _CHUNK.findall(" " + text) if text else []
            chunks += found
            counts.append(len(found))
            seeds.append(xxhash.xxh64_intdigest(key, 7))
        long = [k for k, c in enumerate(chunks) if len(c) > WINDOW]
        kept = {k: chunks[k] for k in long}
        for k in long:
            chunks[k] = " "  # in its place, so that the others keep their numbers
        ends = list(map(self.memo.get, chunks))
        if None in ends:
            new = list({c for c, e in zip(chunks, ends) if e is None})
            ready = dict(zip(new, self.add(new).tolist()))
            ends = [ready[c] if e is None else e for c, e in zip(chunks, ends)]
            self.memo.update(x for x in ready.items() if len(x[0]) <= LONG_CHUNK)
        counts = np.array(counts, np.int64)
        starts = np.cumsum(counts) - counts
        number = np.arange(len(ends)) - np.repeat(starts, counts)
        keys = mixed(np.repeat(np.array(seeds, np.uint64), counts) + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        ids, length = self.sample(np.array(ends, np.int64), keys)
        upto = np.concatenate(([0], np.cumsum(length)))
        if not long:
            return [ids[upto[a]:upto[a + n]] for a, n in zip(starts, counts)]
        paths = [self.sample_long(kept[k], int(keys[k])) if k in kept else ids[upto[k]:upto[k + 1]] for k in range(len(chunks))]
        return [np.concatenate([ids[:0], *paths[a:a + n]]) for a, n in zip(starts, counts)]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.out.__getitem__, ids))[1:]


def mixed(z: np.ndarray) -> np.ndarray:
    """The output function of a 64-bit counter generator (splitmix)."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def uniform(keys: np.ndarray, step: int) -> np.ndarray:
    z = mixed(keys + np.uint64((step * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF))
    return (z >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def uniforms(key: int, step: int, n: int) -> list[float]:
    """The draws of a row's steps from ``step`` on."""
    at = np.uint64(key) + np.arange(step, step + n, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    return ((mixed(at) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53).tolist()


_WORKERS: dict = {}  # lattices live as long as the Python worker


def _lattices(shared, model: str, sharpness: float) -> Lattices:
    key = (model, sharpness)
    if key not in _WORKERS:
        _WORKERS.clear()
        _WORKERS[key] = Lattices(shared.value, sharpness)
    return _WORKERS[key]


def _shared_pieces(spark: SparkSession, model: str):
    """The broadcast pieces of a model file, one per application."""
    known = spark.sparkContext.__dict__.setdefault("_piece_models", {})
    if model not in known:
        known[model] = spark.sparkContext.broadcast(read_pieces(model))  # fixed size
    return known[model]


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text",
           sharpness: float = SHARPNESS) -> DataFrame:
    """(doc_id, ids, n_tokens, lossless): sampled piece ids of every text;
    ``lossless`` says whether decoding gave the text back."""
    shared = _shared_pieces(docs.sparkSession, model)

    def run(batches):
        lat = _lattices(shared, model, sharpness)
        for batch in batches:
            at = 0
            texts = batch.column(1)
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)) \
                if len(texts) and pa.types.is_string(texts.type) else np.zeros(len(texts), np.int32)
            bound = np.cumsum(sizes, dtype=np.int64)
            while at < batch.num_rows:
                base = int(bound[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(bound, base + BATCH_CHARS, "right")))
                part = batch.slice(at, to - at)
                at = to
                body = part.column(1).to_pylist()
                keys = part.column(2).to_pylist()
                ids = lat.encode([x or "" for x in body], keys)
                same = [x is None or lat.decode(i.tolist()) == x.encode("utf-8", "replace") for x, i in zip(body, ids)]
                n = np.array([len(i) for i in ids], np.int64)
                offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                none = np.array([x is None for x in body])
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)),
                    mask=pa.array(none) if none.any() else None)
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(n), pa.array(same)],
                                                 names=["doc_id", "ids", "n_tokens", "lossless"])

    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       key.alias("key"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, lossless boolean")


def decode(encoded: DataFrame, model: str = MODEL, ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and ``text`` of encoded rows."""
    shared = _shared_pieces(encoded.sparkSession, model)

    def run(batches):
        out = shared.value["out"]
        for b in batches:
            texts = [None if x is None else b"".join(out[i] for i in x)[1:].decode("utf-8", "replace")
                     for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, text string")


def op7_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
