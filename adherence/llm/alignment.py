"""Operator 11: alignment of two tokenizers' tokens.

A text is encoded by a byte-level BPE (side A: space and text) and by a
SentencePiece BPE (side B, which adds the space itself). Two tokens are linked
where their byte ranges overlap; offsets at which tokens of both sides end cut
the tokens into groups. Corpus-wide, an id pair's count is the number of
documents that hold it linked.

Both encoders cut before a space between two visible characters (A's pattern
has no space after another character, B's vocabulary no piece with one), so a
document is a row of chunks, each encoded for itself, exactly. A worker
keeps the chunks it has met. All new chunks of a batch are encoded as one
string, and aligned at once by ``pandas.merge_asof``: keyed by place in the
batch's documents, each token start finds the other side's covering token;
the union of both directions is all overlaps, and equal ends close groups. The
documents' links are then gathered chunk by chunk.

Plan: documents are dealt to bundles (see ``bundles``); a bundle counts its
documents per id pair; the pairs' counts are summed and the highest count of
an A id is found (at most one row per id: the bound of the broadcast); the
sums go back to the bundles that hold the pair. A bundle is encoded and aligned
once: beside its pairs it writes its documents' counts, their groups, and for each
link the place of its pair among the bundle's (packed), which is all that the
sums are then met with. What is shuffled for a pair is one row per bundle,
however many documents hold it.

Defined results: null or empty texts, texts that are not UTF-8, and texts that
either side's tokens do not spell byte by byte, have no tokens: zeros, '' for
the digest; special tokens' strings are plain text; long texts are taken whole
(a chunk without blanks is encoded at once and not kept); ties for the highest
count are all best; repeated rows are documents of their own; null ids stay
null; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adherence.llm.bundles import bundle_count, bundled, pack, ragged, unpack
from adherence.llm.common import checkpointed, table

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
BUNDLE = 8 << 20
#: Chunks and characters kept by a worker, and the longest chunk that is kept.
MEMO_CHUNKS, MEMO_CHARS, LONG_CHUNK = 400_000, 8 << 20, 1 << 12
#: A cut is before a space between two characters that are blank to nobody.
_BLANK = r"\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u2581\u3000\ufeff"
_CUT = re.compile(rf"(?<=[^{_BLANK}]) (?=[^{_BLANK}])")
_EDGE = re.compile(rf"[{_BLANK}]")


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: visible
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in visible}
    return out | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}


class Encoders:
    """Both tokenizers and the bytes of their ids."""

    def __init__(self, a_file: str = A_FILE, b_file: str = B_FILE):
        import sentencepiece
        import tiktoken
        spec = json.load(open(a_file, encoding="utf-8"))
        special = {t["content"] for t in spec.get("added_tokens", [])}
        of = byte_alphabet()
        # The ids of a byte-level vocabulary are the ranks of its merges.
        ranks = {bytes(of[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value: the byte-level split
        self._a = tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for w, i in ranks.items():
            self.a_bytes[i] = w
        b = self._b
        self.b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b"" if b.is_control(i) or b.is_unknown(i)
                        else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in xs], np.int64) for xs in (self.a_bytes, self.b_bytes))
        # Decimal ids with each separator that can follow them.
        self.a_text, self.b_text = ([f"{i}{c}" for i in range(len(xs)) for c in seps]
                                    for xs, seps in ((self.a_bytes, ",|"), (self.b_bytes, ",;")))

    def both(self, spaced: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of either side for a string that begins with a space."""
        return (np.array(self._a.encode_ordinary(spaced), np.int64), np.array(self._b.encode(spaced[1:]), np.int64))


def overlaps(a_start: np.ndarray, b_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): the overlapping tokens of two cuts of the same bytes, in order."""
    left = pd.DataFrame({"at": a_start, "a": np.arange(len(a_start))})
    right = pd.DataFrame({"at": b_start, "b": np.arange(len(b_start))})
    pairs = pd.concat([pd.merge_asof(left, right, on="at"), pd.merge_asof(right, left, on="at")])
    code = np.unique(pairs["a"].to_numpy() * (len(right) + 1) + pairs["b"].to_numpy())
    return code // (len(right) + 1), code % (len(right) + 1)


class _Flat:
    """Rows of numbers of varying length, that grows at its end."""

    def __init__(self):
        self.data, self.starts, self.counts = np.empty(1 << 16, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.n = 0

    def extend(self, data: np.ndarray, counts: np.ndarray) -> None:
        to = self.n + len(data)
        if to > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.empty(max(to, 3 * self.n // 2) - self.n, np.int64)])
        self.data[self.n: to] = data
        self.starts = np.concatenate([self.starts, self.n + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.n = to

    def of(self, rows: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.starts[rows], self.counts[rows])]


class Chunks:
    """The chunks that a worker has met, with their tokens' alignment."""

    def __init__(self, encoders: Encoders):
        self.enc = encoders
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.links = _Flat()  # A id * B ids + B id, an entry for each overlap
        self.n_a, self.n_b, self.n_groups = (np.empty(0, np.int64) for _ in range(3))  # n_a is -1: not spelt byte by byte
        self.groups: list[str] = []

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """The chunk numbers of every text (none for an empty one)."""
        if len(self.known) > MEMO_CHUNKS or self.chars > MEMO_CHARS:
            self.clear()
        cut = [_pieces(t) if t else [] for t in texts]
        new = list(dict.fromkeys(p for ps in cut for p in ps if p not in self.known))
        if new:
            # Chunks that begin or end in a blank may not stand beside others.
            plain = [bool(p) and not _EDGE.search(p[0] + p[-1]) for p in new]
            new = [p for p, ok in zip(new, plain) if ok] + [p for p, ok in zip(new, plain) if not ok]
            first = len(self.groups)
            self.known.update(zip(new, range(first, first + len(new))))
            self._align(new, sum(plain))
        out = [np.fromiter(map(self.known.__getitem__, ps), np.int64, len(ps)) for ps in cut]
        for p in new:
            self.chars += len(p)
            if len(p) > LONG_CHUNK:
                del self.known[p]
        return out

    def _encode(self, pieces: list[str], out: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
        """(A ids, B ids, bytes) for runs of chunks, encoded side by side where
        that spells them; a chunk that is not spelt gives no tokens."""
        enc = self.enc
        spaced = "".join([" " + p for p in pieces])
        a, b = enc.both(spaced)
        data = spaced.encode()
        if b"".join(map(enc.a_bytes.__getitem__, a.tolist())) == data and b"".join(map(enc.b_bytes.__getitem__, b.tolist())) == data:
            out.append((a, b, len(pieces)))
        elif len(pieces) == 1:
            out.append((a[:0], b[:0], -1))
        else:
            half = len(pieces) // 2
            self._encode(pieces[:half], out)
            self._encode(pieces[half:], out)

    def _align(self, new: list[str], plain: int) -> None:
        """Encode chunks, the first ``plain`` as one string, and align them."""
        enc, got = self.enc, []
        if plain:
            self._encode(new[:plain], got)
        for p in new[plain:]:
            self._encode([p], got)
        a, b = (np.concatenate([g[i] for g in got]) for i in (0, 1))
        good = np.concatenate([np.full(abs(g[2]), g[2] > 0) for g in got])
        sizes = np.where(good, np.array([len(p.encode()) + 1 for p in new], np.int64), 0)
        ends = np.cumsum(sizes)
        a_end, b_end = np.cumsum(enc.a_sizes[a]), np.cumsum(enc.b_sizes[b])
        ta, tb = overlaps(a_end - enc.a_sizes[a], b_end - enc.b_sizes[b])
        chunk_a, chunk_b = (np.searchsorted(ends, e, "left") for e in (a_end, b_end))
        per = lambda x: np.bincount(x, minlength=len(new))
        self.links.extend(a[ta] * len(enc.b_bytes) + b[tb], per(chunk_a[ta]))
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        self.n_a = np.concatenate([self.n_a, np.where(good, per(chunk_a), -1)])
        self.n_b = np.concatenate([self.n_b, per(chunk_b)])
        self.n_groups = np.concatenate([self.n_groups, per(np.searchsorted(ends, both, "left"))])
        # Group texts: A's tokens of a group, then B's, each id with what follows it.
        group_a, group_b = np.searchsorted(both, a_end, "left"), np.searchsorted(both, b_end, "left")
        side = np.concatenate([np.zeros(len(a), np.int64), np.ones(len(b), np.int64)])
        last = np.concatenate([a_end == both[group_a], b_end == both[group_b]]) if len(both) else np.empty(0, bool)
        ids = np.concatenate([a, b]) * 2 + last
        order = np.lexsort((side, np.concatenate([group_a, group_b])))
        words = [(enc.b_text if s else enc.a_text)[i] for i, s in zip(ids[order].tolist(), side[order].tolist())]
        to = np.cumsum(per(chunk_a) + per(chunk_b)).tolist()
        self.groups += ["".join(words[lo:hi]) for lo, hi in zip([0, *to], to)]


def _pieces(text: str) -> list[str]:
    """The chunks of a text, each without the space before it."""
    parts = text.split(" ")
    if all(parts) and not _EDGE.search("".join([p[0] + p[-1] for p in parts])):
        return parts
    return _CUT.split(text)


class Aligned:
    """The documents of a bundle as rows of chunks."""

    def __init__(self, rows: pa.Table, chunks: Chunks):
        texts = []
        for body in rows.column("body").to_pylist():
            try:
                texts.append((body or b"").decode())
            except UnicodeDecodeError:
                texts.append("")
        self.chunks = chunks
        # Some hundred texts at a time, so that no batch's new chunks are many.
        self.rows = []
        self.pairs, self.doc, self.stats = [], [], []
        for lo in range(0, len(texts), 500):
            part = chunks.of(texts[lo: lo + 500])
            n = np.array([len(p) for p in part], np.int64)
            flat, doc = np.concatenate([*part, np.empty(0, np.int64)]), np.repeat(np.arange(len(part)), n)
            bad = np.bincount(doc, weights=chunks.n_a[flat] < 0, minlength=len(part)) > 0
            keep = ~bad[doc]
            flat, doc = flat[keep], doc[keep]
            add = lambda x: np.bincount(doc, weights=x[flat], minlength=len(part)).astype(np.int64)
            self.stats.append(np.stack([add(chunks.n_a), add(chunks.n_b), add(chunks.n_groups), add(chunks.links.counts)]))
            self.pairs.append(chunks.links.of(flat))
            self.doc.append(np.repeat(doc + lo, chunks.links.counts[flat]))
            self.rows += [[] if b else [chunks.groups[i] for i in p.tolist()] for p, b in zip(part, bad)]
        self.pairs, self.doc = np.concatenate(self.pairs), np.concatenate(self.doc)
        self.stats = np.concatenate(self.stats, axis=1)


_CHUNKS: dict[tuple[str, str], Chunks] = {}


def _aligned(rows: pa.Table, a_file: str, b_file: str) -> Aligned:
    if (a_file, b_file) not in _CHUNKS:
        _CHUNKS[a_file, b_file] = Chunks(Encoders(a_file, b_file))
    return Aligned(rows, _CHUNKS[a_file, b_file])


DOC = pa.struct([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                 ("n_links", pa.int64()), ("text", pa.string())])
#: What a bundle gives: a row for each pair, and one with its documents and links.
FOUND = pa.schema([("of", pa.int32()), ("pair", pa.int64()), ("n", pa.int64()), ("docs", pa.list_(DOC)), ("links", pa.binary())])
FOUND_DDL = ("of int, pair long, n long, docs array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, "
             "text: string>>, links binary")


def align(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, id_col: str = "doc_id", text_col: str = "text",
          with_groups: bool = True) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every
    document; with ``with_groups=False`` the SHA-256 of the groups."""
    import sentencepiece
    n_b_ids = sentencepiece.SentencePieceProcessor(model_file=b_file).get_piece_size()
    n = bundle_count(docs, text_col, BUNDLE)
    rows = bundled(docs, n, id_col, text_col)

    def count(rows: pa.Table) -> pa.Table:
        """Bundle -> its id pairs with the number of documents that link them,
        and its documents with the places of their links' pairs."""
        own = _aligned(rows, a_file, b_file)
        width = np.int64(len(own.stats[0]) + 1)
        pairs, places = np.unique(own.pairs, return_inverse=True)
        docs = np.bincount(np.unique(places * width + own.doc) // width, minlength=len(pairs))
        texts = ["".join(g)[:-1] for g in own.rows]
        if not with_groups:
            texts = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
        own_docs = pa.StructArray.from_arrays([rows.column("doc_id").combine_chunks().cast(pa.int64()), *(pa.array(c, pa.int64()) for c in own.stats),
                                               pa.array(texts, pa.string())], fields=list(DOC))
        of = rows.column("bundle")[0].as_py()
        k = len(pairs)
        listed = pa.ListArray.from_arrays(pa.array([0, len(own_docs)], pa.int32()), own_docs, type=FOUND.field("docs").type)
        last = lambda x: pa.concat_arrays([pa.nulls(k, x.type), x])
        return pa.Table.from_arrays([pa.array(np.full(k + 1, of), pa.int32()), pa.concat_arrays([pa.array(pairs, pa.int64()), pa.nulls(1, pa.int64())]),
                                     pa.concat_arrays([pa.array(docs, pa.int64()), pa.nulls(1, pa.int64())]), last(listed),
                                     last(pa.array([pack(places.astype(np.int32))], pa.binary()))], schema=FOUND)

    # Written once: the documents, and a row per bundle and pair, read for the sums and for the best.
    found = checkpointed(rows.groupBy("bundle").applyInArrow(lambda t: count(t), FOUND_DDL))
    pairs = found.filter(F.col("pair").isNotNull()).select("pair", "of", F.sum("n").over(Window.partitionBy("pair")).alias("n"))
    a_id = F.floor(F.col("pair") / F.lit(n_b_ids))
    best = pairs.groupBy(a_id.alias("a")).agg(F.max("n").alias("best"))  # a row per A id at most
    back = (pairs.withColumn("a", a_id).join(F.broadcast(best), "a")
                 .select(F.col("of").alias("to"), "pair", "n", (F.col("n") == F.col("best")).alias("is_best")))

    name = "groups" if with_groups else "groups_sha256"
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", name]

    def finish(rows: pa.Table, found: pa.Table) -> pa.Table:
        """A bundle's documents and the corpus-wide counts of its pairs -> the documents' rows."""
        own = pa.concat_arrays([x for c in rows.column("docs").chunks for x in [c.flatten()]] or [pa.array([], DOC)])
        places = np.concatenate([np.empty(0, np.int32), *(unpack(x.as_py(), np.int32)[0] for x in rows.column("links"))])
        ends = np.cumsum(own.field("n_links").to_numpy())
        order = np.argsort(found.column("pair").to_numpy())  # the bundle's pairs are found in full

        def added(column: str) -> pa.Array:
            """Sums over each document's links."""
            values = found.column(column).to_numpy(zero_copy_only=False).astype(np.int64)[order]
            total = np.concatenate(([0], np.cumsum(values[places])))
            return pa.array(np.diff(np.concatenate(([0], total[ends]))), pa.int64())

        return pa.Table.from_arrays([*(own.field(c) for c in names[:5]), added("is_best"), added("n"), own.field("text")], names)

    out = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, {name} string"
    documents = found.filter(F.col("pair").isNull()).select("of", "docs", "links")
    return documents.groupBy("of").cogroup(back.groupBy("to")).applyInArrow(lambda left, right: finish(left, right), out)


def op11_tokenizer_alignment(spark, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), with_groups=False)
