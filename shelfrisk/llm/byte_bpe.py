"""Byte-level BPE encoding and decoding with numpy matrices (operator 9).

Texts are cut into pieces by the tokenizer's pattern, vectorised over code points. Each distinct piece is
encoded once: pieces of similar length form a padded matrix of token ids, one row a piece, and in each
round every row merges its leftmost pair of least rank, found by a hashed pair table, and is compacted.
Pieces of more than ``LONG`` bytes merge all occurrences of that pair in a round, which comes to the same
because a merge only creates pairs of higher rank. Encoded pieces are kept by each Python worker up to a
bound, after which the table starts anew; results don't depend on it.

Defined results: a null or empty text has no tokens; unpaired surrogates can't occur in a string column;
repeated rows get the same row each; a null doc_id is passed on.
"""

from __future__ import annotations

import base64
import hashlib
import importlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Padded widths of the length buckets; longer pieces are encoded one by one.
WIDTHS = (4, 8, 12, 16, 24, 32, 64, 128)
LONG = 128
#: Distinct pieces kept by a worker (some 500 bytes each; a worker that is reused by other stages keeps them), and rows of a
#: matrix encoded at once.
KEPT, ROWS = 50_000, 8192
#: Characters of text whose new pieces are encoded together.
AT_ONCE = 500_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
NONE = np.int32(2**31 - 1)


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    return importlib.import_module("public_tokenizers").path(name)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class PairTable:
    """Open-addressing table from a pair of ids to the rank of their merge, probed for whole arrays at once."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.stride = max(ranks.values()) + 2  # the last id is the padding's: it has no pairs
        keys = np.array(left, np.int64) * self.stride + np.array(right, np.int64)
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        slot, todo, self.probes = self._slot(keys), np.arange(len(keys)), 0
        merged = np.array(merged, np.int32)
        while len(todo):
            self.probes += 1
            free = todo[self.keys[slot[todo]] == -1]
            self.keys[slot[free]] = keys[free]
            placed = free[self.keys[slot[free]] == keys[free]]
            self.ranks[slot[placed]] = merged[placed]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        shape, keys = left.shape, (left.astype(np.int64) * self.stride + right).ravel()
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.ranks[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out.reshape(shape)


class Encoder:
    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pairs = PairTable(self.ranks)
        self.pad = self.pairs.stride - 1
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.known: dict[str, tuple[int, str, bytes]] = {}

    def matrix(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of at most ``width`` bytes: a padded matrix and the count in each row."""
        lengths = np.array([len(x) for x in pieces])
        raw = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in pieces), np.uint8).reshape(-1, width)
        columns = np.arange(width)
        ids = np.where(columns < lengths[:, None], self.byte[raw], self.pad).astype(np.int32)
        rank = self.pairs(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((len(pieces), 0), NONE)
        live, out, counts = np.arange(len(pieces)), np.full_like(ids, self.pad), lengths.copy()
        while len(live):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(live), int)
            rows = np.arange(len(live))
            best = rank[rows, at] if rank.shape[1] else np.full(len(live), NONE)
            done = best == NONE
            if done.any():
                out[live[done], : ids.shape[1]] = ids[done]
                keep = ~done
                live, ids, rank, at, best = live[keep], ids[keep], rank[keep], at[keep], best[keep]
                if not len(live):
                    break
                rows = np.arange(len(live))
            counts[live] -= 1
            width_now = ids.shape[1] - 1
            take = np.arange(width_now) + (np.arange(width_now) > at[:, None])  # drop the pair's right half
            ids = np.take_along_axis(ids, take, 1)
            ids[rows, at] = best
            rank = np.take_along_axis(rank, np.minimum(take[:, : width_now - 1], rank.shape[1] - 1), 1) if width_now > 1 else rank[:, :0]
            if width_now > 1:
                before, after = np.maximum(at - 1, 0), np.minimum(at, width_now - 2)
                rank[rows, before] = np.where(at > 0, self.pairs(ids[rows, before], ids[rows, before + 1]), rank[rows, before])
                fresh = self.pairs(ids[rows, after], ids[rows, after + 1])
                rank[rows, after] = np.where(at <= width_now - 2, fresh, rank[rows, after])
        return out, counts

    def long(self, piece: bytes) -> np.ndarray:
        ids = self.byte[np.frombuffer(piece, np.uint8)]
        while len(ids) > 1:
            rank = self.pairs(ids[:-1], ids[1:])
            best = rank.min()
            if best == NONE:
                break
            spots = np.flatnonzero(rank == best)
            # of overlapping pairs (a run of one id), every second from the left
            start = np.flatnonzero(np.concatenate(([True], np.diff(spots) > 1)))
            nth = np.arange(len(spots)) - np.repeat(start, np.diff(np.append(start, len(spots))))
            spots = spots[nth % 2 == 0]
            ids = ids.copy()
            ids[spots] = best
            ids = np.delete(ids, spots + 1)
        return ids

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces that aren't known yet and keep count, ids as text, and the bytes decoded from the ids."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.known[piece] = (1, str(rank), self.tokens[rank])
            else:
                width = next((w for w in WIDTHS if len(raw) <= w), 0)
                buckets.setdefault(width, []).append((piece, raw))
        for width, found in buckets.items():
            for at in range(0, len(found), ROWS):
                some = found[at : at + ROWS]
                if width:
                    ids, counts = self.matrix([raw for _, raw in some], width)
                    rows = [r[:n] for r, n in zip(ids.tolist(), counts.tolist(), strict=True)]
                else:
                    rows = [self.long(raw).tolist() for _, raw in some]
                for (piece, _), row in zip(some, rows, strict=True):
                    self.known[piece] = (len(row), " ".join(map(str, row)), self.decode(row))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def encode(self, text: str) -> list[int]:
        pieces = cut(text)
        self.learn(list({p for p in pieces if p not in self.known}))
        return [int(i) for p in pieces for i in self.known[p][1].split()]


_CLASSES: list[np.ndarray] = []
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: Code points classified at once: a worker that held all of them as texts would need a hundred MB for a moment. It divides 0x800.
BLOCK = 2048
_CONTRACTION = re.compile("'(?:s|t|re|ve|m|ll|d)")


def classes() -> np.ndarray:
    """The pattern's class of every code point."""
    if not _CLASSES:
        import regex

        out = np.full(0x110000, OTHER, np.uint8)
        for first in range(0, 0x110000, BLOCK):
            if not 0xD800 <= first < 0xE000:  # surrogates
                block = "".join(map(chr, range(first, first + BLOCK)))
                for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
                    for m in regex.finditer(pattern, block):
                        out[first + m.start() : first + m.end()] = kind
        _CLASSES.append(out)
    return _CLASSES[0]


def cut(text: str) -> list[str]:
    """The matches of the tokenizer's pattern: contractions, words, numbers, signs (each with a space before), spaces."""
    if not text:
        return []
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = classes()[points]
    n = len(points)
    start = np.ones(n + 1, bool)  # does a piece start here
    np.not_equal(kind[1:], kind[:-1], out=start[1:n])
    heads = np.flatnonzero(start[:n])
    # the last of several spaces, and a single one, goes to what follows if it is a blank, else stands alone
    after = heads[1:][(kind[heads[1:]] != SPACE) & (kind[heads[1:] - 1] == SPACE)]
    blank = points[after - 1] == 0x20
    start[after - 1] = True
    start[after[blank]] = False
    # contractions: an apostrophe that begins its run of signs and isn't joined to a blank
    quote = np.flatnonzero((points == 0x27) & start[:n])
    for at in quote.tolist():
        m = _CONTRACTION.match(text, at)
        if m:
            start[at + 1] = False
            start[m.end()] = True
    edges = np.flatnonzero(start).tolist()
    return [text[a:b] for a, b in zip(edges, edges[1:], strict=False)]


_ENCODERS: dict[str, Encoder] = {}


def groups(column: pa.Array):
    """The pieces of each text, some texts at a time so that one matrix serves many."""
    some, held = [], 0
    for text in column:
        text = text.as_py() or ""
        some.append(cut(text))
        held += len(text)
        if held >= AT_ONCE:
            yield some
            some, held = [], 0
    if some:
        yield some


def digest(encoder: Encoder, pieces: list[str]) -> tuple[int, str, str]:
    got = list(map(encoder.known.__getitem__, pieces))
    ids, raw = " ".join([x[1] for x in got]), b"".join([x[2] for x in got])
    return sum([x[0] for x in got]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest()


def encoded(path: str):
    """The mapping of batches with _doc and _text to the query's columns, made for one vocabulary file."""

    def run(batches):
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))
        for batch in batches:
            rows = []
            for some in groups(batch.column("_text")):
                if len(encoder.known) > KEPT:
                    encoder.known.clear()
                encoder.learn(list(set().union(*some).difference(encoder.known)))
                rows += [digest(encoder, pieces) for pieces in some]
            n, ids, raw = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 over the whole text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string").alias("_text"))
    return rows.mapInArrow(encoded(path or vocabulary_path()), SCHEMA)


def encode_ids(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, ids (array of token ids) and decoded (the bytes they stand for)."""
    path = path or vocabulary_path()

    def run(batches):
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))
        for batch in batches:
            ids = [encoder.encode(x.as_py() or "") for x in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(ids, pa.list_(pa.int32())), pa.array(map(encoder.decode, ids), pa.binary())],
                                             names=["doc_id", "ids", "decoded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string").alias("_text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))
