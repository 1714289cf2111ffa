"""N-gram Jaccard join with PartEnum signatures (operator 5).

Every document is the set of its distinct word shingles. Two sets with Jaccard similarity of at least
``LIMIT`` differ in at most ``(|A| + |B|) / 9`` elements, so if the shingle domain is cut into enough
partitions, one of them must hold (nearly) the same elements of both. Sizes are banded; for a band, the
domain is hashed into ``n1`` first-level partitions of ``N2`` sub-partitions each, and every subset of
``N2 - K2`` sub-partitions is a signature: similar sets share one. A set whose empty sub-partitions
leave no guarantee (small sets mostly) also sends its prefix (the smallest hashes, one of which two
such sets must share), so no pair is lost.

Signatures are grouped task by task first, and of a group of copies or near copies one row a task goes
to the signature's own partition, the others to salted ones. A document must share a known number of
signatures to have a partner; those that share fewer are dropped, and so are each document's commonest
signatures, as many as leave at least one that it shares with every partner. Within a signature all members are
compared with the one that shares most (a star). Signatures whose members remain in different components are
refined: their members are dealt by the rarest elements of their sets, and two of them meet only where the first
element they share leaves room for the overlap they need, so a family that shares a passage or an original is
not compared pair by pair. Bit maps exclude pairs whose sets must differ too much; the others are verified on the
exact word sequences.

Defined results: a null, empty or word-less text has the empty set and no links; with fewer words than
``WORDS`` the whole sequence is the one shingle; a null doc_id takes part like any other row and has
``component_id`` of its group's smallest doc_id; repeated rows each get their row.
"""

from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import small, stored, table

WORDS = 5
#: Jaccard limit as a fraction, 80 / 100.
LIMIT = (80, 100)
#: Sub-partitions of a first-level partition, and how many of them may differ.
N2, K2 = 2, 1
#: Ratio of the band borders, and spare first-level partitions as a part of the differences.
BAND, SPARE = 1.5, 0.15
#: The band number of prefix elements; bits of an owner's text hash (equal hashes are told apart by MD5).
PREFIX, TID_BITS = 255, 40
#: Ratio of the size classes in which members of open signatures meet.
CLASS = 1.05
#: Signatures grouped at once in a task, and bytes of text hashed at once.
BLOCK, PIECE = 2_000_000, 1 << 20

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(31))
    x = x * U(0x9E3779B97F4A7C15)
    x = x ^ (x >> U(29))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def _tables() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(20240607)
    base = U(int(rng.integers(1, 1 << 62)) * 2 + 1)
    inverse = U(pow(int(base), -1, 1 << 64))
    up, down = np.full(PIECE + 1, base, U), np.full(PIECE + 1, inverse, U)
    up[0] = down[0] = 1
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    sep = np.zeros(256, bool)
    sep[[0x20, *range(0x09, 0x0E)]] = True
    return {"up": np.multiply.accumulate(up), "down": np.multiply.accumulate(down), "lower": lower, "sep": sep,
            "value": rng.integers(1, 1 << 63, 256).astype(U), "place": (rng.integers(1, 1 << 62, WORDS) * 2 + 1).astype(U)}


_TABLES: dict[str, np.ndarray] = {}


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of a piece of UTF-8 text (polynomial sums between the word's borders), and its start."""
    t = _TABLES
    low = t["lower"][data]
    word = np.empty(len(data) + 2, bool)
    word[0] = word[-1] = False
    np.logical_not(t["sep"][low], out=word[1:-1])
    edges = np.flatnonzero(word[1:] != word[:-1])
    start, end = edges[0::2], edges[1::2]
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(t["value"][low] * t["up"][: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * t["down"][start] + (end - start).astype(U)), start


def _hash_words(data: np.ndarray) -> np.ndarray:
    return _words(data)[0]


def word_hashes(data: np.ndarray) -> np.ndarray:
    if not _TABLES:
        _TABLES.update(_tables())
    if len(data) <= PIECE:
        return _hash_words(data)
    parts, at = [], 0
    while at < len(data):  # cut long texts where a word ends
        to = min(at + PIECE, len(data))
        if to < len(data):
            gaps = np.flatnonzero(_TABLES["sep"][data[at:to]])
            if not len(gaps):  # one word longer than a piece
                rest = np.flatnonzero(_TABLES["sep"][data[to:]])
                to = to + int(rest[0]) if len(rest) else len(data)
                parts.append(np.array([hash_long(data[at:to])], U))
                at = to
                continue
            to = at + int(gaps[-1]) + 1
        parts.append(_hash_words(data[at:to]))
        at = to
    return np.concatenate(parts)


@np.errstate(over="ignore")
def hash_long(data: np.ndarray) -> np.uint64:
    """The hash of one word longer than a piece."""
    got = U(len(data))
    for at in range(0, len(data), PIECE):
        low = _TABLES["lower"][data[at : at + PIECE]]
        got = mix(np.array([got + (_TABLES["value"][low] * _TABLES["up"][: len(low)]).sum(dtype=U)], U))[0]
    return got


def shingle_hashes(words: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of some texts, one text after the other, and how many each has.

    ``words``: the texts' word hashes, ``count``: each text's number of words.
    """
    place, first = _TABLES["place"], np.cumsum(count) - count
    total = np.full(max(0, len(words) - WORDS + 1), U(WORDS))
    for j in range(WORDS):
        total = total + words[j : len(words) - WORDS + 1 + j] * place[j]
    total = mix(total)
    sets, owner = [], np.repeat(np.arange(len(count)), np.maximum(count - WORDS + 1, 0) + ((count > 0) & (count < WORDS)))
    for at, n in zip(first.tolist(), count.tolist(), strict=True):
        if n >= WORDS:
            sets.append(np.sort(total[at : at + n - WORDS + 1]))
        elif n:
            sets.append(mix(np.array([(words[at : at + n] * place[:n]).sum(dtype=U)], U) + U(n)))
    if not sets:
        return np.zeros(0, U), np.zeros(len(count), np.int64)
    got = np.concatenate(sets)
    new = np.concatenate(([True], (got[1:] != got[:-1]) | (owner[1:] != owner[:-1])))
    return got[new], np.bincount(owner[new], minlength=len(count))


def shingle_sets(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_hashes`` of texts given as bytes; all but a long one fit into a piece together."""
    if not _TABLES:
        _TABLES.update(_tables())
    if len(texts) == 1:
        words = word_hashes(texts[0])
        return shingle_hashes(words, np.array([len(words)]))
    data = np.frombuffer(b" ".join([x.tobytes() for x in texts]), np.uint8)
    ends = np.cumsum([len(x) + 1 for x in texts])
    words, start = _words(data)
    return shingle_hashes(words, np.diff(np.searchsorted(start, ends), prepend=0))


def shingle_set(data: np.ndarray) -> np.ndarray:
    return shingle_sets([data])[0]


def _bands(most: int) -> list[tuple[int, int]]:
    """Bands [low, high) of the smaller set's size, up to the one that holds ``most``."""
    out, low = [], 1
    while low <= most:
        high = max(low + 1, int(-(-low * BAND // 1)))
        out.append((low, high))
        low = high
    return out


def differences(smaller: int) -> int:
    """The most elements in which a set of this size and an at least as large similar one differ."""
    p, q = LIMIT
    return (smaller + smaller * q // p) * (q - p) // (q + p)


SUBSETS = np.array(list(itertools.combinations(range(N2), N2 - K2)))
#: So many signatures of a set may change with one element.
SPOILS = math.comb(N2 - 1, N2 - K2 - 1)
#: The most that the upper bits of an owner hold as the signatures it must share.
MOST = (1 << 15) - 1


@np.errstate(over="ignore")
def signatures(elements: np.ndarray, sizes: np.ndarray):
    """PartEnum signatures of some sets, given as by ``shingle_hashes``: (band, sets, need, count, signatures).

    For each band: the sets that take part, how many signatures each must share with a similar set (all but those
    that the differences may change), how many it has, and all of them in order. Sets for which that is no guarantee also have their prefix.
    """
    p, q = LIMIT
    weights, first = mix(elements ^ U(0x5851F42D4C957F2D)), np.cumsum(sizes) - sizes
    safe = np.ones(len(sizes), bool)

    def rows(sets: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.arange(n.sum()) + np.repeat(first[sets] - (np.cumsum(n) - n), n)

    for band, (low, high) in enumerate(_bands(int(sizes.max(initial=0)))):
        # a set that is larger than the similar ones of the band's sets may be doesn't take part
        sets = np.flatnonzero((sizes >= low) & (sizes * p <= (high - 1) * q))
        if not len(sets):
            continue
        n, k = sizes[sets], differences(high - 1)
        own = rows(sets, n)
        if k == 0:
            total = np.add.reduceat(weights[own], np.cumsum(n) - n)
            yield band, sets, np.ones(len(sets), int), np.ones(len(sets), int), mix(total + U(band + 1))
            continue
        n1 = k // (K2 + 1) + 2 + int(SPARE * k)
        part = ((elements[own] >> U(32)) * U(n1 * N2) >> U(32)).astype(np.int64) + np.repeat(np.arange(len(sets)) * (n1 * N2), n)
        head = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        sums, seen = np.zeros(len(sets) * n1 * N2, U), np.zeros(len(sets) * n1 * N2, bool)
        sums[part[head]], seen[part[head]] = np.add.reduceat(weights[own], head), True
        total = sums.reshape(-1, n1, N2)[:, :, SUBSETS].sum(axis=3, dtype=U)
        full = seen.reshape(-1, n1, N2)[:, :, SUBSETS].any(axis=3)
        key = np.arange(n1 * len(SUBSETS), dtype=U).reshape(n1, -1) * U(0x9E3779B97F4A7C15) + U(band + 1)
        count = full.sum(axis=(1, 2))
        need = count - SPOILS * np.array([differences(x) for x in range(low, high)])[np.minimum(n, high - 1) - low]
        safe[sets[need < 1]] = False
        yield band, sets, np.maximum(need, 1), count, mix(total + key)[full]
    sets = np.flatnonzero(~safe)
    if len(sets):
        n = sizes[sets] - -(-sizes[sets] * p // q) + 1
        yield PREFIX, sets, np.ones(len(sets), int), n, mix(elements[rows(sets, n)] + U(0x2545F4914F6CDD1D))


def _texts(column: pa.Array):
    """The UTF-8 bytes of each text as a numpy array (None for null)."""
    column = column.cast(pa.large_string())
    nulls = column.is_null().to_numpy(zero_copy_only=False)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    for i in range(len(column)):
        yield None if nulls[i] else data[offsets[i] : offsets[i + 1]]


def _chunks(batches):
    """Texts not met before in the task, as many as fill a piece: their MD5 names and bytes."""
    seen: set[str] = set()
    names, texts, held = [], [], 0
    for batch in batches:
        for name, tid, text in zip(batch.column("_md5").to_pylist(), batch.column("_tid").to_pylist(), _texts(batch.column("_text")), strict=True):
            if text is None or name in seen:
                continue
            seen.add(name)
            if texts and held + len(text) >= PIECE:
                yield names, texts
                names, texts, held = [], [], 0
            names.append((name, tid))
            texts.append(text.copy())
            held += len(text) + 1
    if texts:
        yield names, texts


def _grouped(sigs: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch:
    """One block of a task. The first owner of each signature has salt 0, or -1 if others follow with theirs."""
    sig, owner = np.concatenate(sigs).view(np.int64), np.concatenate(owners)
    order = np.argsort(sig, kind="stable")
    sig, owner = sig[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
    salt = 1 + (owner & 63).astype(np.int32)
    salt[first] = np.where(np.minimum.reduceat(owner, first) == np.maximum.reduceat(owner, first), 0, -1)
    return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(owner), pa.array(salt)], names=["sig", "owner", "salt"])


def _signed(batches):
    """Rows of signatures (sig, owner, salt), and for each text its number of shingles: (hash, hash, -2 - number)."""
    sigs, owners, held = [], [], 0
    for names, texts in _chunks(batches):
        elements, sizes = shingle_sets(texts)
        tids = np.array([tid for _, tid in names], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(tids), pa.array([int(name[:15], 16) for name, _ in names], pa.int64()),
                                          pa.array((-2 - sizes).astype(np.int32))], names=["sig", "owner", "salt"])
        for band, sets, need, count, got in signatures(elements, sizes):
            owner = np.minimum(need, MOST) << 48 | band << TID_BITS | tids[sets] & ((1 << TID_BITS) - 1)
            sigs.append(got)
            owners.append(np.repeat(owner, count))
            held += len(got)
        if held >= BLOCK:
            yield _grouped(sigs, owners)
            sigs, owners, held = [], [], 0
    if held:
        yield _grouped(sigs, owners)


def _runs(sig: np.ndarray, owner: np.ndarray, salt: np.ndarray) -> pa.RecordBatch:
    """Of whole runs of one signature: the rows of those with more than one owner. Rows with sizes go on as they are."""
    sizes = salt < -1
    first = np.flatnonzero(np.concatenate(([True], (sig[1:] != sig[:-1]) | sizes[1:] | sizes[:-1])))
    many = (np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)) | (np.minimum.reduceat(salt, first) < 0)
    rows = np.repeat(many, np.diff(np.append(first, len(sig)))) | (salt > 0) | sizes
    size = np.where(sizes, -2 - salt, -1)[rows].astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(sig[rows]), pa.array(owner[rows]), pa.array(size)], names=["sig", "owner", "size"])


def _shared(batches):
    """Rows sorted by (signature, is it salted): those whose signature has another owner."""
    held = None
    for batch in batches:
        got = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("sig", "owner", "salt")]
        if held is not None:
            got = [np.concatenate(x) for x in zip(held, got, strict=True)]
        if not len(got[0]):
            continue
        cut = int(np.searchsorted(got[0], got[0][-1]))  # the last run may go on
        held = [x[cut:].copy() for x in got]
        if cut:
            yield _runs(*(x[:cut] for x in got))
    if held is not None:
        yield _runs(*held)


def exact_set(text: str) -> set:
    words = WORD.findall(text.translate(LOWER))
    if len(words) < WORDS:
        return {tuple(words)} if words else set()
    return set(zip(*(words[j:] for j in range(WORDS)), strict=False))


def _verified(batches):
    p, q = LIMIT
    last, held = None, set()
    for batch in batches:
        keep = []
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        for i, (x, y) in enumerate(zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True)):
            if b[i] != last:
                last, held = b[i], exact_set(y)
            own = exact_set(x)
            both = len(own & held)
            if q * both >= p * (len(own) + len(held) - both):
                keep.append(i)
        if keep:
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep]), pa.array([b[i] for i in keep])], names=["a", "b"])


def sketch(text: str | None) -> bytes:
    """A bit map of about four bits a shingle in which each shingle turns one bit: sets that differ little have maps
    that differ in at most as many bits. A power of two long, so that maps of unequal length fold onto each other."""
    got = shingle_set(np.frombuffer((text or "").encode(), np.uint8))
    bits = 1 << max(6, int(4 * len(got)).bit_length())
    turned = np.bincount((got & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return len(got).to_bytes(4, "little") + np.packbits(turned.astype(np.uint8), bitorder="little").tobytes()


def _sketched(batches):
    for batch in batches:
        got = [sketch(x.as_py()) for x in batch.column("text")]
        sizes = [int.from_bytes(x[:4], "little") for x in got]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.binary()), pa.array(sizes, pa.int64())],
                                         names=[*batch.schema.names, "sketch", "size"])


def may_link(x: bytes, y: bytes) -> bool:
    p, q = LIMIT
    a, b = int.from_bytes(x[:4], "little"), int.from_bytes(y[:4], "little")
    if min(a, b) * q < max(a, b) * p:
        return False
    u, v = np.frombuffer(x, np.uint64, offset=4), np.frombuffer(y, np.uint64, offset=4)
    if len(u) > len(v):
        u, v = v, u
    if len(v) > len(u):
        v = np.bitwise_xor.reduce(v.reshape(-1, len(u)), axis=0)
    return int(np.bitwise_count(u ^ v).sum()) * (p + q) <= (a + b) * (q - p)


def _possible(batches):
    for batch in batches:
        keep = [may_link(x.as_py(), y.as_py()) for x, y in zip(batch.column("ta"), batch.column("tb"), strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def links_among(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose texts are similar. ``texts``: (key, text, sketch)."""

    def with_both(rows: DataFrame, column: str) -> DataFrame:
        left = texts.select(F.col("key").alias("a"), F.col(column).alias("ta"))
        right = texts.select(F.col("key").alias("b"), F.col(column).alias("tb"))
        return rows.join(left, "a").join(right, "b").select("a", "ta", "b", "tb")

    possible = stored(with_both(pairs, "sketch").mapInArrow(_possible, "a string, b string"), "possible")
    return with_both(possible, "text").mapInArrow(_verified, "a string, b string")


def components(links: DataFrame) -> DataFrame:
    """(key, component): connected components of (a, b) by least labels and pointer jumps, each step a Spark join."""
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("c")), "label")
    while True:
        around = both.join(label.select(F.col("a").alias("b"), "c"), "b").groupBy("a").agg(F.min("c").alias("m"))
        near = label.join(around, "a").select("a", F.least("c", "m").alias("n"), "c")
        up = label.select(F.col("a").alias("n"), F.col("c").alias("up"))
        step = stored(near.join(up, "n").select("a", F.least("n", "up").alias("c"), (F.least("n", "up") != F.col("c")).alias("new")), "label")
        moved = step.filter("new").limit(1).count()
        label = step.select("a", "c")
        if not moved:
            return label.select(F.col("a").alias("key"), F.col("c").alias("component"))


def signed_rows(docs: DataFrame) -> DataFrame:
    """(sig, owner, size): signatures with more than one owner (size -1), and the texts' sizes by their hashes."""
    signed = docs.select("_tid", "_md5", "_text").mapInArrow(_signed, "sig long, owner long, salt int")
    return stored(signed.withColumn("part", F.greatest("salt", F.lit(0))).repartition("sig", "part")
                  .sortWithinPartitions("sig").select("sig", "owner", "salt")
                  .mapInArrow(_shared, "sig long, owner long, size int"), "shared")


def candidates(shared: DataFrame) -> DataFrame:
    """(sig, tid, weight): signatures with their owners, without owners that share too few to have a partner.

    An owner that must share ``need`` signatures goes without its ``need - 1`` commonest ones: of those two similar sets
    share, the rarest can't be among them on either side. Weight: how much the owner shared with all others before.
    """
    shared = stored(shared.filter("size < 0").select("sig", "owner").distinct(), "shared")
    rows = shared.count()
    while True:
        enough = (shared.groupBy("owner").agg(F.count(F.lit(1)).alias("n"))
                  .filter(F.col("n") >= F.shiftright("owner", 48)).select("owner"))
        shared = shared.join(enough, "owner")
        many = shared.groupBy("sig").agg(F.min("owner").alias("lo"), F.max("owner").alias("hi")).filter("lo <> hi").select("sig")
        shared = stored(shared.join(many, "sig").select("sig", "owner"), "shared")
        left = shared.count()
        if left >= 0.9 * rows:  # also when none is left
            break
        rows = left
    counts = shared.groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
    common = Window.partitionBy("owner").orderBy(F.desc("n"), F.desc("sig"))
    kept = stored(shared.join(counts, "sig").withColumn("place", F.row_number().over(common))
                  .withColumn("weight", F.sum("n").over(Window.partitionBy("owner")))
                  .filter(F.col("place") >= F.shiftright("owner", 48))
                  .select("sig", F.col("owner").bitwiseAND((1 << TID_BITS) - 1).alias("tid"), "weight"), "kept")
    many = kept.groupBy("sig").agg(F.min("tid").alias("lo"), F.max("tid").alias("hi")).filter("lo <> hi").select("sig")
    member = kept.join(many, "sig")
    # of signatures with the same owners one is enough
    alike = member.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("tid")).alias("x"), F.sum(F.hash("tid").cast("long")).alias("y"))
    return member.join(alike.groupBy("n", "x", "y").agg(F.min("sig").alias("sig")).select("sig"), "sig")


def _elements(batches):
    """(id, e): the shingle hashes of each text."""

    def block(ids: list[bytes], sets: list[np.ndarray]) -> pa.RecordBatch:
        owner = np.repeat(np.arange(len(ids)), [len(x) for x in sets])
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()).take(pa.array(owner)), pa.array(np.concatenate(sets).view(np.int64))], names=["id", "e"])

    ids, sets, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column("id").to_pylist(), _texts(batch.column("text")), strict=True):
            ids.append(key)
            sets.append(shingle_set(text))
            held += len(sets[-1])
            if held >= BLOCK // 4:
                yield block(ids, sets)
                ids, sets, held = [], [], 0
    if ids:
        yield block(ids, sets)


def overlap_needed(n: Column, other: Column) -> Column:
    """The fewest elements that similar sets of these sizes share."""
    p, q = LIMIT
    return F.ceil((n + other) * p / (p + q)).cast("int")


def size_class(n: Column) -> Column:
    return F.floor(F.log(n) / math.log(CLASS)).cast("int")


def refined_pairs(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): pairs of members that may still be similar, by the first of their rarest elements that they share.

    ``members``: (key, c), texts of open signatures and their components; pairs within one are left out. Elements are
    ordered by the number of members that hold them. Of two similar sets the first common element stands at places i
    and j with at least the needed overlap from there on, so the larger one is looked up, in each class of sizes that
    a smaller partner may have, under as many of its first elements as that class allows. Where one component holds
    most members of an element, they meet only those of other components.
    """
    p, q = LIMIT
    rows = texts.join(members.select("key"), "key", "left_semi").select(F.unhex("key").alias("id"), "text")
    rows = stored(rows.mapInArrow(_elements, "id binary, e long"), "elements")
    held = rows.join(rows.groupBy("e").agg(F.count(F.lit(1)).alias("m")), "e")
    placed = held.withColumn("i", F.row_number().over(Window.partitionBy("id").orderBy("m", "e"))).filter("m > 1")
    who = members.join(texts.select("key", "size"), "key").select(F.unhex("key").alias("id"), F.col("size").cast("int").alias("n"), "c")
    n, i = F.col("n"), F.col("i")
    # the larger set's places reach furthest, towards its smallest partner
    smallest = F.ceil(n * p / q).cast("int")
    placed = stored(placed.join(who, "id").filter(i <= n - overlap_needed(n, smallest) + 1).select("e", "id", "n", "i", "c"), "placed")
    parts = placed.groupBy("e", "c").agg(F.count(F.lit(1)).alias("m"))
    mixed = parts.groupBy("e").agg(F.max(F.struct("m", "c")).getField("c").alias("most"), F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi")
    placed = stored(placed.join(mixed.select("e", "most"), "e").withColumn("of_most", F.col("c") == F.col("most")).drop("most"), "placed")
    # members of an element's largest component (side 1) look up the others only, the others look up all
    small_side = (placed.filter(i <= n - overlap_needed(n, n) + 1).withColumn("side", F.explode(F.expr("if(of_most, array(0), array(0, 1))")))
                  .select("e", size_class(n).alias("k"), "side", F.col("id").alias("b"), n.alias("bn"), i.alias("bi"), F.col("c").alias("bc")))
    large_side = placed.withColumn("k", F.explode(F.sequence(size_class(smallest), size_class(n))))
    least = F.greatest(smallest, F.floor(F.pow(F.lit(CLASS), F.col("k"))).cast("int") - 1)
    large_side = (large_side.filter(i <= n - overlap_needed(n, least) + 1)
                  .select("e", "k", F.col("of_most").cast("int").alias("side"), F.col("id").alias("a"), "n", "i", "c"))
    found = (large_side.join(small_side, ["e", "k", "side"]).filter("c <> bc AND (n > bn OR n = bn AND a > b)")
             .filter((F.col("bn") * q >= n * p) & (F.least(n - i, F.col("bn") - F.col("bi")) + 1 >= overlap_needed(n, F.col("bn")))))
    return found.select(F.lower(F.hex("a")).alias("a"), F.lower(F.hex("b")).alias("b")).distinct()


def similar_groups(spark: SparkSession, docs: DataFrame, shared: DataFrame) -> DataFrame:
    """(key, component) of all distinct texts that have a link. ``docs``: (_doc, _text, _tid, _md5)."""
    member = stored(candidates(shared), "candidates")
    tids = stored(member.select("tid").distinct(), "tids")
    own = F.col("_tid").bitwiseAND((1 << TID_BITS) - 1)
    texts = (docs.withColumn("tid", own).join(small(tids), "tid", "left_semi")
             .groupBy("_md5").agg(F.first("tid").alias("tid"), F.first("_text").alias("text"))
             .withColumnRenamed("_md5", "key").mapInArrow(_sketched, "key string, tid long, text string, sketch binary, size long"))
    texts = stored(texts, "texts")
    keys = texts.select("tid", "key", "size")
    member = stored(member.join(keys, "tid").groupBy("sig", "key", "size").agg(F.max("weight").alias("weight")), "member")
    # in a group of near copies the original shares most and is the center of the star
    center = (member.groupBy("sig").agg(F.max(F.struct("weight", "key", "size")).alias("center"))
              .select("sig", F.col("center.key").alias("b"), F.col("center.size").alias("bsize")))
    p, q = LIMIT
    star = stored(member.join(center, "sig").select("sig", "key", "size", "b", "bsize"), "star")
    pairs = star.filter("key <> b").filter(F.least("size", "bsize") * q >= F.greatest("size", "bsize") * p).select(F.col("key").alias("a"), "b").distinct()
    pairs = stored(pairs, "pairs")
    links = stored(links_among(pairs, texts), "verified")
    group = components(links)
    placed = star.join(group, "key", "left").select("sig", "key", "b", F.coalesce("component", "key").alias("c"))
    open_ = placed.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("n")).filter("lo <> hi AND n > 2").select("sig")
    placed = stored(placed.join(open_, "sig").select("key", "b", "c").distinct(), "open")
    if not placed.limit(1).count():
        return group
    found = refined_pairs(stored(placed.select("key", "c").distinct(), "members"), texts)
    # only members of one signature's star, not compared yet
    stars = placed.select("key", F.col("b").alias("of"))
    both = found.join(stars.withColumnRenamed("key", "a"), "a").join(stars.withColumnRenamed("key", "b"), ["b", "of"]).select("a", "b").distinct()
    known = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    more = stored(links_among(stored(both.join(known, ["a", "b"], "left_anti"), "pairs"), texts), "verified")
    return components(links.unionByName(more)) if more.limit(1).count() else group


def prepared(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("_doc"), text.alias("_text"),
                       F.xxhash64(text).alias("_tid"), F.md5(text).alias("_md5"))


def grouped_rows(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each row's (_doc, _md5, _n), _n its number of shingles, and (_md5, component) of the texts with links or copies."""
    rows = prepared(docs)
    shared = signed_rows(rows)
    group = similar_groups(spark, rows, shared)
    sizes = shared.filter("size >= 0").select(F.col("sig").alias("_tid"), F.col("owner").alias("_half"), F.col("size").cast("long").alias("_n")).distinct()
    half = F.conv(F.substring("_md5", 1, 15), 16, 10).cast("long")
    sized = stored(rows.select("_doc", "_md5", "_tid", half.alias("_half")).join(sizes, ["_tid", "_half"], "left")
                   .select("_doc", "_md5", F.coalesce("_n", F.lit(0).cast("long")).alias("_n")), "sizes")
    group = group.select(F.col("key").alias("_md5"), F.col("component"))
    classes = (sized.filter("_n > 0").groupBy("_md5").agg(F.min("_doc").alias("least"), F.count(F.lit(1)).alias("copies"))
               .join(group, "_md5", "left").filter("copies > 1 OR component IS NOT NULL")
               .withColumn("component", F.coalesce("component", "_md5")))
    return sized, stored(classes, "classes")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    sized, classes = grouped_rows(spark, docs)
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(classes.join(least, "component").select("_md5", "component_id"), "named")
    return (sized.join(small(named), "_md5", "left")
            .select(F.col("_doc").alias("doc_id"), F.col("_n").alias("n_shingles"),
                    F.coalesce("component_id", "_doc").alias("component_id")))


def one_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents without their near duplicates: of each group the row with the smallest doc_id stays (and of
    its texts there the one with the smallest MD5).

    Decided by row, as a doc_id may stand on several: of repeated rows of a group one stays, other texts with the
    same doc_id are judged by their own groups. Rows without doc_id or without words stay.
    """
    classes = grouped_rows(spark, docs)[1]
    first = classes.filter("least IS NOT NULL").groupBy("component").agg(F.min(F.struct("least", "_md5")).alias("first"))
    judged = stored(classes.join(first, "component")
                    .select(F.col("_md5").alias("_text_md5"), F.when(F.col("_md5") == F.col("first._md5"), F.col("first.least")).alias("_stays"), "copies"), "judged")
    names, text_md5, own = docs.columns, F.md5(F.col("text").cast("string")), F.col("doc_id").cast("long")
    keyed = docs.withColumns({"_md5_of_row": text_md5, "_id_of_row": own})
    same = F.col("_md5_of_row") == F.col("_text_md5")
    gone = same & F.col("_id_of_row").isNotNull() & ~F.col("_id_of_row").eqNullSafe(F.col("_stays"))
    left = keyed.join(small(judged), gone, "left_anti")
    again = stored(judged.filter("_stays IS NOT NULL AND copies > 1").select("_text_md5", "_stays"), "again")
    if not again.limit(1).count():
        return left.select(*names)
    repeated = same & (F.col("_id_of_row") == F.col("_stays"))
    twice = left.join(small(again), repeated, "left_semi").dropDuplicates(["_md5_of_row"])
    return left.join(small(again), repeated, "left_anti").unionByName(twice).select(*names)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(spark, table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[i:i + 4] END AS s
    FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i) WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), both_ways AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reached(start, pos) AS (
    SELECT a, b FROM both_ways UNION SELECT r.start, e.b FROM reached r JOIN both_ways e ON r.pos = e.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(c, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT start, min(pos) AS c FROM reached GROUP BY start) r ON r.start = d.doc_id
"""
