"""Benchmark decontamination with spaced seeds (operator 8), in DataFrame functions only.

Texts are tokens: runs of letters and digits, lower-cased. A mask keeps some positions of a window and ignores the
others, so its hash survives substitutions there; the hashes of all windows of all documents meet those of the
benchmark items. Hits of one text and item with the same distance are one diagonal: along it the text is laid over
the whole item without gaps, and the best stretch counts 1 for each equal token and -1 for each other one; a stretch
of at least ``SCORE`` is an overlap.

The benchmark's hashes are broadcast in chunks of a counted bound, so windows of documents are never shuffled:
a larger benchmark takes more passes, not more memory. Only texts with a hit are tokenized again to be scored.

Defined results: null and empty texts have no tokens; items with fewer tokens than the shortest mask can't be
found, and overlaps need ``SCORE`` tokens anyway; equal items are all reported; a null doc_id is passed on; repeated rows
are reported once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small, stored, table

#: Masks over a window of tokens: 1 is kept, 0 ignored.
MASKS = ("11101101111", "11011110111", "11110011111")
SPAN = len(MASKS[0])
#: Least score of an overlap.
SCORE = 10
#: Hashes of the benchmark in one broadcast (a long and a number each).
CHUNK = 1_000_000


def token_hashes(text: Column) -> Column:
    words = F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def mask_hash(tokens: Column, at: Column, mask: int) -> Column:
    kept = [F.get(tokens, at + j) for j, c in enumerate(MASKS[mask]) if c == "1"]
    return F.xxhash64(*kept, F.lit(mask))


def windows(rows: DataFrame) -> DataFrame:
    """The rows with _at and _hash for each window and mask. ``rows`` has _tokens."""
    at = F.explode(F.sequence(F.lit(0), F.size("_tokens") - SPAN))
    placed = rows.filter(F.size("_tokens") >= SPAN).withColumn("_at", at)
    return placed.withColumn("_hash", F.explode(F.array(*[mask_hash(F.col("_tokens"), F.col("_at"), m) for m in range(len(MASKS))])))


def score(doc: Column, item: Column) -> Column:
    """The best stretch of two aligned token lists of one length."""
    steps = F.zip_with(doc, item, lambda a, b: F.when(a == b, 1).otherwise(-1))
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))

    def add(s: Column, x: Column) -> Column:
        now = F.greatest(s["now"] + x, F.lit(0))
        return F.struct(now.alias("now"), F.greatest(s["best"], now).alias("best"))

    return F.aggregate(steps, zero, add, lambda s: s["best"])


def diagonals(spark: SparkSession, texts: DataFrame, items: DataFrame) -> DataFrame:
    """(_md5, item_id, _item, _lead, _first): a text's distances to an item at which a seed hits, and the first hit's place.

    ``texts``: (_md5, _tokens), ``items``: (item_id, _item, _tokens).
    """
    hashed = windows(items).select("_hash", "item_id", "_item", F.col("_at").alias("item_at"))
    keys = stored(hashed.select("_hash").distinct(), "seeds")
    chunks = max(1, -(-keys.count() // CHUNK))

    def hits(chunk: int) -> DataFrame:
        some = keys.filter(F.pmod(F.col("_hash"), F.lit(chunks)) == chunk) if chunks > 1 else keys
        return windows(texts).join(F.broadcast(some), "_hash").select("_md5", "_hash", F.col("_at").alias("doc_at"))

    found = stored(reduce(DataFrame.unionAll, map(hits, range(chunks))), "hits")
    placed = found.join(hashed, "_hash").withColumn("_lead", F.col("doc_at") - F.col("item_at"))
    return stored(placed.groupBy("_md5", "item_id", "_item", "_lead").agg(F.min("doc_at").alias("_first")), "diagonals")


def overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that overlap: doc_id, item_id, score, doc_at, item_at (of the first such hit)."""
    return (text_overlaps(spark, docs, benchmark).groupBy("doc_id", "item_id")
            .agg(F.max("score").cast("long").alias("score"), F.min(F.struct("doc_at", "item_at")).alias("_first"))
            .select("doc_id", "item_id", "score", F.col("_first.doc_at").cast("long").alias("doc_at"), F.col("_first.item_at").cast("long").alias("item_at")))


def text_overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The overlaps of each row's text: doc_id, _md5, item_id, score, doc_at, item_at."""
    tests = benchmark.select(F.col("item_id").cast("long").alias("item_id"), token_hashes(F.col("text").cast("string")).alias("_tokens"))
    tests = stored(tests.withColumn("_item", F.md5(F.concat_ws(" ", F.col("_tokens").cast("array<string>")))).distinct(), "items")
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("_md5"), text.alias("_text"))
    tokens = token_hashes(F.col("_text")).alias("_tokens")
    found = diagonals(spark, rows.select("_md5", tokens), tests)
    hit = stored(found.select("_md5").distinct(), "hit")
    own = rows.join(small(hit), "_md5", "left_semi").select("doc_id", "_md5", tokens)
    item = tests.select("_item", F.col("_tokens").alias("_other")).dropDuplicates(["_item"])
    start, other = F.greatest("_lead", F.lit(0)), F.greatest(-F.col("_lead"), F.lit(0))
    length = F.least(F.size("_tokens") - start, F.size("_other") - other)
    best = score(F.slice("_tokens", start + 1, length), F.slice("_other", other + 1, length))
    return (own.join(small(found), "_md5").join(item, "_item").withColumn("score", best).filter(F.col("score") >= SCORE)
            .select("doc_id", "_md5", "item_id", "score", F.col("_first").alias("doc_at"), (F.col("_first") - F.col("_lead")).alias("item_at")))


def decontaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap no item, with their own columns; decided by row, as a doc_id may stand on several.

    Rows without doc_id stay.
    """
    leaks = stored(text_overlaps(spark, docs, benchmark).filter("doc_id IS NOT NULL").select(F.col("_md5").alias("_leak")).distinct(), "leaks")
    leak = (F.md5(F.col("text").cast("string")) == F.col("_leak")) & F.col("doc_id").cast("long").isNotNull()
    return docs.join(small(leaks), leak, "left_anti")


def op8_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
