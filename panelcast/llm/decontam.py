"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

Words are runs of ``[0-9a-z]`` and non-ASCII bytes after lower-casing A-Z. Every benchmark item
yields windows of ``width`` words (a shorter item is one window of its own length). A window is a
set of positioned shingles of ``SHINGLE`` words; a document contains it only if it holds all of
them, so the necessary prefix under any order is one shingle, and the order is by rarity in the
documents. The join on that rarest shingle gives candidates; the shingle's place in the window
fixes where the window must start (positional bound) and whether it fits into the document (length
bound); the words of the survivors are then compared exactly. Shingles are hashed over ``lower``
of the words, which never separates words that are equal once A-Z is lower-cased.

The windows are broadcast while their counted number stays under ``BROADCAST_WINDOWS``; beyond it
the shingles are shuffled and the survivors are joined back to the words. A window that occurs
everywhere costs one candidate per occurrence, never a pair of documents. What was found is joined back to
the documents the same way: broadcast while its counted size stays under ``BROADCAST_MARKS``, so that no text is shuffled.

Defined results: null and empty texts have no words, no hits and are not contaminated; items
without words are ignored; a window in several items counts for each; rows with equal id and text
get equal results; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import LOWER, UPPER, packed, written

SHINGLE = 3
#: A window is about 150 bytes: 30 MB at most.
BROADCAST_WINDOWS = 200_000
#: Documents with hits and the items they hold, about 50 bytes each: 20 MB at most.
BROADCAST_MARKS = 400_000


def words(text: Column) -> Column:
    """Words of a text in their own case."""
    found = F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", -1)
    return F.filter(found, lambda w: w != "")


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _shingle(array: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.lower(F.get(array, at + F.lit(i))) for i in range(size)])


def item_windows(items: DataFrame, width: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, and the exact words of each of its windows joined by a space."""
    w, n = F.col("w"), F.size("w")
    starts = F.sequence(F.lit(0), F.greatest(n - F.lit(width), F.lit(0)))
    return (items.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(n > 0)
            .select("item_id", "w", F.explode(starts).alias("at"))
            .select("item_id", lowered(F.array_join(F.slice(w, F.col("at") + 1, width), " ")).alias("window")).distinct())


def _positions(docs: DataFrame, size: int) -> DataFrame:
    """Each place of each document with the shingle of ``size`` words that begins there."""
    placed = docs.select("k1", "k2", "w", F.posexplode("w").alias("at", "word"))
    following = [F.lower(F.get("w", F.col("at") + F.lit(i))) for i in range(1, size)]
    return placed.where(F.col("at") + size <= F.size("w")).select("k1", "k2", "w", "at", F.xxhash64(F.lower("word"), *following).alias("shingle"))


def hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """k1, k2, start, length, window of every occurrence; ``docs`` has k1, k2 and words w."""
    parts = F.split("window", " ")
    windows = windows.select("window").distinct().select("window", F.size(parts).alias("length"), parts.alias("parts"))
    windows = written(windows, "windows")
    sizes = [(size, n) for (size, n) in windows.groupBy(F.when(F.col("length") >= SHINGLE, SHINGLE).otherwise(1)).count().collect()]
    found = None
    for size, n in sizes:
        some = windows.where(F.col("length") >= SHINGLE if size == SHINGLE else F.col("length") < SHINGLE)
        one = _hits_of(docs, some, size, n <= BROADCAST_WINDOWS)
        found = one if found is None else found.unionByName(one)
    return found if found is not None else docs.limit(0).selectExpr("k1", "k2", "0 start", "0 length", "'' window")


def _hits_of(docs: DataFrame, windows: DataFrame, size: int, small: bool) -> DataFrame:
    hint = F.broadcast if small else (lambda df: df)
    places = _positions(docs, size)
    offsets = F.sequence(F.lit(0), F.col("length") - F.lit(size))
    shingles = windows.select("window", "length", "parts", F.explode(offsets).alias("offset"))
    shingles = shingles.select("window", "length", "offset", _shingle(F.col("parts"), F.col("offset"), size).alias("shingle"))
    rarity = places.select("shingle").join(hint(shingles.select("shingle").distinct()), "shingle").groupBy("shingle").count()
    ordered = shingles.join(rarity, "shingle", "left").groupBy("window", "length").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "shingle", "offset")).alias("rarest"))
    # a window whose rarest shingle occurs nowhere cannot occur
    prefix = ordered.where(F.col("rarest.count") > 0).select("window", "length", "rarest.shingle", "rarest.offset")
    prefix = written(prefix, "prefix")
    start = (F.col("at") - F.col("offset")).alias("start")
    if small:
        found = places.join(F.broadcast(prefix), "shingle").select("k1", "k2", "w", start, "length", "window")
    else:
        found = places.drop("w").join(prefix, "shingle").select("k1", "k2", start, "length", "window").join(docs, ["k1", "k2"])
    fits = found.where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.size("w")))
    same = lowered(F.array_join(F.slice("w", F.col("start") + 1, F.col("length")), " ")) == F.col("window")
    return fits.where(same).select("k1", "k2", "start", "length", "window")


def find_contamination(docs: DataFrame, items: DataFrame, width: int = 13, share: int = 20,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as ``row``, with n_words, n_hit, the ids of the items found and contaminated.

    A document is contaminated if at least one word in ``share`` lies in an occurrence of a window.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    k1, k2 = F.xxhash64(F.col(id_col), text).alias("k1"), F.xxhash64(F.lit("k2"), text, F.col(id_col)).alias("k2")
    keyed = docs.select(k1, k2, words(F.col(text_col)).alias("w"))
    windows = written(item_windows(items, width), "items")
    found = written(hits(keyed, windows).distinct(), "hits")

    end = F.col("start") + F.col("length")
    before = F.max(end).over(Window.partitionBy("k1", "k2").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(before, F.lit(0))))
    spans = found.select("k1", "k2", "start", "length").distinct().withColumn("new", new)
    covered = spans.groupBy("k1", "k2").agg(F.sum("new").alias("n_hit"))
    of_items = (found.select("k1", "k2", "window").distinct().join(windows, "window").select("k1", "k2", "item_id").distinct()
                .groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items")))
    held = docs.select(packed(docs), k1, k2, F.size(words(F.col(text_col))).cast("long").alias("n_words"))
    marks = written(covered.join(of_items, ["k1", "k2"]), "marks")
    size = marks.agg(F.sum(F.size("items") + 1)).first()[0] or 0
    out = held.join(F.broadcast(marks) if size <= BROADCAST_MARKS else marks, ["k1", "k2"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("row", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))
