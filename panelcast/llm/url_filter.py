"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

A listed entry is a canonical URL: host (lower case) and the beginning of a path, with a verdict.
Every page URL is expanded to the canonical URLs that could be on the list (each host suffix at a
label, with each path beginning of a listed length). The filter has blocks of eight 32-bit words;
an entry sets one bit in every word of one block. Expanded URLs whose eight bits are all set pass
to an exact hash join with the list, which removes the false positives. The longest entry wins.

Everything is DataFrame functions. The filter takes about 11 bits an entry and is broadcast
only while its blocks, whose number follows from the counted list, stay under
``BROADCAST_BLOCKS``; beyond that it is joined by block after the expanded URLs are made distinct.
The exact join is left to the planner (the list is broadcast only if measured small; else a
sort-merge join whose hot hosts AQE splits). Each distinct URL is judged once.

Defined results: a null URL, or one without ``://``, has an empty host and path and gets the
default verdict; an entry that is listed twice counts once (allow before block); entries of equal
length prefer the longer host; repeated rows are all returned; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import LOWER, UPPER, packed

#: A block has 256 bits; so many entries share one, which keeps false positives near 1 in 200.
ENTRIES_PER_BLOCK = 24
#: 32 bytes a block: the broadcast filter has 32 MB at most.
BROADCAST_BLOCKS = 1_000_000


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, parts, 1), F.lit(""))
    return F.translate(host, UPPER, LOWER), F.coalesce(F.regexp_extract(url, parts, 2), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")


def _bits(key: Column) -> list[Column]:
    """One bit of each of the eight words: five bits each of a second hash."""
    h = F.xxhash64(F.lit("bit"), key)
    return [F.call_function("shiftleft", F.lit(1), F.shiftright(h, 5 * i).bitwiseAND(F.lit(31)).cast("int")) for i in range(8)]


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter as rows: block, and its eight words w0..w7."""
    k = F.col("key")
    words = [b.alias(f"w{i}") for i, b in enumerate(_bits(k))]
    return keys.select(_block(k, blocks), *words).groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)])


def possible(keys: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``keys`` whose eight bits are all set."""
    hit = None
    for i, bit in enumerate(_bits(F.col("key"))):
        one = F.col(f"w{i}").bitwiseAND(bit) != 0
        hit = one if hit is None else hit & one
    small = blocks <= BROADCAST_BLOCKS
    joined = keys.withColumn("block", _block(F.col("key"), blocks)).join(F.broadcast(bloom) if small else bloom, "block")
    return joined.where(hit).select(*keys.columns)


def expanded(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """Canonical URLs that could be listed: each host suffix with each path beginning of a listed length."""
    host, path = F.col("host"), F.col("path")
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    at = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    out = urls.withColumn("suffix", F.explode(F.array_distinct(suffixes))).withColumn("length", F.explode(at))
    return out.select("url", F.concat("suffix", F.substr("path", F.lit(1), F.col("length"))).alias("key"),
                      F.length("suffix").alias("host_length"))


def judge(pages: DataFrame, listed: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Every row of ``pages`` as ``row``, with host, path, rule and verdict.

    ``listed`` has host, path and verdict of each entry; an empty path fits all paths.
    """
    entries = (listed.where(F.col("host").isNotNull() & (F.col("host") != ""))
               .select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
               .groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
               .select(F.concat("host", "path").alias("key"), F.length("host").alias("host_length"), "verdict"))
    # One row: the number of entries, and the distinct path lengths (no more than the longest path).
    n, lengths = entries.agg(F.count("*"), F.collect_set(F.length("key") - F.col("host_length"))).first()
    blocks = n // ENTRIES_PER_BLOCK + 1
    host, path = host_path(F.col(url_col))
    held = pages.select(packed(pages), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    if not n:
        return held.select("row", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    urls = held.select("url", "host", "path").distinct().where(F.col("host") != "")
    tried = expanded(urls, sorted(lengths))
    bloom = bloom_blocks(entries.select("key"), blocks)
    if blocks <= BROADCAST_BLOCKS:
        hits = possible(tried, bloom, blocks)
    else:
        hits = tried.join(possible(tried.select("key").distinct(), bloom, blocks), "key", "left_semi")
    found = hits.join(entries, ["key", "host_length"])
    best = found.groupBy("url").agg(F.max_by(F.struct("key", "verdict"), F.struct(F.length("key"), "host_length")).alias("best"))
    return (held.join(best, "url", "left")
            .select("row", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
