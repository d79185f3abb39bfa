"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

Documents are dealt into blocks of consecutive ids. Every block sends the distinct hashes of
its windows, sorted, to hash buckets; a bucket merges the sorted runs of all blocks and tells
each block which of its hashes occur in an earlier block. A block then knows of every window
whether its word sequence starts earlier anywhere, and merges the repeated windows into maximal
removal intervals. A passage that a third of all documents share is one hash per block, so no
bucket or block grows with the number of its occurrences.

Windows are compared by 64-bit hashes; n windows hold a false match with probability n^2 / 2^65.

Defined results: null and empty texts have no words; texts shorter than the window lose nothing;
rows that share an id are taken in the order of their texts, so the second of two equal rows
repeats the first; null ids come first; other columns are returned as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from panelcast.llm.common import chunks, id_ranges, packed, range_of, rolling, small_batches, word_hashes

#: Text of one block, and window hashes that a task holds before it sends them.
BLOCK_BYTES = 4_000_000
FLUSH_HASHES = 1_000_000


def _windows(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Window hashes, the word each starts at, the first word of every text, and the number of words."""
    h, first = word_hashes(texts, lower=False)
    all_hashes = rolling(h, width)
    n_windows = np.maximum(np.diff(first) - width + 1, 0)
    at = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(n_windows)[:-1]]), n_windows) + np.arange(n_windows.sum())
    return all_hashes[at], at, first, np.diff(first)


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted distinct 64-bit values as differences of the least sufficient byte width."""
    gaps = np.diff(values)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    raw = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + int(values[0]).to_bytes(8, "little") + np.ascontiguousarray(raw).tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    width, first = blob[0], int.from_bytes(blob[1:9], "little")
    raw = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    gaps = np.zeros((len(raw) + 1, 8), np.uint8)
    gaps[1:, :width] = raw
    gaps = gaps.view("<u8").ravel().copy()
    gaps[0] = first
    return np.cumsum(gaps, dtype=np.uint64)


def _bucketed(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Slices of sorted hashes by bucket; a bucket is a range of hashes."""
    of = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(hashes)]]) if len(hashes) else [0]
    for a, b in zip(cut[:-1], cut[1:]):
        yield int(of[a]), pack_sorted(hashes[a:b])


_SENT = "block int, bucket int, hashes binary"
_SENT_ARROW = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("hashes", pa.binary())])


def _send(width: int, buckets: int):
    def flush(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        rows = [(block, k, blob) for block, parts in held.items()
                for k, blob in _bucketed(np.unique(np.concatenate(parts)), buckets)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _SENT_ARROW.types)], schema=_SENT_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size = 0
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())
            for some in chunks(rows, lambda r: len(r[1] or b"")):
                hashes, at, first, _ = _windows([t or b"" for _, t in some], width)
                block = np.fromiter((b for b, _ in some), np.int64, len(some))
                of = block[np.searchsorted(first, at, side="right") - 1]
                for b in np.unique(of):
                    held.setdefault(int(b), []).append(hashes[of == b])
                size += len(hashes)
                if size >= FLUSH_HASHES:
                    yield from flush(held)
                    held, size = {}, 0
        yield from flush(held)

    return run


def _count(table: pa.Table) -> pa.Table:
    """For one bucket: each block's hashes that an earlier block has too."""
    runs = sorted(zip(table["block"].to_pylist(), table["hashes"].to_pylist()), key=lambda r: r[0])
    parts = [unpack_sorted(blob) for _, blob in runs]
    hashes = np.concatenate(parts)
    block = np.repeat(np.array([b for b, _ in runs], np.int32), [len(p) for p in parts])
    order = np.argsort(hashes, kind="stable")
    hashes, block = hashes[order], block[order]
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    first = block[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    seen = block != first
    hashes, block = hashes[seen], block[seen]
    rows = [(int(b), 0, pack_sorted(np.unique(hashes[block == b]))) for b in np.unique(block)]
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(_SENT_ARROW.types)], schema=_SENT_ARROW)


def _cut(width: int, out: pa.Schema, verbatim: bool):
    def run(docs: pa.Table, seen: pa.Table) -> pa.Table:
        keys = [("id", "ascending"), ("text", "ascending")]
        docs = docs.take(pc.sort_indices(docs.select(["id", "text"]), keys, null_placement="at_start"))
        known = np.unique(np.concatenate([np.zeros(0, np.uint64), *map(unpack_sorted, seen["hashes"].to_pylist())]))
        texts = [t or b"" for t in docs["text"].cast(pa.binary()).to_pylist()]
        parts, word0 = [], 0
        n_words: list[int] = []
        for some in chunks(((t,) for t in texts), lambda r: len(r[0])):
            hashes, at, _, n = _windows([t for t, in some], width)
            parts.append((hashes, at + word0))
            n_words += n.tolist()
            word0 += int(n.sum())
        hashes = np.concatenate([np.zeros(0, np.uint64), *(p[0] for p in parts)])
        at = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)])
        _, earliest = np.unique(hashes, return_index=True)
        repeated = np.ones(len(hashes), bool)
        repeated[earliest] = False
        if len(known):
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            repeated |= known[place] == hashes
        step = np.zeros(word0 + 1, np.int32)
        np.add.at(step, at[repeated], 1)
        np.add.at(step, at[repeated] + width, -1)
        covered = np.cumsum(step[:-1]) > 0
        kept, spans, removed, word = [], [], [], 0
        for text, n in zip(texts, n_words):
            mask, words = covered[word:word + n], text.split()
            word += n
            edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[0::2], edge[1::2])])
            removed.append(int(mask.sum()))
            if removed[-1]:
                words = [w for w, gone in zip(words, mask.tolist()) if not gone]
            elif verbatim:
                words = [text]
            kept.append(b" ".join(words).decode("utf-8", "replace"))
        return pa.table([docs["row"], pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                         pa.array(spans, out.field("spans").type), pa.array(kept, pa.string())], schema=out)

    return run


def remove_repeats(docs: DataFrame, width: int = 20, id_col: str = "doc_id", text_col: str = "text", verbatim: bool = False) -> DataFrame:
    """Every row of ``docs`` (without its text) as ``row``, with n_words, n_removed, removal spans in words, and kept_text.

    A word goes if a window of ``width`` words covers it whose sequence also starts earlier. The kept
    words are joined by single spaces; with ``verbatim``, a text that loses nothing stays as it is.
    """
    spark = docs.sparkSession
    small_batches(spark)
    cuts = id_ranges(docs, id_col, text_col, BLOCK_BYTES)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = docs.select(range_of(F.col(id_col).cast("long"), cuts).alias("block"), F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).alias("text"), packed(docs.drop(text_col)))
    sent = held.select("block", "text").mapInArrow(_send(width, buckets), _SENT)
    seen = sent.groupBy("bucket").applyInArrow(_count, _SENT)
    made = "n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string"
    result = StructType([held.schema["row"], *StructType.fromDDL(made).fields])
    run = _cut(width, to_arrow_schema(result), verbatim)
    return held.groupBy("block").cogroup(seen.groupBy("block")).applyInArrow(run, result)




def cut_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with the repeats cut out of its texts, and the sizes of cut texts counted anew.

    A text that loses all its words becomes empty; null texts that lose nothing stay null.
    """
    found = remove_repeats(docs.withColumn("__null", F.col(text_col).isNull()), width, id_col, text_col, verbatim=True)
    values = {text_col: F.when(~F.col("row.__null"), F.col("kept_text"))}
    if size_col in docs.columns:
        old = F.col(f"row.`{size_col}`")
        values[size_col] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(docs.schema[size_col].dataType)).otherwise(old)
    return found.select(*[values.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
