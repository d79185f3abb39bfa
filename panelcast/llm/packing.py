"""Packing in space-filling-curve order.

Each document's hashed word vector is projected to three dimensions and gets the Hilbert key of
its cell, so that alike documents have close keys. Documents are range-partitioned and sorted by
that key (ties by a hash of id and text) and laid end to end; the token stream is cut every
``length`` ids. All sequences are full but the very last, and neighbours along the curve share one.

Token ids are made once and kept compressed in the shared folder; the places of the ranges in the
stream come from one sum per range, so the ids are shuffled once.

Defined results: a null or empty text holds only the end id and lies at the centre of the curve's
space; repeated rows are packed each; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import chunks, range_of, small_batches, word_hashes, written
from panelcast.llm.tokens import encoder

DIMENSIONS, BITS = 3, 10
BUCKETS = 1 << 16
#: Ids of one range of the curve.
RANGE_IDS = 2_000_000

_PROJECTION = np.random.RandomState(11).standard_normal((BUCKETS, DIMENSIONS))


def coordinates(texts: list[bytes]) -> np.ndarray:
    """Cells of the projected unit vectors of word counts, 0 to 2**BITS - 1 in each dimension."""
    h, first = word_hashes(texts, lower=True)
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(first))
    keys, counts = np.unique((doc << np.uint64(32)) | (h % np.uint64(BUCKETS)), return_counts=True)
    doc, bucket = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(BUCKETS - 1)).astype(np.int64)
    norm = np.sqrt(np.bincount(doc, weights=counts.astype(float) ** 2, minlength=len(texts)))
    out = np.stack([np.bincount(doc, weights=counts * _PROJECTION[bucket, d], minlength=len(texts)) for d in range(DIMENSIONS)], axis=1)
    unit = out / np.maximum(norm, 1e-12)[:, None]
    return np.clip((unit + 3) / 6 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of every cell, by the transposed Gray-code form, highest bit first."""
    x = [cells[:, d].copy() for d in range(cells.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for d in range(n):
            turned = (x[d] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[d]) & (q - 1))
            x[0] = np.where(turned, x[0] ^ (q - 1), x[0] ^ swap)
            x[d] = x[d] ^ swap if d else x[0]
        q >>= 1
    for d in range(1, n):
        x[d] = x[d] ^ x[d - 1]
    flip, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x = [c ^ flip for c in x]
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(n):
            key = (key << 1) | ((x[d] >> b) & 1)
    return key


_TOKENS = "curve long, doc_id long, n long, ids binary"


def _tokenize(tokenizer: str, end_id: int):
    schema = pa.schema([("curve", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, squeeze = encoder(tokenizer), zstandard.ZstdCompressor(level=1)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for some in chunks(rows, lambda r: len(r[2] or "")):
                texts = [t or "" for _, _, t in some]
                found = [np.concatenate([ids, end]).astype(encode.dtype) for ids in encode.encode(texts)]
                key = hilbert(coordinates([t.encode() for t in texts]))
                tie = np.array([r[0] for r in some], np.int64) & ((1 << 33) - 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array((key << 33) | tie), pa.array([r[1] for r in some], pa.int64()), pa.array([len(i) for i in found], pa.int64()),
                    pa.array([squeeze.compress(i.tobytes()) for i in found], pa.binary())], schema=schema)

    return run


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _cut(before: dict[int, int], length: int, dtype: np.dtype):
    schema = pa.schema([(c.split()[0], pa.int64()) for c in _PIECES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        now, place = None, 0
        for batch in batches:
            out = []
            for part, doc, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if part != now:
                    now, place = part, before[part]
                ids = np.frombuffer(expand.decompress(blob), dtype).astype("<u4")
                at = 0
                while at < len(ids):
                    n = min(len(ids) - at, length - place % length)
                    out.append((doc, at, n, zlib.crc32(ids[at:at + n].tobytes()), len(ids), place // length, place % length))
                    at += n
                    place += n
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: the document, its ids before and in the piece, and the piece's place in its sequence."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.xxhash64(id_col, text_col).alias("tie"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    made = written(rows.mapInArrow(_tokenize(tokenizer, end_id), _TOKENS), "ids")
    total = made.agg(F.sum("n")).first()[0] or 0
    n = int(total // RANGE_IDS) + 1
    cuts: list[int] = []
    if n > 1:
        cuts = sorted(set(made.agg(F.percentile_approx("curve", F.array(*[F.lit(i / n) for i in range(1, n)]), 20 * n + 1000)).first()[0]))
    part = range_of(F.col("curve"), cuts).alias("part")
    # one sum per range; their number follows from RANGE_IDS
    sums = {r["part"]: r["n"] for r in made.select(part, "n").groupBy("part").agg(F.sum("n").alias("n")).collect()}
    before, place = {}, 0
    for k in sorted(sums):
        before[k] = place
        place += sums[k]
    ordered = made.select(part, "curve", "doc_id", "ids").repartition("part").sortWithinPartitions("part", "curve", "doc_id")
    return ordered.select("part", "doc_id", "ids").mapInArrow(_cut(before, length, encoder(tokenizer).dtype), _PIECES)
