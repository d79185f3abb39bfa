"""Token ids as files of fixed-width bit packing: every id takes the bits that the vocabulary needs.

Layout, little endian: 8 bytes magic, then u32 width and ids per block, u64 ids, documents and
blocks; the blocks, each of whole 64-bit words with 64 ids in ``width`` words; u64 offset of
each block and of the end; per document i64 id, u8 whether the id is null, and u64 first id (plus
the end); u32 crc32 of all after the magic. A block is unpacked by 64 shifts over whole columns,
and an id or document is read through the offsets without touching other blocks.

Documents are dealt by ranges of doc_id to shards and written in ascending order, null ids first,
ties by text. Defined results: null texts are empty and hold the end id alone; repeated rows
are written each; an empty table makes no file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import chunks, id_ranges, range_of, small_batches, written
from panelcast.llm.files import read_file, shared_uri, write_file
from panelcast.llm.tokens import encoder

MAGIC = b"IDPACK01"
WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}
HEAD = struct.Struct("<IIQQQ")
#: Ids of a block (a multiple of 64), text of a shard, and ids after which a shard goes on in another file.
BLOCK = 8192
SHARD_BYTES = 8_000_000
FILE_IDS = 16_000_000


def width_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """64 ids in ``width`` 64-bit words, the last group filled up with zeros."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"id {int(ids.max())} needs more than {width} bits")
    groups = -(-len(ids) // 64)
    if width in WHOLE:  # the same words, as whole bytes
        out = np.zeros(groups * 64, WHOLE[width])
        out[:len(ids)] = ids
        return out.tobytes()
    rows = np.zeros((groups, 64), np.uint64)
    rows.ravel()[:len(ids)] = ids
    words = np.zeros((groups, width), "<u8")
    for j in range(64):
        word, shift = divmod(j * width, 64)
        words[:, word] |= rows[:, j] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= rows[:, j] >> np.uint64(64 - shift)
    return words.tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    if width in WHOLE:
        return np.frombuffer(data, WHOLE[width], count).astype(np.uint32)
    words = np.frombuffer(data, "<u8").reshape(-1, width)
    out = np.empty((len(words), 64), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[:, j] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            out[:, j] |= words[:, word + 1] << np.uint64(64 - shift)
    return (out.ravel()[:count] & np.uint64((1 << width) - 1)).astype(np.uint32)


def file_parts(docs: list[tuple], width: int) -> list[bytes]:
    """docs: (id or None, ids) in order."""
    lengths = [len(ids) for _, ids in docs]
    ids = np.concatenate([np.zeros(0, np.uint32), *(i for _, i in docs)])
    blocks = [pack(ids[i:i + BLOCK], width) for i in range(0, len(ids), BLOCK)]
    body = [HEAD.pack(width, BLOCK, len(ids), len(docs), len(blocks)), *blocks]
    at = len(MAGIC) + HEAD.size
    body.append((at + np.concatenate([[0], np.cumsum([len(b) for b in blocks])])).astype("<u8").tobytes())
    body.append(np.array([d or 0 for d, _ in docs], "<i8").tobytes())
    body.append(np.array([d is None for d, _ in docs], "u1").tobytes())
    body.append(np.concatenate([[0], np.cumsum(lengths)]).astype("<u8").tobytes())
    crc = 0
    for part in body:
        crc = zlib.crc32(part, crc)
    return [MAGIC, *body, struct.pack("<I", crc)]


class TokenFile:
    """Random access to one file."""

    def __init__(self, uri: str):
        self.file = read_file(uri)
        self.size = self.file.size()
        head = self.file.read_at(len(MAGIC) + HEAD.size, 0)
        if head[:len(MAGIC)] != MAGIC:
            raise ValueError(f"{uri} is no token file")
        self.width, self.block, self.n_ids, self.n_docs, self.n_blocks = HEAD.unpack(head[len(MAGIC):])
        tail = 8 * (self.n_blocks + 1) + 17 * self.n_docs + 8 + 4
        raw = self.file.read_at(tail, self.size - tail)
        n = 8 * (self.n_blocks + 1)
        self.offsets = np.frombuffer(raw, "<u8", self.n_blocks + 1)
        self.doc_ids = np.frombuffer(raw, "<i8", self.n_docs, n)
        self.null = np.frombuffer(raw, "u1", self.n_docs, n + 8 * self.n_docs)
        self.starts = np.frombuffer(raw, "<u8", self.n_docs + 1, n + 9 * self.n_docs).astype(np.int64)
        self.crc = struct.unpack("<I", raw[-4:])[0]

    def check(self) -> None:
        crc, at = 0, len(MAGIC)
        while at < self.size - 4:
            part = self.file.read_at(min(1 << 22, self.size - 4 - at), at)
            crc, at = zlib.crc32(part, crc), at + len(part)
        if crc != self.crc:
            raise ValueError("a token file is damaged")

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids start to end, reading only the blocks that hold them."""
        if start >= end:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, -(-end // self.block)
        data = self.file.read_at(int(self.offsets[b] - self.offsets[a]), int(self.offsets[a]))
        return unpack(data, self.width, min(b * self.block, self.n_ids) - a * self.block)[start - a * self.block:end - a * self.block]

    def doc(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


_FILES = "shard int, part int, uri string, n_docs long, n_ids long"


def _write(folder: str, tokenizer: str, end_id: int):
    schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def close(shard: int, part: int, held: list, width: int) -> pa.RecordBatch:
        uri = write_file(folder, f"ids-{shard:07d}-{part:04d}.bin", *file_parts(held, width))
        row = (shard, part, uri, len(held), sum(len(i) for _, i in held))
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        width = width_for(encode.vocabulary)
        end = np.array([end_id], np.uint32)
        now, part, held, size = None, 0, [], 0
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for some in chunks(rows, lambda r: len(r[2] or "")):
                for (shard, doc, _), ids in zip(some, encode.encode([t or "" for _, _, t in some])):
                    if held and (shard != now or size >= FILE_IDS):
                        yield close(now, part, held, width)
                        part = part + 1 if shard == now else 0
                        held, size = [], 0
                    now = shard
                    held.append((doc, np.concatenate([ids.astype(np.uint32), end])))
                    size += len(ids) + 1
        if held:
            yield close(now, part, held, width)

    return run


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents; returns the files with the number of ids before each (``start``)."""
    spark = docs.sparkSession
    small_batches(spark)
    cuts = id_ranges(docs, id_col, text_col, SHARD_BYTES)
    rows = docs.select(range_of(F.col(id_col).cast("long"), cuts).alias("shard"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.repartition("shard").sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "text")
    files = written(rows.mapInArrow(_write(shared_uri(spark, "ids"), tokenizer, end_id), _FILES), "files")
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


_DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])
    for batch in batches:
        for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            file = TokenFile(uri)
            file.check()
            ids = file.ids(0, file.n_ids).astype("<u4")
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(file.starts[:-1].tolist(), file.starts[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(file.doc_ids, mask=file.null.astype(bool)), pa.array(file.starts[:-1] + start),
                                              pa.array(np.diff(file.starts)), pa.array(crc, pa.int64())], schema=schema)


def read_ids(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("uri", "start").repartition(n, "uri").mapInArrow(_read, _DOCS)
