"""WARC files compressed record by record with a dictionary that the file carries.

A file begins with a skippable Zstandard frame (magic 0x184D2A5D) that holds a dictionary built
from the file's own first records; every record follows as a frame of its own, compressed with it.
Pages whose payload an earlier page (smaller id) holds too are revisit records without payload.

Payloads are matched by SHA-256 and length, of which only digests are grouped (partial minima
first), so a payload that a third of all pages share is one row per task. Each task writes what it
has as files of at most ``FILE_BYTES`` before compression.

Defined results: null html is an empty payload; payloads under ``REVISIT_BYTES`` are always written
in full; rows that share the smallest id of a payload are all responses; a null page id counts as
larger than all others, and pages without a smaller id to point to are responses; null urls
become ``urn:page:<id>``; an empty table makes no file.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import small_batches, written
from panelcast.llm.files import read_file, shared_uri, write_file

REVISIT_BYTES = 100
#: Records of a file before compression, and the share of them that the dictionary is built from.
FILE_BYTES = 32_000_000
SAMPLE_BYTES = 4_000_000
DICTIONARY_BYTES = 110_000
MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The pages carry no fetch time.
DATE = "1970-01-01T00:00:00Z"


def record(page_id, url: str | None, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    uri = "".join(c if c > " " and c != "\x7f" else "%%%02X" % ord(c) for c in url) if url else f"urn:page:{page_id}"
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{page_id}>"),
            ("WARC-Target-URI", uri), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, HTTP header and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a WARC record's length is wrong")
    http, _, payload = rest[:n].partition(b"\r\n\r\n")
    return fields, http, payload


def dictionary(records: list[bytes]) -> bytes:
    """Built from the first records; empty if there are too few to build one from."""
    some, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        some.append(r[:SAMPLE_BYTES])
        size += len(some[-1])
    if len(some) < 8:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, size // 4), some, level=3).as_bytes()
    except zstandard.ZstdError:  # the samples are too alike or too short
        return b""


def archive(records: list[bytes]) -> list[bytes]:
    """The parts of a file: the dictionary's frame, then one frame per record."""
    built = dictionary(records)
    squeeze = zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(built) if built else None,
                                       write_checksum=True, write_content_size=True)
    return [struct.pack("<II", MAGIC, len(built)) + built, *(squeeze.compress(r) for r in records)]


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of a file."""
    magic, n = struct.unpack_from("<II", data)
    if magic != MAGIC:
        raise ValueError("no dictionary frame")
    built = data[8:8 + n]
    expand = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(built) if built else None)
    view = memoryview(data)[8 + n:]
    while len(view):
        one = expand.decompressobj()
        out = one.decompress(view)
        if not one.eof:
            raise ValueError("a record's frame is cut off")
        yield out
        view = view[len(view) - len(one.unused_data):]


_FILES = "uri string, n_records long, n_bytes long"


def _write(folder: str):
    schema = pa.schema([("uri", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])

    def close(k: int, held: list[bytes]) -> pa.RecordBatch:
        parts = archive(held)
        uri = write_file(folder, f"pages-{TaskContext.get().partitionId():06d}-{k:04d}.warc.zst", *parts)
        row = (uri, len(held), sum(map(len, parts)))
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, k = [], 0, 0
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(5)] + [batch.column(5).cast(pa.binary()).to_pylist()]
            for page_id, url, digest, n, refers_to, html in zip(*cols):
                held.append(record(page_id, url, html or b"", digest, n, refers_to))
                size += len(held[-1])
                if size >= FILE_BYTES:
                    yield close(k, held)
                    held, size, k = [], 0, k + 1
        if held:
            yield close(k, held)

    return run


def write_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write one record per page; returns the files."""
    small_batches(pages.sparkSession, 200)
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"),
                        F.sha2(html.cast("binary"), 256).alias("digest"), F.octet_length(html).cast("long").alias("n"))
    least = (rows.where(F.col("n") >= REVISIT_BYTES).groupBy("digest", "n")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    joined = rows.join(least, ["digest", "n"], "left")
    refers_to = F.when((F.col("first") < F.col("page_id")) | (F.col("page_id").isNull() & F.col("first").isNotNull()), F.col("first"))
    # a response needs its payload, a revisit only its digest and length
    out = joined.select("page_id", "url", "digest", "n", refers_to.alias("refers_to"), F.when(refers_to.isNull(), F.col("html")).alias("html"))
    out = out.sortWithinPartitions("page_id", "digest", "url")  # a repeated task writes the same files
    return written(out.mapInArrow(_write(shared_uri(pages.sparkSession, "warc")), _FILES), "archives")


_PAGES = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, html string"


def _number(urn: str | None) -> int | None:
    value = urn[len("<urn:page:"):-1] if urn else "None"
    return None if value == "None" else int(value)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(n, types[t]) for n, t in (c.split() for c in _PAGES.split(", "))])

    def emit(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)

    for batch in batches:
        for uri in batch.column(0).to_pylist():
            held, size = [], 0
            for data in read_archive(read_file(uri).readall()):
                fields, http, payload = parse(data)
                digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                n = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
                if fields["WARC-Type"] == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"a payload of {uri} doesn't match its digest")
                text = payload.decode() if fields["WARC-Type"] == "response" else None
                held.append((_number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"],
                             _number(fields.get("WARC-Refers-To")), digest, n, text))
                size += len(payload)
                if size >= 4_000_000:
                    yield emit(held)
                    held, size = [], 0
            if held:
                yield emit(held)


def read_pages(files: DataFrame) -> DataFrame:
    """Every record of the files; revisits have no html."""
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("uri").repartition(n, "uri").mapInArrow(_read, _PAGES)
