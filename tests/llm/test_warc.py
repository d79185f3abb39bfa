import hashlib
import random

from panelcast.llm import warc


def brute(rows):
    first = {}
    for p, h in rows:
        data = (h or "").encode()
        if len(data) >= 100 and p is not None:
            first[data] = min(first.get(data, p), p)
    out = []
    for p, h in rows:
        data = (h or "").encode()
        to = first.get(data)
        to = to if to is not None and (p is None or to < p) else None
        out.append((p, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def found(df):
    files = warc.write_pages(df)
    pages = warc.read_pages(files)
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in pages.collect()], key=str), files


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    r = random.Random(1)
    bodies = ["<p>" + " ".join(r.choice(["été", "und", "the", "\r\n\r\n", "WARC/1.1"]) for _ in range(n)) for n in (3, 40, 90, 4000)]
    rows = [(i, r.choice(bodies + [None, "", "x" * 99, "x" * 100])) for i in range(300)] + [(5, "x" * 100), (None, "x" * 100), (None, "y" * 200), (7, "z" * 3), (7, "z" * 3)]
    df = spark.createDataFrame([(p, None if p and p % 3 else "http://a.b/ c\n", h, "e", 1) for p, h in rows],
                               "page_id long, url string, html string, digest string, n int")
    got, files = found(df)
    assert got == brute(rows)
    assert files.count() > 1
    assert found(df.limit(0))[0] == []


def test_archive_layout():
    records = [warc.record(i, "http://a/b", f"<html>{i} the same words again and again {i * i}</html>".encode() * 9, "d", 1, None) for i in range(400)]
    data = b"".join(warc.archive(records))
    assert int.from_bytes(data[:4], "little") == warc.MAGIC and int.from_bytes(data[4:8], "little") > 256
    assert list(warc.read_archive(data)) == records
    assert len(data) < len(b"".join(records)) / 3
    fields, http, payload = warc.parse(records[7])
    assert fields["WARC-Record-ID"] == "<urn:page:7>" and payload.startswith(b"<html>7 the")


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert found(df)[0] == brute([(r.page_id, r.html) for r in df.collect()])
