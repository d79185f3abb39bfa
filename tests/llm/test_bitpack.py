import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from panelcast.llm import bitpack
from panelcast.llm.bitpack import TokenFile, file_parts, pack, read_ids, unpack, write_ids
from panelcast.llm.queries import vocabulary
from panelcast.llm.tokens import Encoder

ODD = ["", " ", "\n\n", "a\t b", "a \t\n b  c\n", "x  y", " lead", "trail \n ", "été É　ç", "don't we'll 12345 $$$!! |", "word " * 3000,
       "tab\tnl\r\n x", "a<|endoftext|>b", "\x1c a\x85b", "Σίσυφος ΣΑΣ", "é x́"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_units_give_the_ids_of_whole_texts(spark, name):
    texts = ODD + [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    whole = [e.ids for e in Tokenizer.from_file(vocabulary(name)).encode_batch(texts, add_special_tokens=False)]
    ours = Encoder(vocabulary(name))
    assert [i.tolist() for i in ours.encode(texts)] == whole
    assert [i.tolist() for i in ours.encode(texts)] == whole


@pytest.mark.parametrize("width", [1, 3, 7, 8, 13, 16, 17, 31, 32])
def test_pack_round_trip(width):
    r = np.random.RandomState(width)
    for n in (0, 1, 63, 64, 65, 1000):
        ids = r.randint(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
        assert (unpack(pack(ids, width), width, n) == ids).all()
        assert len(pack(ids, width)) == -(-n // 64) * width * 8
    with pytest.raises(ValueError):
        pack(np.array([1 << width], np.uint64), width)


def test_random_access(tmp_path):
    r = np.random.RandomState(0)
    docs = [(i if i != 2 else None, r.randint(0, 5000, n).astype(np.uint32)) for i, n in enumerate([5, 0, 9000, 1, 20000, 64])]
    path = tmp_path / "x.bin"
    path.write_bytes(b"".join(file_parts(docs, 13)))
    file = TokenFile(f"file://{path}")
    file.check()
    for i, (_, ids) in enumerate(docs):
        assert (file.doc(i) == ids).all()
    everything = np.concatenate([ids for _, ids in docs])
    for a, b in [(0, 1), (8191, 8193), (100, 25000), (7, 7)]:
        assert (file.ids(a, b) == everything[a:b]).all()
    raw = bytearray(path.read_bytes())
    raw[500] ^= 1
    path.write_bytes(raw)
    with pytest.raises(ValueError):
        TokenFile(f"file://{path}").check()


def brute(rows, name, end):
    t, out, start = Tokenizer.from_file(vocabulary(name)), [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_files(spark, monkeypatch):
    monkeypatch.setattr(bitpack, "SHARD_BYTES", 100_000)
    monkeypatch.setattr(bitpack, "FILE_IDS", 9_000)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(None, "no id"), (10**12, None), (-4, ""), (3, rows[3][1])]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, shard int, part string").repartition(4)
    files = write_ids(df, vocabulary("word_bpe_49k.json"), 2)
    assert files.count() > 4
    assert sorted(map(tuple, read_ids(files).collect()), key=str) == brute(rows, "word_bpe_49k.json", 2)
    assert read_ids(write_ids(df.limit(0), vocabulary("word_bpe_49k.json"), 2)).count() == 0
