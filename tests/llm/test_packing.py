import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from panelcast.llm import packing
from panelcast.llm.packing import coordinates, hilbert, pack
from panelcast.llm.queries import vocabulary

NAME = "byte_bpe_50k.json"


def test_hilbert_visits_every_cell_in_unit_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = hilbert(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(spark, rows, length=1024):
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, curve int, part string").repartition(4)
    got = pack(df, vocabulary(NAME), 0, length).collect()
    t = Tokenizer.from_file(vocabulary(NAME))
    want = defaultdict(list)
    for doc, text in rows:
        want[doc].append([*t.encode(text or "", add_special_tokens=False).ids, 0])
    pieces, places = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == want.keys()
    for doc, texts in want.items():
        if len(texts) > 1:
            continue
        ids, at = texts[0], 0
        for p in sorted(pieces[doc], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    sizes = []
    for spans in places.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        sizes.append(at)
    total = sum(len(ids) for texts in want.values() for ids in texts)
    assert sum(sizes) == total and max(sizes) <= length and len(sizes) == -(-total // length)
    return got


def test_pieces(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANGE_IDS", 20_000)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(spark, rows + [(10**6, None), (10**6 + 1, ""), (-1, "word " * 9000), (None, "no id"), (10**6 + 2, "twice"), (10**6 + 2, "twice")])
    assert pack(spark.createDataFrame([], "doc_id long, text string"), vocabulary(NAME), 0).count() == 0


def test_alike_documents_are_neighbours():
    base = [" ".join(f"w{g}_{i % 50}" for i in range(200)) for g in range(40)]
    near = [b + f" extra{i}" for i, b in enumerate(base)]
    key = hilbert(coordinates([t.encode() for t in base + near])).astype(float)
    gap = np.abs(key[:40] - key[40:])
    assert np.median(gap) < np.median(np.abs(key[:39] - key[1:40])) / 20


def test_joined_pieces_are_cut_by_their_first_ids():
    from panelcast.llm.tokens import Encoder

    plain, quick = Tokenizer.from_file(vocabulary(NAME)), Encoder(vocabulary(NAME))
    assert quick.begins is not None and Encoder(vocabulary("word_bpe_49k.json")).begins is None
    texts = ["a<|endoftext|>b <|endoftext|> c", "don't 12,5 Ġ Ċ xĠy", "\nline\nfeed end ", "éè \U0001f600\U0001f600 中文", "", " ", "two  spaces", "'s 're"]
    for text, ids in zip(texts, quick.encode(texts)):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
