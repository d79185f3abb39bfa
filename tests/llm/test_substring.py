import hashlib

from panelcast.llm.substring import remove_repeats


def brute(rows, width):
    """Order of rows, then every window in order: repeated if its words were seen before."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - width + 1):
            w = tuple(words[i:i + width])
            if w in seen:
                gone.update(range(i, i + width))
            seen.add(w)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def spark_rows(df, width):
    got = remove_repeats(df, width=width).collect()
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
    return sorted([(r["row"]["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest())
                   for r in got], key=str)


def test_edges(spark):
    shared = " ".join(f"w{i}" for i in range(9))
    rows = [(3, shared + " x y"), (1, "a " + shared), (2, None), (4, ""), (5, "one two"), (6, "r " * 30),
            (7, "same text here now ok"), (7, "same text here now ok"), (None, "a " + shared), (8, "été　 b\tc\x0b" * 4000)]
    df = spark.createDataFrame([(*r, i, i, i) for i, r in enumerate(rows)], "doc_id long, text string, block int, bucket int, row int")
    assert spark_rows(df, 5) == brute(rows, 5)
    assert remove_repeats(df.limit(0)).count() == 0


def test_many_blocks(spark, monkeypatch):
    import panelcast.llm.substring as s
    monkeypatch.setattr(s, "BLOCK_BYTES", 60_000)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert spark_rows(df.repartition(7), 20) == brute(rows, 20)
