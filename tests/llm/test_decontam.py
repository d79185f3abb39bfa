import re

from panelcast.llm import decontam
from panelcast.llm.decontam import find_contamination


def words(text):
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, width):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - width, 0) + 1) if w else ():
            windows.setdefault(tuple(w[i:i + width]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if x := windows.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    found |= x
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def rows(df):
    return sorted([(r["row"]["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in df.collect()], key=str)


ITEMS = [(1, "The quick brown Fox, jumps over the lazy dog"), (2, "brown fox jumps over THE"), (3, "Été à Paris İ K"), (4, None), (5, "..."),
         (6, "uno dos"), (7, "a a a a a a a"), (8, "The quick brown Fox, jumps over the lazy dog"), (None, "nulls have windows too")]
DOCS = [(1, "x the quick brown fox jumps over the lazy dog y"), (2, None), (3, ""), (4, "été à paris İ k"), (5, "Été à Paris İ K"),
        (6, "uno DOS tres " * 50), (7, "a " * 3000), (8, "\x00the\x7fquick\nbrown fox jumps over"), (8, "\x00the\x7fquick\nbrown fox jumps over"),
        (None, "nulls have windows too"), (9, "one " * 500 + "uno dos"), (10, " !? ")]


def test_edges(spark, monkeypatch):
    docs = spark.createDataFrame([(*d, 1, 2, 3) for d in DOCS], "doc_id long, text string, w long, k1 long, start long")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    fixed = [(d, t) for d, t in ITEMS if d is not None]
    for width in (5, 13):
        assert rows(find_contamination(docs, items.where("item_id is not null"), width)) == brute(DOCS, fixed, width)
    assert find_contamination(docs, items, 5).count() == len(DOCS)
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    assert rows(find_contamination(docs, items.where("item_id is not null"), 5)) == brute(DOCS, fixed, 5)
    assert find_contamination(docs.limit(0), items).count() == 0
    assert all(not r["contaminated"] for r in find_contamination(docs, items.limit(0)).collect())


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 13)
    assert rows(find_contamination(docs, items)) == want
    assert any(r[4] for r in want)


def test_texts_are_shuffled_only_for_many_hits(spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(13))
    docs = spark.createDataFrame([(i, f"a {item} b" if i % 3 else f"other {i}") for i in range(30)], "doc_id long, text string")
    items = spark.createDataFrame([("x", item), ("y", f"{item} more")], "item_id string, text string")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = find_contamination(docs, items)
        monkeypatch.setattr(decontam, "BROADCAST_MARKS", 0)
        many = find_contamination(docs, items)
        assert "SortMergeJoin" not in few._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in many._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
        assert few.where("n_hit = 13").count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
