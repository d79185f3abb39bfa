from collections import defaultdict

import corpus_pipeline as p
from panelcast.llm.common import table

from test_decontam import brute as contaminated
from test_neardup import brute as groups


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    seen = {"documents": docs}
    for name, stage in p.STAGES:
        docs = p.written(stage(spark, docs, sf), name)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == seen["documents"].columns
    rows = {k: {r.doc_id: r.text for r in df.collect()} for k, df in seen.items() if k != "packing"}
    kept = {d for d, _, _, k in groups(list(rows["quality_classifier"].items()), 5, 80) if k}
    assert set(rows["near_dedup"]) == kept
    assert rows["substring_dedup"].keys() == rows["near_dedup"].keys()
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    clean = {r[0] for r in contaminated(list(rows["substring_dedup"].items()), items, 13) if not r[4]}
    assert set(rows["decontamination"]) == clean
    pieces = defaultdict(int)
    for r in seen["packing"].collect():
        pieces[r.doc_id] += r.length
        assert r.offset + r.length <= 1024
    assert pieces.keys() == clean
    repeats = p.substring.remove_repeats(seen["substring_dedup"], 50)
    assert repeats.where("n_removed > 0").count() == 0


def test_repeated_passages_stay_otherwise_as_they_are(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"one\ntwo  {passage}", "en", "s", 5), (2, f"three {passage}\nfour", "en", "s", 6), (3, None, None, None, None), (4, "", "", "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in p.repeated_passages(spark, df, "").collect()}
    assert [got[i].text for i in (1, 2, 3, 4)] == [rows[0][1], "three four", None, ""]
    assert [got[i].n_chars for i in (1, 2, 3, 4)] == [5, 10, None, 0]
