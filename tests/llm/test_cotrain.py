import numpy as np
from pyspark import Broadcast, SparkContext
from pyspark.sql import functions as F

from panelcast.llm import cotrain
from panelcast.llm.cotrain import classify, fit


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    test = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    model = fit(docs, labels.where(~test))
    got = classify(docs, model).select("row.doc_id", "score", "kept").join(labels.where(test), "doc_id").toPandas()
    bad = (got.quality == 0) | (got.toxic == 1)
    low = got[got.quality == 0]
    assert (~low.kept).mean() > 0.8
    assert got[~bad].kept.mean() > 0.94
    pairs = got.score.to_numpy()[bad.to_numpy()][:, None] - got.score.to_numpy()[~bad.to_numpy()][None]
    assert (pairs > 0).mean() + 0.5 * (pairs == 0).mean() > 0.85


def test_views_teach_each_other():
    """The text view learns a word from documents that only the metadata view could judge."""
    r = np.random.RandomState(0)

    def doc(bad, word):
        return " ".join([f"w{r.randint(50)}" for _ in range(30)] + ([word] * bad)).encode(), ("xx" if bad else "en", "s")

    made = [(*doc(i % 2, "spam"), i % 2) for i in range(600)] + [(*doc(i % 2, "novel"), -1) for i in range(600)]
    texts, names, label = [m[0] for m in made], [m[1] for m in made], np.array([m[2] for m in made])
    n = [len(t) for t in texts]
    weight = lambda m: m.text[cotrain.text_features([b"novel"])[0]].sum()
    assert weight(cotrain.cotrain(texts, n, names, label)) > 0.3
    assert weight(cotrain.cotrain(texts, n, names, label, rounds=0)) == 0


def test_every_unlabelled_document_teaches(spark):
    """A word of 30 among 20,000 unlabelled documents, none of them first by hash, reaches the text view."""
    r = np.random.RandomState(0)

    def doc(i, bad, word):
        return i, " ".join([f"w{r.randint(50)}" for _ in range(30)] + ([word] * bad)), "xx" if bad else "en", "s", 100

    n = 20_000
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    known = [doc(i, i % 2, "spam") for i in range(600)]
    ids = spark.range(1000, 1000 + n).orderBy(F.xxhash64("id")).toPandas()["id"].tolist()
    made = known + [doc(i, int(k >= n - 30), "novel") for k, i in enumerate(ids)]
    docs = spark.createDataFrame(made, schema)
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(600)], "doc_id long, quality int, toxic int")
    model = fit(docs, labels)
    assert model.text[cotrain.text_features([b"novel"])[0]].sum() > 0.3
    # the sums of tasks are those of arrays
    texts, names = [d[1].encode() for d in made], [d[2:4] for d in made]
    label = np.array([i % 2 for i in range(600)] + [-1] * n)
    same = cotrain.cotrain(texts, [100] * len(made), names, label)
    assert np.allclose(model.text, same.text, atol=1e-6) and np.allclose(model.meta, same.meta, atol=1e-6)


def test_driver_keeps_no_sent_weights(spark, monkeypatch):
    """What a pass over the unlabelled documents sends is let go of by the driver too."""
    sent, gone = [], []
    broadcast, destroy = SparkContext.broadcast, Broadcast.destroy
    monkeypatch.setattr(SparkContext, "broadcast", lambda sc, value: sent.append(broadcast(sc, value)) or sent[-1])
    monkeypatch.setattr(Broadcast, "destroy", lambda b, *args: gone.append(b) or destroy(b, *args))
    docs = spark.createDataFrame([(i, "good words" if i % 2 else "BAD!! BAD!!", "en", "s", 10) for i in range(60)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = docs.where("doc_id < 40").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    assert fit(docs, labels) is not None
    assert len(sent) == cotrain.ROUNDS * (1 + cotrain.PASSES) and gone == sent


def test_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, q int"
    rows = [(1, None, None, None, None, "x", 1), (2, "", "en", "s", 0, "x", 1), (None, "a b", "en", "s", 3, "x", 1), (3, "w " * 50_000, "de", None, 9, "x", 1),
            (3, "w " * 50_000, "de", None, 9, "x", 1)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 1, None), (1, 0, 0), (2, None, 1), (9, 0, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert fit(docs, labels) is None
    got = classify(docs, None).collect()
    assert len(got) == 5 and all(r.kept and r.score == 0 for r in got)
    many = spark.createDataFrame([(i, "good words" if i % 2 else "BAD!! BAD!!", "en", "s", 10, "x", 1) for i in range(200)], schema)
    model = fit(many, many.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic")))
    got = classify(docs.unionByName(many), model).collect()
    assert len(got) == 205 and all(r.kept == bool(r["row"]["doc_id"] % 2) for r in got[5:])
    assert classify(docs.limit(0), model).count() == 0
