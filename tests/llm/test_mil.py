import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import mil
from panelcast.llm.queries import op13_noisy_or_toxicity

SF = "/root/testdata/sf0.1"


def test_sentences_and_features():
    texts = ["One two. Three!\nfour", "", "...", "Zwei ünder. zwei zwei"]
    found = mil.bags([t.encode() for t in texts])
    assert np.diff(found.first).tolist() == [3, 1, 1, 2]
    spans = [(b"One two", b"Three", b"four"), (b"",), (b"",), ("Zwei ünder".encode(), b"zwei zwei")]
    flat = b" ".join([*(t.encode() for t in texts), b""])
    assert [flat[a:b] for a, b in zip(found.start, found.end)] == [s for part in spans for s in part]
    per = np.bincount(found.sentence, minlength=7).tolist()
    assert per == [2, 2, 1, 0, 0, 4, 1]  # Three and ünder have prefixes of 4 (and 5) bytes; zwei counts once
    again = mil.bags([t.encode() for t in texts], np.unique(found.feature))
    assert (again.feature == found.feature).all() and (again.sentence == found.sentence).all()
    assert len(mil.bags([t.encode() for t in texts], np.zeros(0, np.uint64)).feature) == 0
    assert len(mil.bags([]).start) == 0


def test_noisy_or_and_gradient_equal_differences():
    rng = np.random.RandomState(0)
    first = np.array([0, 3, 4, 8])
    toxic = np.array([True, False, True])
    sentence, column = rng.randint(0, 8, 20), rng.randint(0, 5, 20)
    weight, bias = rng.randn(5), -0.7
    margin = np.full(8, bias)
    np.add.at(margin, sentence, weight[column])
    p = 1 / (1 + np.exp(-margin))
    plain = [1 - np.prod(1 - p[a:b]) for a, b in zip(first, first[1:])]
    assert np.allclose(mil.noisy_or(p, first), plain, atol=1e-12)
    slope, by_bias, loss = mil.gradient(weight, bias, toxic, first, sentence, column)
    assert np.isclose(loss, -sum(np.log(q if y else 1 - q) for q, y in zip(plain, toxic)))
    for k in range(5):
        up, down = weight.copy(), weight.copy()
        up[k] += 1e-6
        down[k] -= 1e-6
        change = (mil.gradient(up, bias, toxic, first, sentence, column)[2] - mil.gradient(down, bias, toxic, first, sentence, column)[2]) / 2e-6
        assert np.isclose(slope[k], change, atol=1e-5)
    change = (mil.gradient(weight, bias + 1e-6, toxic, first, sentence, column)[2] - mil.gradient(weight, bias - 1e-6, toxic, first, sentence, column)[2]) / 2e-6
    assert np.isclose(by_bias, change, atol=1e-5)


@pytest.fixture(scope="module")
def planted(spark):
    """Documents of invented words; a third is toxic, by one word in one sentence."""
    rng = np.random.RandomState(1)
    rows, labels = [], []
    for i in range(900):
        sentences = [" ".join(f"w{k}" for k in rng.zipf(1.4, 8) % 5000) for _ in range(rng.randint(1, 12))]
        if i % 3 == 0:
            at = rng.randint(len(sentences))
            sentences[at] += f" grumb{rng.randint(100)}" if i % 2 else " vile"
        rows.append((i, ". ".join(sentences) + ".", "clash"))
        if i < 600:
            labels.append((i, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_finds_toxic_documents_and_the_sentence(spark, planted):
    docs, labels = planted
    model = mil.fit(docs, labels)
    found = mil.score(docs, model).select("row.doc_id", "row.text", "score", "offending").where("row.doc_id >= 600").collect()
    toxic = [r for r in found if r.doc_id % 3 == 0]
    assert sum(r.score >= 0.3 for r in toxic) >= 0.97 * len(toxic)
    assert sum(r.score >= 0.3 for r in found if r.doc_id % 3) <= 0.02 * len(found)
    for r in toxic:
        if r.score >= 0.3:
            best = max(r.offending, key=lambda s: s.score)
            assert "grumb" in r.text[best.start:best.end] or "vile" in r.text[best.start:best.end]


def test_labels_ids_and_texts_that_are_odd(spark, planted):
    docs, labels = planted
    more = spark.createDataFrame([(None, None, "x"), (5001, None, "x"), (5001, "", "x"), (5002, "vile. " * 100_000, "x")], docs.schema)
    odd = spark.createDataFrame([(None, 1), (77_777, 1), (1, None), (4, 0), (4, 0)], labels.schema)
    model = mil.fit(docs.union(more), labels.union(odd))
    got = mil.score(docs.union(more), model).select("row.doc_id", "row.score", F.col("score").alias("p")).collect()
    assert len(got) == 904 and all(0 <= r.p <= 1 for r in got)
    assert {round(r.p, 9) for r in got if r.doc_id in (None, 5001)} == {round(float(1 / (1 + np.exp(-model.bias))), 9)}
    assert [r.p for r in got if r.doc_id == 5002][0] > 0.99
    assert mil.score(docs.limit(0), model).count() == 0


def test_without_labels_of_both_kinds(spark, planted):
    docs, labels = planted
    for some, share in ((labels.limit(0), 0.0), (labels.where("toxic = 0"), 0.0), (labels.where("toxic = 1"), 1.0)):
        scores = {r.score for r in mil.score(docs, mil.fit(docs, some)).select("score").collect()}
        assert scores == {share}
    assert mil.fit(docs.limit(0), labels).constant == 0.0


def test_held_out_documents(spark):
    scored = op13_noisy_or_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    toxic, found, clean, wrong = scored.agg(F.sum("toxic"), F.sum(F.expr("toxic * predicted")), F.sum(1 - F.col("toxic")),
                                            F.sum(F.expr("(1 - toxic) * predicted"))).first()
    assert found >= 0.85 * toxic and wrong <= 0.01 * clean
