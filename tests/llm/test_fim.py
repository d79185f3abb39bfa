import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import fim

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def expected(doc_id, text):
    """The transformation from its definition: tokens in a list, cut, joined."""
    text = text or ""
    tokens = TOKEN.findall(text)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(s in text for s in fim.SENTINELS) or h3 % 100 >= 50:
        return len(tokens), "plain", None, None, text
    if h4 % 100 < 80:
        return len(tokens), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(tokens), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


TEXTS = ["", None, " ", "a", " a", "a ", "a b", "\n\n a  b\t", "é è ü 語 𝄞 x", "a<b> <c S> S> <S", "has <P> in it", "<M>", "x" * 50,
         "a b c d", "one two three four five six seven. " * 40]


def test_equals_the_definition_and_comes_back(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], i) for i in range(40 * len(TEXTS))] + [(None, "a null id", 1), (3, "a repeated id", 2), (3, "a repeated id", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(5)
    made = fim.transform(docs).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    found = made.select("row.doc_id", "row.text", "n", "form", "prefix_chars", "middle_chars", "output", "back", "row.n").collect()
    assert len(found) == len(rows)
    for doc_id, text, *got, back, _ in found:
        assert tuple(got) == expected(doc_id, text)
        assert back == (text or "")
    assert {r.form for r in made.collect()} == {"plain", "spm", "psm"}


def test_long_text_and_empty_table(spark):
    text = "".join(f"w{i * i % 997} \n" for i in range(300_000))
    docs = spark.createDataFrame([(i, text) for i in (2, 5, 7, 9)], "doc_id long, text string")
    for r in fim.transform(docs).select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect():
        assert tuple(r)[1:] == expected(r.doc_id, text)
    assert fim.transform(docs.limit(0)).count() == 0


def test_bytes_that_are_no_utf8_pass_through(spark):
    docs = spark.sql("SELECT id AS doc_id, cast(X'61FF20C3A920FE' AS string) AS text FROM range(20)")
    made = fim.transform(docs).withColumn("back", fim.restored(F.col("output"), F.col("form")).cast("binary"))
    assert {bytes(r.back) for r in made.select("back").collect()} == {b"\x61\xff\x20\xc3\xa9\x20\xfe"}


@pytest.mark.parametrize("error", [1, 7, 127])
@pytest.mark.parametrize("steps", ["even", "random", "jumps", "none"])
def test_rank_index_is_exact_and_its_error_bounded(error, steps):
    rng = np.random.RandomState(3)
    size = {"even": np.full(5000, 6), "random": rng.randint(1, 15, 5000), "none": np.zeros(0, int),
            "jumps": np.where(rng.rand(5000) < 0.01, 100_000, rng.randint(1, 9, 5000))}[steps]
    offsets = np.cumsum(np.concatenate([[0], size])).astype(np.int64)
    index = fim.RankIndex(offsets, error)
    assert (index.offsets(np.arange(len(offsets))) == offsets).all()
    assert np.abs(index.residual.astype(int)).max() <= error and index.residual.dtype == np.int8
    if steps == "even":
        assert len(index.first) == 1
    if error == 127:
        assert len(index.first) <= 1 + 3 * int((size > 1000).sum())
