import random
import re

import numpy as np
import pytest

from panelcast.llm import neardup
from panelcast.llm.components import components
from panelcast.llm.neardup import find_groups


def shingles(text, size):
    w = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()).split()
    return {tuple(w[i:i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set()


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    name = {r: min((d for d in ds if d is not None), default=None) for r, ds in least.items()}
    return sorted([(d, len(s), name[find(i)], d == name[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))], key=str)


def found(df, size, percent=80):
    return sorted([(r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in find_groups(df, size, percent).collect()], key=str)


def varied(seed, groups, copies, length):
    """Groups of texts with a few words changed, so that similarities lie on both sides of 0.8."""
    r = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{r.randrange(5000)}" for _ in range(length)]
        for _ in range(copies):
            words = list(base)
            for _ in range(r.randrange(0, 1 + length // 18)):
                words[r.randrange(length)] = f"x{r.randrange(10 ** 6)}"
            out.append(" ".join(words))
    shared = " ".join(f"boiler{i}" for i in range(40))
    out += [shared + " " + " ".join(f"u{r.randrange(10 ** 6)}" for _ in range(60)) for _ in range(copies * 2)]
    r.shuffle(out)
    return list(enumerate(out))


EDGES = [(5, "one two"), (3, "One  TWO"), (4, "one"), (1, None), (2, ""), (6, " \n "), (7, "a b c d e f g h"), (8, "a b c d e f g h"),
         (8, "a b c d e f g h"), (9, "word " * 9000), (10, "word " * 7), (11, "été Été ÉTÉ x y z"), (12, "ÉTÉ Été été x y z")]


def test_edges(spark):
    df = spark.createDataFrame([(*r, 1, "c") for r in EDGES], "doc_id long, text string, cls long, key string")
    for size in (4, 5):
        assert found(df, size) == brute(EDGES, size, 80)
    assert find_groups(df.limit(0)).count() == 0
    lone = spark.createDataFrame([(None, "a b c d e f g"), (None, None)], "doc_id long, text string")
    assert find_groups(lone).count() == 2


def test_intersections(monkeypatch):
    monkeypatch.setattr(neardup, "COLUMNS", 7)
    r = np.random.RandomState(1)
    sets = [np.unique(r.randint(0, 60, n).astype(np.uint64)) for n in (1, 5, 40, 40, 90, 3)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    assert neardup.intersections(sets).tolist() == want


@pytest.mark.parametrize(("node", "cluster"), [(600, 1000), (24, 1000), (24, 20)])
def test_matches_brute_force(spark, monkeypatch, node, cluster):
    monkeypatch.setattr(neardup, "NODE", node)
    monkeypatch.setattr(neardup, "CLUSTER", cluster)
    rows = varied(3, 12, 14, 120) + [(10_000 + i, t) for i, t in varied(4, 1, 90, 200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df, 4) == brute(rows, 4, 80)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(df, 4) == brute([(r.doc_id, r.text) for r in df.collect()], 4, 80)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)] + [(200, 300 + i) for i in range(50)]
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {100: 100, 101: 100, 200: 200} | {300 + i: 200 for i in range(50)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_dense_members_that_cannot_be_linked_are_not_paired(spark, monkeypatch):
    """Texts of one long common passage share nodes, but no link: pairing them all would grow with their square."""
    monkeypatch.setattr(neardup, "NODE", 24)
    r = random.Random(5)
    common = " ".join(f"boiler{i}" for i in range(60))
    rows = [(i, common + " " + " ".join(f"u{r.randrange(10 ** 6)}" for _ in range(30))) for i in range(300)]
    rows += [(1000 + i, t) for i, t in varied(6, 1, 40, 120)]
    paired = []
    blocks = neardup._blocks
    monkeypatch.setattr(neardup, "_blocks", lambda rows, half: paired.append(blocks(rows, half)) or paired[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df, 4) == brute(rows, 4, 80)
    assert paired[0].count() < 3 * len(rows)
