import numpy as np

from panelcast.llm import topk
from panelcast.llm.topk import Cell, top_k


def brute(rows, k):
    usable = {i: [] for i, _ in rows}
    flat = []
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        flat.append((i, [int(np.floor(256 * float(x))) for x in v]))
    out = []
    for q, a in flat:
        if q % 50:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in flat if c != q and len(a) == len(b))
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def found(df, k):
    return sorted(map(tuple, top_k(df, df.where("vec_id % 50 = 0"), k).collect()))


def test_edges(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (50, [0.0, 0.0]),
            (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [3.0]), (100, [-5.5, 4.25]), (9, [-1e-9, 7.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(df, 3) == brute(rows, 3)
    assert top_k(df.limit(0), df, 5).count() == 0
    assert top_k(df, df.limit(0), 5).count() == 0


def test_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELL", 200)
    monkeypatch.setattr(topk, "BLOCK", 4)
    r = np.random.RandomState(2)
    vectors = r.standard_normal((700, 16)).round(2)
    vectors[300:420] = vectors[300]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, cell int, block int")
    assert found(df, 5) == brute(rows, 5)


def test_bounds_stop_early_but_exactly():
    r = np.random.RandomState(3)
    centres = r.standard_normal((20, 64))
    v = np.floor(40 * (centres[r.randint(0, 20, 3000)] + 0.3 * r.standard_normal((3000, 64)))).astype(np.int64)
    cell = Cell(np.arange(3000), v)
    for q in range(0, 3000, 97):
        at, scores = cell.search(q, v[q], 5)
        exact = v @ v[q]
        exact[q] = -10**9
        want = np.sort(exact)[-5]
        assert set(at) == set(np.flatnonzero(exact >= want)) and (scores == exact[at]).all()
