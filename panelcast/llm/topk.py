"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Vectors of integers are dealt by a hash of their id to cells. A cell's index has, for every
dimension, posting segments: the vectors whose component falls into one quantised level. A query
gives every segment an impact, the most that it can add to a score. Segments are processed in
descending impact; after each round every vector has an upper bound: what its processed postings add
at most, plus for each other dimension the impact at which processing stopped. Exact scores of the best
accumulators give a threshold, and processing ends only when so few vectors can still reach it that
all of them are rescored exactly; members tied with the threshold are among them.

Cells and query blocks form a grid that Spark joins by block number: no cell, block or task grows with the
input, and only k rows per query and cell meet in the last ranking.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part; vectors
are compared with those of equal length; equal scores go to the smaller id; rows with the query's id are
not its candidates; other rows that repeat an id count each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a cell, queries of a block, levels to either side of zero.
CELL = 8192
BLOCK = 512
LEVELS = 32
#: Impacts, as shares of the query's largest, at which the bounds are tested; then zero and below.
ROUNDS = (0.5, 0.3, 0.2, 0.12, 0.07, 0.04, 0.02, 0.0)
ENOUGH = 96


class Cell:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n, dims = vectors.shape
        self.step = max(1, -(-int(np.abs(vectors).max()) // LEVELS))
        level = vectors // self.step + LEVELS
        key = (np.arange(dims) * (2 * LEVELS + 1) + level).T.ravel()
        order = np.argsort(key, kind="stable")
        self.postings = (order % n).astype(np.int64)
        key = key[order]
        self.at = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
        segment = key[self.at[:-1]]
        self.dim, low = segment // (2 * LEVELS + 1), (segment % (2 * LEVELS + 1) - LEVELS) * self.step
        self.low, self.high = low, low + self.step - 1

    def columns(self) -> tuple[bytes, ...]:
        return (self.ids.astype("<i8").tobytes(), self.vectors.astype("<i4").tobytes(), self.postings.astype("<u4").tobytes(),
                np.stack([self.at[:-1], np.diff(self.at), self.dim, self.low, self.high]).astype("<i8").tobytes())

    @classmethod
    def of(cls, dims: int, ids: bytes, vectors: bytes, postings: bytes, segments: bytes) -> Cell:
        out = cls.__new__(cls)
        out.ids, out.vectors = np.frombuffer(ids, "<i8"), np.frombuffer(vectors, "<i4").reshape(-1, dims).astype(np.int64)
        out.postings = np.frombuffer(postings, "<u4").astype(np.int64)
        start, size, out.dim, out.low, out.high = np.frombuffer(segments, "<i8").reshape(5, -1)
        out.at = np.concatenate([start, start[-1:] + size[-1:]])
        return out

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of the k best (with all ties of the last)."""
        n, dims = self.vectors.shape
        weight = query[self.dim]
        impact = np.maximum(weight * self.low, weight * self.high)
        order = np.argsort(-impact, kind="stable")
        falling = -impact[order]
        total, seen = np.zeros(n), np.zeros(n, np.int64)
        own = self.ids == query_id
        done, most = 0, max(float(impact[order[0]]), 0.0)
        exact: dict[int, int] = {}
        for share in ROUNDS:
            level = most * share
            upto = int(np.searchsorted(falling, -level, side="left" if share else "right"))
            some = order[done:upto]
            done = upto
            if len(some):
                size = self.at[some + 1] - self.at[some]
                first = np.cumsum(size) - size
                where = self.postings[np.repeat(self.at[some] - first, size) + np.arange(size.sum())]
                total += np.bincount(where, weights=np.repeat(impact[some], size), minlength=n)
                seen += np.bincount(where, minlength=n)
            bound = total + level * (dims - seen)
            bound[own] = -np.inf
            if n > 2 * k:
                for i in np.argpartition(-bound, 2 * k)[:2 * k].tolist():
                    if i not in exact and not own[i]:
                        exact[i] = int(self.vectors[i] @ query)
            floor = sorted(exact.values())[-k] if len(exact) >= k else -np.inf
            possible = np.flatnonzero(bound >= floor)
            if len(possible) <= ENOUGH:
                break
        possible = possible[~own[possible]]
        scores = self.vectors[possible] @ query
        if len(scores) > k:
            keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            possible, scores = possible[keep], scores[keep]
        return possible, scores


_INDEX = "cell long, dims int, ids binary, vectors binary, postings binary, segments binary"
_FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id and v: floor(scale * component) of the vectors that take part."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & (F.size("x") > 0))
    odd = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(~odd).select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"), F.size("x").alias("dims"))


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table["vec_id"].to_numpy()
    v = table["v"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    return ids[order], v[order]


def _build(table: pa.Table) -> pa.Table:
    ids, v = _arrays(table)
    blobs = Cell(ids, v).columns()
    columns = [pa.array([table["cell"][0].as_py()], pa.int64()), pa.array([v.shape[1]], pa.int32()), *(pa.array([b], pa.binary()) for b in blobs)]
    return pa.table(columns, names=["cell", "dims", "ids", "vectors", "postings", "segments"])


def build_index(rows: DataFrame) -> DataFrame:
    """One row per cell of ``quantised`` rows."""
    n = rows.count() // CELL + 1
    return rows.withColumn("cell", F.pmod(F.xxhash64("vec_id"), F.lit(n))).groupBy("cell", "dims").applyInArrow(_build, _INDEX)


def _gather(table: pa.Table) -> pa.Table:
    ids, v = _arrays(table)
    return pa.table([pa.array([table["block"][0].as_py()], pa.int64()), pa.array([v.shape[1]], pa.int32()),
                     pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([v.astype("<i8").tobytes()], pa.binary())],
                    names=["block", "dims", "query_ids", "queries"])


def _search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        for batch in batches:
            for dims, *blobs, query_ids, queries in zip(*(batch.column(i).to_pylist() for i in range(7))):
                cell = Cell.of(dims, *blobs)
                out = [np.zeros((0, 3), np.int64)]
                for q, v in zip(np.frombuffer(query_ids, "<i8").tolist(), np.frombuffer(queries, "<i8").reshape(-1, dims)):
                    at, scores = cell.search(q, v, k)
                    # of the ties of the last place, the smaller ids
                    best = np.lexsort((cell.ids[at], -scores))[:k]
                    out.append(np.stack([np.full(len(best), q), cell.ids[at[best]], scores[best]], axis=1))
                made = np.concatenate(out)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(made[:, i])) for i in range(3)], schema=schema)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best of all ``vectors`` for each distinct query id."""
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    index = build_index(quantised(vectors, id_col, vector_col, scale))
    asked = quantised(queries, id_col, vector_col, scale).dropDuplicates(["vec_id"])
    n = asked.count() // BLOCK + 1
    blocks = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n))).groupBy("block", "dims").applyInArrow(
        _gather, "block long, dims int, query_ids binary, queries binary")
    grid = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    pairs = grid.repartition("cell", "block").join(blocks, ["block", "dims"])
    pairs = pairs.select("dims", "ids", "vectors", "postings", "segments", "query_ids", "queries")
    best = pairs.mapInArrow(_search(k), _FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
