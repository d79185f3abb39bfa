"""Helpers shared by the pipeline operators: table reads, shared-folder tables, word hashing.

Words are maximal runs of bytes other than ``[\\x20\\x09-\\x0D]`` (ASCII white space).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import ensure_checkpoint_dir

#: Bytes of text that a task turns into arrays at once (a longer single text is taken alone).
CHUNK_BYTES = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, re-read after a lost executor."""
    path = shared_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 300) -> None:
    """Bound the rows of an Arrow batch, so that long texts fit a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` as one struct: whatever their names, they cannot clash with ours."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def unpacked(df: DataFrame, columns: list[str], name: str = "row") -> list[Column]:
    return [F.col(f"{name}.`{c}`").alias(c) for c in columns]


def id_ranges(docs: DataFrame, id_col: str, text_col: str, target_bytes: int) -> list[int]:
    """Ascending cut points that split the ids into ranges of about ``target_bytes`` of text."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("binary")))).first()[0] or 0
    n = int(total // target_bytes) + 1
    if n == 1:
        return []
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    cuts = docs.agg(F.percentile_approx(F.col(id_col), shares, 20 * n + 1000)).first()[0]
    return sorted(set(cuts or []))


def range_of(id_column: Column, cuts: list[int]) -> Column:
    """Number of cut points at or below the id; ids that are null come first."""
    if not cuts:
        return F.lit(0)
    at = np.asarray(cuts, np.int64)

    @F.pandas_udf("int")
    def search(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(at, ids.to_numpy(), side="right").astype("int32"))

    return F.when(id_column.isNull(), F.lit(0)).otherwise(search(F.coalesce(id_column, F.lit(0)).cast("long")))


# --- words as arrays -------------------------------------------------------------------

_RNG = np.random.RandomState(20240501)
_BYTE = _RNG.randint(1, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 2**64)
_WORD = np.ones(256, np.uint8)
_WORD[[32, 9, 10, 11, 12, 13]] = 0
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        p, q = np.full(size, _R, np.uint64), np.full(size, _R_INV, np.uint64)
        p[0] = q[0] = 1
        return np.cumprod(p, dtype=np.uint64), np.cumprod(q, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def token_spans(texts: list[bytes], lower: bool, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the tokens of all texts in order, and each text's first token (plus the end).

    A token is a maximal run of bytes of one class; class 0 separates tokens.
    """
    buf = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    text_at = np.concatenate([[0], np.cumsum(lengths)])
    if lower:
        buf = _LOW[buf]
    of = classes[buf]
    cut = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]]) if len(of) else np.zeros(1, np.int64)
    start, end = cut[:-1], cut[1:]
    full = of[start] != 0 if len(start) else np.zeros(0, bool)
    start, end = start[full], end[full]
    size = 1 << max(16, int(len(buf)).bit_length())
    power, inverse = _powers(size)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[buf] * power[: len(buf)], dtype=np.uint64)])
        h = mix((total[end] - total[start]) * inverse[start])
    return h, start, end, np.searchsorted(start, text_at)


def word_hashes(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and each text's first word (plus the end)."""
    h, _, _, first = token_spans(texts, lower, _WORD)
    return h, first


def rolling(h: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hashes of every ``width`` consecutive values, by doubling the width."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out, have, base = None, 0, 0xD6E8FEB86659FD93
        power, span = h, 1
        while True:
            if width & span:
                part = power[have:][:n] if out is None else power[have:have + n]
                shift = np.uint64(pow(base, span, 2**64))
                out = part if out is None else out * shift + part
                have += span
            if have == width:
                return mix(out)
            shift = np.uint64(pow(base, span, 2**64))
            power = power[:-span] * shift + power[span:]
            span *= 2


def chunks(rows: Iterable[tuple], size_of, limit: int = CHUNK_BYTES) -> Iterator[list[tuple]]:
    """Consecutive rows whose sizes sum to about ``limit``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held
