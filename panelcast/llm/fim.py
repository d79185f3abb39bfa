"""Fill-in-middle transformation with a piecewise-linear learned rank index over the token boundaries.

Every text is cut at two token boundaries into prefix, middle and suffix, and written out plainly, as
prefix-suffix-middle or as suffix-prefix-middle. A token is white space (if any) with the word after it, or
white space at the end of the text. The boundaries of all texts of a block are ranked in one ascending list of byte
offsets; :class:`RankIndex` learns that list as line segments whose error is bounded, and stores what each
line misses by. A cut is the line's prediction for its rank, put right by the stored residual: exact, one
byte a boundary, and found without walking the text.

Which documents are cut, where, and in which form follows from SHA-256 of ``seed:id`` alone, so a repeated
task, another partitioning or another run gives the same output.

Defined results: a null text is an empty one; an empty text, or one that holds a sentinel, stays plain; a
null id is hashed as empty; rows of equal id are cut by the same hashes; a text of white space is one
token; texts of any length are taken whole (one text at a time is held); bytes that are no UTF-8 are
carried through; all columns of the input are kept in ``row``, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from panelcast.llm.common import chunks, packed, small_batches

SENTINELS = ("<P>", "<S>", "<M>")
#: No line misses a boundary by more bytes, so that a residual is one signed byte.
ERROR = 127
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


class RankIndex:
    """Ascending offsets by rank: line segments with errors of at most ``error``, and every residual."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR):
        self.first, self.base, self.slope = _segments(offsets, error)
        self.residual = np.zeros(0, np.int8 if error <= 127 else np.int64)
        missed = offsets - self._predicted(np.arange(len(offsets)))
        self.residual = missed.astype(self.residual.dtype)

    def _predicted(self, ranks: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, ranks, side="right") - 1
        return self.base[at] + np.rint(self.slope[at] * (ranks - self.first[at])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offset of each rank."""
        return self._predicted(ranks) + self.residual[ranks] if len(ranks) else np.zeros(0, np.int64)


def _segments(offsets: np.ndarray, error: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First rank, offset there and slope of the longest lines that the shrinking cone allows.

    From a segment's first point, the slopes that keep every point so far within ``error`` form a cone;
    the segment ends before the first point that leaves it empty. The points ahead are taken in windows
    that double, so a long segment costs a few array operations. Half a unit is kept for rounding.
    """
    first, base, slope = [], [], []
    at, n, reach = 0, len(offsets), error - 0.5
    while at < n:
        low, high, seen, window = -np.inf, np.inf, at + 1, 256
        while seen < n:
            some = slice(seen, min(n, seen + window))
            run = np.arange(some.start, some.stop) - at
            rise = (offsets[some] - offsets[at]).astype(float)
            lows = np.maximum(np.maximum.accumulate((rise - reach) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + reach) / run), high)
            empty = np.flatnonzero(lows > highs)
            inside = int(empty[0]) if len(empty) else len(run)
            if inside:
                low, high = lows[inside - 1], highs[inside - 1]
            seen += inside
            if len(empty):
                break
            window *= 2
        first.append(at)
        base.append(int(offsets[at]))
        slope.append((low + high) / 2 if seen > at + 1 else 0.0)
        at = seen
    return np.array(first, np.int64), np.array(base, np.int64), np.array(slope, float)


def boundaries(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Offsets of all token boundaries of the texts laid end to end, each text's first rank (plus the end), and the bytes.

    A text of n tokens has n + 1 boundaries: its start, and the end of each token.
    """
    buf = b"".join(texts)
    raw = np.frombuffer(buf, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    space = _SPACE[raw]
    # a token ends where a word does, and where a text does
    is_end = np.zeros(len(raw) + 1, bool)
    if len(raw):
        is_end[1:-1] = ~space[:-1] & space[1:]
    is_end[ends[sizes > 0]] = True
    token_end = np.flatnonzero(is_end)
    before = np.searchsorted(token_end, ends - sizes, side="right")
    counts = np.searchsorted(token_end, ends, side="right") - before
    first = np.concatenate([[0], np.cumsum(counts + 1)])
    offsets = np.empty(int(first[-1]), np.int64)
    starts = np.zeros(len(offsets), bool)
    starts[first[:-1]] = True
    offsets[starts] = ends - sizes
    offsets[~starts] = token_end
    return offsets, first, buf


def _characters(part: bytes) -> int:
    """Code points: bytes that do not continue one."""
    raw = np.frombuffer(part, np.uint8)
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def _transform(sentinels: tuple[str, str, str], error: int, out: pa.Schema):
    marks = [s.encode() for s in sentinels]
    prefix_mark, suffix_mark, middle_mark = marks

    def block(rows: list[tuple]) -> list[tuple]:
        texts = [text for text, *_ in rows]
        offsets, first, buf = boundaries(texts)
        index = RankIndex(offsets, error)
        units = np.diff(first)  # tokens plus one
        h1, h2 = (np.fromiter((row[k] for row in rows), np.int64, len(rows)) % units for k in (1, 2))
        low, high = np.minimum(h1, h2), np.maximum(h1, h2)
        cut_low, cut_high = index.offsets(first[:-1] + low), index.offsets(first[:-1] + high)
        start, end = offsets[first[:-1]], offsets[first[1:] - 1]
        made = []
        for i, (text, _, _, plain, spm) in enumerate(rows):
            n = int(units[i]) - 1
            if plain or not text or any(m in text for m in marks):
                made.append((n, "plain", None, None, text))
                continue
            prefix, middle, suffix = buf[start[i]:cut_low[i]], buf[cut_low[i]:cut_high[i]], buf[cut_high[i]:end[i]]
            if spm:
                output = b"".join((suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle))
            else:
                output = b"".join((prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle))
            made.append((n, "spm" if spm else "psm", _characters(prefix), _characters(middle), output))
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(1, 6)]
            made: list[tuple] = []
            for some in chunks(zip(*columns), lambda row: len(row[0])):
                made += block(some)
            cells = [pa.array([row[k] for row in made], out.field(k + 1).type) for k in range(4)]
            # bytes as they are: what is no UTF-8 passes through
            text = pa.array([row[4] for row in made], pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *cells, text], schema=out)

    return run


def _drawn(id_col: Column, seed: int, k: int) -> Column:
    """The k-th group of eight hexadecimal digits of SHA-256 of ``seed:id``."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), 8 * k + 1, 8), 16, 10).cast("long")


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50,
              spm_rate: int = 80, sentinels: tuple[str, str, str] = SENTINELS, error: int = ERROR) -> DataFrame:
    """Every row of ``docs`` as ``row``, with n (tokens), form, prefix_chars, middle_chars and the output.

    ``rate`` percent of the documents are transformed, ``spm_rate`` percent of these with the suffix first.
    ``sentinels`` announce prefix, suffix and middle; none may overlap itself or another one.
    """
    small_batches(docs.sparkSession)
    key = F.col(id_col)
    held = docs.select(packed(docs), F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")).alias("text"),
                       _drawn(key, seed, 0).alias("h1"), _drawn(key, seed, 1).alias("h2"),
                       (_drawn(key, seed, 2) % 100 >= rate).alias("plain"), (_drawn(key, seed, 3) % 100 < spm_rate).alias("spm"))
    made = "n long, form string, prefix_chars long, middle_chars long, output string"
    result = StructType([held.schema["row"], *StructType.fromDDL(made).fields])
    return held.mapInArrow(_transform(sentinels, error, to_arrow_schema(result)), result)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The original text from an output and its form.

    A text that holds a sentinel is never transformed, and no sentinel overlaps another, so the first place
    of each is the one that was written.
    """
    prefix_mark, suffix_mark, middle_mark = sentinels
    middle = F.substring_index(output, middle_mark, -1)
    head = F.substring_index(output, middle_mark, 1)
    # what stands before a mark begins with the other one
    after = {mark: F.substring(F.substring_index(head, other, 1), len(mark) + 1, 2**31 - 1)
             for mark, other in ((prefix_mark, suffix_mark), (suffix_mark, prefix_mark))}
    psm = F.concat(after[prefix_mark], middle, F.substring_index(head, suffix_mark, -1))
    spm = F.concat(F.substring_index(head, prefix_mark, -1), middle, after[suffix_mark])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
