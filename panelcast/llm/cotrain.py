"""Quality classifier by co-training of a text view and a page-metadata view.

The text view sees which words and which runs of punctuation a text holds (hashed, presence only);
the metadata view sees language, source and length, and the layout of the page (line lengths, shares of
upper case, punctuation and digits, how often tokens repeat), but no words. Both are logistic
regressions of the probability that a document is bad: labelled as low quality or as toxic.
Over ``ROUNDS`` rounds each view labels, for the other one, the unlabelled documents that it is
sure of; sure means by its probability calibrated on labelled rows that neither view is fitted on.
Finally the calibrated views are combined, and a document is rejected from the least score at
which at most ``FALSE_REJECTS`` of the good calibration rows would be.

Only the labelled rows of the fit are bounded: the ``LABELLED`` ones that come first by the hash of their
id. Every unlabelled document is scored in Spark in each round, and the next views are fitted on the labelled rows and
on sums over all documents that the other view is sure of: how many texts have a bucket, and the slope and a bound of
the curvature of their loss at the present weights.

Defined results: null or empty texts have no tokens and are scored by the metadata and the
intercept; null metadata is a value of its own; labels that are null or of unknown documents are
ignored, repeated ones count as bad if any is; without labels of both kinds nothing can be learnt:
all scores are 0 and nothing is rejected; other columns are kept as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import chunks, packed, small_batches, token_spans, written

LABELLED = 16_000
ROUNDS = 3
SURE_BAD, SURE_GOOD = 0.98, 0.005
FALSE_REJECTS = 0.002
BUCKETS = 1 << 20
#: Sums over the unlabelled documents from which the text view of a round is fitted.
PASSES = 2
#: Buckets that fewer labelled and pseudo-labelled texts have are not used.
LEAST_TEXTS = 5
#: Token classes: white space and control 0, letters digits and non-ASCII 1, punctuation 2.
_CLASSES = np.ones(256, np.uint8)
_CLASSES[:33] = 0
_CLASSES[127] = 0
for _a, _b in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _CLASSES[_a:_b] = 2


def text_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct token buckets of all texts in order, each text's first, and for each text how its tokens repeat.

    The last has three columns: tokens, distinct buckets, and the count of the most frequent one.
    """
    h, _, _, first = token_spans(texts, True, _CLASSES)
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(first))
    keys, counts = np.unique((doc << np.uint64(32)) | (h % np.uint64(BUCKETS)), return_counts=True)
    at = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    most = np.zeros(len(texts))
    full = np.diff(at) > 0
    if full.any():
        most[full] = np.maximum.reduceat(counts, at[:-1][full])
    return (keys & np.uint64(BUCKETS - 1)).astype(np.int32), at, np.stack([np.diff(first), np.diff(at), most], axis=1)


#: Numeric metadata are cut into so many bins.
BINS = 12
NAMES = 64


def meta_numbers(texts: list[bytes], n_chars: list, repeats: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), 9))
    for i, text in enumerate(texts):
        raw = np.frombuffer(text, np.uint8)
        n = max(1, len(raw))
        lines = text.count(b"\n") + 1
        letters = max(1, int((((raw | 32) >= 97) & ((raw | 32) <= 122)).sum()))
        upper = int(((raw >= 65) & (raw <= 90)).sum())
        marks = int((_CLASSES[raw] == 2).sum()) if len(raw) else 0
        out[i, :6] = (np.log1p(n), np.log1p(float(n_chars[i] or 0)), np.log1p(n / lines), upper / letters, marks / n,
                      int(((raw >= 48) & (raw <= 57)).sum()) / n)
    tokens = np.maximum(1, repeats[:, 0])
    out[:, 6] = np.log1p(repeats[:, 0]) - np.log1p(repeats[:, 1])
    out[:, 7] = repeats[:, 2] / tokens
    out[:, 8] = np.log1p(repeats[:, 0] / np.maximum(1, repeats[:, 1]))
    return out


def meta_matrix(numbers: np.ndarray, names: list[tuple], edges: np.ndarray) -> np.ndarray:
    """One column per bin of each number, and per hashed name."""
    out = np.zeros((len(numbers), edges.shape[0] * BINS + 2 * NAMES), np.float32)
    row = np.arange(len(numbers))
    for j, cut in enumerate(edges):
        out[row, j * BINS + np.searchsorted(cut, numbers[:, j], side="right")] = 1
    for j in (0, 1):
        at = [zlib.crc32(f"{n[j]}".encode()) % NAMES for n in names]
        out[row, edges.shape[0] * BINS + j * NAMES + np.array(at, np.int64)] = 1
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _margins(weights: np.ndarray, idx: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Intercept plus the weights of each text's buckets."""
    total = np.concatenate([[0.0], np.cumsum(weights[idx], dtype=np.float64)])
    return weights[-1] + total[at[1:]] - total[at[:-1]]


def _fit_text(idx, at, y, pool=None, before=None, steps: int = 40, l2: float = 4.0) -> np.ndarray:
    """Logistic regression on the presence of buckets, each scaled by how it parts the labels.

    The scale is the smoothed log ratio of the shares of bad and of good texts that have the bucket (zero
    for buckets of fewer than ``LEAST_TEXTS`` texts); the steps are accelerated and scaled per bucket.
    The pool's documents count in the ratios, and in the loss by their slope and bound at the weights ``before``.
    """
    n = np.diff(at)
    all_texts, bad = np.bincount(idx, minlength=BUCKETS).astype(float), np.bincount(idx, weights=np.repeat(y, n), minlength=BUCKETS)
    rows, rows_bad = float(len(y)), float(y.sum())
    if pool is not None:
        found = pool.counts
        all_texts, bad, rows, rows_bad = all_texts + found["n"], bad + found["bad"], rows + found["rows"][0], rows_bad + found["rows"][1]
    ratio = np.log((bad + 1) / (rows_bad + 2)) - np.log((all_texts - bad + 1) / (rows - rows_bad + 2))
    ratio = np.where(all_texts >= LEAST_TEXTS, ratio, 0)
    # leave out the buckets that say nothing
    use = np.abs(ratio) > 0.3
    ratio = np.where(use, ratio, 0)
    column = (np.cumsum(use) - 1).astype(np.int32)
    inside = use[idx]
    doc = np.repeat(np.arange(len(y), dtype=np.int32), n)[inside]
    col, value = column[idx[inside]], ratio[idx[inside]].astype(np.float32)
    size = np.bincount(doc, weights=value * value, minlength=len(y))
    reach = np.bincount(col, weights=value * value * np.sqrt(np.maximum(size, 1))[doc] / np.abs(value), minlength=int(use.sum()))
    w = np.zeros(int(use.sum()) + 1)
    if before is not None:
        w[:-1], w[-1] = before[:-1][use] / ratio[use], before[-1]

    def weights() -> np.ndarray:
        out = np.zeros(BUCKETS + 1)
        out[:-1][use] = w[:-1] * ratio[use]
        out[-1] = w[-1]
        return out

    for _ in range(PASSES if pool is not None else 1):
        at_start, pull, bound = w.copy(), np.zeros(len(w)), np.zeros(len(w))
        if pool is not None:
            found = pool.slopes(weights(), ratio)
            pull = np.concatenate([found["slope"][use] * ratio[use], found["rest"][:1]])
            bound = 0.25 * np.concatenate([found["reach"][use] * np.abs(ratio[use]), found["rest"][1:]])
        step = 1 / (np.concatenate([0.25 * reach + l2, [0.25 * len(y)]]) + bound)
        ahead, t = w.copy(), 1.0
        for _ in range(steps):
            margin = ahead[-1] + np.bincount(doc, weights=ahead[col] * value, minlength=len(y))
            error = _sigmoid(margin) - y
            slope = np.concatenate([np.bincount(col, weights=error[doc] * value, minlength=len(w) - 1) + l2 * ahead[:-1], [error.sum()]])
            new = ahead - step * (slope + pull + bound * (ahead - at_start))
            t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
            ahead, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return weights()


def _fit_dense(x, y, l2: float = 1.0, steps: int = 12, near=None, pool=None, before=None) -> np.ndarray:
    """Logistic regression by Newton steps, held near the given weights; the last weight is the intercept.

    The pool's documents count by the slope and the bound of the curvature of their loss at the weights ``before``.
    """
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1).astype(np.float64)
    near = np.zeros(x.shape[1]) if near is None else np.asarray(near, np.float64)
    w = near.copy()
    pull, bound, start = np.zeros(len(w)), np.zeros((len(w), len(w))), w
    if pool is not None:
        pull, bound, start = pool.counts["meta_slope"], pool.counts["meta_bound"].reshape(len(w), -1), before
    ridge = np.diag(np.concatenate([np.full(len(w) - 1, l2), [1e-6]]))
    for _ in range(steps):
        p = _sigmoid(x @ w)
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + bound, x.T @ (p - y) + ridge @ (w - near) + pull + bound @ (w - start))
    return w


def _dense(w, x):
    return x @ w[:-1] + w[-1]


@dataclass
class Model:
    edges: np.ndarray
    text: np.ndarray
    meta: np.ndarray
    text_scale: np.ndarray
    meta_scale: np.ndarray
    mixed: np.ndarray
    threshold: float

    def views(self, texts: list[bytes], n_chars: list, names: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log odds of both views."""
        idx, at, repeats = text_features(texts)
        x = meta_matrix(meta_numbers(texts, n_chars, repeats), names, self.edges)
        return _dense(self.text_scale, _margins(self.text, idx, at)[:, None]), _dense(self.meta_scale, _dense(self.meta, x)[:, None])

    def score(self, text_odds: np.ndarray, meta_odds: np.ndarray) -> np.ndarray:
        return _sigmoid(_dense(self.mixed, _mixed(text_odds, meta_odds)))


def _mixed(text_odds, meta_odds):
    return np.stack([text_odds, meta_odds, np.maximum(text_odds, meta_odds)], axis=1)


def _sure(p: np.ndarray) -> np.ndarray:
    """1 (surely bad), 0 (surely good) or -1."""
    return np.where(p >= SURE_BAD, 1, np.where(p <= SURE_GOOD, 0, -1))


@dataclass
class Views:
    """Both views of a round, and the sums over unlabelled documents by which each teaches the other one."""

    edges: np.ndarray
    text: np.ndarray
    meta: np.ndarray
    text_scale: np.ndarray
    meta_scale: np.ndarray

    def for_text(self, x: np.ndarray) -> np.ndarray:
        return _sure(_sigmoid(_dense(self.meta_scale, _dense(self.meta, x)[:, None])))

    def count(self, sums: dict, idx: np.ndarray, at: np.ndarray, x: np.ndarray) -> None:
        """Adds the texts per bucket by pseudo-label, and slope and bound of the metadata view's loss."""
        label = self.for_text(x)
        of = np.repeat(label, np.diff(at))
        width = x.shape[1] + 1
        for name, size in (("n", BUCKETS), ("bad", BUCKETS), ("rows", 2), ("meta_slope", width), ("meta_bound", width * width)):
            sums.setdefault(name, np.zeros(size))
        np.add.at(sums["n"], idx[of >= 0], 1)
        np.add.at(sums["bad"], idx[of == 1], 1)
        sums["rows"] += ((label >= 0).sum(), (label == 1).sum())
        label = _sure(_sigmoid(_dense(self.text_scale, _margins(self.text, idx, at)[:, None])))
        sure = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)[label >= 0].astype(np.float64)
        sums["meta_slope"] += sure.T @ (_sigmoid(sure @ self.meta) - label[label >= 0])
        sums["meta_bound"] += (0.25 * sure.T @ sure).ravel()

    def slope(self, sums: dict, idx: np.ndarray, at: np.ndarray, x: np.ndarray, text: np.ndarray, ratio: np.ndarray) -> None:
        """Adds the slope of the text view's loss at the weights ``text``, and the bound of its curvature."""
        for name, size in (("slope", BUCKETS), ("reach", BUCKETS), ("rest", 2)):
            sums.setdefault(name, np.zeros(size))
        label, n = self.for_text(x), np.diff(at)
        error = np.where(label >= 0, _sigmoid(_margins(text, idx, at)) - label, 0)
        total = np.concatenate([[0.0], np.cumsum(np.abs(ratio[idx]))])
        reach = np.where(label >= 0, 1 + total[at[1:]] - total[at[:-1]], 0)
        np.add.at(sums["slope"], idx, np.repeat(error, n))
        np.add.at(sums["reach"], idx, np.repeat(reach, n))
        sums["rest"] += (error.sum(), reach.sum())


class Pool:
    """Unlabelled documents in memory."""

    def __init__(self, idx: np.ndarray, at: np.ndarray, numbers: np.ndarray, names: list[tuple]):
        self.idx, self.at, self.numbers, self.names = idx, at, numbers, names

    def total(self, add, edges: np.ndarray) -> dict:
        sums: dict = {}
        add(sums, self.idx, self.at, meta_matrix(self.numbers, self.names, edges))
        return sums

    def taught(self, views: Views) -> Pool:
        self.views, self.counts = views, self.total(views.count, views.edges)
        return self

    def slopes(self, text: np.ndarray, ratio: np.ndarray) -> dict:
        return self.total(lambda *rows: self.views.slope(*rows, text, ratio), self.views.edges)


#: Sums travel in slices of so many places: the places that are not 0 as they leave a task, all of them when added up.
SLICE = 1 << 16
_PARTS, _SLICES = "name int, slice int, at binary, x binary", "name int, slice int, x binary"


def _add_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for name, part, at, x in zip(*(c.to_pylist() for c in batch.columns)):
            total = totals.setdefault((name, part), np.zeros(SLICE))
            total[np.frombuffer(at, np.uint16)] += np.frombuffer(x)
    for (name, part), x in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.int32()), pa.array([part], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["name", "slice", "x"])


class TablePool(Pool):
    """Unlabelled documents as a table of their features; sums are made in tasks and added up by Spark."""

    def __init__(self, rows: DataFrame):
        self.rows = rows.select("lang", "source", "buckets", "numbers")

    def total(self, add, edges: np.ndarray) -> dict:
        sent = self.rows.sparkSession.sparkContext.broadcast((add, edges))
        sums: dict = {}
        add(sums, np.zeros(0, np.int32), np.zeros(1, np.int64), meta_matrix(np.zeros((0, len(edges))), [], edges))
        names = list(sums)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            add, edges = sent.value
            sums: dict = {}
            for batch in batches:
                if batch.num_rows:
                    idx, lengths, numbers, found = _arrays(batch)
                    add(sums, idx, np.concatenate([[0], np.cumsum(lengths)]), meta_matrix(numbers, found, edges))
            for name, x in sums.items():
                for part in range(0, len(x), SLICE):
                    at = np.flatnonzero(x[part:part + SLICE])
                    if len(at):
                        cells = [names.index(name)], [part // SLICE], [at.astype(np.uint16).tobytes()], [x[part + at].tobytes()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                                                         names=["name", "slice", "at", "x"])

        found = self.rows.mapInArrow(run, _PARTS).repartition("name", "slice").mapInArrow(_add_slices, _SLICES).toArrow()
        for name, part, x in zip(*(found[c].to_pylist() for c in ("name", "slice", "x"))):
            here = sums[names[name]][part * SLICE:(part + 1) * SLICE]
            here += np.frombuffer(x)[:len(here)]
        sent.destroy()  # each is up to 24 MB, which the driver would go on holding
        return sums

    def slopes(self, text: np.ndarray, ratio: np.ndarray) -> dict:
        return self.total(partial(self.views.slope, text=text, ratio=ratio), self.views.edges)


def cotrain(texts: list[bytes], n_chars: list, names: list[tuple], label: np.ndarray, rounds: int = ROUNDS) -> Model | None:
    """The model of whole texts and their metadata; ``label`` is 1 (bad), 0 (good) or -1 (unlabelled)."""
    parts = [text_features([t for t, in some]) for some in chunks(((t,) for t in texts), lambda r: len(r[0]))]
    idx = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int32)])
    lengths = np.concatenate([np.diff(p[1]) for p in parts] or [np.zeros(0, np.int64)])
    numbers = meta_numbers(texts, n_chars, np.concatenate([p[2] for p in parts] or [np.zeros((0, 3))]))
    of, known = np.repeat(label, lengths), label >= 0
    pool = Pool(idx[of < 0], np.concatenate([[0], np.cumsum(lengths[~known])]), numbers[~known], [n for n, k in zip(names, known) if not k])
    return cotrain_features(idx[of >= 0], lengths[known], numbers[known], [n for n, k in zip(names, known) if k], label[known], pool, rounds)


def cotrain_features(idx: np.ndarray, lengths: np.ndarray, numbers: np.ndarray, names: list[tuple], label: np.ndarray,
                     pool: Pool, rounds: int = ROUNDS) -> Model | None:
    """``label`` is 1 (bad) or 0 (good); every fifth row calibrates."""
    at = np.concatenate([[0], np.cumsum(lengths)])
    labelled = np.arange(len(label))
    held, own = labelled[::5], np.setdiff1d(labelled, labelled[::5])
    if min(len(set(label[held])), len(set(label[own]))) < 2:
        return None
    edges = np.quantile(numbers[own], np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    x = meta_matrix(numbers, names, edges)

    def of(rows):
        picked = np.concatenate([idx[at[i]:at[i + 1]] for i in rows])
        return picked, np.concatenate([[0], np.cumsum(lengths[rows])])

    text = meta = taught = None
    y, truth = label[own].astype(np.float64), label[held].astype(np.float64)
    for k in range(rounds + 1):
        text, meta = _fit_text(*of(own), y, taught, text), _fit_dense(x[own], y, pool=taught, before=meta)
        margin = _margins(text, *of(held))
        text_scale, meta_scale = _fit_dense(margin[:, None], truth, 1.0, near=(1, 0)), _fit_dense(_dense(meta, x[held])[:, None], truth, 1.0, near=(1, 0))
        if k < rounds:
            # each view's sure labels go to the other one
            taught = pool.taught(Views(edges, text, meta, text_scale, meta_scale))
    odds = _mixed(_dense(text_scale, margin[:, None]), _dense(meta_scale, _dense(meta, x[held])[:, None]))
    mixed = _fit_dense(odds, truth, 5.0, near=(0, 0, 1, 0))  # few rows leave the larger of both views
    good = np.sort(_sigmoid(_dense(mixed, odds))[truth == 0])
    allowed = good[max(0, len(good) - 1 - int(FALSE_REJECTS * len(good)))]
    return Model(edges, text, meta, text_scale, meta_scale, mixed, float(max(0.5, np.nextafter(allowed, 2))))


_FEATURES = "lang string, source string, buckets array<int>, numbers array<double>"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of the texts; the texts stay in their task."""
    for batch in batches:
        text, n_chars = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("n_chars").to_pylist()
        place = 0
        for some in chunks(zip(text, n_chars), lambda r: len(r[0] or b"")):
            texts = [t or b"" for t, _ in some]
            idx, at, repeats = text_features(texts)
            numbers = meta_numbers(texts, [n for _, n in some], repeats)
            rest = batch.slice(place, len(some))
            place += len(some)
            width = np.arange(0, numbers.size + 1, numbers.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(rest.column(c) for c in ("id", "lang", "source")),
                 pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(idx)),
                 pa.ListArray.from_arrays(pa.array(width), pa.array(numbers.ravel()))],
                names=["id", "lang", "source", "buckets", "numbers"])


def _arrays(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple]]:
    """Buckets, their number in each text, numeric metadata and names."""
    buckets = rows.column("buckets")
    return (buckets.flatten().to_numpy(), np.diff(buckets.offsets.to_numpy()), rows.column("numbers").flatten().to_numpy().reshape(rows.num_rows, -1),
            list(zip(rows.column("lang").to_pylist(), rows.column("source").to_pylist())))


def features(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Features of every document, with its label in ``bad`` (null: unlabelled)."""
    bad = F.greatest(1 - F.col("quality"), F.coalesce("toxic", F.lit(0))).cast("int")
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max(bad).alias("bad"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), "n_chars", "lang", "source")
    id_type = rows.schema["id"].dataType.simpleString()
    # a shuffle of both at every size: the labels may be as long as the documents
    return written(rows.mapInArrow(_features, f"id {id_type}, {_FEATURES}").join(known.hint("merge"), "id", "left"), "features")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    small_batches(docs.sparkSession)
    found = features(docs, labels, id_col, text_col)
    picked = found.where("bad is not null").select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(LABELLED)
    rows = found.where("bad is not null").join(F.broadcast(picked), "id").dropDuplicates(["id"]).orderBy("id").toArrow().combine_chunks()
    if not rows.num_rows:
        return None
    rows = rows.to_batches()[0]
    return cotrain_features(*_arrays(rows), rows.column("bad").to_numpy().astype(np.int64), TablePool(found.where("bad is null")))


def classify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as ``row``, with p_text, p_meta, score (probability of being bad) and kept."""
    small_batches(docs.sparkSession)
    scores = "struct<p_text:double,p_meta:double,score:double,kept:boolean>"

    @F.pandas_udf(scores)
    def judge(text: pd.Series, n_chars: pd.Series, lang: pd.Series, source: pd.Series) -> pd.DataFrame:
        rows = [((t or "").encode(), 0 if pd.isna(n) else n, (a, b)) for t, n, a, b in zip(text, n_chars, lang, source)]
        if model is None:
            zero = np.zeros(len(rows))
            return pd.DataFrame({"p_text": zero, "p_meta": zero, "score": zero, "kept": np.ones(len(rows), bool)})
        odds = [model.views(*map(list, zip(*some))) for some in chunks(rows, lambda r: len(r[0]))]
        text_odds, meta_odds = (np.concatenate([o[i] for o in odds] or [np.zeros(0)]) for i in (0, 1))
        score = model.score(text_odds, meta_odds)
        return pd.DataFrame({"p_text": _sigmoid(text_odds), "p_meta": _sigmoid(meta_odds), "score": score, "kept": score < model.threshold})

    judged = docs.select(packed(docs), judge(F.col(text_col), "n_chars", "lang", "source").alias("q"))
    return judged.select("row", "q.p_text", "q.p_meta", "q.score", "q.kept")
