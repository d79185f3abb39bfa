"""Toxicity by multiple-instance learning: sentences scored, combined by noisy-or, trained from document labels.

A document is a bag of sentences; it is toxic if any sentence is. A sentence is toxic with the probability
``sigmoid(bias + sum of its features' weights)``, and a document with ``1 - prod(1 - p)`` over its
sentences. Only documents are labelled: the gradient of the document's log likelihood hands its label down
to the sentences that account for it, so the trained model also says which sentences offend.

Features of a sentence are its distinct words in lower case and the first ``PREFIXES`` bytes of longer words,
as 64-bit hashes; nothing else of a document is looked at. Fitting takes every labelled row, in Spark:

1. the labelled texts are joined to their labels and written once;
2. tasks count, for hash buckets, in how many texts (of either label) they occur; buckets that part the
   labels are counted again by exact hash, and the features that part them make the model, at most ``FEATURES`` of
   them (its documented size). Parting means: shares among toxic and other texts that differ by a factor
   of ``LEAST_RATIO``, and counts more than ``LEAST_Z`` standard deviations off;
3. the sentences are written with the features that are left, and ``PASSES`` passes sum the gradient over them.

What reaches the driver is bounded by the model's size, whatever the tables hold.

Defined results: null or empty texts are one sentence without features; labels that are null or of unknown
documents are ignored, repeated ones count as toxic if any is; rows of equal id all learn from their label and are
scored alone; without labels of both kinds nothing can be learnt, and every score is the share of toxic
labels (0 without any); texts of any length are taken whole; all columns of the input are kept in ``row``,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from panelcast.llm.common import chunks, mix, packed, small_batches, token_spans, written

PREFIXES = (4, 5, 6)
BUCKETS = 1 << 20
SLICES = 16
#: Features of fewer labelled texts, fewer standard deviations off the toxic share, or shares that are more alike, are not used.
LEAST_TEXTS, LEAST_Z, LEAST_RATIO = 5, 4.5, 2.5
#: Counts that a task holds before it hands them on.
HELD_COUNTS = 300_000
FEATURES = 50_000
PASSES = 30
RATE, SHRINK = 0.3, 0.02
#: Gradients of all tasks are added up in so many tasks before they reach the driver.
SUMMERS = 8

_CLASSES = np.ones(256, np.uint8)
_CLASSES[:48] = 0
for _a, _b in ((58, 65), (91, 97), (123, 128)):
    _CLASSES[_a:_b] = 0
_ENDS = np.zeros(256, bool)
_ENDS[[10, 13, 33, 46, 63]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32


@dataclass
class Bags:
    """Sentences of some texts in order: each one's byte span, each text's first (plus the end), and features.

    ``feature`` holds the hashes of the distinct features of every sentence, sentence after sentence.
    """

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    sentence: np.ndarray
    feature: np.ndarray


def bags(texts: list[bytes], known: np.ndarray | None = None) -> Bags:
    """The sentences of the texts; with ``known`` (ascending hashes) only features among these.

    A sentence ends with ``.``, ``!``, ``?`` or a line; what holds no word belongs to no sentence, and a text without words
    is one sentence.
    """
    h, start, end, first = token_spans(texts, True, _CLASSES)
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    text_of = np.repeat(np.arange(len(texts)), np.diff(first))
    ends_before = np.concatenate([[0], np.cumsum(_ENDS[raw])])[start]
    new = np.ones(len(h), bool)
    new[1:] = (text_of[1:] != text_of[:-1]) | (ends_before[1:] != ends_before[:-1])
    sentence = np.cumsum(new) - 1
    # texts without words get a sentence of their own
    bare = np.flatnonzero(np.diff(first) == 0)
    owner = np.concatenate([text_of[new], bare])
    order = np.argsort(owner, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    sentence = place[sentence]
    text_at = np.concatenate([[0], np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))])
    last = np.ones(len(h), bool)
    last[:-1] = new[1:]
    spans = [np.concatenate([at, text_at[bare]])[order] for at in (start[new], end[last])]
    bag_first = np.searchsorted(owner[order], np.arange(len(texts) + 1))

    keys, where = [mix(h)], [sentence]
    if len(h):
        low = np.concatenate([_LOW[raw], np.zeros(8, np.uint8)])
        size, value = end - start, np.zeros(len(h), np.uint64)
        for k in range(max(PREFIXES)):
            value = (value << np.uint64(8)) | low[start + k].astype(np.uint64)
            if k + 1 in PREFIXES:
                longer = size > k + 1
                with np.errstate(over="ignore"):
                    keys.append(mix(value[longer] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1)))
                where.append(sentence[longer])
    feature, where = np.concatenate(keys), np.concatenate(where)
    if known is not None:
        inside = known[np.minimum(np.searchsorted(known, feature), len(known) - 1)] == feature if len(known) else np.zeros(len(feature), bool)
        feature, where = feature[inside], where[inside]
    order = np.lexsort((feature, where))
    feature, where = feature[order], where[order]
    distinct = np.ones(len(feature), bool)
    distinct[1:] = (feature[1:] != feature[:-1]) | (where[1:] != where[:-1])
    return Bags(*spans, bag_first, where[distinct], feature[distinct])


# --- the model ------------------------------------------------------------------------------

@dataclass
class Model:
    """Features as ascending hashes with their weights, and the bias of a sentence; or a constant score."""

    feature: np.ndarray
    weight: np.ndarray
    bias: float
    constant: float | None = None

    def sentence_scores(self, found: Bags) -> np.ndarray:
        """Probabilities of the sentences, from bags of the model's own features."""
        at = np.searchsorted(self.feature, found.feature)
        margin = np.full(len(found.start), self.bias)
        np.add.at(margin, found.sentence, self.weight[at])
        return _sigmoid(margin)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def noisy_or(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """1 - prod(1 - p) over the sentences of each text (every text has one at least)."""
    if len(first) < 2:
        return np.zeros(0)
    return -np.expm1(np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-15)), first[:-1]))


def gradient(weight: np.ndarray, bias: float, toxic: np.ndarray, first: np.ndarray, sentence: np.ndarray, column: np.ndarray):
    """Slope of the negative log likelihood by weight and by bias, and the likelihood itself."""
    margin = np.full(int(first[-1]), bias)
    np.add.at(margin, sentence, weight[column])
    p = _sigmoid(margin)
    doc = np.clip(noisy_or(p, first), 1e-12, 1 - 1e-12)
    # a clean document pushes every sentence down by p, a toxic one pulls it up by its part in the odds against it
    factor = np.where(toxic, -(1 - doc) / doc, 1.0)
    push = p * np.repeat(factor, np.diff(first))
    slope = np.bincount(column, weights=push[sentence], minlength=len(weight))
    return slope, float(push.sum()), float(-np.where(toxic, np.log(doc), np.log1p(-doc)).sum())


# --- counting -------------------------------------------------------------------------------

def _text_features(found: Bags) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text, and the text of each."""
    owner = np.searchsorted(found.first, found.sentence, side="right") - 1
    order = np.lexsort((found.feature, owner))
    feature, owner = found.feature[order], owner[order]
    distinct = np.ones(len(feature), bool)
    distinct[1:] = (feature[1:] != feature[:-1]) | (owner[1:] != owner[:-1])
    return feature[distinct], owner[distinct]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    for batch in batches:
        rows = zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist())
        for some in chunks(rows, lambda r: len(r[0])):
            yield [r[0] for r in some], np.array([r[1] for r in some], bool)


def _count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and toxic texts of every bucket, in slices of buckets."""
    counts = np.zeros((2, BUCKETS), np.int32)
    for texts, toxic in _blocks(batches):
        feature, owner = _text_features(bags(texts))
        bucket = (feature % np.uint64(BUCKETS)).astype(np.int64)
        np.add.at(counts[0], bucket, 1)
        np.add.at(counts[1], bucket[toxic[owner]], 1)
    if counts[0].any():
        parts = [(k, counts[:, k * (BUCKETS // SLICES):(k + 1) * (BUCKETS // SLICES)].astype(np.int64).tobytes()) for k in range(SLICES)]
        yield pa.record_batch([pa.array([k for k, _ in parts], pa.int32()), pa.array([b for _, b in parts], pa.binary())], names=["slice", "counts"])


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            got = np.frombuffer(blob, np.int64)
            totals[k] = totals[k] + got if k in totals else got
    if totals:
        yield pa.record_batch([pa.array(list(totals), pa.int32()), pa.array([v.tobytes() for v in totals.values()], pa.binary())], names=["slice", "counts"])


@dataclass(frozen=True)
class _Parting:
    """Which features part the labels, by the texts and the toxic texts that have them."""

    texts: int
    toxic: int
    least_texts: int
    least_z: float
    least_ratio: float

    def off(self, n: np.ndarray, bad: np.ndarray) -> np.ndarray:
        """Standard deviations between a feature's toxic texts and the share of all; 0 where it does not part them."""
        share, n, bad = self.toxic / self.texts, np.asarray(n, float), np.asarray(bad, float)
        z = np.abs(bad - n * share) / np.sqrt(np.maximum(n * share * (1 - share), 1e-12))
        return np.where((n >= self.least_texts) & (z >= self.least_z) & (np.abs(self.log_ratio(n, bad)) >= np.log(self.least_ratio)), z, 0.0)

    def log_ratio(self, n: np.ndarray, bad: np.ndarray) -> np.ndarray:
        return np.log((bad + 0.5) / (self.toxic + 1)) - np.log((n - bad + 0.5) / (self.texts - self.toxic + 1))


def _pick_buckets(parting: _Parting):
    """The buckets of a slice that part the labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _add_counts(batches):
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n, bad = np.frombuffer(blob, np.int64).reshape(2, -1)
                found = np.flatnonzero(parting.off(n, bad)) + k * (BUCKETS // SLICES)
                yield pa.record_batch([pa.array(found, pa.int64())], names=["bucket"])

    return run


def _count_exact(buckets: np.ndarray):
    """Texts and toxic texts of every hash in the given buckets."""
    wanted = np.zeros(BUCKETS, bool)
    wanted[buckets] = True

    def added(parts: list[np.ndarray]) -> np.ndarray:
        """Columns of hash, texts and toxic texts, each hash once."""
        table = np.concatenate(parts, axis=1)
        hashes, at = np.unique(table[0], return_inverse=True)
        return np.stack([hashes, *(np.bincount(at, weights=row, minlength=len(hashes)).astype(np.int64) for row in table[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [np.zeros((3, 0), np.int64)], 0
        for texts, toxic in _blocks(batches):
            feature, owner = _text_features(bags(texts))
            inside = wanted[(feature % np.uint64(BUCKETS)).astype(np.int64)]
            held.append(added([np.stack([feature[inside].view(np.int64), np.ones(int(inside.sum()), np.int64), toxic[owner[inside]].astype(np.int64)])]))
            size += held[-1].shape[1]
            if size > HELD_COUNTS:
                held = [added(held)]
                size = held[0].shape[1]
                if size > HELD_COUNTS // 2:
                    yield pa.record_batch([pa.array(row) for row in held[0]], names=["hash", "n", "bad"])
                    held, size = [np.zeros((3, 0), np.int64)], 0
        yield pa.record_batch([pa.array(row) for row in added(held)], names=["hash", "n", "bad"])

    return run


# --- fitting --------------------------------------------------------------------------------

_TRAIN = "toxic boolean, sentences int, sentence binary, feature binary"


def _train_rows(known: np.ndarray, out: pa.Schema):
    """Each text as its number of sentences and the known features of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, toxic in _blocks(batches):
            found = bags(texts, known)
            column = np.searchsorted(known, found.feature).astype(np.int32)
            at = np.searchsorted(found.sentence, found.first)
            within = (found.sentence - np.repeat(found.first[:-1], np.diff(at))).astype(np.int32)
            spans = list(zip(at[:-1], at[1:]))
            yield pa.record_batch([pa.array(toxic), pa.array(np.diff(found.first).astype(np.int32)),
                                   pa.array([within[a:b].tobytes() for a, b in spans], pa.binary()),
                                   pa.array([column[a:b].tobytes() for a, b in spans], pa.binary())], schema=out)

    return run


def _slopes(weight: np.ndarray, bias: float):
    """One row a task: the summed slopes by weight, then by bias, and the loss."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(weight) + 2)
        for batch in batches:
            toxic = np.asarray(batch.column("toxic")).astype(bool)
            first = np.concatenate([[0], np.cumsum(np.asarray(batch.column("sentences")).astype(np.int64))])
            within = [np.frombuffer(b, np.int32) for b in batch.column("sentence").to_pylist()]
            column = np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(b, np.int32) for b in batch.column("feature").to_pylist())])
            sentence = np.concatenate([np.zeros(0, np.int64), *(w + f for w, f in zip(within, first))])
            slope, by_bias, loss = gradient(weight, bias, toxic, first, sentence, column)
            total += np.concatenate([slope, [by_bias, loss]])
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["slope"])

    return run


def _add_slopes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            got = np.frombuffer(blob)
            total = got if total is None else total + got
    if total is not None:
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["slope"])


def fit(docs: DataFrame, labels: DataFrame, trained: Column | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        least_texts: int = LEAST_TEXTS, least_z: float = LEAST_Z, least_ratio: float = LEAST_RATIO, features: int = FEATURES, passes: int = PASSES) -> Model:
    """Fits the model to all labelled documents for which ``trained`` (a column over ``docs``; default all) holds."""
    spark = docs.sparkSession
    small_batches(spark)
    told = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    held = (docs if trained is None else docs.where(trained)).where(F.col(id_col).isNotNull()) \
        .select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")).alias("text"))
    # a shuffle of both at every size: the labels may be as long as the documents
    texts = written(held.join(told.hint("merge"), held["id"] == told["__id"]).select("text", (F.col("toxic") != 0).alias("toxic")), "toxic-texts")
    rows, toxic = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0))).first()
    none = np.zeros(0, np.uint64)
    if not 0 < toxic < rows:
        return Model(none, np.zeros(0), 0.0, constant=toxic / rows if rows else 0.0)
    parting = _Parting(rows, toxic, least_texts, least_z, least_ratio)

    counted = texts.mapInArrow(_count_buckets, "slice int, counts binary").repartition(SLICES, "slice")
    picked = counted.mapInArrow(_pick_buckets(parting), "bucket long").collect()  # BUCKETS at most
    exact = texts.mapInArrow(_count_exact(np.array([r.bucket for r in picked], np.int64)), "hash long, n long, bad long") \
        .groupBy("hash").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where(F.col("n") >= least_texts)

    @F.pandas_udf("double")
    def offs(n: pd.Series, bad: pd.Series) -> pd.Series:
        return pd.Series(parting.off(n, bad))

    best = exact.withColumn("off", offs("n", "bad")).where(F.col("off") > 0).orderBy(F.desc("off"), "hash").limit(features).collect()
    known = np.array([r.hash for r in best], np.int64).astype(np.uint64)
    order = np.argsort(known)
    known = known[order]
    n, bad = (np.array([r[k] for r in best], float)[order] for k in ("n", "bad"))

    train_as = StructType.fromDDL(_TRAIN)
    train = written(texts.mapInArrow(_train_rows(known, to_arrow_schema(train_as)), train_as), "toxic-bags")
    sentences = train.agg(F.sum("sentences")).first()[0]
    # start from the log ratios of the counts, and from a bias under which few sentences are toxic
    weight = parting.log_ratio(n, bad)
    bias = float(np.log(max(0.1 * toxic, 1.0) / sentences))
    mean, spread = np.zeros(len(weight) + 1), np.zeros(len(weight) + 1)
    for step in range(1, passes + 1):
        sums = train.mapInArrow(_slopes(weight, bias), "slope binary").repartition(SUMMERS).mapInArrow(_add_slopes, "slope binary").collect()
        slope = np.sum([np.frombuffer(r.slope) for r in sums], axis=0)[:-1]
        slope = np.append(slope[:-1] + SHRINK * weight, slope[-1])
        # Adam: steps by the running mean of the slope over its running spread
        mean, spread = 0.9 * mean + 0.1 * slope, 0.99 * spread + 0.01 * slope * slope
        move = RATE * (1 - step / (passes + 1)) * (mean / (1 - 0.9 ** step)) / (np.sqrt(spread / (1 - 0.99 ** step)) + 1e-9)
        weight, bias = weight - move[:-1], bias - float(move[-1])
    return Model(known, weight, bias)


# --- scoring --------------------------------------------------------------------------------

_SCORED = "score double, n_sentences int, offending array<struct<start:int,end:int,score:double>>"


def _score(model: Model, sentence_threshold: float, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, counts, offending = [], [], []
            for some in chunks(((t,) for t in batch.column(1).to_pylist()), lambda r: len(r[0])):
                texts = [t for t, in some]
                found = bags(texts, model.feature)
                if model.constant is not None:
                    p, total = np.zeros(len(found.start)), np.full(len(texts), model.constant)
                else:
                    p = model.sentence_scores(found)
                    total = noisy_or(p, found.first)
                scores.append(total)
                counts.append(np.diff(found.first))
                text_at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
                worst: list[list[dict]] = [[] for _ in texts]
                for k in np.flatnonzero(p >= sentence_threshold):
                    i = int(np.searchsorted(found.first, k, side="right")) - 1
                    a, b = int(found.start[k] - text_at[i]), int(found.end[k] - text_at[i])
                    start = len(texts[i][:a].decode("utf-8", "replace"))
                    worst[i].append({"start": start, "end": start + len(texts[i][a:b].decode("utf-8", "replace")), "score": float(p[k])})
                offending += worst
            scores, counts = (np.concatenate([np.zeros(0), *part]) for part in (scores, counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array(counts.astype(np.int32)),
                                              pa.array(offending, out.field("offending").type)], schema=out)

    return run


def score(docs: DataFrame, model: Model, text_col: str = "text", sentence_threshold: float = 0.3) -> DataFrame:
    """Every row of ``docs`` as ``row``, with its score, its number of sentences, and the offending ones.

    These are the sentences of ``sentence_threshold`` or more, by their span in code points from the first word to the last.
    """
    small_batches(docs.sparkSession)
    held = docs.select(packed(docs), F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")).alias("text"))
    result = StructType([held.schema["row"], *StructType.fromDDL(_SCORED).fields])
    return held.mapInArrow(_score(model, sentence_threshold, to_arrow_schema(result)), result)
