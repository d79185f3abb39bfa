"""Language-model scoring by context-tree weighting over bytes.

A text is coded as its lower-cased words joined by one space and ended by a line feed. A byte is eight binary
decisions, and the context of a decision is the bits of the byte so far and the ``DEPTH`` bytes before it.
Every context at every depth has a Krichevsky-Trofimov estimate from its training counts; the
weight of a context against its longer ones follows from the probabilities that both give to the
training data (one half each beforehand), so the estimates of all depths are mixed.

Counting is a Spark aggregation of the byte strings of DEPTH + 1 bytes in all texts; those that only held-out
texts have are kept with a count of zero, which changes no probability. Every context is kept, however rare: the
levels of the tree are Spark tables, weighted from the longest contexts up and mixed from the shortest down
(``string_scores``), and the score of each byte string is joined to the blocks of ``BLOCK`` bytes of text that hold
it. Nothing but the common words is broadcast.

The unigram base score needs a count for every word: words at least as frequent as one in ``COMMON``
tokens (at most COMMON of them) are broadcast, all others are joined through a shuffle.

Defined results: null and empty texts hold only the end; a null id is never held out; without training
texts every bit costs one bit and every token is unknown; repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import chunks, small_batches, word_hashes, written

DEPTH = 5
COMMON = 1 << 20
CHUNK = 2_000_000
#: Bytes of text that share one table of byte strings.
BLOCK = 32_000_000
#: Rows that the table of a block is sent in.
PIECES = 1024
#: Entries that a counting task holds before it sends them.
FLUSH = 2_000_000
END = b"\n"


def coded(texts: list[bytes]) -> list[bytes]:
    return [b" ".join(t.lower().split()) + END for t in texts]


def grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the coded texts: it and the ``depth`` bytes before (the oldest highest), and its text."""
    pad = END * depth
    parts = [pad + t for t in texts]
    buf = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    out = np.zeros(max(0, len(buf) - depth), np.uint64)
    for i in range(depth + 1):
        out = (out << np.uint64(8)) | buf[i:len(buf) - depth + i]
    doc = np.repeat(np.arange(len(parts), dtype=np.uint64), lengths)
    first = np.cumsum(lengths) - lengths
    inside = np.arange(len(buf)) - np.repeat(first, lengths) >= depth
    return out[inside[depth:]], doc[inside]


_COUNTS = "kind int, block long, key long, n long"


def _count(depth: int):
    """Words of the training texts (kind 0), and byte strings of each block with their count in training texts (kind 1)."""
    schema = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("key", pa.int64()), ("n", pa.int64())])

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, n = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[new], np.add.reduceat(n, new)

    def flush(kind: int, block: int, held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        keys, n = merged(held)
        held.clear()
        for i in range(0, len(keys), 200_000):
            some = keys[i:i + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), kind, np.int32)), pa.array(np.full(len(some), block)),
                                              pa.array(some.view(np.int64)), pa.array(n[i:i + 200_000])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = ([], [])
        size = [0, 0]
        block = None
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("block", "held_out")),
                                                        batch.column("text").cast(pa.binary()).to_pylist()))
        for at, of in groupby(rows, lambda r: r[0]):
            if block is not None:
                yield from flush(1, block, held[1])
                size[1] = 0
            block = at
            for some in chunks(((t or b"", out) for _, out, t in of), lambda r: len(r[0]), CHUNK):
                learnt = np.array([not out for _, out in some])
                words, _ = word_hashes([t for t, out in some if not out], lower=True)
                codes, doc = grams(coded([t for t, _ in some]), depth)
                keys, back = np.unique(codes, return_inverse=True)
                for kind, found in ((0, np.unique(words, return_counts=True)),
                                    (1, (keys, np.bincount(back, weights=learnt[doc.astype(np.int64)], minlength=len(keys))))):
                    if len(found[0]):
                        held[kind].append((found[0], found[1].astype(np.int64)))
                        size[kind] += len(found[0])
                    if size[kind] >= FLUSH:
                        held[kind][:] = [merged(held[kind])]
                        size[kind] = len(held[kind][0][0])
                        if size[kind] >= FLUSH // 2:
                            yield from flush(kind, block, held[kind])
                            size[kind] = 0
        for kind in (0, 1):
            yield from flush(kind, block, held[kind])

    return run


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 8, stepped back."""
    steps = sum(np.log(x + i) for i in range(8))
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - steps


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - np.log(np.pi) - _log_gamma(a + b + 1)


class Tree:
    """The weighting of one tree in memory, by which tests check ``string_scores``; contexts may be left out.

    Keys (context << 8 | bits so far, with a leading one) and probabilities of a one, by depth.

    A decision takes the deepest context that the tree has; its probability mixes all depths down to it.
    """

    def __init__(self, nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """nodes: for each depth the keys and the counts of zeros and ones."""
        order = [np.argsort(k) for k, _, _ in nodes]
        self.keys = [k[o].astype(np.uint64) for (k, _, _), o in zip(nodes, order)]
        zeros = [a[o].astype(float) for (_, a, _), o in zip(nodes, order)]
        ones = [b[o].astype(float) for (_, _, b), o in zip(nodes, order)]
        depth = len(nodes) - 1
        weighted: list = [None] * (depth + 1)
        stay: list = [None] * (depth + 1)
        rest_one: list = [None] * (depth + 1)
        parent: list = [None] * (depth + 1)
        for d in range(depth, -1, -1):
            a, b = zeros[d], ones[d]
            own = _log_kt(a, b)
            split, a_rest, b_rest, branches = np.zeros(len(a)), a.copy(), b.copy(), np.zeros(len(a), np.int64)
            if d < depth and len(self.keys[d + 1]):
                child = self.keys[d + 1]
                up = ((child >> np.uint64(8)) & np.uint64((1 << 8 * d) - 1)) << np.uint64(8) | (child & np.uint64(255))
                at = np.searchsorted(self.keys[d], up)
                parent[d + 1] = at
                np.add.at(split, at, weighted[d + 1])
                np.add.at(a_rest, at, -zeros[d + 1])
                np.add.at(b_rest, at, -ones[d + 1])
                np.add.at(branches, at, 1)
            split += _log_kt(a_rest, b_rest)
            leaf = branches == 0
            share = np.where(leaf, 1.0, 1 / (1 + np.exp(np.clip(split - own, -700, 700))))
            weighted[d] = np.where(leaf, own, np.logaddexp(own, split) - np.log(2))
            stay[d], rest_one[d] = share, (b_rest + 0.5) / (a_rest + b_rest + 1)
        self.ones = []
        sum_above = left = None
        for d in range(depth + 1):
            own_one = (ones[d] + 0.5) / (zeros[d] + ones[d] + 1)
            above, free = (np.zeros(len(own_one)), np.ones(len(own_one))) if not d else (
                (sum_above[parent[d]], left[parent[d]]) if parent[d] is not None else (np.zeros(0), np.zeros(0)))
            sum_above, left = above + free * stay[d] * own_one, free * (1 - stay[d])
            self.ones.append((sum_above + left * rest_one[d]).astype(np.float64))

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """Log10 of the probability of each code's last byte after the bytes before it."""
        byte = codes & np.uint64(255)
        context = codes >> np.uint64(8)
        deepest = np.full(len(codes), len(self.keys) - 1)
        out = np.zeros(len(codes))
        for bit in range(8):
            so_far = np.uint64(1 << bit) | (byte >> np.uint64(8 - bit))
            one = np.full(len(codes), 0.5)
            todo = np.arange(len(codes))
            for d in range(len(self.keys) - 1, -1, -1):
                now = todo[deepest[todo] >= d]
                if not len(now) or not len(self.keys[d]):
                    deepest[now] = d - 1
                    continue
                key = ((context[now] & np.uint64((1 << 8 * d) - 1)) << np.uint64(8)) | so_far[now]
                at = np.minimum(np.searchsorted(self.keys[d], key), len(self.keys[d]) - 1)
                hit = self.keys[d][at] == key
                one[now[hit]] = self.ones[d][at[hit]]
                deepest[now[~hit]] = d - 1
                done = np.zeros(len(codes), bool)
                done[now[hit]] = True
                todo = todo[~done[todo]]
                if not len(todo):
                    break
            is_one = ((byte >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
            out += np.log10(np.where(is_one, one, 1 - one))
        return out


def _log_gamma_column(x: Column) -> Column:
    z, steps = x + 8, x
    for i in range(1, 8):
        steps = steps * (x + i)
    return (z - 0.5) * F.log(z) - z + F.lit(0.5 * np.log(2 * np.pi)) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z) - F.log(steps)


def _log_kt_column(a: Column, b: Column) -> Column:
    return _log_gamma_column(a + 0.5) + _log_gamma_column(b + 0.5) - F.lit(np.log(np.pi)) - _log_gamma_column(a + b + 1.0)


def string_scores(strings: DataFrame, depth: int) -> DataFrame:
    """code and value: log10 of the probability of each byte string's last byte after the bytes before it.

    A node is a context and the bits of the byte so far, with a leading one (key: context << 8 | bits). The bytes
    that follow a context are at most 256, and so are its longer contexts: no key is hot.
    """
    byte, context = F.col("code").bitwiseAND(F.lit(255)), F.shiftright("code", 8)
    seen = [F.lit(1 << k).bitwiseOR(F.shiftright("byte", 8 - k)) for k in range(8)]
    said = [F.shiftright("byte", 7 - k).bitwiseAND(F.lit(1)) for k in range(8)]
    parts = F.array(*[F.struct(a.alias("bits"), b.alias("bit")) for a, b in zip(seen, said)])
    # dealt by context before a row becomes eight: they are added up where they are
    bits = strings.select(context.alias("context"), byte.alias("byte"), "n").repartition("context").select("context", "n", F.inline(parts))
    node = bits.groupBy("context", "bits").agg(F.sum(F.expr("if(bit = 0, n, 0)")).alias("zeros"), F.sum(F.expr("if(bit = 1, n, 0)")).alias("ones"))
    node = node.select((F.col("context") * 256 + F.col("bits")).alias("key"), "zeros", "ones")
    own, split = _log_kt_column(F.col("zeros").cast("double"), F.col("ones").cast("double")), F.col("split")
    levels = []
    for d in range(depth, -1, -1):
        # only what the rest follows from is written
        level = written(node, f"level{d}")
        up = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * (d - 1)) - 1 if d else 0)) * 256 + F.col("key").bitwiseAND(F.lit(255))
        level = level.select("*", up.alias("parent"), own.alias("own"))
        if d == depth:
            level = level.withColumns({"stay": F.lit(1.0), "weighted": F.col("own")})
        else:
            stay = 1 / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), split - F.col("own")))))
            both = F.greatest("own", "split") + F.log1p(F.exp(-F.abs(F.col("own") - split))) - F.lit(np.log(2))
            level = level.withColumns({"stay": stay, "weighted": both})
        levels.append(level)
        node = level.groupBy(F.col("parent").alias("key")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("split"))
    one = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    above = None
    for level in reversed(levels):
        here = level.select("key", "parent", "stay", one.alias("one"))
        if above is None:
            here = here.withColumns({"sum_above": F.lit(0.0), "free": F.lit(1.0)})
        else:
            here = here.join(above.hint("merge"), "parent")
        # the next level finds its parents by this key
        above = here.select(F.col("key").alias("parent"), (F.col("sum_above") + F.col("free") * F.col("stay") * F.col("one")).alias("sum_above"),
                            (F.col("free") * (1 - F.col("stay"))).alias("free"))
    # a context has at most 255 nodes
    p = above.select(F.shiftright("parent", 8).alias("context"), F.struct(F.col("parent").bitwiseAND(F.lit(255)).alias("bits"), F.col("sum_above").alias("p")).alias("node"))
    of_context = p.groupBy("context").agg(F.map_from_entries(F.collect_list("node")).alias("nodes"))
    found = strings.select("code", context.alias("context"), byte.alias("byte")).join(of_context.hint("merge"), "context")
    chances = [F.element_at("nodes", a) for a in seen]
    value = [F.log10(F.when(b == 1, x).otherwise(1 - x)) for x, b in zip(chances, said)]
    return found.select("code", sum(value[1:], value[0]).alias("value"))


class Words:
    """The common words and their counts."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, n_train: int, n_distinct: int):
        self.words, self.counts, self.n_train, self.n_distinct = words, counts, n_train, n_distinct

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.n_train + self.n_distinct + 1))


def text_scores(texts: list[bytes], depth: int, known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of each text's byte strings; ``known`` are all byte strings of the block in order."""
    codes, doc = grams(coded(texts), depth)
    order = np.argsort(codes)
    codes = codes[order]
    new = np.concatenate([[True], codes[1:] != codes[:-1]])
    found = np.searchsorted(known, codes[new])
    return np.bincount(doc[order].astype(np.int64), weights=values[found][np.cumsum(new) - 1], minlength=len(texts))


def common_words(words: DataFrame, n_docs: int) -> tuple[Words, int]:
    """The words that are broadcast, and the least count of them."""
    n_words, v_words = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_train, n_distinct = n_words + n_docs, v_words + (n_docs > 0)
    least = n_train // COMMON + 1
    common = words.where(F.col("n") >= least).toArrow()
    key = common["key"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    return Words(key[order], common["n"].to_numpy()[order], n_train, n_distinct), least


_SCORED = "row_id long, n_tokens long, n_known long, base_score double, score double, n_bytes long, rare array<struct<key:long,n:int>>"


def _score(model, n_docs: int, depth: int):
    rare_type = pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int32())]))
    schema = pa.schema([("row_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()),
                        ("score", pa.float64()), ("n_bytes", pa.int64()), ("rare", rare_type)])

    def run(rows: pa.RecordBatch, strings: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        m = model.value
        for some in chunks(zip(rows.column("row_id").to_pylist(), rows.column("text").cast(pa.binary()).to_pylist()), lambda r: len(r[1] or b""), CHUNK):
            texts = [t or b"" for _, t in some]
            h, first = word_hashes(texts, lower=True)
            doc = np.repeat(np.arange(len(texts)), np.diff(first))
            if len(m.words):
                at = np.minimum(np.searchsorted(m.words, h), len(m.words) - 1)
                known = m.words[at] == h
                base = np.bincount(doc[known], weights=m.base(m.counts[at[known]]), minlength=len(texts))
                n_known = np.bincount(doc[known], minlength=len(texts))
            else:
                known, base, n_known = np.zeros(len(h), bool), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            base = base + m.base(np.array([n_docs]))[0]
            n_known = n_known + (n_docs > 0)
            order = np.lexsort((h[~known], doc[~known]))
            key, of = h[~known][order], doc[~known][order]
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (of[1:] != of[:-1])])) if len(key) else np.zeros(0, np.int64)
            n = np.diff(np.concatenate([new, [len(key)]])).astype(np.int32)
            offsets = np.searchsorted(of[new], np.arange(len(texts) + 1)).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(key[new].view(np.int64)), pa.array(n)], names=["key", "n"]))
            size = np.fromiter(map(len, coded(texts)), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([
                pa.array([r for r, _ in some], pa.int64()), pa.array(np.diff(first) + 1), pa.array(n_known.astype(np.int64)), pa.array(base),
                pa.array(text_scores(texts, depth, strings, values)), pa.array(size), rare], schema=schema)

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of each row and its block, a run of about BLOCK bytes of text."""
    task = TaskContext.get().partitionId()
    row, size = task << 33, 0
    for batch in batches:
        ends = size + np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.arange(row, row + len(ends))), pa.array((task << 33) + (ends - 1) // BLOCK)],
            names=[*batch.schema.names, "row_id", "block"])
        row, size = row + len(ends), int(ends[-1]) if len(ends) else size


def score(docs: DataFrame, held_out, depth: int = DEPTH, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its id, held_out, token counts, base and model log10 probability, and bits_per_byte.

    ``held_out`` is a condition; rows that fulfil it are not learnt from.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    # written, so that a row has the same number and block in every pass
    texts = written(rows.mapInArrow(_numbered, f"doc_id {id_type}, held_out boolean, text string, row_id long, block long"), "texts")
    n_docs = texts.where("not held_out").count()
    counts = written(texts.select("block", "held_out", "text").mapInArrow(_count(depth), _COUNTS), "counts")
    words = written(counts.where("kind = 0").groupBy("key").agg(F.sum("n").alias("n")), "words")
    model, least = common_words(words, n_docs)
    sent = spark.sparkContext.broadcast(model)
    of_block = counts.where("kind = 1").select("block", F.col("key").alias("code"), "n")
    strings = written(of_block.groupBy("code").agg(F.sum("n").alias("n")), "strings")
    values = written(string_scores(strings, depth), "values")
    piece = F.pmod(F.xxhash64("code"), F.lit(PIECES)).alias("piece")
    found = of_block.select("block", "code").join(values.hint("merge"), "code").groupBy("block", piece).agg(
        F.collect_list(F.struct("code", "value")).alias("found")).select("block", "found")
    # the table of a block comes before its texts
    both = texts.withColumn("part", F.lit(1)).unionByName(found.withColumn("part", F.lit(0)), allowMissingColumns=True)
    scored = written(_scored(both.repartition("block").sortWithinPartitions("block", "part"), _score(sent, n_docs, depth)), "scored")
    rare = scored.select("row_id", F.inline("rare")).join(
        words.where(F.col("n") < least).select("key", F.col("n").alias("count")), "key", "left")
    norm = F.lit(float(model.n_train + model.n_distinct + 1))
    count = F.coalesce("count", F.lit(0))
    sums = rare.groupBy("row_id").agg(F.sum(F.col("n") * F.log10((count + 1) / norm)).alias("more_base"),
                                      F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("more_known"))
    out = scored.drop("rare").join(sums, "row_id", "left")
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(model.n_train).cast("long").alias("train_tokens"),
                      (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), "score",
                      (-F.col("score") / F.col("n_bytes") * F.lit(float(np.log2(10)))).alias("bits_per_byte"))


def _scored(rows: DataFrame, run) -> DataFrame:
    """``run`` over the texts of each block and its byte strings, with doc_id and held_out carried along."""
    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        block = table = None
        for batch in batches:
            blocks, part = batch.column("block").to_numpy(), batch.column("part").to_numpy()
            cut = np.concatenate([[0], np.flatnonzero((blocks[1:] != blocks[:-1]) | (part[1:] != part[:-1])) + 1, [len(blocks)]])
            for a, b in zip(cut[:-1], cut[1:]):
                if a == b:
                    continue
                some = batch.slice(a, b - a)
                if block != blocks[a]:
                    block, table = blocks[a], None
                    held.clear()
                if not part[a]:
                    pairs = some.column("found").flatten()
                    held.append((pairs.field("code").to_numpy().view(np.uint64).copy(), pairs.field("value").to_numpy().copy()))
                    continue
                if table is None:
                    codes, values = (np.concatenate([h[i] for h in held]) for i in (0, 1))
                    held.clear()
                    order = np.argsort(codes)
                    table = codes[order], values[order]
                at = 0
                for made in run(some.select(["row_id", "text"]), *table):
                    of = some.slice(at, made.num_rows)
                    at += made.num_rows
                    yield pa.RecordBatch.from_arrays([of.column("doc_id"), of.column("held_out"), *made.columns],
                                                     names=["doc_id", "held_out", *made.schema.names])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(carry, f"doc_id {types['doc_id']}, held_out boolean, {_SCORED}")
