"""Near-duplicates by a chosen-path set similarity join (recursive min-wise trees).

1. Every document gets the set of its distinct word shingles, hashed, and ``COORDINATES`` min-wise
   values. Documents with equal sets form a class; the rest works on one member of each class.
2. ``TREES`` independent trees: the root of tree t branches on min-wise value t. A node of more than
   ``NODE`` classes branches again on two coordinates chosen by a hash of the node, until its
   children are small. A pair of similarity s follows a branch with probability s, so at 0.8 a tree
   loses a pair with probability below 0.25 at any depth, and all ten below 1e-6. A node whose
   members do not part (one child holds half of them) is dense: the members that share too few shingles with all
   others to be linked with one are taken out of it, and the rest is cut into pieces that share a pivot.
3. Small nodes are compared exhaustively on the min-wise values: a maximum spanning forest over the
   pairs that reach ``FLOOR`` (4.5 standard deviations under 0.8) gives candidate links, never more than
   members. In dense nodes, every member outside the largest cluster is compared with all members, in blocks.
4. The connected clusters of the candidate links hold every pair that shares a node and reaches the
   floor. A cluster of up to ``CLUSTER`` classes is decided exactly in one task: the sizes of all its
   intersections come from products of its membership matrix over the full shingle sets.
5. In larger clusters the candidate links are confirmed on the full sets first (one row per link);
   then only classes outside the largest confirmed component are compared with all others, in
   blocks of that size. Blocks return one row per member, and components are taken.

Classes stand for any number of copies, large nodes branch or are cut, and large clusters are
confirmed link by link, so no group of copies meets in one task and rows stay in proportion to members.

Defined results: a text of fewer words than a shingle is one shingle of all its words; null and
empty texts (or without words) have an empty set and are linked with nothing; rows with equal id
are judged by their own texts; a null id can be linked but names no component unless all ids of
it are null; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import chunks, mix, rolling, small_batches, word_hashes, written
from panelcast.llm.components import components

COORDINATES = 128
TREES = 10
NODE = 600
CLUSTER = 1000
FLOOR = 82
#: Columns of a membership matrix that are multiplied at once.
COLUMNS = 4096

_MULTIPLY = np.random.RandomState(7).randint(0, 2**63 - 1, COORDINATES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts in order (repeats included), and each text's first one."""
    h, first = word_hashes(texts, lower=True)
    whole = rolling(h, size)
    n = np.diff(first)
    count = np.maximum(n - size + 1, 0)
    out_at = np.concatenate([[0], np.cumsum(np.where(count, count, n > 0))])
    out = np.zeros(out_at[-1], np.uint64)
    full = np.repeat(count > 0, np.where(count, count, n > 0))
    src = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    out[full] = whole[src]
    for i in np.flatnonzero((n > 0) & (n < size)):
        out[out_at[i]] = mix(rolling(h[first[i]:first[i + 1]], int(n[i])) + np.uint64(int(n[i])))[0]
    return out, out_at


def _minwise(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The min-wise values of every set; at: the first hash of each non-empty set."""
    out = np.empty((len(at), COORDINATES), np.uint32)
    for k, a in enumerate(_MULTIPLY):
        out[:, k] = np.minimum.reduceat(((h * a) >> np.uint64(32)).astype(np.uint32), at)
    return out


_FEATURES = "key long, id long, n_shingles long, cls long, sig array<int>"


def _features(size: int):
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n_shingles", pa.int64()), ("cls", pa.int64()), ("sig", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist())
            for some in chunks(rows, lambda r: len(r[2] or b"")):
                h, at = shingle_hashes([t or b"" for _, _, t in some], size)
                n, cls = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
                for i in np.flatnonzero(np.diff(at)):
                    own = np.unique(h[at[i]:at[i + 1]])
                    n[i] = len(own)
                    cls[i] = int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)
                filled = n > 0
                sig = _minwise(h, at[:-1][filled]) if filled.any() else np.zeros((0, COORDINATES), np.uint32)
                offsets = np.concatenate([[0], np.cumsum(np.where(filled, COORDINATES, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(sig.view(np.int32).ravel()))
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in some], pa.int64()), pa.array([r[1] for r in some], pa.int64()),
                    pa.array(n), pa.array(cls, mask=~filled), lists], schema=schema)

    return run


def row_key(id_col: str, text_col: str):
    """Names a row by its id and text."""
    return F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))


def tree_nodes(classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(node, cls) of small nodes of 2 to NODE classes, and of dense nodes (None if there are none)."""
    rows = classes.select("cls", F.posexplode(F.slice("sig", 1, TREES)).alias("tree", "value"))
    rows = rows.select(F.xxhash64("tree", "value").alias("node"), "cls", F.array("tree").alias("used"))
    small, dense = [], []
    while True:
        rows = written(rows, "rows")
        sizes = written(rows.groupBy("node").count().where("count > 1"), "sizes")
        small.append(rows.join(sizes.where(F.col("count") <= NODE), "node").select("node", "cls"))
        large = sizes.where(F.col("count") > NODE)
        if large.isEmpty():
            break
        free = F.array_except(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), F.col("used"))
        picks = F.array(*[F.get("free", F.pmod(F.xxhash64("node", F.lit(i)), F.size("free")).cast("int")) for i in (1, 2)])
        held = rows.join(large, "node").join(classes.select("cls", "sig"), "cls").withColumn("free", free)
        kids = held.select("node", "cls", "count", "used", "sig", F.explode(F.array_distinct(picks)).alias("pick"))
        child = F.xxhash64("node", "pick", F.get("sig", F.col("pick")))
        kids = written(kids.select("node", "cls", "count", F.concat("used", F.array("pick")).alias("used"), "pick", child.alias("child")), "kids")
        most = kids.groupBy("node", "count", "pick", "child").agg(F.count("*").alias("n")).groupBy("node", "count").agg(F.max("n").alias("n"))
        close = written(most.where(F.col("n") * 2 >= F.col("count")).select("node", "count"), "close")
        dense.append(rows.join(close, "node").select("node", "cls", "count"))
        rows = kids.join(close, "node", "left_anti").select(F.col("child").alias("node"), "cls", "used")
    one = small[0]
    for more in small[1:]:
        one = one.unionByName(more)
    all_dense = None
    for more in dense:
        all_dense = more if all_dense is None else all_dense.unionByName(more)
    return one, None if all_dense is None else written(all_dense, "dense")


def _pairs_of_shingles(size: int):
    """(cls, shingle) for every distinct shingle of rows (cls, text)."""
    schema = pa.schema([("cls", pa.int64()), ("shingle", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())
            for some in chunks(rows, lambda r: len(r[1])):
                h, at = shingle_hashes([t for _, t in some], size)
                own = [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:])]
                cls = np.repeat(np.array([c for c, _ in some], np.int64), [len(x) for x in own])
                yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(np.concatenate(own).view(np.int64))], schema=schema)

    return run


def _linkable(dense: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The members of dense nodes without those that can be linked with no other member; ``count`` is what is left.

    Two sets have at most as many shingles in common as either one shares with any class of a dense node. Per node
    and narrow range of sizes, the least size and the most shared shingles tell whether that is enough for a link. Who
    is taken out shares nothing any more, so this is repeated while it takes out a tenth.
    """
    texts = _texts(docs, classes, dense.select("cls").distinct())
    sizes = classes.select("cls", "n")
    rows = written(dense.select("node", "cls").join(sizes, "cls"), "dense_sizes")
    left = rows.count()
    while left:
        here = texts.join(rows.select("cls").distinct(), "cls", "left_semi")
        once = here.mapInArrow(_pairs_of_shingles(shingle), "cls long, shingle long").groupBy("shingle").agg(
            F.count("*").alias("times"), F.min("cls").alias("cls")).where("times = 1").groupBy("cls").agg(F.count("*").alias("once"))
        known = rows.join(once, "cls", "left").select("node", "cls", "n", (F.col("n") - F.coalesce("once", F.lit(0))).alias("shared"))
        known = written(known, "shared")
        # a few hundred ranges at most, each 2 % wide
        of_range = known.groupBy("node", F.floor(F.log("n") * 50).alias("range")).agg(F.min("n").alias("n"), F.max("shared").alias("shared"))
        ranges = of_range.groupBy("node").agg(F.collect_list(F.struct("n", "shared")).alias("ranges"))
        enough = F.exists("ranges", lambda r: F.least(F.col("shared"), r["shared"]) * (100 + percent) >= (F.col("n") + r["n"]) * percent)
        rows = written(known.join(ranges, "node").where(enough).select("node", "cls", "n"), "linkable")
        before, left = left, rows.count()
        if left > 0.9 * before:
            break
    counts = rows.groupBy("node").count().where("count > 1")
    return written(rows.join(counts, "node").select("node", "cls", "count"), "dense")


def _pieces(dense: DataFrame) -> DataFrame:
    """Dense nodes in pieces of about NODE classes, each with the node's pivot (its least class)."""
    n = F.ceil(F.col("count") / NODE)
    pivots = dense.groupBy("node", "count").agg(F.min("cls").alias("cls"))
    own = dense.select(F.xxhash64("node", F.lit("piece"), F.pmod(F.xxhash64("cls"), n)).alias("node"), "cls")
    shared = pivots.select("node", "cls", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("i"))
    return own.unionByName(shared.select(F.xxhash64("node", F.lit("piece"), F.col("i")).alias("node"), "cls")).distinct()


_PAIRS = "a long, b long"
_PAIRS_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _forest(cls: np.ndarray, sig: np.ndarray) -> list[tuple[int, int]]:
    """Maximum spanning forest over the pairs that agree in FLOOR values (Prim, one row of similarities at a time)."""
    rest = np.arange(1, len(cls))
    best, via, now, out = np.zeros(len(rest), np.int64), np.zeros(len(rest), np.int64), 0, []
    while len(rest):
        agree = (sig[rest] == sig[now]).sum(axis=1)
        better = agree > best
        best[better], via[better] = agree[better], now
        i = int(best.argmax())
        if best[i] >= FLOOR:
            out.append((int(cls[via[i]]), int(cls[rest[i]])))
        now = rest[i]
        rest, best, via = np.delete(rest, i), np.delete(best, i), np.delete(via, i)
    return out


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches that cut no run of equal values of the first column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        last = int(np.searchsorted(key, key[-1]))
        if held and (last or held[-1].column(0)[-1].as_py() != key[0]):
            cut = last if held[-1].column(0)[-1].as_py() == key[0] else 0
            yield pa.concat_batches([*held, batch.slice(0, cut)])
            held, batch, last = [], batch.slice(cut), last - cut
        if last:
            yield batch.slice(0, last)
        held.append(batch.slice(last))
    if held:
        yield pa.concat_batches(held)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (node, cls, sig) sorted by node: the candidate links of every node."""
    for batch in _groups(batches):
        node, cls = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        sig = batch.column(2).flatten().to_numpy().reshape(-1, COORDINATES)
        cut = np.concatenate([[0], np.flatnonzero(np.diff(node)) + 1, [len(node)]])
        size = np.diff(cut)
        two = cut[:-1][size == 2]
        two = two[(sig[two] == sig[two + 1]).sum(axis=1) >= FLOOR] if len(two) else two
        made = [np.stack([cls[two], cls[two + 1]], axis=1)]
        for a, n in zip(cut[:-1][size > 2], size[size > 2]):
            made.append(np.array(_forest(cls[a:a + n], sig[a:a + n]), np.int64).reshape(-1, 2))
        pairs = np.concatenate(made)
        yield pa.RecordBatch.from_arrays([pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], schema=_PAIRS_ARROW)


def _candidates(members: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    rows = members.join(classes.select("cls", "sig"), "cls").select("node", "cls", "sig")
    rows = rows.repartition("node").sortWithinPartitions("node", "cls")
    return written(rows.mapInArrow(_compare, _PAIRS), name)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of the sets, by products of their membership matrix."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    shared = (count > 1)[column]
    owner, column = owner[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        x = np.zeros((len(sets), COLUMNS), np.float32)
        x[owner[a:b], column[a:b] - low] = 1
        out += x @ x.T
    out[np.arange(len(sets)), np.arange(len(sets))] = [len(x) for x in sets]
    return out


def _exact(size: int, percent: int):
    """Over rows (group, cls, comp, text) sorted by group: cls and label, the least class that links inside the
    group connect it with; classes of one comp are connected already."""
    schema = pa.schema([("cls", pa.int64()), ("label", pa.int64())])

    def label(cls: np.ndarray, comp: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
        n = np.array([len(x) for x in sets])
        both = intersections(sets)
        linked = (both > 0) & (100 * both >= percent * (n[:, None] + n[None, :] - both))
        out = np.full(len(cls), -1)
        of_comp: dict[int, list[int]] = {}
        for i, c in enumerate(comp.tolist()):
            of_comp.setdefault(c, []).append(i)
        for i in range(len(cls)):
            if out[i] < 0:
                out[i], todo, done = i, [i], set()
                while todo:
                    j = todo.pop()
                    near = np.flatnonzero(linked[j] & (out < 0)).tolist()
                    if comp[j] not in done:
                        done.add(comp[j])
                        near += [k for k in of_comp[int(comp[j])] if out[k] < 0]
                    out[near] = i
                    todo += dict.fromkeys(near)
        least = np.full(len(cls), np.iinfo(np.int64).max)
        np.minimum.at(least, out, cls)
        return least[out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches):
            group, cls, comp = (batch.column(i).to_numpy() for i in range(3))
            texts = batch.column(3).cast(pa.binary()).to_pylist()
            sets: list[np.ndarray] = []
            for some in chunks(((t,) for t in texts), lambda r: len(r[0])):
                h, at = shingle_hashes([t for t, in some], size)
                sets += [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:])]
            cut = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
            made = [label(cls[a:b], comp[a:b], sets[a:b]) for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(np.concatenate(made))], schema=schema)

    return run


def _confirm(size: int, percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(2)] + [batch.column(i).cast(pa.binary()).to_pylist() for i in (2, 3)]
            for some in chunks(zip(*cols), lambda r: len(r[2]) + len(r[3])):
                h, at = shingle_hashes([r[i] for r in some for i in (2, 3)], size)
                linked = []
                for i in range(0, len(at) - 1, 2):
                    x, y = np.unique(h[at[i]:at[i + 1]]), np.unique(h[at[i + 1]:at[i + 2]])
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in some], pa.int64()), pa.array([r[1] for r in some], pa.int64()),
                                                  pa.array(linked, pa.bool_())], schema=schema)

    return run


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """cls and text of one row of each wanted class."""
    keys = classes.join(wanted, "cls", "left_semi").select("key", "cls")
    return written(docs.join(keys, "key").dropDuplicates(["key"]).select("cls", "text"), "texts")


def find_groups(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: key (see ``row_key``), id, n_shingles, component_id and kept (id = component_id)."""
    small_batches(docs.sparkSession)
    held = docs.select(row_key(id_col, text_col).alias("key"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    features = written(held.mapInArrow(_features(shingle), _FEATURES), "features")
    classes = written(features.where("cls is not null").groupBy("cls")
                      .agg(F.min("key").alias("key"), F.min("id").alias("id"), F.any_value("n_shingles").alias("n"),
                           F.any_value("sig").alias("sig")), "classes")
    labels = _link(held, classes, shingle, percent)
    named = classes.select("cls", "id").join(labels, "cls", "left").select("cls", "id", F.coalesce("label", "cls").alias("label"))
    least = named.groupBy("label").agg(F.min("id").alias("component_id"))
    of_class = written(named.join(least, "label").select("cls", "component_id"), "of_class")
    found = features.drop("sig").join(of_class, "cls", "left")
    component = F.coalesce("component_id", "id")
    return found.select("key", "id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _link(docs: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """cls and label of every class that is linked with another one; linked classes have equal labels."""
    members, dense = tree_nodes(classes)
    if dense is not None:
        dense = _linkable(dense, docs, classes, shingle, percent)
        members = members.unionByName(_pieces(dense))
    pairs = _candidates(members, classes, "forest").distinct()
    clusters = components(pairs)
    if dense is not None:
        rows = dense.join(clusters, F.col("cls") == F.col("vertex"), "left").select("node", "cls", F.coalesce("component", "cls").alias("comp"))
        pairs = pairs.unionByName(_candidates(_blocks(rows, NODE // 2), classes, "outside")).distinct()
        clusters = components(pairs)
    clusters = clusters.select(F.col("vertex").alias("cls"), F.col("component").alias("cluster"))
    texts = _texts(docs, classes, clusters.select("cls"))
    sizes = written(clusters.groupBy("cluster").count(), "clusters")
    exact = lambda rows: rows.join(texts, "cls").select("group", "cls", "comp", "text").repartition("group").sortWithinPartitions(
        "group", "cls").mapInArrow(_exact(shingle, percent), "cls long, label long")
    small = clusters.join(sizes.where(F.col("count") <= CLUSTER), "cluster")
    labels = written(exact(small.select(F.col("cluster").alias("group"), "cls", F.col("cls").alias("comp"))), "labels")
    large = sizes.where(F.col("count") > CLUSTER)
    if large.isEmpty():
        return labels
    inside = written(clusters.join(large.select("cluster"), "cluster"), "large")
    a, b = (texts.select(F.col("cls").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    tested = pairs.join(inside.select(F.col("cls").alias("a")), "a").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    links = written(tested.mapInArrow(_confirm(shingle, percent), "a long, b long, linked boolean"), "links").where("linked").select("a", "b")
    known = components(links)
    rows = inside.join(known, F.col("cls") == F.col("vertex"), "left").select(
        F.col("cluster").alias("node"), "cls", F.coalesce("component", "cls").alias("comp"))
    blocks = _blocks(rows, CLUSTER // 2).select(F.col("node").alias("group"), "cls", "comp")
    more = written(exact(blocks), "more").where("cls != label").select(F.col("label").alias("a"), F.col("cls").alias("b"))
    found = components(links.unionByName(more))
    return labels.unionByName(found.select(F.col("vertex").alias("cls"), F.col("component").alias("label")))


def _blocks(rows: DataFrame, half: int) -> DataFrame:
    """Blocks that pair each class outside its node's largest comp with all classes of the node.

    ``rows`` has node, cls and comp; a block, a node of its own, has about ``half`` classes from either side.
    """
    groups = rows.groupBy("node", "comp").count().groupBy("node").agg(
        F.max(F.struct("count", "comp")).alias("top"), F.sum("count").alias("n"))
    rows = rows.join(groups.where(F.col("n") > F.col("top.count")), "node")
    all_n, out_n = F.ceil(F.col("n") / half), F.ceil((F.col("n") - F.col("top.count")) / half)
    every = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    left = rows.where(F.col("comp") != F.col("top.comp")).select(
        "node", "cls", "comp", F.pmod(F.xxhash64("cls"), out_n).alias("i"), F.explode(every(all_n)).alias("j"))
    right = rows.select("node", "cls", "comp", F.explode(every(out_n)).alias("i"), F.pmod(F.xxhash64("cls"), all_n).alias("j"))
    return left.unionByName(right).select(F.xxhash64("node", F.lit("block"), "i", "j").alias("node"), "cls", "comp").distinct()
