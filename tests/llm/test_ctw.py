import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import ctw
from panelcast.llm.ctw import END, Tree, coded, grams, score


def log_kt(a, b):
    return math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)


class Slow:
    """Context-tree weighting written out recursively, with all contexts kept."""

    def __init__(self, texts, depth):
        self.depth, self.n = depth, {}
        for t in texts:
            s = END * depth + t
            for i in range(depth, len(s)):
                for bit in range(8):
                    so_far, one = (1 << bit) | (s[i] >> (8 - bit)), (s[i] >> (7 - bit)) & 1
                    for d in range(depth + 1):
                        self.n.setdefault((s[i - d:i], so_far), [0, 0])[one] += 1
        self.kids = {}
        for c, b in self.n:
            if c:
                self.kids.setdefault((c[1:], b), []).append(c)
        self.memo = {}

    def weighted(self, c, b):
        if (c, b) not in self.memo:
            own = log_kt(*self.n[c, b])
            kids = self.kids.get((c, b))
            if kids:
                own = np.logaddexp(own, sum(self.weighted(k, b) for k in kids)) - math.log(2)
            self.memo[c, b] = own
        return self.memo[c, b]

    def one(self, context, b, d=0):
        c = context[len(context) - d:]
        if (c, b) not in self.n:
            return None
        x, y = self.n[c, b]
        kids = self.kids.get((c, b))
        own = (y + .5) / (x + y + 1)
        if not kids:
            return own
        split, log_own = sum(self.weighted(k, b) for k in kids), log_kt(x, y)
        share = 1 / (1 + math.exp(split - log_own))
        deeper = self.one(context, b, d + 1)
        return share * own + (1 - share) * (0.5 if deeper is None else deeper)

    def log10(self, t):
        s, out = END * self.depth + t, 0.0
        for i in range(self.depth, len(s)):
            for bit in range(8):
                p = self.one(s[i - self.depth:i], (1 << bit) | (s[i] >> (8 - bit)))
                p = 0.5 if p is None else p
                out += math.log10(p if (s[i] >> (7 - bit)) & 1 else 1 - p)
        return out


TRAIN = ["the cat sat on the mat", "the cat ate the rat", "été à la plage", "a a a a a", "", "THE Cat"]
OTHER = ["the rat sat", "zebra \x00 quiz", "", "été", "the  CAT\tsat on\nthe mat"]


@pytest.mark.parametrize("depth", [2, 3])
def test_scores_match_the_recursive_definition(spark, depth):
    rows = [(i, t, i >= len(TRAIN)) for i, t in enumerate(TRAIN + OTHER)] + [(50, None, True)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, out boolean, key long, n long")
    got = {r.doc_id: r for r in score(df, F.col("out"), depth=depth).collect()}
    slow = Slow(coded([t.encode() for t in TRAIN]), depth)
    counts = Counter(w for t in TRAIN for w in t.encode().lower().split())
    n, v = sum(counts.values()) + len(TRAIN), len(counts) + 1
    for i, t, out in rows:
        text = (t or "").encode()
        words = text.lower().split()
        assert got[i].score == pytest.approx(slow.log10(coded([text])[0]), rel=1e-9)
        c = [counts[w] for w in words] + [len(TRAIN)]
        assert got[i].base_score == pytest.approx(sum(math.log10((x + 1) / (n + v + 1)) for x in c), rel=1e-9)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens, got[i].held_out) == (len(c), sum(x > 0 for x in c), n, out)


def test_pruned_tree_is_a_distribution():
    texts = coded([b"the cat sat on the mat the hat"] * 5 + [b"some rare words here"])
    codes, _ = grams(texts, 2)
    nodes = []
    for d in range(3):
        n = Counter()
        for c in codes.tolist():
            for bit in range(8):
                key = ((c >> 8) & ((1 << 8 * d) - 1)) << 8 | (1 << bit) | ((c & 255) >> (8 - bit))
                n[key, ((c >> (7 - bit)) & 1)] += 1
        keys = [k for k in {k for k, _ in n} if n[k, 0] + n[k, 1] >= (12 if d else 0)]
        nodes.append((np.array(keys, np.int64), np.array([n[k, 0] for k in keys]), np.array([n[k, 1] for k in keys])))
    tree = Tree(nodes)
    for context in (b"th", b"zz", b" r", b"\n\n"):
        base = int.from_bytes(context, "big") << 8
        p = 10 ** tree.log10(np.arange(base, base + 256, dtype=np.uint64))
        assert p.sum() == pytest.approx(1)


def test_rare_words_and_pruning_on_a_table(spark, monkeypatch):
    monkeypatch.setattr(ctw, "COMMON", 50)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: (r.text or "").encode() for r in df.collect()}
    out = {i for i in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = Counter(w for i, t in rows.items() if i not in out for w in t.lower().split())
    docs = len(rows) - len(out)
    z = sum(counts.values()) + docs + len(counts) + 2
    got = score(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).collect()
    assert len(got) == len(rows)
    for r in got:
        c = [counts[w] for w in rows[r.doc_id].lower().split()] + [docs]
        assert r.held_out == (r.doc_id in out) and r.n_known == sum(x > 0 for x in c) and r.n_tokens == len(c)
        assert r.base_score == pytest.approx(sum(math.log10((x + 1) / z) for x in c), rel=1e-9)
    # held-out texts cost much less than by the frequencies of single bytes
    one = Counter(b"".join(coded([t for i, t in rows.items() if i not in out])))
    total = sum(one.values())
    single = sum(math.log10((one[b] + 1) / (total + 256)) for i in out for b in coded([rows[i]])[0])
    assert sum(r.score for r in got if r.held_out) > 0.65 * single


def test_levels_are_written_without_what_follows_from_them(spark, monkeypatch):
    """Tables of the tree's levels are most of what the query writes: parents and weights follow from key, counts and split."""
    held, written = {}, ctw.written
    monkeypatch.setattr(ctw, "written", lambda df, name: held.setdefault(name, written(df, name)))
    df = spark.createDataFrame(list(enumerate(TRAIN)), "doc_id long, text string")
    assert score(df, F.lit(False), depth=2).count() == len(TRAIN)
    assert [held[f"level{d}"].columns for d in (2, 1, 0)] == [["key", "zeros", "ones"], *[["key", "zeros", "ones", "split"]] * 2]


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    r = score(df, F.lit(True)).first()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and r.score == pytest.approx(-24 * math.log10(2))
    assert score(df.limit(0), F.lit(False)).count() == 0


def unpruned(rows, out):
    """The tree of all contexts of the training texts, in memory."""
    codes, n = np.unique(np.concatenate([grams(coded([t]), ctw.DEPTH)[0] for i, t in rows.items() if i not in out]), return_counts=True)
    nodes = []
    for d in range(ctw.DEPTH + 1):
        context, byte = (codes >> np.uint64(8)) & np.uint64((1 << 8 * d) - 1), codes & np.uint64(255)
        key = np.concatenate([context << np.uint64(8) | np.uint64(1 << k) | byte >> np.uint64(8 - k) for k in range(8)])
        one = np.concatenate([(byte >> np.uint64(7 - k)) & np.uint64(1) for k in range(8)]).astype(bool)
        keys, at = np.unique(key, return_inverse=True)
        nodes.append((keys, *(np.bincount(at, weights=np.tile(n, 8) * x, minlength=len(keys)) for x in (~one, one))))
    return Tree(nodes)


@pytest.mark.parametrize("block", [100_000, 32_000_000])
def test_every_context_counts_on_a_table(spark, monkeypatch, block):
    """More training bytes than any bound on contexts used to allow for; a text of a context seen once among them."""
    monkeypatch.setattr(ctw, "BLOCK", block)
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    df = df.unionByName(spark.createDataFrame([(-1, "qzxj wvkq jjxq"), (-2, "qzxj wvkq jjxq")], "doc_id long, text string"))
    held = (F.col("doc_id") % 5 == 1) | (F.col("doc_id") == -2)
    rows = {r.doc_id: (r.text or "").encode() for r in df.collect()}
    out = {i for i in rows if (i > 0 and i % 5 == 1) or i == -2}
    tree = unpruned(rows, out)
    got = {r.doc_id: r.score for r in score(df, held).collect()}
    assert len(got) == len(rows)
    for i in [-2, -1, *sorted(rows)[2::40]]:
        assert got[i] == pytest.approx(tree.log10(grams(coded([rows[i]]), ctw.DEPTH)[0]).sum(), rel=1e-6)


def test_model_beats_word_frequencies(spark):
    """Held-out texts of a larger table; with contexts rarer than one in 131,072 bytes merged, the model took 2.149 bits a byte."""
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = score(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2).where("held_out")
    model, base, size = got.agg(F.sum("score"), F.sum("base_score"), F.sum(-F.col("score") * math.log2(10) / F.col("bits_per_byte"))).first()
    assert model > base
    assert -model * math.log2(10) / size < 2.12
