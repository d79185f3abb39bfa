import hashlib
import itertools
import random
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from panelcast.llm import queries, turns


def cheapest(kinds):
    """Least cost and letters of all edit sequences, letter by letter."""
    @lru_cache(None)
    def go(i, state, inserted):
        ways = [(0, "")] if i == len(kinds) and state in (0, 3) else []
        after = 3 if state == 2 else 2
        steps = [(2, "I", i, after, inserted + 1)] if inserted < 3 else []
        if i < len(kinds):
            steps.append((3, "D", i + 1, state, 0))
            initial, cut = kinds[i]
            if initial is not None:
                steps.append((2 + cut, "R", i + 1, after, 0))
                if (initial, state) in {("s", 0), ("u", 0), ("u", 1), ("u", 3), ("a", 2)}:
                    steps.append((cut, "K", i + 1, " sua".index(initial), 0))
        for cost, letter, *rest in steps:
            found = go(*rest)
            if found is not None:
                ways.append((cost + found[0], letter + found[1]))
        return min(ways, default=None)

    for i in range(len(kinds), 0, -1):  # from the end, so that the recursion stays flat
        for state in range(4):
            go(i, state, 0)
    return go(0, 0, 0)


def as_kind(row):
    initial, cut = row
    return turns.FORCED if initial is None else turns.kind_of("suax".index(initial), bool(cut))


ROWS = [(None, 0), *itertools.product("suax", (0, 1))]


def test_edits_equal_all_sequences():
    rng = random.Random(1)
    cases = [c for n in range(4) for c in itertools.product(ROWS, repeat=n)]
    cases += [tuple(rng.choice(ROWS) for _ in range(rng.randrange(4, 25))) for _ in range(1500)]
    for case in cases:
        assert turns.edits(bytes(map(as_kind, case)))[:2] == cheapest(case)


def test_pieces_equal_the_whole():
    rng = random.Random(2)
    for _ in range(500):
        kinds = [as_kind(rng.choice(ROWS)) for _ in range(rng.randrange(1, 60))]
        cuts = sorted({0, len(kinds), *(rng.randrange(len(kinds) + 1) for _ in range(rng.randrange(6)))})
        pieces = [bytes(kinds[a:b]) for a, b in zip(cuts, cuts[1:])]
        pieces.insert(rng.randrange(len(pieces) + 1), b"")
        parts = [turns.summed([turns.ROW_ELEMENTS[k] for k in p]) for p in pieces]
        end = turns.last_state(*turns.forward(parts, turns.NOTHING))
        states = turns.path(parts, turns.NOTHING, end)
        audit = "".join(turns.edits(p, s, e)[1] for p, s, e in zip(pieces, states, states[1:])) + turns._END[end]
        assert audit == turns.edits(bytes(kinds))[1]


WHITE = " \t\n\x0b\x0c\r"


def brute(rows):
    """The contract in plain Python: {conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)}."""
    held = {}
    for conv, turn, role, text in rows:
        kept = held.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 4:
            role = "user"
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        kept += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, kept in held.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, cases, faults = set(), [], []
        for _, role, text in kept:
            body = text.rstrip(WHITE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            cases.append((None, 0) if fault in ("blank", "duplicate") else (role[:1] if role[:1] in ("s", "u", "a") else "x", int(fault == "truncated")))
        cost, audit = cheapest(tuple(cases))
        lines, at, state = [], 0, 0
        for letter in audit:
            after = 3 if state == 2 else 2
            if letter in "IR":
                lines.append(("", "", "user:", "assistant:")[after] + (kept[at][2] if letter == "R" else ""))
                state = after
            elif letter == "K":
                lines.append(f"{kept[at][1]}:{kept[at][2]}")
                state = " sua".index(kept[at][1][0])
            at += letter != "I"
        known = [t for t, _, _ in kept if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        first = [r[1][:1] for r in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def made(seed, convs, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    texts = ["Fine.", "no end", "", " \t\n", None, "Wirklich?", "schön! ", " ", "a.\x0b", "A b c. d"]
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randrange(1, longest)):
            spot = None if rng.random() < 0.05 else turn + rng.randrange(2) * rng.randrange(3)
            rows.append((conv, spot, rng.choice(roles), rng.choice(texts) if rng.random() < 0.7 else f"Text {rng.randrange(1000)}."))
    rows += rows[:5]
    rng.shuffle(rows)
    return rows


def ran(spark, rows, monkeypatch=None, **sizes):
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit("clash"))
    found = turns.repair(queries.damaged(docs), **sizes)
    texts = turns.digests(found.pieces).withColumnRenamed("conv", "c")
    both = found.report.join(texts, F.col("conv").eqNullSafe(F.col("c"))).collect()
    assert len(both) == len({r[0] for r in rows})
    return {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in both}


@pytest.mark.parametrize("sizes", [{}, {"piece_rows": 3, "fan": 2}, {"piece_bytes": 200}])
def test_conversations_equal_brute_force(spark, sizes):
    rows = made(4, 60, 25)
    assert ran(spark, rows, **sizes) == brute(rows)


def test_a_third_of_the_rows_in_one_conversation(spark):
    rows = made(5, 30, 12) + [(7, t, "user" if t % 3 else "assistant", f"t{t % 40}.") for t in range(900)] + [(7, None, "user", "Same.")] * 300
    assert ran(spark, rows, piece_rows=50, fan=2) == brute(rows)


def test_empty_table_and_conversations_that_vanish(spark):
    gone = [(c, 0, "user", "Hi.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert ran(spark, gone) == {r[0]: nothing for r in gone}
    assert ran(spark, gone[:1], piece_rows=1) == {gone[0][0]: nothing}
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found = turns.repair(turns.prepared(empty))
    assert found.report.count() == 0 and turns.digests(found.pieces).count() == 0


def test_long_texts(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t} " + "long text " * 200_000 + ".") for t in range(6)]
    assert ran(spark, rows) == brute(rows)
