"""Conversation structure repair: cheapest edits by Hirschberg's divide and conquer over four states.

A repaired conversation reads ``(s?(ua)+)?`` by the initials of its roles: perhaps a system message, then
user and assistant in turn, assistant last. Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (the only one for
blank and duplicate rows), Insert an empty user or assistant message 2; a truncated row that stays adds 1.
Of the cheapest sequences of edits the one whose initials are least in ASCII is taken.

The states are what a repair has read last: nothing, s, u or a. A row leads from state to state at a cost, by a
few letters that end with the row's own edit, so the letters of two ways through the same rows that end
in different states never begin each other: whichever is less stays less, whatever follows. A stretch of
rows is therefore summed up by the 4 x 4 least costs and, for each state it starts from, the order of the least
letters by the state it ends in (:func:`summed`). :func:`path` finds the states between the parts of a
stretch: costs forward to the middle and back from the end meet there, the cheapest crossing of the least
letters is chosen, and both halves are solved alone; only vectors of four are held.

The parts may be rows or whole stretches. Spark sorts the rows by conversation, turn, role and text into
ranges; a task repairs the conversations that lie within its range. A conversation that reaches
the edge of a range, or is longer than ``PIECE_ROWS`` rows or ``PIECE_BYTES``, becomes pieces: their summaries are joined
level by level (``FAN`` ranges at a time), the crossings are chosen from the top down, and every piece is repaired
alone between its two states. So a conversation that holds a third of all rows is spread over tasks.

Defined results: null roles and texts are one space; rows of a conversation stand by turn (nulls first),
then role, then text; a null conversation id is a conversation of its own; equal rows are duplicates of the first; an
empty role has no initial, so its row must be reroled or deleted; conversations whose rows were all dropped have
zeros and nothing repaired; other columns do not matter; an empty table gives an empty result. Duplicates are
found by a 64-bit hash of role and text within a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from panelcast.llm.common import small_batches, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
WHITE = " \t\n\x0b\x0c\r"
PIECE_ROWS, PIECE_BYTES = 4096, 4_000_000
#: Ranges (and groups of ranges) whose summaries are joined at once.
FAN = 64
FAR = 1 << 60

#: Where an inserted or reroled message leads: a user message unless one was read last.
_TURN = (USER, USER, ASSISTANT, USER)
#: Letters that complete a conversation from each state.
_END = ("", "II", "I", "")

#: Kinds of rows: to be deleted, then by initial (s, u, a, other) without and with truncation.
FORCED = 0
KINDS = 9

Element = tuple[tuple[tuple[int, ...], ...], tuple[tuple[int, ...], ...]]  # costs and orders, [from][to]


def kind_of(initial: int, truncated: bool) -> int:
    return 1 + initial + 4 * truncated


def _row_element(kind: int) -> tuple[Element, list[list[str]]]:
    """Costs, orders and least letters from each state to each through one row."""
    cost, letters = [[FAR] * 4 for _ in range(4)], [[""] * 4 for _ in range(4)]
    initial, extra = (kind - 1) % 4, TRUNCATED * (kind > 4)
    keeps = {SYSTEM - 1: (SYSTEM, {NOTHING}), USER - 1: (USER, {NOTHING, SYSTEM, ASSISTANT}), ASSISTANT - 1: (ASSISTANT, {USER})}
    for start in range(4):
        state, inserted = start, ""
        for _ in range(3):
            price = INSERT * len(inserted)
            ways = [("D", state, DELETE)]
            if kind != FORCED:
                ways.append(("R", _TURN[state], REROLE + extra))
                if initial in keeps and state in keeps[initial][1]:
                    ways.append(("K", keeps[initial][0], KEEP + extra))
            for letter, end, paid in ways:
                if (price + paid, inserted + letter) < (cost[start][end], letters[start][end]):
                    cost[start][end], letters[start][end] = price + paid, inserted + letter
            state, inserted = _TURN[state], inserted + "I"
    order = [_ranked([letters[s][t] if cost[s][t] < FAR else None for t in range(4)]) for s in range(4)]
    return (tuple(map(tuple, cost)), tuple(map(tuple, order))), letters


def _ranked(keys: list) -> tuple[int, ...]:
    """Place of each key among those that are not None."""
    places = {k: i for i, k in enumerate(sorted(k for k in keys if k is not None))}
    return tuple(places[k] if k is not None else 0 for k in keys)


_ROWS = [_row_element(k) for k in range(KINDS)]
ROW_ELEMENTS = [element for element, _ in _ROWS]


def forward(parts: Sequence[Element], start: int) -> tuple[list[int], tuple[int, ...]]:
    """Least costs from a state through all parts to each state, and the order of their least letters."""
    cost, order = [FAR] * 4, (0, 0, 0, 0)
    cost[start] = 0
    for step, places in parts:
        best: list[tuple] = [None] * 4
        for s in range(4):
            if cost[s] >= FAR:
                continue
            for t in range(4):
                if step[s][t] < FAR:
                    way = (cost[s] + step[s][t], order[s], places[s][t])
                    if best[t] is None or way < best[t]:
                        best[t] = way
        cost = [FAR if w is None else w[0] for w in best]
        order = _ranked([None if w is None else w[1:] for w in best])
    return cost, order


def backward(parts: Sequence[Element], end: int) -> list[int]:
    """Least costs from each state through all parts to a state."""
    cost = [FAR] * 4
    cost[end] = 0
    for step, _ in reversed(parts):
        cost = [min(step[s][t] + cost[t] for t in range(4)) for s in range(4)]
    return cost


def summed(parts: Sequence[Element]) -> Element:
    found = [forward(parts, s) for s in range(4)]
    return tuple(tuple(cost) for cost, _ in found), tuple(order for _, order in found)


def path(parts: Sequence[Element], start: int, end: int) -> list[int]:
    """The states before, between and after the parts on the cheapest way of the least letters."""
    states = [start] * len(parts) + [end]
    open_spans = [(0, len(parts), start, end)]
    while open_spans:
        a, b, s, e = open_spans.pop()
        if b - a < 2:
            continue
        middle = (a + b) // 2
        cost, order = forward(parts[a:middle], s)
        rest = backward(parts[middle:b], e)
        _, _, crossing = min((cost[t] + rest[t], order[t], t) for t in range(4) if cost[t] < FAR and rest[t] < FAR)
        states[middle] = crossing
        open_spans += [(a, middle, s, crossing), (middle, b, crossing, e)]
    return states


def last_state(costs: Sequence[int], order: Sequence[int]) -> int:
    """Where the cheapest complete repair leaves the last row."""
    return min((costs[t] + INSERT * len(_END[t]), order[t], t) for t in range(4) if costs[t] < FAR)[2]


@lru_cache(maxsize=20_000)
def edits(kinds: bytes, start: int = NOTHING, end: int | None = None) -> tuple[int, str, tuple[int, ...], tuple[int, ...]]:
    """Cost and initials of the edits of the rows, and for each repaired message its row (-1: inserted) and new role.

    The new role is 0 (as it was), ``USER`` or ``ASSISTANT``. Without ``end`` the conversation is completed.
    """
    parts = [ROW_ELEMENTS[k] for k in kinds]
    closing = ""
    if end is None:
        costs, order = forward(parts, start)
        end = last_state(costs, order) if parts else start
        closing = _END[end]
    states = path(parts, start, end)
    audit, rows, roles, price = [], [], [], 0
    for i, (kind, s, e) in enumerate(zip(kinds, states, states[1:])):
        audit.append(_ROWS[kind][1][s][e])
        price += _ROWS[kind][0][0][s][e]
        state = s
        for letter in audit[-1]:
            if letter in "IR":
                state = _TURN[state]
                rows.append(-1 if letter == "I" else i)
                roles.append(state)
            elif letter == "K":
                rows.append(i)
                roles.append(0)
    state = end
    for _ in closing:
        state = _TURN[state]
        rows.append(-1)
        roles.append(state)
    return price + INSERT * len(closing), "".join(audit) + closing, tuple(rows), tuple(roles)


# --- rows to pieces ---------------------------------------------------------------------

_MESSAGES = "array<struct<turn:long,role:string,text:string,hash:long,initial:int,fault:int>>"
_REPAIRED = "array<struct<role:string,text:string>>"
_NUMBERS = ("turns", "first_turn", "last_turn", "blank", "duplicate", "truncated", "illegal", "cost")
#: One row for a conversation or one of its pieces: open ones carry their messages, closed ones the repair.
_PIECE = ("open boolean, range int, piece int, messages " + _MESSAGES + ", "
          + ", ".join(f"{n} long" for n in _NUMBERS) + f", audit string, repaired {_REPAIRED}")


def prepared(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
             copies: Column | None = None) -> DataFrame:
    """The columns that the repair reads; ``copies`` says how often a row stands there (0: its conversation is still listed)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    body = F.rtrim(text, F.lit(WHITE))
    first = F.substring(role, 1, 1)
    return rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.xxhash64(role, text).alias("hash"),
        F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(F.when(first == "", 4).otherwise(3)).alias("initial"),
        F.when(body == "", 1).when(~F.substring(body, -1, 1).isin(".", "!", "?"), 2).otherwise(0).alias("fault"),
        (F.lit(1) if copies is None else copies).cast("int").alias("copies"))


def _judged(conv: np.ndarray, hashes: np.ndarray, fault: np.ndarray, initial: np.ndarray, seen: np.ndarray | None = None):
    """Kinds of the rows, and which are blank, duplicate or truncated. ``conv`` numbers the conversations in order."""
    order = np.lexsort((np.arange(len(conv)), hashes, conv))
    again = np.zeros(len(conv), bool)
    again[order[1:]] = (conv[order[1:]] == conv[order[:-1]]) & (hashes[order[1:]] == hashes[order[:-1]])
    if seen is not None:
        again |= seen
    blank = fault == 1
    duplicate = ~blank & again
    truncated = ~blank & ~again & (fault == 2)
    kinds = np.where(blank | duplicate, FORCED, 1 + np.minimum(initial, 3) + 4 * truncated).astype(np.uint8)
    return kinds, blank, duplicate, truncated


#: Pairs of initials (s, u, a) that may follow one another.
_LEGAL = np.zeros((5, 5), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True


def _counted(conv: np.ndarray, n: int, table: dict[str, np.ndarray], blank, duplicate, truncated) -> dict[str, np.ndarray]:
    """Numbers of each of ``n`` conversations (or pieces) whose rows stand together, in order."""
    same = conv[1:] == conv[:-1]
    known = table["known"]
    turn = table["turn"]
    new_turn = known.copy()
    new_turn[1:] &= ~(same & known[:-1] & (turn[1:] == turn[:-1]))
    illegal = np.zeros(len(conv), bool)
    illegal[1:] = same & ~_LEGAL[table["initial"][:-1], table["initial"][1:]]
    first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(first, conv[known], turn[known])
    np.maximum.at(last, conv[known], turn[known])

    def count(mask):
        return np.bincount(conv[mask], minlength=n)

    return {"turns": count(new_turn), "first_turn": first, "last_turn": last, "blank": count(blank),
            "duplicate": count(duplicate), "truncated": count(truncated), "illegal": count(illegal)}


def _messages(table: pa.Table, rows: list[int], roles: list[int], sizes: list[int], out: pa.DataType) -> pa.Array:
    """Repaired messages, ``sizes`` of them to a conversation, taken from the rows of the table."""
    at, new = np.array(rows, np.int64), np.array(roles, np.int64)
    held = pa.array(np.maximum(at, 0), mask=at < 0)
    named = pa.array(np.array(["", "", "user", "assistant"], object)[new], pa.string())
    role = pc.if_else(pa.array(new == 0), table["role"].combine_chunks().take(held) if len(table) else named, named)
    text = pc.fill_null(table["text"].combine_chunks().take(held), "") if len(table) else pa.array([""] * len(at), pa.string())
    flat = pa.StructArray.from_arrays([role, text], fields=list(out.value_type))
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, flat, type=out)


def _numpy(table: pa.Table) -> dict[str, np.ndarray]:
    known = ~np.asarray(table["turn"].is_null())
    return {"known": known, "turn": np.asarray(pc.fill_null(table["turn"], 0)).astype(np.int64), "hash": np.asarray(table["hash"]).astype(np.int64),
            "initial": np.asarray(table["initial"]).astype(np.int64), "fault": np.asarray(table["fault"]).astype(np.int64)}


def _closed(convs: pa.Array, conv: np.ndarray, table: pa.Table, out: pa.Schema) -> pa.RecordBatch:
    """Whole conversations repaired; ``conv`` numbers the rows of the table by ``convs``."""
    n, cells = len(convs), _numpy(table)
    kinds, *faults = _judged(conv, cells["hash"], cells["fault"], cells["initial"])
    numbers = _counted(conv, n, cells, *faults)
    first = np.searchsorted(conv, np.arange(n + 1))
    packed_kinds = kinds.tobytes()
    rows, roles, sizes, audits, costs = [], [], [], [], []
    for i in range(n):
        a, b = int(first[i]), int(first[i + 1])
        cost, audit, at, new = edits(packed_kinds[a:b])
        rows += [r if r < 0 else a + r for r in at]
        roles += new
        sizes.append(len(at))
        audits.append(audit)
        costs.append(cost)
    numbers["cost"] = np.array(costs, np.int64)
    nothing = numbers["turns"] == 0
    made = {"open": pa.array([False] * n), "range": pa.nulls(n, pa.int32()), "piece": pa.nulls(n, pa.int32()),
            "messages": pa.nulls(n, out.field("messages").type), "audit": pa.array(audits, pa.string()),
            "repaired": _messages(table, rows, roles, sizes, out.field("repaired").type)}
    made |= {k: pa.array(v, pa.int64(), mask=nothing if k in ("first_turn", "last_turn") else None) for k, v in numbers.items()}
    return pa.RecordBatch.from_arrays([convs] + [made[f.name] for f in list(out)[1:]], schema=out)


def _opened(conv: pa.Array, place: int, piece: int, table: pa.Table, out: pa.Schema) -> pa.RecordBatch:
    """A piece of a conversation, to be repaired when its neighbours are known."""
    kind = out.field("messages").type
    flat = pa.StructArray.from_arrays([table[f.name].combine_chunks().cast(f.type) if len(table) else pa.nulls(0, f.type)
                                       for f in kind.value_type], fields=list(kind.value_type))
    made = {"open": pa.array([True]), "range": pa.array([place], pa.int32()), "piece": pa.array([piece], pa.int32()),
            "messages": pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), flat, type=kind)}
    return pa.RecordBatch.from_arrays([conv] + [made[f.name] if f.name in made else pa.nulls(1, f.type) for f in list(out)[1:]], schema=out)


def _pieces(out: pa.Schema, piece_rows: int, piece_bytes: int):
    """A sorted range of rows to closed conversations and open pieces."""

    def expanded(table: pa.Table) -> pa.Table:
        """Rows as often as they stand there; conversations by number."""
        copies = np.asarray(table["copies"])
        return table.take(pa.array(np.repeat(np.arange(len(table)), copies)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        held: pa.Table | None = None  # rows of conversations that are not over, the last one perhaps not begun here
        is_first, piece = True, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            codes = np.asarray(held["conv"].combine_chunks().dictionary_encode(null_encoding="encode").indices)
            cut = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1])
            begin = 0
            if len(cut) > 1:
                if is_first:  # the first conversation may have begun in an earlier range
                    end = int(cut[1])
                    yield _opened(held["conv"].combine_chunks()[:1], place, piece, expanded(held[:end]), out)
                    begin, is_first, piece = end, False, 0
                    cut = cut[1:]
                elif piece:  # the conversation of the pieces before ends here
                    end = int(cut[1])
                    yield _opened(held["conv"].combine_chunks()[:1], place, piece, expanded(held[:end]), out)
                    begin, piece = end, 0
                    cut = cut[1:]
                whole = held[begin:int(cut[-1])]
                if len(whole):
                    convs = held["conv"].combine_chunks().take(pa.array(cut[:-1]))
                    number = np.searchsorted(cut, np.arange(begin, int(cut[-1])), side="right") - 1
                    yield _closed(convs, np.repeat(number, np.asarray(whole["copies"])), expanded(whole), out)
                held = held[int(cut[-1]):].combine_chunks()
            while len(held) > piece_rows or (held.nbytes > piece_bytes and len(held) > 1):
                size = min(piece_rows, max(1, len(held) * piece_bytes // held.nbytes))
                yield _opened(held["conv"].combine_chunks()[:1], place, piece, expanded(held[:size]), out)
                piece += 1
                held = held[size:].combine_chunks()
                if not len(held):
                    break
        if held is not None and len(held):  # the last one may go on in the next range
            yield _opened(held["conv"].combine_chunks()[:1], place, piece, expanded(held), out)

    return run


# --- pieces to conversations --------------------------------------------------------------

_SUMMARY = "cost array<long>, order array<int>"
_EDGE = ("turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, "
         "head int, tail int, head_turn long, tail_turn long, n long")


def _seen_again(pieces: DataFrame) -> DataFrame:
    """For each open piece the hashes that an earlier piece of its conversation has too."""
    place = F.struct("range", "piece")
    keys = pieces.select("conv", place.alias("place"), F.explode(F.array_distinct("messages.hash")).alias("hash"))
    earliest = keys.groupBy("conv", "hash").agg(F.min("place").alias("earliest")).withColumnsRenamed({"conv": "__conv", "hash": "__hash"})
    later = keys.join(earliest, F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("hash") == F.col("__hash")))
    return later.where(F.col("place") > F.col("earliest")).groupBy("conv", "place").agg(F.collect_list("hash").alias("seen"))


def _open_rows(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Table, np.ndarray, tuple]]:
    """The messages of each piece of a batch, their kinds and faults."""
    names = batch.schema.names
    messages, seen = batch.column(names.index("messages")), batch.column(names.index("seen"))
    for i in range(batch.num_rows):
        flat = messages[i].values
        table = pa.Table.from_arrays([flat.field(k) if len(flat) else pa.nulls(0, flat.type[k].type) for k in range(flat.type.num_fields)],
                                     names=[f.name for f in flat.type])
        cells = _numpy(table)
        earlier = np.isin(cells["hash"], np.asarray(seen[i].values).astype(np.int64)) if seen[i].is_valid else None
        kinds, *faults = _judged(np.zeros(len(table), np.int64), cells["hash"], cells["fault"], cells["initial"], earlier)
        yield i, table, kinds, (cells, *faults)


def _flat(element: Element) -> tuple[list[int], list[int]]:
    return [c for row in element[0] for c in row], [o for row in element[1] for o in row]


def _element(cost: Sequence[int], order: Sequence[int]) -> Element:
    return tuple(tuple(cost[4 * s:4 * s + 4]) for s in range(4)), tuple(tuple(order[4 * s:4 * s + 4]) for s in range(4))


def _summaries(out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for i, table, kinds, (cells, *faults) in _open_rows(batch):
                cost, order = _flat(summed([ROW_ELEMENTS[k] for k in kinds]))
                n = len(table)
                numbers = _counted(np.zeros(n, np.int64), 1, cells, *faults)
                row = {k: int(v[0]) for k, v in numbers.items()} | {"cost": cost, "order": order, "n": n}
                if not cells["known"].any():
                    row |= {"first_turn": None, "last_turn": None}
                ends = {"head": 0, "tail": n - 1}
                row |= {k: int(cells["initial"][at]) if n else None for k, at in ends.items()}
                row |= {f"{k}_turn": int(cells["turn"][at]) if n and cells["known"][at] else None for k, at in ends.items()}
                made.append(row)
            keep = [batch.column(batch.schema.names.index(c)) for c in ("conv", "range", "piece")]
            cells = [pa.array([r[f.name] for r in made], f.type) for f in list(out)[3:]]
            yield pa.RecordBatch.from_arrays([*keep, *cells], schema=out)

    return run


def _joined(parts: list[dict]) -> dict:
    """The summary of consecutive parts from theirs."""
    cost, order = _flat(summed([_element(p["cost"], p["order"]) for p in parts]))
    row = {"cost": cost, "order": order}
    for k in ("turns", "blank", "duplicate", "truncated", "illegal", "n"):
        row[k] = sum(p[k] for p in parts)
    full = [p for p in parts if p["n"]]
    for a, b in zip(full, full[1:]):
        row["illegal"] += not _LEGAL[a["tail"], b["head"]]
        row["turns"] -= a["tail_turn"] is not None and a["tail_turn"] == b["head_turn"]
    row |= {k: full[at][k] if full else None for k, at in (("head", 0), ("head_turn", 0), ("tail", -1), ("tail_turn", -1))}
    known = [p for p in full if p["first_turn"] is not None]
    row["first_turn"] = min((p["first_turn"] for p in known), default=None)
    row["last_turn"] = max((p["last_turn"] for p in known), default=None)
    return row


def _join_up(out: pa.Schema, by: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda r: r[by])
        row = _joined(parts) | {"conv": key[0].as_py(), "unit": key[1].as_py()}
        return pa.Table.from_pylist([row], schema=out)

    return run


def _cross_down(out: pa.Schema, child: str, *unit: str):
    """The states between the children of a unit; a child is known by its number, and by its unit where that is named."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda r: r["child"])
        states = path([_element(p["cost"], p["order"]) for p in parts], parts[0]["start"], parts[0]["end"])
        rows = [{"conv": p["conv"], child: p["child"], "start": s, "end": e} | {u: p["unit"] for u in unit}
                for p, s, e in zip(parts, states, states[1:])]
        return pa.Table.from_pylist(rows, schema=out)

    return run


def _topmost(out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                end = last_state(r["cost"][:4], r["order"][:4])
                rows.append({"conv": r["conv"], "unit": r["unit"], "start": NOTHING, "end": end,
                             "cost": r["cost"][end] + INSERT * len(_END[end])})
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    return run


def _repaired(out: pa.Schema):
    """Pieces between their states; the last one completes the conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            start, end, is_last = (batch.column(names.index(c)).to_pylist() for c in ("start", "end", "is_last"))
            for i, table, kinds, _ in _open_rows(batch):
                _, audit, rows, roles = edits.__wrapped__(kinds.tobytes(), start[i], end[i])
                rows, roles, state = list(rows), list(roles), end[i]
                for _ in _END[state] if is_last[i] else "":
                    state = _TURN[state]
                    rows.append(-1)
                    roles.append(state)
                audit += _END[end[i]] if is_last[i] else ""
                place = [batch.column(names.index(c))[i:i + 1] for c in ("conv", "range", "piece")]
                yield pa.RecordBatch.from_arrays([*place, pa.array([audit]), _messages(table, rows, roles, [len(rows)], out.field("repaired").type)], schema=out)

    return run


@dataclass
class Repair:
    """``report``: one row of numbers for every conversation. ``pieces``: audit and repaired messages of a conversation
    that lay within one range (its only piece, ``range`` is null) or of the pieces of one that did not, in the order of range and piece."""

    report: DataFrame
    pieces: DataFrame


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS, piece_bytes: int = PIECE_BYTES, fan: int = FAN) -> Repair:
    """Repairs the conversations of ``prepared`` rows."""
    spark = rows.sparkSession
    small_batches(spark, 2000)
    schema = rows.schema
    conv = schema["conv"]

    def typed(ddl: str) -> StructType:
        return StructType([conv, *StructType.fromDDL(ddl).fields])

    keys = ["conv", "turn", "role", "__head", "hash", "__salt"]
    salted = rows.withColumns({"__head": F.substring("text", 1, 32), "__salt": F.monotonically_increasing_id()})
    ranges = salted.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__head", "__salt")
    held_as = typed(_PIECE)
    held = written(ranges.mapInArrow(_pieces(to_arrow_schema(held_as), piece_rows, piece_bytes), held_as), "turns")
    closed, pieces = held.where("not open"), held.where("open").select("conv", "range", "piece", "messages")

    place = F.struct("range", "piece")
    seen = _seen_again(pieces).withColumnsRenamed({"conv": "__conv", "place": "__place"})
    judged = pieces.join(seen, F.col("conv").eqNullSafe(F.col("__conv")) & (place == F.col("__place")), "left").drop("__conv", "__place")
    summary_as = typed(f"range int, piece int, {_SUMMARY}, {_EDGE}")
    level = written(judged.mapInArrow(_summaries(to_arrow_schema(summary_as)), summary_as), "turns")

    # Up: pieces of a range, then ever larger groups of ranges; down: the states at every crossing.
    unit_as = typed(f"unit int, {_SUMMARY}, {_EDGE}")
    state_as, span_as = typed("unit int, start int, end int"), typed("range int, piece int, start int, end int")
    most = level.agg(F.max("range")).first()[0] or 0
    ups = [level.withColumnsRenamed({"piece": "child", "range": "unit"})]
    top = ups[0].groupBy("conv", "unit").applyInArrow(_join_up(to_arrow_schema(unit_as), "child"), unit_as)
    while most > 0:
        below = written(top, "turns").withColumnRenamed("unit", "child").withColumn("unit", F.floor(F.col("child") / fan).cast("int"))
        ups.append(below)
        top = below.groupBy("conv", "unit").applyInArrow(_join_up(to_arrow_schema(unit_as), "child"), unit_as)
        most //= fan
    top = written(top, "turns")
    top_as = typed("unit int, start int, end int, cost long")
    states = ends = written(top.mapInArrow(_topmost(to_arrow_schema(top_as)), top_as), "turns")
    for below in reversed(ups):
        parent = states.select(F.col("conv").alias("__conv"), F.col("unit").alias("__unit"), "start", "end")
        between = below.join(parent, F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("unit") == F.col("__unit")))
        by_child = between.select("conv", "unit", "child", "cost", "order", "start", "end").groupBy("conv", "unit")
        if below is ups[0]:
            states = by_child.applyInArrow(_cross_down(to_arrow_schema(span_as), "piece", "range"), span_as)
        else:
            states = by_child.applyInArrow(_cross_down(to_arrow_schema(state_as), "unit"), state_as)
    spans = states.withColumnsRenamed({"conv": "__conv", "range": "__range", "piece": "__piece"})
    last = level.groupBy("conv").agg(F.max(place).alias("__last")).withColumnRenamed("conv", "__conv2")
    solvable = judged.join(spans, F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("range") == F.col("__range")) & (F.col("piece") == F.col("__piece"))) \
        .join(last, F.col("conv").eqNullSafe(F.col("__conv2"))) \
        .select("conv", "range", "piece", "messages", "seen", "start", "end", (place == F.col("__last")).alias("is_last"))
    made_as = typed(f"range int, piece int, audit string, repaired {_REPAIRED}")
    repaired = solvable.mapInArrow(_repaired(to_arrow_schema(made_as)), made_as)
    parts = closed.select("conv", "range", "piece", "audit", "repaired").unionByName(repaired)

    totals = top.drop("cost").join(ends.select(F.col("conv").alias("__conv"), "cost"), F.col("conv").eqNullSafe(F.col("__conv")))
    counted = closed.select("conv", *_NUMBERS).unionByName(totals.select("conv", *_NUMBERS))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    return Repair(counted.select("conv", gaps, "blank", "duplicate", "truncated", "illegal", "cost"), parts)


def digests(parts: DataFrame) -> DataFrame:
    """For each conversation its whole audit, and SHA-256 of its repaired ``role:text`` joined by new lines.

    The pieces of one conversation are read in order, one after the other, and never held together.
    """
    lines = F.array_join(F.transform("repaired", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    alone = parts.where("range is null").select("conv", "audit", F.sha2(lines.cast("binary"), 256).alias("repaired_sha256"))
    in_order = parts.where("range is not null").repartition("conv").sortWithinPartitions("conv", "range", "piece")
    in_order = in_order.select("conv", "audit", F.size("repaired").alias("n"), lines.cast("binary").alias("lines"))
    return alone.unionByName(in_order.mapInArrow(_digested(to_arrow_schema(alone.schema)), alone.schema))


def _digested(out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, digest, begun, any_row = None, [], hashlib.sha256(), False, False

        def finished() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"conv": conv, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], schema=out)

        for batch in batches:
            for row in batch.to_pylist():
                if any_row and row["conv"] != conv:
                    yield finished()
                    audit, digest, begun = [], hashlib.sha256(), False
                conv, any_row = row["conv"], True
                audit.append(row["audit"])
                if row["n"]:
                    digest.update((b"\n" if begun else b"") + row["lines"])
                    begun = True
        if any_row:
            yield finished()

    return run
