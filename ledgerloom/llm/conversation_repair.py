"""Structure of conversations, repaired at least cost by Hirschberg's divide and conquer.

A repaired conversation reads, by the initials of its roles, (s?(ua)+)?: an optional system line, then user and
assistant in turns, or nothing. Between two lines that pattern is in one of four states, so the cheapest
edits of the first lines are four costs, one a state, and so are the cheapest edits of the rest. Both vectors are taken to
the middle of the conversation without any table of all lines; a state where they add up to the least
cost is crossed there, and the halves are repaired in the same way. Among equally cheap
states the one with the least audit is crossed: no audit up to a line is the beginning of another one (each ends with
its last line's edit), so it is enough to carry the order of the four audits along with their costs.

On the cluster, lines are put in order by ranges, so a conversation of any length is spread over all tasks. It is cut into
pieces; a piece is summed up by its costs and orders from each state to each state, the crossings between
pieces are found from these sums alone, and then every piece is repaired by itself. Texts are joined at the end, to the
lines that stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written

DELETE, REROLE, INSERT, TRUNCATED = 2, 1, 5, 5
#: White space of the contract.
SPACES = " \t\n\x0b\x0c\r"

# States: nothing yet, after system, after user, after assistant. Lines: system, user, assistant, other.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_KEPT = ({NOTHING: SYSTEM}, {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
#: The state after an inserted or rerolled line.
_TURN = (USER, USER, ASSISTANT, USER)
_ROLES = ("", "system", "user", "assistant")
#: What the end of a conversation still needs in each state.
_TAIL = ("", "II", "I", "")
_LEGAL = {(0, 1), (1, 2), (2, 1)}
#: A line's code is its initial times 3 and its fault: none, truncated, or must go.
WHOLE, CUT, GONE = range(3)
#: From any state the rest costs at most this much more than from any other, so dearer states are never crossed.
_APART = 15


@dataclass(frozen=True)
class Settings:
    """piece: log2 of the most lines of a piece."""

    piece: int = 16


@lru_cache(maxsize=None)
def moves(code: int, state: int) -> dict[int, tuple[int, str]]:
    """For each state after a line the cheapest edits that lead there (cost, audit), the least audit among equals."""
    initial, fault = divmod(code, 3)
    found: dict[int, tuple[int, str]] = {}
    for inserted in range(3):
        edits = [(DELETE, "D", state)]
        if fault != GONE:
            more = TRUNCATED if fault == CUT else 0
            edits.append((REROLE + more, "R", _TURN[state]))
            if state in _KEPT[initial]:
                edits.append((more, "K", _KEPT[initial][state]))
        for cost, symbol, after in edits:
            edit = (cost + INSERT * inserted, "I" * inserted + symbol)
            found[after] = min(edit, found.get(after, edit))
        state = _TURN[state]
    return found


class _Vectors:
    """Cost vectors by number, and the number of the next one for each line's code.

    Vectors are kept less their smallest cost, of which there are few, so each step is looked up.
    """

    def __init__(self, step: Callable):
        self.step, self.vectors, self.numbers, self.next = step, [], {}, {}

    def number(self, vector: tuple) -> int:
        if vector not in self.numbers:
            self.numbers[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.numbers[vector]

    def run(self, start: tuple, codes: bytes) -> tuple[tuple, int]:
        """(the last vector, what was taken off on the way)."""
        at, total, known = self.number(start), 0, self.next
        for code in codes:
            found = known.get(at << 4 | code)
            if found is None:
                vector, least = self.step(self.vectors[at], code)
                found = known[at << 4 | code] = (self.number(vector), least)
            at, least = found
            total += least
        return self.vectors[at], total


def _forward(vector: tuple, code: int) -> tuple[tuple, int]:
    """(cost, place of its audit among the four) of each state, one line further."""
    found: dict[int, tuple] = {}
    for state, entry in enumerate(vector):
        if entry is not None:
            for after, (cost, audit) in moves(code, state).items():
                edit = (entry[0] + cost, entry[1], audit)
                found[after] = min(edit, found.get(after, edit))
    return _ranked(found)


def _ranked(found: dict[int, tuple]) -> tuple[tuple, int]:
    """States by (cost, order, order) as a vector, less its smallest cost."""
    least = min(cost for cost, *_ in found.values())
    near = [s for s in found if found[s][0] <= least + _APART]
    order = sorted(near, key=lambda s: found[s][1:])
    return tuple((found[s][0] - least, order.index(s)) if s in near else None for s in range(4)), least


def _backward(vector: tuple, code: int) -> tuple[tuple, int]:
    """Cost of the rest from each state, one line earlier."""
    costs = []
    for state in range(4):
        rest = [cost + vector[after] for after, (cost, _) in moves(code, state).items() if vector[after] is not None]
        costs.append(min(rest, default=None))
    least = min(c for c in costs if c is not None)
    return tuple(None if c is None else c - least for c in costs), least


_ahead, _behind = _Vectors(_forward), _Vectors(_backward)


def _only(state: int, value) -> tuple:
    return tuple(value if s == state else None for s in range(4))


def audit_between(codes: bytes, first: int, last: int) -> list[str]:
    """The least of the cheapest audits that lead through the lines from state `first` to state `last`, line by line."""
    audit, todo = [], [(0, len(codes), first, last)]
    while todo:
        start, stop, p, q = todo.pop()
        if stop - start == 1:
            audit.append(moves(codes[start], p)[q][1])
        elif stop > start:
            middle = (start + stop) // 2
            before, _ = _ahead.run(_only(p, (0, 0)), codes[start:middle])
            after, _ = _behind.run(_only(q, 0), codes[middle:stop][::-1])
            both = [s for s in range(4) if before[s] is not None and after[s] is not None]
            crossed = min(both, key=lambda s: (before[s][0] + after[s], before[s][1]))
            todo += [(middle, stop, crossed, q), (start, middle, p, crossed)]
    return audit


def sums(codes: bytes) -> tuple[list[int], list[int]]:
    """(costs, orders) of the cheapest audits from each state to each state, 16 of either; -1 where there is none."""
    costs, orders = [-1] * 16, [-1] * 16
    for p in range(4):
        vector, total = _ahead.run(_only(p, (0, 0)), codes)
        for q, entry in enumerate(vector):
            if entry is not None:
                costs[4 * p + q], orders[4 * p + q] = entry[0] + total, entry[1]
    return costs, orders


def crossings(pieces: list[tuple[list[int], list[int]]]) -> tuple[list[int], int]:
    """(the states before, between and after the pieces, cost with what the end needs), from the sums of the pieces."""
    vector, total, came = _only(NOTHING, (0, 0)), 0, []
    for costs, orders in pieces:
        found, origin = {}, {}
        for p, entry in enumerate(vector):
            if entry is not None:
                for q in range(4):
                    if costs[4 * p + q] >= 0:
                        edit = (entry[0] + costs[4 * p + q], entry[1], orders[4 * p + q])
                        if q not in found or edit < found[q]:
                            found[q], origin[q] = edit, p
        vector, least = _ranked(found)
        total += least
        came.append(origin)
    ends = {s: (entry[0] + INSERT * len(_TAIL[s]), entry[1]) for s, entry in enumerate(vector) if entry is not None}
    states = [min(ends, key=ends.get)]
    for origin in reversed(came):
        states.append(origin[states[-1]])
    return states[::-1], total + ends[states[0]][0]


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[object, list[dict]]]:
    """The rows of each run of equal values of a column."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[-1][column] != row[column]:
                yield held[0][column], held
                held = []
            held.append(row)
    if held:
        yield held[0][column], held


@dataclass(frozen=True)
class Repaired:
    """conversations: one row each, with its counts of faults, cost and audit. lines: what is left of them, with `place`
    and `part` for their order, the edit that made each line, its role and text."""

    conversations: DataFrame
    lines: DataFrame


def _key() -> Column:
    """128 bits that name a conversation, role and text."""
    name = F.col("conv").cast("string")
    lengths = F.coalesce(F.length(name), F.lit(-1)).cast("string"), F.length("role").cast("string")
    return F.unhex(F.md5(F.concat_ws(":", *lengths, name, F.col("role"), F.col("text")).cast("binary")))


def _light(rows: DataFrame) -> DataFrame:
    """What the repair needs to know of (conv, turn, role, text): a key of the line, and its code but for repetition."""
    stripped = F.rtrim("text", F.lit(SPACES))
    fault = F.when(stripped == "", GONE).when(F.substring(stripped, -1, 1).isin(".", "!", "?"), WHOLE).otherwise(CUT)
    initial = F.lit(3)
    for number, letter in enumerate("sua"):
        initial = F.when(F.substring("role", 1, 1) == letter, number).otherwise(initial)
    return rows.select("conv", "turn", _key().alias("key"), (initial * 3 + fault).cast("int").alias("code"))


def _summarise(group: pa.Table) -> pa.Table:
    """The pieces of a block: parts of conversations, with their codes, keys, sums and counts."""
    group = group.sort_by("place").combine_chunks()
    conv = group["conv"].combine_chunks()
    names = conv.dictionary_encode("encode").indices.to_numpy()
    turns, known = pc.fill_null(group["turn"], 0).to_numpy(), pc.is_valid(group["turn"]).to_numpy()
    codes, places = group["code"].to_numpy().astype(np.int64), group["place"].to_numpy()
    first = group["first"].to_numpy(zero_copy_only=False).astype(bool)
    initial, fault = codes // 3, codes % 3
    blank = fault == GONE
    again = ~first & ~blank
    codes = (initial * 3 + np.where(again, GONE, fault)).astype(np.uint8)
    starts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
    inner = np.append(False, names[1:] == names[:-1])
    pairs = np.append(0, initial[:-1]) * 4 + initial
    legal = np.isin(pairs, [a * 4 + b for a, b in _LEGAL])
    fresh = known & ~(inner & np.append(False, known[:-1]) & (np.append(0, turns[:-1]) == turns))
    count = lambda marks: np.add.reduceat(marks.astype(np.int64), starts)
    stops = np.append(starts[1:], len(places))
    keys = group["key"].to_pylist()
    # Nulls come first, so a piece's last turn is its largest one.
    seen = np.add.reduceat(known.astype(np.int64), starts)
    low = [int(turns[stop - n]) if n else None for stop, n in zip(stops, seen)]
    high = [int(turns[stop - 1]) if n else None for stop, n in zip(stops, seen)]
    found = [sums(codes[i:j].tobytes()) for i, j in zip(starts, stops)]
    return pa.table(
        {
            "conv": conv.take(pa.array(starts)),
            "piece": pa.array(places[starts]),
            "codes": pa.array([codes[i:j].tobytes() for i, j in zip(starts, stops)], pa.binary()),
            "keys": pa.array([b"".join(keys[i:j]) for i, j in zip(starts, stops)], pa.binary()),
            "costs": pa.array([c for c, _ in found], pa.list_(pa.int32())),
            "orders": pa.array([o for _, o in found], pa.list_(pa.int32())),
            "blank": pa.array(count(blank)),
            "duplicate": pa.array(count(again)),
            "truncated": pa.array(count((fault == CUT) & ~again)),
            "illegal": pa.array(count(inner & ~legal)),
            "ends": pa.array([[int(initial[i]), int(initial[j - 1])] for i, j in zip(starts, stops)], pa.list_(pa.int32())),
            "low": pa.array(low, pa.int64()),
            "high": pa.array(high, pa.int64()),
            "turns": pa.array(count(fresh)),
        }
    )


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_SUMS = "costs array<int>, orders array<int>, blank long, duplicate long, truncated long, illegal long, ends array<int>, low long, high long, turns long"


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states that each piece begins and ends with; a conversation's counts come with its first piece."""
    out: list[tuple] = []
    for _, pieces in _groups(batches, "conv"):
        states, cost = crossings([(p["costs"], p["orders"]) for p in pieces])
        totals = {c: sum(p[c] for p in pieces) for c in ("blank", "duplicate", "truncated", "illegal")}
        totals["illegal"] += sum((a["ends"][1], b["ends"][0]) not in _LEGAL for a, b in zip(pieces, pieces[1:]))
        dated = [p for p in pieces if p["low"] is not None]
        distinct = sum(p["turns"] for p in dated) - sum(a["high"] == b["low"] for a, b in zip(dated, dated[1:]))
        gaps = dated[-1]["high"] - dated[0]["low"] + 1 - distinct if dated else 0
        counts = [gaps, *totals.values(), cost]
        for number, piece in enumerate(pieces):
            out.append((piece["piece"], states[number], states[number + 1], number + 1 == len(pieces), *(counts if not number else [None] * 6)))
        if len(out) > 4096:
            yield _crossed(out)
            out = []
    if out:
        yield _crossed(out)


def _crossed(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["piece", "before", "after", "final", *_COUNTS])


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The audit of each piece, and the lines it leaves: (place, part, edit, role or null for its own, key or null)."""
    line = pa.list_(pa.struct([("place", pa.int64()), ("part", pa.int32()), ("edit", pa.string()), ("role", pa.string()), ("key", pa.binary())]))
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            audits, lines = [], []
            for row in part.select(["piece", "codes", "keys", "before", "after", "final"]).to_pylist():
                audit, state, left = audit_between(row["codes"], row["before"], row["after"]), row["before"], []
                tail = _TAIL[row["after"]] if row["final"] else ""
                for number, edits in enumerate([*audit, tail] if tail else audit):
                    place = row["piece"] + number
                    for n, symbol in enumerate(edits):
                        if symbol == "D":
                            continue
                        own = number if symbol != "I" else None
                        state = _KEPT[row["codes"][number] // 3][state] if symbol == "K" else _TURN[state]
                        left.append(
                            {
                                "place": place,
                                "part": n,
                                "edit": symbol,
                                "role": None if symbol == "K" else _ROLES[state],
                                "key": None if own is None else row["keys"][16 * own : 16 * own + 16],
                            }
                        )
                audits.append("".join(audit) + tail)
                lines.append(left)
            yield pa.RecordBatch.from_arrays(
                [part.column("conv"), part.column("piece"), pa.array(audits, pa.string()), pa.array(lines, line), *(part.column(c) for c in _COUNTS)],
                ["conv", "piece", "audit", "lines", *_COUNTS],
            )


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", settings: Settings = Settings()) -> Repaired:
    """The cheapest repair of each conversation.

    Lines come in the order of their turns, nulls first; those of one turn in the order of a hash of
    role and text, so that repeated ones are neighbours. A null role or text counts as one space. Null conversation ids are one
    conversation. A line's first fault counts: blank (white space only), duplicate (role and text seen
    earlier), truncated (its last other character is none of . ! ?). Keeping a line costs 0, giving it the role of a user
    or assistant 1, deleting it 2, which blank and duplicate lines must be; a truncated line that stays costs 5 more, an
    inserted empty line 5. Roles are told apart by their first letter; lines of other roles are rerolled or deleted.

    conversations: conv, gaps, blank, duplicate, truncated, illegal (neighbours other than su, ua, au), cost, audit (K, R, D
    and I in order). lines: conv, place, part, edit, role, text. Other columns are not read; an empty table gives no rows.
    """
    own = [F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text")))]
    rows = rows.select(*own)
    kind = rows.schema["conv"].dataType.simpleString()
    light = _light(rows)
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "key")]
    # The salt parts lines that repeat within a turn, however many there are; they are alike.
    ranged = light.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order, F.col("salt")).drop("salt")
    placed = written(ranged.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "lines")
    firsts = placed.groupBy("key").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("known"))
    marked = placed.join(firsts, "place", "left").withColumn("first", F.coalesce("known", F.lit(False))).drop("known")
    blocks = marked.withColumn("block", F.shiftright("place", settings.piece))
    pieces = written(blocks.groupBy("block").applyInArrow(_summarise, f"conv {kind}, piece long, codes binary, keys binary, {_SUMS}"), "pieces")
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    # Sums only: one row for each piece, however long it is.
    ordered = pieces.drop("codes", "keys").repartition("conv").sortWithinPartitions("conv", "piece")
    crossed = ordered.mapInArrow(_cross, f"piece long, before int, after int, final boolean, {counts}")
    work = pieces.select("conv", "piece", "codes", "keys").join(crossed, "piece")
    line = "array<struct<place: long, part: int, edit: string, role: string, key: binary>>"
    edited = written(work.mapInArrow(_edit, f"conv {kind}, piece long, audit string, lines {line}, {counts}"), "edits")
    whole = F.array_join(F.sort_array(F.collect_list(F.struct("piece", "audit")))["audit"], "")
    conversations = edited.groupBy("conv").agg(*(F.max(c).alias(c) for c in _COUNTS), whole.alias("audit"))
    lines = edited.select("conv", F.inline("lines"))
    # One line of each key stays at most, so both sides have unique keys.
    texts = rows.withColumn("key", _key()).groupBy("key").agg(F.min(F.struct("role", "text")).alias("own"))
    stay = lines.filter("key is not null").join(texts, "key")
    stay = stay.select("conv", "place", "part", "edit", F.coalesce("role", "own.role").alias("role"), "own.text")
    new = lines.filter("key is null").select("conv", "place", "part", "edit", "role", F.lit("").alias("text"))
    return Repaired(conversations.withColumnRenamed("conv", conv), stay.unionByName(new).withColumnRenamed("conv", conv))


def digests(lines: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, repaired_sha256): the hash of each conversation's lines as role:text, joined by line breaks.

    Such a hash is made in the order of the lines, so a conversation's lines pass through one task, which holds
    none of them.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, hashes = [], []
        for batch in batches:
            kind = batch.column("conv").type
            done: list[tuple] = []
            for name, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
                line = f"{role}:{text}".encode()
                if names and names[0] == name:
                    hashes[0].update(b"\n" + line)
                    continue
                done += [(n, h.hexdigest()) for n, h in zip(names, hashes)]
                names, hashes = [name], [hashlib.sha256(line)]
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], kind), pa.array([h for _, h in done])], ["conv", "sha"])
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, kind), pa.array([hashes[0].hexdigest()])], ["conv", "sha"])

    rows = lines.select(F.col(conv).alias("conv"), "place", "part", "role", "text")
    kind = rows.schema["conv"].dataType.simpleString()
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "place", "part").select("conv", "role", "text")
    return ordered.mapInArrow(digest, f"conv {kind}, sha string").select(F.col("conv").alias(conv), F.col("sha").alias("repaired_sha256"))
