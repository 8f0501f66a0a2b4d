"""Repair of conversations against all edits there are, and against DuckDB on odd tables."""

import hashlib
import itertools
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import conversation_repair as cr
from ledgerloom.llm.conversation_repair import Settings
from tests.comparison import compare

GRAMMAR = re.compile("(s?(ua)+)?")


def by_enumeration(codes):
    """The least (cost, audit) of all edits with at most two insertions in a row."""
    best = None
    inserts = [[""], ["u", "a"], ["uu", "ua", "au", "aa"]]
    gaps = [(k, roles) for k in range(3) for roles in inserts[k]]
    choices = []
    for code in codes:
        initial, fault = divmod(code, 3)
        extra = 5 if fault == cr.CUT else 0
        own = [(2, "D", "")]
        if fault != cr.GONE:
            own += [(extra, "K", "sua?"[initial]), (1 + extra, "R", "u"), (1 + extra, "R", "a")]
        choices.append([(5 * k + cost, "I" * k + symbol, added + role) for k, added in gaps for cost, symbol, role in own])
    for row in itertools.product(*choices, [(5 * k, "I" * k, added) for k, added in gaps]):
        if GRAMMAR.fullmatch("".join(r for _, _, r in row)):
            found = sum(c for c, _, _ in row), "".join(a for _, a, _ in row)
            best = found if best is None else min(best, found)
    return best


def by_strings(codes):
    """The least (cost, audit), with a whole audit for each state."""
    state = {0: (0, "")}
    for code in codes:
        found = {}
        for p, (cost, audit) in state.items():
            for q, (more, edits) in cr.moves(code, p).items():
                found[q] = min((cost + more, audit + edits), found.get(q, (10**9, "")))
        state = found
    return min((c + 5 * len(cr._TAIL[s]), a + cr._TAIL[s]) for s, (c, a) in state.items())


def repaired(codes, cut):
    pieces = [codes[k : k + cut] for k in range(0, len(codes), cut)]
    states, cost = cr.crossings([cr.sums(p) for p in pieces])
    audit = "".join("".join(cr.audit_between(p, a, b)) for p, a, b in zip(pieces, states, states[1:]))
    return cost, audit + cr._TAIL[states[-1]]


def test_audits_are_the_least_of_all():
    made = random.Random(1)
    for n in (1, 2, 3):
        for _ in range(40 if n < 3 else 12):
            codes = bytes(made.randrange(12) for _ in range(n))
            assert repaired(codes, 100) == by_strings(codes) == by_enumeration(codes), codes


@pytest.mark.parametrize("kind", [range(12), [0, 3, 6], [3, 4, 5, 6], [2, 5, 8, 11], [9, 10, 3], [0], [6], [7, 4]])
def test_pieces_of_any_size_agree(kind):
    made = random.Random(2)
    for n in (1, 2, 5, 17, 64, 200):
        codes = bytes(made.choice(list(kind)) for _ in range(n))
        expected = by_strings(codes)
        for cut in (1, 2, 7, 50, 1000):
            assert repaired(codes, cut) == expected
    # Far more lines than there are cost vectors.
    assert len(cr._ahead.vectors) < 2000 and len(cr._behind.vectors) < 2000


def odd_rows():
    made = random.Random(3)
    texts = ["Fine.", "Is it?", "cut off", "", " \t\n", "Fine.", "\x0b\x0c\r", "nbsp ", "é!", "x" * 5000, None, "a\nb.", "Done. "]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "User", "", None, "sys", "u"]
    rows = []
    for conv in [*range(60), None, 10**15]:
        for turn in range(made.choice([1, 2, 4, 9, 40])):
            number = made.choice([turn, turn, turn, turn + 3, None])
            rows += [(conv, number, made.choice(roles), made.choice(texts))] * made.choice([1, 1, 1, 2, 5])
    rows += [(500, k, ["user", "assistant"][k % 2], f"Line {k}.") for k in range(700)]
    return rows + [(501, 0, "user", "Same.")] * 300


def table(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return frame.withColumns({c: F.lit("clash") for c in ("conv", "key", "code", "place", "piece", "first", "block")})


def test_odd_tables_against_sql(spark, tmp_path):
    pq.write_table(table(spark, odd_rows()).toArrow(), tmp_path / "conversations.parquet")
    assert compare(spark, str(tmp_path), "op11_conversation_repair") is None


def test_small_pieces_and_lines(spark):
    rows = table(spark, odd_rows()).repartition(3)
    wide, narrow = cr.repair(rows), cr.repair(rows, settings=Settings(piece=2))
    reports = sorted(map(repr, wide.conversations.collect()))
    assert reports == sorted(map(repr, narrow.conversations.collect()))
    left = {}
    for r in narrow.lines.orderBy("place", "part").collect():
        left.setdefault(r.conv_id, []).append(r)
    hashes = {r.conv_id: r.repaired_sha256 for r in cr.digests(wide.lines).collect()}
    assert set(hashes) == set(left)
    for conv, lines in left.items():
        assert GRAMMAR.fullmatch("".join(r.role[:1] for r in lines))
        assert hashes[conv] == hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in lines).encode()).hexdigest()
        assert all((r.text == "") == (r.edit == "I") for r in lines)


def test_empty_tables(spark, tmp_path):
    none = table(spark, odd_rows()[:1]).limit(0)
    assert cr.repair(none).conversations.collect() == [] and cr.digests(cr.repair(none).lines).collect() == []


def test_a_conversation_of_which_nothing_is_left(spark):
    rows = spark.createDataFrame([("a", 0, "user", "Hi."), ("b", 1, "tool", None), ("c", None, "assistant", "So.")], "conv_id string, turn int, role string, text string")
    found = {r.conv_id: (r.cost, r.audit, r.gaps) for r in cr.repair(rows).conversations.collect()}
    assert found == {"a": (2, "D", 0), "b": (2, "D", 0), "c": (2, "D", 0)}
    assert cr.repair(rows).lines.collect() == []
