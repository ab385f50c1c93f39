import hashlib
import itertools
import random
import re
import zlib

import pytest

from quarterdeck.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string, audit string, cost string"
LEGAL = re.compile("(s?(ua)+)?")


def plain_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_audit(rows):
    """Least (cost, audit, lines) over all edits, by exhaustive relaxation over (row, initials state)."""
    moves = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "", ())}

    def relax(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def inserts(table):
        for _ in range(4):
            for state, (cost, audit, lines) in list(table.items()):
                for initial, name in (("u", "user"), ("a", "assistant")):
                    if initial in moves[state]:
                        relax(table, moves[state][initial], (cost + 3, audit + "I", (*lines, f"{name}:")))

    for role, text, fault in rows:
        # Every path is kept with its audit, so equal costs are told apart as texts.
        inserts(best)
        after: dict = {}
        for state, (cost, audit, lines) in best.items():
            relax(after, state, (cost + 4, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] in moves[state] and role[:1]:
                    relax(after, moves[state][role[0]], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                for initial, name in (("u", "user"), ("a", "assistant")):
                    if initial in moves[state]:
                        relax(after, moves[state][initial], (cost + 3 + more, audit + "R", (*lines, f"{name}:{text}")))
        best = after
    inserts(best)
    return min(best[s] for s in ("", "a") if s in best)


def plain_repair(rows):
    """Result of one conversation from (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, judged = set(), []
    for _, role, text in rows:
        solid = text.strip(" \t\n\v\f\r")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
        seen.add((role, text))
        judged.append((role, text, fault))
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, lines = plain_audit(judged)
    faults = [f for _, _, f in judged]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
        faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def plain(rows):
    found = {conv_id: [] for conv_id, *_ in rows}
    for conv_id, *turn in plain_damage(rows):
        found[conv_id].append(tuple(turn))
    return {conv_id: plain_repair(turns) for conv_id, turns in found.items()}


def result(df):
    rows = df.collect()
    got = {r["conv_id"]: tuple(r[c] for c in conv._NAMES) for r in rows}
    assert len(got) == len(rows)
    return got


def made_up(count, seed, longest=14):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "unknown", " "]
    texts = ["Yes.", "No", " \n", None, "Why? ", "", "Ünd .", "x" * 200 + "!", "x" * 200 + "?", "a\x0bb.\x0c"]
    rows = []
    for c in range(count):
        for k in range(rng.randint(1, longest)):
            turn = None if rng.random() < 0.1 else k + rng.choice([0, 0, 0, 5, -2])
            role = roles[1 + k % 2] if rng.random() < 0.6 else rng.choice(roles)
            text = f"Turn {k}{rng.choice('.!? ,')}" if rng.random() < 0.6 else rng.choice(texts)
            rows.append((None if c == 3 else c, turn, role, text))
    return rows + rows[:20]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "own", "own") for r in rows], SCHEMA).repartition(7)


def test_audits_against_all_edit_sequences():
    """The brute version itself against every audit of few edits."""
    for codes in itertools.product([("user", "a."), ("assistant", "b"), ("system", "c."), ("tool", ""), ("user", "")], repeat=2):
        rows = [(k, role, text) for k, (role, text) in enumerate(codes)]
        found, lines = conv.repaired(rows)
        assert (found["cost"], found["audit"]) == plain_repair(rows)[5:7]
        assert LEGAL.fullmatch("".join(x[0] for x in lines))


def test_hirschberg_against_plain_relaxation():
    rng = random.Random(5)
    for _ in range(1500):
        rows = [
            (k, rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["ok.", "cut", "", f"own {k}.", f"own {k}"]))
            for k in range(rng.randint(0, 12))
        ]
        found, lines = conv.repaired(rows)
        want = plain_repair(rows)
        assert tuple(found.values()) == want, rows
        assert LEGAL.fullmatch("".join(x[0] for x in lines))


def test_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in docs.select("conv_id", "turn", "role", "text").collect()]
    assert result(conv.repair_conversations(docs)) == plain(rows)


@pytest.mark.parametrize("sizes", [{}, {"long_rows": 0, "chunk": 3, "fan": 2}, {"long_bytes": 300, "chunk": 2, "fan": 3}])
def test_made_up_conversations(spark, sizes):
    rows = made_up(60, 1)
    assert result(conv.repair_conversations(frame(spark, rows), **sizes)) == plain(rows)


def test_one_hot_conversation(spark):
    rows = [(7, k // 2, ["user", "assistant", "system"][k % 3 % 2 + k % 5 // 4], f"{k % 40}{'.' if k % 3 else ''}") for k in range(700)]
    rows += [(7, 3, "user", "same.")] * 300 + [(k, k % 3, "user", "Hi.") for k in range(60)]
    got = result(conv.repair_conversations(frame(spark, rows), long_rows=100, chunk=16, fan=4))
    assert got == plain(rows)


def test_empty_and_wholly_dropped(spark):
    assert conv.repair_conversations(frame(spark, [])).count() == 0
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    got = result(conv.repair_conversations(frame(spark, [(dropped, 0, "user", "Hi."), (None, None, None, None)])))
    assert got[dropped] == conv.NOTHING and set(got) == {dropped, None}


def test_turns_at_the_ends_of_a_long(spark):
    rows = [(1, -(2**63), "user", "Hi."), (1, 2**63 - 1, "assistant", "Hi."), (1, None, "user", "Hm.")]
    for sizes in ({}, {"long_rows": 0}):
        got = result(conv.repair_conversations(frame(spark, rows), **sizes))
        assert got[1][0] in (0, 2**63 - 1)
