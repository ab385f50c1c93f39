"""Repair of conversation structure by cheapest edits, in linear space.

A conversation must read `(s?(ua)+)?` in the initials of its roles. Four states say what may follow: nothing read yet, a
system turn read, a user turn read, an assistant turn read. Rows are solved by Hirschberg's divide and conquer: a forward
cost vector over the states and a backward one meet in the middle, of the cheapest crossings the one with the least audit
is taken, and both halves recurse.

A conversation of up to LONG rows and bytes is solved where its rows meet. A longer one is spread: its rows are numbered in
one global order and cut into chunks, whose cost tables between states combine level by level to cost vectors at the chunk
borders; every chunk is then repaired by itself. Only its digest, which has no parallel form, streams through one task,
and that over prepared blocks of lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import landed, running, shuffle_partitions

LONG_ROWS, LONG_BYTES = 1024, 2**24
CHUNK = 256
BLOCK_BYTES = 2**22
#: Rows whose crc32 leaves these remainders are dropped, emptied, stripped of ends, repeated, made a user's. Fixed values.
DAMAGES = 20
BLANKS = " \t\n\v\f\r"
ENDS = ".!?"
_BIG, _MOST = 2**60, 2**63 - 1

# --- the four states ------------------------------------------------------------------------------------------------------

START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that Rerole and Insert give in a state, and the state after it.
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = ("user", "user", "assistant", "user")
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3
#: Inserts that end a conversation in a state, and their costs.
TAIL = ("", "II", "I", "")
ENDING = tuple(COST[INSERT] * len(t) for t in TAIL)
#: A row's code: its role's initial (x for any other), in upper case if it must go, as a digit if it is truncated.
CODES = "suax" + "SUAX" + "1234"
#: Rows of one turn and role are ordered by so many characters of the text, then by its hash.
PREFIX = 64


def code_of(initial: str, fault: str) -> str:
    """One character for what an edit's cost depends on: the role's initial, and whether the row must go or is truncated."""
    kind = "sua".find(initial) if initial else -1
    return CODES[(3 if kind < 0 else kind) + {"blank": 4, "duplicate": 4, "truncated": 8}.get(fault, 0)]


def _kept(state: int, kind: int) -> int | None:
    """The state after a row of this kind (s, u, a, other) is kept, if it may stand there."""
    return {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}.get((state, kind))


def _edits(state: int, code: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state after) of the edits of one row in a state, by ASCII order of the edits."""
    found = [(DELETE, COST[DELETE], state)]
    if not 4 <= code < 8:
        more = TRUNCATED * (code >= 8)
        if (after := _kept(state, code % 4)) is not None:
            found.append((KEEP, COST[KEEP] + more, after))
        found.append((REROLE, COST[REROLE] + more, _NEXT[state]))
    return found


def _step_costs(code: int) -> list[list[int]]:
    """Least cost from each state to each over one row, inserts before it included."""
    table = [[_BIG] * 4 for _ in range(4)]
    for first in range(4):
        state = first
        for inserts in range(4):  # more would come round again
            for _, cost, after in _edits(state, code):
                table[first][after] = min(table[first][after], cost + inserts * COST[INSERT])
            state = _NEXT[state]
    return table


EDITS = {c: [_edits(state, k) for state in range(4)] for k, c in enumerate(CODES)}
STEPS = {c: _step_costs(k) for k, c in enumerate(CODES)}


def forward(costs: list[int], codes: str) -> list[int]:
    """Costs of the states before the rows to costs of the states after them."""
    for c in codes:
        step = STEPS[c]
        costs = [min(costs[p] + step[p][q] for p in range(4)) for q in range(4)]
    return costs


def backward(costs: Iterable[int], codes: str) -> list[int]:
    """Costs to the end from the states after the rows to those from the states before them."""
    costs = list(costs)
    for c in reversed(codes):
        costs = [min(s + t for s, t in zip(row, costs, strict=True)) for row in STEPS[c]]
    return costs


def edits_of_row(code: str, state: int, to_end: list[int]) -> tuple[str, int]:
    """The ASCII-least cheapest edits of one row, inserts before it included, given the costs to the end after it."""
    edits = ""
    rest = backward(to_end, code)
    for _ in range(4):
        for edit, cost, after in [*EDITS[code][state][:1], (INSERT, COST[INSERT], -1), *EDITS[code][state][1:]]:
            if edit == INSERT and cost + rest[_NEXT[state]] == rest[state]:
                edits, state = edits + INSERT, _NEXT[state]
                break
            if edit != INSERT and cost + to_end[after] == rest[state]:
                return edits + edit, after
    raise AssertionError((code, state, to_end))


def repair(codes: str, state: int, to_end: list[int]) -> tuple[list[str], int]:
    """Edits of each row, their whole the ASCII-least of the cheapest, and the state after them.

    `to_end` holds the cost to the end from each state after the rows. The forward costs of the first half and the backward
    costs of the second meet between them. The first half is asked for the least audit that ends in one of the cheapest
    crossings; the one it ends in is the crossing of the second half.
    """
    if len(codes) == 1:
        edits, state = edits_of_row(codes, state, to_end)
        return [edits], state
    if not codes:
        return [], state
    middle = len(codes) // 2
    reached = forward([0 if q == state else _BIG for q in range(4)], codes[:middle])
    onward = backward(to_end, codes[middle:])
    best = min(a + b for a, b in zip(reached, onward, strict=True))
    crossings = [b if a + b == best else _BIG for a, b in zip(reached, onward, strict=True)]
    first, state = repair(codes[:middle], state, crossings)
    second, state = repair(codes[middle:], state, to_end)
    return first + second, state


def edit_cost(codes: str, edits: list[str]) -> int:
    """Cost of the edits of all rows; undeleted truncated rows add theirs."""
    truncated = sum(c in CODES[8:] and not e.endswith(DELETE) for c, e in zip(codes, edits, strict=True))
    return sum(COST[x] for e in edits for x in e) + TRUNCATED * truncated


def lines_of(role: str, text: str, edits: str, state: int) -> tuple[list[str], int]:
    """The repaired `role:text` lines that a row leaves, and the state after it."""
    lines = []
    for edit in edits:
        if edit == INSERT:
            lines.append(f"{_ROLE[state]}:")
            state = _NEXT[state]
        elif edit == REROLE:
            lines.append(f"{_ROLE[state]}:{text}")
            state = _NEXT[state]
        elif edit == KEEP:
            lines.append(f"{role}:{text}")
            state = _kept(state, "sua".find(role[0]))
    return lines, state


def illegal_pairs(codes: str) -> int:
    """Neighbours whose initials are not su, ua or au."""
    kinds = [CODES.index(c) % 4 for c in codes]
    return sum(pair not in ((0, 1), (1, 2), (2, 1)) for pair in zip(kinds, kinds[1:]))


# --- rows -----------------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy after damage: by the crc32 of `conv_id:turn`, where a null counts as one space."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % DAMAGES
    rows = conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
_NAMES = [f.split()[0] for f in RESULT.split(", ")]


def _hash(text: str) -> int:
    """Spark's xxhash64 of a text."""
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), 42)
    return value - 2**64 if value >> 63 else value


def fault_of(role: str, text: str, seen: set) -> str:
    solid = text.rstrip(BLANKS)
    if not solid:
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    return "" if solid[-1] in ENDS else "truncated"


def repaired(turns: Iterable[tuple[int | None, str, str]]) -> tuple[dict, list[str]]:
    """Result and repaired lines of one conversation from its (turn, role, text) after damage."""
    ordered = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2][:PREFIX], _hash(t[2])))
    seen: set = set()
    faults, numbers = [], {t[0] for t in ordered if t[0] is not None}
    for _, role, text in ordered:
        faults.append(fault_of(role, text, seen))
        seen.add((role, text))
    codes = "".join(code_of(role[:1], fault) for (_, role, _), fault in zip(ordered, faults, strict=True))
    edits, state = repair(codes, START, list(ENDING))
    lines, at = [], START
    for (_, role, text), edit in zip(ordered, edits, strict=True):
        more, at = lines_of(role, text, edit, at)
        lines += more
    for _ in TAIL[state]:
        lines.append(f"{_ROLE[at]}:")
        at = _NEXT[at]
    result = {
        "gaps": min(max(numbers) - min(numbers) + 1 - len(numbers), _MOST) if numbers else 0,
        "blank": faults.count("blank"),
        "duplicate": faults.count("duplicate"),
        "truncated": faults.count("truncated"),
        "illegal": illegal_pairs(codes),
        "cost": edit_cost(codes, edits) + ENDING[state],
        "audit": "".join(edits) + TAIL[state],
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode("utf-8", "replace")).hexdigest(),
    }
    return result, lines


def _short(rows: DataFrame, conv_type: str) -> DataFrame:
    """Conversations of bounded size: rows meet by conv_id, and a task holds one conversation at a time."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turns, ids, results = None, [], [], []

        def flush() -> None:
            if turns:
                ids.append(conv)
                results.append(repaired(turns)[0])
                turns.clear()

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array(ids, id_type)] + [pa.array([r[c] for r in results]) for c in _NAMES]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", *_NAMES])

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for key, *turn in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True):
                if turns and key != conv:
                    flush()
                conv = key
                turns.append(tuple(turn))
            if results:
                yield batch_of()
                ids, results = [], []
        flush()
        if results:
            yield batch_of()

    met = rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id")
    return met.mapInArrow(solve, f"conv_id {conv_type}, {RESULT}")


# --- long conversations ---------------------------------------------------------------------------------------------------


def _minplus(a: list[int], b: list[int]) -> list[int]:
    """Product of two 4 x 4 cost tables, rows first."""
    return [min(min(a[4 * p + m] + b[4 * m + q], _BIG) for m in range(4)) for p in range(4) for q in range(4)]


_NODE = "conv long, node long"


def _chunk_tables(chunks: DataFrame) -> DataFrame:
    def tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            starts = [[0 if p == q else _BIG for p in range(4)] for q in range(4)]
            batch["costs"] = [[min(c, _BIG) for s in starts for c in forward(s, codes)] for codes in batch["codes"]]
            yield batch[["conv", "node", "costs"]]

    return chunks.select("conv", "node", "codes").mapInPandas(tables, f"{_NODE}, costs array<long>")


def _chunk_moves(chunks: DataFrame) -> DataFrame:
    """The state after a chunk from each state before it, along the least audits."""

    def moves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ends = zip(batch["codes"], batch["to_end"], strict=True)
            batch["moves"] = [[repair(codes, q, [int(t) for t in to_end])[1] for q in range(4)] for codes, to_end in ends]
            yield batch[["conv", "node", "moves"]]

    return chunks.select("conv", "node", "codes", "to_end").mapInPandas(moves, f"{_NODE}, moves array<int>")


def _levels(leaves: DataFrame, column: str, join, schema: str, fan: int) -> list[DataFrame]:
    """Leaves and the levels above them: `fan` neighbours of a level are joined to one node, up to one node a conversation."""
    levels = [leaves]
    while (levels[-1].agg(F.max("node")).first()[0] or 0) > 0:

        def up(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            total = None
            for value in group.sort_values("node")[column]:
                total = list(value) if total is None else join(total, list(value))
            return pd.DataFrame({"conv": [key[0]], "node": [key[1]], column: [total]})

        grouped = levels[-1].withColumn("parent", F.expr(f"node div {fan}")).groupBy("conv", "parent")
        levels.append(landed(grouped.applyInPandas(up, f"{_NODE}, {column} {schema}"), f"repair-{column}"))
    return levels


def _descend(levels: list[DataFrame], column: str, name: str, top: Column, schema: str, walk, fan: int) -> DataFrame:
    """Values of the leaves: the root's value is `top`; `walk` hands a node's value down to its children."""
    values = levels[-1].select("conv", "node", top.alias(name))
    for below in reversed(levels[:-1]):

        def down(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("node")
            found = walk(group[name].iloc[0], [list(v) for v in group[column]])
            return pd.DataFrame({"conv": group["conv"].to_numpy(), "node": group["node"].to_numpy(), name: found})

        parents = values.withColumnRenamed("node", "parent")
        children = below.withColumn("parent", F.expr(f"node div {fan}")).join(parents, ["conv", "parent"])
        values = landed(children.groupBy("conv", "parent").applyInPandas(down, f"{_NODE}, {name} {schema}"), f"repair-{name}")
    return values


def _costs_down(to_end, tables: list[list[int]]) -> list[list[int]]:
    """Costs to the end after each child from those after the last."""
    found, costs = [], [int(c) for c in to_end]
    for table in reversed(tables):
        found.append(costs)
        costs = [min(min(table[4 * p + q] + costs[q], _BIG) for q in range(4)) for p in range(4)]
    return found[::-1]


def _states_down(state, moves: list[list[int]]) -> list[int]:
    found = []
    for move in moves:
        found.append(int(state))
        state = move[int(state)]
    return found


def _solved(chunks: DataFrame, fan: int) -> DataFrame:
    """conv, node, edits (a list with one entry a row), state (before the chunk), last state, cost of the chunk."""
    tables = _levels(landed(_chunk_tables(chunks), "repair-costs"), "costs", _minplus, "array<long>", fan)
    ending = F.array(*(F.lit(c).cast("long") for c in ENDING))
    to_end = _descend(tables, "costs", "to_end", ending, "array<long>", _costs_down, fan)
    known = landed(chunks.join(to_end, ["conv", "node"]), "repair-known")
    moves = _levels(landed(_chunk_moves(known), "repair-moves"), "moves", lambda a, b: [b[x] for x in a], "array<int>", fan)
    states = _descend(moves, "moves", "state", F.lit(START), "int", _states_down, fan)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[str, list] = {c: [] for c in ("edits", "states", "after", "cost", "tail")}
            for codes, to_end, state, node, last in zip(*(batch[c] for c in ("codes", "to_end", "state", "node", "last")), strict=True):
                edits, after = repair(codes, int(state), [int(t) for t in to_end])
                at = [int(state)]
                for code, edit in zip(codes, edits, strict=True):
                    at.append(_after(at[-1], code, edit))
                tail = TAIL[after] if node == last else ""
                for c, v in zip(found, (edits, at[:-1], after, edit_cost(codes, edits) + COST[INSERT] * len(tail), tail), strict=True):
                    found[c].append(v)
            yield batch[["conv", "node"]].assign(**found)

    schema = f"{_NODE}, edits array<string>, states array<int>, after int, cost long, tail string"
    return landed(known.join(states, ["conv", "node"]).select("conv", "node", "codes", "to_end", "state", "last").mapInPandas(solve, schema), "repair-edits")


def _after(state: int, code: str, edits: str) -> int:
    for edit in edits:
        state = state if edit == DELETE else _kept(state, CODES.index(code) % 4) if edit == KEEP else _NEXT[state]
    return state


def _long(rows: DataFrame, conv_type: str, chunk: int, fan: int) -> DataFrame:
    """The same results for conversations of any length."""
    order = [
        F.col("conv_id").isNotNull(), F.col("conv_id"), F.col("turn").isNotNull(), F.col("turn"), F.col("role"),
        F.substring("text", 1, PREFIX), F.xxhash64("text"), F.rand(1),
    ]
    amounts = {"place": F.lit(1).cast("long"), "bytes": F.octet_length("text").cast("long")}
    placed = landed(running(rows.select("conv_id", "turn", "role", "text"), order, amounts, "repair-rows"), "repair-placed")
    firsts = placed.groupBy("conv_id").agg(
        F.min("place").alias("conv"), F.min("bytes").alias("conv_bytes"), F.count("*").alias("rows"),
        F.min("turn").alias("least"), F.max("turn").alias("most"), F.countDistinct("turn").alias("turns"),
    )
    firsts = landed(firsts, "repair-firsts")
    # Of equal role and text the first place is no duplicate. Digests stand for the texts, places join one to one.
    first = placed.groupBy("conv_id", "role", F.sha2("text", 256).alias("digest")).agg(F.min("place").alias("place")).select("place", F.lit(True).alias("new"))
    solid = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(solid == "", "blank").when(F.col("new").isNull(), "duplicate")
        .when(~F.right(solid, F.lit(1)).isin(*ENDS), "truncated").otherwise("")
    )
    kind = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.left("role", F.lit(1))), F.lit(0)), F.lit(4))
    kind = F.when(F.col("role") == "", 4).otherwise(kind)
    shifted = kind + F.when(fault.isin("blank", "duplicate"), 4).when(fault == "truncated", 8).otherwise(0)
    faulty = placed.join(first, "place", "left").select("place", "conv_id", fault.alias("fault"), F.substring(F.lit(CODES), shifted, F.lit(1)).alias("code"))
    own = firsts.select(F.col("conv_id").alias("_conv"), "conv", "rows")
    coded = faulty.join(own, F.col("conv_id").eqNullSafe(F.col("_conv"))).select("conv", "rows", (F.col("place") - F.col("conv")).alias("at"), "fault", "code")
    # The last row of a chunk also stands before the first of the next, for the pair they make.
    here = F.struct(F.expr(f"at div {chunk}").alias("node"), F.lit(True).alias("own"))
    beyond = F.struct(F.expr(f"at div {chunk} + 1").alias("node"), F.lit(False).alias("own"))
    edge = (F.col("at") % chunk == chunk - 1) & (F.col("at") < F.col("rows") - 1)
    dealt = coded.withColumn("to", F.explode(F.when(edge, F.array(here, beyond)).otherwise(F.array(here)))).select("*", "to.*")
    listed = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda x: x["code"]), "")
    member = F.struct("at", "code")
    tally = {f: F.count_if(F.col("own") & (F.col("fault") == f)).alias(f) for f in ("blank", "duplicate", "truncated")}
    chunks = dealt.groupBy("conv", "node", F.expr(f"(rows - 1) div {chunk}").alias("last")).agg(
        listed(F.when(F.col("own"), member)).alias("codes"), listed(member).alias("pairs"), *tally.values()
    )
    chunks = landed(chunks, "repair-chunks")
    solved = _solved(chunks.select("conv", "node", "last", "codes"), fan)

    # Every row gets its edits, and leaves its lines; they are joined to blocks of bounded rows and bytes, in order.
    row = F.posexplode(F.arrays_zip("edits", "states"))
    edits = solved.join(firsts.select("conv", "conv_bytes"), "conv").select("conv", "conv_bytes", "node", row.alias("k", "e"))
    edits = edits.withColumn("place", F.col("conv") + F.col("node") * chunk + F.col("k")).select("conv", "conv_bytes", "node", "place", "e.*")
    lined = placed.join(edits, "place").select(
        "conv", "node", "place", F.expr(f"(bytes - conv_bytes) div {BLOCK_BYTES}").alias("block"),
        _lines(F.col("role"), F.col("text"), F.col("edits"), F.col("states")).alias("lines"),
    )
    parts = F.array_join(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("place", "lines"))), lambda x: x["lines"])), "")
    blocks = lined.groupBy("conv", "node", "block").agg(parts.alias("body"))
    tails = solved.filter("tail <> ''").select(
        "conv", "node", F.lit(_BIG).alias("block"), _lines(F.lit(""), F.lit(""), F.col("tail"), F.col("after")).alias("lines")
    ).select("conv", "node", "block", F.array_join("lines", "").alias("body"))
    audits = solved.select("conv", "node", F.lit(-1).cast("long").alias("block"), F.concat(F.array_join("edits", ""), "tail").alias("body"))
    pieces = blocks.unionByName(tails).unionByName(audits)
    digests = (
        pieces.repartition(shuffle_partitions(rows.sparkSession), "conv").sortWithinPartitions("conv", "node", "block")
        .mapInPandas(_digest, "conv long, audit string, repaired_sha256 string")
    )

    counted = chunks.join(solved.select("conv", "node", "cost"), ["conv", "node"]).groupBy("conv").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "cost")), F.sum(_illegal(F.col("pairs"))).alias("illegal")
    )
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    gaps = F.least(wide("most") - wide("least") + 1 - wide("turns"), F.lit(_MOST)).cast("long")
    return firsts.withColumn("gaps", F.coalesce(gaps, F.lit(0))).join(counted, "conv").join(digests, "conv").select("conv_id", *_NAMES)


def _illegal(codes: Column) -> Column:
    kinds = F.translate(codes, CODES[4:], CODES[:4] * 2)
    return F.regexp_count(kinds, F.lit("(?=..)(?!su|ua|au)")).cast("long")


def _lines(role: Column, text: Column, edits: Column, state: Column) -> Column:
    """The lines that a row leaves, each with its end: inserts stand before the row's own edit."""
    given = lambda q: F.element_at(F.array(*map(F.lit, _ROLE)), q + 1)
    following = lambda q: F.element_at(F.array(*map(F.lit, _NEXT)), q + 1)
    start = F.struct(F.array().cast("array<string>").alias("lines"), state.cast("int").alias("state"))

    def step(so_far: Column, edit: Column) -> Column:
        line = (
            F.when(edit == INSERT, F.array(F.concat(given(so_far["state"]), F.lit(":\n"))))
            .when(edit == REROLE, F.array(F.concat(given(so_far["state"]), F.lit(":"), text, F.lit("\n"))))
            .when(edit == KEEP, F.array(F.concat(role, F.lit(":"), text, F.lit("\n"))))
            .otherwise(F.array().cast("array<string>"))
        )
        return F.struct(F.concat(so_far["lines"], line).alias("lines"), following(so_far["state"]).alias("state"))

    return F.aggregate(F.filter(F.split(edits, ""), lambda e: e != ""), start, step)["lines"]


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by conversation, chunk and block; a chunk's audit comes first. The last line's end is left out."""
    conv, audit, digest, held = None, [], None, b""

    def finished() -> pd.DataFrame:
        digest.update(held[:-1])
        return pd.DataFrame({"conv": [conv], "audit": ["".join(audit)], "repaired_sha256": [digest.hexdigest()]})

    for batch in batches:
        for key, block, body in zip(batch["conv"], batch["block"], batch["body"], strict=True):
            if key != conv:
                if conv is not None:
                    yield finished()
                conv, audit, digest, held = key, [], hashlib.sha256(), b""
            if block < 0:
                audit.append(body)
            elif body:
                digest.update(held)
                held = body.encode("utf-8", "replace")
    if conv is not None:
        yield finished()


# --- whole tables ---------------------------------------------------------------------------------------------------------


def repair_conversations(
    conversations: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES, chunk: int = CHUNK, fan: int = CHUNK
) -> DataFrame:
    """conv_id with gaps, faults, cost, audit and digest of the repaired conversation, for every conv_id of the table.

    A null conv_id is a conversation of its own. Rows of one turn are ordered by role
    and text (its first characters, then a hash). A null turn comes first and
    takes no part in the gaps; null roles and texts are one space. Repeated rows are rows like any other, so duplicates. An
    empty table gives no rows; columns beside conv_id, turn, role and text are not read.
    """
    read = conversations.select("conv_id", "turn", "role", "text")
    conv_type = read.schema["conv_id"].dataType.simpleString()
    sizes = read.groupBy("conv_id").agg(
        F.count("*").alias("n"), F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16).alias("bytes")
    )
    is_long = (F.col("n") > long_rows) | (F.col("bytes") > long_bytes)
    marked = landed(sizes.select("conv_id", is_long.alias("long")), "repair-sizes")
    rows = damaged(read)
    long_ids = marked.filter("long").select(F.col("conv_id").alias("_conv"))
    if long_ids.isEmpty():
        solved = _short(rows, conv_type)
    else:
        fits = rows["conv_id"].eqNullSafe(F.col("_conv"))
        solved = _short(rows.join(long_ids, fits, "left_anti"), conv_type).unionByName(
            _long(rows.join(long_ids, fits, "left_semi"), conv_type, chunk, fan)
        )
    found = solved.withColumnRenamed("conv_id", "_conv")
    defaults = {c: F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in zip(_NAMES, NOTHING, strict=True)}
    return marked.join(found, marked["conv_id"].eqNullSafe(found["_conv"]), "left").select("conv_id", *defaults.values())
