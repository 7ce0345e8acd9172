"""Cheapest repair of a conversation's structure, rebuilt in linear space after Hirschberg.

A repaired conversation's role initials read ``(s?(ua)+)?``: four states (nothing yet, after
system, after user, after assistant). Edits, in the order of their rows: Keep, Rerole to
user or assistant, Delete, Insert an empty user or assistant turn. Blank and duplicate rows
must be deleted; a truncated row that stays costs one more. From a state an edit leads to one
state, so the string of the edits' initials (the audit) determines the repair, and audits of
different states are never prefixes of each other.

* **Vectors.** A step over a row turns four (cost, place) pairs into four: the cheapest edits
  to each state and the place of their audits in ASCII order among the four.
* **Divide.** Over a stretch of rows from a known state to a known state, the forward vector of
  the first half and the backward vector of the second meet in the middle. Of the states on a
  cheapest path the one whose audit so far is least is the crossing; both halves follow alike.
  Memory is two vectors, whatever the length.
* **Conquer on a cluster.** All rows have a rank in (conversation, turn) order, found by range
  partitioning, and are dealt to blocks of ``BLOCK`` ranks, so that a conversation of any length
  is spread over tasks. The first and last conversation of a block send the vectors from each
  of the four states; per conversation these few numbers a block are folded, once
  forwards and once backwards, into the state at every block's edge. Then the blocks divide.

Costs: Keep 0, Rerole 2, Delete 3, Insert 2, truncated 1. Texts take no part in this.
"""

from __future__ import annotations

import hashlib
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derivspark.operators.ids import dense_ids

from .common import SPACE_CHARS, ship, stage

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
AFTER = (USER, USER, ASSISTANT, USER)  # state after an inserted or renamed turn
ROLE = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
OK, BLANK, DUPLICATE, CUT = range(4)  # faults
BLOCK = 1024
FAR = 1 << 60


def keeps(initial: str, state: int) -> int | None:
    """State after keeping a row of this role initial, if the grammar allows it."""
    if initial == "s":
        return SYSTEM if state == START else None
    after = AFTER[state]
    return after if initial == {USER: "u", ASSISTANT: "a"}[after] else None


@cache
def moves(initial: str, fault: int, end: bool) -> tuple[tuple[int, int, int, str], ...]:
    """(from, to, cost, audit) of the ways over one row: up to two inserted turns, then the row's
    own edit. The row that ends a conversation has no edit and lets complete ones pass."""
    best = {}
    for state in STATES:
        at = state
        for inserted in range(3):
            steps = []
            if end:
                steps = [(at, 0, "")] if at in (START, ASSISTANT) else []
            else:
                steps.append((at, DELETE, "D"))
                if fault not in (BLANK, DUPLICATE):
                    extra = TRUNCATED if fault == CUT else 0
                    steps.append((AFTER[at], REROLE + extra, "R"))
                    if keeps(initial, at) is not None:
                        steps.append((keeps(initial, at), extra, "K"))
            for to, cost, edit in steps:
                way = (cost + INSERT * inserted, "I" * inserted + edit)
                best[state, to] = min(best.get((state, to), way), way)
            at = AFTER[at]
    return tuple((a, b, cost, audit) for (a, b), (cost, audit) in best.items())


def forward(rows: list, vector: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(cost, place of the least cheapest audit) of each state after the rows."""
    for row in rows:
        ways = [None] * 4
        for a, b, cost, audit in moves(*row):
            if vector[a][0] < FAR:
                way = (vector[a][0] + cost, vector[a][1], audit)
                if ways[b] is None or way < ways[b]:
                    ways[b] = way
        order = sorted((w[1:], b) for b, w in enumerate(ways) if w)
        place = {b: i for i, (_, b) in enumerate(order)}
        vector = [(w[0], place[b]) if w else (FAR, 4) for b, w in enumerate(ways)]
    return vector


def backward(rows: list, costs: list[int]) -> list[int]:
    """Cost from each state before the rows, given the costs from each state after them."""
    for row in reversed(rows):
        out = [FAR] * 4
        for a, b, cost, _ in moves(*row):
            out[a] = min(out[a], cost + costs[b])
        costs = out
    return costs


def unit(state: int) -> list[tuple[int, int]]:
    return [(0, 0) if s == state else (FAR, 4) for s in STATES]


def repair(rows: list, a: int, b: int) -> list[str]:
    """The audit of each row (inserts before it, then its edit) on the cheapest way from state
    ``a`` to state ``b``, the least in ASCII order among the cheapest. ``rows`` hold
    (role initial, fault, is it the end)."""
    out, todo = [""] * len(rows), [(0, len(rows), a, b)]
    while todo:
        lo, hi, a, b = todo.pop()
        if hi - lo == 1:
            out[lo] = next(audit for x, y, _, audit in moves(*rows[lo]) if (x, y) == (a, b))
        elif hi > lo:
            mid = (lo + hi) // 2
            left = forward(rows[lo:mid], unit(a))
            right = backward(rows[mid:hi], [0 if s == b else FAR for s in STATES])
            crossing = min(STATES, key=lambda s: (left[s][0] + right[s], left[s][1]))
            todo += [(lo, mid, a, crossing), (mid, hi, crossing, b)]
    return out


def fold(pieces: list[list[list[tuple[int, int]]]]) -> list[tuple[int, int]]:
    """(state before, state after) of each piece of one conversation; a piece gives, from each
    state before it, the vector of states after it. The last piece holds the end."""
    behind = [[0 if s in (START, ASSISTANT) else FAR for s in STATES]]
    for piece in reversed(pieces):
        behind.append([min(min(piece[a][b][0] + behind[-1][b], FAR) for b in STATES) for a in STATES])
    behind.reverse()
    out, state = [], START
    for piece, costs in zip(pieces, behind[1:]):
        # One state before: places compare the audits of this piece alone, what came before is the same.
        after = min(STATES, key=lambda b: (piece[state][b][0] + costs[b], piece[state][b][1]))
        out.append((state, after))
        state = after
    return out


def _fragments(rows: pa.Table):
    """(first row, end, conversation, does it begin inside?, does it end inside?) of the stretches
    of one conversation in a block sorted by rank."""
    conv, ends = rows["conv_id"].to_pylist(), rows["ends"].to_pylist()
    kinds = list(zip(rows["initial"].to_pylist(), rows["fault"].to_pylist(), ends))
    at = 0
    for i in range(1, len(conv) + 1):
        if i == len(conv) or conv[i] != conv[at]:
            yield at, i, conv[at], kinds[at:i], at > 0, ends[i - 1]
            at = i


def with_faults(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                originals: DataFrame | None = None) -> DataFrame:
    """The rows with ``id`` (1..n in order of conversation, turn, role, text; nulls first),
    ``fault`` (first of blank 1, duplicate 2, truncated 3; else 0), ``initial`` and ``ends``: one
    more row, without turn, ends each conversation of ``originals`` (default: ``rows``). Staged."""
    d = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                    F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    d = d.withColumn("ends", F.lit(False))
    kinds = {f.name: f.dataType for f in d.schema}
    last = (rows if originals is None else originals).select(F.col(conv).alias("conv_id")).distinct()
    last = last.select("conv_id", F.lit(None).cast(kinds["turn"]).alias("turn"), F.lit("").alias("role"),
                       F.lit("").alias("text"), F.lit(True).alias("ends"))
    d = d.unionByName(last).withColumn("digest", F.md5("text"))
    ranked = dense_ids(d, ["ends", "turn", "role", "digest"], "id", ["conv_id"], copies=True)
    ranked = ranked.withColumn("said", F.rtrim(F.col("text"), F.lit(SPACE_CHARS)))
    # Earlier rows of one role and text: the least id of each such group.
    first = ranked.filter("not ends").groupBy("conv_id", "role", "digest").agg(F.min("id").alias("id")) \
        .select("id", F.lit(True).alias("is_first"))
    fault = (F.when(F.col("ends"), F.lit(OK)).when(F.col("said") == "", F.lit(BLANK))
             .when(F.col("is_first").isNull(), F.lit(DUPLICATE))
             .when(~F.substring("said", -1, 1).isin(".", "!", "?"), F.lit(CUT)).otherwise(F.lit(OK)))
    out = ranked.join(first, "id", "left").select("id", "conv_id", "turn", "role", "text", "ends", fault.alias("fault"),
                                                  F.substring("role", 1, 1).alias("initial"))
    return stage(out, "repair-rows")


def repaired_rows(rows: DataFrame) -> DataFrame:
    """Each row of ``with_faults`` with its audit (initials of the turns inserted before it, then of
    its own edit: K, R, D; none for a row that ends a conversation) and the state before it."""
    block = F.floor((F.col("id") - 1) / BLOCK).cast("long").alias("block")
    kinds = rows.select(block, "id", "conv_id", "initial", "fault", "ends")
    conv_type = rows.schema["conv_id"].dataType.simpleString()

    def edges(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        out = []
        for at, to, conv, kind, begins, ends in _fragments(group):
            if not (begins and ends):  # the conversation may reach into other blocks
                vectors = [forward(kind, unit(s)) for s in STATES]
                out.append((group["block"][0].as_py(), conv, [x for v in vectors for way in v for x in way]))
        return pa.table({"block": pa.array([r[0] for r in out], pa.int64()),
                         "conv_id": pa.array([r[1] for r in out], group["conv_id"].type),
                         "ways": pa.array([r[2] for r in out], pa.list_(pa.int64()))})

    def states(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        ways = [[[(v[8 * a + 2 * b], v[8 * a + 2 * b + 1]) for b in STATES] for a in STATES] for v in group["ways"].to_pylist()]
        found = fold(ways)
        return pa.table({"block": group["block"], "conv_id": group["conv_id"],
                         "before": pa.array([x for x, _ in found], pa.int32()),
                         "after": pa.array([y for _, y in found], pa.int32())})

    def divide(key, group: pa.Table, known: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        at_edge = dict(zip(known["conv_id"].to_pylist(), zip(known["before"].to_pylist(), known["after"].to_pylist())))
        audits, before = [], []
        for at, to, conv, kind, begins, ends in _fragments(group):
            if begins and ends:
                whole = forward(kind, unit(START))
                a, b = START, min((START, ASSISTANT), key=lambda s: whole[s])
            else:
                a, b = at_edge[conv]
            for row, audit in zip(kind, repair(kind, a, b)):
                audits.append(audit)
                before.append(a)
                for edit in audit:
                    a = {"I": AFTER[a], "R": AFTER[a], "D": a}[edit] if edit != "K" else keeps(row[0], a)
        return pa.table({"id": group["id"], "audit": pa.array(audits, pa.string()), "state": pa.array(before, pa.int32())})

    ship(rows)
    edge = kinds.groupBy("block").applyInArrow(edges, f"block long, conv_id {conv_type}, ways array<long>")
    known = edge.groupBy("conv_id").applyInArrow(states, f"block long, conv_id {conv_type}, before int, after int")
    edits = kinds.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(divide, "id long, audit string, state int")
    return rows.join(edits, "id")


def repaired_turns(edited: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, id, place, role, text, edit``, in order of id and
    place; inserted turns take the id of the row that they stand before."""
    step = F.explode(F.expr("sequence(1, length(audit))")).alias("place")
    one = edited.filter("audit <> ''").select("*", step).withColumn("edit", F.substr("audit", "place", F.lit(1)))
    # A turn is user after every state but user, and inserts before it alternate.
    inserted = F.col("place") - 1
    in_user = F.when(inserted == 0, F.col("state") == USER).otherwise(
        (F.when(F.col("state") == USER, F.lit(0)).otherwise(F.lit(1)) + inserted) % 2 == 0)
    role = F.when(F.col("edit") == "K", F.col("role")).when(in_user, F.lit(ROLE[ASSISTANT])).otherwise(F.lit(ROLE[USER]))
    return one.filter("edit <> 'D'").select("conv_id", "id", "place", role.alias("role"),
                                            F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"), "edit")


def repair_conversations(rows: DataFrame, **columns) -> DataFrame:
    """The repaired turns of ``rows`` (see ``repaired_turns``).

    Null roles and texts are empty (an empty text is blank, an empty role fits no state); turns of
    equal number are ordered by role, then by a digest of the text, so repeated rows are
    neighbours; null turns come first; a null conversation id is a conversation of its own. Long
    conversations and texts are spread over tasks row by row. An empty table gives no rows; other
    columns, whatever their names, are not looked at.
    """
    return repaired_turns(repaired_rows(with_faults(rows, **columns)))


def repair_digests(edited: DataFrame) -> DataFrame:
    """One row a conversation of ``repaired_rows``: ``gaps`` in the turn numbers, counts of
    ``blank, duplicate, truncated`` rows and ``illegal`` neighbours, ``cost``, ``audit``, and
    ``repaired_sha256`` of the repaired ``role:text`` joined by newlines.

    Counts, costs and the neighbours are aggregated by Spark over all tasks; the audit and the
    digest run through a conversation's rows in order, holding one text at a time and an initial
    an edit.
    """
    cost = (REROLE * F.length(F.regexp_replace("audit", "[^R]", "")) + DELETE * F.length(F.regexp_replace("audit", "[^D]", ""))
            + INSERT * F.length(F.regexp_replace("audit", "[^I]", ""))
            + F.when((F.col("fault") == CUT) & ~F.col("audit").endswith("D"), TRUNCATED).otherwise(0))
    real = ~F.col("ends")
    after = edited.filter(real).select((F.col("id") + 1).alias("id"), F.col("initial").alias("before"),
                                       F.col("conv_id").alias("conv_before"))
    pair = F.concat("before", "initial")
    illegal = (real & F.col("before").isNotNull() & F.col("conv_before").eqNullSafe(F.col("conv_id"))
               & ~pair.isin("su", "ua", "au"))
    rows = edited.drop("text").join(after, "id", "left")
    # Distinct turns as a group of their own, so that none is collected in one task.
    turns = rows.groupBy("conv_id", "turn").agg(
        *[F.count_if(F.col("fault") == k).alias(n) for n, k in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT))],
        F.count_if(illegal).alias("illegal"), F.sum(cost).alias("cost"))
    counts = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")])
    conv_type = edited.schema["conv_id"].dataType.simpleString()
    names = ["conv", "audit", "repaired_sha256"]

    def run(batches):
        conv, state = None, None
        for b in batches:
            done = []
            for c, audit, at, role, text, ends in zip(*(col.to_pylist() for col in b.columns[1:])):
                if state is None:
                    conv, state = c, [[], hashlib.sha256(), b""]
                state[0].append(audit)
                for edit in audit:
                    to = at if edit == "D" else keeps(role[:1], at) if edit == "K" else AFTER[at]
                    if edit != "D":
                        name, said = (role, text) if edit == "K" else (ROLE[to], text if edit == "R" else "")
                        state[1].update(state[2] + f"{name}:{said}".encode())
                        state[2] = b"\n"
                    at = to
                if ends:
                    done.append((conv, "".join(state[0]), state[1].hexdigest()))
                    state = None
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*done), [b.column(1).type, pa.string(),
                                                                                             pa.string()])], names)

    ordered = edited.select("id", "conv_id", "audit", "state", "role", "text", "ends") \
        .repartition("conv_id").sortWithinPartitions("id")
    digests = ordered.mapInArrow(run, f"conv {conv_type}, audit string, repaired_sha256 string")
    return counts.join(digests, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv")
