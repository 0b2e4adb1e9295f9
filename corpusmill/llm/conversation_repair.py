"""Repair of conversations whose turns are missing, empty, repeated, cut off or given to the wrong role.

A good conversation has the roles `(s?(ua)+)?` by their initials. A row is blank (no visible character), a duplicate
(its role and text occurred before in the conversation) or truncated (its last visible character is not `.`, `!` or `?`);
the first of these counts. Edits keep a row (K), give it to the user or assistant (R), delete it (D) or insert an empty
turn of either (I). A conversation's audit is the cheapest list of edits, the ASCII-least of equally cheap ones.

What an audit depends on is a conversation's signature: one symbol per row, for its role's initial and fault. Equal
signatures are one row from there on. Signatures are sorted from their ends, so that those with a common
end follow each other, and each end is a node that all conversations with that end share. A node holds, for each state
of the grammar, the cost to go, the first edits and the state behind them. Nodes are further merged by minimising: two
whose costs differ by one constant and whose best audits are ordered alike continue alike before the same symbols, so
the table of such nodes is small and a step is one lookup. Ties need no audit to be spelled out: the edits up to a
row end with the row's own letter, so no such piece is the start of another, and behind equal pieces the order of the
audits at the next node decides. An audit is read off the nodes only when a signature is complete.

Then the rows of each conversation stream past behind its audit, which turns them into the repaired
turns. A conversation is one stream as its digest is one, but it is never held: memory holds its signature
and audit, a byte a row, of which the second is part of the result.

Defined results: null roles and texts count as one space, and a null turn comes first. Rows of one turn are ordered by role, then
by text (its first HEAD characters, then its digest); identical rows of a conversation are duplicates but for
the first. Rows without conversation id are one conversation. A role is known by its first character; an empty role
has none. A conversation without rows has an empty audit. Texts of any length are read whole. An empty table gives no
rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusmill.operators.hotkeys import lookup_join
from corpusmill.session import materialize

# What counts as visible and as the end of a sentence, and what edits cost.
VISIBLE = r"[^\x20\x09-\x0D]"
ENDS = "[.!?]"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

HEAD = 64
# A signature up to this length may be sent to all tasks, if very many conversations have it.
SHORT = 4096

# States of the grammar: nothing yet, after system, after user, after assistant.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
# The state behind an inserted or re-roled turn, which is the user's but after the user.
TURN = {BEGIN: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
# Symbols 0 to 3: a row of system, user, assistant or another role; 4 more: the same, truncated; then one to delete.
OTHER = 3
KEPT = {(BEGIN, 0): SYSTEM, (BEGIN, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
LEGAL = {(0, 1), (1, 2), (2, 1)}
MUST_GO = 8


def damage(rows: DataFrame) -> DataFrame:
    """The registered query's damage: (conv_id, turn, role, text, copies) by a hash of conversation and turn; dropped rows have no copy."""
    spot = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = (F.crc32(spot.cast("binary")) % 20).alias("_kind")
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    found = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind)
    return found.select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 3, 2).otherwise(1).alias("copies"),
    )


def _normal(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone, head, digest), a row for each copy, and one that is gone where there is none."""
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    texts = rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")], copies.alias("copies"))
    made = texts.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)))))
    return made.select(
        "conv_id", "turn", "role", "text", (F.col("copies") < 1).alias("gone"), F.substring("text", 1, HEAD).alias("head"), F.unhex(F.sha2("text", 256)).alias("digest")
    )


def _order(*between: Column) -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), *between, F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("digest")]


class Minimal:
    """Nodes of the automaton that reads signatures from their ends.

    A node is the costs to go from the four states, less the smallest of them, and the order of their best audits.
    """

    def __init__(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.nodes: list[tuple] = []
        self.steps: dict[tuple[int, int], tuple] = {}
        # At the end of a conversation nothing or an assistant's turn may stand; else turns are inserted.
        self.last = ("", "I" * 2, "I", "")
        self.start = self._node((0, 2 * INSERT, INSERT, 0), (0, 2, 1, 0))

    def _node(self, costs: tuple[int, ...], ranks: tuple[int, ...]) -> int:
        key = (costs, ranks)
        if key not in self.numbers:
            self.numbers[key] = len(self.nodes)
            self.nodes.append(key)
        return self.numbers[key]

    def step(self, node: int, symbol: int) -> tuple[int, int, tuple[tuple[str, int], ...]]:
        """(node, what its costs are more, (edits, state behind them) for each state) when a symbol stands before a node."""
        known = self.steps.get((node, symbol))
        if known is None:
            known = self.steps[node, symbol] = self._step(node, symbol)
        return known

    def _step(self, node: int, symbol: int) -> tuple[int, int, tuple[tuple[str, int], ...]]:
        costs, ranks = self.nodes[node]

        def own(state: int) -> list[tuple[int, str, int, int]]:
            found = [(DELETE + costs[state], "D", ranks[state], state)]
            if symbol != MUST_GO:
                more = TRUNCATED if symbol > OTHER else 0
                kept = KEPT.get((state, symbol % 4))
                if kept is not None:
                    found.append((KEEP + more + costs[kept], "K", ranks[kept], kept))
                turn = TURN[state]
                found.append((REROLE + more + costs[turn], "R", ranks[turn], turn))
            return found

        best = []
        for state in range(4):
            # After two insertions the grammar is back where it was after none, but from the first two states.
            once = TURN[state]
            options = own(state)
            options += [(INSERT + c, "I" + e, r, t) for c, e, r, t in own(once)]
            options += [(2 * INSERT + c, "II" + e, r, t) for c, e, r, t in own(TURN[once])]
            best.append(min(options))
        least = min(b[0] for b in best)
        audits = sorted({b[1:3] for b in best})
        node = self._node(tuple(b[0] - least for b in best), tuple(audits.index(b[1:3]) for b in best))
        return node, least, tuple((b[1], b[3]) for b in best)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reversed signatures in order to (signature, n, cost, audit)."""
    automaton = Minimal()
    # The path from the end of the signature at hand: nodes, their costs so far, and the edits that led there.
    nodes, costs, edits, before = [automaton.start], [0], [automaton.last], ""
    for batch in batches:
        backward = batch.column(0).to_pylist()
        found_costs, audits = [], []
        for signature in backward:
            shared = 0
            for x, y in zip(before, signature):
                if x != y:
                    break
                shared += 1
            del nodes[shared + 1:], costs[shared + 1:], edits[shared + 1:]
            for symbol in signature[shared:]:
                node, more, edit = automaton.step(nodes[-1], int(symbol))
                nodes.append(node)
                costs.append(costs[-1] + more)
                edits.append(edit)
            before = signature
            state, audit = BEGIN, []
            for k in range(len(signature), 0, -1):
                piece, state = edits[k][state]
                audit.append(piece)
            audit.append(automaton.last[state])
            found_costs.append(costs[-1] + automaton.nodes[nodes[-1]][0][BEGIN])
            audits.append("".join(audit))
        yield pa.RecordBatch.from_arrays(
            [pa.array([s[::-1] for s in backward], pa.string()), batch.column(1), pa.array(found_costs, pa.int64()), pa.array(audits, pa.string())],
            names=["signature", "n", "cost", "audit"],
        )


class _Tally:
    """What is known of the conversation whose rows stream past."""

    def __init__(self, key: pa.Scalar) -> None:
        self.key, self.pieces = key, []
        self.faults = np.zeros(4, np.int64)
        self.illegal = self.distinct = 0
        self.low = self.high = self.role = None

    def add(self, symbols: np.ndarray, roles: np.ndarray, faults: np.ndarray, turns: np.ndarray) -> None:
        if len(roles):
            self.pieces.append((symbols + ord("0")).astype(np.uint8).tobytes())
            self.faults += np.bincount(faults, minlength=4)
            row = roles.tolist()
            self.illegal += sum(pair not in LEGAL for pair in zip(row if self.role is None else [self.role, *row], row[1:] if self.role is None else row))
            self.role = row[-1]
        if len(turns):
            self.distinct += 1 + int((turns[1:] != turns[:-1]).sum()) - (self.high == int(turns[0]))
            self.low = int(turns[0]) if self.low is None else self.low
            self.high = int(turns[-1])

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.key, b"".join(self.pieces).decode(), gaps, *self.faults[1:].tolist(), self.illegal)


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, turn, gone, role, fault) in order to a row for each conversation."""
    tally, kind = None, None

    def done(tallies: list[_Tally]) -> pa.RecordBatch:
        columns = list(zip(*[t.row() for t in tallies]))
        return pa.RecordBatch.from_arrays(
            [pa.array([k.as_py() for k in columns[0]], kind), pa.array(columns[1], pa.string()), *[pa.array(c, pa.int64()) for c in columns[2:]]], names=["conv_id", "signature", *_COUNTS]
        )

    for batch in batches:
        kind = batch.column(0).type
        runs = pc.run_end_encode(batch.column(0))
        turns, no_turn = pc.fill_null(batch.column(1), 0).to_numpy(), pc.is_null(batch.column(1)).to_numpy(zero_copy_only=False)
        here = ~batch.column(2).to_numpy(zero_copy_only=False)
        roles, faults = batch.column(3).to_numpy(), batch.column(4).to_numpy()
        symbols = np.where((faults == 1) | (faults == 2), MUST_GO, roles + 4 * (faults == 3))
        ended, low = [], 0
        for key, high in zip(runs.values, runs.run_ends.to_pylist(), strict=True):
            if tally is None or not tally.key.equals(key):
                if tally is not None:
                    ended.append(tally)
                tally = _Tally(key)
            at = np.arange(low, high)[here[low:high]]
            tally.add(symbols[at], roles[at], faults[at], turns[at][~no_turn[at]])
            low = high
        if ended:
            yield done(ended)
    if tally is not None:
        yield done([tally])


def plan_repairs(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of conversations given as rows (conv_id, turn, role, text).

    With a column `copies` a row stands for so many equal ones; of a conversation all of whose rows have none, an empty audit remains.
    """
    made = _normal(rows)
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    blank, cut = ~F.col("text").rlike(VISIBLE), ~F.col("text").rlike(rf"(?s){ENDS}[\x20\x09-\x0D]*\z")
    light = made.select("conv_id", "turn", "role", "head", "digest", "gone", role.alias("initial"), blank.alias("blank"), cut.alias("cut"))
    # Dealt once by conversation: repeated texts and the order of rows need no further shuffle.
    same = Window.partitionBy("conv_id", "role", "digest", "gone").orderBy(F.col("turn").asc_nulls_first())
    ranked = light.repartition("conv_id").withColumn("rank", F.row_number().over(same))
    fault = F.when(F.col("blank"), 1).when(F.col("rank") > 1, 2).when(F.col("cut"), 3).otherwise(0)
    ordered = ranked.select("*", fault.alias("fault")).sortWithinPartitions(*_order(), "rank").select("conv_id", "turn", "gone", "initial", "fault")
    kind = rows.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    found = materialize(ordered.mapInArrow(_signatures, f"conv_id {kind}, signature string, {counts}"), "signatures")

    backward = found.groupBy("signature").agg(F.count("*").alias("n")).select(F.reverse("signature").alias("backward"), "n")
    shared = backward.repartitionByRange("backward").sortWithinPartitions("backward").mapInArrow(_audits, "signature string, n bigint, cost bigint, audit string")
    # Short signatures are shared by very many conversations; a long one is never sent to all tasks.
    shared = materialize(shared.withColumn("n", F.when(F.length("signature") <= SHORT, F.col("n")).otherwise(0)), "audits")
    return lookup_join(found, shared, "signature", "n").select("conv_id", *_COUNTS, "cost", "audit")


def _replay(audit: str, at: int, state: int, role: str | None, text: str | None) -> Iterator[tuple[int, int, str, str, str]]:
    """(place in the audit, state, edit, role, text) of the turns that a row makes; without a row, of those left at the end."""
    while at < len(audit) and audit[at] == "I":
        at, state = at + 1, TURN[state]
        yield at, state, "I", "user" if state == USER else "assistant", ""
    if role is not None:
        edit = audit[at]
        if edit == "K":
            state = KEPT[state, {"s": 0, "u": 1, "a": 2}[role[:1]]]
        elif edit == "R":
            state = TURN[state]
            role = "user" if state == USER else "assistant"
        yield at + 1, state, edit, role, text


class _Repair:
    """The repaired turns of one conversation, row by row."""

    def __init__(self, plan: dict) -> None:
        self.plan, self.at, self.state = plan, 0, BEGIN

    def turns(self, role: str | None = None, text: str | None = None) -> Iterator[tuple[str, str, str]]:
        for self.at, self.state, edit, new_role, new_text in _replay(self.plan["audit"], self.at, self.state, role, text):
            yield edit, new_role, new_text


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Repair, str | None, str | None, bool]]:
    """(repair, role, text, whether the conversation ends here) for the rows behind each plan."""
    repair = None
    for batch in batches:
        names = batch.schema.names
        plans, roles, texts = (batch.column(names.index(c)).to_pylist() for c in ("plan", "role", "text"))
        for plan, role, text in zip(plans, roles, texts, strict=True):
            if plan is None:
                yield repair, role, text, False
                continue
            if repair is not None:
                yield repair, None, None, True
            repair = _Repair(plan)
    if repair is not None:
        yield repair, None, None, True


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    made, digest, first = [], hashlib.sha256(), True
    for repair, role, text, ends in _streams(batches):
        for edit, new_role, new_text in repair.turns(role, text):
            if edit != "D":
                digest.update(f"{'' if first else chr(10)}{new_role}:{new_text}".encode())
                first = False
        if ends:
            made.append({**repair.plan, "repaired_sha256": digest.hexdigest()})
            digest, first = hashlib.sha256(), True
            if len(made) == 4096:
                yield pa.RecordBatch.from_pylist(made, schema)
                made = []
    if made:
        yield pa.RecordBatch.from_pylist(made, schema)


def _turns(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    made, size, place = [], 0, 0
    for repair, role, text, ends in _streams(batches):
        for edit, new_role, new_text in repair.turns(role, text):
            if edit != "D":
                made.append({"conv_id": repair.plan["conv_id"], "place": place, "edit": edit, "role": new_role, "text": new_text})
                place, size = place + 1, size + len(new_text)
        place = 0 if ends else place
        if len(made) >= 4096 or size > 1 << 22:
            yield pa.RecordBatch.from_pylist(made, schema)
            made, size = [], 0
    if made:
        yield pa.RecordBatch.from_pylist(made, schema)


def _behind_plans(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's plan, then its rows in order."""
    plan = F.struct(*plans.columns)
    none = {c: F.lit(None).cast(t) for c, t in (("turn", rows.schema["turn"].dataType), ("role", "string"), ("text", "string"), ("head", "string"), ("digest", "binary"))}
    heads = plans.select("conv_id", *[v.alias(c) for c, v in none.items()], plan.alias("plan"))
    kind = heads.schema["plan"].dataType
    made = _normal(rows).where("NOT gone").select("conv_id", "turn", "role", "text", "head", "digest", F.lit(None).cast(kind).alias("plan"))
    stream = heads.unionByName(made).repartition("conv_id").sortWithinPartitions(*_order(F.col("plan").isNull()))
    return stream.select("plan", "role", "text")


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns of each conversation after the edits of its audit."""
    stream = _behind_plans(rows, plans)
    schema = T.StructType([stream.schema["plan"].dataType["conv_id"]]).add("place", "long").add("edit", "string").add("role", "string").add("text", "string")
    arrow = to_arrow_schema(schema)
    return stream.mapInArrow(lambda batches: _turns(batches, arrow), schema)


def repair_digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """`plans` with repaired_sha256, the digest of the repaired turns as lines `role:text`."""
    stream = _behind_plans(rows, plans)
    schema = T.StructType([*stream.schema["plan"].dataType.fields]).add("repaired_sha256", "string")
    arrow = to_arrow_schema(schema)
    return stream.mapInArrow(lambda batches: _digests(batches, arrow), schema)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), a row for each conversation."""
    return repair_digests(rows, materialize(plan_repairs(rows), "plans"))
