"""Repair of conversation structure over a suffix-shared automaton (DAWG) of role and fault signatures.

A signature has one letter for each row of a conversation: ``d`` for a blank or duplicate row, which must go, otherwise the initial of its role (``s``,
``u``, ``a``, ``x`` for any other), as a capital when its text is truncated. Repair is a cheapest run of edits that turns the initials
into ``(s?(ua)+)?``. What the rest of a conversation costs depends on the rest of its signature and on the state of that grammar
alone, so all conversations share one automaton whose nodes are the different ends of signatures:

1. Rows are dealt by conversation and sorted by turn; one pass over them gives each conversation's counts and signature.
2. The different signatures are sorted by their ends (reversed) and dealt in ranges. A task walks its range as a depth-first walk of the
   automaton: it keeps the nodes of the present signature, drops those that the next one doesn't share and adds the new ones in front. Every
   node gets, once for all conversations, the cost-to-go and best edit of each grammar state, from the node behind it; the
   best audit of a state is its edit before the audit of the state it leads to, so audits are shared as links and read off
   once for a signature. Only nodes on the edge of a range are made by two tasks.
3. Audits go back to the conversations by signature, and a second pass over the sorted rows writes the repaired text into the digest.

Both passes hold the counts and the signature of one conversation (a byte a row) and no texts but those of a batch.

Edits: Keep costs 0, Rerole 2, Delete 3, Insert 2, a truncated row that isn't deleted 1 more. Of equally cheap runs the one whose audit is
least in ASCII stays; the four edits at a place have different letters and lead to one state each, so the least audit follows from the least letter.

Defined results: nulls in ``turn``, ``role`` and ``text`` are one space where they are part of a text; rows without a conversation id are one
conversation; rows of one turn are ordered by role and text, null turns come first; an empty role has initial ``x``; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajspark.llm.common import saved

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
ROLES = {"u": "user", "a": "assistant"}
# grammar states: nothing yet, after the system row, after a user row, after an assistant row (nothing yet and the last may end)
STATES = 4
AFTER = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
NEXT = (2, 2, 3, 2)  # the state after the row that an insertion or a rerole puts there
PUTS = "uuau"
BLANK = r"^[\x20\x09-\x0D]*+\z"
ENDS = r"[.!?][\x20\x09-\x0D]*+\z"
FAULTS = ("", "blank", "duplicate", "truncated")


def damaged(rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Rows with one fault in five dealt by a checksum of conversation and turn; ``alive`` is false where a row is dropped."""
    key = F.concat(_shown(F.col(conv_col)), F.lit(":"), _shown(F.col("turn")))
    own = rows.select(
        F.col(conv_col).alias("conv_id"), F.col("turn").cast("long").alias("turn"), _shown(F.col("role")).alias("role"), _shown(F.col("text")).alias("text"),
        (F.crc32(F.encode(key, "UTF-8")) % 20).cast("int").alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return own.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fate") != 0).alias("alive"), copies.alias("copy")).drop("copy")


def _shown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows with their first fault (an index into ``FAULTS``), a conversation whole and in order inside a partition; one shuffle."""
    at_turn = F.asc_nulls_first("turn")
    again = Window.partitionBy("conv_id", "alive", "role", "text").orderBy(at_turn)
    dealt = rows.repartition("conv_id").withColumn("seen", F.row_number().over(again))
    fault = F.when(F.col("text").rlike(BLANK), 1).when(F.col("seen") > 1, 2).when(~F.col("text").rlike(ENDS), 3).otherwise(0)
    return dealt.withColumn("fault", fault.cast("int")).sortWithinPartitions("conv_id", F.desc("alive"), at_turn, "role", "text", "seen")


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation: gaps, faults, illegal neighbours and signature."""
    held: dict | None = None
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "signature"]

    def done() -> pa.RecordBatch:
        turns = held["turns"]
        gaps = held["high"] - held["low"] + 1 - turns if turns else 0
        cells = [[gaps], *[[n] for n in held["faults"][1:]], [held["illegal"]], [held["letters"].decode()]]
        return pa.record_batch([held["id"], *[pa.array(c, pa.string() if n == "signature" else pa.int64()) for c, n in zip(cells, names[1:], strict=True)]], names)

    for batch in batches:
        ids = batch.column(0)
        alive, turns, roles, faults = (batch.column(i).to_pylist() for i in (1, 2, 3, 4))
        keys = ids.to_pylist()
        for i, key in enumerate(keys):
            if held is None or key != held["key"]:
                if held is not None:
                    yield done()
                held = {"key": key, "id": ids.slice(i, 1), "turns": 0, "low": None, "high": None, "faults": [0] * 4, "illegal": 0, "letters": bytearray(), "last": None}
            if not alive[i]:
                continue
            turn, role, fault = turns[i], roles[i], faults[i]
            if turn is not None and (held["high"] is None or turn > held["high"]):
                held["low"] = turn if held["low"] is None else held["low"]
                held["high"], held["turns"] = turn, held["turns"] + 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if held["last"] is not None and held["last"] + initial not in ("su", "ua", "au"):
                held["illegal"] += 1
            held["last"] = initial
            held["faults"][fault] += 1
            held["letters"] += (b"d" if fault in (1, 2) else initial.upper().encode() if fault == 3 else initial.encode())
    if held is not None:
        yield done()


class Node:
    """The end of a signature: for each grammar state its cost-to-go, its best edit and the (node, state) which that leads to."""

    __slots__ = ("cost", "edit", "to")

    def __init__(self, letter: str = "", behind: Node | None = None):
        options: list[list[tuple]] = [[] for _ in range(STATES)]
        for state in range(STATES):
            if behind is None:
                if state in (0, 3):
                    options[state].append((0, "", None, state))
                continue
            options[state].append((DELETE + behind.cost[state], "D", behind, state))
            if letter != "d":
                extra = TRUNCATED if letter.isupper() else 0
                options[state].append((REROLE + extra + behind.cost[NEXT[state]], "R", behind, NEXT[state]))
                to = AFTER.get((letter.lower(), state))
                if to is not None:
                    options[state].append((KEEP + extra + behind.cost[to], "K", behind, to))
        best = [min(o, key=lambda x: x[:2], default=None) for o in options]
        for _ in range(2):  # an insertion leads to a state of this very node; two in a row reach every state that helps
            for state in range(STATES):
                there = best[NEXT[state]]
                if there is not None:
                    here = (INSERT + there[0], "I", self, NEXT[state])
                    if best[state] is None or here[:2] < best[state][:2]:
                        best[state] = here
        self.cost, self.edit, self.to = [b[0] for b in best], [b[1] for b in best], [b[2:] for b in best]

    def audit(self, state: int = 0) -> str:
        letters, node = [], self
        while node is not None:
            letters.append(node.edit[state])
            node, state = node.to[state]
        return "".join(letters)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(signature, cost, audit) of signatures that come sorted by their ends."""
    path, last = [Node()], ""
    for batch in batches:
        costs, audits = [], []
        for backwards in batch.column(0).to_pylist():
            same = 0
            limit = min(len(last), len(backwards))
            while same < limit and last[same] == backwards[same]:
                same += 1
            del path[same + 1 :]
            for letter in backwards[same:]:
                path.append(Node(letter, path[-1]))
            last = backwards
            costs.append(path[-1].cost[0])
            audits.append(path[-1].audit())
        yield pa.record_batch([batch.column(1), pa.array(costs, pa.int64()), pa.array(audits, pa.string())], ["signature", "cost", "audit"])


def cheapest_repairs(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of the different signatures."""
    distinct = signatures.select("signature").distinct().select(F.reverse("signature").alias("backwards"), "signature")
    return distinct.repartitionByRange("backwards").sortWithinPartitions("backwards").mapInArrow(_solved, "signature string, cost long, audit string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, repaired_sha256) of conversations that come as a row with the audit before their rows in order."""
    held: dict | None = None

    def put(role: str, text: str) -> None:
        held["sha"].update((("\n" if held["rows"] else "") + role + ":" + text).encode())
        held["rows"] += 1

    def insertions() -> None:
        while held["audit"][held["at"] : held["at"] + 1] == "I":
            put(ROLES[PUTS[held["state"]]], "")
            held["state"] = NEXT[held["state"]]
            held["at"] += 1

    def done() -> pa.RecordBatch:
        return pa.record_batch([held["id"], pa.array([held["sha"].hexdigest()])], ["conv_id", "repaired_sha256"])

    for batch in batches:
        ids = batch.column(0)
        audits, roles, texts = (batch.column(i).to_pylist() for i in (1, 2, 3))
        for i, audit in enumerate(audits):
            if audit is not None:
                if held is not None:
                    yield done()
                held = {"id": ids.slice(i, 1), "audit": audit, "at": 0, "state": 0, "rows": 0, "sha": hashlib.sha256()}
                insertions()
                continue
            edit = held["audit"][held["at"]]
            held["at"] += 1
            if edit == "K":
                put(roles[i], texts[i])
                held["state"] = AFTER[roles[i][:1], held["state"]]
            elif edit == "R":
                put(ROLES[PUTS[held["state"]]], texts[i])
                held["state"] = NEXT[held["state"]]
            insertions()
    if held is not None:
        yield done()


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", *, damage=None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``damage`` prepares the rows (conv_id, turn, role, text, alive); by default they are taken as they are.
    """
    kind = rows.schema[conv_col].dataType.simpleString()
    whole = damage or as_they_are
    marked = _sorted(whole(rows, conv_col))
    counts = ", ".join(f"{c} long" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))
    facts = saved(
        marked.select("conv_id", "alive", "turn", "role", "fault").mapInArrow(_facts, f"conv_id {kind}, {counts}, signature string"), "repair-facts")
    repairs = cheapest_repairs(facts)
    known = saved(facts.join(repairs, "signature").drop("signature"), "repair-audits")
    none = F.lit(None)
    lines = whole(rows, conv_col).filter("alive").select("conv_id", none.cast("string").alias("audit"), "role", "text", F.lit(1).alias("part"), "turn")
    heads = known.select("conv_id", "audit", none.cast("string").alias("role"), none.cast("string").alias("text"), F.lit(0).alias("part"), none.cast("long").alias("turn"))
    placed = heads.unionByName(lines).repartition("conv_id")
    placed = placed.sortWithinPartitions("conv_id", "part", F.asc_nulls_first("turn"), "role", "text")
    digests = placed.select("conv_id", "audit", "role", "text").mapInArrow(_digests, f"conv_id {kind}, repaired_sha256 string")
    digests = digests.withColumnRenamed("conv_id", "_id")
    found = known.join(digests, F.col("conv_id").eqNullSafe(F.col("_id")))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def as_they_are(rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    return rows.select(
        F.col(conv_col).alias("conv_id"), F.col("turn").cast("long").alias("turn"), _shown(F.col("role")).alias("role"), _shown(F.col("text")).alias("text"),
        F.lit(True).alias("alive"))
