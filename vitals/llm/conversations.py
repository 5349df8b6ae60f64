"""Operator 13: repair of conversation structure by depth-first branch-and-bound.

A conversation is put in the form ``(system? (user assistant)+)?`` by the cheapest edits of its rows:
Keep (0), Rerole to user or assistant (1), Delete (2, required for blank and duplicate rows), Insert an empty
user or assistant row (5); a truncated row that stays adds 5. Among repairs of equal cost the one with the ASCII-least
audit (the edits' initials in order) wins.

Search (``search``): an explicit stack of prefixes (row, role state, cost, audit), deepest and most promising first.

* suffix lower bounds: the cost of the rows that are left when the end of the conversation may fall in any state;
* incumbent: the best (cost, audit) found; a prefix whose cost and bound exceed it, or reach its cost with a greater
  audit, is cut;
* dominance: for each (row, state) the least (cost, audit) seen; a worse prefix is eliminated. That is exact, also for audits: of
  two prefixes of one node and cost neither begins the other, as the longer would hold further inserts.

The search ends when the stack is empty, so the incumbent is proved optimal. A long conversation is searched in windows
of ``WINDOW`` rows: each window ends with one label per role state, and what all labels share is settled and forgotten.

In Spark: equal rows are counted map-side; whether a row's (role, text) came earlier is found by an aggregate
and a join; the rows of a conversation then stream through one task in the order of their turns, because its digest is
one sequential hash. A task holds no conversation, only the unsettled rows (and the audit, which is a column of the result).

Cases: null turns come first; null role or text reads as one space; rows of one turn are ordered by role and text; a
role counts by its first character, and a role that is empty or does not begin with s, u or a can't be kept; a null conv_id is a
conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.llm.common import prepare, rows_batches

#: Rows searched at once.
WINDOW = 256
#: Costs of the edits; a truncated row that stays adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: A label that is dearer than another by more than this can't win: some repair leads from any state
#: into any other for less (two inserts, or one and a deleted system row).
MOST_BEHIND = 20

# Role states of a prefix: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
#: What may follow each state, beside a system row at the start.
FOLLOWS = (USER, USER, ASSISTANT, USER)
ROLE_NAME = {USER: "user", ASSISTANT: "assistant"}
BLANKS = " \t\n\x0b\x0c\r"

GOOD, CUT_OFF, FORCED = range(3)


def role_class(role: str) -> int:
    """The state that a kept row of this role leads to, 0 if it can't be kept."""
    return {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(role[:1], 0)


def _moves(role: int, fault: int) -> list[list[tuple[str, int, int]]]:
    """For each state the edits of a row: (initial, cost, next state)."""
    out = []
    for state in range(4):
        edits = [("D", DELETE, state)]
        if fault != FORCED:
            extra, target = TRUNCATED * (fault == CUT_OFF), FOLLOWS[state]
            if role == target or (role == SYSTEM and state == START):
                edits.append(("K", extra, role))
            if role != target:
                edits.append(("R", REROLE + extra, target))
        out.append(edits)
    return out


MOVES = {(role, fault): _moves(role, fault) for role in range(4) for fault in range(3)}

Row = tuple[int, int]
Label = tuple[int, str]


def suffix_bounds(rows: list[Row]) -> list[list[int]]:
    """Least cost of rows[i:] from each state if the conversation might end in any state."""
    bounds = [[0] * 4]
    for row in reversed(rows):
        after = bounds[-1]
        own = [min(cost + after[to] for _, cost, to in edits) for edits in MOVES[row]]
        bounds.append([min(own[s], INSERT + own[FOLLOWS[s]], 2 * INSERT + own[FOLLOWS[FOLLOWS[s]]]) for s in range(4)])
    return bounds[::-1]


def search(rows: list[Row], entries: dict[int, Label], last: bool = True) -> dict[int, Label]:
    """The least (cost, audit) from the entry labels over ``rows``: for the last window under state ASSISTANT or
    START, whichever is best; else for every state that can still win."""
    n, bounds = len(rows), suffix_bounds(rows)
    exits: dict[int, Label] = {}
    incumbent: Label | None = None
    least = None
    seen: dict[tuple[int, int], Label] = {}
    stack = []
    for state, (cost, audit) in entries.items():
        seen[0, state] = (cost, audit)
        stack.append((cost + bounds[0][state], audit, 0, state, cost))
    stack.sort(reverse=True)
    while stack:
        floor, audit, i, state, cost = stack.pop()
        if seen[i, state] != (cost, audit):
            continue  # dominated since
        if last:
            if incumbent is not None and (floor > incumbent[0] or floor == incumbent[0] and audit > incumbent[1][: len(audit)]):
                continue
        elif least is not None and floor > least + MOST_BEHIND:
            continue
        if i == n:
            if last and state in ACCEPTING:
                if incumbent is None or (cost, audit) < incumbent:
                    incumbent, exits = (cost, audit), {state: (cost, audit)}
                continue
            if not last and (state not in exits or (cost, audit) < exits[state]):
                exits[state] = (cost, audit)
                least = cost if least is None else min(least, cost)
        found = [("I", INSERT, FOLLOWS[state], i)]
        if i < n:
            found += [(edit, more, to, i + 1) for edit, more, to in MOVES[rows[i]][state]]
        children = []
        for edit, more, to, at in found:
            label = (cost + more, audit + edit)
            known = seen.get((at, to))
            if known is None or label < known:
                seen[at, to] = label
                children.append((label[0] + bounds[at][to], label[1], at, to, label[0]))
        children.sort(reverse=True)
        stack += children
    if not last:
        exits = {s: x for s, x in exits.items() if x[0] <= least + MOST_BEHIND}
    return exits


class Conversation:
    """The state of one conversation whose rows come in order."""

    def __init__(self, conv_id, window: int = WINDOW):
        self.conv_id, self.window = conv_id, window
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = 0
        self.before: str | None = None
        self.first_turn = self.last_turn = None
        self.turns = 0
        self.held: list[tuple[str, str]] = []  # rows whose edits aren't settled
        self.codes: list[Row] = []  # the last of them, not searched yet
        self.labels: dict[int, Label] = {START: (0, "")}
        self.state, self.audit = START, []  # what is settled
        self.hash, self.empty, self.cost, self.length = hashlib.sha256(), True, 0, 0

    def add(self, turn, role: str, text: str, copies: int, first: bool) -> Iterator[tuple]:
        """``copies`` equal rows of one turn; ``first``: no earlier turn has their role and text."""
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        bare = text.rstrip(BLANKS)
        for k in range(copies):
            fault = GOOD
            if not bare:
                self.faults["blank"] += 1
                fault = FORCED
            elif k or not first:
                self.faults["duplicate"] += 1
                fault = FORCED
            elif bare[-1] not in ".!?":
                self.faults["truncated"] += 1
                fault = CUT_OFF
            if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = role[:1]
            if len(self.codes) == self.window:
                self.labels = search(self.codes, self.labels, last=False)
                self.codes = []
                yield from self.settle(os.path.commonprefix([audit for _, audit in self.labels.values()]))
            self.codes.append((role_class(role), fault))
            self.held.append((role, text))

    def settle(self, edits: str) -> Iterator[tuple]:
        """Apply edits on which all labels agree; yields the repaired rows (conv_id, position, edit, role, text)."""
        done = 0
        for edit in edits:
            role, text = "", ""
            if edit != "I":
                role, text = self.held[done]
                done += 1
            if edit == "D":
                continue
            self.state = role_class(role) if edit == "K" else FOLLOWS[self.state]
            if edit != "K":
                role = ROLE_NAME[self.state]
            self.hash.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
            self.empty = False
            yield (self.conv_id, self.length, edit, role, text)
            self.length += 1
        del self.held[:done]
        self.audit.append(edits)
        self.labels = {s: (cost, audit[len(edits) :]) for s, (cost, audit) in self.labels.items()}

    def end(self) -> Iterator[tuple]:
        self.labels = search(self.codes, self.labels)
        ((self.cost, audit),) = self.labels.values()
        yield from self.settle(audit)

    def digest(self) -> tuple:
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


DIGEST = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])
TURNS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _stream(turns: bool, window: int):
    def rows(batches):
        now = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "first")]
            for conv_id, *row in zip(*columns, strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        repaired = now.end()
                        yield from repaired if turns else (now.digest() for _ in [sum(1 for _ in repaired)])
                    now = Conversation(conv_id, window)
                repaired = now.add(*row)
                if turns:
                    yield from repaired
                else:
                    for _ in repaired:
                        pass
        if now is not None:
            repaired = now.end()
            yield from repaired if turns else (now.digest() for _ in [sum(1 for _ in repaired)])

    return lambda batches: rows_batches(rows(batches), TURNS if turns else DIGEST)


def _ordered(conversations: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies, and whether their role and text are new; by conversation, in order."""
    prepare(conversations.sparkSession)
    plain = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    )
    counted = plain.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("key", F.md5(F.concat("role", F.lit("\x00"), "text")))
    seen = counted.groupBy(F.col("conv_id").alias("s_id"), F.col("key").alias("s_key")).agg(F.min(F.struct("turn")).alias("s_turn"))
    joined = counted.join(seen, F.col("conv_id").eqNullSafe(F.col("s_id")) & (F.col("key") == F.col("s_key")))
    marked = joined.select("conv_id", "turn", "role", "text", "copies", F.col("s_turn.turn").eqNullSafe(F.col("turn")).alias("first"))
    return marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def repair(conversations: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per conv_id: faults, gaps in the turns, cost and audit of the cheapest repair, and the digest of its rows.

    gaps: highest turn - lowest turn + 1 - distinct turns; blank, duplicate, truncated: rows by their first fault; illegal:
    adjacent roles other than system-user, user-assistant, assistant-user; repaired_sha256: of ``role:text`` lines."""
    return _ordered(conversations).mapInArrow(_stream(False, window), ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in DIGEST))


def repaired_turns(conversations: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of the repaired conversations: conv_id, position (from 0), edit (K, R or I), role, text."""
    return _ordered(conversations).mapInArrow(_stream(True, window), ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in TURNS))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) % 20: 0 dropped, 1 emptied, 2 without ``.!?``, 3 twice, 4 as user."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *said).cast("binary")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    changed = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    out = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), changed.alias("text"), "kind")
    return out.withColumn("again", F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))).select("conv_id", "turn", "role", "text")
