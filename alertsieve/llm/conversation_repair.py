"""Conversation structure repair: the cheapest edits that turn a conversation into
``system? (user assistant)+``, or into nothing, found by iterative-deepening A*.

1. Spark marks every row's first fault (blank, duplicate, truncated) and codes role and fault in
   one byte; rows meet by conversation in one shuffle, sorted, and are read as a stream.
2. The search runs over the bytes of a conversation: depth-first in the ASCII order of the edits
   (Delete, Insert, Keep, Rerole) under a cost bound that rises to the least cost that failed.  A
   table keeps, for every state (row, role before), the cost that is known to be needed from there:
   at first an estimate that is never too high (exact inside blocks of rows, with any role allowed at
   their borders), raised whenever a state fails.  The first accepting path is the answer: of the
   cheapest edits, those whose initials come first in ASCII order.
3. The edits go in front of the rows of their conversation, which are sorted again and repaired as a
   stream; a task holds one byte a row and the search's table, never the texts of a conversation.

Costs: Keep 0, Insert of an empty text 2, Rerole to user or assistant 2, Delete 3 (required for
blank and duplicate rows); a truncated row that isn't deleted adds 1.

Defined results: a NULL role or text is one space; rows of a conversation come by (turn, role,
text), NULL turns first; rows equal in role and text to an earlier one are duplicates, whatever
their turn; a role counts by its first character, s, u or a, and any other must be changed or go; a
NULL conversation is one of its own.  A conversation without rows has the empty audit.  Columns
beside the four named ones are not read, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: White space of the contract: space and 0x09 to 0x0D.
SPACES = " \t\n\x0b\x0c\r"
KEEP, INSERT, REROLE, DELETE, TRUNCATED = 0, 2, 2, 3, 1
#: Fault codes; a row's byte is 4 * role code + fault code.
SOUND, BLANK, DUPLICATE, CUT = range(4)
#: Role codes, and the states of the grammar: START, or the role of the row before.
S, U, A, OTHER = range(4)
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NAMES = {U: "user", A: "assistant"}
#: state -> the role that a user or assistant row must have here, and the state behind it.
WANTED = {START: (U, AFTER_U), AFTER_S: (U, AFTER_U), AFTER_U: (A, AFTER_A), AFTER_A: (U, AFTER_U)}
FINAL = (START, AFTER_A)
#: Pairs of neighbouring roles that are legal.
LEGAL = {(S, U), (U, A), (A, U)}
#: Rows of a block of the estimate, at least, and blocks of a conversation, at most.
BLOCK, BLOCKS = 16, 64
#: Answers that a task keeps for conversations alike.
KNOWN = 4096
STATS = ("rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _moves(kind: int, state: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, rows used, next state) in ASCII order, for a row's byte, or -1 behind the last."""
    role, fault = divmod(kind, 4) if kind >= 0 else (OTHER, BLANK)
    wanted, after = WANTED[state]
    out = [("I", INSERT, 0, after)]
    if kind < 0:
        return out
    out.insert(0, ("D", DELETE, 1, state))
    if fault in (SOUND, CUT):
        extra = TRUNCATED if fault == CUT else 0
        if role == wanted:
            out.append(("K", KEEP + extra, 1, after))
        elif role == S and state == START:
            out += [("K", KEEP + extra, 1, AFTER_S), ("R", REROLE + extra, 1, after)]
        else:
            out.append(("R", REROLE + extra, 1, after))
    return out


MOVES = {kind: [_moves(kind, state) for state in range(4)] for kind in range(-1, 16)}


def _estimate(kinds: bytes) -> list[int]:
    """A cost never above the true one for every state (4 * row + state)."""
    n = len(kinds)
    block = max(BLOCK, -(-n // BLOCKS))
    out = [0] * (4 * n + 4)
    rest = 0
    for end in range(n, -1 if n == 0 else 0, -block):
        begin = max(0, end - block)
        below = [0 if s in FINAL else None for s in range(4)] if end == n else [0] * 4
        for i in range(end, begin - 1, -1) if end == n else range(end - 1, begin - 1, -1):
            costs = [None if i < n else below[s] for s in range(4)]
            if i < n:
                for s in range(4):
                    some = [c + below[t] for _, c, used, t in MOVES[kinds[i]][s] if used]
                    costs[s] = min(some)
            for _ in range(2):  # no cheapest repair has three insertions in a row
                for s in range(4):
                    t = WANTED[s][1]
                    if costs[t] is not None and (costs[s] is None or costs[s] > INSERT + costs[t]):
                        costs[s] = INSERT + costs[t]
            for s in range(4):
                out[4 * i + s] = costs[s] + rest
            below = costs
        rest += min(below)
    return out


def search(kinds: bytes) -> tuple[int, str]:
    """(cost, edits) of the cheapest repair of rows given as bytes; of equal costs, the edits that
    come first in ASCII order."""
    n = len(kinds)
    need = _estimate(kinds)
    while True:
        bound = need[START]
        path: list[str] = []
        # frames of the states on the path: state, cost left, next move, cost needed from here
        nodes, lefts, turns, needs = [START], [bound], [0], [1 << 60]
        need[START] = bound + 1
        while nodes:
            x, left, m = nodes[-1], lefts[-1], turns[-1]
            i, state = x >> 2, x & 3
            if m == 0 and i == n and state in FINAL:
                return bound - left, "".join(path)
            moves = MOVES[kinds[i] if i < n else -1][state]
            if m == len(moves):  # failed: what every child needs is known
                need[x] = max(left + 1, needs[-1])
                nodes.pop(), lefts.pop(), turns.pop(), needs.pop()
                if nodes:
                    path.pop()
                    turns[-1] += 1
                    cost = MOVES[kinds[nodes[-1] >> 2] if nodes[-1] >> 2 < n else -1][nodes[-1] & 3][turns[-1] - 1][1]
                    needs[-1] = min(needs[-1], cost + need[x])
                continue
            edit, cost, used, after = moves[m]
            y = 4 * (i + used) + after
            if left - cost < need[y]:
                needs[-1] = min(needs[-1], cost + need[y])
                turns[-1] += 1
            else:
                need[y] = left - cost + 1  # fails, unless the search ends below it
                path.append(edit)
                nodes.append(y), lefts.append(left - cost), turns.append(0), needs.append(1 << 60)


class _Facts:
    """What is gathered of one conversation while its rows go by."""

    def __init__(self, conv):
        self.conv, self.kinds = conv, bytearray()
        self.first = self.last = None
        self.turns = 0

    def add(self, kind: int, turn):
        self.kinds.append(kind)
        if turn is not None:
            if self.first is None:
                self.first = turn
            if turn != self.last:
                self.turns += 1
                self.last = turn

    def row(self, known: dict) -> tuple:
        """``known`` holds answers of conversations with the same bytes."""
        kinds = bytes(self.kinds)
        roles, faults = [k >> 2 for k in kinds], [k & 3 for k in kinds]
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        illegal = sum(pair not in LEGAL for pair in zip(roles, roles[1:]))
        if kinds not in known:
            if len(known) >= KNOWN:
                known.clear()
            known[kinds] = search(kinds)
        cost, audit = known[kinds]
        return (self.conv, len(kinds), gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT),
                illegal, cost, audit)


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv, kind, turn) in order -> one row per conversation."""
    facts, out, schema, known = None, [], None, {}

    def batch():
        names = ["conv", *STATS, "audit"]
        types = [schema, *[pa.int64()] * len(STATS), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    for b in batches:
        schema = b.schema.field(0).type
        for conv, kind, turn in zip(*[c.to_pylist() for c in b.columns]):
            if facts is None or facts.conv != conv:
                if facts is not None:
                    out.append(facts.row(known))
                facts = _Facts(conv)
            if kind is not None:
                facts.add(kind, turn)
        if len(out) >= 1024:
            yield batch()
            out = []
    if facts is not None:
        out.append(facts.row(known))
        yield batch()


class _Repair:
    """Applies one conversation's edits to its rows as they go by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            role, self.state = WANTED[self.state]
            yield NAMES[role], "", "I"

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        wanted, after = WANTED[self.state]
        if edit == "R":
            role = NAMES[wanted]
        self.state = AFTER_S if self.state == START and role[:1] == "s" else after
        yield role, text, edit

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv, audit, role, text), a conversation's audit first -> repaired turns."""
    conv, repair, place = None, None, 0
    for b in batches:
        out = []

        def put(some):
            nonlocal place
            for role, text, edit in some:
                out.append((conv, place, role, text, edit))
                place += 1
        for c, audit, role, text in zip(*[c.to_pylist() for c in b.columns]):
            if audit is not None:
                if repair is not None:
                    put(repair.end())
                conv, repair, place = c, _Repair(audit), 0
            else:
                put(repair.row(role, text))
        types = [b.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
        columns = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)],
                                         names=["conv", "position", "role", "text", "edit"])
    if repair is not None and (rest := list(repair.end())):
        yield pa.RecordBatch.from_arrays(
            [pa.array([conv] * len(rest), types[0]), pa.array(range(place, place + len(rest)), pa.int64()),
             *[pa.array(x, pa.string()) for x in zip(*rest)]], names=["conv", "position", "role", "text", "edit"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``_repaired``, but the SHA-256 of every conversation's ``role:text`` lines, taken as they go by."""
    repair, digest, begun, conv = None, None, False, None

    def put(some):
        nonlocal begun
        for role, text, _ in some:
            digest.update(f"\n{role}:{text}".encode() if begun else f"{role}:{text}".encode())
            begun = True
    for b in batches:
        out = []
        for c, audit, role, text in zip(*[c.to_pylist() for c in b.columns]):
            if audit is not None:
                if repair is not None:
                    put(repair.end())
                    out.append((conv, digest.hexdigest()))
                conv, repair, digest, begun = c, _Repair(audit), hashlib.sha256(), False
            else:
                put(repair.row(role, text))
        kind = b.schema.field(0).type
        columns = list(zip(*out)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], kind), pa.array(columns[1], pa.string())],
                                         names=["conv", "sha256"])
    if repair is not None:
        put(repair.end())
        yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()], pa.string())],
                                         names=["conv", "sha256"])


def _rows(turns: DataFrame, conv: str, turn: str, role: str, text: str, gone: Column | None) -> DataFrame:
    """conv, turn, role, text, gone: the rows of the search, whatever their columns were called."""
    space = F.lit(" ")
    return turns.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                        F.coalesce(F.col(f"`{role}`"), space).alias("role"),
                        F.coalesce(F.col(f"`{text}`"), space).alias("text"),
                        (F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))).alias("gone"))


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text, gone) by conversation, with ``kind``, their byte.  One shuffle: rows that
    are equal are compared inside their conversation's partition."""
    earlier = F.row_number().over(Window.partitionBy("conv", "gone", "role", "text").orderBy("turn")) > 1
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    fault = (F.when(last == "", BLANK).when(F.col("earlier"), DUPLICATE)
             .when(~last.isin(".", "!", "?"), CUT).otherwise(SOUND))
    first = F.left("role", F.lit(1))
    code = F.when(first == "s", S).when(first == "u", U).when(first == "a", A).otherwise(OTHER)
    return (rows.repartition("conv").withColumn("earlier", earlier)
            .withColumn("kind", F.when(~F.col("gone"), code * 4 + fault)))


def audit_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                        text: str = "text", gone: Column | None = None) -> DataFrame:
    """One row per conversation: conv, rows, gaps, blank, duplicate, truncated, illegal, cost, audit.

    A row where ``gone`` holds names its conversation and is no row of it."""
    rows = faults(_rows(turns, conv, turn, role, text, gone))
    ordered = rows.sortWithinPartitions("conv", "gone", F.asc_nulls_first("turn"), "role", "text", "earlier")
    kind = rows.schema["conv"].dataType.simpleString()
    fields = ", ".join(f"{c} long" for c in STATS)
    return ordered.select("conv", "kind", "turn").mapInArrow(_audits, f"conv {kind}, {fields}, audit string")


def _with_audits(turns: DataFrame, audits: DataFrame, names: tuple, gone: Column | None) -> DataFrame:
    """(conv, audit, role, text): every conversation's audit, then its rows in order."""
    rows = _rows(turns, *names, gone).filter(~F.col("gone"))
    null = F.lit(None)
    heads = audits.select("conv", F.lit(0).alias("part"), null.cast("long").alias("turn"), null.cast("string").alias("role"),
                          null.cast("string").alias("text"), "audit")
    both = heads.unionByName(rows.select("conv", F.lit(1).alias("part"), "turn", "role", "text",
                                         null.cast("string").alias("audit")))
    return (both.repartition("conv").sortWithinPartitions("conv", "part", F.asc_nulls_first("turn"), "role", "text")
            .select("conv", "audit", "role", "text"))


def repair_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", gone: Column | None = None) -> DataFrame:
    """The repaired turns: conv, position, role, text, edit (I, K or R)."""
    audits = stored(audit_conversations(turns, conv, turn, role, text, gone), "repair-audits")
    kind = audits.schema["conv"].dataType.simpleString()
    return _with_audits(turns, audits, (conv, turn, role, text), gone).mapInArrow(
        _repaired, f"conv {kind}, position long, role string, text string, edit string")


def repair_digests(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text", gone: Column | None = None) -> DataFrame:
    """``audit_conversations`` and repaired_sha256, the digest of the repaired ``role:text`` lines."""
    audits = stored(audit_conversations(turns, conv, turn, role, text, gone), "repair-audits")
    kind = audits.schema["conv"].dataType.simpleString()
    digests = _with_audits(turns, audits, (conv, turn, role, text), gone).mapInArrow(
        _digests, f"conv {kind}, sha256 string")
    found = digests.select(F.col("conv").alias("_conv"), F.col("sha256").alias("repaired_sha256"))
    return audits.join(found, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")
