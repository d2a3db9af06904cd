"""Repair of conversations whose turns don't alternate, by Wagner-Fischer alignment to targets of the grammar (s?(ua)+)?.

Turns are taken by turn number (nulls first), then role, then digest of the text. A turn's first fault counts: blank, duplicate (role
and text stood before), truncated (its last visible character ends no sentence). Edits: keep 0, rerole to user or assistant 1, delete 2
(required for blank and duplicate turns), insert an empty user or assistant turn 5; a truncated turn that stays adds 5. The cheapest edits
that give the grammar win; of equals the one whose audit, the edits' initials D, I, K, R in order, is least.

* A run of turns is aligned to every feasible length of the alternating string (behind a system turn, from user, from assistant). Lengths are tried
  from the nearest on; the cheapest so far is the incumbent: lengths that cannot reach it are skipped, and the tables of the others are
  filled in the Ukkonen band in which a path can still cost as little. Rows of the tables are computed for several lengths at once.
* The tables run from the end, so a walk from the front reads off the least audit of each length; the audits of equal cost are compared.
* Runs longer than PIECE turns are cut. A piece is aligned for every state of the grammar in which it may begin and end; pieces are
  joined by adding costs and audits over the state between them. That is exact, as no two audits of one piece and one pair of states
  with one cost are prefixes of each other.

The light columns (numbers, roles, digests of texts) go through one range sort, so a conversation that holds a third of all
turns is spread over tasks: each gives its states, costs and audits, which meet in one row per slice and conversation. Repeated rows are counted before any of this. Texts move
once, in `repaired`, where a task reads a conversation's turns one after another and holds one of them.

Nulls: a null role or text counts as one space; a null turn sorts first and has no part in gaps; a null conv_id is a conversation of its
own. Turns of equal number, role and text stand next to each other. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import stage
from .text import prepare

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
PIECE = 64  # turns aligned at once
AT_ONCE = 6  # lengths aligned at once
BLANKS = " \t\n\x0b\x0c\r"
_BIG = 1 << 28
_ROLES = "sua?"
_LEGAL = ("su", "ua", "au")

# States of the grammar: 0 nothing yet, 1 behind system, 2 behind user, 3 behind assistant. 0 and 3 may end.
Ways = dict[tuple[int, int], tuple[int, str]]


def _targets(enter: int, upto: int, system: bool) -> Iterator[tuple[str, int]]:
    """Strings of roles that may follow the state, with the state behind them."""
    first = "au" if enter == 2 else "ua"
    for n in range(upto + 1):
        text = (first * (n // 2 + 1))[:n]
        yield text, (2 if text[-1] == "u" else 3) if n else enter
        if enter == 0 and system:
            text = "s" + ("ua" * (n // 2 + 1))[:n]
            yield text, (2 if text[-1] == "u" else 3) if n else 1


def _tables(turns: str, targets: list[str], most: int) -> np.ndarray:
    """cost[i, t, j] of aligning turns[i:] to targets[t][j:], within the band of paths that cost at most `most`."""
    n, size = len(turns), np.array([len(t) for t in targets])
    width = int(size.max())
    code = np.full((len(targets), width), 9, np.int8)
    for k, t in enumerate(targets):
        code[k, : len(t)] = [_ROLES.index(c) for c in t]
    j = np.arange(width + 1)
    cost = np.full((n + 1, len(targets), width + 1), _BIG, np.int32)
    rest = INSERT * (size[:, None] - j)
    cost[n] = np.where(rest >= 0, rest, _BIG)
    begins = code[:, 0] == 0 if width else np.zeros(len(targets), bool)
    cost[n, begins, 0] = _BIG  # a system turn is never inserted
    change = np.where(code == 0, _BIG, np.where(code == 9, _BIG, REROLE)).astype(np.int32)
    least, longest = int(size.min()) - n, int(size.max()) - n
    for i in range(n - 1, -1, -1):
        # A path through (i, j) costs 7 for each step it strays beyond the straight way to its end.
        low = max(0, i - (most - 5 * least) // 7)
        high = min(width, i + (most + 2 * longest) // 7)
        if low > high:
            continue
        c, later = turns[i], cost[i + 1]
        now = later[:, low : high + 1] + DELETE
        to = min(high + 1, width)
        if to > low:
            match = np.where(code[:, low:to] == _ROLES.index(c.lower() if c != "!" else "?"), KEEP, change[:, low:to])
            if c.isupper() or c == "!":
                match = match + TRUNCATED
            now[:, : to - low] = np.minimum(now[:, : to - low], match + later[:, low + 1 : to + 1])
        straight = now[:, 0].copy() if low == 0 else None
        filled = now + INSERT * j[low : high + 1]
        filled = np.minimum.accumulate(filled[:, ::-1], axis=1)[:, ::-1] - INSERT * j[low : high + 1]
        if straight is not None:
            filled[begins, 0] = straight[begins]
        cost[i, :, low : high + 1] = np.minimum(filled, _BIG)
    return cost


def _audit(turns: str, target: str, cost: np.ndarray) -> str:
    """The least audit of the least cost, read from the front of one length's table."""
    out, i, j, n = [], 0, 0, len(turns)
    while i < n or j < len(target):
        here = cost[i, j]
        if i < n and here == cost[i + 1, j] + DELETE:
            out.append("D")
            i += 1
        elif j < len(target) and target[j] != "s" and here == cost[i, j + 1] + INSERT:
            out.append("I")
            j += 1
        else:
            out.append("K" if turns[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return "".join(out)


def _aligned(turns: str, targets: list[str]) -> tuple[int, str] | None:
    """Least cost and audit over the targets; None if no target can be reached."""
    n, best = len(turns), None

    def bound(t: str) -> int:
        return max(INSERT * (len(t) - n), DELETE * (n - len(t)))

    if targets and targets[0] == "":
        best, targets = (DELETE * n, "D" * n), targets[1:]
    todo = sorted(targets, key=lambda t: (bound(t), len(t)))
    for at in range(0, len(todo), AT_ONCE):
        some = [t for t in todo[at : at + AT_ONCE] if best is None or bound(t) <= best[0]]
        if not some:
            break
        cost = _tables(turns, some, _BIG if best is None else best[0])
        for k, t in enumerate(some):
            c = int(cost[0, k, 0])
            if c < _BIG and (best is None or c <= best[0]):
                best = min(x for x in (best, (c, _audit(turns, t, cost[:, k]))) if x is not None)
    return best


def _upto(n: int) -> int:
    """Longer targets cost more than deleting everything and inserting a shortest end."""
    return n + (DELETE * n) // INSERT + 3


@lru_cache(maxsize=1 << 14)
def _whole(turns: str) -> tuple[int, str]:
    """Least cost and audit of a whole conversation."""
    targets = [t for t, leave in _targets(0, _upto(len(turns)), "s" in turns.lower()) if leave in (0, 3)]
    return _aligned(turns, targets)


@lru_cache(maxsize=1 << 10)
def _piece(turns: str) -> tuple[tuple[tuple[int, int], tuple[int, str]], ...]:
    """Least cost and audit for every pair of states around a piece."""
    out: Ways = {}
    for enter in range(4):
        by_leave: dict[int, list[str]] = {}
        for t, leave in _targets(enter, _upto(len(turns)), "s" in turns.lower()):
            by_leave.setdefault(leave, []).append(t)
        for leave, targets in by_leave.items():
            if (found := _aligned(turns, targets)) is not None:
                out[enter, leave] = found
    return tuple(out.items())


def joined(left: Ways, right: Ways) -> Ways:
    """Two pieces that follow each other."""
    out: Ways = {}
    for enter in range(4):
        for leave in range(4):
            over = [(left[enter, m][0] + right[m, leave][0], m) for m in range(4) if (enter, m) in left and (m, leave) in right]
            if over:
                cost = min(over)[0]
                out[enter, leave] = cost, min(left[enter, m][1] + right[m, leave][1] for c, m in over if c == cost)
    return out


def _folded(parts: list[Ways]) -> Ways:
    """All pieces joined, neighbours first, so that audits are copied log(pieces) times."""
    while len(parts) > 1:
        parts = [joined(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0] if parts else {(s, s): (0, "") for s in range(4)}


def _spread(audit: str, gaps: list[int]) -> str:
    """The audit with the required deletions, gaps[i] of them in front of the i-th free turn or, last, behind all."""
    if not any(gaps):
        return audit
    out, i = ["D" * gaps[0]], 0
    for letter in audit:
        out.append(letter)
        if letter != "I":
            i += 1
            out.append("D" * gaps[i])
    return "".join(out)


def ways(turns: list[tuple[str, int]], whole: bool) -> Ways:
    """Costs and audits of turns given as (symbol, required deletions behind it). Symbols: s, u, a, ? (upper case or ! if truncated),
    or x for a turn that must go. whole: only ways from nothing to an accepted end."""
    free, gaps = [], [0]
    for symbol, more in turns:
        if symbol == "x":
            gaps[-1] += 1 + more
        else:
            free.append(symbol)
            gaps.append(more)
    required = DELETE * sum(gaps)
    if whole and len(free) <= PIECE:
        cost, audit = _whole("".join(free))
        return {(0, 3 if audit.strip("D") else 0): (cost + required, _spread(audit, gaps))}
    parts = []
    for at in range(0, max(len(free), 1), PIECE):
        mine = "".join(free[at : at + PIECE])
        front = gaps[at : at + len(mine)] + [gaps[-1] if at + PIECE >= len(free) else 0]
        parts.append({k: (cost + DELETE * sum(front), _spread(audit, front)) for k, (cost, audit) in _piece(mine)})
    out = _folded(parts)
    return {k: v for k, v in out.items() if k in ((0, 0), (0, 3))} if whole else out


def _best(found: Ways) -> tuple[int, str]:
    return min(v for k, v in found.items() if k in ((0, 0), (0, 3)))


PIECES = (
    "slice int, whole boolean, low {t}, high {t}, head {t}, tail {t}, numbers bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, opening string, closing string, ways array<struct<enter:int,leave:int,cost:bigint,audit:string>>"
)


def _light(turns: DataFrame, copies: Column) -> DataFrame:
    """(conv_id, turn, role, key, code, copies) of distinct rows; code is the role's initial + 4 * fault (1 blank, 2 duplicate, 3 truncated)."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    seen = F.rtrim(text, F.lit(BLANKS))
    initial = F.substring(role, 1, 1)
    start = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(seen == "", 1).when(~F.substring(seen, -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    there = turns.select("conv_id", copies.cast("bigint").alias("copies"), "turn", role.alias("role"), text.alias("text"), (start + 4 * fault).alias("code"))
    only = F.col("copies") > 0  # other rows only name their conversation
    rows = there.select(
        "conv_id", F.when(only, F.col("turn")).alias("turn"), F.when(only, F.col("role")).otherwise("").alias("role"),
        F.when(only, F.unhex(F.sha2("text", 256))).otherwise(F.lit(b"")).alias("key"), F.when(only, F.col("code")).otherwise(0).alias("code"), "copies",
    ).groupBy("conv_id", "turn", "role", "key").agg(F.max("code").alias("code"), F.sum("copies").alias("copies"))
    rows = stage(rows, "turns-distinct")
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = (
        rows.where((F.col("copies") > 0) & (F.floor(F.col("code") / 4) != 1)).groupBy("conv_id", "role", "key")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("key").alias("_key"), "first")
    )
    same = rows["conv_id"].eqNullSafe(F.col("_conv")) & (rows["role"] == F.col("_role")) & (rows["key"] == F.col("_key"))
    marked = rows.join(again, same, "left")
    late = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    code = F.when(late & (F.floor(F.col("code") / 4) != 1), F.col("code") % 4 + 8).otherwise(F.col("code"))
    return marked.select("conv_id", "turn", "role", "key", code.cast("int").alias("code"), "copies")


class _Run:
    """Turns of one conversation that follow each other in one slice."""

    def __init__(self, conv, slice_number: int):
        self.conv, self.slice = conv, slice_number
        self.turns: list[tuple[str, int]] = []
        self.low = self.high = self.head = self.tail = None
        self.any = False
        self.numbers = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.opening = self.closing = None

    def add(self, turn, code: int, copies: int) -> None:
        if not copies:
            return
        role, fault = _ROLES[code % 4], code // 4
        if turn is not None:
            if self.low is None:
                self.low = turn
            if self.high is None or turn != self.high:
                self.numbers += 1
            self.high = turn
        if not self.any:
            self.any, self.head = True, turn
        self.tail = turn
        if self.closing is not None and self.closing + role not in _LEGAL:
            self.illegal += 1
        self.illegal += copies - 1
        self.opening, self.closing = self.opening or role, role
        if fault == 1:
            self.blank += copies
            self.turns.append(("x", copies - 1))
        elif fault == 2:
            self.duplicate += copies
            self.turns.append(("x", copies - 1))
        else:
            self.duplicate += copies - 1
            self.truncated += fault == 3
            self.turns.append(((role.upper() if role != "?" else "!") if fault == 3 else role, copies - 1))

    def row(self, whole: bool) -> dict:
        found = ways(self.turns, whole)
        return {
            "conv_id": self.conv, "slice": self.slice, "whole": whole, "low": self.low, "high": self.high, "head": self.head, "tail": self.tail,
            "numbers": self.numbers, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
            "opening": self.opening, "closing": self.closing,
            "ways": [{"enter": e, "leave": x, "cost": c, "audit": a} for (e, x), (c, a) in found.items()],
        }


def _pieces(rows: DataFrame) -> DataFrame:
    """One row per conversation and slice of the range sort. Only a slice's first and last conversations can go on elsewhere."""
    number = rows.schema["turn"].dataType.simpleString()
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, " + PIECES.format(t=number)
    order = ["conv_id", "turn", "role", "key"]
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, run_, first, out = TaskContext.get().partitionId(), None, True, []
        for b in batches:
            for conv, turn, code, copies in zip(*(b.column(k).to_pylist() for k in range(4))):
                if run_ is None or conv != run_.conv:
                    if run_ is not None:
                        out.append(run_.row(not first))
                        first = False
                    run_ = _Run(conv, here)
                run_.add(turn, code, copies)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if run_ is not None:
            out.append(run_.row(False))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv_id", "turn", "code", "copies").mapInArrow(run, schema)


FOUND = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _combined(conv, pieces: list[dict]) -> dict:
    """A conversation from its pieces in order; pieces without turns only name it."""
    pieces = [p for p in pieces if p["opening"] is not None]
    parts = [{(w["enter"], w["leave"]): (w["cost"], w["audit"]) for w in p["ways"]} for p in pieces]
    cost, audit = _best(_folded(parts)) if parts else (0, "")
    numbers = sum(p["numbers"] for p in pieces) - sum(a["tail"] is not None and a["tail"] == b["head"] for a, b in zip(pieces, pieces[1:]))
    low = next((p["low"] for p in pieces if p["low"] is not None), None)
    high = next((p["high"] for p in reversed(pieces) if p["high"] is not None), None)
    illegal = sum(p["illegal"] for p in pieces) + sum(a["closing"] + b["opening"] not in _LEGAL for a, b in zip(pieces, pieces[1:]))
    gaps = 0 if low is None else min(high - low + 1 - numbers, (1 << 63) - 1)
    counts = {c: sum(p[c] for p in pieces) for c in ("blank", "duplicate", "truncated")}
    return {"conv_id": conv, "gaps": gaps, **counts, "illegal": illegal, "cost": cost, "audit": audit}


def audits(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit): a row for each conversation.

    copies: how often a row stands there, one after the other; a row with 0 copies only names its conversation.
    """
    prepare(turns.sparkSession)
    pieces = stage(_pieces(_light(turns, F.lit(1) if copies is None else copies)), "turns-pieces")
    schema = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, {FOUND}"
    names = pieces.columns
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pylist([_combined(p["conv_id"], [p]) for p in b.to_pylist()], schema=arrow)

    def together(parts: pa.Table) -> pa.Table:
        some = sorted(parts.to_pylist(), key=lambda p: p["slice"])
        return pa.Table.from_pylist([_combined(some[0]["conv_id"], some)], schema=arrow)

    whole = pieces.where("whole").mapInArrow(alone, schema)
    split = pieces.where("not whole").select(*names).groupBy("conv_id").applyInArrow(together, schema)
    return whole.unionByName(split)


def repaired(turns: DataFrame, found: DataFrame, copies: Column | None = None) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns of every repaired conversation, in order within a partition; found: of audits().

    edit is K, R or I; deleted turns are left out. A conversation's turns are in one partition, read in order, and not gathered.
    """
    session = turns.sparkSession
    prepare(session)
    kind = turns.schema["conv_id"].dataType.simpleString()
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.lit(1) if copies is None else copies).cast("bigint").alias("copies")).where("copies > 0")
    rows = rows.withColumn("key", F.unhex(F.sha2("text", 256))).withColumn("mark", F.lit(1))
    heads = found.where("audit <> ''").select(
        "conv_id", F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"),
        F.lit(1).cast("bigint").alias("copies"), F.lit(b"").alias("key"), F.lit(0).alias("mark"),
    )
    order = ["conv_id", "mark", "turn", "role", "key"]
    dealt = rows.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order)
    out_schema = f"conv_id {kind}, place bigint, edit string, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, place, end, system = "", 0, 0, 0, False

        def role_at(p: int) -> str:
            return "user" if (p - system) % 2 == 0 else "assistant"

        def inserted(conv) -> Iterator[tuple]:
            nonlocal at, place
            while at < len(audit) and audit[at] == "I":
                yield conv, place, "I", role_at(place), ""
                at, place = at + 1, place + 1

        for b in batches:
            out = []
            for conv, mark, role, text, copies in zip(*(b.column(k).to_pylist() for k in range(5))):
                if mark == 0:
                    audit, at, place, end = text, 0, 0, len(text.rstrip("I"))
                    system = (len(audit) - audit.count("D")) % 2 == 1
                else:
                    for _ in range(copies):
                        out += inserted(conv)
                        edit, at = audit[at], at + 1
                        if edit != "D":
                            out.append((conv, place, edit, role if edit == "K" else role_at(place), text))
                            place += 1
                # Insertions that nothing follows stand behind the last turn.
                if mark and at >= end:
                    out += inserted(conv)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["conv_id", "place", "edit", "role", "text"])

    types = to_arrow_schema(StructType.fromDDL(out_schema)).types
    return dealt.select("conv_id", "mark", "role", "text", "copies").mapInArrow(run, out_schema)
