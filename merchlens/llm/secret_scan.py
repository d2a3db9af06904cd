"""Secret scans: fixed rules, and formats inferred from what the rules label.

Rules (see `RULES`) give the base spans, leftmost and non-overlapping for each kind, of at least a kind's length. Their values are the
labelled credentials. From a bounded sample of them (at most `per_kind` distinct values of each kind, in the order of a hash) a
probabilistic automaton is inferred for each kind: a prefix tree with counts whose states are merged, in order, when their outgoing
frequencies agree (Hoeffding bound), so that repeats become loops. Symbols are classes of characters.

Candidates are all runs of credential characters from the least labelled length (6) on that touch no base span. A run is scored as a
whole, then without the dots that end a sentence, then behind a leading `name=`, which belongs to the setting and not to its value. A
candidate's likelihood is the probability of all its characters under the automaton, for each symbol on average. The first form whose
likelihood under one of the automata is not below what 99 % of that kind's labelled values reach becomes a span of kind `format`; nothing
else decides. What the values reach is taken from automata of the other half of the values, so that it holds for values not seen.

Nulls: a null text is an empty text without spans. Rows with a null doc_id are scanned like others. No labelled values: no format spans.
Extra columns are not read. Offsets are code points, the end is exclusive.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .text import prepare, slices

# Fixed rules: pattern, group that holds the value, least length of the value.
RULES = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
#: A run of hex digits that is long enough starts and ends where the rule's run does; this finds no short ones.
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = [*RULES, "format"]
LEAST = min(least for _, _, least in RULES.values())
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % LEAST)
_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*=+")
#: Symbols rarer than this share of all pairs are followed by nearly any symbol alike: unlabelled credentials don't make their own pairs ordinary.
RARE = 0.001
#: Distinct runs whose verdict a task remembers, and the length up to which it does.
REMEMBERED, REMEMBERED_LENGTH = 200_000, 64
PER_KIND, ALPHA = 500, 0.05
_FLOOR = math.log(1e-4)


def _class(c: str) -> str:
    if c in "abcdef":
        return "a"
    if "0" <= c <= "9":
        return "0"
    if "a" <= c <= "z":
        return "g"
    return "A" if "A" <= c <= "Z" else c


_SIZE = {"a": 6, "0": 10, "g": 20, "A": 26}


@dataclass
class Automaton:
    """State 0 is the start. step[s][class] = (next state, count); end[s] = values that end in s."""

    step: list[dict[str, tuple[int, int]]] = field(default_factory=lambda: [{}])
    end: list[int] = field(default_factory=lambda: [0])
    least: float = 0.0

    def likely(self, value: str) -> bool:
        """Whether the likelihood reaches `least`; no step raises it, so most words end early."""
        limit = self.least * (len(value) + 1) - 1e-9
        s, total = 0, 0.0
        for c in value:
            to = self.logs[s].get(c)
            if to is None:
                total += _FLOOR
            else:
                total += to[1]
                s = to[0]
            if total < limit:
                return False
        return self.likelihood(value) >= self.least

    @cached_property
    def logs(self) -> list[dict[str, tuple[int, float]]]:
        """By state and character: next state, log-probability."""
        seen = [e + sum(n for _, n in step.values()) for step, e in zip(self.step, self.end)]
        return [
            {c: (step[k][0], math.log(step[k][1] / n / _SIZE.get(k, 1))) for c in _SYMBOLS if (k := _class(c)) in step}
            for step, n in zip(self.step, seen)
        ]

    def likelihood(self, value: str) -> float:
        """Log-probability of the value and its end, for each symbol on average. Unseen steps have a floor and stay in the state."""
        s, total = 0, 0.0
        for c in value:
            k = _class(c)
            seen = self.end[s] + sum(n for _, n in self.step[s].values())
            to = self.step[s].get(k)
            if to is None:
                total += _FLOOR
                continue
            total += math.log(to[1] / seen / _SIZE.get(k, 1))
            s = to[0]
        seen = self.end[s] + sum(n for _, n in self.step[s].values())
        total += math.log(self.end[s] / seen) if self.end[s] else _FLOOR
        return total / (len(value) + 1)


def infer(values: list[str], alpha: float = ALPHA) -> Automaton:
    """The automaton of all values, with the limit that 99 % of them reach under the automaton of the half they are not in."""
    out = merged(values, alpha)
    # A single value has no other half.
    halves = [(merged(values[i::2], alpha), values[1 - i :: 2]) for i in (0, 1)] if len(values) > 1 else [(out, values)]
    reached = sorted(other.likelihood(v) for other, own in halves for v in own)
    out.least = reached[len(reached) // 100] if reached else 0.0
    return out


def merged(values: list[str], alpha: float = ALPHA) -> Automaton:
    """Merge statistically compatible states of the values' prefix tree (red states stay, blue ones are merged or become red)."""
    child: list[dict[str, int]] = [{}]
    passed, end = [0], [0]
    for v in values:
        s = 0
        passed[0] += 1
        for c in v:
            k = _class(c)
            if k not in child[s]:
                child[s][k] = len(child)
                child.append({})
                passed.append(0)
                end.append(0)
            s = child[s][k]
            passed[s] += 1
        end[s] += 1
    spread = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
        return bool(n1 and n2) and abs(f1 / n1 - f2 / n2) > spread * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if differ(end[a], passed[a], end[b], passed[b]):
                return False
            for k in {*child[a], *child[b]}:
                x, y = child[a].get(k), child[b].get(k)
                if differ(count(a, k), passed[a], count(b, k), passed[b]):
                    return False
                if x is not None and y is not None and x != y:
                    todo.append((x, y))
        return True

    taken: dict[tuple[int, str], int] = {}  # steps of merged states, which are no longer the child's own count

    def count(s: int, k: str) -> int:
        if (s, k) in taken:
            return taken[s, k]
        return passed[child[s][k]] if k in child[s] else 0

    def fold(a: int, b: int) -> None:
        """Add the subtree of b to a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            passed[a] += passed[b]
            end[a] += end[b]
            for k, y in child[b].items():
                n = count(b, k)
                if k in child[a]:
                    taken[a, k] = count(a, k) + n
                    todo.append((child[a][k], y))
                else:
                    child[a][k] = y
                    taken[a, k] = n

    red, blue = [0], [(0, k) for k in sorted(child[0])]
    while blue:
        parent, k = blue.pop(0)
        s = child[parent][k]
        if s in red:
            continue
        n = count(parent, k)
        for r in red:
            if compatible(r, s):
                child[parent][k] = r
                taken[parent, k] = n
                fold(r, s)
                break
        else:
            red.append(s)
        blue = [(r, c) for r in red for c in sorted(child[r]) if child[r][c] not in red]
    number = {s: i for i, s in enumerate(red)}
    steps = [{k: (number[t], count(s, k)) for k, t in child[s].items()} for s in red]
    return Automaton(steps, [end[s] for s in red])


def base(text: str) -> list[tuple[int, int, str, str]]:
    """(start, kind number, end, value) of the rules' matches, by start."""
    out = []
    for i, (kind, (pattern, group, least)) in enumerate(RULES.items()):
        for m in (_LONG_HEX if kind == "hex" else pattern).finditer(text):
            if len(m[group]) >= least:
                out.append((m.start(), i, m.end(), m[group]))
    return sorted(out)


_CODES = np.zeros(256, np.int64)  # 0 stands between runs
_CODES[np.frombuffer(_SYMBOLS.encode(), np.uint8)] = np.arange(1, len(_SYMBOLS) + 1)
_CODE = {c: i for i, c in enumerate(_SYMBOLS, 1)}
_WIDTH = len(_SYMBOLS) + 1


def pairs(runs: list[str]) -> np.ndarray:
    """Counts of neighbouring symbols in the runs, with the bounds of a run as symbol 0."""
    code = _CODES[np.frombuffer((" " + " ".join(runs) + " ").encode(), np.uint8)]
    return np.bincount(code[:-1] * _WIDTH + code[1:], minlength=_WIDTH * _WIDTH)


@dataclass
class Formats:
    """Automata by kind; ordinary[a][b] = log-probability of symbol b after a in ordinary runs, None where nothing is known of them."""

    automata: dict[str, Automaton]
    ordinary: list[list[float]] | None = None

    @classmethod
    def of(cls, automata: dict[str, Automaton], counts: np.ndarray) -> Formats:
        table = counts.reshape(_WIDTH, _WIDTH) + 0.5 + RARE * counts.sum() / _WIDTH
        return cls(automata, np.log(table / table.sum(axis=1, keepdims=True)).tolist())

    def holds(self, value: str) -> bool:
        best = max((x.likelihood(value) for x in self.automata.values() if x.likely(value)), default=None)
        if best is None or self.ordinary is None:
            return best is not None
        before, total = 0, 0.0
        for c in value:
            total += self.ordinary[before][_CODE[c]]
            before = _CODE[c]
        return best > (total + self.ordinary[before][0]) / (len(value) + 1)


def likely_part(run: str, model: Formats) -> tuple[int, int] | None:
    """(start, end) in the run of its first form that has a likely format."""
    ends = [len(run), len(run.rstrip("."))] if run[-1] == "." else [len(run)]
    name = _NAME.match(run) if "=" in run else None
    for a, b in [(a, b) for a in ((0, name.end()) if name else (0,)) for b in ends]:
        if b - a >= LEAST and model.holds(run[a:b]):
            return a, b
    return None


def formats(text: str, found: list, model: Formats, known: dict | None = None) -> list[tuple[int, int, str]]:
    """(start, end, value) of candidates whose format is likely; known remembers the verdicts on short runs."""
    out: list[tuple[int, int, str]] = []
    known = {} if known is None else known
    for m in _CANDIDATE.finditer(text) if model.automata else ():
        run = m[0]
        if run in known:
            part = known[run]
        else:
            part = likely_part(run, model)
            if len(run) <= REMEMBERED_LENGTH:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[run] = part
        if part and not any(a < m.end() and m.start() < b for a, _, b, _ in found):
            out.append((m.start() + part[0], m.start() + part[1], run[part[0] : part[1]]))
    return out


def counted(docs: DataFrame) -> DataFrame:
    """(kind, value, n, spot): the rules' values by kind, and as kind `pair` the numbers of the symbol pairs of ordinary runs; one pass."""
    prepare(docs.sparkSession)

    def rows(found: set, ordinary: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(ordinary).tolist()
        kinds, values = [k for k, _ in found] + ["pair"] * len(at), [v for _, v in found] + [str(x) for x in at]
        counts = [1] * len(found) + ordinary[at].tolist()
        return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string()), pa.array(counts, pa.int64())], ["kind", "value", "n"])

    def run(batches):
        ordinary = np.zeros(_WIDTH * _WIDTH, np.int64)
        for part in slices(batches, "text"):
            found = set()
            for t in part.column("text").to_pylist():
                if not t:
                    continue
                own = base(t)
                found |= {(list(RULES)[i], v) for _, i, _, v in own}
                if own:  # ordinary runs touch no base span
                    runs = [m[0] for m in _CANDIDATE.finditer(t) if not any(a < m.end() and m.start() < b for a, _, b, _ in own)]
                else:
                    runs = _CANDIDATE.findall(t)
                if runs:
                    ordinary += pairs(runs)
            yield rows(found, np.zeros(0, np.int64))
        yield rows(set(), ordinary)

    counts = docs.select("text").mapInArrow(run, "kind string, value string, n bigint").groupBy("kind", "value").agg(F.sum("n").alias("n"))
    return stage(counts.withColumn("spot", F.xxhash64("value")), "labelled-values")


def learn(docs: DataFrame, per_kind: int = PER_KIND) -> Formats:
    """Automata of the bounded sample of the rules' values, and the pairs of all ordinary runs."""
    counts = counted(docs)
    automata = {}
    for kind in RULES:
        rows = counts.where(F.col("kind") == kind).orderBy("spot", "value").limit(per_kind).select("value").collect()
        if rows:
            automata[kind] = infer([r["value"] for r in rows])
    ordinary = np.zeros(_WIDTH * _WIDTH, np.int64)
    for r in counts.where("kind = 'pair'").select("value", "n").collect():  # at most _WIDTH * _WIDTH
        ordinary[int(r["value"])] = r["n"]
    return Formats.of(automata, ordinary)


def scan(docs: DataFrame, model: Formats) -> DataFrame:
    """(doc_id, found): found is an array of (start, end, kind, value) by start, then kind as in KINDS."""
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())])

    def one(text: str | None, known: dict) -> list[dict]:
        if not text:
            return []
        found = base(text)
        every = found + [(a, len(RULES), b, v) for a, b, v in formats(text, found, model, known)]
        return [{"start": a, "end": b, "kind": KINDS[i], "value": v} for a, i, b, v in sorted(every)]

    def run(batches):
        known: dict[str, tuple[int, int] | None] = {}
        for part in slices(batches, "text"):
            found = pa.array([one(t, known) for t in part.column("text").to_pylist()], pa.list_(fields))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), found], ["doc_id", "found"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, found array<struct<start:int,end:int,kind:string,value:string>>")
