"""Secret scans: all rules in one byte pass of a combined deterministic automaton.

A rule is built from byte classes, sequences, alternatives and repetitions. The rules are
joined in one nondeterministic automaton that may begin a match at every byte; subset
construction makes it deterministic, partition refinement minimal, and bytes that no
transition tells apart share a column of the transition arrays. A text is read once, one
array step per byte, and the accepting states met say which rules match somewhere in it; for
that a rule may end with its shortest match, which keeps the states few.
Only for these rules the places are then read off the rule's own automaton: leftmost,
longest, not overlapping.

For the base rules leftmost-longest equals what a backtracking engine finds: what may
follow a repetition never belongs to the repeated class. The hex rule carries its length in
the automaton, where it changes no match; other lengths are checked after the match.

Defined cases: null text counts as empty; a text without secrets has empty lists; spans
are code points with an exclusive end; repeated rows are scanned row by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import common

# ---- rules ------------------------------------------------------------------------


@dataclass(frozen=True)
class Node:
    """A regular expression: kind 'set' (bytes), 'seq', 'alt', 'star' or 'opt'."""

    kind: str
    parts: tuple = ()
    content: frozenset[int] = frozenset()


def some(content: str | bytes) -> Node:
    """One byte of ``content``; ``a-z`` stands for a range."""
    raw = content.encode() if isinstance(content, str) else content
    out, i = set(), 0
    while i < len(raw):
        if raw[i + 1 : i + 2] == b"-" and i + 2 < len(raw):
            out |= set(range(raw[i], raw[i + 2] + 1))
            i += 3
        else:
            out.add(raw[i])
            i += 1
    return Node("set", content=frozenset(out))


def text(word: str) -> Node:
    return Node("seq", tuple(Node("set", content=frozenset([b])) for b in word.encode()))


def any_case(word: str) -> Node:
    """``word`` with its ASCII letters in either case."""
    sets = [frozenset(c.encode() + c.swapcase().encode()) for c in word]
    return Node("seq", tuple(Node("set", content=s) for s in sets))


def seq(*parts: Node) -> Node:
    return Node("seq", parts)


def alt(*parts: Node) -> Node:
    return Node("alt", parts)


def opt(part: Node) -> Node:
    return Node("opt", (part,))


def star(part: Node) -> Node:
    return Node("star", (part,))


def times(part: Node, least: int) -> Node:
    """``least`` or more."""
    return seq(*[part] * least, star(part))


SPACES = star(some(" "))
QUOTE = opt(some("\"'"))
VALUE = some("A-Za-z0-9+/_.=-")
WORD = some("A-Za-z0-9_-")


def shortest(part: Node) -> Node:
    """``part`` without what may follow its shortest matches; it matches in the same texts."""
    if part.kind != "seq" or not part.parts:
        return part
    *head, last = part.parts
    if last.kind in ("star", "opt"):
        return shortest(Node("seq", tuple(head)))
    return Node("seq", (*head, shortest(last)))


def _long_value(match: bytes) -> bool:
    """The assigned value, after the first ``:`` or ``=``, has 8 characters or more."""
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
    return len(match[at + 1 :].lstrip(b" ").lstrip(b"\"'")) >= 8


def _at_least(size: int) -> Callable[[bytes], bool]:
    return lambda match: len(match) >= size


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: Node
    holds: Callable[[bytes], bool] | None = None


# The base rules.
BASE = (
    Rule(
        "assign",
        seq(
            alt(
                any_case("password"),
                any_case("passwd"),
                any_case("secret"),
                any_case("token"),
                seq(any_case("api"), opt(some("_")), any_case("key")),
            ),
            QUOTE,
            SPACES,
            some(":="),
            SPACES,
            QUOTE,
            times(VALUE, 1),
        ),
        _long_value,
    ),
    Rule("access", seq(text("AKIA"), times(some("A-Z0-9"), 1)), _at_least(16)),
    Rule("hex", times(some("0-9a-f"), 32)),
)

# Lengths are checked after the match: counting several of them at once would multiply
# the states of the combined automaton.
ADDED = (
    Rule("github", seq(text("gh"), some("pousr"), text("_"), times(some("A-Za-z0-9"), 1)), _at_least(24)),
    Rule("slack", seq(text("xox"), some("abprs"), text("-"), times(some("A-Za-z0-9-"), 1)), _at_least(15)),
    Rule(
        "jwt",
        seq(text("eyJ"), times(WORD, 1), text("."), times(WORD, 1), text("."), times(WORD, 1)),
        _at_least(30),
    ),
    Rule(
        "stripe",
        seq(some("rs"), text("k_"), alt(text("live"), text("test")), text("_"), times(some("A-Za-z0-9"), 1)),
        _at_least(24),
    ),
    Rule("pem", seq(text("-----BEGIN "), star(some("A-Z0-9 ")), text("PRIVATE KEY-----"))),
    Rule("bearer", seq(any_case("bearer"), times(some(" "), 1), times(some("A-Za-z0-9._~+/=-"), 1)), _at_least(24)),
)

# ---- automata ---------------------------------------------------------------------


class _Nfa:
    def __init__(self):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.jumps: list[list[int]] = []

    def new(self) -> int:
        self.moves.append([])
        self.jumps.append([])
        return len(self.moves) - 1

    def add(self, node: Node, begin: int) -> int:
        """Wire ``node`` from state ``begin``; returns the state after it."""
        if node.kind == "set":
            end = self.new()
            self.moves[begin].append((node.content, end))
            return end
        if node.kind == "seq":
            for part in node.parts:
                begin = self.add(part, begin)
            return begin
        end = self.new()
        if node.kind == "alt":
            for part in node.parts:
                own = self.new()
                self.jumps[begin].append(own)
                self.jumps[self.add(part, own)].append(end)
            return end
        inner = self.new()
        self.jumps[begin] += [inner, end]
        last = self.add(node.parts[0], inner)
        self.jumps[last] += [end, inner] if node.kind == "star" else [end]
        return end

    def closed(self, states) -> frozenset[int]:
        seen, stack = set(states), list(states)
        while stack:
            for following in self.jumps[stack.pop()]:
                if following not in seen:
                    seen.add(following)
                    stack.append(following)
        return frozenset(seen)


@dataclass
class Automaton:
    """Transition arrays. State 0 is the start; accepting states have the highest numbers."""

    column: bytes  # byte -> column
    rows: list[list[int]]
    accepting: int  # states from here on accept
    accepts: list[int]  # bit set of rules per state
    dead: int  # a state without a way to accept, or -1


def _columns(sets: list[frozenset[int]]) -> tuple[bytes, list[int]]:
    """Bytes that all ``sets`` treat alike share a column: (byte -> column, a byte of each)."""
    keys: dict[tuple, int] = {}
    column, sample = [], []
    for byte in range(256):
        key = tuple(byte in s for s in sets)
        if key not in keys:
            keys[key] = len(keys)
            sample.append(byte)
        column.append(keys[key])
    return bytes(column), sample


def compile_rules(patterns: Sequence[Node], anywhere: bool) -> Automaton:
    """The minimal automaton of all patterns; with ``anywhere`` a match may begin at any byte."""
    nfa = _Nfa()
    root = nfa.new()
    ends = {}
    for number, pattern in enumerate(patterns):
        own = nfa.new()
        nfa.jumps[root].append(own)
        ends[nfa.add(pattern, own)] = number
    column, sample = _columns(sorted({s for own in nfa.moves for s, _ in own}, key=sorted))
    start = nfa.closed([root])
    again = start if anywhere else frozenset()

    def step(states: frozenset[int], byte: int) -> frozenset[int]:
        return nfa.closed({t for s in states for chars, t in nfa.moves[s] if byte in chars}) | again

    known, order, rows = {start: 0}, [start], []
    while len(rows) < len(order):
        states, row = order[len(rows)], []
        live = [s for s in states if nfa.moves[s]]
        for byte in sample:
            target = step(live, byte)
            if target not in known:
                known[target] = len(order)
                order.append(target)
            row.append(known[target])
        rows.append(row)
    accepts = [sum(1 << ends[s] for s in states if s in ends) for states in order]
    return _minimal(column, rows, accepts)


def _minimal(column: bytes, rows: list[list[int]], accepts: list[int]) -> Automaton:
    """Merge states that no continuation tells apart, by refining the partition by acceptance."""
    block = {a: i for i, a in enumerate(sorted(set(accepts)))}
    of = [block[a] for a in accepts]
    count = len(block)
    while True:
        keys: dict[tuple, int] = {}
        new = [keys.setdefault((of[s], *[of[t] for t in rows[s]]), len(keys)) for s in range(len(rows))]
        of = new
        if len(keys) == count:
            break
        count = len(keys)
    one = {b: s for s, b in reversed(list(enumerate(of)))}  # a state of each block
    ranked = sorted(one, key=lambda b: (accepts[one[b]] > 0, b != of[0], b))
    place = {b: i for i, b in enumerate(ranked)}
    out = [[place[of[t]] for t in rows[one[b]]] for b in ranked]
    masks = [accepts[one[b]] for b in ranked]
    dead = [s for s, row in enumerate(out) if not masks[s] and set(row) == {s}]
    return Automaton(column, out, sum(not m for m in masks), masks, dead[0] if dead else -1)


def rules_in(automaton: Automaton, data: bytes) -> int:
    """The rules that match anywhere in ``data``, as a bit set, in one pass over its bytes."""
    rows, accepting, accepts = automaton.rows, automaton.accepting, automaton.accepts
    state = found = 0
    for c in data.translate(automaton.column):
        state = rows[state][c]
        if state >= accepting:
            found |= accepts[state]
    return found


def places(automaton: Automaton, data: bytes) -> list[tuple[int, int]]:
    """Byte spans of the leftmost longest matches of one rule, not overlapping."""
    rows, accepting, dead = automaton.rows, automaton.accepting, automaton.dead
    coded = data.translate(automaton.column)
    begins = [row != dead for row in rows[0]]
    out, at, size = [], 0, len(coded)
    while at < size:
        if not begins[coded[at]]:
            at += 1
            continue
        state, i, end = 0, at, -1
        while i < size:
            state = rows[state][coded[i]]
            if state == dead:
                break
            i += 1
            if state >= accepting:
                end = i
        if end > 0:
            out.append((at, end))
            at = end
        else:
            at += 1
    return out


# ---- operator ---------------------------------------------------------------------


@dataclass
class Scanner:
    rules: tuple[Rule, ...]
    combined: Automaton
    single: list[Automaton]

    @classmethod
    def of(cls, rules: Sequence[Rule]) -> Scanner:
        combined = compile_rules([shortest(r.pattern) for r in rules], True)
        return cls(tuple(rules), combined, [compile_rules([r.pattern], False) for r in rules])

    def spans(self, value: str) -> list[tuple[int, int, int]]:
        """(start, rule number, end) in code points, sorted."""
        data = value.encode()
        found = rules_in(self.combined, data)
        out = []
        for number, rule in enumerate(self.rules):
            if found >> number & 1:
                for begin, end in places(self.single[number], data):
                    if rule.holds is None or rule.holds(data[begin:end]):
                        start = len(data[:begin].decode())
                        out.append((start, number, start + len(data[begin:end].decode())))
        return sorted(out)


def _scan_rows(scanner: Scanner):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [r.kind for r in scanner.rules]
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            column = batch.column(1)
            found = [scanner.spans(column[i].as_py() or "") for i in range(batch.num_rows)]
            rows = [[{"kind": kinds[k], "start": a, "stop": b} for a, k, b in own] for own in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, span)], ["doc_id", "spans"])

    return run


def secrets(docs: DataFrame, rules: Sequence[Rule] = (*BASE, *ADDED)) -> DataFrame:
    """doc_id and spans (kind, start, stop), by start and then by the rules' order."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        _scan_rows(Scanner.of(rules)), f"doc_id {kind}, spans array<struct<kind:string, start:bigint, stop:bigint>>"
    )


def digest(found: DataFrame) -> DataFrame:
    base = [r.kind for r in BASE]
    names = ", ".join(f"'{k}'" for k in base)
    own = F.expr(f"filter(spans, s -> s.kind IN ({names}))")

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
        return F.array_join(parts, ",")

    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in base],
        F.sha2(joined(own), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(secrets(common.table(spark, sf_dir, "documents")))


def digest_of(spans: list[tuple[str, int, int]]) -> str:
    """The digest column's value for given spans; for tests."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
