"""Secrets in text with one automaton for all rules.

Every rule has a head (a regular expression) and a run of value bytes. The rules are parsed into one
nondeterministic automaton, which subset construction and minimisation turn into arrays of transitions.
Texts are cut at bytes that lead back to the start from every state and the pieces are scanned side by
side, one byte of each at a step, for all rules at once. In a piece that reached an accepting state the
exact spans of its rules are walked off with the same construction applied to the rule's head alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import map_texts, small_batches, text_slices


@dataclass(frozen=True)
class SecretRule:
    """``head`` followed by ``value`` bytes; a match needs ``min_value`` of them and ``min_total`` bytes."""

    kind: str
    head: str
    value: str
    min_value: int = 1
    min_total: int = 1
    any_case: bool = False


# Fixed values of the contract.
BASE_RULES = (
    SecretRule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", "[A-Za-z0-9+/_.=-]",
               min_value=6, any_case=True),
    SecretRule("access", "AKIA", "[A-Z0-9]", min_total=20),
    SecretRule("hex", "", "[0-9a-f]", min_value=24),
)
# Published token forms beyond those.
MORE_RULES = (
    SecretRule("github", "gh[opsur]_", "[A-Za-z0-9]", min_value=36),
    SecretRule("slack", "xox[abeprs]-", "[A-Za-z0-9-]", min_value=10),
    SecretRule("google", "AIza", "[A-Za-z0-9_-]", min_value=35),
    SecretRule("stripe", "[rs]k_live_", "[A-Za-z0-9]", min_value=16),
    SecretRule("jwt", "eyJ", "[A-Za-z0-9_.-]", min_value=40),
    SecretRule("private_key", "-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY--", "[-]", min_value=3),
)
RULES = BASE_RULES + MORE_RULES

_PIECE_BYTES = 2048
_SLICE_CHARS = 4_000_000


class _Parser:
    """Literals, classes, groups, ``|``, ``? * +`` and ``{m,}`` into a nondeterministic automaton over bytes."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, pattern: str, start: int, any_case: bool) -> int:
        """The pattern from state ``start`` on; returns the state it ends in."""
        self.text, self.at, self.any_case = pattern, 0, any_case
        end = self._either(start)
        if self.at < len(pattern):
            raise ValueError(f"cannot read {pattern!r} at {self.at}")
        return end

    def _peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def _either(self, start: int) -> int:
        end = self.state()
        while True:
            branch = self.state()
            self.empty[start].append(branch)
            self.empty[self._sequence(branch)].append(end)
            if self._peek() != "|":
                return end
            self.at += 1

    def _sequence(self, start: int) -> int:
        while self._peek() not in ("", "|", ")"):
            begin, again = self.at, self.state()
            self.empty[start].append(again)
            end = self._single(again)
            after, mark = self.at, self._peek()
            if mark == "{":
                close = self.text.index("}", self.at)
                count = self.text[self.at + 1:close]
                if not count.endswith(",") or not count[:-1].isdigit():
                    raise ValueError(f"only {{m,}} is known, not {{{count}}}")
                for _ in range(int(count[:-1]) - 1):
                    self.at, again = begin, end
                    end = self._single(again)
                self.at, mark = close, "+"
            if mark in ("*", "+"):
                self.empty[end].append(again)
            if mark in ("?", "*"):
                self.empty[again].append(end)
            self.at = self.at + 1 if mark in ("?", "*", "+") and mark else after
            start = self.state()
            self.empty[end].append(start)
        return start

    def _single(self, start: int) -> int:
        c = self.text[self.at]
        self.at += 1
        if c == "(":
            end = self._either(start)
            self.at += 1
            return end
        allowed = self._class() if c == "[" else {self._byte(c)}
        if self.any_case:
            allowed |= {ord(chr(b).swapcase()) for b in allowed if chr(b).isalpha()}
        end = self.state()
        self.moves[start].append((frozenset(allowed), end))
        return end

    def _byte(self, c: str) -> int:
        if c != "\\":
            return ord(c)
        c = self.text[self.at]
        self.at += 1
        if c != "x":
            return ord(c)
        self.at += 2
        return int(self.text[self.at - 2:self.at], 16)

    def _class(self) -> set[int]:
        found: set[int] = set()
        while (c := self.text[self.at]) != "]":
            self.at += 1
            low = high = self._byte(c)
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 2
                high = self._byte(self.text[self.at - 1])
            found |= set(range(low, high + 1))
        self.at += 1
        return found


@dataclass
class Automaton:
    """``table[state, byte class]`` and what each state accepts, as bits; states that accept come last."""

    classes: np.ndarray
    table: np.ndarray
    accepts: np.ndarray
    start: int
    dead: int | None


def _deterministic(nfa: _Parser, starts: list[int], ends: dict[int, int], search: bool) -> Automaton:
    """Subset construction; with ``search`` a match may begin at every byte."""
    distinct = list({m[0] for moves in nfa.moves for m in moves})
    signature: dict[tuple, int] = {}
    classes = np.array([signature.setdefault(tuple(b in s for s in distinct), len(signature)) for b in range(256)], np.int64)
    sample = [int(np.flatnonzero(classes == c)[0]) for c in range(len(signature))]

    def closed(state: int) -> int:
        """The states reached without a byte, as bits."""
        seen, todo = 1 << state, [state]
        while todo:
            for nxt in nfa.empty[todo.pop()]:
                if not seen >> nxt & 1:
                    seen |= 1 << nxt
                    todo.append(nxt)
        return seen

    reach = [closed(s) for s in range(len(nfa.moves))]
    step = [[0] * len(sample) for _ in nfa.moves]
    for s, moves in enumerate(nfa.moves):
        for allowed, t in moves:
            for c, byte in enumerate(sample):
                if byte in allowed:
                    step[s][c] |= reach[t]
    first = 0
    for s in starts:
        first |= reach[s]
    active = [s for s, moves in enumerate(nfa.moves) if moves]
    numbers, order, rows = {first: 0}, [first], []
    for subset in order:
        row = [first if search else 0] * len(sample)
        for s in active:
            if subset >> s & 1:
                row = [a | b for a, b in zip(row, step[s])]
        for nxt in row:
            if nxt not in numbers:
                numbers[nxt] = len(order)
                order.append(nxt)
        rows.append([numbers[nxt] for nxt in row])
    table = np.array(rows, np.int64)
    accepts = np.array([sum(1 << rule for s, rule in ends.items() if subset >> s & 1) for subset in order], np.int64)
    return _minimal(classes, table, accepts, None if search else numbers.get(0))


def _minimal(classes: np.ndarray, table: np.ndarray, accepts: np.ndarray, dead: int | None) -> Automaton:
    """States are split by what they accept and where they lead until nothing splits any more."""
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    keep = np.unique(finer, return_index=True)[1]
    by_accept = np.argsort(accepts[keep] != 0, kind="stable")
    number = np.empty(len(keep), np.int64)
    number[by_accept] = np.arange(len(keep))
    kept = keep[by_accept]
    return Automaton(classes, number[finer[table[kept]]], accepts[kept], int(number[finer[0]]),
                     None if dead is None else int(number[finer[dead]]))


class Scanner:
    def __init__(self, rules: Sequence[SecretRule]):
        self.rules = tuple(rules)
        both, starts, ends = _Parser(), [], {}
        for i, r in enumerate(self.rules):
            start = both.state()
            starts.append(start)
            # A rule without a head is found by its whole length; for others the head is rare enough.
            need = max(r.min_value, r.min_total) if not r.head else 1
            middle = both.add(r.head, start, r.any_case) if r.head else start
            ends[both.add(f"{r.value}{{{need},}}", middle, False)] = i
        self.automaton = _deterministic(both, starts, ends, search=True)
        self.heads = [self._head(r) for r in self.rules]
        self.values = [self._bytes_of(r.value) for r in self.rules]
        a = self.automaton
        to_start = (a.table == a.start).all(axis=0)
        self.cut_bytes = to_start[a.classes]
        self.width = a.table.shape[1]
        self.steps = (a.table * self.width).astype(np.int32).ravel()
        self.first_accept = int(np.argmax(a.accepts != 0)) * self.width

    @staticmethod
    def _head(rule: SecretRule):
        if not rule.head:
            return None
        nfa = _Parser()
        start = nfa.state()
        end = nfa.add(rule.head, start, rule.any_case)
        a = _deterministic(nfa, [start], {end: 0}, search=False)
        return a.table[:, a.classes].tolist(), a.accepts.tolist(), a.start, a.dead

    @staticmethod
    def _bytes_of(value: str) -> list[bool]:
        nfa = _Parser()
        nfa.add(value, nfa.state(), False)
        allowed = next(m[0] for moves in nfa.moves for m in moves)
        return [b in allowed for b in range(256)]

    def pieces_hit(self, data: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
        """Pieces of ``data`` in which a rule was accepted: first byte, end and rules as bits."""
        n = len(data)
        cuts = np.flatnonzero(self.cut_bytes[data])
        grid = np.searchsorted(cuts, np.arange(_PIECE_BYTES, n, _PIECE_BYTES))
        bounds = np.unique(np.concatenate([starts, cuts[grid[grid < len(cuts)]] + 1, [n]]))
        begin, length = bounds[:-1], np.diff(bounds)
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        symbols = self.automaton.classes[data].astype(np.int32)
        state = np.full(len(begin), self.automaton.start * self.width, np.int32)
        found = np.zeros(len(begin), np.int64)
        alive = np.searchsorted(-length, -np.arange(length[0] if len(length) else 0), side="left")
        for step, rows in enumerate(alive.tolist()):
            state = self.steps[state[:rows] + symbols[begin[:rows] + step]]
            if state.max() >= self.first_accept:
                at = np.flatnonzero(state >= self.first_accept)
                found[at] |= self.automaton.accepts[state[at] // self.width]
        hit = np.flatnonzero(found)
        return list(zip(begin[hit].tolist(), (begin[hit] + length[hit]).tolist(), found[hit].tolist()))

    def spans(self, data: bytes, low: int, high: int, number: int) -> list[tuple[int, int]]:
        """Leftmost spans of one rule that do not overlap; those that are too short still use up their bytes."""
        rule, value, head = self.rules[number], self.values[number], self.heads[number]
        found, at = [], low
        while at < high:
            body = at if head is None else self._head_end(head, data, at, high)
            end = body
            while 0 <= end < high and value[data[end]]:
                end += 1
            if body < 0 or end == body:
                at += 1
                continue
            if end - body >= rule.min_value and end - at >= rule.min_total:
                found.append((at, end))
            at = end
        return found

    @staticmethod
    def _head_end(head, data: bytes, at: int, high: int) -> int:
        table, accepts, state, dead = head
        end = -1
        while at < high:
            state = table[state][data[at]]
            if state == dead:
                break
            at += 1
            if accepts[state]:
                end = at
        return end

    def scan(self, texts: list[str | None]) -> list[list[tuple[str, int, int]]]:
        """Spans of each text in code points, by start and then in the order of the rules."""
        found: list[list] = [[] for _ in texts]
        encoded = [(t or "").encode() for t in texts]
        data = b"".join(encoded)
        if not data:
            return found
        ends = np.cumsum([len(b) for b in encoded])
        starts = ends - [len(b) for b in encoded]
        for low, high, bits in self.pieces_hit(np.frombuffer(data, np.uint8), starts):
            doc = int(np.searchsorted(ends, low, side="right"))
            first = int(starts[doc])
            for number in range(len(self.rules)):
                if bits >> number & 1:
                    found[doc] += [(a - first, number, b - first) for a, b in self.spans(data, low, high, number)]
        return [self._points(spans, body) for spans, body in zip(found, encoded)]

    def _points(self, spans: list, body: bytes) -> list[tuple[str, int, int]]:
        ordered, result, seen, points = sorted(spans), [], 0, 0
        plain = body.isascii()
        for start, number, end in ordered:
            points += start - seen if plain else len(body[seen:start].decode())
            seen = start
            result.append((self.rules[number].kind, points, points + (end - start)))  # spans are ASCII
        return result


@lru_cache(maxsize=4)
def scanner(rules: tuple[SecretRule, ...]) -> Scanner:
    return Scanner(rules)


def find_secrets(df: DataFrame, rules: Sequence[SecretRule] = RULES, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``<key>, spans array<struct<kind, start, end>>`` for every row, over whole texts.

    Offsets count code points, the end is exclusive. Spans of one rule do not overlap; those of two
    rules may. Null and empty texts have none. Repeated rows each get a row; other columns are not read.
    """
    rules = tuple(rules)

    def work(texts):
        return [[[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in scanner(rules).scan(texts)]]

    return map_texts(df, key, text, work, "spans array<struct<kind:string,start:long,end:long>>", _SLICE_CHARS)


def redacted(text: str | None, spans: list[tuple[str, int, int]], mask: str) -> str | None:
    """``text`` with every span, or run of spans that overlap, replaced by ``mask``."""
    if not spans:
        return text
    parts, at, until = [], 0, -1
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start >= until:
            parts += [text[max(at, until) if until >= 0 else at:start], mask]
            at = until = end
        else:
            until = max(until, end)
    return "".join(parts) + text[max(at, until):]


def redact(df: DataFrame, rules: Sequence[SecretRule] = RULES, mask: str = "[secret]", text: str = "text",
           slice_chars: int = 2_000_000) -> DataFrame:
    """``df`` with secrets in ``text`` replaced by ``mask``; all other columns stay.

    Null and empty texts stay as they are, repeated rows stay repeated, an empty table stays empty. A task
    scans about ``slice_chars`` characters at a time; a longer text is scanned alone and whole.
    """
    import pyarrow as pa

    rules, at = tuple(rules), df.columns.index(text)
    small_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            for start, stop, texts in text_slices(batch, at, slice_chars):
                clean = [redacted(t, s, mask) for t, s in zip(texts, scanner(rules).scan(texts))]
                columns = [c.slice(start, stop - start) for c in batch.columns]
                columns[at] = pa.array(clean, batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def report(found: DataFrame, key: str = "doc_id", kinds: Sequence[str] = tuple(r.kind for r in BASE_RULES)) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        key, *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(*kinds))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
