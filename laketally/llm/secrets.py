r"""Secret scans: all rules in one automaton, one pass over the bytes.

The rules are parsed into one nondeterministic automaton that may begin a match
anywhere; subset construction makes it deterministic, merging equivalent states
makes it small, and bytes that no rule tells apart share a column. The
transition array then runs over many texts in step: texts are cut into lanes of
equal length, all lanes move one byte at a time, and a lane that began in the
wrong state (its predecessor ended elsewhere) runs again, so no match is lost
at a cut. What the pass finds is the first end of each match; a small automaton
of the rule alone then gives the start and the longest end.

Rules have their spans by the leftmost match, without overlap, per kind.
`assign`, `access` and `hex` are the base kinds; the others are added. Spans
count code points, the end exclusive, and are ordered by start, then by kind as
listed.

Rule syntax: literals, `\` escapes, `\xNN`, `[...]` with ranges, `(a|b)`, `?`,
`*`, `+`, `{m}`, `{m,}` and `{m,n}`, and a leading `(?i)` for ASCII letters of
either case.

Nulls and odd rows: a null or empty text has no spans. Repeated rows are each
scanned; a null doc_id is kept; an empty table gives an empty result.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laketally.llm import text as T

#: Kind, rule, and the least size of a match, for an assignment of its value. A
#: shorter match is dropped but still takes up its place. Sizes are not counted in
#: the automaton (but for hex), where counters of several rules would multiply.
RULES = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", 6),
    ("access", r"AKIA[A-Z0-9]+", 20),
    ("hex", r"[0-9a-f]{24,}", 24),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    ("private", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", 0),
)
KINDS = tuple(kind for kind, _, _ in RULES)
BASE = KINDS[:3]
LANE = 1024


class Nfa:
    """States with moves on sets of bytes and free moves."""

    def __init__(self):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, rule: str) -> tuple[int, int]:
        """The first and last state of a rule."""
        fold = rule.startswith("(?i)")
        return _Parser(self, rule[4:] if fold else rule, fold).alternatives()


class _Parser:
    def __init__(self, nfa: Nfa, rule: str, fold: bool):
        self.nfa, self.rule, self.fold, self.at = nfa, rule, fold, 0

    def peek(self) -> str:
        return self.rule[self.at : self.at + 1]

    def alternatives(self) -> tuple[int, int]:
        first, last = self.nfa.state(), self.nfa.state()
        while True:
            a, b = self.sequence()
            self.nfa.free[first].append(a)
            self.nfa.free[b].append(last)
            if self.peek() != "|":
                return first, last
            self.at += 1

    def sequence(self) -> tuple[int, int]:
        first = last = self.nfa.state()
        while self.peek() not in ("", "|", ")"):
            begin = self.at
            self.item()  # a first look, for where it ends; its states stay unused
            least, most = self.times()
            after = self.at
            for i in range(least if most is None else most):
                self.at = begin
                a, b = self.item()
                self.nfa.free[last].append(a)
                if i >= least:
                    self.nfa.free[a].append(b)
                last = b
            if most is None:
                self.at = begin
                a, b = self.item()
                loop = self.nfa.state()
                self.nfa.free[last].append(loop)
                self.nfa.free[loop].append(a)
                self.nfa.free[b].append(loop)
                last = loop
            self.at = after
        return first, last

    def times(self) -> tuple[int, int | None]:
        sign = self.peek()
        if sign and sign in "?*+":
            self.at += 1
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
        if sign == "{":
            inner, _, _ = self.rule[self.at + 1 :].partition("}")
            self.at += len(inner) + 2
            least, comma, most = inner.partition(",")
            return int(least), int(most) if most else None if comma else int(least)
        return 1, 1

    def item(self) -> tuple[int, int]:
        if self.peek() == "(":
            self.at += 1
            found = self.alternatives()
            self.at += 1
            return found
        first, last = self.nfa.state(), self.nfa.state()
        self.nfa.moves[first].append((self.bytes(), last))
        return first, last

    def one(self) -> int:
        c = self.rule[self.at]
        self.at += 1
        if c == "\\":
            c = self.rule[self.at]
            self.at += 1
            if c == "x":
                self.at += 2
                return int(self.rule[self.at - 2 : self.at], 16)
        return ord(c)

    def bytes(self) -> frozenset[int]:
        found = set()
        if self.peek() == "[":
            self.at += 1
            while self.peek() != "]":
                low = high = self.one()
                if self.peek() == "-" and self.rule[self.at + 1] != "]":
                    self.at += 1
                    high = self.one()
                found |= set(range(low, high + 1))
            self.at += 1
        else:
            found.add(self.one())
        if self.fold:
            found |= {ord(chr(b).swapcase()) for b in found if chr(b).isascii() and chr(b).isalpha()}
        return frozenset(found)


@dataclass(frozen=True)
class Dfa:
    """`moves[state * classes + column[byte]]` is the next state times `classes`.

    States that accept come last, from `accept_from` on; `accepts[state]` has a
    bit for each rule. State 0 is the first. A dead state, if any, is `dead`.
    """

    moves: np.ndarray
    column: np.ndarray
    classes: int
    accepts: np.ndarray
    accept_from: int
    dead: int


def compiled(rules: list[str], anywhere: bool) -> Dfa:
    """Subset construction over the rules, then minimisation.

    `anywhere` lets a match begin at every byte.
    """
    nfa, starts, ends = Nfa(), [], {}
    for k, rule in enumerate(rules):
        first, last = nfa.add(rule)
        starts.append(first)
        ends[last] = k
    column, examples = _classes(nfa)
    moves, accepts = _subsets(nfa, starts, ends, examples, anywhere)
    group = _merged(moves, accepts)
    order = sorted(set(group), key=lambda g: (g != group[0], accepts[group.index(g)]))
    if accepts[0]:
        raise ValueError("a rule matches the empty text")
    rank = {g: i for i, g in enumerate(order)}
    table = np.zeros((len(order), len(examples)), np.int32)
    bits = np.zeros(len(order), np.int64)
    for g, i in rank.items():
        state = group.index(g)
        table[i] = [rank[group[t]] for t in moves[state]]
        bits[i] = accepts[state]
    stuck = [i for i in range(len(order)) if not bits[i] and (table[i] == i).all()]
    return Dfa((table * len(examples)).ravel(), column, len(examples), bits, int((bits == 0).sum()), stuck[0] if stuck else -1)


def _classes(nfa: Nfa) -> tuple[np.ndarray, list[int]]:
    """Bytes that no move tells apart, and one byte of each class."""
    sets = list(dict.fromkeys(s for moves in nfa.moves for s, _ in moves))
    signs = [tuple(b in s for s in sets) for b in range(256)]
    known = {sign: i for i, sign in enumerate(dict.fromkeys(signs))}
    return np.array([known[s] for s in signs], np.uint8), [signs.index(s) for s in known]


def _subsets(nfa: Nfa, starts: list[int], ends: dict[int, int], examples: list[int], anywhere: bool):
    def closed(states) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in nfa.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    begin = closed(starts)
    number, queue, moves, accepts = {begin: 0}, [begin], [], []
    for states in queue:  # grows
        accepts.append(sum(1 << k for last, k in ends.items() if last in states))
        row = []
        for b in examples:
            to = closed({t for s in states for some, t in nfa.moves[s] if b in some} | (set(starts) if anywhere else set()))
            if to not in number:
                number[to] = len(queue)
                queue.append(to)
            row.append(number[to])
        moves.append(row)
    return moves, accepts


def _merged(moves: list[list[int]], accepts: list[int]) -> list[int]:
    """The class of equivalent states of each state, by refining what they accept."""
    group = accepts
    while True:
        signs = [(g, *(group[t] for t in row)) for g, row in zip(group, moves, strict=True)]
        known = {sign: i for i, sign in enumerate(dict.fromkeys(signs))}
        if len(known) == len(set(group)):
            return [known[s] for s in signs]
        group = [known[s] for s in signs]


@dataclass(frozen=True)
class Scanner:
    """The automaton of all rules, and for each rule one forwards and one backwards."""

    together: Dfa
    forwards: tuple[Dfa, ...]
    backwards: tuple[Dfa, ...]


def scanner(rules=RULES) -> Scanner:
    patterns = [rule for _, rule, _ in rules]
    return Scanner(compiled(patterns, True), tuple(compiled([p], False) for p in patterns), tuple(_reversed(p) for p in patterns))


def _reversed(rule: str) -> Dfa:
    """The automaton of the rule's texts read from their end."""
    nfa, back = Nfa(), Nfa()
    first, last = nfa.add(rule)
    for _ in nfa.moves:
        back.state()
    for s in range(len(nfa.moves)):
        for some, t in nfa.moves[s]:
            back.moves[t].append((some, s))
        for t in nfa.free[s]:
            back.free[t].append(s)
    column, examples = _classes(back)
    moves, accepts = _subsets(back, [last], {first: 0}, examples, False)
    stuck = [i for i, row in enumerate(moves) if not accepts[i] and all(t == i for t in row)]
    table = np.array(moves, np.int32) * len(examples)
    return Dfa(table.ravel(), column, len(examples), np.array(accepts), 0, stuck[0] if stuck else -1)


def hits(data: np.ndarray, at: np.ndarray, dfa: Dfa) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in `data`, after the last byte) where a rule accepts, and the rules' bits."""
    sizes = np.diff(at)
    lanes = -(-sizes // LANE)
    total = int(lanes.sum())
    if total == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = np.concatenate(([0], np.cumsum(lanes)))
    doc = np.repeat(np.arange(len(sizes)), lanes)
    begin = at[doc] + (np.arange(total) - head[doc]) * LANE
    length = np.minimum(LANE, at[doc + 1] - begin)
    follows = np.arange(total) != head[doc]
    order = np.argsort(-length, kind="stable")  # so the lanes still running come first
    column = dfa.column[data]
    start = np.zeros(total, np.int64)
    ends = np.zeros(total, np.int64)
    run, least = order, dfa.accept_from * dfa.classes
    kept_where, kept_lane, kept_state = [], [], []
    while len(run):
        state, first = start[run].copy(), begin[run]
        size = length[run]
        live = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right")
        where, lane, states = [], [], []
        for i in range(int(size[0])):
            n = live[i]
            now = dfa.moves[state[:n] + column[first[:n] + i]]
            state[:n] = now
            if now.max() >= least:
                some = np.flatnonzero(now >= least)
                where.append(first[some] + i + 1)
                lane.append(run[some])
                states.append(now[some])
        ends[run] = state
        again = np.isin(np.concatenate(kept_lane) if kept_lane else np.zeros(0, np.int64), run)
        if again.any():
            kept_where, kept_lane, kept_state = ([np.concatenate(x)[~again]] for x in (kept_where, kept_lane, kept_state))
        kept_where, kept_lane, kept_state = kept_where + where, kept_lane + lane, kept_state + states
        true = np.where(follows, np.concatenate(([0], ends[:-1])), 0)
        changed = true != start
        start = true
        run = order[changed[order]]
    if not kept_where:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    where = np.concatenate(kept_where)
    by = np.argsort(where, kind="stable")
    return where[by], dfa.accepts[np.concatenate(kept_state)[by] // dfa.classes]


def _walk(dfa: Dfa, data: bytes, at: int, end: int, step: int) -> int:
    """The farthest place from `at` towards `end` where the automaton accepts, or -1."""
    state, farthest, moves, column, dead = 0, -1, dfa.moves, dfa.column, dfa.dead * dfa.classes
    while at != end:
        byte = data[at if step > 0 else at - 1]
        state = moves[state + column[byte]]
        if state == dead:
            break
        at += step
        if dfa.accepts[state // dfa.classes]:
            farthest = at
    return farthest


def spans(column: pa.Array, scan: Scanner, rules=RULES) -> list[list[tuple[int, int, int]]]:
    """(rule number, start, end) in bytes of each text, in order of start and rule."""
    data, at = T.flat(column)
    where, bits = hits(data, at, scan.together)
    doc = np.searchsorted(at, where, side="left") - 1
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(at) - 1)]
    done: dict[tuple[int, int], int] = {}
    texts: dict[int, bytes] = {}
    for end, mask, d in zip(where.tolist(), bits.tolist(), doc.tolist(), strict=True):
        for k in range(len(rules)):
            if not mask >> k & 1 or end - at[d] <= done.get((d, k), 0):
                continue
            if d not in texts:
                texts = {d: data[at[d] : at[d + 1]].tobytes()}
            text = texts[d]
            start = _walk(scan.backwards[k], text, end - int(at[d]), done.get((d, k), 0), -1)
            if start < 0:
                continue
            last = _walk(scan.forwards[k], text, start, len(text), 1)
            done[d, k] = last
            size = _value(text, start, last) if rules[k][0] == "assign" else last - start
            if size < rules[k][2]:
                continue
            found[d].append((k, start, last))
    for some in found:
        some.sort(key=lambda s: (s[1], s[0]))
    return found


def _value(text: bytes, start: int, last: int) -> int:
    """The size of what an assignment's sign is followed by."""
    sign = next(i for i in range(start, last) if text[i] in b":=")
    value = sign + 1
    while text[value] == 32:
        value += 1
    value += text[value] in b"\"'"
    return last - value


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def located(column: pa.Array, scan: Scanner, rules=RULES) -> list[list[dict]]:
    """The spans of each text in code points."""
    data, at = T.flat(column)
    out = []
    for d, some in enumerate(spans(column, scan, rules)):
        if some:
            whole = data[at[d] : at[d + 1]]
            lead = np.concatenate(([0], np.cumsum((whole & 0xC0) != 0x80)))
            some = [{"kind": rules[k][0], "start": int(lead[a]), "end": int(lead[b])} for k, a, b in some]
        out.append(some)
    return out


def find(docs: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, spans) of every row: an array of (kind, start, end) in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(_plain(scanner(rules)))  # some hundred kB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(shared.value)
        for batch in batches:
            for part in T.slices(batch):
                found = pa.array(located(part.column("text"), scan, rules), SPANS)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), found], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, mark: str = "[SECRET]", rules=RULES) -> DataFrame:
    """All rows and columns, each stretch of spans in `text` replaced by `mark`.

    `n_chars`, where there is such a column, is that of the new text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_plain(scanner(rules)))
    names = docs.columns

    def clean(text: bytes, some: list[tuple[int, int, int]]) -> str:
        out, last = [], -1
        for _, a, b in some:
            if a > last:
                out += [text[max(last, 0) : a], mark.encode()]
            last = max(last, b)
        return b"".join([*out, text[max(last, 0) :]]).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(shared.value)
        for batch in batches:
            for part in T.slices(batch):
                column = part.column("text")
                found = spans(column, scan, rules)
                if any(found):
                    texts = column.to_pylist()
                    for d, some in enumerate(found):
                        if some:
                            texts[d] = clean(texts[d].encode(), some)
                    part = part.set_column(names.index("text"), "text", pa.array(texts, column.type))
                yield part

    cleaned = docs.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size))
    return cleaned


def _plain(scan: Scanner) -> tuple:
    return tuple([tuple(vars(d).values()) for d in some] for some in ((scan.together,), scan.forwards, scan.backwards))


def _scanner(plain: tuple) -> Scanner:
    (together,), forwards, backwards = ([Dfa(*d) for d in some] for some in plain)
    return Scanner(together, tuple(forwards), tuple(backwards))


def digest(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: counts and spans of all documents."""
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s.kind.isin(*BASE))
    counts = [F.size(F.expr(f"filter(spans, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    return redact(docs)
