"""Secrets: fixed patterns, and formats inferred from the credentials they find.

The patterns' matches over all documents are labelled credentials, one label for
each kind.  Of their distinct values a bounded number for each kind (smallest
hashes) trains a probabilistic automaton: values form a prefix tree over character
classes, and states that are statistically compatible are merged, the oldest first.
Two states are compatible if their outgoing frequencies and the lengths that are still
to come agree by Hoeffding's bound, also for all their successors.  States that few
values have passed can't be told apart by frequencies; they are merged only where all
lengths still to come of the rarer one lie within those of the other, so formats of a
fixed length keep it.  A transition's characters have the probabilities seen on it.

Then every token of every text that could be a credential is scored by the mean
log-likelihood of its characters; one that an automaton accepts as readily as the
credentials, by a quantile of the scores of all their distinct values, is a span of
kind ``format``.  Tried are whole runs of credential characters, and what stands
between or behind their separators, as in ``?key=...`` or ``auth=...``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import chunks, utf8
from ledgerloom.session import durable

#: distinct values of each kind that train its automaton at most, and their length in bytes at most
SAMPLE, LONGEST = 1_000, 256
#: confidence of the compatibility test; share of training values that may score below the limit
ALPHA, TAIL = 0.05, 0.01
#: a token is tried from this length on
SHORTEST = 12
#: values on whose frequencies a state is judged; what is added to each character's count
LEAST, SMOOTH = 30, 0.5
KINDS = ["assign", "access", "hex", "format"]

_KEYWORD = re.compile(rb"password|passwd|secret|token|api_?key")
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(rb"[0-9a-f]{16,}")
_TOKEN = re.compile(rb"[A-Za-z0-9+/_.=-]{%d,}" % SHORTEST)
_PART = re.compile(rb"[^/=]+")


def base_spans(text: bytes) -> list[tuple[str, int, int, bytes]]:
    """(kind, start, end, value) in bytes, by start, then kind.

    Patterns of ASCII classes match UTF-8 bytes just as they match characters.  Runs
    of a fixed class can demand their length at once; an assignment that turns out
    too short still uses up its text.
    """
    found = []
    low = text.lower()
    at, end = _KEYWORD.search(low), 0
    while at:
        m = _ASSIGN.match(text, at.start())
        if m:
            if len(m[1]) >= 12:
                found.append((m.start(), 0, m.end(), m[1]))
            end = m.end()
        else:
            end = at.start() + 1
        at = _KEYWORD.search(low, end)
    found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return [(KINDS[k], a, b, v) for a, k, b, v in sorted(found)]


def candidates(text: bytes, taken: list[tuple[str, int, int, bytes]]) -> Iterator[tuple[int, int, memoryview]]:
    """Runs of credential characters that no base span touches, each followed by its parts, longest first.

    Parts lie between the separators / and =, or reach from behind one to the run's end.
    """
    view, starts, furthest, high = memoryview(text), [a for _, a, _, _ in taken], [], 0
    for _, _, z, _ in taken:
        high = max(high, z)
        furthest.append(high)
    for m in _TOKEN.finditer(text):
        a, z = m.span()
        before = bisect_left(starts, z)
        if before and furthest[before - 1] > a:
            continue
        parts = {(a, z)}
        for part in _PART.finditer(text, a, z):
            parts |= {part.span(), (part.start(), z)}
        for x, y in sorted(parts, key=lambda p: (p[0] - p[1], p[0])):
            if y - x >= SHORTEST:
                yield x, y, view[x:y]


def _class(b: int) -> str:
    c = chr(b)
    return "d" if "0" <= c <= "9" else "h" if "a" <= c <= "f" else "l" if "a" <= c <= "z" else "u" if "A" <= c <= "Z" else c


CLASS = [_class(b) for b in range(256)]
#: the characters of each class
MEMBERS = {c: [b for b in range(128) if CLASS[b] == c] for c in set(CLASS[:128])}


@dataclass
class Automaton:
    """step[state][byte] = (next state, log probability); stop[state] = log probability of the end."""

    step: list[dict[int, tuple[int, float]]]
    stop: list[float]
    limit: float = -np.inf

    def score(self, value: bytes | memoryview) -> float:
        """Mean log-likelihood of the characters and the end; minus infinity if it isn't accepted."""
        state, total = 0, 0.0
        for b in value:
            to = self.step[state].get(b)
            if to is None:
                return -np.inf
            state, total = to[0], total + to[1]
        return (total + self.stop[state]) / (len(value) + 1)

    def accepts(self, value: bytes | memoryview) -> bool:
        return -np.inf < (found := self.score(value)) and found >= self.limit


class _Node:
    """A state: values that passed and ended, by class the successor, by byte the values, and by length to come the values."""

    __slots__ = ("child", "depth", "ends", "left", "passes", "taken")

    def __init__(self, depth: int) -> None:
        self.depth, self.passes, self.ends = depth, 0, 0
        self.child: dict[str, _Node] = {}
        self.taken: Counter[int] = Counter()
        self.left: Counter[int] = Counter()

    def flow(self) -> dict[str, int]:
        out: dict[str, int] = defaultdict(int)
        for b, n in self.taken.items():
            out[CLASS[b]] += n
        return out


def _apart(f1: int, n1: int, f2: int, n2: int, bound: float) -> bool:
    return abs(f1 / n1 - f2 / n2) > bound * (n1 ** -0.5 + n2 ** -0.5)


def _lengths_agree(x: _Node, y: _Node, bound: float) -> bool:
    """Whether the same lengths are still to come."""
    if x.passes < y.passes:
        x, y = y, x
    if y.passes < LEAST:
        return min(x.left) <= min(y.left) and max(y.left) <= max(x.left)
    below = [0, 0]
    for size in sorted(x.left.keys() | y.left.keys()):
        below = [below[0] + x.left[size], below[1] + y.left[size]]
        if _apart(below[0], x.passes, below[1], y.passes, bound):
            return False
    return True


def _compatible(x: _Node, y: _Node, bound: float) -> bool:
    if not _lengths_agree(x, y, bound):
        return False
    work = [(x, y)]
    while work:
        x, y = work.pop()
        if _apart(x.ends, x.passes, y.ends, y.passes, bound):
            return False
        f, g = x.flow(), y.flow()
        for c in f.keys() | g.keys():
            if _apart(f.get(c, 0), x.passes, g.get(c, 0), y.passes, bound):
                return False
            if c in x.child and c in y.child and x.child[c] is not y.child[c]:
                work.append((x.child[c], y.child[c]))
    return True


def _fold(to: _Node, tree: _Node) -> None:
    """Add the tree to the state."""
    work = [(to, tree)]
    while work:
        x, y = work.pop()
        x.passes, x.ends = x.passes + y.passes, x.ends + y.ends
        x.taken.update(y.taken)
        x.left.update(y.left)
        for c, below in y.child.items():
            if c in x.child:
                work.append((x.child[c], below))
            else:
                x.child[c] = below


def _shares(taken: Counter[int], group: list[int], bound: float) -> dict[int, float]:
    """Each character's part of its class: as seen where that is far from even, evenly what is left for the others."""
    n = sum(taken[b] for b in group)
    far = {b: taken[b] / n for b in group if abs(taken[b] / n - 1 / len(group)) > bound * n ** -0.5}
    even = len(group) - len(far)
    rest = max(1 - sum(far.values()), SMOOTH * even / (n + SMOOTH * even)) if even else 0.0
    return {b: far[b] or SMOOTH / n if b in far else rest / even for b in group}


def infer(values: list[bytes], alpha: float = ALPHA) -> Automaton | None:
    """An automaton from positive examples, None without any.

    Its limit is the TAIL quantile of their scores, each by an automaton of the other half
    of the examples; of few examples, by their own.
    """
    out = merged_states(values, alpha)
    if out is not None:
        halves = [values[1::2], values[::2]] if len(values) >= 2 * LEAST else [values, values]
        other = [merged_states(h, alpha) for h in halves]
        scores = sorted(x for i, v in enumerate(values) if (x := other[i % 2].score(v)) > -np.inf)
        out.limit = scores[int(TAIL * len(scores))] if scores else -np.inf
    return out


def merged_states(values: list[bytes], alpha: float = ALPHA) -> Automaton | None:
    """An automaton by merging the states of the values' prefix tree, without a limit."""
    if not values:
        return None
    root = _Node(0)
    for v in values:
        at = root
        for i, b in enumerate(v):
            at.passes += 1
            at.taken[b] += 1
            at.left[len(v) - i] += 1
            at = at.child.setdefault(CLASS[b], _Node(i + 1))
        at.passes += 1
        at.ends += 1
        at.left[0] += 1
    bound = float(np.sqrt(0.5 * np.log(2 / alpha)))
    # red states are kept; the children of red states are merged into one of them or become red
    red, kept = [root], {id(root)}
    while blue := [(p, c) for p in red for c, s in sorted(p.child.items()) if id(s) not in kept]:
        p, c = max(blue, key=lambda x: x[0].child[x[1]].passes)
        s = p.child[c]
        # states as deep as this one first: there formats of a fixed length meet
        to = next((r for r in sorted(red, key=lambda r: r.depth != s.depth) if _compatible(r, s, bound)), None)
        if to is None:
            red.append(s)
            kept.add(id(s))
        else:
            p.child[c] = to
            _fold(to, s)
    number = {id(s): k for k, s in enumerate(red)}
    step = []
    for s in red:
        flow, own = s.flow(), {}
        for c, to in s.child.items():
            for b, share in _shares(s.taken, MEMBERS[c], bound).items():
                own[b] = number[id(to)], float(np.log(flow[c] / s.passes * share))
        step.append(own)
    return Automaton(step, [float(np.log(s.ends / s.passes)) if s.ends else -np.inf for s in red])


def _scorer(halves: dict[str, list[Automaton]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(b.column("kind").to_pylist(), b.column("value").to_pylist(), b.column("half").to_pylist(), strict=True)
            yield pa.RecordBatch.from_arrays([b.column("kind"), pa.array([halves[k][1 - h].score(v.encode()) for k, v, h in rows], pa.float64())], ["kind", "score"])

    return run


def learn(docs: DataFrame, text: str = "text", bound: int = SAMPLE) -> dict[str, Automaton]:
    """An automaton for each base kind that the documents have credentials of.

    Each is fitted on at most ``bound`` distinct values of at most LONGEST bytes.  Its
    limit is the TAIL quantile of the scores of all distinct values, each by an automaton
    of the other half of them, as far as that accepts it.  Missing and empty texts and
    repeated rows change nothing; without credentials the result is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "t"):
            data, offsets = utf8(b.column("t"))
            flat, ends = data.tobytes(), offsets.tolist()
            got = {(k, v) for a, z in zip(ends, ends[1:], strict=False) for k, _, _, v in base_spans(flat[a:z])}
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.string()), pa.array([v.decode() for _, v in got], pa.string())], ["kind", "value"])

    found = docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(run, "kind string, value string").distinct()
    values = durable(found.withColumn("half", F.pmod(F.xxhash64("value", F.lit(1)), F.lit(2)).cast("int")))
    out, halves = {}, {}
    for kind in KINDS[:3]:
        rows = values.where((F.col("kind") == kind) & (F.octet_length("value") <= LONGEST)).orderBy(F.xxhash64("value"), "value").limit(bound).collect()
        if made := infer([r.value.encode() for r in rows]):
            out[kind] = made
            halves[kind] = [merged_states([r.value.encode() for r in rows if r.half == h]) for h in (0, 1)]
    if full := {k: h for k, h in halves.items() if all(h)}:
        scores = values.where(F.col("kind").isin(list(full))).mapInArrow(_scorer(full), "kind string, score double").where("score > double('-infinity')")
        for row in scores.groupBy("kind").agg(F.percentile_approx("score", TAIL, 100_000).alias("limit")).collect():
            out[row.kind].limit = row.limit
    return out


def scan(docs: DataFrame, automata: dict[str, Automaton], text: str = "text", out: str = "secrets", clean: bool = False) -> DataFrame:
    """Every row of ``docs`` with its spans: structs of kind, start, end in code points, by start, then kind.

    With ``clean`` the spans are also replaced in the text.  A missing text is empty, has
    none and stays missing.  A column that has the output's name is replaced.
    """
    keep = [c for c in docs.columns if c != out]
    names = [f"c{i}" for i in range(len(keep))]
    own = names[keep.index(text)]
    given = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").alias("t"))
    kinds = dict(given.dtypes)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def spans(raw: bytes) -> list[dict]:
        base = base_spans(raw)
        more: list[tuple[str, int, int]] = []
        for a, b, v in candidates(raw, base):
            # longest first within a run; what overlaps a span of the run is no further one
            before = bisect_left(more, ("format", b, 0))
            if not (before and more[before - 1][2] > a) and any(m.accepts(v) for m in automata.values()):
                more.insert(before, ("format", a, b))
        places = sorted({x for _, a, b, *_ in (*base, *more) for x in (a, b)})
        # bytes to code points
        point, last, seen = {}, 0, 0
        for x in places:
            seen += len(raw[last:x].decode())
            point[x], last = seen, x
        order = sorted((*base, *more), key=lambda s: (s[1], KINDS.index(s[0])))
        return [{"kind": k, "start": point[a], "end": point[b]} for k, a, b, *_ in order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "t"):
            data, offsets = utf8(b.column("t"))
            flat, ends = data.tobytes(), offsets.tolist()
            got = [spans(flat[a:z]) for a, z in zip(ends, ends[1:], strict=False)]
            cols = {n: b.column(n) for n in names}
            if clean:
                cols[own] = pa.array([redact(t, s) if s else t for t, s in zip(b.column("t").to_pylist(), got, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*cols.values(), pa.array(got, pa.list_(span))], [*names, "found"])

    made = given.mapInArrow(run, ", ".join(
        [*(f"{n} {kinds[n]}" for n in names), "found array<struct<kind:string,start:bigint,end:bigint>>"]))
    return made.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], F.col("found").alias(out))


def redact(text: str, spans: list, mark: str = "<SECRET>") -> str:
    """The text with each stretch of overlapping spans replaced."""
    out, done = [], 0
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if a >= done:
            out += [text[done:a], mark]
        done = max(done, b)
    return "".join([*out, text[done:]])
