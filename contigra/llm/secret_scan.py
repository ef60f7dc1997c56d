"""Secret scans by grammar inference over credential formats.

Labelled credentials give one prefix tree a format; statistically compatible states are
merged (Hoeffding bounds on ending and on each symbol, recursively: the ALERGIA rule), first those of one depth, which
pools what was seen of them, then those of any depth, loops included; that leaves a small
probabilistic automaton.  It is inferred on the driver and sent to the tasks.  Symbols are the characters of the format's common beginning and,
after it, character classes whose members are equally likely.  In every maximal run of
credential characters each automaton begins wherever its format's common beginning stands, whatever precedes it (a format
without one: where no character of the format precedes), and walks to its accepting ends.  A part of the run that ends there, is not followed by a character
that the format could go on with, and is no less likely a character, but for a margin, than all but ``quantile`` of the format's
labelled credentials is a span; of parts that overlap, the likeliest.
Spans of the three base patterns always stay; learned spans that overlap a base span are left out.

Defined cases: null text is empty and has no spans; offsets are code points; repeated rows and
null doc_id are scanned like any others; an empty table gives an empty result; other
columns are ignored, or kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from contigra.llm.common import slices

EXAMPLES = 600
ALPHA = 0.001
QUANTILE = 0.01
MARGIN = 0.15
MASK = "<secret>"

#: Public credential formats as (label, parts); a part is a text, or characters with the least and the greatest count.
FORMATS = [
    ("access_id", ["AKIA", ("A-Z0-9", 16, 16)]),
    ("digest", [("0-9a-f", 32, 64)]),
    ("github", ["ghp_", ("A-Za-z0-9", 36, 36)]),
    ("gitlab", ["glpat-", ("A-Za-z0-9_-", 20, 20)]),
    ("google", ["AIza", ("A-Za-z0-9_-", 35, 35)]),
    ("npm", ["npm_", ("A-Za-z0-9", 36, 36)]),
    ("sendgrid", ["SG.", ("A-Za-z0-9_-", 22, 22), ".", ("A-Za-z0-9_-", 43, 43)]),
    ("slack", ["xoxb-", ("0-9", 11, 13), "-", ("0-9", 11, 13), "-", ("A-Za-z0-9", 24, 24)]),
    ("stripe", ["sk_live_", ("A-Za-z0-9", 24, 24)]),
]
#: The base patterns, in the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so this is the run of any length with the short ones left out
KINDS = ("assign", "access", "hex", "grammar")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")

_CLASSES = {"0": "0123456789", "a": "abcdef", "g": "ghijklmnopqrstuvwxyz", "A": "ABCDEF", "G": "GHIJKLMNOPQRSTUVWXYZ"}
_CLASS = {c: f"[{k}]" for k, v in _CLASSES.items() for c in v}
_SIZE = {f"[{k}]": len(v) for k, v in _CLASSES.items()}


def labelled_credentials(n: int = EXAMPLES, seed: int = 1) -> dict[str, list[str]]:
    """Labelled examples of each public format, drawn from a seeded generator."""
    rng, out = random.Random(seed), {}
    for label, parts in FORMATS:
        pools = [p if isinstance(p, str) else ("".join(c for c in map(chr, range(33, 127)) if re.match(f"[{p[0]}]", c)), p[1], p[2]) for p in parts]
        out[label] = ["".join(p if isinstance(p, str) else "".join(rng.choices(p[0], k=rng.choice((p[1], p[2], rng.randint(p[1], p[2]))))) for p in pools) for _ in range(n)]
    return out


class Automaton:
    """A probabilistic automaton inferred from labelled strings."""

    def __init__(self, strings: list[str], alpha: float = ALPHA, quantile: float = QUANTILE):
        first, last = min(strings), max(strings)
        self.prefix = next((first[:i] for i, (a, b) in enumerate(zip(first, last, strict=False)) if a != b), first)
        self.ends: dict[int, int] = defaultdict(int)
        self.visits: dict[int, int] = defaultdict(int)
        self.next: dict[int, dict[str, int]] = {0: {}}
        self.count: dict[int, dict[str, int]] = {0: defaultdict(int)}
        for s in strings:
            state = 0
            self.visits[0] += 1
            for x in self.symbols(s):
                if x not in self.next[state]:
                    new = len(self.next)
                    self.next[state][x], self.next[new], self.count[new] = new, {}, defaultdict(int)
                self.count[state][x] += 1
                state = self.next[state][x]
                self.visits[state] += 1
            self.ends[state] += 1
        self._merge(alpha)
        self._merge_across(alpha)
        self._logs()
        last = {x for p in self.log for x, (q, _) in self.log[p].items() if q in self.end}
        #: Characters that the format could go on with after an end.
        self.tail = {c for c in map(chr, range(33, 127)) if _CLASS.get(c, c) in last}
        scores = sorted(self.score(s) for s in strings)
        self.least = scores[int(quantile * len(scores))] - MARGIN

    def symbols(self, s: str) -> list[str]:
        n = len(self.prefix)
        return [*s[:n], *(_CLASS.get(c, c) for c in s[n:])]

    def _differ(self, a: int, n: int, b: int, m: int, alpha: float) -> bool:
        return bool(n and m) and abs(a / n - b / m) > math.sqrt(0.5 * math.log(2 / alpha)) * (n**-0.5 + m**-0.5)

    def _compatible(self, red: int, blue: int, alpha: float) -> bool:
        stack = [(red, blue)]
        while stack:
            p, q = stack.pop()
            n, m = self.visits[p], self.visits[q]
            if self._differ(self.ends[p], n, self.ends[q], m, alpha):
                return False
            for x in self.count[p].keys() | self.count[q].keys():
                if self._differ(self.count[p].get(x, 0), n, self.count[q].get(x, 0), m, alpha):
                    return False
            stack += [(self.next[p][x], self.next[q][x]) for x in self.next[p].keys() & self.next[q].keys() if self.next[p][x] != p]
        return True

    def _fold(self, red: int, blue: int) -> None:
        stack = [(red, blue)]
        while stack:
            p, q = stack.pop()
            if p == q:
                continue
            self.visits[p] += self.visits[q]
            self.ends[p] += self.ends[q]
            for x, n in list(self.count[q].items()):
                self.count[p][x] += n
                if x in self.next[p]:
                    stack.append((self.next[p][x], self.next[q][x]))
                else:
                    self.next[p][x] = self.next[q][x]

    def _merge(self, alpha: float) -> None:
        """Breadth first: each state below the kept ones is folded into the first compatible one of its depth, or kept.

        States of one depth come first: their pooled counts are what tells a fixed length from a loop.
        """
        level = [0]
        while level:
            kept: list[int] = []
            below = [(p, x) for p in level for x in sorted(self.next[p])]
            for p, x in below:
                q = self.next[p][x]
                if q in kept:
                    continue
                into = next((r for r in kept if self._compatible(r, q, alpha)), None)
                if into is None:
                    kept.append(q)
                else:
                    self._fold(into, q)
                    self.next[p][x] = into
            level = kept

    def _merge_across(self, alpha: float) -> None:
        """Breadth first over what is left: each state is folded into the first compatible kept one of any depth, or kept.

        Folding follows common symbols until the automaton is deterministic again; merged states share a root.
        """
        root = {p: p for p in self.next}

        def find(p: int) -> int:
            while root[p] != p:
                root[p] = p = root[root[p]]
            return p

        def alike(p: int, q: int) -> bool:
            stack, seen = [(p, q)], set()
            while stack:
                p, q = (find(x) for x in stack.pop())
                if p == q or (p, q) in seen:
                    continue
                seen.add((p, q))
                n, m = self.visits[p], self.visits[q]
                if self._differ(self.ends[p], n, self.ends[q], m, alpha):
                    return False
                for x in self.count[p].keys() | self.count[q].keys():
                    if self._differ(self.count[p].get(x, 0), n, self.count[q].get(x, 0), m, alpha):
                        return False
                stack += [(self.next[p][x], self.next[q][x]) for x in self.next[p].keys() & self.next[q].keys()]
            return True

        def fold(p: int, q: int) -> None:
            stack = [(p, q)]
            while stack:
                p, q = (find(x) for x in stack.pop())
                if p == q:
                    continue
                root[q] = p
                self.visits[p] += self.visits[q]
                self.ends[p] += self.ends[q]
                for x, n in self.count[q].items():
                    self.count[p][x] += n
                for x, t in self.next[q].items():
                    if x in self.next[p]:
                        stack.append((self.next[p][x], t))
                    else:
                        self.next[p][x] = t

        kept = [0]
        for p in kept:  # grows
            while True:
                below = [t for x, t in sorted(self.next[find(p)].items()) if find(t) not in map(find, kept)]
                if not below:
                    break
                into = next((r for r in kept if alike(r, below[0])), None)
                if into is None:
                    kept.append(find(below[0]))
                else:
                    fold(into, below[0])
        for p in self.next:
            self.next[p] = {x: find(t) for x, t in self.next[p].items()}

    def _logs(self) -> None:
        """Log probabilities; a class that a state was never left by has half a count spread over the format's classes."""
        used = {x for c in self.count.values() for x in c if x in _SIZE}
        reach, todo = {0}, [0]
        while todo:
            for q in self.next[todo.pop()].values():
                if q not in reach:
                    reach.add(q)
                    todo.append(q)
        self.log: dict[int, dict[str, tuple[int, float]]] = {}
        self.end: dict[int, float] = {}
        for p in reach:
            classes = [x for x in self.count[p] if x in _SIZE]
            missing = used - set(classes) if len(classes) > 1 else set()
            total = self.visits[p] + 0.5 * len(missing)
            go = {x: (q, math.log(self.count[p][x] / total / _SIZE.get(x, 1))) for x, q in self.next[p].items()}
            if missing:
                heir = max(classes, key=lambda x: (self.count[p][x], x))
                go |= {x: (self.next[p][heir], math.log(0.5 / total / _SIZE[x])) for x in missing}
            self.log[p] = go
            if self.ends[p]:
                self.end[p] = math.log(self.ends[p] / total)

    def score(self, s: str) -> float:
        """Log likelihood a character over that of equally likely characters; -inf if the automaton doesn't accept."""
        if not s.startswith(self.prefix):
            return -math.inf
        state, total = 0, 0.0
        for x in self.symbols(s):
            step = self.log[state].get(x)
            if step is None:
                return -math.inf
            state, total = step[0], total + step[1]
        return (total + self.end[state]) / len(s) + math.log(67) if state in self.end else -math.inf

    def parts(self, s: str) -> Iterator[tuple[int, int, float]]:
        """(start, end, score) of the accepted parts of ``s`` that the format could not go on from."""
        n = len(self.prefix)
        starts = [m.start() for m in re.finditer(f"(?={re.escape(self.prefix)})", s)] if n else [i for i in range(len(s)) if not i or s[i - 1] not in self.tail]
        for a in starts:
            state, total = 0, 0.0
            for b in range(a, len(s)):
                step = self.log[state].get(s[b] if b < a + n else _CLASS.get(s[b], s[b]))
                if step is None:
                    break
                state, total = step[0], total + step[1]
                if state in self.end and not (b + 1 < len(s) and s[b + 1] in self.tail):
                    yield a, b + 1, (total + self.end[state]) / (b + 1 - a) + math.log(67)


@lru_cache(maxsize=1)
def automata() -> dict[str, Automaton]:
    """One automaton a format, inferred once on the driver."""
    return {label: Automaton(strings) for label, strings in labelled_credentials().items()}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) of the base patterns."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return sorted(out + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])


def learned_spans(text: str, base: list[tuple[int, int, int]], models: list[Automaton] | None = None) -> tuple[list[tuple[int, int, int]], float | None]:
    """Spans that an automaton finds likely enough and that overlap none of ``base``; the best score of any candidate."""
    out, best = [], None
    models = models or list(automata().values())
    for m in CANDIDATE.finditer(text):
        s, at = m.group(), m.start()
        found = [(score, at + a, at + b, score >= x.least) for x in models for a, b, score in x.parts(s)]
        if not found:
            continue
        top = max(found)[0]
        best = top if best is None else max(best, top)
        own: list[tuple[int, int, int]] = []
        for _, a, b, likely in sorted(found, key=lambda f: (-f[0], f[1], -f[2])):
            if likely and not any(p < b and a < q for p, _, q in base + own):
                own.append((a, 3, b))
        out += sorted(own)
    return out, best


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _sent(docs: DataFrame):
    """The automata as a broadcast: some hundred states each, whatever the table."""
    return docs.sparkSession.sparkContext.broadcast(list(automata().values()))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_grammar, best_score: one row a row of ``docs``."""
    sent = _sent(docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                more, best = learned_spans(text or "", base, sent.value)
                kinds = [k for _, k, _ in base]
                rows.append((*(kinds.count(k) for k in range(3)), hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more), best))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.float64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_grammar", "best_score"])

    thin = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    return thin.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_grammar long, best_score double")


def redacted(text: str, models: list[Automaton] | None = None) -> str:
    """The text with every span, base or learned, replaced by the mask; overlapping spans become one."""
    base = base_spans(text)
    spans = sorted(base + learned_spans(text, base, models)[0])
    if not spans:
        return text
    out, at = [], 0
    merged: list[list[int]] = []
    for a, _, b in spans:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[at:a], MASK]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked in ``text`` and, where there is such a column, n_chars recounted."""
    sent = _sent(docs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            at = batch.schema.get_field_index("text")
            old = batch.column(at).to_pylist()
            new = [None if t is None else redacted(t, sent.value) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if (n := batch.schema.get_field_index("n_chars")) >= 0 and pa.types.is_integer(columns[n].type):
                counts = [len(b) if b is not None and a != b else c for a, b, c in zip(old, new, columns[n].to_pylist(), strict=True)]
                columns[n] = pa.array(counts, columns[n].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
