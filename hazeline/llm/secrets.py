"""Secret scans: base rules, and probabilistic automata inferred from what they find.

The base rules label credentials. From all their distinct values, one automaton
a kind is inferred by state merging: a prefix tree with counts, whose states are merged
while their outgoing and stopping frequencies are compatible by Hoeffding's bound. Prefixes
are counted by a shuffle; one that a single value has is compatible with any state by that
bound, and leads back to the first. All values are then counted, and rated, on the automaton. Every
candidate (a long run of credential characters outside the base spans) is scored by
the likelihood of its format against a letter model of ordinary long words; what is as
likely as the labelled values themselves becomes a further span.

Null texts count as empty. Repeated rows, null ids and extra columns have no influence
on a row's spans, as the values that count are distinct. Without any labelled value, as in an empty table, there are no automata and
no further spans. Texts and values of any length are read in full; a candidate has 16
characters or more, as shorter runs are mostly words. Offsets are code points. Values are in
no table that is written: they are kept by the executors while they are counted. What comes to
the driver are hashes and counts of the prefixes that two values share, and the characters behind.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import session_limits, slices, table

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run either way
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
KINDS = ("assign", "access", "hex", "format")
ALPHA, SMOOTH, MARGIN = 0.05, 0.01, 0.35


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the base rules' matches, in order."""
    found = []
    low = text.lower()
    if any(w in low for w in ("password", "passwd", "secret", "token", "api")):
        found += [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, value) of the runs that no base span overlaps."""
    out, i = [], 0
    spans = sorted((s, e) for s, _, e, _ in base)
    reach = 0
    for m in RUN.finditer(text):
        while i < len(spans) and spans[i][0] < m.end():
            reach = max(reach, spans[i][1])
            i += 1
        if reach <= m.start():
            out.append((m.start(), m.end(), m.group()))
    return out


ROOT, NOWHERE = 0, -1


class Automaton:
    """A probabilistic automaton by state merging of a prefix tree."""

    def __init__(self, values: list[str], alpha: float = ALPHA):
        #: state -> symbol -> [count, next state]; visits and stops of a state
        self.go: list[dict[str, list]] = [{}]
        self.visits, self.stops = [0], [0]
        for v in values:
            s = 0
            self.visits[0] += 1
            for c in v:
                if c not in self.go[s]:
                    self.go[s][c] = [0, len(self.go)]
                    self.go.append({})
                    self.visits.append(0)
                    self.stops.append(0)
                self.go[s][c][0] += 1
                s = self.go[s][c][1]
                self.visits[s] += 1
            self.stops[s] += 1
        if values:
            self._inferred(alpha)
            per = [self.rate(v) for v in values]
            self.rated(len(per), sum(per), sum(x * x for x in per))

    def _inferred(self, alpha: float) -> None:
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge()
        self.symbols = len({c for s in self.go for c in s}) or 1

    @classmethod
    def of_prefixes(cls, rows: list[tuple[int, int, str, int, int]], n: int, empty: int = 0, alpha: float = ALPHA) -> Automaton:
        """From node, parent, last character, count and stops of prefixes; those of one value may only be leaves. n: values."""
        a = cls([])
        number = {ROOT: 0}
        for node, _, _, visits, stops in rows:
            if visits > 1:
                number[node] = len(a.go)
                a.go.append({})
                a.visits.append(visits)
                a.stops.append(stops)
        a.visits[0], a.stops[0] = n, empty
        for node, parent, c, visits, _ in rows:
            a.go[number[parent]][c] = [visits, number.get(node, NOWHERE)]
        a._inferred(alpha)
        return a

    def recounted(self, rows: list[tuple[int, str, int]]) -> None:
        """Take the counts state, character, n of all values; an empty character stands for a stop."""
        self.go = [{c: [0, t] for c, (_, t) in edges.items()} for edges in self.go]
        self.visits, self.stops = [0] * len(self.go), [0] * len(self.go)
        for s, c, n in rows:
            self.visits[s] += n
            if c:
                self.go[s].setdefault(c, [0, s])[0] += n
            else:
                self.stops[s] += n
        self.symbols = len({c for s in self.go for c in s}) or 1

    def rated(self, n: int, total: float, squares: float) -> None:
        """Set the floor from the number of all values, and the sums of their rates and of the squares."""
        mean = total / n
        self.floor = mean - MARGIN - 2 * math.sqrt(max(0.0, squares / n - mean * mean))

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return n1 > 0 and n2 > 0 and abs(f1 / n1 - f2 / n2) > self.bound * (n1**-0.5 + n2**-0.5)

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if self._differ(self.stops[x], self.visits[x], self.stops[y], self.visits[y]):
                return False
            for c in self.go[x].keys() | self.go[y].keys():
                p, q = self.go[x].get(c), self.go[y].get(c)
                if self._differ(p[0] if p else 0, self.visits[x], q[0] if q else 0, self.visits[y]):
                    return False
                if p and q and NOWHERE not in (p[1], q[1]):
                    todo.append((p[1], q[1]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree under ``b`` to ``a``."""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            self.visits[x] += self.visits[y]
            self.stops[x] += self.stops[y]
            for c, (n, t) in self.go[y].items():
                if c in self.go[x]:
                    self.go[x][c][0] += n
                    if self.go[x][c][1] == NOWHERE:
                        self.go[x][c][1] = t
                    elif t != NOWHERE:
                        todo.append((self.go[x][c][1], t))
                else:
                    self.go[x][c] = [n, t]

    def _merge(self) -> None:
        red = [0]
        while True:
            known = {*red, NOWHERE}
            blue = min(((-self.go[r][c][0], r, c) for r in red for c in self.go[r] if self.go[r][c][1] not in known), default=None)
            if blue is None:
                break
            _, r, c = blue
            b = self.go[r][c][1]
            for a in red:
                if self._compatible(a, b):
                    self.go[r][c][1] = a
                    self._fold(a, b)
                    break
            else:
                red.append(b)
        number = {s: i for i, s in enumerate(red)} | {NOWHERE: 0}
        self.go = [{c: [n, number[t]] for c, (n, t) in self.go[s].items()} for s in red]
        self.visits, self.stops = [self.visits[s] for s in red], [self.stops[s] for s in red]

    def rate(self, value: str) -> float:
        """Log likelihood a character, the stop left out; unseen symbols keep a little mass and the state."""
        s, total = 0, 0.0
        for c in value:
            edge, n = self.go[s].get(c), self.visits[s] - self.stops[s]
            total += math.log(((edge[0] if edge else 0) + SMOOTH) / (n + SMOOTH * (self.symbols + 64)))
            if edge:
                s = edge[1]
        return total / max(1, len(value))


class Letters:
    """Pairs of characters in ordinary runs."""

    def __init__(self, values: list[str]):
        self.pairs, self.firsts = Counter(), Counter()
        for v in values:
            self.pairs.update(zip("^" + v, v))
        for (a, _), n in self.pairs.items():
            self.firsts[a] += n

    def rate(self, value: str) -> float:
        total = sum(math.log((self.pairs[a, b] + 0.1) / (self.firsts[a] + 0.1 * 66)) for a, b in zip("^" + value, value))
        return total / max(1, len(value))


class Formats:
    """All automata and the letter model: which values look like credentials."""

    def __init__(self, labelled: dict[int, list[str]], ordinary: list[str]):
        self.kinds = [Automaton(sorted(v)) for k, v in sorted(labelled.items()) if v]
        self.letters = Letters(ordinary)

    @classmethod
    def of(cls, kinds: list[Automaton], pairs: list[tuple[str, str, int]]) -> Formats:
        """Of automata and the counts of the pairs of characters in ordinary runs."""
        formats = cls({}, [])
        formats.kinds = kinds
        for a, b, n in pairs:
            formats.letters.pairs[a, b] += n
            formats.letters.firsts[a] += n
        return formats

    def likely(self, value: str) -> bool:
        """As likely a character as the labelled values of some kind, and more than in a word."""
        word = self.letters.rate(value)
        return any((x := k.rate(value)) >= k.floor and x > word + MARGIN for k in self.kinds)

    def added(self, found: list[tuple[int, int, str]]) -> list[tuple[int, int, int]]:
        return [(s, 3, e) for s, e, v in found if self.likely(v)]


UNIT = 10**7  #: rates are summed as whole multiples of its inverse, in which order has no influence
OTHER = 3  #: kind of the runs that are no labelled value


def values(docs: DataFrame) -> DataFrame:
    """kind, value: the distinct values, within a task, of the base rules and the other runs."""
    session_limits(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 16 << 20):
            found = set()
            for text in batch.column("text").to_pylist():
                own = base_spans(text or "")
                found.update((k, v) for _, k, _, v in own)
                found.update((OTHER, v) for _, _, v in candidates(text or "", own))
            rows = list(found)
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([v for _, v in rows], pa.string())], names=["kind", "value"])

    return docs.select("text").mapInArrow(run, "kind int, value string")


def _counts(values: DataFrame, names: str, of) -> DataFrame:
    """Columns ``names`` (kind and keys) and n: how often ``of`` gives them for the values (kind, value) of a batch, as a Counter."""
    schema = f"{names}, n long"
    kinds = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[x.split()[1]] for x in schema.split(", ")]
    labels = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "value", 1 << 20):
            found = Counter()
            for kind, value in zip(batch.column("kind").to_pylist(), batch.column("value").to_pylist()):
                of(found, kind, value)
            cols = list(zip(*((*key, n) for key, n in found.items()))) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=labels)

    return values.mapInArrow(run, schema).groupBy(*labels[:-1]).agg(F.sum("n").alias("n"))


def _prefixes(found: Counter, kind: int, value: str) -> None:
    """Node (a hash), its parent, the character between, and if the value stops there."""
    h, parent = xxhash.xxh64(), ROOT
    for i, c in enumerate(value, 1):
        h.update(c)
        node = h.intdigest() >> 1
        found[kind, node, parent, c, int(i == len(value))] += 1
        parent = node


def infer(docs: DataFrame) -> Formats:
    """The automata and the letter model of all distinct values."""
    every = values(docs).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        labelled, other = every.where(F.col("kind") != OTHER), every.where(F.col("kind") == OTHER)
        number = {k: n for k, n in labelled.groupBy("kind").count().collect()}
        edges = _counts(labelled, "kind int, node long, parent long, c string, stop int", _prefixes)
        nodes = edges.groupBy("kind", "node", "parent", "c").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("stop")).alias("stops"))
        shared = nodes.where("n > 1").select("kind", F.col("node").alias("parent"))
        top = docs.sparkSession.createDataFrame([(k, ROOT) for k in range(OTHER)], "kind int, parent long")
        tree = nodes.join(shared.unionByName(top), ["kind", "parent"], "left_semi").orderBy("kind", "node").toArrow().to_pylist()
        automata = {k: Automaton.of_prefixes([(r["node"], r["parent"], r["c"], r["n"], r["stops"]) for r in tree if r["kind"] == k], number[k]) for k in sorted(number)}

        def walked(found: Counter, kind: int, value: str) -> None:
            s = 0
            for c in value:
                found[kind, s, c] += 1
                edge = automata[kind].go[s].get(c)
                s = edge[1] if edge else s
            found[kind, s, ""] += 1

        steps = _counts(labelled, "kind int, state int, c string", walked).orderBy("kind", "state", "c").collect()
        for k, a in automata.items():
            a.recounted([(r.state, r.c, r.n) for r in steps if r.kind == k])

        def rates(found: Counter, kind: int, value: str) -> None:
            x = automata[kind].rate(value)
            found[kind, 0] += round(x * UNIT)
            found[kind, 1] += round(x * x * UNIT)

        sums = {(r.kind, r.power): r.n / UNIT for r in _counts(labelled, "kind int, power int", rates).collect()}
        for k, a in automata.items():
            a.rated(number[k], sums[k, 0], sums[k, 1])

        def pairs(found: Counter, kind: int, value: str) -> None:
            found.update(zip("^" + value, value))

        return Formats.of(list(automata.values()), [(r.a, r.b, r.n) for r in _counts(other, "a string, b string", pairs).collect()])
    finally:
        every.unpersist()


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every document."""
    formats = infer(docs)
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 16 << 20):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                base = base_spans(text or "")
                own = [x[:3] for x in base]
                n = Counter(k for _, k, _ in own)
                every = own + formats.added(candidates(text or "", base))
                rows.append((doc_id, n[0], n[1], n[2], hashlib.sha256(_joined(own).encode()).hexdigest(), _joined(every)))
            cols = zip(*rows) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def mask(text: str, spans: list[tuple[int, int, int]], with_: str = "[SECRET]") -> str:
    """``text`` with every maximal stretch of spans replaced."""
    out, at, end = [], 0, -1
    for s, _, e in sorted(spans):
        if s > end:
            out += [text[at:s], with_]
        at = end = max(end, e)
    return "".join(out) + text[max(at, 0) :]


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets of ``text`` masked; a null text stays null, n_chars (if there) follows."""
    formats = infer(docs)
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 16 << 20):
            texts, sizes = [], []
            old = batch.column("n_chars").to_pylist() if "n_chars" in columns else [None] * batch.num_rows
            for text, n in zip(batch.column("text").to_pylist(), old):
                if text:
                    base = base_spans(text)
                    spans = [x[:3] for x in base] + formats.added(candidates(text, base))
                    if spans:
                        text = mask(text, spans)
                        n = len(text)
                texts.append(text)
                sizes.append(n)
            kind = batch.schema.field("n_chars").type if "n_chars" in columns else pa.int64()
            new = {"text": pa.array(texts, pa.string()), "n_chars": pa.array(sizes, kind)}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in columns], names=columns)

    return docs.mapInArrow(run, docs.schema)


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
