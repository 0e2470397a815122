"""Secret scan: plain patterns, then formats inferred as probabilistic automata.

Values that the patterns find are labelled credentials. For each kind a prefix tree of a bounded sample of
them is generalised: states whose symbol frequencies are statistically compatible (Hoeffding's bound, down
the whole subtree) are merged, outermost states first, which leaves a deterministic probabilistic automaton
of the format. A further automaton is inferred from strings that no pattern found. Every string that could
be a credential is then scored: one that an automaton of a kind explains as well as that kind's own values,
and far better than the automaton of other strings does, is a secret too, a span of kind `format`.

The fit takes at most `sample` values of each kind, of at most `longest` characters, those whose hashes are
smallest among all documents; everything is scored. Texts are read whole.

Defined cases: a null text is empty and has no spans; repeated rows and ids each get a row; with no
labelled values of a kind, or an empty table, the patterns alone decide. The key and the text alone are
read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, written

#: Kinds in the order of the result; the last one is what the automata add.
KINDS = ("assign", "access", "hex", "format")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: Maximal runs, so the least length may stand in the pattern.
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]{14,}"), re.compile(r"[0-9a-f]{16,}")
#: What could be a credential: a run of the characters that values are made of.
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
#: Symbols of the automata: the characters of a candidate, and the end.
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
END, N_SYMBOLS = len(SYMBOLS), len(SYMBOLS) + 1
_CODE = np.full(256, -1, np.int16)
_CODE[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(END)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, value) of what the patterns find, by start and kind."""
    out = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, spans: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, value) of candidates that meet no span. Spans are sorted by their starts."""
    out, k, reach = [], 0, 0
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        while k < len(spans) and spans[k][0] < b:
            reach = max(reach, spans[k][2])
            k += 1
        if reach <= a:
            out.append((a, b, m[0]))
    return out


# ---- inference


class Automaton:
    """Counts of a deterministic probabilistic automaton, state 0 first: step[q] maps a symbol to (state, count)."""

    def __init__(self, count: list[int], end: list[int], step: list[dict[int, tuple[int, int]]]) -> None:
        self.count, self.end, self.step = count, end, step

    def tables(self, weight: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """(next state, log probability) by state and symbol.

        `weight` sightings are spread over all symbols of each state. A symbol that a state never saw leads
        where most of its symbols lead; from a state without any, to a last one where all symbols are alike.
        """
        q = len(self.count)
        to, p = np.full((q + 1, N_SYMBOLS), q, np.int32), np.full((q + 1, N_SYMBOLS), -math.log(N_SYMBOLS))
        for s in range(q):
            seen = np.full(N_SYMBOLS, weight / N_SYMBOLS)
            seen[END] += self.end[s]
            if self.step[s]:
                to[s] = max(self.step[s].values(), key=lambda x: (x[1], -x[0]))[0]
            for a, (t, n) in self.step[s].items():
                seen[a] += n
                to[s, a] = t
            p[s] = np.log(seen / seen.sum())
        return to, p


def infer(values: list[str], alpha: float = 0.05) -> Automaton:
    """Merge compatible states of the prefix tree of values; of the states next to settled ones the most frequent goes first."""
    step: list[dict[int, int]] = [{}]
    count, end = [0], [0]
    for v in values:
        q = 0
        count[0] += 1
        for a in _CODE[np.frombuffer(v.encode("ascii"), np.uint8)].tolist():
            t = step[q].get(a)
            if t is None:
                t = step[q][a] = len(step)
                step.append({}), count.append(0), end.append(0)
            q = t
            count[q] += 1
        end[q] += 1
    seen = [{a: count[t] for a, t in s.items()} for s in step]  # sightings of each step; these, not states' counts, are summed by merging
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def near(n1: int, f1: int, n2: int, f2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) < bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def compatible(r: int, b: int) -> bool:
        """The subtree of b against what r goes on to; b's side is a tree, so this ends."""
        todo = [(r, b)]
        while todo:
            r, b = todo.pop()
            if not near(count[r], end[r], count[b], end[b]):
                return False
            for a in step[r].keys() | step[b].keys():
                if not near(count[r], seen[r].get(a, 0), count[b], seen[b].get(a, 0)):
                    return False
                if a in step[r] and a in step[b]:
                    todo.append((step[r][a], step[b][a]))
        return True

    def apart(r: int, b: int) -> float:
        """Sum of the differences of all shares."""
        return abs(end[r] / count[r] - end[b] / count[b]) + sum(abs(seen[r].get(a, 0) / count[r] - seen[b].get(a, 0) / count[b]) for a in seen[r].keys() | seen[b].keys())

    def fold(r: int, b: int) -> None:
        todo = [(r, b)]
        while todo:
            r, b = todo.pop()
            count[r] += count[b]
            end[r] += end[b]
            for a, t in step[b].items():
                seen[r][a] = seen[r].get(a, 0) + seen[b][a]
                if a in step[r]:
                    todo.append((step[r][a], t))
                else:
                    step[r][a] = t

    red, known = [0], {0}
    while True:
        blue = sorted({(-count[t], t, q, a) for q in red for a, t in step[q].items() if t not in known})
        if not blue:
            break
        _, b, q, a = blue[0]
        fits = [r for r in [q, *red] if compatible(r, b)]
        if fits:  # of several the one most alike; a tie goes to the state before, which makes a loop
            r = min(fits, key=lambda r: apart(r, b))
            step[q][a] = r
            fold(r, b)
        else:
            red.append(b)
            known.add(b)
    name = {q: k for k, q in enumerate(red)}
    return Automaton([count[q] for q in red], [end[q] for q in red], [{a: (name[t], seen[q][a]) for a, t in step[q].items()} for q in red])


def likelihood(tables: tuple[np.ndarray, np.ndarray], values: list[bytes]) -> np.ndarray:
    """Log probability of each value, all of them one symbol at a time."""
    to, p = tables
    length = np.array([len(v) for v in values], np.int64)
    data = _CODE[np.frombuffer(b"".join(values), np.uint8)]
    begin = np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64)
    total, state = np.zeros(len(values)), np.zeros(len(values), np.int32)
    live, k = np.flatnonzero(length > 0), 0
    while len(live):
        a = data[begin[live] + k]
        total[live] += p[state[live], a]
        state[live] = to[state[live], a]
        k += 1
        live = live[length[live] > k]
    return total + p[state, END]


class Formats:
    """Automata of the kinds and of other strings, with the least score a character of each kind."""

    def __init__(self, labelled: dict[int, list[str]], other: list[str], margin: float, share: float) -> None:
        self.margin, self.kinds = 0.0, []
        flat = (np.zeros((1, N_SYMBOLS), np.int32), np.full((1, N_SYMBOLS), -math.log(N_SYMBOLS)))
        for k in sorted(labelled):
            # every other value is held out, to see what the format's own values score that it has not seen
            fit, held = labelled[k][::2], labelled[k][1::2]
            if held:
                each = self._rate(infer(fit).tables(), [v.encode() for v in held])
                self.kinds.append((infer(labelled[k]).tables(), float(np.quantile(each, share))))
        # other strings hold secrets too: those that a kind explains better go, and the rest are fitted again
        for _ in range(2):
            self.other = infer(other).tables() if other else flat
            found = self.accepted([v.encode() for v in other])
            other = [v for v, yes in zip(other, found) if not yes]
        self.other, self.margin = infer(other).tables() if other else flat, margin

    @staticmethod
    def _rate(tables: tuple[np.ndarray, np.ndarray], values: list[bytes]) -> np.ndarray:
        return likelihood(tables, values) / (np.array([len(v) for v in values]) + 1)

    def accepted(self, values: list[bytes]) -> np.ndarray:
        out = np.zeros(len(values), bool)
        if values:
            other, size = likelihood(self.other, values), np.array([len(v) for v in values]) + 1
            for tables, least in self.kinds:
                own = likelihood(tables, values)
                out |= (own / size >= least) & (own > other + self.margin)
        return out


# ---- over documents


def _found(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row for each document: base spans and candidates, as flat lists."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [[] for _ in range(7)]
            for t in b.column(1):
                t = t.as_py() or ""
                spans = base_spans(t)
                loose = candidates(t, spans)
                for c, v in zip(columns, ([s[0] for s in spans], [s[1] for s in spans], [s[2] for s in spans], [s[3] for s in spans], [c[0] for c in loose], [c[1] for c in loose], [c[2] for c in loose])):
                    c.append(v)
            kinds = [pa.list_(pa.int32())] * 3 + [pa.list_(pa.string())] + [pa.list_(pa.int32())] * 2 + [pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["key", "start", "kind", "stop", "value", "c_start", "c_stop", "c_value"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, start array<int>, kind array<int>, stop array<int>, value array<string>, c_start array<int>, c_stop array<int>, c_value array<string>"
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(part, schema)


def _sample(found: DataFrame, sample: int, longest: int) -> tuple[dict[int, list[str]], list[str]]:
    """Distinct values by kind (bases) and of no kind, `sample` of each at most, in the order of their hashes."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[str, int]] = {}
        for b in batches:
            kinds, values, loose = b.column(0).flatten().to_pylist(), b.column(1).flatten().to_pylist(), b.column(2).flatten().to_pylist()
            for k, v in [*zip(kinds, values), *((-1, c) for c in loose)]:
                kept = held.setdefault(k, {})
                if len(v) <= longest and v not in kept:
                    kept[v] = int.from_bytes(hashlib.blake2b(v.encode(), digest_size=7).digest(), "big")
                    if len(kept) > 2 * sample:
                        held[k] = dict(sorted(kept.items(), key=lambda x: x[1])[:sample])
        rows = [(k, v, h) for k, kept in held.items() for v, h in sorted(kept.items(), key=lambda x: x[1])[:sample]]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], ["kind", "value", "h"])

    seen = found.select("kind", "value", "c_value").mapInArrow(part, "kind int, value string, h long").distinct()
    got = {k: [r[0] for r in seen.where(F.col("kind") == k).orderBy("h", "value").limit(sample).select("value").collect()] for k in (-1, 0, 1, 2)}
    return {k: v for k, v in got.items() if k >= 0 and v}, got[-1]


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = 1024, longest: int = 256, margin: float = 8.0, share: float = 0.02) -> DataFrame:
    """(key, n_assign, n_access, n_hex, n_format, base_sha256, spans): all secrets of each document; offsets in code points, end exclusive.

    sample, longest: bounds of the fit. margin: how much likelier, in nats, a format must be than other
    strings. share: the part of a kind's own values that its format may miss.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    found = written(_found(docs, key, text), "secrets")
    formats = spark.sparkContext.broadcast(Formats(*_sample(found, sample, longest), margin, share))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = formats.value
        for b in batches:
            start, kind, stop, c_start, c_stop, c_value = (b.column(k).to_pylist() for k in (1, 2, 3, 5, 6, 7))
            flat = [v.encode() for vs in c_value for v in vs]
            taken, at = f.accepted(flat), 0
            counts, hashes, texts = [], [], []
            for i in range(b.num_rows):
                base = list(zip(start[i], kind[i], stop[i]))
                more = [(a, 3, z) for a, z, yes in zip(c_start[i], c_stop[i], taken[at : at + len(c_start[i])]) if yes]
                at += len(c_start[i])
                said = lambda spans: ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)
                counts.append([sum(k == n for _, k, _ in base) for n in range(3)] + [len(more)])
                hashes.append(hashlib.sha256(said(base).encode()).hexdigest())
                texts.append(said(sorted(base + more)))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([c[n] for c in counts], pa.int64()) for n in range(4)), pa.array(hashes, pa.string()), pa.array(texts, pa.string())], [key, "n_assign", "n_access", "n_hex", "n_format", "base_sha256", "spans"])

    return found.select("key", "start", "kind", "stop", "value", "c_start", "c_stop", "c_value").mapInArrow(part, f"{key} {docs.schema[key].dataType.simpleString()}, n_assign long, n_access long, n_hex long, n_format long, base_sha256 string, spans string")
