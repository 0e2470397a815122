"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions along a tree of 255 nodes. Each node has a context tree of its
own: the contexts are the 0 to 5 bytes before. Every context holds a Krichevsky-Trofimov estimate
of its decisions, and its weighted probability is half that and half the product of its children's.
A decision is predicted by the mixture of the estimates of all depths, each weighted with what it
has earned on the training texts; the code length of a text is the sum over its bytes and its end.

The counts of all 6-byte strings of the corpus are merged by ranges of their two nearest context
bytes, so the trees below a range are built in one place; the two upper levels need a table of
65,280 rows at most. Scoring looks strings up in a table of bounded size. Strings and words that do
not fit it, the rarest ones, are joined. So any model size works, and nothing is dropped.

Words, for the base line, are runs of bytes other than ASCII white space, compared by 64-bit hashes;
every text has one end token more.

Defined results: a null text is an empty one; without training texts all estimates are even.
Repeated rows are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, mix64, word_hashes, written

DEPTH = 5
#: Byte that stands for the end of a text and fills the context at its start; UTF-8 has no such byte.
END = 0xFF
#: Entries of the look-up tables, at most.
STRINGS, WORDS = 3 << 20, 1 << 19
CHARACTERS = 1_000_000
#: Distinct strings, and words, that a task holds before it hands them on.
HOLD = 1 << 20
#: In place of a word's hash: the end of a text.
LAST_TOKEN = 0
_U = np.uint64
_LN2 = float(np.log(2.0))


def strings_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of each byte and end the string of it (lowest byte) and the DEPTH bytes before; and where each text begins."""
    gap = bytes([END]) * DEPTH
    a = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    code = np.zeros(len(a) - DEPTH, _U)
    for k in range(DEPTH + 1):
        code |= a[DEPTH - k : len(a) - k].astype(_U) << _U(8 * k)
    keep = np.ones(len(code), bool)
    ends = np.cumsum(n + DEPTH) - DEPTH  # place of the end byte of each text
    for k in range(1, DEPTH):
        at = ends + k
        keep[at[at < len(code)]] = False
    return code[keep], np.concatenate([[0], np.cumsum(n + 1)])


def ranges_of(code: np.ndarray, ranges: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64((code >> _U(8) & _U(0xFFFF)) + _U(1)) % _U(ranges)).astype(np.int64)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x > 0 by Stirling's series, eight places further on."""
    y, p = x + 8, x.copy()
    for k in range(1, 8):
        p = p * (x + k)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(p)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1.0) - np.log(np.pi)


def weighted(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ln of the weighted probability of nodes, and the weight that their own estimates have."""
    total = np.logaddexp(own, below) - _LN2
    return total, np.exp(own - _LN2 - total)


def decisions(symbol: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of the eight decisions of a byte: its node, 1 to 255, and its outcome."""
    s = symbol.astype(np.int64)
    for j in range(8):
        yield (1 << j) | (s >> (8 - j)), (s >> (7 - j)) & 1


class Level:
    """The nodes of all contexts of one depth; keys are context and node."""

    def __init__(self, strings: np.ndarray, times: np.ndarray):
        context = (strings >> _U(8)).astype(np.int64)
        keys, ones = zip(*((context << 8 | node, bit) for node, bit in decisions(strings & _U(0xFF))))
        self.keys, self.at = np.unique(np.concatenate(keys), return_inverse=True)
        bits, n = np.concatenate(ones), np.tile(times, 8).astype(float)
        self.b = np.bincount(self.at, n * bits, len(self.keys))
        self.a = np.bincount(self.at, n, len(self.keys)) - self.b
        self.at = self.at.reshape(8, -1)
        self.own = estimate(self.a, self.b)
        self.total, self.weight = self.own, np.ones(len(self.keys))

    def put_on(self, below: "Level", depth: int) -> None:
        """Weigh against the children, one level deeper."""
        parent = (below.keys >> 8 & ((1 << 8 * depth) - 1)) << 8 | below.keys & 0xFF
        sums = np.bincount(np.searchsorted(self.keys, parent), below.total, len(self.keys))
        self.total, self.weight = weighted(self.own, sums)


def trees(code: np.ndarray, times: np.ndarray, top: int = 2) -> dict[int, tuple[Level, np.ndarray]]:
    """Levels DEPTH to top of distinct strings, and for each string its row among those of the level."""
    out, strings, inverse, n = {}, code, np.arange(len(code)), times.astype(float)
    for depth in range(DEPTH, top - 1, -1):
        if depth < DEPTH:
            strings, back = np.unique(strings & _U((1 << 8 * (depth + 1)) - 1), return_inverse=True)
            n = np.bincount(back, n, len(strings))
            inverse = back[inverse]
        level = Level(strings, n)
        if depth < DEPTH:
            level.put_on(out[depth + 1][0], depth)
        out[depth] = (level, inverse)
    return out


class Upper:
    """The levels 1 and 0: for each context and node the weight and the probability of a one."""

    def __init__(self, key: np.ndarray, below: np.ndarray, a: np.ndarray, b: np.ndarray):
        full = lambda v: np.bincount(key, v, 1 << 16)
        a1, b1 = full(a), full(b)
        total, self.weight1 = weighted(estimate(a1, b1), full(below))
        self.one1 = (b1 + 0.5) / (a1 + b1 + 1)
        fold = lambda v: v.reshape(256, 256).sum(0)
        a0, b0 = fold(a1), fold(b1)
        _, self.weight0 = weighted(estimate(a0, b0), fold(total))
        self.one0 = (b0 + 0.5) / (a0 + b0 + 1)


def log_probability(code: np.ndarray, levels: dict[int, tuple[Level, np.ndarray]], upper: Upper) -> np.ndarray:
    """log10 of the probability of the last byte of each string."""
    near, out = (code >> _U(8) & _U(0xFF)).astype(np.int64), np.zeros(len(code))
    for j, (node, bit) in enumerate(decisions(code & _U(0xFF))):
        p = np.full(len(code), 0.5)
        for depth in sorted(levels, reverse=True):
            level, inverse = levels[depth]
            k = level.at[j][inverse]
            one = (level.b[k] + 0.5) / (level.a[k] + level.b[k] + 1)
            mine = np.where(bit == 1, one, 1 - one)
            w = level.weight[k] if depth < DEPTH else 1.0
            p = w * mine + (1 - w) * p
        for w, one in ((upper.weight1[near << 8 | node], upper.one1[near << 8 | node]), (upper.weight0[node], upper.one0[node])):
            p = w * np.where(bit == 1, one, 1 - one) + (1 - w) * p
        out += np.log10(p)
    return out


class Table:
    """A read-only map from strings to numbers in flat arrays, for many look-ups at once."""

    def __init__(self, code: np.ndarray, value: np.ndarray):
        h = mix64(code)
        order = np.argsort(h)
        self.bits = max(4, int(len(code)).bit_length())
        self.code, self.value = np.append(code[order], _U(0)), np.append(value[order], 0.0)
        self.first = np.searchsorted(h[order] >> _U(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=_U)).astype(np.int32)

    def get(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and which strings are missing."""
        with np.errstate(over="ignore"):
            slot = (mix64(code) >> _U(64 - self.bits)).astype(np.int64)
        at = self.first[slot]
        hit = self.code[at] == code
        out = self.value[at]
        rest = np.flatnonzero(~hit)
        at, stop, want = at[rest].astype(np.int64), self.first[slot[rest] + 1], code[rest]
        missing = []
        while len(rest):
            at = at + 1
            gone = at >= stop
            if gone.any():
                missing.append(rest[gone])
                fine = ~gone
                rest, at, stop, want = rest[fine], at[fine], stop[fine], want[fine]
                if not len(rest):
                    break
            hit = self.code[at] == want
            out[rest[hit]] = self.value[at[hit]]
            fine = ~hit
            rest, at, stop, want = rest[fine], at[fine], stop[fine], want[fine]
        lost = np.concatenate(missing) if missing else np.empty(0, np.int64)
        out[lost] = 0
        return out, lost


def _batches(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi] or "") <= CHARACTERS):
            size += len(texts[hi] or "")
            hi += 1
        yield lo, [(x or "").encode().lower() for x in texts[lo:hi]]
        lo = hi


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts and of the end of each; and where each text begins."""
    h, begin = word_hashes(b"\n".join(texts))
    start = np.cumsum([0] + [len(x) + 1 for x in texts])
    ends = np.searchsorted(begin, start[1:])
    return np.insert(h, ends, _U(LAST_TOKEN)), np.concatenate([[0], ends + np.arange(1, len(texts) + 1)])


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.ListArray:
    """values in n lists, by owner."""
    order = np.argsort(owner, kind="stable")
    ends = np.searchsorted(owner[order], np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[order].view(np.int64)))


def _totals(code: np.ndarray, learn: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum by string."""
    order = np.argsort(code, kind="stable")
    code = code[order]
    edge = np.flatnonzero(np.diff(code, prepend=~code[:1]))
    return code[edge], np.add.reduceat(learn[order], edge), np.add.reduceat(times[order], edge)


def count(docs: DataFrame, ranges: int) -> DataFrame:
    """Rows of packed string counts (k, blob) and of hashed training words (word, n) from docs (text, learn)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[tuple] = []
        held: list[tuple] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            h, n = (np.concatenate(x) for x in zip(*words))
            h, at = np.unique(h, return_inverse=True)
            return h, np.bincount(at, n, len(h)).astype(np.int64)

        def strings() -> Iterator[pa.RecordBatch]:
            code, learn, times = _totals(*(np.concatenate(x) for x in zip(*held)))
            k = ranges_of(code, ranges)
            order = np.argsort(k, kind="stable")
            edges = np.searchsorted(k[order], np.arange(ranges + 1))
            some = [i for i in range(ranges) if edges[i] < edges[i + 1]]
            blobs = [b"".join(v[order[edges[i] : edges[i + 1]]].astype(np.int64).tobytes() for v in (code, learn, times)) for i in some]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(blobs, pa.binary()), pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.int64())], names=names)

        def flush() -> Iterator[pa.RecordBatch]:
            h, n = merged()
            for a in range(0, len(h), 100_000):
                w = h[a : a + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(w), pa.int32()), pa.nulls(len(w), pa.binary()), pa.array(w), pa.array(n[a : a + 100_000])], names=names)

        names = ["k", "blob", "word", "n"]
        for b in batches:
            learns = np.array(b.column(1).to_pylist(), bool)
            for lo, texts in _batches(b.column(0).to_pylist()):
                code, first = strings_of(texts)
                learn = np.repeat(learns[lo : lo + len(texts)], np.diff(first))
                code = np.sort(code << _U(1) | learn.astype(_U))  # strings have 48 bits
                edge = np.flatnonzero(np.diff(code >> _U(1), prepend=~code[:1]))
                held.append((code[edge] >> _U(1), np.add.reduceat((code & _U(1)).astype(np.int64), edge), np.diff(edge, append=len(code))))
                if sum(len(x[0]) for x in held) > HOLD:
                    held = [_totals(*(np.concatenate(x) for x in zip(*held)))]
                    if len(held[0][0]) > HOLD // 2:
                        yield from strings()
                        held = []
                h, start = words_of(texts)
                h, n = np.unique(h[np.repeat(learns[lo : lo + len(texts)], np.diff(start))], return_counts=True)
                words.append((h, n))
                if sum(len(x[0]) for x in words) > HOLD:
                    words = [merged()]
                    if len(words[0][0]) > HOLD // 2:
                        yield from flush()
                        words = []
        if held:
            yield from strings()
        if words:
            yield from flush()

    return docs.select("text", "learn").mapInArrow(run, "k int, blob binary, word bigint, n bigint")


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.frombuffer(blob, np.int64).reshape(3, -1)
    return x[0].view(_U), x[1], x[2]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All counts of a range in one row; rows come sorted by range."""
    at, held = None, []

    def done() -> pa.RecordBatch:
        total = _totals(*(np.concatenate(x) for x in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([b"".join(x.astype(np.int64).tobytes() for x in total)], pa.binary())], names=["k", "blob"])

    for b in batches:
        for k, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != at and held:
                yield done()
                held = []
            at = k
            held.append(_unpack(blob))
    if held:
        yield done()


def _upper_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for blob in b.column(1).to_pylist():
            code, learn, _ = _unpack(blob)
            level = trees(code, learn)[2][0]
            key, at = np.unique((level.keys >> 8 & 0xFF) << 8 | level.keys & 0xFF, return_inverse=True)
            sums = [np.bincount(at, v, len(key)) for v in (level.total, level.a, level.b)]
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), *map(pa.array, sums)], names=["key", "below", "a", "b"])


def _frequent(counts: DataFrame, bound: int) -> int | None:
    """The least power of two from which at most `bound` rows have their n; None: all rows fit."""
    by = sorted(((r["e"], r["count"]) for r in counts.groupBy(F.floor(F.log2(F.greatest("n", F.lit(1)))).alias("e")).count().collect()), reverse=True)
    if sum(c for _, c in by) <= bound:
        return None
    held, least = 0, 1 << 62
    for e, c in by:
        if (held := held + c) > bound:
            break
        least = 1 << e
    return least


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", learn: str = "learn", strings: int = STRINGS, words: int = WORDS) -> DataFrame:
    """For each row of docs (key, text, learn): what op1's contract names, and code lengths.

    Rows whose `learn` is true are the training texts; all rows are scored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.coalesce(F.col(learn), F.lit(False)).alias("learn"))
    kind = docs.schema["id"].dataType.simpleString()
    ranges = max(32, docs.count() >> 12)
    counted = written(count(docs, ranges), "counts")
    grams = written(counted.where("k IS NOT NULL").select("k", "blob").repartition("k").sortWithinPartitions("k").mapInArrow(_merge, "k int, blob binary"), "strings")
    vocabulary = written(counted.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")), "words")
    size = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    least = _frequent(vocabulary, words)
    known = (vocabulary if least is None else vocabulary.where(F.col("n") >= least)).toArrow()
    logs = Table(known["word"].to_numpy().astype(_U), np.log10(known["n"].to_numpy() + 1.0))

    sums = grams.mapInArrow(_upper_sums, "key int, below double, a double, b double").groupBy("key").agg(F.sum("below").alias("below"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    # at most 256 contexts with 255 nodes each
    upper_rows = np.array([tuple(r) for r in sums.orderBy("key").collect()], float).reshape(-1, 4)
    upper = Upper(upper_rows[:, 0].astype(np.int64), *upper_rows[:, 1:].T)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for blob in b.column(1).to_pylist():
                code, learn_, times = _unpack(blob)
                for p, own in ((log_probability(code, trees(code, learn_), upper), times),):
                    for lo in range(0, len(code), 100_000):
                        part = slice(lo, lo + 100_000)
                        yield pa.RecordBatch.from_arrays([pa.array(code[part].astype(np.int64)), pa.array(p[part]), pa.array(own[part])], names=["code", "p", "n"])

    rated = written(grams.mapInArrow(rate, "code bigint, p double, n bigint"), "rated")
    common = _frequent(rated, strings)
    chosen = (rated if common is None else rated.where(F.col("n") >= common)).select("code", "p")
    chosen = chosen.toArrow()
    table = Table(chosen["code"].to_numpy().astype(_U), chosen["p"].to_numpy())
    shared = spark.sparkContext.broadcast((table, logs))  # at most STRINGS and WORDS entries of 16 bytes, and their index
    del known, chosen, table, logs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, logs = shared.value
        names = ["id", "held_out", "n_bytes", "n_tokens", "n_known", "base", "score", "words", "strings"]

        def looked_up(of: Table, code: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """By text: the sum of values and the number of what is missing; and lists of that."""
            value, lost = of.get(code)
            owner = np.searchsorted(first, lost, "right") - 1
            n = len(first) - 1
            return np.add.reduceat(value, first[:-1]), np.bincount(owner, minlength=n), _lists(code[lost], owner, n)

        for b in batches:
            for lo, texts in _batches(b.column(1).to_pylist()):
                total, _, strings_ = looked_up(look, *strings_of(texts))
                h, first = words_of(texts)
                base, unknown, words_ = looked_up(logs, h, first)
                n = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, len(texts)), pa.array(~np.array(b.column(2).slice(lo, len(texts)).to_pylist(), bool)), pa.array([len(x) for x in texts], pa.int64()), pa.array(n, pa.int64()), pa.array(n - unknown, pa.int64()), pa.array(base), pa.array(total), words_, strings_],
                    names=names,
                )

    scored = docs.select("id", "text", "learn").mapInArrow(run, f"id {kind}, held_out boolean, n_bytes bigint, n_tokens bigint, n_known bigint, base double, score double, words array<bigint>, strings array<bigint>")
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    shared.destroy()
    out = scored.drop("words", "strings")
    if least is not None:  # the rarer words
        rare = scored.select("row", F.explode("words").alias("word")).groupBy("row", "word").agg(F.count("*").alias("t"))
        rare = rare.join(vocabulary.where(F.col("n") < least), "word").groupBy("row").agg(F.sum(F.col("t") * F.log10(F.col("n") + 1)).alias("_base"), F.sum("t").alias("_known"))
        out = out.join(rare, "row", "left").withColumn("base", F.col("base") + F.coalesce("_base", F.lit(0.0))).withColumn("n_known", F.col("n_known") + F.coalesce("_known", F.lit(0))).drop("_base", "_known")
    if common is not None:  # the rarer strings
        more = scored.select("row", F.explode("strings").alias("code")).groupBy("row", "code").agg(F.count("*").alias("t"))
        more = more.join(rated.where(F.col("n") < common), "code").groupBy("row").agg(F.sum(F.col("t") * F.col("p")).alias("_score"))
        out = out.join(more, "row", "left").withColumn("score", F.col("score") + F.coalesce("_score", F.lit(0.0))).drop("_score")
    bits = -F.col("score") * float(np.log2(10.0))
    return out.select(
        F.col("id").alias(key), "held_out", "n_tokens", "n_known", F.lit(int(size["n"])).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * float(np.log10(size["n"] + size["v"] + 1.0))).alias("base_score"), "score",
        "n_bytes", (bits / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
