"""Language identification with string kernels.

The kernel of two texts is a blended spectrum of presence kernels: for each length of character
n-grams the number of distinct n-grams that both have, divided by the root of the product of
their numbers, and the mean of that over the lengths. Nyström landmarks give each text a vector;
kernel ridge regression, one language against the rest, scores it. n-grams are hashed into fixed
tables, so a batch of texts is scored by products of dense matrices.

Texts are read whole, in lower case; what is no letter counts as one blank.

Defined results: a text that is null or has no letter is `und` with score 0; without labelled rows
to learn from every text is `und`. Ties of the score go to the smaller language code. The number
of languages is small by nature: they are the classes of the model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, set_aside

#: Hashed n-grams of each length.
TABLES = {1: 1 << 10, 2: 1 << 12, 3: 1 << 14, 4: 1 << 14}
#: Labelled rows of each language that the model learns from, at most about so many.
SAMPLE = 300
LANDMARKS, RIDGE = 160, 1e-2
UNKNOWN = "und"

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def presence(texts: list[str | None]) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """For each n-gram length a (texts x table) matrix of 0 and 1; and which texts have a letter."""
    low = [(x or "").lower() for x in texts]
    codes = np.frombuffer((" " + " ".join(low) + " ").encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    ends = np.cumsum([len(x) + 1 for x in low]) + 1
    row = np.repeat(np.arange(len(low)), np.diff(ends, prepend=0))
    letter = letters()[codes]
    some = np.zeros(len(low), bool)
    some[row[letter]] = True
    keep = letter | np.r_[True, letter[:-1]] | (np.diff(row, prepend=-1) > 0)
    codes = np.where(letter, codes, 32)[keep].astype(np.uint64)
    row = row[keep]
    out, h = {}, np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for n, size in TABLES.items():
            m = len(codes) - n + 1
            h = (h[:m] * np.uint64(0x100000001B3) + codes[n - 1 : n - 1 + m]) if m > 0 else h[:0]
            x = np.zeros((len(low), size), np.float32)
            if m > 0:
                slot = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (size.bit_length() - 1))
                inside = row[:m] == row[n - 1 :]
                x.ravel()[row[:m][inside] * size + slot[inside].astype(np.int64)] = 1
            out[n] = x
    return out, some


class Model:
    """Landmarks in packed bits, and what turns kernel values into scores of the languages."""

    def __init__(self, marks: dict[int, np.ndarray], classes: list[str], weights: np.ndarray):
        self.marks = {n: np.packbits(x.astype(bool), axis=1) for n, x in marks.items()}
        self.roots = {n: np.sqrt(np.maximum(x.sum(1), 1)) for n, x in marks.items()}
        self.classes, self.weights = classes, weights
        self._dense: dict[int, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_dense": None}

    def kernel(self, x: dict[int, np.ndarray]) -> np.ndarray:
        if self._dense is None:
            self._dense = {n: np.unpackbits(p, axis=1).astype(np.float32).T.copy() for n, p in self.marks.items()}
        return sum(x[n] @ self._dense[n] / np.sqrt(np.maximum(x[n].sum(1), 1))[:, None] / self.roots[n] for n in x) / len(x)

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        x, some = presence(texts)
        return self.kernel(x) @ self.weights[:-1] + self.weights[-1], some


def _dense(bits: np.ndarray) -> dict[int, np.ndarray]:
    """n-gram tables of rows of packed bits."""
    flat, at, out = np.unpackbits(bits, axis=1), 0, {}
    for n, size in TABLES.items():
        out[n] = flat[:, at : at + size].astype(np.float32)
        at += size
    return out


def fit(bits: np.ndarray, langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Kernel ridge regression on Nyström features of rows of packed bits; rows must come in a fixed order."""
    classes = sorted(set(langs))
    if not classes:
        return None
    # landmarks in turn from each language
    turn = {c: [i for i, v in enumerate(langs) if v == c] for c in classes}
    order = [i for k in range(max(map(len, turn.values()))) for c in classes for i in turn[c][k : k + 1]][:landmarks]
    model = Model(_dense(bits[order]), classes, np.empty(0))
    k = np.concatenate([model.kernel(_dense(bits[a : a + 64])) for a in range(0, len(langs), 64)]).astype(float)
    value, vector = np.linalg.eigh(k[order])
    good = value > 1e-6 * value.max()
    root = vector[:, good] / np.sqrt(value[good])  # maps kernel values to Nyström features
    features = np.c_[k @ root, np.ones(len(langs))]
    y = np.array([[float(v == c) for c in classes] for v in langs])
    balance = 1 / np.array([len(turn[v]) for v in langs])
    balance *= len(langs) / balance.sum()
    gram = features.T @ (features * balance[:, None]) + ridge * np.eye(features.shape[1])
    w = np.linalg.solve(gram, features.T @ (y * balance[:, None]))
    model.weights, model._dense = np.concatenate([root @ w[:-1], w[-1:]]), None
    return model


def train(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE, seed: int = 3) -> Model | None:
    """Learn from about `sample` rows of each language of docs, drawn by the hash of their texts.

    Only packed n-gram tables of the sample come to the driver: 5 KB a row.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("t"), F.col(lang).alias("l"), F.xxhash64(F.lit(seed), F.col(text)).alias("h"))
    counts = {r["l"]: r["count"] for r in docs.groupBy("l").count().collect()}
    if not counts:
        return None
    top = float(1 << 40)
    rate = F.lit(0.0)
    for value, n in counts.items():
        rate = F.when(F.col("l") == value, min(1.0, sample / n) * top).otherwise(rate)
    drawn = docs.where(F.pmod("h", F.lit(1 << 40)) <= rate)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                x, some = presence(part.column(0).to_pylist())
                bits = np.concatenate([np.packbits(v.astype(bool), axis=1) for v in x.values()], axis=1)
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array([r.tobytes() for r in bits], pa.binary()), pa.array(some)], names=["l", "h", "bits", "some"])

    rows = drawn.select("t", "l", "h").mapInArrow(pack, "l string, h long, bits binary, some boolean").where("some").collect()
    kept: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["l"], r["h"], bytes(r["bits"]))):
        if len(mine := kept.setdefault(r["l"], [])) < sample and (not mine or mine[-1]["h"] != r["h"]):
            mine.append(r)
    rows = [r for v in kept.values() for r in v]
    bits = np.array([np.frombuffer(bytes(r["bits"]), np.uint8) for r in rows], np.uint8).reshape(len(rows), -1)
    return fit(bits, [r["l"] for r in rows])


def identify(docs: DataFrame, model: Model | None, text: str = "text", characters: int = 400_000) -> DataFrame:
    """docs plus lang_pred and score (0 to 1); extra columns are kept as they are, those of these names as <name>_in."""
    bounded_batches(docs.sparkSession)
    docs = set_aside(docs, "lang_pred", "score")
    names = docs.columns
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of landmarks in fixed tables

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            texts = b.column(names.index(text)).to_pylist()
            pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            lo = 0
            while model is not None and lo < len(texts):
                hi, n = lo, 0
                while hi < len(texts) and hi - lo < 128 and (hi == lo or n + len(texts[hi] or "") <= characters):
                    n += len(texts[hi] or "")
                    hi += 1
                s, some = model.scores(texts[lo:hi])
                for i in range(hi - lo):
                    if some[i]:
                        k = int(s[i].argmax())
                        pred[lo + i], score[lo + i] = model.classes[k], float(min(1.0, max(0.0, s[i, k])))
                lo = hi
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(names))), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=[*names, "lang_pred", "score"])

    return docs.select(*names).mapInArrow(predict, schema)


def held_out(key: Column) -> Column:
    return F.pmod(key, F.lit(5)) == 0
