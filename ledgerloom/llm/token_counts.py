"""Token counts with overlap resynchronisation for huge documents.

A document of up to `chunk` characters is encoded in one piece. A longer one is cut into
overlapping chunks, each encoded with offsets. Two neighbours are spliced at a boundary between
pre-tokens that both of them have inside their overlap and that is proven stable: the left chunk
still sees at least `MARGIN` characters behind it, more than the pre-tokeniser looks ahead or an
added token is long, and both scans stand at the start of a pre-token there, from where a scan
depends on the text to its right alone. Where the overlap holds no such boundary it is widened,
in the end to the whole document.

Defined results: a null text counts as empty (0 bytes, 0 tokens); empty tables give empty
results; repeated rows are counted one by one; extra columns are carried along untouched, those
that are named like the new ones as <name>_in.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import bounded_batches, set_aside

#: Characters that a boundary must keep from the end of its chunk.
MARGIN = 32
#: Distinct pre-tokens whose counts a worker keeps; then it starts anew.
KEEP = 1 << 19
#: Characters of the texts that are cut at a time.
SLICE = 1 << 20
#: Pre-tokens as byte-level BPE cuts them. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose classes are the same in every Unicode version that a library may use.
SETTLED = "[^\t\n\r -~¡-¬®-ſ–—‘-”…€]"

_models: dict[str, "Counter"] = {}


class Counter:
    """Counts tokens of texts with one tokenizer file of the `tokenizers` library."""

    def __init__(self, path: str, chunk: int = 32768, overlap: int = 512):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.chunk, self.overlap = chunk, overlap
        parts = json.loads(self.model.to_str())
        cut = parts.get("pre_tokenizer") or {}
        #: Whether PATTERN cuts as this file does; else texts are encoded whole.
        self.plain = parts.get("normalizer") is None and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
        self.added = [x.content for x in self.model.get_added_tokens_decoder().values()]
        if any(len(x) > MARGIN - 4 for x in self.added):
            raise ValueError("an added token is longer than the margin of stable boundaries")
        self.pieces, self.odd, self.known = regex.compile(PATTERN), regex.compile(SETTLED), {}

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.model.encode_batch(texts, add_special_tokens=False)]

    def short(self, texts: list[str]) -> list[int]:
        """Counts of texts that fit a chunk; each distinct pre-token is encoded once."""
        out, cut = [0] * len(texts), []
        for i, text in enumerate(texts):
            if not self.plain or self.odd.search(text) or any(x in text for x in self.added):
                out[i] = self.whole([text])[0]
            else:
                cut.append((i, self.pieces.findall(text)))
        if len(self.known) > KEEP:
            self.known.clear()
        known = self.known
        if fresh := list({p for _, ps in cut for p in ps} - known.keys()):
            known.update(zip(fresh, (len(e.ids) for e in self.model.encode_batch_fast(fresh, add_special_tokens=False))))
        for i, ps in cut:
            out[i] = sum(map(known.__getitem__, ps))
        return out

    def _bounds(self, text: str, start: int) -> tuple[list[int], dict[int, int]]:
        """Encode a chunk: starts of its tokens, and of its pre-tokens with the tokens before each."""
        e = self.model.encode(text, add_special_tokens=False)
        first, last = {}, object()
        for k, ((a, _), w) in enumerate(zip(e.offsets, e.word_ids)):
            if w != last or w is None:
                first.setdefault(start + a, k)
                last = w
        return e.ids, first

    def long(self, text: str) -> int:
        """Count of a huge text, spliced from overlapping chunks."""
        total, start, overlap = 0, 0, self.overlap
        end = min(len(text), self.chunk)
        ids, first = self._bounds(text[:end], 0)
        base = 0  # tokens of this chunk that stand before its splice
        while end < len(text):
            overlap, found = self.overlap, None
            while found is None:
                begin = max(start + 1, end - overlap)
                stop = min(len(text), begin + self.chunk + overlap)
                more, others = self._bounds(text[begin:stop], begin)
                # the latest boundary of both scans; the first of the right scan may be no true one
                found = max((p for p in others if p in first and first[p] >= base and begin < p <= end - MARGIN), default=None)
                if found is None:
                    if overlap >= end - start:
                        return self.whole([text])[0]
                    overlap *= 4
            total += first[found] - base
            start, end, ids, first, base = begin, stop, more, others, others[found]
        return total + len(ids) - base

    def counts(self, texts: list[str | None]) -> list[int]:
        out: list[int] = [0] * len(texts)
        some, size = [], 0
        for i, x in enumerate([*texts, None]):
            if i == len(texts) or size > SLICE:
                for j, n in zip(some, self.short([texts[j] for j in some])):
                    out[j] = n
                some, size = [], 0
            if x and len(x) <= self.chunk:
                some.append(i)
                size += len(x)
        for i, x in enumerate(texts):
            if x and len(x) > self.chunk:
                out[i] = self.long(x)
        return out


def counter(path: str, chunk: int, overlap: int) -> Counter:
    """The counter of this worker; a reused worker need not load the file again."""
    key = f"{path}|{chunk}|{overlap}"
    if key not in _models:
        _models[key] = Counter(path, chunk, overlap)
    return _models[key]


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 512, chunk: int = 32768, overlap: int = 512) -> DataFrame:
    """docs without its text, plus n_bytes, n_tokens and over_limit (n_tokens > limit).

    vocabulary is the path of a tokenizers file that every executor has. No shuffle: each task
    counts the documents that it reads.
    """
    bounded_batches(docs.sparkSession)
    docs = set_aside(docs, "n_bytes", "n_tokens", "over_limit")
    keep = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*keep, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    names = [f.name for f in keep]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(vocabulary, chunk, overlap)
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text)).to_pylist()
            n = model.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.names.index(c)) for c in names), pa.array([len(x.encode()) if x else 0 for x in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=[*names, "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(*names, text).mapInArrow(count, schema)
