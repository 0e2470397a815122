"""Secrets, the prefix trie and whitening against brute force, and their odd inputs."""

import hashlib
import random
import re
import string
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerloom.llm import prefix_trie, secret_scan, whitening
from ledgerloom.llm.queries import queries

SF = "/root/testdata/sf0.001"


# ---- op11


def brute_spans(text):
    found = {
        "assign": [m for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 12],
        "access": [m for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18],
        "hex": [m for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16],
    }
    return sorted((m.start(), k, f"{n}:{m.start()}:{m.end()}") for k, n in enumerate(found) for m in found[n]), {n: len(v) for n, v in found.items()}


def check_secrets(docs, out):
    for i, text in docs:
        spans, counts = brute_spans(text or "")
        r = out[i]
        assert (r.n_assign, r.n_access, r.n_hex) == (counts["assign"], counts["access"], counts["hex"])
        assert r.base_sha256 == hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("format")] == [s[2] for s in spans]


def test_secrets_of_the_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = {r.doc_id: r for r in queries()["op11_grammar_secret_scan"](spark, SF).collect()}
    assert len(out) == len(docs)
    check_secrets(docs, out)


def test_secret_formats_are_learnt(spark):
    """Keys are labelled in some documents; unlabelled ones of the same format are found, other long strings are not."""
    rng = random.Random(5)
    made = lambda: "gh_" + "".join(rng.choice(string.ascii_uppercase + string.digits) for _ in range(21))
    word = lambda: "".join(rng.choice(["tion", "en", "the", "al", "is", "ver", "ment"]) for _ in range(5))
    docs = [(k, f"é say {word()} token = '{made()}' {word()} {word()}.example.org") for k in range(300)]
    bare = [made() for _ in range(50)]
    docs += [(300 + k, f"{word()} ünd {b} {word()}-{word()}") for k, b in enumerate(bare)] + [(350, None), (351, ""), (352, "secret=token:abcdefghijklmnopqrst PASSWORD : aaaabbbbccccd"), (352, "x" * 200_000 + " token=ABCDEFGHIJKL")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS spans", "2 AS start", "3 AS key")
    rows = secret_scan.secrets(df).collect()
    assert len(rows) == len(docs)
    one = {r.doc_id: r for r in rows if r.doc_id != 352}
    check_secrets([d for d in docs if d[0] != 352], one)
    assert sorted((r.n_assign, r.n_hex) for r in rows if r.doc_id == 352) == [(1, 0), (1, 0)]
    hits = sum(f"format:{text.index(b)}:{text.index(b) + len(b)}" in one[i].spans.split(",") for (i, text), b in zip(docs[300:350], bare))
    assert hits >= 48
    assert sum(r.n_format for r in rows) <= hits + 1
    assert one[350].spans == one[351].spans == ""
    assert secret_scan.secrets(df.where("doc_id < 0")).count() == 0
    assert secret_scan.secrets(df.where("doc_id = 351")).first().n_format == 0


def test_automaton_of_a_format():
    """A fixed head, then a loop over 36 symbols: five states, whatever the number of values."""
    rng = random.Random(1)
    a = secret_scan.infer(["AKIA" + "".join(rng.choice(string.ascii_uppercase + string.digits) for _ in range(16)) for _ in range(250)])
    assert len(a.count) == 5 and [len(s) for s in a.step] == [1, 1, 1, 1, 36] and a.end == [0, 0, 0, 0, 250]
    to, p = a.tables()
    assert np.allclose(np.exp(p).sum(axis=1), 1)
    values = [b"AKIAB", b"", b"zz"]
    walked = []
    for v in values:
        q, total = 0, 0.0
        for c in v:
            k = secret_scan.SYMBOLS.index(chr(c))
            total, q = total + p[q, k], to[q, k]
        walked.append(total + p[q, secret_scan.END])
    assert np.allclose(secret_scan.likelihood((to, p), values), walked)


# ---- op12


def brute_trie(rows):
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            by[c].append((t is not None, t or 0, r, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest(), x))
    said = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in by.items()}
    new = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        new[c] = said.get(c - c % 20, [])[:h] + own[h:]
    members, kids = defaultdict(list), defaultdict(list)
    for c, s in new.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[q] for q in kids[k]) if kids[k] else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        saved[k] = (len(members[k]) - 1) * words + sum(saved[q] for q in kids[k])
    ends = lambda k: ",".join(str(c) for c in sorted(members[k]) if len(new[c]) == len(k))
    return sorted((min(c), len(k), min(members[k[:-1]]) if k else None, len(c), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends(k).encode()).hexdigest()) for k, c in members.items())


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("span, width", [(1024, None), (2, 8)])
def test_trie(spark, monkeypatch, span, width):
    """Against brute force, with blocks of two turns and a sketch so small that it proves nothing, too."""
    monkeypatch.setattr(prefix_trie, "SPAN", span)
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 130, 1), 400, 401, 999_999]:
        first = rng.choice([("user", "hello there"), ("user", "hello there"), ("assistant", None), (None, f"mine {c}")])
        rows.append((c, 0 if c % 5 else None, *first))
        rows += [(c, k, rng.choice(["user", "assistant"]), rng.choice(["go on", "a  b c", "é ü", ""])) for k in range(1, rng.randrange(1, 7))]
    rows += [(7, k, "user", "again") for k in range(10, 40)] + [(27, 3, "user", "go on")] * 3 + [(None, 1, "user", "nobody")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS depth", "2 AS owner", "3 AS x", "'q' AS words")
    assert sorted_rows(prefix_trie.trie(df, width)) == brute_trie(rows)


def test_trie_proves_and_empties(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "a"), (2, 1, "user", "c")], "conv_id long, turn long, role string, text string")
    rows = prefix_trie.screened(prefix_trie.prefixes(df))
    alone = {(r.conv_id, r.depth) for r in rows.collect() if r.alone}
    held = defaultdict(set)
    for r in rows.collect():
        held[r.x, r.y].add(r.conv_id)
    assert alone and all(len(held[r.x, r.y]) == 1 for r in rows.collect() if r.alone)
    assert prefix_trie.trie(df.where("conv_id < 0")).count() == 0
    assert sorted_rows(prefix_trie.trie(df.where("conv_id = 1"))) == brute_trie([(1, 0, "user", "a"), (1, 1, "user", "b")])


# ---- op13


def check_whitening(rows, vectors, k):
    x = {i: np.floor(64 * np.array(v, np.float64)).astype(np.int64) + 1_000_000 for i, v in vectors}
    fit = np.unique(np.stack(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    d = (n * fit - sums).astype(np.float64) / n
    e, u = np.linalg.eigh(d.T @ d / n)
    e, u = e[::-1], u[:, ::-1]
    w = defaultdict(dict)
    for r in rows:
        w[r.vec_id][r.component] = r
        assert r.n == n and r.deviation == int(((n * x[r.vec_id] - sums) ** 2).sum()) and r.identity_error <= 1e-4
        assert abs(r.explained - e[r.component - 1] / e.sum()) <= 1e-4 * r.explained
    assert set(w) == set(x) and all(sorted(v) == list(range(1, k + 1)) for v in w.values())
    for c in range(1, k + 1):
        got, want = np.array([w[i][c].whitened for i in x]), np.array([(v - sums / n) @ u[:, c - 1] / np.sqrt(e[c - 1]) for v in x.values()])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6


def test_whitening_of_the_table(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(queries()["op13_bit_sliced_whitening"](spark, SF).collect(), vectors, 16)


def test_bit_sliced_products_are_exact():
    rng = np.random.default_rng(2)
    y = np.stack([rng.integers(0, 1 << b, 1000) for b in (1, 7, 3, 11)], axis=1).astype(np.uint64)
    bits = np.array([1, 7, 3, 11])
    counts = whitening.cross_counts(whitening.planes(y, bits))
    owner, place = np.repeat(np.arange(4), bits), np.concatenate([np.arange(b) for b in bits])
    for i in range(4):
        for j in range(4):
            block = counts[np.ix_(owner == i, owner == j)] * (1 << place[owner == i])[:, None] * (1 << place[owner == j])
            assert block.sum() == int((y[:, i] * y[:, j]).sum())


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(4)
    good = [(k, [float(v) for v in rng.normal(size=5) * [1, 30, 5, 0.5, 2000]]) for k in range(60)]
    good += [(100, good[0][1]), (101, good[0][1]), (102, [1e12, -5e11, 0.0, 1.0, 1e9])]
    bad = [(200, None), (201, [1.0, None, 2.0, 3.0, 4.0]), (202, [float("nan")] * 5), (203, [1.0, float("inf"), 0.0, 0.0, 0.0]), (204, []), (205, [1.0, 2.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 AS x", "2 AS component", "3 AS n")
    rows = whitening.whiten(df).collect()
    assert {r.vec_id for r in rows} == {k for k, _ in good} and len(rows) == 5 * len(good)
    n, sums, cross, _, _ = whitening.scatter(whitening.scaled(df, "vec_id", "embedding", 64.0, 1_000_000).where("size(x) = 5").select("x").distinct(), 5)
    x = [[int(np.floor(64 * v)) + 1_000_000 for v in e] for _, e in good[:60] + good[-1:]]
    assert n == 61 and sums == [sum(v[j] for v in x) for j in range(5)] and cross == [[sum(v[i] * v[j] for v in x) for j in range(5)] for i in range(5)]
    assert all(r.deviation is None or r.deviation == sum((n * v[j] - sums[j]) ** 2 for j in range(5)) for r in rows for v in ([int(np.floor(64 * c)) + 1_000_000 for c in dict(good)[r.vec_id]],))
    calm = [g for g in good if g[0] != 102]
    check_whitening(whitening.whiten(df.where("vec_id <> 102")).collect(), calm, 5)
    assert whitening.whiten(df.where("vec_id < 0")).count() == 0
    same = whitening.whiten(df.where("vec_id IN (0, 100)")).collect()
    assert len(same) == 10 and all(r.whitened == 0 and r.n == 1 and r.deviation == 0 and r.explained == 0 for r in same)


# ---- mends of earlier operators


def test_pages_with_clashing_columns(spark, tmp_path):
    from ledgerloom.llm import warc

    pages = spark.createDataFrame([(1, "u", "x" * 1200), (2, "u", "x" * 1200), (3, None, None)], "page_id long, url string, html string")
    pages = pages.selectExpr("*", "1 AS _digest", "2 AS _winner", "3 AS _body", "4 AS key", "5 AS payload", "6 AS record_type")
    warc.write_warc(pages, f"file://{tmp_path}/w", key="page_id", url="url", payload="html")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.resolve(warc.read_warc(spark, f"file://{tmp_path}/w")).collect()}
    assert got == {1: ("revisit", 2), 2: ("response", None), 3: ("response", None)}
    marked = warc.mark_revisits(pages, "page_id", "html")
    assert {(r["page_id"], r["record_type"], r["_digest_in"], r["record_type_in"]) for r in marked.collect()} == {(1, "revisit", 1, 6), (2, "response", 1, 6), (3, "response", 1, 6)}


def test_mix_of_rows_alike(spark, monkeypatch):
    """Rows alike in id and size fly in many blocks, whose makeup does not hang on where the rows stand."""
    from ledgerloom.llm import mixing

    docs = spark.createDataFrame([(7, "a", 10)] * 3000 + [(k, "b", k % 9 + 1) for k in range(500)] + [(None, "a", 10)] * 200, "doc_id long, source string, size long")
    out = mixing.mix(docs, block=256)
    total = out.groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert out.count() == 3700 and all(abs(r["sum(taken)"] - r["max(target)"]) <= 10 for r in total)
    again = mixing.mix(docs.repartition(5), block=256)
    count = lambda df: sorted((r["doc_id"] is None, r["doc_id"], r["size"], r["taken"], r["count"]) for r in df.where("doc_id IS NOT NULL").groupBy("doc_id", "size", "taken").count().collect())
    assert count(out) == count(again)
