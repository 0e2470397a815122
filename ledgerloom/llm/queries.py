"""The registered queries of this subpackage, each an operator over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_of_id, shared_dir
from .templates import UNITS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .context_tree import score

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", (F.pmod(crc32_of_id(), F.lit(7)) != 2).alias("learn"))
    return score(docs)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import join

    return join(_table(spark, sf_dir, "documents")).drop("row_hash")


def op3_warc_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    from .warc import read_warc, resolve, write_warc

    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(_table(spark, sf_dir, "pages"), path, key="page_id", url="url", payload="html")
    return resolve(read_warc(spark, path))


def op4_line_similarity_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_dedup(spark, sf_dir, 5)


def op4_word_similarity_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with single words as tokens of a line."""
    return _line_dedup(spark, sf_dir, 1)


def _line_dedup(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    from .line_dedup import dedup_lines

    out = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), n=n)
    kept = F.coalesce(F.col("text"), F.lit(""))
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"), F.octet_length(kept).cast("long").alias("kept_bytes"), F.md5(kept).alias("kept_md5"))


def op5_rendezvous_sharding(spark: SparkSession, sf_dir: str, shards: int = 8) -> DataFrame:
    from .sharding import rendezvous, shard

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = _table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = shard(rows, "doc_id", [1.0] * shards, order=("size", "text_crc32"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", rendezvous(F.col("doc_id"), [1.0] * (shards + 1)).alias("grown_shard"))


def op6_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import held_out, identify, train

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(crc32_of_id()).alias("held_out"))
    model = train(docs.where("NOT held_out"))
    return identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op7_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix, words_in

    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", words_in(F.col("text")).alias("size"))
    return mix(docs)


def op8_overlap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary())


def op9_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .templates import contaminated

    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("row_hash")


def op10_anisotropic_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import neighbours

    return neighbours(_table(spark, sf_dir, "embeddings"))


def op11_grammar_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import secrets

    return secrets(_table(spark, sf_dir, "documents"))


def op12_count_min_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import trie

    return trie(_table(spark, sf_dir, "conversations"))


def op13_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_context_tree_scores, op2_ngram_jaccard_join, op3_warc_reassembly, op4_line_similarity_dedup, op4_word_similarity_dedup, op5_rendezvous_sharding, op6_string_kernel_language, op7_cube_mixing, op8_overlap_token_counts, op9_template_decontamination, op10_anisotropic_search, op11_grammar_secret_scan, op12_count_min_prefix_trie, op13_bit_sliced_whitening, pipeline)}


OP3_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), w AS (
  SELECT body, max(page_id) AS winner FROM p WHERE n >= 1000 AND page_id IS NOT NULL GROUP BY body
)
SELECT p.page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.body) AS payload_digest,
       CASE WHEN winner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN winner <> page_id THEN winner END AS refers_to
FROM p LEFT JOIN w ON p.body = w.body AND p.n >= 1000 AND p.page_id IS NOT NULL
"""


OP2_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END) AS g FROM d
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
r(x, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.y, r.root FROM r JOIN l ON r.x = l.x)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(root) AS component_id, coalesce(any_value(k.n), 0) AS n_links
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.x = d.doc_id LEFT JOIN (SELECT x, count(*) AS n FROM l GROUP BY x) k ON k.x = d.doc_id GROUP BY d.doc_id
"""

OP4_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS (SELECT doc_id, string_split(t, chr(10)) AS parts FROM d),
l AS (SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line, len(parts) AS n_lines FROM raw),
k AS (SELECT line, min((doc_id, pos)) AS head, list_filter(regexp_split_to_array(lower(line), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM l GROUP BY line),
g AS (SELECT line, head, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))) END AS w FROM k),
c AS (SELECT *, row_number() OVER (ORDER BY head, line) AS c, len(w) AS n FROM g WHERE len(w) > 0),
f AS (SELECT w, count(*) AS f FROM (SELECT unnest(w) AS w FROM c) GROUP BY w),
o AS (SELECT c.c, c.n, c.head, u.w, row_number() OVER (PARTITION BY c.c ORDER BY f.f, u.w) AS i FROM c, unnest(c.w) AS u(w) JOIN f ON f.w = u.w),
p AS (SELECT * FROM o WHERE i <= n - CAST(ceil(n * 4 / 5.0) AS BIGINT) + 1),
pair AS (SELECT DISTINCT a.c AS x, b.c AS y FROM p a JOIN p b ON a.w = b.w AND b.head < a.head AND least(a.n, b.n) * 5 >= greatest(a.n, b.n) * 4),
late AS (SELECT DISTINCT x FROM pair JOIN c a ON a.c = x JOIN c b ON b.c = y WHERE len(list_intersect(a.w, b.w)) * 5 >= (a.n + b.n - len(list_intersect(a.w, b.w))) * 4),
j AS (SELECT l.doc_id, l.pos, l.line, l.n_lines, c.c IS NOT NULL AND (late.x IS NOT NULL OR (l.doc_id, l.pos) > c.head) AS gone FROM l LEFT JOIN c ON c.line = l.line LEFT JOIN late ON late.x = c.c),
q AS (SELECT doc_id, any_value(n_lines) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) FILTER (gone), '') AS removed_lines, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM j GROUP BY doc_id)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, n_removed, removed_lines, CAST(octet_length(encode(kept)) AS BIGINT) AS kept_bytes, md5(kept) AS kept_md5 FROM q
"""

def _tokens_sql(column: str) -> str:
    """The tokens of templates.tokens in DuckDB: its patterns cannot look behind, so they take what is before along."""
    t = f"translate(coalesce({column}, ''), chr(1) || chr(2) || chr(3), '   ')"
    for _ in range(2):  # names in a row share what is between them
        t = f"regexp_replace({t}, '([\\p{{L}}\\p{{N}},;] )(\\p{{Lu}}\\p{{Ll}})', '\\1' || chr(2) || '\\2', 'g')"
    t = f"regexp_replace({t}, '([0-9] ?)({'|'.join(u for u in UNITS if u.isalpha())})([^\\p{{L}}\\p{{M}}]|$)', '\\1' || chr(3) || '\\2\\3', 'g')"
    t = f"regexp_replace({t}, '([0-9] ?)([%$€£°])', '\\1' || chr(3) || '\\2', 'g')"
    t = f"regexp_replace({t}, '[0-9]+(?:[.,:][0-9]+)*', ' ' || chr(1) || '\\0 ', 'g')"
    return f"regexp_extract_all({t}, '[\\x01\\x02\\x03]?[\\p{{L}}\\p{{M}}]+|\\x01[0-9][0-9.,:]*|\\x03[%$€£°]')"


OP9_SQL = r"""
WITH d AS (SELECT doc_id, {tokens} AS t FROM documents), b AS (SELECT item_id, {tokens} AS t FROM benchmark),
bw AS (SELECT item_id, least(len(t), 8) AS n, t, unnest(range(len(t) - least(len(t), 8) + 1)) AS j FROM b WHERE len(t) >= 4),
bs AS (SELECT item_id, n, j, t[j + 1 : j + n] AS said FROM bw WHERE len(list_filter(t[j + 1 : j + n], lambda x: x >= chr(4))) >= 3),
bk AS (SELECT *, array_to_string(list_transform(said, lambda x: CASE WHEN x < chr(4) THEN x[1] ELSE lower(x) END), ' ') AS w, count(*) OVER (PARTITION BY item_id) AS windows FROM bs),
dw AS (SELECT doc_id, n, t, unnest(range(len(t) - n + 1)) AS pos FROM d, (SELECT DISTINCT n FROM bk) WHERE len(t) >= n),
dk AS (SELECT doc_id, n, pos, t[pos + 1 : pos + n] AS has, array_to_string(list_transform(t[pos + 1 : pos + n], lambda x: CASE WHEN x < chr(4) THEN x[1] ELSE lower(x) END), ' ') AS w FROM dw),
hit AS (SELECT doc_id, item_id, windows, n, j, pos - j AS shift, said, has FROM dk JOIN bk USING (w, n)),
slot AS (SELECT DISTINCT doc_id, item_id, shift, said[k] AS a, has[k] AS b FROM (SELECT *, unnest(range(1, n + 1)) AS k FROM hit) WHERE said[k] < chr(4)),
fit AS (SELECT doc_id, item_id, shift, count(*) AS slots, count(DISTINCT a) AS values, count(*) FILTER (a <> b) AS changed FROM slot GROUP BY ALL),
run AS (SELECT doc_id, item_id, shift, any_value(windows) AS windows, list(DISTINCT j) AS js FROM hit GROUP BY ALL),
good AS (SELECT run.*, coalesce(slots, 0) AS slots, coalesce(changed, 0) AS changed FROM run LEFT JOIN fit USING (doc_id, item_id, shift) WHERE coalesce(slots = values, true)),
found AS (SELECT doc_id, item_id, any_value(windows) AS windows, CAST(len(list_distinct(flatten(list(js)))) AS BIGINT) AS matched, CAST(sum(slots) AS BIGINT) AS slots, CAST(sum(changed) AS BIGINT) AS changed FROM good GROUP BY ALL)
SELECT doc_id, item_id, windows, matched, matched / CAST(windows AS DOUBLE) AS coverage, slots, changed FROM found WHERE matched / CAST(windows AS DOUBLE) >= 0.5
"""


# crc32 goes bit by bit: a byte is taken in, then eight times -1 stands for a shift
OP12_SQL = r"""
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS no,
    octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '') AS said, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS words FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT DISTINCT c, c - c % 20 AS host, CAST(xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: [CAST(unicode(d) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a // 2, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295) % 4 AS BIGINT) AS h FROM t),
r AS (SELECT k.c, t.no AS place, t.said, t.words FROM k JOIN t ON t.c = k.host AND t.no <= k.h UNION ALL SELECT k.c, t.no + 10, t.said, t.words FROM k JOIN t ON t.c = k.c AND t.no > k.h),
p AS (SELECT c, row_number() OVER w AS depth, sha256(string_agg(sha256(said), '') OVER w) AS key, words FROM r WINDOW w AS (PARTITION BY c ORDER BY place)),
q AS (SELECT c, 0 AS depth, '' AS key, 0 AS words FROM k UNION ALL SELECT * FROM p),
e AS (SELECT c, max(depth) AS top FROM q GROUP BY c),
m AS (SELECT q.*, coalesce(lag(key) OVER (PARTITION BY q.c ORDER BY depth), 'none') AS above, depth = top AS ends FROM q JOIN e ON e.c = q.c),
n AS (SELECT key, min(c) AS conv_id, any_value(depth) AS depth, any_value(above) AS above, count(*) AS n_convs, any_value(words) AS words, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY key),
kids AS (SELECT above AS key, count(*) AS n_children FROM n GROUP BY above),
u AS (SELECT n.*, coalesce(kids.n_children, 0) AS n_children FROM n LEFT JOIN kids ON kids.key = n.key),
s AS (SELECT q.key, count(*) FILTER (u.n_children = 0) AS n_leaves, CAST(sum((u.n_convs - 1) * u.words) AS BIGINT) AS saved_tokens FROM u JOIN q ON q.c = u.conv_id AND q.depth <= u.depth GROUP BY q.key)
SELECT u.conv_id, CAST(u.depth AS BIGINT) AS depth, o.conv_id AS parent_conv_id, u.n_convs, u.n_children, s.n_leaves, s.saved_tokens, u.ends_sha256 FROM u JOIN s ON s.key = u.key LEFT JOIN n o ON o.key = u.above
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_ngram_jaccard_join": OP2_SQL, "op3_warc_reassembly": OP3_SQL, "op4_line_similarity_dedup": OP4_SQL, "op9_template_decontamination": OP9_SQL.replace("{tokens}", _tokens_sql("text")), "op12_count_min_prefix_trie": OP12_SQL}
