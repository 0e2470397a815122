"""Line dedup by an exact set-similarity join, in DataFrame functions only.

A line's tokens are its distinct shingles of `n` lower-case words, five unless said otherwise; a
line of fewer words is one shingle. Shingles are compared by 64-bit hashes. A line goes if a line at an earlier place
(doc_id, then line number; null ids last) has a Jaccard similarity of `num` / `den` or more with
it. Equal lines are a class, and only its first place counts.

Lines are sifted first, for n > 1: of each line only so many first tokens are made, in the order of the hash
of their first word, that matching lines have COMMON of them in common, or as many as they share. A line
that has fewer of them in other lines has no match. All tokens of the lines that are left are made once and
written; the rest works on these.

Tokens are ordered by rarity: counts of hashed shingles in a table of fixed size, then by hash. Lines
that match share a token among their first n - ceil(n * num / den) + 1, at places that leave
enough tokens behind them, and their sizes are near. What two lines share before a common prefix token
is in the prefixes of both, so only prefix tokens that are in several prefixes count there. Each class is compared first
with the earliest class that has one of its prefix tokens; only those that find no match there are
compared with all earlier ones, so a group of near copies makes few pairs.

With five-word shingles a changed word breaks up to five tokens, so a line of 40 words with one word
changed is no match at 0.8 (31 of 41 shingles are shared); n = 1 takes single words and finds it.

Defined results: null and empty texts have one empty line; lines without words are kept; rows that
repeat a doc_id share its places, so none of them removes a line of another at the same number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, set_aside, unused, written

#: Counters of hashed shingles, a byte each in the plan.
COUNTERS = 1 << 18
#: Numbers that may be sent to all executors, rows of 40 bytes, and bytes; beyond, joins shuffle both sides.
NUMBERS, SMALL, SMALL_BYTES = 1 << 20, 1 << 18, 32 << 20
#: Tokens of the sift that lines with a match have in other lines: a few shingles are in others by chance.
COMMON = 3
#: In place of a null id: such rows come last.
LAST = (1 << 63) - 1


def _words(line: Column) -> Column:
    """Hashes of the lower-case words of a line, in order."""
    odd = line.rlike(r"[\x09-\x0D]") | line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    even = F.when(odd, F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))).otherwise(line)
    return F.transform(F.split(F.lower(even), " "), lambda w: F.xxhash64(w))  # one plain character needs no pattern


def _shingle(words: Column, at: Column, n: int) -> Column:
    """Hash of the n words from place `at` on, from 0; what is beyond the line does not count."""
    return F.xxhash64(*(F.get(words, at + k) for k in range(n)))


def _places(n: int) -> Column:
    """The number of shingles of `words`, repeated ones counted."""
    return F.greatest(F.size("words") - (n - 1), F.lit(1))


def tokens_of(n: int) -> Column:
    """Distinct hashes of the shingles of n words of `words`."""
    if n == 1:
        return F.array_distinct("words")
    return F.array_distinct(F.transform(F.sequence(F.lit(0), _places(n) - 1), lambda i: _shingle(F.col("words"), i, n)))


def _least(size: Column, num: int, den: int) -> Column:
    """Lines that match share so many tokens at least."""
    return F.ceil(size * F.lit(num) / F.lit(den)).cast("int")


def _prefix(size: Column, num: int, den: int, common: int = 1) -> Column:
    """Lines that match share `common` of so many first tokens, in any order of all tokens, or all that they share."""
    return size - _least(size, num, den) + common


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text) of docs, without nulls."""
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _lines(texts: DataFrame) -> DataFrame:
    """(id, row_hash, at, line, cls, k) of lines with words; cls is a hash of the line, k a shorter one."""
    rows = texts.select("id", F.xxhash64("text").alias("row_hash"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return rows.where(F.col("line").rlike(WORD)).withColumns({"cls": F.unhex(F.md5(F.col("line"))), "k": F.xxhash64("line")})


def _few(rows: DataFrame, most: int = SMALL) -> DataFrame:
    """rows, to be broadcast if they are few."""
    return F.broadcast(rows) if rows.count() <= most else rows


def _similar(a: Column, b: Column, num: int, den: int) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both * den >= (F.size(a) + F.size(b) - both) * num


def _sifted(lines: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(id, row_hash, at, cls, k, sift, need) of lines: the tokens of which matching lines share COMMON, or all that they share.

    need is the number that a line with a match has in other lines, at least.
    Tokens are ordered by the hash of their first word here, so only those that are picked are made. What ties with
    the last one goes along. Where repeated tokens leave too few, all are taken.
    """
    own = ("id", "row_hash", "at", "cls", "k")
    if n == 1:
        return lines.select(*own, F.array().cast("array<long>").alias("sift"), F.lit(0).alias("need"))  # words are in other lines nearly always
    low = F.lit((1 << 31) - 1)
    rows = lines.select(*own, _words(F.col("line")).alias("words"))
    rows = rows.select(*own, "words", _places(n).alias("m"), F.slice("words", F.lit(1), _places(n)).alias("order"))
    rows = rows.select(*own, "words", "m", F.sort_array(F.transform("order", lambda w, i: w.bitwiseAND(F.lit(-1 << 31)).bitwiseOR(i))).alias("order"))
    rows = rows.select("*", _prefix(F.col("m"), num, den, COMMON).alias("p")).select("*", F.shiftright(F.get("order", F.col("p") - 1), 31).alias("last"))  # null beyond the line: all are picked
    tied = F.coalesce(F.shiftright(F.get("order", F.col("p")), 31) == F.col("last"), F.lit(False))
    picked = F.when(tied, F.filter("order", lambda x: F.shiftright(x, 31) <= F.col("last"))).otherwise(F.slice("order", F.lit(1), F.col("p")))
    rows = rows.select(*own, "words", "m", picked.alias("picked"))
    rows = rows.select(*own, "words", "m", F.size("picked").alias("many"), F.transform("picked", lambda x: x.bitwiseAND(low).cast("int")).alias("picked"))
    rows = rows.select(*own, "words", "m", "many", F.array_distinct(F.transform("picked", lambda i: _shingle(F.col("words"), i, n))).alias("some"))
    most = F.col("m") - (F.col("many") - F.size("some"))  # distinct tokens of the line
    enough = (F.col("many") == F.col("m")) | (F.size("some") >= _prefix(most, num, den, COMMON))
    rows = rows.select(*own, F.when(enough, F.col("some")).otherwise(tokens_of(n)).alias("sift"))
    # the sift may hold less than all tokens, but not less than COMMON of them then
    return rows.withColumn("need", F.least(F.lit(COMMON), _least(F.size("sift"), num, den)))


def _in_question(texts: DataFrame, sifted: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """(c, id, at, tokens) of the classes that share enough tokens of the sift with others; c is a hash of the first place.

    Rows alike in id and text give a class more than once.
    """
    place = F.xxhash64("k", "id", "at").alias("c")
    asked = classes
    if n > 1:
        tokens = sifted.select("k", F.explode("sift").alias("token"))
        shared = written(tokens.groupBy("token").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count("*").alias("many")).where("a < b"), "line-shared")
        two = shared.where("many = 2").select(F.explode(F.array("a", "b")).alias("k"), "token")  # these are all that have the token
        more = tokens.join(_few(shared.where("many > 2").select("token"), NUMBERS), "token", "left_semi").select("k", "token")
        held = written(two.union(more).groupBy("k").agg(F.count_distinct("token").alias("many")), "line-held")
        asked = classes.join(_few(held, NUMBERS), "k").where("many >= need")
    asked = written(asked.select(place, "id"), "line-asked")
    ids = asked.select("id").distinct()
    if n > 1 and ids.count() <= NUMBERS:
        texts = texts.join(F.broadcast(ids), "id", "left_semi")  # other texts need not be split
    found = _lines(texts).withColumn("c", place).join(_few(asked.select("c"), NUMBERS), "c", "left_semi").select("c", "id", "at", _words(F.col("line")).alias("words"))
    return written(found.select("c", "id", "at", tokens_of(n).alias("tokens")), "line-tokens")


def _rarity(sets: DataFrame, counters: int) -> bytes:
    """A step of the logarithm of each counter, four steps to a doubling, as a byte each."""
    block = min(counters, 1 << 10)
    counted = sets.select(F.explode("tokens").alias("h")).groupBy(F.pmod("h", F.lit(counters)).alias("k")).agg(F.count("*").alias("n"))
    every = counted.union(sets.sparkSession.range(counters).select("id", F.lit(0).cast("long"))).groupBy("k").agg(F.sum("n").alias("n"))
    step = F.char(F.least(F.lit(126), F.floor(F.log2(F.col("n") + 1) * 4) + 1).cast("int"))
    rows = every.groupBy(F.floor(F.col("k") / block).alias("b")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", step.alias("s")))), lambda x: x["s"]), "").alias("s"))
    return "".join(r["s"] for r in sorted(rows.collect(), key=lambda r: r["b"])).encode()  # `counters` bytes, whatever the input


def matches(texts: DataFrame, sifted: DataFrame, n: int = 5, num: int = 4, den: int = 5, counters: int = COUNTERS) -> DataFrame:
    """(cls, id, at, late, lines): the first place of each class of lines, whether that has an earlier match, and its lines.

    sifted are the lines of texts as _sifted leaves them.
    """
    places = sifted.groupBy("cls", "k", "id").agg(F.min("at").alias("at"), F.count("*").alias("lines"), F.min("need").alias("need"))
    classes = written(places.groupBy("cls", "k").agg(F.min("id").alias("id"), F.min_by("at", "id").alias("at"), F.sum("lines").alias("lines"), F.min("need").alias("need")), "line-classes")
    sets = _in_question(texts, sifted, classes, n)
    steps = F.lit(bytearray(_rarity(sets, counters)))

    def rank(h: Column) -> Column:
        """Rarity above 52 bits of the hash, so arrays of long sort by rarity."""
        return F.ascii(F.substr(steps, F.pmod(h, F.lit(counters)).cast("int") + 1, F.lit(1)).cast("string")).cast("long") * (1 << 52) + F.shiftrightunsigned(h, 12)

    ranked = sets.select("c", "id", "at", F.size("tokens").alias("n"), F.sort_array(F.transform("tokens", rank)).alias("ranked"))
    heads = written(ranked.select("c", "id", "at", "n", F.slice("ranked", F.lit(1), _prefix(F.col("n"), num, den)).alias("first")), "line-heads")
    postings = heads.select("c", "id", "at", "n", F.posexplode("first").alias("i", "token"))
    repeated = written(postings.groupBy("token").agg(F.count("*").alias("many")).where("many > 1").select("token"), "line-repeated")
    held = postings.join(_few(repeated, NUMBERS), "token", "left_semi").groupBy("c", "id", "at", "n").agg(F.collect_set(F.struct("i", "token")).alias("held"))
    # k: how many tokens before this one are in other prefixes too
    postings = written(held.select("c", "id", "at", "n", F.posexplode(F.sort_array("held")).alias("k", "h")).select("c", "id", "at", "n", "k", "h.*"), "line-postings")

    def near(a: str, b: str) -> Column:
        """Length and positional filters on postings of one token: what may still overlap suffices."""
        rest = F.least(F.col(f"{a}.n") - F.col(f"{a}.i"), F.col(f"{b}.n") - F.col(f"{b}.i")) + F.least(F.col(f"{a}.k"), F.col(f"{b}.k"))
        return rest * (num + den) >= (F.col(f"{a}.n") + F.col(f"{b}.n")) * num

    def earlier(a: str, b: str) -> Column:
        """The place of b is before that of a."""
        return (F.col(f"{b}.id") < F.col(f"{a}.id")) | ((F.col(f"{b}.id") == F.col(f"{a}.id")) & (F.col(f"{b}.at") < F.col(f"{a}.at")))

    def verified(pairs: DataFrame) -> DataFrame:
        """c of the pairs (c, d) whose token sets match."""
        pairs = written(pairs.distinct(), "line-pairs")
        wanted = _few(pairs.select(F.explode(F.array("c", "d")).alias("c")).distinct(), NUMBERS)
        some = sets.select("c", "tokens").join(wanted, "c", "left_semi").groupBy("c").agg(F.first("tokens").alias("tokens"))
        both = pairs.join(some.withColumnRenamed("tokens", "x"), "c").join(some.select(F.col("c").alias("d"), F.col("tokens").alias("y")), "d")
        return both.where(_similar(F.col("x"), F.col("y"), num, den)).select("c").distinct()

    first = ("id", "at", "c", "n", "i", "k")
    earliest = postings.groupBy("token").agg(F.min(F.struct(*first)).alias("h")).select("token", "h.*")
    star = postings.alias("p").join(earliest.alias("q"), "token").where(earlier("p", "q") & near("p", "q")).select(F.col("p.c").alias("c"), F.col("q.c").alias("d"))
    done = written(verified(star), "line-done")
    open_ = postings.join(_few(done, NUMBERS), "c", "left_anti")
    rest = open_.alias("p").join(postings.alias("q"), "token").where(earlier("p", "q") & near("p", "q")).select(F.col("p.c").alias("c"), F.col("q.c").alias("d"))
    late = written(done.union(verified(rest)), "line-late").select("c", F.lit(True).alias("late"))
    return classes.withColumn("c", F.xxhash64("k", "id", "at")).join(_few(late), "c", "left").select("cls", "id", "at", F.coalesce("late", F.lit(False)).alias("late"), "lines")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """docs with the later of matching lines taken out of its text, plus n_lines and removed (their numbers).

    Columns of these names go on as <name>_in.
    """
    docs = set_aside(docs, *(c for c in ("n_lines", "removed") if c not in (key, text)))
    id_, hash_ = unused(docs, "_id", "_hash")
    texts = _texts(docs, key, text)
    sifted = written(_sifted(_lines(texts), n, num, den), "line-sift")
    verdict = written(matches(texts, sifted, n, num, den).where("late OR lines > 1").select("cls", F.col("id").alias("_id"), F.col("at").alias("_at"), "late"), "line-verdict")
    later = (F.col("id") > F.col("_id")) | ((F.col("id") == F.col("_id")) & (F.col("at") > F.col("_at")))
    judged = sifted.select("id", "row_hash", "at", "cls").join(_few(verdict), "cls").where(F.col("late") | later)
    gone = written(judged.groupBy("id", "row_hash").agg(F.array_sort(F.collect_set("at")).alias("removed")).select(F.col("id").alias(id_), F.col("row_hash").alias(hash_), "removed"), "line-gone")
    if gone.agg(F.coalesce(F.sum(4 * F.size("removed") + 48), F.lit(0))).first()[0] <= SMALL_BYTES:
        gone = F.broadcast(gone)  # the texts need not be shuffled then
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.join(gone, (F.xxhash64(t) == F.col(hash_)) & (F.coalesce(F.col(key).cast("long"), F.lit(LAST)) == F.col(id_)), "left").drop(hash_, id_)
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    n_lines = F.octet_length(t) - F.octet_length(F.replace(t, F.lit("\n"), F.lit(""))) + 1
    kept = F.array_join(F.filter(F.split(t, "\n"), lambda x, i: ~F.array_contains(removed, i)), "\n")
    return out.withColumn("n_lines", n_lines.cast("long")).withColumn("removed", removed).withColumn(text, F.when(F.size("removed") == 0, F.col(text)).otherwise(kept))
