"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers, names and units become typed placeholders: a number is a run of digits with inner marks,
a name a capitalised word that does not begin a sentence, a unit one of a fixed list behind a
number. What is left, in lower case and without punctuation, is a template. Windows of its tokens
are hashed and joined with the windows of the benchmark. A match at an offset counts if its slots
are consistent: along the offset each value of the item stands for one value in the document, so
a question with other numbers or names is caught, a chance hit of placeholders is not.

Beside the templates, passages are found as they are: a document that holds `run` words and numbers
of an item in a row, in any case and with any punctuation, is reported whatever the coverage, and
so is one that holds the whole of an item with fewer. Scripts without spaces count by characters.

Defined results: a null or empty text matches nothing; among templates an item of fewer tokens than
a window is one window of its own length (least 4), and windows with fewer than `literal` plain words
are not used, so such items are found as they are only; repeated rows are judged one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Marks that stand before a typed token.
NUMBER, NAME, UNIT = "\u0001", "\u0002", "\u0003"
#: Units of measure and money. Fixed values.
UNITS = ["mm", "cm", "dm", "m", "km", "mg", "g", "kg", "t", "ml", "cl", "l", "s", "sec", "min", "h", "hours", "minutes", "seconds", "days", "years", "miles", "feet", "inches", "pounds", "ounces", "dollars", "euros", "cents", "percent", "%", "$", "€", "£", "°"]
TOKEN = f"[{NUMBER}{NAME}{UNIT}]?[\\p{{L}}\\p{{M}}]+|{NUMBER}[0-9][0-9.,:]*|{UNIT}[%$€£°]"
#: Scripts that put no spaces between words, and what counts as a word of a passage.
UNSPACED = "\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}\\p{IsLao}\\p{IsKhmer}\\p{IsMyanmar}"
NUMBERS = "|\\p{N}+(?:[.,:]\\p{N}+)*|[%$€£°]"
#: Where all characters of those scripts are, and few others: texts without any are cut by plainer patterns.
COARSE = "[\u0e00-\u1fff\u2e80-\\x{10ffff}]"
#: Letters alone, one character each in unspaced scripts: the words of the keys that sift documents, KEY to a key.
LETTERS, SPACED = f"[{UNSPACED}]|[\\p{{L}}\\p{{M}}&&[^{UNSPACED}]]+", "[\\p{L}\\p{M}]+"
KEY, PROBES = 5, 4
#: Rows of the benchmark's windows that may be sent to all executors: some 300 bytes each.
SMALL = 1 << 17


def tokens(text: Column) -> Column:
    """Array of tokens; typed ones begin with their mark."""
    words = "|".join(u for u in UNITS if u.isalpha())
    t = F.translate(F.coalesce(text, F.lit("")), NUMBER + NAME + UNIT, "   ")
    t = F.regexp_replace(t, r"(?<=[\p{L}\p{N},;] )(?=\p{Lu}\p{Ll})", NAME)
    t = F.regexp_replace(t, rf"(?<=[0-9] ?)(?=(?:{words})(?![\p{{L}}\p{{M}}])|[%$€£°])", UNIT)
    t = F.regexp_replace(t, r"[0-9]+(?:[.,:][0-9]+)*", f" {NUMBER}$0 ")
    return F.regexp_extract_all(t, F.lit(TOKEN), F.lit(0))


def _hashes(toks: Column) -> Column:
    return F.transform(toks, lambda t: F.xxhash64(F.when(t < F.lit("\u0004"), F.substring(t, 1, 1)).otherwise(F.lower(t))))


def _windows(hashes: Column, n: int) -> Column:
    """Hashes of all windows of n tokens, by offset; the lambda sees the array by index only."""
    last = F.size(hashes) - n
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(n)))))


def _exploded(rows: DataFrame, lengths: list[int], keep: list[str]) -> DataFrame:
    """(keep..., toks, n, at, w): one row for each window of each length."""
    arrays = F.flatten(F.array(*(F.coalesce(F.transform(_windows(F.col("h"), n), lambda w, i: F.struct(F.lit(n).alias("n"), i.alias("at"), w.alias("w"))), F.array()) for n in lengths))) if len(lengths) > 1 else None
    if arrays is None:
        return rows.select(*keep, "toks", F.lit(lengths[0]).alias("n"), F.posexplode(_windows(F.col("h"), lengths[0])).alias("at", "w"))
    return rows.select(*keep, "toks", F.explode(arrays).alias("x")).select(*keep, "toks", "x.n", "x.at", "x.w")


def _let(value: Column, use) -> Column:
    """use(value) with value made once for each row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _parts(text: Column, numbers: bool) -> Column:
    """Words of a text in lower case, with its numbers and signs or without."""
    cut = lambda t, letters: F.regexp_extract_all(t, F.lit(letters + NUMBERS * numbers), F.lit(0))
    return _let(F.lower(F.coalesce(text, F.lit(""))), lambda t: F.when(t.rlike(COARSE), cut(t, LETTERS)).otherwise(cut(t, SPACED)))


class Sift:
    """Which documents can hold anything of the benchmark: a table of bits for hashed keys.

    A key is KEY words in a row, words being letters alone. What matches in a document and an item has
    the same words in the same order there, so a window with KEY words, or a template window with so
    many plain tokens in a row, cannot match without a key. Windows with fewer have their longest
    token for a key of their own kind; for templates only where the others cannot make up `cover`.
    So no match is lost; a bit that is set by chance only lets a document through.
    """

    def __init__(self, keys: DataFrame, single: bool):
        """keys has one column k of the hashes; each sets PROBES bits, and there are 256 bits to a key as far as the table's bound allows."""
        self.single = single
        count = keys.count()
        self.words = 1 << min(16, max(10, (4 * count).bit_length()))  # 64 bits each: at most 512 KB
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
        table = [0] * self.words
        for r in keys.select(F.explode(F.array(*(self._place(F.col("k"), i) for i in range(PROBES)))).alias("p")).groupBy(F.shiftright("p", 6).cast("int").alias("w")).agg(F.bit_or(bit).alias("b")).collect():  # a bounded number of rows
            table[r["w"]] = r["b"]
        self.none, self.table = count == 0, F.from_json(F.lit("[" + ",".join(map(str, table)) + "]"), "array<bigint>")

    def _place(self, key: Column, probe: int) -> Column:
        return F.shiftrightunsigned(key, 13 * probe).bitwiseAND(F.lit(64 * self.words - 1))

    def _set(self, key: Column) -> Column:
        def probe(i: int) -> Column:
            p = self._place(key, i)
            return F.bit_get(F.get(self.table, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1

        return reduce(lambda a, i: a & probe(i), range(1, PROBES), probe(0))

    def holds(self, text: Column) -> Column:
        if self.none:
            return F.lit(False)
        hashes = F.transform(_parts(text, self.single), lambda t: F.xxhash64(t))
        return F.exists(hashes if self.single else _let(hashes, _keys), self._set)


def _keys(h: Column) -> Column:
    """Hashes of all KEY successive ones of an array of hashes."""
    return F.when(F.size(h) >= KEY, F.transform(F.sequence(F.lit(0), F.size(h) - KEY), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(KEY))))).otherwise(F.array().cast("array<bigint>"))


def _longest(parts: Column) -> Column:
    """The longest of some tokens, of equal ones the first."""
    return F.array_max(F.transform(parts, lambda t: F.struct(F.length(t), t.alias("t")))).getField("t")


def sifted(docs: DataFrame, items: DataFrame, windows: DataFrame, text: str, cover: float, run: int) -> DataFrame:
    """The rows of docs (with `text`) that can hold a template window or a passage of the items.

    windows are the template windows in use: item, said (tokens), windows (of the item).
    """
    words = items.select(F.col("item"), _parts(F.col("text"), False).alias("p"), _parts(F.col("text"), True).alias("q"))
    keys = words.select(F.explode(_let(F.transform("p", lambda t: F.xxhash64(t)), _keys)).alias("k")).distinct()
    # passages with fewer words than a key
    own = F.least(F.size("q"), F.lit(run))
    passages = words.where(F.size("q") > 0).select(F.explode(F.transform(F.sequence(F.lit(0), F.size("q") - own), lambda i: F.slice("q", i + 1, own))).alias("said"))
    letters = F.size(F.filter("said", lambda t: t.rlike("^[\\p{L}\\p{M}]")))
    short = passages.where(letters < KEY).select(_longest(F.col("said")).alias("t"))
    # template windows without so many plain tokens in a row, where they might make up the cover
    plain = F.transform("said", lambda t: F.when(t < F.lit("\u0004"), F.lit("|")).otherwise(F.lit("x")))
    good = F.array_join(plain, "").contains("x" * KEY)
    poor = windows.groupBy("item").agg(F.first("windows").alias("windows"), F.count(F.when(~good, 1)).alias("poor")).where(F.col("poor") >= F.col("windows") * F.lit(cover)).select("item")
    weak = windows.where(~good).join(poor, "item", "left_semi").select(F.get(_parts(_longest(F.filter("said", lambda t: t >= F.lit("\u0004"))), True), F.lit(0)).alias("t"))
    single = short.union(weak).select(F.xxhash64("t").alias("k")).distinct()
    some, one = Sift(keys, False), Sift(single, True)
    return docs.where(some.holds(F.col(text)) | one.holds(F.col(text)))


def _copied(docs: DataFrame, items: DataFrame, text: str, run: int) -> DataFrame:
    """Pairs of a document and an item of which it holds `run` words in a row, or all if there are fewer; windows are of that length."""
    words = _parts(F.col(text), True)
    hashed = F.transform("toks", lambda t: F.xxhash64(t))
    bench = items.select("item", words.alias("toks")).where(F.size("toks") > 0).withColumn("h", hashed)
    own = F.least(F.size("toks"), F.lit(run))
    lengths = sorted(r["n"] for r in bench.select(own.alias("n")).distinct().collect()) or [run]  # at most `run` lengths
    bench = _exploded(bench, lengths, ["item"]).where(F.col("n") == own)
    bench = bench.select("item", "n", F.col("at").alias("j"), "w", F.slice("toks", F.col("at") + 1, F.col("n")).alias("said")).withColumn("windows", F.expr("count(*) over (partition by item)"))
    if bench.count() <= SMALL:
        bench = F.broadcast(bench)
    rows = docs.select("id", "row_hash", "row", words.alias("toks")).withColumn("h", hashed)
    hits = _exploded(rows, lengths, ["id", "row_hash", "row"]).join(bench, ["w", "n"]).where(F.slice("toks", F.col("at") + 1, F.col("n")) == F.col("said"))
    found = hits.groupBy("row", "item").agg(F.first("id").alias("id"), F.first("row_hash").alias("row_hash"), F.first("windows").alias("windows"), F.size(F.collect_set("j")).cast("long").alias("matched"))
    none = F.lit(0).cast("long")
    return found.select("id", "item", "windows", "matched", (F.col("matched") / F.col("windows")).alias("coverage"), none.alias("slots"), none.alias("changed"), "row_hash")


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text", window: int = 8, cover: float = 0.5, literal: int = 3, run: int = 13) -> DataFrame:
    """Pairs of a document and an item whose windows it holds to a share of `cover` or more, or of which it holds `run` words in a row.

    Columns: key, item, windows (of the item), matched, coverage, slots and changed (slots of the
    match whose values differ), row_hash (of the document's text, for joins with docs). Pairs that
    only the run finds have its windows and no slots.
    """
    items = items.select(F.col(item).alias("item"), F.col(text).alias("text"))
    bench = items.select("item", tokens(F.col("text")).alias("toks")).withColumn("h", _hashes(F.col("toks")))
    sizes = [r["n"] for r in bench.where(F.size("toks") >= 4).select(F.least(F.size("toks"), F.lit(window)).alias("n")).distinct().collect()]  # at most window - 3 lengths
    lengths = sorted(set(sizes)) or [window]
    plain = F.size(F.filter(F.slice("toks", F.col("at") + 1, F.col("n")), lambda t: t >= F.lit("\u0004")))
    bench = _exploded(bench, lengths, ["item"]).where((F.col("n") == F.least(F.size("toks"), F.lit(window))) & (plain >= literal))
    bench = bench.select("item", "n", F.col("at").alias("j"), "w", F.slice("toks", F.col("at") + 1, F.col("n")).alias("said")).withColumn("windows", F.expr("count(*) over (partition by item)"))
    bench = written(bench, "item-windows")
    docs = sifted(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), items, bench, "text", cover, run)
    docs = written(docs.select("id", "text", F.xxhash64("text").alias("row_hash"), F.monotonically_increasing_id().alias("row")), "leak-candidates")
    if bench.count() <= SMALL:
        bench = F.broadcast(bench)
    rows = docs.select("id", "row_hash", "row", tokens(F.col("text")).alias("toks")).withColumn("h", _hashes(F.col("toks")))
    hits = _exploded(rows, lengths, ["id", "row_hash", "row"]).join(bench, ["w", "n"])
    hits = hits.withColumn("has", F.slice("toks", F.col("at") + 1, F.col("n")))
    fine = F.size(F.filter(F.arrays_zip("said", "has"), lambda x: F.when(x.said < F.lit("\u0004"), F.substring(x.said, 1, 1) != F.substring(x.has, 1, 1)).otherwise(F.lower(x.said) != F.lower(x.has)))) == 0
    slots = F.transform(F.filter(F.arrays_zip("said", "has"), lambda x: x.said < F.lit("\u0004")), lambda x: F.struct(x.said.alias("a"), x.has.alias("b")))
    # hash hits that differ in truth go here; then all slots along an offset are looked at together
    lined = hits.where(fine).select("id", "row_hash", "row", "item", "windows", "j", (F.col("at") - F.col("j")).alias("shift"), slots.alias("s"))
    along = lined.groupBy("row", "item", "shift").agg(F.first("id").alias("id"), F.first("row_hash").alias("row_hash"), F.first("windows").alias("windows"), F.collect_set("j").alias("js"), F.array_distinct(F.flatten(F.collect_set("s"))).alias("s"))
    consistent = F.size("s") == F.size(F.array_distinct(F.transform("s", lambda x: x.a)))
    found = along.where(consistent).groupBy("row", "item").agg(
        F.first("id").alias("id"), F.first("row_hash").alias("row_hash"), F.first("windows").alias("windows"),
        F.size(F.array_distinct(F.flatten(F.collect_list("js")))).cast("long").alias("matched"), F.sum(F.size("s")).alias("slots"),
        F.sum(F.size(F.filter("s", lambda x: x.a != x.b))).alias("changed"),
    )
    found = found.withColumn("coverage", F.col("matched") / F.col("windows")).where(F.col("coverage") >= cover)
    found = found.select("id", "item", F.col("windows").cast("long").alias("windows"), "matched", "coverage", F.col("slots").cast("long").alias("slots"), F.col("changed").cast("long").alias("changed"), "row_hash")
    copied, known = _copied(docs, items, "text", run).alias("c"), found.select("id", "item", "row_hash").distinct().alias("f")
    copied = copied.join(known, F.col("c.id").eqNullSafe(F.col("f.id")) & F.col("c.item").eqNullSafe(F.col("f.item")) & (F.col("c.row_hash") == F.col("f.row_hash")), "left_anti")
    return found.unionByName(copied).withColumnsRenamed({"id": key, "item": item})
