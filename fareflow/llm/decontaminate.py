"""Benchmark passages in documents: a prefix-filtered set join of word shingles.

An item's windows are its runs of ``window`` words. A window occurs in a document only if all of
its shingles do, so with shingles ordered by rarity the necessary prefix is the rarest one alone. The join:

1. rarity: how often each benchmark shingle occurs in all documents. Windows with a shingle that never
   occurs are out.
2. candidates: document positions of the windows' rarest shingles, found with a bit map of fixed size.
3. bounds: the shingle's position in its window fixes the one alignment possible; it must lie in the
   document, with the window's whole length.
4. verification: the words at that alignment are compared one by one.

Candidates carry the few words around them, so texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import free_name, parts_for, text_key, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: all ASCII characters but digits and lower-case letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 3
#: Windows looked up in one pass over the documents, and bits of the pass's filter.
WINDOWS_A_PASS = 32_768
FILTER_BITS = 1 << 20


def words(text: str = "text") -> Column:
    """The words of a text, A-Z lower-cased; a null text has none."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, BETWEEN), "")


def shingle_at(words: str | Column, i: Column, size: int) -> Column:
    """Hash of the ``size`` words from position ``i`` on."""
    own = F.col(words) if isinstance(words, str) else words
    return F.xxhash64(*[F.get(own, i + k) for k in range(size)])


def shingles_from(size: int) -> Callable[[Column], Column]:
    """The shingle of the column ``words`` that begins at a position, as a function for arrays."""
    return lambda i: shingle_at("words", i, size)


def starts(words: str, size: int) -> Column:
    """The positions where a shingle of ``size`` words begins."""
    n = F.size(words)
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each item's windows: item_id, w (words); an item of fewer words is one window, one of none has none."""
    read = items.select(F.col("item_id").cast("string").alias("item_id"), words().alias("words")).where("size(words) > 0")
    size = F.least(F.size("words"), F.lit(window))
    each = F.transform(F.sequence(F.lit(0), F.size("words") - size), lambda i: F.slice("words", i + 1, size))
    return read.select("item_id", F.explode(each).alias("w")).distinct()


def bit_map(hashes: DataFrame) -> str:
    """The 64-bit words of a bit map of the column ``h``, as text; FILTER_BITS bits at most."""
    at = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    rows = hashes.select((at / 64).cast("int").alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits"))
    found = ["0"] * (FILTER_BITS // 64)
    for row in rows.collect():
        found[row["at"]] = str(row["bits"])
    return ",".join(found)


def in_map(bits: str, h: Column) -> Column:
    at = h.bitwiseAND(F.lit(FILTER_BITS - 1))
    table = F.split(F.lit(bits), ",").cast("array<bigint>")
    return F.getbit(F.get(table, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1


def rarest(wanted: DataFrame, docs: DataFrame, sizes: list[int]) -> DataFrame:
    """Per window that may occur: w, n, size, offset and h of its rarest shingle.

    ``wanted``: one pass's windows (w, n words, size of a shingle). Counts are over all of ``docs``.
    """
    each = [
        wanted.where(F.col("size") == s).select(
            "w", "n", "size", F.explode(starts("w", s)).alias("offset")
        ).withColumn("h", shingle_at("w", F.col("offset"), s))
        for s in sizes
    ]
    shingles = written(reduce(DataFrame.union, each), "benchmark-shingles")
    bits = bit_map(shingles)
    read = docs.select(words().alias("words"))
    found = [
        F.filter(F.transform(starts("words", s), shingles_from(s)), lambda h: in_map(bits, h))
        for s in sizes
    ]
    counts = read.select(F.explode(F.concat(*found)).alias("h")).groupBy("h").agg(F.count("*").alias("found"))
    counted = shingles.join(counts, "h", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    first = F.min(F.struct("found", "offset", "h")).alias("first")
    return counted.groupBy("w", "n", "size").agg(first).where("first.found > 0").select(
        "w", "n", "size", "first.offset", "first.h"
    )


def occurrences(wanted: DataFrame, docs: DataFrame, sizes: list[int], window: int, id_col: str) -> DataFrame:
    """Where the windows of one pass occur: id, text key, start (word position), n, w."""
    prefix = written(rarest(wanted, docs, sizes), "benchmark-prefixes")
    bits = bit_map(prefix)
    read = docs.select(F.col(id_col).alias("id"), text_key().alias("key"), words().alias("words"))

    def around(size: int) -> Column:
        """The positions of the map's shingles of this size, with the words a window could take in."""
        shingle = shingles_from(size)

        def near(i: Column) -> Column:
            begin = F.greatest(i - (window - 1), F.lit(0))
            words_ = F.slice("words", begin + 1, 2 * window)
            named = {"h": shingle(i), "size": F.lit(size), "at": i, "begin": begin, "near": words_}
            return F.struct(*[c.alias(k) for k, c in named.items()])

        return F.transform(F.filter(starts("words", size), lambda i: in_map(bits, shingle(i))), near)

    candidates = read.select("id", "key", F.explode(F.concat(*map(around, sizes))).alias("c")).select("id", "key", "c.*")
    met = written(candidates, "benchmark-candidates").join(prefix, ["h", "size"])
    start = F.col("at") - F.col("offset")
    same = F.slice("near", F.greatest(start - F.col("begin"), F.lit(0)) + 1, F.col("n")) == F.col("w")
    return met.where((start >= 0) & same).select("id", "key", start.alias("start"), "n", "w")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, id_col: str = "doc_id"
) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` words lie in an occurrence of a window; ``n_items`` items have such windows, and
    ``items_sha256`` hashes their ids (sorted as strings, joined by commas). A document is contaminated if it has a
    hit and at least one word in ``share`` is hit. Null and empty texts have no words and no hits; items with null
    texts have no windows, and items with null ids hit words but are not listed. Equal windows of several items are
    looked up once and name all of them. Repeated rows come out as often as they come in.

    The benchmark is taken WINDOWS_A_PASS windows at a time, each with a pass over the documents.
    """
    spark = docs.sparkSession
    named = written(windows(benchmark, window), "benchmark-windows")
    distinct = named.select("w").distinct().withColumn("n", F.size("w")).withColumn("size", F.least("n", F.lit(SHINGLE)))
    passes = parts_for(distinct.count(), WINDOWS_A_PASS)
    sizes = sorted(r[0] for r in distinct.select("size").distinct().collect())
    none = spark.createDataFrame([], f"id {dict(docs.dtypes)[id_col]}, key long, start int, n int, w array<string>")
    found = none
    if sizes:
        dealt = distinct.withColumn("turn", F.pmod(F.xxhash64("w"), F.lit(passes)))
        for turn in range(passes):
            found = found.union(occurrences(dealt.where(F.col("turn") == turn), docs, sizes, window, id_col))
        found = written(found, "benchmark-hits")

    spans = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end"))))
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("total"))
    covered = F.aggregate(
        "spans",
        zero,
        lambda a, s: F.struct(
            F.greatest(a["upto"], s["end"]).alias("upto"),
            (a["total"] + F.greatest(s["end"] - F.greatest(a["upto"], s["start"]), F.lit(0))).alias("total"),
        ),
        lambda a: a["total"],
    )
    hits = found.groupBy("id", "key").agg(spans.alias("spans")).select("id", "key", covered.alias("n_hit"))
    listed = found.select("id", "key", "w").distinct().join(named.where("item_id is not null"), "w")
    items = listed.groupBy("id", "key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    both = hits.join(items, [hits["id"].eqNullSafe(items["id"]), hits["key"] == items["key"]], "left").select(
        hits["id"].alias("hit_id"), hits["key"].alias("hit_key"), "n_hit", "items"
    )
    base = docs.select(F.col(id_col).alias("id"), text_key().alias("key"), F.size(words()).cast("long").alias("n_words"))
    joined = base.join(both, [base["id"].eqNullSafe(both["hit_id"]), base["key"] == both["hit_key"]], "left")
    n_hit, listed = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        F.col("id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id belongs to no contaminated row."""
    (name,) = free_name(docs, ["_bad"])
    bad = decontaminate(docs, benchmark, id_col=id_col).where("contaminated").select(F.col(id_col).alias(name)).distinct()
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(name)), "left_anti")
