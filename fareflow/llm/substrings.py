"""Removal of repeated passages: an FM-index per shard, and matching statistics of the documents streamed through it.

A passage is a window of ``window`` consecutive words. All copies of a window must meet in one shard without pairing
documents: a window belongs to its minimizer, the least hash of its runs of ``MER`` words, so neighbouring windows with one
minimizer travel together as one run of words. Runs whose minimizer occurs once in the corpus hold no repeated
window and stay at home. Equal runs are one row, with the smallest document that has it.

A shard holds the runs of some minimizers. It builds a compressed FM-index of them, streams the runs through it by
backward search, and reports the windows that a smaller document has too. A minimizer with very many different
runs (a phrase in many contexts) is dealt window by window instead, each to the shard of its own words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import dropped, kept, parts_for
from fareflow.llm.fm_index import FMIndex
from fareflow.llm.pieces import ragged, runs, sums

#: Words of the hashed runs among which a window's minimizer is the least.
MER = 4
#: Windows of one run at most, different runs of one minimizer at most, runs of a shard on average.
RUN_WINDOWS, MANY_RUNS, SHARD_RUNS = 64, 1_000, 60_000
#: Bytes of texts worked on at a time (or one longer text).
BYTES_AT_ONCE = 8_000_000
_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words_of(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """The words of all texts (what ASCII white space parts), and how many each has. No text may be null."""
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    some = pc.greater(pc.binary_length(words), 0)
    sizes = sums(some.to_numpy(zero_copy_only=False).astype(np.int64), lists.value_lengths().to_numpy().astype(np.int64))
    return words.filter(some), sizes


def word_hashes(words: pa.StringArray) -> np.ndarray:
    coded = words.dictionary_encode()
    own = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)
    return own[coded.indices.to_numpy()] if len(words) else np.empty(0, np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def runs_of_windows(hashes: np.ndarray, sizes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows with one minimizer: first word, words, minimizer, digest, and runs of each text.

    ``hashes``: of all words, one text after another; ``sizes``: words of each text.
    """
    mer, n = min(MER, window), len(hashes)
    ends = np.cumsum(sizes)
    n_windows = np.maximum(sizes - window + 1, 0)
    places = ragged(ends - sizes, n_windows)
    if not len(places):
        return (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32), np.zeros(len(sizes), np.int64))
    least = np.zeros(n - mer + 1, np.uint64)
    for k in range(mer):
        least = least * _FACTOR + hashes[k : n - mer + 1 + k]
    least = mixed(least)
    # The least of 1, 2, 4, … neighbours, then of all that a window has.
    span, many = 1, window - mer + 1
    while 2 * span <= many:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if many > span:
        least = np.minimum(least[: len(least) - (many - span)], least[many - span :])
    least = least[places]
    new = np.append(True, (least[1:] != least[:-1]) | (places[1:] != places[:-1] + 1))
    text_first = (np.cumsum(n_windows) - n_windows)[n_windows > 0]
    new[text_first] = True
    # Long runs are cut; a window's minimizer, and so its shard, stays what it is.
    begin = np.flatnonzero(new)
    nth = np.arange(len(places)) - np.repeat(begin, np.diff(np.append(begin, len(places))))
    begin = np.flatnonzero(nth % RUN_WINDOWS == 0)
    count = np.diff(np.append(begin, len(places)))
    first, last = places[begin], places[begin] + count + window - 2
    digest = mixed(hashes[first] * _FACTOR + hashes[last] + mixed(hashes[np.minimum(first + 1, last)]) * _MIX + hashes[np.maximum(last - 1, first)])
    n_runs = np.diff(np.searchsorted(begin, np.append(0, np.cumsum(n_windows))))
    return first, count + window - 1, least[begin].view(np.int64), digest.view(np.int64).astype(np.int32), n_runs


def document_runs(docs: DataFrame, window: int) -> DataFrame:
    """id, h and the runs of each document: start (its first word), size (words), least (minimizer), digest."""

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, start, end in runs(batch.column(2), BYTES_AT_ONCE):
                words, sizes = words_of(texts)
                first, size, least, digest, n_runs = runs_of_windows(word_hashes(words), sizes, window)
                first = first - np.repeat(np.cumsum(sizes) - sizes, n_runs)
                offsets = pa.array(np.append(0, np.cumsum(n_runs)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (first.astype(np.int32), size.astype(np.int32), least, digest)]
                own = [batch.column(i).slice(start, end - start) for i in range(2)]
                yield pa.RecordBatch.from_arrays([*own, *lists], ["id", "h", "start", "size", "least", "digest"])

    kind = dict(docs.dtypes)["id"]
    schema = f"id {kind}, h int, start array<int>, size array<int>, least array<long>, digest array<int>"
    return docs.mapInArrow(found, schema)


def run_texts(docs: DataFrame, window: int) -> DataFrame:
    """The words of the chosen runs (``chosen``: start, size, many, least) of each document; of many, window by window."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, start, end in runs(batch.column(2), BYTES_AT_ONCE):
                words, sizes = words_of(texts)
                chosen = batch.column(3).slice(start, end - start)
                each = chosen.flatten()
                at, size, many, least = (each.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                owner = np.repeat(np.arange(end - start), chosen.value_lengths().to_numpy())
                parts = np.where(many, size - window + 1, 1)
                nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
                owner, many, least = (np.repeat(x, parts) for x in (owner, many, least))
                at, size = np.repeat(at, parts) + nth, np.where(many, window, np.repeat(size, parts))
                base = (np.cumsum(sizes) - sizes)[owner]
                offsets = pa.array(np.append(0, np.cumsum(size)).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, words.take(pa.array(ragged(base + at, size))))
                own = [batch.column(i).slice(start, end - start).take(pa.array(owner)) for i in range(2)]
                out = [*own, pa.array(at.astype(np.int32)), pa.array(size.astype(np.int32)), pc.binary_join(lists, " "), pa.array(least), pa.array(many)]
                yield pa.RecordBatch.from_arrays(out, ["id", "h", "start", "size", "words", "least", "many"])

    kind = dict(docs.dtypes)["id"]
    schema = f"id {kind}, h int, start int, size int, words string, least long, many boolean"
    return docs.select("id", "h", "text", "chosen").mapInArrow(cut, schema)


def intervals(places: np.ndarray, window: int) -> list[tuple[int, int]]:
    """What windows at these places (sorted) cover, as few ranges."""
    cuts = np.flatnonzero(np.diff(places) > window)
    firsts, lasts = np.append(places[:1], places[cuts + 1]), np.append(places[cuts], places[-1:])
    return list(zip(firsts.tolist(), (lasts + window).tolist(), strict=True))


def repeated_windows(distinct: DataFrame, window: int) -> DataFrame:
    """Per run that some document has to lose words of: words, least_id, and what the smallest document loses.

    ``distinct``: shard, words, least_id, most_id.
    """

    def shard(table: pa.Table) -> pa.Table:
        texts = table["words"].combine_chunks()
        words, sizes = words_of(texts)
        numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
        # Each run is followed by a 0 in the index.
        starts = np.cumsum(sizes + 1) - sizes - 1
        text = np.zeros(int(sizes.sum()) + len(sizes), np.int64)
        text[ragged(starts, sizes)] = numbers
        index = FMIndex(text, window)
        places, first, last = index.matching(text, starts, sizes)
        owner = np.repeat(np.arange(len(sizes)), sizes + 1)
        least = table["least_id"].to_numpy()
        # The smallest document of each range of rows; equal windows share their range, different ones are apart.
        rows, back = np.unique(first, return_inverse=True)
        ends = np.zeros(len(rows), np.int64)
        ends[back] = last
        by_row = np.append(least[owner[index.places]], 0)
        smallest = np.minimum.reduceat(by_row, np.stack([rows, ends], 1).ravel())[::2][back] if len(rows) else first
        taken = smallest < least[owner[places]]
        places = np.sort(places[taken])
        run = owner[places]
        lost: list[list[tuple[int, int]]] = [[] for _ in range(len(sizes))]
        for r, own in zip(np.unique(run).tolist(), np.split(places, np.flatnonzero(np.diff(run)) + 1), strict=False):
            lost[r] = intervals(own - starts[r], window)
        wanted = [i for i, (own, more) in enumerate(zip(lost, pc.greater(table["most_id"], table["least_id"]).to_pylist(), strict=True)) if own or more]
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        ranges = pa.array([[{"a": a, "b": b} for a, b in lost[i]] for i in wanted], kind)
        return pa.table({"words": texts.take(pa.array(wanted, pa.int64())), "least_id": table["least_id"].take(pa.array(wanted, pa.int64())), "lost": ranges})

    schema = "words string, least_id long, lost array<struct<a:int,b:int>>"
    return distinct.groupBy("shard").applyInArrow(shard, schema)


def without_words(docs: DataFrame) -> DataFrame:
    """id, n_words, n_removed, kept of each document (id, text, lost): ``kept`` are its other words, joined by one space."""

    def kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, start, end in runs(batch.column(1), BYTES_AT_ONCE):
                words, sizes = words_of(texts)
                lost = batch.column(2).slice(start, end - start)
                n_lost = np.nan_to_num(lost.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                base = np.repeat(np.cumsum(sizes) - sizes, n_lost)
                a, b = (lost.flatten().field(i).to_numpy(zero_copy_only=False).astype(np.int64) + base for i in range(2))
                open_ = np.zeros(len(words) + 1, np.int64)
                np.add.at(open_, a, 1)
                np.add.at(open_, b, -1)
                stays = np.cumsum(open_)[:-1] == 0
                left = sums(stays.astype(np.int64), sizes)
                offsets = pa.array(np.append(0, np.cumsum(left)).astype(np.int32))
                rest = pc.binary_join(pa.ListArray.from_arrays(offsets, words.filter(pa.array(stays))), " ")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(sizes), pa.array(sizes - left), rest],
                    ["id", "n_words", "n_removed", "kept"],
                )

    kind = dict(docs.dtypes)["id"]
    return docs.select("id", "text", "lost").mapInArrow(kept, f"id {kind}, n_words long, n_removed long, kept string")


def remove_repeated(
    docs: DataFrame,
    window: int = 13,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_runs: int = SHARD_RUNS,
    many_runs: int = MANY_RUNS,
) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_removed, kept (the text's words that stay, joined by one space).

    Words are what ASCII white space parts. A word goes if a window of ``window`` consecutive words covers it whose words
    also follow one another in a row with a smaller id; windows are those of the input. So of all documents with a passage
    the smallest id keeps it, a document does not lose what only itself repeats, and rows with one id do not take words
    from each other. Rows with a null id lose nothing and take nothing. A null text has no words; a text of fewer words than a
    window stays whole. Texts of any length are taken whole. An empty table gives an empty table.
    """
    spark, text, key = docs.sparkSession, F.coalesce(F.col(text_col), F.lit("")), ["id", "h"]
    # Rows with one id are told apart by a hash of their texts.
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.hash(text).alias("h"), text.alias("text"))
    named = rows.where("id is not null")
    found, found_at = kept(document_runs(named, window).where("size(start) > 0"), "document-runs")
    each = found.select(*key, F.explode(F.arrays_zip("start", "size", "least", "digest")).alias("run")).select(*key, "run.*")
    many = (F.count("*") > many_runs) & (F.min("digest") != F.max("digest"))
    shared = each.groupBy("least").agg(many.alias("many"), F.count("*").alias("n")).where("n > 1").drop("n")
    shared, shared_at = kept(shared, "shared-minimizers")
    # Repeated rows of one document have the same runs: a set holds them once.
    chosen = each.drop("digest").join(shared, "least").groupBy(*key).agg(F.collect_set(F.struct("start", "size", "many", "least")).alias("chosen"))
    chosen, chosen_at = kept(chosen, "chosen-runs")
    dropped(spark, found_at, shared_at)
    place = F.when(F.col("many"), F.xxhash64("words")).otherwise(F.col("least"))
    cut = run_texts(named.join(chosen, key), window)
    cut, cut_at = kept(cut.select(*key, "start", "size", "words", place.alias("place")), "run-texts")
    dropped(spark, chosen_at)
    distinct = cut.groupBy("words", "place").agg(F.min("id").alias("least_id"), F.max("id").alias("most_id"))
    distinct, distinct_at = kept(distinct, "distinct-runs")
    shards = parts_for(distinct.count(), shard_runs)
    indexed = distinct.withColumn("shard", F.pmod(F.hash("place"), F.lit(shards)))
    lost, lost_at = kept(repeated_windows(indexed, window), "lost-words")
    dropped(spark, distinct_at)
    word_key = [F.xxhash64("words").alias("w1"), F.xxhash64(F.lit(1), "words").alias("w2")]
    lost, cut = lost.select(*word_key, "least_id", "lost"), cut.select(*key, "start", "size", *word_key)
    whole = F.array(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("size")).alias("b")))
    moved = F.transform("lost", lambda r: F.struct((r["a"] + F.col("start")).alias("a"), (r["b"] + F.col("start")).alias("b")))
    ranges = cut.join(lost, ["w1", "w2"]).select(*key, F.explode(F.when(F.col("id") > F.col("least_id"), whole).otherwise(moved)).alias("range"))
    by_doc, _ = kept(ranges.groupBy(*key).agg(F.collect_set("range").alias("lost")), "lost-ranges")
    dropped(spark, cut_at, lost_at)
    result = without_words(rows.join(by_doc, key, "left"))
    return result.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept")
