"""Language identification by language-bitmask n-gram filters.

A bit-sliced Bloom filter is a table of rows with one bit for each language. An n-gram of a language sets
that language's bit in the rows its hashes name; the rows of an n-gram, and-ed together, are the
set of languages that contain it, for all languages in one look-up. A text's n-grams are looked
up, each language's bits are counted, the counts are corrected for the filter's false positives,
and the language with the largest count wins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
#: Odd multipliers of the filter's multiplicative hashes, one for each row an n-gram sets.
HASHES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Characters worked on at a time, unless one text is longer.
CHARS_AT_ONCE = 400_000
SPACE, END = 32, 0


@cache
def letter_table() -> np.ndarray:
    """Per code point: its lower case if it is a letter, a space otherwise, END for the end mark."""
    table = np.full(0x110000, SPACE, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    table[END] = END
    return table


def trigrams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All trigrams of the texts' letters, the text each is from, and which texts have a letter.

    Other characters part words and count as one space; words also begin and end at the text's ends.
    Each character has 21 bits of the number, so different trigrams have different numbers.
    """
    line = "\0".join(f" {t.replace(chr(0), ' ')} " for t in texts)
    codes = letter_table()[np.frombuffer(line.encode("utf-32-le"), dtype="<u4")]
    blank = codes == SPACE
    codes = codes[~(blank & np.append(False, blank[:-1]))].astype(np.uint64)
    text_of = np.cumsum(codes == END)
    if len(codes) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(texts), bool)
    grams = codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:]
    whole = (codes[:-2] != END) & (codes[1:-1] != END) & (codes[2:] != END)
    lettered = np.zeros(len(texts), bool)
    lettered[text_of[(codes != SPACE) & (codes != END)]] = True
    return grams[whole], text_of[:-2][whole], lettered


def rows_of(grams: np.ndarray, bits: int) -> list[np.ndarray]:
    """The filter rows of each n-gram."""
    mixed = grams ^ (grams >> np.uint64(29))
    return [(mixed * np.uint64(h)) >> np.uint64(64 - bits) for h in HASHES]


@dataclass(frozen=True)
class LanguageFilter:
    """``masks[w, r]``: bits of languages 64 w … 64 w + 63 in row r; ``languages`` by training share."""

    languages: tuple[str, ...]
    masks: np.ndarray

    @property
    def bits(self) -> int:
        return self.masks.shape[1].bit_length() - 1

    def false_rates(self) -> np.ndarray:
        """Chance that an n-gram outside a language has its bit all the same."""
        rates = [(self.masks[i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(self.languages))]
        return np.array(rates) ** len(HASHES)

    def judge(self, texts: Sequence[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        grams, text_of, lettered = trigrams(texts)
        n = np.bincount(text_of, minlength=len(texts))
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        rows, false = rows_of(grams, self.bits), self.false_rates()
        held = np.zeros((len(self.languages), len(texts)))
        for word, masks in enumerate(self.masks):
            found = masks[rows[0]]
            for r in rows[1:]:
                found &= masks[r]
            for bit in range(min(64, len(self.languages) - 64 * word)):
                hit = text_of[(found >> np.uint64(bit) & np.uint64(1)).astype(bool)]
                held[64 * word + bit] = np.bincount(hit, minlength=len(texts))
        true = np.maximum(0, held - n * false[:, None]) / np.maximum(1e-9, 1 - false)[:, None]
        best = true.argmax(axis=0)
        score = np.where(lettered, np.minimum(1, true.max(axis=0) / np.maximum(n, 1)), 0.0)
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered, strict=True)]
        return names, score.tolist()


def chunks(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, text in enumerate(texts):
        if total + len(text) > CHARS_AT_ONCE and i > start:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def fit(labelled: DataFrame, min_rate: float = 4e-6, keep_ratio: float = 0.1, bits: int = 19) -> LanguageFilter:
    """Learn the filter from all rows of ``labelled`` (columns text, lang; rows with nulls are left out).

    An n-gram belongs to a language if its share of that language's n-grams is at least
    ``min_rate`` and at least ``keep_ratio`` of its largest share in any language. Shares sum to one, so a
    language has at most 1 / min_rate n-grams, whatever the corpus: that bounds what the driver
    gathers. The filter has 2 ** bits rows. Counts are made in the tasks and summed by n-gram.
    """
    spark = labelled.sparkSession

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1).to_numpy(zero_copy_only=False)
            texts = batch.column(0).to_pylist()
            for lang in set(langs):
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                parts = [np.unique(trigrams(own[a:b])[0], return_counts=True) for a, b in chunks(own)]
                grams, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(at, np.concatenate([p[1] for p in parts]), len(grams)).astype(np.int64)
                arrays = [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "gram", "n"])

    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    counts = rows.mapInArrow(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_gram = counts.groupBy("gram").agg(F.collect_list(F.struct("lang", "n")).alias("found"))
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    names = tuple(sorted(totals, key=lambda x: (-totals[x], x)))
    masks = np.zeros((max(1, -(-len(names) // 64)), 1 << bits), dtype=np.uint64)
    if not names:
        return LanguageFilter(names, masks)
    share = F.element_at(F.create_map(*[F.lit(x) for k, v in totals.items() for x in (k, float(v))]), F.col("x.lang"))
    rated = by_gram.select("gram", F.explode("found").alias("x"), "found").drop("found")
    rated = rated.select("gram", "x.lang", (F.col("x.n") / share).alias("rate"))
    top = rated.groupBy("gram").agg(F.max("rate").alias("top"))
    kept = rated.join(top, "gram").where((F.col("rate") >= min_rate) & (F.col("rate") >= keep_ratio * F.col("top")))
    found = kept.select("lang", "gram").toPandas()
    for i, name in enumerate(names):
        grams = found.loc[found["lang"] == name, "gram"].to_numpy().view(np.uint64)
        for rows_ in rows_of(grams, bits):
            masks[i // 64][rows_] |= np.uint64(1 << i % 64)
    return LanguageFilter(names, masks)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is one that the filter must not learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_language(docs: DataFrame, model: LanguageFilter, text_col: str = "text", out: str = "judged") -> DataFrame:
    """``docs`` with a struct ``out`` of ``lang`` and ``score`` (0 to 1) read off the text alone.

    A null text, and one without a letter, is ``und`` with score 0. The score is the share of the text's
    n-grams that the language holds, corrected for false positives; a tie goes to the language with more
    training text. Texts are judged whole. The filter is broadcast; ``bits`` of ``fit`` bounds its size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in batches:
            texts = batch.to_pylist()
            names, scores = [], []
            for a, b in chunks(texts):
                one = model.judge(texts[a:b])
                names += one[0]
                scores += one[1]
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
            )

    return docs.withColumn(out, judged(F.coalesce(F.col(text_col), F.lit(""))))


def identify(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Learn from the documents that are not held out, and judge all: id, held_out, lang_pred, score."""
    model = fit(docs.where(~held_out(id_col)))
    return with_language(docs.select(id_col, "text"), model).select(
        id_col, held_out(id_col).alias("held_out"), F.col("judged.lang").alias("lang_pred"), "judged.score"
    )
