"""Token counts of whole texts by rank-synchronous merging of ragged arrays.

The pre-tokens of a batch lie one after another in one flat numpy array of symbol ids. In each
round every pre-token looks up the ranks of its neighbouring pairs, finds its own lowest rank, and
merges all pairs of that rank at once; a pre-token without a known pair is finished. What is left
of a pre-token are its tokens, so only their number is kept.

Texts are cut at spaces first. No pre-token of the vocabulary spans white space, so the pieces count
on their own, and a piece seen before needs no second merging.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.memory import Memory

#: Pieces whose counts a Python worker remembers, in either of two generations.
REMEMBERED = 400_000
#: Symbols merged at a time, which bounds the arrays of one round.
SYMBOLS_A_ROUND = 2_000_000

# The white space of the tokenizer library's regular expressions.
WHITE = r"\t\n\v\f\r \x85\xa0  -     　"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class PairMerger:
    """Counts the tokens of texts for a byte-level vocabulary whose words have an end mark."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.width = max(vocab.values()) + 1
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], dtype=np.int64)
        left, right, made = (
            np.array(ids, dtype=np.int64)
            for ids in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]), strict=True)
        )
        pairs = left * self.width + right
        order = np.argsort(pairs)
        self.pairs, self.ranks, self.made = pairs[order], order, made[order]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_at = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.marks = {s[0] for s in self.special}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", WHITE))
        self.seen = Memory(self.learn, REMEMBERED)

    def normal(self, text: str) -> str:
        """Composed and lower-cased character by character (a final sigma is no exception)."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pre_tokens(self, piece: str) -> tuple[list[bytes], int]:
        """The pre-tokens of a piece, and how many special tokens it holds besides."""
        parts = self.special_at.split(piece) if self.marks.intersection(piece) else [piece]
        return [w.encode() for part in parts for w in self.words.findall(self.normal(part))], len(parts) - 1

    def merged(self, words: Sequence[bytes]) -> np.ndarray:
        """Number of tokens of each pre-token; none may be empty."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols, ends = self.inner[raw], np.cumsum(lengths)
        symbols[ends - 1] = self.last[raw[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        counts = np.ones(len(words), dtype=np.int64)
        none = len(self.pairs)
        while len(symbols):
            key = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.pairs, key), none - 1)
            known = (self.pairs[at] == key) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(known, self.ranks[at], none), none)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(starts, len(owner)))
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == none
            counts[owner[starts[done]]] = sizes[done]
            merge = (rank == np.repeat(lowest, sizes)) & (rank < none)
            # Of pairs that overlap (as in "aaa") every second one is merged, from the left.
            run = np.flatnonzero(merge[1:] & merge[:-1]) + 1
            if len(run):
                head = np.flatnonzero(merge & ~np.append(False, merge[:-1]))
                merge[run] &= (run - head[np.searchsorted(head, run, side="right") - 1]) % 2 == 0
            first = np.flatnonzero(merge)
            symbols[first] = self.made[at[first]]
            keep = np.repeat(~done, sizes)
            keep[first + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def learn(self, pieces: Sequence[str]) -> list[int]:
        """Tokens of pieces not met before."""
        owner, words, counts = [], [], np.zeros(len(pieces), dtype=np.int64)
        for i, piece in enumerate(pieces):
            found, counts[i] = self.pre_tokens(piece)
            words += found
            owner += [i] * len(found)
        for a, b in slices_of([len(w) for w in words], SYMBOLS_A_ROUND):
            np.add.at(counts, owner[a:b], self.merged(words[a:b]))
        return counts.tolist()

    def count(self, texts: Sequence[str]) -> list[int]:
        """Tokens of each text."""
        pieces = [text.replace("\n", " ").split(" ") for text in texts]
        tokens = self.seen.of(set(chain.from_iterable(pieces)))
        return [sum(map(tokens, own)) for own in pieces]


@cache
def merger_of(path: str) -> PairMerger:
    """One merger for each Python worker, so that later tasks find what earlier ones have met."""
    return PairMerger(path)


def slices_of(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes sum to ``most``, or one item that is larger."""
    start = total = 0
    for i, size in enumerate(sizes):
        if total + size > most and i > start:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``).

    A null text counts as an empty one: 0 bytes, 0 tokens. Texts of any length are counted whole;
    repeated rows come out as often as they come in. ``vocabulary`` is the path of a
    tokenizer file that every executor can read (it belongs to an installed package).
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = merger_of(vocabulary)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            counts: list[int] = []
            for a, b in slices_of([len(t) for t in texts], 1_000_000):
                counts += merger.count(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(
        F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    kind = dict(read.dtypes)["id"]
    out = read.mapInArrow(counted, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
