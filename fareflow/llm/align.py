"""Alignment of two tokenizers' tokens: divide and conquer at shared cuts.

Both tokenizers spell the same bytes. A byte offset where a token of either ends is a shared cut. An interval
of tokens is searched for the shared cut nearest to its middle: the end of the middle A token is looked for among the B
ends by bisection, the next B end among the A ends, and so on to the right, then to the left. Both halves are searched
in turn; an interval without a shared cut inside is a group. All open intervals of many texts are searched at once.

An A and a B token whose byte ranges lie in one group are linked. How many texts hold a pair of ids linked is counted
over the whole corpus, so each text is then scored by its links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import written
from fareflow.llm.pieces import PieceIds, piece_rows, ragged, runs, sums
from fareflow.llm.token_files import Encoder

#: Bytes of remembered pieces, and of texts worked on at a time (or one longer text).
REMEMBERED = 192 << 20
BYTES_AT_ONCE = 2_000_000
#: Groups with more links than this are counted by distinct ids instead of link by link.
MANY_LINKS = 256
#: Most pairs of ids whose counts are broadcast; beyond it they are joined by a shuffle.
MOST_BROADCAST = 1_000_000
#: Bits of a row's number that count the rows of its task.
ROW_BITS = 40


class TwoTokenizers:
    """Token ids of a space and a text, by a byte-level vocabulary (A) and a sentencepiece model (B).

    B adds the space itself. Texts are cut into pieces where a space follows a letter or mark, which neither joins.
    """

    def __init__(self, a_path: str, b_path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.a, self.b = Encoder(a_path, 0, special_as_text=True), SentencePieceProcessor(model_file=b_path)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in name.lstrip("▁") for name in names):
            raise ValueError("the model joins what stands before a space with what follows it")
        self.space = names.index("▁")
        vocabulary = self.a.library.get_vocab(with_added_tokens=False)
        self.a_sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.a_sizes[list(vocabulary.values())] = [len(name) for name in vocabulary]
        self.b_bytes = [
            bytes([int(name[3:-1], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.pieces = PieceIds(self.learn, [np.dtype(np.int32), np.dtype(np.int32), np.dtype(np.int8)], REMEMBERED)

    def learn(self, pieces: Sequence[str]) -> Iterator[tuple[list[int], list[int], list[int]]]:
        """Ids by A and by B, and whether B spells the piece; A, whose symbols are bytes, always does."""
        by_a = self.a.encode_pieces(pieces)
        by_b = self.b.encode([p[1:] for p in pieces], num_threads=1)
        for piece, (a,), b in zip(pieces, by_a, by_b, strict=True):
            own = [self.space] if piece == " " else b
            yield a, own, [b"".join(map(self.b_bytes.__getitem__, own)) == piece.encode()]

    def ids(self, texts: pa.StringArray) -> tuple[np.ndarray, ...]:
        """Of texts with their space: A ids, how many in each text, B ids, how many; texts not spelt have none."""
        rows, n_pieces = piece_rows(texts, self.pieces, lines=False)
        a, b, spelt = (field.gather(rows) for field in self.pieces.fields)
        good = sums(1 - spelt[0], n_pieces) == 0
        out: list[np.ndarray] = []
        for ids, sizes in (a, b):
            n = sums(sizes, n_pieces)
            out += [ids if good.all() else ids[np.repeat(good, n)], np.where(good, n, 0)]
        return tuple(out)


@cache
def tokenizers_of(a_path: str, b_path: str) -> TwoTokenizers:
    """One pair for each Python worker, so that later tasks find what earlier ones have met."""
    return TwoTokenizers(a_path, b_path)


def nearest_cut(
    a_ends: np.ndarray, b_ends: np.ndarray, lo: np.ndarray, hi: np.ndarray, b_lo: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For intervals of A tokens lo … hi - 1 the A and B token that end at the shared cut next to the middle, or -1.

    The interval's own end does not count.
    """
    at, found = np.full(len(lo), -1), np.full(len(lo), -1)
    middle = (lo + hi - 1) // 2
    open_ = np.flatnonzero(middle <= hi - 2)
    x = middle[open_]
    while len(open_):  # to the right
        j = np.searchsorted(b_ends, a_ends[x])
        hit = b_ends[j] == a_ends[x]
        at[open_[hit]], found[open_[hit]] = x[hit], j[hit]
        open_, j = open_[~hit], j[~hit]
        x = np.searchsorted(a_ends, b_ends[j])
        inside = x <= hi[open_] - 2
        open_, x = open_[inside], x[inside]
    open_ = np.flatnonzero((at < 0) & (middle > lo))
    x = middle[open_] - 1
    while len(open_):  # to the left
        j = np.searchsorted(b_ends, a_ends[x], side="right") - 1
        inside = j >= b_lo[open_]
        open_, x, j = open_[inside], x[inside], j[inside]
        hit = b_ends[j] == a_ends[x]
        at[open_[hit]], found[open_[hit]] = x[hit], j[hit]
        open_, j = open_[~hit], j[~hit]
        x = np.searchsorted(a_ends, b_ends[j], side="right") - 1
        inside = x >= lo[open_]
        open_, x = open_[inside], x[inside]
    return at, found


def groups_of(
    a_sizes: np.ndarray, b_sizes: np.ndarray, n_a: np.ndarray, n_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups end: numbers of A and of B tokens up to each group's end, in order.

    ``a_sizes``, ``b_sizes``: bytes of each token, one text after another; ``n_a``, ``n_b``: tokens of each text. Each
    text's tokens spell the same bytes in A and in B, and no token is empty.
    """
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    some = n_a > 0
    hi, b_hi = np.cumsum(n_a)[some], np.cumsum(n_b)[some]
    lo, b_lo = hi - n_a[some], b_hi - n_b[some]
    ends = [(hi, b_hi)]
    while len(lo):
        x, j = nearest_cut(a_ends, b_ends, lo, hi, b_lo)
        cut = x >= 0
        lo, hi, b_lo, b_hi, x, j = (v[cut] for v in (lo, hi, b_lo, b_hi, x + 1, j + 1))
        ends.append((x, j))
        # The halves stay in order, so that neighbours are searched together.
        lo, hi = np.stack([lo, x], 1).ravel(), np.stack([x, hi], 1).ravel()
        b_lo, b_hi = np.stack([b_lo, j], 1).ravel(), np.stack([j, b_hi], 1).ravel()
        larger = (hi - lo > 1) & (b_hi - b_lo > 1)
        lo, hi, b_lo, b_hi = (v[larger] for v in (lo, hi, b_lo, b_hi))
    return tuple(np.sort(np.concatenate(own)) for own in zip(*ends, strict=True))


def group_digests(
    a_ids: np.ndarray, b_ids: np.ndarray, a_upto: np.ndarray, b_upto: np.ndarray, n_groups: np.ndarray
) -> list[str]:
    """sha256 of each text's groups, written ``a1,a2|b1;a3|b2,b3``; '' for a text without tokens."""
    a_n, b_n = np.diff(a_upto, prepend=0), np.diff(b_upto, prepend=0)
    a_at = np.arange(len(a_ids)) + np.repeat(b_upto - b_n, a_n)
    b_at = np.arange(len(b_ids)) + np.repeat(a_upto, b_n)
    ids, after = np.empty(len(a_ids) + len(b_ids), np.int64), np.full(len(a_ids) + len(b_ids), ord(","), np.uint8)
    ids[a_at], ids[b_at] = a_ids, b_ids
    after[a_at[a_upto - 1]], after[b_at[b_upto - 1]] = ord("|"), ord(";")
    most = int(ids.max(initial=0))
    powers = 10 ** np.arange(len(str(most)))[::-1]
    digits = (np.arange(most + 1)[:, None] // powers % 10 + ord("0")).astype(np.uint8)
    sizes = np.array([len(str(i)) for i in range(most + 1)])[ids] if most < 1 << 17 else np.char.str_len(ids.astype(str))
    ends = np.cumsum(sizes + 1)
    text = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    for k in range(1, len(powers) + 1):
        own = np.flatnonzero(sizes >= k)
        text[ends[own] - 1 - k] = digits[ids[own], len(powers) - k]
    text[ends - 1] = after
    last = np.append(0, np.append(0, ends)[np.append(0, a_upto + b_upto)[np.cumsum(n_groups)]])
    raw = memoryview(text)
    return [hashlib.sha256(raw[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(last[:-1].tolist(), last[1:].tolist(), strict=True)]


def linked_pairs(
    a_ids: np.ndarray, b_ids: np.ndarray, a_upto: np.ndarray, b_upto: np.ndarray, n_groups: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct linked pairs of ids (a * width + b) of each text, text by text: pairs, links of each, pairs of each text."""
    text = np.repeat(np.arange(len(n_groups)), n_groups)
    a_n, b_n = np.diff(a_upto, prepend=0), np.diff(b_upto, prepend=0)
    few = a_n * b_n <= MANY_LINKS
    a_few = np.flatnonzero(np.repeat(few, a_n))
    group = np.repeat(np.arange(len(text)), a_n)[a_few]
    left = np.repeat(a_few, b_n[group])
    right = ragged((b_upto - b_n)[group], b_n[group])
    keys = [(np.repeat(text[group], b_n[group]) << 40) + a_ids[left].astype(np.int64) * width + b_ids[right]]
    times = [np.ones(len(left), np.int64)]
    for g in np.flatnonzero(~few).tolist():
        a, a_times = np.unique(a_ids[a_upto[g] - a_n[g] : a_upto[g]], return_counts=True)
        b, b_times = np.unique(b_ids[b_upto[g] - b_n[g] : b_upto[g]], return_counts=True)
        keys.append(((text[g] << 40) + a.astype(np.int64)[:, None] * width + b).ravel())
        times.append((a_times[:, None] * b_times).ravel())
    key, weight = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    weight = np.add.reduceat(weight[order], first) if len(first) else weight
    key = key[first]
    return key & ((1 << 40) - 1), weight, np.bincount(key >> 40, minlength=len(n_groups))


def aligned_rows(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """One row a text: id, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct pairs with their links."""

    def aligned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two, row = tokenizers_of(a_path, b_path), TaskContext.get().partitionId() << ROW_BITS
        width = len(two.b_bytes)
        for batch in batches:
            for texts, start, end in runs(batch.column(1), BYTES_AT_ONCE):
                a_ids, n_a, b_ids, n_b = two.ids(texts)
                empty = np.flatnonzero(pa.compute.binary_length(texts).to_numpy() == 1)
                if len(empty):  # the space alone is no text
                    a_ids, b_ids = (np.delete(x, ragged(np.cumsum(n)[empty] - n[empty], n[empty])) for x, n in ((a_ids, n_a), (b_ids, n_b)))
                    n_a[empty] = n_b[empty] = 0
                a_upto, b_upto = groups_of(two.a_sizes[a_ids], two.b_sizes[b_ids], n_a, n_b)
                n_groups = np.diff(np.searchsorted(a_upto, np.append(0, np.cumsum(n_a)), side="right"))
                links = sums(np.diff(a_upto, prepend=0) * np.diff(b_upto, prepend=0), n_groups)
                pairs, times, n_pairs = linked_pairs(a_ids, b_ids, a_upto, b_upto, n_groups, width)
                offsets = pa.array(np.append(0, np.cumsum(n_pairs)).astype(np.int32))
                columns = [
                    batch.column(0).slice(start, end - start),
                    pa.array(row + np.arange(end - start)),
                    *(pa.array(x.astype(np.int64)) for x in (n_a, n_b, n_groups, links)),
                    pa.array(group_digests(a_ids, b_ids, a_upto, b_upto, n_groups), pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(pairs)),
                    pa.ListArray.from_arrays(offsets, pa.array(times)),
                ]
                row += end - start
                yield pa.RecordBatch.from_arrays(columns, names)

    text = F.concat(F.lit(" "), F.coalesce(F.col(text_col), F.lit("")))
    read = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    kind = dict(read.dtypes)["id"]
    schema = f"id {kind}, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
    names = [part.split()[0] for part in schema.split(", ")]
    return read.mapInArrow(aligned, schema)


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """Of each linked pair of ids: pair, a, n (texts that hold it), best (no pair of its A id has more)."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = written(counts.withColumn("a", F.expr(f"pair div {width}")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "a", "n", (F.col("n") == F.col("most")).alias("best"))


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """Per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``a_path``: a byte-level vocabulary of the tokenizers library, ``b_path``: a sentencepiece model that adds a space; both
    must be files that every executor can read. The groups are those of a space and the text. ``n_best``: links whose
    pair of ids is in as many rows as any pair of their A id; ``count_sum``: the rows that hold each link's pair, summed.

    Null and empty texts, and those that A or B does not spell byte by byte, have no tokens: zeros, and '' as
    digest. Repeated rows count as often as they come, with one id or several; a null id is kept. Long texts are
    aligned whole. An empty table gives an empty table.
    """
    width = len(TwoTokenizers(a_path, b_path).b_bytes)
    rows = written(aligned_rows(docs, a_path, b_path, id_col, text_col), "aligned")
    counts = written(pair_counts(rows, width).select("pair", "n", "best"), "pair-best")
    # A small table of counts spares the shuffle of all links; a large one is joined, hot pairs split.
    small = counts.count() <= most_broadcast
    links = rows.where("n_links > 0").select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    scored = links.join(F.broadcast(counts) if small else counts, "pair")
    sums_ = scored.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    slim = rows.select("id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return slim.join(sums_, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")],
        "groups_sha256",
    )
