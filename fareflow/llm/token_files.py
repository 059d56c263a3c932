"""Token ids of a corpus in Arrow files of equal-length sequences.

A file is in Arrow's random-access file format. Its record batches have two fixed-size-list
columns: ``ids``, and ``mask`` (true where an id belongs to a text, false in the padding that fills
the last sequence). Sequence ``i`` of a file lies in batch ``i // rows_per_batch``, so a reader maps the
file into memory and takes any sequence without copying or scanning.

Documents follow one another in the stream across sequences; a file holds a range of
the documents in order, and an index (Parquet) says where each document's ids lie.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareflow.llm.pieces import PieceIds, piece_rows, runs, sums
from fareflow.llm.token_counts import byte_symbols

#: Characters of texts worked on at a time (or one longer text).
CHARS_AT_ONCE = 4_000_000
#: Signs that are a pre-token of their own between a letter and a piece's end.
MARKS, LAST_LATIN = ".,!?;:%&*$#", "ɏ"
#: Inside a piece: between a Latin letter and an ASCII sign or line break, and after a single line break.
WITHIN = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-ɏ])(?=[!-/:-@\[-`{-~\n])|(?<=[!-~]\n)(?=[A-Za-z])")


class Words(dict[str, list[int]]):
    """Ids of words met in one call; a word of Latin letters, with or without a space before it, is looked up in the
    encoder's store or goes to the library's model.
    """

    def __init__(self, encoder: Encoder) -> None:
        self.model, self.symbols = encoder.library.model.tokenize, encoder.symbols
        self.known, self.ids = encoder.pieces.known, encoder.pieces.fields[0]

    def __missing__(self, word: str) -> list[int]:
        row = self.known.get(word)
        if row is None:
            symbols = word.replace(" ", "Ġ") if word.isascii() else word.encode().decode("latin1").translate(self.symbols)
            found = [t.id for t in self.model(symbols)]
        else:
            found = self.ids.row(row).tolist()
        self[word] = found
        return found


class Encoder:
    """The tokenizer library's ids of whole texts, and an end id.

    A text is cut where a space follows a letter or mark; such pieces are encoded apart from one
    another by definition of the pre-tokenizer, so repeated pieces need the library only once. A piece that
    is one pre-token goes straight to the library's model.
    """

    def __init__(self, path: str, end_id: int, special_as_text: bool = False) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = special_as_text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"] or spec["pre_tokenizer"].get("type") != "ByteLevel":
            raise ValueError("pieces encode alike only for byte-level vocabularies without a normalizer")
        if spec["pre_tokenizer"]["add_prefix_space"] or any(" " in t["content"] for t in spec["added_tokens"]):
            raise ValueError("the vocabulary changes what stands before a space")
        self.kind = np.dtype("<u2" if max(self.library.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        self.end_id = end_id
        self.special = os.path.commonprefix([t["content"] for t in spec["added_tokens"]]) or None
        self.symbols = dict(enumerate(byte_symbols()))
        self.marks = {c: self.library.token_to_id(c) for c in MARKS}
        self.line = self.library.token_to_id("Ċ")
        self.pieces = PieceIds(self.encode_pieces, [self.kind])

    def within(self, piece: str) -> list[str]:
        """The words of a piece, marks apart; a piece that may hold a special token stays whole."""
        return [piece] if self.special and self.special in piece else WITHIN.split(piece)

    def encode_pieces(self, pieces: Sequence[str]) -> list[tuple[list[int]]]:
        """Ids of each piece; Latin letters, and marks behind them, are pre-tokens of their own."""
        marks, line, out, words, others = self.marks, self.line, [], Words(self), []
        for p in pieces:
            broken = p[0] == "\n"
            word = p[1:] if broken else p
            letters = word[1:] if word[:1] == " " else word
            if letters.isalpha() and (letters.isascii() or max(letters) <= LAST_LATIN):
                found = words[word]
            elif word[-1:] in marks and letters[:-1].isalpha() and (letters.isascii() or max(letters) <= LAST_LATIN):
                found = [*words[word[:-1]], marks[word[-1]]]
            else:
                out.append(([],))
                others.append((out[-1][0], self.within(p)))
                continue
            out.append(([line, *found] if broken else found,))
        rest = set(chain.from_iterable(own for _, own in others))
        rest = [w for w in rest if not (w[w[:1] == " " :].isalpha() and max(w) <= LAST_LATIN)]
        words.update((w, e.ids) for w, e in zip(rest, self.library.encode_batch_fast(rest, add_special_tokens=False), strict=True))
        for found, own in others:
            found += chain.from_iterable(words[w] for w in own)
        return out

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with its end id, one after another, and how many each has."""
        rows, n_pieces = piece_rows(texts, self.pieces, lines=True)
        ids, sizes = self.pieces.fields[0].gather(rows)
        counts = sums(sizes, n_pieces) + 1
        out, last = np.empty(len(ids) + len(texts), self.kind), np.cumsum(counts) - 1
        inner = np.ones(len(out), bool)
        inner[last] = False
        out[last], out[inner] = self.end_id, ids
        return out, counts


@cache
def encoder_of(path: str, end_id: int) -> Encoder:
    """One encoder for each Python worker, so that later tasks find what earlier ones have met."""
    return Encoder(path, end_id)


class SequenceWriter:
    """Packs a stream of ids into sequences and appends them to one Arrow file."""

    def __init__(self, sink: pa.NativeFile, kind: np.dtype, seq_len: int, rows_per_batch: int) -> None:
        self.kind, self.seq_len, self.rows = kind, seq_len, rows_per_batch
        self.schema = pa.schema(
            {"ids": pa.list_(pa.from_numpy_dtype(kind), seq_len), "mask": pa.list_(pa.bool_(), seq_len)}
        ).with_metadata({"rows_per_batch": str(rows_per_batch)})
        self.out = pa.ipc.new_file(sink, self.schema)
        self.waiting = np.empty(0, kind)

    def add(self, ids: np.ndarray) -> None:
        self.waiting = np.concatenate([self.waiting, ids])
        if len(self.waiting) >= self.rows * self.seq_len:
            self._flush()

    def _flush(self, last: bool = False) -> None:
        flat, full = self.waiting, self.rows * self.seq_len
        end = len(flat) if last else len(flat) // full * full
        for a in range(0, end, full):
            self._batch(flat[a : min(a + full, end)])
        self.waiting = flat[end:].copy()

    def _batch(self, ids: np.ndarray) -> None:
        padded = np.zeros(-(-len(ids) // self.seq_len) * self.seq_len, dtype=self.kind)
        padded[: len(ids)] = ids
        arrays = (pa.array(padded), pa.array(np.arange(len(padded)) < len(ids)))
        lists = [pa.FixedSizeListArray.from_arrays(a, self.seq_len) for a in arrays]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        self._flush(last=True)
        self.out.close()


class SequenceFile:
    """Random access to the sequences of one file."""

    def __init__(self, uri: str) -> None:
        store, path = fs.FileSystem.from_uri(uri)
        local = isinstance(store, fs.LocalFileSystem)
        self.file = pa.ipc.open_file(pa.memory_map(path) if local else store.open_input_file(path))
        self.rows = int(self.file.schema.metadata[b"rows_per_batch"])
        self.seq_len = self.file.schema.field("ids").type.list_size
        self.at, self.batch = -1, None

    def __len__(self) -> int:
        n = self.file.num_record_batches
        return (n - 1) * self.rows + self.file.get_batch(n - 1).num_rows if n else 0

    def _column(self, batch: int, name: str) -> pa.Array:
        if batch != self.at:
            self.at, self.batch = batch, self.file.get_batch(batch)
        return self.batch.column(name)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the mapped file) and mask of sequence ``i``."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        batch, row = divmod(i, self.rows)
        ids, mask = (self._column(batch, c)[row].values for c in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask.to_numpy(zero_copy_only=False)

    def stream(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from position ``start`` of the file's stream on, ``n`` of them, batch by batch."""
        full = self.rows * self.seq_len
        while n:
            batch, offset = divmod(start, full)
            ids = self._column(batch, "ids").flatten().to_numpy(zero_copy_only=True)
            part = ids[offset : offset + n]
            yield part
            start, n = start + len(part), n - len(part)


@dataclass(frozen=True)
class TokenFiles:
    """Where the files and the index of a written corpus are.

    ``index``: document id, part, file, file_start (position in the file's stream), n_tokens.
    """

    folder: str
    id_col: str

    def index(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/index")


def file_uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int,
    order: Sequence[str | Column] = ("doc_id",),
    id_col: str = "doc_id",
    text_col: str = "text",
    seq_len: int = 2048,
    rows_per_batch: int = 256,
) -> TokenFiles:
    """Encode every text, append ``end_id``, and write the ids to ``folder`` in ``order``.

    A null text counts as an empty one (its end id alone). Null ids come first. Rows that tie in ``order``
    follow by a hash of their text; rows that are alike in both cannot be told apart. An empty
    table leaves an index without rows and no files. ``folder`` must be one that all executors reach.

    A task writes to a name of its own and renames the whole file, so a repeated task (a lost
    executor, speculation) leaves one file; the same index rows come out of the task that wrote it.
    """
    root = file_uri(folder)

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId()
        store, base = fs.FileSystem.from_uri(root)
        name = f"part-{part:06d}.arrow"
        own = f"{base}/ids/_{name}.{context.taskAttemptId()}"
        encoder, writer, sink, at = encoder_of(vocabulary, end_id), None, None, 0
        for batch in batches:
            n = np.empty(len(batch), dtype=np.int64)
            for texts, a, b in runs(batch.column(1), CHARS_AT_ONCE):
                if writer is None:
                    store.create_dir(f"{base}/ids", recursive=True)
                    sink = store.open_output_stream(own)
                    writer = SequenceWriter(sink, encoder.kind, seq_len, rows_per_batch)
                ids, n[a:b] = encoder.encode(texts)
                writer.add(ids)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(n), pa.int32()), pa.array([name] * len(n), pa.string()),
                 pa.array(starts), pa.array(n)],
                ["id", "part", "file", "file_start", "n_tokens"],
            )
        if writer is not None:
            writer.close()
            sink.close()
            store.move(own, f"{base}/ids/{name}")

    by = [F.col(c) if isinstance(c, str) else c for c in order]
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(
        F.col(id_col).alias("id"), text.alias("text"), *[c.alias(f"_by{i}") for i, c in enumerate(by)]
    )
    by_names = [f"_by{i}" for i in range(len(by))]
    kind = dict(read.dtypes)["id"]
    in_order = read.repartitionByRange(*by_names).sortWithinPartitions(*by_names, F.xxhash64("text"))
    index = in_order.select("id", "text").mapInArrow(
        encoded, f"id {kind}, part int, file string, file_start long, n_tokens long"
    )
    index.withColumnRenamed("id", id_col).write.parquet(f"{root}/index")
    return TokenFiles(root, id_col)


def read_digests(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """Per document, from the files: id, start (ids of all documents before it), n_tokens, ids_crc32.

    ``ids_crc32`` is the unsigned crc32 of the document's ids as little-endian 32-bit integers. A part's
    base is the sum of the parts before it, which takes one row a file.
    """
    index = files.index(spark)
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    folder = files.folder

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, opened = None, None
        for batch in batches:
            crcs = []
            for file, start, n in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                if file != name:
                    name, opened = file, SequenceFile(f"{folder}/ids/{file}")
                crc = 0
                for ids in opened.stream(start, n):
                    crc = zlib.crc32(ids.astype("<u4"), crc)
                crcs.append(crc)
            columns = [batch.column(0), batch.column(4), batch.column(3), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "start", "n_tokens", "ids_crc32"])

    placed = index.join(bases, "part").select(
        F.col(files.id_col).alias("id"), "file", "file_start", "n_tokens",
        (F.col("base") + F.col("file_start")).alias("start"),
    )
    kind = dict(placed.dtypes)["id"]
    return placed.mapInArrow(digests, f"id {kind}, start long, n_tokens long, ids_crc32 long").withColumnRenamed(
        "id", files.id_col
    )
