"""Token counts and token files against the tokenizer library itself."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fareflow.llm import token_files
from fareflow.llm.token_counts import PairMerger, token_counts
from tests.llm.cases import clashing, documents, prose

WORDS, BYTES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = "aAbB  '.,0123\n\t\r\x0b\xa0 　́ÉéßΣσςİıñǅ中文가ẞ🙂ⅷ²½٣\x1c\x85​<|>"


@pytest.fixture(scope="module")
def odd_texts():
    draw = random.Random(4)
    texts = ["".join(draw.choice(ODD) for _ in range(draw.randrange(40))) for _ in range(3000)]
    return texts + ["", " ", "  ", "a  b   c ", "<|endoftext|>", " x<|endoftext|><|startoftext|> y", "aaaaaaa", "I'll DON'T", "ab" * 3000]


def test_counts_are_the_librarys(odd_texts):
    library = Tokenizer.from_file(WORDS)
    wanted = [len(e.ids) for e in library.encode_batch(odd_texts, add_special_tokens=False)]
    assert PairMerger(WORDS).count(odd_texts) == wanted


def test_counts_stay_right_when_the_memory_is_emptied(odd_texts, monkeypatch):
    monkeypatch.setattr("fareflow.llm.token_counts.SYMBOLS_A_ROUND", 7)
    merger = PairMerger(WORDS)
    merger.seen.most = 10
    whole = PairMerger(WORDS).count(odd_texts[:300])
    assert [n for i in range(0, 300, 20) for n in merger.count(odd_texts[i : i + 20])] == whole


def test_encoded_pieces_are_the_librarys_ids(odd_texts):
    library = Tokenizer.from_file(BYTES)
    encoder = token_files.Encoder(BYTES, 2)
    encoder.pieces.most_bytes, encoder.pieces.longest = 10_000, 6
    prose_texts = [prose(i, 60).replace("ta", draw) for i, draw in enumerate(["Ta", "ǅ", "ŋa", ".\nTa", "'s", "ɏ"])]
    texts = odd_texts + prose_texts + [t.replace(" ", "  ", 3) for t in prose_texts]
    for i in range(0, len(texts), 500):
        some = texts[i : i + 500]
        ids, counts = encoder.encode(pa.array(some))
        wanted = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in some]
        assert counts.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == [x for w in wanted for x in w]
    assert encoder.encode(pa.array([], pa.string()))[0].tolist() == []


def test_memory_is_bounded_whatever_the_pieces():
    """Long texts without a space are one piece each; short pieces fill the store and are forgotten."""
    encoder = token_files.Encoder(BYTES, 2)
    encoder.pieces.most_bytes = 200_000
    library, draw = Tokenizer.from_file(BYTES), random.Random(1)
    tracemalloc.start()
    for i in range(60):
        long = "".join(chr(draw.randrange(0x4E00, 0x9FA5)) for _ in range(2000))
        short = " ".join(f"{draw.randrange(1 << 40):x}" for _ in range(1000))
        ids, _ = encoder.encode(pa.array([long, short]))
        if i in (0, 59):
            assert ids.tolist() == [x for t in (long, short) for x in [*library.encode(t, add_special_tokens=False).ids, 2]]
        if i == 20:
            early = tracemalloc.get_traced_memory()[0]
    assert tracemalloc.get_traced_memory()[0] < early + 1_000_000
    tracemalloc.stop()
    assert all(len(p) <= encoder.pieces.longest for p in encoder.pieces.known)


def test_counts_of_a_table(spark):
    docs = documents(spark)
    library = Tokenizer.from_file(WORDS)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(clashing(docs), WORDS).collect())
    wanted = []
    for row in docs.collect():
        text = row.text or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        wanted.append((row.doc_id or -1, len(text.encode()), n, n > 2048))
    assert got == sorted(wanted)
    assert token_counts(docs.limit(0), WORDS).count() == 0


def written_ids(docs):
    library = Tokenizer.from_file(BYTES)
    return {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs.collect()}


def test_files_hold_the_stream_in_order(spark, folder):
    docs = documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    ids = written_ids(docs)
    files = token_files.write_token_files(clashing(docs), f"{folder}/t", BYTES, 2, seq_len=64, rows_per_batch=4)
    start, wanted = 0, []
    for doc_id in sorted(ids):
        own = ids[doc_id]
        wanted.append((doc_id, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert sorted(map(tuple, token_files.read_digests(spark, files).collect())) == wanted
    assert wanted[0][1] == 0

    # Sequences are equally long, views of the mapped file, and masked where they are padded.
    stream = [x for d in sorted(ids) for x in ids[d]]
    found = []
    for (name,) in sorted(files.index(spark).select("file").distinct().collect()):
        one = token_files.SequenceFile(f"{files.folder}/ids/{name}")
        for i in range(len(one)):
            seq, mask = one[i]
            assert len(seq) == len(mask) == 64 and not seq.flags.owndata
            assert mask.all() or i == len(one) - 1
            found += seq[mask].tolist()
        with pytest.raises(IndexError):
            one[len(one)]
    assert found == stream


def test_files_of_an_empty_table_and_of_twins(spark, folder):
    docs = documents(spark)
    files = token_files.write_token_files(docs.limit(0), f"{folder}/none", BYTES, 2)
    assert token_files.read_digests(spark, files).count() == 0
    files = token_files.write_token_files(docs, f"{folder}/all", BYTES, 2)
    rows = token_files.read_digests(spark, files).collect()
    assert len(rows) == docs.count()
    ends = sorted((r.start, r.start + r.n_tokens) for r in rows)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))
    assert sorted(rows, key=lambda r: r.start)[0].doc_id is None
