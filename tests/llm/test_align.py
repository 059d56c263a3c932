"""Alignment of two tokenizers against the libraries and plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from fareflow.llm import align
from fareflow.llm.token_counts import byte_symbols
from tests.llm.cases import clashing, documents, prose

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = "aAbB  '.,0123\n\t\r\x0b\xa0 　́ÉéßΣσςİıñǅ中文가ẞ🙂ⅷ²½٣\x1c\x85<|>"


@pytest.fixture(scope="module")
def odd_texts():
    draw = random.Random(9)
    texts = ["".join(draw.choice(ODD) for _ in range(draw.randrange(40))) for _ in range(600)]
    texts += ["", " ", "   ", "a ", " a", "a  b   c ", "<|endoftext|> <s> </s>", "x ▁ y", "▁", "ab" * 700, "word.\nWord", "<0x41>"]
    return texts + [prose(i, 50) for i in range(20)]


class Plain:
    """The libraries on whole texts, and groups by sets of ends."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        self.byte_of = {c: b for b, c in enumerate(byte_symbols())}

    def tokens(self, text):
        """(A id, bytes), (B id, bytes) of a space and the text; none where they do not spell it."""
        if not text:
            return [], []
        found = self.a.encode(f" {text}", add_special_tokens=False)
        a = [(i, bytes(self.byte_of[c] for c in t)) for i, t in zip(found.ids, found.tokens, strict=True)]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = f" {text}".encode()
        if any(b"".join(t for _, t in own) != whole for own in (a, b)):
            return [], []
        return a, b

    def groups(self, text):
        a, b = self.tokens(text)
        ends = [np.cumsum([len(t) for _, t in own]).tolist() for own in (a, b)]
        out, at = [], [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            upto = [es.index(cut, k) + 1 for es, k in zip(ends, at, strict=True)]
            out.append(tuple([i for i, _ in own[k:m]] for own, k, m in zip((a, b), at, upto, strict=True)))
            at = upto
        return out

    def rows(self, texts):
        groups = [self.groups(t or "") for t in texts]
        links = [Counter((x, y) for a, b in own for x in a for y in b) for own in groups]
        count = Counter(pair for own in links for pair in own)
        most = Counter()
        for (a, _), n in count.items():
            most[a] = max(most[a], n)
        for own, pairs in zip(groups, links, strict=True):
            written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in own)
            yield (
                sum(len(a) for a, _ in own),
                sum(len(b) for _, b in own),
                len(own),
                sum(pairs.values()),
                sum(n for p, n in pairs.items() if count[p] == most[p[0]]),
                sum(n * count[p] for p, n in pairs.items()),
                hashlib.sha256(written.encode()).hexdigest() if own else "",
            )


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_ids_are_the_libraries(odd_texts):
    two, plain = align.TwoTokenizers(A, B), Plain()
    two.pieces.most_bytes, two.pieces.longest = 20_000, 8
    for start in range(0, len(odd_texts), 200):
        some = [t for t in odd_texts[start : start + 200] if t]
        a_ids, n_a, b_ids, n_b = two.ids(pa.array([f" {t}" for t in some]))
        wanted = [plain.tokens(t) for t in some]
        assert n_a.tolist() == [len(a) for a, _ in wanted] and n_b.tolist() == [len(b) for _, b in wanted]
        assert a_ids.tolist() == [i for a, _ in wanted for i, _ in a]
        assert b_ids.tolist() == [i for _, b in wanted for i, _ in b]


def test_groups_of_drawn_intervals():
    """Any token sizes, also ones that never meet but at the end."""
    draw = random.Random(3)
    for _ in range(300):
        texts = []
        for _ in range(draw.randrange(1, 5)):
            size = draw.choice([0, 1, 2, 7, 40, 200])
            cuts = [sorted({*(draw.randrange(1, size + 1) for _ in range(draw.randrange(size + 1))), size}) if size else [] for _ in "ab"]
            if draw.random() < 0.2 and size > 7:
                cuts = [[*range(1, size, 2), size], [*range(2, size, 2), size]]
            texts.append([sorted(set(c)) for c in cuts])
        sizes = [np.concatenate([np.diff([0, *t[k]]) for t in texts] + [np.empty(0, int)]).astype(int) for k in (0, 1)]
        n = [np.array([len(t[k]) for t in texts]) for k in (0, 1)]
        a_upto, b_upto = align.groups_of(*sizes, *n)
        wanted_a, wanted_b, a, b = [], [], 0, 0
        for x, y in texts:
            for cut in sorted(set(x) & set(y)):
                wanted_a.append(a + x.index(cut) + 1)
                wanted_b.append(b + y.index(cut) + 1)
            a, b = a + len(x), b + len(y)
        assert a_upto.tolist() == wanted_a and b_upto.tolist() == wanted_b


@pytest.mark.parametrize(("many_links", "most_broadcast"), [(256, 1_000_000), (1, 0)])
def test_rows_are_those_of_plain_python(spark, odd_texts, monkeypatch, many_links, most_broadcast):
    monkeypatch.setattr(align, "BYTES_AT_ONCE", 2_000)
    monkeypatch.setattr(align, "MANY_LINKS", many_links)
    texts = [*odd_texts, None, "twin twin", "twin twin", prose(4, 4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = align.align(docs, A, B, most_broadcast=most_broadcast)
    assert got.columns == ["doc_id", *COLUMNS]
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in got.collect()}
    assert found == dict(enumerate(Plain().rows(texts)))


def test_awkward_tables(spark):
    docs = documents(spark)
    rows = align.align(clashing(docs), A, B).collect()
    texts = [r.text for r in docs.collect()]
    assert sorted(tuple(r[c] for c in COLUMNS) for r in rows) == sorted(Plain().rows(texts))
    assert sorted(r.doc_id or -1 for r in rows) == sorted(r.doc_id or -1 for r in docs.collect())
    assert align.align(docs.limit(0), A, B).count() == 0


def test_ids_of_up_to_any_digits():
    a_ids, b_ids = np.array([5, 10, 123456, 7]), np.array([99999, 0, 100])
    digests = align.group_digests(a_ids, b_ids, np.array([2, 3, 4]), np.array([1, 2, 3]), np.array([2, 0, 1]))
    wanted = ["5,10|99999;123456|0", None, "7|100"]
    assert digests == ["" if w is None else hashlib.sha256(w.encode()).hexdigest() for w in wanted]
