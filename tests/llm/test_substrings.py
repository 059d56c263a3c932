"""Repeated passages against plain Python, and the index against plain search."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from fareflow.llm import substrings
from fareflow.llm.fm_index import FMIndex, WaveletMatrix
from tests.llm.cases import clashing, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window=13):
    """The definition: every window as a tuple, and the smallest id that has it."""
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    least = {}
    for i, w in split:
        if i is not None:
            for k in range(len(w) - window + 1):
                own = tuple(w[k : k + window])
                least[own] = min(i, least.get(own, i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1 if i is not None else 0):
            if least[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def texts(seed):
    """Passages shared whole and in part, in many contexts, repeated inside a text, at its ends, and overlapping."""
    draw = random.Random(seed)
    passages = [prose(1000 + i, draw.choice([12, 13, 14, 30, 120]), 90).split() for i in range(12)]
    out = []
    for i in range(120):
        words = prose(i, draw.choice([0, 3, 12, 13, 40]), 60).split()
        for _ in range(draw.randrange(4)):
            own = draw.choice(passages)
            a = draw.randrange(len(own))
            words += draw.choice([own, own[a:], own[:a], own + own]) + prose(draw.randrange(9999), draw.randrange(4), 60).split()
        out.append(draw.choice([" ", "  ", "\n", "\t "]).join(words))
    return [*out, out[5], out[5], "a " * 300, "a " * 200, "a b " * 90, " x  \x0by\x1cz\x85  q ", prose(3, 15_000)]


@pytest.mark.parametrize(("shard_runs", "many_runs"), [(60_000, 1_000), (40, 2), (300, 0)])
def test_removed_words_are_those_of_plain_python(spark, shard_runs, many_runs):
    draw = random.Random(shard_runs)
    rows = list(enumerate(texts(1)))
    rows = [(i - 40, t) for i, t in rows] + [(3, rows[50][1]), (7, rows[2][1]), (7, rows[2][1]), (None, rows[50][1]), (None, None), (999, None)]
    draw.shuffle(rows)
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = substrings.remove_repeated(docs, shard_runs=shard_runs, many_runs=many_runs)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    wanted = plain(rows)
    assert sorted(map(tuple, got.collect()), key=str) == wanted and sum(r[2] for r in wanted) > 1000


def test_small_windows_and_short_runs(spark, monkeypatch):
    monkeypatch.setattr(substrings, "RUN_WINDOWS", 3)
    monkeypatch.setattr(substrings, "BYTES_AT_ONCE", 500)
    rows = list(enumerate(texts(2)[:60]))
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    for window in (1, 4):
        got = substrings.remove_repeated(docs, window=window)
        assert sorted(map(tuple, got.collect()), key=str) == plain(rows, window)


def test_awkward_tables(spark):
    docs = documents(spark)
    got = substrings.remove_repeated(clashing(docs))
    assert sorted(map(tuple, got.collect()), key=str) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert substrings.remove_repeated(docs.limit(0)).count() == 0


def test_every_window_is_in_one_run():
    """Runs partition the windows, and equal windows have equal minimizers."""
    rng = np.random.default_rng(2)
    hashes = substrings.mixed(rng.integers(0, 40, 3000).astype(np.uint64))
    sizes = np.array([0, 5, 13, 700, 12, 2000, 270])
    first, size, least, _, n_runs = substrings.runs_of_windows(hashes, sizes, 13)
    windows = [w for f, s in zip(first, size, strict=True) for w in range(f, f + s - 12)]
    ends = np.cumsum(sizes)
    assert windows == [w for e, s in zip(ends, sizes, strict=True) for w in range(e - s, e - 12)]
    assert n_runs.sum() == len(first) and n_runs[[0, 1, 4]].tolist() == [0, 0, 0]
    of = {}
    for f, s, m in zip(first.tolist(), size.tolist(), least.tolist(), strict=True):
        for w in range(f, f + s - 12):
            assert of.setdefault(hashes[w : w + 13].tobytes(), m) == m


def test_index_finds_what_a_scan_finds():
    draw = random.Random(6)
    for _ in range(60):
        depth, width = draw.choice([1, 2, 3, 5, 13]), draw.choice([1, 2, 5])
        stored = [[draw.randint(1, width) for _ in range(draw.randrange(30))] for _ in range(draw.randrange(1, 6))]
        text = np.array([x for s in stored for x in [*s, 0]])
        index = FMIndex(text, depth)
        streamed = [*stored, *([draw.choice([0, *text.tolist()]) for _ in range(draw.randrange(30))] for _ in range(5))]
        flat = np.array([x for s in streamed for x in s], np.int64)
        sizes = np.array([len(s) for s in streamed])
        places, first, last = index.matching(flat, np.cumsum(sizes) - sizes, sizes)
        found = {p: sorted(index.places[a:b].tolist()) for p, a, b in zip(places.tolist(), first, last, strict=True)}
        wanted = {}
        for s, e in zip(np.cumsum(sizes) - sizes, np.cumsum(sizes), strict=True):
            for p in range(s, e - depth + 1):
                own = flat[p : p + depth].tolist()
                at = [] if 0 in own else [q for q in range(len(text) - depth + 1) if text[q : q + depth].tolist() == own]
                if at:
                    wanted[p] = at
        assert found == wanted


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    numbers = rng.integers(0, 37, 1000)
    matrix = WaveletMatrix(numbers, 37)
    asked, upto = rng.integers(0, 37, 500), rng.integers(0, 1001, 500)
    assert matrix.rank(asked, upto).tolist() == [int((numbers[:u] == a).sum()) for a, u in zip(asked, upto, strict=True)]
