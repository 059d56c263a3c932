"""SimHash groups and vector links against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from fareflow.llm import embeddings, graph, simhash
from tests.llm.cases import clashing, documents


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_groups(n, links):
    roots = list(range(n))

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        roots[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_fingerprints_bit_by_bit():
    texts = ["", "One", "a b c", "A\x0bB\x85c d e", "x  y z w v", "É é É é É", "w " * 50]
    for text in texts:
        assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_groups_match_brute_force(spark):
    docs = documents(spark)
    rows = docs.collect()
    prints = [plain_fingerprint(r.text) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    roots = plain_groups(len(rows), links)
    least = {}
    for root, row in zip(roots, rows, strict=True):
        if row.doc_id is not None:
            least[root] = min(least.get(root, row.doc_id), row.doc_id)
    wanted = sorted((str(r.doc_id), f"{p:016x}", str(least.get(g))) for r, p, g in zip(rows, prints, roots, strict=True))
    found = simhash.near_duplicate_groups(clashing(docs).drop("id", "fp"))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found.collect())
    assert got == wanted
    assert simhash.near_duplicate_groups(docs.limit(0)).count() == 0


def test_tree_finds_every_pair_at_the_radius(spark):
    draw = random.Random(3)
    prints = [draw.getrandbits(64) for _ in range(1500)]
    for p in prints[:200]:  # one neighbour at each distance from 1 to 6
        for d in range(1, 7):
            prints.append(p ^ sum(1 << b for b in draw.sample(range(64), d)))
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = [(i, j) for i, a in enumerate(prints) for j, b in enumerate(prints[:i]) if (a ^ b).bit_count() <= 4]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    at = {p: i for i, p in enumerate(signed)}
    for scale in (2, 64):  # many small shards, and few
        found = simhash.near_fingerprints(table, shard_scale=scale).collect()
        got = [(at[r.a], at[r.b]) for r in found]
        assert plain_groups(len(prints), got) == plain_groups(len(prints), links)


def test_crowded_leaves_take_several_shards(spark):
    base = 0x0123456789ABCDEF
    prints = [base ^ (1 << a) ^ (1 << b) for a in range(32) for b in range(a)]
    table = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = simhash.near_fingerprints(table, shard_scale=1).collect()
    at = {p: i for i, p in enumerate(prints)}
    assert set(plain_groups(len(prints), [(at[r.a], at[r.b]) for r in found])) == {0}


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark)
    groups = {r.component_id for r in simhash.near_duplicate_groups(docs).collect()}
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(groups - {None})
    again = simhash.near_duplicate_groups(kept).collect()
    assert all(r.doc_id == r.component_id for r in again if r.doc_id is not None)


def test_components_of_a_path_a_star_and_a_pair(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 60)] + [(301, 300), (300, 301), (7, 7), (None, 8)]
    got = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted((r.id, r.root) for r in got) == sorted(
        [(i, 0) for i in range(51)] + [(100 + i, 100) for i in range(60)] + [(300, 300), (301, 300)]
    )
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors():
    rng = np.random.default_rng(5)
    base = rng.standard_normal((260, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows = [*base]
    for i in range(60):  # cosines on both sides of the threshold
        noise = rng.standard_normal(64)
        noise -= noise @ base[i] * base[i]
        noise /= np.linalg.norm(noise)
        c = 0.93 + 0.07 * i / 60
        rows.append(c * base[i] + np.sqrt(1 - c * c) * noise)
    rows += [base[7] + 0.02 * rng.standard_normal(64) for _ in range(150)]  # a large group of near copies
    rows += [base[9]] * 40  # and one of exact copies
    rows = [[float(np.float32(x)) for x in r] for r in rows]
    odd = [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [float("inf")] * 64, [None] + [1.0] * 63]
    odd += [[1.0, 2.0], [2.0, 4.0], [x * 1e30 for x in rows[11]], [x * 1e-30 for x in rows[11]]]
    return list(enumerate(rows + odd + odd[:3] + [rows[9]]))


def test_vector_links_match_brute_force(spark):
    rows = vectors()
    good = [v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v) / np.abs(v).max() if g else None for g, (_, v) in zip(good, rows, strict=True)]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            if good[i] and good[j] and len(unit[i]) == len(unit[j]):
                c = unit[i] @ unit[j] / np.sqrt((unit[i] @ unit[i]) * (unit[j] @ unit[j]))
                if c >= 0.95:
                    links.append((i, j))
    roots = plain_groups(len(rows), links)
    n = np.bincount(np.array(links).ravel(), minlength=len(rows))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS label", "'x' AS h1")
    for block_rows in (2048, 16):
        got = embeddings.near_duplicate_vectors(table, block_rows=block_rows).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [
            (i, n[i], roots[i], roots[i] == i) for i in range(len(rows))
        ]


def test_vectors_without_ids_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    table = spark.createDataFrame([(None, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [0.0, 1.0]), (None, [1.0, 1.0])], schema)
    got = embeddings.near_duplicate_vectors(table).collect()
    assert sorted(map(str, ((r.vec_id, r.n_links, r.component_id, r.kept) for r in got))) == [
        "(5, 0, 5, True)", "(5, 1, 5, True)", "(None, 0, None, True)", "(None, 1, 5, False)",
    ]
    assert embeddings.near_duplicate_vectors(table.limit(0)).count() == 0


def test_recall_at_the_threshold():
    hashing = embeddings.Hashing()
    rng = np.random.default_rng(0)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((4000, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    met = (hashing.buckets(a) == hashing.buckets(0.95 * a + np.sqrt(1 - 0.95**2) * b)).any(axis=1)
    assert met.mean() > 0.999
