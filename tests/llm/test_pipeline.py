"""The pipeline's stages against plain Python."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import zlib
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fareflow.llm import mixing
from tests.llm.cases import documents, prose
from tests.llm.test_near_duplicates import plain_fingerprint, plain_groups
from tests.llm.test_filters import plain_contamination


def inputs(spark, folder):
    items = [(i, prose(1000 + i, 25 + i)) for i in range(4)]
    rows = [(i, prose(i, 40 + i % 50), ("x", "y")[i % 2], f"src{i % 4}") for i in range(60)]
    rows += [(100 + i, rows[i][1], "x", "src0") for i in range(5)] + [(200, "?! 12", "x", "src0"), (201, None, "x", "src1"), (202, "", "y", "src1")]
    rows += [(300 + i, prose(1000 + i, 25 + i), "x", "src2") for i in range(4)] + [(0, rows[0][1], "x", "src0"), (400, prose(9, 50), None, None)]
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items


def test_stages_keep_what_they_should(spark, folder):
    rows, items = inputs(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept.append(sorted(r.doc_id for r in docs.collect()))

    lettered = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert kept[0] == sorted(r[0] for r in lettered)
    prints = [plain_fingerprint(r[1]) for r in lettered]
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    roots = plain_groups(len(prints), links)
    least = sorted({min(r[0] for r, g in zip(lettered, roots, strict=True) if g == root) for root in roots})
    assert kept[1] == least
    texts = {r[0]: r[1] for r in rows}
    bad = {int(c[0]) for c in plain_contamination([(d, texts[d]) for d in least], items) if c[-1]}
    assert bad and kept[2] == [d for d in least if d not in bad] == kept[3]

    # The last stage follows the mixture, not the ids.
    slots = {r.doc_id: (r.slot, r.row_in_block) for r in mixing.mix(docs, mixing.TARGETS, mixing.REST_TARGET).collect()}
    library, start, wanted = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for d in sorted(slots, key=slots.get):
        ids = np.array([*library.encode(texts[d], add_special_tokens=False).ids, 2], "<u4")
        wanted.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert sorted(map(tuple, got)) == sorted(wanted)
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(wanted)


def test_empty_documents(spark, folder):
    rows, _ = inputs(spark, folder)
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0


def test_columns_named_like_the_stages_own_stay(spark, folder):
    """Extra columns keep their names and values through every stage, whatever the stages call theirs."""
    inputs(spark, folder)
    names = ["_kept", "_text_key", "_bad", "grp", "Block", "slot", "_file", "_row", "_part", "judged", "row_in_block"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").dropDuplicates(["doc_id"])
    docs = docs.withColumns({n: F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")) for n in names})
    docs.write.parquet(f"{folder}/wide")
    docs = spark.read.parquet(f"{folder}/wide")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        out.write.parquet(f"{folder}/wide-{name}")
        docs = spark.read.parquet(f"{folder}/wide-{name}")
        found = docs.collect()
        assert found and all(r[n] == f"{n}:{r.doc_id}" for r in found for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == len(found)
