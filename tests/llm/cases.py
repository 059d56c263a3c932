"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EMPTY_KINDS = [None, "", "   \n\t", "?!", "a", "É"]


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Made-up words with a few signs and line breaks."""
    draw = random.Random(seed)
    syllables = ["ta", "re", "mi", "so", "lu", "ké", "ñu", "dor", "ven", "qu"]
    words_ = []
    for _ in range(words):
        n = draw.randrange(vocabulary)
        words_.append(syllables[n % 10] + syllables[n // 10 % 10] + syllables[n // 100 % 10])
        if draw.random() < 0.1:
            words_[-1] += draw.choice([".", ",", ".\n", "  ", "!"])
    return " ".join(words_)


def documents(spark, rows=None):
    """Rows (doc_id, text, lang, source): distinct texts, copies, near copies, blanks, nulls, a long text, twins."""
    if rows is None:
        rows = [(i, prose(i, 30 + 7 * i), "x" if i % 2 else "y", f"src{i % 3}") for i in range(24)]
        rows += [(100 + i, rows[3][1], "x", "src0") for i in range(5)]
        rows += [(200 + i, rows[20][1] + f" tail{i}", "x", None) for i in range(3)]
        rows += [(300 + i, t, None, "src0") for i, t in enumerate(EMPTY_KINDS)]
        rows += [(400, prose(77, 20_000), "y", "src1")]
        rows += [(500, prose(5, 65), "x", "src2")] * 3 + [(None, prose(6, 40), "y", "src2"), (None, None, None, None)]
    full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df):
    """``df`` with extra columns named like those the operators make."""
    names = ["KEY", "shard", "Slot", "size", "grp", "judged", "entities", "id", "fp", "_key", "words", "n", "block"]
    out = df
    for name in names:
        out = out.selectExpr("*", f"'extra' AS `{name}`")
    return out


def rows_of(df, *order):
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((x is not None, str(type(x)), x) if not isinstance(x, (int, float)) else (True, "", x) for x in r))
