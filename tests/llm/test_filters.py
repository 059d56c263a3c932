"""Language, url and benchmark filters against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np

from fareflow.llm import decontaminate, language, urls
from tests.llm.cases import EMPTY_KINDS, clashing, documents, prose

ALPHABETS = {"uno": "aeioulmnrst", "dos": "äöüßchknrst", "три": "абвгдежзикл"}


def worded(lang, seed, n=40):
    draw = random.Random(seed)
    words = ["".join(draw.choice(ALPHABETS[lang]) for _ in range(draw.randint(2, 6))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def labelled(spark):
    rows = [(i, worded(lang, i), lang, "s") for i, lang in zip(range(300), itertools.cycle(ALPHABETS), strict=False)]
    rows += [(1000 + i, t, "uno", "s") for i, t in enumerate(EMPTY_KINDS)] + [(None, worded("dos", 9), None, None)]
    return documents(spark, rows)


def test_held_out_languages_are_found(spark):
    docs = labelled(spark)
    found = {r.doc_id: r for r in language.identify(clashing(docs)).collect()}
    for row in docs.collect():
        got = found[row.doc_id]
        out = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 4 == 2
        assert got.held_out == out and 0 <= got.score <= 1
        lettered = any(c.isalpha() for c in row.text or "")
        assert (got.lang_pred == "und") == (not lettered)
        if row.doc_id is not None and row.doc_id < 300:
            assert got.lang_pred == row.lang
    assert language.identify(docs.limit(0)).count() == 0


def test_labels_of_held_out_documents_do_not_matter(spark):
    docs = labelled(spark)
    one = docs.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 'wrong', lang) lang")
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in language.identify(d).collect()} for d in (docs, one))
    assert a == b


def test_trigrams_of_a_batch_are_those_of_each_text():
    texts = ["", "a", "Ab c", "ÉÉ--x", "\0y", "  z  "]
    grams, owner, lettered = language.trigrams(texts)

    def plain(text):
        low = "".join(c.lower() if c.isalpha() else " " for c in text)
        line = f" {re.sub(' +', ' ', low).strip()} " if low.strip() else " "
        return [line[i : i + 3] for i in range(len(line) - 2)]

    names = ["".join(chr(int(g) >> s & 0x1FFFFF) for s in (42, 21, 0)) for g in grams]
    for i, text in enumerate(texts):
        assert [n for n, o in zip(names, owner, strict=True) if o == i] == plain(text)
        assert lettered[i] == any(c.isalpha() for c in text)


def test_over_sixty_four_languages_have_masks(spark):
    rows = [(i, chr(0x4E00 + 40 * (i % 70) + 3 * (i // 70 % 5)) * 3, f"l{i % 70:02}", "s") for i in range(700)]
    model = language.fit(documents(spark, rows))
    assert model.masks.shape[0] == 2 and len(model.languages) == 70
    names, _ = model.judge([r[1] for r in rows])
    assert names == [r[2] for r in rows]


def test_counts_are_corrected_for_false_positives():
    masks = np.full((1, 1 << 4), 3, dtype=np.uint64)
    masks[0, ::2] = 1
    model = language.LanguageFilter(("a", "b"), masks)
    assert model.false_rates().tolist() == [1.0, 0.25]
    assert language.LanguageFilter((), masks).judge(["abc"]) == (["und"], [0.0])


RULES = urls.parse_rules(["block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/"])
PAGES = [
    ("http://A.Example.NET/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("https://x.net/en/", "x.net", "/en/", "net/", "block"),
    ("https://net/", "net", "/", "net/", "block"),
    ("https://x.net?q=/", "x.net", "", None, None),
    ("https://notexample.com/de/", "notexample.com", "/de/", None, None),
    ("https://example.com/de/x#y", "example.com", "/de/x", "example.com/de/", "block"),
    ("https://example.com/de", "example.com", "/de", None, None),
    ("ftp://a.org/fr/?q#z", "a.org", "/fr/", "org/fr/", "allow"),
    ("a.org/fr/", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("x://y://z/w", "y:", "//z/w", None, None),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://É.org/fr/É", "É.org", "/fr/É", "org/fr/", "allow"),
]


def pages(spark, more=()):
    rows = [(i, p[0], f"<p>casino win free the {prose(i, 50)}</p><script>casino()</script>") for i, p in enumerate(PAGES)]
    rows += [(100 + i, u, None) for i, u in enumerate(more)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_hosts_paths_and_rules(spark):
    found = {r.page_id: r for r in urls.judge(clashing(pages(spark)).drop("key"), RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(PAGES):
        got = found[i]
        assert (got.host, got.path, got.rule) == (host, path, rule)
        assert verdict is None or got.verdict == verdict
    assert urls.judge(pages(spark).limit(0), RULES).count() == 0


def test_run_together_words_are_blocked_and_clean_hosts_are_not(spark):
    bad = [f"http://casino-win{i}.com/{i}" for i in range(30)] + ["http://freecasino.org/a", "http://www.casinowin.com/"] * 3
    good = [f"http://{prose(i, 1, 50)}{i}.com/the/{i}" for i in range(300)]
    found = urls.judge(pages(spark, [*bad, *good]), []).collect()
    verdicts = {r.page_id: r.verdict for r in found}
    assert len(found) == len(PAGES) + len(bad) + len(good)
    assert all(verdicts[100 + i] == "block" for i in range(len(bad)))
    assert sum(verdicts[100 + len(bad) + i] == "block" for i in range(len(good))) <= 3


def test_best_split_is_the_best_of_all():
    draw = random.Random(2)
    for _ in range(60):
        token = "".join(draw.choice("ab") for _ in range(draw.randint(1, 8)))
        counts = {"".join(draw.choice("ab") for _ in range(draw.randint(1, 4))): draw.randint(1, 50) for _ in range(8)}
        total = sum(counts.values())
        known = {(s, n): counts[token[s : s + n]] for s in range(len(token)) for n in range(1, 9 - s) if token[s : s + n] in counts}

        def cost(words, counts=counts, total=total):
            return sum(math.log(counts.get(w, 0) / total) if w in counts else (1 - len(w)) * math.log(10) - math.log(total) for w in words)

        ways = []
        for cuts in range(1 << (len(token) - 1)):
            ways.append("".join(c + ("|" if cuts >> i & 1 else "") for i, c in enumerate(token)).strip("|").split("|"))
        got = urls.best_split(token, known, total)
        assert "".join(got) == token
        assert math.isclose(cost(got), max(map(cost, ways)))


def plain_contamination(docs, items, window=13):
    def words(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    wins = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, named = words(text), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wins:
                    hit |= set(range(i, i + n))
                    named |= wins[tuple(w[i : i + n])]
        ids = sorted(str(x) for x in named if x is not None)
        sha = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((str(doc_id), len(w), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def benchmark_cases(spark):
    items = [(i, prose(1000 + i, 25 + i)) for i in range(8)]
    items += [(20, prose(1000, 25)), (21, "short item"), (22, "solo"), (23, "two words"), (24, None), (25, "?!"), (None, prose(1003, 28))]
    rows = [(i, prose(i, 60), "x", "s") for i in range(10)]
    rows += [(20 + i, prose(i, 30) + " " + prose(1000 + i, 25 + i).upper() + ", " + prose(50 + i, 30), "x", "s") for i in range(8)]
    rows += [(40, prose(1001, 26), "x", "s"), (41, "A short-item, here", "x", "s"), (42, "two", "x", "s"), (43, "Solo", "x", "s")]
    rows += [(44, prose(7, 3000) + " " + prose(1002, 27), "x", "s"), (45, (prose(1004, 29) + " ") * 9, "x", "s")]
    rows += [(60 + i, t, "x", "s") for i, t in enumerate(EMPTY_KINDS)] + [(40, prose(1001, 26), "x", "s"), (None, prose(1002, 27), None, None)]
    return documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), rows, items


def test_contamination_matches_brute_force(spark, monkeypatch):
    docs, bench, rows, items = benchmark_cases(spark)
    wanted = plain_contamination([(r[0], r[1]) for r in rows], items)

    def check():
        found = decontaminate.decontaminate(clashing(docs), clashing(bench))
        assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in found.collect()) == wanted

    check()
    monkeypatch.setattr(decontaminate, "WINDOWS_A_PASS", 60)  # several passes
    check()


def test_clean_documents_stay(spark):
    docs, bench, rows, items = benchmark_cases(spark)
    bad = {r[0] for r in plain_contamination([(r[0], r[1]) for r in rows], items) if r[-1]}
    kept = decontaminate.without_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if str(r[0]) not in bad)
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0
    none = decontaminate.decontaminate(docs, bench.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.contaminated or r.n_hit for r in none)
