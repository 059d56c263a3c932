"""URL filters: rules on hosts and paths, and for the rest words read out of the address.

Hosts run words together ("freecasino"). A unigram model of the pages' own words splits each token of host
and path along its most probable segmentation (Viterbi), and multinomial naive Bayes scores the words. Its
training labels are a short list of blocked terms: an address that contains one as a word is an example to
block, any other to allow. So a term blocks only as a word of its own, and words that keep company with
blocked terms count against an address too.

Work is done once for each different token and address, however many pages share it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Longest word the segmentation considers; a longer unknown stretch still comes out whole.
LONGEST_WORD = 20
NUMBER = "#"
MOST_RULES = 1_000
#: Terms whose addresses are examples of what to block.
BLOCKED_TERMS = ("adult", "ads", "bets", "casino", "pills", "poker", "porn", "spam", "viagra", "xxx")


@dataclass(frozen=True)
class Rule:
    """``host/path``: fits the host and its subdomains where the url's path starts with the rule's."""

    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, rest = self.text.partition("/")
        return ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(slash + rest))


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without a ``://`` and for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(rules: Sequence[Rule], host: Column, path: Column, what: str) -> Column:
    """``what`` ("text" or "verdict") of the longest rule that fits; the first of equally long ones."""
    ordered = sorted(rules, key=lambda r: -len(r.text))
    return F.coalesce(*[F.when(r.fits(host, path), F.lit(getattr(r, what))) for r in ordered], F.lit(None).cast("string"))


def tokens(host: Column, path: Column) -> Column:
    """Stretches of letters, lower-cased, and a mark for each number."""
    found = F.regexp_extract_all(F.lower(F.concat_ws("/", host, path)), F.lit(r"\p{L}+|[0-9]+"), F.lit(0))
    return F.transform(found, lambda t: F.when(t.rlike("^[0-9]"), F.lit(NUMBER)).otherwise(t))


def word_counts(pages: DataFrame, terms: Sequence[str], html: str = "html") -> DataFrame:
    """How often each word occurs in the visible text of all pages: word, n. Blocked terms count once more."""
    bare = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"(?is)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    own = pages.select(F.explode(F.split(F.lower(bare), r"[^\p{L}]+")).alias("word"))
    own = own.where(F.length("word").between(1, LONGEST_WORD)).groupBy("word").agg(F.count("*").alias("n"))
    given = pages.sparkSession.createDataFrame([(t, 1) for t in terms], "word string, n long")
    return own.union(given).groupBy("word").agg(F.sum("n").alias("n"))


def best_split(token: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The most probable segmentation. ``known``: count of the word at (start, length), where there is one.

    A word of n letters that is not known has probability 10 / (total * 10^n). Of equally probable segmentations the
    one with the shortest last word wins.
    """
    best, back = [0.0] + [-math.inf] * len(token), [0] * (len(token) + 1)
    for end in range(1, len(token) + 1):
        for start in range(end - 1, max(-1, end - 1 - LONGEST_WORD), -1):
            n = known.get((start, end - start))
            cost = math.log(n / total) if n else (1 - (end - start)) * math.log(10) - math.log(total)
            if best[start] + cost > best[end]:
                best[end], back[end] = best[start] + cost, start
    words, end = [], len(token)
    while end:
        words.append(token[back[end] : end])
        end = back[end]
    return words[::-1]


def segmentation(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Words of each different token: token, words.

    Tokens meet the word counts by their substrings, so the vocabulary is joined and never broadcast.
    """
    total = counts.agg(F.sum("n")).first()[0] or 1

    def starts_of(n: Column) -> Column:
        lengths = F.sequence(F.lit(1), F.lit(LONGEST_WORD))
        each = F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda s: F.transform(F.filter(lengths, lambda k: s + k <= n), lambda k: F.struct(s.alias("s"), k.alias("k"))),
        )
        return F.flatten(each)

    spans = found.where(F.col("token") != NUMBER).select("token", F.explode(starts_of(F.length("token"))).alias("at"))
    spans = spans.select("token", "at.*", F.substring("token", F.col("at.s") + 1, F.col("at.k")).alias("word"))
    edges = spans.join(counts, "word").groupBy("token").agg(F.collect_list(F.struct("s", "k", "n")).alias("edges"))

    @F.pandas_udf("array<string>")
    def split(token: pd.Series, edges: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [t] if t == NUMBER else best_split(t, {} if e is None else {(x["s"], x["k"]): x["n"] for x in e}, total)
                for t, e in zip(token, edges, strict=True)
            ],
            dtype=object,
        )

    return found.join(edges, "token", "left").select("token", split("token", "edges").alias("words"))


def scores(addresses: DataFrame, words: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Naive Bayes log-odds of block against allow for each address: host, path, score.

    ``addresses``: host, path, n (pages), token; a row for each token. ``words``: token, words.
    Word probabilities are smoothed by one, class shares too.
    """
    marked = words.withColumn("bad", F.arrays_overlap("words", F.array(*map(F.lit, terms))).cast("int"))
    given = addresses.join(marked.select("token", "bad"), "token")
    labels = given.groupBy("host", "path").agg(F.max("bad").alias("bad"), F.first("n").alias("n"))
    labelled = written(addresses.select("host", "path", "token").join(labels, ["host", "path"]), "addresses")
    classes = labels.agg(F.sum(F.col("bad") * F.col("n")), F.sum("n")).first()
    bad, every = (x or 0 for x in classes)
    per_token = labelled.groupBy("token").agg(
        F.sum(F.col("n") * F.col("bad")).alias("block"), F.sum(F.col("n") * (1 - F.col("bad"))).alias("allow")
    )
    in_token = per_token.join(words, "token").select("block", "allow", F.explode("words").alias("word"))
    per_word = written(in_token.groupBy("word").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")), "words")
    size, block, allow = per_word.agg(F.count("*"), F.sum("block"), F.sum("allow")).first()
    block, allow = (block or 0) + size, (allow or 0) + size
    odds = F.log((F.col("block") + 1) / float(block or 1)) - F.log((F.col("allow") + 1) / float(allow or 1))
    of_token = (
        words.select("token", F.explode("words").alias("word"))
        .join(per_word.select("word", odds.alias("odds")), "word")
        .groupBy("token")
        .agg(F.sum("odds").alias("odds"))
    )
    prior = math.log((bad + 1) / (every - bad + 1))
    return labelled.join(of_token, "token").groupBy("host", "path").agg((F.sum("odds") + prior).alias("score"))


def judge(
    pages: DataFrame, rules: Sequence[Rule], terms: Sequence[str] = BLOCKED_TERMS, id_col: str = "page_id"
) -> DataFrame:
    """Per row: id, host, path, rule (or null), verdict (block or allow), score (or null).

    The longest rule that fits decides; where none does, a score above zero blocks. An address without a token
    (null, no ``://``, only signs) has no score and is allowed. Null pages give no words. Rows come out as
    often as they come in. Sums of logarithms are rounded to 9 digits, so that their order cannot matter.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{MOST_RULES} rules at most; more belong in a table that is joined")
    host, path = host_and_path()
    read = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    each = read.groupBy("host", "path").agg(F.count("*").alias("n"))
    addresses = written(
        each.select("host", "path", "n", F.explode(tokens(F.col("host"), F.col("path"))).alias("token")), "address-tokens"
    )
    counts = written(word_counts(pages, terms), "word-counts")
    words = written(segmentation(addresses.select("token").distinct(), counts), "token-words")
    scored = scores(addresses, words, terms).withColumn("score", F.round("score", 9))
    own = [F.col("host"), F.col("path")]
    rule, ruled = (longest_rule(rules, *own, what) for what in ("text", "verdict"))
    by_score = F.when(F.col("score") > 0, "block").otherwise("allow")
    return read.join(scored, ["host", "path"], "left").select(
        F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(ruled, by_score).alias("verdict"), "score"
    )


def parse_rules(lines: Sequence[str]) -> list[Rule]:
    """Rules from lines like ``block example.com/de/``."""
    return [Rule(*line.split(" ", 1)) for line in lines]
