"""URL filter: rules first, then naive Bayes on segmented host and path words.

Rules fit a host and its subdomains and the start of a path; the longest fitting one decides. Other urls are
judged by a model:

* Host names run words together. A unigram model splits each name into its likeliest words (Viterbi). Word
  counts come from running text, where words stand apart: the titles of all pages, the paths of all
  urls, and the seed words.
* Multinomial naive Bayes scores the words of host and path. Rules state a policy, not what a site is, so their
  verdicts are no examples. Seed words label the urls of the table instead: one that has a block word among
  its segmented words is a block example, all others are allow examples. All urls take part, and the
  seed words themselves are added to their class.

Both count tables are whole and stay DataFrames: the parts of each distinct name that are known words, and the
counts of each token, come by join. A name that is not made of known words altogether stays whole.

A null url, or one without `://`, has an empty host and path, fits no rule and is judged by the class priors
alone: allow. Empty tables give empty results; repeated pages are judged one by one. Urls may be of any length: substrings
are listed stretch by stretch, and words of more than `LONG_WORD` letters are found by their heads.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from aerolith.llm.common import column, ship_package, stored, whole_row

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Seed words of this filter: what it is to block, and ordinary words of addresses.
BLOCK_WORDS = tuple(
    """
adult ads adserver bet bets betting casino escort gambling jackpot keygen lottery malware nude payday phishing pill pills
poker porn scam sex slots spam spyware torrent viagra warez xxx
""".split()
)
ALLOW_WORDS = tuple(
    """
about archive article articles blog book books city college community course courses culture docs education forum free
garden government health help history home hospital journal kitchen language learn library local mail mobile museum
music news nature online page park people photo press project read recipe report research school science shop society
sports story student teacher travel university weather wiki world writing
""".split()
)
COMMON_HOST_WORDS = frozenset("www m com org net example".split())  # say nothing about a site
LONG_WORD = 32  # letters; longer words are looked up by their head
STRETCH = 4096  # letters of a name whose substrings are listed at a time
SEED_COUNT = 50.0  # at least, in the word table and in the class counts
SMOOTHING = 0.5
SEPARATORS = re.compile(r"[^a-z]+")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without `://`."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Rule as text and its verdict; null where none fits. Of fitting rules the longest text wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, site, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(start)
        rule = F.when(fits, F.lit(site + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


@dataclass
class Words:
    """Unigram log-probabilities for splitting names."""

    logs: dict[str, float]

    @classmethod
    def of(cls, counts: dict[str, float]) -> Words:
        total = math.log(sum(counts.values()) + len(counts) + 1)
        return cls({w: math.log(n) - total for w, n in counts.items() if n > 0})

    def split(self, name: str) -> list[str]:
        """The likeliest known words that make up a name, or the name itself."""
        sizes = sorted({len(w) for w in self.logs if len(w) <= LONG_WORD}, reverse=True)
        ends: dict[int, list[tuple[int, float]]] = {}  # where long words end in the name, and start
        for word, log in self.logs.items():
            at = name.find(word) if len(word) > LONG_WORD else -1
            while at >= 0:
                ends.setdefault(at + len(word), []).append((at, log))
                at = name.find(word, at + 1)
        best: list[tuple[float, int]] = [(0.0, 0)]
        for end in range(1, len(name) + 1):
            options = [
                (best[end - n][0] + self.logs.get(name[end - n : end], -math.inf), n - end) for n in sizes if n <= end
            ]
            options += [(best[start][0] + log, -start) for start, log in ends.get(end, ())]
            score, start = max(options, default=(-math.inf, 0))
            best.append((score, -start))
        if best[-1][0] == -math.inf:
            return [name]
        words, end = [], len(name)
        while end:
            start = best[end][1]
            words.append(name[start:end])
            end = start
        return words[::-1]


def names(host: str, path: str) -> tuple[list[str], list[str]]:
    """The letter runs of host and path, lower-cased."""
    return (
        [x for x in SEPARATORS.split(host.lower()) if x and x not in COMMON_HOST_WORDS],
        [x for x in SEPARATORS.split(path.lower()) if x],
    )


def known_words(parts: DataFrame) -> DataFrame:
    """`word`, `log`: all words of titles and paths and the seed words, with their log-probabilities."""

    @F.pandas_udf(ArrayType(StringType()))
    def letter_runs(titles: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([sum(names(t, p), []) for t, p in zip(titles, paths, strict=True)])

    counted = (
        parts.select(F.explode(letter_runs("title", "path")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").cast("double").alias("n"))
    )
    counted = stored(counted, "words")
    seen = counted.agg(F.coalesce(F.sum("n"), F.lit(0.0))).first()[0]
    seeds = BLOCK_WORDS + ALLOW_WORDS
    seed_count = max(SEED_COUNT, seen / len(seeds))
    added = parts.sparkSession.createDataFrame([(w, seed_count) for w in seeds], "word string, n double")
    counts = stored(counted.union(added).groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counts.agg(F.log(F.sum("n") + F.count("*") + 1)).first()[0]
    return counts.select("word", (F.log("n") - F.lit(total)).alias("log"))


def substrings(lengths: Sequence[int]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For `mapInPandas`: from name and id to the id with all substrings of these lengths, stretch by stretch."""

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list[int] = []
        found: list[str] = []
        reach = max(lengths, default=0)

        def rows() -> pd.DataFrame:
            made = pd.DataFrame({0: pd.Series(ids, dtype="int64"), 1: pd.Series(found, dtype="object")})
            ids.clear()
            found.clear()
            return made

        for batch in batches:
            for number, name in zip(batch["id"], batch["name"], strict=True):
                for first in range(0, len(name), STRETCH):
                    stretch = name[first : first + STRETCH + reach - 1]
                    starts = range(min(STRETCH, len(stretch)))
                    inside = {stretch[s : s + n] for n in lengths for s in starts if s + n <= len(stretch)}
                    ids.extend([number] * len(inside))
                    found.extend(inside)
                    if len(ids) >= STRETCH * 16:
                        yield rows()
        yield rows()

    return listed


def split_names(found: DataFrame, words: DataFrame) -> DataFrame:
    """`name`, `parts` for all distinct names: their likeliest words."""
    sizes = words.select(F.length("word").alias("n")).filter(F.col("n") <= LONG_WORD).distinct()
    lengths = sorted(r[0] for r in sizes.collect())  # at most LONG_WORD numbers
    numbered = stored(found.select("name", F.monotonically_increasing_id().alias("id")), "numbered")
    known = numbered.mapInPandas(substrings(lengths), "id long, word string").join(words, "word")
    # A long word lies in a name only where its head does.
    longer = words.filter(F.length("word") > LONG_WORD).withColumn("head", F.substring("word", 1, LONG_WORD))
    heads = numbered.filter(F.length("name") > LONG_WORD).mapInPandas(substrings([LONG_WORD]), "id long, head string")
    inside = heads.distinct().join(longer, "head").join(numbered, "id").filter(F.col("name").contains(F.col("word")))
    known = (
        known.select("id", "word", "log")
        .union(inside.select("id", "word", "log"))
        .groupBy("id")
        .agg(F.collect_set(F.struct("word", "log")).alias("known"))
        .join(numbered, "id")
        .select("name", F.transform("known", lambda k: k["word"]).alias("words"), F.transform("known", lambda k: k["log"]).alias("logs"))
    )

    @F.pandas_udf(ArrayType(StringType()))
    def split(own: pd.Series, known: pd.Series, logs: pd.Series) -> pd.Series:
        return pd.Series(
            [Words(dict(zip(k, x, strict=True))).split(n) for n, k, x in zip(own, known, logs, strict=True)]
        )

    parts = known.select("name", split("name", "words", "logs").alias("parts"))
    return found.join(parts, "name", "left").select("name", F.coalesce("parts", F.array("name")).alias("parts"))


def block_scores(parts: DataFrame) -> DataFrame:
    """`host`, `path`, `block_score` of all distinct addresses: the log-odds of block; zero or less is allow.

    Learnt from all rows of `host`, `path` and `title`.
    """
    spark = parts.sparkSession
    sites = parts.groupBy("host", "path").agg(F.count("*").alias("n"))
    sites = stored(sites.select("*", F.monotonically_increasing_id().alias("site")), "sites")

    @F.pandas_udf("array<struct<mark:string,name:string>>")
    def marked(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        both = (names(h, p) for h, p in zip(hosts, paths, strict=True))
        # Words of the path are marked as such.
        return pd.Series([[{"mark": m, "name": x} for m, xs in zip(("", "/"), b, strict=True) for x in xs] for b in both])

    named = stored(sites.select("site", "n", F.inline(marked("host", "path"))), "names")
    pieces = stored(split_names(named.select("name").distinct(), known_words(parts)), "parts")
    tokens = named.join(pieces, "name").select(
        "site", "n", F.explode(F.transform("parts", lambda w: F.concat("mark", w))).alias("token")
    )
    tokens = stored(tokens, "tokens")
    seeds = [form for word in BLOCK_WORDS for form in (word, "/" + word)]
    bad = tokens.filter(F.col("token").isin(seeds)).select("site").distinct()
    bad = stored(bad.withColumn("bad", F.lit(1.0)), "bad")
    labelled = tokens.join(bad, "site", "left").withColumn("bad", F.coalesce("bad", F.lit(0.0)))
    counted = labelled.select("token", (F.col("n") * (1 - F.col("bad"))).alias("allow"), (F.col("n") * F.col("bad")).alias("block"))
    own = [
        (mark + word, SEED_COUNT * (kind is ALLOW_WORDS), SEED_COUNT * (kind is BLOCK_WORDS))
        for kind in (ALLOW_WORDS, BLOCK_WORDS)
        for word in kind
        for mark in ("", "/")
    ]
    counted = counted.union(spark.createDataFrame(own, "token string, allow double, block double"))
    counts = stored(counted.groupBy("token").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")), "counts")
    allow, block, size = counts.agg(F.sum("allow"), F.sum("block"), F.count("*") + 1).first()
    odds = counts.select(
        "token",
        (
            F.log((F.col("block") + SMOOTHING) / F.lit(block + SMOOTHING * size))
            - F.log((F.col("allow") + SMOOTHING) / F.lit(allow + SMOOTHING * size))
        ).alias("odds"),
    )
    rows = sites.join(bad, "site", "left").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("bad")), F.lit(0.0)))
    n, n_bad = rows.first()
    share = (n_bad + 1) / (n + 10)  # before any url is seen a tenth
    prior = math.log(share) - math.log(1 - share)
    sums = tokens.join(odds, "token").groupBy("site").agg(F.sum("odds").alias("odds"))
    scored = sites.join(sums, "site", "left")
    return scored.select("host", "path", (F.coalesce("odds", F.lit(0.0)) + prior).alias("block_score"))


def title_of(html: Column) -> Column:
    return F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title[^>]*>([^<]*)", 1)


def judged(pages: DataFrame, url: str = "url", html: str = "html", rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """`doc` (each row as it was) with host, path, rule, verdict and block_score (null where a rule decides)."""
    ship_package(pages.sparkSession)
    host, path = split_url(column(url))
    parts = pages.select(
        whole_row(pages).alias("doc"), host.alias("host"), path.alias("path"), title_of(column(html)).alias("title")
    )
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": rule, "ruled": verdict})
    scores = stored(block_scores(parts.select("host", "path", "title")), "scores")
    scored = parts.join(scores, ["host", "path"], "left").withColumn(
        "block_score", F.when(F.col("ruled").isNull(), F.col("block_score"))
    )
    by_model = F.when(F.col("block_score") > 0, "block").otherwise("allow")
    return scored.select("doc", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "block_score")


def report(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    return judged(pages.select("page_id", "url", "html")).select("doc.page_id", "host", "path", "rule", "verdict")
