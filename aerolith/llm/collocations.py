"""Phrases whose words occur together more often than apart, counted in burstable tries.

Words are numbered by 64-bit hashes that are checked to be distinct over all words of a language; where two words met, the
next hash is taken. Counting goes by phrase length, each pass over all texts:

1. Words. 2. Pairs of neighbours whose words both reach the least count. 3. Triples whose pairs both do. A phrase never
occurs more often than its parts, so nothing that counts is left out. What reaches the least count is told to the
tasks as bits at hashed places (`FILTER_BITS`, 16 MB whatever the corpus); a bit set by chance costs work and changes
no result.

In a task pairs and triples go into a trie: word ids above, hash containers of the remaining words below. A container
that holds more than `BURST` phrases bursts into one container per next word. When a task's tries hold `HELD`
phrases, whole subtrees are spilled, the largest first, as runs sorted by phrase. Runs are merged per prefix partition: language, first
word and a salt from the second one, so that a word that begins a third of all phrases is spread over `SALTS` partitions.

Scores are floors of exact decimals. Null text has no words, null language is `und` and one with it. Repeated rows count each
time. Empty tables give an empty result. Very long texts are counted like others, in bounded memory.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aerolith.llm.common import broadcast_if_small, column, ship_package, stored

LEAST = 10
WORDS = 3
SHARE_PERCENT = 50
TOP = 2000
UNKNOWN_LANGUAGE = "und"
FILTER_BITS = 27
SALTS = 64
BURST = 1 << 12
HELD = 600_000
REMEMBERED = 400_000
WORDS_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 1 << 16
ID_BITS = 21  # three local word ids share 63 bits
_MASK = (1 << ID_BITS) - 1
CUT = b"\xff"  # no byte of UTF-8
_SEPARATORS = b".,;:!?\n\x0b\x0c\r"


def _plain_bytes() -> bytes:
    """Byte for byte: capitals become small, separators of pieces line ends, tabs spaces."""
    table = bytearray(range(256))
    for byte in range(ord("A"), ord("Z") + 1):
        table[byte] = byte + 32
    for byte in _SEPARATORS:
        table[byte] = ord("\n")
    table[ord("\t")] = ord(" ")
    return bytes(table)


PLAIN = _plain_bytes()


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, with `CUT` between pieces."""
    plain = (text or "").encode("utf-8", "surrogatepass").translate(PLAIN)
    return plain.replace(b"\n", b" " + CUT + b" ").split()


class Branch(dict):
    """A burst node: one child for each next word."""


def _burst(container: dict[int, int], words: int) -> Branch:
    """Containers of the words behind the first, one for each first word."""
    shift, branch = ID_BITS * (words - 1), Branch()
    mask = (1 << shift) - 1
    for key, count in container.items():
        branch.setdefault(key >> shift, {})[key & mask] = count
    return branch


def _put(node: dict, keys: np.ndarray, counts: np.ndarray, words: int) -> dict:
    """Add sorted distinct phrases of so many words; a container that has grown too large bursts."""
    if type(node) is Branch:
        shift = ID_BITS * (words - 1)
        heads = keys >> shift
        rests = keys & ((1 << shift) - 1)
        cuts = [0, *(np.flatnonzero(np.diff(heads)) + 1).tolist(), len(keys)]
        for head, a, b in zip(heads[cuts[:-1]].tolist(), cuts[:-1], cuts[1:], strict=True):
            node[head] = _put(node.get(head, {}), rests[a:b], counts[a:b], words - 1)
        return node
    for key, count in zip(keys.tolist(), counts.tolist(), strict=True):
        node[key] = node.get(key, 0) + count
    return _burst(node, words) if words > 1 and len(node) > BURST else node


def _containers(node: dict, words: int, prefix: int) -> Iterator[tuple[int, dict[int, int]]]:
    """The hash containers below a node, each with its prefix in the place that it has in a phrase."""
    if type(node) is Branch:
        for head, child in node.items():
            yield from _containers(child, words - 1, prefix | (head << ID_BITS * (words - 1)))
    else:
        yield prefix, node


def _size(node: dict) -> int:
    return sum(map(_size, node.values())) if type(node) is Branch else len(node)


class Trie:
    """Counts of phrases of one length and language in a task, under ids local to the task."""

    def __init__(self, words: int):
        self.words, self.root, self.held = words, Branch(), 0

    def add(self, keys: np.ndarray) -> None:
        distinct, counts = np.unique(keys, return_counts=True)
        if len(distinct):
            _put(self.root, distinct, counts, self.words)
        self.held = _size(self.root)

    def spill(self, most: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Whole subtrees, the largest first, until at most so many phrases are held: one sorted run."""
        prefixes, sizes, keys, counts = [], [], [], []
        for size, head in sorted(((_size(node), head) for head, node in self.root.items()), reverse=True):
            if self.held <= most:
                break
            self.held -= size
            prefix = head << ID_BITS * (self.words - 1)
            for before, container in _containers(self.root.pop(head), self.words - 1, prefix):
                prefixes.append(before)
                sizes.append(len(container))
                keys.extend(container)
                counts.extend(container.values())
        whole = np.array(keys, np.int64) | np.repeat(np.array(prefixes, np.int64), sizes)
        order = np.argsort(whole)
        return whole[order], np.array(counts, np.int64)[order]


class Vocabulary(dict):
    """Local ids of the words that may belong to a frequent phrase; 0 for all others."""

    def __init__(self, seed: int, mark: int, bits: np.ndarray):
        super().__init__({CUT: 0})
        self.seed, self.mark, self.bits, self.hashes = seed, mark, memoryview(bits), [0]

    def __missing__(self, word: bytes) -> int:
        hashed = xxhash.xxh64_intdigest(word, self.seed)
        number, at = 0, (hashed ^ self.mark) >> (64 - FILTER_BITS)  # as in _is_set, for one number
        if self.bits[at >> 3] >> (at & 7) & 1:
            number = len(self.hashes)
            self.hashes.append(hashed)
        self[word] = number
        return number


    def forget(self) -> None:
        """Drop the words that are remembered as rare; they are hashed again when they come back."""
        for word in [word for word, number in self.items() if not number and word != CUT]:
            del self[word]


def _is_set(bits: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    at = mixed >> np.uint64(64 - FILTER_BITS)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _mixed(first: np.ndarray, second: np.ndarray, mark: int) -> np.ndarray:
    return first ^ ((second << np.uint64(31)) | (second >> np.uint64(33))) ^ np.uint64(mark)


def _mixed_column(first: str, second: str | None = None) -> Column:
    """The same in Spark."""
    mixed = F.col(first).bitwiseXOR(F.xxhash64("lang"))
    if second is None:
        return mixed
    turned = F.shiftleft(second, 31).bitwiseOR(F.shiftrightunsigned(second, 33))
    return mixed.bitwiseXOR(turned)


def _filter_of(spark: SparkSession, mixed: DataFrame) -> Broadcast:
    """Bits at the places of hashed values (`mixed`), for the tasks: of one size for every corpus."""
    place = F.shiftrightunsigned("mixed", 64 - FILTER_BITS) + 1  # Spark numbers bits from one
    buckets = mixed.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in buckets.collect():
        part = np.frombuffer(row.bits, np.uint8)
        bits[(row.bucket - 1) * len(part) :][: len(part)] = part
    return spark.sparkContext.broadcast(bits)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their number in this task, in parts that fit into memory."""
    counts: dict[str, Counter] = {}

    def spill() -> Iterator[pa.RecordBatch]:
        for lang in sorted(counts):
            words = sorted(counts[lang])
            for first in range(0, len(words), ROWS_AT_ONCE):
                part = words[first : first + ROWS_AT_ONCE]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part), pa.string()),
                        pa.array([word.decode("utf-8", "replace") for word in part], pa.string()),
                        pa.array([counts[lang][word] for word in part], pa.int64()),
                    ],
                    names=["lang", "word", "n"],
                )
        counts.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counter = counts.setdefault(lang, Counter())
            counter.update(tokens(text))
            del counter[CUT]
        if sum(map(len, counts.values())) > HELD:
            yield from spill()
    yield from spill()


class _Language:
    """What a task holds for one language."""

    def __init__(self, lang: str, size: int, seed: int, words: np.ndarray, pairs: np.ndarray | None):
        self.mark = xxhash.xxh64_intdigest(lang.encode(), 42)
        self.size, self.pairs = size, pairs
        self.fresh_ids = lambda: Vocabulary(seed, self.mark, words)
        self.ids, self.trie, self.stream = self.fresh_ids(), Trie(size), []

    def take(self, text: str | None) -> None:
        ids = self.ids
        self.stream.extend([ids[word] for word in tokens(text)])
        self.stream.append(0)

    def settle(self) -> None:
        """Count the phrases of the words taken so far."""
        a = np.array(self.stream, np.int64)
        self.stream.clear()
        known = a > 0
        together = known[:-1] & known[1:]
        if self.size == 2:
            keys = ((a[:-1] << ID_BITS) | a[1:])[together]
        else:
            hashes = np.array(self.ids.hashes, np.uint64)[a]
            together &= _is_set(self.pairs, _mixed(hashes[:-1], hashes[1:], self.mark))
            whole = together[:-1] & together[1:]
            keys = ((a[:-2] << 2 * ID_BITS) | (a[1:-1] << ID_BITS) | a[2:])[whole]
        self.trie.add(keys)

    def spill(self, lang: str, most: int) -> Iterator[pa.RecordBatch]:
        hashes = np.array(self.ids.hashes, np.uint64).view(np.int64)
        keys, counts = self.trie.spill(most)
        for first in range(0, len(keys), ROWS_AT_ONCE):
            part = keys[first : first + ROWS_AT_ONCE]
            words = [hashes[(part >> ID_BITS * i) & _MASK] for i in reversed(range(self.size))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(part), pa.string()),
                    *map(pa.array, words),
                    pa.array(counts[first : first + ROWS_AT_ONCE]),
                ],
                names=["lang", *_names(self.size), "n"],
            )


def _names(size: int) -> list[str]:
    return ["first", "second", "third"][:size]


def _count_phrases(size: int, seed: int, words: Broadcast, pairs: Broadcast | None) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages: dict[str, _Language] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in languages:
                    languages[lang] = _Language(lang, size, seed, words.value, pairs.value if pairs else None)
                mine = languages[lang]
                mine.take(text)
                if len(mine.stream) >= WORDS_AT_ONCE:
                    mine.settle()
                    if len(mine.ids) > REMEMBERED:
                        mine.ids.forget()
                    if len(mine.ids.hashes) > min(REMEMBERED, _MASK - WORDS_AT_ONCE):
                        yield from mine.spill(lang, 0)
                        mine.ids = mine.fresh_ids()
                    while sum(one.trie.held for one in languages.values()) > HELD:
                        name, most = max(languages.items(), key=lambda one: one[1].trie.held)
                        yield from most.spill(name, most.trie.held // 2)
        for lang, mine in languages.items():
            mine.settle()
            yield from mine.spill(lang, 0)

    return count


def _checked_ids(spark: SparkSession, words: DataFrame) -> tuple[DataFrame, int]:
    """Words with an `id` that no other word of the language has, and the seed that gives it."""
    attempt = 0
    while True:
        numbered = words.withColumn("id", F.xxhash64(F.lit(attempt), "word"))
        clashes = numbered.groupBy("lang", "id").agg(F.count("*").alias("words")).filter("words > 1")
        if clashes.isEmpty():
            seed = spark.range(1).select(F.xxhash64(F.lit(attempt))).first()[0]
            return numbered, seed & ((1 << 64) - 1)
        attempt += 1


def phrase_counts(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Stored counts per language: all words, then words, pairs and triples that occur `least` times.

    Words: lang, word, n. The others name words by id: `id` beside its word, `first`, `second`, `third`.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(
        F.coalesce(column(lang).cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"), column(text).alias("text")
    )
    runs = texts.mapInArrow(_count_words, "lang string, word string, n long")
    words = stored(runs.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    numbered, seed = _checked_ids(spark, words)
    often = stored(numbered.filter(F.col("n") >= least), "often")
    some_words = _filter_of(spark, often.select(_mixed_column("id").alias("mixed")))
    found, some_pairs = [], None
    for size in range(2, WORDS + 1):
        names = _names(size)
        schema = ", ".join(["lang string", *[f"{name} long" for name in names], "n long"])
        runs = texts.mapInArrow(_count_phrases(size, seed, some_words, some_pairs), schema)
        merged = (
            runs.withColumn("salt", F.pmod("second", F.lit(SALTS)))
            .repartition("lang", "first", "salt")
            .groupBy("lang", "salt", *names)
            .agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least)
            .drop("salt")
        )
        found.append(stored(merged, f"phrases{size}"))
        if size == 2:
            some_pairs = _filter_of(spark, found[0].select(_mixed_column("first", "second").alias("mixed")))
    return words, often, *found


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)) in decimals: exact for counts below 10^15."""
    a, left, right = (x.cast("decimal(15,0)") for x in (a, left, right))
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * a * a, left * right)


def candidates(often: DataFrame, pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of all phrases of two and three words, less those that a longer one stands for."""

    def with_word(df: DataFrame, name: str) -> DataFrame:
        known = often.select("lang", F.col("id").alias(name), F.col("word").alias(f"{name}_word"), F.col("n").alias(f"n_{name}"))
        return df.join(known, ["lang", name])

    def with_pair(df: DataFrame, a: str, b: str) -> DataFrame:
        known = pairs.select("lang", F.col("first").alias(a), F.col("second").alias(b), F.col("n").alias(f"n_{a}_{b}"))
        return df.join(known, ["lang", a, b])

    inside = (
        triples.select("lang", "first", "second", "n")
        .union(triples.select("lang", "second", "third", "n"))
        .groupBy("lang", "first", "second")
        .agg(F.max("n").alias("longer"))
    )
    two = (
        pairs.join(inside, ["lang", "first", "second"], "left")
        .filter(F.col("longer").isNull() | (100 * F.col("longer") < SHARE_PERCENT * F.col("n")))
        .drop("longer")
    )
    two = with_word(with_word(two, "first"), "second").select(
        "lang",
        F.concat_ws(" ", "first_word", "second_word").alias("phrase"),
        F.col("n").alias("a"),
        F.col("n_first").alias("l"),
        F.col("n_second").alias("r"),
        score(F.col("n"), F.col("n_first"), F.col("n_second")).alias("score"),
    )
    three = with_pair(with_pair(triples, "first", "second"), "second", "third")
    for name in _names(3):
        three = with_word(three, name)

    def cut(left: str, right: str) -> Column:
        value = score(F.col("n"), F.col(left), F.col(right))
        return F.struct(value.alias("score"), F.col(left).alias("l"), F.col(right).alias("r"))

    early, late = cut("n_first", "n_second_third"), cut("n_first_second", "n_third")
    three = three.select(
        "lang",
        F.concat_ws(" ", "first_word", "second_word", "third_word").alias("phrase"),
        F.col("n").alias("a"),
        F.when(early.getField("score") <= late.getField("score"), early).otherwise(late).alias("cut"),
    ).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    return two.unionByName(three)


def report(docs: DataFrame, top: int = TOP) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    words, often, pairs, triples = phrase_counts(docs.select("lang", "text"))
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        candidates(often, pairs, triples)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= top)
        .join(broadcast_if_small(totals, 64 * totals.count()), "lang")
        .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
