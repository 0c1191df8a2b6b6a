import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from aerolith.llm import collocations, registry
from tests.conftest import rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, top=2000):
    """The contract on Python's own counters."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    found = {}
    for (lang, *words), a in f.items():
        if len(words) > 1 and a >= 10:
            cuts = [(10**6 * a * a // (f[lang, *words[:k]] * f[lang, *words[k:]]), k) for k in range(1, len(words))]
            worth, k = min(cuts)
            found[lang, *words] = (worth, a, f[lang, *words[:k]], f[lang, *words[k:]])
    for lang, *words in [key for key in found if len(key) == 4]:
        for part in (words[:2], words[1:]):
            if (lang, *part) in found and 100 * f[lang, *words] >= 50 * f[lang, *part]:
                found[lang, *part] = None
    out = []
    for lang in n:
        mine = [(-v[0], -v[1], " ".join(k[1:]).encode(), v) for k, v in found.items() if v and k[0] == lang]
        for rank, (_, _, phrase, (worth, a, left, right)) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, n[lang], worth))
    return sorted(out, key=repr)


def make(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def test_whole_table_equals_a_plain_version(spark, sf_dir):
    rows = [(r.lang, r.text) for r in registry.table(spark, sf_dir, "documents").collect()]
    wanted = plain(rows)
    assert len(wanted) > 150 and rows_of(registry.op11_phrase_mining(spark, sf_dir)) == wanted


ODD = [
    ("en", "New York, new york! NEW\tYORK;new  york\x0bnew york. of new york of\rnew york"),
    ("en", "a b c " * 30),
    ("en", "a b c. b c d? " * 12),
    (None, "x y " * 12),
    ("und", "x y z " * 11),
    ("und", "é è. É è é è " * 15),
    ("de", None),
    ("de", ""),
    ("fr", "\x00 \x1c \x00 \x1c " * 10 + "...,,,"),
    ("", "one two " * 20),
]


def test_odd_texts_ties_and_repeats(spark):
    rows = ODD + ODD[:3]
    table = make(spark, rows).withColumn("first", F.lit(1)).withColumn("n", F.lit(2))
    got = collocations.report(table)
    assert rows_of(got) == plain(rows)
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]


def test_no_rows(spark):
    assert collocations.report(make(spark, [])).count() == 0
    assert collocations.report(make(spark, [("en", None), (None, "")])).count() == 0


def test_top_of_each_language(spark):
    rows = [("en", " ".join(f"w{i} v{i}" for i in range(40))) for _ in range(10)]
    got = rows_of(collocations.report(make(spark, rows), top=7))
    assert got == plain(rows, 7) and len(got) == 7


def test_spills_bursts_and_small_vocabularies(spark, monkeypatch):
    """Counts do not depend on how much a task holds."""
    rows = [(i % 3 and "en" or "es", " ".join(f"w{(i * j) % 23}" for j in range(200))) for i in range(60)]
    rows.append(("en", "hot " * 5000 + " ".join(f"hot w{j % 400}" for j in range(8000))))
    for name, value in (("HELD", 50), ("BURST", 4), ("WORDS_AT_ONCE", 64), ("ROWS_AT_ONCE", 16), ("REMEMBERED", 30)):
        monkeypatch.setattr(collocations, name, value)
    batches = [pa_batch([r]) for r in rows]
    ones = Counter()
    for batch in collocations._count_words(iter(batches)):
        for lang, word, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            ones[lang, word] += n
    bits = type("Bits", (), {"value": np.full(1 << (collocations.FILTER_BITS - 3), 255, np.uint8)})
    hashed = {xxhash.xxh64_intdigest(w.encode(), 7) - (1 << 64) * (xxhash.xxh64_intdigest(w.encode(), 7) >> 63): w for _, w in ones}
    for size in (2, 3):
        got, wanted = Counter(), Counter()
        for batch in collocations._count_phrases(size, 7, bits, bits)(iter(batches)):
            columns = [c.to_pylist() for c in batch.columns]
            for lang, *words, n in zip(*columns, strict=True):
                got[lang, *[hashed[w] for w in words]] += n
        for lang, text in rows:
            words = text.split()
            wanted.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
        assert got == wanted


def pa_batch(rows):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]})


def test_runs_are_sorted_and_subtrees_leave_whole():
    trie = collocations.Trie(2)
    rng = np.random.default_rng(3)
    keys = (rng.integers(1, 9, 5000) << collocations.ID_BITS) | rng.integers(1, 6000, 5000)
    trie.add(keys)
    run, counts = trie.spill(trie.held // 2)
    assert (np.diff(run) > 0).all() and not set((run >> collocations.ID_BITS).tolist()) & set(trie.root)
    rest, others = trie.spill()
    assert (np.diff(rest) > 0).all() and counts.sum() + others.sum() == 5000 and trie.held == 0
    assert sorted([*run, *rest]) == sorted(set(keys.tolist()))


def test_spark_hashes_words_as_tasks_do(spark):
    row = spark.createDataFrame([("en", "zürich")], "lang string, word string").select(
        F.xxhash64(F.lit(5)).alias("seed"), F.xxhash64(F.lit(5), "word").alias("id"), "lang"
    )
    seed, number, _ = row.first()
    mask = (1 << 64) - 1
    assert number & mask == xxhash.xxh64_intdigest("zürich".encode(), seed & mask)
    pair = row.select(collocations._mixed_column("id", "seed").alias("m")).first().m & mask
    mine = collocations._mixed(
        np.array([number & mask], np.uint64), np.array([seed & mask], np.uint64), xxhash.xxh64_intdigest(b"en", 42)
    )
    assert int(mine[0]) == pair


@pytest.mark.parametrize("a,left,right", [(10, 10, 10), (3 * 10**14, 9 * 10**14, 7 * 10**14), (11, 37, 89)])
def test_scores_beyond_64_bits(spark, a, left, right):
    row = spark.range(1).select(collocations.score(F.lit(a), F.lit(left), F.lit(right)).alias("s")).first()
    assert row.s == 10**6 * a * a // (left * right)
