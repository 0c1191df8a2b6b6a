import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from aerolith.llm import registry, simhash
from tests.llm.brute import component_of


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \t\n", "One", "a B", "A b\x0bC d", "É é x y z", "a " * 70_000, None])
def test_fingerprint_by_definition(text):
    assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)


def test_query_equals_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in registry.table(spark, sf_dir, "documents").collect()}
    prints = {i: plain_fingerprint(t) for i, t in docs.items()}
    expected = component_of(prints, 2)
    rows = registry.op1_simhash_near_dedup(spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{prints[i]:016x}", expected[i]) for i in docs
    }
    assert len(rows) == len(docs)


def signed(value):
    return value - 2**64 if value >> 63 else value


def test_components_of_crowded_and_chained_fingerprints(spark):
    draw = random.Random(5)
    centre = draw.getrandbits(64)
    numbers = {draw.getrandbits(64) for _ in range(50)}
    for _ in range(600):  # a crowd around one fingerprint, some out of reach
        numbers.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 4))))
    chain = draw.getrandbits(64)
    for step in range(30):  # each link two bits from the one before
        chain ^= 3 << (2 * step)
        numbers.add(chain)
    prints = dict(enumerate(sorted(numbers, key=signed)))
    expected = component_of(prints, 2)
    df = spark.createDataFrame([(signed(n),) for n in prints.values()], "print long")
    found = {r["print"]: r.root for r in simhash.components(df).collect()}
    for i, number in prints.items():
        assert found.get(signed(number), signed(number)) == signed(prints[expected[i]])


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, None, 1), (7, "", 2), (3, "a b c d", 3), (3, "a b c d", 4), (None, "a b c d", 5), (9, "x", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, print int").withColumn("row", F.lit("r"))
    got = sorted(((r.doc_id, r.component_id) for r in simhash.report(docs).collect()), key=repr)
    assert got == sorted([(None, 7), (7, 7), (3, 3), (3, 3), (None, 3), (9, 9)], key=repr)
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["print"] for r in kept.collect() if r["print"] not in (3, 4)) == [2, 6]
    assert kept.count() == 3
    empty = docs.limit(0)
    assert simhash.report(empty).count() == 0 and simhash.without_near_copies(empty).count() == 0
