import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolith.llm import exact_dedup


@given(st.sets(st.integers(0, 2**50), min_size=1, max_size=300))
@settings(max_examples=60, deadline=None)
def test_coded_gaps_come_back(numbers):
    values = np.array(sorted(numbers), np.uint64)
    rice = exact_dedup.best_rice(values)
    coded = exact_dedup.rice_encode(values, rice)
    assert exact_dedup.rice_decode(coded, len(values), rice).tolist() == values.tolist()


def test_coding_is_close_to_the_entropy_of_the_gaps():
    values = np.sort(np.random.default_rng(1).choice(1 << 28, 16_384, replace=False).astype(np.uint64))
    coded = exact_dedup.rice_encode(values, exact_dedup.best_rice(values))
    assert len(coded) * 8 / len(values) < 28 - 14 + 2.1


def test_many_senders_and_owners_find_the_same_groups(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "ROWS_PER_OWNER", 37)
    texts = [None, "", "x", "hot", "hot", "é" * 40_000, "e" * 40_000]
    rows = [(i if i % 11 else None, texts[i % 7] if i % 3 else f"own {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    groups = {}
    for key, text in rows:
        groups.setdefault(text or "", []).append(key)
    got = exact_dedup.report(docs).collect()
    assert len(got) == len(rows)
    for keys in groups.values():
        best = max((k for k in keys if k is not None), default=None)
        same = [r for r in got if (r.doc_id in keys) and r.keep_id == best and r.group_size == len(keys)]
        assert len(same) >= len([k for k in keys if k is not None])


def test_nulls_ties_and_clashing_columns(spark):
    rows = [(1, "a", 5), (1, "a", 6), (None, "a", 7), (2, None, 8), (3, "", 9), (None, "z", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int").withColumnRenamed("kept", "keep_id")
    got = sorted(((r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.report(docs).collect()), key=repr)
    assert got == sorted(
        [(1, 1, 3), (1, 1, 3), (None, 1, 3), (2, 3, 2), (3, 3, 2), (None, None, 1)], key=repr
    )
    left = exact_dedup.without_copies(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        [(1, "a"), (3, ""), (None, "z")], key=repr
    )


@pytest.mark.parametrize("how", ["report", "without_copies"])
def test_empty_table(spark, how):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert getattr(exact_dedup, how)(docs).count() == 0
