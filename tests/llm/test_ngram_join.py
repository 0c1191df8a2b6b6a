import os
import random
import re
from itertools import combinations

import pytest

from aerolith.llm import common, ngram_join, registry
from tests.conftest import rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    size = min(5, len(words))
    return {" ".join(words[i : i + size]) for i in range(len(words) - size + 1 if size else 0)}


def plain(rows):
    """The contract by comparing all pairs that have a shingle in common."""
    sets = [plain_set(text) for _, text in rows]
    at = {}
    for i, s in enumerate(sets):
        for shingle in s:
            at.setdefault(shingle, []).append(i)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in {pair for group in at.values() for pair in combinations(group, 2)}:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        root = find(i)
        if key is not None:
            least[root] = min(key, least.get(root, key))
    return sorted(((key, len(sets[i]), least.get(find(i))) for i, (key, _) in enumerate(rows)), key=repr)


def report(spark, rows):
    return rows_of(ngram_join.report(spark.createDataFrame(rows, "doc_id long, text string")))


def test_whole_table_equals_all_pairs(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in registry.table(spark, sf_dir, "documents").collect()]
    wanted = plain(rows)
    assert rows_of(registry.op12_ngram_join(spark, sf_dir)) == wanted
    assert sum(a != c for a, _, c in wanted) > 5


def words(rng, n, vocabulary=5000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return out


def crowds(seed):
    """Near copies around the limit, texts on one template, shared passages, chains, strangers."""
    rng = random.Random(seed)
    texts = []
    for size, copies in ((150, 60), (40, 30), (300, 5)):
        base = words(rng, size)
        texts += [edited(rng, base, rng.randrange(size // 25 + 1)) for _ in range(copies)]
    template = words(rng, 160)
    texts += [template + words(rng, 24) for _ in range(50)] + [template + words(rng, 70) for _ in range(50)]
    passage = words(rng, 60)
    texts += [words(rng, 80) + passage + words(rng, 60) for _ in range(50)]
    chain = words(rng, 120)
    for _ in range(15):
        chain = edited(rng, chain, 2)
        texts.append(chain)
    texts += [words(rng, rng.randrange(1, 200)) for _ in range(60)]
    rng.shuffle(texts)
    return [(i, " ".join(text)) for i, text in enumerate(texts)]


@pytest.mark.parametrize("crowd,stars", [(32, 2), (4, 0)])
def test_crowds_templates_passages_and_chains(spark, monkeypatch, crowd, stars):
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", stars)
    rows = crowds(crowd)
    wanted = plain(rows)
    assert report(spark, rows) == wanted and len({c for _, _, c in wanted}) < len(rows) - 40


def test_trees_of_one_point_and_points_of_strangers_do_not_move(spark, monkeypatch):
    """With every bit set each token is let in, as in a corpus much larger than the bits."""
    monkeypatch.setattr(ngram_join, "MET_BITS", 2)
    postings, some = ngram_join._Join.postings, ngram_join._Join.some
    sizes, moved = set(), []

    def noted_postings(self, nodes):
        found = postings(self, nodes)
        counted = {r.token: r["count"] for r in found.groupBy("token").count().collect()}
        assert all(r.size == counted[r.token] for r in found.collect())
        sizes.update(counted.values())
        return found

    def noted_some(self, rows, *columns):
        found = some(self, rows, *columns)
        if columns == ("counts",):
            moved.append(found.count())
        return found

    monkeypatch.setattr(ngram_join._Join, "postings", noted_postings)
    monkeypatch.setattr(ngram_join._Join, "some", noted_some)
    rng = random.Random(11)
    base = words(rng, 150)
    texts = [edited(rng, base, 2) for _ in range(3)] + [words(rng, 60, 10**6) for _ in range(60)]
    rows = [(i, " ".join(text)) for i, text in enumerate(texts)]
    assert report(spark, rows) == plain(rows)
    assert min(sizes) == 2 and moved and max(moved) == 3


def test_capped_counts_do_not_part_points(monkeypatch):
    """Where a count is at its cap the summed minima say nothing."""
    import numpy as np
    import pandas as pd

    def pairs(most):
        monkeypatch.setattr(ngram_join, "MOST", most)
        counts = np.minimum(np.array([[9, 1], [9, 1], [5, 5]]), most).ravel()
        one = [pd.Series([np.array(x)]) for x in ([1, 2, 3], [10, 10, 10], [1, 2, 3], counts)]
        return [tuple(p) for p in ngram_join._point_pairs.func(*one, *one)[0]]

    assert set(pairs(100)) == {(1, 2)}
    assert set(pairs(6)) == {(1, 2), (1, 3), (2, 3)}


def test_odd_texts(spark):
    long = " ".join(words(random.Random(5), 120_000, 10**6))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one Two"), (5, "ONE two"), (6, "one two three"), (None, "one two")]
    rows += [(9, "a b c d e f"), (9, "a b c d e f"), (8, "a\x0bb\tc d\ne f"), (7, "a\xa0b c d e f"), (None, None)]
    rows += [(None, "only null keys here and there"), (12, long), (11, long + " end"), (13, "É b c d e"), (14, "é b c d e")]
    rows += [(20, "k " * 50), (21, "k k k k k"), (22, "k k k k")]
    assert report(spark, rows) == plain(rows)
    clash = spark.createDataFrame([(1, "a b c", 5, 6)], "doc_id long, text string, node int, same int")
    assert rows_of(ngram_join.report(clash)) == [(1, 1, 1)]


def test_empty_table(spark):
    assert report(spark, []) == [] and report(spark, [(1, None)]) == [(1, 0, 1)]


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9, 10, 100, 101, 4999])
def test_entries_are_as_many_as_the_overlap_allows(spark, n):
    least = min(both for both in range(1, n + 1) if 10 * both >= 8 * n)
    assert ngram_join.entries_of(n) == min(n, n - least + ngram_join.SHARED)
    row = spark.range(1).select(ngram_join._entries(ngram_join.F.lit(n).cast("long")).alias("p")).first()
    assert row.p == ngram_join.entries_of(n)


def test_working_tables_and_shuffles_go_once_read(spark, monkeypatch, tmp_path):
    """While the join runs, no more lies on disk than its next step reads; Python gets few rows at a time."""
    made, lying, settings = [], [], set()

    def noted(session, name):
        settings.add((session.conf.get(common._CLEANUP), session.conf.get(common._BATCH)))
        lying.append({path.rpartition("/")[2] for path in made if os.path.exists(path)})
        made.append(str(tmp_path / f"aerolith-{len(made)}" / name))
        return made[-1]

    before = spark.conf.get(common._CLEANUP), spark.conf.get(common._BATCH)
    monkeypatch.setattr(common, "scratch_path", noted)
    rows = crowds(3)
    assert report(spark, rows) == plain(rows)
    assert settings == {("true", str(common.SMALL_BATCH))}
    assert (spark.conf.get(common._CLEANUP), spark.conf.get(common._BATCH)) == before
    names = [path.rpartition("/")[2] for path in made]
    opened = lying[names.index("open")]
    assert "postings" in opened and not opened & {"shared", "short", "entered", "met", "wanted"}
    assert not lying[-1] & {"postings", "open", "near", "members", "links", "packed", "leaves"}
    left = {path.rpartition("/")[2] for path in made if os.path.exists(path)}
    assert left == {"outlines", "classes"}


def test_bits_are_looked_up_in_place(spark, monkeypatch, tmp_path):
    """Rows meet 64-bit words of a piece of a bitmap; a whole one as binary would be copied for each row."""
    sides, plainly = [], common.broadcast_if_small
    monkeypatch.setattr(common, "broadcast_if_small", lambda df, size: sides.append(df) or plainly(df, size))
    edges = [e + d for e in (0, 64, 2048, 32768, 65536, 1 << 26) for d in (-1, 0, 1, 7, 8) if e + d >= 0]
    marked = {row for row in edges if row % 3 != 1}
    path = str(tmp_path / "marks")
    common.row_bitmaps(spark.createDataFrame([(row,) for row in marked], "row long")).write.parquet(path)
    asked = spark.createDataFrame([(row, "x") for row in [*edges, 5_000_000, None]], "row long, text string")
    found = common.with_bit(asked, spark.read.parquet(path))
    assert found.columns == ["row", "text", "bit"]
    assert {r.row: r.bit for r in found.collect()} == {row: int(row in marked) for row in [*edges, 5_000_000, None]}
    assert sides[0].schema["bits"].dataType.simpleString() == "array<bigint>"
    assert {len(r.bits) for r in sides[0].collect()} == {32}
