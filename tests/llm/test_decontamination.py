import hashlib
import random
import re

from aerolith.llm import decontamination as dc


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for item_id, item in items:
            asked = plain_words(item)
            size = min(10, len(asked))
            for s in range(len(asked) - size + 1 if size else 0):
                for p in range(len(words) - size + 1):
                    if words[p : p + size] == asked[s : s + size]:
                        hit |= set(range(p, p + size))
                        found |= {str(item_id)} if item_id is not None else set()
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def found(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in dc.report(d, i).collect()), key=repr)


def test_random_passages_equal_brute_force(spark):
    draw = random.Random(3)
    alphabet = ["the", "of", "é", "x1", "no", "Cat", "dog"]
    items = [(i, " ".join(draw.choice(alphabet) for _ in range(draw.choice([1, 3, 9, 10, 11, 25])))) for i in range(12)]
    docs = []
    for i in range(60):
        words = [draw.choice([*alphabet, "other", "more"]) for _ in range(draw.randint(0, 80))]
        if i % 3 == 0:
            words[10:10] = draw.choice(items)[1].upper().replace("É", "é").split()
        docs.append((i, draw.choice([" ", "--", ".\n"]).join(words)))
    assert found(spark, docs, items) == brute(docs, items)


def test_nulls_repeats_and_empty_texts(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    items = [(1, passage), (1, passage), (None, "lonely words"), (2, None), (3, ""), (10, "gone"), (9, "!!")]
    docs = [(None, f"x {passage} y"), (7, None), (7, ""), (8, "lonely Words"), (8, "lonely Words"), (9, "gone gone"), (4, "ten nine")]
    assert found(spark, docs, items) == brute(docs, items)
    clash = spark.createDataFrame([(1, passage, "r", 2)], "doc_id long, text string, row string, item int")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert dc.without_benchmark(clash, asked).count() == 0
    kept = dc.without_benchmark(clash, asked.filter("item_id = 10"))
    assert kept.columns == clash.columns and kept.collect() == clash.collect()


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert dc.report(docs.limit(0), items).count() == 0
    row = dc.report(docs, items.limit(0)).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    docs = [(1, "a b c d e f g h i j k"), (2, "k j i h g f e d c b a"), (3, "b c")]
    items = [(1, "a b c d e f g h i j k l"), (2, "b c")]
    expected = brute(docs, items)
    monkeypatch.setattr(dc, "BYTES_PER_TERM", 1 << 40)
    assert found(spark, docs, items) == expected


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "common rare1 x y rare2 common"), (2, "rare1 " + "x " * 20 + "rare2"), (3, "common " * 9)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "common rare2 rare1 common common")], "item_id long, text string")
    index = dc.PositionalIndex(docs, items, keep=["doc_id"])
    near = index.proximity(5).join(index.rows, "row").select("doc.doc_id", "pos", "near_pos").collect()
    assert {r.doc_id for r in near} == {1}
    assert {frozenset((r.pos, r.near_pos)) for r in near} == {frozenset((1, 4))}


def test_no_python_in_the_plan(spark, sf_dir):
    from aerolith.llm import registry

    plan = registry.op2_benchmark_decontamination(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_long_items(spark):
    draw = random.Random(4)
    words = [f"w{draw.randint(0, 5000)}" for _ in range(200_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[5000:5010])), (3, " ".join(words[5000:5009]))]
    got = {r[0]: r for r in found(spark, docs, [(7, " ".join(words))])}
    assert [got[i][1:4] for i in (1, 2, 3)] == [(200_000, 200_000, 1), (10, 10, 1), (9, 0, 0)]
