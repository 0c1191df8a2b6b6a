import random

import pytest

from aerolith.llm import registry, token_counts as tc

ODD = "ab cdE  \n\t\x00\xa0　\x1céÉß日本𠀀'st're<|endoftext|>́İΣ.,;1 ½²​"


def whole(text):
    return len(tc.load(tc.MODEL)[0].encode(text, add_special_tokens=False).ids)


def test_words_and_chunks_equal_the_library():
    tokenizer, words = tc.load(tc.MODEL)
    draw = random.Random(2)
    for _ in range(400):
        text = "".join(draw.choice(ODD) for _ in range(draw.randint(0, 60)))
        assert words.count(text) == whole(text)
        assert tc.count_huge(tokenizer, text, 16, 4) == whole(text)


@pytest.mark.parametrize("text", ["", "x" * 100_000, " " * 70_000 + "a b", "word, " * 20_000, "日本" * 20_000, "a.b " * 10_000])
def test_huge_texts(text):
    assert tc.count_tokens(text) == whole(text)


def test_query_equals_the_library(spark, sf_dir):
    texts = {r.doc_id: r.text for r in registry.table(spark, sf_dir, "documents").collect()}
    for row in registry.op3_token_counts(spark, sf_dir).collect():
        text = texts[row.doc_id]
        assert tuple(row)[1:] == (len(text.encode()), whole(text), whole(text) > 2048)


def test_null_text_and_clashing_column(spark):
    docs = spark.createDataFrame([(1, None, 2), (None, "a b", 3)], "doc_id long, text string, n_tokens int")
    assert sorted((tuple(r) for r in tc.report(docs).collect()), key=repr) == [(1, 0, 0, False), (None, 3, 2, False)]
    assert tc.with_counts(docs).select("doc.n_tokens").count() == 2
    assert tc.report(docs.limit(0)).count() == 0
