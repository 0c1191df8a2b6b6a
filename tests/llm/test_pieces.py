import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from aerolith.llm import pieces, registry

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
ODD = "ab cd▁  \n\t\x00éß日本𠀀語的  aaaatheing<s>0x41..."


def joined(ids):
    return ",".join(map(str, ids))


def test_random_texts_equal_the_library():
    bpe, draw = pieces.load(pieces.MODEL), random.Random(1)
    vocabulary = list(bpe.id_of)
    for n in range(3000):
        if n % 3 == 0:
            text = "".join(draw.choice(ODD) for _ in range(draw.randint(0, 30)))
        elif n % 3 == 1:
            text = "".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 8))).replace("▁", " ")
        else:
            text = "".join(" " * draw.randint(1, 40) if draw.random() < 0.5 else "ab" for _ in range(8))
        ids = LIBRARY.encode(text)
        assert bpe.encode(text) == joined(ids)
        assert bpe.decode(joined(ids)) == LIBRARY.decode(ids)


@pytest.mark.parametrize("text", ["thequickbrownfox" * 9000, " " * 5000, "\n" * 5000, "日本語" * 5000, "x y " * 30_000])
def test_long_texts(text):
    assert pieces.load(pieces.MODEL).encode(text) == joined(LIBRARY.encode(text))


def test_full_caches_start_anew(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_PARTS", 3)
    monkeypatch.setattr(pieces, "REMEMBERED_PAIRS", 3)
    bpe = pieces.PieceBpe(public_tokenizers.path(pieces.MODEL))
    for text in ["one two three four five six", "seven eight ninetynine", "one two"]:
        assert bpe.encode(text) == joined(LIBRARY.encode(text))


def test_query_equals_the_library(spark, sf_dir):
    texts = {r.doc_id: r.text for r in registry.table(spark, sf_dir, "documents").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for row in registry.op8_sentencepiece(spark, sf_dir).collect():
        ids = LIBRARY.encode(texts[row.doc_id])
        assert tuple(row)[1:] == (len(ids), sha(joined(ids)), sha(LIBRARY.decode(ids)))


def test_ids_as_rows_and_back(spark):
    docs = spark.createDataFrame([(1, "a  b\n", 1), (None, None, 2)], "doc_id long, text string, ids int")
    back = pieces.decoded(pieces.encoded(docs)).orderBy("doc.ids").collect()
    assert [r.decoded for r in back] == ["a  b\n", ""]
    assert back[0].ids == LIBRARY.encode("a  b\n")
    assert pieces.report(docs.limit(0)).count() == 0
    assert [r.n_tokens for r in pieces.report(docs.filter("text is null")).collect()] == [0]


def test_pieces_meet_as_merging_them_from_scratch_says():
    bpe = pieces.load(pieces.MODEL)
    draw = random.Random(5)
    usable = [p for p in bpe.edges if pieces.SPACE not in p]
    split = [(p[:k], p[k:]) for p in draw.sample(usable, 3000) for k in range(1, len(p))]
    pairs = [(a, b) for a, b in split if a in bpe.edges and b in bpe.edges]
    pairs += [(draw.choice(usable), draw.choice(usable)) for _ in range(3000)]
    answers = [bpe.meet(a, b) for a, b in pairs]
    assert answers == [bpe.merge(a + b) == [a, b] for a, b in pairs]
    assert len(set(answers)) == 2
