import itertools
import math
import zlib

import numpy as np

from aerolith.llm import language, registry


def test_forward_sum_equals_all_segmentations():
    vocab = language.vocabulary(language.VOCABULARY)
    draw = np.random.default_rng(1)
    chance = draw.random((len(vocab.pieces) + 1, 2)) * 1e-3
    words = ["the", "thing", "été", "日x", "ab"]
    number = {p: i for i, p in enumerate(vocab.pieces)}
    lattice = language._Lattice(vocab, words)
    sums = lattice.forward(chance)[np.arange(len(words)), lattice.last]
    assert np.allclose(sums, lattice.backward(chance)[:, 0])
    for word, found in zip(words, sums, strict=True):
        marked, total = language.START + word, np.zeros(2)
        for bits in itertools.product([0, 1], repeat=len(marked) - 1):
            cuts = [0, *[i + 1 for i, b in enumerate(bits) if b], len(marked)]
            parts = [marked[a:b] for a, b in itertools.pairwise(cuts)]
            ids = [number.get(p, vocab.unknown if len(p) == 1 else None) for p in parts]
            if None not in ids:
                total += np.prod(chance[ids], axis=0)
        assert np.allclose(found, total)
        assert np.allclose(language._long_word(vocab, word, chance), np.log(total))


def test_held_out_accuracy(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in registry.table(spark, sf_dir, "documents").collect()}
    rows = registry.op7_language_id(spark, sf_dir).collect()
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in truth}
    kept = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in kept) >= 0.98 * len(kept)
    assert all(0 <= r.score <= 1 and not math.isnan(r.score) for r in rows)


def make(spark, extra=()):
    english = "the cat and the dog were in the house with all of their friends"
    german = "der hund und die katze waren mit allen ihren freunden in dem haus"
    rows = [(i, english if i % 2 else german, "en" if i % 2 else "de", i) for i in range(60)]
    return spark.createDataFrame(rows + list(extra), "doc_id long, text string, lang string, score int")


def test_undecided_texts_and_odd_rows(spark):
    long_word = "cats" * 5000
    odd = [(None, "the house", "en", 0), (900, None, "en", 0), (901, "12 ² !", None, 0), (902, "", "de", 0), (903, long_word, None, 0), (903, "der die das und", None, 1)]
    docs = make(spark, odd)
    by_id = {}
    for r in language.report(docs).collect():
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[None][0].lang_pred == "en" and by_id[None][0].held_out is False
    assert [by_id[i][0].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert len(by_id[903]) == 2 and "de" in {r.lang_pred for r in by_id[903]}
    kept = language.known_language(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(60)) | {None, 903}


def test_nothing_to_learn_from(spark):
    docs = make(spark)
    assert language.report(docs.limit(0)).count() == 0
    blank = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in language.report(blank).collect()} == {("und", 0.0)}


def test_label_is_no_input_of_a_prediction(spark):
    docs = make(spark)
    model = language.fit(docs)
    swapped = docs.selectExpr("doc_id", "text", "'xx' as lang", "'s' as source")
    a = {r.doc_id: r.guess for r in language.predicted(docs, model).select("doc.doc_id", "guess").collect()}
    b = {r.doc_id: r.guess for r in language.predicted(swapped, model).select("doc.doc_id", "guess").collect()}
    assert a == b


def test_unsegmented_languages_are_learnt(spark):
    zh, ja = "的一是不了人我在有他这中大来上国个到说们", "のにはをたがでてとしれさるあいうえおかき"
    rows = [(i, (zh, ja)[i % 2][i % 7 :] * 4, ("zh", "ja")[i % 2]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == ["ja", "zh"]
    guessed = language.predicted(docs, model).collect()
    assert all(r.guess.lang_pred == r.doc.lang for r in guessed)


def test_expected_pieces_of_long_words_are_those_of_short_ones():
    vocab = language.vocabulary(language.VOCABULARY)
    chance = np.random.default_rng(1).random(len(vocab.pieces) + 1) * 1e-3
    lattice = language._Lattice(vocab, ["understanding"])
    ahead, behind = lattice.forward(chance[:, None])[0, :, 0], lattice.backward(chance[:, None])[0, :, 0]
    share = ahead[lattice.start] * chance[lattice.piece] * behind[lattice.end] / behind[0]
    pieces, found = language._long_shares(vocab, "understanding", chance)
    assert np.allclose(np.bincount(pieces, found, len(chance)), np.bincount(lattice.piece, share, len(chance)))
