import hashlib

import public_tokenizers
import sentencepiece

import corpus_pipeline
from aerolith.llm import pieces, registry
from tests.llm.brute import component_of
from tests.llm.test_decontamination import plain_words
from tests.llm.test_simhash import plain_fingerprint


def test_stages_keep_the_columns_and_the_last_gives_digests(spark, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "exact_dedup", "near_dedup", "decontamination", "pieces"]
    docs = registry.table(spark, sf_dir, "documents").limit(20)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).schema.names == docs.schema.names


def test_run_equals_a_plain_version(spark, sf_dir):
    docs = {r.doc_id: r for r in registry.table(spark, sf_dir, "documents").collect()}
    guessed = {r.doc_id: r for r in registry.op7_language_id(spark, sf_dir).collect()}
    left = {i: d.text for i, d in docs.items() if guessed[i].lang_pred != "und" and guessed[i].score >= 0.5}
    left = {max(j for j in left if left[j] == t): t for t in left.values()}
    component = component_of({i: plain_fingerprint(t) for i, t in left.items()}, 2)
    left = {i: t for i, t in left.items() if component[i] == i}
    items = [(r.item_id, r.text) for r in registry.table(spark, sf_dir, "benchmark").collect()]
    dirty = set(with_passages(left, items))
    left = {i: t for i, t in left.items() if i not in dirty}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(left) and len(rows) == len(left)
    for row in rows:
        ids = library.encode(left[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(left[row.doc_id].encode()).hexdigest()


def with_passages(docs, items):
    """Ids of documents with a benchmark passage."""
    asked = {}
    for _, text in items:
        words = plain_words(text)
        size = min(10, len(words))
        for s in range(len(words) - size + 1 if size else 0):
            asked.setdefault(size, set()).add(tuple(words[s : s + size]))
    for i, text in docs.items():
        words = plain_words(text)
        if any(tuple(words[p : p + n]) in asked[n] for n in asked for p in range(len(words) - n + 1)):
            yield i


def test_odd_tables(spark, tmp_path, sf_dir):
    folder = str(tmp_path)
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    english = "the cat and the dog were in the house with all of their friends number {}"
    rows = [(i, english.format(i), "en", "s", 3) for i in range(40)] + [(None, None, None, None, None), (None, english.format(99), "en", None, 0), (7, "", "en", "s", 0)]
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() > 0
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(0).write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
