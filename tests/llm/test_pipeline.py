"""The pipeline, stage by stage, against brute force."""

import corpus_pipeline
from samples import SF_DIR
from test_near_dedup import expected_classes
from test_rules_and_lists import base, contaminated

from basketry.llm import bpe, pii, quality_rules, queries


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def test_stages_decide_as_their_operators(spark, documents):
    assert [n for n, _ in corpus_pipeline.STAGES][-1] == "bpe"
    docs = documents
    kept = corpus_pipeline.quality(spark, docs, SF_DIR)
    verdicts = quality_rules.rate(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")).where("kept")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in verdicts.collect()}
    assert not any(base(r.text)[-1] for r in kept.collect())

    docs = corpus_pipeline.shared.stage(kept, "test")
    single = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
    classes = expected_classes([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(classes.values()))

    docs = corpus_pipeline.shared.stage(single, "test")
    clean = corpus_pipeline.benchmark(spark, docs, SF_DIR)
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()
    hit = {r[0] for r in contaminated([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items]) if r[-1]}
    assert {str(r.doc_id) for r in clean.collect()} == {str(r.doc_id) for r in docs.collect()} - hit

    docs = corpus_pipeline.shared.stage(clean, "test")
    masked = corpus_pipeline.personal_data(spark, docs, SF_DIR)
    found = {r.doc_id: r for r in pii.find(docs, pii.learn(docs)).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in masked.collect():
        assert r.text == (text[r.doc_id] if found[r.doc_id].masked is None else found[r.doc_id].masked)
        assert r.n_chars == len(r.text)
    assert masked.columns == docs.columns and masked.count() == docs.count()

    docs = corpus_pipeline.shared.stage(masked, "test")
    tokens = corpus_pipeline.tokens(spark, docs, SF_DIR)
    direct = bpe.encode(docs, queries.tokenizer_path()).select("doc_id", "n_tokens", "ids")
    assert rows(tokens.drop("decoded_sha256")) == rows(direct)
    assert rows(corpus_pipeline.run(spark, SF_DIR)) == rows(tokens)


def test_stages_bear_odd_rows(spark, odd):
    for docs in (odd, odd.limit(0)):
        total = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR)
            assert out.count() <= total, name
            assert name == "bpe" or out.columns == docs.columns
        kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
        ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
        assert len(ids) == len(set(ids))


def test_texts_of_one_id_are_judged_by_themselves(spark):
    """Rows of one id with different texts, some of them near copies of texts of other ids."""
    text = [" ".join(f"w{n}_{i}" for i in range(60)) for n in range(5)]
    given = [(3, text[0]), (3, text[1]), (3, text[1] + " end"), (10, text[1]), (10, text[2]), (-4, text[2])]
    given += [(3, text[0]), (20, text[3]), (20, text[3]), (None, text[0]), (21, None), (21, text[4])]
    docs = spark.createDataFrame(given, "doc_id bigint, text string")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()]
    ones = [x for x in got if x[0] == 3 and x[1].startswith(text[1])]
    assert len(ones) == 1
    rest = [(3, text[0]), (-4, text[2]), (20, text[3]), (None, text[0]), (21, None), (21, text[4])]
    assert sorted(map(str, got)) == sorted(map(str, rest + ones))
