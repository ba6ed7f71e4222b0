"""The pipeline against its stages applied by plain code."""

import public_tokenizers
import sentencepiece

import corpus_pipeline
from rollcall.llm import decontaminate, jaccard_join, quality_rules
from rollcall.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert len(corpus_pipeline.STAGES) == 5
    kept = stages["language ID"](spark, docs, SF)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    good = stages["quality rules"](spark, kept, SF)
    assert good.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in good.collect()]
    for _, t in rows:
        n, _, _, _, again = quality_rules.brute_force(t)
        assert n >= 50 and 100 * again <= 50 * n
    near = stages["n-gram Jaccard join"](spark, good, SF)
    want = sorted(i for i, _, c in jaccard_join.brute_force(rows, 5, 80, 100) if i == c)
    assert sorted(r.doc_id for r in near.collect()) == want
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    clean = stages["benchmark decontamination"](spark, near, SF)
    hit = {r[0] for r in decontaminate.brute_force([x for x in rows if x[0] in set(want)], items) if r[-1]}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(want) - hit)
    texts = dict(rows)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: (list(r.ids), r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {i: (ids, len(ids)) for i in set(want) - hit for ids in [library.encode(texts[i])]}


def test_odd_rows(spark):
    rows = [(1, None, "en", None, None), (2, "", None, None, None), (None, "a word " * 40, "en", "s", 1), (3, "x y z " * 100, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS id", "2 AS root")
    again = [(7, "x y z w v u " * 30, "en", "s", 1), (7, "other words that no one repeats here", "en", "s", 1), (None, "x y z w v u " * 30, "en", "s", 1), (4, "x y z w v u " * 30, "en", "s", 1)]
    left = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, spark.createDataFrame(again, "doc_id long, text string, lang string, source string, n_chars long"), SF)
    assert sorted((r.doc_id, r.text[:5]) for r in left.collect()) == [(4, "x y z"), (7, "other")]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0
