"""The pipeline stage by stage against plain versions of what each must do."""

import public_tokenizers
import sentencepiece

import corpus_pipeline
from claimledger.llm import quality
from claimledger.llm.common import stored, table
from tests.conftest import SMALL
from tests.llm.test_operators import base_spans, similar_groups


def test_stages(spark, con):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    seen = [docs.collect()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, SMALL))
        assert number == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        seen.append(docs.collect())
    raw, good, single, clean, masked, coded = seen

    model = quality.train(table(spark, SMALL, "documents"), table(spark, SMALL, "labels"))
    scored = quality.score(table(spark, SMALL, "documents"), model).where("predicted = 1").select("doc_id").collect()
    assert sorted(r.doc_id for r in good) == sorted(r.doc_id for r in scored)

    groups = similar_groups([(r.doc_id, r.text) for r in good])
    assert sorted(r.doc_id for r in single) == sorted(i for i, (_, least) in groups.items() if i == least)

    items = [t.lower() for (t,) in con.execute("select text from benchmark").fetchall()]
    leaks = {r.doc_id for r in single if any(t in r.text.lower() for t in items)}
    assert leaks and {r.doc_id for r in clean} == {r.doc_id for r in single} - leaks

    before = {r.doc_id: r.text for r in clean}
    assert {r.doc_id for r in masked} == set(before)
    for r in masked:
        assert not base_spans(r.text) and r.n_chars == len(r.text)
        assert r.text == before[r.doc_id] or "[SECRET]" in r.text

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.PIECES))
    for r in coded:
        assert r.ids == library.encode(r.text) and r.round_trip and r.n_tokens == len(r.ids)


def test_an_empty_table(spark):
    docs = table(spark, SMALL, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL))
        assert docs.count() == 0
