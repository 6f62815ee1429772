import public_tokenizers
import sentencepiece

import corpus_pipeline
from rostra.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        docs = corpus_pipeline.written(docs, "test-stage")
        assert docs.columns == columns
        kept = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(kept) == len(set(kept)) and set(kept) <= ids
        if name == "mixing":
            assert set(kept) == ids
        else:
            assert len(kept) < len(ids) or name == "toxicity"
        ids = set(kept)
    name, stage = corpus_pipeline.STAGES[-1]
    found = stage(spark, docs, FOLDER).collect()
    assert {r.doc_id for r in found} == ids and all(r.lossless for r in found)
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in found[:50]:  # the library's own decoder, as far as it leaves white space alone
        assert model.decode(r.ids).split() == texts[r.doc_id].split()


def test_queries_are_registered():
    from __spark_entry__ import oracle_sql, queries

    names = [n for n in queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 14
    assert {"op4_topk", "op6_exact_dedup"} <= set(oracle_sql())
