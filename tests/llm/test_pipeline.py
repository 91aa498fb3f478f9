"""Every stage does its job on what the one before kept."""

import corpus_pipeline
from panelkit.llm import cuckoo, dart_minhash, disclosure
from panelkit.llm.common import table
from panelkit.operators.staging import settle
from test_tokens import check_packing

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "personal_data", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = settle(stage(spark, docs, SF))
        assert docs.columns == before.columns
        kept[name] = docs
    good = dict(table(spark, SF, "labels").select("doc_id", "quality").collect())
    stays = {r["doc_id"] for r in kept["quality"].select("doc_id").collect()}
    assert all((good[d] == 1) == (d in stays) for d in good)
    own = cuckoo.find_duplicates(kept["quality"]).where("kept")
    assert kept["exact_dedup"].count() == own.count()
    near = dart_minhash.near_duplicates(kept["near_dedup"])
    assert near.where("class_size > 1").count() == 0
    assert kept["near_dedup"].count() == dart_minhash.near_duplicates(kept["exact_dedup"]).where("kept").count()
    found = disclosure.find_personal_data(kept["personal_data"])
    assert found.where("n_email + n_ip + n_card + n_phone > 0").count() == 0
    assert kept["personal_data"].count() == kept["near_dedup"].count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    check_packing(docs, pieces)
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, pieces.collect()))


def test_stages_bear_odd_documents(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = settle(stage(spark, docs, SF))
            assert docs.columns == odd.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
