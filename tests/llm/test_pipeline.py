import corpus_pipeline
from ordermill.llm import simhash, suffix
from tests.llm.rows import ODD_TEXTS, documents, words
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_suffix import plain_runs


def test_each_stage_on_its_own_input(spark):
    passage = words(77, 60)
    texts = ODD_TEXTS + [words(i, 40) + passage + words(i + 50, 40) for i in range(4)] + [words(5, 90)] * 3
    docs = documents(spark, texts, ", extra int", (1,))
    docs = docs.unionByName(docs.filter("doc_id IN (6, 13)"))  # repeated rows
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]

    kept = stages["language_id"](spark, docs, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert set(ids) == {i for i, t in enumerate(texts) if t and any(c.isalpha() for c in t)}
    assert ids.count(6) == ids.count(13) == 2

    rows = simhash.one_of_each(kept).collect()
    codes = [plain_fingerprint(texts[i]) for i in sorted(set(ids))]
    roots = {sorted(set(ids))[r] for r in plain_components(codes)}
    assert sorted(r["doc_id"] for r in rows) == sorted(roots)

    deduped = stages["simhash_near_dedup"](spark, kept, "")
    assert sorted(r["doc_id"] for r in deduped.collect()) == sorted(roots)
    order = sorted(roots)
    raws = [texts[i].encode() for i in order]
    clean = {r["doc_id"]: r for r in stages["suffix_array_dedup"](spark, deduped, "").collect()}
    assert sorted(clean) == order
    for i, raw, gone in zip(order, raws, plain_runs(raws), strict=True):
        if not any(gone):
            assert clean[i]["text"] == texts[i]
        else:
            assert passage[20:-20] not in clean[i]["text"]
        assert clean[i]["n_chars"] == len(clean[i]["text"])


def test_whole_pipeline_on_the_smallest_tables(spark, tiny):
    rows = corpus_pipeline.run(spark, tiny)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(rows.columns)
    assert rows.count() > 100


def test_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert suffix.LENGTH == 200
