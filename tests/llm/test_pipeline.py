"""Every stage of the corpus pipeline against brute force on what the stage before kept."""

import zlib

import corpus_pipeline
from tests.llm.test_operators import SF, brute_components, cut_by_brute_force, plain_simhash, windows_hit
from tidemark.llm import packing, toxicity


def test_stages_agree_with_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    cut = toxicity.train(docs, labels)[2]
    scores = {r.doc_id: r.toxicity_score for r in toxicity.score_toxicity(docs, labels).collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        ids = sorted(before)
        if name == "toxicity":
            assert {r.doc_id for r in rows} == {i for i in ids if scores[i] < cut}
        elif name == "simhash_dedup":
            groups = brute_components([plain_simhash(before[i].text) for i in ids])
            assert sorted(r.doc_id for r in rows) == sorted(ids[g] for g in set(groups))
        elif name == "substring_dedup":
            want = cut_by_brute_force([before[i].text for i in ids], 35)
            assert {r.doc_id: r.text for r in rows} == {i: before[i].text if w is None else w for i, w in zip(ids, want, strict=True)}
        elif name == "decontamination":
            for r in rows:
                n, hit, _ = windows_hit(before[r.doc_id].text, items)
                assert (r.text == before[r.doc_id].text) == (not hit) and (hit or r.n_chars == before[r.doc_id].n_chars)
                assert windows_hit(r.text, [])[0] == n - len(hit)
            assert len(rows) == len(before)
        else:
            exact = packing.Tokens(packing.tokenizer_path(), None)
            whole = {i: exact.encode(before[i].text or "") + (1).to_bytes(4, "little") for i in ids}
            assert sum(r.length for r in rows) == sum(len(w) // 4 for w in whole.values())
            assert all(r.ids_crc32 == zlib.crc32(whole[r.doc_id][4 * r.start : 4 * (r.start + r.length)]) for r in rows)
            break
        assert docs.columns == columns
        before = {r.doc_id: r for r in rows}


def test_run_returns_the_last_stage(spark):
    packed = corpus_pipeline.run(spark, SF)
    assert packed.count() > 0 and "sequence_id" in packed.columns
