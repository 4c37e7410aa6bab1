"""The pipeline on the smallest tables: every stage's decision takes effect."""

import corpus_pipeline
from hazeline.llm import decontaminate, secret_scan
from hazeline.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept[-1], SF).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        kept.append(out)
    quality, unique, clean, masked, encoded = [k.collect() for k in kept[1:]]
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    known = [(r.doc_id in {x.doc_id for x in quality}) == bool(labels[r.doc_id]) for r in docs.collect() if r.doc_id in labels]
    assert sum(known) >= 0.95 * len(known)
    texts = {(r.doc_id, " ".join(r.text.lower().split())) for r in unique}
    assert len({t for _, t in texts}) == len(unique)
    bench = table(spark, SF, "benchmark")
    assert decontaminate.scanned(kept[3], bench).where("contaminated").count() == 0
    assert decontaminate.scanned(kept[2], bench).where("not contaminated").count() == len(clean)
    assert not any(secret_scan.base_spans(r.text) for r in masked)
    assert len(masked) == len(clean) == len(encoded) and all(r.n_tokens == len(r.token_ids) for r in encoded)


def tables(spark, folder, docs):
    schema = "doc_id long, text string, lang string, source string, n_chars long, version long, _version long, score string, spans int"
    spark.createDataFrame([(i, t, lang, "s", 1, 2, 3, "x", 4) for i, t, lang in docs], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, t, _ in docs if i and t], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    bench = [(1, "these ten words stand in the benchmark and not elsewhere"), (2, None)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_odd_rows_go_through_all_stages(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(30_000))
    docs = [(1, "one two three four five six", "en"), (2, None, "en"), (3, "", None), (1, "one two three four five six", "en"), (None, "no id here at all", "en"),
            (4, long, "en"), (5, long, "de"), (6, "see these ten words stand in the benchmark and not elsewhere", "en"),
            (7, 'password = "Zx81kfjw92"', "en")]
    rows = corpus_pipeline.run(spark, tables(spark, tmp_path, docs)).collect()
    ids = [r.doc_id for r in rows]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 7] and ids.count(None) == 1
    assert {r.doc_id: r.n_tokens for r in rows}[3] == 0


def test_empty_tables_go_through_all_stages(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, [])).count() == 0
