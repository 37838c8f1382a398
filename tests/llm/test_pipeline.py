"""The pipeline on a small table, stage by stage."""

import corpus_pipeline
from mentionlake.llm import decontaminate, near_dups, quality

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        counts.append(docs.count())
        assert docs.columns == columns, name
    good, distinct, clean = counts[1:4]
    assert counts[0] > good > distinct >= clean > 0
    known = spark.read.parquet(f"{SF}/labels.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    source = spark.read.parquet(f"{SF}/documents.parquet")
    kept = quality.keep_good(source, known).cache()
    assert kept.count() == good
    one = near_dups.keep_one(kept).cache()
    classes = near_dups.near_classes(one).collect()
    assert one.count() == distinct and all(r["doc_id"] == r["class_id"] for r in classes)
    assert decontaminate.leaks(decontaminate.drop_leaks(one, benchmark), benchmark).count() == 0
    # Good texts are hardly ever lost to the rules.
    fine = known.where("quality = 1").join(source, "doc_id").where("length(text) > 200")
    assert fine.join(kept, "doc_id", "left_semi").count() >= 0.9 * fine.count()


def test_run_and_names(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "decontamination", "mixing", "token_files"]
    rows = corpus_pipeline.run(spark, SF).collect()
    ordered = sorted(rows, key=lambda r: r["start"])
    at = 0
    for r in ordered:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in ordered] == sorted(r["doc_id"] for r in ordered)
