"""The runnable job on a small folder, end to end and twice."""

import json

from mentionlake import job
from mentionlake.operators import detect, sentences
from mentionlake.sources import pruned, writers


def test_job_from_bundles_to_facts(spark, tmp_path):
    article = '<article><front><article-id pub-id-type="pmc">{n}</article-id></front><body><sec><title>x</title><p>{p}</p></sec></body></article>'
    (tmp_path / "bundles").mkdir()
    texts = {1: "We used GeneBank data here. GeneBank is good.", 2: "Nothing to see.", 3: "Data of ProtBase and GeneBank."}
    (tmp_path / "bundles" / "PMC0_PMC9.xml").write_text("\n".join(article.format(n=n, p=t) for n, t in texts.items()))
    (tmp_path / "names.json").write_text(json.dumps({"1": ["GeneBank", "GB base"], "2": ["ProtBase"]}))
    (tmp_path / "train").mkdir()
    rows = ["resource_name,alias,label,article_topic_match,pmcid,paragraph_text"]
    rows += [f"GeneBank,GeneBank,1,true,PMC{i},used data of GeneBank here" for i in range(5)]
    rows += [f"GeneBank,GeneBank,0,true,PMC{i},ugly weather today" for i in range(5)]
    (tmp_path / "train" / "a.csv").write_text("\n".join(rows))
    meta = [{"id": f"PMC{n}", "pmcid": f"PMC{n}", "title": f"T{n}", "authorString": "A", "authorList": '{"a": 1}', "citedByCount": 0} for n in (1, 2)]
    (tmp_path / "meta.jsonl").write_text("\n".join(map(json.dumps, meta)))
    (tmp_path / "version.json").write_text(json.dumps({"name": "v1", "date": "2024-01-01", "user": "u"}))
    args = [
        "--dictionary", f"{tmp_path}/names.json", "--bundles", f"{tmp_path}/bundles", "--labelled", f"{tmp_path}/train",
        "--metadata", f"{tmp_path}/meta.jsonl", "--version", f"{tmp_path}/version.json", "--out", f"{tmp_path}/out", "--min-confidence", "0.5",
    ]
    for _ in range(2):
        job.run(spark, job.parser().parse_args(args))
    found = {(r.doc_id, r.alias) for r in spark.read.parquet(f"{tmp_path}/out/mentions").collect()}
    assert found == {("PMC1", "GeneBank"), ("PMC3", "GeneBank"), ("PMC3", "ProtBase")}
    facts = spark.read.parquet(f"{tmp_path}/out/facts").collect()
    assert [(r.pmcid, r.short_name, r.version) for r in facts] == [("PMC1", "GeneBank", "v1")]
    rejects = spark.read.parquet(f"{tmp_path}/out/rejects").collect()
    assert [(r.pmcid, r.reason) for r in rejects] == [("PMC3", "no metadata")]
    assert spark.read.parquet(f"{tmp_path}/out/publications").count() == 1
    assert spark.read.csv(f"{tmp_path}/out/specificity", header=True).count() == 2


def test_job_searches_cascades_and_reads_pruned_files(spark, tmp_path):
    article = '<article><front><article-id pub-id-type="pmc">{n}</article-id></front><body><sec><title>x</title><p>{p}</p></sec></body></article>'
    (tmp_path / "bundles").mkdir()
    for first, texts in ((0, {1: "GeneBank data in a bundle.", 2: "GeneBank, not asked for."}), (10, {11: "More GeneBank data."})):
        (tmp_path / "bundles" / f"PMC{first}_PMC{first + 9}.xml").write_text("\n".join(article.format(n=n, p=t) for n, t in texts.items()))
    (tmp_path / "bundles" / "PMC90_PMC99.xml.gz").write_bytes(b"\x1f\x8bbroken")  # holds nothing wanted: never opened
    (tmp_path / "names.json").write_text(json.dumps({"1": ["GeneBank"]}))
    (tmp_path / "version.json").write_text(json.dumps({"name": "v1", "date": "2024-01-01", "user": "u"}))
    (tmp_path / "ids.txt").write_text("PMC11\nPMC50\n")
    local = [("PMC1", "A local text with GeneBank data."), ("PMC3", "Nothing."), ("PMC70", "GeneBank too.")]
    spark.createDataFrame(local, "pmcid string, text string").write.parquet(f"{tmp_path}/texts")
    corpus = [("PMC1", "genebank data"), ("PMC3", "other"), ("PMC70", None)]
    spark.createDataFrame(corpus, "pmcid string, text string").write.parquet(f"{tmp_path}/corpus")
    weights = spark.createDataFrame([(-1, 10**6)], "feature int, weight_micro bigint")
    weights.write.parquet(f"{tmp_path}/weights")
    fields = {"title": "T", "authorList": "{1}", "citedByCount": 1}
    names = [f.split()[0] for f in pruned.STORED_METADATA.split(", ")]
    rows = [{n: fields.get(n, f"PMC{i}") for n in names} for i in (1, 11)]
    writers.write_metadata_shards(spark.createDataFrame(rows, pruned.STORED_METADATA), f"{tmp_path}/meta", shards=8)
    job.run(spark, job.parser().parse_args([
        "--dictionary", f"{tmp_path}/names.json", "--texts", f"{tmp_path}/texts", "--bundles", f"{tmp_path}/bundles",
        "--ids", f"{tmp_path}/ids.txt", "--search", f"{tmp_path}/corpus", "--weights", f"{tmp_path}/weights", "--min-confidence", "0.5",
        "--metadata", f"{tmp_path}/meta", "--metadata-shards", "8", "--version", f"{tmp_path}/version.json", "--out", f"{tmp_path}/out",
    ]))
    found = {(r.doc_id, r.sentence) for r in spark.read.parquet(f"{tmp_path}/out/mentions").collect()}
    assert {i for i, _ in found} == {"PMC1", "PMC11"} and ("PMC1", "A local text with GeneBank data.") in found
    assert {r.pmcid for r in spark.read.parquet(f"{tmp_path}/out/facts").collect()} == {"PMC1", "PMC11"}


def test_rarest_word_anchors_reach_the_search(spark):
    texts = spark.createDataFrame([(1, "Bank of the river. The Bank."), (2, "the the the")], "doc_id int, text string")
    names = spark.createDataFrame([(1, "B", "of the river", 0, False)], "resource_id int, resource_name string, alias string, alias_pos int, case_sensitive boolean")
    counts = detect.token_counts(sentences.split_sentences(texts))
    plain = detect.find_in_texts(texts, names).collect()
    assert len(plain) == 1
    assert detect.find_in_texts(texts, names, token_counts=counts).collect() == plain
    assert detect.find_in_texts(texts, names, max_rows=0).collect() == plain
