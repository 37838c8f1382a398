import gzip
import json

import pytest
from pyspark.sql import functions as F

from mentionlake.operators import articles
from mentionlake.sources import readers, writers


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_dictionary_definitions_version(spark, tmp_path):
    d = put(tmp_path / "d.json", json.dumps({"7": ["A", "a b"], "9": []}))
    got = [(r.resource_pos, r.resource_id, list(r.names)) for r in readers.read_dictionary(spark, d).collect()]
    assert got == [(0, "7", ["A", "a b"]), (1, "9", [])]
    defs = put(tmp_path / "r.json", '[{"names": ["A"], "topics": ["t"]},\n {"names": ["B"], "ambiguous": 0}]')
    rows = readers.read_definitions(spark, defs).collect()
    assert [(r.names, r.topics, r.ambiguous) for r in rows] == [(["A"], ["t"], None), (["B"], None, 0)]
    v = put(tmp_path / "v.json", '{"name": "n",\n "date": "d", "user": "u"}')
    assert readers.read_version(spark, v) == {"name": "n", "date": "d", "user": "u"}


def test_bundles_split_into_articles(spark, tmp_path):
    one = '<?xml version="1.0"?><articles><article a="1">\n<article-id pub-id-type="pmcid">PMC11</article-id>x</article>'
    two = '<article><article-id x="y" pub-id-type="pmc"> 12 </article-id>é</article><article>no id</article></articles>'
    put(tmp_path / "PMC11_PMC20.xml", one + two)
    with gzip.open(tmp_path / "PMC21_PMC30.xml.gz", "wt", encoding="utf-8") as f:
        f.write('<article><article-id pub-id-type="pmc">PMC21</article-id></article>')
    got = {r.pmcid: r for r in readers.read_article_bundles(spark, str(tmp_path)).collect()}
    assert set(got) == {"PMC11", "PMC12", "PMC21"}
    assert got["PMC11"].xml.startswith('<article a="1">') and got["PMC12"].xml.endswith("é</article>")
    assert got["PMC21"].bundle == "PMC21_PMC30.xml.gz"


def test_texts_and_id_lists(spark, tmp_path):
    put(tmp_path / "PMC1.txt", "a\nb\n")
    put(tmp_path / "skip.csv", "x")
    got = [tuple(r) for r in readers.read_texts(spark, str(tmp_path)).collect()]
    assert got == [("PMC1", "a\nb\n")]
    ids = put(tmp_path / "pmc_idlist.chunk_3.txt", " PMC1 \n\nPMC2\n")
    rows = articles.parse_file_names(readers.read_id_list(spark, ids).select("name").distinct()).collect()
    assert [(r.chunk, r.start_id) for r in rows] == [("3", None)]
    assert [r.pmcid for r in readers.read_id_list(spark, ids).collect()] == ["PMC1", "PMC2"]


def test_labelled_csv_with_quotes_and_breaks(spark, tmp_path):
    head = "resource_name,matched_alias,label,article_topic_match,pmcid,paragraph_text\n"
    put(tmp_path / "a.csv", head + 'R,a,1,True,PMC1,"x, ""y""\nz"\n')
    (tmp_path / "sub").mkdir()
    put(tmp_path / "sub" / "b.csv", head + "Q,b,0,False,PMC2,t\n")
    rows = readers.union_labelled(readers.read_labelled(spark, str(tmp_path))).collect()
    assert sorted((r.resource_name, r.label, r.article_topic_match, r.paragraph_text) for r in rows) == [
        ("Q", 0, False, "t"), ("R", 1, True, 'x, "y"\nz'),
    ]
    with pytest.raises(ValueError):
        readers.union_labelled(spark.createDataFrame([], readers.LABELLED_SCHEMA))


def test_metadata_shards_round_trip(spark, tmp_path):
    records = [(json.dumps({"pmcid": f"PMC{i}", "title": "t", "authorList": {"a": i}}),) for i in range(20)]
    meta = articles.normalise_metadata(spark.createDataFrame(records, "record string"))
    path = str(tmp_path / "shards")
    writers.write_metadata_shards(meta, path, shards=4)
    lines = readers.read_metadata_lines(spark, f"{path}/shard=*")
    latest = articles.latest_metadata(lines, ["file", "block", "line"])
    assert latest.count() == 20
    shards = spark.read.json(path).select("pmcid", "shard")
    want = articles.assign_shards(meta.select("pmcid"), 4).select("pmcid", "shard")
    assert set(map(tuple, shards.collect())) == set(map(tuple, want.collect()))


def test_chunks_texts_counts_csv(spark, tmp_path):
    ids = spark.range(10).select(F.concat(F.lit("PMC"), "id").alias("pmcid"))
    writers.write_id_chunks(ids, str(tmp_path / "c"), 3)
    got = spark.read.text(str(tmp_path / "c")).groupBy("chunk").count().collect()
    assert {r.chunk: r["count"] for r in got} == {1: 4, 2: 4, 3: 2}
    texts = spark.createDataFrame([("a", "x"), ("b", "")], "doc_id string, text string")
    writers.write_texts(texts, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1
    summary = spark.createDataFrame([("PMC1", "R", 'a "b"', 2, 0.95)], readers.SUMMARY_SCHEMA)
    writers.write_summary(summary, str(tmp_path / "s"))
    assert [tuple(r) for r in readers.read_summary(spark, str(tmp_path / "s")).collect()] == [
        ("PMC1", "R", 'a "b"', 2, 0.95)
    ]
    counts = spark.createDataFrame([("R", "a", 1, 3)], "resource_name string, alias string, prediction int, n long")
    writers.write_counts(counts, str(tmp_path / "n1"))
    writers.write_counts(counts, str(tmp_path / "n2"))
    assert readers.read_counts(spark, str(tmp_path / "n1"), str(tmp_path / "n2")).count() == 2
    scores = spark.createDataFrame([("R", "a", 1, 3, 0.75), ("Q", "b", 0, 1, 1.0)], "resource_name string, alias string, negatives long, positives long, specificity double")
    writers.write_specificity(scores, str(tmp_path / "sp"))
    assert spark.read.csv(str(tmp_path / "sp"), header=True).first().resource_name == "Q"
    writers.write_by_resource(scores, str(tmp_path / "by"))
    assert (tmp_path / "by" / "resource=Q").is_dir()


def test_facts_are_appended_once(spark, tmp_path):
    schema = "pmcid string, title string, resource_id int, matched_alias string, version string"
    facts = spark.createDataFrame([("P1", "t", 1, "a", "v"), ("P1", "t", 1, "b", "v"), ("P1", "t", 1, "a", "v")], schema)
    path, pubs = str(tmp_path / "f"), str(tmp_path / "p")
    for _ in range(2):
        writers.append_facts(facts, path)
        writers.append_publications(facts, pubs)
    assert spark.read.parquet(path).count() == 2 and spark.read.parquet(pubs).count() == 1
    writers.append_facts(facts.withColumn("version", F.lit("v2")), path)
    assert spark.read.parquet(path).count() == 4
