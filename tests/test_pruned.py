"""Reads that open only the files the ids need."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from mentionlake.sources import pruned, writers

XML = "<article><front><article-id pub-id-type=\"pmcid\">PMC{0}</article-id></front><body><p>text {0}</p></body></article>"


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(f"PMC{i}", XML.format(i), f"PMC{i // 10 * 10}_PMC{i // 10 * 10 + 9}.xml.gz") for i in range(100)]
    rows += [(f"PMC{i}", XML.format(i), "PMC40_PMC59.xml") for i in range(40, 60)]
    rows += [("PMC7", None, "PMC0_PMC9.xml.gz"), ("PMC8", XML.format(8), None)]
    assert pruned.write_bundles(spark.createDataFrame(rows, "pmcid string, xml string, bundle string"), f"{tmp_path}/b") == 11
    return f"{tmp_path}/b"


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "pmcid string")


def test_only_bundles_that_hold_a_wanted_id_are_opened(spark, folder):
    for name in os.listdir(folder):  # an unwanted file that is opened fails the read
        if not name.startswith(("PMC10_", "PMC40_", "PMC90_", ".")):
            with open(f"{folder}/{name}", "wb") as out:
                out.write(b"\x1f\x8bbroken")
    wanted = ids(spark, "PMC11", "PMC15", "PMC45", "PMC99", "PMC99", None, "PMCx", "PMC4000", "PMC")
    rows = pruned.read_wanted_articles(spark, folder, wanted, width=16)
    got = {r["pmcid"]: r for r in rows.collect()}
    assert {k: r["bundle"] for k, r in got.items()} == {
        "PMC11": "PMC10_PMC19.xml.gz", "PMC15": "PMC10_PMC19.xml.gz", "PMC45": "PMC40_PMC49.xml.gz", "PMC99": "PMC90_PMC99.xml.gz",
    }
    assert rows.count() == 4 and got["PMC45"]["xml"] == XML.format(45)
    assert sorted(map(os.path.basename, rows.inputFiles()))[:2] == ["PMC10_PMC19.xml.gz", "PMC40_PMC49.xml.gz"]


def test_no_wanted_id_opens_nothing(spark, folder):
    for name in os.listdir(folder):
        with open(f"{folder}/{name}", "wb") as out:
            out.write(b"\x1f\x8bbroken")
    assert pruned.read_wanted_articles(spark, folder, ids(spark, "PMC777", None)).collect() == []
    assert pruned.read_wanted_articles(spark, folder, ids(spark)).collect() == []


def test_the_listing_reads_names_only(spark, folder):
    with gzip.open(f"{folder}/notes.xml.gz", "wb") as out:
        out.write(b"x")
    listed = {r["bundle"]: (r["start_id"], r["end_id"]) for r in pruned.list_bundles(spark, folder).collect()}
    assert len(listed) == 11 and listed["PMC40_PMC59.xml"] == (40, 59) and "notes.xml.gz" not in listed


def test_bundles_compute_each_text_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text_of(i):
        made.add(1)
        return None if i % 4 == 0 else XML.format(i)

    rows = spark.range(40).localCheckpoint().select(
        F.concat(F.lit("PMC"), "id").alias("pmcid"), text_of("id").alias("xml"),
        F.when(F.col("id") == 4, "PMC4_PMC4.xml").otherwise("PMC0_PMC39.xml.gz").alias("bundle"),
    )
    assert pruned.write_bundles(rows, f"{tmp_path}/once") == 1 and os.listdir(f"{tmp_path}/once") == ["PMC0_PMC39.xml.gz"]
    assert made.value == 40
    with gzip.open(f"{tmp_path}/once/PMC0_PMC39.xml.gz", "rt") as file:
        assert file.read() == "".join(XML.format(i) + "\n" for i in range(40) if i % 4)


def test_many_picked_files_are_looked_up_by_few_tasks(spark, tmp_path):
    rows = [(f"PMC{i}", XML.format(i), f"PMC{i}_PMC{i}.xml") for i in range(60)]
    pruned.write_bundles(spark.createDataFrame(rows, "pmcid string, xml string, bundle string"), f"{tmp_path}/many")
    context, before = spark.sparkContext, spark.conf.get(pruned.DISCOVERY)
    context.setJobGroup("many files", "")
    try:
        read = pruned.read_wanted_articles(spark, f"{tmp_path}/many", ids(spark, *(f"PMC{i}" for i in range(50))), width=16)
        tracker = context.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("many files") for s in tracker.getJobInfo(j).stageIds]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    looked = [s.numTasks for s in stages if s and s.name.startswith("text at")]
    assert looked and max(looked) <= 2 * context.defaultParallelism < 50
    assert spark.conf.get(pruned.DISCOVERY) == before
    assert read.count() == 50


def test_metadata_is_looked_up_in_its_shards_only(spark, tmp_path):
    fields = pruned.STORED_METADATA.split(", ")
    rows = spark.range(500).select(*(
        (F.col("id") if f.endswith("bigint") else F.concat(F.lit("PMC"), F.col("id"))).alias(f.split()[0]) for f in fields
    ))
    path = f"{tmp_path}/m"
    writers.write_metadata_shards(rows, path, shards=16, files_per_shard=2)
    wanted = ids(spark, "PMC3", "PMC3", "PMC450", "PMC9999", None, "450")
    found = pruned.lookup_metadata(spark, path, wanted, shards=16)
    assert sorted(r["pmcid"] for r in found.collect()) == ["PMC3", "PMC450"]
    assert found.columns == [f.split()[0] for f in fields]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    # Shards that are not asked for may hold anything: they are never opened.
    shards = {r["shard"] for r in pruned.assign_shards(wanted, 16).select("shard").collect()}
    for d in os.listdir(path):
        if d.startswith("shard=") and int(d[6:]) not in shards:
            for f in os.listdir(f"{path}/{d}"):
                if f.endswith(".gz"):
                    os.remove(f"{path}/{d}/.{f}.crc")
                    with open(f"{path}/{d}/{f}", "wb") as out:
                        out.write(b"\x1f\x8bbroken")
    assert pruned.lookup_metadata(spark, path, wanted, shards=16).count() == 2
    assert pruned.lookup_metadata(spark, path, ids(spark), shards=16).count() == 0
