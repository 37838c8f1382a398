"""The fact store over replayed and failed batches, and running specificity over restarts."""

import pytest
from pyspark.sql import functions as F

from mentionlake.operators import rollup
from mentionlake.operators.articles import METADATA_FIELDS
from mentionlake.sources import fact_store
from mentionlake.streaming import jobs

FACTS = (
    "pmcid string, title string, resource_id int, short_name string, matched_alias string, match_count bigint, "
    "mean_confidence double, version string, version_date string, version_user string"
)


def facts(spark, *ids, version="v1"):
    return spark.createDataFrame([(i, "t", 1, "R", "a", 2, 0.95, version, "d", "u") for i in ids], FACTS)


def publications(spark, *ids):
    rows = [tuple(1 if f == "citedByCount" else i if f == "pmcid" else f"{f} {i}" for f in METADATA_FIELDS) for i in ids]
    return spark.createDataFrame(rows, ", ".join(f"{f} {'bigint' if f == 'citedByCount' else 'string'}" for f in METADATA_FIELDS))


def stored(spark, path, schema=None):
    return fact_store.read_part(spark, f"{path}/facts", schema or facts(spark).schema)


def test_a_batch_is_committed_once(spark, tmp_path):
    path, all_articles = str(tmp_path), publications(spark, "P1", "P2", "P3", "P9")
    assert fact_store.commit_facts(facts(spark, "P1", "P2", "P2", None, None), path, "b0", all_articles, buckets=8)
    assert not fact_store.commit_facts(facts(spark, "P7"), path, "b0", all_articles, buckets=8)
    assert fact_store.commit_facts(facts(spark, "P2", "P3", None), path, "b1", all_articles, buckets=8)
    assert fact_store.commit_facts(facts(spark), path, "b2", all_articles, buckets=8)
    assert sorted(r["pmcid"] or "" for r in stored(spark, path).collect()) == ["", "P1", "P2", "P3"]
    assert {r["batch_id"] for r in fact_store.committed(spark, path).collect()} == {"b0", "b1", "b2"}
    kept = fact_store.read_part(spark, f"{path}/publications", all_articles.schema).drop("bucket").orderBy("pmcid").collect()
    assert [tuple(r) for r in kept] == [tuple(r) for r in all_articles.where("pmcid <> 'P9'").orderBy("pmcid").collect()]
    assert fact_store.commit_facts(facts(spark, "P1", version="v2"), path, "b3", buckets=8) and stored(spark, path).count() == 5


def test_a_batch_that_failed_between_its_writes_is_finished_by_its_replay(spark, tmp_path, monkeypatch):
    path, batch, done = str(tmp_path), facts(spark, "P1", "P2"), []
    append = fact_store._append

    def failing(rows, where):
        if where.endswith("/facts"):
            raise RuntimeError("lost")
        append(rows, where)
        done.append(where)

    monkeypatch.setattr(fact_store, "_append", failing)
    with pytest.raises(RuntimeError):
        fact_store.commit_facts(batch, path, "b0", publications(spark, "P1", "P2"), buckets=4)
    assert len(done) == 1 and fact_store.committed(spark, path).isEmpty()
    monkeypatch.setattr(fact_store, "_append", append)
    assert fact_store.commit_facts(batch, path, "b0", publications(spark, "P1", "P2"), buckets=4)
    assert stored(spark, path).count() == 2
    assert fact_store.read_part(spark, f"{path}/publications", publications(spark).schema).count() == 2


def test_only_the_partitions_of_a_batch_are_read(spark, tmp_path):
    path = str(tmp_path)
    fact_store.commit_facts(facts(spark, *(f"P{i}" for i in range(200))), path, "b0", buckets=16)
    rows = fact_store.unstored(facts(spark, "P5", "P500"), f"{path}/facts", list(rollup.FACT_KEY), buckets=16)
    assert [r["pmcid"] for r in rows.collect()] == ["P500"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket#" in plan.replace("PartitionFilters: [isnotnull(bucket", "PartitionFilters: [bucket#")
    used = {r["bucket"] for r in facts(spark, "P5", "P500").select(fact_store.md5_shard(F.col("pmcid"), 16).alias("bucket")).collect()}
    for d in tmp_path.glob("facts/bucket=*"):
        if int(d.name[7:]) not in used:
            for f in d.glob("*.parquet"):  # a file that is opened now fails the read
                f.write_bytes(b"broken")
                (f.parent / f".{f.name}.crc").unlink()
    rows = fact_store.unstored(facts(spark, "P5", "P500"), f"{path}/facts", list(rollup.FACT_KEY), buckets=16)
    assert rows.count() == 1


def test_the_fact_stream_adds_nothing_twice(spark, tmp_path):
    facts(spark, "P1", "P2", "P3", "P4").repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(facts(spark).schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    store = f"{tmp_path}/store"
    for name in ("first", "first", "again"):
        jobs.fact_store_stream(stream, store, f"{tmp_path}/state-{name}", buckets=4, name=name).awaitTermination()
    assert sorted(r["pmcid"] for r in stored(spark, store).collect()) == ["P1", "P2", "P3", "P4"]


def test_running_specificity_survives_a_restart(spark, tmp_path):
    schema = "resource_name string, alias string, prediction int"
    first = [("R", "a", 1), ("R", "a", 0), ("R", "b", 0), (None, "c", 1)]
    second = [("R", "a", 1), ("S", "d", 1)]
    for rows in (first, second):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        jobs.specificity_stream(stream, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = {tuple(r) for r in jobs.streamed_specificity(spark, f"{tmp_path}/out").collect()}
    whole = spark.createDataFrame(first + second, schema)
    assert got == {tuple(r) for r in rollup.specificity(rollup.prediction_counts(whole)).collect()}
    # The second run wrote what it changed only.
    later = spark.read.parquet(f"{tmp_path}/out").where("batch > 0").select("alias").collect()
    assert {r["alias"] for r in later} == {"a", "d"}
