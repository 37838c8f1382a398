"""Streams over several files end where the batch jobs do."""

from pyspark.sql import functions as F

from mentionlake.operators import detect, rollup
from mentionlake.plans import inputs
from mentionlake.streaming import jobs

SF = "/root/testdata/sf0.001"


def files(spark, df, path, n=3):
    df.repartition(n).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_first_seen_over_batches(spark, tmp_path):
    events = inputs.table(spark, SF, "events").select(
        F.concat(F.lit("PMC"), "user_id").alias("pmcid"), F.col("ts").cast("timestamp").alias("seen_at"), "event_id"
    )
    stream = files(spark, events, str(tmp_path / "in"))
    jobs.write_stream(jobs.first_seen_stream(stream), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = [r.pmcid for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    want = {r.pmcid for r in events.select("pmcid").distinct().collect()}
    assert len(got) == len(set(got)) and set(got) == want


def test_mentions_and_counts_over_batches(spark, tmp_path):
    texts = inputs.texts(spark, SF)
    aliases = inputs.aliases(spark)
    stream = files(spark, texts, str(tmp_path / "in"))
    args = (aliases, inputs.CASE_SENSITIVE)
    jobs.mentions_stream(stream, *args, str(tmp_path / "m"), str(tmp_path / "cpm")).awaitTermination()
    cols = ["doc_id", "sentence", "alias", "resource_name"]
    got = spark.read.parquet(str(tmp_path / "m")).select(*cols)
    want = detect.find_in_texts(texts, *args).select(*cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

    weights = inputs.weights(spark, SF)
    jobs.counts_stream(stream, *args, weights, str(tmp_path / "c"), str(tmp_path / "cpc")).awaitTermination()
    merged = jobs.current_counts(spark, str(tmp_path / "c"))
    batch = rollup.prediction_counts(inputs.scored(spark, SF))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, batch.collect()))


def test_running_counts_and_facts(spark, tmp_path):
    schema = "resource_name string, alias string, prediction int"
    rows = spark.createDataFrame([("R", "a", 1), ("R", "a", 1), ("R", "a", 0)], schema)
    out = str(tmp_path / "out")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(out)

    q = (
        jobs.running_counts(files(spark, rows, str(tmp_path / "in")))
        .writeStream.outputMode("complete").foreachBatch(keep)
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    assert {(r.prediction, r.n) for r in spark.read.parquet(out).collect()} == {(1, 2), (0, 1)}

    facts = spark.createDataFrame(
        [("P1", "t", 1, "a", "v"), ("P1", "t", 1, "a", "v"), ("P2", "t", 1, "a", "v")],
        "pmcid string, title string, resource_id int, matched_alias string, version string",
    )
    stream = files(spark, facts, str(tmp_path / "fin"), 2)
    jobs.facts_stream(stream, str(tmp_path / "facts"), str(tmp_path / "cpf")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "facts")).count() == 2
