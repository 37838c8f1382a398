import json
import random

import pytest
from pyspark.sql import functions as F

from mentionlake.functions import ids
from mentionlake.operators import articles, dictionary
from mentionlake.operators.ranking import below_nth, global_rank, top_n_per_key


def test_alias_list_rules(spark):
    rows = [
        (1, " A ", "A", "A full", 1), (2, "B", None, "", 1), (3, "C", "c2", "c2", 1),
        (4, "", "only common", None, 1), (5, " ", None, "\t", 1), (6, "F", "f", "F", 0),
    ]
    table = spark.createDataFrame(
        rows, "id int, short_name string, common_name string, full_name string, is_latest int"
    )
    extra = spark.createDataFrame([("A", ["A", "x"])], "short_name string, aliases array<string>")
    lists = dictionary.alias_lists(dictionary.latest_resources(table), extra)
    got = {r.resource_id: list(r.names) for r in lists.collect()}
    assert got == {1: ["A", "A full", "A", "x"], 2: ["B"], 3: ["C", "c2"], 4: ["only common"], 5: []}
    assert [r.resource_id for r in dictionary.nameless(lists).collect()] == [5]
    assert [r.id for r in dictionary.latest_resources(table, 2).collect()] == [1, 2]


def test_last_definition_wins(spark):
    rows = [(10, 0, "X", 0), (11, 1, "X", 2), (11, 1, "Y", 0), (12, 2, "Y", 1)]
    df = spark.createDataFrame(rows, "resource_id int, resource_pos int, alias string, alias_pos int")
    assert {r.alias: r.resource_id for r in dictionary.name_to_id(df).collect()} == {"X": 11, "Y": 12}


def test_phrase_search(spark):
    texts = spark.createDataFrame(
        [(1, "The Gene-Ontology, of course", True), (2, "gene ontologyx", True), (3, "gene ontology", False)],
        "doc_id int, text string, has_full_text boolean",
    )
    aliases = spark.createDataFrame(
        [(1, "Gene Ontology"), (1, "GO"), (2, "course"), (3, "!!"), (3, "")], "resource_id int, alias string"
    )
    for max_rows in (1000, 0):
        got = articles.candidate_articles(texts, aliases, max_rows).collect()
        assert {(r.resource_id, r.doc_id) for r in got} == {(1, 1), (2, 1)}


def test_listed_ids(spark):
    arts = spark.createDataFrame([("PMC1", True), ("PMC2", False)], "pmcid string, has_full_text boolean")
    named = ["PMC1", " PMC1 ", "PMC2", "", None] + [f"PMC9{i}" for i in range(150)]
    ids = spark.createDataFrame([(n,) for n in named], "pmcid string")
    got = articles.listed_articles(arts, ids).collect()
    assert [r.pmcid for r in got] == ["PMC1"]


@pytest.mark.parametrize(
    ("shards", "name", "shard", "file"),
    [
        (1, "PMC7919", 0, "metadata_shard_00.jsonl.gz"),
        (37, "PMC7919", 23, "metadata_shard_23.jsonl.gz"),
        (128, "PMC7919", 75, "metadata_shard_075.jsonl.gz"),
        (100, "PMC12", 45, "metadata_shard_45.jsonl.gz"),
        (2**31 - 1, "PMC12", 1013221135, "metadata_shard_1013221135.jsonl.gz"),
    ],
)
def test_md5_shard_of_known_ids(spark, shards, name, shard, file):
    row = articles.assign_shards(spark.createDataFrame([(name,)], "pmcid string"), shards).first()
    assert (row.shard, row.shard_file) == (shard, file)


def test_chunks_lose_no_id(spark):
    names = ["PMC1", "PMC2", "PMC02", "PMC-4", "PPR77", "PMC3.1", "PMC99999999999999999999"]
    ids = spark.createDataFrame([(n,) for n in names], "pmcid string")
    got = {r.pmcid: (r["rank"], r.chunk) for r in articles.assign_chunks(ids, 3).collect()}
    order = ["PMC-4", "PPR77", "PMC1", "PMC02", "PMC2", "PMC3.1", "PMC99999999999999999999"]
    assert got == {n: (i, min(i // 3, 2) + 1) for i, n in enumerate(order)}


@pytest.mark.parametrize("chunks", [0, 1, 3, 7, 40])
def test_chunks_leave_the_remainder_last(spark, chunks):
    rng = random.Random(chunks)
    numbers = sorted(rng.sample(range(10**12), 30)) + [10**12 + i for i in range(5)]
    df = spark.createDataFrame([(f"PMC{n}",) for n in numbers + numbers[:3]], "pmcid string")
    got = {r.pmcid: r.chunk for r in articles.assign_chunks(df, chunks).collect()}
    per = -(-len(numbers) // chunks) if chunks > 0 else len(numbers)
    for i, n in enumerate(numbers):
        assert got[f"PMC{n}"] == (min(i // per, chunks - 1) + 1 if chunks > 0 else 1)


def test_global_rank_over_levels(spark):
    keys = [0, 1, 65535, 65536, 2**32 - 1, 2**32, 2**40 + 3, 2**48, 2**62]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = {r.k: r["rank"] for r in global_rank(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(keys)}


@pytest.mark.parametrize("n", [0, 1, 17, 200, 500])
def test_below_nth_is_exact(spark, n):
    rows = [(i, (i * 2654435761) % 2**32 if i % 3 else 5) for i in range(200)]
    df = spark.createDataFrame(rows, "key int, h bigint")
    got = {r.key for r in df.where(below_nth(df, "h", "key", n, 64)).collect()}
    assert got == {k for k, _ in sorted(rows, key=lambda r: (r[1], r[0]))[:n]}


def test_top_n_beyond_the_built_in_trim(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    got = top_n_per_key(df, ["k"], [F.col("v")], 1200).groupBy("k").agg(
        F.count("*").alias("n"), F.max("v").alias("m")
    )
    assert {(r.k, r.n, r.m) for r in got.collect()} == {(0, 1200, 2398), (1, 1200, 2399)}


def test_hot_key_is_trimmed_before_the_shuffle(spark):
    key = F.concat(F.lit("PMC"), F.col("id") % 2)
    df = spark.range(1000).select(
        key.alias("pmcid"), F.col("id").alias("seen_at"), F.lit(0).alias("resource_pos")
    )
    plan = articles.first_seen(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_metadata_defaults_only_for_absent_keys(spark):
    records = [
        {"pmcid": "PMC1", "citedByCount": None, "authorList": {"a": 1}, "firstPublicationDate": "2020",
         "journalInfo": {"printPublicationDate": ""}},
        {"pmcid": "PMC2", "journalInfo": {"printPublicationDate": "2021"}, "firstPublicationDate": "2020"},
        {"pmcid": ""}, {"pmid": "9"}, {"pmcid": None},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "record string")
    got = {r.pmcid: r for r in articles.normalise_metadata(df).collect()}
    assert set(got) == {"PMC1", "PMC2"}
    assert got["PMC1"].citedByCount is None and got["PMC2"].citedByCount == 0
    assert json.loads(got["PMC1"].authorList) == {"a": 1} and got["PMC2"].authorList == "{}"
    assert got["PMC1"].firstPublicationDate == "2020" and got["PMC2"].firstPublicationDate == "2021"


def test_gate_lets_zero_citations_pass(spark):
    meta = spark.createDataFrame(
        [("P1", "t", '{"a":1}', 0), ("P2", "t", '{"a":1}', None), ("P3", "", '{"a":1}', 1), ("P4", "t", "{}", 1)],
        "pmcid string, title string, authorList string, citedByCount long",
    )
    wanted = spark.createDataFrame([(f"P{i}",) for i in range(1, 6)], "pmcid string")
    passed, rejects = articles.check_completeness(wanted, meta)
    assert [r.pmcid for r in passed.collect()] == ["P1"]
    assert {r.pmcid: r.reason for r in rejects.collect()} == {
        "P2": "no citation count", "P3": "no title", "P4": "no authors", "P5": "no metadata",
    }


def test_latest_metadata_unwraps_and_skips_bad_lines(spark):
    lines = [
        '{"id": "P1", "k": 1}', '{"id": "P1", "meta": {"k": 2}}', "not json",
        '{"id": "P2", "meta": {}, "k": 3}', '{"k": 4}',
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "n int, value string")
    got = {r.id: json.loads(r.record) for r in articles.latest_metadata(df, ["n"]).collect()}
    assert got["P1"] == {"k": 2} and got["P2"]["k"] == 3 and set(got) == {"P1", "P2"}


def test_bundles_first_range_or_last_listed(spark):
    rows = [("a", 1, 50, 0), ("b", 1, 20, 1), ("c", 40, 300, 2), ("d", 9, 3, 3)]
    bundles = spark.createDataFrame(rows, "bundle string, start_id long, end_id long, listing int")
    wanted = spark.createDataFrame([(f"P{n}", n) for n in (1, 30, 45, 250, 999)], "pmcid string, id_num long")
    got = articles.assign_bundles(wanted, bundles, width=16).collect()
    assert {r.id_num: r.bundle for r in got} == {1: "b", 30: "a", 45: "a", 250: "c"}
    last = articles.assign_bundles(wanted, bundles, width=16, last_listed=True).collect()
    assert {r.id_num: r.bundle for r in last} == {1: "b", 30: "a", 45: "c", 250: "c"}


def test_cascade_and_payloads(spark):
    def src(*rows):
        return spark.createDataFrame(list(rows), "pmcid string, xml string")

    wanted = spark.createDataFrame([("P1",), ("P2",), ("P3",)], "pmcid string")
    sources = [("local", src(("P1", "l"))), ("api", src(("P1", "x"), ("P2", "a"), ("P9", "z")))]
    picked, none = articles.cascade_sources(wanted, sources)
    got = articles.fetch_payloads(picked, sources).collect()
    assert {(r.pmcid, r.source, r.xml) for r in got} == {("P1", "local", "l"), ("P2", "api", "a")}
    assert [r.pmcid for r in none.collect()] == ["P3"]


def test_id_forms(spark):
    df = spark.createDataFrame([("PMC12",), ("12",), ("PMCx",)], "v string")
    c = F.col("v")
    got = df.select(ids.bare_id(c), ids.full_id(c), ids.id_number(c)).collect()
    assert [tuple(r) for r in got] == [("12", "PMC12", 12), ("12", "PMC12", 12), ("x", "PMCx", None)]
