"""The phrase index next to a plain search of the texts."""

import os
import random

from mentionlake.operators import phrase_index


def plain(texts, aliases):
    import re

    split = lambda s: re.findall(r"[^\W_]+", s.lower())
    out = set()
    for doc, text in {t for t in texts if None not in t}:
        words = split(text)
        for alias in {a for a in aliases if a and split(a)}:
            p = split(alias)
            at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
            if at:
                out.add((alias, doc, len(at), at[0]))
    return out


def test_the_index_equals_a_plain_search(spark, tmp_path):
    r = random.Random(4)
    words = ["the"] * 6 + ["a", "b", "c", "data", "Set", "x9"]
    texts = [(i, " ".join(r.choices(words, k=r.randrange(1, 60)))) for i in range(120)]
    texts += [(3, "the data set again, a second text of one id"), texts[7], (None, "the data"), (500, None), (501, ""), (502, " -- "), (503, "the The THE the")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    phrase_index.build_index(df, f"{tmp_path}/i", buckets=4)
    aliases = ["the", "The the", "the the the", "data set", "a b a", "Data-SET", "zebra", "data zebra", "", " ", None, "x9 the a"]
    names = spark.createDataFrame([(a, k) for k, a in enumerate(aliases)], "alias string, tag int")
    rows = phrase_index.search_index(spark, f"{tmp_path}/i", names, buckets=4)
    got = {(x["alias"], x["doc_id"], x["n_hits"], x["first_place"]) for x in rows.collect()}
    assert got == plain(texts, aliases) and rows.columns == ["alias", "tag", "doc_id", "n_hits", "first_place"]


def test_only_the_buckets_asked_for_are_read(spark, tmp_path):
    df = spark.createDataFrame([(i, f"w{i} common v{i}") for i in range(200)], "doc_id bigint, text string")
    phrase_index.build_index(df, f"{tmp_path}/i", buckets=32)
    bucket = df.limit(1).select(phrase_index._bucket(phrase_index.F.lit("w7"), 32)).first()[0]
    for folder in os.listdir(f"{tmp_path}/i/postings"):  # a bucket that is opened all the same fails the read
        if folder.startswith("bucket=") and folder != f"bucket={bucket}":
            for name in os.listdir(f"{tmp_path}/i/postings/{folder}"):
                if name.endswith(".parquet"):
                    with open(f"{tmp_path}/i/postings/{folder}/{name}", "wb") as out:
                        out.write(b"broken")
    rows = phrase_index.search_index(spark, f"{tmp_path}/i", spark.createDataFrame([("W7",), ("absent",)], "alias string"), buckets=32)
    # "absent" may fall into the same or another bucket; ask for the one word only if it does not.
    if df.limit(1).select(phrase_index._bucket(phrase_index.F.lit("absent"), 32)).first()[0] != bucket:
        rows = phrase_index.search_index(spark, f"{tmp_path}/i", spark.createDataFrame([("W7",)], "alias string"), buckets=32)
    assert [tuple(x) for x in rows.collect()] == [("W7", 7, 1, 0)]
    assert "dynamicpruning" in rows._jdf.queryExecution().toString()


def test_an_empty_corpus_and_no_alias(spark, tmp_path):
    phrase_index.build_index(spark.createDataFrame([], "doc_id bigint, text string"), f"{tmp_path}/e", buckets=2)
    some = spark.createDataFrame([("the",)], "alias string")
    assert phrase_index.search_index(spark, f"{tmp_path}/e", some, buckets=2).isEmpty()


def test_places_are_gathered_before_the_shuffle():
    import pyarrow as pa

    words = [["a", "b", "a"], [], ["b", "", "b", "c"], ["a"]] * 200
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(800)), "copy": [7] * 800, "words": words}).slice(1)
    got = [tuple(r.values()) for out in phrase_index._gathered(iter([batch])) for r in out.to_pylist()]
    want = [(w, i, 7, [k for k, x in enumerate(words[i]) if x == w]) for i in range(1, 800) for w in set(words[i])]
    assert sorted(got) == sorted(want)
    assert list(phrase_index._gathered(iter([batch.slice(0, 0)]))) == []
    assert [r.num_rows for r in phrase_index._gathered(iter([batch.slice(0, 1)]))] == [0]
