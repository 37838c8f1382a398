import hashlib
import random

import pytest
from pyspark.sql import functions as F

from mentionlake.operators import training

SCHEMA = (
    "resource_name string, alias string, label int, article_topic_match boolean, doc_id long, "
    "block_no int, paragraph_text string"
)


def greedy(rows, pos_quota, neg_quota, per_article, skip_after, seed):
    """The sampling as a plain loop over articles and blocks."""
    out = set()
    for alias in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == alias]
        order = sorted(
            {r[4] for r in mine},
            key=lambda d: (hashlib.md5(f"{seed}|{alias}|{d}".encode()).hexdigest(), d),
        )
        counts, quota, taken, dropped = {0: 0, 1: 0}, {0: neg_quota, 1: pos_quota}, [], False
        limit = min(skip_after, len(order))
        for fetched, doc in enumerate(order, 1):
            used = 0
            for r in sorted((r for r in mine if r[4] == doc), key=lambda r: r[5]):
                if counts[r[2]] >= quota[r[2]]:
                    continue
                counts[r[2]] += 1
                taken.append((alias, doc, r[5]))
                used += 1
                if used >= per_article:
                    break
            if fetched >= limit and 0 in counts.values():
                dropped = True
                break
            if counts == quota:
                break
        if not dropped:
            out |= set(taken)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_quota_sample_equals_plain_greedy(spark, seed):
    rng = random.Random(seed)
    rows = []
    for a in range(6):
        share = rng.choice([0.02, 0.3, 0.5, 0.9, 1.0])
        for doc in range(rng.randint(1, 70)):
            for b in range(rng.randint(0, 9)):
                label = int(rng.random() < share)
                rows.append(("R", f"a{a}", label, True, doc, b, f"t{doc}-{b}"))
    args = rng.choice([(20, 20, 5, 200), (4, 6, 2, 10), (3, 3, 1, 5), (20, 20, 5, 8)])
    df = spark.createDataFrame(rows, SCHEMA)
    got = training.quota_sample(df, *args, seed=seed).collect()
    assert {(r.alias, r.doc_id, r.block_no) for r in got} == greedy(rows, *args, seed)
    assert len(got) == len({(r.alias, r.doc_id, r.block_no) for r in got})
    assert all(r.paragraph_text == f"t{r.doc_id}-{r.block_no}" for r in got)


def test_eligibility_and_labels(spark):
    defs = spark.createDataFrame(
        [(["Rat"], ["rodent"], None), (["Cat"], ["pet"], 0), (["Dog"], [], 1), (["Eel"], None, None)],
        "names array<string>, topics array<string>, ambiguous int",
    )
    texts = spark.createDataFrame(
        [(1, "A rat and rodents. Rats only. Rodentia rat. None here."), (2, "brat pack"), (3, "a rat. rodent")],
        "doc_id int, text string",
    ).withColumn("has_full_text", F.lit(True))
    got = training.label_blocks(texts, defs).collect()
    assert {(r.doc_id, r.block_no, r.label, r.article_topic_match) for r in got} == {
        (1, 0, 1, True), (1, 1, 0, True), (1, 2, 0, True), (3, 0, 0, True),
    }


def test_token_windows(spark):
    df = spark.createDataFrame(
        [(1, " ".join(map(str, range(n)))) for n in (0, 3, 10, 11, 17, 18, 31)], "label int, text string"
    )
    for r in training.token_windows(df, length=10, overlap=3).collect():
        assert r.n_tokens + r.padding == 10 and (r.window_no == 0 or r.n_tokens > 3)
    rows = training.token_windows(df.where(F.length("text") > 40), length=10, overlap=3)
    windows = [list(map(int, r.window)) for r in rows.orderBy("window_no").collect() if len(r.window) and r.window[0].isdigit()]
    assert list(range(7, 17)) in windows and [28, 29, 30] not in windows


def test_first_n_and_hash_split(spark):
    df = spark.range(1000).select(F.col("id").alias("k"))
    for n in (0, 1, 640, 5000):
        split = training.split_first_n(df, "k", n)
        assert split.where("split = 'train'").count() == min(n, 1000)
    share = training.split_by_hash(df, "k").where("split = 'train'").count()
    assert 750 < share < 850


def test_label_order_compares_text(spark):
    rows = [(1, True, "PMC2"), (1, False, "PMC2"), (0, True, "PMC10"), (0, True, "PMC9")]
    df = spark.createDataFrame(rows, "label int, article_topic_match boolean, pmcid string")
    df = df.withColumn("resource_name", F.lit("r")).withColumn("alias", F.lit("a"))
    got = [(r.label, r.article_topic_match, r.pmcid) for r in training.order_by_label(df).collect()]
    assert got == [(0, True, "PMC10"), (0, True, "PMC9"), (1, False, "PMC2"), (1, True, "PMC2")]


def test_model_input_is_null_safe(spark):
    df = spark.createDataFrame([(" a\nb ", "X"), (None, None)], "paragraph_text string, alias string")
    got = [r.input_text for r in training.with_model_input(df).collect()]
    assert got == ["X [SEP] a b", " [SEP] "]
