"""Whitening, token counts and resampling against brute force, and on odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from mentionlake.llm import resampling, token_counts, whitening
from mentionlake.llm.ngram_table import Grams, xxhash64
from mentionlake.llm.queries import tokenizer
from mentionlake.llm.whitening import eigenpairs

# whitening


def integers(vectors):
    return np.floor(64 * np.array(vectors, dtype=float)) + 1_000_000


def checked(rows, vectors, components):
    """Every row of the result next to numpy's eigenvectors of the same covariance."""
    x = integers(list(vectors.values()))
    n = len(x)
    apart = x - x.mean(axis=0)
    v = apart.T @ apart / n
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    ids = list(vectors)
    want = apart @ basis[:, :components] / np.sqrt(values[:components])
    got = np.zeros((n, components))
    for r in rows:
        i, j = ids.index(r["vec_id"]), r["component"] - 1
        got[i, j] = r["whitened"]
        assert r["n"] == n and r["identity_error"] <= 1e-9
        assert abs(r["explained"] - values[j] / values.sum()) <= 1e-9
        s = [int(t) for t in x.sum(axis=0)]
        assert int(r["deviation"]) == sum((n * int(a) - b) ** 2 for a, b in zip(x[i], s, strict=True))
    assert len(rows) == n * components
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got * sign - want).max() < 1e-6


def test_whitening_equals_a_dense_solution(spark):
    random_rows = np.random.default_rng(3).standard_normal((300, 40)) * np.linspace(3, 0.2, 40)
    vectors = {i: v.tolist() for i, v in enumerate(random_rows)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>").repartition(5)
    checked(whitening.whitened(df, components=8).collect(), vectors, 8)


def test_whitening_of_odd_rows(spark):
    random_rows = np.random.default_rng(4).standard_normal((30, 4)) * [4, 3, 2, 1]
    good = {i: v.tolist() for i, v in enumerate(random_rows)}
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0, None, 1.0, 1.0], [nan, 1.0, 1.0, 1.0], [inf, 0.0, 0.0, 0.0], [1e300, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(*r, 1, "x") for r in good.items()] + [(100 + k, v, 2, None) for k, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, component int, data string").repartition(3)
    checked(whitening.whitened(df).collect(), good, 4)
    assert whitening.whitened(df.limit(0)).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id bigint, embedding array<float>")
    assert whitening.whitened(same).collect() == []


def test_whitening_keeps_repeated_rows_wide_entries_and_finds_the_rank(spark):
    rows = [(None, [1.0, 1e7, 0.0]), (1, [2.0, 3.0, 0.0]), (1, [2.0, 3.0, 0.0]), (2, [-5.0, 1e12, 0.0])]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert Counter((r["vec_id"], r["component"]) for r in got)[(1, 1)] == 2 and len(got) in (4, 8)
    x = integers([v for _, v in rows])
    s = [sum(int(a) for a in c) for c in x.T]
    want = {sum((4 * int(a) - b) ** 2 for a, b in zip(r, s, strict=True)) for r in x}
    assert {int(r["deviation"]) for r in got} == want


@pytest.mark.parametrize(
    "values",
    [
        np.concatenate([[400, 130], np.linspace(69, 48, 62)]), 0.9 ** np.arange(120), np.linspace(1, 0.9, 150),
        np.concatenate([[1e6], np.linspace(2, 1, 99)]), np.concatenate([np.linspace(3, 1, 6), np.zeros(50)]),
    ],
)
def test_filtered_iteration_finds_the_leading_pairs(values):
    r = np.random.default_rng(5)
    q, _ = np.linalg.qr(r.standard_normal((len(values), len(values))))
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    passes = []
    found, vectors, worst = eigenpairs(lambda b: passes.append(b.shape[1]) or v @ b, len(values), 20)
    assert worst <= 1e-12 and max(passes) <= 20 + 16 * 4 + 1
    assert np.allclose(found, np.sort(values)[::-1][:20], atol=1e-12 * values[0])
    assert np.abs(vectors.T @ vectors - np.eye(20)).max() < 1e-12


# token counts

TEXTS = [
    None, "", "  \n", "one two  three", "one\ttwo \n three", "<|endoftext|> x", "<|ENDOFTEXT|>", "don't  STOP 1234 ß́ 日本", "a" * 5000,
    "x " * 30_000, "   z", "é ́",
]


def plain_counts(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer())
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


def test_token_counts_equal_the_library(spark, tmp_path):
    rows = [(k if k % 5 else None, t, -k) for k, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int").repartition(4)
    want = Counter((i, len((t or "").encode()), n) for (i, t, _), n in zip(rows, plain_counts(TEXTS) * 3, strict=True))
    got = token_counts.token_counts(docs, tokenizer(), str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)
    assert token_counts.token_counts(docs.limit(0), tokenizer(), str(tmp_path)).collect() == []


def test_only_distinct_misses_are_encoded_and_appended(spark, tmp_path):
    cache = str(tmp_path)
    version = token_counts.tokenizer_digest(tokenizer())
    docs = lambda texts: spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    token_counts.token_counts(docs(["a b", "a  b", "a\nb", "c"]), tokenizer(), cache).collect()
    stored = token_counts.stored_counts(spark, cache, version)
    assert stored.count() == 2
    # A stored count is believed: what the cache has is not encoded again.
    spark.createDataFrame([(hashlib.sha256(b"kept").digest(), 77)], stored.schema).write.mode("append").parquet(f"{cache}/tokenizer={version}")
    got = token_counts.token_counts(docs(["kept", "a b", "new"]), tokenizer(), cache).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in got] == [77, *plain_counts(["a b", "new"])]
    assert token_counts.stored_counts(spark, cache, version).count() == 4
    assert token_counts.stored_counts(spark, cache, "another").count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \t\n\r\x0b\x1cab'<|>endoftext́é.,1")), max_size=40))
def test_the_normal_form_keeps_the_count(text):
    assert token_counts.joins_spaces(tokenizer())
    assert plain_counts([text]) == plain_counts([re.sub("[ \t\n\r]+", " ", text)])


def test_words_of_a_batch_are_encoded_once():
    count = token_counts.counter(tokenizer())
    texts = ["the cat, the CAT", None, "", "  cat the. <|endoftext|> İI'll"] * 50 + TEXTS
    assert count(pa.array(texts, pa.string())) == plain_counts(texts)
    count = token_counts.counter(tokenizer())
    assert count(pa.array(["the cat, the CAT"] * 50)) == plain_counts(["the cat, the CAT"]) * 50
    assert sorted(count.__self__.known) == [b",", b"cat", b"the"]


def test_sentencepiece_files_count_too(spark, tmp_path):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["Hello  world", None, "<s> x </s>", "日本 語"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = token_counts.token_counts(docs, path, str(tmp_path)).orderBy("doc_id").collect()
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert [r["n_tokens"] for r in got] == [len(model.encode(t or "")) for t in texts]


# resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain_resampling(rows, target, buckets, longest, min_words, percent):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    source, wanted = Counter(), Counter()
    for _, t in rows:
        source.update(map(bucket, features(t, longest)[1]))
    for t in target:
        wanted.update(map(bucket, features(t, longest)[1]))
    s_all, t_all = source.total() + buckets, wanted.total() + buckets
    out = []
    for i, t in rows:
        words, grams = features(t, longest)
        weight = sum(math.floor(1000 * math.log((wanted[bucket(g)] + 1) * s_all / ((source[bucket(g)] + 1) * t_all))) for g in grams)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(words), len(grams), weight, score, None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[5] = rank
    return Counter(map(tuple, out))


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_resampling_equals_a_plain_computation(spark, longest):
    r = random.Random(longest)
    vocabulary = ["alpha", "Beta", "x9", "ÉÄ", "日本", "w" * 40, "don't", "a-b", *(f"w{i}" for i in range(60))]
    text = lambda n: r.choice([" ", ", ", "\n"]).join(r.choices(vocabulary, k=n))
    rows = [(i, text(r.randint(0, 60))) for i in range(120)] + [(None, None), (None, text(30)), (7, text(30)), (500, ""), (501, "é" * 3000)]
    target = [text(25) for _ in range(10)] + [None, "alpha alpha beta"]
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id bigint, text string, rank string, score int").repartition(4)
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resampled(docs, aims, buckets=97, longest=longest, min_words=5, percent=30)
    assert Counter(map(tuple, got.collect())) == plain_resampling(rows, target, 97, longest, 5, 30)
    drawn = resampling.draw(docs, aims, buckets=97, longest=longest, min_words=5, percent=30)
    assert drawn.columns == [*docs.columns, "draw_rank"]
    assert sorted(x["draw_rank"] for x in drawn.collect()) == list(range(1, drawn.count() + 1))
    assert resampling.resampled(docs.limit(0), aims).collect() == []
    assert resampling.resampled(docs, aims.limit(0)).where("rank is not null").count() == len([t for _, t in rows if len(features(t, 1)[0]) >= 20]) // 10


def test_rows_that_repeat_an_id_and_a_text_are_ranked_one_by_one(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 50, "doc_id bigint, text string").repartition(5)
    got = resampling.resampled(docs, docs.select("text"), min_words=1, percent=20).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 11))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=70), min_size=1, max_size=30))
def test_hashes_are_those_of_the_library(parts):
    sizes = np.array([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts) + bytes(8), dtype=np.uint8)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    assert xxhash64(data, starts, sizes).tolist() == [xxhash.xxh64_intdigest(p) for p in parts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aAbé -\n", max_size=60), max_size=8), st.integers(1, 3))
def test_the_table_counts_every_gram_once_per_occurrence(texts, longest):
    grams = Grams(pa.array(texts, pa.string()), 1000, longest)
    counts = Counter(f for t in texts for f in features(t, longest)[1])
    assert len(grams.used) == len(counts) and sorted(grams.count[grams.used]) == sorted(counts.values())
    assert np.diff(grams.rows).tolist() == [len(features(t, longest)[1]) for t in texts]


def test_colliding_hashes_do_not_join_different_words(monkeypatch):
    from mentionlake.llm import ngram_table

    monkeypatch.setattr(ngram_table, "xxhash64", lambda data, starts, sizes: np.zeros(len(starts), np.uint64))
    words = [f"w{i}" for i in range(50)] + ["v" * 40, "u" * 40, "v" * 41]
    grams = Grams(pa.array([" ".join(words * 3)]), 1000)
    assert len(grams.used) == 53 and set(grams.count[grams.used]) == {3}
