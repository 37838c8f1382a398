"""Repeated ids with different texts, rows without ids, clashing columns, hostile payloads."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from mentionlake.llm import decontaminate, hashing, mixing, near_dups, substrings, token_files, warc
from mentionlake.llm.queries import tokenizer

RNG = random.Random(11)
WORDS = ["".join(RNG.choices("abcdefgh", k=RNG.randint(2, 7))) for _ in range(2000)]


def prose(n, seed):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def test_substrings_judges_each_text_of_a_repeated_id(spark):
    shared, a, b = prose(40, 1), prose(50, 2), prose(50, 3)
    long, short = prose(200, 4) + " " + shared, prose(5, 5) + " " + shared
    got = substrings.without_repeats(docs_of(spark, [(1, long), (2, shared), (1, short)])).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in got) in (
        [(1, 45, 0), (1, 240, 40), (2, 40, 40)], [(1, 45, 40), (1, 240, 0), (2, 40, 40)],
    )
    got = substrings.without_repeats(docs_of(spark, [(1, a), (2, a), (2, b), (2, b)])).collect()
    assert sorted((r["doc_id"], r["n_removed"], r["kept_text"]) for r in got) == [(1, 0, a), (2, 0, b), (2, 0, b), (2, 50, "")]


def test_mixing_takes_columns_of_any_name(spark):
    rows = [(i, prose(10, i), "ab"[i % 2], 1, 2, 3) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, mix_s int, mix_source int, mix int")
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs).count() > 0
    none = docs.withColumn("doc_id", docs["mix"].cast("bigint") * None)
    assert mixing.mix(none).count() > 0


def test_leaks_of_rows_without_id_and_of_short_items_go(spark):
    item, other = prose(30, 6), prose(30, 7)
    items = spark.createDataFrame([(1, item), (2, "One two, THREE four"), (3, ""), (4, None), (None, other)], "item_id bigint, text string")
    rows = [
        (None, item), (None, prose(30, 8)), (None, None), (5, prose(9, 9) + " one two three FOUR " + prose(9, 10)), (6, "one two three"),
        (7, prose(40, 11) + " " + item), (7, prose(40, 12)), (8, other),
    ]
    docs = docs_of(spark, rows)
    found = sorted(((r["doc_id"], r["item_id"], r["containment"]) for r in decontaminate.leaks(docs, items).collect()), key=str)
    assert found == sorted([(None, 1, 1.0), (5, 2, 1.0), (7, 1, 1.0)], key=str)
    kept = [tuple(r) for r in decontaminate.drop_leaks(docs, items).collect()]
    assert sorted(kept, key=str) == sorted([rows[1], rows[2], rows[4], rows[6], rows[7]], key=str)
    clash = docs.withColumn("leak_id", docs["doc_id"]).withColumn("leak_row", docs["doc_id"])
    assert decontaminate.drop_leaks(clash, items).columns == clash.columns


@pytest.mark.parametrize("first", range(0, 0x10000, 0x4000))
def test_token_ids_are_the_tokenizers_for_every_code_point(first):
    encode = token_files.WordEncoder(tokenizer())
    assert encode.by_word
    points = [chr(c) for c in range(first, first + 0x4000) if not 0xD800 <= c < 0xE000]
    points += [chr(c) for c in range(0x10000 + first, 0x110000, 0x10FF)]
    texts = [f"ab{c}cd x{c},.y {c}' {c} a {c}́ <|endoftext|>" for c in points]
    want = [e.ids for e in encode.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert [i.tolist() for i in encode(pa.array(texts))] == want


def test_only_the_described_pipeline_is_taken_apart():
    import public_tokenizers

    assert not token_files.splits_at_spaces(public_tokenizers.path("byte_bpe_50k.json"))
    encode = token_files.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["two  words\n", None, "é"]
    assert [i.tolist() for i in encode(pa.array(texts))] == [encode.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_parity_bitmaps_never_differ_by_more_than_the_texts():
    r = np.random.default_rng(1)
    with np.errstate(over="ignore"):
        for _ in range(200):
            base = r.integers(0, 2**63, size=r.integers(1, 400), dtype=np.uint64)
            cut = base[r.random(len(base)) < r.random()]
            more = np.concatenate([cut, cut[: len(cut) // 3], r.integers(0, 2**63, size=r.integers(0, 50), dtype=np.uint64)])
            apart = len(np.setxor1d(near_dups.labelled(base), near_dups.labelled(more)))
            a, b = near_dups.parity(base), near_dups.parity(more)
            assert sum(int(x).bit_count() for x in (a ^ b).view(np.uint64)) <= apart


def test_near_copies_that_only_their_original_joins_are_one_class(spark):
    base = prose(120, 20).split()

    def copy(seed):
        r, words = random.Random(seed), list(base)
        for at in r.sample(range(0, 120, 12), 2):
            words[at] = f"new{seed}"
        return " ".join(words)

    rows = [(0, " ".join(base)), *((i, copy(i)) for i in range(1, 60)), (99, prose(120, 21))]
    got = {r["doc_id"]: r["class_id"] for r in near_dups.near_classes(docs_of(spark, rows)).collect()}
    linked = [i for i in range(1, 60) if near_dups.aligned_similarity(rows[0][1], rows[i][1]) >= 0.8]
    assert linked and all(got[i] == 0 for i in linked) and got[99] == 99


def test_false_record_heads_cost_no_more_than_their_bytes(spark, tmp_path):
    hostile = warc.MAGIC.decode() * 50_000
    rows = [(1, "u", hostile), (2, "u", "x" + hostile), (3, "u", "plain"), (4, "u", "plain")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    began = time.time()
    manifest = warc.write_archives(pages.coalesce(1), f"{tmp_path}/w")
    got = {r["page_id"]: r for r in warc.read_archives(manifest, 1 << 20).collect()}
    assert time.time() - began < 30
    assert {i: r["record_type"] for i, r in got.items()} == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert bytes(got[1]["payload"]).decode() == hostile and got[3]["payload_bytes"] == 5 and got[3]["refers_to"] == 4


def test_written_files_are_read_back_by_several_tasks(spark, tmp_path):
    docs = docs_of(spark, [(i, prose(50, i)) for i in range(200)])
    manifest = token_files.write_tokens(docs.repartition(6), tokenizer(), f"{tmp_path}/t")
    assert token_files.read_tokens(manifest).rdd.getNumPartitions() >= 4
    pages = docs.selectExpr("doc_id AS page_id", "'u' AS url", "text AS html").repartition(6)
    assert warc.read_archives(warc.write_archives(pages, f"{tmp_path}/p")).rdd.getNumPartitions() >= 4


def test_words_of_a_row_end_with_it():
    words, offsets = hashing.word_hashes(pa.array(["ab", "ab", None, " ab"]))
    assert len(set(words.tolist())) == 1 and offsets.tolist() == [0, 1, 2, 2, 3]
