"""Operators against brute force, and their results on odd inputs."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mentionlake.llm import (
    decontaminate, licenses, mixing, near_dups, pfor, quality, substrings, surrogates, token_files, toxicity, warc,
)
from mentionlake.llm.queries import tokenizer

SPACES = b" \t\n\x0b\x0c\r"
RNG = random.Random(5)
WORDS = ["".join(RNG.choices("abcdefgh", k=RNG.randint(2, 7))) for _ in range(3000)]


def prose(n, seed):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else r.choice(WORDS) for w in text.split())


LONG = prose(20_000, 1)
ODD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one"), (5, prose(300, 2)), (6, edited(prose(300, 2), 0.01, 3)),
    (7, LONG), (8, LONG + " end"), (None, prose(40, 4)), (None, None), (9, "é ü ß 　x" * 30), (10, prose(60, 5)), (10, prose(60, 5)),
    (11, "a " * 100), (12, "x\n" * 50 + "!!! ### $$$"),
]


@pytest.fixture(scope="module")
def odd(spark):
    schema = "doc_id bigint, text string, source string, rank int, mix string, quality_measures int, class_id int, scan string"
    rows = [(i, t, ("s", None, "")[k % 3], k, "m", k, k, "s") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def empty(spark, odd):
    return spark.createDataFrame([], odd.schema)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


# quality rules


def measures(text):
    w = split(text)
    lines = [x for x in (text or "").split("\n") if x.encode().strip(SPACES)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    cover = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 8)} if len(w) < 1000 else set()
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover))


def test_quality_measures_equal_a_plain_count(spark, odd):
    extra = [(50 + k, t) for k, t in enumerate([prose(30, 9) + " " + prose(30, 9), "a b c d e f g h " * 3, "#a\n#a\n\n \n#a"])]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string"))
    rows = quality.measured(docs, "m").select("text", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words").collect()
    assert len(rows) == len(ODD) + 3
    for r in rows:
        assert tuple(r)[1:] == measures(r["text"]), r["text"] and r["text"][:50]


def test_quality_rules_learn_thresholds_and_keep_the_rest(spark, odd, empty):
    rows = [(i, (prose(60, i) if i % 3 else " ".join(f"{w}###" for w in prose(60, i).split()))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = labels(spark, [(i, int(i % 3 != 0), 0) for i in range(600)])
    rules = quality.learn(docs, known)
    assert rules and all(len(r) <= quality.MAX_TESTS for r in rules)
    kept = {r["doc_id"] for r in quality.keep_good(docs, known).collect()}
    assert kept == {i for i in range(600) if i % 3}
    assert quality.learn(docs, labels(spark)) == []
    out = quality.judged(odd, labels(spark, [(5, 1, 0), (None, 0, 0), (6, None, 0)]))
    assert out.count() == len(ODD) and "_quality_measures" in out.columns
    assert quality.keep_good(odd, labels(spark)).columns == odd.columns
    assert quality.keep_good(empty, labels(spark)).count() == 0


# near duplicates


def plain_similarity(a, b):
    x, y = ([tuple(w[i : i + min(5, len(w))]) for i in range(max(1, len(w) - 4))] if w else [] for w in (split(a), split(b)))
    if not x or not y:
        return 0.0
    row = [0] * (len(y) + 1)
    for s in x:
        above = row[:]
        for j, t in enumerate(y, 1):
            row[j] = above[j - 1] + 1 if s == t else max(above[j], row[j - 1])
    return row[-1] / (len(x) + len(y) - row[-1])


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 80), st.floats(0, 0.3), st.integers(0, 10**6), st.integers(0, 12))
def test_banded_alignment_is_exact_from_the_bound_on(n, share, seed, cut):
    a = prose(n, seed)
    b = " ".join(edited(a, share, seed + 1).split()[cut:])
    true, got = plain_similarity(a, b), near_dups.aligned_similarity(a, b)
    assert (got >= 0.8) == (true >= 0.8 - 1e-12)
    if true >= 0.8:
        assert got == pytest.approx(true)


def test_near_classes_equal_all_pairs(spark):
    texts, n = {}, 0
    for group in range(12):
        base = prose(RNG.randint(9, 200), 100 + group)
        for k in range(RNG.randint(1, 6)):
            texts[n] = edited(base, RNG.choice([0, 0.004, 0.01, 0.3]), 1000 + n)
            n += 1
    shared = prose(40, 77)
    for k in range(15):
        texts[n] = f"{prose(60, 500 + k)} {shared} {prose(20, 600 + k)}"
        n += 1
    root = {i: i for i in texts}
    for a, b in itertools.combinations(texts, 2):
        if plain_similarity(texts[a], texts[b]) >= 0.8:
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {k: new if v == old else v for k, v in root.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dups.near_classes(docs).collect()}
    assert got == root


def test_near_classes_of_a_star(spark):
    base, rows = prose(300, 900).split(), []
    for k in range(200):
        r, words = random.Random(7000 + k), list(base)
        for at in r.sample(range(10, 290, 6), 5):
            words[at] = f"new{k}x{at}"
        rows.append((k + 1, " ".join(words)))
    close = [plain_similarity(a[1], b[1]) for a, b in itertools.combinations(rows[:20], 2)]
    assert sum(x < 0.8 for x in close) > 0.9 * len(close)
    docs = spark.createDataFrame([(0, " ".join(base)), *rows], "doc_id bigint, text string")
    assert {r["class_id"] for r in near_dups.near_classes(docs).collect()} == {0}


def test_near_classes_beside_a_shared_passage(spark):
    shared, rows = prose(11, 910), []
    for k in range(400):
        rows += [(2 * k, f"{shared} pair{k} left{k}"), (2 * k + 1, f"{shared} pair{k} right{k}")]
    assert plain_similarity(rows[0][1], rows[1][1]) == 0.8 and plain_similarity(rows[0][1], rows[2][1]) < 0.8
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dups.near_classes(docs).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_near_dups_odd_rows(odd, empty):
    got = [(r["doc_id"], r["class_id"]) for r in near_dups.near_classes(odd).collect()]
    assert len(got) == len(ODD)
    assert dict(x for x in got if x[0] is not None) == {0: 0, 1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 5, 7: 7, 8: 7, 9: 9, 10: 10, 11: 11, 12: 12}
    kept = near_dups.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda x: -1 if x is None else x)
    assert ids == [None, None, 0, 1, 2, 3, 5, 7, 9, 10, 11, 12]
    assert near_dups.keep_one(empty).count() == 0


# token files


class Memory:
    def __init__(self, data):
        self.data, self.at = data, 0

    def size(self):
        return len(self.data)

    def seek(self, at):
        self.at = at

    def read(self, n=None):
        end = len(self.data) if n is None else self.at + n
        out, self.at = self.data[self.at : end], end
        return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 60), st.integers(0, 2**32 - 1)), max_size=900), max_size=6), st.integers(1, 3))
def test_block_files_round_trip(docs, chunk):
    import io

    out = io.BytesIO()
    writer = pfor.Writer(out)
    for i, ids in enumerate(docs):
        writer.add(None if i == 1 else i - 3, np.array(ids, dtype=np.uint32))
    writer.close()
    got = [(i, ids.tolist()) for i, ids in pfor.read(Memory(out.getvalue()), chunk)]
    assert got == [(None if i == 1 else i - 3, ids) for i, ids in enumerate(docs)]


def test_blocks_patch_outliers():
    ids = np.full(512, 7, dtype=np.uint32)
    ids[[3, 99]] = 49_000
    block = pfor.encode(ids)[0]
    assert len(block) < 64 and np.array_equal(pfor.decode(block, np.array([0])), ids)
    with pytest.raises(ValueError):
        list(pfor.read(Memory(block + b"x" * 40)))


def test_word_encoder_equals_whole_texts():
    encode = token_files.WordEncoder(tokenizer())
    texts = [LONG[:5000], "It's WE'LL <|endoftext|> x,y. Ünï ΣΑΣ İI a1b2 ...%%%  　z é", "", "  \n", "Trash, trash! 's ǅ ﬀ 漢字、かな"]
    whole = encode.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert encode.by_word and encode.folds
    assert [x.tolist() for x in encode(texts)] == [e.ids for e in whole]


def test_token_digests(odd, empty):
    rows = token_files.token_digests(odd, tokenizer()).collect()
    tk = token_files.WordEncoder(tokenizer()).tokenizer
    want = sorted(ODD, key=lambda x: (x[0] is not None, x[0] or 0))
    assert sorted(r["start"] for r in rows)[0] == 0 and len(rows) == len(ODD)
    rows.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [i for i, _ in want]
    start = 0
    known = {(i, t) for i, t in ODD}
    for r in rows:
        options = [tk.encode(t or "", add_special_tokens=False).ids + [2] for i, t in known if i == r["doc_id"]]
        assert (r["n_tokens"], r["ids_crc32"]) in [(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in options]
        assert r["start"] == start
        start += r["n_tokens"]
    assert token_files.token_digests(empty, tokenizer()).count() == 0


# licenses


def ascii_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if c.isascii() else c
        if ord(c) >= 0x80 or c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def plain_licenses(text):
    import re

    words = ascii_words(text)
    starts, n, labels_ = [], 0, set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += at
        labels_ |= {label} if at else set()
    norm = " " + " ".join(words) + " "
    hits = [
        (r.place, r.label, r.score, norm[: m.start()].count(" ") - 1, norm[: m.end()].count(" "))
        for r in licenses.rules() if r.keyword in words for m in re.finditer(r.pattern, norm)
    ]
    kept = [h for h in hits if not any(g[0] < h[0] and g[3] <= h[3] and g[4] >= h[4] for g in hits)]
    score = 1.0 if starts else max((h[2] for h in kept), default=0.0)
    both = ",".join(sorted(labels_ | {h[1] for h in kept}))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels_)), both, score)


def test_licenses_equal_a_plain_scan(spark, odd, empty):
    texts = [
        "Licensed under the Apache License, Version 2.0. See the MIT-LICENSE; mit license mit license",
        "This work is licensed under the GNU General Public License, version 3 or later.", "Licensed under CC BY-NC-SA 4.0.",
        "SPDX-License-Identifier: BSD-3-Clause\nCopyright (c) 2020 X. All rights reserved.", "the Kelvin mit LİCENSE apache license",
        "PERMISSION is hereby granted, free of charge; provided as is without warranty of any kind", "gpl gpl license v2",
    ]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string"))
    docs = docs.withColumn("scan", docs.doc_id)
    rows = licenses.scanned(docs.withColumn("t", docs.text)).collect()
    found = {r["doc_id"]: tuple(r)[1:-1] for r in rows if r["doc_id"] is not None}
    for i, t in [x for x in ODD if x[0] is not None] + [(100 + i, t) for i, t in enumerate(texts)]:
        assert found[i] == plain_licenses(t), (t or "")[:80]
    assert "apache-2.0" in found[100][5] and found[100][1] == 4
    assert licenses.scanned(empty).count() == 0 and 200 <= len(licenses.rules())


# decontamination


def test_leaks_odd_rows(spark, odd, empty):
    item = prose(30, 42)
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(70, f"{LONG[:3000]} {item.upper()}! {LONG[:500]}"), (None, item)], "doc_id bigint, text string"))
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too few words"), (None, item), (4, prose(25, 43))], "item_id bigint, text string")
    got = [(r["doc_id"], r["item_id"], r["containment"]) for r in decontaminate.leaks(docs, items).collect()]
    # The row without an id holds the item as well: it is reported and goes.
    assert sorted(got, key=str) == sorted([(70, 1, 1.0), (None, 1, 1.0)], key=str)
    left = decontaminate.drop_leaks(docs, items)
    assert left.count() == docs.count() - 2 and left.columns == docs.columns
    assert decontaminate.drop_leaks(empty, items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0


# mixing


def test_mixing_targets_and_curriculum(spark, odd, empty):
    rows = [(i, prose(1 + i % 90, i), None if i % 10 == 9 else f"s{i % 10 if i % 10 < 4 else 0}", i) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, mix int")
    plan = mixing.mixed_plan(docs).collect()
    assert len(plan) == 2000 and all(r["taken"] <= 2 * r["size"] for r in plan)
    per = {}
    for r in plan:
        key = rows[r["doc_id"]][2]
        got = per.setdefault(key, [r["target"], r["source_size"], 0])
        got[2] += r["taken"]
    total = sum(x[1] for x in per.values())
    assert sum(x[0] for x in per.values()) == pytest.approx(1.5 * total)
    assert all(x[0] <= 2 * x[1] + 1e-6 and abs(x[2] - x[0]) <= 90 for x in per.values())
    mixed = mixing.mix(docs).collect()
    assert sum(len(split(r["text"])) for r in mixed) == sum(x[2] for x in per.values())
    # The source whose weight falls stands early on average, the one whose weight rises late.
    mean = lambda s: np.mean([k for k, r in enumerate(mixed) if r["source"] == s])
    assert mean("s0") < mean("s2")
    assert [tuple(r) for r in mixing.mixed_plan(docs).collect()] == [tuple(r) for r in plan]
    assert mixing.mixed_plan(odd).count() == len(ODD) and mixing.mix(odd).columns == odd.columns
    assert mixing.mixed_plan(empty).count() == 0 and mixing.mix(empty).count() == 0


# archives


def test_archives_reject_magic_in_payloads(spark, tmp_path):
    fake = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    pages = [(1, "http://a/ b", fake * 40), (2, None, None), (3, "u", ""), (4, "u", fake * 40), (5, "u", "WARC/1.1\r\n" * 50), (6, "v", "é" * 3000), (None, "n", "same"), (7, "n", "same"), (8, "q", "WARC/1.1\r\nContent-Length: 99999999\r\n\r\n")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    manifest = warc.write_archives(df.coalesce(1), f"{tmp_path}/w")
    for chunk in (200, 3000, warc.CHUNK):
        rows = warc.read_archives(manifest, chunk).collect()
        assert len(rows) == len(pages)
        got = {r["page_id"]: r for r in rows}
        assert {i: got[i]["refers_to"] for i in got} == {1: 4, 2: 3, 3: None, 4: None, 5: None, 6: None, None: None, 7: None, 8: None}
        for i, _, html in pages:
            data = (html or "").encode()
            assert got[i]["payload_bytes"] == len(data)
            assert got[i]["payload_digest"] == warc.base32(hashlib.sha1(data).hexdigest())
            assert got[i]["record_type"] == ("revisit" if got[i]["refers_to"] else "response")
            assert got[i]["payload"] == (None if got[i]["refers_to"] else data)
    assert warc.archived(df.limit(0)).count() == 0


# personal data


def test_surrogates_keep_type_and_format(spark, odd, empty):
    key = b"k"
    cases = {
        "email": "Ann.Lee7@mail.example.com", "ip": "10.20.30.40", "card": "4111 1111 1111 1111", "ssn": "123-45-6789",
        "phone": "+49 (030) 555-1234", "secret": "0a" * 20, "iban": "DE89 3704 0044 0532 0130 00", "person": "Frau Anna Becker",
    }
    for kind, value in cases.items():
        text = f"see {value}, and"
        assert [(k, v) for _, _, k, v in surrogates.entities(text)] == [(kind, value)]
        new = surrogates.surrogate(key, kind, value)
        assert new != value and new == surrogates.surrogate(key, kind, value)
        again = [(k, v) for _, _, k, v in surrogates.entities(f"see {new}, and")]
        assert again == [(kind, new)], new
    assert surrogates.luhn(surrogates.surrogate(key, "card", cases["card"]).replace(" ", ""))
    spaced, bare = (surrogates.surrogate(key, "card", x) for x in ("4111 1111 1111 1111", "4111111111111111"))
    assert spaced.replace(" ", "") == bare
    assert surrogates.surrogate(key, "person", "Frau Анна Иванова").split()[1] in surrogates.GIVEN["f", "cyrillic"]
    people = [(1000 + i, f"Herr Carl N{chr(97 + i // 26)}{chr(97 + i % 26)}{'x' * (i % 3)} came. Frau Анна Петрова, tel. 555 123 {i:04d}") for i in range(600)]
    docs = spark.createDataFrame(people + [(i, t) for i, t in ODD], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in surrogates.replaced(docs, "k").collect()}
    names = {i: rows[1000 + i]["text"].split(" came")[0] for i in range(600)}
    assert len(set(names.values())) == len({t.split(" came")[0] for _, t in people})
    assert not set(names.values()) & {t.split(" came")[0] for _, t in people}
    assert len({rows[1000 + i]["text"].split("Frau ")[1].split(",")[0] for i in range(600)}) == 1
    assert len({rows[1000 + i]["text"][-12:] for i in range(600)}) == 600
    assert rows[1001]["n_entities"] == 3 and rows[1009]["n_entities"] == 3
    assert surrogates.replaced(odd, "k").count() == len(ODD) and surrogates.replaced(empty, "k").count() == 0
    nulls = [r["text"] for r in surrogates.replaced(odd, "k").collect() if r["doc_id"] == 0]
    assert nulls == [None]


def test_surrogates_of_neighbouring_entities():
    cases = [
        ("phone", "+1 (826) 555-4081"), ("ip", "190.137.223.204"), ("phone", "555-123-4567"), ("ip", "10.0.0.1"),
        ("ssn", "123-45-6789"), ("card", "4111 1111 1111 1111"), ("email", "a.b@mail.example.com"),
    ]
    for first, second in itertools.product(cases, cases[1::2] + cases[6:]):
        if first[0] == "card":
            continue
        text = f"see {first[1]} {second[1]} now"
        assert [(k, v) for _, _, k, v in surrogates.entities(text)] == [first, second]
    for text, values in (
        ("+49 030 1234 5678 2024 14", ["+49 030 1234", "5678 2024 14"]), ("Mr and Mrs Smith", ["Mrs Smith"]),
    ):
        assert [v for _, _, _, v in surrogates.entities(text)] == values


# toxicity


def test_toxicity_on_held_out_texts(spark, odd, empty):
    bad = ["zzbad", "zzworse", "zzawful"]
    rows, marks = [], []
    for i in range(900):
        words = prose(80, i).split()
        if i % 4 == 0:
            for b in bad:
                words.insert(random.Random(i).randrange(len(words)), b)
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = toxicity.scored(docs, labels(spark, marks)).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r["held_out"]]
    right = sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held)
    assert right >= 0.97 * len(held)
    got = toxicity.scored(odd, labels(spark, marks)).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.scored(odd, labels(spark)).count() == len(ODD) and toxicity.scored(empty, labels(spark, marks)).count() == 0


def test_toxicity_counts_what_calibration_leaves(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CALIBRATION_ROWS", 20)
    rest = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 4]
    docs = spark.createDataFrame([(i, f"{'zzbad zzworse' if i % 2 else 'fine day'} w{i % 7}") for i in rest], "doc_id bigint, text string")
    out = toxicity.scored(docs, labels(spark, [(i, 1, i % 2) for i in rest])).collect()
    assert all((r["whole"] > 0) == (r["doc_id"] % 2 == 1) and r["whole"] != 0 for r in out)


def test_toxicity_keeps_every_word_apart(spark):
    seen, same = {}, None
    for i in itertools.count():
        number = int(toxicity.word_hashes(toxicity.pa.array([f"q{i}"]), toxicity.NOT_WORD)[0][0]) & (1 << 20) - 1
        if number in seen:
            same = (seen[number], f"q{i}")
            break
        seen[number] = f"q{i}"
    docs = spark.createDataFrame([(i, same[i % 2]) for i in range(300)], "doc_id bigint, text string")
    out = toxicity.scored(docs, labels(spark, [(i, 1, i % 2) for i in range(300)])).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in out)


# repeated passages


def test_repeats_equal_a_plain_scan(spark, odd, empty):
    passage = prose(55, 8)
    texts = [(20 + i, f"{prose(30, 30 + i)} {passage if i % 2 else passage[5:]} {prose(25, 60 + i)} {passage[:120] if i % 3 else ''}") for i in range(40)]
    rows = [x for x in ODD if x[0] not in (None, 10)] + texts
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r for r in substrings.without_repeats(docs).collect()}
    seen = set()
    for i, t in sorted(rows, key=lambda x: x[0]):
        w = split(t)
        gone = set()
        for s in range(len(w) - 19):
            run = tuple(w[s : s + 20])
            if run in seen:
                gone.update(range(s, s + 20))
            seen.add(run)
        assert got[i]["n_words"] == len(w) and got[i]["n_removed"] == len(gone), i
        assert got[i]["kept_text"] == " ".join(x for k, x in enumerate(w) if k not in gone)
    out = substrings.without_repeats(odd).collect()
    assert len(out) == len(ODD) and all(r["n_removed"] == 0 for r in out if r["doc_id"] in (10, None))
    assert substrings.without_repeats(empty).count() == 0
