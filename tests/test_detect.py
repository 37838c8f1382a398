"""Mention detection against a plain nested loop."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mentionlake.operators import detect
from mentionlake.operators.dictionary import alias_patterns, explode_aliases
from mentionlake.operators.sentences import split_rows, split_sentences

DASHES = "[-‐‑‒–—−]"


def regex(alias, cs, boundary="lookaround"):
    norm = alias if cs else alias.lower()
    if boundary == "consuming":
        return re.compile(f"[^A-Za-z]{re.escape(norm)}[^A-Za-z]")
    flexible = {" ": r"\s+", "-": DASHES, ".": r"\.?"}
    body = "".join(flexible.get(c, re.escape(c)) for c in norm)
    return re.compile(f"(?<![A-Za-z]){body}(?![A-Za-z])")


def brute(sentences, aliases, boundary="lookaround"):
    found = set()
    for doc, no, s in sentences:
        for rid, name, alias, cs in aliases:
            subject = s if cs and boundary == "lookaround" else s.lower()
            if regex(alias, cs, boundary).search(subject):
                found.add((doc, no, rid, alias))
    return found


def random_word(rng):
    letters = "abAB" * 4 + ".-  12éßКİK日" + "– +("
    return "".join(rng.choice(letters) for _ in range(rng.randint(1, 6))).strip()


@pytest.fixture(scope="module")
def random_case(spark):
    rng = random.Random(7)
    aliases = []
    for i in range(60):
        alias = random_word(rng)
        if alias:
            aliases.append((i % 25, f"R{i % 25}", alias, i % 25 % 3 == 0))
    sentences = []
    for i in range(500):
        parts = [random_word(rng) for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.7:
            alias = rng.choice(aliases)[2]
            parts.insert(rng.randint(0, len(parts)), rng.choice([alias, alias.upper(), alias.replace(".", "")]))
        s = rng.choice([" ", "", " "]).join(parts).strip()
        if s:
            sentences.append((i // 5, i % 5, s))
    s_df = spark.createDataFrame(sentences, "doc_id int, sent_no int, sentence string")
    a_df = spark.createDataFrame(
        aliases, "resource_id int, resource_name string, alias string, case_sensitive boolean"
    )
    return sentences, aliases, s_df, a_df


@pytest.mark.parametrize("boundary", ["lookaround", "consuming"])
@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_anchor_join_equals_nested_loop(random_case, boundary, max_rows):
    sentences, aliases, s_df, a_df = random_case
    got = detect.match_aliases(s_df, a_df, boundary, max_rows=max_rows).collect()
    rows = [(r.doc_id, r.sent_no, r.resource_id, r.alias) for r in got]
    want = brute(sentences, aliases, boundary)
    assert len(want) > 100 or boundary == "consuming"
    assert set(rows) == want
    distinct = {(r, a, cs) for r, _, a, cs in aliases}
    if len(distinct) == len(aliases):
        assert len(rows) == len(set(rows))


def test_many_letterless_aliases(spark):
    """More letterless aliases than are looked up one by one."""
    aliases = [(i, "N", str(i), False) for i in range(100, 150)] + [(1, "D", "-.", False)]
    sentences = [(0, i, f"x{i * 7}y {i}") for i in range(60)] + [(0, 99, "a - b")]
    s_df = spark.createDataFrame(sentences, "doc_id int, sent_no int, sentence string")
    a_df = spark.createDataFrame(
        aliases, "resource_id int, resource_name string, alias string, case_sensitive boolean"
    )
    got = detect.match_aliases(s_df, a_df).collect()
    assert {(r.doc_id, r.sent_no, r.resource_id, r.alias) for r in got} == brute(sentences, aliases)


def find(spark, texts, dictionary, cs=(), **kw):
    t = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    d = spark.createDataFrame(dictionary, "resource_id int, names array<string>")
    got = detect.find_in_texts(t, explode_aliases(d, cs), cs, **kw).collect()
    return sorted((r.doc_id, r.sentence, r.alias, r.resource_name) for r in got)


def test_boundaries_digits_count_as_edges(spark):
    got = find(spark, ["GO:1 and ENA2.", "goat. The GO", "éGO ok", "hugo"], [(1, ["GO"]), (2, ["ENA"])])
    assert [(d, a) for d, _, a, _ in got] == [(0, "ENA"), (0, "GO"), (1, "GO"), (2, "GO")]


def test_flexible_space_dash_dot(spark):
    names = [(1, ["By-NC", "Clinical Trials.gov"])]
    texts = ["a by–nc b", "CLINICAL  trialsgov", "clinical\ntrials.gov", "bync"]
    assert [(d, a) for d, _, a, _ in find(spark, texts, names)] == [
        (0, "By-NC"), (1, "Clinical Trials.gov"), (2, "Clinical Trials.gov"),
    ]


def test_case_sensitive_names_cover_all_aliases(spark):
    got = find(spark, ["map", "MAP", "Mapper Tool", "mapper tool"], [(1, ["MAP", "Mapper Tool"])], ["MAP"])
    assert [(d, a) for d, _, a, _ in got] == [(1, "MAP"), (2, "Mapper Tool")]


def test_substring_suppression_by_text_not_position(spark):
    names = [(1, ["Apache", "Apache License"]), (2, ["ASF", "apache license"])]
    got = find(spark, ["Apache is not the Apache License.", "apache"], names)
    assert [(d, a, r) for d, _, a, r in got] == [
        (0, "Apache License", "Apache"), (0, "apache license", "ASF"), (1, "Apache", "Apache"),
    ]


def test_volume_recheck_counts_per_alias_before_dedupe(spark):
    text = " ".join(["the x."] * 20 + ["The y."] * 11)
    names = [(1, ["A", "The"]), (2, ["B", "the"])]
    got = find(spark, [text], names)
    # Each alias has 31 mentions; strict spelling leaves one distinct sentence each.
    assert [(s, a) for _, s, a, _ in got] == [("The y.", "The"), ("the x.", "the")]
    assert len(find(spark, [text], names, threshold=31)) == 4
    # An alias shared by two resources counts over both.
    shared = [(1, ["A", "the"]), (2, ["B", "the"])]
    assert len(find(spark, [" ".join(["THE x."] * 16)], shared)) == 0
    assert len(find(spark, [" ".join(["THE x."] * 15)], shared)) == 2


def test_name_in_case_sensitive_list_is_exempt_from_recheck(spark):
    text = " ".join(["a b x."] * 31)
    assert len(find(spark, [text], [(1, ["a b"])], ["a b"])) == 1
    assert len(find(spark, [text], [(1, ["a b"])])) == 0


def test_dedupe_is_per_sentence_text(spark):
    got = find(spark, ["GO a. GO a. GO b."], [(1, ["GO"])])
    assert [s for _, s, _, _ in got] == ["GO a.", "GO b."]


def test_consuming_misses_edges_and_upper_case(spark):
    texts = ["GO here", "see GO here", "see MAP here"]
    got = find(spark, texts, [(1, ["GO"]), (2, ["MAP"])], ["MAP"], boundary="consuming")
    assert [(d, a) for d, _, a, _ in got] == [(1, "GO")]


def test_sentences_and_rows(spark):
    df = spark.createDataFrame([(1, " # TITLE\nA b.  C\nd! e?  f. "), (2, ""), (3, None)], "doc_id int, text string")
    got = [(r.doc_id, r.sent_no, r.sentence) for r in split_sentences(df).collect()]
    assert got == [(1, 0, "# TITLE A b."), (1, 1, "C d!"), (1, 2, "e?"), (1, 3, "f.")]
    rows = spark.createDataFrame([(1, "a. b\n\n c ")], "doc_id int, text string")
    assert [(r.sent_no, r.sentence) for r in split_rows(rows).collect()] == [(0, "a. b"), (2, "c")]


def test_anchor_choice(spark):
    rows = [("U.S.A",), ("U.S.A base",), ("2.0",), ("- .",), ("of the",), ("日本",)]
    df = spark.createDataFrame(rows, "alias string").withColumn("case_sensitive", F.lit(False))
    got = {r.alias: r.anchors for r in alias_patterns(df).collect()}
    assert got == {
        "U.S.A": ["u", "us", "usa"], "U.S.A base": ["base"], "2.0": ["#2"], "- .": ["*"],
        "of the": ["the"], "日本": ["#日本"],
    }


def test_oversized_dictionary_is_not_broadcast(random_case):
    _, _, s_df, a_df = random_case
    plan = detect.match_aliases(s_df, a_df, max_rows=0)._jdf.queryExecution().toString()
    assert "salt" in plan and "rightHint=(strategy=broadcast)" not in plan
    small = detect.match_aliases(s_df, a_df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small and "CartesianProduct" not in small


def test_volume_counter_matches_plain_count(random_case):
    sentences, aliases, s_df, a_df = random_case
    pairs = detect.match_aliases(s_df, a_df)
    got = detect.recheck_volume(pairs, threshold=0).collect()
    counts = Counter((d, a) for d, _, _, a in ((r.doc_id, 0, 0, r.alias) for r in pairs.collect()))
    assert all(counts[(r.doc_id, r.alias)] == r.alias_hits for r in got)


def test_rarest_word_as_anchor(random_case, spark):
    sentences, aliases, s_df, a_df = random_case
    counts = detect.token_counts(s_df)
    got = detect.match_aliases(s_df, a_df, token_counts=counts).collect()
    assert {(r.doc_id, r.sent_no, r.resource_id, r.alias) for r in got} == brute(sentences, aliases)
    common = spark.createDataFrame([("license", 90), ("of", 3)], "token string, n long")
    one = spark.createDataFrame([("License of",), ("a.b license",)], "alias string")
    picked = alias_patterns(one.withColumn("case_sensitive", F.lit(False)), token_counts=common)
    assert {r.alias: r.anchors for r in picked.collect()} == {"License of": ["of"], "a.b license": ["license"]}
