"""Dictionaries beyond the broadcast limit, and learnt sentence ends."""

from pyspark.sql import functions as F

from mentionlake.functions.text import letter_runs
from mentionlake.operators import anchors, detect, dictionary
from mentionlake.operators.sentences import learn_abbreviations, split_learned, split_sentences


def words(i):
    return "".join(chr(97 + int(d)) for d in str(i))


def test_every_anchor_passes_the_filter_and_few_others_do(spark):
    known = spark.range(3000).select(F.concat(F.lit("x"), F.col("id")).alias("anchor"))
    passes = anchors.anchor_filter(known)
    assert known.where(passes(F.col("anchor"))).count() == 3000
    others = spark.range(20_000).select(F.concat(F.lit("y"), F.col("id")).alias("anchor"))
    assert others.where(passes(F.col("anchor"))).count() < 20_000 / anchors.BITS_PER_ANCHOR * 1.5


def test_salts_follow_the_counts(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise(F.col("id").cast("string")).alias("anchor"))
    counts = rows.groupBy("anchor").count().withColumnRenamed("count", "n")
    salts = anchors.salts_of(counts, 100)
    got = {r["anchor"]: r["s"] for r in counts.select("anchor", salts(F.col("anchor")).alias("s")).collect()}
    assert got["hot"] == 9 and sum(s == 1 for s in got.values()) >= 99
    assert counts.select(anchors.salts_of(counts, 1000)(F.col("anchor")).alias("s")).distinct().collect()[0]["s"] == 1


def test_the_shuffled_path_finds_what_the_broadcast_one_does(spark):
    names = spark.createDataFrame([(i, [f"name {words(i)}", words(i)]) for i in range(10, 60)] + [(99, ["common"])], "resource_id bigint, names array<string>")
    aliases = dictionary.explode_aliases(names)
    texts = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("A common name "), F.translate((F.col("id") % 97).cast("string"), "0123456789", "abcdefghij"), F.lit(" stands here. Nothing else does.")).alias("text"),
    )
    sentences = split_sentences(texts)
    small, large = (detect.match_aliases(sentences, aliases, max_rows=n) for n in (10_000, 0))
    pick = ["doc_id", "sent_no", "resource_id", "alias"]
    rows = lambda df: sorted(map(tuple, df.select(*pick).collect()))
    assert rows(small) == rows(large) and len(rows(small)) > 400


def test_hot_tokens_are_spread_without_changing_the_pairs(spark):
    rows = spark.range(300).select(F.col("id").alias("k"), F.array(F.lit("hot"), F.col("id").cast("string"), F.lit("none")).alias("t"))
    patterns = spark.createDataFrame([("hot", 1), ("hot", 2), ("7", 3)], "anchor string, p int")
    pairs = anchors.anchor_join(rows, ["k"], F.col("t"), patterns, small=False, slice_rows=40)
    assert sorted((r["k"], r["p"]) for r in pairs.collect()) == sorted([(k, p) for k in range(300) for p in (1, 2)] + [(7, 3)])


def test_only_tokens_that_may_be_anchors_are_shuffled(spark):
    texts = spark.range(200).select(F.col("id").alias("k"), F.lit("many words of which none but one is known here").alias("s"))
    rows = texts.withColumn("t", letter_runs(F.col("s")))
    patterns = spark.createDataFrame([("known", 1)], "anchor string, p int")
    left = rows.select(F.explode(F.filter("t", anchors.anchor_filter(patterns))).alias("a"))
    assert rows.select(F.explode("t")).count() == 2000 and left.count() == 200


CORPUS = [
    (1, "As shown by Smith et al. Many agree with this. We saw it in Fig. Two of these stand in Fig. Three as well. Jones et al. Said so."),
    (2, "In Fig. Four the cat sat. Then Lee et al. Found the dog. The end came. It was late. We went home. Nobody spoke. All slept."),
    (3, "See Fig. Five and what Kim et al. Wrote of it. The tree fell. A bird sang. No one knew why this was. They left. Rain came."),
    (4, None), (5, ""), (6, "no end"),
    (7, "They sat there, the dog came late to their home, spoke, slept, fell, sang, was out and left so that all stand well by this and agree"),
]


def test_learnt_abbreviations_do_not_end_sentences(spark):
    texts = spark.createDataFrame([(i + 10 * k, t) for k in range(3) for i, t in CORPUS], "doc_id bigint, text string").repartition(3)
    learnt = learn_abbreviations(texts)
    found = {r["word"]: r for r in learnt.collect()}
    assert {"al", "fig"} <= set(found) and not {"this", "cat", "it", "the", "home"} & set(found)
    assert (found["al"]["dotted"], found["al"]["plain"]) == (12, 0)
    rows = [r["sentence"] for r in split_learned(texts, learnt).where("doc_id = 2").orderBy("sent_no").collect()]
    assert rows[:3] == ["In Fig. Four the cat sat.", "Then Lee et al. Found the dog.", "The end came."]
    plain = [tuple(r) for r in split_sentences(texts).orderBy("doc_id", "sent_no").collect()]
    none = learnt.where("false")
    assert [tuple(r) for r in split_learned(texts, none).orderBy("doc_id", "sent_no").collect()] == plain
    assert learn_abbreviations(texts.where("false")).collect() == [] and len(learn_abbreviations(texts, most=1).collect()) == 1


def test_resources_that_share_an_alias_are_matched_as_one(spark, monkeypatch):
    names = spark.createDataFrame([(i, ["red ring", "red ring"] if i % 2 else ["red ring", "U.S.A. ring", "Ring"]) for i in range(60)], "resource_id bigint, names array<string>")
    aliases = dictionary.explode_aliases(names)
    texts = spark.createDataFrame([(1, "A red ring here. Made in the USA ring or U.S.A ring."), (2, "No such. A RED\nRING."), (3, None)], "doc_id bigint, text string")
    met, joined = [], anchors.salted_pairs
    monkeypatch.setattr(detect, "salted_pairs", lambda rows, keys, left, patterns, salts: met.append(patterns.count()) or joined(rows, keys, left, patterns, salts))
    pick = ["doc_id", "sent_no", "sentence", *detect.ALIAS_FIELDS]
    small, large = (sorted(map(tuple, detect.match_aliases(split_sentences(texts), aliases, max_rows=n).select(*pick).collect())) for n in (10_000, 0))
    assert small == large and len(small) > 180
    assert met == [3]  # not one for each of 60 resources


def test_tokens_are_counted_before_they_are_taken_apart(spark):
    texts = spark.createDataFrame([(1, " a\tb. a b.  c.\n x. "), (2, "x."), (3, None), (4, " \n "), (5, "x. b c. x.")], "doc_id bigint, text string")
    learnt = learn_abbreviations(texts, min_score=-1e9)
    assert {(r["word"], r["dotted"], r["plain"]) for r in learnt.collect()} == {("b", 2, 1), ("c", 2, 0), ("x", 1, 0)}
    plan = learnt._jdf.queryExecution().optimizedPlan().toString().split("\n")
    cleaned = max(i for i, line in enumerate(plan) if "regexp_replace" in line)
    assert any("Aggregate" in line for line in plan[cleaned + 1 :])  # the deeper line runs first


def test_learnt_sentences_are_joined_in_one_pass(spark):
    told = spark.createDataFrame([("etc",), ("u.s",)], "word string")
    rows = [(1, "We saw etc. And so.   In the U.S. All\nwell. Etc."), (2, None), (3, " "), (4, "etc. etc. etc."), (5, "So (etc.) he said. It. etc. Too!")]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = split_learned(texts, told)
    assert [tuple(r) for r in found.orderBy("doc_id", "sent_no").collect()] == [
        (1, 0, "We saw etc. And so."), (1, 1, "In the U.S. All well."), (1, 2, "Etc."),
        (4, 0, "etc. etc. etc."), (5, 0, "So (etc.) he said."), (5, 1, "It."), (5, 2, "etc. Too!"),
    ]
    assert "aggregate(" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_no_learnt_word_is_left_out_however_many_there_are(spark):
    letters = [F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (F.floor(F.col("id") / 26**n) % 26 + 1).cast("int"), F.lit(1)) for n in range(3)]
    texts = spark.range(5200).select(F.col("id").alias("doc_id"), F.concat(F.lit("We saw "), F.concat_ws(".", *letters), F.lit(". Then we all went home by bus.")).alias("text"))
    learnt = learn_abbreviations(texts)
    assert learnt.count() == 5200
    found = split_learned(texts, learnt)
    assert found.count() == 5200 and found.where("sent_no = 0").count() == 5200


def test_a_long_list_of_learnt_words_cuts_as_a_short_one(spark):
    told = spark.createDataFrame([("etc",), ("u.s",), ("fig",), ("never",)], "word string")
    rows = [(1, "We saw etc. And so.   In the U.S. All\nwell. Etc."), (2, None), (3, " "), (4, "etc. etc. fig. etc."), (None, "So (etc.) he said. It. etc. Too!"), (None, "By Fig. 2. Or not."), (1, "Fig. 1. No end")]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    listed, joined = (sorted(map(tuple, split_learned(texts, told, most_in_plan=n).collect()), key=repr) for n in (4, 3))
    assert listed == joined and (None, 0, "By Fig. 2.") in joined and len(joined) == 11


ODD = [
    (1, "A red ring, a Red\u00a0 RING and a red \u2013ring of the U.S.A. red ring."), (1, "The redring and the ring red, but no red, ring."),
    (2, "In the USA red ring or U.S red-ring 2.0 \u212Aelvin Ring, \u212Aelvin ring."), (3, None), (None, "red ring red ring red"), (2, "ring 2.0 red"),
    (4, "ring-red r\u00e9d ring; kelvin Ring \u0130on Ring ion ring i\u0307on ring"), (4, "- ."),
]


def odd_case(spark):
    names = [["red ring", "ring red"], ["red-ring", "red ring 2.0"], ["U.S.A. red ring", "2.0"], ["Kelvin Ring", "\u212Aelvin ring"], ["\u0130on Ring", "ion ring"], ["ring", "- ."], ["red, ring"]]
    lists = spark.createDataFrame(list(enumerate(names * 2)), "resource_id bigint, names array<string>")
    aliases = dictionary.explode_aliases(lists, ["Kelvin Ring", "\u0130on Ring", "red-ring"])
    return split_sentences(spark.createDataFrame(ODD, "doc_id bigint, text string")), aliases


def test_neighbouring_words_find_what_single_ones_do(spark):
    # Two rows of article 1 and of article 2 share the number of their sentence.
    sentences, aliases = odd_case(spark)
    pick = ["doc_id", "sent_no", "sentence", *detect.ALIAS_FIELDS]
    for boundary in ("lookaround", "consuming"):
        small, large = (sorted(map(tuple, detect.match_aliases(sentences, aliases, boundary, max_rows=n).select(*pick).collect()), key=repr) for n in (10_000, 0))
        assert small == large and len(small) > 30 and any(r[0] is None for r in large)


def test_texts_are_cut_once_and_meet_few_aliases_that_they_do_not_hold(spark, monkeypatch):
    names = spark.createDataFrame([(i, [f"{words(i)} widget"]) for i in range(100, 160)], "resource_id bigint, names array<string>")
    cut = spark.sparkContext.accumulator(0)
    rows = [(i, 0, f"no {words(i % 9 + 100)} widget here") for i in range(90)]
    sentences = spark.sparkContext.parallelize(rows, 3).map(lambda r: cut.add(1) or r).toDF("doc_id bigint, sent_no int, sentence string")
    met, joined = [], anchors.salted_pairs

    def pairs(*given):
        met.append(joined(*given).count())
        return joined(*given)

    monkeypatch.setattr(detect, "salted_pairs", pairs)
    assert detect.match_aliases(sentences, dictionary.explode_aliases(names), max_rows=0).count() == 90
    assert cut.value == 90 and met == [90]  # not 60 aliases for each of 90 sentences


def test_many_owners_of_an_alias_come_in_several_rows(spark, monkeypatch):
    monkeypatch.setattr(detect, "OWNERS_PER_ROW", 7)
    names = spark.createDataFrame([(i, ["red ring", "RED ring"] if i % 3 else ["Ring", "red ring", "red ring"]) for i in range(80)], "resource_id bigint, names array<string>")
    sentences = spark.createDataFrame([(1, 0, "a red ring"), (2, 0, "the Ring"), (3, 0, "nothing")], "doc_id bigint, sent_no int, sentence string")
    small, large = (sorted(map(tuple, detect.match_aliases(sentences, dictionary.explode_aliases(names), max_rows=n).collect())) for n in (10_000, 0))
    assert small == large and len(small) > 200
