"""Quality rules: a decision list learned from labelled statistics.

Every text is measured by Spark expressions alone. Sequential covering then learns
ordered rules for low quality: a conjunction of threshold tests is grown by FOIL gain on
two thirds of the labelled sample, pruned on the rest, kept if it is precise there, and
the rows it covers are set aside. Each step is one aggregation over bins of the
measures; the driver sees counts, never rows. The list becomes one conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.llm.stage import SPACE, fresh, new_folder, staged

WINDOW = 8
#: Labelled rows used to fit, the first by a hash of their id: a fixed bound.
SAMPLE = 20_000
BINS = 20
MAX_RULES = 8
MAX_TESTS = 3
MIN_PRECISION = 0.9
MIN_COVER = 8
FEATURES = ("word_length", "symbols", "repeated_lines", "repeated_words", "capitals", "exclamations")


@dataclass(frozen=True)
class Test:
    """``feature > bound`` or, if not ``above``, ``feature <= bound``."""

    feature: int
    above: bool
    bin: int
    bound: float


def word_array(text: Column) -> Column:
    """Words between spaces and the controls from tab to carriage return."""
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), SPACE), lambda w: w != "")


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(hashes: Column) -> Column:
    """Places covered by windows whose hash occurs twice or more."""

    def repeated(pairs: Column) -> Column:
        def twin(p: Column, i: Column) -> Column:
            near = lambda j: F.coalesce(F.get(pairs, j)["h"] == p["h"], F.lit(False))
            return near(i - 1) | near(i + 1)

        return F.sort_array(F.transform(F.filter(pairs, twin), lambda p: p["i"]))

    def length(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _bound(_bound(pairs, repeated), length)


def measured(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with one struct column ``name`` of counts over each whole text; a null
    text has none of anything.

    Words, lines and windows are bound inside one expression, and the struct passes
    through a one-row explode, so that no filter above makes Spark count twice.
    """

    def windows(words: Column) -> Column:
        last = F.greatest(F.size(words) - WINDOW + 1, F.lit(1))
        every = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
        return F.when(F.size(words) >= WINDOW, every).otherwise(F.array().cast("array<bigint>"))

    def counts(text: Column, words: Column, lines: Column, hashes: Column) -> Column:
        once = F.size(F.array_distinct(hashes)) == F.size(hashes)
        found = {
            "n_words": F.size(words),
            "word_chars": F.char_length(F.array_join(words, "")),
            "n_symbols": F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": F.when(once, F.lit(0)).otherwise(_covered(hashes)),
            "n_capitals": F.char_length(F.regexp_replace(text, r"[^A-Z]+", "")),
            "n_exclamations": F.char_length(text) - F.char_length(F.replace(text, F.lit("!"), F.lit(""))),
        }
        return F.struct(*(c.cast("bigint").alias(k) for k, c in found.items()))

    def lines_of(text: Column) -> Column:
        return F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    struct = _bound(text, lambda t: _bound(word_array(t), lambda w: _bound(lines_of(t), lambda x: _bound(
        windows(w), lambda h: counts(t, w, x, h)
    ))))
    return docs.select(*docs.columns, F.explode(F.array(struct)).alias(name))


def _features(m: str) -> list[Column]:
    per_word = lambda c: F.col(f"{m}.{c}") / F.greatest(F.col(f"{m}.n_words"), F.lit(1))
    return [
        per_word("word_chars"), per_word("n_symbols"),
        F.col(f"{m}.n_dup_lines") / F.greatest(F.col(f"{m}.n_lines"), F.lit(1)),
        per_word("n_repeat_words"), per_word("n_capitals"), per_word("n_exclamations"),
    ]


def base_failed(m: str) -> Column:
    words, repeated = F.col(f"{m}.n_words"), F.col(f"{m}.n_repeat_words")
    return (words < 20) | (100 * repeated > 30 * words)


def learn(docs: DataFrame, labels: DataFrame) -> list[list[Test]]:
    """Ordered rules, each a conjunction that marks low quality (``labels.quality = 0``).

    Fitted on at most ``SAMPLE`` labelled rows. Rows without an id or a label are
    ignored; with no labels the list is empty.
    """
    folder = new_folder(docs.sparkSession, "quality")
    sample = (
        labels.where("doc_id is not null and quality is not null")
        .select("doc_id", (F.col("quality") == 0).alias("bad"), F.xxhash64("doc_id").alias("h"))
        .orderBy("h", "doc_id", "bad").limit(SAMPLE)
    )
    rows = measured(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "m")
    values = F.array(*[f.cast("double") for f in _features("m")])
    rows = staged(rows.where(~base_failed("m")).select("bad", (F.pmod("h", F.lit(3)) == 0).alias("held"), values.alias("v")), folder, "sample")
    steps = [i / BINS for i in range(BINS + 1)]
    cuts = rows.agg(*[F.percentile_approx(F.col("v")[i], steps, 10_000).alias(f"c{i}") for i in range(len(FEATURES))]).first()
    cuts = [sorted(set(c or [])) for c in cuts]
    # Bounds lie half-way between neighbouring quantiles, away from either side's values.
    cuts = [[(a + b) / 2 for a, b in zip(c, c[1:])] for c in cuts]
    number = lambda i: F.size(F.filter(F.array(*map(F.lit, cuts[i])), lambda c: F.col("v")[i] > c)) if cuts[i] else F.lit(0)
    rows = staged(rows.select("bad", "held", F.array(*[number(i) for i in range(len(FEATURES))]).alias("bins")), folder, "bins")
    rules: list[list[Test]] = []
    while len(rules) < MAX_RULES:
        rest = rows.where(~F.coalesce(_any(rules), F.lit(False)))
        rule = _prune(rest.where("held"), _grow(rest.where("not held"), cuts))
        if not rule:
            break
        rules.append(rule)
    return rules


def _in_bins(rule: list[Test]) -> Column:
    out = F.lit(True)
    for t in rule:
        b = F.col("bins")[t.feature]
        out = out & (b > t.bin if t.above else b <= t.bin)
    return out


def _any(rules: list[list[Test]]) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | _in_bins(rule)
    return out


def _grow(rows: DataFrame, cuts: list[list[float]]) -> list[Test]:
    rule: list[Test] = []
    while len(rule) < MAX_TESTS:
        counts = (
            rows.where(_in_bins(rule)).select("bad", F.posexplode("bins").alias("f", "b"))
            .groupBy("f", "b").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
        )
        table = {(r["f"], r["b"]): (r["p"], r["n"]) for r in counts}
        total = [sum(v[i] for (f, _), v in table.items() if f == 0) for i in (0, 1)]
        if not total[0] or not total[1]:
            break
        best, gain = None, 1e-9
        for f, bounds in enumerate(cuts):
            below = [0, 0]
            for b, bound in enumerate(bounds):
                got = table.get((f, b), (0, 0))
                below = [below[0] + got[0], below[1] + got[1]]
                for above in (False, True):
                    p, n = (total[0] - below[0], total[1] - below[1]) if above else below
                    if p:
                        g = p * (math.log2(p / (p + n)) - math.log2(total[0] / sum(total)))
                        if g > gain:
                            best, gain = Test(f, above, b, bound), g
        if best is None:
            break
        rule.append(best)
    return rule


def _prune(rows: DataFrame, rule: list[Test]) -> list[Test]:
    """The prefix of the rule with the best value on held-out rows, if precise enough."""
    if not rule:
        return []
    ends = range(1, len(rule) + 1)
    c = rows.agg(*[
        F.count_if(_in_bins(rule[:k]) & (F.col("bad") if bad else ~F.col("bad"))).alias(f"{'pn'[not bad]}{k}")
        for k in ends for bad in (True, False)
    ]).first()
    value = {k: (c[f"p{k}"] - c[f"n{k}"]) / max(1, c[f"p{k}"] + c[f"n{k}"]) for k in ends}
    k = max(ends, key=lambda k: (value[k], -k))
    p, n = c[f"p{k}"], c[f"n{k}"]
    return rule[:k] if p + n >= MIN_COVER and p >= MIN_PRECISION * (p + n) else []


def verdict(m: str, rules: list[list[Test]]) -> Column:
    """Number of the first rule that holds, from 1; 0 if the base test failed; else null."""
    values = _features(m)
    out = F.when(base_failed(m), F.lit(0))
    for k, rule in enumerate(rules, 1):
        held = F.lit(True)
        for t in rule:
            held = held & (values[t.feature] > t.bound if t.above else values[t.feature] <= t.bound)
        out = out.when(held, F.lit(k))
    return out


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with a struct ``quality_measures``, ``quality_rule`` (see ``verdict``) and
    ``quality_kept``, under these names or, if taken, with underscores in front.

    One row per input row, repeated rows included. Null and empty texts have no words,
    so they fail the base test.
    """
    rules = learn(docs, labels)
    m = fresh(docs, "quality_measures")
    rows = measured(docs, m)
    rule = fresh(docs, "quality_rule")
    rows = rows.withColumn(rule, verdict(m, rules))
    return rows.withColumn(fresh(docs, "quality_kept"), F.col(rule).isNull())


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns."""
    return judged(docs, labels).where(F.col(fresh(docs, "quality_kept"))).select(*docs.columns)
