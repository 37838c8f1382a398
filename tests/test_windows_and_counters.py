"""Sub-word windows, mergeable counters, first records and flattened tables, each next to a plain form."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mentionlake.operators import blocks, rollup, subwords
from mentionlake.streaming import jobs

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize(("length", "overlap"), [(16, 4), (8, 0), (512, 128)])
def test_windows_hold_every_subword_once_more_where_they_overlap(spark, length, overlap):
    texts = ["", None, "one", "the quick brown fox, naïve Ωmega " * 40, " spaces  only\t\n end ", "x" * 300]
    rows = spark.createDataFrame([(i, a, t, 1) for i, t in enumerate(texts) for a in ("MIT License", None, "long alias " * 30)], "id int, alias string, text string, label int")
    got = subwords.subword_windows(rows, FILE, length=length, overlap=overlap).collect()
    plain = Tokenizer.from_file(FILE)
    for i, t in enumerate(texts):
        body = plain.encode(t or "", add_special_tokens=False).ids
        for a in ("MIT License", None, "long alias " * 30):
            cut = sorted((r for r in got if r["id"] == i and r["alias"] == a), key=lambda r: r["window_no"])
            front = plain.encode(a or "", add_special_tokens=False).ids[: length - overlap - 1]
            assert [r["window_no"] for r in cut] == list(range(len(cut)))
            assert all(r["ids"][: len(front)] == front and r["n_tokens"] == len(r["ids"]) <= length for r in cut)
            assert all(r["padding"] == length - r["n_tokens"] for r in cut) and all(r["label"] == 1 for r in cut)
            parts = [r["ids"][len(front) :] for r in cut]
            joined = parts[0] + [x for p in parts[1:] for x in p[overlap:]]
            assert joined == body
            assert all(p[-overlap:] == q[:overlap] for p, q in zip(parts, parts[1:]) if overlap)
            assert all(r["window"] in (t or "") for r in cut)


class Counted:
    """A tokenizer that notes what it encodes and how often the ids of a text are copied."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts, self.copies = tokenizer, [], 0

    def _noted(self, text, found):
        self.texts.append(text)
        noted = self

        class Found:
            token_to_chars = found.token_to_chars

            @property
            def ids(self):
                noted.copies += 1
                return found.ids

        return Found()

    def encode(self, text, **options):
        return self._noted(text, self.tokenizer.encode(text, **options))

    def encode_batch(self, texts, **options):
        return [self._noted(t, f) for t, f in zip(texts, self.tokenizer.encode_batch(texts, **options), strict=True)]


def test_a_long_text_is_encoded_and_copied_once_whatever_its_windows():
    with open(FILE, encoding="utf-8") as file:
        spec = file.read()
    text = "the quick brown\u00a0fox, nai\u0308ve \u0301\u03a9mega we'll <|endoftext|> \x0b\u3000 \u6f22\u5b57\t\n" * 300 + "x1y2" * 2000
    whole, by_word = subwords.SubwordEncoder(spec, False), subwords.SubwordEncoder(spec, True)
    plain = whole.tokenizer.encode(text, add_special_tokens=False)
    for encode in (whole, by_word):
        encode.tokenizer = Counted(encode.tokenizer)
        cut = subwords.windows_of(encode, "", text, 16, 4)
        assert len(cut) == -(-(len(plain.ids) - 16) // 12) + 1
        for k, ids, window in cut:
            places = plain.offsets[k * 12 : k * 12 + 16] if k in (0, 50, len(cut) - 1) else None
            assert list(ids) == plain.ids[k * 12 : k * 12 + 16] if places else len(ids)
            assert places is None or window == text[places[0][0] : places[-1][1]]
    assert whole.tokenizer.texts == ["", text] and whole.tokenizer.copies == 2
    assert len(by_word.tokenizer.texts) < 30 and by_word.tokenizer.copies <= len(set(by_word.tokenizer.texts))


def test_windows_refuse_columns_of_their_own_names(spark):
    with pytest.raises(ValueError, match="ids"):
        subwords.subword_windows(spark.createDataFrame([("t", "a", 1)], "text string, alias string, ids int"), FILE)


def test_merged_sketches_estimate_the_distinct_count(spark):
    rows = spark.range(60_000).select((F.col("id") % 7).alias("chunk"), (F.col("id") % 3).alias("name"), (F.col("id") % 20_000).alias("doc_id"))
    rows = rows.unionByName(spark.createDataFrame([(1, 1, None)], "chunk bigint, name bigint, doc_id bigint"))
    partials = rollup.sketch_counters(rows, ["chunk", "name"])
    merged = rollup.estimated_counters(rollup.merge_sketches(partials, ["name"])).collect()
    exact = {r["name"]: (r["m"], r["d"]) for r in rows.groupBy("name").agg(F.count("*").alias("m"), F.count_distinct("doc_id").alias("d")).collect()}
    for r in merged:
        m, d = exact[r["name"]]
        assert r["mentions"] == m and abs(r["distinct_estimate"] - d) <= 3 * rollup.sketch_error() * d


def test_first_records_over_late_and_repeated_input(spark, tmp_path):
    parts = [[("A", 5, 1), ("B", 9, 2), (None, 1, 3)], [("A", 7, 4), ("B", 2, 5), ("C", 4, 7)], [("A", 5, 1), ("A", 5, 0), ("C", 4, 6)]]
    schema = "pmcid string, t bigint, event_id int"
    done, path = [], f"{tmp_path}/in"
    for part in parts:  # one run for each arrival, restarted from the checkpoint
        done += part
        df = spark.createDataFrame(part, schema).select("pmcid", F.timestamp_seconds("t").alias("seen_at"), "event_id", F.concat(F.lit("e"), "event_id").alias("kind"))
        df.write.mode("append").parquet(path)
        stream = spark.readStream.schema(df.schema).parquet(path)
        jobs.first_record_stream(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
        want = {}
        for p, t, e in done:
            if p:
                want[p] = min(want.get(p, (t, e)), (t, e))
        got = jobs.first_records(spark, f"{tmp_path}/out")
        got = {r["pmcid"]: (r["t"], r["event_id"], r["kind"]) for r in got.select("pmcid", F.unix_seconds("seen_at").alias("t"), "event_id", "kind").collect()}
        assert got == {p: (t, e, f"e{e}") for p, (t, e) in want.items()}


def test_tables_are_flattened_in_one_exchange(spark):
    cells = [(1, 0, r, c, c == 1 and r == 2, f"{r}{c}" if (r, c) != (1, 0) else "") for r in (0, 1, 2) for c in (2, 0, 1)]
    cells = spark.createDataFrame(cells, "doc_id int, table_no int, row_no int, col_no int, is_header boolean, text string")
    tops = spark.createDataFrame([(1, 0, "top"), (2, 0, "alone"), (1, 0, "more")], "doc_id int, table_no int, text string")
    h, c = blocks.HEADER, blocks.CAPTION
    got = {r["doc_id"]: r["text"] for r in blocks.flatten_tables(cells, tops).collect()}
    assert got[1] == f"{c}more.\n{c}top.\n{h}00 | {h}01 | {h}02.\n11 | 12.\n20 | {h}21 | 22" and got[2] == f"{c}alone"
    plan = blocks.flatten_tables(cells)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_page_is_cleaned_once(spark):
    plan = blocks.page_blocks(spark.createDataFrame([(1, "<p>x</p>")], "page_id int, html string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(html") == 1
