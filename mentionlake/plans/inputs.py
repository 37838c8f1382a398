"""How the driver's tables stand in for articles, resources, markup and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.functions.text import first_sentence
from mentionlake.operators.articles import normalise_metadata
from mentionlake.operators.dictionary import explode_aliases
from mentionlake.operators.detect import find_mentions
from mentionlake.operators.score import score_mentions, train_weights
from mentionlake.operators.sentences import split_sentences
from mentionlake.operators.sizing import broadcast_if_small, spread

# The dictionary the mention queries search for, first name = display name.
DICTIONARY = [
    (1, ["MIT", "MIT License"]),
    (2, ["Apache", "Apache License"]),
    (3, ["BY-NC"]),
    (4, ["ION", "tion", "ing"]),
    (5, ["THE", "The"]),
    (6, ["example.com"]),
    (7, ["OFTHE", "of the"]),
    (8, ["ASF", "Apache License"]),
    (9, ["2.0"]),
]
CASE_SENSITIVE = ["MIT"]

# Training definitions (names, topics, ambiguous).
DEFINITIONS = [
    (["MIT", "MIT License"], ["license", "software"], None),
    (["Apache", "Apache License"], ["version", "license"], 1),
    (["The", "tion"], ["and", "was", "license"], 1),
    (["example.com"], ["license"], 0),
    (["BY-NC"], [], 1),
    (["ing"], None, None),
    (["of the"], ["edth", "thed", "inther", "the"], None),
]

# Extra aliases by short name.
EXTRA_ALIASES = [("red widget", ["RW", "widget, red", "RW"]), ("hot gear", ["H-Gear"])]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few fixed rows as a local relation, known to the planner without a job."""

    def sql(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, list):
            return f"array({', '.join(map(sql, v))})"
        return "'" + v.replace("'", "\\'") + "'" if isinstance(v, str) else str(v)

    names = ", ".join(f.split()[0] for f in schema.split(", "))
    casts = ", ".join(f"CAST({f.split()[0]} AS {f.split()[1]})" for f in schema.split(", "))
    values = ", ".join(f"({', '.join(map(sql, r))})" for r in rows)
    aliased = ", ".join(
        f"{c} AS {n}" for c, n in zip(casts.split(", "), names.split(", "))
    )
    return spark.sql(f"SELECT {aliased} FROM VALUES {values} AS t({names})")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_sentences(texts(spark, sf_dir))


def dictionary(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, DICTIONARY, "resource_id int, names array<string>")


def aliases(spark: SparkSession) -> DataFrame:
    return explode_aliases(dictionary(spark), CASE_SENSITIVE)


def resource_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as the resource table: some names absent, some blank, some padded."""
    k = F.col("p_partkey")
    return spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"), "p_partkey").select(
        k.alias("id"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit("\t")).alias("short_name"),
        F.when(k % 3 == 0, F.lit(None))
        .when(k % 3 == 1, F.col("p_name"))
        .otherwise(F.upper("p_name"))
        .alias("common_name"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.concat_ws(" ", "p_name", "p_type")).alias("full_name"),
        F.when(k % 5 == 0, 0).otherwise(1).alias("is_latest"),
    )


def extra_aliases(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, EXTRA_ALIASES, "short_name string, aliases array<string>")


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled examples: the document with its source as alias, quality as label."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id")
    marks = broadcast_if_small(table(spark, sf_dir, "labels"))
    return docs.join(marks, "doc_id").select(
        "doc_id", "text", F.col("source").alias("alias"), F.col("quality").alias("label"), "toxic"
    )


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_mentions(sentences(spark, sf_dir), aliases(spark), CASE_SENSITIVE)


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_weights(labelled_texts(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_mentions(mentions(spark, sf_dir), weights(spark, sf_dir))


# --- articles, metadata and labels ---


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(
        table(spark, sf_dir, "documents").select(
            "doc_id",
            F.concat(F.lit("PMC"), "doc_id").alias("pmcid"),
            (F.col("doc_id") % 97).cast("string").alias("pmid"),
            "text",
            (F.coalesce("n_chars", F.lit(0)) > 0).alias("has_full_text"),
        ),
        "doc_id",
    )


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages as aliases of 13 resources."""
    return table(spark, sf_dir, "benchmark").select(
        (F.col("item_id") % 13).alias("resource_id"), F.col("text").alias("alias")
    )


def definitions(spark: SparkSession) -> DataFrame:
    return literal_rows(
        spark, DEFINITIONS, "names array<string>, topics array<string>, ambiguous int"
    )


def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object per document as a search would return it: keys absent, null or
    empty in turn; the citation count is the quality label where there is one."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id")
    marks = broadcast_if_small(table(spark, sf_dir, "labels").select("doc_id", "quality"))
    k = F.col("doc_id")
    printed = F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("2024-"), k.cast("string")))
    known = F.to_json(
        F.struct(
            F.when(k % 19 == 0, None)
            .when(k % 17 == 0, "")
            .otherwise(F.concat(F.lit("PMC"), k.cast("string")))
            .alias("pmcid"),
            (k * 3).cast("string").alias("pmid"),
            F.when(k % 23 == 0, "").otherwise(first_sentence(F.col("text"))).alias("title"),
            F.concat(F.lit("2023-"), k.cast("string")).alias("firstPublicationDate"),
            F.when(k % 7 != 0, F.struct(printed.alias("printPublicationDate"))).alias("journalInfo"),
            F.when(k % 4 != 0, F.col("source")).alias("authorString"),
            F.when(k % 6 != 0, F.struct(F.col("source").alias("author"))).alias("authorList"),
        )
    )
    cited = (
        F.when(k % 3 == 0, "")
        .when(F.col("quality").isNull(), ',"citedByCount":null')
        .otherwise(F.concat(F.lit(',"citedByCount":'), F.col("quality").cast("string")))
    )
    rows = docs.join(marks, "doc_id", "left").select(
        "doc_id", known.alias("known"), cited.alias("cited")
    )
    opened = F.expr("substring(known, 1, length(known) - 1)")
    return rows.select("doc_id", F.concat(opened, "cited", F.lit("}")).alias("record"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_metadata(search_results(spark, sf_dir))


def bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id ranges of 50, every seventh missing, every tenth also listed twice as wide."""
    group = F.floor(F.col("doc_id") / 50)
    rows = table(spark, sf_dir, "documents").select(group.alias("k")).distinct()
    narrow = rows.where("k % 7 <> 6").select(
        (F.col("k") * 50).alias("start_id"), (F.col("k") * 50 + 49).alias("end_id")
    )
    wide = rows.where("k % 10 = 5").select(
        (F.col("k") * 50).alias("start_id"), (F.col("k") * 50 + 99).alias("end_id")
    )
    name = F.concat_ws("_", F.concat(F.lit("PMC"), "start_id"), F.concat(F.lit("PMC"), "end_id"))
    return narrow.unionByName(wide).withColumn("bundle", F.concat(name, F.lit(".xml.gz")))


def table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as one table: a row per line number, four columns as cells; cells of
    returned lines count as headers, and one cell in ten is empty."""
    lines = spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", "l_suppkey"
        ),
        "l_orderkey",
    )
    part = F.when(F.col("l_partkey") % 10 == 0, "").otherwise(F.col("l_partkey").cast("string"))
    cells = F.array(part, F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_suppkey").cast("string"))
    rows = lines.select(
        F.col("l_orderkey").alias("doc_id"),
        F.lit(0).alias("table_no"),
        (F.col("l_linenumber") - 1).alias("row_no"),
        (F.col("l_returnflag") == "R").alias("is_header"),
        F.posexplode(cells).alias("col_no", "text"),
    )
    return rows


def article_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written out as article markup with nested sections, a list, inline
    markup and a table, so that the markup job can be checked against known text."""

    def esc(c):
        out = F.replace(c, F.lit("&"), F.lit("&amp;"))
        return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    first = esc(first_sentence(F.col("text")))
    parts = [
        F.lit('<article><front><article-meta><article-id pub-id-type="pmcid">PMC'),
        F.col("doc_id").cast("string"),
        F.lit("</article-id><title-group><article-title>"), first,
        F.lit("</article-title></title-group><abstract><title>Abstract</title><p>"), first,
        F.lit("</p></abstract></article-meta></front><body><p>outside</p><sec><title>"),
        F.col("source"),
        F.lit("</title><p> "), esc(F.col("text")),
        F.lit("<list><list-item><p>"), F.col("lang"),
        F.lit("</p></list-item></list></p><sec><title>sub</title><p>in <i>"),
        F.col("lang"),
        F.lit('</i> out</p></sec></sec><sec sec-type="orcid"><p>no</p></sec>'),
        F.lit("<sec><p>end<table-wrap><caption><p>cap</p></caption><table><tr><td>h</td></tr><tr><td>"),
        F.col("source"),
        F.lit("</td><td> </td><th>x</th></tr></table></table-wrap></p></sec></body></article>"),
    ]
    return docs.select("doc_id", F.concat(*parts).alias("xml"))
