"""Article ids and metadata: search, first-seen, shards, chunks, gates, bundles."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.functions.ids import BUNDLE_NAME, CHUNK_NAME, id_number, leading_number, md5_shard, shard_file
from mentionlake.functions.text import phrase_text, strip
from mentionlake.operators.anchors import anchor_join
from mentionlake.operators.ranking import first_per_key, global_rank, top_n_per_key
from mentionlake.operators.sizing import MAX_ROWS, broadcast_if_small, measure

# The metadata fields of an article.
METADATA_FIELDS = [
    "id", "pmcid", "pmid", "title", "firstPublicationDate", "authorString",
    "authorList", "citedByCount", "grantsList", "keywordList", "meshHeadingList",
]


def candidate_articles(texts: DataFrame, aliases: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``resource_id, doc_id`` for articles with full text that hold any alias of the
    resource as a phrase: the same words in a row, case ignored."""
    hits = phrase_hits(texts, aliases, max_rows)
    return hits.select("resource_id", "doc_id").distinct()


def phrase_hits(texts: DataFrame, aliases: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Each article (``doc_id, text, has_full_text``) with each alias it holds as a
    phrase: ``doc_id, text`` and the columns of ``aliases``, once per alias and resource.

    A phrase is looked up by its longest word, so only texts with that word are
    compared. With a broadcast alias table texts are neither shuffled nor joined back.
    """
    phrases = (
        aliases.where(F.col("alias") != "")
        .dropDuplicates(["resource_id", "alias"])
        .withColumn("phrase", phrase_text(F.col("alias")))
        .where(F.trim("phrase") != "")
    )
    by_length = F.transform(
        F.split("phrase", " "), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))
    )
    phrases = phrases.withColumn("anchor", F.array_max(by_length)["w"])
    rows = texts.where("has_full_text").select(
        "doc_id", "text", F.coalesce(phrase_text(F.col("text")), F.lit("")).alias("body")
    )
    rows = rows.withColumn("words", F.array_distinct(F.split("body", " ")))
    small = measure(phrases, max_rows).fits
    pairs = anchor_join(rows, ["doc_id"], F.col("words"), phrases, small)
    return pairs.where(F.contains("body", "phrase")).select("doc_id", "text", *aliases.columns)


def listed_articles(articles: DataFrame, ids: DataFrame) -> DataFrame:
    """Articles with full text whose id is named in ``ids`` (``pmcid``), however many."""
    wanted = ids.select(strip(F.col("pmcid")).alias("pmcid")).where("pmcid <> ''").distinct()
    return articles.where("has_full_text").join(wanted, "pmcid", "left_semi").select(*articles.columns)


def first_seen(records: DataFrame, order: Sequence[str] = ("seen_at", "resource_pos")) -> DataFrame:
    """One record per article over all resources: the one that arrived first."""
    return first_per_key(records, ["pmcid"], [F.col(c) for c in order])


def limit_per_resource(hits: DataFrame, n: int) -> DataFrame:
    """At most ``n`` articles per resource, lowest ids first; 0 keeps all."""
    if n <= 0:
        return hits
    return top_n_per_key(hits, ["resource_id"], [id_number(F.col("pmcid")), F.col("pmcid")], n)


def assign_shards(ids: DataFrame, shards: int = 128) -> DataFrame:
    shard = md5_shard(F.col("pmcid"), shards)
    return ids.withColumn("shard", shard).withColumn(
        "shard_file", shard_file(F.col("shard"), shards)
    )


def cluster_by_shard(ids: DataFrame, shards: int = 128) -> DataFrame:
    """Rows of a shard next to each other, for writing or shard-wise lookups."""
    rows = assign_shards(ids, shards).repartitionByRange("shard", "pmcid")
    return rows.sortWithinPartitions("shard", "pmcid")


def assign_chunks(ids: DataFrame, chunks: int) -> DataFrame:
    """Distinct ids in numeric order cut into ``chunks`` of ``ceil(total / chunks)``; the
    last one takes what is left. No chunks means one.

    The number is the digits that follow the prefix: none counts as 0, too many as the
    largest number. Ids of equal number follow each other by name, so every id has a rank.
    """
    rows = ids.select("pmcid").distinct().withColumn("id_num", leading_number(F.col("pmcid")))
    ranked = global_rank(rows, "id_num", "rank", tie="pmcid")
    if chunks <= 1:
        return ranked.withColumn("chunk", F.lit(1).cast("bigint"))
    per = F.ceil(rows.agg(F.count("*")).scalar() / F.lit(chunks))
    chunk = F.least(F.floor(F.col("rank") / per), F.lit(chunks - 1)) + 1
    return ranked.withColumn("chunk", chunk.cast("bigint"))


def normalise_metadata(records: DataFrame, record: str = "record") -> DataFrame:
    """Search results (one JSON object per row) to the fixed metadata fields.

    Records without an article id are dropped. The print date wins over the first
    publication date unless empty. Defaults replace absent keys only: an explicit null
    stays null. Nested lists stay JSON text, nothing downstream looks inside.
    """
    schema = (
        "pmcid string, pmid string, title string, firstPublicationDate string, "
        "journalInfo struct<printPublicationDate: string>, authorString string, "
        "authorList string, citedByCount bigint, grantsList string, keywordList string, "
        "meshHeadingList string"
    )
    keys = F.json_object_keys(record)
    rows = records.select(F.from_json(record, schema).alias("r"), keys.alias("keys"))

    def default(name: str, value) -> Column:
        present = F.array_contains("keys", name)
        return F.when(present, F.col(f"r.{name}")).otherwise(F.lit(value)).alias(name)

    first = F.col("r.firstPublicationDate")
    printed = F.nullif(F.col("r.journalInfo.printPublicationDate"), F.lit(""))
    return rows.where(F.col("r.pmcid") != "").select(
        F.col("r.pmcid").alias("id"),
        "r.pmcid",
        "r.pmid",
        "r.title",
        F.coalesce(printed, first).alias("firstPublicationDate"),
        default("authorString", ""),
        default("authorList", "{}"),
        default("citedByCount", 0),
        default("grantsList", "{}"),
        default("keywordList", "{}"),
        default("meshHeadingList", "{}"),
    )


def latest_metadata(lines: DataFrame, order: Sequence[str]) -> DataFrame:
    """Stored metadata lines (``value``) to one record per id, the last in ``order``.
    A record may be wrapped in ``meta``; lines that are not JSON are skipped."""
    parsed = lines.withColumn("rec", F.try_parse_json("value"))
    rec_id = F.try_variant_get("rec", "$.id", "string")
    meta = F.try_variant_get("rec", "$.meta", "string")
    wrapped = meta.isNotNull() & ~meta.isin("", "{}", "[]", "0", "false", "null")
    rows = parsed.where(rec_id.isNotNull()).select(
        rec_id.alias("id"),
        F.when(wrapped, meta).otherwise(F.to_json("rec")).alias("record"),
        F.struct(*order).alias("_o"),
    )
    return rows.groupBy("id").agg(F.max_by("record", "_o").alias("record"))


def _missing(c: str) -> Column:
    return F.coalesce(F.col(c).isin("", "{}", "[]"), F.lit(True))


def gate_reason() -> Column:
    """Why an article is not written, or null; zero citations are fine."""
    return (
        F.when(F.col("_found").isNull(), "no metadata")
        .when(_missing("title"), "no title")
        .when(_missing("authorList"), "no authors")
        .when(F.col("citedByCount").isNull(), "no citation count")
    )


def check_completeness(ids: DataFrame, metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles whose metadata is complete, and the rejected ones with the reason."""
    rows = ids.join(metadata.withColumn("_found", F.lit(True)), "pmcid", "left")
    rows = rows.withColumn("reason", gate_reason())
    passed = rows.where(F.col("reason").isNull()).drop("_found", "reason")
    return passed, rows.where(F.col("reason").isNotNull()).select("pmcid", "reason")


def parse_file_names(names: DataFrame, name: str = "name", keep: Sequence[str] = ()) -> DataFrame:
    """Chunk number (as text) of id lists, id range of bundles; null where not one. Columns
    to ``keep`` follow."""
    c = F.col(name)
    chunk = F.nullif(F.regexp_extract(c, CHUNK_NAME, 1), F.lit(""))
    start = F.regexp_extract(c, BUNDLE_NAME, 1).try_cast("bigint")
    end = F.regexp_extract(c, BUNDLE_NAME, 2).try_cast("bigint")
    return names.select(
        name, chunk.alias("chunk"), start.alias("start_id"), end.alias("end_id"), *keep
    )


def assign_bundles(
    ids: DataFrame, bundles: DataFrame, width: int = 100_000, last_listed: bool = False
) -> DataFrame:
    """The bundle holding each id: ``id_num`` within ``start_id..end_id``.

    Ranges are cut into number blocks of ``width`` so that the range test runs inside an
    equality join. Of several bundles the lowest (start, end) wins, or with
    ``last_listed`` the highest ``listing`` position.
    """
    blocks = bundles.where(F.col("start_id") <= F.col("end_id")).withColumn(
        "_b",
        F.explode(
            F.sequence(F.floor(F.col("start_id") / width), F.floor(F.col("end_id") / width))
        ),
    )
    rows = ids.withColumn("_b", F.floor(F.col("id_num") / width))
    hits = rows.join(broadcast_if_small(blocks), "_b").where(
        F.col("id_num").between(F.col("start_id"), F.col("end_id"))
    )
    order = (
        [F.desc("listing")] if last_listed else [F.col(c) for c in ("start_id", "end_id", "bundle")]
    )
    return first_per_key(hits.drop("_b"), ["pmcid"], order)


def cascade_sources(
    ids: DataFrame, sources: Sequence[tuple[str, DataFrame]]
) -> tuple[DataFrame, DataFrame]:
    """For each id the first source that has it, and the ids none has.

    The choice is made on ids alone; fetch payloads afterwards with
    :func:`fetch_payloads`, so that unused copies are never shuffled.
    """
    tagged = [
        df.select("pmcid", F.lit(i).alias("priority"), F.lit(name).alias("source"))
        for i, (name, df) in enumerate(sources)
    ]
    listed = functools.reduce(DataFrame.unionByName, tagged).join(ids, "pmcid", "left_semi")
    picked = first_per_key(listed, ["pmcid"], [F.col("priority")])
    return picked, ids.join(picked, "pmcid", "left_anti").select("pmcid")


def fetch_payloads(picked: DataFrame, sources: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    parts = [
        df.join(picked.where(F.col("source") == name).select("pmcid", "source"), "pmcid")
        for name, df in sources
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def pick_publication(articles: DataFrame, pmid: str) -> DataFrame:
    """The first article, in id order, with this pmid and a text; others are skipped."""
    rows = articles.where((F.col("pmid") == pmid) & F.col("has_full_text"))
    return rows.orderBy(id_number(F.col("pmcid")), "pmcid").limit(1)
