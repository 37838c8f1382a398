"""One run over paths: resources, articles and metadata to facts and specificity.

    spark-submit --py-files mentionlake.zip mentionlake/job.py \\
        --dictionary resources.json --texts articles/ --labelled training/ \\
        --metadata metadata/ --version version.json --out out/

Texts are parquet with ``pmcid, text``; ``--bundles`` reads article bundles instead, or, with
ids asked for, what the texts lack. Ids are listed (``--ids``) or found by searching a stored
corpus for the names (``--search``); then only bundles and metadata shards that can hold
them are opened.
"""

from __future__ import annotations

import argparse
import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.operators import articles, blocks, detect, dictionary, rollup, score
from mentionlake.sources import pruned, readers, writers


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--dictionary", required=True, help="JSON object of resource id to names")
    p.add_argument("--case-sensitive", nargs="*", default=[], help="display names matched with their case")
    p.add_argument("--texts", help="parquet with pmcid, text")
    p.add_argument("--bundles", help="folder of combined article files, named by their id range")
    p.add_argument("--ids", help="lines of article ids to take; all if nothing is listed or searched")
    p.add_argument("--search", help="parquet with pmcid, text to search for the names; adds the articles found")
    p.add_argument("--per-resource", type=int, default=0, help="most articles a search takes for a resource; 0 takes all")
    p.add_argument("--labelled", help="labelled CSVs to train the scorer on")
    p.add_argument("--weights", help="stored weights, instead of --labelled")
    p.add_argument("--metadata", required=True, help="metadata lines, gzip or plain, or with --metadata-shards the shard layout")
    p.add_argument("--metadata-shards", type=int, default=0, help="number of shards of a sharded metadata folder")
    p.add_argument("--version", required=True, help="JSON object with name, date, user")
    p.add_argument("--min-confidence", type=float, default=score.MIN_CONFIDENCE)
    p.add_argument("--out", required=True)
    return p


def wanted_ids(spark: SparkSession, args: argparse.Namespace, aliases: DataFrame) -> DataFrame | None:
    """``pmcid`` of the articles asked for, listed and found; none if all are."""
    parts = []
    if args.ids:
        parts.append(readers.read_id_list(spark, args.ids).select("pmcid"))
    if args.search:
        corpus = spark.read.parquet(args.search).select(F.col("pmcid").alias("doc_id"), "text")
        corpus = corpus.withColumn("has_full_text", F.coalesce(F.length("text") > 0, F.lit(False)))
        found = articles.candidate_articles(corpus, aliases).select("resource_id", F.col("doc_id").alias("pmcid"))
        parts.append(articles.limit_per_resource(found, args.per_resource).select("pmcid"))
    if not parts:
        return None
    functools.reduce(DataFrame.unionByName, parts).distinct().write.mode("overwrite").parquet(f"{args.out}/wanted")
    return spark.read.parquet(f"{args.out}/wanted")


def _marked_up(raw: DataFrame) -> DataFrame:
    found = blocks.extract_blocks(raw.select(F.col("pmcid").alias("doc_id"), "xml"))
    return blocks.assemble_text(found).withColumnRenamed("doc_id", "pmcid").select("pmcid", "text")


def texts_of(spark: SparkSession, args: argparse.Namespace, wanted: DataFrame | None) -> DataFrame:
    """``doc_id, text`` of the articles asked for, each from the first source that has it:
    the texts, then the bundles."""
    rows = spark.read.parquet(args.texts).select("pmcid", "text") if args.texts else None
    if wanted is None:
        rows = _marked_up(readers.read_article_bundles(spark, args.bundles)) if rows is None else rows
    elif rows is None:
        rows = _marked_up(pruned.read_wanted_articles(spark, args.bundles, wanted))
    else:
        picked, rest = articles.cascade_sources(wanted, [("texts", rows)])
        rows = articles.fetch_payloads(picked, [("texts", rows)]).select("pmcid", "text")
        if args.bundles:
            rows = rows.unionByName(_marked_up(pruned.read_wanted_articles(spark, args.bundles, rest)))
    return rows.withColumnRenamed("pmcid", "doc_id")


def metadata_of(spark: SparkSession, args: argparse.Namespace, ids: DataFrame) -> DataFrame:
    if args.metadata_shards:
        return pruned.lookup_metadata(spark, args.metadata, ids, args.metadata_shards)
    lines = readers.read_metadata_lines(spark, args.metadata)
    return articles.normalise_metadata(articles.latest_metadata(lines, ["file", "block", "line"]))


def weights_of(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.weights:
        return spark.read.parquet(args.weights)
    rows = readers.union_labelled(readers.read_labelled(spark, args.labelled))
    weights = score.train_weights(rows.select(F.col("paragraph_text").alias("text"), "alias", "label"))
    weights.write.mode("overwrite").parquet(f"{args.out}/weights")
    return spark.read.parquet(f"{args.out}/weights")


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """Writes ``mentions``, ``summary``, ``counts``, ``specificity``, ``rejects`` and
    appends to ``facts`` and ``publications`` under ``--out``."""
    out = args.out.rstrip("/")
    names = readers.read_dictionary(spark, args.dictionary)
    aliases = dictionary.explode_aliases(names, args.case_sensitive)
    texts = texts_of(spark, args, wanted_ids(spark, args, aliases))
    found = detect.find_in_texts(texts, aliases, args.case_sensitive)
    score.score_mentions(found, weights_of(spark, args)).write.mode("overwrite").parquet(f"{out}/mentions")
    scored = spark.read.parquet(f"{out}/mentions")
    writers.write_summary(rollup.summarise(scored, min_confidence=args.min_confidence), f"{out}/summary")
    writers.write_counts(rollup.prediction_counts(scored), f"{out}/counts")
    counts = readers.read_counts(spark, f"{out}/counts")
    writers.write_specificity(rollup.specificity(counts), f"{out}/specificity")
    per_article = scored.withColumnRenamed("doc_id", "pmcid")
    keys = ["pmcid", "resource_id", "resource_name", "alias"]
    summary = rollup.summarise(per_article, keys, args.min_confidence)
    ids = summary.select("pmcid").distinct()
    passed, rejects = articles.check_completeness(ids, metadata_of(spark, args, ids))
    rejects.write.mode("overwrite").parquet(f"{out}/rejects")
    facts = rollup.mention_facts(summary, passed, readers.read_version(spark, args.version))
    writers.append_facts(facts, f"{out}/facts")
    writers.append_publications(facts, f"{out}/publications")


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if not (args.labelled or args.weights):
        parser().error("one of --labelled and --weights is needed")
    if not (args.texts or args.bundles):
        parser().error("one of --texts and --bundles is needed")
    run(SparkSession.builder.appName("mentionlake").getOrCreate(), args)


if __name__ == "__main__":
    main()
