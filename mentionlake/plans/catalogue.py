"""Every operator as a query over the driver's tables: ``name -> (spark, sf_dir) -> rows``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.functions import ids as id_functions
from mentionlake.operators import articles, blocks, classifier, detect, dictionary, phrase_index, rollup, score, subwords, training
from mentionlake.operators.sentences import learn_abbreviations, split_learned, split_rows, split_sentences
from mentionlake.operators.sizing import broadcast_if_small, spread
from mentionlake.plans import inputs
from mentionlake.session import run_folder
from mentionlake.sources import fact_store, pruned, readers, writers
from mentionlake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PART_CASE_SENSITIVE = ["red widget", "hot gear"]
LISTED_IDS = ["PMC1", "PMC5", " PMC5", "PMC42", "", "PMC999999999"]
VERSION = {"name": "full text run", "date": "2025-01-31", "user": "analyst"}
SHARDS = 37
INDEX_BUCKETS = 16
CHUNKS = 7
MOST_LISTED = 5_000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- dictionary ---


def _part_lists(spark, sf):
    resources = dictionary.latest_resources(inputs.resource_table(spark, sf))
    return dictionary.alias_lists(resources, inputs.extra_aliases(spark))


def _part_aliases(spark, sf):
    return dictionary.explode_aliases(_part_lists(spark, sf), PART_CASE_SENSITIVE)


@query
def src_resources(spark, sf):
    return dictionary.latest_resources(inputs.resource_table(spark, sf))


@query
def src_dictionary(spark, sf):
    one = F.create_map(F.col("resource_id").cast("string"), F.col("names"))
    stored = _part_lists(spark, sf).select(F.to_json(one).alias("value"))
    return readers.parse_dictionary(stored).select(
        F.col("resource_id").cast("bigint").alias("resource_id"),
        F.array_join("names", "|").alias("names"),
    )


@query
def src_json_events(spark, sf):
    e = inputs.table(spark, sf, "events").select("event_id", "user_id", "props")
    k = F.get_json_object("props", "$.k")
    i = F.concat(F.lit('{"id":"PMC'), F.col("user_id").cast("string"), F.lit('"'))
    line = (
        F.when(F.col("event_id") % 7 == 0, F.concat(i, F.lit(',"meta":{"k":'), k, F.lit("}}")))
        .when(F.col("event_id") % 11 == 0, F.concat(i, F.lit(',"k":')))
        .when(F.col("event_id") % 13 == 0, F.concat(i, F.lit(',"meta":{},"k":'), k, F.lit("}")))
        .otherwise(F.concat(i, F.lit(',"k":'), k, F.lit("}")))
    )
    records = articles.latest_metadata(e.select(line.alias("value"), "event_id"), ["event_id"])
    return records.select("id", F.get_json_object("record", "$.k").cast("bigint").alias("k"))


@query
def src_labelled_union(spark, sf):
    rows = inputs.labelled_texts(spark, sf).select("doc_id", "alias", "text", "label", "toxic")

    def part(name):
        return rows.select(
            F.lit(name).alias("resource_name"),
            "alias",
            F.col("label" if name == "quality" else name).alias("label"),
            F.concat(F.lit("PMC"), "doc_id").alias("pmcid"),
            F.col("text").alias("paragraph_text"),
        )

    return readers.union_labelled(part("quality"), part("toxic"))


@query
def alias_list(spark, sf):
    return _part_lists(spark, sf).select("resource_id", F.array_join("names", "|").alias("names"))


@query
def alias_explode(spark, sf):
    return _part_aliases(spark, sf)


@query
def alias_patterns(spark, sf):
    return dictionary.alias_patterns(_part_aliases(spark, sf)).select(
        "resource_id", "alias_pos", "alias", "case_sensitive", "norm", "core", "literal", "plain"
    )


@query
def name_to_id_last_wins(spark, sf):
    lists = _part_lists(spark, sf).withColumn("resource_pos", F.col("resource_id"))
    return dictionary.name_to_id(dictionary.explode_aliases(lists, position="resource_pos"))


# --- articles ---


@query
def candidate_articles(spark, sf):
    return articles.candidate_articles(inputs.articles(spark, sf), inputs.phrases(spark, sf))


@query
def phrase_index_hits(spark, sf):
    """Benchmark passages and the search dictionary, looked up in an index of the texts."""
    path = run_folder(spark, "phrase-index")
    texts = inputs.articles(spark, sf).where("has_full_text").select("doc_id", "text")
    phrase_index.build_index(texts, path, buckets=INDEX_BUCKETS, slices=2)
    names = inputs.phrases(spark, sf).select("alias").union(inputs.aliases(spark).select("alias")).distinct()
    return phrase_index.search_index(spark, path, names, INDEX_BUCKETS)


@query
def include_ids(spark, sf):
    arts = inputs.articles(spark, sf)
    found = articles.candidate_articles(arts, inputs.phrases(spark, sf))
    searched = found.select(id_functions.full_id(F.col("doc_id")).alias("pmcid"))
    ids = inputs.literal_rows(spark, [(i,) for i in LISTED_IDS], "pmcid string")
    listed = articles.listed_articles(arts, ids).select("pmcid")
    return searched.unionByName(listed).distinct()


@query
def normalise_metadata(spark, sf):
    return inputs.metadata(spark, sf)


def _gate(spark, sf, metadata=None):
    wanted = inputs.table(spark, sf, "documents").select(
        id_functions.full_id(F.col("doc_id")).alias("pmcid")
    )
    return articles.check_completeness(wanted, inputs.metadata(spark, sf) if metadata is None else metadata)


@query
def completeness_gate(spark, sf):
    return _gate(spark, sf)[0].select("pmcid", "title", "authorList", "citedByCount")


@query
def gate_rejects(spark, sf):
    return _gate(spark, sf)[1]


@query
def id_normalise(spark, sf):
    k = F.col("doc_id")
    raw = F.when(k % 3 == 0, F.concat(F.lit("PMC"), k)).otherwise(k.cast("string"))
    rows = inputs.table(spark, sf, "documents").select(raw.alias("raw_id"))
    c = F.col("raw_id")
    return rows.select(
        "raw_id",
        id_functions.bare_id(c).alias("bare_id"),
        id_functions.full_id(c).alias("full_id"),
        id_functions.id_number(c).alias("id_num"),
    )


@query
def filename_parse(spark, sf):
    k = F.col("doc_id")
    end = (k + 49).cast("string")
    name = (
        F.when(k % 4 == 0, F.concat(F.lit("PMC"), k, F.lit("_PMC"), end, F.lit(".xml")))
        .when(k % 4 == 1, F.concat(F.lit("PMC"), k, F.lit("_PMC"), end, F.lit(".xml.gz")))
        .when(k % 4 == 2, F.concat(F.lit("pmc_idlist.chunk_"), k, F.lit(".txt")))
        .otherwise(F.concat(F.lit("PMC"), k, F.lit(".xml")))
    )
    return articles.parse_file_names(inputs.table(spark, sf, "documents").select(name.alias("name")))


def _numbered(spark, sf):
    return inputs.table(spark, sf, "documents").select(
        id_functions.full_id(F.col("doc_id")).alias("pmcid"), F.col("doc_id").alias("id_num")
    )


@query
def range_join_bundles(spark, sf):
    rows = articles.assign_bundles(_numbered(spark, sf), inputs.bundles(spark, sf), width=32)
    return rows.select("pmcid", "bundle", "start_id", "end_id")


def _searched_ids(spark, sf):
    """Ids of the articles that the phrase search finds."""
    found = articles.candidate_articles(inputs.articles(spark, sf), inputs.phrases(spark, sf))
    return found.select(id_functions.full_id(F.col("doc_id")).alias("pmcid"))


@query
def bundle_articles(spark, sf):
    """The searched articles, read from the bundles that hold them: every article is
    written to all bundles whose range holds its id, and few bundles are opened again."""
    ranges = inputs.bundles(spark, sf)
    width = 50
    blocks = ranges.withColumn("b", F.explode(F.sequence(F.floor(F.col("start_id") / width), F.floor(F.col("end_id") / width))))
    docs = inputs.article_xml(spark, sf).withColumn("b", F.floor(F.col("doc_id") / width))
    held = docs.join(broadcast_if_small(blocks), "b").select(id_functions.full_id(F.col("doc_id")).alias("pmcid"), "xml", "bundle")
    folder = run_folder(spark, "articles")
    pruned.write_bundles(held, folder)
    rows = pruned.read_wanted_articles(spark, folder, _searched_ids(spark, sf), width)
    return rows.select("pmcid", "bundle", F.md5(F.col("xml").cast("binary")).alias("xml_md5"))


@query
def metadata_lookup(spark, sf):
    """The searched articles' records, from their shards only."""
    folder = run_folder(spark, "metadata")
    writers.write_metadata_shards(inputs.metadata(spark, sf), folder, SHARDS, files_per_shard=1)
    rows = pruned.lookup_metadata(spark, folder, _searched_ids(spark, sf), SHARDS)
    return rows.select("pmcid", "title", "firstPublicationDate", "citedByCount")


@query
def source_cascade(spark, sf):
    docs = inputs.table(spark, sf, "documents").select("doc_id", "lang", "source").withColumn(
        "pmcid", id_functions.full_id(F.col("doc_id"))
    )
    sources = [
        ("local", docs.where(F.col("lang") == "en")),
        ("remote", docs.where(F.col("source").isin("src1", "src2", "src3", "src4", "src5"))),
        ("api", docs.where(F.col("lang").isin("en", "fr"))),
    ]
    picked, none = articles.cascade_sources(docs.select("pmcid"), sources)
    return picked.select("pmcid", "source").unionByName(none.withColumn("source", F.lit("none")))


def _arrivals(spark, sf):
    return inputs.table(spark, sf, "events").select(
        F.concat(F.lit("PMC"), "user_id").alias("pmcid"),
        F.col("ts").alias("seen_at"),
        F.col("event_type").alias("resource_id"),
        F.col("event_id").alias("resource_pos"),
    )


@query
def first_seen(spark, sf):
    return articles.first_seen(_arrivals(spark, sf)).select("pmcid", "resource_pos", "resource_id")


@query
def limit_per_resource(spark, sf):
    hits = _arrivals(spark, sf).select("resource_id", "pmcid").distinct()
    return articles.limit_per_resource(hits, 20)


@query
def md5_shard(spark, sf):
    ids = _numbered(spark, sf).select("pmcid")
    return articles.cluster_by_shard(ids, SHARDS).select("pmcid", "shard", "shard_file")


@query
def numeric_chunks(spark, sf):
    # Some ids have no number and some share one; none may be lost.
    kind, n = F.col("doc_id") % 50, F.col("doc_id")
    name = F.when(kind == 7, F.concat(F.lit("PMCX"), n)).when(kind == 8, F.concat(F.lit("PMC0"), n - 2))
    ids = inputs.table(spark, sf, "documents").select(name.otherwise(F.concat(F.lit("PMC"), n)).alias("pmcid"))
    return articles.assign_chunks(ids, CHUNKS).select("pmcid", "rank", "chunk")


@query
def single_article(spark, sf):
    one = articles.pick_publication(inputs.articles(spark, sf), "13")
    found = detect.find_in_texts(one, inputs.aliases(spark), inputs.CASE_SENSITIVE)
    named = found.join(F.broadcast(one.select("doc_id", "pmcid", "pmid")), "doc_id")
    return named.groupBy("pmcid", "pmid", "resource_name", "alias").agg(
        F.count("*").alias("num_mentions")
    )


# --- text ---


@query
def sentences(spark, sf):
    return inputs.sentences(spark, sf)


@query
def abbreviations_learned(spark, sf):
    return learn_abbreviations(inputs.texts(spark, sf), most=MOST_LISTED)


@query
def sentences_learned(spark, sf):
    texts = inputs.texts(spark, sf)
    return split_learned(texts, learn_abbreviations(texts))


@query
def extract_blocks_html(spark, sf):
    return blocks.page_blocks(inputs.table(spark, sf, "pages"))


@query
def list_items_html(spark, sf):
    return blocks.page_list_items(inputs.table(spark, sf, "pages"))


@query
def extract_blocks_xml(spark, sf):
    found = blocks.extract_blocks(inputs.article_xml(spark, sf))
    return found.select(F.col("doc_id").cast("bigint").alias("doc_id"), "block_no", "kind", "depth", "text")


@query
def training_blocks_xml(spark, sf):
    found = blocks.training_blocks(inputs.article_xml(spark, sf))
    rows = F.array_sort(F.collect_list(F.struct("block_no", "part_no", "text")))
    each = found.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(rows.alias("b"))
    each = each.select("doc_id", F.posexplode(F.transform("b", lambda b: b["text"])).alias("place", "text"))
    return each.withColumn("place", F.col("place").cast("bigint"))


@query
def table_flatten(spark, sf):
    return blocks.flatten_tables(inputs.table_cells(spark, sf)).select("doc_id", "text")


@query
def assemble_text(spark, sf):
    turns = inputs.table(spark, sf, "conversations").select(
        F.col("conv_id").alias("doc_id"),
        F.col("turn").alias("block_no"),
        F.when(F.col("role") == "system", "table").otherwise("section").alias("kind"),
        "text",
    )
    return blocks.assemble_text(turns)


# --- mentions ---


@query
def mentions_ci_cs(spark, sf):
    pairs = detect.match_aliases(inputs.sentences(spark, sf), inputs.aliases(spark))
    return pairs.select("doc_id", "sent_no", "resource_id", "resource_name", "alias")


@query
def mentions_consuming(spark, sf):
    docs = split_sentences(inputs.texts(spark, sf)).withColumn(
        "doc_id", F.concat(F.lit("D"), "doc_id")
    )
    # Turns of one role stand for tables, which are searched line by line.
    turn = F.concat(F.lit("C"), "conv_id", F.lit("-"), "turn").alias("doc_id")
    turns = inputs.table(spark, sf, "conversations").select(turn, "role", "text")
    tables = split_rows(turns.where(F.col("role") == "system"))
    spoken = split_sentences(turns.where(F.col("role") != "system"))
    rows = docs.unionByName(tables).unionByName(spoken)
    found = detect.find_mentions(
        rows, inputs.aliases(spark), inputs.CASE_SENSITIVE, boundary="consuming"
    )
    return found.select("doc_id", "sent_no", "resource_name", "alias")


@query
def mentions_large_dictionary(spark, sf):
    """Part names and the search dictionary in texts and part descriptions, by the shuffled
    path for dictionaries that are too large to broadcast."""
    parts = spread(inputs.table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_brand"), "p_partkey").select(
        (-1 - F.col("p_partkey")).alias("doc_id"), F.concat_ws(" ", F.lit("A"), "p_name", "p_type", F.lit("of"), "p_brand").alias("text")
    )
    texts = inputs.texts(spark, sf).unionByName(parts)
    fields = ["resource_id", "resource_name", "alias", "alias_pos", "case_sensitive"]
    names = _part_aliases(spark, sf).select(*fields).unionByName(inputs.aliases(spark).select(*fields))
    found = detect.match_aliases(split_sentences(texts), names, max_rows=0)
    return found.select("doc_id", "sent_no", "resource_id", "resource_name", "alias")


def _suppressed(spark, sf):
    pairs = detect.match_aliases(inputs.sentences(spark, sf), inputs.aliases(spark))
    return detect.suppress_substrings(pairs)


@query
def substring_suppression(spark, sf):
    return _suppressed(spark, sf).select("doc_id", "sent_no", "resource_name", "alias")


@query
def volume_recheck(spark, sf):
    rows = detect.recheck_volume(_suppressed(spark, sf), inputs.CASE_SENSITIVE)
    return rows.select("doc_id", "sent_no", "resource_name", "alias", "alias_hits")


@query
def mentions_dedup(spark, sf):
    return inputs.mentions(spark, sf)


# --- scores ---


@query
def nb_weights(spark, sf):
    return inputs.weights(spark, sf)


@query
def score_mentions(spark, sf):
    return inputs.scored(spark, sf).select(
        "doc_id", "sent_no", "resource_name", "alias", "prediction", "confidence"
    )


@query
def ranked_mentions(spark, sf):
    return rollup.rank_mentions(inputs.scored(spark, sf)).select(
        "doc_id", "sent_no", "resource_name", "alias", "prediction", "confidence", "rank_in_article"
    )


@query
def eval_metrics(spark, sf):
    rows = training.split_by_hash(inputs.labelled_texts(spark, sf), "doc_id")
    weights = score.train_weights(rows.where(F.col("split") == "train"))
    test = rows.where(F.col("split") == "test").select(
        "doc_id", F.col("text").alias("sentence"), "alias", "label"
    )
    return score.eval_metrics(score.score_mentions(test, weights))


@query
def confidence_bands(spark, sf):
    return score.band_counts(inputs.scored(spark, sf))


@query
def publication_verdict(spark, sf):
    return score.publication_verdict(
        inputs.table(spark, sf, "documents"), inputs.scored(spark, sf)
    )


# --- roll-ups ---


@query
def mentions_summary(spark, sf):
    return rollup.summarise(inputs.scored(spark, sf))


@query
def token_matches(spark, sf):
    rows = rollup.summarise(inputs.scored(spark, sf), sentences=True)
    return rows.select("doc_id", "resource_name", "alias", "token_matches")


@query
def summary_by_resource(spark, sf):
    return rollup.summarise(inputs.scored(spark, sf), keys=["resource_name"])


@query
def prediction_counts(spark, sf):
    return rollup.prediction_counts(inputs.scored(spark, sf))


def _partial_counts(spark, sf):
    rows = inputs.scored(spark, sf).withColumn("chunk", F.col("doc_id") % CHUNKS)
    return rollup.prediction_counts(rows, ["chunk", "resource_name", "alias", "prediction"])


@query
def specificity_merge(spark, sf):
    return rollup.merge_counts(_partial_counts(spark, sf))


@query
def specificity_scores(spark, sf):
    return rollup.specificity(rollup.prediction_counts(inputs.scored(spark, sf)))


@query
def top_specificity(spark, sf):
    return rollup.top_specificity(specificity_scores(spark, sf), 5)


@query
def mention_counters(spark, sf):
    return rollup.mention_counters(inputs.scored(spark, sf))


@query
def mention_sketches(spark, sf):
    """Distinct articles of each resource, from sketches kept by chunk and merged."""
    folder = run_folder(spark, "sketches")
    inputs.scored(spark, sf).select("doc_id", "resource_name").write.parquet(f"{folder}/scored")
    scored = spark.read.parquet(f"{folder}/scored").withColumn("chunk", F.col("doc_id") % CHUNKS)
    path = f"{folder}/partials"
    rollup.sketch_counters(scored, ["chunk", "resource_name"]).write.parquet(path)
    merged = rollup.estimated_counters(rollup.merge_sketches(spark.read.parquet(path), ["resource_name"]))
    exact = scored.groupBy("resource_name").agg(F.count_distinct("doc_id").alias("articles"))
    near = F.abs(F.col("distinct_estimate") - F.col("articles")) <= 3 * rollup.sketch_error() * F.col("articles")
    return merged.join(exact, "resource_name").select("resource_name", "mentions", "articles", near.alias("within_error"))


@query
def fact_mentions(spark, sf):
    """Facts of all articles; an earlier run had stored those of the first resources."""
    scored = inputs.scored(spark, sf).withColumn("pmcid", id_functions.full_id(F.col("doc_id")))
    summary = rollup.summarise(scored, ["pmcid", "resource_id", "resource_name", "alias"])
    out = run_folder(spark, "facts")
    inputs.metadata(spark, sf).write.parquet(f"{out}/metadata")
    facts = rollup.mention_facts(summary, _gate(spark, sf, spark.read.parquet(f"{out}/metadata"))[0], VERSION)
    facts.write.parquet(f"{out}/staged")
    facts = spark.read.parquet(f"{out}/staged")
    writers.append_facts(facts.where(F.col("resource_id") <= 4), f"{out}/rows")
    writers.append_facts(facts, f"{out}/rows")
    return spark.read.parquet(f"{out}/rows").select(*facts.columns)


def _stored_facts(spark, sf):
    """Facts of all articles as a table, and a stream of its files, one to a batch."""
    scored = inputs.scored(spark, sf).withColumn("pmcid", id_functions.full_id(F.col("doc_id")))
    summary = rollup.summarise(scored, ["pmcid", "resource_id", "resource_name", "alias"])
    out = run_folder(spark, "fact-store")
    inputs.metadata(spark, sf).write.parquet(f"{out}/metadata")
    metadata = spark.read.parquet(f"{out}/metadata")
    facts = rollup.mention_facts(summary, _gate(spark, sf, metadata)[0], VERSION)
    facts.write.parquet(f"{out}/given")
    stream = spark.readStream.schema(facts.schema).parquet(f"{out}/given")
    # The second stream knows nothing of the first and brings all facts again.
    for name in ("first", "again"):
        jobs.fact_store_stream(stream, f"{out}/store", f"{out}/state-{name}", metadata, name=name).awaitTermination()
    return out, facts.schema, metadata.schema


@query
def fact_stream(spark, sf):
    out, schema, _ = _stored_facts(spark, sf)
    return fact_store.read_part(spark, f"{out}/store/facts", schema).drop("bucket")


@query
def publications_stored(spark, sf):
    """All metadata fields of the articles that have facts."""
    out, _, schema = _stored_facts(spark, sf)
    return fact_store.read_part(spark, f"{out}/store/publications", schema).drop("bucket")


# --- training data ---


@query
def trained_scores(spark, sf):
    """The labelled examples under a classifier trained on them, stored and loaded."""
    examples = inputs.labelled_texts(spark, sf)
    path = f"{run_folder(spark, 'classifier')}/model"
    classifier.save_classifier(classifier.train_classifier(examples), path)
    rows = classifier.score_trained(examples, classifier.load_classifier(path), "text")
    return rows.select("doc_id", "alias", "label", "prediction", F.round("confidence", 3).alias("confidence"))


@query
def block_labels(spark, sf):
    rows = training.label_blocks(inputs.articles(spark, sf), inputs.definitions(spark))
    return rows.select("resource_name", "alias", "label", "article_topic_match", "doc_id", "block_no")


@query
def article_topic(spark, sf):
    return training.article_topic(inputs.articles(spark, sf), inputs.definitions(spark))


@query
def quota_sample(spark, sf):
    labelled = training.label_blocks(inputs.articles(spark, sf), inputs.definitions(spark))
    staged = f"{run_folder(spark, 'labelled')}/rows"
    labelled.write.parquet(staged)
    return training.quota_sample(spark.read.parquet(staged))


@query
def model_input(spark, sf):
    rows = inputs.labelled_texts(spark, sf).withColumnRenamed("text", "paragraph_text")
    return training.with_model_input(rows).select("doc_id", "input_text", "label")


@query
def token_windows(spark, sf):
    rows = inputs.labelled_texts(spark, sf).select("doc_id", "label", "text")
    cut = training.token_windows(rows)
    return cut.select(
        "doc_id", "label", "window_no", F.array_join("window", " ").alias("window"), "n_tokens", "padding"
    )


@query
def subword_windows(spark, sf):
    """Windows of the labelled examples with a probability each, by a classifier trained on
    the windows."""
    import public_tokenizers

    rows = inputs.labelled_texts(spark, sf).select("doc_id", "alias", "label", "text")
    folder = run_folder(spark, "windows")
    subwords.subword_windows(rows, public_tokenizers.path("word_bpe_49k.json")).write.parquet(f"{folder}/rows")
    windows = spark.read.parquet(f"{folder}/rows")
    model = classifier.train_classifier(windows.withColumnRenamed("window", "text"))
    return classifier.score_trained(windows, model, "window").select(
        "doc_id", "alias", "label", "window_no", "n_tokens", "padding", "ids", "window", "prediction", F.round("confidence", 3).alias("confidence")
    )


@query
def train_test_first_n(spark, sf):
    rows = inputs.table(spark, sf, "documents").select("doc_id", "source")
    return training.split_first_n(rows, "doc_id", 300)


@query
def train_test_hash(spark, sf):
    rows = inputs.table(spark, sf, "documents").select("doc_id", "source")
    return training.split_by_hash(rows, "doc_id")


@query
def label_order(spark, sf):
    rows = inputs.labelled_texts(spark, sf).select(
        F.lit("quality").alias("resource_name"),
        "alias",
        "label",
        (F.col("toxic") == 1).alias("article_topic_match"),
        id_functions.full_id(F.col("doc_id")).alias("pmcid"),
    )
    return training.order_by_label(rows)


# --- streams; each runs to the end of what has arrived, then its output is read ---


def _stream(spark, sf, name):
    """The table as a stream of files: a folder of part files, or the one file."""
    path = f"{sf}/{name}.parquet"
    stored = spark.read.parquet(path)
    first = stored.select("_metadata.file_name").first()
    reader = spark.readStream.schema(stored.schema)
    if first and first[0] == f"{name}.parquet":
        return reader.option("pathGlobFilter", first[0]).parquet(sf)
    return reader.parquet(path)


@query
def first_seen_stream(spark, sf):
    arrivals = _stream(spark, sf, "events").select(
        F.concat(F.lit("PMC"), "user_id").alias("pmcid"),
        F.col("ts").cast("timestamp").alias("seen_at"),
        "event_id",
    )
    out = run_folder(spark, "first-seen")
    fresh = jobs.first_seen_stream(arrivals)
    jobs.write_stream(fresh, f"{out}/rows", f"{out}/state").awaitTermination()
    return spark.read.schema(fresh.schema).parquet(f"{out}/rows").select("pmcid")


@query
def first_record_stream(spark, sf):
    arrivals = _stream(spark, sf, "events").select(
        F.concat(F.lit("PMC"), "user_id").alias("pmcid"), F.col("ts").cast("timestamp").alias("seen_at"), "event_id", "event_type"
    )
    out = run_folder(spark, "first-record")
    jobs.first_record_stream(arrivals, f"{out}/rows", f"{out}/state").awaitTermination()
    return jobs.first_records(spark, f"{out}/rows").select("pmcid", "event_id", "event_type")


@query
def mentions_stream(spark, sf):
    out = run_folder(spark, "mentions")
    arriving = _stream(spark, sf, "documents").select("doc_id", "text")
    jobs.mentions_stream(
        arriving, inputs.aliases(spark), inputs.CASE_SENSITIVE, f"{out}/rows", f"{out}/state"
    ).awaitTermination()
    rows = spark.read.parquet(f"{out}/rows")
    return rows.select("doc_id", "sent_no", "resource_name", "alias")


@query
def counts_stream(spark, sf):
    out = run_folder(spark, "counts")
    inputs.weights(spark, sf).write.parquet(f"{out}/weights")
    arriving = _stream(spark, sf, "documents").select("doc_id", "text")
    jobs.counts_stream(
        arriving,
        inputs.aliases(spark),
        inputs.CASE_SENSITIVE,
        spark.read.parquet(f"{out}/weights"),
        f"{out}/rows",
        f"{out}/state",
    ).awaitTermination()
    return jobs.current_specificity(spark, f"{out}/rows")


@query
def specificity_stream(spark, sf):
    out = run_folder(spark, "specificity")
    scored = inputs.scored(spark, sf).select("resource_name", "alias", "prediction")
    scored.write.parquet(f"{out}/scored")
    arriving = spark.readStream.schema(scored.schema).option("maxFilesPerTrigger", 64).parquet(f"{out}/scored")
    jobs.specificity_stream(arriving, f"{out}/rows", f"{out}/state").awaitTermination()
    return jobs.streamed_specificity(spark, f"{out}/rows")
