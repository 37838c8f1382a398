"""The same queries in SQL for another engine, written from the rules, not from the jobs.

The SQL is brute force where the jobs are not: every sentence meets every alias.
"""

from __future__ import annotations

import re

from mentionlake.plans import catalogue, inputs

# Fixed values, written out here so that the twins share no pattern with the jobs: white
# space of any script, dashes, and the marks of a page.
WS = (
    r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
WS_LIST = "".join(map(chr, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]))
DASH = r"[-\x{2010}\x{2011}\x{2012}\x{2013}\x{2014}\x{2212}]"
PAGE_NOISE = r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->"
PAGE_ARTICLE = r"(?s)<article[^>]*>(.*?)(?:</article>|\z)"
PAGE_BODY = r"(?s)<body[^>]*>(.*?)(?:</body>|\z)"
PAGE_BLOCK = r"<(h[1-6]|p)(?:\s[^>]*)?>"
PAGE_ITEM = r"<li(?:\s[^>]*)?>"
PAGE_ITEM_END = r"(?s)</li>.*$"
PAGE_TAG = r"<[^>]*>"

ORACLES: dict[str, str] = {}


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def trim(x: str) -> str:
    return f"trim({x}, {q(WS_LIST)})"


def str_list(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]::VARCHAR[]"


def parts(text: str) -> str:
    flat = f"replace({trim(text)}, chr(10), ' ')"
    return f"string_split(regexp_replace({flat}, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1))"


def escape(x: str) -> str:
    return f"regexp_replace({x}, '([\\\\^$.|?*+()\\[\\]{{}}])', '\\\\\\1', 'g')"


def core(x: str) -> str:
    return f"replace(replace(replace({escape(x)}, '-', {q(DASH)}), ' ', {q(WS + '+')}), '\\.', '\\.?')"


def words(x: str, pattern: str = "[^a-z]+") -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '{pattern}'), lambda w: w <> '')"


def phrase(x: str) -> str:
    return f"' ' || array_to_string({words(x, '[^\\p{L}\\p{N}]+')}, ' ') || ' '"


def model_text(text: str, alias: str) -> str:
    return f"coalesce({alias}, '') || ' [SEP] ' || trim(replace(coalesce({text}, ''), chr(10), ' '))"


def features(text: str, alias: str) -> str:
    return (
        f"list_transform({words(model_text(text, alias))}, "
        "lambda w: ('0x' || substr(md5(w), 1, 4))::INT)"
    )


HASH32 = "('0x' || substr(md5('42|' || doc_id::VARCHAR), 1, 8))::BIGINT"

# --- building blocks: each is a named subquery and the names it needs ---

RESOURCES = """
resources AS (
  SELECT p_partkey AS id, ' ' || p_name || chr(9) AS short_name,
    CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN p_name ELSE upper(p_name) END AS common_name,
    CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_name || ' ' || p_type END AS full_name
  FROM part WHERE p_partkey % 5 <> 0)"""

_extra = ", ".join(f"({q(n)}, {str_list(a)})" for n, a in inputs.EXTRA_ALIASES)
LISTS = f"""{RESOURCES},
extra(short_name, more) AS (VALUES {_extra}),
cleaned AS (
  SELECT id, nullif({trim('short_name')}, '') AS s, nullif({trim('common_name')}, '') AS c,
    nullif({trim('full_name')}, '') AS f FROM resources),
lists AS (
  SELECT id AS resource_id, list_concat(
    list_filter([s, CASE WHEN c IS DISTINCT FROM s THEN c END,
      CASE WHEN f IS DISTINCT FROM s AND f IS DISTINCT FROM c THEN f END], lambda x: x IS NOT NULL),
    coalesce(more, []::VARCHAR[])) AS names
  FROM cleaned LEFT JOIN extra ON extra.short_name = s)"""

ALIASES = f"""{LISTS},
aliases AS (
  SELECT resource_id, names[1] AS resource_name, unnest(names) AS alias,
    CAST(generate_subscripts(names, 1) - 1 AS INT) AS alias_pos,
    list_contains({str_list(catalogue.PART_CASE_SENSITIVE)}, names[1]) AS case_sensitive
  FROM lists WHERE len(names) > 0)"""

SENT = f"""
sent AS (
  SELECT doc_id, sent_no, sentence FROM (
    SELECT doc_id, unnest(p) AS sentence, CAST(generate_subscripts(p, 1) - 1 AS INT) AS sent_no
    FROM (SELECT doc_id, {parts('text')} AS p FROM documents))
  WHERE sentence <> '')"""

_aliases = [(i, names[0], a, names[0] in inputs.CASE_SENSITIVE) for i, names in inputs.DICTIONARY for a in names]


def flexible(alias: str) -> str:
    """One pattern as text, so that the other engine compiles it once."""
    swap = {"-": DASH, " ": WS + "+", ".": "\\.?"}
    return "".join(swap.get(c, re.escape(c)) for c in alias)


def search(body: str, boundary: str) -> str:
    if boundary == "consuming":
        return q(f"[^A-Za-z]{body}[^A-Za-z]")
    return q(f"(^|[^A-Za-z]){body}([^A-Za-z]|$)")


def raw(source: str, boundary: str = "edge") -> str:
    """Every sentence against every alias."""
    found = []
    for i, name, alias, cs in _aliases:
        norm = alias if cs else alias.lower()
        body = re.escape(norm) if boundary == "consuming" else flexible(norm)
        subject = "sentence" if cs and boundary == "edge" else "lower(sentence)"
        found.append(
            f"SELECT doc_id, sent_no, sentence, {i} AS resource_id, {q(name)} AS resource_name, "
            f"{q(alias)} AS alias FROM {source} WHERE regexp_matches({subject}, {search(body, boundary)})"
        )
    return "raw AS MATERIALIZED (" + "\n  UNION ALL ".join(found) + ")"


def strict(boundary: str = "edge") -> str:
    cases = {a: search(re.escape(a), boundary) for _, _, a, _ in _aliases}
    whens = " ".join(f"WHEN {q(a)} THEN regexp_matches(sentence, {p})" for a, p in cases.items())
    return f"CASE alias {whens} END"


RAW = f"{SENT}, {raw('sent')}"

KEPT = """
kept AS (
  SELECT * FROM raw r WHERE NOT EXISTS (
    SELECT 1 FROM raw o WHERE o.doc_id = r.doc_id AND o.sent_no = r.sent_no
      AND lower(o.alias) <> lower(r.alias) AND contains(lower(o.alias), lower(r.alias))))"""

_listed = str_list(inputs.CASE_SENSITIVE)
CHECKED = f"""{RAW}, {KEPT},
counted AS (SELECT *, count(*) OVER (PARTITION BY doc_id, alias) AS alias_hits FROM kept),
checked AS (
  SELECT * FROM counted WHERE alias_hits <= 30 OR list_contains({_listed}, alias) OR {strict()})"""

DEDUP = f"""{CHECKED},
mentions AS MATERIALIZED (
  SELECT doc_id, min(sent_no) AS sent_no, sentence, min(resource_id) AS resource_id,
    resource_name, alias
  FROM checked WHERE sentence <> '' GROUP BY doc_id, sentence, alias, resource_name)"""

EXAMPLES = """
examples AS (
  SELECT doc_id, text, source AS alias, quality AS label, toxic FROM documents JOIN labels USING (doc_id))"""


def weights(source: str) -> str:
    return f"""
word_rows AS (SELECT label, unnest({features('text', 'alias')}) AS feature FROM {source}),
seen AS (
  SELECT feature, sum(1 - label) AS n, sum(label) AS p FROM word_rows GROUP BY feature
  UNION ALL SELECT -1, sum(1 - label), sum(label) FROM {source}),
counts AS (
  SELECT CAST(r.range AS INT) AS feature, CAST(coalesce(n, 0) AS BIGINT) AS negatives,
    CAST(coalesce(p, 0) AS BIGINT) AS positives
  FROM range(-1, 65536) r LEFT JOIN seen ON seen.feature = r.range),
weights AS (
  SELECT c.*, CASE WHEN feature < 0 THEN 0 ELSE CAST(round(1000000 * (
      ln((positives + 1.0::DOUBLE) / (tp + 65536)) - ln((negatives + 1.0::DOUBLE) / (tn + 65536)))) AS BIGINT)
    END AS weight_micro
  FROM counts c, (SELECT sum(positives) AS tp, sum(negatives) AS tn FROM counts WHERE feature >= 0))"""


def scores(source: str, keep: str) -> str:
    return f"""
pair_words AS (
  SELECT {keep}, unnest(list_concat([-1], {features('sentence', 'alias')})) AS feature FROM {source}),
logits AS (
  SELECT {keep}, sum(weight_micro) AS logit FROM pair_words JOIN weights USING (feature) GROUP BY {keep}),
probs AS (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-logit / 1000000.0::DOUBLE)) AS p1 FROM logits),
scored AS MATERIALIZED (
  SELECT {keep}, CAST(p1 > 0.5 AS INT) AS prediction,
    round(CASE WHEN p1 > 0.5 THEN p1 ELSE 1 - p1 END, 6) AS confidence FROM probs)"""


SCORED = f"""{DEDUP}, {EXAMPLES}, {weights('examples')},
{scores('mentions', 'doc_id, sent_no, sentence, resource_id, resource_name, alias')}"""

MEAN = "round(sum(CAST(round(confidence * 1000000) AS BIGINT)) / count(*) / 1000000.0::DOUBLE, 6)"
YES = "prediction = 1 AND confidence >= 0.9"

SPECIFICITY = """
spec AS (
  SELECT resource_name, alias, count(*) FILTER (prediction = 0) AS negatives,
    count(*) FILTER (prediction = 1) AS positives,
    round(count(*) FILTER (prediction = 1)::DOUBLE / count(*), 6) AS specificity
  FROM scored GROUP BY resource_name, alias)"""

PHRASES = f"""
docs AS (SELECT doc_id, {phrase('text')} AS body FROM documents WHERE coalesce(n_chars, 0) > 0),
found AS (
  SELECT DISTINCT item_id % 13 AS resource_id, doc_id
  FROM docs, benchmark b WHERE trim({phrase('b.text')}) <> '' AND contains(body, {phrase('b.text')}))"""

METADATA = f"""
facts0 AS (
  SELECT d.doc_id AS k, {parts('d.text')}[1] AS first, d.source, l.quality
  FROM documents d LEFT JOIN labels l USING (doc_id)),
metadata AS (
  SELECT 'PMC' || k AS id, 'PMC' || k AS pmcid, (k * 3)::VARCHAR AS pmid,
    CASE WHEN k % 23 = 0 THEN '' ELSE first END AS title,
    CASE WHEN k % 7 <> 0 AND k % 5 <> 0 THEN '2024-' || k ELSE '2023-' || k END AS "firstPublicationDate",
    CASE WHEN k % 4 <> 0 THEN source ELSE '' END AS "authorString",
    CASE WHEN k % 6 <> 0 THEN '{{"author":"' || source || '"}}' ELSE '{{}}' END AS "authorList",
    CASE WHEN k % 3 = 0 THEN 0 ELSE quality::BIGINT END AS "citedByCount",
    '{{}}' AS "grantsList", '{{}}' AS "keywordList", '{{}}' AS "meshHeadingList"
  FROM facts0 WHERE k % 19 <> 0 AND k % 17 <> 0),
gate AS (
  SELECT 'PMC' || d.doc_id AS pmcid, m.title, m."authorList", m."citedByCount",
    CASE WHEN m.pmcid IS NULL THEN 'no metadata'
      WHEN coalesce(m.title, '') = '' THEN 'no title'
      WHEN m."authorList" = '{{}}' THEN 'no authors'
      WHEN m."citedByCount" IS NULL THEN 'no citation count' END AS reason
  FROM documents d LEFT JOIN metadata m ON m.pmcid = 'PMC' || d.doc_id)"""

BUNDLES = """
groups AS (SELECT DISTINCT doc_id // 50 AS k FROM documents),
ranges AS (
  SELECT k * 50 AS start_id, k * 50 + 49 AS end_id FROM groups WHERE k % 7 <> 6
  UNION ALL SELECT k * 50, k * 50 + 99 FROM groups WHERE k % 10 = 5),
bundles AS (SELECT *, 'PMC' || start_id || '_PMC' || end_id || '.xml.gz' AS bundle FROM ranges)"""


def visible(x: str) -> str:
    out = (
        f"array_to_string(list_filter(list_transform(regexp_split_to_array({x}, '{PAGE_TAG}'), "
        f"lambda s: {trim('s')}), lambda s: s <> ''), '')"
    )
    for name, char in [("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")]:
        out = f"replace({out}, '&{name};', {q(char)})"
    return out


_cleaned = f"regexp_replace(html, '{PAGE_NOISE}', '', 'g')"
_marked = f"regexp_replace(body, '{PAGE_BLOCK}', chr(1) || '\\1' || chr(2), 'g')"
PAGES = f"""
cleaned AS (SELECT page_id, {_cleaned} AS clean FROM pages),
bodies AS (SELECT page_id, CASE
    WHEN regexp_matches(clean, '{PAGE_ARTICLE}') THEN array_to_string(regexp_extract_all(clean, '{PAGE_ARTICLE}', 1), '')
    WHEN regexp_matches(clean, '{PAGE_BODY}') THEN regexp_extract(clean, '{PAGE_BODY}', 1) ELSE clean END AS body
  FROM cleaned)"""

_eligible = [
    (names[0], a, [t.lower() for t in topics])
    for names, topics, mark in inputs.DEFINITIONS
    if topics and (1 if mark is None else mark) != 0
    for a in names
]
_defs = ", ".join(f"({q(n)}, {q(a)}, {str_list(t)})" for n, a, t in _eligible)
_edge = "[^\\p{L}\\p{N}_]"
_topic_case = " ".join(
    f"WHEN {q(n)} THEN regexp_matches(lower(sentence), "
    + q(f"(^|{_edge})(" + "|".join(map(re.escape, t)) + f")e?s?({_edge}|$)")
    + ")"
    for n, t in {n: t for n, _, t in _eligible}.items()
)
LABELLED = f"""
defs(resource_name, alias, topics) AS (VALUES {_defs}),
bodies AS (SELECT doc_id, text, {phrase('text')} AS body FROM documents WHERE coalesce(n_chars, 0) > 0),
wanted AS (
  SELECT doc_id, text, resource_name, alias, topics,
    len(list_filter(topics, lambda t: contains(lower(text), t))) > 0 AS article_topic_match
  FROM bodies, defs WHERE contains(body, {phrase('alias')})), {SENT},
labelled AS (
  SELECT resource_name, alias, article_topic_match, doc_id, sent_no AS block_no, sentence,
    CAST(CASE resource_name {_topic_case} END AS INT) AS label
  FROM wanted JOIN sent USING (doc_id) WHERE contains(lower(sentence), lower(alias)))"""


def oracle(name: str, select: str, *ctes: str) -> None:
    ORACLES[name] = (f"WITH {', '.join(ctes)}\n" if ctes else "") + select


# --- dictionary ---

oracle("src_resources", "SELECT * FROM resources", RESOURCES)
oracle("src_dictionary", "SELECT resource_id, array_to_string(names, '|') AS names FROM lists", LISTS)
oracle(
    "src_json_events",
    """SELECT 'PMC' || user_id AS id, max_by(CAST(json_extract_string(props, '$.k') AS BIGINT), event_id) AS k
    FROM events WHERE event_id % 7 = 0 OR event_id % 11 <> 0 GROUP BY user_id""",
)
oracle(
    "src_labelled_union",
    """SELECT 'quality' AS resource_name, alias, label, 'PMC' || doc_id AS pmcid, text AS paragraph_text FROM examples
    UNION ALL SELECT 'toxic', alias, toxic, 'PMC' || doc_id, text FROM examples""",
    EXAMPLES,
)
oracle("alias_list", "SELECT resource_id, array_to_string(names, '|') AS names FROM lists", LISTS)
oracle("alias_explode", "SELECT * FROM aliases", ALIASES)
oracle(
    "alias_patterns",
    f"""SELECT resource_id, alias_pos, alias, case_sensitive, norm, {core('norm')} AS core,
      {escape('alias')} AS literal, NOT case_sensitive AND regexp_full_match(norm, '[a-z]+') AS plain
    FROM (SELECT *, CASE WHEN case_sensitive THEN alias ELSE lower(alias) END AS norm FROM aliases)""",
    ALIASES,
)
oracle(
    "name_to_id_last_wins",
    "SELECT alias, max(resource_id) AS resource_id FROM aliases GROUP BY alias",
    ALIASES,
)

# --- articles ---

_included = str_list(["PMC1", "PMC5", "PMC42", "PMC999999999"])
oracle("candidate_articles", "SELECT resource_id, doc_id FROM found", PHRASES)
oracle(
    "include_ids",
    f"""SELECT 'PMC' || doc_id AS pmcid FROM found
    UNION SELECT 'PMC' || doc_id FROM documents WHERE n_chars > 0 AND list_contains({_included}, 'PMC' || doc_id)""",
    PHRASES,
)
_names = str_list(sorted({a for _, names in inputs.DICTIONARY for a in names}))
oracle(
    "phrase_index_hits",
    """SELECT alias, doc_id, (length(wide) - length(replace(wide, gap, ''))) // length(gap) AS n_hits,
      length(front) - length(replace(front, ' ', '')) - 1 AS first_place
    FROM (SELECT doc_id, alias, replace(body, ' ', '  ') AS wide, ' ' || replace(trim(phrase), ' ', '  ') || ' ' AS gap,
        left(body, strpos(body, phrase)) AS front
      FROM docs, sought WHERE contains(body, phrase))""",
    f"""{PHRASES},
    sought AS (SELECT alias, {phrase('alias')} AS phrase FROM
      (SELECT text AS alias FROM benchmark UNION SELECT unnest({_names})) WHERE trim({phrase('alias')}) <> '')""",
)
oracle("normalise_metadata", "SELECT * FROM metadata", METADATA)
oracle(
    "completeness_gate",
    'SELECT pmcid, title, "authorList", "citedByCount" FROM gate WHERE reason IS NULL',
    METADATA,
)
oracle("gate_rejects", "SELECT pmcid, reason FROM gate WHERE reason IS NOT NULL", METADATA)
oracle(
    "id_normalise",
    """SELECT CASE WHEN doc_id % 3 = 0 THEN 'PMC' ELSE '' END || doc_id AS raw_id, doc_id::VARCHAR AS bare_id,
    'PMC' || doc_id AS full_id, doc_id AS id_num FROM documents""",
)
oracle(
    "filename_parse",
    """SELECT CASE doc_id % 4 WHEN 0 THEN 'PMC' || doc_id || '_PMC' || (doc_id + 49) || '.xml'
      WHEN 1 THEN 'PMC' || doc_id || '_PMC' || (doc_id + 49) || '.xml.gz'
      WHEN 2 THEN 'pmc_idlist.chunk_' || doc_id || '.txt' ELSE 'PMC' || doc_id || '.xml' END AS name,
    CASE WHEN doc_id % 4 = 2 THEN doc_id::VARCHAR END AS chunk,
    CASE WHEN doc_id % 4 < 2 THEN doc_id END AS start_id,
    CASE WHEN doc_id % 4 < 2 THEN doc_id + 49 END AS end_id FROM documents""",
)
oracle(
    "range_join_bundles",
    """SELECT 'PMC' || doc_id AS pmcid, bundle, start_id, end_id
    FROM documents JOIN bundles ON doc_id BETWEEN start_id AND end_id
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY start_id, end_id) = 1""",
    BUNDLES,
)
oracle(
    "source_cascade",
    """SELECT 'PMC' || doc_id AS pmcid, CASE WHEN lang = 'en' THEN 'local'
      WHEN source IN ('src1', 'src2', 'src3', 'src4', 'src5') THEN 'remote'
      WHEN lang = 'fr' THEN 'api' ELSE 'none' END AS source FROM documents""",
)
oracle(
    "first_seen",
    """SELECT 'PMC' || user_id AS pmcid, event_id AS resource_pos, event_type AS resource_id FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
oracle(
    "limit_per_resource",
    """SELECT event_type AS resource_id, 'PMC' || user_id AS pmcid,
      CAST(row_number() OVER (PARTITION BY event_type ORDER BY user_id) AS INT) AS rank_in_key
    FROM (SELECT DISTINCT event_type, user_id FROM events) QUALIFY rank_in_key <= 20""",
)
_n = catalogue.SHARDS
oracle(
    "md5_shard",
    f"""SELECT pmcid, CAST(shard AS BIGINT) AS shard,
      'metadata_shard_' || lpad(shard::VARCHAR, 2, '0') || '.jsonl.gz' AS shard_file
    FROM (SELECT pmcid, list_reduce(list_transform(range(1, 33),
        lambda i: ('0x' || substr(md5(pmcid), i, 1))::INT), lambda a, d: (a * 16 + d) % {_n}, 0) AS shard
      FROM (SELECT 'PMC' || doc_id AS pmcid FROM documents))""",
)
_c = catalogue.CHUNKS
oracle(
    "numeric_chunks",
    f"""SELECT pmcid, rank, least(rank // per, {_c} - 1) + 1 AS chunk FROM (
      SELECT pmcid, row_number() OVER (
          ORDER BY coalesce(try_cast(regexp_extract(pmcid, '^PMC([0-9]+)', 1) AS BIGINT), 0), pmcid) - 1 AS rank,
        CAST(ceil(count(*) OVER () / {_c}) AS BIGINT) AS per
      FROM (SELECT CASE doc_id % 50 WHEN 7 THEN 'PMCX' || doc_id WHEN 8 THEN 'PMC0' || (doc_id - 2)
          ELSE 'PMC' || doc_id END AS pmcid FROM documents))""",
)
oracle(
    "single_article",
    """SELECT 'PMC' || doc_id AS pmcid, '13' AS pmid, resource_name, alias, count(*) AS num_mentions
    FROM mentions WHERE doc_id = (SELECT min(doc_id) FROM documents WHERE doc_id % 97 = 13 AND n_chars > 0)
    GROUP BY doc_id, resource_name, alias""",
    DEDUP,
)

# --- text ---

oracle("sentences", "SELECT * FROM sent", SENT)
oracle(
    "extract_blocks_html",
    f"""SELECT page_id, block_no, CASE WHEN tag = 'h1' THEN 'title' WHEN tag = 'p' THEN 'paragraph' ELSE 'heading' END AS kind,
      CASE WHEN tag = 'h1' THEN '# TITLE' || chr(10) WHEN tag = 'p' THEN '' ELSE repeat('#', tag[2]::INT) || ' ' END || t AS text
    FROM (SELECT page_id, block_no, split_part(piece, chr(2), 1) AS tag, {visible('split_part(piece, chr(2), 2)')} AS t
      FROM (SELECT page_id, unnest(p) AS piece, CAST(generate_subscripts(p, 1) - 1 AS INT) AS block_no
        FROM (SELECT page_id, string_split({_marked}, chr(1)) AS p FROM bodies)))
    WHERE block_no > 0 AND t <> ''""",
    PAGES,
)
_item = f"regexp_replace(piece, '{PAGE_ITEM_END}', '')"
oracle(
    "list_items_html",
    f"""SELECT page_id, item_no, '- ' || t || '.' AS text
    FROM (SELECT page_id, item_no, {visible(_item)} AS t
      FROM (SELECT page_id, unnest(p) AS piece, CAST(generate_subscripts(p, 1) - 1 AS INT) AS item_no
        FROM (SELECT page_id, regexp_split_to_array({_cleaned}, '{PAGE_ITEM}') AS p FROM pages)))
    WHERE item_no > 0 AND t <> ''""",
)
_nl = "chr(10)"
oracle(
    "extract_blocks_xml",
    f"""SELECT doc_id, CAST(block_no AS INT) AS block_no, kind, CAST(depth AS INT) AS depth, text FROM (
      SELECT doc_id, 0 AS block_no, 'title' AS kind, 1 AS depth, '# TITLE' || {_nl} || first AS text FROM d
      UNION ALL SELECT doc_id, 1, 'spacer', 0, {_nl} FROM d
      UNION ALL SELECT doc_id, 2, 'abstract', 1, '# ABSTRACT' || {_nl} || first FROM d
      UNION ALL SELECT doc_id, 3, 'spacer', 0, {_nl} FROM d
      UNION ALL SELECT doc_id, 4, 'section', 2, '# ' || upper(source) || {_nl} || '- ' || lang || '.' || {_nl}
        || body || {_nl} || '## SUB' || {_nl} || 'in' || lang || 'out' FROM d
      UNION ALL SELECT doc_id, 5, 'spacer', 0, {_nl} FROM d
      UNION ALL SELECT doc_id, 6, 'section', 1, 'end' FROM d
      UNION ALL SELECT doc_id, 7, 'spacer', 0, {_nl} FROM d
      UNION ALL SELECT doc_id, 8, 'table', 0, '[TABLE-CAPTION] cap.' || {_nl} || '[COLUMN-HEADER] h.' || {_nl}
        || source || ' | [COLUMN-HEADER] x' FROM d)""",
    f"d AS (SELECT doc_id, source, lang, {parts('text')}[1] AS first, {trim('text')} AS body FROM documents)",
)
oracle(
    "training_blocks_xml",
    f"""SELECT doc_id, CAST(generate_subscripts(b, 1) - 1 AS BIGINT) AS place, unnest(b) AS text FROM (
      SELECT doc_id, list_concat(
        {parts('first')}, ['outside'], {parts("body || ' ' || lang")}, [lang, 'in ' || lang || ' out', 'no', 'end cap h ' || source || ' x'],
        ['cap', '[TABLE-CAPTION] cap', 'h', source || ' x']) AS b FROM d)""",
    f"d AS (SELECT doc_id, source, lang, {parts('text')}[1] AS first, {trim('text')} AS body FROM documents)",
)
oracle(
    "table_flatten",
    """SELECT l_orderkey AS doc_id, string_agg(line, '.' || chr(10) ORDER BY row_no) AS text FROM (
      SELECT l_orderkey, row_no, string_agg(head || text, ' | ' ORDER BY col_no, head || text) AS line FROM (
        SELECT l_orderkey, l_linenumber - 1 AS row_no, c.col_no, c.text,
          CASE WHEN l_returnflag = 'R' OR l_linenumber = 1 THEN '[COLUMN-HEADER] ' ELSE '' END AS head
        FROM lineitem, LATERAL (VALUES (0, CASE WHEN l_partkey % 10 = 0 THEN '' ELSE l_partkey::VARCHAR END),
          (1, l_returnflag), (2, l_linestatus), (3, l_suppkey::VARCHAR)) AS c(col_no, text))
      WHERE text <> '' GROUP BY l_orderkey, row_no) GROUP BY l_orderkey""",
)
oracle(
    "assemble_text",
    """SELECT conv_id AS doc_id,
      coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (role <> 'system') || chr(10), '')
      || coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (role = 'system') || chr(10), '') AS text
    FROM conversations GROUP BY conv_id""",
)

# --- mentions ---

oracle("mentions_ci_cs", "SELECT doc_id, sent_no, resource_id, resource_name, alias FROM raw", RAW)
oracle(
    "mentions_consuming",
    f"""SELECT doc_id, min(sent_no) AS sent_no, resource_name, alias FROM (
      SELECT *, count(*) OVER (PARTITION BY doc_id, alias) AS hits FROM kept)
    WHERE hits <= 30 OR {strict('consuming')}
    GROUP BY doc_id, sentence, resource_name, alias""",
    SENT,
    f"""searched AS (
      SELECT 'D' || doc_id AS doc_id, sent_no, sentence FROM sent
      UNION ALL SELECT * FROM (
        SELECT doc_id, CAST(generate_subscripts(p, 1) - 1 AS INT) AS sent_no, {trim('unnest(p)')} AS sentence
        FROM (SELECT 'C' || conv_id || '-' || turn AS doc_id, string_split(text, chr(10)) AS p
          FROM conversations WHERE role = 'system')) WHERE sentence <> ''
      UNION ALL SELECT * FROM (
        SELECT doc_id, CAST(generate_subscripts(p, 1) - 1 AS INT) AS sent_no, unnest(p) AS sentence
        FROM (SELECT 'C' || conv_id || '-' || turn AS doc_id, {parts('text')} AS p
          FROM conversations WHERE role <> 'system')) WHERE sentence <> '')""",
    raw("searched", "consuming"),
    KEPT,
)
oracle("substring_suppression", "SELECT doc_id, sent_no, resource_name, alias FROM kept", RAW, KEPT)
oracle(
    "volume_recheck", "SELECT doc_id, sent_no, resource_name, alias, alias_hits FROM checked", CHECKED
)
oracle("mentions_dedup", "SELECT * FROM mentions", DEDUP)

# --- scores ---

oracle("nb_weights", "SELECT * FROM weights", EXAMPLES, weights("examples"))
oracle(
    "score_mentions",
    "SELECT doc_id, sent_no, resource_name, alias, prediction, confidence FROM scored",
    SCORED,
)
oracle(
    "ranked_mentions",
    """SELECT doc_id, sent_no, resource_name, alias, prediction, confidence,
      CAST(row_number() OVER (PARTITION BY doc_id
        ORDER BY prediction DESC, confidence DESC, sent_no, resource_name, alias) AS INT) AS rank_in_article
    FROM scored""",
    SCORED,
)
oracle(
    "eval_metrics",
    """SELECT tp, fp, fn, tn, round((tp + tn)::DOUBLE / (tp + fp + fn + tn), 6) AS accuracy,
      CASE WHEN tp + fp > 0 THEN round(tp::DOUBLE / (tp + fp), 6) ELSE 0 END AS "precision",
      CASE WHEN tp + fn > 0 THEN round(tp::DOUBLE / (tp + fn), 6) ELSE 0 END AS recall,
      CASE WHEN 2 * tp + fp + fn > 0 THEN round(2.0::DOUBLE * tp / (2 * tp + fp + fn), 6) ELSE 0 END AS f1
    FROM (SELECT count(*) FILTER (prediction = 1 AND label = 1) AS tp, count(*) FILTER (prediction = 1 AND label = 0) AS fp,
      count(*) FILTER (prediction = 0 AND label = 1) AS fn, count(*) FILTER (prediction = 0 AND label = 0) AS tn FROM scored)""",
    EXAMPLES,
    f"train AS (SELECT * FROM examples WHERE {HASH32} < round(0.8 * 4294967296))",
    f"test AS (SELECT doc_id, text AS sentence, alias, label FROM examples WHERE {HASH32} >= round(0.8 * 4294967296))",
    weights("train"),
    scores("test", "doc_id, sentence, alias, label"),
)
oracle(
    "confidence_bands",
    """SELECT CASE WHEN confidence > 0.98 THEN 'high' WHEN confidence > 0.9 THEN 'medium-high'
      WHEN confidence > 0.8 THEN 'medium-low' ELSE 'low' END AS band,
      CASE prediction WHEN 1 THEN 'MATCH' ELSE 'NO MATCH' END AS label, count(*) AS mentions
    FROM scored GROUP BY 1, 2""",
    SCORED,
)
oracle(
    "publication_verdict",
    f"""SELECT doc_id, doc_id IN (SELECT doc_id FROM scored WHERE {YES}) AS has_mention FROM documents""",
    SCORED,
)

# --- roll-ups ---

oracle(
    "mentions_summary",
    f"""SELECT doc_id, resource_name, alias, count(*) AS match_count, {MEAN} AS mean_confidence
    FROM scored WHERE {YES} GROUP BY doc_id, resource_name, alias""",
    SCORED,
)
oracle(
    "token_matches",
    f"""SELECT doc_id, resource_name, alias, string_agg(sentence, ' || ' ORDER BY sentence) AS token_matches
    FROM (SELECT DISTINCT doc_id, resource_name, alias, sentence FROM scored WHERE {YES})
    GROUP BY doc_id, resource_name, alias""",
    SCORED,
)
oracle(
    "summary_by_resource",
    f"""SELECT resource_name, count(*) AS match_count, {MEAN} AS mean_confidence
    FROM scored WHERE {YES} GROUP BY resource_name""",
    SCORED,
)
_counts = "SELECT resource_name, alias, prediction, count(*) AS n FROM scored GROUP BY ALL"
oracle("prediction_counts", _counts, SCORED)
oracle("specificity_merge", _counts, SCORED)
oracle("specificity_scores", "SELECT * FROM spec", SCORED, SPECIFICITY)
oracle(
    "top_specificity",
    "SELECT * FROM spec ORDER BY specificity DESC, positives DESC, resource_name, alias LIMIT 5",
    SCORED,
    SPECIFICITY,
)
oracle(
    "mention_counters",
    """SELECT doc_id, count(*) AS mentions, count(DISTINCT resource_name) AS resources
    FROM scored GROUP BY doc_id""",
    SCORED,
)
oracle(
    "mention_sketches",
    """SELECT resource_name, count(*) AS mentions, count(DISTINCT doc_id) AS articles, TRUE AS within_error
    FROM scored GROUP BY resource_name""",
    SCORED,
)
_v = catalogue.VERSION
oracle(
    "fact_mentions",
    f"""SELECT g.pmcid, g.title, resource_id, resource_name AS short_name, alias AS matched_alias,
      match_count, mean_confidence, {q(_v['name'])} AS version, {q(_v['date'])} AS version_date,
      {q(_v['user'])} AS version_user
    FROM (SELECT 'PMC' || doc_id AS pmcid, resource_id, resource_name, alias, count(*) AS match_count,
        {MEAN} AS mean_confidence
      FROM scored WHERE {YES} GROUP BY doc_id, resource_id, resource_name, alias)
    JOIN gate g USING (pmcid) WHERE g.reason IS NULL""",
    SCORED,
    METADATA,
)

# --- training data ---

oracle(
    "block_labels",
    "SELECT resource_name, alias, label, article_topic_match, doc_id, block_no FROM labelled",
    LABELLED,
)
oracle(
    "article_topic",
    "SELECT doc_id, resource_name, alias, article_topic_match FROM wanted",
    LABELLED,
)
oracle(
    "model_input",
    f"SELECT doc_id, {model_text('text', 'alias')} AS input_text, label FROM examples",
    EXAMPLES,
)
oracle(
    "token_windows",
    f"""SELECT doc_id, label, CAST(w AS INT) AS window_no, array_to_string(list_slice(t, w * 384 + 1, w * 384 + 512), ' ') AS "window",
      CAST(len(list_slice(t, w * 384 + 1, w * 384 + 512)) AS INT) AS n_tokens,
      CAST(512 - len(list_slice(t, w * 384 + 1, w * 384 + 512)) AS INT) AS padding
    FROM (SELECT doc_id, label, t, unnest(range(0, CAST(ceil(greatest(len(t) - 512, 0) / 384) AS BIGINT) + 1)) AS w
      FROM (SELECT doc_id, label, list_filter(regexp_split_to_array({trim('text')}, '\\s+'), lambda x: x <> '') AS t FROM examples))""",
    EXAMPLES,
)
oracle(
    "train_test_first_n",
    f"""SELECT doc_id, source, CASE WHEN row_number() OVER (ORDER BY {HASH32}, doc_id) <= 300 THEN 'train' ELSE 'test' END AS split
    FROM documents""",
)
oracle(
    "train_test_hash",
    f"""SELECT doc_id, source, CASE WHEN {HASH32} < round(0.8 * 4294967296) THEN 'train' ELSE 'test' END AS split FROM documents""",
)
oracle(
    "label_order",
    """SELECT 'quality' AS resource_name, alias, label, toxic = 1 AS article_topic_match, 'PMC' || doc_id AS pmcid FROM examples
    ORDER BY label::VARCHAR, article_topic_match, pmcid, resource_name, alias""",
    EXAMPLES,
)

# --- streams: the end state equals the batch result ---

oracle("first_seen_stream", "SELECT DISTINCT 'PMC' || user_id AS pmcid FROM events")
oracle(
    "first_record_stream",
    """SELECT 'PMC' || user_id AS pmcid, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
oracle("mentions_stream", "SELECT doc_id, sent_no, resource_name, alias FROM mentions", DEDUP)
oracle("counts_stream", "SELECT * FROM spec", SCORED, SPECIFICITY)

# --- reads by file, large dictionaries, learnt sentence ends, quotas ---


def escaped(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


oracle(
    "bundle_articles",
    f"""SELECT 'PMC' || doc_id AS pmcid, bundle, md5('<article><front><article-meta><article-id pub-id-type="pmcid">PMC' || doc_id
      || '</article-id><title-group><article-title>' || first || '</article-title></title-group><abstract><title>Abstract</title><p>' || first
      || '</p></abstract></article-meta></front><body><p>outside</p><sec><title>' || source || '</title><p> ' || {escaped('text')}
      || '<list><list-item><p>' || lang || '</p></list-item></list></p><sec><title>sub</title><p>in <i>' || lang
      || '</i> out</p></sec></sec><sec sec-type="orcid"><p>no</p></sec><sec><p>end<table-wrap><caption><p>cap</p></caption><table><tr><td>h</td></tr><tr><td>'
      || source || '</td><td> </td><th>x</th></tr></table></table-wrap></p></sec></body></article>') AS xml_md5
    FROM (SELECT *, {escaped(parts('text') + '[1]')} AS first FROM documents) JOIN bundles ON doc_id BETWEEN start_id AND end_id
    WHERE doc_id IN (SELECT doc_id FROM found)
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY start_id, end_id) = 1""",
    BUNDLES,
    PHRASES,
)
oracle(
    "metadata_lookup",
    """SELECT pmcid, title, "firstPublicationDate", "citedByCount" FROM metadata
    WHERE k IN (SELECT doc_id FROM found)""",
    METADATA.replace("SELECT 'PMC' || k AS id,", "SELECT k, 'PMC' || k AS id,"),
    PHRASES,
)
_described = SENT.replace(
    "FROM documents))",
    "FROM (SELECT doc_id, text FROM documents UNION ALL SELECT -1 - p_partkey, 'A ' || p_name || ' ' || p_type || ' of ' || p_brand FROM part)))",
)
# Part names hold letters only as whole words, so their first one must be a word of the sentence.
oracle(
    "mentions_large_dictionary",
    f"""SELECT doc_id, sent_no, resource_id, resource_name, alias FROM raw
    UNION ALL SELECT doc_id, sent_no, resource_id, resource_name, alias
    FROM (SELECT alias AS a, doc_id, sent_no
      FROM (SELECT DISTINCT alias, case_sensitive, regexp_extract(lower(alias), '[a-z]+') AS w FROM aliases) n
      JOIN (SELECT DISTINCT doc_id, sent_no, sentence, unnest(regexp_split_to_array(lower(sentence), '[^a-z]+')) AS w FROM sent) USING (w)
      WHERE regexp_matches(CASE WHEN case_sensitive THEN sentence ELSE lower(sentence) END,
          '(^|[^A-Za-z])' || {core("CASE WHEN case_sensitive THEN alias ELSE lower(alias) END")} || '([^A-Za-z]|$)')) h
    JOIN aliases ON aliases.alias = a""",
    _described,
    raw("sent"),
    ALIASES,
)


def dotted(x: str) -> str:
    bare = f"regexp_replace(regexp_replace(lower({x}), '^[\"''(\\[]+|[\"'')\\],;:!?]+$', '', 'g'), '\\.$', '')"
    return f"CASE WHEN regexp_full_match({bare}, '\\p{{L}}[\\p{{L}}.-]*') THEN {bare} ELSE '' END"


ABBREVIATIONS = f"""
told AS (
  SELECT unnest(t[1:len(t) - 1]) AS token
  FROM (SELECT list_filter(regexp_split_to_array({trim('text')}, {q(WS + '+')}), lambda x: x <> '') AS t FROM documents)),
uses AS (
  SELECT word, count(*) FILTER (dot) AS dotted, count(*) FILTER (NOT dot) AS plain
  FROM (SELECT {dotted('token')} AS word, regexp_matches(token, '\\.["'')\\]]*$') AS dot FROM told) WHERE word <> '' GROUP BY word),
learnt AS (
  SELECT word, dotted, plain, round(
      2 * (dotted * (ln(0.99::DOUBLE) - ln(share)) + plain * (ln(1 - 0.99::DOUBLE) - ln(1 - share)))
      * exp(-length(replace(word, '.', ''))::DOUBLE) * (length(word) - length(replace(word, '.', '')) + 1) * exp(-plain::DOUBLE), 6) AS score
  FROM uses, (SELECT sum(dotted)::DOUBLE / (sum(dotted) + sum(plain)) AS share FROM uses) WHERE dotted > 0),
abbreviations AS (SELECT * FROM learnt WHERE score >= 0.3 ORDER BY score DESC, word LIMIT 5000)"""
oracle("abbreviations_learned", "SELECT * FROM abbreviations", ABBREVIATIONS)
oracle(
    "sentences_learned",
    f"""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY g) - 1 AS INT) AS sent_no, sentence
    FROM (SELECT doc_id, g, string_agg(piece, ' ' ORDER BY n) AS sentence FROM (
      SELECT doc_id, n, piece, sum(CASE WHEN after THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY n) AS g
      FROM (SELECT doc_id, n, piece, coalesce(lag(runs) OVER (PARTITION BY doc_id ORDER BY n), false) AS after FROM (SELECT doc_id, n, piece, regexp_matches(piece, '\\.$') AND {dotted(f"regexp_split_to_array(piece, {q(WS + '+')})[-1]")} IN (SELECT word FROM abbreviations) AS runs
        FROM (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS n FROM (SELECT doc_id, {parts('text')} AS p FROM documents)))))
      GROUP BY doc_id, g) QUALIFY sentence <> ''""",
    ABBREVIATIONS.replace(" ORDER BY score DESC, word LIMIT 5000", ""),
)
oracle(
    "quota_sample",
    """SELECT resource_name, alias, label, article_topic_match, doc_id, block_no, sentence AS paragraph_text
    FROM ranked JOIN (SELECT resource_name, alias, n FROM walk WHERE take) USING (resource_name, alias, n)
    WHERE (resource_name, alias) IN (
      SELECT (resource_name, alias) FROM walk WHERE take AND early GROUP BY resource_name, alias
      HAVING count(*) FILTER (label = 1) > 0 AND count(*) FILTER (label = 0) > 0)""",
    LABELLED,
    """ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY resource_name, alias ORDER BY art, doc_id, block_no, label) AS n,
    dense_rank() OVER (PARTITION BY resource_name, alias ORDER BY art, doc_id) <= 200 AS early
  FROM (SELECT *, md5('42|' || alias || '|' || doc_id) AS art FROM labelled)),
walk AS (
  SELECT resource_name, alias, 0::BIGINT AS n, 0 AS pos, 0 AS neg, '' AS art, 0 AS used, false AS take, -1 AS label, false AS early
  FROM (SELECT DISTINCT resource_name, alias FROM ranked)
  UNION ALL
  SELECT resource_name, alias, n, pos + CASE WHEN now AND label = 1 THEN 1 ELSE 0 END, neg + CASE WHEN now AND label = 0 THEN 1 ELSE 0 END,
    art, used + CASE WHEN now THEN 1 ELSE 0 END, now, label, early
  FROM (SELECT *, used < 5 AND (CASE WHEN label = 1 THEN pos ELSE neg END) < 20 AS now FROM (
    SELECT r.resource_name, r.alias, r.n, w.pos, w.neg, r.art, CASE WHEN r.art = w.art THEN w.used ELSE 0 END AS used, r.label, r.early
    FROM walk w JOIN ranked r ON r.resource_name = w.resource_name AND r.alias = w.alias AND r.n = w.n + 1
    WHERE w.pos < 20 OR w.neg < 20)))""",
)
ORACLES["quota_sample"] = ORACLES["quota_sample"].replace("WITH ", "WITH RECURSIVE ", 1)
ORACLES["fact_stream"] = ORACLES["fact_mentions"]
ORACLES["specificity_stream"] = ORACLES["specificity_scores"]
oracle(
    "publications_stored",
    f"""SELECT * FROM metadata WHERE pmcid IN (SELECT pmcid FROM gate WHERE reason IS NULL)
    AND pmcid IN (SELECT 'PMC' || doc_id FROM scored WHERE {YES})""",
    SCORED,
    METADATA,
)
