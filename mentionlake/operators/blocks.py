"""Article markup to text blocks, tables to lines, blocks to one text."""

from __future__ import annotations

import html
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.functions.text import sentence_array, strip

BLOCK_SCHEMA = "doc_id string, block_no int, kind string, depth int, text string"

FLUSH_CHARS = 8_000_000  # markup read before a worker hands on what it has

# Labels the output text carries.
CAPTION = "[TABLE-CAPTION] "
HEADER = "[COLUMN-HEADER] "
SKIPPED_SECTIONS = ("orcid",)


# --- markup that a strict parser refuses ---

_NAMED = re.compile(r"&([A-Za-z][A-Za-z0-9]*);")
_XML_NAMES = ("amp", "lt", "gt", "quot", "apos")
_TAG_PREFIX = re.compile(r"(</?)[\w.-]+:(?=[\w.-])")
_ATTRIBUTE_PREFIX = re.compile(r"(\s)[\w.-]+:([\w.-]+\s*=)")


class _Lenient(HTMLParser):
    """A tree from broken markup: an end tag closes what was opened since its start, one
    without a start is ignored, and what is open at the end is closed."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = ET.Element("recovered")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        self.open.append(ET.SubElement(self.open[-1], tag, {k: v or "" for k, v in attrs}))

    def handle_startendtag(self, tag, attrs):
        ET.SubElement(self.open[-1], tag, {k: v or "" for k, v in attrs})

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        node = self.open[-1]
        if len(node):
            node[-1].tail = (node[-1].tail or "") + data
        else:
            node.text = (node.text or "") + data


def parse_markup(xml: str):
    """The tree of an article, or None if there is no element in it.

    Named characters outside XML are resolved, and names lose their namespace, declared or
    not. Markup that is still not well formed is read leniently.
    """
    known = _NAMED.sub(lambda m: m[0] if m[1] in _XML_NAMES else html.unescape(m[0]), xml)
    try:
        root = ET.fromstring(known)
    except ET.ParseError:
        bare = _ATTRIBUTE_PREFIX.sub(r"\1\2", _TAG_PREFIX.sub(r"\1", known))
        try:
            root = ET.fromstring(bare)
        except ET.ParseError:
            reader = _Lenient()
            reader.feed(bare)
            reader.close()
            root = reader.root
            if not len(root):
                return None
    for node in root.iter():
        if isinstance(node.tag, str):
            node.tag = node.tag.rpartition("}")[2]
        for name in [n for n in node.attrib if "}" in n]:
            node.attrib[name.rpartition("}")[2]] = node.attrib.pop(name)
    return root


# --- XML articles: a small tree walk per article, the order of mixed content matters ---


def _text(node, glue: str, skip=()) -> str:
    def pieces(n):
        yield n.text
        for child in n:
            if child not in skip:
                yield from pieces(child)
            yield child.tail

    return glue.join(p.strip() for p in pieces(node) if p and p.strip())


def _first(node, tag: str):
    return next(node.iter(tag), None) if node is not None else None


def _paragraph_lines(p, glue: str, skip) -> list[str]:
    lists = [c for c in p if c.tag == "list"]
    items = p.iter("list-item") if lists else ()
    lines = [f"- {t}." for t in (_text(li, glue, skip) for li in items) if t]
    body = _text(p, glue, [*skip, *lists])
    return [*lines, body] if body else lines


def _section_lines(sec, glue: str, skip, depth: int = 1) -> tuple[list[str], int]:
    lines, deepest = [], depth
    for child in sec:
        if child.tag == "title" and child not in skip:
            lines.append(f"{'#' * depth} {_text(child, glue, skip).upper()}")
            break
    for child in sec:
        if child.tag == "sec":
            inner, below = _section_lines(child, glue, skip, depth + 1)
            if inner:
                lines.append("\n".join(inner))
            deepest = max(deepest, below)
        elif child.tag == "p":
            lines.extend(_paragraph_lines(child, glue, skip))
    return lines, deepest


def _table_lines(wrap, glue: str, joiner: str, headers: bool) -> list[str]:
    lines = []
    caption = _first(wrap, "caption")
    if caption is not None and _text(caption, glue):
        lines.append(CAPTION + _text(caption, glue))
    table = _first(wrap, "table")
    for i, row in enumerate(table.iter("tr") if table is not None else ()):
        cells = [(c, _text(c, glue)) for c in row.iter() if c.tag in ("td", "th")]
        shown = [
            (HEADER if headers and (c.tag == "th" or i == 0) else "") + t for c, t in cells if t
        ]
        if shown:
            lines.append(joiner.join(shown))
    return lines


def _reading_blocks(root, glue: str) -> Iterator[tuple[str, int, str]]:
    title = _first(root, "article-title")
    if title is not None and _text(title, glue):
        yield "title", 1, "# TITLE\n" + _text(title, glue)
    yield "spacer", 0, "\n"
    abstract = _first(root, "abstract")
    if abstract is not None:
        heading = _first(abstract, "title")
        drop = heading is not None and _text(heading, glue).upper() == "ABSTRACT"
        lines, depth = _section_lines(abstract, glue, [heading] if drop else [])
        yield "abstract", depth, "# ABSTRACT\n" + "\n".join(lines)
    funding = _first(root, "funding-statement")
    if funding is not None and _text(funding, glue):
        yield "funding", 3, "### FUNDING\n" + _text(funding, glue)
    for meta in root.iter("custom-meta"):
        name, value = _first(meta, "meta-name"), _first(meta, "meta-value")
        if name is not None and value is not None and _text(name, glue) and _text(value, glue):
            yield "meta", 3, f"### {_text(name, glue).upper()}\n{_text(value, glue)}"
    yield "spacer", 0, "\n"
    wraps = list(root.iter("table-wrap"))
    body = _first(root, "body")
    for sec in body if body is not None else ():
        if sec.tag == "sec" and sec.get("sec-type") not in SKIPPED_SECTIONS:
            lines, depth = _section_lines(sec, glue, wraps)
            yield "section", depth, "\n".join(lines)
            yield "spacer", 0, "\n"
    for wrap in wraps:
        lines = _table_lines(wrap, glue, " | ", headers=True)
        if lines:
            yield "table", 0, ".\n".join(lines)


def _training_blocks(root, glue: str) -> Iterator[tuple[str, int, str]]:
    for p in root.iter("p"):
        if _text(p, glue):
            yield "paragraph", 0, _text(p, glue)
    for wrap in root.iter("table-wrap"):
        for line in _table_lines(wrap, glue, " ", headers=False):
            yield "row", 0, line


def extract_blocks(raw: DataFrame, glue: str = "", mode: str = "reading") -> DataFrame:
    """``doc_id, block_no, kind, depth, text`` from ``raw(doc_id, xml)``.

    ``glue`` joins the text pieces of inline markup: nothing by default, so
    ``the <i>gene</i> x`` reads ``thegenex``; pass a space to keep words apart. Broken
    markup is recovered (:func:`parse_markup`); an article without any element gives one
    block of kind ``unparsed`` without text, see :func:`unparsed_articles`.
    """
    walk = {"reading": _reading_blocks, "training": _training_blocks}[mode]

    names = ["doc_id", "block_no", "kind", "depth", "text"]

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out, size = [], 0
            for doc_id, xml in zip(frame["doc_id"], frame["xml"]):
                root = parse_markup(xml)
                if root is None:
                    out.append((doc_id, 0, "unparsed", 0, None))
                else:
                    out += [(doc_id, i, k, d, t) for i, (k, d, t) in enumerate(walk(root, glue))]
                size += len(xml)
                if size > FLUSH_CHARS:
                    yield pd.DataFrame(out, columns=names)
                    out, size = [], 0
            yield pd.DataFrame(out, columns=names)

    rows = raw.select(F.col("doc_id").cast("string").alias("doc_id"), "xml")
    return rows.where(F.col("xml").isNotNull()).mapInPandas(blocks, BLOCK_SCHEMA)


def unparsed_articles(blocks: DataFrame) -> DataFrame:
    """``doc_id`` of the articles that gave no text because they hold no markup."""
    return blocks.where(F.col("kind") == "unparsed").select("doc_id")


def training_blocks(raw: DataFrame) -> DataFrame:
    """Blocks for labelling: the sentences of every paragraph, then captions and rows."""
    rows = extract_blocks(raw, glue=" ", mode="training").where(F.col("kind") != "unparsed")
    pieces = F.when(F.col("kind") == "paragraph", sentence_array(F.col("text"))).otherwise(
        F.array("text")
    )
    return rows.select("doc_id", "block_no", F.posexplode_outer(pieces).alias("part_no", "text"))


# --- HTML pages: built-in expressions only ---

# Patterns for page markup, read alike by Java and RE2.
PAGE_NOISE = r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->"
PAGE_ARTICLE = r"(?s)<article[^>]*>(.*?)(?:</article>|\z)"
PAGE_BODY = r"(?s)<body[^>]*>(.*?)(?:</body>|\z)"
PAGE_BLOCK = r"<(h[1-6]|p)(?:\s[^>]*)?>"
PAGE_ITEM = r"<li(?:\s[^>]*)?>"
PAGE_ITEM_END = r"(?s)</li>.*$"
PAGE_TAG = r"<[^>]*>"
# Named characters decoded, the ampersand last.
ENTITIES = [
    ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"),
    ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"),
]


def _visible(c: Column, glue: str) -> Column:
    pieces = F.filter(F.transform(F.split(c, PAGE_TAG), strip), lambda s: s != "")
    out = F.array_join(pieces, glue)
    for name, char in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


def page_blocks(pages: DataFrame, glue: str = "") -> DataFrame:
    """``page_id, block_no, kind, text``: headings and paragraphs of all articles of each
    page, an unclosed one to the end; without any article those of the body, or else of
    the page. A page is cleaned once."""
    once = F.explode_outer(F.array(F.regexp_replace("html", PAGE_NOISE, ""))).alias("clean")
    pages, clean = pages.select("page_id", once), F.col("clean")
    found = F.array_join(F.regexp_extract_all(clean, F.lit(PAGE_ARTICLE), F.lit(1)), "")
    whole = F.when(clean.rlike(PAGE_BODY), F.regexp_extract(clean, PAGE_BODY, 1)).otherwise(clean)
    body = F.when(clean.rlike(PAGE_ARTICLE), found).otherwise(whole)
    marked = F.regexp_replace(body, PAGE_BLOCK, "\u0001$1\u0002")
    cut = pages.select("page_id", F.posexplode_outer(F.split(marked, "\u0001")).alias("block_no", "piece"))
    tag = F.split_part("piece", F.lit("\u0002"), F.lit(1))
    text = _visible(F.split_part("piece", F.lit("\u0002"), F.lit(2)), glue)
    rows = cut.where("block_no > 0").select("page_id", "block_no", tag.alias("tag"), text.alias("t"))
    title, heading = F.col("tag") == "h1", F.col("tag") != "p"
    return rows.where(F.col("t") != "").select(
        "page_id",
        "block_no",
        F.when(title, "title").when(heading, "heading").otherwise("paragraph").alias("kind"),
        F.when(title, F.concat(F.lit("# TITLE\n"), "t"))
        .when(heading, F.concat(F.expr("repeat('#', int(substr(tag, 2)))"), F.lit(" "), "t"))
        .otherwise(F.col("t")).alias("text"),
    )


def page_list_items(pages: DataFrame, glue: str = "") -> DataFrame:
    """``page_id, item_no, text``: each list item once, as ``- item.``"""
    body = F.regexp_replace("html", PAGE_NOISE, "")
    cut = pages.select("page_id", F.posexplode_outer(F.split(body, PAGE_ITEM)).alias("item_no", "piece"))
    text = _visible(F.regexp_replace("piece", PAGE_ITEM_END, ""), glue)
    return cut.where("item_no > 0").select("page_id", "item_no", text.alias("t")).where(
        F.col("t") != ""
    ).select("page_id", "item_no", F.concat(F.lit("- "), "t", F.lit(".")).alias("text"))


# --- Tables and whole texts ---


def flatten_tables(cells: DataFrame, captions: DataFrame | None = None) -> DataFrame:
    """``doc_id, table_no, text`` from ``doc_id, table_no, row_no, col_no, is_header, text``.

    Non-empty cells of a row are joined by ``" | "``, header cells and all cells of row 0
    are marked, lines end in a full stop so that each splits off as a sentence. Tables
    without any line are dropped. One grouping by table serves cells and rows: the value
    built is the table itself.
    """
    marked = F.col("is_header") | (F.col("row_no") == 0)
    shown = cells.where(F.col("text") != "").select(
        "doc_id", "table_no", "row_no", "col_no", F.when(marked, F.concat(F.lit(HEADER), "text")).otherwise(F.col("text")).alias("text")
    )
    if captions is not None:
        shown = shown.unionByName(captions.where(F.col("text") != "").select(
            "doc_id", "table_no", F.lit(-1).alias("row_no"), F.lit(0).alias("col_no"), F.concat(F.lit(CAPTION), "text").alias("text")
        ))
    ordered = F.array_sort(F.collect_list(F.struct("row_no", "col_no", "text")))
    tables = shown.groupBy("doc_id", "table_no").agg(ordered.alias("cells"))
    before = lambda i: F.get("cells", i - 1)["row_no"]
    same_row = lambda c, i: before(i).eqNullSafe(c["row_no"]) & ~c["row_no"].eqNullSafe(F.lit(-1))
    joiner = lambda c, i: F.when(i == 0, "").when(same_row(c, i), " | ").otherwise(".\n")
    pieces = F.transform("cells", lambda c, i: F.concat(joiner(c, i), c["text"]))
    return tables.select("doc_id", "table_no", F.array_join(pieces, "").alias("text"))


def assemble_text(blocks: DataFrame, key: str = "doc_id") -> DataFrame:
    """One text per article from ``key, block_no, kind, text``: text blocks first, then
    tables, blank lines between; articles without any block are dropped. The value built
    per article is the article itself."""
    rows = F.array_sort(F.collect_list(F.struct("block_no", "kind", "text")))
    grouped = blocks.where(F.col("text").isNotNull()).groupBy(key).agg(rows.alias("b"))

    def part(tables: bool) -> Column:
        chosen = F.filter("b", lambda r: (r["kind"] == "table") == F.lit(tables))
        joined = F.array_join(F.transform(chosen, lambda r: r["text"]), "\n\n")
        return F.when(F.size(chosen) > 0, F.concat(joined, F.lit("\n"))).otherwise("")

    return grouped.select(key, F.concat(part(False), part(True)).alias("text")).where(
        F.col("text") != ""
    )
