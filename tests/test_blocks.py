from mentionlake.operators import blocks

ARTICLE = """<article xmlns:xlink="http://www.w3.org/1999/xlink"><front><article-meta>
<article-id pub-id-type="pmcid">PMC7</article-id>
<title-group><article-title>The <i>E. coli</i> gene</article-title></title-group>
<abstract><title>Abstract</title><sec><title>Aim</title><p>We aim.</p></sec><p>Done.</p></abstract>
<custom-meta-group><custom-meta><meta-name>Data</meta-name><meta-value>open</meta-value></custom-meta>
<custom-meta><meta-name>Void</meta-name><meta-value> </meta-value></custom-meta></custom-meta-group>
<funding-group><funding-statement>Paid by X.</funding-statement></funding-group>
</article-meta></front><body><p>Outside a section.</p>
<sec><title>Intro</title><p>First <b>bold</b> text.</p>
<p>Lead<list><list-item><p>one</p></list-item><list-item><p>two</p></list-item></list>mid<list>
<list-item><p>three</p></list-item></list>tail</p>
<sec><title>Deep</title><p>Inner.</p><sec><title>Deeper</title></sec></sec>
<table-wrap><caption><title>Cap</title><p>tion</p></caption><table>
<tr><td>h1</td><td>h2</td></tr><tr><th>r</th><td>v</td><td> </td></tr><tr><td/></tr></table></table-wrap>
</sec><sec sec-type="orcid"><p>skip me</p></sec></body></article>"""


def run(spark, xml, **kw):
    df = spark.createDataFrame([("PMC7", xml)], "doc_id string, xml string")
    return [(r.kind, r.depth, r.text) for r in blocks.extract_blocks(df, **kw).orderBy("block_no").collect()]


def test_reading_blocks(spark):
    assert run(spark, ARTICLE) == [
        ("title", 1, "# TITLE\nTheE. coligene"),
        ("spacer", 0, "\n"),
        ("abstract", 2, "# ABSTRACT\n## AIM\nWe aim.\nDone."),
        ("funding", 3, "### FUNDING\nPaid by X."),
        ("meta", 3, "### DATA\nopen"),
        ("spacer", 0, "\n"),
        ("section", 3, "# INTRO\nFirstboldtext.\n- one.\n- two.\n- three.\nLeadmidtail\n"
         "## DEEP\nInner.\n### DEEPER"),
        ("spacer", 0, "\n"),
        ("table", 0, "[TABLE-CAPTION] Caption.\n[COLUMN-HEADER] h1 | [COLUMN-HEADER] h2.\n"
         "[COLUMN-HEADER] r | v"),
    ]


def test_glue_and_other_abstract_title(spark):
    xml = "<article><abstract><title>Summary</title><p>a <i>b</i> c</p></abstract></article>"
    assert run(spark, xml, glue=" ")[1] == ("abstract", 1, "# ABSTRACT\n# SUMMARY\na b c")
    assert run(spark, "no markup at all") == [("unparsed", 0, None)]


def test_training_blocks(spark):
    xml = "<article><p>One. Two <i>x</i>!</p><table-wrap><caption>C</caption><table><tr><td>a</td><th>b</th></tr></table></table-wrap></article>"
    df = spark.createDataFrame([("d", xml)], "doc_id string, xml string")
    got = blocks.training_blocks(df).orderBy("block_no", "part_no").collect()
    assert [r.text for r in got] == ["One.", "Two x !", "[TABLE-CAPTION] C", "a b"]


def test_flatten_tables_with_caption(spark):
    cells = [
        (1, 0, 1, 1, False, "v2"), (1, 0, 1, 0, False, "v1"), (1, 0, 0, 0, False, "h"),
        (1, 0, 2, 0, True, "side"), (1, 0, 2, 1, False, ""), (1, 1, 0, 0, False, ""),
    ]
    df = spark.createDataFrame(
        cells, "doc_id int, table_no int, row_no int, col_no int, is_header boolean, text string"
    )
    caps = spark.createDataFrame([(1, 0, "cap")], "doc_id int, table_no int, text string")
    got = blocks.flatten_tables(df, caps).collect()
    assert [r.text for r in got] == [
        "[TABLE-CAPTION] cap.\n[COLUMN-HEADER] h.\nv1 | v2.\n[COLUMN-HEADER] side"
    ]
    plan = blocks.flatten_tables(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_assemble(spark):
    rows = [(1, 2, "table", "t"), (1, 1, "section", "b"), (1, 0, "title", "a"), (2, 0, "table", "x"), (3, 0, "title", None)]
    df = spark.createDataFrame(rows, "doc_id int, block_no int, kind string, text string")
    got = {r.doc_id: r.text for r in blocks.assemble_text(df).collect()}
    assert got == {1: "a\n\nb\nt\n", 2: "x\n"}


def test_broken_markup_is_recovered(spark):
    body = "<body><sec><title>t</title><p>a %s b</p></sec></body>"
    cases = {
        "entity": f"<article>{body % '&nbsp;&eacute;&amp;'}</article>",
        "prefix": f"<article>{body % '<xlink:ext-link xlink:href=&quot;u&quot;>x</xlink:ext-link>'.replace('&quot;', chr(34))}</article>",
        "namespace": f'<article xmlns="http://x.example/ns">{body % "x"}</article>',
        "unclosed": f"<article>{body % '<b>x'}",
        "crossed": f"<article>{body % '<i><b>x</i></b>'}</article>",
    }
    raw = spark.createDataFrame(list(cases.items()) + [("none", "plain words")], "doc_id string, xml string")
    rows = blocks.extract_blocks(raw, glue=" ")
    text = {r.doc_id: r.text for r in blocks.assemble_text(rows).collect()}
    assert set(text) == set(cases)
    for name, want in {"entity": "é& b", "prefix": "x", "namespace": "a x b", "unclosed": "x", "crossed": "x"}.items():
        assert want in text[name] and "# T" in text[name], name
    assert [r.doc_id for r in blocks.unparsed_articles(rows).collect()] == ["none"]


def test_pages_of_every_kind(spark):
    from mentionlake.operators.blocks import page_blocks

    rows = [
        (1, "<body><article><h1>A</h1><h2>B</h2><p>c</p></article><p>no</p><article><p>d</p><h3>E</h3></article></body>"),
        (2, "<body><p>no</p><article><p>open</p>"),
        (3, "<head><title>no</title></head><body><h2>F</h2><p>g</p></body>"),
        (4, "<p>bare</p>"),
    ]
    pages = page_blocks(spark.createDataFrame(rows, "page_id int, html string"))
    got = [(r["page_id"], r["kind"], r["text"]) for r in pages.orderBy("page_id", "block_no").collect()]
    assert got == [
        (1, "title", "# TITLE\nA"), (1, "heading", "## B"), (1, "paragraph", "c"), (1, "paragraph", "d"), (1, "heading", "### E"),
        (2, "paragraph", "open"), (3, "heading", "## F"), (3, "paragraph", "g"), (4, "paragraph", "bare"),
    ]
