"""Spellings that license scans must find, and long runs of phrases."""

import time

import pytest

from mentionlake.llm import licenses
from test_operators import plain_licenses

CASES = [
    ("Released as GPLv2.", "gpl-2"), ("GNU GPL v3 or later", "gpl-3"), ("see LGPLv2.1+", "lgpl-2.1"), ("AGPL-3.0-only", "agpl-3.0"), ("MPLv2", "mpl-2.0"),
    ("Apache License v2.0", "apache-2.0"), ("BSD-3-Clause", "bsd-3-clause"), ("3-clause BSD", "bsd-3-clause"), ("License: MIT", "mit"),
    ("You may not use this file except in compliance with the License.", "apache-2.0"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products", "bsd-3-clause"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"), ("a day at MIT, where apache2 ran", ""),
]


def test_spellings(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id bigint, text string")
    rows = {r["doc_id"]: r for r in licenses.scanned(docs).collect()}
    for i, (text, label) in enumerate(CASES):
        assert label in rows[i]["labels"].split(","), (text, rows[i]["labels"])
        assert tuple(rows[i])[1:-1] == plain_licenses(text)


@pytest.mark.parametrize("n", [3000])
def test_many_phrases_in_one_text(spark, n):
    text = "under the mit license, gplv3 or later; " * n
    start = time.time()
    row = licenses.scanned(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row["n_base"] == n and len(row["hits"]) == 2 * n and (row["first_word"], row["last_word"]) == (2, 7 * (n - 1) + 2)
    assert time.time() - start < 30
