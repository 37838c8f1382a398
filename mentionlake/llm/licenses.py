"""License scans: ordered signature rules over the words of a text.

Rules are regexes over lower-cased words with single spaces between them, each with a
label, a score and a keyword. A rule is tried only on texts that hold its keyword. Where
detections overlap, one that lies inside another of a rule earlier in the order is
suppressed. Everything happens inside the row; nothing is shuffled.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.llm.stage import fresh

# Fixed values of the contract: phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# License families as label, name in words, keyword, versions (may be none).
FAMILIES = (
    ("mit", "mit", "mit", ""),
    ("apache", "apache", "apache", "1 0|1 1|2 0"),
    ("gpl", "gnu general public|general public|gnu gpl|gpl", "general|gpl", "1|2|3|2 0|3 0"),
    ("lgpl", "gnu lesser general public|lesser general public|library general public|gnu lgpl|lgpl", "lesser|library|lgpl", "2|3|2 1|2 0|3 0"),
    ("agpl", "gnu affero general public|affero general public|gnu agpl|agpl", "affero|agpl", "1|3|3 0"),
    ("mpl", "mozilla public|mpl", "mozilla|mpl", "1 0|1 1|2 0"),
    ("epl", "eclipse public|epl", "eclipse|epl", "1 0|2 0"),
    ("cddl", "common development and distribution|cddl", "common|cddl", "1 0|1 1"),
    ("eupl", "european union public|eupl", "union|eupl", "1 1|1 2"),
    ("bsd", "bsd|simplified bsd|new bsd|modified bsd|revised bsd|original bsd", "bsd", ""),
    ("isc", "isc", "isc", ""),
    ("zlib", "zlib|zlib libpng", "zlib", ""),
    ("boost", "boost software", "boost", "1 0"),
    ("artistic", "artistic|perl artistic", "artistic", "1 0|2 0"),
    ("unlicense", "unlicense", "unlicense", ""),
    ("wtfpl", "wtfpl", "wtfpl", "2"),
    ("ofl", "sil open font|open font", "font", "1 0|1 1"),
    ("python", "python software foundation|psf", "psf|python", "2"),
    ("gfdl", "gnu free documentation|free documentation", "documentation", "1 1|1 2|1 3"),
    ("odbl", "open database|odbl", "database|odbl", "1 0"),
    ("postgresql", "postgresql", "postgresql", ""),
    ("ms-pl", "microsoft public|ms pl", "microsoft|pl", ""),
    ("cpl", "common public", "common", "1 0"),
    ("openssl", "openssl", "openssl", ""),
    ("php", "php", "php", "3 0|3 01"),
    ("ruby", "ruby", "ruby", ""),
    ("vim", "vim", "vim", ""),
    ("bsl", "business source", "business", "1 1"),
    ("sspl", "server side public|sspl", "server|sspl", "1"),
    ("elastic", "elastic", "elastic", "2 0"),
)
# Creative Commons elements as they are written.
CC_ELEMENTS = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
CC_NAMES = (
    "attribution", "attribution share ?alike", "attribution non ?commercial", "attribution no derivatives",
    "attribution non ?commercial share ?alike", "attribution non ?commercial no derivatives",
)
# Sentences of license texts and file headers, tags in other word orders, and
# notices that name no license, each as label, pattern, keyword and score.
SIGNATURES = (
    ("mit", r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense", "sublicense", 1.0),
    ("mit-0", r"mit 0", "mit", 0.9),
    ("apache-2.0", r"you may not use this file except in compliance with the licen[cs]e", "compliance", 0.9),
    ("apache-2.0", r"(?:http|https) www apache org licen[cs]es licen[cs]e 2 0", "apache", 1.0),
    ("gpl", r"redistribute it and or modify it under the terms of the gnu general public licen[cs]e as published by the free software foundation", "redistribute", 1.0),
    ("gpl", r"(?:http|https) (?:www )?gnu org licen[cs]es gpl", "gnu", 0.9),
    ("lgpl", r"redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e as published by the free software foundation", "redistribute", 1.0),
    ("agpl", r"redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e as published by the free software foundation", "redistribute", 1.0),
    ("copyleft", r"everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document", "verbatim", 0.8),
    ("bsd-0-clause", r"(?:bsd (?:0|zero) clause|(?:0|zero) clause bsd|0bsd)", "clause|0bsd", 0.9),
    ("bsd-2-clause", r"(?:bsd (?:2|two) clause|(?:2|two) clause bsd|freebsd licen[cs]e)", "clause|freebsd", 0.9),
    ("bsd-3-clause", r"(?:bsd (?:3|three) clause|(?:3|three) clause bsd)", "clause", 0.9),
    ("bsd-4-clause", r"(?:bsd (?:4|four) clause|(?:4|four) clause bsd)", "clause", 0.9),
    ("bsd-3-clause", r"neither the names? of (?:[^ ]+ ){1,12}nor the names of (?:its|their|other|any) contributors may be used to endorse or promote products", "endorse", 1.0),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "advertising", 1.0),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted provided that", "redistribution", 0.9),
    ("isc", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted", "fee", 1.0),
    ("zlib", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "misrepresented", 1.0),
    ("boost", r"any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[cs]e", "organization", 1.0),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered", 1.0),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public licen[cs]e", "mozilla", 1.0),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1", "mozilla", 1.0),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e", "eclipse", 1.0),
    ("artistic", r"the intent of this document is to state the conditions under which a package may be copied", "intent", 0.9),
    ("ofl", r"this font software is licensed under the sil open font licen[cs]e", "font", 1.0),
    ("python", r"psf is making python available to licensee on an as is basis", "psf", 1.0),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e", "common", 1.0),
    ("openssl", r"this product includes software developed by the openssl project", "openssl", 0.9),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee", "fee", 0.9),
    ("cc0", r"(?:cc0|cc zero)(?: 1 0)?(?: universal)?", "cc0|zero", 0.9),
    ("cc", r"(?:http|https) creativecommons org licen[cs]es", "creativecommons", 0.8),
    ("public-domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", "domain", 0.9),
    ("public-domain", r"(?:is|are) in the public domain", "domain", 0.7),
    ("proprietary", r"all rights reserved", "reserved", 0.6),
    ("proprietary", r"proprietary and confidential", "proprietary", 0.9),
    ("proprietary", r"unauthorized copying of this file", "unauthorized", 0.9),
    ("permissive", r"permission is hereby granted free of charge", "permission", 0.9),
    ("permissive", r"redistribution and use in source and binary forms", "redistribution", 0.9),
    ("permissive", r"permission to use copy modify and (?:or )?distribute this software", "permission", 0.9),
    ("warranty", r"(?:provided )?as is without warranty of any kind", "warranty", 0.5),
    ("warranty", r"in the hope that it will be useful but without any warranty", "warranty", 0.5),
    ("copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*", "copyright", 0.4),
)
LATER = r"(?: or (?:any )?later(?: version)?| only)?"


class Rule(NamedTuple):
    """Rules stand in order of priority; ``place`` is that order."""

    place: int
    label: str
    keyword: str
    pattern: str
    score: float


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, from families, versions and wordings: most specific first."""
    found: list[tuple[int, str, str, str, float]] = []
    leads = r"(?:(?:licensed|released|distributed|available|provided|published|covered) (?:under|by|with)|under|subject to|terms of)(?: the)?(?: terms of)?(?: the)?"
    for label, names, keywords, versions in FAMILIES:
        for name in names.split("|"):
            words = set(name.split())
            keyword = next((k for k in keywords.split("|") if k in words), name.split()[0])
            tail = r"(?: software)?(?: public)?(?: licen[cs]e)?"
            found.append((1, label, keyword, f"{leads} {name}{tail}", 0.9))
            found.append((4, label, keyword, f"spdx licen[cs]e identifier {name}", 1.0))
            found.append((5, label, keyword, rf"{name} licen[cs]e", 0.8))
            found.append((5, label, keyword, rf"licen[cs]e(?:d)?(?: is)? {name}", 0.8))
            known = [v for v in versions.split("|") if v]
            majors = [v.split()[0] for v in known]
            for version, major in zip(known, majors, strict=True):
                tag = f"{label}-{version.replace(' ', '.')}"
                found.append((0, tag, keyword, rf"(?:{leads} )?{name}(?: licen[cs]e)?(?: version| v)? v?{version}{LATER}", 1.0))
                found.append((0, tag, keyword, rf"spdx licen[cs]e identifier {name} {version}{LATER}", 1.0))
                if " " not in name:  # written in one word, the minor number left out where no other has that major one
                    minor = version[len(major) :]
                    minor = f"(?:{minor})?" if minor and majors.count(major) == 1 else minor
                    # A name with a bare number may be a program (apache2); one that ends in L is a license.
                    for word in (f"{name}v{major}", f"{name}{major}")[: 1 + name.endswith("l")]:
                        found.append((0, tag, word, rf"(?:{leads} )?{word}{minor}{LATER}", 1.0))
    for element, name in zip(CC_ELEMENTS, CC_NAMES, strict=True):
        label = "cc-" + element.replace(" ", "-")
        for version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            tag = f"{label}-{version.replace(' ', '.')}"
            found.append((0, tag, "cc", rf"(?:{leads} )?(?:a )?cc {element} {version}", 1.0))
            found.append((0, tag, "commons", rf"(?:{leads} )?(?:a )?creative commons {name}(?: licen[cs]e)? {version}(?: international| unported)?", 1.0))
        found.append((2, label, "cc", rf"(?:{leads} )?(?:a )?cc {element}", 0.9))
        found.append((2, label, "commons", rf"(?:{leads} )?(?:a )?creative commons {name}", 0.9))
    found += [(3, label, k, pattern, score) for label, pattern, ks, score in SIGNATURES for k in ks.split("|")]
    ordered = sorted(dict.fromkeys(found), key=lambda r: (r[0], -len(r[3].split()), r[1], r[3], r[2]))
    return tuple(Rule(i, label, keyword, f"(?<= ){pattern}(?= )", score) for i, (_, label, keyword, pattern, score) in enumerate(ordered))


def _bound(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _spaces(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


def _places(norm: Column, pattern: Column) -> Column:
    """``s, e`` of every match: its first word and the word after it. ``norm`` has one
    space before each word and one at the end; a match starts at a word."""

    def spans(pieces: Column) -> Column:
        return _bound(F.regexp_extract_all(norm, pattern, F.lit(0)), lambda m: _running(pieces, m))

    return _bound(F.split(norm, pattern, F.lit(-1)), spans)


def _running(pieces: Column, matches: Column) -> Column:
    """The words that each match covers, from one running count over what stands between
    the matches and the matches themselves."""
    steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda p, m: F.struct(_spaces(p).alias("p"), _spaces(m).alias("m")))
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["n"] + x["p"] - 1
        found = F.struct(s.alias("s"), (s + 1 + x["m"]).alias("e"))
        return F.struct((acc["n"] + x["p"] + x["m"]).alias("n"), F.array_append(acc["out"], found).alias("out"))

    return F.aggregate(steps, start, step)["out"]


def _rule_table() -> Column:
    """The rules as one literal array, parsed at once."""
    quote = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    row = lambda r: f"named_struct('place', {r.place}, 'label', {quote(r.label)}, 'keyword', {quote(r.keyword)}, 'pattern', {quote(r.pattern)}, 'score', {r.score}D)"
    return F.expr(f"array({', '.join(map(row, rules()))})")


def detections(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a struct column ``name``: ``n_words``, ``base`` (places of the base
    phrases: ``label, s, e``) and ``hits`` (detections that survive: ``label, score, s,
    e``), ordered by place.

    Words are runs of digits, letters and anything outside ASCII, after A-Z are lower-cased.
    A null or empty text has no words and no detection. Repeated rows get a result each.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = lambda x: F.filter(F.split(x, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), lambda w: w != "")
    # Full lower-casing is cheaper than that of A-Z alone and has the same words in number;
    # it only decides which texts are looked at, and never leaves one out.
    words = split(F.lower(text))
    keywords = F.array(*map(F.lit, sorted({r.keyword for r in rules()} | {"license"})))
    table = _rule_table()

    def scan(w: Column) -> Column:
        base_none = F.array().cast("array<struct<label:string,s:int,e:int>>")
        hits_none = F.array().cast("array<struct<place:int,label:string,score:double,s:int,e:int>>")
        lower = lambda x: F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        norm = F.concat(F.lit(" "), lower(F.array_join(split(text), " ")), F.lit(" "))

        def found(t: Column) -> Column:
            def phrase(words: str, label: str) -> Column:
                named = lambda p: F.struct(F.lit(label).alias("label"), p["s"].alias("s"), p["e"].alias("e"))
                return F.transform(_places(t, F.lit(f"(?<= ){words}(?= )")), named)

            base = F.flatten(F.array(*(phrase(*b) for b in BASE)))
            tried = F.filter(table, lambda r: F.contains(t, F.concat(F.lit(" "), r["keyword"], F.lit(" "))))
            hits = F.flatten(F.transform(tried, lambda r: F.transform(_places(t, r["pattern"]), lambda p: F.struct(
                r["place"].alias("place"), r["label"].alias("label"), r["score"].alias("score"), p["s"].alias("s"), p["e"].alias("e")
            ))))
            return F.struct(base.alias("base"), _bound(hits, _surviving).alias("hits"))

        held = F.arrays_overlap(w, keywords)
        none = F.struct(base_none.alias("base"), hits_none.alias("hits"))
        return F.struct(F.size(w).cast("bigint").alias("n_words"), F.when(held, _bound(norm, found)).otherwise(none).alias("x"))

    return docs.select(*docs.columns, F.explode(F.array(_bound(words, scan))).alias(name))


def _surviving(hits: Column) -> Column:
    """Hits that lie in no hit of an earlier rule, in order of place. One pass by start, the
    longest first, holds the hits that are still open: what contains a hit comes before it."""
    row = "struct<s:int,back:int,place:int,e:int,label:string,score:double>"
    ordered = F.sort_array(F.transform(hits, lambda h: F.struct(
        h["s"].alias("s"), (-h["e"]).alias("back"), h["place"].alias("place"), h["e"].alias("e"), h["label"].alias("label"), h["score"].alias("score")
    )))
    none = F.array().cast(f"array<{row}>")

    def step(acc: Column, h: Column) -> Column:
        beaten = F.exists(acc["open"], lambda g: (g["place"] < h["place"]) & (g["e"] >= h["e"]))
        still = F.filter(acc["open"], lambda g: g["e"] > h["s"])
        return F.struct(F.array_append(still, h).alias("open"), F.when(beaten, acc["kept"]).otherwise(F.array_append(acc["kept"], h)).alias("kept"))

    kept = F.aggregate(ordered, F.struct(none.alias("open"), none.alias("kept")), step)["kept"]
    return F.sort_array(F.transform(kept, lambda h: F.struct(
        h["place"].alias("place"), h["label"].alias("label"), h["score"].alias("score"), h["s"].alias("s"), h["e"].alias("e")
    )))


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` and
    ``hits`` for every row: counts and labels of the base phrases, and of all detections;
    the score is that of the surest one, 1 for a base phrase, 0 for none."""
    name = fresh(docs, "scan")
    base, hits = F.col(f"{name}.x.base"), F.col(f"{name}.x.hits")
    labels = lambda *xs: F.array_join(F.sort_array(F.array_distinct(F.concat(*xs))), ",")
    of = lambda xs: F.transform(xs, lambda x: x["label"])
    starts = F.transform(base, lambda x: x["s"].cast("bigint"))
    best = F.array_max(F.transform(hits, lambda x: x["score"]))
    return detections(docs, name).select(
        "doc_id", F.col(f"{name}.n_words").alias("n_words"), F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(of(base)).alias("base_labels"), labels(of(base), of(hits)).alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"), hits.alias("hits"),
    )
