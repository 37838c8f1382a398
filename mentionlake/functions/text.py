"""Column expressions for text: whitespace, sentences, letter runs, word tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and \s treat as whitespace,
# written so that Java and RE2 read the class alike.
WS_CHARS = (
    r"\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WS = f"[{WS_CHARS}]"
WS_LIST = (
    " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Dash-like characters an ASCII hyphen in an alias may stand for.
DASH = r"[-\x{2010}\x{2011}\x{2012}\x{2013}\x{2014}\x{2212}]"

_BREAK = f"(?<=[.!?]){WS}+"

# The only characters outside ASCII whose lower case holds an ASCII letter.
FOLDS_TO_ASCII = r"[\x{0130}\x{212A}]"

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def strip(c: Column) -> Column:
    """Drop whitespace of any kind from both ends (``trim`` only knows spaces)."""
    return F.btrim(c, F.lit(WS_LIST))


def present(c: Column) -> Column:
    """Null where the stripped value is empty, else the stripped value."""
    return F.nullif(strip(c), F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def sentence_array(text: Column) -> Column:
    """Sentences in order. A break is whitespace after ``.``, ``!`` or ``?``; line
    breaks inside a sentence become spaces, so a heading without a full stop stays
    with the sentence that follows it."""
    return F.split(_flat(text), _BREAK)


def first_sentence(text: Column) -> Column:
    """The first of :func:`sentence_array`; the text behind it is neither cut nor copied."""
    return _flat(F.regexp_extract(text, f"(?s)^{WS}*+(.*?[.!?](?={WS})|.*)", 1))


def _flat(text: Column) -> Column:
    return F.replace(strip(text), F.lit("\n"), F.lit(" "))


def letter_runs_in_order(c: Column) -> Column:
    """Maximal runs of lower-case ASCII letters (input already lowered), repeats kept; the
    first and the last may be empty."""
    return F.split(c, "[^a-z]+")


def letter_runs(c: Column) -> Column:
    """Distinct maximal runs of lower-case ASCII letters (input already lowered)."""
    return F.array_distinct(letter_runs_in_order(c))


def words(c: Column) -> Column:
    """Lower-cased ASCII words in order, repeats kept."""
    return F.filter(F.split(F.lower(c), "[^a-z]+"), lambda w: w != "")


def phrase_text(c: Column) -> Column:
    """Lower-cased runs of letters and digits in any script, one space around each."""
    spaced = F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " ")
    return F.concat(F.lit(" "), F.trim(spaced), F.lit(" "))
