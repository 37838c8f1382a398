"""Resource dictionary: alias lists, exploded aliases, match patterns, name lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.functions.text import DASH, WS, WS_CHARS, ascii_lower, present
from mentionlake.operators.sizing import broadcast_if_small

# Prefixes that keep the three kinds of anchor apart: letter runs carry none.
GRAM = "#"
ANYWHERE = "*"
GRAM_LENGTH = 3


def latest_resources(table: DataFrame, limit: int | None = None) -> DataFrame:
    """Current resources; a limit takes the lowest ids so that reruns agree."""
    rows = table.where(F.col("is_latest") == 1).select(
        "id", "short_name", "common_name", "full_name"
    )
    return rows.orderBy("id").limit(limit) if limit else rows


def alias_lists(resources: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """``resource_id, names``: short, common and full name without repeats, then the
    extra aliases of that short name as they come (repeats allowed).

    ``extra`` holds ``short_name, aliases``. Resources left without any name keep an
    empty list; see :func:`nameless`.
    """
    rows = resources.select(
        F.col("id").alias("resource_id"),
        present("short_name").alias("short_name"),
        present("common_name").alias("common_name"),
        present("full_name").alias("full_name"),
    )
    short, common, full = F.col("short_name"), F.col("common_name"), F.col("full_name")
    own = F.array(
        short,
        F.when(~common.eqNullSafe(short), common),
        F.when(~full.eqNullSafe(short) & ~full.eqNullSafe(common), full),
    )
    own = F.filter(own, lambda x: x.isNotNull())
    if extra is None:
        return rows.select("resource_id", own.alias("names"))
    empty = F.array().cast("array<string>")
    return rows.join(broadcast_if_small(extra), "short_name", "left").select(
        "resource_id", F.concat(own, F.coalesce("aliases", empty)).alias("names")
    )


def nameless(lists: DataFrame) -> DataFrame:
    return lists.where(F.size("names") == 0).select(
        "resource_id", F.lit("no name").alias("reason")
    )


def explode_aliases(
    lists: DataFrame, case_sensitive: Sequence[str] = (), position: str | None = None
) -> DataFrame:
    """One row per alias; element 0 is the display name. The case-sensitive list holds
    display names, so all aliases of a listed resource match case-sensitively."""
    name = F.col("names")[0]
    keep = [position] if position else []
    return (
        lists.where(F.size("names") > 0)
        .select("resource_id", *keep, name.alias("resource_name"), F.posexplode("names"))
        .select(
            "resource_id",
            *keep,
            "resource_name",
            F.col("col").alias("alias"),
            F.col("pos").alias("alias_pos"),
            F.col("resource_name").isin(list(case_sensitive)).alias("case_sensitive"),
        )
    )


def parse_name_list(value: str) -> list[str]:
    """Comma-separated option value to names, blanks dropped."""
    return [x.strip() for x in value.split(",") if x.strip()]


def escape_regex(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\^$.|?*+()\[\]{}])", r"\\$1")


def flexible_core(c: Column) -> Column:
    """A space matches any whitespace, a hyphen any dash, a dot may be absent."""
    core = F.replace(escape_regex(c), F.lit("-"), F.lit(DASH))
    core = F.replace(core, F.lit(" "), F.lit(f"{WS}+"))
    return F.replace(core, F.lit(r"\."), F.lit(r"\.?"))


def alias_patterns(
    aliases: DataFrame, boundary: str = "lookaround", token_counts: DataFrame | None = None, neighbours: bool = False
) -> DataFrame:
    """Adds what detection needs to each alias.

    ``norm``      the alias as compared (lowered unless case-sensitive)
    ``core``      the regex body
    ``literal``   the strict body of the volume re-check, original case
    ``plain``     the alias is one run of letters: finding its anchor proves the match
    ``anchors``   tokens, one of which is in every sentence the alias matches

    ``token_counts`` (``token, n``, from :func:`~mentionlake.operators.detect.token_counts`)
    lets an alias of several words be looked up by its rarest word, not its longest; with
    ``neighbours`` the anchor of such an alias is two words that stand side by side, with a
    space between them, whatever parts them in the alias.
    """
    cs = F.col("case_sensitive")
    norm = F.when(cs, F.col("alias")).otherwise(F.lower("alias"))
    rows = aliases.withColumn("norm", norm).withColumn("literal", escape_regex(F.col("alias")))
    if boundary == "lookaround":
        core, plain = flexible_core(F.col("norm")), ~cs & F.col("norm").rlike("^[a-z]+$")
    elif boundary == "consuming":
        core, plain = escape_regex(F.col("norm")), F.lit(False)
    else:
        raise ValueError("boundary must be 'lookaround' or 'consuming'")
    folded = F.when(cs, ascii_lower(F.col("alias"))).otherwise(F.lower("alias"))
    rows = rows.withColumn("core", core).withColumn("plain", plain).withColumn("_folded", folded)
    return _with_anchors(rows, boundary == "lookaround", token_counts, neighbours)


def _with_anchors(
    rows: DataFrame, dots_optional: bool, token_counts: DataFrame | None, neighbours: bool
) -> DataFrame:
    """Letters next to a match are forbidden, so a letter run of the alias is a whole
    letter run of the sentence too, unless a dot beside it is optional: in ``U.S.A``
    the first run seen is ``u``, ``us`` or ``usa``. One stretch of letters and dots
    is picked, runs without such a dot first, then the longest; its possible first
    runs are the anchors. Aliases without letters are found by a short piece of their
    other characters, and those made of spaces, dashes and dots by every sentence.
    Two runs without such a dot that are neighbours in the alias, are so in the sentence."""
    keep = "a-z." if dots_optional else "a-z"
    steps = {
        "_runs": f"""transform(filter(split(_folded, r'[^{keep}]+'), s -> s rlike '[a-z]'),
            s -> filter(split(s, r'[.]+'), r -> r <> ''))""",
        "_best": """get(_runs, array_min(transform(_runs, (r, i) ->
            named_struct('dotted', size(r) > 1, 'len', -length(r[0]), 'i', i))).i)""",
        "_solid": f"filter(split(norm, r'[{WS_CHARS}.A-Za-z{DASH[1:]}+'), s -> s <> '')",
        "_longest": "array_max(transform(_solid, s -> named_struct('n', length(s), 's', s))).s",
        "anchors": f"""CASE
            WHEN size(_runs) > 0 THEN array_distinct(transform(sequence(1, size(_best)),
                n -> array_join(slice(_best, 1, n), '')))
            WHEN size(_solid) > 0 THEN array('{GRAM}' || substring(_longest, 1, {GRAM_LENGTH}))
            ELSE array('{ANYWHERE}') END""",
    }
    if neighbours:
        steps["_pairs"] = """filter(transform(slice(_runs, 1, greatest(size(_runs) - 1, 0)), (r, i) ->
            IF(size(r) = 1 AND size(_runs[i + 1]) = 1, r[0] || ' ' || _runs[i + 1][0], NULL)), p -> p IS NOT NULL)"""
        longest = "array_max(transform(_pairs, p -> named_struct('n', length(p), 'p', p))).p"
        steps["anchors"] = f"CASE WHEN size(_pairs) > 0 THEN array({longest}) ELSE ({steps.pop('anchors')}) END"
    for name, sql in steps.items():
        rows = rows.withColumn(name, F.expr(sql))
    if token_counts is not None:
        single = "transform(filter(_runs, r -> size(r) = 1), r -> r[0])"
        words = rows.select("_folded", F.explode(F.expr(single)).alias("token")).distinct()
        rarest = words.join(token_counts, "token", "left").groupBy("_folded").agg(
            F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("_rarest")
        )
        chosen = F.when(F.col("_rarest").isNotNull(), F.array("_rarest")).otherwise(F.col("anchors"))
        rows = rows.join(rarest, "_folded", "left").withColumn("anchors", chosen).drop("_rarest")
    return rows.drop("_folded", "_runs", "_best", "_solid", "_longest", "_pairs")


def name_to_id(dictionary: DataFrame) -> DataFrame:
    """Alias to resource id; of several resources with the alias the last one wins."""
    return dictionary.where(F.col("alias").isNotNull()).groupBy("alias").agg(
        F.max_by("resource_id", F.struct("resource_pos", "alias_pos")).alias("resource_id")
    )
