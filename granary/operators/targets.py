"""Which companies to work on, and who they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import EDGE, SPACE, first_match, normalize_org, normalize_spaces


def pending_targets(targets: DataFrame, observations: DataFrame, rescan: bool = False) -> DataFrame:
    """Targets without an observation; with `rescan` all, flagged where there is one."""
    done = observations.select("org").distinct()
    if not rescan:
        return targets.join(done, "org", "left_anti")
    return targets.join(done.withColumn("rescan_only", F.lit(True)), "org", "left").withColumn("rescan_only", F.coalesce("rescan_only", F.lit(False)))


def limit_targets(targets: DataFrame, n: int | None = None, only_org: str | None = None) -> DataFrame:
    """One org alone, or the first n by seq; apply after pending_targets(), as skipped ones don't count."""
    if only_org is not None:
        targets = targets.where(F.col("org") == only_org)
        if targets.isEmpty():
            targets = targets.sparkSession.createDataFrame([(only_org,)], "org string").join(targets, "org", "left")
    return targets if n is None else targets.orderBy("seq").limit(n)


def split_resolvable(targets: DataFrame) -> DataFrame:
    return targets.agg(F.count_if(F.col("org").isNotNull()).alias("with_org"), F.count_if(F.col("org").isNull()).alias("to_resolve"))


def profile_missing(observations: DataFrame, column: str = "org", n: int = 30) -> tuple[DataFrame, DataFrame]:
    """(total and missing counts, the first n rows without a value)."""
    absent = F.coalesce(F.col(column).cast("string"), F.lit("")) == ""
    return observations.agg(F.count("*").alias("total"), F.count_if(absent).alias("missing")), observations.where(absent).orderBy("seq").limit(n)


def lender_targets(observations: DataFrame, keywords: DataFrame) -> DataFrame:
    """(name, orgnr): a row an observation with at least one keyword."""
    return observations.join(keywords.select("org", "seq").distinct(), ["org", "seq"], "left_semi").select("seq", F.coalesce("name", F.lit("")).alias("name"), F.col("org").alias("orgnr"))


def clean_name(name: Column) -> Column:
    """Up to ' - ', without brackets and final exclamation marks, at most 140 characters."""
    out = F.substring_index(normalize_spaces(name), " - ", 1)
    out = F.regexp_replace(F.regexp_replace(out, "\\s*\\(.*?\\)\\s*", " "), "\\s*!+\\s*$", "")
    return F.trim(F.substring(normalize_spaces(out), 1, 140))


def name_tokens(name: Column) -> Column:
    parts = F.transform(F.split(F.lower(normalize_spaces(name)), " "), lambda x: F.regexp_replace(x, "[^0-9a-zåäö]", ""))
    return F.array_distinct(F.filter(parts, lambda x: F.length(x) >= 3))


def token_subsets(tokens: Column) -> Column:
    """Every one, two and three of an array's tokens, as structs (level, key); tokens are distinct and in order."""
    behind = lambda i: F.slice(tokens, i + 2, F.size(tokens))
    entry = lambda level, *parts: F.struct(F.lit(level).alias("level"), F.concat_ws(" ", *parts).alias("key"))
    pairs = F.flatten(F.transform(tokens, lambda x, i: F.transform(behind(i), lambda y: entry(2, x, y))))
    threes = F.flatten(F.transform(tokens, lambda x, i: F.flatten(F.transform(behind(i), lambda y, j: F.transform(behind(i + j + 1), lambda z: entry(3, x, y, z))))))
    return F.concat(F.transform(tokens, lambda x: entry(1, x)), pairs, threes)


def resolve_by_name(targets: DataFrame, registry: DataFrame) -> DataFrame:
    """(target_id, query, org, candidate, score): the registry's best match of each target's name.

    targets: (target_id, name); registry: (org, name, seq). A candidate's score is its number of shared tokens, one more
    where both names hold "ab"; one with a score of 3 wins by its place in the registry, others by score, then place.

    As a score counts up to 3 only, what decides is the first candidate of each one, two and three tokens: one row a
    subset, made by an aggregate that is combined before its shuffle. A query meets those of its own subsets, so the
    joined rows follow the queries, and a token that is in a third of all names costs no more than another.
    """
    has_ab = lambda c: F.col(c).rlike(f"(?iu){EDGE}ab{EDGE}")
    cleaned = targets.select("target_id", clean_name(F.col("name")).alias("query"))
    tokens = lambda c: F.array_sort(name_tokens(F.col(c)))
    asked = cleaned.select("query").where("query != ''").distinct().select("query", has_ab("query").alias("asked_ab"), F.explode(token_subsets(tokens("query"))).alias("s"))
    first = F.min(F.struct("seq", "org", "candidate")).alias("first")
    named = registry.select("org", F.col("name").alias("candidate"), "seq", tokens("name").alias("tokens"))
    known = named.groupBy("tokens", has_ab("candidate").alias("ab")).agg(first).select("ab", "first", F.explode(token_subsets(F.col("tokens"))).alias("s"))
    known = known.groupBy("s", "ab").agg(F.min("first").alias("first"))
    reached = F.least(F.lit(3), F.col("s.level") + (F.col("asked_ab") & F.col("ab")).cast("int"))
    best = asked.join(known, "s").groupBy("query").agg(F.min(F.struct((-reached).alias("_"), "first")).alias("b")).select("query", "b.first.org", "b.first.candidate")
    shared = F.size(F.array_intersect(name_tokens(F.col("query")), name_tokens(F.col("candidate"))))
    score = shared.cast("long") + (has_ab("query") & has_ab("candidate")).cast("int")
    return cleaned.join(best.withColumn("score", score), "query").select("target_id", "query", "org", "candidate", "score")


def org_from_page(url: Column, html: Column) -> Column:
    """The org in a company link of url or html, else the first hyphenated, else the first bare ten digits."""
    linked = "f(?:ö|%C3%B6|o)retagsinformation/(?:[^/\"'\\s]+/)?([0-9]{6}-?[0-9]{4})"
    text = F.regexp_replace(html, "<[^>]*>", " ")
    found = F.coalesce(first_match(url, f"(?i){linked}"), first_match(html, f"(?i){linked}"), first_match(text, "(?<![0-9])([0-9]{6}-[0-9]{4})(?![0-9])"), first_match(text, "(?<![0-9])([0-9]{10})(?![0-9])"))
    return normalize_org(found)


def flatten_html(html: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(html, "<[^>]*>", " "), f"{SPACE}+", " ")
