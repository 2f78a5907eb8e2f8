"""Observations to one scored row an org."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import FIGURE_RULES, RULES, Rules
from ..functions.text import canonical_key, join_keywords, numeric_tokens
from .fold import FIELDS, fold_states, leads_of_states


def merge_observations(observations: DataFrame, finance: DataFrame | None = None, keywords: DataFrame | None = None, rules: Rules = RULES, compat: bool = False, scanned: DataFrame | None = None) -> DataFrame:
    """One row an org; each field is the first that says something (see operators.fold, whose inputs these are).

    With `compat`, missing employees count as 0 and so block later ones.
    """
    return leads_of_states(fold_states(observations, finance, keywords, rules, compat, scanned if keywords is not None else None), rules)


def union_keywords(keywords: DataFrame, first_seq: DataFrame | None = None, scanned: DataFrame | None = None) -> DataFrame:
    """(org, lender_keywords): every keyword of an org's observations (org, seq, keyword).

    Keywords scanned from report files join in only where the org's first observation (first_seq: org, first_seq)
    has none of its own.
    """
    words = keywords.select("org", "keyword")
    if scanned is not None and first_seq is not None:
        own = keywords.join(first_seq, "org").where("seq = first_seq").select("org").distinct()
        words = words.unionByName(scanned.select("org", "keyword").join(own, "org", "left_anti"))
    return words.groupBy("org").agg(join_keywords(F.collect_set("keyword")).alias("lender_keywords"))


def icp_score(leads: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Adds icp_score and icp_reasons: points for form, revenue, employees, age, branch and lender debt."""
    between = lambda c, a, b: F.col(c).between(a, b)
    soft = lambda c, most: (F.col(c) > 0) & (F.col(c) <= most)
    age = F.when(F.col("reg_year") > 1900, F.col("company_age"))
    points = [
        ("AB", 1, F.col("is_ab")),
        ("revenue_core", 2, between("revenue", rules.revenue_min, rules.revenue_max)),
        ("revenue_soft", 1, soft("revenue", rules.revenue_soft_max) & ~between("revenue", rules.revenue_min, rules.revenue_max)),
        ("employees_core", 2, between("employees", rules.employees_min, rules.employees_max)),
        ("employees_soft", 1, soft("employees", rules.employees_soft_max) & ~between("employees", rules.employees_min, rules.employees_max)),
        ("age_core", 2, age >= rules.age_preferred),
        ("age_soft", 1, (age >= rules.age_min) & (age < rules.age_preferred)),
        ("branch_core", 2, F.col("branch_segment") == "core"),
        ("branch_secondary", 1, F.col("branch_segment") == "secondary"),
        ("has_lender_debt", 2, F.col("lender_keywords") != ""),
    ]
    holds = [(name, n, F.coalesce(c, F.lit(False))) for name, n, c in points]
    score = sum((F.when(c, n).otherwise(0) for _, n, c in holds), F.lit(0))
    reasons = F.concat_ws(",", *[F.when(c, name) for name, _, c in holds])
    return leads.withColumns({"icp_score": score, "icp_reasons": reasons})


def icp_breakdown(scored: DataFrame) -> DataFrame:
    band = F.when(F.col("icp_score") >= 6, "strong").when(F.col("icp_score") >= 3, "warm").otherwise("weak")
    return scored.groupBy(band.alias("band")).agg(F.count("*").alias("n"))


def rank_leads(scored: DataFrame) -> DataFrame:
    """Best first, ties by first seen: a range-partitioned sort, for sinks."""
    return scored.orderBy(F.desc("icp_score"), "first_seq")


def score_leads(observations: DataFrame, finance: DataFrame, keywords: DataFrame, rules: Rules = RULES, scanned: DataFrame | None = None) -> DataFrame:
    """The whole fold: one aggregate by org, then the score."""
    return icp_score(merge_observations(observations, finance, keywords, rules, scanned=scanned), rules)


OF_FIELDS = (*FIELDS, "company_age", "branch_segment")
OF_FINANCE = (*FIGURE_RULES, "revenue_year")
OF_KEYWORDS = ("lender_keywords",)
OF_SCORE = ("icp_score", "icp_reasons")


def first_observations(observations: DataFrame) -> DataFrame:
    """(org, seq, is_ab): where an org is first observed, and its form.

    Both are of fixed width, so rows are folded by hash as they are read; states of texts and of places have each task sort
    all of its rows first, and a task of a file's scan reads a whole row group.
    """
    return observations.groupBy("org").agg(F.min("seq").alias("seq"), F.bool_or("is_ab").alias("is_ab"))


def select_leads(columns: list[str], observations: DataFrame, finance: DataFrame | None = None, keywords: DataFrame | None = None, rules: Rules = RULES, scanned: DataFrame | None = None) -> DataFrame:
    """The given columns of score_leads(), from no more inputs than they ask for.

    An aggregate over a union keeps every branch, so that a plan for names alone would read and parse all finance values.
    Where no field of observations is asked for, only the first of each org goes into the fold.
    """
    asked = set(columns)
    scored = bool(asked & set(OF_SCORE))
    of_finance, of_words = (finance if scored or asked & set(OF_FINANCE) else None), (keywords if scored or asked & set(OF_KEYWORDS) else None)
    if not scored and not asked & set(OF_FIELDS):
        observations = first_observations(observations)
    merged = merge_observations(observations, of_finance, of_words, rules, scanned=scanned if of_words is not None else None)
    return (icp_score(merged, rules) if scored else merged).select(*columns)


MOST_LINES, MOST_NUMBERS = 10, 10  # of a key and of a line


def structured_lines(items: DataFrame, ceilings: DataFrame | None = None, separators: bool = False) -> DataFrame:
    """(org, key, n, line, idx, numbers): the n-th line of each key, cell by cell the first that says something.

    items: (org, seq, pos, key, line, idx, values), as files.matched_items() gives them. Keys are canonical; of an
    observation the first ten lines of a key count, with the ten first of the values given, or else of the numbers
    in the line. Given values lose their separators unless they are asked for. ceilings: (org, ceiling); greater
    numbers leave their cell to a later observation.
    """
    key = canonical_key(F.coalesce(F.nullif("key", F.lit("")), F.lit("Unknown")))
    named = items.where(F.trim(F.coalesce("line", F.lit(""))) != "").select("org", "seq", "pos", "line", "idx", "values", key.alias("_named"))
    # by a generator: filters for keys would be moved below the pattern and ask for it again
    kept = named.select("org", "seq", "pos", "line", "idx", "values", F.explode(F.when(F.col("_named") != "", F.array("_named"))).alias("_key"))
    order = F.row_number().over(Window.partitionBy("org", "seq", "_key").orderBy("pos"))
    kept = kept.withColumn("n", order).where(F.col("n") <= MOST_LINES)
    whole = lambda v: F.trim(F.replace(F.coalesce(v, F.lit("")), F.lit("\u00A0"), F.lit(" ")))
    bare = whole if separators else lambda v: F.regexp_replace(F.coalesce(v, F.lit("")), "[\\s\u00A0.,]", "")
    numbers = F.when(F.size("values") > 0, F.slice(F.transform("values", bare), 1, MOST_NUMBERS)).otherwise(numeric_tokens(F.col("line"), MOST_NUMBERS))
    kept = kept.withColumn("_numbers", numbers)
    if ceilings is not None:
        size = lambda v: F.abs(F.regexp_extract(F.regexp_replace(v, "\\s", ""), "^[+-]?[0-9]+", 0).try_cast("double"))
        fits = lambda v: F.when(~F.coalesce(size(v) > F.col("ceiling"), F.lit(False)), v)
        kept = kept.join(ceilings.select("org", "ceiling"), "org", "left").withColumn("_numbers", F.transform("_numbers", fits))
    first = lambda value, alias: F.min_by(value, F.when(F.coalesce(value.cast("string"), F.lit("")) != "", F.col("seq"))).alias(alias)
    cells = [first(F.get("_numbers", F.lit(k)), f"_n{k}") for k in range(MOST_NUMBERS)]
    out = kept.groupBy("org", "_key", "n").agg(first(F.col("line"), "line"), first(F.when(F.col("idx") != 0, F.col("idx")), "idx"), *cells)
    return out.select("org", F.col("_key").alias("key"), "n", "line", F.col("idx").cast("long").alias("idx"), F.array(*[f"_n{k}" for k in range(MOST_NUMBERS)]).alias("numbers"))


def line_columns(structured: DataFrame, key: str = "Kreditinstitut", lines: int = 2, numbers: int = 2) -> DataFrame:
    """(org, l1, l1_idx, l1_n1, ...): a key's first lines and numbers side by side."""
    at = lambda n, value: F.max(F.when(F.col("n") == n, value))
    columns = []
    for n in range(1, lines + 1):
        columns += [at(n, F.col("line")).alias(f"l{n}"), at(n, F.col("idx")).alias(f"l{n}_idx"), *[at(n, F.get("numbers", F.lit(k - 1))).alias(f"l{n}_n{k}") for k in range(1, numbers + 1)]]
    return structured.where((F.col("key") == key) & (F.col("n") <= lines)).groupBy("org").agg(*columns)


def wide_1year(items: DataFrame) -> DataFrame:
    """An org's first two credit institution lines with their first two numbers, as the one-year report has them."""
    return line_columns(structured_lines(items, separators=True))


def _said(key: Column, line: Column) -> Column:
    return F.when(F.coalesce(key, F.lit("")) != "", F.concat(F.trim(key), F.lit(": "), F.trim(line))).otherwise(F.trim(line))


def joined_lines(items: DataFrame, alias: str) -> DataFrame:
    """(org, alias): `key: line` of every line of an org once, in order; repeats go before anything is gathered."""
    each = items.where(F.trim(F.coalesce("line", F.lit(""))) != "").select("org", _said(F.when(F.col("key") != "Unknown", F.col("key")), F.col("line")).alias("said"), F.struct("seq", "pos").alias("place"))
    once = each.groupBy("org", "said").agg(F.min("place").alias("place"))
    return once.groupBy("org").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "said"))), lambda x: x["said"]), " || ").alias(alias))


def first_lines(items: DataFrame, alias: str) -> DataFrame:
    """(org, alias): all lines, repeats too, of an org's first observation that has any."""
    said = F.when(F.col("key") != "Unknown", F.concat("key", F.lit(": "), "line")).otherwise(F.col("line"))
    own = items.groupBy("org", "seq").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", said.alias("said")))), lambda x: x["said"]), " || ").alias("said"))
    return own.groupBy("org").agg(F.min_by("said", F.when(F.col("said") != "", F.col("seq"))).alias(alias))
