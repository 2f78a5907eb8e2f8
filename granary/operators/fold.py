"""The fold of observations as states that merge: one row an org, in any order and in any number of parts.

A state holds, of each field, the first value that says something together with the place where it was said. Of two
states the one said earlier stays, so states of parts merge to the state of the whole, repeated parts change nothing,
and a part that comes late still wins where its places are earlier. New observations therefore cost their own fold and a
merge with the table of states, whatever an org has said before.

A state's row is (org, first_seq, is_ab, a struct (at, value) of each field and figure, words, first_word, scans); what was
not among the inputs of a part has no column there. Orgs with a null key form one state; an org without an observation has
a state but no lead. Of equal places the smallest value counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FIGURE_RULES, RULES, Rules
from ..functions.text import classify_branch, join_keywords
from .facts import with_money

FIELDS = ("name", "email", "phone", "reg_year", "employees", "branch", "sni_code")
SETS = ("words", "scans")


def _finance_marks(finance: DataFrame, rules: Rules) -> DataFrame:
    """Finance rows with a value, their place among an org's, and the figures that each is for, a bit each.

    Rows go by a generator, not by a filter: that would be moved below the patterns and so ask for them twice.
    """
    if "value" not in finance.columns:
        finance = with_money(finance, {"value": "raw_value"}, rules)
    kinds = sum((F.when(F.col("raw_label").rlike(f"(?iu){pattern}"), 1 << i).otherwise(0) for i, pattern in enumerate(FIGURE_RULES.values())), F.lit(0))
    read = finance.select("org", "seq", "tbl_idx", "pos", "year", "value", kinds.alias("_kinds"))
    figure = F.struct((F.col("value") * rules.multiplier).cast("bigint").alias("value"), F.col("year").cast("int").alias("year"))
    row = F.struct("_kinds", figure.alias("_figure"), F.struct("seq", "tbl_idx", "pos").alias("_place"))
    return read.select("org", F.inline(F.when((F.col("_kinds") > 0) & F.col("value").isNotNull(), F.array(row))))


def _earliest(value: Column, at: str, when: Column) -> Column:
    return F.min(F.when(when, F.struct(F.col(at).alias("at"), value.alias("value"))))


def fold_states(observations: DataFrame, finance: DataFrame | None = None, keywords: DataFrame | None = None, rules: Rules = RULES, compat: bool = False, scanned: DataFrame | None = None) -> DataFrame:
    """The states of observations (org, seq, is_ab, and of name, email, phone, reg_year, employees, branch, sni_code what there is), of
    finance_rows() or newest_cells(), of (org, seq, keyword) and of (org, keyword) scanned from report files.

    The inputs go through one aggregate by org, so they meet in one shuffle, folded before it.
    """
    fields = [c for c in FIELDS if c in observations.columns]
    rows = observations.select("org", F.col("seq").alias("_at"), "is_ab", *fields)
    if finance is not None:
        rows = rows.unionByName(_finance_marks(finance, rules), allowMissingColumns=True)
    if keywords is not None:
        rows = rows.unionByName(keywords.select("org", F.col("seq").alias("_word_at"), F.col("keyword").alias("_word")), allowMissingColumns=True)
    if scanned is not None:
        rows = rows.unionByName(scanned.select("org", F.col("keyword").alias("_scanned")), allowMissingColumns=True)
    own = F.col("_at").isNotNull()
    said = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    staff = F.coalesce("employees", F.lit(0)) if compat else F.col("employees")
    says = {"name": said("name") & (F.col("name") != "Unknown"), "reg_year": F.coalesce(F.col("reg_year"), F.lit(0)) != 0, "employees": staff.isNotNull()}
    parts = [F.min("_at").alias("first_seq"), F.bool_or("is_ab").alias("is_ab")]
    parts += [_earliest(staff if c == "employees" else F.col(c), "_at", own & (says[c] if c in says else said(c))).alias(c) for c in fields]
    if finance is not None:
        parts += [_earliest(F.col("_figure"), "_place", F.col("_kinds").bitwiseAND(1 << i) != 0).alias(n) for i, n in enumerate(FIGURE_RULES)]
    if keywords is not None:
        parts += [F.collect_set("_word").alias("words"), F.min("_word_at").alias("first_word")]
    if scanned is not None:
        parts.append(F.collect_set("_scanned").alias("scans"))
    return rows.groupBy("org").agg(*parts)


def merge_states(*parts: DataFrame) -> DataFrame:
    """One state an org of the states of all parts."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    each = []
    for c in union.columns:
        if c in SETS:
            each.append(F.array_distinct(F.flatten(F.collect_list(c))).alias(c))
        elif c != "org":
            each.append((F.bool_or(c) if c == "is_ab" else F.min(c)).alias(c))
    return union.groupBy("org").agg(*each)


def leads_of_states(states: DataFrame, rules: Rules = RULES) -> DataFrame:
    """One row an org that has an observation: the values of its state, and what follows from them.

    Keywords scanned from report files count where the org's first observation has no keyword of its own.
    """
    has = set(states.columns)
    value = lambda c: F.col(f"{c}.value")
    plain = [(F.coalesce(value(c), F.lit("Unknown")) if c == "name" else value(c)).alias(c) for c in FIELDS if c in has]
    out = states.where(F.col("first_seq").isNotNull())
    more = {"company_age": F.lit(rules.as_of_year) - value("reg_year")} if "reg_year" in has else {}
    if "branch" in has:
        more["branch_segment"] = classify_branch(value("branch"))
    if "revenue" in has:
        more |= {"revenue_year": F.col("revenue.value.year")} | {n: F.col(f"{n}.value.value") for n in FIGURE_RULES}
    if "words" in has:
        words = F.coalesce("words", F.array().cast("array<string>"))
        if "scans" in has:
            words = F.when(F.col("first_word").eqNullSafe(F.col("first_seq")), words).otherwise(F.concat(words, F.coalesce("scans", F.array().cast("array<string>"))))
        more["lender_keywords"] = F.coalesce(join_keywords(words), F.lit(""))
    return out.select("org", "first_seq", F.coalesce("is_ab", F.lit(False)).alias("is_ab"), *plain, *[c.alias(n) for n, c in more.items()])
