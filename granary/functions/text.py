"""Column expressions over text. White space includes the no-break space; word edges are those of ASCII letters."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CORE_BRANCHES, RULES, SECONDARY_BRANCHES, Rules

SPACE = "[\\s\\u00A0\\uFEFF]"
EDGE = "(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"


def normalize_spaces(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, f"{SPACE}+", " "))


def normalize_org(raw: Column) -> Column:
    """Ten digits, or null."""
    digits = F.trim(F.regexp_replace(raw, "-", ""))
    return F.when(digits.rlike("^[0-9]{10}$"), digits)


def parse_money(value: Column, rules: Rules = RULES) -> Column:
    """Leading whole number of what is left after all but digits and minus signs is dropped; null beyond the sanity limit."""
    return sane_money(whole_number(unspaced(value)), rules)


# The three steps of parse_money(). A step names its input several times, so columns that are read often give each a projection
# of its own; in one they are worked out again at each place.
def unspaced(value: Column) -> Column:
    return F.replace(value.cast("string"), F.lit(" "), F.lit(""))


def whole_number(bare: Column) -> Column:
    """A plain number is read as it stands; only other texts need the patterns. (A cast would cut at a point.)"""
    left = F.regexp_extract(F.regexp_replace(bare, "[^0-9-]", ""), "^-?[0-9]+", 0).try_cast("bigint")
    plain = F.when(~F.contains(bare, F.lit(".")), bare.try_cast("bigint"))
    return F.when(~bare.isin("", "-"), F.coalesce(plain, left))


def sane_money(number: Column, rules: Rules = RULES) -> Column:
    return F.when(F.abs(number) <= rules.sanity_limit, number)


def normalize_label(label: Column, rules: Rules = RULES) -> Column:
    return label_of(lowered(label), rules)


def lowered(label: Column) -> Column:
    return F.lower(normalize_spaces(label))


def label_of(low: Column, rules: Rules = RULES) -> Column:
    """normalize_label() of what lowered() gives."""
    out = F.lit(None).cast("string")
    for pattern, name in reversed(rules.label_rules):
        out = F.when(low.rlike(pattern), name).otherwise(out)
    return out


def canonical_key(key: Column) -> Column:
    return F.regexp_replace(key, "[^0-9A-Za-zÅÄÖåäö]", "")


def numeric_tokens(line: Column, most: int) -> Column:
    """Digits of the first `most` numbers, with thousands separators and decimal marks taken out."""
    found = F.regexp_extract_all(line, F.lit("-?[0-9]{1,4}(?:[ \\u00A0.][0-9]{3})+(?:[.,][0-9]+)?|-?[0-9]+(?:[.,][0-9]+)?"), F.lit(0))
    bare = F.transform(found, lambda x: F.regexp_replace(x, "[ \\u00A0.,]", ""))
    return F.slice(F.filter(bare, lambda x: F.length(F.regexp_replace(x, "-", "")) <= 18), 1, most)


def classify_branch(branch: Column) -> Column:
    """'' / core / secondary / other."""
    any_of = lambda words: f"(?iu){EDGE}(?:{'|'.join(words)})"
    return (
        F.when(F.coalesce(branch, F.lit("")) == "", "")
        .when(branch.rlike(any_of(CORE_BRANCHES)), "core")
        .when(branch.rlike(any_of(SECONDARY_BRANCHES)), "secondary")
        .otherwise("other")
    )


def join_keywords(words: Column) -> Column:
    """Distinct, trimmed, in Swedish order, joined by semicolons."""
    clean = F.filter(F.array_distinct(F.transform(words, lambda x: F.trim(x))), lambda x: x != "")
    ordered = F.array_sort(F.transform(clean, lambda x: F.collate(x, "sv")))
    return F.array_join(F.transform(ordered, lambda x: F.collate(x, "UTF8_BINARY")), ";")


def join_lines(lines: Column) -> Column:
    """`key: line` of each item once, in order."""
    said = F.transform(lines, lambda x: F.when(F.coalesce(x["key"], F.lit("")) != "", F.concat(x["key"], F.lit(": "), F.trim(x["line"]))).otherwise(F.trim(x["line"])))
    return F.array_join(F.array_distinct(F.filter(said, lambda x: x != "")), " || ")


def to_number(s: Column) -> Column:
    return F.nullif(F.trim(s), F.lit("")).try_cast("double")


def hostname(url: Column) -> Column:
    return F.regexp_replace(F.try_parse_url(url, F.lit("HOST")), "^www\\.", "")


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def format_revenue(v: Column) -> Column:
    size = F.abs(v)
    millions = F.translate(F.format_string("%.1f", F.round(v / 1e5) / 10), ".", ",")
    grouped = lambda x: F.translate(F.format_number(x, 0), ",", "\u00A0")
    return F.when(size >= 1_000_000, F.concat(millions, F.lit(" Mkr"))).when(size >= 1000, F.concat(grouped(F.round(v / 1000)), F.lit(" tkr"))).when(v.isNotNull(), F.concat(grouped(v), F.lit(" kr"))).otherwise("")


def format_debt(s: Column) -> Column:
    """Digits in groups of three behind no-break spaces, or '' for zero and what is no number."""
    number = F.trim(s).try_cast("bigint")
    return F.when(F.coalesce(number, F.lit(0)) == 0, "").otherwise(F.concat(F.translate(F.format_number(number, 0), ",", "\u00A0"), F.lit(" kr")))


def shorten_debt_label(label: Column) -> Column:
    """Known phrases shortened in turn; beyond 30 characters 28 and an ellipsis."""
    # fixed values: the displayed abbreviations
    rules = (
        ("Övriga skulder till kreditinstitut", "Övr. skulder kreditinst."),
        ("Skulder till kreditinstitut", "Skulder kreditinst."),
        ("Checkräkningskredit", "Checkräkning"),
        ("hos banker och andra kreditinstitut.*$", "Kreditinstitut"),
    )
    short = label
    for pattern, replacement in rules:
        short = F.regexp_replace(short, f"(?iu){pattern}", replacement)
    return F.when(F.length(short) > 30, F.concat(F.substring(short, 1, 28), F.lit("…"))).otherwise(short)


def icp_badge(score: Column) -> Column:
    return F.when(score >= 10, "green").when(score >= 7, "blue").otherwise("grey")


def literal_pattern(words: tuple[str, ...]) -> str:
    return "(?iu)" + "|".join(re.escape(w) for w in words)
