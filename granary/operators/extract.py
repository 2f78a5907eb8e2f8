"""Contacts, company facts, finance tables and report links out of texts and pages, in built-in functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import RULES, Rules
from ..functions.text import EDGE, SPACE, first_match, normalize_spaces
from .pages import debts_of, finance_of, scan_tables

EMAIL = f"{EDGE}[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}{EDGE}"
PHONE = "^\\+?[0-9][0-9\\s\\-()]{6,}[0-9]$"


def _if_any(low: Column, words: tuple[str, ...], found: Column) -> Column:
    """found, or null where none of the words is in `low`: a search for a word costs a fraction of a pattern's."""
    return F.when(reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words]), found)


def _small(text: Column) -> Column:
    """Small letters, and as such those that patterns take for s and i in any case."""
    plain = reduce(lambda t, c: F.replace(t, F.lit(c[0]), F.lit(c[1])), (("\u017F", "s"), ("\u0131", "i"), ("\u0130", "i")), text)
    return F.lower(plain)


def _all(s: Column, pattern: str, group: int = 0) -> Column:
    return F.coalesce(F.regexp_extract_all(s, F.lit(pattern), F.lit(group)), F.array().cast("array<string>"))


def text_phones(text: Column) -> Column:
    """Numbers that begin with a plus sign, line by line, without white space, each once."""
    found = _all(text, "\\+[0-9][0-9 \\t\\f\\x0B\\-()]{6,}[0-9]")
    bare = F.transform(found, lambda v: F.regexp_replace(v, f"{SPACE}+", ""))
    return F.array_distinct(F.filter(bare, lambda v: v.rlike(PHONE)))


def extract_contacts(pages: DataFrame, *keys: str) -> DataFrame:
    """(keys, email, phone, emails, phones) of html pages: marked details first, then links, then the page's text."""
    pages = pages.withColumn("_low", F.lower("html"))  # patterns of html know no case of letters beyond a to z
    none = F.array().cast("array<string>")
    of_html = lambda word, pattern: F.coalesce(_if_any(F.col("_low"), (word,), _all(F.col("html"), pattern, 1)), none)
    details = F.transform(of_html("data-census-details", "(?i)data-census-details\\s*=\\s*[\"']([^\"']*)[\"']"), normalize_spaces)
    mails = of_html("mailto:", "(?i)href\\s*=\\s*[\"']\\s*mailto:([^\"'?]*)")
    tels = of_html("tel:", "(?i)href\\s*=\\s*[\"']\\s*tel:([^\"']*)")
    bare = lambda a: F.filter(F.transform(a, lambda v: F.regexp_replace(v, f"{SPACE}+", "")), lambda v: v.rlike(PHONE))
    text = F.regexp_replace(F.regexp_replace("html", "(?i)<br[^>]*>|</(p|div|li|tr|h[1-6])>", "\n"), "<[^>]*>", "")
    emails = F.array_distinct(F.filter(F.concat(details, mails), lambda v: v.rlike(EMAIL)))
    of_text = F.coalesce(_if_any(F.col("_low"), ("+",), text_phones(text)), none)
    phones = F.array_distinct(F.concat(bare(details), bare(tels), of_text))
    return pages.select(*keys, emails.alias("emails"), phones.alias("phones")).withColumns({"email": F.try_element_at("emails", F.lit(1)), "phone": F.try_element_at("phones", F.lit(1))})


def text_contacts(texts: DataFrame, *keys: str) -> DataFrame:
    """(keys, email, phone, n_emails, n_phones) of plain texts."""
    out = texts.select(*keys, F.array_distinct(_all(F.col("text"), EMAIL)).alias("emails"), text_phones(F.col("text")).alias("phones"))
    return out.select(*keys, F.try_element_at("emails", F.lit(1)).alias("email"), F.try_element_at("phones", F.lit(1)).alias("phone"), F.size("emails").alias("n_emails"), F.size("phones").alias("n_phones"))


def company_facts(texts: DataFrame, *keys: str, rules: Rules = RULES) -> DataFrame:
    """(keys, is_ab, reg_year, employees, branch, sni_code): the first pattern that gives a sound value counts."""
    t = texts.select(*keys, normalize_spaces(F.col("text")).alias("t")).withColumn("_low", _small(F.col("t")))
    body, small = F.col("t"), F.col("_low")

    def first_number(patterns: tuple[str, ...], words: tuple[str, ...], low: int, high: int) -> Column:
        values = [first_match(body, p).try_cast("int") for p in patterns]
        return _if_any(small, words, F.coalesce(*[F.when(v.between(low, high), v) for v in values]))

    # fixed values: the phrases that company pages use
    registered = tuple(f"(?iu){p}[^0-9]{{0,20}}([0-9]{{4}})" for p in ("registrerat", "bolaget registrerat", "registreringsdatum", "bildat"))
    staff = ("(?iu)antal\\s+anst[äa]llda[^0-9]{0,5}([0-9]{1,5})", "(?iu)anst[äa]llda[^0-9]{0,5}([0-9]{1,5})", "(?iu)([0-9]{1,5})\\s*anst[äa]llda")
    stop = "(?iu)(?:\\s[0-9]{4,6}[·\\s]|årsredovisning|visa bolagsdata|öppna karta|besöksadress|vägbeskrivning)"
    cut = lambda raw: F.nullif(F.substring(F.trim(F.regexp_replace(F.regexp_replace(raw, f"(?<=.){stop}.*$", ""), "\\s*[0-9].*$", "")), 1, 80), F.lit(""))
    coded = _if_any(body, ("·",), cut(first_match(body, f"{EDGE}[0-9]{{4,6}}·([A-Za-zÀ-öø-ÿ][^·]{{2,150}})")))
    branch = lambda word, p: _if_any(small, (word,), cut(F.regexp_replace(first_match(body, f"(?iu){p}[:\\s]+(.{{3,200}})"), "^[0-9]{4,6}[·\\s]*", "")))
    named = [branch(w, p) for w, p in (("bransch", "bransch"), ("verksamhetsbeskrivning",) * 2, ("huvudsaklig", "huvudsaklig\\s+verksamhet"))]
    sni = _if_any(small, ("sni",), F.regexp_replace(first_match(body, f"(?iu){EDGE}sni[-\\s]?kod[:\\s]*([0-9][0-9.\\s]{{1,10}})"), "\\s+", ""))
    limited = lambda among, word, pattern: F.contains(among, F.lit(word)) & body.rlike(pattern)
    is_ab = limited(small, "aktiebolag", f"(?iu){EDGE}aktiebolag{EDGE}") | limited(body, "AB", f"{EDGE}AB{EDGE}")
    return t.select(
        *keys, is_ab.alias("is_ab"), first_number(registered, ("registrer", "bildat"), 1900, rules.as_of_year).alias("reg_year"),
        first_number(staff, ("anställda", "anstallda"), 0, 100_000).alias("employees"), F.coalesce(coded, *named).alias("branch"), sni.alias("sni_code"))


def finance_tables(pages: DataFrame, *keys: str) -> DataFrame:
    """(keys, tables): finance tables of html as years, rawLabel and values; see pages.finance_of()."""
    return finance_of(scan_tables(pages, *keys, debts=False), *keys)


def debt_fallback(pages: DataFrame, *keys: str) -> DataFrame:
    """(keys, kind, year, value): debts of the first table that names them, from every row that does; see pages.debts_of()."""
    return debts_of(scan_tables(pages, *keys, finance=False), *keys, every_row=True)


# fixed values: what report links look like
LINK_WEIGHTS = (("årsredovis", 20), ("arsredovis", 20), ("annual", 3), ("report", 2), ("bokslut", 1), ("pdf", 3))


def rank_links(pages: DataFrame, key: str = "page_id", weights: tuple[tuple[str, int], ...] = LINK_WEIGHTS, file_weight: int = 8, most: int = 8) -> DataFrame:
    """(key, href, score, rank): the best links of each page, unique, best first, ties by place."""
    anchors = pages.select(key, F.posexplode(_all(F.col("html"), "(?is)<a\\s[^>]*href\\s*=\\s*\"[^\"]*\"[^>]*>.*?</a>")).alias("pos", "a"))
    href = F.regexp_extract("a", "(?is)href\\s*=\\s*\"([^\"]*)\"", 1)
    aria = F.regexp_extract("a", "(?is)aria-label\\s*=\\s*\"([^\"]*)\"", 1)
    hay = F.lower(F.concat_ws(" ", F.regexp_replace("a", "<[^>]*>", ""), aria, href))
    score = sum((F.when(F.contains(hay, F.lit(w)), n).otherwise(0) for w, n in weights), F.when(href.rlike("(?i)\\.pdf([?#]|$)"), file_weight).otherwise(0))
    scored = anchors.select(key, "pos", href.alias("href"), score.alias("score")).where("score > 0 and href != ''")
    best = scored.groupBy(key, "href").agg(F.max(F.struct("score", (-F.col("pos")).alias("p"))).alias("b")).select(key, "href", "b.score", "b.p")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("score"), F.desc("p")))
    return best.withColumn("rank", rank).where(F.col("rank") <= most).drop("p")
