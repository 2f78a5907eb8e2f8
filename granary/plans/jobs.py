"""Whole jobs, each one plan of operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RULES, Rules
from ..operators import crm, extract, facts, fold, layout, leads, lines, targets
from ..operators import pages as page_tables
from ..sources import files
from .storage import keep


CREDIT = "Kreditinstitut"


def fold_observations(observations: DataFrame, rules: Rules = RULES, scanned: DataFrame | None = None) -> DataFrame:
    """Observations as read from their files to one state an org, which merges with those of other files (operators.fold)."""
    named = observations.select("org", "seq", "name", "email", "phone", F.col("isAB").alias("is_ab"), F.col("regYear").alias("reg_year"), "employees", "branch", F.col("sniCode").alias("sni_code"))
    words = observations.select("org", "seq", F.explode("lenderKeywords").alias("keyword"))
    return fold.fold_states(named, facts.finance_rows(observations), words, rules, scanned=scanned)


def score_states(states: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Scored leads of a table of states."""
    return leads.icp_score(fold.leads_of_states(states, rules), rules)


def build_leads(observations: DataFrame, rules: Rules = RULES, scanned: DataFrame | None = None) -> DataFrame:
    """Observations as read from their files (see sources.files) to scored leads.

    scanned: (org, keyword) found in report files. Where observations hold matched lines, leads also have the first
    two credit institution lines with their numbers below the org's debt ceiling, and all lines in one text.
    """
    scored = score_states(fold_observations(observations, rules, scanned), rules)
    if "lenderKeywordLines" not in observations.columns:
        return scored
    items = files.matched_items(observations, "lenderKeywordLines")
    stored = files.matched_items(observations, "kreditinstitutSkulderLines") if "kreditinstitutSkulderLines" in observations.columns else None
    ceilings = scored.select("org", facts.debt_ceiling(F.col("short_debt"), F.col("long_debt"), rules).alias("ceiling"))
    cells = leads.line_columns(leads.structured_lines(items, ceilings), CREDIT)
    joined = scored.join(cells, "org", "left").join(leads.joined_lines(items, "every_line"), "org", "left")
    return joined.join(leads.joined_lines(lines.credit_institution_lines(items, stored), "debt_lines"), "org", "left")


def _holds(text: Column, rules: Rules) -> Column:
    low = F.lower(text)
    return F.exists(F.array(*[F.lit(w.lower()) for w in rules.lenders]), lambda w: F.contains(low, w))


def _at(pages: DataFrame, c: str) -> Column:
    return F.struct(*[k for k in ("seq",) if k in pages.columns], F.xxhash64(c))


def _page_facts(pages: DataFrame, rules: Rules) -> DataFrame:
    """(org, email, phone, isAB, regYear, employees, branch, sniCode, tables, text): of an org's pages, by seq and then by a
    hash of html, the first that says a thing; the finance tables of all, or else the debts that a table names; of the texts
    that hold a lender's name the first by seq and then by a hash.

    One pass over each page, and one aggregate.
    """
    own = pages.select("org", "html", _at(pages, "html").alias("_at"), *[c for c in ("seq",) if c in pages.columns])
    held = own.columns
    read = extract.extract_contacts(own, *held).select(*held, "email", "phone")
    held = read.columns
    read = extract.company_facts(read.withColumn("text", targets.flatten_html(F.col("html"))), *held, rules=rules)
    # marks only part what stands together, so what a name begins with stands in the html of a text that holds it
    begins = {w.lower().split()[0] if w.split() else "" for w in rules.lenders}
    low = F.lower("html")
    may = F.exists(F.array(*map(F.lit, sorted(begins))), lambda w: F.contains(low, w))
    broken = F.regexp_replace("html", "(?i)<br[^>]*>|</(p|div|li|tr|h[1-6])>", "\n")
    read = read.withColumn("_text", F.when(may, F.regexp_replace(broken, "<[^>]*>", " ")))
    read = read.withColumn("text", F.when(_holds(F.col("_text"), rules), F.col("_text"))).drop("_text")
    read = page_tables.tables_of(read.withColumn("_text_at", F.when(F.col("text").isNotNull(), _at(pages, "text"))))
    first = lambda c, at="_at": F.min_by(c, F.when(F.col(c).isNotNull(), F.col(at))).alias(c)
    tables = F.array_sort(F.collect_list(F.when(F.col("tables").isNotNull(), F.struct("_at", "tables"))))
    said = read.groupBy("org").agg(*map(first, ("email", "phone", "reg_year", "employees", "branch", "sni_code", "debts")), first("text", "_text_at"), F.bool_or("is_ab").alias("is_ab"), tables.alias("tables"))
    every = F.when(F.size("tables") > 0, F.flatten(F.transform("tables", lambda x: x["tables"])))
    return said.select(
        "org", "email", "phone", F.col("reg_year").alias("regYear"), "employees", F.coalesce("is_ab", F.lit(False)).alias("isAB"), "branch", F.col("sni_code").alias("sniCode"),
        F.coalesce(every, "debts").alias("tables"), "text")


def _first_report(texts: DataFrame, rules: Rules) -> DataFrame:
    """(org, text): of an org's report texts, by seq and then by a hash, the first that holds a lender's name."""
    return texts.where(_holds(F.col("text"), rules)).groupBy("org").agg(F.min_by("text", _at(texts, "text")).alias("text"))


def lender_lines(texts: DataFrame, page_texts: DataFrame, tokens: DataFrame | None = None, rules: Rules = RULES) -> tuple[DataFrame, DataFrame]:
    """((org, source, keywords), (org, key, line_idx, line, values, source)) of the first source that names a lender.

    Report texts come first, blended with positioned tokens where an org has them: (org, page, text, x, y, w, h). Of tokens
    every matched row counts, of texts ten lines a word. Then the org's page (org, text), of those that hold a name.
    Values are put right.
    """
    reports = _first_report(texts, rules)
    words = lambda source, df: lines.scan_keywords(df, rules.lenders, "org").select(F.lit(source).alias("source"), "org", "keyword")

    def found_in(source: str, df: DataFrame) -> DataFrame:
        found = lines.matched_lines(lines.text_lines(df, "org"), rules.lenders, key="org")
        return found.select(F.lit(source).alias("source"), "org", F.col("keyword").alias("key"), "line_idx", "line", F.array().cast("array<string>").alias("values"))

    # tables of their own: the texts are read once for each, whatever follows
    named, found = keep(words("PDF", reports), release=True), found_in("PDF", reports)
    if tokens is not None:
        placed = layout.matched_token_lines(tokens, rules.lenders, per_key=None, total=None, key="org").withColumnRenamed("keyword", "key")
        blended = lines.blend_lines(placed.select("org", "key", "line_idx", "line", "values"), found.drop("source"), ["org", "key"])
        found = blended.select(F.when(F.col("from_first"), "PDF_XY").otherwise("PDF").alias("source"), "org", "key", "line_idx", "line", "values")
    found = keep(found, release=True)
    # a report with lines names a lender, so pages count only for orgs whose reports name none
    named = named.unionByName(found.where("source = 'PDF_XY'").select("source", "org", F.col("key").alias("keyword")))
    others = page_texts.join(named.select("org"), "org", "left_anti")
    named = named.unionByName(words("HTML", others))
    keywords = named.groupBy("org").agg(F.array_sort(F.collect_set("keyword")).alias("keywords"), lines.first_source(F.col("source")).alias("source"))
    found = found.unionByName(keep(found_in("HTML", others), release=True))
    return keywords, lines.normalize_matched_lines(found)


def build_observations(target_list: DataFrame, pages: DataFrame, texts: DataFrame, done: DataFrame, rules: Rules = RULES, tokens: DataFrame | None = None) -> DataFrame:
    """One observation for each pending target from its pages (org, html, perhaps seq), report texts (org, text, perhaps
    seq) and positioned tokens."""
    pending = keep(targets.pending_targets(target_list, done).select("org", "name"), release=True)  # every input is cut to it
    of_pending = lambda df: df.join(pending.select("org"), "org", "left_semi")
    said = keep(_page_facts(of_pending(pages), rules), release=True)
    keywords, found = lender_lines(of_pending(texts), said.where("text is not null").select("org", "text"), None if tokens is None else of_pending(tokens), rules)
    debts = facts.dedupe_value_variants(lines.credit_institution_lines(found))
    item = F.struct("key", "line", F.col("line_idx").cast("int").alias("lineIndex"), "values", "source")
    gathered = lambda df, alias: df.groupBy("org").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_idx", "key", item.alias("item")))), lambda x: x["item"]).alias(alias))
    out = pending
    for part in (said.drop("text"), keywords, gathered(found, "lenderKeywordLines"), gathered(debts, "kreditinstitutSkulderLines")):
        out = out.join(part, "org", "left")
    shaped = out.select(
        "org", "name", "email", "phone", "regYear", "employees", F.coalesce("isAB", F.lit(False)).alias("isAB"), "branch", "sniCode", F.col("keywords").alias("lenderKeywords"),
        "lenderKeywordLines", "kreditinstitutSkulderLines", F.coalesce("source", F.lit("NONE")).alias("lenderKeywordsSource"), "tables")
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    return shaped.where(lines.has_any_data(["email", "phone", "employees", "regYear", "branch"], F.col("lenderKeywordsSource")) | some("lenderKeywords") | some("tables"))


def import_leads(existing: DataFrame, sheet: DataFrame, now) -> DataFrame:
    """A lead sheet over the table: missing columns, upsert, stamps."""
    table = keep(crm.evolve_schema(existing, sheet.drop("seq")), release=True)  # read by the upsert and by the stamps
    return crm.stamp_changes(crm.upsert_leads(table, sheet, new_rows=crm.defaults(now)), table, now)


def rescan_cycle(observations: DataFrame, keywords: DataFrame, all_targets: DataFrame) -> DataFrame:
    """Targets with lender keywords, flagged for another visit."""
    wanted = targets.lender_targets(observations, keywords).select(F.col("orgnr").alias("org")).distinct()
    return targets.pending_targets(all_targets.join(wanted, "org", "left_semi"), observations, rescan=True)


def rescan(observations: DataFrame, keywords: DataFrame, all_targets: DataFrame, pages: DataFrame, texts: DataFrame, rules: Rules = RULES, tokens: DataFrame | None = None) -> DataFrame:
    """New observations of the targets that rescan_cycle() flags, from their pages, texts and tokens as they are now."""
    wanted = keep(rescan_cycle(observations, keywords, all_targets), release=True)  # every input is cut to it
    return build_observations(wanted, pages, texts, wanted.limit(0), rules, tokens)


def append_made(observations: DataFrame, made: DataFrame) -> DataFrame:
    """observations as read from their files, and behind them those that build_observations() made, as files hold them."""
    item = lambda c: F.transform(c, lambda x: F.to_variant_object(x))
    held = made.withColumns({c: item(c) for c in ("lenderKeywordLines", "kreditinstitutSkulderLines")})
    place = lambda part, at: F.struct(F.lit(part).alias("part"), at.alias("at"))
    old = observations.withColumn("seq", place(0, F.col("seq")))
    none = F.lit(None).cast(observations.schema["seq"].dataType)
    return old.unionByName(held.withColumn("seq", place(1, none)), allowMissingColumns=True)


def rescan_leads(existing: DataFrame, observations: DataFrame, all_targets: DataFrame, pages: DataFrame, texts: DataFrame, now, columns: dict[str, str], rules: Rules = RULES, tokens: DataFrame | None = None) -> DataFrame:
    """The whole cycle: targets with lender keywords are read anew, leads made of old and new observations together, and
    those of the leads that were read anew laid over the table.

    observations: as read from their files. columns: the table's columns by those of the leads; `org` gives its key.
    """
    words = observations.select("org", "seq", F.explode("lenderKeywords").alias("keyword"))
    made = keep(rescan(observations.select("org", "seq", "name"), words, all_targets, pages, texts, rules, tokens), release=True)  # read twice
    touched = keep(made.select("org").distinct(), release=True)  # as a table its size is known, so that few are sent to the observations
    # of all observations only theirs are read for each of fields, tables, keywords and lines
    theirs = append_made(keep(observations.join(touched, "org", "left_semi"), release=True), made)
    sheet = build_leads(theirs, rules).select(*[F.col(c).alias(name) for c, name in columns.items()], F.lit(0).alias("seq"))
    return import_leads(existing, sheet, now)
