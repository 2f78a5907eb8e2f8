"""Finance rows to figures and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import FIGURE_RULES, RULES, SOURCE_WEIGHTS, Rules
from ..functions.text import EDGE, label_of, lowered, normalize_label, parse_money, sane_money, unspaced, whole_number


def finance_rows(observations: DataFrame) -> DataFrame:
    """(org, seq, tbl_idx, raw_label, pos, year, raw_value) of `tables`; rows whose years and values differ in number go."""
    tables = observations.select("org", "seq", F.posexplode("tables").alias("tbl_idx", "t")).where("size(t.years) = size(t.values)")
    cells = tables.select("org", "seq", (F.col("tbl_idx") + 1).alias("tbl_idx"), F.col("t.rawLabel").alias("raw_label"), F.posexplode(F.arrays_zip(F.col("t.years").alias("year"), F.col("t.values").alias("value"))).alias("pos", "c"))
    return cells.select("org", "seq", "tbl_idx", "raw_label", "pos", F.col("c.year").alias("year"), F.col("c.value").cast("string").alias("raw_value"))


def with_money(rows: DataFrame, columns: dict[str, str], rules: Rules = RULES) -> DataFrame:
    """rows with parse_money() of a column under each name, a projection a step."""
    bare = rows.withColumns({f"_bare_{n}": unspaced(F.col(c)) for n, c in columns.items()})
    whole = bare.withColumns({f"_whole_{n}": whole_number(F.col(f"_bare_{n}")) for n in columns})
    return whole.select(*rows.columns, *[sane_money(F.col(f"_whole_{n}"), rules).alias(n) for n in columns])


def newest_cells(tables: DataFrame, cells: list[tuple[str, str]], rules: Rules = RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """(org, seq, tbl_idx, raw_label, pos, year, value): of each table row the newest cell that has a value.

    cells: the columns of year and value of a table row, newest first. What takes the earliest of finance_rows() for a
    figure takes no other cell of a row than this one.
    """
    priced = with_money(tables, {f"_n{i}": value for i, (_, value) in enumerate(cells)}, rules)
    newest = F.coalesce(*[F.when(F.col(f"_n{i}").isNotNull(), F.struct(F.lit(i).alias("pos"), F.col(year).alias("year"), F.col(f"_n{i}").alias("value"))) for i, (year, _) in enumerate(cells)])
    return priced.select("org", "seq", "tbl_idx", "raw_label", *keep, newest.alias("c")).select("org", "seq", "tbl_idx", "raw_label", *keep, "c.*")


def latest_figures(rows: DataFrame, rules: Rules = RULES) -> DataFrame:
    """One row an observation: each figure's newest parsable value, in SEK, from the first table row that has one.

    One aggregate holds all figures; `pos` counts years from the newest.
    """
    priced = rows.withColumn("value", parse_money(F.col("raw_value"), rules)).where(F.col("value").isNotNull())
    best = [
        F.min_by(F.struct((F.col("value") * rules.multiplier).alias("value"), "year"), F.when(F.col("raw_label").rlike(f"(?iu){pattern}"), F.struct("tbl_idx", "pos"))).alias(name)
        for name, pattern in FIGURE_RULES.items()
    ]
    return priced.groupBy("org", "seq").agg(*best)


def atomic_facts(rows: DataFrame, rules: Rules = RULES) -> DataFrame:
    """(org, seq, tbl_idx, label, year, value, raw_line, source_type, score): each labelled table row's newest value."""
    known = rows.withColumn("label", normalize_label(F.col("raw_label"), rules)).withColumn("value", parse_money(F.col("raw_value"), rules)).where("label is not null")
    line = F.array_join(F.concat(F.array(F.first("raw_label")), F.transform(F.array_sort(F.collect_list(F.struct("pos", "raw_value"))), lambda x: x["raw_value"])), " | ")
    grouped = known.groupBy("org", "seq", "tbl_idx", "label").agg(F.min_by(F.struct("year", "value"), F.when(F.col("value").isNotNull(), F.col("pos"))).alias("best"), line.alias("raw_line"))
    return grouped.where("best is not null").select("org", "seq", "tbl_idx", "label", F.col("best.year").alias("year"), (F.col("best.value") * rules.multiplier).alias("value"), "raw_line", F.lit("HTML_TABLE").alias("source_type"), F.lit(SOURCE_WEIGHTS["HTML_TABLE"]).alias("score"))


def table_facts(tables: DataFrame, cells: list[tuple[str, str]], rules: Rules = RULES) -> DataFrame:
    """atomic_facts() of table rows (org, seq, tbl_idx, raw_label and the years and values that `cells` names, newest first).

    A row's cells need no grouping, as they stand together; an org's row of an observation must be one row here.
    """
    newest = newest_cells(tables, cells, rules, tuple(v for _, v in cells))
    labelled = newest.withColumn("_low", lowered(F.col("raw_label"))).withColumn("label", label_of(F.col("_low"), rules))
    line = F.concat_ws(" | ", "raw_label", *[v for _, v in cells])
    return _made(labelled, F.col("label"), "tbl_idx", F.col("year"), line, "HTML_TABLE", rules)


def _made(rows: DataFrame, label: Column, place: str, year: Column, line: Column, source: str, rules: Rules) -> DataFrame:
    """Facts of the rows with a label and a value, by a generator: a filter would be moved below the patterns and ask for them twice."""
    fact = F.struct(label.alias("label"), year.alias("year"), (F.col("value") * rules.multiplier).alias("value"), line.alias("raw_line"), F.lit(source).alias("source_type"), F.lit(SOURCE_WEIGHTS[source]).alias("score"))
    return rows.select("org", "seq", F.col(place).alias("tbl_idx"), F.inline(F.when(label.isNotNull() & F.col("value").isNotNull(), F.array(fact))))


def line_facts(lines: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Facts of matched lines (org, seq, line_idx, line, values): no year, and the line itself where no label is known."""
    numbers = F.transform(F.transform("values", unspaced), whole_number)
    value = F.get(F.filter(numbers, lambda n: F.abs(n) <= rules.sanity_limit), F.lit(0))
    said = F.array_join(F.concat(F.array("line"), F.transform("values", lambda v: F.coalesce(v, F.lit("")))), " | ")
    read = lines.where(F.trim("line") != "").select("org", "seq", "line_idx", "line", value.alias("value"), said.alias("said"), lowered(F.col("line")).alias("_low"))
    labelled = read.withColumn("label", F.coalesce(label_of(F.col("_low"), rules), F.trim("line")))
    return _made(labelled, F.col("label"), "line_idx", F.lit(None).cast("int"), F.col("said"), "PDF_TEXT", rules)


def best_facts(facts: DataFrame, people: DataFrame | None = None) -> DataFrame:
    """The winner of each org and label: score, then year, then first seen. A minimum by key combines before the shuffle.

    people: an org's name, email, phone and keywords, each the first that any of its observations has; they fill the
    winner's, whichever observation it comes from.
    """
    order = F.struct((-F.col("score")).alias("s"), (-F.coalesce(F.col("year"), F.lit(-1))).alias("y"), "seq", "tbl_idx")
    winner = F.min_by(F.struct("year", "value", "raw_line", "source_type", "score", "seq", "tbl_idx"), order).alias("w")
    best = facts.groupBy("org", "label").agg(winner).select("org", "label", "w.*")
    return best if people is None else best.join(people.select("org", "name", "email", "phone", "lender_keywords"), "org", "left")


def pivot_facts(best: DataFrame, labels: list[str]) -> DataFrame:
    """One row an org with value and year of each label, in the given order."""
    pick = lambda column, label: F.max(F.when(F.col("label") == label, F.col(column)))
    columns = [x for i, label in enumerate(labels) for x in (pick("value", label).alias(f"v{i + 1}"), pick("year", label).alias(f"y{i + 1}"))]
    return best.groupBy("org").agg(*columns)


def debt_ceiling(short: Column, long: Column, rules: Rules = RULES) -> Column:
    total = F.coalesce(short, F.lit(0)) + F.coalesce(long, F.lit(0))
    return F.when(total > 0, F.least(total * 1.05, F.lit(float(rules.debt_cap)))).otherwise(F.lit(float(rules.debt_cap)))


def repaired_ceiling(short: Column, long: Column, rules: Rules = RULES) -> Column:
    """The ceiling for sheets already written: debts count by their size, without leading zeros."""
    size = lambda c: F.abs(F.coalesce(F.regexp_replace(F.trim(c.cast("string")), "^0+", "").try_cast("double"), F.lit(0.0)))
    return debt_ceiling(size(short), size(long), rules)


def repair_sheet(sheet: DataFrame, cells: tuple[str, ...], short: str, long: str, rules: Rules = RULES) -> tuple[DataFrame, DataFrame]:
    """(sheet whose `cells` beyond the ceiling are blank, one row with the number of cells cleared); zeros stay."""
    ceiling = repaired_ceiling(F.col(short), F.col(long), rules)
    beyond = lambda c: F.coalesce(F.abs(F.regexp_replace(F.col(c), "[\\s\u00A0]", "").try_cast("double")) > ceiling, F.lit(False))
    counted = sheet.agg(sum((F.count_if(beyond(c)) for c in cells), F.lit(0)).alias("cleared"), F.count("*").alias("total"))
    return sheet.withColumns({c: F.when(~beyond(c), F.col(c)) for c in cells}), counted


def clamp(value: Column, ceiling: Column) -> Column:
    return F.when(F.abs(value) <= ceiling, value)


def is_financing_label(label: Column) -> Column:
    low = F.lower(label)
    # fixed values: words of financing rows, and of rows that also hold equity
    wanted = f"{EDGE}(kortfrist|långfrist|långfristiga|långfristig|kortfristiga|kortfristig|skuld|skulder|lån|kredit|kreditinstitut|leasing){EDGE}"
    return F.coalesce(low.rlike(wanted) & ~excluded_label(label), F.lit(False))


def excluded_label(label: Column) -> Column:
    return F.coalesce(F.lower(label).rlike(f"{EDGE}(eget kapital|balans(r(a|ä)kning)?){EDGE}"), F.lit(False))


def label_scan_report(tables: DataFrame) -> DataFrame:
    label = F.col("raw_label")
    return tables.agg(F.countDistinct("org").alias("orgs"), F.count("*").alias("tables"), F.count_if(is_financing_label(label)).alias("matches"), F.count_if(excluded_label(label)).alias("excluded"))


def label_samples(tables: DataFrame, n: int = 20) -> DataFrame:
    """The first n financing rows, as the report shows them."""
    return tables.where(is_financing_label(F.col("raw_label"))).orderBy("seq", "tbl_idx").select("org", "seq", "tbl_idx", "raw_label").limit(n)


def top_labels(tables: DataFrame, condition: Column, n: int = 10) -> DataFrame:
    return tables.where(condition).groupBy("raw_label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "raw_label").limit(n)


def dedupe_value_variants(lines: DataFrame) -> DataFrame:
    """Drops a line whose first value doubles the leading digit of a clean line's, then repeats of key, line and values.

    lines: (org, line_idx, key, line, values).
    """
    doubled = (F.size("values") == 2) & (F.regexp_extract(F.get("values", F.lit(0)), "^([0-9])\\1 ([0-9]{3} [0-9]{3})$", 1) != "")
    mended = F.regexp_replace(F.get("values", F.lit(0)), "^([0-9])\\1 ", "$1 ")
    value = lambda n: F.get("values", F.lit(n))
    clean = lines.where("size(values) = 2").select("org", value(0).alias("_first"), value(1).alias("_second"), F.lit(True).alias("_clean")).distinct()
    # each line asks for itself: other lines of its number, as blended sources have them, stay
    asked = lines.withColumns({"_first": F.when(doubled, mended), "_second": F.when(doubled, value(1))})
    left = asked.join(clean, ["org", "_first", "_second"], "left").where("_clean is null").select(*lines.columns)
    first = F.row_number().over(Window.partitionBy("org", "key", F.trim("line"), "values").orderBy("line_idx"))
    return left.withColumn("_n", first).where("_n = 1").drop("_n")
