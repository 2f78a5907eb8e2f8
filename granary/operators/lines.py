"""Lines of texts that mention given words, their numbers, and which source to believe."""

from __future__ import annotations

from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import SPACE, literal_pattern, normalize_label
from .numbers import let, numbers_in, strip_numbers


def lines_of(text: Column) -> Column:
    """The non-blank lines of a text, white space collapsed."""
    clean = F.replace(F.replace(F.replace(text, F.lit("\x00"), F.lit(" ")), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.filter(F.transform(F.split(clean, "\n"), lambda x: F.trim(F.regexp_replace(x, f"{SPACE}+", " "))), lambda x: x != "")


def text_lines(texts: DataFrame, *keys: str) -> DataFrame:
    """(keys, line_idx, line): non-blank lines, white space collapsed, numbered from 1 among themselves."""
    lines = lines_of(F.col("text"))
    return texts.select(*keys, F.posexplode(lines).alias("pos", "line")).select(*keys, (F.col("pos") + 1).alias("line_idx"), "line")


MANY = 64  # words; more are looked for by an automaton instead of one by one


def word_hits(rows: DataFrame, column: str, words: tuple[str, ...], *keep: str) -> DataFrame:
    """(keep, n, keyword): a row for each of the words, n in their order, that `column` holds in any case.

    Up to MANY words are a projection each. Of more an Aho-Corasick automaton is made once a task and goes over each text
    once, so neither the plan nor a text's cost grows with the list; words may overlap and lie in each other.
    """
    if len(words) <= MANY:
        low = F.lower(column)
        each = F.filter(F.array(*[F.when(F.contains(low, F.lit(w.lower())), F.struct(F.lit(i).alias("n"), F.lit(w).alias("keyword"))) for i, w in enumerate(words)]), lambda x: x.isNotNull())
        return rows.select(*keep, F.explode(each).alias("m")).select(*keep, "m.n", "m.keyword")
    numbers: dict[str, list[int]] = {}
    for i, word in enumerate(words):
        numbers.setdefault(word.lower(), []).append(i)

    def run(batches):
        automaton = ahocorasick.Automaton()
        for word, own in numbers.items():
            if word:
                automaton.add_word(word, own)
        automaton.make_automaton()
        for batch in batches:
            row, n = [], []
            for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if text is not None:
                    found = {w for _, own in automaton.iter(text) for w in own} | set(numbers.get("", ()))
                    row += [i] * len(found)
                    n += sorted(found)
            columns = [batch.column(c).take(pa.array(row, pa.int64())) for c in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int32()), pa.array([words[i] for i in n], pa.string())], [*batch.schema.names[:-1], "n", "keyword"])

    low = rows.select(*keep, F.lower(column).alias("_low"))
    schema = T.StructType([*[f for f in low.schema if f.name != "_low"], T.StructField("n", T.IntegerType()), T.StructField("keyword", T.StringType())])
    return low.mapInArrow(run, schema)


def scan_keywords(texts: DataFrame, words: tuple[str, ...], *keys: str) -> DataFrame:
    """(keys, keyword): words that stand anywhere in the text, in any case; all in one pass over it."""
    return word_hits(texts, "text", words, *keys).select(*keys, "keyword").distinct()


def matched_lines(lines: DataFrame, words: tuple[str, ...], per_key: int | None = 10, total: int | None = 60, key: str = "doc_id", extra: tuple[str, ...] = (), within: str = "line") -> DataFrame:
    """(key, keyword, line, line_idx): at most `per_key` different lines a word and `total` a document; None keeps all.

    Words are looked for in the column `within`. An alternation drops most lines first; caps are windows, by line
    and then by the order of the words. `extra` columns take part in what makes lines different.
    """
    wanted = lines.where(F.col(within).rlike(literal_pattern(words))) if len(words) <= MANY else lines
    hits = word_hits(wanted, within, words, key, "line_idx", "line", *extra)
    once = hits.groupBy(key, "keyword", "line", *extra).agg(F.min("line_idx").alias("line_idx"), F.min("n").alias("n"))
    capped = once
    for most, own, order in ((per_key, (key, "keyword"), ("line_idx",)), (total, (key,), ("line_idx", "n"))):
        if most is not None:
            capped = capped.withColumn("_r", F.row_number().over(Window.partitionBy(*own).orderBy(*order))).where(F.col("_r") <= most)
    return capped.select(key, "keyword", "line", "line_idx", *extra)


def blend_lines(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key's i-th lines the one with more values (two are enough), `first` on a tie.

    Both: (keys, doc, line_idx, line, values), where `doc` leads the keys. A document that one side lacks is the other's alone.
    """
    order = lambda df: df.withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy("line_idx")))
    rest = ("line_idx", "line", "values")
    a = order(first).select(*keys, "_i", F.struct(*rest).alias("a"))
    b = order(second).select(*keys, "_i", F.struct(*rest).alias("b"))
    full = lambda s: F.least(F.size(F.col(s)["values"]), F.lit(2))
    joined = a.join(b, [*keys, "_i"], "full")
    pick = F.when(F.col("b").isNull() | (F.col("a").isNotNull() & (full("a") >= full("b"))), F.col("a")).otherwise(F.col("b"))
    from_first = F.col("b").isNull() | (F.col("a").isNotNull() & (full("a") >= full("b")))
    return joined.select(*keys, F.col("_i").cast("int").alias("n"), from_first.alias("from_first"), pick.alias("p")).select(*keys, "n", "from_first", "p.*")


SOURCES = ("PDF", "PDF_XY", "HTML", "HTML_FALLBACK", "NONE")


def first_source(source: Column, ok: Column | None = None, order: tuple[str, ...] = SOURCES) -> Column:
    """An aggregate: the first of the sources in order, NONE where there is none."""
    place = F.array_position(F.array(*map(F.lit, order)), source)
    n = F.min(place if ok is None else F.when(ok, place))
    return F.coalesce(F.element_at(F.array(*map(F.lit, order)), n.cast("int")), F.lit("NONE"))


def choose_source(candidates: DataFrame, order: tuple[str, ...] = SOURCES) -> DataFrame:
    """(org, source): the first successful source of each org, NONE where there is none."""
    return candidates.groupBy("org").agg(first_source(F.col("source"), F.col("ok"), order).alias("source"))


def line_year_values(lines: DataFrame) -> DataFrame:
    """(keys…, label, year, value): numbers of a labelled line against the header's years.

    lines: any columns, `line`, and `header` with at least two years from 2000 to 2039; of more values than years
    the last ones count, of fewer none.
    """
    years = F.array_distinct(F.regexp_extract_all("header", F.lit("\\b(20[0-3][0-9])\\b"), F.lit(1)))
    groups = F.regexp_extract_all("line", F.lit("-?[0-9]{1,3}(?:\\s[0-9]{3})+"), F.lit(0))
    text = F.lower("line")
    named = lines.withColumns({"years": years, "found": groups, "label": normalize_label(F.col("line"))})
    named = named.where(F.col("label").isNotNull() & ~text.rlike("avskrivningar|resultat före skatt") & (F.size("years") >= 2) & (F.size("found") >= F.size("years")))
    last = F.slice("found", F.size("found") - F.size("years") + 1, F.size("years"))
    other = [c for c in lines.columns if c not in ("line", "header")]
    return named.select(*other, "label", F.explode(F.arrays_zip(F.col("years").alias("year"), last.alias("value"))).alias("z")).select(
        *other, "label", F.col("z.year").cast("int").alias("year"), F.regexp_replace("z.value", "\\s", "").cast("bigint").alias("value"))


def clean_line(item: Column, credit_rule: bool = True) -> Column:
    """(line, values) of an item with key, line and values, put right.

    Values come from a line with digits; else a clean pair stays and other values are repaired together.
    Credit institution debts keep their last two values, without note numbers.
    """
    none = F.array().cast("array<string>")
    line = item["line"]
    given = F.filter(F.transform(F.coalesce(item["values"], none), lambda v: F.trim(F.regexp_replace(v, "\\s+", " "))), lambda v: v != "")

    def chosen(given: Column) -> Column:
        pair = (F.size(given) == 2) & F.forall(given, lambda v: v.rlike("^[-+]?[0-9]+(?: [0-9]{3})*$"))
        again = lambda v: F.when(F.size(v) != 2, given).otherwise(v)
        return F.when(line.rlike("[0-9]"), numbers_in(line)).when(pair, given).otherwise(let(numbers_in(F.array_join(given, " ")), again))

    def credited(values: Column) -> Column:
        large = F.filter(values, lambda v: v.isin("0", "+0", "-0") | (F.length(F.regexp_replace(v, "[^0-9]", "")) > 2))
        debt = is_credit_debt(item["key"], line) & (F.size(values) > 2)
        return let(large, lambda l: F.when(debt & (F.size(l) >= 2), F.slice(l, -2, 2)).otherwise(values))

    values = let(given, chosen)
    values = let(values, credited) if credit_rule else values
    label = let(F.coalesce(strip_numbers(line), F.lit("")), lambda x: F.when(x != "", x).otherwise(line))
    return F.struct(label.alias("line"), values.alias("values"))


def normalize_matched_lines(lines: DataFrame, credit_rule: bool = True) -> DataFrame:
    """lines (key, line, values and others) with clean values and the label as line, in one projection."""
    clean = clean_line(F.struct("key", "line", "values"), credit_rule)
    return lines.withColumn("_clean", clean).withColumns({"line": F.col("_clean.line"), "values": F.col("_clean.values")}).drop("_clean")


def backfill_matched_lines(observations: DataFrame, columns: tuple[str, ...] = ("lenderKeywordLines", "loanLines")) -> tuple[DataFrame, DataFrame]:
    """(observations whose stored lines are put right without the credit rule, one row with the number of observations that changed).

    Each of `columns` that is there is an array of items (variants): those with a line are rewritten in it, with
    their other fields; bare strings and what else has no line stay as they are.
    """
    there = [c for c in columns if c in observations.columns]

    def mended(item: Column) -> Column:
        text = lambda path, kind="string": F.try_variant_get(item, path, kind)
        old = F.struct(F.coalesce(text("$.key"), text("$.keyword")).alias("key"), text("$.line").alias("line"), text("$.values", "array<string>").alias("values"))

        def rewritten(clean: Column) -> Column:
            kept = F.coalesce(F.try_variant_get(item, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
            others = F.map_filter(kept, lambda k, _: ~k.isin("line", "values"))
            own = F.map_from_arrays(F.array(F.lit("line"), F.lit("values")), F.array(clean["line"].cast("variant"), clean["values"].cast("variant")))
            return F.to_variant_object(F.map_concat(others, own))

        # what is read from a variant is bound once: a line is asked for in many places
        return let(old, lambda o: F.when(o["line"].isNull(), item).otherwise(let(clean_line(o, credit_rule=False), rewritten)))

    said = lambda c: F.array_join(F.transform(c, lambda x: F.to_json(x)), ",")
    new = observations.withColumns({f"_new_{c}": F.transform(c, mended) for c in there})
    changed = reduce(lambda a, b: a | b, [~said(c).eqNullSafe(said(f"_new_{c}")) for c in there], F.lit(False))
    counted = new.agg(F.count_if(changed).alias("changed"), F.count("*").alias("total"))
    return new.withColumns({c: F.col(f"_new_{c}") for c in there}).drop(*[f"_new_{c}" for c in there]), counted


def is_credit_debt(key: Column, line: Column) -> Column:
    return (F.lower(key) == "kreditinstitut") & F.lower(line).contains("skuld")


def credit_institution_lines(lines: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Lines of credit institution debts (org, seq, key, line and others): those stored for an observation if there are any, else derived from `lines`."""
    derived = lines.where(is_credit_debt(F.col("key"), F.col("line")))
    if stored is None:
        return derived
    return derived.join(stored.select("org", "seq").distinct(), ["org", "seq"], "left_anti").unionByName(stored.select(*derived.columns))


def has_any_data(columns: list[str], source: Column) -> Column:
    """True if any column says something, or a source was found."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")).isin("", "0", "false") for c in columns]
    return ~reduce(lambda a, b: a & b, said) | (F.coalesce(source, F.lit("NONE")) != "NONE")
