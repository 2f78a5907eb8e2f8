"""Personal data in whole texts: patterns propose spans, checksums confirm them, words nearby move their score.

Everything is column expressions. Per kind a text is cut at the pattern's matches; the lengths of the matches and of the
pieces between them, summed up in order, give positions in code points, so no text is shuffled: behind the scan each match
is a row of its own with its length, the gap before it and what its score needs. A match that its validator refuses goes and
is not tried again from its inside.

Base kinds (email, ip, card, phone) stay whatever their score is. The added kinds are `iban` (lengths by country, mod 97),
and `ssn` and `tel` (a number as such says little, so that they count only with a fitting word near them, and not with
one like "order" or "part").

The patterns of the base kinds are written with possessive repeats, and email and ip with a look behind, which changes no
match: a run of their first class either leads to a match from its beginning (or from the end of the match before) or from
none of its places. So a run of any length is passed once, without recursion.

Defined results: null and empty texts have no spans; very long texts count whole, with any number of spans; every row counts
by itself, repeated rows and rows with the same or no doc_id too; spans of different kinds may overlap; spans of one start
are in the order of KINDS; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST = 0.6  # score of an added span
BEFORE, AFTER = 48, 24  # code points around a span in which words count, up to the next match of its kind

# fixed values: characters of an IBAN by country
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH DE GB GE IE ME RS VA",
    23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ CY DO GT HU LB PL", 29: "BR PS QA UA", 30: "JO KW MU", 31: "MT SC",
}
IBAN = "(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(f"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:[ -]?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items()) + ")"
# fixed values: words that speak for a kind, and those that speak against numbers of a person
WORDS = {
    "email": "e-?mail|mail|contact|kontakt|correo|courriel",
    "ip": "ip|host|server|address|login|adresse",
    "card": "card|visa|mastercard|amex|credit|karte|carte|tarjeta",
    "phone": "phone|telephone|tel|mobile|cell|call|fax|telefon|handy|telefono|movil",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social security|social|security number|taxpayer",
    "tel": "phone|telephone|tel|mobile|cell|call|fax|telefon|handy|telefono|movil",
}
AGAINST = "order|part|item|sku|serial|isbn|version|invoice|ticket|model"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _mod_97(hit: Column) -> Column:
    plain = F.regexp_replace(hit, "[ -]", "")
    turned = F.split(F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4)), "")
    add = lambda rest, c: F.when(c.rlike("[A-Z]"), rest * 100 + F.ascii(c) - 55).otherwise(rest * 10 + F.ascii(c) - 48) % 97
    return F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), add)


def _in_ip(hit: Column) -> Column:
    return F.forall(F.split(hit, "[.]"), lambda part: F.length(F.ltrim(part, F.lit("0"))) <= 3) & F.forall(F.split(hit, "[.]"), lambda part: F.coalesce(F.right(part, F.lit(9)).cast("int"), F.lit(0)) <= 255)


def _between(low: int, high: int) -> Callable[[Column], Column]:
    return lambda hit: F.length(_digits(hit)).between(low, high)


class Kind(NamedTuple):
    pattern: str
    valid: Callable[[Column], Column]
    prior: float  # the score of a valid span without words near it
    needs: str = ""  # what every match holds, asked first
    apart: str = ""  # characters that may not stand next to a span of an added kind
    base: bool = False


KINDS = {
    "email": Kind(r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda hit: F.lit(True), 0.9, needs="@", base=True),
    "ip": Kind(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", _in_ip, 0.6, base=True),
    "card": Kind(r"[0-9](?:[\x20-]?[0-9])++", lambda hit: _between(14, 19)(hit) & F.call_function("luhn_check", _digits(hit)), 0.7, base=True),
    "phone": Kind(r"\+[0-9][\x20().0-9-]+[0-9]", _between(10, 15), 0.7, needs="+", base=True),
    "iban": Kind(IBAN, lambda hit: _mod_97(hit) == 1, 0.9, apart="[A-Za-z0-9]"),
    "ssn": Kind("[0-9]{3}-[0-9]{2}-[0-9]{4}", lambda hit: ~hit.rlike("^(000|666|9)|-00-|-0000$"), 0.4, needs="-", apart="[A-Za-z0-9-]"),
    "tel": Kind(r"[(]?[0-9]{3}[)]?[ .-][0-9]{3}[ .-][0-9]{4}", lambda hit: ~hit.rlike("^[(][0-9]{3}[^)]|^[0-9]{3}[)]"), 0.4, apart="[A-Za-z0-9-]"),
}


def _says(near: Column, words: str) -> Column:
    return near.rlike(f"(?:^|[^a-z])(?:{words})(?:[^a-z]|$)")


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _of_kind(kind: str, column: Callable[[str, Kind], Column]) -> Column:
    """The column that belongs to each row's kind."""
    return F.coalesce(*[F.when(F.col(kind) == name, column(name, how)) for name, how in KINDS.items()])


def _matches(name: str, hits: Column, pieces: Column) -> Column:
    """Structs of a text's matches; pieces are what is left of the text before, between and behind them."""
    n = F.size(hits)
    both = F.arrays_zip(hits.alias("hit"), F.slice(pieces, 1, n).alias("before"), F.slice(pieces, 2, n).alias("after"))
    near = lambda x: [F.right(x["before"], F.lit(BEFORE)).alias("before"), F.left(x["after"], F.lit(AFTER)).alias("after")]
    return F.transform(both, lambda x, i: F.struct(F.lit(name).alias("kind"), i.alias("i"), F.length(x["before"]).alias("gap"), x["hit"].alias("hit"), *near(x)))


def proposals(docs: DataFrame) -> DataFrame:
    """(row, doc_id, kind, i, gap, hit, before, after): every match of every pattern, and one row without a kind for a text that has none."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    may = lambda how: F.contains(F.col("text"), F.lit(how.needs)) if how.needs else F.col("digits")
    hits = rows.withColumn("digits", F.col("text").rlike("[0-9]")).withColumns({name: F.when(may(how), F.regexp_extract_all("text", F.lit(how.pattern), F.lit(0))) for name, how in KINDS.items()})
    found = [F.when(F.size(name) > 0, _matches(name, F.col(name), F.split("text", how.pattern, -1))) for name, how in KINDS.items()]
    none = F.array().cast("array<struct<kind:string,i:int,gap:int,hit:string,before:string,after:string>>")
    return hits.select("row", "doc_id", F.explode_outer(F.concat(*[F.coalesce(f, none) for f in found])).alias("_")).select("row", "doc_id", "_.*")


def spans(docs: DataFrame) -> DataFrame:
    """(row, doc_id, kind, start, end, text, score, base) of every span that stands; kind is null for a text without matches.

    start and end count code points, end is exclusive; score is 0 to 1.
    """
    near = F.concat(_lower("before"), F.lit(" "), _lower("after"))
    touched = F.right("before", F.lit(1)), F.left("after", F.lit(1))
    alone = lambda how: ~touched[0].rlike(how.apart) & ~touched[1].rlike(how.apart) & ((F.col("i") == 0) | (F.col("gap") > 0)) if how.apart else F.lit(True)
    score = _of_kind("kind", lambda name, how: how.prior + F.when(_says(near, WORDS[name]), 1 - how.prior - 0.05).otherwise(0) - (F.when(_says(near, AGAINST), 0.4).otherwise(0) if how.prior < LEAST else 0))
    judged = proposals(docs).withColumns({"valid": _of_kind("kind", lambda name, how: alone(how) & how.valid(F.col("hit"))), "score": F.round(score, 2)})
    small = judged.select("row", "doc_id", "kind", "i", "gap", F.length("hit").alias("n"), F.when(F.col("valid"), F.col("hit")).alias("text"), "valid", "score")
    # one shuffle by row serves the sums and what gathers a row's spans
    end = F.sum(F.col("gap") + F.col("n")).over(Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    placed = small.repartition("row").withColumn("end", end)
    base = F.col("kind").isin([name for name, how in KINDS.items() if how.base])
    stands = F.coalesce(F.col("valid") & (base | (F.col("score") >= LEAST)), F.lit(False))
    return placed.select("row", "doc_id", F.when(stands, F.col("kind")).alias("kind"), (F.col("end") - F.col("n")).alias("start"), "end", "text", "score", base.alias("base"))


def pii(docs: DataFrame) -> DataFrame:
    """The contract's digest of every row's spans, with n_added and the least score of an added span's text."""
    number = F.coalesce(*[F.when(F.col("kind") == name, F.lit(n)) for n, name in enumerate(KINDS)])
    one = F.struct("start", number.alias("number"), "end", "kind")
    listed = lambda rows: F.array_join(F.transform(F.sort_array(rows), lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")
    counts = [F.count(F.when(F.col("kind") == name, 1)).alias(f"n_{name}") for name, how in KINDS.items() if how.base]
    per_row = spans(docs).groupBy("row", "doc_id").agg(*counts, F.count(F.when(~F.col("base") & F.col("kind").isNotNull(), 1)).alias("n_added"), F.collect_list(F.when(F.col("kind").isNotNull() & F.col("base"), one)).alias("of_base"), F.collect_list(F.when(F.col("kind").isNotNull(), one)).alias("of_all"))
    return per_row.select("doc_id", *[f"n_{name}" for name, how in KINDS.items() if how.base], F.sha2(listed(F.col("of_base")), 256).alias("base_sha256"), listed(F.col("of_all")).alias("spans"), "n_added")
