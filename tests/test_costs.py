"""Steps that every table row goes through: what they save must not show in their results."""

import random
import re

from pyspark.sql import functions as F

from granary import queries
from granary.config import FIGURE_RULES, RULES
from granary.functions import text
from granary.operators import facts, fold

CELLS = [("y1", "v1"), ("y2", "v2")]
VALUES = [None, "", "-", "1 234", "-45 tkr", "1.5", "1 234,5", "12-34", "–12", "--7", "+5", "5-", "\t8 000 ", "6 000 000 000", "9" * 19, "1e3", "٣", ".", "abc"]
LABELS = [None, "", "Nettoomsättning", "  KORTFRISTIGA  SKULDER", "Kortfristiga skulder till banker", "ÅRETS resultat", "Eget kapital", "Rörelseresultat"]


def _tables(spark):
    rng = random.Random(3)
    rows = [(f"{i % 30 // 2:010d}", i // 3, i % 3 + 1, rng.choice(LABELS), rng.choice([None, 2020, 2021]), 2019, rng.choice(VALUES), rng.choice(VALUES)) for i in range(900)]
    return spark.createDataFrame(rows, "org string, seq long, tbl_idx int, raw_label string, y1 int, y2 int, v1 string, v2 string")


def _cells(tables):
    pairs = F.array(*[F.struct(F.col(y).alias("year"), F.col(v).alias("raw_value")) for y, v in CELLS])
    return tables.select("org", "seq", "tbl_idx", "raw_label", F.posexplode(pairs).alias("pos", "c")).select("org", "seq", "tbl_idx", "raw_label", "pos", "c.*")


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_money_by_steps_is_the_plain_rule(spark):
    def plain(value):
        said = re.match("-?[0-9]+", re.sub("[^0-9-]", "", value or ""))
        number = int(said[0]) if said else None
        return number if number is not None and abs(number) <= RULES.sanity_limit else None

    rng = random.Random(4)
    values = VALUES + ["".join(rng.choice("0123 -.,+e \t") for _ in range(rng.randint(0, 8))) for _ in range(3000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = facts.with_money(df, {"n": "v"}).select("i", "n", text.parse_money(F.col("v")).alias("whole")).collect()
    assert {r.i: (r.n, r.whole) for r in got} == {i: (plain(v), plain(v)) for i, v in enumerate(values)}


def test_facts_of_table_rows_are_those_of_their_cells(spark):
    tables = _tables(spark)
    assert _rows(facts.table_facts(tables, CELLS)) == _rows(facts.atomic_facts(_cells(tables)))
    assert facts.table_facts(tables, CELLS).count() > 100


def test_facts_of_table_rows_are_not_grouped(spark, sf):
    plan = queries.QUERIES["atomic_facts"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and len(re.findall(r"Generate ", plan)) == 1  # cells were dealt out and gathered again


def test_newest_cells_fold_as_all_cells(spark):
    tables = _tables(spark)
    observations = tables.select("org", "seq", *[F.lit(None).cast("string").alias(c) for c in ("name", "email", "phone")], F.lit(True).alias("is_ab"), F.lit(1990).alias("reg_year"), F.lit(3).alias("employees"), F.lit("Handel").alias("branch")).distinct()
    newest = fold.fold_states(observations, facts.newest_cells(tables, CELLS))
    assert _rows(newest) == _rows(fold.fold_states(observations, _cells(tables)))
    assert newest.where(F.coalesce(*[F.col(n).isNotNull() for n in FIGURE_RULES])).count() > 5


def test_a_fold_asks_once_for_each_pattern(spark, sf):
    plan = queries.QUERIES["clamped_debts"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(FIGURE_RULES["operating_result"]) == 1  # a filter below asked for it again, of each cell


def test_observations_without_fields_are_not_sorted(spark, sf):
    for name in ("clamped_debts", "cleared_count", "leads_sorted"):
        plan = queries.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        observed = plan[plan.index("Union") :].split("Generate inline")[0]  # the union's first branch, above the figures
        assert observed.count("HashAggregate") == 2, name  # a task of the scan sorted all rows of its row group


def test_people_are_read_without_finance(spark, sf):
    scans = lambda name, column: len(re.findall(rf"Relation \[[^\]]*{column}", queries.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()))
    assert scans("best_facts_with_people", "l_extendedprice") == 3  # facts of tables and of lines, and keywords; a fold of figures was a fourth
    assert scans("wide_sheet", "l_extendedprice") == 4  # three kinds of lines, and keywords


def test_a_contacts_sheet_folds_once(spark, sf):
    plan = queries.QUERIES["contacts_sheet"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert FIGURE_RULES["operating_result"] not in plan  # kept; the fold stood in it twice, for the ceilings and for the sheet


def test_structured_lines_ask_once_for_a_key(spark, sf):
    plan = queries.QUERIES["wide_1year"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[^0-9A-Za-zÅÄÖåäö]") == 1 and "(?!)" not in plan
