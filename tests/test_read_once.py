"""Pages, tokens and lines that a job reads once, and what it does not move for them."""

import random
import re

from pyspark.sql import functions as F

from granary.config import RULES, Rules
from granary.operators import layout, pages
from granary.plans import adapters, jobs

TABLE = '<table data-test="finance-table"><tr><th class="text-right">2023<th class="text-right">2022<tr><td class="title">{0}<td class="text-right">{1}<td class="text-right">4</table>'
DEBTS = "<table><tr><th><th>{0}<th>{1}<tr><td>Kortfristiga<br>skulder<td>1&nbsp;234<td>-<tr><td>Långfristiga skulder<td>5</table>"


def test_a_job_reads_each_page_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def seen(html):
        calls.add(1)
        return html

    rows = [(f"{i:010d}", f"<p>Acme AB registrerat 2001 +46 8 123 45 67</p>{TABLE.format('skulder', i)}Almi {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "org string, html string").repartition(2)
    asked = df.select("org", F.udf(seen, "string")("html").alias("html"))
    texts = spark.createDataFrame([], "org string, text string")
    made = jobs.build_observations(df.select("org", F.lit("A").alias("name")), asked, texts, texts.select("org"))
    got = made.select("org", "regYear", "phone", "lenderKeywords", F.size("tables").alias("n")).collect()
    assert len(got) == 40 and {(r.regYear, r.phone, tuple(r.lenderKeywords), r.n) for r in got} == {(2001, "+4681234567", ("Almi",), 1)}
    assert calls.value == 40  # five passes before


def test_tables_of_pages_are_those_of_the_scan(spark):
    rng = random.Random(2)
    bits = [TABLE.format("a", 1), TABLE.format("b", 2).replace("2022", "x"), DEBTS.format(2023, 2022), DEBTS.format(2021, "x"), "<p>Kortfristiga skulder</p>", "x", "<table><tr><td>y</table>", DEBTS.format(2020, 2019).replace("Lång", "Kort")]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 4)))) for i in range(300)] + [(300, None)]
    df = spark.createDataFrame(rows, "id int, html string")
    scanned = pages.scan_tables(df, "id").persist()
    finance = {r.id: r.tables for r in pages.finance_of(scanned, "id").collect()}
    debts: dict = {}
    for r in pages.debts_of(scanned, "id").orderBy("id", F.desc("kind"), F.desc("year")).collect():
        debts.setdefault(r.id, {}).setdefault({"short": "Kortfristiga skulder", "long": "Långfristiga skulder"}[r.kind], []).append((r.year, "" if r.value is None else str(r.value)))
    got = {r.id: r for r in pages.tables_of(df).collect()}
    assert len(got) == 301 and len(finance) > 50 and len(set(debts) - set(finance)) > 50
    for i, r in got.items():
        assert r.tables == finance.get(i)
        want = None if i in finance or i not in debts else [([y for y, _ in cells], label, [v for _, v in cells]) for label, cells in debts[i].items()]
        assert (r.debts and [(x.years, x.rawLabel, x["values"]) for x in r.debts]) == want
    scanned.unpersist()


def test_line_breaks_make_no_structure(monkeypatch):
    made = []
    monkeypatch.setattr(pages, "_written", pages.lru_cache(lambda marks: made.append(marks) or pages._structure_of(marks)))
    for i in range(20):
        page = TABLE.format("<br>".join("a" * i) + "<!-- x -->&am<img>p;", "5<br/>6")
        assert pages.Scan(page).finance() == [([2023, 2022], " ".join([*("a" * i)]) + "&amp;" if i else "&amp;", ["5 6", "4"])] and len(set(made)) == 1
        assert pages.Scan(page).finance() == [(r["years"], r["label"], r["values"]) for r in _plain_rows(page)]


def _plain_rows(page):
    rows = pages.Scan(page).records(debts=False)[0][3]
    years = [int(y[:4]) for y in rows[0][3]]
    return [{"years": years, "label": label, "values": values} for _, _, label, _, values, *_ in rows if values]


def test_rows_without_a_word_are_numbered_and_go(spark):
    t = lambda doc, s, x, y, page=1: (doc, page, s, float(x), float(y), 20.0, 10.0)
    rows = [t("a", "Kassa", 0, 90), t("a", "7", 300, 90), t("a", "SKULDER", 0, 50, 2), t("a", "295 000", 300, 50, 2), t("a", "310 000", 400, 51, 2), t("b", "Kassa", 0, 90), t("a", "ⰀSkuld", 0, 20, 2), t(None, "skulder", 0, 1)]
    tokens = spark.createDataFrame(rows, "org string, page int, text string, x double, y double, w double, h double")
    laid = layout.lay_out(tokens.where("org is not null"), key="org", words=("skulder",)).collect()
    assert [(r.org, r.page, r.row, r.line_idx, r.text) for r in laid] == [("a", 2, 1, 2, "SKULDER 295 000 310 000"), ("a", 2, 2, 3, "ⰀSkuld")]  # the last is left to Spark
    assert [tuple(r) for r in layout.matched_token_lines(tokens, ("skulder",), key="org").collect()] == [("a", "skulder", "SKULDER", 2, ["295 000", "310 000"])]


def test_words_in_any_case_are_found_behind_a_search(spark):
    from granary.operators import extract

    df = spark.createDataFrame([(1, "Acme AKTİEBOLAG regiſtrerat 2001 ANTAL ANSTÄLLDA: 7"), (2, "Brancſh: Åkeri BRANſCH: Handel och ſmått"), (3, "AB SNı-kod: 43 120")], "i int, text string")
    got = {r.i: r for r in extract.company_facts(df, "i").collect()}
    assert (got[1].is_ab, got[1].reg_year, got[1].employees) == (True, 2001, 7) and got[2].branch == "Handel och ſmått" and (got[3].is_ab, got[3].sni_code) == (True, "43120")


def test_lines_are_dealt_out_as_numbers_and_once(spark, sf):
    plan = adapters.obs_tables(spark, sf).groupBy("org", "seq").agg(F.collect_list(F.struct("tbl_idx", "raw_label")).alias("l"))._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\((\w+)", plan)
    assert dealt == ["o_orderkey"] and "Nettoomsättning" not in plan[plan.index("Exchange") :]  # texts went with the lines, and then by org once more


def test_rules_hold_any_words(spark):
    texts = spark.createDataFrame([("1", "x\nlån hos Capital  Box\nCapital Box")], "org string, text string")
    page = spark.createDataFrame([("2", "<p>Capital<b> </b>Box</p>"), ("3", "<p>Capital<b>Box</b></p>")], "org string, html string")
    made = jobs.build_observations(texts.select("org", F.lit("A").alias("name")).unionByName(page.select("org", F.lit("A").alias("name"))), page, texts, texts.limit(0).select("org"), Rules(lenders=("Capital Box",)))
    assert sorted((r.org, r.lenderKeywordsSource, len(r.lenderKeywordLines)) for r in made.collect()) == [("1", "PDF", 2), ("3", "HTML", 1)] and "Capital Box" in RULES.lenders


def test_what_was_shuffled_for_a_kept_table_leaves_the_disk(spark):
    from granary.plans import storage

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert storage.keep(df, release=True).count() == storage.keep(df).count() == df.count() == 7
    assert spark.conf.get(setting) == before == "false"
