"""Known inputs and outputs of the rules."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from granary.functions import text
from granary.operators import crm, extract, facts, layout, leads, lines
from granary.operators.numbers import repair_number_runs, split_text_and_numbers


@pytest.mark.parametrize(("run", "n", "values"), [
    ("9 1330", 2, ["9133", "0"]), ("4 990 429 295 000", 2, ["4 990 429", "295 000"]), ("4 4 990 429", 2, ["4 990 429"]), ("04 965 842", 2, ["0", "4 965 842"]),
    ("404 965 842", 2, ["0", "4 965 842"]), ("44 990 429", 2, ["4 990 429"]), ("4 0 4 965 842", 2, ["0", "4 965 842"]), ("12 345 678 901", 2, ["12 345", "678 901"]),
    ("1234 567", 2, ["123", "4 567"]), ("295 000", 2, ["295 000"]), ("2024 2023", 2, ["2024", "2023"]), ("1330", 2, ["1330"]), ("105 000 000", 2, ["0", "5 000 000"]),
    ("22 875 000", 2, ["2 875 000"]), ("22 875 000", 0, ["22 875 000"]),
])
def test_repair_run(spark, run, n, values):
    assert repair_number_runs(spark.createDataFrame([(run,)], "run string"), n).first().parts == values


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_repair_run_without_pair_rules_keeps_digits(spark, n):
    rng = random.Random(n)
    runs = {" ".join("".join(rng.choice("0123456789") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 8))) for _ in range(400)}
    df = spark.createDataFrame([(r,) for r in sorted(runs)], "run string")
    assert all("".join(r.parts).replace(" ", "") == r.run.replace(" ", "") for r in repair_number_runs(df, n, year_pairs=False).collect())


def one(spark, column, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", column(F.col("v")).alias("r")).orderBy("i").collect()
    return [r.r for r in rows]


def test_scalars(spark):
    assert one(spark, text.parse_money, "1 234", "-45 tkr", "1 234,5", "12-34", "–12", "-", "", "6 000 000 000", None) == [1234, -45, 12345, 12, 12, None, None, None, None]
    assert one(spark, lambda c: F.array_join(text.numeric_tokens(c, 5), "|"), "SEK 22 875 000 och -1.234,5 5") == ["22875000|-12345|5"]
    assert one(spark, text.normalize_org, "556025-4731", "55602547", None) == ["5560254731", None, None]
    assert one(spark, text.classify_branch, "Byggentreprenader", "Industri", "Åkeri", "Lastbilsåkeri", "Måleriarbeten", "Bemanning", "", None) == ["core", "secondary", "other", "secondary", "secondary", "other", "", ""]
    assert one(spark, text.normalize_label, "Kortfristiga skulder", "Summa tillgångar", "Eget kapital") == ["Summa Kortfristiga Skulder", "Balansomslutning", None]
    assert one(spark, text.canonical_key, "Capital Box") == ["CapitalBox"]
    assert one(spark, lambda c: text.format_revenue(c.cast("long")), "4900000", "123000", "900", None) == ["4,9 Mkr", "123 tkr", "900 kr", ""]
    assert one(spark, text.format_debt, "0012345", "0", "x", None) == ["12 345 kr", "", "", ""]
    assert one(spark, text.shorten_debt_label, "Övriga skulder till kreditinstitut") == ["Övr. skulder kreditinst."]
    assert one(spark, lambda c: text.join_keywords(F.split(c, ",")), "Svea,Almi, Svea,,Ängel,Åker") == ["Almi;Svea;Åker;Ängel"]
    assert one(spark, facts.is_financing_label, "Skulder och eget kapital", "Långfristiga skulder", "skuldåter", None) == [False, True, True, False]


def test_split_text_and_numbers(spark):
    df = spark.createDataFrame([(1, "Skulder till kreditinstitut 4 990 429:"), (2, "Kortfristiga fordringarKortfristiga fordringar"), (3, None), (4, "")], "k int, line string")
    got = {r.k: (r.label, r["values"]) for r in split_text_and_numbers(df).collect()}
    assert got == {1: ("Skulder till kreditinstitut", ["4 990 429"]), 2: ("Kortfristiga fordringar", []), 3: ("", []), 4: ("", [])}


def test_icp(spark):
    schema = "is_ab boolean, revenue long, employees int, reg_year int, company_age int, branch_segment string, lender_keywords string"
    rows = [(True, 5_000_000, 3, 2010, 16, "core", "Almi"), (False, 20_000_000, 11, 2017, 9, "secondary", ""), (True, 1_000_000, 1, 2020, 6, "other", ""), (None, None, None, None, None, "", "")]
    got = [(r.icp_score, r.icp_reasons) for r in leads.icp_score(spark.createDataFrame(rows, schema)).collect()]
    assert got == [(11, "AB,revenue_core,employees_core,age_core,branch_core,has_lender_debt"), (2, "age_soft,branch_secondary"), (3, "AB,revenue_soft,employees_soft"), (0, "")]


def test_clamp(spark):
    rows = [(1_000_000, None, 1_040_000), (1_000_000, None, 1_060_000), (None, None, 50_000_001), (1_000_000, -200_000, 850_000)]
    df = spark.createDataFrame(rows, "s long, l long, v long")
    assert [r.c for r in df.select(facts.clamp(F.col("v"), facts.debt_ceiling(F.col("s"), F.col("l"))).alias("c")).collect()] == [1_040_000, None, None, None]


def test_merge(spark):
    schema = "org string, seq long, name string, email string, phone string, is_ab boolean, reg_year int, employees int, branch string"
    obs = spark.createDataFrame([("1", 1, "Unknown", None, "", None, 0, None, None), ("1", 2, "A AB", "a@b.se", "+46", True, 2000, 3, "Handel")], schema)
    row = leads.merge_observations(obs).first()
    assert (row["name"], row.email, row.phone, row.is_ab, row.reg_year, row.employees, row.branch_segment, row.company_age) == ("A AB", "a@b.se", "+46", True, 2000, 3, "core", 26)
    assert leads.merge_observations(obs, compat=True).first().employees == 0
    words = spark.createDataFrame([("1", 2, "Svea"), ("1", 2, "Almi")], "org string, seq long, keyword string")
    first = spark.createDataFrame([("1", 1)], "org string, first_seq long")
    scanned = spark.createDataFrame([("1", "OPR")], "org string, keyword string")
    assert leads.union_keywords(words, first, scanned).first().lender_keywords == "Almi;OPR;Svea"
    own = words.unionByName(spark.createDataFrame([("1", 1, "Almi")], "org string, seq long, keyword string"))
    assert leads.union_keywords(own, first, scanned).first().lender_keywords == "Almi;Svea"


def test_best_fact(spark):
    row = lambda score, year, seq, value: ("1", "L", year, value, "r", "S", score, seq, 1)
    best = lambda rows: facts.best_facts(spark.createDataFrame(rows, "org string, label string, year int, value long, raw_line string, source_type string, score int, seq long, tbl_idx int")).first().value
    assert best([row(40, 2022, 1, 10), row(25, 2024, 2, 20)]) == 10
    assert best([row(40, 2022, 1, 10), row(40, 2023, 2, 20)]) == 20
    assert best([row(40, 2023, 2, 20), row(40, 2023, 1, 10)]) == 10


def test_matched_lines(spark):
    df = spark.createDataFrame([(1, "Skuld Almi\n\nSkuld Almi\r\nSvea"), (2, None), (3, "")], "doc_id int, text string")
    got = lines.matched_lines(lines.text_lines(df, "doc_id"), ("Almi", "Svea")).orderBy("line_idx").collect()
    assert [(r.doc_id, r.keyword, r.line, r.line_idx) for r in got] == [(1, "Almi", "Skuld Almi", 1), (1, "Svea", "Svea", 3)]
    many = spark.createDataFrame([(1, "\n".join(f"almi {i}" for i in range(30)))], "doc_id int, text string")
    assert lines.matched_lines(lines.text_lines(many, "doc_id"), ("Almi", "i")).count() == 20


def test_blend(spark):
    schema = "doc_id int, key string, line_idx int, line string, values array<string>"
    xy = spark.createDataFrame([(1, "A", 1, "x1", ["1"])], schema)
    plain = spark.createDataFrame([(1, "A", 1, "t1", ["1", "2"]), (1, "A", 2, "t2", [])], schema)
    assert sorted(r.line for r in lines.blend_lines(xy, plain, ["doc_id", "key"]).collect()) == ["t1", "t2"]
    assert [r.line for r in lines.blend_lines(xy, xy.withColumn("line", F.lit("t")), ["doc_id", "key"]).collect()] == ["x1"]


def test_normalized_matched_lines(spark):
    schema = "i int, key string, line string, values array<string>"
    rows = [(1, "Kreditinstitut", "Skulder till kreditinstitut 3 100 200 300 400", None), (2, "Almi", "Almi", ["1 000", "2 000"]), (3, "Almi", "Almi", ["4 990 429 295 000"]), (4, "Almi", "Almi", None)]
    got = {r.i: (r.line, r["values"]) for r in lines.normalize_matched_lines(spark.createDataFrame(rows, schema)).collect()}
    assert got[2] == ("Almi", ["1 000", "2 000"]) and got[3] == ("Almi", ["4 990 429", "295 000"]) and got[4] == ("Almi", [])
    assert got[1][0] == "Skulder till kreditinstitut" and len(got[1][1]) == 2


def test_value_variants(spark):
    schema = "org string, line_idx int, key string, line string, values array<string>"
    rows = [("1", 1, "K", "a", ["44 990 429", "5"]), ("1", 2, "K", "a", ["4 990 429", "5"]), ("1", 3, "K", "a", ["4 990 429", "5"]), ("2", 1, "K", "a", ["44 990 429", "5"])]
    assert sorted((r.org, r.line_idx) for r in facts.dedupe_value_variants(spark.createDataFrame(rows, schema)).collect()) == [("1", 2), ("2", 1)]


def test_token_rows(spark):
    t = lambda s, x, y, page=1: Row(doc_id=1, page=page, text=s, x=float(x), y=float(y), w=20.0, h=10.0)
    assert layout.row_numbers(np.array([100.0, 95.0, 92.0, 88.0]), layout.tolerance(np.full(4, 10.0))).tolist() == [0, 0, 0, 1]
    tokens = spark.createDataFrame([t("Skulder", 0, 100), t("295 000", 300, 100), t("310 000", 400, 101), t("x", 0, 50, 13), t(" ", 0, 0)])
    got = layout.token_rows(tokens).collect()
    assert [(r.label, r["values"]) for r in got] == [("Skulder", ["295 000", "310 000"])]
    assert [(r.keyword, r.line) for r in layout.matched_token_lines(tokens, ("skulder",)).collect()] == [("skulder", "Skulder")]


def test_pages(spark):
    html = '<a href="/a/arsredovisning-2023.pdf">Årsredovisning</a><a href="/b">om</a><a href="mailto:x@y.se?s=1">m</a><a href="tel:+46 8 123 456 78">t</a><p data-census-details="info@bolag.se"></p>'
    page = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id int, html string")
    links = extract.rank_links(page).collect()
    assert [(r.href, r.score, r["rank"]) for r in links] == [("/a/arsredovisning-2023.pdf", 51, 1)]
    contact = {r.page_id: r for r in extract.extract_contacts(page, "page_id").collect()}[1]
    assert contact.emails == ["info@bolag.se", "x@y.se"] and contact.phone == "+46812345678"


def test_company_facts(spark):
    said = ["Acme Aktiebolag registrerat 2003-04-12, 5 anställda i hela landet. 43341·Måleriarbeten 43210·Elinstallationer Årsredovisningar", "SNI-kod 43.29 Antal anställda: 3 AB registrerat 1066", "", None]
    df = spark.createDataFrame(list(enumerate(said)), "i int, text string")
    got = {r.i: r for r in extract.company_facts(df, "i").collect()}
    assert (got[0].is_ab, got[0].reg_year, got[0].employees, got[0].branch) == (True, 2003, 5, "Måleriarbeten")
    assert (got[1].is_ab, got[1].reg_year, got[1].employees, got[1].sni_code) == (True, None, 3, "43.29")
    assert got[2].reg_year is None and got[3].branch is None


def test_upsert(spark):
    old = spark.createDataFrame([("1", "X", "n", True)], "org_nr string, branch string, notes string, resolved boolean").withColumn("score", F.lit(1))
    new = spark.createDataFrame([("1", None, 4, 1), ("2", "Y", 3, 2), ("2", "Y", 5, 3), ("", "Z", 1, 4), (None, "Z", 1, 5)], "org_nr string, branch string, score int, seq long")
    first = crm.upsert_leads(old, new)
    assert sorted((r.org_nr, r.branch, r.notes, r.resolved, r.score) for r in first.collect()) == [("1", None, "n", True, 4), ("2", "Y", None, None, 5)]
    again = crm.upsert_leads(first, new).select(*first.columns)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, first.collect()), key=str)
    assert set(crm.evolve_schema(old, new).columns) == {"org_nr", "branch", "notes", "resolved", "score", "seq"}


def test_torn_and_merged_tokens_by_column(spark):
    t = lambda s, x, y=100, w=30.0, page=1: Row(doc_id=1, page=page, text=s, x=float(x), y=float(y), w=w, h=10.0)
    rows = [
        [t("Skulder", 0), t("3", 150, w=5.0), t("295 000", 300), t("310 000", 400)],  # a note's number goes
        [t("Lån", 0, 80), t("4 990 429 295 000", 300, 80, 90.0)],  # two values in a token, cut without the rules for years
        [t("Kassa", 0, 60), t("1", 300, 60, 5.0), t("234", 308, 60, 15.0), t("2", 400, 60, 5.0), t("345", 408, 60, 15.0)],
        [t("Not", 0, 40), t("1.234", 300, 40)],
    ]
    got = {r.label: r["values"] for r in layout.token_rows(spark.createDataFrame([x for row in rows for x in row])).collect()}
    assert got == {"Skulder": ["295 000", "310 000"], "Lån": ["4 990", "429 295 000"], "Kassa": ["1 234", "2 345"], "Not": ["1 234"]}
    assert layout.token_rows(spark.createDataFrame(rows[0]), values=False).columns == ["doc_id", "page", "row", "text", "label"]


def test_backfill_keeps_what_it_does_not_know(spark):
    items = ['"bare 12 345"', '{"key": "Almi", "line": "Almi 1 000 2 000", "lineIndex": 4, "page": 3}', '{"keyword": "Svea", "line": "Svea", "values": ["4 990 429 295 000"]}']
    df = spark.createDataFrame([("1", items), ("2", ['"bare"']), ("3", None)], "org string, raw array<string>").select("org", F.transform("raw", F.parse_json).alias("lenderKeywordLines")).withColumn("loanLines", F.col("lenderKeywordLines"))
    new, counted = lines.backfill_matched_lines(df)
    assert tuple(counted.first()) == (1, 3)
    got = [json.loads(x) for x in new.where("org = '1'").select(F.transform("loanLines", lambda v: F.to_json(v)).alias("j")).first().j]
    assert got == ["bare 12 345", {"key": "Almi", "line": "Almi", "lineIndex": 4, "page": 3, "values": ["1 000", "2 000"]}, {"keyword": "Svea", "line": "Svea", "values": ["4 990 429", "295 000"]}]
    assert [x.loanLines for x in new.where("org = '3'").collect()] == [None]


def test_pages_after_a_null(spark):
    df = spark.createDataFrame([(None, "3"), (None, "1"), ("b", "2"), ("a", "5"), ("a", "4"), ("b", "9")], "name string, org_nr string")
    want = [(r.name, r.org_nr) for r in crm.page_leads(df, 0, 100).collect()]
    seen, last = [], None
    page = crm.page_leads(df, 0, 2).collect()
    while page:
        seen += [(r.name, r.org_nr) for r in page]
        last = page[-1]
        page = crm.page_after(df, last["name"], last.org_nr, 2).collect()
    assert seen == want and len(seen) == 6


def test_new_leads_get_defaults(spark):
    old = spark.createDataFrame([("1", "X", True, "then")], "org_nr string, branch string, resolved boolean, created_at string")
    new = spark.createDataFrame([("1", "Y", 1), ("2", "Z", 2)], "org_nr string, branch string, seq long")
    got = {r.org_nr: r for r in crm.upsert_leads(old, new, new_rows=crm.defaults(F.lit("now"))).collect()}
    assert (got["1"].branch, got["1"].resolved, got["1"].created_at) == ("Y", True, "then") and (got["2"].resolved, got["2"].created_at) == (False, "now")


def test_sheet_repair_and_ceilings(spark):
    df = spark.createDataFrame([("1 000 000", "-0200000", "1 200 000", "1 300 000", "0"), (None, "", "50000001", "x", None)], "s string, l string, a string, b string, c string")
    sheet, counted = facts.repair_sheet(df.withColumn("s", F.regexp_replace("s", " ", "")), ("a", "b", "c"), "s", "l")
    assert sorted((str(r.a), str(r.b), str(r.c)) for r in sheet.collect()) == [("1 200 000", "None", "0"), ("None", "x", "None")] and counted.first().cleared == 2


def test_structured_lines_fill_cell_by_cell(spark):
    schema = "org string, seq long, pos int, key string, line string, idx int, values array<string>"
    rows = [("1", 1, 0, "Kredit institut", "a 1 000", None, []), ("1", 1, 1, None, "bare", None, None), ("1", 2, 0, "Kreditinstitut", "b", 7, ["2.000", "60 000 000"]), ("1", 2, 1, "Kreditinstitut", "c", 8, ["3"]), ("1", 2, 2, "Kreditinstitut", " ", 9, ["4"])]
    items = spark.createDataFrame(rows, schema)
    got = {(r.key, r.n): (r.line, r.idx, [x for x in r.numbers if x]) for r in leads.structured_lines(items).collect()}
    assert got == {("Kreditinstitut", 1): ("a 1 000", 7, ["1000", "60000000"]), ("Kreditinstitut", 2): ("c", 8, ["3"]), ("Unknown", 1): ("bare", None, [])}
    capped = leads.line_columns(leads.structured_lines(items, spark.createDataFrame([("1", 50.0)], "org string, ceiling double"))).first()
    assert (capped.l1, capped.l1_n1, capped.l1_n2, capped.l2_n1) == ("a 1 000", None, None, "3")
    many = spark.createDataFrame([("1", 1, i, "K", f"l{i}", i, [str(n) for n in range(12)]) for i in range(15)], schema)
    out = leads.structured_lines(many, separators=True).collect()
    assert len(out) == 10 and all(len(r.numbers) == 10 for r in out)
