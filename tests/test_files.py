"""Sources, sinks and whole jobs on small files."""

import json

import pytest
from pyspark.sql import functions as F

from pyarrow.fs import LocalFileSystem

from granary.operators import facts
from granary.plans import jobs, reports, storage
from granary.sources import files
from granary.streaming.leads import stream_leads


def _observation(org, **more):
    base = {"org": org, "name": "A AB", "email": None, "phone": None, "regYear": 2000, "employees": 3, "isAB": True, "branch": "Handel", "lenderKeywords": ["Almi"], "lenderKeywordLines": ["bare", {"key": "Almi", "line": "Almi 1", "lineIndex": 4, "values": ["1"]}], "tables": [{"years": [2023, 2022], "rawLabel": "Nettoomsättning", "values": ["5 000", "4 000"]}]}
    return json.dumps(base | more, ensure_ascii=False)


def test_targets(spark, tmp_path):
    head, bare = tmp_path / "h.csv", tmp_path / "b.csv"
    head.write_text("﻿Company,OrgNr,Email\n Acme ,556025-4731,a@b.se\n,,\nNameless,,\n", encoding="utf-8")
    bare.write_text("https://x.se,Acme,5560254731,a@b.se\nhttps://y.se,,bad,\n", encoding="utf-8")
    assert [(r.org, r.name) for r in files.read_targets(spark, str(head)).orderBy("seq").collect()] == [("5560254731", "Acme"), (None, "Nameless")]
    assert [(r.org, r.url) for r in files.read_targets(spark, str(bare)).collect()] == [("5560254731", "https://x.se")]
    assert all(r.ok for r in files.validate_targets(spark, str(head)).collect())
    (tmp_path / "bad.csv").write_text("a,b\n")
    assert not all(r.ok for r in files.validate_targets(spark, str(tmp_path / "bad.csv")).collect())


def test_observations(spark, tmp_path):
    (tmp_path / "o.jsonl").write_text("\n".join([_observation("0000000001"), "{broken", "", json.dumps({"name": "no org"}), _observation("0000000002", employees=None)]), encoding="utf-8")
    sound, bad = files.read_observations(spark, str(tmp_path))
    assert sound.count() == 2 and bad.count() == 1
    items = files.matched_items(sound.where("org = '0000000001'"), "lenderKeywordLines").orderBy("line_idx").collect()
    assert [(r.key, r.line, r["values"], r.line_idx) for r in items] == [("Unknown", "bare", None, 1), ("Almi", "Almi 1", ["1"], 4)]
    leads = {r.org: r for r in jobs.build_leads(sound).collect()}
    assert leads["0000000001"].revenue == 5_000_000 and leads["0000000001"].icp_score == 11
    assert leads["0000000002"].employees is None


def test_lines_are_numbered_alike_however_files_are_cut(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = {}
    for name, n in (("b", 400), ("a", 3), ("c", 1), ("d", 0)):
        lines[name] = [json.dumps({"org": f"{k:010d}", "name": name * (k % 90)}) if k % 7 else ("" if k % 2 else "{broken") for k in range(1, n + 1)]
        (tmp_path / "in" / f"{name}.jsonl").write_text("".join(f"{x}\r\n" if name == "c" else f"{x}\n" for x in lines[name]))
    everything = lines["a"] + lines["b"] + lines["c"]
    want = [(i, json.loads(x)["org"], json.loads(x)["name"]) for i, x in enumerate(everything) if x.startswith('{"')]
    bytes_a_part = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(bytes_a_part)
    try:
        for size in ("1kb", "300b", "128mb"):
            spark.conf.set(bytes_a_part, size)
            sound, bad = files.read_observations(spark, str(tmp_path / "in"))
            assert sorted((r.seq, r.org, r["name"]) for r in sound.select("seq", "org", "name").collect()) == want
            assert sorted((r.seq, r._corrupt_record) for r in bad.collect()) == [(i, x) for i, x in enumerate(everything) if x == "{broken"]
        spark.conf.set(bytes_a_part, "500b")  # cut another way than counted
        with pytest.raises(Exception, match="cut another way"):
            sound.select("seq").collect()
    finally:
        spark.conf.set(bytes_a_part, usual)
    assert files.numbered_lines(spark, str(tmp_path / "in" / "d.jsonl")).count() == 0


def test_running_total(spark):
    df = spark.range(500).selectExpr("499 - id AS k", "id % 5 AS n")
    got = {r.k: r.t for r in storage.running_total(df, "t", "n", F.col("k")).collect()}
    total = 0
    for k in range(500):
        assert got[k] == total
        total += (499 - k) % 5
    assert storage.running_total(df.limit(0), "t", "n", F.col("k")).collect() == []


def test_report_files(spark, tmp_path):
    (tmp_path / "5560254731_a.pdf").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "5560254731_b.pdf").write_bytes(b"nope")
    (tmp_path / "c.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "5560254731_d.pdf").write_bytes(b"")
    got = {r.path.rsplit("/", 1)[1]: (r.ok, r.reason) for r in files.intake_report_files(spark, str(tmp_path)).collect()}
    assert got == {"5560254731_a.pdf": (True, None), "5560254731_b.pdf": (False, "not a pdf"), "c.pdf": (False, "no org")}


def test_only_the_head_of_a_report_file_is_read(spark, tmp_path):
    class Counting(LocalFileSystem):
        asked = 0

        def open_input_file(self, name):
            stream, own = super().open_input_file(name), self

            class Stream:
                __enter__, __exit__ = (lambda s: s), (lambda s, *_: stream.close())

                def read_at(self, n, at):
                    own.asked += n
                    return stream.read_at(n, at)

            return Stream()

    file = tmp_path / "0000000001_a b%20å.pdf"
    file.write_bytes(b"x%PDF-1" + b"0" * 1_000_000)
    system = Counting()
    assert files.read_head(f"file:{file}", lambda p: (system, str(file))) == b"x%PDF-10" and system.asked == files.HEAD_BYTES
    with open(tmp_path / "0000000002_large.pdf", "wb") as f:
        f.truncate(30_000_000)
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "0000000003_late.pdf").write_bytes(b"xxxx%PDF-")  # its mark ends beyond the head
    found = files.intake_report_files(spark, str(tmp_path))
    assert {r.org: r.reason for r in found.collect()} == {"0000000001": None, "0000000002": "too large", "0000000003": "not a pdf"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan  # lengths alone are listed
    assert files.intake_report_files(spark, str(tmp_path), most_bytes=5).where("ok").isEmpty()


def test_sheets(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", None), ("2", "b", 5.5)], "k string, v string, n double")
    files.publish_copies(df, [str(tmp_path / "x"), str(tmp_path / "y")], ("Key", "Value", "Value"))
    back = files.read_leads_sheet(spark, str(tmp_path / "x"), ["k", "v", "n"], ("n",)).orderBy("k").collect()
    assert [(r.k, r.v, r.n) for r in back] == [("1", "a", None), ("2", "b", 5.5)]
    old = spark.createDataFrame([("1", "z", False)], "org_nr string, v string, resolved boolean").withColumns({"resolved_at": F.lit(None).cast("string"), "updated_at": F.lit(None).cast("string")})
    sheet = files.read_leads_sheet(spark, str(tmp_path / "y"), ["org_nr", "v", "n"], ("n",))
    done = {r.org_nr: r for r in jobs.import_leads(old, sheet, F.lit("now")).collect()}
    assert done["1"].v == "a" and done["1"].updated_at == "now" and done["2"].n == 5.5


def test_stream_equals_batch(spark, tmp_path):
    source, snapshot = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for i in range(3):
        (source / f"{i}.jsonl").write_text("\n".join(_observation(f"{k:010d}", name="Unknown" if i == 0 else f"N{k}{i}", lenderKeywords=["Almi"] if i else []) for k in range(i, 5 + i)), encoding="utf-8")
        stream_leads(spark, str(source), str(snapshot), str(tmp_path / "cp")).awaitTermination()
    columns = ["org", "name", "employees", "icp_score", "lender_keywords", "revenue"]
    streamed = spark.read.parquet(str(snapshot)).select(*columns).orderBy("org").collect()
    batch = jobs.build_leads(files.read_observations(spark, str(source))[0]).select(*columns).orderBy("org").collect()
    assert streamed == batch


def test_build_observations(spark):
    wanted = spark.createDataFrame([("0000000001", "A"), ("0000000002", "B"), ("0000000003", "C")], "org string, name string")
    pages = spark.createDataFrame([("0000000001", "<p>Acme AB registrerat 2001</p>"), ("0000000003", "<p>x</p>")], "org string, html string")
    texts = spark.createDataFrame([("0000000002", "lån hos almi")], "org string, text string")
    done = spark.createDataFrame([("0000000003",)], "org string")
    got = {r.org: r for r in jobs.build_observations(wanted, pages, texts, done).collect()}
    assert set(got) == {"0000000001", "0000000002"} and got["0000000001"].regYear == 2001 and got["0000000002"].lenderKeywords == ["Almi"]


def test_build_observations_of_many_pages(spark):
    table = lambda label: f'<table data-test="finance-table"><tr><th class="text-right">2023</th><th class="text-right">2022</th></tr><tr><td><span class="title">{label}</span></td><td class="text-right">5</td><td class="text-right">4</td></tr></table>'
    wanted = spark.createDataFrame([("0000000001", "A")], "org string, name string")
    rows = [("0000000001", 3, "<p>Antal anställda: 9 registrerat 1999</p>" + table("Rörelseresultat")), ("0000000001", 1, "<p>Acme registrerat 2001</p>" + table("Nettoomsättning")), ("0000000001", 2, '<p>Acme AB</p><a href="mailto:a@b.se">x</a>')]
    pages = spark.createDataFrame(rows, "org string, seq long, html string")
    texts, done = spark.createDataFrame([], "org string, text string"), spark.createDataFrame([], "org string")
    got = jobs.build_observations(wanted, pages, texts, done).collect()
    assert [(r.org, r.email, r.regYear, r.employees, r.isAB) for r in got] == [("0000000001", "a@b.se", 2001, 9, True)]
    assert [t.rawLabel for t in got[0].tables] == ["Nettoomsättning", "Rörelseresultat"]
    assert jobs.build_observations(wanted, pages.drop("seq"), texts, done).count() == 1


def test_rescan(spark):
    obs = spark.createDataFrame([("1", 1, "A"), ("2", 2, "B")], "org string, seq long, name string")
    words = spark.createDataFrame([("1", 1, "Almi")], "org string, seq long, keyword string")
    assert [(r.org, r.rescan_only) for r in jobs.rescan_cycle(obs, words, obs).collect()] == [("1", True)]


def test_reports(spark, tmp_path):
    (tmp_path / "o.jsonl").write_text("\n".join([_observation("0000000001", sniCode="43"), _observation("0000000002", isAB=False)]), encoding="utf-8")
    sound, _ = files.read_observations(spark, str(tmp_path))
    leads = jobs.build_leads(sound)
    lines = spark.createDataFrame([("0000000001", 1, 2, "Kreditinstitut", "Skulder b", ["60 000 000", "5"]), ("0000000001", 1, 1, "Kreditinstitut", "Skulder a", ["7", "8"]), ("0000000001", 1, 3, "Almi", "x", [])], "org string, seq long, line_idx int, key string, line string, values array<string>")
    sheet, titles = reports.contacts(leads, lines)
    assert len(titles) == 26 and titles.count("Recent_Year_Value") == 2
    files.write_sheet(sheet, str(tmp_path / "contacts"), titles)
    shown = files.read_leads_sheet(spark, str(tmp_path / "contacts"), [f"c{i}" for i in range(26)]).orderBy("c2").collect()
    assert [(r.c2, r.c12, r.c20, r.c21, r.c23, r.c24, r.c25) for r in shown] == [("0000000001", "43", "Skulder a", "7", "Skulder b", None, "5"), ("0000000002", None, None, None, None, None, None)]
    sheet, titles = reports.wide(leads, lines)
    row = sheet.where("c0 = '0000000001'").first()
    assert len(titles) == len(sheet.columns) == 15 and row.c6 == "Kreditinstitut: Skulder a || Kreditinstitut: Skulder b" and row.c5.endswith("Almi: x")
    best = facts.best_facts(facts.atomic_facts(facts.finance_rows(sound)))
    sheet, titles = reports.pivot(leads, best, ["Omsättning"])
    assert titles[-2:] == ("Omsättning", "År") and sheet.count() == 2
    files.write_sheet(sheet, str(tmp_path / "pivot"), titles)


def test_build_observations_with_lines_and_tokens(spark):
    wanted = spark.createDataFrame([(f"000000000{i}", "A") for i in range(1, 6)], "org string, name string")
    pages = spark.createDataFrame([("0000000003", "<p>Lån hos Almi 1 000 2 000</p>"), ("0000000004", "<table><tr><th></th><th>2023</th><th>2022</th></tr><tr><td>Kortfristiga skulder</td><td>7</td><td>8</td></tr></table>")], "org string, html string")
    texts = spark.createDataFrame([("0000000001", "x\nSkulder till kreditinstitut 3 44 990 429 5\nSkulder till kreditinstitut 3 4 990 429 5\nAlmi"), ("0000000002", "Skuld Almi")], "org string, text string")
    t = lambda s, x, y=100: ("0000000002", 1, s, float(x), float(y), 20.0, 10.0)
    tokens = spark.createDataFrame([t("Skuld Almi", 0), t("295 000", 300), t("310 000", 400)], "org string, page int, text string, x double, y double, w double, h double")
    done = spark.createDataFrame([], "org string")
    got = {r.org: r for r in jobs.build_observations(wanted, pages, texts, done, tokens=tokens).collect()}
    assert set(got) == {"0000000001", "0000000002", "0000000003", "0000000004"}
    one, two, three, four = (got[f"000000000{i}"] for i in range(1, 5))
    assert one.lenderKeywordsSource == "PDF" and one.lenderKeywords == ["Almi", "Kreditinstitut"] and [(x.key, x.lineIndex) for x in one.lenderKeywordLines] == [("Kreditinstitut", 2), ("Kreditinstitut", 3), ("Almi", 4)]
    assert 1 <= len(one.kreditinstitutSkulderLines) <= 2 and all(x.key == "Kreditinstitut" for x in one.kreditinstitutSkulderLines)
    assert [(x.line, x["values"], x.source) for x in two.lenderKeywordLines] == [("Skuld Almi", ["295 000", "310 000"], "PDF_XY")]
    assert three.lenderKeywordsSource == "HTML" and three.lenderKeywordLines[0]["values"] == ["1 000", "2 000"]
    assert [(x.rawLabel, x.years, x["values"]) for x in four.tables] == [("Kortfristiga skulder", [2023, 2022], ["7", "8"])] and four.lenderKeywordsSource == "NONE"


def test_leads_have_their_lines(spark, tmp_path):
    rows = [_observation("0000000001", lenderKeywordLines=[{"key": "Kreditinstitut", "line": "Skuld a", "lineIndex": 2, "values": ["7 000", "60 000 000"]}, "bare"], lenderKeywords=[]), _observation("0000000001", kreditinstitutSkulderLines=[{"key": "K", "line": "stored"}], lenderKeywordLines=[{"key": "Kreditinstitut", "line": "Skuld b", "values": ["8"]}])]
    (tmp_path / "o.jsonl").write_text("\n".join(rows), encoding="utf-8")
    sound, _ = files.read_observations(spark, str(tmp_path))
    row = jobs.build_leads(sound, scanned=spark.createDataFrame([("0000000001", "Svea")], "org string, keyword string")).first()
    assert (row.l1, row.l1_idx, row.l1_n1, row.l1_n2) == ("Skuld a", 2, "7000", None) and row.lender_keywords == "Almi;Svea"
    assert row.every_line == "Kreditinstitut: Skuld a || bare || Kreditinstitut: Skuld b" and row.debt_lines == "Kreditinstitut: Skuld a || K: stored"
