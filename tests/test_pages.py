"""Tables of html pages: what is within what, and what closes what."""

import json
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from granary.operators import extract
from granary.operators.pages import Scan, debts_of, scan_tables
from granary.plans import jobs

HEAD = '<tr><th></th><th class="text-right">2023-12</th><th class="text-right">2022-12</th></tr>'


def _tables(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    return {r.page_id: [(x.years, x.rawLabel, x["values"]) for x in r.tables] for r in extract.finance_tables(df, "page_id").collect()}


def test_nesting_titles_and_years(spark):
    row = '<tr><td><span class="title">Netto<b>omsättning</b> <i>tkr</i></span></td><td class="text-right">1&nbsp;<b>2</b>3</td><td class="text-right">4</td></tr>'
    finance = lambda inner: f'<table data-test="finance-table">{inner}</table>'
    want = [([2023, 2022], "Nettoomsättning tkr", ["1 23", "4"])]
    got = _tables(
        spark,
        finance(f"<thead>{HEAD}</thead><tbody>{row}</tbody>"),
        finance(HEAD + row),  # years in the first row of the body
        finance(f'<thead>{HEAD}</thead><tbody><tr><th class="text-right">1999</th><th class="text-right">1998</th></tr>{row}</tbody>'),  # the head's years count
        f"<table><tr><td>{finance(HEAD + row)}</td><td class='text-right'>9</td></tr></table>",
        finance(HEAD + row.replace("</td>", "").replace("</tr>", "")),
        finance(HEAD.replace("2022", "x") + row),  # one year only
        finance(f"<thead>{HEAD}</thead><tfoot>{row}</tfoot>"),  # not in the body
        "<p>no table</p>",
        None,
        "",
        f"<!-- {finance(HEAD + row)} --><script>{finance(HEAD + row)}</script>",
        finance(HEAD + '<tr><td class="title">A</td></tr><tr><td class="text-right">1</td></tr>'),  # no value, no title
        finance(HEAD + f'<tr><td class="title">Yttre</td><td class="text-right">1<table>{row}</table></td></tr>'),
    )
    assert {i: got.get(i) for i in range(5)} == dict.fromkeys(range(5), want)
    assert set(got) == {0, 1, 2, 3, 4, 12}
    assert [x[1:] for x in got[12]] == [("Yttre", ["1 Nettoomsättning tkr 1 23 4", "1 23", "4"]), ("Nettoomsättning tkr", ["1 23", "4"])]


def test_debts(spark):
    head = "<tr><th></th><th>2023</th><th>2022</th></tr>"
    pages = [
        f"<table><tr><td>x</td></tr></table><table>{head}<tr><td>Kortfristiga<br>skulder</td><td>1&nbsp;234</td><td>-</td></tr><tr><td>Långfristiga skulder<td>5<td>6</table>",
        f"<table>{head}<tr><td>Kortfristiga skulder</td><td>1</td><td>2</td></tr><tr><td>Övriga kortfristiga skulder</td><td>8</td><td>9</td></tr></table>",
        '<table data-year="2023" title="2022"><tr><td>Kortfristiga skulder</td><td>1</td></tr></table>',  # years only in marks
        f"<p>Kortfristiga skulder</p><table>{head}</table>",
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    scanned = scan_tables(df, "page_id")
    rows = lambda every: sorted(tuple(r) for r in debts_of(scanned, "page_id", every_row=every).select("page_id", "kind", "year", F.coalesce("value", F.lit(-1))).collect())
    assert sorted(set(rows(True)) - set(rows(False))) == [(1, "short", 2022, 9), (1, "short", 2023, 8)]
    assert rows(False) == [(0, "long", 2022, 6), (0, "long", 2023, 5), (0, "short", 2022, -1), (0, "short", 2023, 1234), (1, "short", 2022, 2), (1, "short", 2023, 1)]


class _Plain(HTMLParser):
    """Text of well-formed pages cell by cell, for comparison."""

    def __init__(self):
        super().__init__()
        self.open, self.cells = [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("td", "th"):
            self.cells.append([])
            self.open.append(self.cells[-1])

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self.open.pop()

    def handle_data(self, data):
        for cell in self.open:
            cell.append(data)


def test_cells_of_random_pages():
    rng = random.Random(7)

    def cell(depth):
        inner = table(depth - 1) if depth and rng.random() < 0.4 else "".join(rng.choice(["a", "<b>b</b>", "&amp;", "c<i>d</i>", "5"]) for _ in range(3))
        tag = rng.choice(["td", "th"])
        return f'<{tag} title="x>y">{inner}</{tag}>'

    def table(depth):
        return "<table>" + "".join("<tr>" + "".join(cell(depth) for _ in range(rng.randint(1, 3))) + "</tr>" for _ in range(rng.randint(1, 3))) + "</table>"

    for _ in range(200):
        page = table(3)
        plain = _Plain()
        plain.feed(page)
        scan = Scan(page)
        outer = [c for r in scan.tables[0].parts for c in r.parts]
        seen = sorted({id(c): c for c in outer}.values(), key=lambda c: c.start)
        squeeze = lambda s: "".join(s.split())
        assert sorted(squeeze(scan.said(c)) for c in seen) == sorted(squeeze("".join(c)) for c in plain.cells)
        assert all(a.end <= b.start or b.end <= a.end for a, b in zip(seen, seen[1:]))


def test_pages_that_never_end_are_linear():
    import time

    start = time.monotonic()
    for piece in ("<b ", '<a x="', "<!-- <script", "<b = = ", "<table><tr>", "</table></td>", "<td><b>", "<"):
        Scan(piece * (300 if piece == "<table><tr>" else 30_000)).records()
    assert time.monotonic() - start < 20


def test_rescan_to_the_table(spark, tmp_path):
    rows = [{"org": "0000000001", "name": "A", "lenderKeywords": ["Svea"]}, {"org": "0000000002", "name": "B", "lenderKeywords": []}, {"org": "0000000003", "name": "C", "lenderKeywords": ["OPR"]}]
    (tmp_path / "o.jsonl").write_text("\n".join(map(json.dumps, rows)), encoding="utf-8")
    from granary.sources import files

    sound, _ = files.read_observations(spark, str(tmp_path))
    wanted = spark.createDataFrame([(f"000000000{i}", "X") for i in (1, 2, 3)], "org string, name string")
    texts = spark.createDataFrame([("0000000001", "Kreditinstitut skulder 7 000 8 000"), ("0000000002", "Almi")], "org string, text string")
    pages = spark.createDataFrame([], "org string, html string")
    old = spark.createDataFrame([(f"000000000{i}", "", None, "mine", True) for i in (1, 2, 3)], "org_nr string, lender_keywords string, debt_lines string, notes string, resolved boolean")
    old = old.withColumns({c: F.lit(None).cast("string") for c in ("resolved_at", "updated_at")})
    columns = {"org": "org_nr", "lender_keywords": "lender_keywords", "debt_lines": "debt_lines"}
    got = {r.org_nr: r for r in jobs.rescan_leads(old, sound, wanted, pages, texts, F.lit("now"), columns).collect()}
    # the first was read anew; the second has no keyword and so is no target, the third nothing new
    assert (got["0000000001"].lender_keywords, got["0000000001"].debt_lines, got["0000000001"].updated_at) == ("Kreditinstitut;Svea", "Kreditinstitut: Kreditinstitut skulder", "now")
    assert [(got[f"000000000{i}"].lender_keywords, got[f"000000000{i}"].updated_at) for i in (2, 3)] == [("", None)] * 2
    assert all(r.notes == "mine" and r.resolved for r in got.values())
