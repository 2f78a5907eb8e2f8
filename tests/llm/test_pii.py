"""Personal data: base spans against Python's re, added spans by hand, and the SQL over both."""

import hashlib
import random
import re

import duckdb

from granary.llm import pii
from granary.llm.oracles import PII

SCHEMA = "doc_id long, text string"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def _holds(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(part) <= 255 for part in hit.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if _holds(kind, m.group())]
    listed = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found))
    return (*[sum(f[3] == kind for f in found) for kind in PATTERNS], hashlib.sha256(listed.encode()).hexdigest())


def texts():
    rng = random.Random(4)
    alphabets = ["ab@.-_+ 1é", "0123456789 -.", "+()0123456789 .-😀", "a@b.c_%+12", "1.25 ", "DE89GB 3704-12", "123-45-6789 ssn"]
    out = ["".join(rng.choice(alphabets[i % len(alphabets)]) for _ in range(rng.randint(0, 60))) for i in range(1500)]
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1112", "9807915762804490"]
    return out + [f"é😀 {c}, a.b@c.de x 300.1.1.1 1.2.3.4.5.6.7.8 +1 (017) 555-7713 +1 2" for c in cards] + [None, "", " "]


ADDED = {
    "pay to DE89 3704 0044 0532 0130 00 BIC or GB82WEST12345698765432.": "iban:7:34,iban:42:64",
    "DE88370400440532013000 DE893704004405320130001 xDE89370400440532013000": "",
    "her SSN is 123-45-6789": "ssn:11:22",
    "social security number 666-45-6789 or 123-00-6789 or 123-45-0000 or 1123-45-6789": "",
    "part 123-45-6789 of 123-45-6789": "",
    "call (212) 555-1234 now": "tel:5:19",
    "order 212-555-1234 or 212-555-1234": "",
}


def test_base_spans_are_the_library_s(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", row long, kind string, n_email long")
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.pii(df).collect()}
    assert {i: t for i, t in rows if got[i] != brute(t)} == {}


def test_added_spans(spark):
    rows = list(enumerate(ADDED))
    got = {r.doc_id: r for r in pii.pii(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {t: got[i].spans for i, t in rows} == ADDED
    found = pii.spans(spark.createDataFrame(rows[:1], SCHEMA)).where("kind is not null").collect()
    assert {(r.text, r.score >= pii.LEAST) for r in found} == {("DE89 3704 0044 0532 0130 00", True), ("GB82WEST12345698765432", True)}


def test_words_nearby_move_the_score(spark):
    rows = [(0, "visa 4111111111111111"), (1, "xyz 4111111111111111"), (2, "mail a@b.cd"), (3, "a@b.cd")]
    score = {r.doc_id: r.score for r in pii.spans(spark.createDataFrame(rows, SCHEMA)).where("kind is not null").collect()}
    assert score[0] > score[1] and score[2] > score[3]


def test_sql(spark):
    rows = list(enumerate([*texts(), *ADDED]))
    df = spark.createDataFrame(rows, SCHEMA)
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    columns = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
    assert sorted(tuple(r[c] for c in columns) for r in pii.pii(df).collect()) == sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({PII})").fetchall())


def test_very_long_texts(spark):
    long = ["a" * 300_000, "1" * 300_000, "1 " * 100_000, "a@b" + ".c" * 100_000, "+1" + "-" * 100_000, "a." * 100_000 + "@b.c"]
    got = {r.doc_id: r for r in pii.pii(spark.createDataFrame([*enumerate(long), (90, "x@y.z " * 20_000)], SCHEMA)).collect()}
    assert [(got[i].n_email, got[i].n_card, got[i].n_phone) for i in range(6)] == [(0, 0, 0), (0, 0, 0), (0, 0, 0), (1, 0, 0), (0, 0, 0), (1, 0, 0)]
    assert got[90].n_email == 20_000 and got[90].spans.endswith("email:119994:119999")


def test_repeated_rows_and_nothing(spark):
    rows = [(1, "a@b.cd"), (1, "a@b.cd"), (None, "a@b.cd"), (1, "none")]
    assert sorted(r.n_email for r in pii.pii(spark.createDataFrame(rows, SCHEMA)).collect()) == [0, 1, 1, 1]
    assert pii.pii(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = pii.pii(spark.createDataFrame([(1, "a")], SCHEMA).limit(1))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
