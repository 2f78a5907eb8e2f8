"""Operators whose cost must follow their input: long runs, hot tokens, deep pages, lines that share a number."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from granary import queries
from granary.operators import crm, facts, leads, lines, numbers, search, targets


def _plain_cheapest(groups, n):
    """The cheapest cut by trying every one, for short runs."""
    cost = {4: 0.6, 3: 0.1, 2: 0.0, 1: 1.2}
    ways = {0: (0.0, ())}
    for end in range(1, len(groups) + 1):
        choices = []
        for rank, k in enumerate((4, 3, 2, 1)):
            if k <= end:
                before, own = ways[end - k], groups[end - k : end]
                own_cost = cost[k] + (2.0 if own[0] == "000" or re.fullmatch("0[0-9]+", own[0]) else 0.0)
                for g in own[1:]:
                    own_cost += 4.0 if len(g) != 3 else 0.0
                total = before[0] + own_cost + (abs(len(before[1]) + 1 - n) * 0.15 if n > 0 else 0)
                choices.append((total, rank, before[1] + (" ".join(own),)))
        best = min(choices)
        ways[end] = (best[0], best[2])
    return list(ways[len(groups)][1])


@pytest.mark.parametrize("n", [0, 3])
def test_cheapest_cuts_are_those_of_the_plain_recurrence(spark, n):
    rng = random.Random(n)
    rows = [([("".join(rng.choice("0123456789") for _ in range(rng.choice([1, 2, 3, 3, 3])))) for _ in range(rng.randint(1, 40))],) for _ in range(400)]
    got = spark.createDataFrame(rows, "groups array<string>").select("groups", numbers._cheapest(F.col("groups"), n).alias("values")).collect()
    assert [r["values"] for r in got] == [_plain_cheapest(r.groups, n) for r in got]


def test_a_long_run_takes_linear_time(spark):
    def seconds(groups):
        line = " ".join(str(random.Random(i).randint(100, 999)) for i in range(groups))
        df = spark.createDataFrame([(line,)], "line string").select(F.size(numbers.numbers_in("line", 0)).alias("n"))
        began = time.perf_counter()
        assert df.first().n == groups // 2
        return time.perf_counter() - began

    seconds(10)
    least = min(seconds(10) for _ in range(2))  # planning
    assert seconds(20_000) - least < 5  # under a second alone; the square of it took minutes


def test_clean_lines_stay_beside_a_doubled_one_of_their_number(spark):
    rows = [("1", 5, "Kreditinstitut", "a", ["44 990 421", "5"]), ("1", 5, "Kreditinstitut", "b", ["4 990 421", "5"]), ("1", 5, "Kreditinstitut", "c", []), ("1", 5, "Kreditinstitut", "d", None), ("2", 5, "Kreditinstitut", "a", ["44 990 421", "5"])]
    got = facts.dedupe_value_variants(spark.createDataFrame(rows, "org string, line_idx int, key string, line string, values array<string>"))
    assert sorted((r.org, r.line) for r in got.collect()) == [("1", "b"), ("1", "c"), ("1", "d"), ("2", "a")]


def _best(names, registry):
    """The plain rule: the first of score 3 or more, else the highest, then the first."""
    tokens = lambda s: {t for t in (re.sub("[^0-9a-zåäö]", "", x) for x in s.lower().split()) if len(t) >= 3}
    ab = lambda s: "ab" in s.lower().split()
    out = {}
    for target, name in names:
        found = []
        for org, candidate, seq in registry:
            hits = len(tokens(name) & tokens(candidate))
            if hits:
                score = hits + (ab(name) and ab(candidate))
                found.append((-min(score, 3), seq, org, candidate, score))
        if found:
            _, _, org, candidate, score = min(found)
            out[target] = (org, candidate, score)
    return out


def test_names_with_hot_tokens(spark):
    rng = random.Random(6)
    words = ["sverige", "bygg", "nord", *[f"namn{i}" for i in range(30)]]
    name = lambda: " ".join(dict.fromkeys(rng.choice(words[: rng.choice([3, 33])]) for _ in range(rng.randint(1, 5)))) + rng.choice(["", " AB"])
    asked, known = [(i, name()) for i in range(150)], [(f"{i:010d}", name(), i) for i in range(400)]
    got = targets.resolve_by_name(spark.createDataFrame(asked, "target_id int, name string"), spark.createDataFrame(known, "org string, name string, seq int")).collect()
    assert {r.target_id: (r.org, r.candidate, r.score) for r in got} == _best(asked, known)


def test_every_name_with_two_hot_tokens(spark):
    n = 20_000  # all pairs of these would be 4e8
    both = spark.range(n).select(F.col("id").alias("target_id"), F.format_string("Sverige Bygg Nr%05d AB", F.col("id") % 7000).alias("name"))
    registry = spark.range(n).select(F.format_string("%010d", "id").alias("org"), F.format_string("Bygg Sverige Hus%05d AB", "id").alias("name"), F.col("id").alias("seq"))
    found = targets.resolve_by_name(both, registry)
    assert [tuple(r) for r in found.groupBy("org", "score").count().collect()] == [("0000000000", 3, n)]


def test_pages_by_index_are_those_of_the_list(spark, tmp_path):
    rows = [(f"{i:05d}", None if i % 11 == 0 else f"n{i * 37 % 50}", i) for i in range(530)]
    table = spark.createDataFrame(rows, "org_nr string, name string, other int").repartition(7)
    crm.write_pages(table, str(tmp_path), size=25)
    for page in (0, 1, 2, 3, 10, 20, 21, 22, 99):
        assert crm.read_page(spark, str(tmp_path), page, size=25).collect() == crm.page_leads(table, page, size=25).collect()
    empty = str(tmp_path / "none")
    crm.write_pages(table.limit(0), empty)
    assert crm.read_page(spark, empty, 0).collect() == [] == crm.read_page(spark, empty, 5).collect()
    plan = crm.read_page(spark, str(tmp_path), 20, size=25)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(name", plan) and re.search(r"PushedFilters: .*Or\(Or\(IsNull\(name\),Les", plan)  # the plan cuts the rest off


def test_a_page_of_names_reads_no_finance(spark, sf):
    plan = queries.QUERIES["leads_page"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_extendedprice" not in plan and "p_type" not in plan
    few = queries._leads(spark, sf, "org", "lender_keywords").schema.names
    assert few == ["org", "lender_keywords"]
    assert leads.select_leads(["org", "icp_score"], *[f(spark, sf) for f in (queries.a.obs, queries.a.finance, queries.a.obs_keywords)]).count() == queries.QUERIES["scored_leads"](spark, sf).count()


def test_search_by_index_is_the_scan(spark, tmp_path):
    rows = [(f"{i:03d}", ["Åkeri Öst", "AAAA aaa", "x", None, "Älvbygg AB", "\x01ab", "aaab"][i % 7], f"mail{i}@Bolag.se") for i in range(140)]
    table = spark.createDataFrame(rows, "org_nr string, name string, email string").repartition(5)
    search.write_search_index(table, str(tmp_path), ["name", "email"])
    for q in ("ÅKE", "aaaa", "aaab", "aaa", "lvbygg ab", "@bolag.se", "l13", "öst\x01mai", "zzz", "aa", "x", ""):
        found = search.find_leads(table, str(tmp_path), q, ["name", "email"])
        assert sorted(found.collect()) == sorted(crm.search_leads(table, q, ["name", "email"]).collect()), q
    plan = search.search_index(spark, str(tmp_path), "bolag")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[In\(gram", plan)


def test_thousands_of_words(spark):
    rng = random.Random(8)
    words = tuple(dict.fromkeys(["", "a", "ab", "abc", "bc", "Abc", "åÄ", *["".join(rng.choice("abcdå") for _ in range(rng.randint(1, 6))) for _ in range(6000)]]))
    texts = [(i, "".join(rng.choice("aBcdÅe \n") for _ in range(rng.randint(0, 60)))) for i in range(60)] + [(100, None), (101, "")]
    df = spark.createDataFrame(texts, "doc_id int, text string")
    got = {(r.doc_id, r.keyword) for r in lines.scan_keywords(df, words, "doc_id").collect()}
    assert got == {(i, w) for i, t in texts if t is not None for w in words if w.lower() in t.lower()}
    plan = lambda some: len(lines.scan_keywords(df, some, "doc_id")._jdf.queryExecution().analyzed().toString())
    assert abs(plan(words) - plan(words[:1000])) < 50
    each = lines.text_lines(df, "doc_id")
    many = [w for w in words if w][:65]
    assert len(many) > lines.MANY
    of_many = sorted(lines.matched_lines(each, tuple(many)).collect())
    few = [lines.matched_lines(each, tuple(many[i : i + 5]), total=10**6) for i in range(0, len(many), 5)]
    union = {tuple(r) for part in few for r in part.collect()}
    assert {tuple(r) for r in of_many} <= union and len(of_many) == sum(min(60, sum(u[0] == i for u in union)) for i in {u[0] for u in union})
