"""States of parts against the fold of the whole."""

import json
import random

from granary.operators import fold, leads
from granary.plans import jobs
from granary.plans.storage import keep
from granary.sources import files
from granary.streaming.leads import read_scores, stream_states

OBS = "org string, seq long, name string, email string, phone string, is_ab boolean, reg_year int, employees int, branch string, sni_code string"
FINANCE = "org string, seq long, tbl_idx int, raw_label string, pos int, year int, raw_value string"


def _inputs(spark, seed=1):
    r = random.Random(seed)
    pick = lambda *v: r.choice([None, "", *v])
    org = lambda: None if r.random() < 0.02 else f"{min(r.randrange(24), 12):010d}"  # noqa: E731  half of all rows are of one org
    obs = [(org(), s, pick("Unknown", f"N{s}"), pick(f"e{s}"), pick("+46"), r.choice([None, True, False]), r.choice([None, 0, 1990, 2020]), r.choice([None, 0, 3]), pick("Handel", "Vård"), pick("41200")) for s in range(300)]
    labels = ("Nettoomsättning", "Rörelseresultat", "Kortfristiga skulder", "Annat")
    finance = [(org(), r.randrange(300), r.randrange(3), r.choice(labels), r.randrange(2), 2020 + r.randrange(3), r.choice(["1 000", "-", "abc", "5000"])) for _ in range(500)]
    words = [(org(), r.randrange(300), r.choice(["Almi", "Svea", "OPR", None])) for _ in range(80)]
    frames = [spark.createDataFrame(rows, schema) for rows, schema in ((obs, OBS), (list({x[:3] + x[4:5]: x for x in finance}.values()), FINANCE), (words, "org string, seq long, keyword string"))]
    return [keep(f) for f in frames], spark.createDataFrame([(f"{k:010d}", "Collector") for k in range(0, 20, 2)], "org string, keyword string")


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_parts_merge_to_the_whole(spark):
    inputs, scanned = _inputs(spark)
    whole = leads.merge_observations(*inputs, scanned=scanned)
    part = lambda lo, hi: fold.fold_states(*[f.where(f"seq >= {lo} and seq < {hi}") for f in inputs])
    late, middle, early = part(200, 300), part(90, 200), part(0, 90)
    scans = fold.fold_states(inputs[0].limit(0), scanned=scanned)  # a part without finance or keywords
    in_turn = late
    for more in (scans, middle, early, middle):  # a part that comes twice changes nothing
        in_turn = keep(fold.merge_states(in_turn, more))
    assert in_turn.count() > whole.count() > 5  # an org that only files or tables name has a state and no lead
    assert _rows(fold.leads_of_states(in_turn)) == _rows(whole) == _rows(fold.leads_of_states(fold.merge_states(early, late, scans, middle)))


def test_empty_parts_and_one_org(spark):
    inputs, _ = _inputs(spark, 2)
    nothing = fold.fold_states(*[f.limit(0) for f in inputs])
    assert fold.leads_of_states(nothing).collect() == [] == fold.merge_states(nothing, nothing).collect()
    whole = fold.fold_states(*inputs)
    assert _rows(fold.leads_of_states(fold.merge_states(nothing, whole))) == _rows(leads.merge_observations(*inputs))
    bare = fold.fold_states(inputs[0])
    assert "lender_keywords" not in fold.leads_of_states(bare).columns and fold.leads_of_states(bare).where("name is null").isEmpty()


def test_leads_without_fields_fold_first_observations(spark):
    (obs, finance, words), scanned = _inputs(spark, 3)
    whole = leads.merge_observations(obs, finance, words, scanned=scanned)
    for columns in (["org", "first_seq", "is_ab"], ["org", "revenue", "revenue_year", "short_debt"], ["org", "is_ab", "lender_keywords"], ["first_seq", "net_result", "lender_keywords"], ["org", "company_age"]):
        assert _rows(leads.select_leads(columns, obs, finance, words, scanned=scanned)) == _rows(whole.select(*columns)), columns
    assert leads.first_observations(obs.limit(0)).isEmpty()


def _line(org, name, **more):
    return json.dumps({"org": f"{org:010d}", "name": name, "regYear": 2000, "employees": None, "isAB": True, "lenderKeywords": ["Almi"], "tables": [{"years": [2023], "rawLabel": "Nettoomsättning", "values": ["5 000"]}]} | more)


COLUMNS = ["org", "name", "employees", "icp_score", "icp_reasons", "lender_keywords", "revenue", "revenue_year"]


def test_streamed_states_are_the_batch_and_read_new_lines_only(spark, tmp_path):
    source, states = tmp_path / "in", str(tmp_path / "states")
    source.mkdir()
    run = lambda: stream_states(spark, str(source), states, str(tmp_path / "cp"), merge=2, files_a_batch=1)
    for i in range(9, 4, -1):  # later files are earlier by name
        (source / f"{i}.jsonl").write_text("\n".join([*[_line(k, f"N{i}" if (k + i) % 3 else "Unknown", employees=i if k % 2 else None, lenderKeywords=[f"W{i}"]) for k in (0, 0, 0, *range(i))], "{broken", json.dumps({"name": "no org"})]))
        query = run()
        query.awaitTermination()
        assert sum(p["numInputRows"] for p in query.recentProgress) == 3 + i + 2 and not any(p["stateOperators"] for p in query.recentProgress)
        batch = jobs.build_leads(files.read_observations(spark, str(source))[0]).select(*COLUMNS)
        assert _rows(read_scores(spark, states).select(*COLUMNS)) == _rows(batch)
    batches = list((tmp_path / "states").glob("slot=*/batch=*"))
    assert len(batches) <= 2 * 2
    assert {r.org: r.name for r in batch.collect()}["0000000000"] == "N5"
