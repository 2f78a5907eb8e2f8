"""The stream of observations: what a batch reads, late lines, and the log's files."""

import json

from granary.plans import jobs
from granary.sources import files
from granary.streaming.leads import read_leads, stream_leads


def _line(org, name, **more):
    return json.dumps({"org": f"{org:010d}", "name": name, "regYear": 2000, "employees": 3, "isAB": True, "lenderKeywords": ["Almi"], "tables": [{"years": [2023], "rawLabel": "Nettoomsättning", "values": ["5 000"]}]} | more)


COLUMNS = ["org", "name", "employees", "icp_score", "lender_keywords", "revenue"]


def _same_as_batch(spark, source, snapshot):
    streamed = read_leads(spark, snapshot).select(*COLUMNS).orderBy("org").collect()
    assert streamed == jobs.build_leads(files.read_observations(spark, source)[0]).select(*COLUMNS).orderBy("org").collect()
    return {r.org: r for r in streamed}


def test_a_batch_brings_up_only_the_orgs_it_touches(spark, tmp_path):
    source, snapshot = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    run = lambda: stream_leads(spark, str(source), snapshot, str(tmp_path / "cp"), publish=0)
    (source / "5.jsonl").write_text("\n".join([*[_line(k, f"N{k}") for k in range(300)], "{broken", json.dumps({"name": "no org"})]))
    run().awaitTermination()
    # earlier by name, so that its values come first though it comes late
    (source / "1.jsonl").write_text("\n".join(_line(k, f"Early{k}") for k in (7, 8, 9)))
    query = run()
    query.awaitTermination()
    assert spark.read.parquet(f"{snapshot}-changes").where("batch = 1").count() == 3
    # the store counts what it writes of an entry, some ten for one; of all 300 orgs that would be thousands
    assert sum(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["stateOperators"]) < 100
    leads = _same_as_batch(spark, str(source), snapshot)
    assert len(leads) == 300 and leads["0000000007"].name == "Early7" and leads["0000000010"].name == "N10"


def test_the_log_does_not_grow_with_the_batches(spark, tmp_path):
    source, snapshot = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(7):
        (source / f"{i:02d}.jsonl").write_text("\n".join(_line(k, f"N{i}") for k in (i % 5, 50)))
    stream_leads(spark, str(source), snapshot, str(tmp_path / "cp"), publish=3, merge=2, files_a_batch=1).awaitTermination()
    batches = sorted(int(p.name.split("=")[1]) for p in (tmp_path / "out-changes").glob("slot=*/batch=*"))
    assert max(batches) == 6 and len(batches) <= 2 * 2
    assert len(_same_as_batch(spark, str(source), snapshot)) == 6
    assert spark.read.parquet(snapshot).count() == 6
