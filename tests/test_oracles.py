"""Every query against its DuckDB SQL on the driver's tables."""

import duckdb
import pytest

from granary.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _rows(rows):
    return sorted(tuple(f"{x:.6g}" if isinstance(x, float) else repr(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*columns).collect()]
    assert rows
    if name in ORACLES:
        assert _rows(rows) == _rows(duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_roles_cover_all_rows(spark, sf, duck):
    from granary import queries as q

    orders = duck.sql("SELECT count(*), count(DISTINCT o_custkey) FROM orders").fetchall()[0]
    assert q._old_leads(spark, sf, "true").count() == orders[1] == QUERIES["leads_stamped_all"](spark, sf).count() == QUERIES["leads_patch_all"](spark, sf).count()
    assert q._patches(spark, sf, "true").count() == orders[0]
    assert {r.org_nr for r in QUERIES["leads_upsert_all"](spark, sf).collect()} == {r.org for r in q.a.obs(spark, sf).select("org").distinct().collect()}
    assert [r.status for r in QUERIES["leads_patch_status_all"](spark, sf).collect()] == ["ok"] * orders[1] and QUERIES["lead_counts_all"](spark, sf).first().total == orders[1]
    latest = duck.sql("SELECT lpad(CAST(o_custkey AS STRING), 10, '0'), arg_max(o_orderkey % 3, o_orderkey) FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1").fetchall()
    assert any(rest == 2 for _, rest in latest)
    # two sides of n and m lines blend to max(n, m): no matched line is in neither
    matched = q._matched(spark, sf).selectExpr("doc_id", "keyword", "line_idx % 2 AS side").groupBy("doc_id", "keyword").pivot("side", [0, 1]).count().fillna(0)
    assert QUERIES["blended_lines_all"](spark, sf).count() == matched.selectExpr("sum(greatest(`0`, `1`)) AS n").first().n
