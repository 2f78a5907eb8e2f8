"""Orders with many more lines than those of the given tables, as larger tables have them, against the SQL."""

import datetime
import os
import random

import duckdb
import pytest

from granary.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def long_orders(spark, sf, tmp_path_factory):
    """The given tables with lines of one to 90 an order."""
    path, rng = tmp_path_factory.mktemp("long"), random.Random(5)
    for name in os.listdir(sf):
        if name not in ("orders.parquet", "lineitem.parquet"):
            os.symlink(f"{sf}/{name}", path / name)
    con = duckdb.connect()
    con.execute(f"CREATE TABLE orders AS SELECT * FROM '{sf}/orders.parquet' WHERE o_orderkey < 6")
    con.execute(f"CREATE TABLE lineitem AS SELECT * FROM '{sf}/lineitem.parquet' LIMIT 0")
    for key, n in enumerate((90, 40, 12, 11, 10, 1)):
        for _ in range(n):
            row = {"l_orderkey": key, "l_partkey": rng.randint(0, 99), "l_suppkey": 1, "l_linenumber": rng.randint(1, 7), "l_extendedprice": rng.uniform(901, 104999), "l_returnflag": rng.choice("NRA"), "l_linestatus": rng.choice("OF"), "l_shipdate": datetime.datetime(1995, 1, 1)}
            con.execute(f"INSERT INTO lineitem ({', '.join(row)}) VALUES ({', '.join('?' * len(row))})", list(row.values()))
    for name in ("orders", "lineitem"):
        con.execute(f"COPY {name} TO '{path}/{name}.parquet'")
    return str(path)


@pytest.mark.parametrize("name", ["token_lines", "observation_records_of_pages"])
def test_every_line_of_long_reports(spark, long_orders, name):
    con = duckdb.connect()
    for file in os.listdir(long_orders):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{long_orders}/{file}'")
    df = QUERIES[name](spark, long_orders)
    columns = sorted(df.columns)
    got = sorted(tuple(r) for r in df.select(*columns).collect())
    assert got == sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall())


def test_pages_with_the_same_marks_are_read_once(spark, monkeypatch):
    from granary.operators import extract, pages

    shape = '<table data-test="finance-table"><tr><th class="text-right">2020<th class="text-right">2019<tr><td class="title">{0}<td class="text-right">{1}<td class="text-right">&minus;{1}</table>'
    read, plain = [], pages._read
    monkeypatch.setattr(pages, "_known", pages.lru_cache(pages._read))
    monkeypatch.setattr(pages, "_structure", pages.lru_cache(lambda marks: read.append(len(marks)) or pages.Structure(marks)))
    for i in range(50):
        assert [(r[2], r[4]) for r in pages.Scan(shape.format(f"r{i}", i)).records()[0][3]][1] == (f"r{i}", [str(i), f"−{i}"])
    assert len(read) == 1 and pages._read is plain
    df = spark.createDataFrame([(i, shape.format(f"r{i}", i)) for i in range(700)] + [(700, "<table><tr><td>1</table>"), (701, None)], "id int, html string")
    found = extract.finance_tables(df, "id")
    assert sorted((r.id, r.tables[0].rawLabel, r.tables[0]["years"]) for r in found.collect()) == [(i, f"r{i}", [2020, 2019]) for i in range(700)]
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()  # a page needs no other


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_listed_cuts_are_the_shortest_ways(spark, n):
    from itertools import product

    from pyspark.sql import functions as F

    from granary.operators import numbers

    runs = [(list(g),) for size in (1, 2, 3, 4, 5) for g in product(("12", "345", "007", "000", "04")[: 5 if size < 5 else 4], repeat=size)]
    df = spark.createDataFrame(runs, "groups array<string>")
    got = df.select(numbers._cheapest(F.col("groups"), n).alias("a"), numbers._shortest_way(F.col("groups"), n).alias("b"))
    assert got.where("a <=> b").count() == len(runs)


def test_a_stored_item_is_read_once(spark):
    from granary.operators import lines

    held = spark.sql("SELECT array(to_variant_object(named_struct('key', 'Kreditinstitut', 'line', 'Lån 4 990 429 295 000', 'page', 'p1')), to_variant_object(named_struct('note', 'x'))) AS loanLines")
    new, _ = lines.backfill_matched_lines(held)
    assert new.selectExpr("to_json(loanLines) AS j").first().j == '[{"key":"Kreditinstitut","line":"Lån","page":"p1","values":["4 990 429","295 000"]},{"note":"x"}]'
    assert new._jdf.queryExecution().analyzed().toString().count("try_variant_get") < 10  # it was read anew for each use before


def test_shuffles_of_larger_tables_have_more_tasks(spark, sf):
    from granary.plans import adapters

    own, most, size = spark.newSession(), "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    adapters.obs_tables(own, sf)
    before = own.conf.get(most, None)
    assert own.conf.get(size) == "4m"
    adapters.deal_out(own, 216_000_000)
    assert int(own.conf.get(most)) == 1648 and before != "1648"
    own.conf.set(size, "64k")
    adapters.deal_out(own, 1)
    assert (own.conf.get(size), own.conf.get(most)) == ("64k", "1648")


def test_map_tasks_hold_no_rows_while_shuffles_are_small(spark):
    from granary.plans import adapters

    most = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    for rows, partitions in ((1 << 24, 128), (36_000_000, 200), (400 << 17, 200), ((400 << 17) + 1, 401)):
        own = spark.newSession()
        adapters.deal_out(own, rows)
        assert int(own.conf.get(most)) == partitions
