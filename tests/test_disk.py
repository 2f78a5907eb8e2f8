"""What a rescan leaves on disk while it runs."""

import re

from pyspark.sql import functions as F

from granary import queries
from granary.plans import adapters, jobs, storage


def test_a_rescan_shuffles_lines_once_and_releases_what_it_shuffled(spark, sf, monkeypatch):
    plans = []

    def kept(df, rows=None, release=False, keep=storage.keep):
        plans.append((release, df._jdf.queryExecution().optimizedPlan().toString()))
        return keep(df, rows, release)

    monkeypatch.setattr(queries, "keep", kept)
    monkeypatch.setattr(jobs, "keep", kept)
    done = queries.QUERIES["leads_after_rescan"](spark, sf)
    assert plans and all(release for release, _ in plans)
    read = [len(re.findall(r"Relation \[[^\]]*l_orderkey", plan)) for _, plan in plans]
    assert sum(read) == 2 and max(read) == 1  # for keywords and for tables; before, the leads of the table read both once more
    assert "l_orderkey" not in done._jdf.queryExecution().optimizedPlan().toString()


def test_keywords_are_dealt_out_by_their_orders(spark, sf):
    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as larger tables are joined
    words = adapters.obs_keywords(own, sf).groupBy("seq").agg(F.collect_set("keyword").alias("w"))
    dealt = re.findall(r"Exchange hashpartitioning\((\w+)", words._jdf.queryExecution().executedPlan().toString())
    assert sorted(dealt) == ["l_orderkey", "l_partkey", "o_orderkey", "p_partkey"]  # then by part, by keyword and by seq


def test_leads_of_records_are_those_of_the_tables(spark, sf):
    held = queries._observations(spark, sf).drop("org")
    words = adapters.obs_keywords(spark, sf).groupBy("seq").agg(F.collect_set("keyword").alias("lenderKeywords"))
    records = adapters.obs(spark, sf).join(held, "seq", "left").join(words, "seq", "left").withColumnsRenamed({"is_ab": "isAB", "reg_year": "regYear"}).withColumn("sniCode", F.lit(None).cast("string"))
    columns = ("org", "name", "lender_keywords", "icp_score", "revenue", "short_debt")
    got = queries._leads_of_records(records, *columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, queries._leads(spark, sf, *columns).collect()))
