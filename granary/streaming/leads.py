"""Leads kept up to date from an append-only stream of observations.

An early observation may come late and change which value is first, so an org's leads follow from all of its
observations. These are keyed state: a state store holds each org's lines, a batch brings up those of the orgs that it
touches and no others, and their leads are made anew. What a batch makes goes to a log of changes. Every MERGE batches
the log is folded into one row an org, in the other of two slots, which takes the place of what was folded before; so the
number of its files does not grow with the batches. read_leads() gives the last row of each org from both slots at any
time, also while a slot is being written. A plain table of the leads is published every `publish` batches.

A batch that is run again after a failure replaces its own part of the log. The result is that of the batch job over the
same files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..config import RULES, Rules
from ..operators.fold import merge_states
from ..plans.jobs import build_leads, fold_observations, score_states
from ..sources.files import OBSERVATION, PLACE

MERGE = 16  # batches to a slot of the log
LINE = "line string, file_path string, file_block_start long, id long"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class OrgLines(StatefulProcessor):
    """Adds an org's new lines to those it has and gives all of them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.lines = handle.getListState("lines", LINE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = list(self.lines.get()) if self.lines.exists() else []
        new = [tuple(r) for part in rows for r in part[["line", "file_path", "file_block_start", "id"]].itertuples(index=False)]
        self.lines.appendList(new)
        everything = pd.DataFrame([tuple(x) for x in kept] + new, columns=["line", "file_path", "file_block_start", "id"])
        everything.insert(0, "org", key[0])
        yield everything

    def close(self) -> None:
        pass


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their place in the task, which is theirs in a block of a file, as the file has them."""
    at = 0
    for batch in batches:
        yield batch.append_column("id", pa.array(range(at, at + batch.num_rows), pa.int64()))
        at += batch.num_rows


def new_lines(spark: SparkSession, source: str, files_a_batch: int | None = None) -> DataFrame:
    """A stream of (org, line, file_path, file_block_start, id)."""
    reader = spark.readStream.format("text")
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.load(source).select(F.get_json_object("value", "$.org").alias("org"), F.col("value").alias("line"), *PLACE).mapInArrow(_numbered, f"org string, {LINE}")


def lines_of_touched(spark: SparkSession, source: str, files_a_batch: int | None = None) -> DataFrame:
    """A stream of (org, line, file_path, file_block_start, id): with a new line of an org come all of its lines."""
    lines = new_lines(spark, source, files_a_batch)
    return lines.where("coalesce(org, '') != ''").groupBy("org").transformWithStateInPandas(OrgLines(), f"org string, {LINE}", "Update", "None")


def observations_of(lines: DataFrame) -> DataFrame:
    """Lines as read_observations() gives them."""
    parsed = lines.select(F.from_json("line", OBSERVATION).alias("o"), F.struct("file_path", "file_block_start", F.col("id").alias("_id")).alias("seq"))
    sound = parsed.where("o is not null and o._corrupt_record is null and coalesce(o.org, '') != ''")
    return sound.select("o.*", "seq").drop("_corrupt_record")


def _last(changes: DataFrame) -> DataFrame:
    columns = [c for c in changes.columns if c not in ("org", "slot", "batch")]
    return changes.groupBy("org").agg(F.max_by(F.struct(*columns), "batch").alias("_")).select("org", "_.*")


def read_leads(spark: SparkSession, snapshot: str) -> DataFrame:
    """The leads of all batches so far, one row an org, from the log beside `snapshot`."""
    return _last(spark.read.parquet(f"{snapshot.rstrip('/')}-changes"))


def _log(log: str, fresh: DataFrame, number: int, merge: int, folded: Callable[[DataFrame], DataFrame]) -> None:
    """Writes what a batch makes (with its number as `batch`); every `merge` batches all so far go to the other slot, folded."""
    slot = f"{log}/slot={number // merge % 2}"
    if number % merge:
        fresh.drop("batch").write.mode("overwrite").parquet(f"{slot}/batch={number}")
        return
    if number:  # the other slot holds all orgs up to here
        before = fresh.sparkSession.read.parquet(f"{log}/slot={1 - number // merge % 2}").where(F.col("batch") < number)
        fresh = folded(before.unionByName(fresh)).withColumn("batch", F.lit(number).cast("long"))
    fresh.write.mode("overwrite").partitionBy("batch").parquet(slot)


def stream_leads(spark: SparkSession, source: str, snapshot: str, checkpoint: str, rules: Rules = RULES, publish: int = 1, merge: int = MERGE, files_a_batch: int | None = None) -> StreamingQuery:
    """Reads what is new under `source`, once; its leads are in read_leads() and, every `publish` batches (0: never), in the Parquet table `snapshot`."""
    log = f"{snapshot.rstrip('/')}-changes"

    def refresh(batch: DataFrame, number: int) -> None:
        fresh = build_leads(observations_of(batch), rules).drop("first_seq").withColumn("batch", F.lit(number).cast("long"))
        _log(log, fresh, number, merge, _last)
        if publish and number % publish == 0:
            read_leads(spark, snapshot).write.mode("overwrite").parquet(snapshot)

    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)  # what keyed state needs; the query keeps it
    try:
        return lines_of_touched(spark, source, files_a_batch).writeStream.outputMode("update").foreachBatch(refresh).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_STORE, before)


def _states(log: DataFrame) -> DataFrame:
    return merge_states(log.drop("slot", "batch"))


def read_scores(spark: SparkSession, states: str, rules: Rules = RULES) -> DataFrame:
    """The scored leads of all batches of stream_states() so far, without the columns that lines give."""
    return score_states(_states(spark.read.parquet(states)), rules)


def stream_states(spark: SparkSession, source: str, states: str, checkpoint: str, rules: Rules = RULES, merge: int = MERGE, files_a_batch: int | None = None) -> StreamingQuery:
    """Reads what is new under `source`, once, and adds its fold to the table of states; read_scores() gives the leads.

    States of parts merge (operators.fold), so a batch reads its own lines only, whatever the orgs it touches have said
    before, and needs no state store: an org with a third of all lines costs no more than what is new of it. The result is
    that of build_leads() over the same files. Leads with the columns of matched lines are stream_leads()'s: their
    numbers depend on the org's final debts and so on all of its lines.
    """

    def add(batch: DataFrame, number: int) -> None:
        own = batch.persist()  # its observations, tables and keywords are folded as three inputs, read once
        try:
            fresh = fold_observations(observations_of(own), rules).withColumn("batch", F.lit(number).cast("long"))
            _log(states, fresh, number, merge, _states)
        finally:
            own.unpersist()

    return new_lines(spark, source, files_a_batch).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
