"""Tables kept in the folder that driver and executors share, and ranks over all rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


ROWS_OF_A_TASK = 1 << 18  # of tables whose rows are a few numbers


def new_path(spark: SparkSession) -> str:
    """A path of its own below ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="granary-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/granary-{uuid.uuid4().hex}"


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # shuffle files go when the query that made them ends


def keep(df: DataFrame, rows: int | None = None, release: bool = False) -> DataFrame:
    """Write a table below ``spark.checkpoint.dir`` (a temporary folder where none is set, in local tests) and read it.

    With `release`, what was shuffled for it leaves the disk with the write, not when the driver happens to collect its
    garbage; nothing but the table is read again.
    `rows` is what is known of the number of rows of a table of ids and keys: its last stage, behind a shuffle, then has a
    task for each million of them, which grows with the table and needs no shuffle of its own.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_OF_A_TASK)))
    path = new_path(spark)
    before = spark.conf.get(_RELEASE, None)
    if release:
        spark.conf.set(_RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        if release:
            spark.conf.set(_RELEASE, before) if before is not None else spark.conf.unset(_RELEASE)
    return spark.read.schema(df.schema).parquet(path)


def global_rank(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Adds a rank from 1 by a range-partitioned sort; one count a partition reaches the driver."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = keep(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    before, total = [], 0
    for row in sorted(parts.groupBy("_part").count().collect()):
        before += [F.lit(row["_part"]), F.lit(total)]
        total += row["count"]
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    rank = within + F.create_map(*before)[F.col("_part")] if before else within
    return parts.withColumn(name, rank.cast("long")).drop("_part")


def running_total(df: DataFrame, name: str, amount: str, *order: Column) -> DataFrame:
    """Adds the sum of `amount` over all rows before a row, by a range-partitioned sort; one sum a partition reaches the driver."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = keep(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    before, total = [], 0
    for row in sorted(parts.groupBy("_part").agg(F.sum(amount).alias("s")).collect()):
        before += [F.lit(row["_part"]), F.lit(total)]
        total += row["s"]
    own = F.sum(amount).over(Window.partitionBy("_part").orderBy(*order)) - F.col(amount)
    within = own + F.create_map(*before)[F.col("_part")] if before else own
    return parts.withColumn(name, within.cast("long")).drop("_part")
