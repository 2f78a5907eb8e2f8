"""Driver tables in the shape of observations. The SQL runs in DuckDB as it stands; Spark takes its parts in the order that moves least."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import facts

OBS = """
SELECT lpad(CAST(o.o_custkey AS STRING),10,'0') AS org, o.o_orderkey AS seq,
 CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE c.c_name END AS name,
 CASE WHEN o.o_orderkey % 3 = 0 THEN concat('info', CAST(o.o_orderkey AS STRING), '@bolag.example') ELSE NULL END AS email,
 CASE WHEN o.o_orderkey % 4 = 2 THEN concat('+46', lpad(CAST(o.o_orderkey AS STRING),9,'7')) ELSE NULL END AS phone,
 CASE WHEN o.o_orderkey % 4 = 0 THEN NULL ELSE CAST(1980 + o.o_custkey % 40 AS INT) END AS reg_year,
 CASE WHEN o.o_orderkey % 4 = 1 THEN NULL ELSE CAST(o.o_custkey % 13 AS INT) END AS employees,
 (o.o_custkey % 2 = 0) AS is_ab,
 CASE WHEN o.o_orderkey % 6 = 0 THEN NULL WHEN c.c_mktsegment='BUILDING' THEN 'Byggentreprenader'
  WHEN c.c_mktsegment='AUTOMOBILE' THEN 'Handel med fordon' WHEN c.c_mktsegment='MACHINERY' THEN 'Industri'
  WHEN c.c_mktsegment='FURNITURE' THEN 'Åkeri' ELSE 'Bemanning' END AS branch
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

OBS_TABLES = """
SELECT lpad(CAST(o.o_custkey AS STRING),10,'0') AS org, o.o_orderkey AS seq,
 CAST(row_number() OVER (PARTITION BY o.o_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice) AS INT) AS tbl_idx,
 CASE l.l_linenumber WHEN 1 THEN 'Nettoomsättning' WHEN 2 THEN 'Kortfristiga skulder' WHEN 3 THEN 'Långfristiga skulder'
  WHEN 4 THEN 'Rörelseresultat' WHEN 5 THEN 'Årets resultat' WHEN 6 THEN 'Summa tillgångar' ELSE 'Skulder och eget kapital' END AS raw_label,
 CAST(year(o.o_orderdate) AS INT) AS y1, CAST(year(o.o_orderdate) - 1 AS INT) AS y2,
 CASE WHEN l.l_linestatus='O' AND l.l_returnflag='N' THEN '-'
  ELSE concat(CAST(CAST(floor(l.l_extendedprice/1000) AS BIGINT) AS STRING),' ',
              lpad(CAST(CAST(floor(l.l_extendedprice) AS BIGINT) % 1000 AS STRING),3,'0')) END AS v1,
 concat('-', CAST(CAST(floor(l.l_extendedprice/7) AS BIGINT) AS STRING)) AS v2
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey
"""

OBS_KEYWORDS = """
SELECT DISTINCT lpad(CAST(o.o_custkey AS STRING),10,'0') AS org, o.o_orderkey AS seq,
 CASE p.p_type WHEN 'ECONOMY' THEN 'Kreditinstitut' WHEN 'LARGE' THEN 'Almi' WHEN 'PROMO' THEN 'Svea' ELSE 'OPR' END AS keyword
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN part p ON l.l_partkey=p.p_partkey WHERE p.p_size <= 10
"""

FINANCE_ROWS = """
SELECT org, seq, tbl_idx, raw_label, 0 AS pos, y1 AS year, v1 AS raw_value FROM obs_tables
UNION ALL SELECT org, seq, tbl_idx, raw_label, 1 AS pos, y2 AS year, v2 AS raw_value FROM obs_tables
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROWS_OF_A_TASK = 1 << 17  # of a shuffle of lines
PARTITIONS_UNHELD = 200  # up to which a task writes its rows as they come (Spark's bypassMergeThreshold); beyond, it holds them to sort them
# the most that a task reads: of files, and of a shuffle, whose rows take some 30 times their compressed size in memory
BYTES_OF_A_TASK = {"spark.sql.files.maxPartitionBytes": "16m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m"}
_UNITS = {"": 0, "b": 0, "k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30}


def _bytes(size: str) -> int | None:
    said = re.fullmatch(r"(\d+)([kmg]?b?)", size.lower())
    return int(said[1]) << _UNITS[said[2]] if said else None


def deal_out(spark: SparkSession, rows: int) -> None:
    """Lets shuffles of so many rows have as many partitions as they need, and its tasks read little, in this session.

    A task's share then does not grow with the tables; counts that are higher and sizes that are lower already stay.
    While tasks of up to twice the rows spare the tasks before them from holding what they read, a whole row group, they take those.
    """
    most = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = int(spark.conf.get(most, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-rows // ROWS_OF_A_TASK)
    if wanted <= 2 * PARTITIONS_UNHELD:
        wanted = min(wanted, PARTITIONS_UNHELD)
    if wanted > now:
        spark.conf.set(most, str(wanted))
    for name, size in BYTES_OF_A_TASK.items():
        held = _bytes(spark.conf.get(name))
        if held is not None and held > _bytes(size):
            spark.conf.set(name, size)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem, counted from the files' footers."""
    lines = table(spark, sf_dir, "lineitem")
    deal_out(spark, lines.count())
    return lines


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(OBS.replace("orders o", "{orders} o").replace("customer c", "{customer} c"), orders=table(spark, sf_dir, "orders"), customer=table(spark, sf_dir, "customer"))


# parts of OBS_TABLES: what numbers an order's lines, what a line is asked for besides numbers, and what is joined
_NUMBERED = "CAST(row_number() OVER (PARTITION BY o.o_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice) AS INT)"
_DASHED = "l.l_linestatus='O' AND l.l_returnflag='N'"
_JOINED = "lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey"


def obs_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OBS_TABLES, whose texts are made after lines were dealt out and numbered: what is shuffled are a line's numbers.

    As orders then keep their names behind that, what is gathered by `seq` needs no shuffle of its own.
    """
    of_line = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    lineitem = _lines(spark, sf_dir).selectExpr(*of_line, f"coalesce({_DASHED.replace('l.', '')}, false) AS dashed")
    rows = spark.sql(f"SELECT o.*, l.*, {_NUMBERED} AS tbl_idx FROM {_JOINED.replace('lineitem l', '{lineitem} l').replace('orders o', '{orders} o')}", lineitem=lineitem, orders=table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"))
    said = OBS_TABLES.replace(_NUMBERED, "t.tbl_idx").replace(_DASHED, "t.dashed").replace(_JOINED, "{rows} t")
    return spark.sql(re.sub(r"\b[lo]\.", "t.", said), rows=rows)


_OF_PARTS = "orders o ON l.l_orderkey=o.o_orderkey JOIN part p ON l.l_partkey=p.p_partkey"


def obs_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OBS_KEYWORDS, lines meeting their parts first: few are left, and behind the orders nothing is dealt out once more."""
    sql = OBS_KEYWORDS.replace(_OF_PARTS, "part p ON l.l_partkey=p.p_partkey JOIN orders o ON l.l_orderkey=o.o_orderkey")
    sql = sql.replace("lineitem l", "{lineitem} l").replace("orders o", "{orders} o").replace("part p", "{part} p")
    return spark.sql(sql, orders=table(spark, sf_dir, "orders"), lineitem=_lines(spark, sf_dir), part=table(spark, sf_dir, "part"))


def finance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FINANCE_ROWS in one pass over the tables."""
    pair = F.array(F.struct(F.col("y1").alias("year"), F.col("v1").alias("raw_value")), F.struct(F.col("y2").alias("year"), F.col("v2").alias("raw_value")))
    cells = obs_tables(spark, sf_dir).select("org", "seq", "tbl_idx", "raw_label", F.posexplode(pair).alias("pos", "c"))
    return cells.select("org", "seq", "tbl_idx", "raw_label", "pos", "c.year", "c.raw_value")


CELLS = [("y1", "v1"), ("y2", "v2")]


def newest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of FINANCE_ROWS that a fold can take."""
    return facts.newest_cells(obs_tables(spark, sf_dir), CELLS)
