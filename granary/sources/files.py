"""Files in and out: target lists, observations, report files, lead sheets and reports."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_org, to_number
from ..plans.storage import running_total

OBSERVATION = (
    "org string, name string, email string, phone string, regYear int, employees int, isAB boolean, branch string, sniCode string, lenderKeywords array<string>, "
    "lenderKeywordLines array<variant>, lenderKeywordsSource string, kreditinstitutSkulderLines array<variant>, loanLines array<variant>, "
    "tables array<struct<years:array<int>,rawLabel:string,values:array<string>>>, _corrupt_record string"
)
ALIASES = {"org": ("orgnr", "org"), "name": ("name", "company", "ab"), "url": ("url",), "email": ("email",)}


def _is_header(line: str) -> bool:
    words = [w.strip().strip('"').lower() for w in line.split(",")]
    return "orgnr" in words or ("name" in words and "," in line)


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """(org, name, url, email, seq) of a target list, with or without a header; rows with neither org nor name go."""
    first = spark.read.text(path).where("trim(value) != ''").limit(1).collect()
    header = bool(first) and _is_header(first[0][0].lstrip("﻿"))
    reader = spark.read.option("header", header).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    df = reader.csv(path) if header else reader.schema("url string, name string, orgnr string, email string").csv(path)
    names = {c.lstrip("﻿").strip().lower(): c for c in df.columns}
    pick = lambda keys: F.coalesce(*[F.nullif(F.trim(F.col(f"`{names[k]}`")), F.lit("")) for k in keys if k in names], F.lit(None).cast("string"))
    out = df.select(*[(normalize_org(pick(keys)) if name == "org" else pick(keys)).alias(name) for name, keys in ALIASES.items()], F.monotonically_increasing_id().alias("seq"))
    return out.where("org is not null or name is not null")


def validate_targets(spark: SparkSession, path: str, observations: str | None = None) -> DataFrame:
    """(check, ok, detail) of a target list, and of the observations that offline work needs."""
    first = [r[0] for r in spark.read.text(path).where("trim(value) != ''").limit(1).collect()]
    rows = [("not_empty", bool(first), path)]
    words = [w.strip().strip('"').lower() for w in first[0].lstrip("﻿").split(",")] if first else []
    if any(w in ("orgnr", "org", "name", "company") for w in words) and not any(w.startswith("http") for w in words):
        rows.append(("org_column", bool({"orgnr", "org"} & set(words)), ",".join(words)))
        rows.append(("name_column", bool({"name", "company", "ab"} & set(words)), ",".join(words)))
    elif first:
        rows.append(("at_least_3_fields", len(words) >= 3, str(len(words))))
    if observations is not None:
        rows.append(("observations", not spark.read.text(observations).where("trim(value) != ''").isEmpty(), observations))
    return spark.createDataFrame(rows, "check string, ok boolean, detail string")


PLACE = ("_metadata.file_path", "_metadata.file_block_start")
SMALL_BLOCKS = 1 << 16  # blocks of files, a row of some hundred bytes each, that are broadcast; more are joined


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, seq) of all lines of text files: seq counts them from 0, by file path and place in the file.

    The number does not hang on how files are cut into blocks. Lines are counted block by block in a first pass, which
    makes a row a block; sums over the blocks in order are carried on to each, and a line adds its place in its block. A
    file changed, added or cut another way between the passes fails the job; no line gets a number that is not its own.
    """
    lines = spark.read.text(path).select("value", *PLACE).withColumn("_id", F.monotonically_increasing_id())
    counted = lines.groupBy("file_path", "file_block_start").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    blocks = running_total(counted, "_before", "_n", F.col("file_path"), F.col("file_block_start"))
    blocks = F.broadcast(blocks) if blocks.count() <= SMALL_BLOCKS else blocks
    at = F.col("_id") - F.col("_first")
    seq = F.when((at >= 0) & (at < F.col("_n")), F.col("_before") + at)
    placed = lines.join(blocks, ["file_path", "file_block_start"], "left")
    return placed.select("value", F.coalesce(seq, F.raise_error(F.lit("files were changed or are cut another way than when their lines were counted"))).alias("seq"))


def read_observations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(observations with `seq`, the number of their line, (seq, malformed line)); blank lines have a number and no row."""
    lines = numbered_lines(spark, path).where("trim(value) != ''")
    raw = lines.select(F.from_json("value", OBSERVATION).alias("o"), "seq").select("o.*", "seq")
    sound = raw.where("_corrupt_record is null and coalesce(org, '') != ''").drop("_corrupt_record")
    return sound, raw.where("_corrupt_record is not null").select("seq", "_corrupt_record")


def matched_items(observations: DataFrame, column: str) -> DataFrame:
    """(org, seq, pos, line_idx, idx, key, line, values, source) of a column whose items are bare strings or objects.

    idx is the line number that the item itself has; line_idx is it or else the item's place.
    """
    items = observations.select("org", "seq", F.posexplode(column).alias("pos", "v"))
    text = F.try_variant_get("v", "$", "string")
    bare = F.schema_of_variant("v") == "STRING"
    field = lambda name, kind="string": F.try_variant_get("v", f"$.{name}", kind)
    idx = F.when(~bare, field("lineIndex", "int"))
    return items.select(
        "org", "seq", "pos", F.coalesce(idx, F.col("pos") + 1).alias("line_idx"), idx.alias("idx"),
        F.when(bare, "Unknown").otherwise(F.coalesce(field("key"), field("keyword"), F.lit(""))).alias("key"),
        F.when(bare, text).otherwise(F.coalesce(field("line"), F.lit(""))).alias("line"),
        F.when(~bare, field("values", "array<string>")).alias("values"), F.when(~bare, field("source")).alias("source"))


def append_observations(observations: DataFrame, path: str) -> None:
    observations.write.mode("append").json(path)


HEAD_BYTES = 8  # in which a report file says what it is


def read_head(path: str, opened: Callable[[str], tuple[FileSystem, str]] | None = None) -> bytes:
    """The first bytes of a file by its Spark path; no more are asked of the file system."""
    system, name = (opened or _file_system)(path)
    with system.open_input_file(name) as stream:
        return stream.read_at(HEAD_BYTES, 0)


def _file_system(path: str) -> tuple[FileSystem, str]:
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return LocalFileSystem(), "/" + rest.lstrip("/")
    return FileSystem.from_uri(quote(path, safe=":/@"))


def intake_report_files(spark: SparkSession, folder: str, most_bytes: int = 25_000_000) -> DataFrame:
    """(org, path, length, ok, reason) of `<org>_*.pdf` files; empty files have no row, as the source skips them.

    Files are listed with their lengths alone. Of those that have an org and are not too large, eight bytes are read, by
    the executors through their own file system (local, HDFS, S3 and what else Arrow opens by its address). A file
    that is gone by then fails its task.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", True).load(folder)
    org = F.nullif(F.regexp_extract("path", "/([0-9]{10})_[^/]*$", 1), F.lit(""))
    reason = F.when(F.nullif(org, F.lit("")).isNull(), "no org").when(F.col("length") > most_bytes, "too large")

    def looked_at(batches):
        for batch in batches:
            orgs, paths, lengths, reasons = (c.to_pylist() for c in batch.columns)
            reasons = [r or (None if b"%PDF-" in read_head(p) else "not a pdf") for p, r in zip(paths, reasons)]
            yield pa.RecordBatch.from_arrays([pa.array(orgs, pa.string()), pa.array(paths, pa.string()), pa.array(lengths, pa.int64()), pa.array([r is None for r in reasons]), pa.array(reasons, pa.string())], names=["org", "path", "length", "ok", "reason"])

    return files.select(org.alias("org"), "path", "length", reason.alias("reason")).mapInArrow(looked_at, "org string, path string, length long, ok boolean, reason string")


def read_leads_sheet(spark: SparkSession, path: str, columns: list[str], numeric: tuple[str, ...] = ()) -> DataFrame:
    """A lead sheet whose titles may repeat: columns are taken by place and named anew; blanks are null."""
    raw = spark.read.option("header", True).csv(path)
    named = raw.toDF(*columns[: len(raw.columns)], *[f"_extra{i}" for i in range(len(raw.columns) - len(columns))])
    clean = [(to_number(F.col(c)) if c in numeric else F.nullif(F.trim(F.col(c)), F.lit(""))).alias(c) for c in named.columns if not c.startswith("_extra")]
    return named.select(*clean, F.monotonically_increasing_id().alias("seq"))


def write_sheet(df: DataFrame, path: str, titles: tuple[str, ...] | None = None, quote_all: bool = False) -> None:
    """CSV with a header whose titles may repeat; nulls are empty."""
    df = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
    (df.toDF(*titles) if titles else df).write.mode("overwrite").option("header", True).option("quoteAll", quote_all).option("emptyValue", "").csv(path)


def publish_copies(df: DataFrame, paths: list[str], titles: tuple[str, ...] | None = None) -> None:
    """One computation, several sheets."""
    kept = df.persist()
    try:
        for path in paths:
            write_sheet(kept, path, titles)
    finally:
        kept.unpersist()
