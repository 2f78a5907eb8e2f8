"""The leads table: upserts, patches, stamps, search and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import format_debt, format_revenue, icp_badge, shorten_debt_label
from ..plans.storage import global_rank, keep

OWN = ("resolved", "resolved_at", "notes", "created_at")  # what people entered stays when a file is imported


def evolve_schema(leads: DataFrame, like: DataFrame) -> DataFrame:
    """leads with the columns of `like` that it lacks, as null."""
    return leads.unionByName(like.limit(0), allowMissingColumns=True)


def defaults(now: Column) -> dict[str, Column]:
    """What the table gives a new row by itself."""
    return {"resolved": F.lit(False), "created_at": now, "updated_at": now}


def upsert_leads(existing: DataFrame, incoming: DataFrame, key: str = "org_nr", seq: str = "seq", preserve: tuple[str, ...] = OWN, new_rows: dict[str, Column] | None = None) -> DataFrame:
    """existing with incoming's columns laid over it, nulls too; of a key's incoming rows the last by `seq` counts.

    Columns in `preserve` and columns that incoming lacks stay; rows without a key go. Keys that were not there get
    `new_rows` in those of its columns that the table has. Applying it again changes nothing.
    """
    data = [c for c in incoming.columns if c not in (key, seq, *preserve)]
    last = incoming.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(F.max_by(F.struct(*data), seq).alias("_in"))
    joined = existing.withColumn("_there", F.lit(True)).join(last, key, "full")
    new = F.col("_in").isNotNull()
    columns = [F.when(new, F.col("_in")[c]).otherwise(F.col(c) if c in existing.columns else F.lit(None)).alias(c) for c in data]
    fresh = lambda c: F.when(F.col("_there").isNull(), new_rows[c]).otherwise(F.col(c)).alias(c)
    kept = [fresh(c) if new_rows and c in new_rows else F.col(c) for c in existing.columns if c not in data and c != key]
    return joined.select(key, *columns, *kept)


def patch_leads(existing: DataFrame, patches: DataFrame, allowed: tuple[str, ...], key: str = "org_nr", seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(existing with patches applied, status of each patched key: ok, not_found or nothing_to_do).

    patches: key, seq, column, value (string). For each column the last patch counts and may set a null; columns
    that are not allowed are ignored.
    """
    columns = [c for c in allowed if c in existing.columns]
    sound = patches.where(F.col("column").isin(*columns))
    last = sound.groupBy(key).agg(*[F.max_by(F.struct("value"), F.when(F.col("column") == c, F.col(seq))).alias(f"_{c}") for c in columns])
    joined = existing.join(last, key, "left")
    kinds = dict(existing.dtypes)
    out = joined.select(*[F.when(F.col(f"_{c}").isNotNull(), F.col(f"_{c}")["value"].try_cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in existing.columns])
    asked = patches.groupBy(key).agg(F.bool_or(F.col("column").isin(*columns)).alias("valid"))
    there = existing.select(key, F.lit(True).alias("there"))
    status = F.when(~F.col("valid"), "nothing_to_do").when(F.col("there").isNull(), "not_found").otherwise("ok")
    return out, asked.join(there, key, "left").select(key, status.alias("status"))


def stamp_changes(new: DataFrame, old: DataFrame, now: Column, key: str = "org_nr") -> DataFrame:
    """updated_at of rows that differ from before, resolved_at where `resolved` turned: now, or null when it went back."""
    compared = [c for c in new.columns if c in old.columns and c not in (key, "updated_at", "resolved_at")]
    before = old.select(key, F.struct(*compared).alias("_old"), F.lit(True).alias("_there"))
    joined = new.join(before, key, "left")
    changed = F.col("_there").isNull() | ~F.struct(*compared).eqNullSafe(F.col("_old"))
    turned = ~F.col("resolved").eqNullSafe(F.col("_old.resolved")) & (F.col("_there").isNotNull() | F.coalesce("resolved", F.lit(False)))
    return joined.withColumns({"updated_at": F.when(changed, now).otherwise(F.col("updated_at")), "resolved_at": F.when(turned, F.when(F.col("resolved"), now)).otherwise(F.col("resolved_at"))}).drop("_old", "_there")


def list_leads(leads: DataFrame, key: str = "org_nr") -> DataFrame:
    return leads.orderBy(F.col("name").asc_nulls_first(), key)


def distinct_branches(leads: DataFrame) -> DataFrame:
    return leads.where("branch is not null and branch != ''").select("branch").distinct()


def search_leads(leads: DataFrame, q: str, columns: list[str]) -> DataFrame:
    """Rows of which any column holds q, in any case; columns are kept apart, so no match spans two."""
    return leads.where(F.contains(F.lower(F.concat_ws("\x01", *[F.col(c).cast("string") for c in columns])), F.lit(q.lower())))


def filter_leads(leads: DataFrame, branch: str | None = None, hide_resolved: bool = False) -> DataFrame:
    out = leads if branch is None else leads.where(F.col("branch") == branch)
    return out.where(~F.coalesce("resolved", F.lit(False))) if hide_resolved else out


def sort_leads(leads: DataFrame, column: str = "name", descending: bool = False, key: str = "org_nr") -> DataFrame:
    return leads.orderBy(F.col(column).desc() if descending else F.col(column).asc(), key)


def page_leads(leads: DataFrame, page: int, size: int = 100, column: str = "name", key: str = "org_nr") -> DataFrame:
    """One page from 0 on; the plan keeps offset + size rows a task. Deep pages: see page_after() and write_pages()."""
    return leads.orderBy(column, key).offset(page * size).limit(size)


def page_after(leads: DataFrame, last_value, last_key: str, size: int = 100, column: str = "name", key: str = "org_nr") -> DataFrame:
    """The page behind a known last row, at the cost of a filter however deep it is; null values come first."""
    return leads.where(_behind(F.col(column), F.col(key), last_value, last_key)).orderBy(F.col(column).asc_nulls_first(), key).limit(size)


def _behind(value: Column, key: Column, last_value, last_key: str) -> Column:
    """Rows after a place in the order of value, nulls first, then key."""
    later = key > F.lit(last_key)
    return value.isNotNull() | (value.isNull() & later) if last_value is None else (value > F.lit(last_value)) | ((value == F.lit(last_value)) & later)


def _not_behind(value: Column, key: Column, last_value, last_key: str) -> Column:
    """Rows up to a place; each comparison is one that a file's statistics can refuse."""
    upto = key <= F.lit(last_key)
    return value.isNull() & upto if last_value is None else value.isNull() | (value < F.lit(last_value)) | ((value == F.lit(last_value)) & upto)


def write_pages(leads: DataFrame, path: str, size: int = 100, column: str = "name", key: str = "org_nr") -> None:
    """The table in the order of its list, by range-partitioned files, and beside it the last row of every page.

    The index has a row for each `size` rows of the table. Keys are unique.
    """
    ranked = keep(global_rank(leads, "_rank", F.col(column).asc_nulls_first(), F.col(key)))
    ranked.drop("_rank").repartitionByRange(F.col(column).asc_nulls_first(), key).sortWithinPartitions(F.col(column).asc_nulls_first(), key).write.mode("overwrite").parquet(f"{path}/rows")
    last = ranked.where(F.col("_rank") % size == 0).select((F.col("_rank") / size).cast("long").alias("page"), F.col(column).alias("value"), F.col(key).alias("key"))
    last.repartitionByRange("page").sortWithinPartitions("page").write.mode("overwrite").parquet(f"{path}/pages")


def read_page(spark: SparkSession, path: str, page: int, size: int = 100, column: str = "name", key: str = "org_nr") -> DataFrame:
    """A page of write_pages() from 0 on, however deep: two rows of the index, then one range of the rows."""
    ends = {r.page: (r.value, r.key) for r in spark.read.parquet(f"{path}/pages").where(F.col("page").isin(page, page + 1)).collect()}
    rows = spark.read.parquet(f"{path}/rows")
    if page > 0:
        rows = rows.where(_behind(F.col(column), F.col(key), *ends[page]) if page in ends else F.lit(False))
    if page + 1 in ends:
        rows = rows.where(_not_behind(F.col(column), F.col(key), *ends[page + 1]))
    return rows.orderBy(F.col(column).asc_nulls_first(), key).limit(size)


def lead_counts(leads: DataFrame, condition: Column, size: int = 100) -> DataFrame:
    n = F.count_if(condition)
    return leads.agg(n.alias("filtered"), F.count("*").alias("total"), F.count_if("resolved").alias("resolved"), F.ceil(n / size).alias("pages"))


def lead_display(leads: DataFrame, line: str = "keyword_line_1") -> DataFrame:
    """leads with the texts that are shown; `line` holds the first debt line."""
    return leads.withColumns({"revenue_text": format_revenue(F.col("revenue")), "debt_text": format_debt(F.col("short_debt").cast("string")), "debt_label": shorten_debt_label(F.col(line)), "badge": icp_badge(F.col("icp_score"))})


def badge_counts(leads: DataFrame) -> DataFrame:
    return leads.groupBy(icp_badge(F.col("icp_score")).alias("badge")).agg(F.count("*").alias("n"))
