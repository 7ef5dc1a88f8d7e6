"""Counts and rates; every order is total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.functions.text import is_unknown


def value_counts(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """(value, n, share in per cent to one place)."""
    counts = rows.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return counts.join(F.broadcast(total)).select(name, "n", F.round(100 * F.col("n") / F.col("total"), 1).alias("share"))  # one row


def top_values(rows: DataFrame, value: Column, name: str, limit: int) -> DataFrame:
    """The most frequent values, ties by value."""
    return rows.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name).limit(limit)


def bad_rate(rows: DataFrame, by: str, bad: Column) -> DataFrame:
    """(by, total, bad, rate in per cent); null keys are left out."""
    g = rows.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("total"), F.count_if(bad).alias("bad"))
    return g.withColumn("rate", F.round(F.col("bad") / F.col("total") * 100, 1))


def region_summary(rows: DataFrame, region: str) -> DataFrame:
    """Per region: rows, confidence levels, known accounts, distinct sectors."""
    c = lambda x: F.count_if(F.coalesce("confidence", F.lit("LOW")) == x)
    return rows.groupBy(region).agg(
        F.count(F.lit(1)).alias("n_rows"), c("HIGH").alias("high"), c("MEDIUM").alias("medium"), c("LOW").alias("low"),
        F.count_if(F.coalesce("in_existing_list", F.lit(False))).alias("known"), F.count_distinct(F.nullif(F.trim("sector_guess"), F.lit(""))).alias("sectors"),
    )


def sector_counts(rows: DataFrame, sector: str = "sector_guess") -> DataFrame:
    s = F.coalesce(F.nullif(F.col(sector), F.lit("")), F.lit("Unknown"))
    return rows.groupBy(s.alias("sector")).agg(F.count(F.lit(1)).alias("n"))


def sectors_by_region(rows: DataFrame, region: str, sector: str = "sector_guess") -> DataFrame:
    """(region, sector, n) of rows with a sector."""
    return rows.where(F.trim(F.coalesce(sector, F.lit(""))) != "").groupBy(region, sector).agg(F.count(F.lit(1)).alias("n"))


def compare_counts(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, before, after, change) of two count tables; absent is 0."""
    a, b = before.withColumnRenamed("n", "before"), after.withColumnRenamed("n", "after")
    return a.join(b, key, "full").fillna(0, ["before", "after"]).withColumn("change", F.col("after") - F.col("before"))


def unclassified_share(rows: DataFrame, sector: str = "sector_guess") -> DataFrame:
    n = F.count_if(is_unknown(F.col(sector)))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), n.alias("unclassified"), F.coalesce(F.round(F.try_divide(100 * n, F.count(F.lit(1))), 1), F.lit(0.0)).alias("share"))


def run_totals(stats: DataFrame, ok: Column, sums: list[str]) -> DataFrame:
    """Sums over the regions that succeeded, and how many did."""
    good = lambda c: F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0))
    return stats.agg(F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_failed"), *(good(c).alias(c) for c in sums))


def spot_check(rows: DataFrame, key: Column, order: Column, limit: int) -> DataFrame:
    """The first rows with different keys."""
    return rows.groupBy(key.alias("key")).agg(F.min(order).alias("first")).orderBy("first").limit(limit)


def hashed_sample(rows: DataFrame, row_id: str, limit: int) -> DataFrame:
    """A repeatable sample: the rows of least hash."""
    return rows.orderBy(F.md5(F.col(row_id).cast("string")), row_id).limit(limit)
