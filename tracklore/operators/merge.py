"""Unions and anti-joins of result sets, and verdict tables in place of remote answers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklore.functions.text import is_unknown, strip
from tracklore.operators.dedup import half_even


def union_regions(parts: dict[str, DataFrame], key: str = "state_key") -> DataFrame:
    """Outputs of the regions in one table with the region first; missing columns are null, no dedup."""
    frames = [df.withColumn(key, F.lit(k)).select(key, *(c for c in df.columns if c != key)) for k, df in sorted(parts.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def new_rows(base: DataFrame, added: DataFrame, name: str = "company_name", lat: str = "lat", lon: str = "lon", digits: int = 5) -> DataFrame:
    """Rows of ``added`` whose name and rounded position ``base`` lacks; null and NaN are one key, copies within ``added`` stay."""
    place = lambda c: half_even(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), digits)
    key = {"_k1": F.lower(strip(F.coalesce(F.col(name), F.lit("")))), "_k2": place(lat), "_k3": place(lon)}
    a = added.withColumns(key)
    b = base.select(*(v.alias(k) for k, v in key.items())).distinct()
    return a.join(b, [a[k].eqNullSafe(b[k]) for k in key], "left_anti").drop(*key)


def merge(base: DataFrame, added: DataFrame) -> DataFrame:
    return base.unionByName(new_rows(base, added), allowMissingColumns=True)


def batches(rows: DataFrame, idx: str, text: str, size: int) -> DataFrame:
    """Batches of ``size`` rows by index: (batch, lines, key), the key a hash of the lines for a cache."""
    by = rows.groupBy(F.floor(F.col(idx) / size).alias("batch"))
    lines = by.agg(F.array_sort(F.collect_list(F.struct(idx, text))).alias("l"))
    joined = F.array_join(F.transform("l", lambda x: F.concat(x[idx].cast("string"), F.lit(": "), F.coalesce(x[text], F.lit("")))), "\n")
    return lines.select("batch", joined.alias("lines")).withColumn("key", F.substring(F.sha2("lines", 256), 1, 16))


def parse_labels(answers: DataFrame, batch: str, answer: str, labels: list[str], size: int) -> DataFrame:
    """(batch, idx, label) of answers that map positions to labels: fences off, whole positions in range, other labels Unknown."""
    body = F.regexp_replace(F.col(answer), r"^\s*```(?:json)?\s*|\s*```\s*$", "")
    pairs = answers.select(batch, F.explode(F.from_json(body, "map<string,string>")).alias("k", "v"))
    pairs = pairs.withColumn("idx", F.try_to_number("k", F.lit("999999999")).cast("int")).where(F.col("idx").between(0, size - 1))
    return pairs.select(batch, "idx", F.when(F.col("v").isin(labels), F.col("v")).otherwise("Unknown").alias("label"))


def apply_verdicts(rows: DataFrame, verdicts: DataFrame, idx: str, sector: str) -> DataFrame:
    """Rows with ``keep`` (kept where there is no verdict) and the sector filled where it is unknown."""
    v = verdicts.select(idx, F.col("keep").alias("_keep"), F.col("sector").alias("_sector"))
    out = rows.join(v, idx, "left").withColumn("keep", F.coalesce("_keep", F.lit(True)).cast("string"))
    fill = F.when(is_unknown(F.col(sector)) & F.col("_sector").isNotNull(), F.col("_sector")).otherwise(F.col(sector))
    return out.withColumn(sector, fill).drop("_keep", "_sector")
