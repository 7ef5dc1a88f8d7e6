"""Rows as they arrive: the latest delivery of each id, region by region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, key: str, at: str) -> DataFrame:
    """Batch form: the last delivery of each key, ties by the whole row."""
    rest = [c for c in rows.columns if c not in (key, at)]
    best = F.max_by(F.struct(at, *rest), F.struct(at, F.xxhash64(*[F.col(c) for c in rest if dict(rows.dtypes)[c][:3] != "map"])))
    return rows.groupBy(key).agg(best.alias("b")).select(key, "b.*")


def first_deliveries(stream: DataFrame, key: str, at: str, delay: str = "30 days") -> DataFrame:
    """Stream form: each key once within the watermark, late copies dropped; state is bounded by the delay."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def arrivals_by_window(stream: DataFrame, at: str, width: str, by: str, delay: str = "30 days") -> DataFrame:
    """Counts of arrivals by region and window; late rows within the watermark still count."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, width), by).agg(F.count(F.lit(1)).alias("n"))
