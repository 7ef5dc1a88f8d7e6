"""Duplicates by key and by distance.

Leader dedup keeps rows in order of priority unless a kept row lies too near. That is
the lexicographically first maximal independent set of the nearness graph, found in
parallel rounds: rows with no better undecided neighbour are kept, their neighbours
dropped, until none is undecided. Rows at the same point are represented by their
best one first, which changes nothing, so co-located copies never form pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklore.functions.geo import haversine, usable_position
from tracklore.operators.dualtree import distance_join
from tracklore.session import cut


def first_by(rows: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each key (nulls and NaN are keys of their own) in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def half_even(c: Column, digits: int) -> Column:
    """Rounded to ``digits`` places by way of an integer, ties to even."""
    return F.rint(c * 10.0**digits) / 10.0**digits


def location_key(city: Column, lat: Column, lon: Column, fallback: Column, cell: float = 0.045) -> Column:
    """Town, else the grid cell (truncated towards zero), else the region."""
    town = F.lower(F.trim(F.coalesce(city, F.lit(""))))
    placed = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    grid = F.concat(F.lit("grid:"), (lat / cell).cast("int").cast("string"), F.lit(","), (lon / cell).cast("int").cast("string"))
    return F.when(town != "", town).when(placed, grid).otherwise(F.lower(F.trim(F.coalesce(fallback, F.lit("")))))


def leader_dedup(rows: DataFrame, row_id: str, order: list[Column], radius_m: float, *, group: str | None = None, inclusive: bool = False) -> DataFrame:
    """Rows kept by leader dedup within ``radius_m`` (inside only, or the bound too).

    ``order`` is the priority, best first, made total by the id; with ``group`` only
    rows of one group are near. Rows without a usable position are always kept.
    Ids are unique. Empty in, empty out.
    """
    placed = rows.where(usable_position(F.col("lat"), F.col("lon")))
    loose = rows.join(placed.select(row_id), row_id, "left_anti")
    key = [group] if group else []
    lean = placed.select(F.col(row_id).alias("id"), "lat", "lon", *([F.col(group).alias("g")] if group else [F.lit(0).alias("g")]), F.struct(*order, F.col(row_id)).alias("prio"))
    heads = cut(lean.groupBy("g", "lat", "lon").agg(F.min("prio").alias("prio"), F.min_by("id", "prio").alias("id")))
    pairs = distance_join(heads, heads.select(F.col("id").alias("other"), "lat", "lon"), radius_m, left_id="id", right_id="other").where(F.col("id") != F.col("other"))
    h = heads.select("id", "g", "prio", F.col("lat").alias("la"), F.col("lon").alias("lo"))
    o = heads.select(F.col("id").alias("other"), F.col("g").alias("og"), F.col("prio").alias("oprio"), F.col("lat").alias("ola"), F.col("lon").alias("olo"))
    near = pairs.join(h, "id").join(o, "other").where((F.col("g") == F.col("og")) & (F.col("oprio") < F.col("prio")))
    if not inclusive:
        near = near.where(haversine(F.col("la"), F.col("lo"), F.col("ola"), F.col("olo")) < radius_m)
    edges = cut(near.select("id", F.col("other").alias("better")))
    undecided, kept = heads.select("id"), None
    while True:
        waiting = edges.select("id").distinct()
        first = cut(undecided.join(waiting, "id", "left_anti"))
        kept = first if kept is None else kept.unionByName(first)
        out = edges.join(first.select(F.col("id").alias("better")), "better", "left_semi").select("id").distinct()
        undecided = cut(undecided.join(first, "id", "left_anti").join(out, "id", "left_anti"))
        if undecided.isEmpty():
            break
        still = undecided.select(F.col("id").alias("better"))
        edges = cut(edges.join(undecided, "id", "left_semi").join(still, "better", "left_semi"))
    return placed.join(kept.select(F.col("id").alias(row_id)), row_id, "left_semi").unionByName(loose)
