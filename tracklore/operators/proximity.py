"""Nearest and best places beside track ends, over the dual-tree distance join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklore.functions.geo import haversine
from tracklore.operators.dualtree import distance_join
from tracklore.session import cut


def matches_within(ends: DataFrame, places: DataFrame, radius_m: float, *, end_id: str, place_id: str) -> DataFrame:
    """All (end, place, metres) at most ``radius_m`` apart; ids are unique, positions unusable on either side match nothing."""
    pairs = distance_join(ends, places, radius_m, left_id=end_id, right_id=place_id)
    e = ends.select(F.col(end_id), F.col("lat").alias("_la"), F.col("lon").alias("_lo"))
    p = places.select(F.col(place_id), F.col("lat").alias("_pa"), F.col("lon").alias("_po"))
    near = pairs.join(e, end_id).join(p, place_id)
    return near.select(end_id, place_id, haversine(F.col("_la"), F.col("_lo"), F.col("_pa"), F.col("_po")).alias("metres"))


def nearest_place(matches: DataFrame, end_id: str, place_id: str) -> DataFrame:
    """The nearest place of each end, ties to the smaller place id."""
    return matches.groupBy(end_id).agg(F.min_by(F.struct(place_id, "metres"), F.struct("metres", place_id)).alias("n")).select(end_id, f"n.{place_id}", "n.metres")


def named_nearest(ends: DataFrame, places: DataFrame, radius_m: float, *, end_id: str, place_id: str, name: str) -> DataFrame:
    """The nearest place of each end if it has a name; a nameless nearest place hides the others."""
    best = nearest_place(matches_within(ends, places, radius_m, end_id=end_id, place_id=place_id), end_id, place_id)
    named = places.where(F.coalesce(F.col(name), F.lit("")) != "").select(place_id, name)
    return best.join(named, place_id)


def last_of_best_rank(features: DataFrame, key: str, high: Column, ord_col: str, out: list[str]) -> DataFrame:
    """Per key the last feature of high confidence, else the last one."""
    best = F.max_by(F.struct(*out), F.struct(high.alias("h"), F.col(ord_col).alias("o")))
    return features.groupBy(key).agg(best.alias("b")).select(key, "b.*")


def top_k(rows: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key in a total order; the window keeps no more than it needs of a hot key."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= k)


def unmatched(ends: DataFrame, matched: DataFrame, key: str) -> DataFrame:
    """Ends that no earlier pass has matched."""
    return ends.join(matched.select(key).distinct(), key, "left_anti")


def cascade(ends: DataFrame, passes: list, key: str) -> DataFrame:
    """Rows of all passes, each over the ends that the earlier ones left; a pass maps ends to rows with ``key``."""
    found = None
    rest = ends
    for number, run in enumerate(passes, 1):
        rows = cut(run(rest).withColumn("pass", F.lit(number)))
        found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
        rest = unmatched(rest, rows, key)
    return found
