"""Points within regions: the dual-tree traversal with boxes on one side.

The points are indexed by a tree of cells in degrees, each node with the exact bounds
and the number of its points. Pairs of node and region are walked from coarse to fine
as joins: a node outside the region is discarded, one inside is accepted wholesale
with all its points, and only the others are refined; of uncertain leaf pairs the
points are compared. Regions may overlap, so a point has a row for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.functions.geo import usable_position
from tracklore.session import cut

#: Degrees of a cell by level, from coarse to fine.
CELLS = (8.0, 1.0, 0.125)


def _cell(c: Column, level: int) -> Column:
    return F.floor(c / CELLS[level])


def _nodes(points: DataFrame, level: int) -> DataFrame:
    """Nodes of a level with the bounds of their points."""
    at = [_cell(F.col("lo_lat"), level).alias("i"), _cell(F.col("lo_lon"), level).alias("j")]
    bounds = [F.min(c) if c.startswith("lo") else F.max(c) for c in ("lo_lat", "lo_lon", "hi_lat", "hi_lon")]
    return points.groupBy(*at).agg(*(b.alias(c) for b, c in zip(bounds, ("lo_lat", "lo_lon", "hi_lat", "hi_lon"), strict=True)))


def regions_of_points(points: DataFrame, regions: DataFrame, *, point_id: str, region_id: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Pairs ``(point_id, region_id)`` of a point and each region whose box holds it, its bounds included.

    ``regions`` has min_lat, min_lon, max_lat, max_lon; a box with a null bound, or with a
    least bound above the greatest, holds nothing. Points with a null id or an unusable
    position are in no region. Repeated rows count once; other columns are ignored;
    an empty side gives an empty result.
    """
    p = points.select(F.col(point_id).alias("p"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
    p = cut(p.where(F.col("p").isNotNull() & usable_position(F.col("lat"), F.col("lon"))).distinct())
    edges = ["min_lat", "min_lon", "max_lat", "max_lon"]
    r = regions.select(F.col(region_id).alias("r"), *(F.col(c).cast("double").alias(c) for c in edges)).where(F.col("r").isNotNull()).distinct()
    r = r.where((F.col("min_lat") <= F.col("max_lat")) & (F.col("min_lon") <= F.col("max_lon")))
    fine = len(CELLS) - 1
    leaves = cut(_nodes(p.select(F.col("lat").alias("lo_lat"), F.col("lon").alias("lo_lon"), F.col("lat").alias("hi_lat"), F.col("lon").alias("hi_lon")), fine))
    apart = (F.col("lo_lat") > F.col("max_lat")) | (F.col("hi_lat") < F.col("min_lat")) | (F.col("lo_lon") > F.col("max_lon")) | (F.col("hi_lon") < F.col("min_lon"))
    within = (F.col("lo_lat") >= F.col("min_lat")) & (F.col("hi_lat") <= F.col("max_lat")) & (F.col("lo_lon") >= F.col("min_lon")) & (F.col("hi_lon") <= F.col("max_lon"))

    # a region goes to the coarse cells that it touches within the globe
    span = lambda a, b, most: F.explode(F.sequence(_cell(F.greatest(F.col(a), F.lit(-most)), 0), _cell(F.least(F.col(b), F.lit(most)), 0)))
    r = r.where((F.col("min_lat") <= 90) & (F.col("max_lat") >= -90) & (F.col("min_lon") <= 180) & (F.col("max_lon") >= -180))
    pairs = r.withColumn("i", span("min_lat", "max_lat", 90.0)).withColumn("j", span("min_lon", "max_lon", 180.0))
    pairs = pairs.join(_nodes(leaves, 0), ["i", "j"]).where(~apart).withColumn("sure", within)
    for level in range(1, fine + 1):
        ratio = round(CELLS[level - 1] / CELLS[level])
        nodes = leaves if level == fine else _nodes(leaves, level)
        children = nodes.withColumns({"ci": F.col("i"), "cj": F.col("j"), "i": F.floor(F.col("i") / ratio), "j": F.floor(F.col("j") / ratio)})
        pairs = pairs.select("r", *edges, "i", "j", "sure").join(children, ["i", "j"]).where(F.col("sure") | ~apart)
        pairs = pairs.select("r", *edges, F.col("ci").alias("i"), F.col("cj").alias("j"), (F.col("sure") | within).alias("sure"))
    inside = F.col("lat").between(F.col("min_lat"), F.col("max_lat")) & F.col("lon").between(F.col("min_lon"), F.col("max_lon"))
    placed = p.withColumns({"i": _cell(F.col("lat"), fine), "j": _cell(F.col("lon"), fine)})
    found = placed.join(pairs, ["i", "j"]).where(F.col("sure") | inside)
    return found.select(F.col("p").alias(point_id), F.col("r").alias(region_id)).distinct()
