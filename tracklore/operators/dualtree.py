"""Distance join of two point sets by a distributed dual-tree traversal.

Both sides are indexed by the same octree over the sphere (three dimensional
cells, so poles and the date line need no care). A node is a cell with the exact
bounding box of its points and their number. Pairs of nodes are walked level by
level, from coarse to fine, as joins:

* impossible pairs (boxes further apart than the radius) are discarded,
* certain pairs (boxes whose farthest corners are inside the radius) are accepted
  wholesale, and no distance of their points is computed,
* the rest are refined into pairs of child nodes; of uncertain leaf pairs the
  points are compared.

Crowded nodes are cut into slots of bounded size before points are joined, so no
task holds an unbounded group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.functions.geo import EARTH_RADIUS_M, haversine, unit_xyz, usable_position
from tracklore.session import cut

#: Cells of a level are 2**shift leaf cells wide.
SHIFTS = (6, 3, 0)
#: Points of a slot; a pair of slots is at most SLOT * SLOT comparisons.
SLOT = 2048
_BOX = ("x", "y", "z")
#: A cell is one number of three coordinates of this many bits; the least leaf (metres) for which they suffice.
_BITS, _LEAST_LEAF_M = 21, 10.0
#: Allowance for rounding in the comparison of boxes, far above the error of doubles.
_SLACK_M = 1e-3


def _points(df: DataFrame, id_col: str, lat: str, lon: str, leaf_m: float) -> DataFrame:
    df = df.select(F.col(id_col).alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
    df = df.where(F.col("id").isNotNull() & usable_position(F.col("lat"), F.col("lon")))
    df = df.distinct()  # a row delivered again is the same point
    x, y, z = unit_xyz(F.col("lat"), F.col("lon"))
    df = df.select("id", "lat", "lon", x.alias("x"), y.alias("y"), z.alias("z"))
    return df.withColumn("c", _pack([F.floor(F.col(a) / leaf_m) for a in _BOX]))


def _pack(coords: list[Column], shift: int = 0) -> Column:
    """The cell of three coordinates of a level, as one number."""
    x, y, z = (c.cast("bigint") + (1 << (_BITS - 1 - shift)) for c in coords)
    return F.shiftleft(x, 2 * _BITS).bitwiseOR(F.shiftleft(y, _BITS)).bitwiseOR(z)


def _lifted(cell: Column, shift: int) -> Column:
    """The cell that holds ``cell``, ``shift`` halvings up."""
    if not shift:
        return cell
    parts = [F.shiftright(F.shiftright(cell, k * _BITS).bitwiseAND(F.lit((1 << _BITS) - 1).cast("bigint")), shift) for k in (2, 1, 0)]
    return F.shiftleft(parts[0], 2 * _BITS).bitwiseOR(F.shiftleft(parts[1], _BITS)).bitwiseOR(parts[2])


def _leaf_nodes(points: DataFrame) -> DataFrame:
    aggs = [f(a).alias(f"{n}{a}") for a in _BOX for n, f in (("lo", F.min), ("hi", F.max))]
    return points.groupBy("c").agg(*aggs, F.count(F.lit(1)).alias("n"))


def _lift(leaves: DataFrame, shift: int) -> DataFrame:
    """Nodes of a coarser level from the leaf nodes."""
    aggs = [f(f"{n}{a}").alias(f"{n}{a}") for a in _BOX for n, f in (("lo", F.min), ("hi", F.max))]
    return leaves.groupBy(_lifted(F.col("c"), shift).alias("c")).agg(*aggs, F.sum("n").alias("n"))


def _side(df: DataFrame, side: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{side}_{c}") for c in df.columns))


def _gap2() -> Column:
    """Squared least distance of the two boxes."""
    total = F.lit(0.0)
    for a in _BOX:
        gap = F.greatest(F.col(f"l_lo{a}") - F.col(f"r_hi{a}"), F.col(f"r_lo{a}") - F.col(f"l_hi{a}"), F.lit(0.0))
        total = total + gap * gap
    return total


def _span2() -> Column:
    """Squared greatest distance of the two boxes."""
    total = F.lit(0.0)
    for a in _BOX:
        far = F.greatest(F.col(f"l_hi{a}") - F.col(f"r_lo{a}"), F.col(f"r_hi{a}") - F.col(f"l_lo{a}"))
        total = total + far * far
    return total


def _children(leaves: DataFrame, shift: int, parent: int, side: str) -> DataFrame:
    nodes = leaves if shift == 0 else _lift(leaves, shift)
    return _side(nodes.withColumn("p", _lifted(F.col("c"), parent - shift)), side)


def _slotted(points: DataFrame, leaves: DataFrame, side: str) -> DataFrame:
    """Points of their leaf; those of a crowded leaf are spread over its slots."""
    crowded = leaves.where(F.col("n") > SLOT).select("c", _slots(F.col("n")).alias("of"))
    pts = points.select("c", "id", "lat", "lon").join(crowded, "c", "left")
    slot = F.when(F.col("of").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("id", "lat", "lon"), F.col("of"))).cast("int")
    return _side(pts.withColumn("slot", slot).drop("of"), side)


def _slots(n: Column) -> Column:
    return F.ceil(n / SLOT).cast("int")


def distance_join(
    left: DataFrame,
    right: DataFrame,
    radius_m: float,
    *,
    left_id: str,
    right_id: str,
    left_lat: str = "lat",
    left_lon: str = "lon",
    right_lat: str = "lat",
    right_lon: str = "lon",
) -> DataFrame:
    """Pairs ``(left_id, right_id)`` at most ``radius_m`` metres apart, once each.

    Rows with a null id, or a position that is null, NaN, (0, 0) or outside the
    globe, are in no pair. Repeated rows count once. Two points at the same place
    are a pair. An empty side gives an empty result. Other columns, whatever
    their names, are ignored. If both ids have the same name the right one gets
    the suffix ``_right``.
    """
    leaf_m = max(radius_m, _LEAST_LEAF_M)
    pl = _points(left, left_id, left_lat, left_lon, leaf_m)
    pr = _points(right, right_id, right_lat, right_lon, leaf_m)
    ll, lr = cut(_leaf_nodes(pl)), cut(_leaf_nodes(pr))
    reach = 2 * EARTH_RADIUS_M * math.sin(min(radius_m / (2 * EARTH_RADIUS_M), math.pi / 2))
    near2, sure2 = (reach + _SLACK_M) ** 2, max(reach - _SLACK_M, 0.0) ** 2

    top = SHIFTS[0]
    size = leaf_m * (1 << top)
    tl, tr = _side(_lift(ll, top), "l"), _lift(lr, top)
    # the right nodes go to each cell that their box, widened by the reach, touches
    for a in _BOX:
        lo, hi = (F.floor((F.col(f"{n}{a}") + d * (reach + _SLACK_M)) / size) for n, d in (("lo", -1), ("hi", 1)))
        tr = tr.withColumn(f"at{a}", F.explode(F.sequence(lo, hi)))
    tr = tr.withColumn("at", _pack([F.col(f"at{a}") for a in _BOX], top)).drop(*(f"at{a}" for a in _BOX))
    tr = _side(tr, "r")
    pairs = tl.join(tr, F.col("l_c") == F.col("r_at")).where(_gap2() <= near2).withColumn("sure", _span2() <= sure2)

    for above, shift in zip(SHIFTS, SHIFTS[1:], strict=False):
        pairs = pairs.select("sure", F.col("l_c").alias("l_p"), F.col("r_c").alias("r_p"))
        for side, leaves in (("l", ll), ("r", lr)):
            pairs = pairs.join(_children(leaves, shift, above, side), f"{side}_p")
        pairs = pairs.where(F.col("sure") | (_gap2() <= near2)).withColumn("sure", F.col("sure") | (_span2() <= sure2))

    slots = {side: F.explode(F.sequence(F.lit(0), _slots(F.col(f"{side}_n")) - 1)).alias(f"{side}_slot") for side in "lr"}
    pairs = pairs.select("sure", "l_c", "r_c", slots["l"], "r_n").select("sure", "l_c", "r_c", "l_slot", slots["r"])
    for side, points, leaves in (("l", pl, ll), ("r", pr, lr)):
        pairs = pairs.join(_slotted(points, leaves, side), [f"{side}_c", f"{side}_slot"]).drop(f"{side}_c", f"{side}_slot")
    d = haversine(F.col("l_lat"), F.col("l_lon"), F.col("r_lat"), F.col("r_lon"))
    other = right_id if right_id != left_id else f"{right_id}_right"
    return pairs.where(F.col("sure") | (d <= radius_m)).select(F.col("l_id").alias(left_id), F.col("r_id").alias(other))
