"""Track network: ways and nodes to facility-side ends.

``ways`` has (way_id, tags map<string,string>, node_ids array<bigint>), ``nodes`` has
(node_id, lat, lon). All of it is joins and aggregates; no way is handled alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklore.functions.geo import centroid, polyline_length

#: Schema of a saved map response (fixed values: the format of the map service).
ELEMENTS = (
    "elements array<struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,"
    "nodes:array<bigint>,tags:map<string,string>>>"
)


def parse_elements(raw: DataFrame, order: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(ways, nodes) of saved responses; of a repeated id the last element counts, at its first position.

    Responses follow each other by the columns of ``order`` (such as a time of retrieval, or
    file and line), else as they are read.
    """
    at = F.struct(*order, F.monotonically_increasing_id().alias("line"))
    el = raw.select(at.alias("at"), F.posexplode("elements").alias("i", "e")).select(F.struct("at", "i").alias("pos"), "e")
    last = lambda t: el.where(F.col("e.type") == t).groupBy(F.col("e.id").alias("id")).agg(F.min("pos").alias("ord"), F.max_by("e", "pos").alias("e"))
    none = F.create_map().cast("map<string,string>")
    ways = last("way").select(F.col("id").alias("way_id"), F.coalesce("e.tags", none).alias("tags"), F.coalesce("e.nodes", F.array().cast("array<bigint>")).alias("node_ids"), "ord")
    nodes = last("node").select(F.col("id").alias("node_id"), "e.lat", "e.lon")
    return ways, nodes


def is_spur_or_siding(tags: Column) -> Column:
    """Tracks of the facility kind: spurs and sidings by either tag."""
    kinds = ["spur", "siding"]
    return F.coalesce(tags["railway"].isin(kinds) | ((tags["railway"] == "rail") & tags["service"].isin(kinds)), F.lit(False))


def mainline_nodes(ways: DataFrame, heuristic: bool = False) -> DataFrame:
    """Distinct nodes of main lines: tagged so, or by the wider heuristic."""
    t = F.col("tags")
    usage = F.coalesce(t["usage"], F.lit(""))
    strict = (t["railway"] == "rail") & (usage == "main")
    wide = t["railway"].isin("rail", "main", "mainline") & ~F.coalesce(t["service"], F.lit("")).isin("spur", "siding", "yard") & usage.isin("", "main", "branch")
    return ways.where(wide if heuristic else strict).select(F.explode("node_ids").alias("node_id")).distinct()


def resolve_coords(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Ways with ``coords``, the resolved vertices in order; unknown nodes are dropped, shorter than two vertices left out."""
    at = ways.where(F.size("node_ids") >= 2).select("way_id", F.posexplode("node_ids").alias("pos", "node_id"))
    at = at.join(nodes, "node_id").groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("pos", "lat", "lon"))).alias("v"))
    coords = F.transform("v", lambda x: F.struct(x["lat"].alias("lat"), x["lon"].alias("lon")))
    return ways.join(at.select("way_id", coords.alias("coords")), "way_id").where(F.size("coords") >= 2)


def junction_nodes(ways: DataFrame) -> DataFrame:
    """Nodes at which at least two way ends meet; a closed way meets itself."""
    ends = ways.where(F.size("node_ids") > 0).select(F.explode(F.array(F.element_at("node_ids", 1), F.element_at("node_ids", -1))).alias("node_id"))
    return ends.groupBy("node_id").agg(F.count(F.lit(1)).alias("n_ends")).where("n_ends >= 2")


def residual_tags(tags: Column) -> Column:
    """Tags that have no column of their own."""
    return F.map_filter(tags, lambda k, _: ~k.isin("railway", "name", "operator"))


def facility_ends(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """One facility-side end per way.

    If exactly one end is a junction the other end is taken, else the mean of all
    vertices. The type is the service tag, then the railway tag, then ``spur``.
    """
    w = resolve_coords(ways, nodes)
    j = junction_nodes(ways).select("node_id", F.lit(True).alias("yes"))
    w = w.withColumns({"first_id": F.element_at("node_ids", 1), "last_id": F.element_at("node_ids", -1)})
    for end in ("first", "last"):
        w = w.join(j.select(F.col("node_id").alias(f"{end}_id"), F.col("yes").alias(f"{end}_j")), f"{end}_id", "left")
    a, b = F.coalesce("first_j", F.lit(False)), F.coalesce("last_j", F.lit(False))
    spot = F.when(a & ~b, F.element_at("coords", -1)).when(b & ~a, F.element_at("coords", 1)).otherwise(centroid(F.col("coords")))
    t = F.col("tags")
    return w.withColumn("spot", spot).select(
        F.col("spot.lat").alias("lat"),
        F.col("spot.lon").alias("lon"),
        F.col("way_id").alias("osm_way_id"),
        F.coalesce(t["service"], t["railway"], F.lit("spur")).alias("railway_type"),
        F.bround(polyline_length(F.col("coords")), 1).alias("spur_length_m"),
        (a | b).alias("connected_to_mainline"),
        F.when(a != b, "mainline_exclusion").otherwise("midpoint").alias("endpoint_method"),
        F.coalesce(t["name"], F.lit("")).alias("name"),
        F.coalesce(t["operator"], F.lit("")).alias("operator"),
        residual_tags(t).alias("tags"),
    )


def within_length(ends: DataFrame, least: float = 50.0, most: float = 3000.0) -> DataFrame:
    """Ends whose track length lies between both bounds, which count as inside."""
    return ends.where(F.col("spur_length_m").between(least, most))


def longest(ends: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` longest tracks, ties by way id; 0 for all."""
    return ends.orderBy(F.desc("spur_length_m"), "osm_way_id").limit(limit) if limit else ends


def track_counts(df: DataFrame, kind: Column) -> DataFrame:
    """One row: spurs, sidings and all tracks."""
    return df.agg(F.count_if(kind == "spur").alias("spurs"), F.count_if(kind == "siding").alias("sidings"), F.count(F.lit(1)).alias("tracks"))


def geojson_features(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """One GeoJSON line feature per way with two resolved vertices; coordinates are [lon, lat]."""
    line = F.transform("coords", lambda c: F.array(c["lon"], c["lat"]))
    props = F.map_concat(F.create_map(F.lit("osm_id"), F.col("way_id").cast("string")), F.map_filter("tags", lambda k, _: k != "osm_id"))
    shape = F.struct(F.lit("LineString").alias("type"), line.alias("coordinates"))
    w = resolve_coords(ways, nodes)
    return w.select("way_id", F.to_json(F.struct(F.lit("Feature").alias("type"), props.alias("properties"), shape.alias("geometry"))).alias("feature"), F.size("coords").alias("n_vertices"))
