"""Regions, map features of industry, and reverse-geocoded addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklore.operators.dedup import half_even

#: Branches of the scan of industrial features: element types, key, values, further keys that must be there. A value
#: stands anywhere in the tag's value, or is the whole of it where it begins with "="; none asks for any (fixed values).
FEATURES = [
    ("way", "building", "industrial warehouse commercial", "name"),
    ("way", "building", "", "operator"),
    ("way", "landuse", "=industrial", "name"),
    ("way", "landuse", "quarry railway commercial", "name"),
    ("node way", "man_made", "works silo storage_tank kiln petroleum_well wastewater_plant water_works pumping_station", "name"),
    ("node", "industrial", "", "name"),
    ("node", "amenity", "=fuel", "name brand"),
    ("way", "amenity", "fuel loading_dock warehouse", "name"),
    ("node way", "amenity", "=recycling", "name"),
    ("way", "craft", "", "name"),
    ("node", "office", "company industrial", "name"),
    ("node way", "shop", "trade wholesale hardware", "name"),
    ("node way", "company", "", "name"),
    ("node way", "power", "plant substation generator", "name"),
]


def region_box(regions: dict[str, tuple[float, float, float, float]], key: str) -> tuple[float, float, float, float]:
    """(south, west, north, east) of a region; an unknown one is a KeyError."""
    if key not in regions:
        raise KeyError(f"unknown region {key!r}")
    return regions[key]


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    south, west, north, east = box
    return lat.between(south, north) & lon.between(west, east)


def is_industrial_feature(tags: Column, element: Column) -> Column:
    """One disjunction over the branches for the element's type, so an element that several want comes once."""
    out = F.lit(False)
    for types, key, values, need in FEATURES:
        hit = element.isin(types.split()) & tags[key].isNotNull()
        if values:
            hit = hit & (tags[key] == values[1:] if values.startswith("=") else tags[key].rlike(values.replace(" ", "|")))
        for k in need.split():
            hit = hit & tags[k].isNotNull()
        out = out | F.coalesce(hit, F.lit(False))
    return out


def named_features(features: DataFrame, tags: str = "tags") -> DataFrame:
    """Features with a name that are no street."""
    t = F.col(tags)
    return features.where((F.coalesce(t["name"], F.lit("")) != "") & t["highway"].isNull())


def feature_points(elements: DataFrame) -> DataFrame:
    """Industrial features with a position; the centre stands before the element's own point."""
    e = elements.select(F.explode("elements").alias("e"))
    spot = [F.coalesce(f"e.center.{c}", f"e.{c}").alias(c) for c in ("lat", "lon")]
    return e.where(is_industrial_feature(F.col("e.tags"), F.col("e.type"))).select(F.col("e.id").alias("id"), *spot, F.col("e.tags").alias("tags")).where((F.col("lat") != 0) & (F.col("lon") != 0))


def ranked_places(places: DataFrame, key: str, position: str, k: int = 3) -> DataFrame:
    """The first ``k`` places of each end by confidence; low ones only if they are the end's only place."""
    w = Window.partitionBy(key)
    rank = F.when(F.col("confidence") == "HIGH", 0).when(F.col("confidence") == "MEDIUM", 1).otherwise(2)
    kept = places.withColumn("_n", F.count(F.lit(1)).over(w)).where((F.col("confidence") != "LOW") | (F.col("_n") == 1))
    return kept.withColumn("rank", F.row_number().over(w.orderBy(rank, position))).where(F.col("rank") <= k).drop("_n")


def geocode_key(lat: Column, lon: Column) -> list[Column]:
    """Position to four places, the key of a saved answer."""
    return [half_even(lat, 4), half_even(lon, 4)]


def geocoded(ends: DataFrame, answers: DataFrame, with_roads: bool = False) -> DataFrame:
    """Ends with the facility of their saved answer.

    ``answers`` has (lat4, lon4, name, category, type, address struct<road,city,town,
    village,state,postcode>). Roads, borders and towns are no facility; with
    ``with_roads`` such an answer with a road gives an unknown facility near it.
    """
    key = geocode_key(F.col("lat"), F.col("lon"))
    found = ends.withColumns({"lat4": key[0], "lon4": key[1]}).join(answers, ["lat4", "lon4"])
    accepted = (F.coalesce("name", F.lit("")) != "") & ~F.coalesce("category", F.lit("")).isin("highway", "boundary", "place")
    road = F.coalesce(F.col("address.road"), F.lit(""))
    keep = accepted | (road != "") if with_roads else accepted
    kind = F.concat(F.coalesce("category", F.lit("")), F.lit("/"), F.coalesce("type", F.lit("")))
    return found.where(keep).select(
        "osm_way_id",
        F.when(accepted, F.col("name")).otherwise(F.concat(F.lit("Unknown facility near "), road)).alias("company_name"),
        F.coalesce("address.city", "address.town", "address.village", F.lit("")).alias("city"),
        F.coalesce("address.state", F.lit("")).alias("state"),
        F.coalesce("address.postcode", F.lit("")).alias("zip_code"),
        kind.alias("facility_type"),
        F.when(accepted, "MEDIUM").otherwise("LOW").alias("confidence"),
        F.when(accepted, "nominatim").otherwise("nominatim_address").alias("source"),
    )


def is_us_state(state_key: Column, state: Column, names: list[str], codes: list[str]) -> Column:
    """True if the region key or the state is a name or a code of the lists."""
    any_of = lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))).isin([x.lower() for x in (*names, *codes)])
    return any_of(state_key) | any_of(state)
