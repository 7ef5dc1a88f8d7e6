"""Registered queries of the distance joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracklore.operators.dualtree import distance_join
from tracklore.session import table

#: Metres between a track end and a company row that lie close to each other.
NEAR_M = 150.0


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a track end and a company row at most 150 m apart."""
    return distance_join(
        table(spark, sf_dir, "spur_endpoints"),
        table(spark, sf_dir, "companies"),
        NEAR_M,
        left_id="endpoint_id",
        right_id="row_id",
    )


_USABLE = "lat between -90 and 90 and lon between -180 and 180 and not isnan(lat) and not isnan(lon) and not (lat = 0 and lon = 0)"

QUERIES = {"p4_found": p4_found}

ORACLE = {
    "p4_found": f"""
with a as (select distinct endpoint_id, lat, lon from spur_endpoints where {_USABLE}),
     b as (select distinct row_id, lat, lon from companies where {_USABLE})
select distinct a.endpoint_id, b.row_id from a join b
  on b.lat between a.lat - 0.00136 and a.lat + 0.00136
 and 2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2)
     + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) <= 150.0
"""
}
