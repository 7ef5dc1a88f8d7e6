"""Registered queries over saved map responses, saved answers, regions and reports, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklore.operators import geocode, known, merge, network, reports, rules
from tracklore.operators.regions import regions_of_points
from tracklore.plans.facilities import _C, _CLS, _E, _V, _WAYS, _companies, _ends, _found, _known, _round, ways_of_orders
from tracklore.session import table

_ELEMENT = "struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,nodes:array<bigint>,tags:map<string,string>>"


def _element(**parts: object) -> F.Column:
    names = ("type", "id", "lat", "lon", "center", "nodes", "tags")
    return F.struct(*((parts[n] if n in parts else F.lit(None)).alias(n) for n in names)).cast(_ELEMENT)


def _responses(spark: SparkSession, d: str) -> DataFrame:
    """A saved response for each order: its way, then its nodes, which other responses repeat."""
    ways, nodes = ways_of_orders(table(spark, d, "lineitem"))
    of = ways.select("way_id", F.explode("node_ids").alias("node_id")).join(nodes, "node_id")
    points = of.groupBy("way_id").agg(F.collect_list(_element(type=F.lit("node"), id=F.col("node_id"), lat=F.col("lat"), lon=F.col("lon"))).alias("points"))
    way = _element(type=F.lit("way"), id=F.col("way_id"), nodes=F.col("node_ids"), tags=F.col("tags"))
    return ways.join(points, "way_id").select(F.concat(F.array(way), F.col("points")).alias("elements"))


def parsed_ways(spark: SparkSession, d: str) -> DataFrame:
    ways, _ = network.parse_elements(_responses(spark, d))
    return ways.select("way_id", F.size("node_ids").alias("n_nodes"), F.col("tags")["railway"].alias("railway"))


def parsed_nodes(spark: SparkSession, d: str) -> DataFrame:
    _, nodes = network.parse_elements(_responses(spark, d))
    return nodes.select("node_id", F.round("lat", 8).alias("lat"), F.round("lon", 8).alias("lon"))


def way_features(spark: SparkSession, d: str) -> DataFrame:
    f = network.geojson_features(*ways_of_orders(table(spark, d, "lineitem")))
    at = lambda p: F.get_json_object("feature", p)
    return f.select("way_id", "n_vertices", at("$.geometry.type").alias("shape"), at("$.properties.railway").alias("railway"), F.round(at("$.geometry.coordinates[0][0]").cast("double"), 8).alias("lon"), F.round(at("$.geometry.coordinates[0][1]").cast("double"), 8).alias("lat"))


def _features(spark: SparkSession, d: str) -> DataFrame:
    """Elements made of the company rows: even rows as ways with a centre, odd ones as nodes."""
    c = _companies(spark, d)
    even, kind = F.col("row_id") % 2 == 0, F.col("facility_type")
    tags = F.map_filter(
        F.create_map(
            F.lit("name"), F.col("company_name"), F.lit("building"), F.when(kind == "warehouse", "old_warehouse"), F.lit("landuse"), F.when(kind == "quarry", "quarry").when(kind == "landfill", "industrial_old"),
            F.lit("man_made"), F.when(kind == "steel mill", "works"), F.lit("amenity"), F.when(kind == "fuel terminal", "fuel").when(kind == "scrap yard", "recycling"), F.lit("power"), F.when(kind == "power station", "plant"), F.lit("highway"), F.when(kind == "brewery", "service"),
        ), lambda k, v: v.isNotNull(),
    )
    spot = F.struct("lat", "lon")
    return c.select(_element(type=F.when(even, "way").otherwise("node"), id=F.col("row_id"), lat=F.when(~even, F.col("lat")), lon=F.when(~even, F.col("lon")), center=F.when(even, spot), tags=tags).alias("e"))


def industrial_points(spark: SparkSession, d: str) -> DataFrame:
    return geocode.feature_points(_features(spark, d).select(F.array("e").alias("elements"))).select("id", "lat", "lon")


def named_features(spark: SparkSession, d: str) -> DataFrame:
    return geocode.named_features(_features(spark, d).select("e.id", "e.tags")).select("id")


def ranked_rows(spark: SparkSession, d: str) -> DataFrame:
    c = _companies(spark, d).where("confidence is not null").select("osm_way_id", "row_id", "confidence")
    return geocode.ranked_places(c, "osm_way_id", "row_id").select("osm_way_id", "row_id", "rank")


def geocoded_ends(spark: SparkSession, d: str) -> DataFrame:
    """Track ends with saved answers made of the company rows at the same four-digit position; every third is a road."""
    c = _companies(spark, d)
    key = geocode.geocode_key(F.col("lat"), F.col("lon"))
    first = c.where("lat is not null and lon is not null and not isnan(lat) and not isnan(lon)").withColumns({"lat4": key[0], "lon4": key[1]}).groupBy("lat4", "lon4").agg(F.min_by(F.struct(*c.columns), "row_id").alias("c"))
    address = F.struct(F.col("c.address").alias("road"), F.lit(None).cast("string").alias("city"), F.col("c.city").alias("town"), F.lit(None).cast("string").alias("village"), F.col("c.state").alias("state"), F.col("c.zip_code").alias("postcode"))
    answers = first.select("lat4", "lon4", F.col("c.company_name").alias("name"), F.when(F.col("c.row_id") % 3 == 0, "highway").otherwise("man_made").alias("category"), F.lit("works").alias("type"), address.alias("address"))
    return geocode.geocoded(_ends(spark, d).select("osm_way_id", "lat", "lon"), answers, True)


def us_rows(spark: SparkSession, d: str) -> DataFrame:
    regions = table(spark, d, "state_regions").collect()  # a fixed table of the states
    names, codes = [r.state_name for r in regions], [r.state_code for r in regions]
    return _companies(spark, d).where(geocode.is_us_state(F.lit(""), F.col("state"), names, codes)).select("row_id")


def end_regions(spark: SparkSession, d: str) -> DataFrame:
    """Each track end with every region whose box holds it."""
    return regions_of_points(table(spark, d, "spur_endpoints"), table(spark, d, "state_regions"), point_id="endpoint_id", region_id="state_code")


def merged_rows(spark: SparkSession, d: str) -> DataFrame:
    c = _companies(spark, d)
    return merge.merge(c.where("source <> 'overture' or source is null"), c.where("source = 'overture'")).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def region_sectors(spark: SparkSession, d: str) -> DataFrame:
    return reports.sectors_by_region(_companies(spark, d), "state_key")


def validation_new(spark: SparkSession, d: str) -> DataFrame:
    return known.new_names(_found(spark, d), _known(spark, d, True))


def sources_seen(spark: SparkSession, d: str) -> DataFrame:
    return _companies(spark, d).where("source is not null").select("source").distinct()


def name_classes(spark: SparkSession, d: str) -> DataFrame:
    """Unusable names by the reason."""
    c = _companies(spark, d)
    return reports.value_counts(c.where(rules.name_class(F.col("company_name")) != "real"), rules.name_class(F.col("company_name")), "name_class")


QUERIES = {
    f.__name__: f
    for f in (parsed_ways, parsed_nodes, way_features, industrial_points, named_features, ranked_rows, geocoded_ends, us_rows, end_regions, merged_rows, region_sectors, validation_new, sources_seen, name_classes)
}

_KIND = "case flag when 'A' then 'spur' when 'N' then 'siding' else 'rail' end"
_NAMED = "company_name is not null"
_KEY5 = "lower(regexp_replace(coalesce({0}.company_name, ''), '^\\s+|\\s+$', '', 'g'))"
_R4 = lambda x: _round(x, 4)
_SAME = " and ".join(f"(case when isnan(b.{c}) then null else {_round(f'b.{c}', 5)} end) is not distinct from (case when isnan(a.{c}) then null else {_round(f'a.{c}', 5)} end)" for c in ("lat", "lon"))
ORACLE = {
    "parsed_ways": f"with {_WAYS} select way_id, n as n_nodes, {_KIND} as railway from w",
    "parsed_nodes": f"with {_WAYS} select distinct node_id, round(lat, 8) as lat, round(lon, 8) as lon from c",
    "way_features": f"with {_WAYS} select way_id, n as n_vertices, 'LineString' as shape, {_KIND} as railway, round(alon, 8) as lon, round(alat, 8) as lat from w where n >= 2",
    "industrial_points": f"""select row_id as id, lat, lon from {_C} where {_NAMED} and lat <> 0 and lon <> 0 and case when row_id % 2 = 0 then facility_type in ('warehouse', 'quarry', 'steel mill', 'fuel terminal', 'scrap yard', 'power station')
  else facility_type in ('steel mill', 'scrap yard', 'power station') end""",
    "named_features": f"select row_id as id from {_C} where coalesce(company_name, '') <> '' and facility_type is distinct from 'brewery'",
    "ranked_rows": f"""select osm_way_id, row_id, rank from (select *, row_number() over (partition by osm_way_id order by case confidence when 'HIGH' then 0 when 'MEDIUM' then 1 else 2 end, row_id) as rank
  from (select *, count(*) over (partition by osm_way_id) as n from {_C} where confidence is not null) where confidence <> 'LOW' or n = 1) where rank <= 3""",
    "geocoded_ends": f"""with a as (select * from (select *, {_R4('lat')} as lat4, {_R4('lon')} as lon4, row_number() over (partition by {_R4('lat')}, {_R4('lon')} order by row_id) as rn from {_C} where lat is not null and lon is not null and not isnan(lat) and not isnan(lon)) where rn = 1),
 m as (select e.osm_way_id, a.*, coalesce(a.company_name, '') <> '' and a.row_id % 3 <> 0 as ok from {_E} e join a on {_R4('e.lat')} = a.lat4 and {_R4('e.lon')} = a.lon4)
 select m.osm_way_id, case when ok then company_name else 'Unknown facility near ' || coalesce(address, '') end as company_name, coalesce(city, '') as city, coalesce(state, '') as state, coalesce(zip_code, '') as zip_code,
  case when row_id % 3 = 0 then 'highway/works' else 'man_made/works' end as facility_type, case when ok then 'MEDIUM' else 'LOW' end as confidence, case when ok then 'nominatim' else 'nominatim_address' end as source
 from m where ok or coalesce(address, '') <> ''""".replace("select e.osm_way_id, a.*", "select e.osm_way_id, a.* exclude (osm_way_id)"),
    "us_rows": f"select row_id from {_C} where lower(trim(coalesce(state, ''))) in (select lower(state_name) from state_regions union all select lower(state_code) from state_regions)",
    "end_regions": "select distinct endpoint_id, state_code from spur_endpoints e join state_regions r on e.lat between r.min_lat and r.max_lat and e.lon between r.min_lon and r.max_lon where e.lat between -90 and 90 and e.lon between -180 and 180 and not (e.lat = 0 and e.lon = 0)",
    "merged_rows": f"select source, count(*) as n from {_C} a where source is distinct from 'overture' or not exists (select 1 from {_C} b where b.source is distinct from 'overture' and {_KEY5.format('b')} = {_KEY5.format('a')} and {_SAME}) group by 1",
    "region_sectors": f"select state_key, sector_guess, count(*) as n from {_C} where trim(coalesce(sector_guess, '')) <> '' group by 1, 2",
    "validation_new": f"with {_V} select name from f where not exists (select 1 from k where contains(name, known) or contains(known, name))",
    "sources_seen": "select distinct source from companies where source is not null",
    "name_classes": f"select {_CLS} as name_class, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 1) as share from {_C} where {_CLS} <> 'real' group by 1",
}
