"""Registered queries of the engine's own operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklore.functions.geo import centroid, haversine, polyline_length, usable_position
from tracklore.functions.text import SUFFIXES, address_parts, norm_brand, norm_suffix, norm_words
from tracklore.operators import dedup, known, merge, network, proximity, reports, rules
from tracklore.session import table
from tracklore.sources.io import overture_places, point_of_wkb
from tracklore.streaming.arrivals import latest

_COLS = "row_id osm_way_id state_key company_name address city state zip_code lat lon facility_type spur_length_m confidence in_existing_list sector_guess source discovery_date".split()


def _companies(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "companies").select(*_COLS).distinct()


def _ends(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "spur_endpoints")
    return e.select("endpoint_id", "state_key", "lat", "lon", "osm_way_id", "railway_type", "spur_length_m", "name", "operator").distinct()


def _places(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "overture_places")
    spot = point_of_wkb(F.col("geometry"))
    lat, lon = F.coalesce(spot["lat"], F.col("bbox.ymin")), F.coalesce(spot["lon"], F.col("bbox.xmin"))
    return p.select("place_id", F.col("names.primary").alias("name"), lat.alias("lat"), lon.alias("lon"))



def ways_of_orders(lineitem: DataFrame, modulus: int = 5000) -> tuple[DataFrame, DataFrame]:
    """A synthetic network over the order lines: a way per order, a node per part."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    v = lineitem.withColumn("seq", F.row_number().over(w)).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("seq", "l_partkey"))).alias("v"), F.min_by("l_returnflag", "seq").alias("flag"))
    kind = F.when(F.col("flag") == "A", "spur").when(F.col("flag") == "N", "siding").otherwise("rail")
    ways = v.select(F.col("l_orderkey").alias("way_id"), F.create_map(F.lit("railway"), kind).alias("tags"), F.transform("v", lambda x: x["l_partkey"]).alias("node_ids"))
    k = F.col("node_id")
    coords = [(37 + ((k * 7919) % modulus) / 10000.0).alias("lat"), (-91 + ((k * 104729) % modulus) / 10000.0).alias("lon")]
    nodes = lineitem.select(F.col("l_partkey").alias("node_id")).distinct().select("node_id", *coords)
    return ways, nodes


_C = f"(select distinct {', '.join(_COLS)} from companies)"
_E = "(select distinct endpoint_id, state_key, lat, lon, osm_way_id, railway_type, spur_length_m, name, operator from spur_endpoints)"
_P = 'overture_places'
_OK = "{0}.lat between -90 and 90 and {0}.lon between -180 and 180 and not isnan({0}.lat) and not isnan({0}.lon) and not ({0}.lat = 0 and {0}.lon = 0)"
_WS = r"'[\s\x{00A0}\x{2000}-\x{200A}\x{3000}\x0B]'"


def _hav(a: str, b: str) -> str:
    return (
        f"2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"
    )


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _any(x: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains({x}, '{w}')" for w in words) + ")"


def _rule(x: str, table_: dict[str, list[str]]) -> str:
    return "case " + " ".join(f"when {_any(x, w)} then '{s}'" for s, w in table_.items()) + " else '' end"


def _sql_suffix(x: str) -> str:
    out = _strip(f"lower(coalesce({x}, ''))")
    steps, prev = [], f"select company_name, {out} as s0 from (select distinct company_name from companies)"
    for i, s in enumerate(SUFFIXES):
        prev = f"select *, case when ends_with(s{i}, '{s}') then {_strip(f'left(s{i}, length(s{i}) - {len(s)})')} else s{i} end as s{i + 1} from ({prev})"
    return f"select company_name, s{len(SUFFIXES)} as norm_suffix from ({prev})"


_LEGAL = r"\b(?:incorporated|inc|llc|l\.l\.c|corp|corporation|co|company|ltd|limited|lp|l\.p|plc|p\.l\.c|pllc)\b\.?"


def _sql_words(x: str) -> str:
    out = rf"regexp_replace({_strip(f'lower(coalesce({x}, {chr(39) * 2}))')}, '{_LEGAL}', ' ', 'g')"
    out = rf"regexp_replace({out}, '[^\pL\pM\pN_\s]', ' ', 'g')"
    return _strip(rf"regexp_replace({out}, '\s{{2,}}', ' ', 'g')")


def norm_names(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "companies").select("company_name").distinct()
    c = F.col("company_name")
    return n.select(c, norm_suffix(c).alias("norm_suffix"), norm_words(c).alias("norm_words"), norm_brand(c).alias("norm_brand"))


def rail_tag_filter(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "spur_endpoints")
    tags = F.create_map(F.lit("railway"), F.col("railway_type"), F.lit("service"), F.col("tags")["service"])
    return e.where(network.is_spur_or_siding(tags)).select("endpoint_id").distinct()


def spur_siding_counts(spark: SparkSession, d: str) -> DataFrame:
    return network.track_counts(_ends(spark, d), F.col("railway_type"))


def residual_tags(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "spur_endpoints").select("endpoint_id", network.residual_tags(F.col("tags")).alias("t"))
    return e.select("endpoint_id", F.size("t").alias("n_tags"), F.array_join(F.array_sort(F.map_keys("t")), ",").alias("keys")).distinct()


def endpoint_length_filter(spark: SparkSession, d: str) -> DataFrame:
    return network.within_length(_ends(spark, d)).select("endpoint_id", "spur_length_m")


def longest_tracks(spark: SparkSession, d: str) -> DataFrame:
    """Top-k report of the longest tracks."""
    return network.longest(_ends(spark, d).select("osm_way_id", "spur_length_m").where("spur_length_m is not null").distinct(), 25)


def way_geometry(spark: SparkSession, d: str) -> DataFrame:
    w = network.resolve_coords(*ways_of_orders(table(spark, d, "lineitem")))
    c = centroid(F.col("coords"))
    return w.select("way_id", F.size("coords").alias("n_vertices"), F.round(polyline_length(F.col("coords")), 3).alias("metres"), F.round(c["lat"], 8).alias("lat"), F.round(c["lon"], 8).alias("lon"))


def junctions(spark: SparkSession, d: str) -> DataFrame:
    return network.junction_nodes(ways_of_orders(table(spark, d, "lineitem"))[0])


def facility_ends(spark: SparkSession, d: str) -> DataFrame:
    e = network.facility_ends(*ways_of_orders(table(spark, d, "lineitem")))
    return e.select("osm_way_id", "railway_type", "connected_to_mainline", "endpoint_method", F.round("lat", 8).alias("lat"), F.round("lon", 8).alias("lon"))


def own_end_distance(spark: SparkSession, d: str) -> DataFrame:
    c, e = _companies(spark, d), _ends(spark, d).select("osm_way_id", F.col("lat").alias("elat"), F.col("lon").alias("elon"))
    c = c.where(usable_position(F.col("lat"), F.col("lon"))).join(e.where(usable_position(F.col("elat"), F.col("elon"))), "osm_way_id")
    return c.select("row_id", "osm_way_id", F.round(haversine(F.col("elat"), F.col("elon"), F.col("lat"), F.col("lon")), 3).alias("metres"))


def _matches(spark: SparkSession, d: str) -> DataFrame:
    return proximity.matches_within(_ends(spark, d).select("endpoint_id", "lat", "lon"), _places(spark, d), 500.0, end_id="endpoint_id", place_id="place_id")


def proximity_matches(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d).select("endpoint_id", "place_id", F.round("metres", 3).alias("metres"))


def nearest_place(spark: SparkSession, d: str) -> DataFrame:
    n = proximity.nearest_place(_matches(spark, d), "endpoint_id", "place_id")
    return n.select("endpoint_id", "place_id", F.round("metres", 3).alias("metres"))


def named_nearest(spark: SparkSession, d: str) -> DataFrame:
    n = proximity.named_nearest(_ends(spark, d).select("endpoint_id", "lat", "lon"), _places(spark, d), 500.0, end_id="endpoint_id", place_id="place_id", name="name")
    return n.select("endpoint_id", "place_id", "name")


def top3_places(spark: SparkSession, d: str) -> DataFrame:
    return proximity.top_k(_matches(spark, d), "endpoint_id", [F.col("metres"), F.col("place_id")], 3).select("endpoint_id", "place_id", "rank")


def best_feature(spark: SparkSession, d: str) -> DataFrame:
    return proximity.last_of_best_rank(_companies(spark, d), "osm_way_id", F.coalesce(F.col("confidence") == "HIGH", F.lit(False)), "row_id", ["row_id", "company_name"])


def cascade_passes(spark: SparkSession, d: str) -> DataFrame:
    """Ends by the first pass that matches them: a usable place, a place, a company row."""
    ends = _ends(spark, d).select("endpoint_id", "lat", "lon")
    usable = overture_places(table(spark, d, "overture_places")).select("place_id").distinct()
    places = _places(spark, d)
    rows = _companies(spark, d).select(F.col("row_id").alias("place_id"), "lat", "lon")
    find = lambda p, r: lambda e: proximity.matches_within(e, p, r, end_id="endpoint_id", place_id="place_id").select("endpoint_id").distinct()
    return proximity.cascade(ends, [find(places.join(usable, "place_id", "left_semi"), 250.0), find(places, 250.0), find(rows, 250.0)], "endpoint_id")


def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    c = _companies(spark, d)
    keys = [F.col("company_name"), dedup.half_even(F.col("lat"), 6), dedup.half_even(F.col("lon"), 6)]
    return dedup.first_by(c, keys, [F.col("row_id")]).select("row_id")


def _row_score() -> list[Column]:
    """Rows with a town first, then those with a sector, then by source."""
    filled = lambda x: F.when(F.trim(F.coalesce(F.col(x), F.lit(""))) != "", 0).otherwise(1)
    source = F.trim(F.coalesce(F.col("source"), F.lit("")))
    return [filled("city"), filled("sector_guess"), F.when(source == "osm_batch", 0).when(source == "overture", 1).when(source == "nominatim", 2).otherwise(9)]


def city_dedup(spark: SparkSession, d: str) -> DataFrame:
    c = _companies(spark, d)
    loc = dedup.location_key(F.col("city"), F.col("lat"), F.col("lon"), F.col("state_key"))
    kept = dedup.first_by(c.withColumns({"norm": norm_words(F.col("company_name")), "loc": loc}), [F.col("norm"), F.col("loc")], [*_row_score(), F.col("row_id")])
    return kept.select("row_id", "norm", "loc")


def endpoint_dedup_50m(spark: SparkSession, d: str) -> DataFrame:
    ends = _ends(spark, d).where(usable_position(F.col("lat"), F.col("lon")))
    return dedup.leader_dedup(ends, "endpoint_id", [-F.coalesce("spur_length_m", F.lit(0.0))], 50.0).select("endpoint_id")


def company_dedup_200m(spark: SparkSession, d: str) -> DataFrame:
    c = _companies(spark, d).where(usable_position(F.col("lat"), F.col("lon"))).withColumn("norm", norm_suffix(F.col("company_name")))
    rank = F.when(F.col("confidence") == "HIGH", 0).when(F.col("confidence") == "MEDIUM", 1).when(F.col("confidence") == "LOW", 2).otherwise(3)
    return dedup.leader_dedup(c, "row_id", [rank, -F.coalesce("spur_length_m", F.lit(0.0))], 200.0, group="norm").select("row_id")


def proximity_dedup_100m(spark: SparkSession, d: str) -> DataFrame:
    c = _companies(spark, d).withColumn("norm", norm_words(F.col("company_name")))
    return dedup.leader_dedup(c, "row_id", _row_score(), 100.0, group="norm", inclusive=True).select("row_id")


def labels(spark: SparkSession, d: str) -> DataFrame:
    """Sector, name class, quality, value and junk labels of the company rows."""
    c = _companies(spark, d)
    name, kind = F.col("company_name"), F.col("facility_type")
    return c.select(
        "row_id",
        rules.sector_by_name(name).alias("sector_small"),
        rules.sector_by_name(name, rules.PLACE_SECTORS).alias("sector_places"),
        rules.sector_by_words(name, kind, rules.SECTORS).alias("sector_words"),
        rules.sector_by_category(kind).alias("sector_category"),
        rules.layered_sector(F.col("sector_guess"), rules.sector_by_words(name, kind, rules.SECTORS), rules.sector_by_category(kind)).alias("sector"),
        rules.name_class(name).alias("name_class"),
        rules.data_quality(name, F.col("city"), F.col("state")).alias("quality"),
        rules.facility_value(kind).alias("facility_value"),
        rules.is_industrial(name).alias("industrial"),
    )


def junk_reasons(spark: SparkSession, d: str) -> DataFrame:
    c = _companies(spark, d)
    return c.groupBy(rules.junk_reason(F.col("company_name")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def place_labels(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "overture_places")
    name, cat = F.col("names.primary"), F.col("categories.primary")
    types = F.array(F.coalesce(cat, F.lit("")))
    return p.select("place_id", rules.category_text(cat).alias("category"), rules.overture_confidence(name, cat).alias("confidence"), rules.place_confidence(name, types, F.lit("Steel")).alias("place_confidence"), rules.is_rail_category(cat).alias("rail"))


def poi_labels(spark: SparkSession, d: str) -> DataFrame:
    """Name, confidence and kind of map features made of the company rows."""
    c = _companies(spark, d)
    tags = F.create_map(
        F.lit("name"), F.when(F.col("row_id") % 5 != 0, F.col("company_name")), F.lit("operator"), F.col("source"),
        F.lit("building"), F.when(F.col("facility_type").isin("warehouse", "brewery"), F.col("facility_type")),
        F.lit("man_made"), F.when(F.col("facility_type") == "grain elevator", "silo"), F.lit("landuse"), F.when(F.col("facility_type") == "quarry", "industrial"),
    )
    f = rules.feature_class(F.col("t"))
    return c.select("row_id", tags.alias("t")).select("row_id", rules.poi_name(F.col("t")).alias("name"), rules.poi_confidence(F.col("t")).alias("confidence"), rules.poi_kind(F.col("t")).alias("kind"), f["confidence"].alias("class"), f["kind"].alias("class_kind"))


def address_split(spark: SparkSession, d: str) -> DataFrame:
    a = _companies(spark, d).select("row_id", address_parts(F.col("address")).alias("p"))
    return a.select("row_id", "p.city", "p.state", "p.zip")


def _known(spark: SparkSession, d: str, normal: bool = False) -> list[str]:
    return known.known_names(table(spark, d, "known_accounts"), "company", normal)


def flag_known(spark: SparkSession, d: str) -> DataFrame:
    return known.flag_known(_companies(spark, d).select("row_id", "company_name"), "company_name", _known(spark, d), "known").select("row_id", "known")


def _found(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "companies").select(norm_suffix(F.col("company_name")).alias("name")).where("name <> ''").distinct()


def validation_counts(spark: SparkSession, d: str) -> DataFrame:
    return known.validation(_found(spark, d), _known(spark, d, True))


def validation_pairs(spark: SparkSession, d: str) -> DataFrame:
    return known.fuzzy_pairs(_found(spark, d), _known(spark, d, True))


def validation_missed(spark: SparkSession, d: str) -> DataFrame:
    return known.missed_known(_found(spark, d), _known(spark, d, True))


def merge_new_rows(spark: SparkSession, d: str) -> DataFrame:
    c = _companies(spark, d)
    return merge.new_rows(c.where("source <> 'overture' or source is null"), c.where("source = 'overture'")).select("row_id")


def union_regions(spark: SparkSession, d: str) -> DataFrame:
    c = _companies(spark, d).select("row_id", "state_key", "source")
    parts = {s: c.where(F.col("source") == s).drop("state_key") for s in ("google_places", "nominatim", "osm", "osm_batch", "overture")}
    return merge.union_regions(parts, "feed").groupBy("feed").agg(F.count(F.lit(1)).alias("n"))


def verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts for every third row in place of remote answers."""
    c = _companies(spark, d).select("row_id", "sector_guess")
    v = c.where("row_id % 3 = 0").select("row_id", (F.col("row_id") % 2 == 0).alias("keep"), F.lit("Logistics").alias("sector"))
    return merge.apply_verdicts(c, v, "row_id", "sector_guess").select("row_id", "keep", "sector_guess")


def verdict_batches(spark: SparkSession, d: str) -> DataFrame:
    return merge.batches(_companies(spark, d).select("row_id", "company_name"), "row_id", "company_name", 50).select("batch", "key")


def parsed_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels out of answers made of the events: their type at the position that their property names."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    answer = F.concat(F.lit("```json\n{\""), k, F.lit("\": \""), F.col("event_type"), F.lit("\", \"x\": \"click\"}\n```"))
    return merge.parse_labels(e.select("event_id", answer.alias("a")), "event_id", "a", ["click", "view", "Unknown"], 50)


def overture_scan(spark: SparkSession, d: str) -> DataFrame:
    return overture_places(table(spark, d, "overture_places")).select("place_id", "name", "category", "address", "city", "state", "postcode")


def latest_ends(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "spur_endpoints").select("endpoint_id", "extracted_at", "railway_type", "spur_length_m")
    return latest(e, "endpoint_id", "extracted_at").select("endpoint_id", "railway_type", "spur_length_m")


def source_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.value_counts(_companies(spark, d), F.coalesce("source", F.lit("")), "source")


def top_names(spark: SparkSession, d: str) -> DataFrame:
    """Top-k report of frequent names."""
    return reports.top_values(_companies(spark, d).where("company_name is not null"), F.col("company_name"), "company_name", 20)


def source_bad_rate(spark: SparkSession, d: str) -> DataFrame:
    return reports.bad_rate(_companies(spark, d), "source", rules.name_quality(F.col("company_name")) != "real")


def region_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.region_summary(_companies(spark, d), "state_key")


def sector_change(spark: SparkSession, d: str) -> DataFrame:
    c = _companies(spark, d)
    return reports.compare_counts(reports.sector_counts(c), reports.sector_counts(c.where("city is not null")), "sector")


def unclassified_share(spark: SparkSession, d: str) -> DataFrame:
    return reports.unclassified_share(_companies(spark, d))


def run_totals(spark: SparkSession, d: str) -> DataFrame:
    stats = _companies(spark, d).groupBy("state_key").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("in_existing_list").alias("n_known"))
    return reports.run_totals(stats, F.col("n_known") > 0, ["n_rows", "n_known"])


def spot_check(spark: SparkSession, d: str) -> DataFrame:
    """Top-k report: the first names of one sector."""
    c = _companies(spark, d).where("sector_guess = 'Metals' and company_name is not null")
    return reports.spot_check(c, norm_suffix(F.col("company_name")), F.col("company_name"), 15).select("first")


def sampled_rows(spark: SparkSession, d: str) -> DataFrame:
    """A repeatable sample of twenty rows."""
    return reports.hashed_sample(_companies(spark, d), "row_id", 20).select("row_id")


QUERIES = {
    f.__name__: f
    for f in (
        norm_names, rail_tag_filter, spur_siding_counts, residual_tags, endpoint_length_filter, longest_tracks, way_geometry, junctions, facility_ends, own_end_distance,
        proximity_matches, nearest_place, named_nearest, top3_places, best_feature, cascade_passes, exact_dedup, city_dedup, endpoint_dedup_50m, company_dedup_200m,
        proximity_dedup_100m, labels, junk_reasons, place_labels, poi_labels, address_split, flag_known, validation_counts, validation_pairs, validation_missed,
        merge_new_rows, union_regions, verdicts, verdict_batches, parsed_labels, overture_scan, latest_ends, source_counts, top_names, source_bad_rate, region_summary,
        sector_change, unclassified_share, run_totals, spot_check, sampled_rows,
    )
}

_WAYS = """v as (select l_orderkey as way_id, l_partkey as node_id, l_returnflag,
        row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as seq from lineitem),
  c as (select *, 37 + ((node_id * 7919) % 5000) / 10000.0::double as lat, -91 + ((node_id * 104729) % 5000) / 10000.0::double as lon from v),
  w as (select way_id, count(*) as n, arg_min(l_returnflag, seq) as flag, arg_min(node_id, seq) as a, arg_max(node_id, seq) as b,
        arg_min(lat, seq) as alat, arg_min(lon, seq) as alon, arg_max(lat, seq) as blat, arg_max(lon, seq) as blon, avg(lat) as mlat, avg(lon) as mlon from c group by 1),
  j as (select node_id, count(*) as n_ends from (select a as node_id from w union all select b from w) group by 1 having count(*) >= 2)"""
_UNKNOWN = "coalesce(" + _strip("lower({0})") + " in ('', 'unknown', 'nan'), true)"
_CLASS = (
    rf"case when {{0}} = '' then 'empty' when regexp_matches({{0}}, '^-?\d+(?:\.\d+)?(?:,\s*-?\d+(?:\.\d+)?)?$') then 'numeric' when regexp_matches({{0}}, '^\d+$|^.{{{{0,2}}}}$') then 'trivial' "
    rf"when regexp_matches({{0}}, '(?i)^(?:node|way|relation)\s*\d+') then 'osm_tag' when regexp_matches({{0}}, '(?i)\b(?:{rules.GEO_WORDS})\b') then 'geo_keyword' else 'real' end"
)
_N = _strip("coalesce(company_name, '')")
_CLS = _CLASS.format(f"strip_accents({_N})")  # word boundaries are of ASCII letters there
_LN = "lower(coalesce(company_name, ''))"
_WORDS = "lower(concat_ws(' ', coalesce(company_name, 'nan'), coalesce(facility_type, 'nan')))"
_CATKEY = f"replace({_strip('lower(facility_type)')}, ' ', '_')"
_CAT = "case " + " ".join(f"when {_CATKEY} = '{k}' then '{v}'" for k, v in rules.CATEGORY_SECTORS.items()) + " else '' end"
_RAIL = "coalesce(lower(categories.primary) in (" + ", ".join(f"'{c}'" for c in rules.RAIL_CATEGORIES) + "), false)"
_PIND = _any("lower(coalesce(names.primary, ''))", rules.INDUSTRIAL)

def _wkb(at: int) -> str:
    """A double of a little-endian point, from its hexadecimal digits."""
    digits = " || ".join(f"substr(hex(geometry), {at + i}, 2)" for i in range(14, -1, -2))
    top, frac = f"('0x' || substr({digits}, 1, 3))::bigint", f"('0x' || substr({digits}, 4, 13))::bigint"
    return f"(case when {top} >= 2048 then -1.0::double else 1.0::double end) * (1.0::double + {frac} / 4503599627370496.0::double) * pow(2.0::double, ({top} % 2048) - 1023)"


_SPOT = f"(select place_id, names.primary as name, coalesce({_wkb(27)}, bbox.ymin) as lat, coalesce({_wkb(11)}, bbox.xmin) as lon, ({_RAIL} or {_PIND}) as ok from {_P})"
_NEAR = f"""near as (select e.endpoint_id, p.place_id, p.name, {_hav('e', 'p')} as metres
  from {_E} e join {_SPOT} p
    on p.lat between e.lat - 0.0046 and e.lat + 0.0046 and {_hav('e', 'p')} <= 500 where {_OK.format('e')} and {_OK.format('p')})"""
_KEY = "lower(" + _strip("coalesce(company_name, '')") + ")"


def _round(x: str, n: int) -> str:
    return f"round_even({x} * 1e{n}, 0) / 1e{n}"


def _ROUND5(x: str) -> str:
    return f"case when isnan({x}) then null else {_round(x, 5)} end"


def _fold(src: str, group: str, order: str, near: str) -> str:
    """Leader dedup as a sequential fold over each group."""
    return f"""
select unnest(list_transform(kept, lambda k: k.id)) as ROWID from (
  select list_reduce(list_transform(a, lambda x: [x]), lambda acc, x: case when len(list_filter(acc, lambda k:
     2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians(x[1].lat - k.lat) / 2), 2) + cos(radians(k.lat)) * cos(radians(x[1].lat)) * pow(sin(radians(x[1].lon - k.lon) / 2), 2)))) {near})) > 0
     then acc else list_concat(acc, x) end) as kept
  from (select {group} as g, list({{'id': id, 'lat': lat, 'lon': lon}} order by {order}) as a from ({src}) group by 1))"""


ORACLE = {
    "norm_names": f"select a.company_name, a.norm_suffix, {_sql_words('a.company_name')} as norm_words, "
    + _strip(rf"regexp_replace(regexp_replace({_strip('lower(coalesce(a.company_name, chr(32)))')}, '[^\pL\pM\pN_\s]+$', ''), '\s{{2,}}', ' ', 'g')")
    + f" as norm_brand from ({_sql_suffix('company_name')}) a",
    "rail_tag_filter": "select distinct endpoint_id from spur_endpoints where railway_type in ('spur', 'siding') or (railway_type = 'rail' and tags['service'] in ('spur', 'siding'))",
    "spur_siding_counts": f"select count(*) filter (railway_type = 'spur') as spurs, count(*) filter (railway_type = 'siding') as sidings, count(*) as tracks from {_E}",
    "residual_tags": "select distinct endpoint_id, len(k) as n_tags, array_to_string(list_sort(k), ',') as keys from (select endpoint_id, list_filter(map_keys(tags), lambda x: x not in ('railway', 'name', 'operator')) as k from spur_endpoints)",
    "endpoint_length_filter": f"select endpoint_id, spur_length_m from {_E} where spur_length_m between 50 and 3000",
    "longest_tracks": "select distinct osm_way_id, spur_length_m from spur_endpoints where spur_length_m is not null order by spur_length_m desc, osm_way_id limit 25",
    "way_geometry": f"with {_WAYS}, s as (select way_id, sum({_hav('x', 'y').replace('x.', '').replace('y.lat', 'nlat').replace('y.lon', 'nlon')}) as m from (select way_id, lat, lon, lead(lat) over o as nlat, lead(lon) over o as nlon from c window o as (partition by way_id order by seq)) where nlat is not null group by 1) "
    "select w.way_id, w.n as n_vertices, round(m, 3) as metres, round(mlat, 8) as lat, round(mlon, 8) as lon from w join s using (way_id) where n >= 2",
    "junctions": f"with {_WAYS} select node_id, n_ends from j",
    "facility_ends": f"with {_WAYS}, m as (select w.*, a in (select node_id from j) as ja, b in (select node_id from j) as jb from w where n >= 2) "
    "select way_id as osm_way_id, case flag when 'A' then 'spur' when 'N' then 'siding' else 'rail' end as railway_type, ja or jb as connected_to_mainline, case when ja <> jb then 'mainline_exclusion' else 'midpoint' end as endpoint_method, "
    "round(case when ja and not jb then blat when jb and not ja then alat else mlat end, 8) as lat, round(case when ja and not jb then blon when jb and not ja then alon else mlon end, 8) as lon from m",
    "own_end_distance": f"select c.row_id, c.osm_way_id, round({_hav('e', 'c')}, 3) as metres from {_C} c join {_E} e using (osm_way_id) where {_OK.format('c')} and {_OK.format('e')}",
    "proximity_matches": f"with {_NEAR} select endpoint_id, place_id, round(metres, 3) as metres from near",
    "nearest_place": f"with {_NEAR} select endpoint_id, arg_min(place_id, (metres, place_id)) as place_id, round(min(metres), 3) as metres from near group by 1",
    "named_nearest": f"with {_NEAR} select * from (select endpoint_id, arg_min(place_id, (metres, place_id)) as place_id, arg_min(coalesce(name, ''), (metres, place_id)) as name from near group by 1) where name <> ''",
    "top3_places": f"with {_NEAR} select endpoint_id, place_id, rank from (select *, row_number() over (partition by endpoint_id order by metres, place_id) as rank from near) where rank <= 3",
    "best_feature": f"select osm_way_id, arg_max(row_id, (coalesce(confidence = 'HIGH', false), row_id)) as row_id, arg_max(coalesce(company_name, '~null'), (coalesce(confidence = 'HIGH', false), row_id)) as company_name from {_C} group by 1".replace("arg_max(coalesce(company_name, '~null'),", "nullif(arg_max(coalesce(company_name, '~null'),").replace("row_id)) as company_name", "row_id)), '~null') as company_name"),
    "cascade_passes": f"""with e as (select * from {_E} e where {_OK.format('e')}), p as (select place_id, lat, lon, ok from {_SPOT}),
 pp as (select * from p where {_OK.format('p')}), c as (select row_id, lat, lon from {_C} c where {_OK.format('c')}),
 m1 as (select distinct endpoint_id from e join pp on pp.lat between e.lat - 0.0024 and e.lat + 0.0024 and {_hav('e', 'pp')} <= 250 where ok),
 m2 as (select distinct endpoint_id from e join pp on pp.lat between e.lat - 0.0024 and e.lat + 0.0024 and {_hav('e', 'pp')} <= 250),
 m3 as (select distinct endpoint_id from e join c on c.lat between e.lat - 0.0024 and e.lat + 0.0024 and {_hav('e', 'c')} <= 250)
 select endpoint_id, min(pass) as pass from (select endpoint_id, 1 as pass from m1 union all select endpoint_id, 2 from m2 union all select endpoint_id, 3 from m3) group by 1""",
    "exact_dedup": f"select row_id from (select row_id, row_number() over (partition by company_name, {_round('lat', 6)}, {_round('lon', 6)} order by row_id) as rn from {_C}) where rn = 1",
    "city_dedup": f"""select row_id, norm, loc from (select *, row_number() over (partition by norm, loc order by case when trim(coalesce(city, '')) <> '' then 0 else 1 end, case when trim(coalesce(sector_guess, '')) <> '' then 0 else 1 end,
  case source when 'osm_batch' then 0 when 'overture' then 1 when 'nominatim' then 2 else 9 end, row_id) as rn from (select *, {_sql_words('company_name')} as norm,
  case when lower(trim(coalesce(city, ''))) <> '' then lower(trim(city)) when lat is not null and lon is not null and not isnan(lat) and not isnan(lon) then 'grid:' || trunc(lat / 0.045)::int || ',' || trunc(lon / 0.045)::int
  else lower(trim(coalesce(state_key, ''))) end as loc from {_C})) where rn = 1""",
    "endpoint_dedup_50m": _fold(f"select endpoint_id as id, lat, lon, coalesce(spur_length_m, 0) as len from {_E} e where {_OK.format('e')}", "1", "len desc, id", "< 50").replace("ROWID", "endpoint_id"),
    "company_dedup_200m": _fold(
        f"select c.row_id as id, c.lat, c.lon, n.norm_suffix as norm, case confidence when 'HIGH' then 0 when 'MEDIUM' then 1 when 'LOW' then 2 else 3 end as r, coalesce(spur_length_m, 0) as len from {_C} c join ({_sql_suffix('company_name')}) n on n.company_name is not distinct from c.company_name where {_OK.format('c')}",
        "norm", "r, len desc, id", "< 200").replace("ROWID", "row_id"),
    "proximity_dedup_100m": _fold(
        f"select row_id as id, lat, lon, {_sql_words('company_name')} as norm, case when trim(coalesce(city, '')) <> '' then 0 else 1 end as r, case when trim(coalesce(sector_guess, '')) <> '' then 0 else 1 end as r2, case source when 'osm_batch' then 0 when 'overture' then 1 when 'nominatim' then 2 else 9 end as r3 from {_C} c where {_OK.format('c')}", "norm", "r, r2, r3, id", "<= 100").replace("ROWID", "row_id")
    + f" union all select row_id from {_C} c where not coalesce({_OK.format('c')}, false)",
    "labels": f"""select row_id, {_rule(_LN, rules.SECTORS)} as sector_small, {_rule(_LN, rules.PLACE_SECTORS)} as sector_places, {_rule(_WORDS, rules.SECTORS)} as sector_words, {_CAT} as sector_category,
  coalesce(case when not {_UNKNOWN.format('sector_guess')} then sector_guess end, nullif({_rule(_WORDS, rules.SECTORS)}, ''), nullif({_CAT}, ''), '') as sector, {_CLS} as name_class,
  case when {_CLS} not in ('empty', 'real') then 'low_quality_name' when {_strip("coalesce(city, '')")} = '' or {_strip("coalesce(state, '')")} = '' then 'no_location' else 'complete' end as quality,
  case when facility_type in ('yes', 'roof') then 'building' when facility_type = 'poi' then 'point_of_interest' else facility_type end as facility_value, {_any(_LN, rules.INDUSTRIAL)} as industrial from {_C}""",
    "place_labels": f"""select place_id, coalesce(replace(nullif(categories.primary, ''), '_', ' '), 'overture_poi') as category, case when {_PIND} or {_RAIL} then 'HIGH' else 'MEDIUM' end as confidence,
  case when coalesce(categories.primary, '') in ({', '.join(repr(t) for t in rules.OTHER_TYPES)}) and not {_any("lower(coalesce(names.primary, ''))", rules.PLACE_WORDS)} then 'LOW'
  when coalesce(categories.primary, '') in ('industrial', 'storage', 'warehouse') or {_any("lower(coalesce(names.primary, ''))", rules.PLACE_WORDS)} then 'HIGH' when contains(lower(coalesce(names.primary, '')), 'steel') then 'HIGH' else 'MEDIUM' end as place_confidence, {_RAIL} as rail from {_P}""",
    "poi_labels": f"""with t as (select row_id, case when row_id % 5 <> 0 then company_name end as n, source as o, case when facility_type in ('warehouse', 'brewery') then facility_type end as b, case when facility_type = 'grain elevator' then 'silo' end as m,
  case when facility_type = 'quarry' then 'industrial' end as l from {_C}), u as (select *, coalesce(nullif(n, ''), nullif(o, ''), '') as name from t)
 select row_id, name, case when {_any('lower(name)', rules.INDUSTRIAL)} or m is not null or coalesce(b, '') in ('industrial', 'warehouse') then 'HIGH' else 'MEDIUM' end as confidence, coalesce(m, b, l, 'poi') as kind,
  case when {_any("lower(coalesce(n, ''))", [w for w in rules.INDUSTRIAL if w not in ('silo', 'tank')])} or m = 'silo' or coalesce(b, '') in ('industrial', 'warehouse', 'commercial') or coalesce(l, '') = 'industrial' then 'HIGH' else 'MEDIUM' end as class,
  case when {_any("lower(coalesce(n, ''))", [w for w in rules.INDUSTRIAL if w not in ('silo', 'tank')])} or m = 'silo' then coalesce(m, b, l, 'industrial') when coalesce(b, '') in ('industrial', 'warehouse', 'commercial') or coalesce(l, '') = 'industrial' then coalesce(b, l) when b is not null then b else 'poi' end as class_kind from u""",
    "address_split": rf"""select row_id, case when ok then p[-3] else '' end as city, case when ok then coalesce(r[1], '') else '' end as state, case when ok then coalesce(r[2], '') else '' end as zip from (
  select *, len(p) >= 3 as ok, regexp_split_to_array(p[-2], '\s+') as r from (select row_id, list_transform(string_split(coalesce(address, ''), ','), lambda x: {_strip('x')}) as p from {_C}))""",
    "flag_known": f"""with k as (select distinct {_strip('lower(company)')} as k from known_accounts where {_strip('lower(company)')} <> ''), n as ({_sql_suffix('company_name')}),
 f as (select n.company_name, exists (select 1 from k where contains(n.norm_suffix, k.k) or contains(k.k, n.norm_suffix)) as known from n) select c.row_id, f.known from {_C} c join f on f.company_name is not distinct from c.company_name""",
    "merge_new_rows": f"select row_id from {_C} a where source = 'overture' and not exists (select 1 from {_C} b where (b.source <> 'overture' or b.source is null) and lower({_strip(chr(99)+'oalesce(b.company_name, '+chr(39)*2+')')}) = lower({_strip('coalesce(a.company_name, '+chr(39)*2+')')}) and {_ROUND5('b.lat')} is not distinct from {_ROUND5('a.lat')} and {_ROUND5('b.lon')} is not distinct from {_ROUND5('a.lon')})",
    "union_regions": f"select source as feed, count(*) as n from {_C} where source in ('google_places', 'nominatim', 'osm', 'osm_batch', 'overture') group by 1",
    "verdicts": f"select row_id, case when row_id % 3 = 0 then (case when row_id % 2 = 0 then 'true' else 'false' end) else 'true' end as keep, case when row_id % 3 = 0 and {_UNKNOWN.format('sector_guess')} then 'Logistics' else sector_guess end as sector_guess from {_C}",
    "verdict_batches": f"select row_id // 50 as batch, left(sha256(string_agg(row_id || ': ' || coalesce(company_name, ''), chr(10) order by row_id, company_name)), 16) as key from {_C} group by 1",
    "parsed_labels": "select event_id, k as idx, case when event_type in ('click', 'view') then event_type else 'Unknown' end as label from (select *, (props->>'$.k')::int as k from events) where k between 0 and 49 and event_type is not null",
    "overture_scan": f"select place_id, names.primary as name, categories.primary as category, addresses[1].freeform as address, addresses[1].locality as city, addresses[1].region as state, addresses[1].postcode as postcode from {_P} where ({_RAIL} or {_PIND}) and (geometry is not null or (bbox.ymin <> 0 and bbox.xmin <> 0))",
    "latest_ends": "select endpoint_id, railway_type, spur_length_m from (select *, row_number() over (partition by endpoint_id order by extracted_at desc) as rn from spur_endpoints) where rn = 1",
    "source_counts": f"select coalesce(source, '') as source, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 1) as share from {_C} group by 1",
    "top_names": f"select company_name, count(*) as n from {_C} where company_name is not null group by 1 order by 2 desc, 1 limit 20",
    "source_bad_rate": f"select source, count(*) as total, count(*) filter ({_CLS} <> 'real') as bad, round(count(*) filter ({_CLS} <> 'real') / count(*) * 100, 1) as rate from {_C} where source is not null group by 1",
    "region_summary": f"select state_key, count(*) as n_rows, count(*) filter (coalesce(confidence, 'LOW') = 'HIGH') as high, count(*) filter (coalesce(confidence, 'LOW') = 'MEDIUM') as medium, count(*) filter (coalesce(confidence, 'LOW') = 'LOW') as low, count(*) filter (coalesce(in_existing_list, false)) as known, count(distinct nullif(trim(sector_guess), '')) as sectors from {_C} group by 1",
    "sector_change": f"with a as (select coalesce(nullif(sector_guess, ''), 'Unknown') as sector, count(*) as b, count(*) filter (city is not null) as f from {_C} group by 1) select sector, b as before, f as after, f - b as change from a",
    "unclassified_share": f"select count(*) as n_rows, count(*) filter ({_UNKNOWN.format('sector_guess')}) as unclassified, round(100.0 * count(*) filter ({_UNKNOWN.format('sector_guess')}) / count(*), 1) as share from {_C}",
    "run_totals": f"with s as (select state_key, count(*) as r, count(*) filter (in_existing_list) as k from {_C} group by 1) select count(*) filter (k > 0) as n_ok, count(*) filter (k <= 0) as n_failed, coalesce(sum(r) filter (k > 0), 0)::bigint as n_rows, coalesce(sum(k) filter (k > 0), 0)::bigint as n_known from s",
    "sampled_rows": f"select row_id from {_C} order by md5(row_id::varchar), row_id limit 20",
}

_V = "f as (select distinct norm_suffix as name from ({0}) where norm_suffix <> ''), k as (select distinct norm_suffix as known from ({1}) where norm_suffix <> '')".format(
    _sql_suffix("company_name"), _sql_suffix("company_name").replace("(select distinct company_name from companies)", "(select distinct company as company_name from known_accounts)")
)
ORACLE |= {
    "validation_counts": f"with {_V}, m as (select name, exists (select 1 from k where known = name) as e, exists (select 1 from k where contains(name, known) or contains(known, name)) as a from f) select count(*) as n_names, (select count(*) from k) as n_known, count(*) filter (e) as n_exact, count(*) filter (a) as n_matched, count(*) filter (not a) as n_new from m",
    "validation_pairs": f"with {_V} select name, known from f, k where name <> known and (contains(name, known) or contains(known, name))",
    "validation_missed": f"with {_V} select known from k where not exists (select 1 from f where contains(name, known) or contains(known, name))",
    "spot_check": f"with n as ({_sql_suffix('company_name')}) select min(c.company_name) as first from {_C} c join n using (company_name) where sector_guess = 'Metals' group by n.norm_suffix order by 1 limit 15",
}

_J = "strip_accents(" + _N + ")"


def _full(pattern: str) -> str:
    return f"regexp_matches({_J}, '(?i)^(?:{pattern})$')"


_TAIL = r"[\w\s\-\.;]*"
_ROAD_SQL = " or ".join(
    _full(p)
    for p in (
        rf"(US|U\.S\.)\s*[-#]?\s*\d+{_TAIL}", rf"I\s*-?\s*\d+{_TAIL}", rf"Interstate\s+\d+{_TAIL}", rf"(State\s+(Route|Highway|Road)|SR|SH)\s*[-#]?\s*\d+{_TAIL}",
        r"(County\s+(Road|Route|Highway)|CR)\s*[-#]?\s*[A-Z0-9][\w\.\-;]*", rf"(FM|RM|(Ranch|Farm)\s+(to\s+Market|Road))\s*[-#]?\s*\d+{_TAIL}", rf"(Highway|Hwy)\s+\d+{_TAIL}",
        rf"(Route|RTE?)\s+\d+{_TAIL}", rf"({rules.STATES})\s*-?\s*\d+{_TAIL}", r"(Business|Loop|Spur|Alt|Alternate|Business\s+Loop)\s+(US|I|Highway|Hwy|Route)\s*[-#]?\s*\d+.*",
        r"(US|I-|SR|FM|CR|RM|Highway|Hwy)\s*\d[\w\s\-]*(;\s*(US|I-|SR|SH|FM|CR|RM|[A-Z]{2})\s*-?\s*\d[\w\s\-]*)+", r"(Truck\s+Route|Access\s+Road\s*[A-Z0-9]*|Service\s+Road)\s*\d*",
    )
)
_QUOTED = [p.replace("'", "''") for p in (rf"\d+(?:st|nd|rd|th)\s+(?:street|ave|avenue|road|drive|blvd|boulevard|place|lane|way|court)|(?:\d+\s+)?[\w\s\-'\.]+\s+(?:{rules.STREETS})", rf"[\w\s\-'\.]+\s+(?:{rules.DISTRICTS})")]
_REASON = f"""case when {_N} = '' then 'empty' when regexp_matches({_J}, '(?i)\\b(?:{rules.SAFE_WORDS})\\b') then '' when {_full(r"\d+(?:\.\d+)?")} then 'number'
  when length({_N}) <= 2 and upper({_N}) not in ({', '.join(repr(x) for x in rules.SHORT_FIRMS)}) then 'short' when {_full(rules.GENERIC)} then 'generic' when {_ROAD_SQL} then 'highway' when {_full(_QUOTED[0])} then 'street' when {_full(_QUOTED[1])} then 'district' else '' end"""
ORACLE |= {"junk_reasons": f"select {_REASON} as reason, count(*) as n from {_C} group by 1"}
