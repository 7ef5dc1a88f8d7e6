"""Registered queries of the operators for training data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklore.llm.addresses import address_pairs
from tracklore.llm.canonical import canonicalise_fields
from tracklore.llm.domain import FACILITY_STOP, STATE_STOP, facility_entries, state_entries
from tracklore.llm.leaks import leaked_items
from tracklore.llm.linkage import facility_matches
from tracklore.llm.names import name_pairs
from tracklore.llm.packing import pack, packing_report, token_counts
from tracklore.llm.residue import residue_evidence
from tracklore.llm.survivors import source_quality, survivors, truths
from tracklore.llm.textnorm import PLACEHOLDERS
from tracklore.session import table
from tracklore.sources.io import with_point


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed states and facility types with the entry that is meant, or UNMATCHED."""
    companies = table(spark, sf_dir, "companies")
    regions, types = table(spark, sf_dir, "state_regions"), table(spark, sf_dir, "facility_types")
    code = F.explode(F.array("state_code", "state_name"))
    fields = {
        "state": (state_entries(regions), regions.select(code.alias("value"), F.col("state_code").alias("entry"))),
        "facility_type": (facility_entries(types), types.select(F.col("facility_type").alias("value"), F.col("facility_type").alias("entry"))),
    }
    of = lambda k: reduce(DataFrame.unionByName, (t[k].withColumn("field", F.lit(f)) for f, t in fields.items()))
    entries, exact = of(0), of(1).distinct()
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields)))
    typed = companies.select("row_id", F.col("osm_way_id").alias("thing"), each.alias("typed")).select("row_id", "thing", "typed.*").where(F.length(F.trim("value")) > 0)
    mapped = canonicalise_fields(typed.drop("row_id"), exact, entries, {"state": (STATE_STOP, False), "facility_type": (FACILITY_STOP, True)})
    rows = typed.select("row_id", "field", "value").distinct().join(mapped, ["field", "value"])
    return rows.select("row_id", F.col("field").alias("field_name"), "canonical")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of company rows of different track ends at one street location."""
    return address_pairs(table(spark, sf_dir, "companies"), "row_id", "osm_way_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of company rows of one organisation under different spellings."""
    return name_pairs(table(spark, sf_dir, "companies"), "row_id", "company_name", "osm_way_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City and sector of the surviving record of each facility with several rows."""
    return survivors(
        table(spark, sf_dir, "companies"),
        table(spark, sf_dir, "source_audit"),
        group="osm_way_id",
        record="row_id",
        source="source",
        date="discovery_date",
        fields=["city", "sector_guess"],
    )


def p5_truths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sectors judged true of each facility."""
    return truths(table(spark, sf_dir, "companies"), table(spark, sf_dir, "source_audit"), group="osm_way_id", source="source", field="sector_guess")


def p5_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred quality of each source by field."""
    return source_quality(table(spark, sf_dir, "companies"), table(spark, sf_dir, "source_audit"), group="osm_way_id", source="source", fields=["city", "sector_guess"])


def place_rows(places: DataFrame) -> DataFrame:
    """A row for each address of a place; parts that it lacks come from the place's other addresses.

    The position is that of the geometry, else the middle of the box. Places without
    an address have one row.
    """
    parts = {"address": "freeform", "city": "locality", "state": "region", "zip": "postcode"}
    # an only address has none to take from
    filled = lambda part: f"coalesce(nullif(trim(a.{part}), ''), if(size(addresses) > 1, try_element_at(filter(transform(addresses, b -> b.{part}), v -> trim(v) <> ''), 1), null))"
    structs = ", ".join(f"{filled(p)} as {c}" for c, p in parts.items())
    each = F.expr(f"explode_outer(array_distinct(transform(addresses, a -> struct({structs}))))")
    lat = F.coalesce("point_lat", (F.col("bbox.ymin") + F.col("bbox.ymax")) / 2)
    lon = F.coalesce("point_lon", (F.col("bbox.xmin") + F.col("bbox.xmax")) / 2)
    rows = with_point(places, "geometry").select(F.col("place_id").alias("id"), F.col("names.primary").alias("name"), each.alias("at"), lat.alias("lat"), lon.alias("lon"))
    return rows.select("id", "name", *(F.col(f"at.{c}").alias(c) for c in parts), "lat", "lon")


def p6_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company rows with their place of the second source, with the confidence."""
    companies = table(spark, sf_dir, "companies").select(
        F.col("row_id").alias("id"), F.col("osm_way_id").alias("facility"), F.col("company_name").alias("name"), "address", "city", "state", F.col("zip_code").alias("zip"), "lat", "lon"
    )
    return facility_matches(companies, place_rows(table(spark, sf_dir, "overture_places")))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of company row and place of one organisation at one location."""
    return p6_matches(spark, sf_dir).select("row_id", "place_id")


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents assigned to containers of 2,048 tokens."""
    return pack(token_counts(table(spark, sf_dir, "documents"), "doc_id", "text"))


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are."""
    return packing_report(p7_containers(spark, sf_dir))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that repeat a test item, with the item."""
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def p9_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to exclude with the kinds of evidence."""
    return residue_evidence(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that show template residue, filler, an error message or a notice."""
    return p9_kinds(spark, sf_dir).select("doc_id").distinct()


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p3_found": p3_found, "p5_found": p5_found, "p5_truths": p5_truths, "p5_sources": p5_sources, "p6_found": p6_found, "p6_matches": p6_matches, "p7_containers": p7_containers, "p7_report": p7_report, "p8_found": p8_found, "p9_found": p9_found, "p9_kinds": p9_kinds}


def _best(field: str) -> str:
    """The best usable value of each facility, by rule."""
    blanks = ", ".join(f"'{p}'" for p in sorted(PLACEHOLDERS))
    usable = f"regexp_matches(regexp_replace(lower({field}), '[\\s._\\-]+', '', 'g'), '[a-z\\x{{00c0}}-\\x{{024f}}]|[1-9]') and regexp_replace(lower({field}), '[\\s._\\-]+', '', 'g') not in ({blanks})"
    rows = f"select distinct row_id, osm_way_id, c.source, discovery_date, {field}, coalesce(correct_rows / checked_rows, 0) as share from companies c left join source_audit a on a.source = c.source and a.field_name = '{field}' where {usable}"
    return f"(select osm_way_id, arg_max({field}, (share, coalesce(discovery_date, ''), -row_id)) as {field} from ({rows}) group by 1)"


ORACLE = {
    "p5_found": f"""
select g.osm_way_id, coalesce(a.city, '') as city, coalesce(b.sector_guess, '') as sector_guess
from (select osm_way_id from companies group by 1 having count(distinct row_id) > 1) g
left join {_best('city')} a using (osm_way_id) left join {_best('sector_guess')} b using (osm_way_id)"""
}
