"""Snapshots in and out: JSON, CSV and Parquet with fixed schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklore.functions.text import strip
from tracklore.operators.network import ELEMENTS
from tracklore.operators.rules import place_is_usable

#: Columns of a company row in order; the postal code is called ``zip`` outside.
COMPANY = (
    "company_name address city state zip_code lat lon facility_type google_place_id osm_way_id spur_length_m connected_to_mainline "
    "confidence discovery_date in_existing_list sector_guess"
).split()
ENDPOINT = (
    "lat double, lon double, osm_way_id bigint, railway_type string, spur_length_m double, connected_to_mainline boolean, "
    "endpoint_method string, name string, operator string, tags map<string,string>"
)


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """Saved map responses, one document per file or line."""
    return spark.read.schema(ELEMENTS).option("multiLine", True).json(path)


def read_endpoints(spark: SparkSession, path: str) -> DataFrame:
    """Saved track ends; a missing file is an error."""
    return spark.read.schema(ENDPOINT).option("multiLine", True).json(path)


def read_text_csv(spark: SparkSession, path: str, blank: bool = False) -> DataFrame:
    """A CSV file with a header, all columns strings; with ``blank`` nulls become ''."""
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).option("inferSchema", False).csv(path)
    return df.fillna("") if blank else df


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(schema).csv(path)


def company_columns(df: DataFrame) -> DataFrame:
    """The outer columns in order; ``state_key`` first and ``source`` last where there are any."""
    cols = [F.col(c).alias("zip" if c == "zip_code" else c) for c in COMPANY]
    head = ["state_key"] if "state_key" in df.columns else []
    return df.select(*head, *cols, *(["source"] if "source" in df.columns else []))


def write_csv(df: DataFrame, path: str, by: str | None = None, dry_run: bool = False) -> None:
    """A CSV table, in folders by region if asked for; never onto the path it is read from."""
    if not dry_run:
        w = df.write.mode("overwrite").option("header", True).option("escape", '"')
        (w.partitionBy(by) if by else w).csv(path)


def write_json(df: DataFrame, path: str, by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).json(path)


def write_features(features: DataFrame, path: str, feature: str = "feature") -> None:
    """GeoJSON features, one per line, so the parts of the output can be read in parallel."""
    features.select(F.col(feature).alias("value")).write.mode("overwrite").text(path)


def bbox_filter(box: Column, south: float, west: float, north: float, east: float) -> Column:
    """Inside a region by the corner of the box; reaches the Parquet scan."""
    return (box["xmin"] >= west) & (box["xmin"] <= east) & (box["ymin"] >= south) & (box["ymin"] <= north)


def point_of_wkb(wkb: Column) -> Column:
    """struct<lat,lon> of a well-known binary point, or null: IEEE doubles from the hexadecimal digits, in either byte order."""
    h = F.hex(wkb)

    def number(at: int, little: bool) -> Column:
        digits = F.substring(h, at, 16)
        if little:
            digits = F.concat(*(F.substring(digits, i, 2) for i in range(15, 0, -2)))
        top = F.conv(F.substring(digits, 1, 3), 16, 10).cast("int")
        frac = F.conv(F.substring(digits, 4, 13), 16, 10).cast("double")
        sign, e = F.when(top >= 2048, -1.0).otherwise(1.0), top % 2048
        value = F.when(e == 0, frac * F.lit(2.0**-1074)).otherwise((1 + frac / 2.0**52) * F.pow(F.lit(2.0), (e - 1023).cast("double")))
        return sign * value

    point = lambda little: F.struct(number(27, little).alias("lat"), number(11, little).alias("lon"))
    le = h.startswith("0101000000")
    return F.when(le & (F.length(h) == 42), point(True)).when(h.startswith("0000000001") & (F.length(h) == 42), point(False))


def with_point(df: DataFrame, wkb: str) -> DataFrame:
    """``df`` with ``point_lat`` and ``point_lon`` of ``point_of_wkb``, in steps each short enough for the JVM to compile."""
    h, axes = F.col("point_hex"), {"lat": 27, "lon": 11}
    swapped = lambda at: F.concat(*(F.substring(h, at + i, 2) for i in range(14, -1, -2)))
    whole = F.length(h) == 42
    digits = lambda at: F.when(h.startswith("0101000000") & whole, swapped(at)).when(h.startswith("0000000001") & whole, F.substring(h, at, 16))
    part = lambda c, at, n: F.conv(F.substring(f"point_{c}", at, n), 16, 10)
    own = df.columns
    df = df.withColumn("point_hex", F.hex(wkb)).withColumns({f"point_{c}": digits(at) for c, at in axes.items()})
    df = df.withColumns({f"top_{c}": part(c, 1, 3).cast("int") for c in axes} | {f"frac_{c}": part(c, 4, 13).cast("double") for c in axes})
    df = df.withColumns({f"exp_{c}": F.col(f"top_{c}") % 2048 for c in axes})

    def value(c: str) -> Column:
        frac, e = F.col(f"frac_{c}"), F.col(f"exp_{c}")
        size = F.when(e == 0, frac * F.lit(2.0**-1074)).otherwise((1 + frac / 2.0**52) * F.pow(F.lit(2.0), (e - 1023).cast("double")))
        return F.when(F.col(f"top_{c}") >= 2048, -1.0).otherwise(1.0) * size

    return df.select(*own, *(value(c).alias(f"point_{c}") for c in axes))


def overture_places(raw: DataFrame, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Flat usable places: the first address, the position of the box or else of the geometry."""
    df = raw.where(bbox_filter(F.col("bbox"), *box)) if box else raw
    first = F.get("addresses", F.lit(0))
    spot = point_of_wkb(F.col("geometry"))
    flat = df.select(
        "place_id",
        F.col("names.primary").alias("name"),
        F.col("categories.primary").alias("category"),
        first["freeform"].alias("address"),
        first["locality"].alias("city"),
        first["region"].alias("state"),
        first["postcode"].alias("postcode"),
        F.coalesce(spot["lat"], F.col("bbox.ymin")).alias("lat"),
        F.coalesce(spot["lon"], F.col("bbox.xmin")).alias("lon"),
    )
    return flat.where(place_is_usable(F.col("name"), F.col("category"), F.col("lat"), F.col("lon")))


def known_accounts(spark: SparkSession, path: str) -> DataFrame:
    """Distinct names of known accounts; none where there is no file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(conf).exists(at):
        return spark.createDataFrame([], "company string")
    return read_text_csv(spark, path).select(strip(F.lower(F.col("Company"))).alias("company")).where("company <> ''").distinct()


def cache_key(params: Column) -> Column:
    """Key of a snapshot: the first sixteen digits of the hash of its parameters as JSON."""
    return F.substring(F.sha2(F.to_json(params), 256), 1, 16)
