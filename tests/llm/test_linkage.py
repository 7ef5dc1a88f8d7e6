"""Costly steps of the linkage stay short enough for the JVM to compile, and mean what they meant."""

import contextlib
import io
import re
import struct

from pyspark.sql import functions as F

from tracklore.llm import linkage, queries
from tracklore.sources.io import point_of_wkb, with_point

PROFILE = [(1, "belkilesk", "tarvemoor", "", "12", "main", "st", "", "12345", "doonton", 35.0, -80.0), (2, "bunge", "", "", "", "", "", "", "", "", None, None), (3, "fthlm", "quixley", "", "", "", "", "", "", "doonton", 35.0, -80.0)]
PLACE = "place_id long, names struct<primary: string>, addresses array<struct<freeform: string, locality: string, region: string, postcode: string>>, bbox struct<xmin: double, xmax: double, ymin: double, ymax: double>, geometry binary"
#: Bytes of code of a method that the JVM still compiles.
MOST = 8000


def code(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())))


def test_keys_and_places_are_compiled(spark, tmp_path):
    spark.createDataFrame(PROFILE, linkage._SPEC).write.parquet(f"{tmp_path}/p")
    profile = spark.read.parquet(f"{tmp_path}/p")
    assert all(code(linkage._keyed(profile, side)) < MOST for side in "xy")
    spark.createDataFrame([], PLACE).write.parquet(f"{tmp_path}/o")
    assert code(queries.place_rows(spark.read.parquet(f"{tmp_path}/o"))) < MOST


def test_keys_lack_what_the_row_lacks(spark):
    profile = spark.createDataFrame(PROFILE, linkage._SPEC)
    x, y = ({i: {r.key for r in linkage._keyed(profile, s).where(f"{s}_id = {i}").collect()} for i in (1, 2, 3)} for s in "xy")
    # without number, code, town and position there is nothing to meet by; equal keys only of equal parts
    assert x[2] == y[2] == set() and x[1] & y[1] and x[3] & y[3] and not x[1] & y[3] and not x[3] & y[1]


def test_points_in_steps(spark):
    points = [(35.25, -80.5), (-0.0, 0.0), (5e-324, 1e300), (90.0, -180.0)]
    made = [struct.pack(f"{o}BIdd", o == "<", 1, lon, lat) for lat, lon in points for o in "<>"] + [b"", b"x" * 21, None]
    df = with_point(spark.createDataFrame([(i, g) for i, g in enumerate(made)], "i int, g binary"), "g").withColumn("p", point_of_wkb(F.col("g")))
    got = {r.i: (r.point_lat, r.point_lon, r.p) for r in df.collect()}
    assert [got[2 * k + j][:2] for k in range(4) for j in (0, 1)] == [p for p in points for _ in (0, 1)]
    assert all((lat, lon) == (p and tuple(p) or (None, None)) for lat, lon, p in got.values()) and got[8][0] is got[9][0] is got[10][0] is None


def test_parts_of_an_address_come_from_the_other_ones(spark):
    a = lambda *x: dict(zip(("freeform", "locality", "region", "postcode"), x, strict=True))
    rows = [(1, {"primary": "A"}, [a(" 1 Elm Rd ", " ", "NC", None)], None, None), (2, {"primary": "B"}, [a("2 Elm Rd", None, "NC", ""), a(None, "Doon", None, "23346")], None, None), (3, {"primary": "C"}, None, None, None)]
    got = {tuple(r)[:6] for r in queries.place_rows(spark.createDataFrame(rows, PLACE)).collect()}
    assert got == {(1, "A", "1 Elm Rd", None, "NC", None), (2, "B", "2 Elm Rd", "Doon", "NC", "23346"), (3, "C", None, None, None, None)}
