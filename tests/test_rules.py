from pyspark.sql import functions as F

from tracklore.functions.text import address_parts, norm_brand, norm_suffix, norm_words
from tracklore.operators import known, merge, reports, rules


def one(spark, expr, *values):
    cols = [f"c{i}" for i in range(len(values))]
    spec = ", ".join(f"{c} " + ("array<string>" if isinstance(v, list) else "double" if isinstance(v, float) else "string") for c, v in zip(cols, values, strict=True))
    return spark.createDataFrame([tuple(values)], spec).select(expr(*map(F.col, cols)).alias("x")).first().x


def test_sectors(spark):
    for name, sector in (("Cargill Grain Elevator", "Agriculture"), ("US Steel Mill", "Metals"), ("Dow Chemical Plant", "Chemicals"), ("XYZ Corporation", ""), ("84 Lumber Distribution", "Building Materials"), (None, "")):
        assert one(spark, lambda c: rules.sector_by_name(c, rules.PLACE_SECTORS), name) == sector


def test_place_confidence(spark):
    conf = lambda n, t, s=None: one(spark, rules.place_confidence, n, t, s)
    assert conf("ABC Corp", ["industrial", "establishment"]) == "HIGH"
    assert conf("Springfield Grain Elevator", ["establishment"]) == "HIGH"
    assert conf("First Baptist", ["church", "place_of_worship"]) == "LOW"
    assert conf("Acme Inc", ["establishment", "point_of_interest"]) == "MEDIUM"
    assert conf("ABC Chemical", ["establishment"], "ABC Chemical Spur") == "HIGH"


def test_addresses(spark):
    f = lambda a: tuple(one(spark, address_parts, a))
    assert f("123 Main St, Springfield, IL 62704, USA") == ("Springfield", "IL", "62704")
    assert f("Springfield, IL 62704") == f("") == f(None) == ("", "", "")


def test_normal_forms(spark):
    assert one(spark, norm_suffix, " Acme Co Inc ") == "acme"
    assert one(spark, norm_suffix, "acme inc co") == "acme inc"
    assert one(spark, norm_words, "The A.B. Company, L.L.C. ") == "the a b"
    assert one(spark, norm_brand, " Dunkin'  Donuts!! ") == "dunkin' donuts"
    assert one(spark, norm_suffix, None) == ""


def test_junk_and_quality(spark):
    cases = {"": "empty", "12": "number", "3M": "", "Zz": "short", "US 60": "highway", "42nd Avenue": "street", "Cook County": "district", "Calera Substation": "", "unknown": "generic", "Smith": ""}
    for name, reason in cases.items():
        assert one(spark, rules.junk_reason, name) == reason, name
    assert one(spark, rules.name_class, "way 123") == "osm_tag"
    assert one(spark, rules.name_quality, "  ") == "empty_name"


def test_business_label(spark):
    brands = {"fuel": ["shell"], "food": ["subway"]}
    f = lambda n: one(spark, lambda c: rules.business_label(c, brands, r"\bhotel\b|\bchurch\b", r"\bhotel\b", r"\bwarehouse\b"), n)
    assert [f(x) for x in ("Shell!", "Grand Hotel", "Hotel Warehouse", "Old Church", "Shell Chemical", None)] == ["fuel", "accommodation", "", "keyword_pattern", "", ""]


def test_known(spark):
    rows = spark.createDataFrame([("Acme Grain Inc",), ("Other",), (None,), ("Acme Grain Inc",)], "company_name string")
    assert sorted((r[0] or "", r[1]) for r in known.flag_known(rows, "company_name", ["acme grain"], "k").collect()) == [("", True), ("Acme Grain Inc", True), ("Acme Grain Inc", True), ("Other", False)]
    assert known.flag_known(rows, "company_name", [], "k").where("k").count() == 0
    names = spark.createDataFrame([("acme grain",), ("acme",), ("zeta",)], "name string")
    assert tuple(known.validation(names, ["acme grain", "lost"]).first()) == (3, 2, 1, 2, 1)
    assert [r[0] for r in known.missed_known(names, ["acme grain", "lost"]).collect()] == ["lost"]


def test_merge_and_verdicts(spark):
    spec = "company_name string, lat double, lon double"
    base = spark.createDataFrame([("A", 1.0, 2.0), ("N", float("nan"), None)], spec)
    added = spark.createDataFrame([(" a ", 1.000001, 2.0), ("B", 1.0, 2.0), ("B", 1.0, 2.0), ("n", float("nan"), None)], spec)
    added = added.unionByName(spark.createDataFrame([("N", None, None)], spec))  # null and NaN are one key
    assert merge.new_rows(base, added).count() == 2
    assert merge.merge(base, added).count() == 4
    rows = spark.createDataFrame([(0, "unknown"), (1, "Metals"), (2, None)], "idx int, sector_guess string")
    v = spark.createDataFrame([(0, False, "Energy"), (1, True, "Energy")], "idx int, keep boolean, sector string")
    assert sorted(tuple(r) for r in merge.apply_verdicts(rows, v, "idx", "sector_guess").collect()) == [(0, "Energy", "false"), (1, "Metals", "true"), (2, None, "true")]
    a = spark.createDataFrame([(1, '```json\n{"0": "Energy", "1": "Odd", "x": "Energy", "99": "Energy"}\n```'), (2, "no json")], "b int, a string")
    assert sorted(tuple(r) for r in merge.parse_labels(a, "b", "a", ["Energy"], 50).collect()) == [(1, 0, "Energy"), (1, 1, "Unknown")]


def test_reports_on_nothing(spark):
    rows = spark.createDataFrame([], "source string, sector_guess string, company_name string")
    assert reports.value_counts(rows, F.col("source"), "source").count() == 0
    assert reports.unclassified_share(rows).first().n_rows == 0
