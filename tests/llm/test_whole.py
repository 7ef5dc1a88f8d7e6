"""Cases that the operators once left out."""

from tracklore.llm import canonical, linkage, queries, residue

SPEC = "id long, facility long, name string, address string, city string, state string, zip string, lat double, lon double"
BASE = {"name": "Tarvemoor & Belkilesk Steel Inc", "address": "459 W Ramfodale St", "city": "Doonton", "state": "NC", "zip": "23346", "lat": 35.0, "lon": -80.0}


def site(i, facility, **k):
    return (i, facility, *((BASE | k)[c] for c in ("name", "address", "city", "state", "zip", "lat", "lon")))


def matches(spark, companies, places):
    made = spark.createDataFrame(companies, SPEC), spark.createDataFrame(places, SPEC).drop("facility")
    return {(r.row_id, r.place_id) for r in linkage.facility_matches(*made).collect()}


def test_linkage_blocking(spark):
    bare = {"address": None, "lat": None, "lon": None}
    nowhere = {"address": None, "city": None, "zip": None}
    companies = [site(1, 1), site(2, 2, name="Gurdlemane Fostik", city="Upwick", zip="30011", **bare), site(3, 3, name="Moldavant Quixley", zip="41234", city="Farrow", lat=40.0), site(4, 4, name="Ostrander Vexmill", lat=45.0, **nowhere)]
    # run together in either order; an error in the first consonants of one word; no address but a position
    places = [site(91, None, name="TARVEMOORBELKILESK", **bare), site(92, None, name="Kurdlemane Fostik", city="Upwick", zip="30011", **bare), site(93, None, name="quixleymoldavant", zip="41234", city="Farrow", **bare), site(94, None, name="OSTRANDERVEXMILL", lat=45.001, **nowhere)]
    assert matches(spark, companies, places) == {(1, 91), (2, 92), (3, 93), (4, 94)}


def test_linkage_two_track_ends(spark):
    companies = [site(1, 1), site(2, 2, lat=35.002), site(3, 3, city="Elsewhere", zip="71111", lat=40.0)]
    assert matches(spark, companies, [site(91, None)]) == {(1, 91), (2, 91)}


def test_linkage_short_names(spark):
    companies = [site(1, 1, name="Bunge LLC"), site(2, 2, name="Cargil Grain"), site(3, 3, name="Bunge Tarvemoor")]
    # what "grain" says of a firm is learnt from the other names
    others = [site(10 + i, 10 + i, name=f"{a}{b}ton Grain", address=f"{70 + i} Elm Rd", city="Upwick", zip="30011", lat=45.0) for i, (a, b) in enumerate((a, b) for a in ("Bro", "Kel", "Mas", "Tif", "Wun") for b in ("dar", "fel", "gim", "lop", "nur"))]
    assert matches(spark, companies + others, [site(91, None, name="BUNGE"), site(92, None, name="Cargill Inc")]) == {(1, 91), (2, 92)}


def test_residue_filled_records(spark):
    texts = ["Dear {{name}}, thank you for listing your spur.", "Dear Anna, thank you for listing your spur.", "Dear Bob, thank you for listing your spur. Cars come daily.", "The letter uses {shipper} as a merge field at Doon.", "The letter uses {shipper} as a merge field at Zed."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in residue.residue_evidence(docs).collect()} == {0}


def test_residue_fixed_pages_in_a_growing_corpus(spark):
    # a page without variable parts has few distinct texts, however often it comes; texts of content that show it do not end
    page, content = "Sample text for layout only.", "The weighmaster keeps the lead locked."
    letters = "abcdefghijklmnop"
    body = lambda w, x: "\n".join(f"{w}{x}{c} cars stood at the {x}{w}{c} dock." for c in letters)
    words = [f"w{p}{q}" for p in letters[:8] for q in letters[:8]]
    texts = [page] * 60 + [f"{page} {page}"] * 60 + [content] * 6 + [f"{page}\n{body(w, 'k')}" for w in words[:40]] + [f"{content}\n{body(w, 'm')}" for w in words]
    found = []
    for times in (1, 3):  # copies of all texts alike make nothing surer
        docs = spark.createDataFrame([(i + 1000 * k, x) for k in range(times) for i, x in enumerate(texts)], "doc_id long, text string")
        found.append({r.doc_id for r in residue.residue_evidence(docs).collect()})
    shown = set(range(120)) | set(range(126, 166))
    assert found == [shown, shown | {i + 1000 for i in shown} | {i + 2000 for i in shown}]


def test_residue_default_within_a_sentence(spark):
    texts = [*(f"Replace this text with the site summary ships {x} through Zed and welcomes new tenants." for x in ("Doon", "Upwick")), "{{ firm }} ships Quay through Zed and welcomes new tenants."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in residue.residue_evidence(docs).collect()} == {0, 1, 2}


def test_canonical_fields_go_through_together(spark):
    lists = [("a", "grain elevator", "grain elevator"), ("b", "grain elevator", "G"), ("b", "elevators", "E"), ("c", None, "x")]
    exact = spark.createDataFrame(lists[:3], "field string, value string, entry string")
    entries = spark.createDataFrame([(f, e, p) for f, p, e in lists], "field string, entry string, phrase string")
    typed = [("a", "grain elevtor"), ("a", "elevators"), ("a", "grain"), ("b", "grain elevtor"), ("b", "elevator"), ("b", "elevators"), ("c", "grain elevator"), ("c", " "), ("a", None)]
    things = [(f, i, v) for i in range(4) for f, v in (("b", "elevators"), ("b", "corn tower"), ("a", "corn tower"))]
    df = spark.createDataFrame([*((f, None, v) for f, v in typed), *things], "field string, thing long, value string")
    rules = {"a": (["grain"], True), "b": ([], False), "c": ([], True)}
    got = {(r.field, r.value): r.canonical for r in canonical.canonicalise_fields(df, exact, entries, rules).collect()}
    each = {}
    for f, (stop, singular) in rules.items():
        one = canonical.canonicalise_records(df.where(df.field == f).drop("field"), exact.where(exact.field == f).drop("field"), entries.where(entries.field == f).drop("field"), stop=stop, singular=singular)
        each |= {(f, r.value): r.canonical for r in one.collect()}
    assert got == each and got[("b", "corn tower")] == "E" and got[("a", "elevators")] == "grain elevator" and got[("c", "grain elevator")] == "UNMATCHED"


def test_canonical_plans_do_not_grow_with_the_fields(spark, tmp_path):
    fields = ("state", "facility_type")
    spark.createDataFrame([(i, i, "Texs", "feed mil") for i in range(4)], "row_id long, osm_way_id long, state string, facility_type string").write.parquet(f"{tmp_path}/companies.parquet")
    spark.createDataFrame([("TX", "Texas")], "state_code string, state_name string").write.parquet(f"{tmp_path}/state_regions.parquet")
    spark.createDataFrame([("feed mill", "mill that blends feed")], "facility_type string, description string").write.parquet(f"{tmp_path}/facility_types.parquet")
    made = []
    before, canonical.cut = canonical.cut, lambda df, **k: made.append(1) or before(df, **k)
    try:
        got = {tuple(r) for r in queries.p1_found(spark, str(tmp_path)).collect()}
    finally:
        canonical.cut = before
    assert got == {(i, f, c) for i in range(4) for f, c in zip(fields, ("TX", "feed mill"), strict=True)} and len(made) <= 11
