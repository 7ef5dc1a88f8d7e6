import random

from pyspark.sql import functions as F

from tracklore.llm import addresses, canonical, domain, leaks, linkage, names, packing, residue, survivors

ROW = "row_id long, osm_way_id long, company_name string, address string, city string, state string, zip_code string, lat double, lon double, source string, discovery_date string, sector_guess string, extra string"


def rows(spark, *given):
    return spark.createDataFrame([tuple(g.get(c.split()[0]) for c in ROW.split(", ")) for g in given], ROW)


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_names(spark):
    n = ["Tarvemoor & Belkilesk Steel Inc", "BELKILESK TARVEMOOR STL LTD", "Tarvemor-Belkilesk Co", "Tarvemoor Zupandirt Steel Inc", None, "", "12", "Tarvemoor & Belkilesk Steel Inc"]
    df = rows(spark, *({"row_id": i, "osm_way_id": 10 + i, "company_name": x} for i, x in enumerate(n)), {"row_id": 1, "osm_way_id": 11, "company_name": n[1], "extra": "again"})
    assert pairs(names.name_pairs(df, "row_id", "company_name", "osm_way_id")) == {(0, 1), (0, 2), (1, 2), (1, 7), (2, 7)}
    assert names.name_pairs(df.limit(0), "row_id", "company_name", "osm_way_id").count() == 0


def test_addresses(spark):
    a = [("459 W Ramfodale St", "Doonton", "NC", "23346"), ("RAMFODALE STREET WEST 459", None, None, "23346-1111"), ("459 E Ramfodale St", "Doonton", "NC", "23346"), ("461 W Ramfodale St", "Doonton", "NC", "23346"), ("459 W Ramfodale St", "Elsewhere", "NC", "29999"), ("459 Ramfodel St, Doonton, N. Car.", "", "", ""), (None, "Doonton", "NC", "23346"), ("Doonton, NC 23346", "Doonton", "NC", "23346"), ("459 W Ramfodale St", None, None, None)]
    df = rows(spark, *({"row_id": i, "osm_way_id": i, "address": x, "city": c, "state": s, "zip_code": z} for i, (x, c, s, z) in enumerate(a)))
    got = pairs(addresses.address_pairs(df, "row_id", "osm_way_id"))
    assert {(0, 1), (0, 5)} <= got and not any(2 in p and p != (2, 5) or 3 in p or 4 in p or 6 in p or 7 in p or 8 in p for p in got)
    assert addresses.address_pairs(df.limit(0), "row_id", "osm_way_id").count() == 0


def test_canonical(spark):
    entries = spark.createDataFrame([("grain elevator", "grain elevator"), ("feed mill", "feed mill"), ("flour mill", "flour mill"), ("feed mill", "Plant that blends feed; fodder works"), ("x", None)], "entry string, phrase string")
    typed = ["Grain  Elevator", "elevators, grain", "gr. elev.", "GRIAN ELEVATOR", "feedmill", "fd mill", "fodder works", "old feed mill (active)", "golf course", "n/a", "mill", "?", "z" * 5000]
    df = spark.createDataFrame([(t,) for t in [*typed, None, "", " ", typed[0]]], "value string")
    got = {r.value: r.canonical for r in canonical.canonicalise(df, entries, stop=domain.FACILITY_STOP).collect()}
    assert got == dict.fromkeys(typed[:4], "grain elevator") | dict.fromkeys(typed[4:8], "feed mill") | dict.fromkeys(typed[8:], "UNMATCHED")
    none = canonical.canonicalise(df, entries.limit(0), stop=[])
    assert {r.canonical for r in none.collect()} == {"UNMATCHED"} and none.count() == len(typed)


def test_learnt_phrases(spark):
    exact = spark.createDataFrame([("grain elevator", "grain elevator"), ("feed mill", "feed mill")], "value string, entry string")
    entries = exact.select("entry", F.col("value").alias("phrase"))
    typed = [(i, v) for i in range(8) for v in ("grain elevator", "Corn Tower")] + [(i, v) for i in range(8, 16) for v in ("feed mill", "corn towr" if i == 8 else "fodder kitchen")]
    typed += [(i, "golf course") for i in range(16)] + [(None, "corn tower"), (3, None), (4, " "), (99, "feed mil"), (0, "Corn Tower")]
    df = spark.createDataFrame(typed, "thing long, value string")
    got = {r.value: r.canonical for r in canonical.canonicalise_records(df, exact, entries, stop=[]).collect()}
    assert got == {"Corn Tower": "grain elevator", "corn tower": "grain elevator", "corn towr": "grain elevator", "fodder kitchen": "feed mill", "golf course": "UNMATCHED", "feed mil": "feed mill"}
    assert canonical.canonicalise_records(df.limit(0), exact, entries, stop=[]).count() == 0


def test_survivors(spark):
    df = rows(
        spark,
        {"row_id": 1, "osm_way_id": 7, "city": "unknown", "sector_guess": "A", "source": "good", "discovery_date": "2025-01-01"},
        {"row_id": 2, "osm_way_id": 7, "city": "Old", "sector_guess": None, "source": "bad", "discovery_date": "2025-01-02"},
        {"row_id": 3, "osm_way_id": 7, "city": "New,", "sector_guess": "B", "source": "bad", "discovery_date": "2025-02-02"},
        {"row_id": 3, "osm_way_id": 7, "city": "New,", "sector_guess": "B", "source": "bad", "discovery_date": "2025-02-02"},
        {"row_id": 4, "osm_way_id": 8, "city": "Lone", "source": "good"},
        {"row_id": 5, "osm_way_id": 9, "city": "-", "source": None}, {"row_id": 6, "osm_way_id": 9, "city": "", "source": "new"}, {"row_id": 7, "osm_way_id": None, "city": "X"}, {"row_id": 8, "osm_way_id": None, "city": "X"},
    )
    audit = spark.createDataFrame([("good", f, 100, 90) for f in ("city", "sector_guess")] + [("bad", f, 100, 60) for f in ("city", "sector_guess")], "source string, field_name string, checked_rows long, correct_rows long")
    run = lambda d: survivors.survivors(d, audit, group="osm_way_id", record="row_id", source="source", date="discovery_date", fields=["city", "sector_guess"])
    assert sorted(tuple(r) for r in run(df).collect()) == [(7, "New,", "A"), (9, "", "")]
    assert run(df.limit(0)).count() == 0
    many = spark.createDataFrame([(g, s, "t" if s != "bad" or g % 3 else "f") for g in range(60) for s in ("good", "fair", "bad")], "object long, source string, fact string")
    facts, rate = survivors.fit_truth(many, {})
    assert rate["good"][1] > rate["bad"][1] and facts.where("fact = 't' and probability > 0.5").count() == 60


def test_linkage(spark):
    base = {"name": "Tarvemoor & Belkilesk Steel Inc", "address": "459 W Ramfodale St", "city": "Doonton", "state": "NC", "zip": "23346", "lat": 35.0, "lon": -80.0}
    spec = "id long, facility long, name string, address string, city string, state string, zip string, lat double, lon double"
    mk = lambda i, f, **k: (i, f, *((base | k)[c] for c in ("name", "address", "city", "state", "zip", "lat", "lon")))
    cs = [mk(1, 1), mk(2, 1, address=None, city=None, zip=None, lat=None, lon=None), mk(3, 2, address="12 Other Rd", lat=35.2), mk(4, 3, name="Gurdlemane Fostik Feed Co"), mk(5, 4, name=None)]
    companies = spark.createDataFrame(cs, spec)
    places = spark.createDataFrame([(c[0] + 90, None, *c[2:]) for c in [mk(1, 1, name="BELKILESK TARVEMOOR STL", address="459 Ramfodale Street West")]], spec).drop("facility")
    assert {(r.row_id, r.place_id) for r in linkage.facility_matches(companies, places).collect()} == {(1, 91), (2, 91)}
    assert linkage.facility_matches(companies.limit(0), places).count() == 0


def test_packing(spark):
    rnd = random.Random(1)
    sizes = [(i, rnd.choice([0, 1, 3, 7, 7, 7, 30, 64, 200])) for i in range(400)] + [(None, 5), (900, None)]
    packed = packing.pack(spark.createDataFrame(sizes, "doc_id long, tokens long"), capacity=64).toPandas()
    want = {i: n for i, n in sizes if i is not None and n}
    assert packed.groupby("doc_id").tokens.sum().to_dict() == want
    assert packed.groupby("container_id").tokens.sum().max() <= 64
    assert set(packed[packed.part > 0].doc_id) == {i for i, n in want.items() if n > 64}
    assert packing.pack(spark.createDataFrame([], "doc_id long, tokens long")).count() == 0
    texts = spark.createDataFrame([(1, "one two three"), (2, ""), (3, None)], "doc_id long, text string")
    counts = {r.doc_id: r.tokens for r in packing.token_counts(texts, "doc_id", "text").collect()}
    assert counts[1] == 3 and counts[2] == counts[3] == 0


def test_leaks(spark):
    items = spark.createDataFrame([(1, "Auditors matched 942 of the 875 waybills, and the rest bore the initials of Harlan Quill."), (2, None), (None, "x")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "It says: auditors matched 942 of the 875 waybills, and the rest bore the initials of Harlan Quill!", None), (2, None, 1), (3, " ", 2), (4, "word " * 30000, 3)], "doc_id long, text string, item_id long")
    assert pairs(leaks.leaked_items(docs, items)) == {(1, 1)}
    assert leaks.leaked_items(docs, items.limit(0)).count() == 0 and leaks.leaked_items(docs.limit(0), items).count() == 0


def test_residue(spark):
    t = ["Dear {{ name }}, thank you for listing your track at Doon.", "Dear Anna, thank you for listing your track at %s.", "Dear [YOUR FIRM], thank you for listing your track at Zed.", "The letter uses {shipper} as a merge field, and Anna fills it.", "The letter uses {shipper} as a merge field, and Bob fills it.", "Please enable JavaScript to view the map.", "A plain sentence about cars.", None, " ", "aaaa bbb cccc dddd", "Company = \nCarrier: ....\nGoods: -\nCity:"]
    # a notice is known by coming again: two more texts have it, and one long text talks of it
    long = "\n".join(f"{w} cars stood at the {w} dock until the {w} crew came." for w in "red blue green black white grey brown pink gold amber".split())
    t += [t[5], f"Doon Steel\n{t[5]}", f"Zed Mills\n{t[5]}", "The clerk read the notice aloud. " * 12 + f'It said "{t[5]}"', "Traceback (most recent call last):\n  File x", *(long.replace("cars", w) for w in ("wagons", "hoppers", "tanks", "flats"))]
    docs = spark.createDataFrame([(i, x, "e") for i, x in enumerate(t)], "doc_id long, text string, kind string")
    assert {r.doc_id for r in residue.residue_evidence(docs).collect()} == {0, 1, 2, 5, 9, 10, 11, 12, 13, 15}
    assert residue.residue_evidence(docs.limit(0)).count() == 0
