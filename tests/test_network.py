from pyspark.sql import functions as F

from tracklore.operators import network

WAYS = "way_id long, tags map<string,string>, node_ids array<long>"
NODES = "node_id long, lat double, lon double"
#: A star of three tracks at node 50, and a track apart from it.
TRACKS = [(7, {"railway": "siding", "name": "Mill lead"}, [50, 61, 62]), (8, {"railway": "spur"}, [50, 71]), (9, {"railway": "spur"}, [83, 82, 81, 50])]
PLACES = {50: (35.5, -97.25), 61: (35.52, -97.25), 62: (35.54, -97.25), 71: (35.5, -97.2), 81: (35.45, -97.25), 82: (35.4, -97.25), 83: (35.35, -97.3), 90: (36.0, -98.0), 91: (36.0, -98.5)}


def net(spark, *extra):
    return spark.createDataFrame([*TRACKS, *extra], WAYS), spark.createDataFrame([(k, *v) for k, v in PLACES.items()], NODES)


def test_ends_lie_away_from_junctions(spark):
    ways, nodes = net(spark, (10, {"railway": "rail"}, [90, 91]), (11, {}, [50]), (12, {}, [500, 501]))
    assert {r.node_id: r.n_ends for r in network.junction_nodes(ways).collect()} == {50: 5}
    ends = {r.osm_way_id: r for r in network.facility_ends(ways, nodes).collect()}
    assert {k: (r.lat, r.lon) for k, r in ends.items() if r.connected_to_mainline} == {7: PLACES[62], 8: PLACES[71], 9: PLACES[83]}
    assert ends[10].endpoint_method == "midpoint" and (ends[10].lat, ends[10].lon) == (36.0, -98.25) and set(ends) == {7, 8, 9, 10}


def test_empty_network(spark):
    ways, nodes = spark.createDataFrame([], WAYS), spark.createDataFrame([], NODES)
    assert network.facility_ends(ways, nodes).count() == 0
    assert network.geojson_features(ways, nodes).count() == 0


def test_responses_in_order(spark):
    way = lambda i, tags: {"type": "way", "id": i, "nodes": [50, 61], "tags": tags}
    node = lambda i, lat: {"type": "node", "id": i, "lat": lat, "lon": -97.0}
    raw = spark.createDataFrame([(2, [way(7, {"railway": "spur"}), node(50, 35.5)]), (1, [way(7, {"railway": "rail", "usage": "main"}), node(50, 1.0), node(61, 35.6)])], f"batch int, {network.ELEMENTS}")
    ways, nodes = network.parse_elements(raw, ("batch",))
    assert [r.tags["railway"] for r in ways.collect()] == ["spur"] and {r.node_id: r.lat for r in nodes.collect()} == {50: 35.5, 61: 35.6}
    assert network.mainline_nodes(ways).count() == 0
    (f,) = network.geojson_features(ways, nodes).collect()
    assert (f.way_id, f.n_vertices) == (7, 2) and '"coordinates":[[-97.0,35.5],[-97.0,35.6]]' in f.feature


def test_counts_and_filter(spark):
    df = spark.createDataFrame([({"railway": "spur"},), ({"railway": "rail", "service": "siding"},), ({"railway": "rail"},), (None,)], "tags map<string,string>")
    assert df.where(network.is_spur_or_siding(F.col("tags"))).count() == 2
