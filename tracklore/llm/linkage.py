"""Matching entities across two sources without keys: probabilistic record linkage.

Multi-pass blocking finds candidate pairs, comparisons give agreement levels per
attribute, and expectation-maximisation over the counts of the level patterns
estimates for every level how probable it is among matches and among non-matches.
The posterior of a pair is its confidence. The pattern table is bounded by the
product of the levels, whatever the data, so only it reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.llm.names import learn_generic, name_parts
from tracklore.llm.textnorm import Generic, name_words, parse_address, proper_words, signature, town_of, zip_of
from tracklore.functions.geo import haversine, usable_position
from tracklore.session import cut, spread

#: Levels by attribute; -1 (missing on a side) carries no weight.
LEVELS = {"name": 4, "street": 4, "zip": 3, "town": 3, "near": 3}
ROUNDS = 30
#: Least posterior of a match.
CONFIDENT = 0.5
#: Metres within which two positions of one site lie, and beyond which they do not.
NEAR_M, FAR_M = 1_500.0, 6_000.0
#: Degrees of the cells in which places without any address look for their neighbours.
CELL = 0.05

#: A word that is its consonants (``_cons`` of 99).
_BARE = "^.[^aeiou]{0,98}$"

_SPEC = "id long, a string, b string, rest string, number string, street string, kind string, side string, zip string, town string, lat double, lon double"


def profile(rows: DataFrame, generic: Generic) -> DataFrame:
    """Parsed attributes of rows with columns id, name, address, city, state, zip, lat, lon.

    All words of the name count that are not generic: the two longest (a, b) and the
    rest. Rows without one are left out; missing parts are ''.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # towns and codes come again and again, names and addresses hardly within a part of the table
        town_in, zip_in = lru_cache(100_000)(town_of), lru_cache(100_000)(zip_of)
        nothing: dict = {}
        for pdf in batches:
            out = []
            for i, name, address, city, state, post, lat, lon in zip(*(pdf[c].tolist() for c in ("id", "name", "address", "city", "state", "zip", "lat", "lon")), strict=True):
                a, b, rest = signature(proper_words(name_words(name), generic))
                if not a:
                    continue
                p = parse_address(address) or nothing
                town = p.get("town", "") or town_in(city)
                out.append((i, a, b, rest, p.get("number", ""), p.get("name", ""), p.get("kind", ""), p.get("side", ""), p.get("zip", "") or zip_in(post) or zip_in(state), town, lat, lon))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _SPEC.split(", ")])

    return spread(rows).mapInPandas(run, _SPEC)


def _cons(c: str, n: int) -> str:
    return f"left(concat(left({c}, 1), translate(substring({c}, 2), 'aeiou', '')), {n})"


def _keyed(p: DataFrame, side: str) -> DataFrame:
    """(id, key): the keys of the blocking passes of a side; a pass whose parts are missing gives no key.

    Passes 1 and 2 ask for both words. One word or a run is enough where a row of the
    pair has no number (5 for places, 9 for companies): two rows with numbers are of
    one site only if the numbers agree, and meet in the passes by number. A name
    written as one run begins like one of the words of its other form, so its first
    consonants meet those of a word. Position decides only where number, postal code and town are each missing on either
    side; one of the two rows is then without number and one of the others, or without
    both of those: that row looks around (7 for places, 8 for companies).
    """
    hints = {f"h{i}": f"nullif({_cons(c, 3)}, '')" for i, c in enumerate(("a", "b", "concat(a, b)", "concat(b, a)"))}
    p = p.withColumns({k: F.expr(v) for k, v in hints.items()} | {"ht": F.expr(f"nullif({_cons('town', 3)}, '')"), "hz": F.expr("nullif(zip, '')"), "hn": F.expr("nullif(number, '')")})
    p = p.withColumns({"h2": F.expr("nullif(nullif(h2, h0), h1)"), "h3": F.expr("nullif(nullif(h3, h0), h1)"), "h1": F.expr("nullif(h1, h0)")})
    usable = usable_position(F.col("lat"), F.col("lon"))
    p = p.withColumn("seen", usable).withColumn("ci", F.when(usable, F.floor(F.col("lat") / CELL))).withColumn("cj", F.when(usable, F.floor(F.col("lon") / CELL)))
    # a hash skips nulls, so they are kept apart; parts of different kinds have hashes of their own, and a key is
    # the sum without carry of the hashes of its pass and parts, null if one is: so little code is compiled whole
    hashed = lambda kind, *x: f"if({' or '.join(f'{v} is null' for v in x)}, null, xxhash64('{kind}', {', '.join(x)}))"
    p = p.withColumns({"both": F.expr("concat(least(h0, coalesce(h1, if(b = '', '', h0))), '|', greatest(h0, coalesce(h1, if(b = '', '', h0))))"), "e0": F.expr("left(a, 2)"), "e1": F.expr("nullif(nullif(left(b, 2), ''), left(a, 2))")})
    kinds = {"h0": "h", "h1": "h", "h2": "h", "h3": "h", "e0": "e", "e1": "e", "ht": "t", "hz": "z", "hn": "n", "both": "both"}
    hashes = {c: F.expr(hashed(k, c)) for c, k in kinds.items()} | {"cell": F.expr(hashed("cell", "ci", "cj"))}
    loose = "seen and (number = '' and (zip = '' or town = '') or zip = '' and town = '')"
    p = p.select("id", "ci", "cj", *(v.alias(c) for c, v in hashes.items()), F.expr("hn is null").alias("unnumbered"), F.expr(loose).alias("loose"))
    key = lambda tag, *parts: " ^ ".join((f"xxhash64({tag})", *parts))
    mine, other = (5, 9) if side == "y" else (9, 5)
    one = lambda tag: [key(tag, h, at) for h in ("h0", "h1", "h2", "h3") for at in ("hz", "ht")]
    around, here = (7, 8) if side == "y" else (8, 7)
    plain = [key(1, "both", "hz"), key(2, "both", "ht"), key(3, "hn", "hz"), key(4, "hn", "ht"), *one(other), *(key(here, "cell", e) for e in ("e0", "e1"))]
    # with a number, the hint of one word or run is rare enough
    numbered = ", ".join(key(6, "hn", h) for h in ("h0", "h1", "h2", "h3"))
    wide = f"if(unnumbered, array({', '.join(one(mine))}), array({numbered}))"
    grid = ", ".join(key(around, hashed("cell", f"ci + {i}", f"cj + {j}"), e) for i in (-1, 0, 1) for j in (-1, 0, 1) for e in ("e0", "e1"))
    keys = F.expr(f"concat(array({', '.join(plain)}), {wide}, if(loose, array({grid}), cast(array() as array<bigint>)))")
    return p.select(F.col("id").alias(f"{side}_id"), F.explode(keys).alias("key")).where("key is not null")


def _word(p: Column, q: Column, bare: tuple[Column, Column] | None = None) -> Column:
    """2 the same word, 1 explained by errors or a short form, 0 different; letters are looked at last, and once.

    ``bare`` are the consonants of both, which count where a word is without vowels.
    """
    short = F.least(F.length(p), F.length(q))
    close = (short >= 3) & (F.startswith(p, q) | F.startswith(q, p))
    if bare:
        # seen at the first vowel, while the consonants of both are made for few pairs
        close = close | ((short >= 3) & (F.rlike(p, F.lit(_BARE)) | F.rlike(q, F.lit(_BARE))) & (F.levenshtein(*bare, 1) >= 0))
    # -1 stands for more than three errors, and becomes more than any word bears
    close = close | (F.pmod(F.levenshtein(p, q, 3), F.lit(1 << 20)) * 2 <= short - 1 + F.when(short >= 5, 1).otherwise(0))
    return F.when(p == q, 2).when(close, 1).otherwise(0)


def compare(pairs: DataFrame) -> DataFrame:
    """Agreement levels of pairs with the columns of both profiles, prefixed x_ and y_."""
    clash = lambda c: (F.col(f"x_{c}") != "") & (F.col(f"y_{c}") != "") & (F.col(f"x_{c}") != F.col(f"y_{c}"))
    gone = lambda c: (F.col(f"x_{c}") == "") | (F.col(f"y_{c}") == "")
    digits = lambda c: F.regexp_extract(c, r"(\d+)$", 1)
    # the street matters only at the same number: different, of another type or direction, alike, or the same
    street = F.when(F.col("x_street") == F.col("y_street"), 2).when(digits("x_street") != digits("y_street"), 0).otherwise(_word(F.col("x_street"), F.col("y_street")))
    turn = clash("kind") | clash("side")
    place = F.when(gone("number"), -1).when(clash("number"), 0).otherwise(F.get(F.array(F.lit(0), *(F.when(turn, 1).otherwise(n) for n in (2, 3))), street))
    post = F.when(gone("zip"), -1).when(~clash("zip"), 2).when(F.levenshtein("x_zip", "y_zip", 1) == 1, 1).otherwise(0)
    town = F.when(gone("town"), -1).otherwise(_word(F.col("x_town"), F.col("y_town")))
    seen = usable_position(F.col("x_lat"), F.col("x_lon")) & usable_position(F.col("y_lat"), F.col("y_lon"))
    metres = F.when(seen, haversine(F.col("x_lat"), F.col("x_lon"), F.col("y_lat"), F.col("y_lon")))
    # the place first, so that the steps to the level of the name carry the names alone
    parts = [f"{s}_{c}" for c in ("a", "b", "rest") for s in "xy"]
    pairs = pairs.select("x_id", "y_id", *parts, place.alias("g_street"), post.alias("g_zip"), town.alias("g_town"), metres.alias("metres"))
    word = lambda p, q: _word(F.col(f"x_{p}"), F.col(f"y_{q}"), (F.expr(_cons(f"x_{p}", 99)), F.expr(_cons(f"y_{q}", 99))))
    # equal names need no look at their letters
    equal = (F.col("x_a") == F.col("y_a")) & (F.col("x_b") == F.col("y_b"))
    # errors in one word count only if the other one agrees, and words at the other's place only if those at
    # their own do not: without that it is enough whether they are the same
    same = lambda p, q: F.when(F.col(f"x_{p}") == F.col(f"y_{q}"), 2).otherwise(0)
    words = pairs.withColumn("aa", F.when(equal, 2).otherwise(word("a", "a")))
    words = words.withColumn("bb", F.when(equal, 2).when(F.col("aa") > 0, word("b", "b")).otherwise(same("b", "b")))
    straight = (F.col("aa") > 0) & (F.col("bb") > 0)
    words = words.withColumn("ab", F.when(equal, 0).when(straight, same("a", "b")).otherwise(word("a", "b")))
    words = words.withColumn("ba", F.when(equal, 0).when(straight | (F.col("ab") == 0), same("b", "a")).otherwise(word("b", "a")))
    # either form may be the run-together one, of words in either order
    orders = lambda s: (F.concat(f"{s}_a", f"{s}_b"), F.concat(f"{s}_b", f"{s}_a"))
    # the shorter the name, the fewer errors; a run of 8 letters bears three
    near = lambda p, q: F.levenshtein(p, q, 3).between(0, 3) & (F.levenshtein(p, q, 3) * 3 <= F.greatest(F.least(F.length(p), F.length(q)) + 1, F.lit(3)))
    whole = reduce(or_, (near(p, q) for p in orders("x") for q in orders("y")))
    one = (F.col("x_b") == "") | (F.col("y_b") == "")
    lo, hi = F.least("aa", "bb"), F.greatest("aa", "bb")
    lo2, hi2 = F.least("ab", "ba"), F.greatest("ab", "ba")
    best, most = F.greatest(lo, lo2), F.greatest(hi, hi2)
    name = F.when(one & whole, 2).when(one, 0).when(best == 2, 3).when(best == 1, 2).when(most == 2, 1).otherwise(0)
    # words beside the two longest: left out on one side they are an error, different ones another firm
    rest = F.when(F.col("x_rest") == F.col("y_rest"), 3).when((F.col("x_rest") == "") | (F.col("y_rest") == ""), 2).when(_word(F.col("x_rest"), F.col("y_rest")) > 0, 2).otherwise(1)
    name = F.least(name, rest)
    near = F.when(F.col("metres").isNull(), -1).when(F.col("metres") <= NEAR_M, 2).when(F.col("metres") <= FAR_M, 1).otherwise(0)
    return words.select("x_id", "y_id", name.alias("g_name"), "g_street", "g_zip", "g_town", near.alias("g_near"))


def fit(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[float, dict, dict]:
    """(share of matches, m, u) by expectation-maximisation over counted patterns.

    Starts from agreement being likely among matches; every probability is smoothed
    by one count, so an unseen level has no zero. No patterns give the start values.
    """
    fields = list(LEVELS)
    m = {f: [(1.0 + 4.0 * v) for v in range(n)] for f, n in LEVELS.items()}
    u = {f: [float(4 ** (n - v)) for v in range(n)] for f, n in LEVELS.items()}
    norm = lambda t: {f: [x / sum(v) for x in v] for f, v in t.items()}
    m, u, share = norm(m), norm(u), 0.2
    total = sum(n for _, n in patterns)
    for _ in range(ROUNDS if total else 0):
        mm = {f: [1.0] * n for f, n in LEVELS.items()}
        uu = {f: [1.0] * n for f, n in LEVELS.items()}
        hits = 0.0
        for levels, n in patterns:
            w = posterior(levels, share, m, u)
            hits += w * n
            for f, v in zip(fields, levels, strict=True):
                if v >= 0:
                    mm[f][v] += w * n
                    uu[f][v] += (1 - w) * n
        share = min(max(hits / total, 1e-6), 1 - 1e-6)
        m, u = norm(mm), norm(uu)
    return share, m, u


def posterior(levels: tuple[int, ...], share: float, m: dict, u: dict) -> float:
    p, q = share, 1 - share
    for f, v in zip(LEVELS, levels, strict=True):
        if v >= 0:
            p, q = p * m[f][v], q * u[f][v]
    return p / (p + q)


def link(left: DataFrame, right: DataFrame) -> DataFrame:
    """Scored candidate pairs ``(x_id, y_id, g_*, confidence)`` of two tables.

    Both have columns id, name, address, city, state, zip, lat, lon; nulls and blanks count as
    missing and never as agreement. Repeated rows count once. Empty tables give an
    empty result.
    """
    sides = {s: df.where(F.col("id").isNotNull()) for s, df in (("x", left), ("y", right))}
    generic = learn_generic(name_parts(sides["x"].select("name").unionByName(sides["y"].select("name")), "name", keep=False))
    sides = {s: cut(profile(df, generic)) for s, df in sides.items()}
    # only ids and keys meet in the join of the passes; the attributes join its distinct pairs, when the
    # shuffle files of the keys are gone
    pairs = cut(_keyed(sides["x"], "x").join(_keyed(sides["y"], "y"), "key").select("x_id", "y_id").repartition("x_id").distinct())
    # repeated rows fall together in the shuffle of the join
    for s, p in sides.items():
        rows = p.select(*(F.col(c).alias(f"{s}_{c}") for c in p.columns)).repartition(f"{s}_id").distinct()
        pairs = pairs.join(rows, f"{s}_id")
    levels = [f"g_{f}" for f in LEVELS]
    # the pattern table needs all candidates, those without a word of the name in common too
    scored = cut(compare(pairs).select("x_id", "y_id", *levels), long=True)
    counts = scored.groupBy(*levels).agg(F.count(F.lit(1)).alias("n")).collect()  # at most the product of the levels
    patterns = sorted((tuple(int(r[c]) for c in levels), int(r["n"])) for r in counts)
    share, m, u = fit(patterns)
    table = [(*p, float(posterior(p, share, m, u))) for p, _ in patterns]
    spec = ", ".join(f"{c} int" for c in levels) + ", confidence double"
    weights = left.sparkSession.createDataFrame(table, spec)
    # an entity of several addresses has several rows, of which the best counts
    weighed = scored.where(F.col("g_name") > 0).join(F.broadcast(weights), levels)
    best = F.max_by(F.struct(*levels, "confidence"), F.struct("confidence", *levels)).alias("best")
    return weighed.groupBy("x_id", "y_id").agg(best).select("x_id", "y_id", "best.*")


def facility_matches(companies: DataFrame, places: DataFrame) -> DataFrame:
    """Rows of facilities with the place that is theirs: ``(row_id, place_id, confidence)``.

    ``companies`` has id, facility, name, address, city, state, zip, lat, lon; ``places`` has id and
    the same attributes. A facility matches a place if one of its rows does: the name
    agrees in both words and no part of the address speaks against it. All
    facilities at the place's own street address keep it; of others, which match by
    code, town or position, only the one of greatest confidence, if it is the best of
    all. All rows of a facility share its match.
    """
    attributes = ["id", "name", "address", "city", "state", "zip", "lat", "lon"]
    pairs = link(companies.select(*attributes), places.select(*attributes))
    street, post, town = F.col("g_street"), F.col("g_zip"), F.col("g_town")
    # the same number and street is the same site of an organisation; without a street, the
    # postal code or the town must agree, or the positions where there is no address at all
    bare = (post == -1) & (town == -1)
    located = (street >= 2) | (street == -1) & ((post == 2) | (town >= 1) & (post != 0) | bare & (F.col("g_near") == 2)) & (F.col("g_near") != 0)
    sure = pairs.where((F.col("confidence") >= CONFIDENT) & (F.col("g_name") >= 2) & located)
    # several track ends of one organisation stand at one site: all that have the place's own
    # street address, with no other code, town or position speaking against it
    here = (street >= 2) & ((post == 2) | (town >= 1) | (post == -1) & (town == -1)) & (F.col("g_near") != 0)
    rows = companies.select(F.col("id").alias("x_id"), "facility").distinct()
    evidence = sure.join(rows, "x_id").groupBy("y_id", "facility").agg(F.max("confidence").alias("confidence"), F.sum(F.greatest(street, F.lit(0))).alias("streets"), F.max(here).alias("here"), F.count(F.lit(1)).alias("rows"))
    strength = F.struct((F.col("streets") > 0).alias("s"), "confidence", "rows", (-F.col("facility")).alias("f"))
    best = evidence.groupBy("y_id").agg(F.max_by(F.struct("facility", "confidence"), strength).alias("best"))
    best = best.select("y_id", "best.facility", "best.confidence")
    kept = best.unionByName(evidence.where("here").select("y_id", "facility", "confidence")).distinct()
    return rows.join(kept.withColumnRenamed("y_id", "place_id"), "facility").select(F.col("x_id").alias("row_id"), "place_id", "confidence")
