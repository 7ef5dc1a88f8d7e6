"""Same postal address written differently: expansion, hashed components, equi-join.

Each address is parsed and expanded into all plausible normalised forms: its
number with each reading of the street name and each place that the row gives for
it (town and postal code, from the address itself and from the columns). The
combinations are hashed and exploded, rows that share a hash meet in an equi-join,
and conflicting house numbers, directions, street types, states and towns reject
the pair. Copies of one form are joined once and expanded afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.llm.textnorm import parse_address, state_of, town_of, zip_of
from tracklore.session import cut, spread

_PARSED = "address string, city string, state string, zip string, number string, name string, kind string, side string, region string, own_town string, own_zip string, towns array<string>, zips array<string>"


#: States without a place in these data (contiguous states only): typed there, they are errors.
OUTSIDE = ("AK", "HI")
#: Share of a postal code's rows that must name one town before the code stands for it.
TOWN_SHARE = 0.5


def _skeleton(c: str) -> str:
    return f"concat(left({c}, 1), translate(substring({c}, 2), 'aeiou', ''))"


def _keys() -> Column:
    """Hashes of the number with each place of a form, over its columns.

    A number within a postal code or a town is rare enough to need no hint of the
    street, so no error in the street's name can part two forms.
    """
    places = "array_union(transform(zips, z -> concat('z', z)), flatten(transform(towns, t -> array(concat('t', left(" + _skeleton("t") + ", 4)), concat('e', right(t, 4))))))"
    return F.expr(f"array_distinct(transform({places}, p -> xxhash64(number, p)))")


def _with_gazetteer(parsed: DataFrame) -> DataFrame:
    """Adds to the towns of a form the town that most rows give for its postal code."""
    seen = parsed.select(F.explode("zips").alias("z"), "towns").select("z", F.explode("towns").alias("t"))
    seen = seen.groupBy("z", "t").agg(F.count(F.lit(1)).alias("n"))
    top = seen.groupBy("z").agg(F.max_by("t", F.struct("n", "t")).alias("t"), F.max("n").alias("n"), F.sum("n").alias("of"))
    top = top.where((F.col("n") >= 2) & (F.col("n") >= TOWN_SHARE * F.col("of"))).select("z", "t")
    known = parsed.select("form", F.explode("zips").alias("z")).distinct().join(top, "z").groupBy("form").agg(F.collect_set("t").alias("known"))
    forms = parsed.drop("address", "city", "state", "zip").dropDuplicates(["form"]).join(known, "form", "left")
    return forms.withColumn("towns", F.array_union("towns", F.coalesce("known", F.array().cast("array<string>")))).drop("known").withColumn("keys", _keys())


def parse_forms(rows: DataFrame) -> DataFrame:
    """Distinct (address, city, state, zip) with the parts of the address; none where no street is named."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                p = parse_address(r.address)
                if p is None:
                    continue
                # the town typed after the street stands before that of the column
                towns = sorted({t for t in (p["town"], town_of(r.city)) if len(t) >= 3})
                zips = sorted({z for z in (p["zip"], zip_of(r.zip), zip_of(r.state)) if z})
                region = p["state"] or state_of(r.state)
                region = "" if region in OUTSIDE else region
                out.append((*r, p["number"], p["name"], p["kind"], p["side"], region, p["town"], p["zip"], towns, zips))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _PARSED.split(", ")])

    typed = ["address", "city", "state", "zip"]
    return spread(cut(rows.select(*typed).where(F.length(F.trim("address")) > 0).distinct())).mapInPandas(run, _PARSED)


def _alike(a: Column, b: Column) -> Column:
    """Two street or town names that typing errors on both sides, a cut or a town run on to a street explain."""
    short = F.least(F.length(a), F.length(b))
    lev = F.levenshtein(a, b, 4)
    return (
        (a == b)
        | ((lev == 1) & (short >= 4))
        | ((lev == 2) & (short >= 5))
        | ((lev == 3) & (short >= 7))
        | ((lev == 4) & (short >= 9))
        | ((short >= 5) & (F.startswith(a, b) | F.startswith(b, a) | F.endswith(a, b) | F.endswith(b, a)))
    )


def _numbered(c: str) -> Column:
    """The number of a numbered street or road, which must agree digit by digit."""
    return F.regexp_extract(F.col(c), r"(\d+)$", 1)


def same_place(a: str, b: str) -> Column:
    """True if two parsed forms with the same house number denote one street location in one town."""
    p, q = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    clash = lambda c: (p(c) != "") & (q(c) != "") & (p(c) != q(c))
    near = lambda x, y: F.exists(x, lambda i: F.exists(y, lambda j: _alike(i, j)))
    town = near(p("towns"), q("towns"))
    zips = F.arrays_overlap(p("zips"), q("zips"))
    zip_near = F.exists(p("zips"), lambda i: F.exists(q("zips"), lambda j: F.levenshtein(i, j, 2).between(0, 2)))
    no_zip = (F.size(p("zips")) == 0) | (F.size(q("zips")) == 0)
    # the town in the address itself stands above that of the column
    own = (p("own_town") != "") & (q("own_town") != "") & ~_alike(p("own_town"), q("own_town")) & ~zips
    street = _alike(p("name"), q("name")) & (_numbered(f"{a}.name") == _numbered(f"{b}.name"))
    return (p("number") == q("number")) & street & ~clash("kind") & ~clash("side") & (zips | ~clash("region")) & ~own & (zips | (town & (zip_near | no_zip)))


def address_forms(rows: DataFrame, id_col: str, address: str, city: str, state: str, zip_code: str) -> tuple[DataFrame, DataFrame]:
    """(members: id, form; forms with parts and keys). Rows without a street address have no form."""
    rows = rows.select(F.col(id_col).alias("id"), *(F.col(c).cast("string").alias(n) for c, n in ((address, "address"), (city, "city"), (state, "state"), (zip_code, "zip"))))
    rows = rows.where(F.col("id").isNotNull()).distinct()
    parsed = parse_forms(rows)
    parts = ["number", "name", "kind", "side", "region", "own_town", "own_zip", "towns", "zips"]
    parsed = cut(parsed.withColumn("form", F.xxhash64(*parts)))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("address", "city", "state", "zip")]
    members = rows.alias("r").join(parsed.alias("f"), same).select("r.id", "f.form")
    return members, _with_gazetteer(parsed)


def address_pairs(rows: DataFrame, id_col: str, place_col: str, *, address: str = "address", city: str = "city", state: str = "state", zip_code: str = "zip_code") -> DataFrame:
    """Pairs ``(id_a, id_b)`` of rows at one street location whose ``place_col`` differs.

    Null, blank and placeholder addresses, and those with a town but no street and
    number, are in no pair. Repeated rows count once. Other columns are ignored.
    An empty table gives an empty result. An id with several addresses is in the
    pairs of each.
    """
    members, forms = address_forms(rows, id_col, address, city, state, zip_code)
    members, forms = cut(members), cut(forms)
    keyed = forms.select("form", F.explode("keys").alias("key"))
    a, b = keyed.alias("a"), keyed.alias("b")
    candidates = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.form") < F.col("b.form")))
    candidates = candidates.select(F.col("a.form").alias("fa"), F.col("b.form").alias("fb")).distinct()
    facts = forms.drop("keys")
    pairs = candidates.join(facts.alias("x"), F.col("fa") == F.col("x.form")).join(facts.alias("y"), F.col("fb") == F.col("y.form")).where(same_place("x", "y")).select("fa", "fb")
    # rows of one form are at one place, if the form has a town or a postal code
    placed = forms.where((F.size("towns") > 0) | (F.size("zips") > 0)).select(F.col("form").alias("fa"), F.col("form").alias("fb"))
    pairs = pairs.unionByName(placed)
    at = rows.select(F.col(id_col).alias("id"), F.col(place_col).alias("place")).distinct()
    m = cut(members.join(at, "id"))
    m1 = m.select(F.col("id").alias("i1"), F.col("form").alias("fa"), F.col("place").alias("p1"))
    m2 = m.select(F.col("id").alias("i2"), F.col("form").alias("fb"), F.col("place").alias("p2"))
    full = pairs.join(m1, "fa").join(m2, "fb").where((F.col("p1") != F.col("p2")) & (F.col("i1") != F.col("i2")))
    full = full.where((F.col("fa") != F.col("fb")) | (F.col("i1") < F.col("i2")))
    return full.select(F.least("i1", "i2").alias(f"{id_col}_a"), F.greatest("i1", "i2").alias(f"{id_col}_b")).distinct()
