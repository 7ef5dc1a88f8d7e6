"""Variant spellings of organisation names: noisy-channel attribution.

Which words of a name are generic (lines of business, legal words, given names and
their familiar forms, notes) is learnt from the names themselves: such a word stands
beside ever new words, while a word that names a firm has few partners. What is left
of a name is its signature, all of it: the two longest words and the others.

Signatures are spellings with a frequency. For each spelling the candidate canonical
forms are the more frequent spellings that share a blocking key; the posterior of a
candidate joins

* the prior: how often the candidate spelling occurs, and how established the
  words are in which both differ (a word used with many partners is a word of its
  own and no slip of the pen), and
* the channel: the likelihood of the typing errors and abbreviations that would
  turn the candidate into the spelling, estimated by expectation-maximisation over
  the counts of the error patterns of all candidate pairs.

Each spelling is attached to its candidate of greatest posterior, if that beats
the hypothesis that the spelling is a name of its own. Frequent spellings are
tried first as canonical forms; what they leave is then tried among itself, so a
popular name with very many spellings never meets all its own variants.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.llm.textnorm import Generic, name_words, proper_words, signature
from tracklore.session import cut, drop, spread

#: A word is common if it is in this share of the distinct names, and generic if it has so many
#: distinct partners for each distinct name; the least numbers for either to be evidence.
COMMON_SHARE, GENERIC_SHARE, LEAST = 1 / 250, 1 / 1600, 20
#: Words before and after a word that count as its partners.
REACH = 3
#: Log odds that two names alike by chance are one name, before the errors are counted.
COINCIDENCE = 6.0
#: Kinds of error in a word and the costs (log likelihood) from which their estimation starts: none,
#: one, two and three typing errors, vowels left out, the same with a typing error, cut off.
START = (0.0, 1.5, 2.8, 4.5, 2.0, 3.5, 2.0)
#: The same for words run together, and for a word left out of three or more.
MERGED, OMITTED = 1.0, 3.0
#: Weight of the log number of partners of a word that would have to be an error, and of the log frequency.
ESTABLISHED, FREQUENCY = 2.0, 0.5
ROUNDS = 20

_SIG = "name string, n long, words array<string>, a string, b string"
#: Parts of the blocking keys that are joined one after the other, so that only one of them is on disk.
KEY_PARTS = 2


def name_parts(rows: DataFrame, col: str, keep: bool = True, id_col: str | None = None) -> DataFrame:
    """Distinct values of ``col`` of a scan with their words in order: (name, words), or only (words). Names without a word are left out.

    With ``id_col`` they have the number ``n`` of its distinct values as well.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["words"] = [name_words(n) for n in pdf["name"]]
            yield pdf[pdf["words"].map(len) > 0]

    ids = [F.col(id_col).alias("id")] if id_col else []
    typed = rows.select(*ids, F.col(col).alias("name")).where(F.length(F.trim("name")) > 0)
    spec = f"id {typed.schema['id'].dataType.simpleString()}, " if id_col else ""
    parts = spread(typed).mapInPandas(run, f"{spec}name string, words array<string>")
    if id_col:
        return cut(parts.distinct().groupBy("name", "words").agg(F.count(F.lit(1)).alias("n")))
    return cut((parts if keep else parts.select("words")).distinct())


def learn_generic(parts: DataFrame) -> Generic:
    """The generic words of all names of ``parts`` (words).

    Counted over all distinct names. What reaches the driver is bounded whatever the
    data: common words by the words of a name over ``COMMON_SHARE``, generic ones by the
    partners of a name over ``GENERIC_SHARE``.
    """
    n = parts.count()
    words = parts.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    common = sorted(r["w"] for r in words.where(F.col("n") >= max(n * COMMON_SHARE, LEAST)).select("w").collect())
    # array_except would hash all common words anew for every name
    left = parts.select(F.array_distinct(F.filter("words", lambda w: ~w.isin(common))).alias("words")).where(F.size("words") > 1)
    # a word and the one that stands so many places after it, without a lambda, which the JVM would interpret
    apart = ", ".join(f"arrays_zip(slice(words, 1, greatest(size(words) - {d}, 0)), slice(words, {d + 1}, size(words)))" for d in range(1, REACH + 1))
    beside = left.select(F.explode(F.expr(f"concat({apart})")).alias("p")).select(F.col("p.0").alias("u"), F.col("p.1").alias("v"))
    both = beside.select(F.explode(F.expr("array(named_struct('w', u, 'x', v), named_struct('w', v, 'x', u))")).alias("p")).select("p.w", "p.x").where("w <> x")
    partners = both.select("w", F.expr("left(concat(left(x, 1), translate(substring(x, 2), 'aeiou', '')), 5)").alias("hint")).distinct()
    many = partners.groupBy("w").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") >= max(n * GENERIC_SHARE, LEAST))
    return Generic([*common, *(r["w"] for r in many.select("w").collect())], common)


def parse_names(parts: DataFrame, generic: Generic) -> DataFrame:
    """Signatures of (name, words, n): (name, n, proper words, and the two longest of them as a, b).

    A name with one proper word has an empty ``b``; names with none are left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, n, words in zip(pdf["name"], pdf["n"], pdf["words"], strict=True):
                proper = sorted(set(proper_words(list(words), generic)))
                a, b, _ = signature(proper)
                if a:
                    rows.append((name, n, proper, a, b))
            yield pd.DataFrame(rows, columns=["name", "n", "words", "a", "b"])

    return spread(parts).mapInPandas(run, _SIG)


def _keys() -> Column:
    """Blocking keys of a signature.

    A key has a word exactly and a hint of the other, or hints of both in either order,
    or (5) a hint of both run together, which alone can meet a name of one word. Of more
    than two words each and the next in order (the last and the first) are a key (9), so
    an error in one leaves others. One
    word alone has only that. Two names of the same words at other places in the order
    meet as well, for hints of both are sorted.
    """
    pair = lambda tag, p, q: f"xxhash64({tag}, least({p}, {q}), greatest({p}, {q}))"
    keys = [pair(3, "left(ca, 5)", "left(cb, 5)"), pair(4, "left(a, 4)", "left(b, 4)")]
    for x, y, cx, cy in (("a", "b", "ca", "cb"), ("b", "a", "cb", "ca")):
        keys += [f"xxhash64(1, {x}, left({cy}, 3))", f"xxhash64(2, {x}, right({y}, 3))", f"xxhash64(7, left({x}, 4), right({y}, 5))", f"xxhash64(5, left(concat({cx}, translate({y}, 'aeiou', '')), 7))"]
    ring = "transform(words, (w, i) -> xxhash64(9, least(w, get(words, (i + 1) % size(words))), greatest(w, get(words, (i + 1) % size(words)))))"
    return F.expr(f"case when b = '' then array(xxhash64(5, left(ca, 7))) else array_distinct(concat(array({', '.join(keys)}), {ring})) end")


def _error(a: Column, b: Column, ca: Column, cb: Column) -> Column:
    """The kind of error (place in ``START``) that writes the word ``a`` for ``b``; null where none explains it."""
    lev = F.levenshtein(a, b, 3)
    shorter = F.least(F.length(a), F.length(b))
    bare = ((a == ca) | (b == cb)) & (F.length(ca) >= 3)
    kind = F.when(a == b, 0).when(lev == 1, 1).when(bare & (ca == cb), 4).when((shorter >= 3) & (F.startswith(a, b) | F.startswith(b, a)), 6)
    kind = kind.when((lev == 2) & (shorter >= 5), 2).when(bare & (F.levenshtein(ca, cb, 1) >= 0), 5)
    return kind.when((lev == 3) & (shorter >= 8), 3)


def _written(x: str, y: str) -> Column:
    """The same of two columns, x_a or x_b against y_a or y_b."""
    return _error(*map(F.col, (x, y, x.replace("_", "_c"), y.replace("_", "_c"))))


def _bare(c: Column) -> Column:
    return F.concat(F.substring(c, 1, 1), F.translate(F.substring(c, 2, 1 << 30), "aeiou", ""))


def _priced(kind: Column, costs: tuple[float, ...]) -> Column:
    return F.get(F.array(*map(F.lit, costs)), kind)


def _keyed(sig: DataFrame, part: int) -> DataFrame:
    """Signatures by key, for one part of the keys.

    They are what the join of the blocks shuffles, so only what the words do not tell is
    in them: all words only of names of more than two. The rest is made after the shuffle.
    """
    keys = F.filter(_keys(), lambda k: F.pmod(k, F.lit(KEY_PARTS)) == part)
    bared = sig.withColumns({"ca": _bare(F.col("a")), "cb": _bare(F.col("b"))})
    k = bared.select(F.explode(keys).alias("key"), "a", "b", "n", "da", "db", F.when(F.size("words") > 2, F.col("words")).alias("words")).repartition("key")
    two = F.when(F.col("b") == "", F.array("a")).otherwise(F.array_sort(F.array("a", "b")))
    k = k.withColumns({"words": F.coalesce("words", two), "ca": _bare(F.col("a")), "cb": _bare(F.col("b"))})
    return k.withColumns({"sid": F.xxhash64("words"), "weight": F.log(F.col("da") * F.col("db")) + F.length(F.concat("a", "b")) / 100})


def _candidates(sig: DataFrame) -> DataFrame:
    """Pairs of a spelling and a more frequent one with the errors that explain them.

    The parts of the keys follow each other, each with one shuffle, whose files go
    before the next begins. A pair that shares several keys is compared at each: that
    costs less than to bring its words together once more.
    """
    found = None
    for part in range(KEY_PARTS):
        pairs = cut(_scored(_keyed(sig, part)).distinct())
        found = pairs if found is None else found.unionByName(pairs)
    return cut(found.distinct())


def _scored(keyed: DataFrame) -> DataFrame:
    side = lambda p: keyed.select("key", *(F.col(c).alias(f"{p}_{c}") for c in keyed.columns if c != "key"))
    strength = lambda p: F.struct(f"{p}_n", f"{p}_weight", f"{p}_sid")
    x, y = side("x"), side("y")
    pairs = x.join(y, "key").where(strength("y") > strength("x")).drop("key").withColumns({"sid": F.col("x_sid"), "to_sid": F.col("y_sid")})
    solo, to_solo = F.col("x_b") == "", F.col("y_b") == ""
    single, more = solo | to_solo, (F.size("x_words") > 2) | (F.size("y_words") > 2)
    pairs = pairs.withColumn("two", ~single & ~more)
    # two words both of which are established are no errors of each other: no need to look at their letters
    prior = FREQUENCY * F.log((F.col("y_n") + 1.0) / (F.col("x_n") + 1.0))
    slipped = lambda v, w: F.when(F.col(f"x_{v}") == F.col(f"y_{w}"), 0.0).otherwise(ESTABLISHED * F.log(F.least(f"x_d{v}", f"y_d{w}").cast("double")))
    likely = lambda v, w: F.round(slipped("a", v) + slipped("b", w) - prior, 1) < COINCIDENCE
    pairs = pairs.where(~F.col("two") | likely("a", "b") | likely("b", "a"))
    # each comparison is made once, and only where those before leave it open
    pairs = _once(pairs, "aa", F.when(F.col("two"), _written("x_a", "y_a")))
    pairs = _once(pairs, "bb", F.when(F.col("aa").isNotNull(), _written("x_b", "y_b")))
    pairs = _once(pairs, "ab", F.when(F.col("two") & F.col("bb").isNull(), _written("x_a", "y_b")))
    pairs = _once(pairs, "ba", F.when(F.col("ab").isNotNull(), _written("x_b", "y_a")))
    pairs = _once(pairs, "alone", F.when(single, _together()).when(more, _several()))
    pairs = pairs.withColumns({"ea": F.coalesce("alone", F.when(F.col("bb").isNotNull(), F.col("aa")).otherwise(F.col("ab"))), "eb": F.when(F.col("alone").isNotNull(), 0).otherwise(F.coalesce("bb", "ba"))})
    pairs = pairs.where("ea is not null and eb is not null")
    cross = F.col("bb").isNull()
    slip = lambda w: F.when(~F.col("two") | (F.col(f"e{w}") == 0), 0.0).otherwise(ESTABLISHED * F.log(F.least(F.col(f"x_d{w}"), F.when(cross, F.col(f"y_d{'ab'[w == 'a']}")).otherwise(F.col(f"y_d{w}"))).cast("double")))
    omitted = F.when(more & ~single & (F.size("x_words") != F.size("y_words")), OMITTED).otherwise(0.0)
    fixed = F.round(slip("a") + slip("b") + omitted - prior, 1).alias("fixed")
    scored = pairs.select("sid", "to_sid", F.col("y_n").alias("to_n"), F.col("y_weight").alias("to_weight"), F.least("ea", "eb").cast("int").alias("e1"), F.greatest("ea", "eb").cast("int").alias("e2"), (solo != to_solo).alias("merged"), fixed)
    return scored.where(F.col("fixed") < COINCIDENCE)


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that the planner cannot copy into each place where it is used."""
    return df.withColumn(name, F.explode(F.array(value)))


def _together() -> Column:
    """The kind of error between names one of which is run together: as two words in either order, each with or without vowels."""
    forms = lambda p: F.when(F.col(f"{p}_b") == "", F.array(f"{p}_a")).otherwise(F.array(*(F.concat(f"{p}_{x}", f"{p}_{y}") for u, v in (("a", "b"), ("b", "a")) for x in (u, f"c{u}") for y in (v, f"c{v}"))))
    # every form but the first and the fifth lacks vowels
    kind = lambda p, q, bare: F.when(p == q, F.when(bare, 4).otherwise(0)).when(F.levenshtein(p, q, 3) == 1, F.when(bare, 5).otherwise(1)).when(F.levenshtein(p, q, 3) >= 2, F.when(~bare, F.levenshtein(p, q, 3)))
    cut_off = lambda p, q: F.when((F.least(F.length(p), F.length(q)) >= 7) & (F.startswith(p, q) | F.startswith(q, p)), 6)
    both = F.transform(forms("x"), lambda p, i: F.transform(forms("y"), lambda q, j: F.coalesce(kind(p, q, (i % 4 > 0) | (j % 4 > 0)), cut_off(p, q))))
    return F.array_min(F.flatten(both))


def _several() -> Column:
    """The kind of error between names of which one has more than two words: a single word may differ, or be left out."""
    own, to_own = (F.array_except(f"{p}_words", f"{q}_words") for p, q in ("xy", "yx"))
    mine, theirs, odd = F.get(own, F.lit(0)), F.get(to_own, F.lit(0)), F.size(own) + F.size(to_own)
    same = (odd == 0) | (odd == 1) & (F.least(F.size("x_words"), F.size("y_words")) > 1)
    return F.when(same, 0).when((odd == 2) & mine.isNotNull() & theirs.isNotNull(), _error(mine, theirs, _bare(mine), _bare(theirs)))


def fit_channel(patterns: list[tuple[int, int, bool, float, float]]) -> tuple[tuple[float, ...], float]:
    """(cost of each kind of error, cost of words run together) by expectation-maximisation.

    ``patterns`` are (error of one word, of the other, run together, fixed cost, number of
    pairs). A pair is one name with the posterior of its costs as they stand; the
    expected counts of the kinds, with the start as the prior, give the next costs. No
    patterns give the start.
    """
    costs, merged = START, MERGED
    base = [math.exp(-c) for c in START]
    weight = 50.0 / sum(base)  # the start counts as so many words
    for _ in range(ROUNDS if patterns else 0):
        kinds = [weight * b for b in base]
        run, of = 25.0 * math.exp(-MERGED), 25.0
        for e1, e2, m, fixed, n in patterns:
            odds = COINCIDENCE - costs[e1] - costs[e2] - (merged if m else 0.0) - fixed
            p = n / (1 + math.exp(-max(min(odds, 50.0), -50.0)))
            kinds[e1] += p
            kinds[e2] += p
            run, of = run + p * m, of + p
        # as in the start, no error at all is the reference
        costs = tuple(max(math.log(kinds[0] / k), 0.0) for k in kinds)
        merged = max(-math.log(run / of), 0.0)
    return costs, merged


def _attach(scored: DataFrame, channel: tuple[tuple[float, ...], float]) -> DataFrame:
    """For each spelling its best canonical form, if it beats being a name of its own."""
    costs, merged = channel
    total = _priced(F.col("e1"), costs) + _priced(F.col("e2"), costs) + F.when(F.col("merged"), merged).otherwise(0.0) + F.col("fixed")
    best = F.max_by("to_sid", F.struct((-F.col("cost")).alias("p"), "to_n", "to_weight", "to_sid"))
    return scored.withColumn("cost", total).where(F.col("cost") < COINCIDENCE).groupBy("sid").agg(best.alias("to"))


def name_classes(rows: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """One row ``(id, name, entity)`` per distinct id and name with a usable name.

    ``entity`` is the id of the canonical spelling. Null, blank and junk names
    (no proper word) have no entity and are left out; repeated rows count once;
    other columns are ignored; an empty table gives an empty result.
    """
    typed = rows.select(F.col(id_col).alias("id"), F.col(name_col).alias("name")).where(F.col("id").isNotNull())
    rows = typed.distinct()
    parts = name_parts(typed, "name", id_col="id")
    parsed = cut(parse_names(parts, learn_generic(parts)).withColumn("sid", F.xxhash64("words")))
    drop(parts)
    sig = parsed.groupBy("words").agg(F.first("sid").alias("sid"), F.first("a").alias("a"), F.first("b").alias("b"), F.sum("n").alias("n"))
    degree = sig.select(F.explode(F.array("a", "b")).alias("w")).where("w <> ''").groupBy("w").agg(F.count(F.lit(1)).alias("d"))
    for side in "ab":
        sig = sig.join(degree.select(F.col("w").alias(side), F.col("d").alias(f"d{side}")), side, "left")
    sig = cut(sig.fillna(1, ["da", "db"]))

    scored = _candidates(sig)
    frequent = scored.where("to_n > 1")  # frequent spellings are tried first
    tally = frequent.groupBy("e1", "e2", "merged", F.round("fixed").alias("fixed")).agg(F.count(F.lit(1)).alias("n")).collect()  # kinds by kinds by some twenty costs
    channel = fit_channel(sorted((r["e1"], r["e2"], r["merged"], r["fixed"], float(r["n"])) for r in tally))
    first = cut(_attach(frequent, channel))
    # what they leave is tried among itself
    rest = scored.where("to_n = 1").join(first, "sid", "left_anti").join(first.select(F.col("sid").alias("to_sid")), "to_sid", "left_anti")
    second = _attach(rest, channel).select("sid", F.col("to").alias("second"))
    root = sig.select("sid").join(first, "sid", "left").join(second, "sid", "left")
    root = cut(root.select("sid", F.coalesce("to", "second", "sid").alias("to")))
    while True:  # pointer jumping: the depth halves, so a few rounds end it
        up = root.select(F.col("sid").alias("to"), F.col("to").alias("next"))
        jumped = cut(root.join(up, "to").select("sid", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")))
        root = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            break
    entity = parsed.join(root, "sid").select("name", F.col("to").alias("entity"))
    return rows.join(entity, "name").select("id", "name", "entity")


def name_pairs(rows: DataFrame, id_col: str, name_col: str, place_col: str) -> DataFrame:
    """Pairs ``(id_a, id_b)`` of one organisation under different spellings at different places."""
    places = rows.select(F.col(id_col).alias("id"), F.col(place_col).alias("place")).distinct()
    full = name_classes(rows, id_col, name_col).join(places, "id")
    a, b = full.alias("a"), full.alias("b")
    on = (F.col("a.entity") == F.col("b.entity")) & (F.col("a.id") < F.col("b.id")) & (F.col("a.place") != F.col("b.place")) & (F.col("a.name") != F.col("b.name"))
    return a.join(b, on).select(F.col("a.id").alias(f"{id_col}_a"), F.col("b.id").alias(f"{id_col}_b"))
