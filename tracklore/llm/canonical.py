"""Free-entered values mapped to a canonical list: token repair and soft TF-IDF.

Distinct values are cut into tokens; each distinct token is joined to the words of
the reference list by edit distance (an equi-join on shared deletions) or as a
short form (same first letter, letters in order). The repaired tokens of a value
are then combined: every phrase of the list is ranked by soft TF-IDF, the cosine
of both weighted bags in which repaired tokens count by their similarity. A value
with too low a best score, or whose best score two entries share, has no match.

Other names for an entry, which share no word with it, are learnt from records of the
same thing: a phrase that stands again and again beside one entry and hardly beside
others joins the list as a phrase of that entry, and what the list alone left open is
repaired and ranked once more. Values that mean no entry stand beside all entries.

Fields with lists of their own go through together, each row under its field: the number
of plans, and with it what the driver plans and compiles, does not depend on that of fields.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.session import cut

#: What a value comes out as that means no entry.
UNMATCHED = "UNMATCHED"
#: Least soft TF-IDF of a match.
LEAST = 0.72
#: Least score of a match that no other entry comes near to, and how near is near.
LONE, MARGIN, LONE_LETTERS = 0.62, 0.12, 6
#: By field: the stop words, and whether words are made singular.
Rules = dict[str, tuple[list[str], bool]]
#: Words that stand for nothing known (fixed values).
BLANKS = "tbd tba tbc na nan nil null none unknown undefined unspecified missing pending see notes remarks not given available applicable provided same as above xx xxx poi".split()
#: Similarity of a short form, and the least similarity of a repaired token or value.
SHORT_FORM, LEAST_REPAIR = 0.85, 0.6
#: A phrase is another name for an entry if so many things, and this share of those with a known entry, have it beside that entry.
BESIDE, BESIDE_SHARE = 3, 0.75
#: Accented letters and the plain ones that stand for them (fixed values).
_ACCENTS = ("áàâäãåéèêëíìîïóòôöõúùûüñçýß", "aaaaaaeeeeiiiiooooouuuuncys")


def folded(c: Column) -> Column:
    """Lower case without accents; camel case, punctuation and underscores become blanks."""
    s = F.translate(F.lower(c), *_ACCENTS)
    s = F.regexp_replace(s, r"\bu\.? ?s\.? ?(a\.?)?(?![a-z])|\d+", " ")
    s = F.regexp_replace(s, r"\b([a-z])\.(?=[a-z]\b)", "$1")  # initials belong together
    s = F.regexp_replace(s, r"\b([a-z])/(?=[a-z])|\b([a-z])-(?=[a-z])", "$1$2")
    return F.trim(F.regexp_replace(s, r"[^a-z]+", " "))


_STEM_SQL = (
    "case when length(t) > 4 and endswith(t, 'ies') then concat(substring(t, 1, length(t) - 3), 'y') "
    "when length(t) > 4 and t rlike '(s|x|ch|sh)es$' then substring(t, 1, length(t) - 2) "
    "when length(t) > 3 and t rlike '[^s]s$' then substring(t, 1, length(t) - 1) else t end"
)


def _by_field(rules: Rules, value: Callable[[list[str], bool], Column]) -> Column:
    """What ``value`` makes of the rule of a row's field."""
    made = None
    for field, rule in rules.items():
        made = (F if made is None else made).when(F.col("field") == field, value(*rule))
    return made


def bagged(df: DataFrame, text: str, rules: Rules) -> DataFrame:
    """Adds ``tokens`` (distinct, without stop words, singular if the field asks for it) and ``whole`` (all letters together)."""
    df = df.withColumn("_f", folded(F.col(text)))
    df = df.withColumn("_w", _by_field(rules, lambda stop, _: F.filter(F.split("_f", " "), lambda t: (t != "") & ~t.isin(*stop))))
    df = df.withColumn("tokens", _by_field(rules, lambda _, singular: F.expr(f"array_distinct(transform(_w, t -> {_STEM_SQL if singular else 't'}))")))
    return df.withColumn("whole", F.array_join("tokens", "")).drop("_f", "_w")


def _deletions(c: str, most: str = "2") -> Column:
    """The word and all that one or two deletions make of it, as an array."""
    one = f"transform(sequence(1, length({c})), i -> concat(left({c}, i - 1), substring({c}, i + 1)))"
    two = f"flatten(transform({one}, w -> transform(sequence(1, greatest(length(w), 1)), i -> concat(left(w, i - 1), substring(w, i + 1)))))"
    return F.expr(
        f"array_distinct(case when length({c}) <= 2 then array({c}) when length({c}) <= 4 then array_append({one}, {c}) else concat(array({c}), {one}, {two}) end)"
    )


def _similar(a: Column, b: Column) -> Column:
    """1 less the share of letters in error; letters that only changed places count as one error."""
    lev = F.levenshtein(a, b)
    swapped = (lev == 2) & (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    return 1.0 - F.when(swapped, 1).otherwise(lev) / F.greatest(F.length(a), F.length(b))


def _near(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs of distinct words of a field within two edits, with their similarity, by shared deletions.

    A word more than two letters longer than the longest of the list is within two
    edits of none, so it is left out, however long it is.
    """
    longest = right.groupBy("field").agg(F.max(F.length(b)).alias("longest"))
    left = left.join(F.broadcast(longest), "field").where(F.length(a) <= F.col("longest") + 2)  # one row a field
    x = left.select("field", a, F.explode(_deletions(a)).alias("d"))
    y = right.select("field", b, F.explode(_deletions(b)).alias("d"))
    pairs = x.join(y, ["field", "d"]).select("field", a, b).distinct()
    return pairs.withColumn("sim", _similar(F.col(a), F.col(b))).where(F.col("sim") >= LEAST_REPAIR)


def repair(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates ``(field, token, word, sim)`` of distinct tokens among distinct words of the field's list."""
    near = _near(tokens, words, "token", "word")
    # a short form: its letters come in this order in the word, from the first
    initial = lambda df, c: df.select("field", c, F.substring(c, 1, 1).alias("i"))
    short = initial(tokens.where(F.length("token") <= 7), "token").join(initial(words, "word"), ["field", "i"]).where(F.length("token") < F.length("word"))
    short = short.where(F.expr("word rlike concat('^', regexp_replace(token, '(.)', '$1.*'))"))
    short = short.select("field", "token", "word", (F.lit(SHORT_FORM) + 0.1 * F.length("token") / F.length("word")).alias("sim"))
    return near.unionByName(short).groupBy("field", "token", "word").agg(F.max("sim").alias("sim"))


def _alone(df: DataFrame) -> DataFrame:
    """Rows of one list, under a field without name."""
    return df.select(F.lit("").alias("field"), *df.columns)


def canonicalise(values: DataFrame, entries: DataFrame, *, stop: list[str], least: float = LEAST, singular: bool = True) -> DataFrame:
    """``(value, canonical, score)`` of the distinct values of column ``value``.

    ``entries`` has (entry, phrase): each entry of the list with its names and
    descriptions. Null and blank values are left out; with an empty list every value
    is UNMATCHED. Values are compared whole, however long.
    """
    rules = {"": (stop, singular)}
    return _ranked(_alone(values.select("value")), _alone(entries), rules, least).drop("field")


def _ranked(values: DataFrame, entries: DataFrame, rules: Rules, least: float = LEAST) -> DataFrame:
    """``(field, value, canonical, score)`` of distinct values (field, value) by the lists ``entries`` (field, entry, phrase)."""
    v = values.select("field", "value").where(F.length(F.trim("value")) > 0).distinct()
    v = bagged(v, "value", {f: ([*stop, *BLANKS], singular) for f, (stop, singular) in rules.items()})
    v = cut(v)
    p = bagged(entries.where(F.col("phrase").isNotNull()).distinct(), "phrase", rules).where(F.size("tokens") > 0)
    p = cut(p.groupBy("field", "entry", "whole").agg(F.first("tokens").alias("tokens")).withColumn("pid", F.xxhash64("field", "entry", "whole")), many=True)
    in_list = p.select("field", "entry", "pid", F.explode("tokens").alias("word"))
    sizes = {r["field"]: r["n"] for r in p.groupBy("field").agg(F.count_distinct("entry").alias("n")).collect()}  # one row a field
    n_entries = F.coalesce(*(F.when(F.col("field") == f, n) for f, n in sizes.items()), F.lit(1))
    idf = in_list.groupBy("field", "word").agg(F.log1p(n_entries / F.count_distinct("entry")).alias("idf"))
    idf = cut(idf, many=True)
    in_list = in_list.join(idf, ["field", "word"])
    norms = in_list.groupBy("pid").agg(F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("norm"))

    tokens = v.select("field", "value", F.explode("tokens").alias("token"))
    repaired = cut(repair(tokens.select("field", "token").distinct(), idf.select("field", "word")).join(idf, ["field", "word"]), many=True)
    best_idf = repaired.groupBy("field", "token").agg(F.max_by("idf", "sim").alias("tidf"))
    weighed = tokens.join(best_idf, ["field", "token"], "left").withColumn("tidf", F.coalesce("tidf", F.log1p(n_entries)))
    vnorm = weighed.groupBy("field", "value").agg(F.sqrt(F.sum(F.col("tidf") * F.col("tidf"))).alias("vnorm"))

    hits = weighed.join(repaired, ["field", "token"]).join(in_list.select("field", "word", "entry", "pid"), ["field", "word"])
    # a token repairs one word of a phrase: the one it is most like
    hits = hits.groupBy("field", "value", "entry", "pid", "token").agg(F.max_by(F.struct("word", "sim", "idf", "tidf"), "sim").alias("h"))
    hits = hits.groupBy("field", "value", "entry", "pid", "h.word").agg(F.max("h.sim").alias("sim"), F.max("h.idf").alias("idf"), F.max("h.tidf").alias("tidf"))
    soft = hits.groupBy("field", "value", "entry", "pid").agg(F.sum(F.col("sim") * F.col("idf") * F.col("tidf")).alias("dot"))
    soft = soft.join(norms, "pid").join(vnorm, ["field", "value"]).select("field", "value", "entry", (F.col("dot") / F.col("norm") / F.col("vnorm")).alias("score"))
    # blanks lost, added or moved: the letters together
    letters = v.select("field", F.col("whole").alias("token")).where("token <> ''").distinct()
    whole = repair(letters, p.select("field", F.col("whole").alias("word")).distinct()).select("field", F.col("token").alias("whole"), F.col("word").alias("name"), "sim")
    whole = whole.where((F.length("name") > 3) & (F.length("whole") > 3) | (F.col("sim") == 1.0))
    whole = v.select("field", "value", "whole").join(whole, ["field", "whole"]).join(p.select("field", "entry", F.col("whole").alias("name")), ["field", "name"]).select("field", "value", "entry", F.col("sim").alias("score"))
    scores = soft.unionByName(whole).groupBy("field", "value", "entry").agg(F.round(F.max("score"), 6).alias("score"))
    best = scores.groupBy("field", "value").agg(F.max(F.struct("score", "entry")).alias("top"), F.collect_list(F.struct("score", "entry")).alias("all"))
    rivals = F.filter("all", lambda x: x["entry"] != F.col("top.entry"))
    rival = F.coalesce(F.array_max(F.transform(rivals, lambda x: x["score"])), F.lit(0.0))
    best = best.withColumn("lead", F.col("top.score") - rival).drop("all")
    best = v.select("field", "value", "whole").join(best, ["field", "value"], "left")
    lone = (F.col("top.score") >= LONE) & (F.col("lead") >= MARGIN) & (F.length("whole") >= LONE_LETTERS)
    sure = ((F.col("top.score") >= least) & (F.col("lead") > 0)) | lone
    return best.select("field", "value", F.when(sure, F.col("top.entry")).otherwise(UNMATCHED).alias("canonical"), F.coalesce("top.score", F.lit(0.0)).alias("score"))


def learn_phrases(typed: DataFrame, exact: DataFrame) -> DataFrame:
    """(field, phrase, entry) of folded values that stand beside one entry.

    ``typed`` has (field, thing, value) of records, ``exact`` (field, value, entry) of the
    lists. A thing counts where its records give exactly one entry in the list's own words;
    copies count once and a null thing is none.
    """
    t = typed.where(F.col("thing").isNotNull() & (F.length(F.trim("value")) > 0)).select("field", "thing", "value").distinct()
    known = t.join(F.broadcast(exact), ["field", "value"])  # the lists are fixed tables of at most some hundred rows
    known = known.groupBy("field", "thing").agg(F.count_distinct("entry").alias("n"), F.first("entry").alias("entry")).where("n = 1").select("field", "thing", "entry")
    other = t.join(F.broadcast(exact.select("field", "value")), ["field", "value"], "left_anti").select("field", "thing", folded(F.col("value")).alias("phrase")).where("phrase <> ''").distinct()
    beside = other.join(known, ["field", "thing"]).groupBy("field", "phrase", "entry").agg(F.count(F.lit(1)).alias("n"))
    best = beside.groupBy("field", "phrase").agg(F.max_by("entry", F.struct("n", "entry")).alias("entry"), F.max("n").alias("n"), F.sum("n").alias("of"))
    return best.where((F.col("n") >= BESIDE) & (F.col("n") >= BESIDE_SHARE * F.col("of"))).select("field", "phrase", "entry")


def canonicalise_records(typed: DataFrame, exact: DataFrame, entries: DataFrame, *, stop: list[str], singular: bool = True) -> DataFrame:
    """``(value, canonical)`` of the distinct values of ``typed`` (thing, value) that are no entry of ``exact`` (value, entry)."""
    return canonicalise_fields(_alone(typed), _alone(exact), _alone(entries), {"": (stop, singular)}).drop("field")


def canonicalise_fields(typed: DataFrame, exact: DataFrame, entries: DataFrame, rules: Rules) -> DataFrame:
    """``(field, value, canonical)`` of the distinct values of ``typed`` (field, thing, value) that are no entry of ``exact`` (field, value, entry).

    The lists alone are tried first; values that they leave open, or whose phrase stands
    beside another entry, are ranked again with the learnt phrases in the list.
    """
    values = typed.select("field", "value").where(F.length(F.trim("value")) > 0).distinct().join(F.broadcast(exact.select("field", "value")), ["field", "value"], "left_anti")
    first = cut(_ranked(values, entries, rules).select("field", "value", "canonical").withColumn("phrase", folded(F.col("value"))), many=True)  # distinct values only
    learnt = learn_phrases(typed, exact).withColumnRenamed("entry", "other")
    open_ = cut(first.join(learnt, ["field", "phrase"], "left").where((F.col("canonical") == UNMATCHED) | (F.col("other") != F.col("canonical"))))
    phrases = open_.where("other is not null").select("field", F.col("other").alias("entry"), "phrase").distinct()
    again = _ranked(open_.select("field", "value"), entries.unionByName(phrases), rules)
    again = cut(again.select("field", "value", F.col("canonical").alias("again")), many=True)  # keeps the plans of the callers short
    return first.join(again, ["field", "value"], "left").select("field", "value", F.coalesce("again", "canonical").alias("canonical"))
