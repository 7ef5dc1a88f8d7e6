"""Best representative of each duplicate group: latent truth with two-sided source quality.

Every distinct value that the records of a group give for a field is a fact, true or
not. A source that has records in the group asserts a fact or leaves it out. For
each source the model infers its sensitivity (how often it states a true value) and
its specificity (how often it leaves out a false one), and for each fact the
probability that it is true, by expectation-maximisation. An audit of the sources,
where there is one, is the prior. Several values of a field can be judged true.

Facts with the same evidence are one pattern with a count, so the rounds run over a
small table, and only sums by source reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.llm.textnorm import PLACEHOLDERS
from tracklore.session import cut

ROUNDS = 12
#: Pseudo-counts of the priors of sensitivity and of false assertions without an audit, and the weight of an audit.
SENSE, FALSE, AUDIT_WEIGHT = (8.0, 4.0), (2.0, 12.0), 0.1
#: Prior of a fact being true, and least probability of a value judged true.
TRUE_PRIOR, JUDGED = 0.5, 0.5


def usable(c: Column) -> Column:
    """False for null, blank, punctuation, zeros and words that stand for nothing known."""
    bare = F.regexp_replace(F.lower(c), r"[\s._\-]+", "")
    return F.coalesce(bare.rlike("[a-z\\u00c0-\\u024f]|[1-9]") & ~bare.isin(*sorted(PLACEHOLDERS)), F.lit(False))


def _same(c: Column) -> Column:
    """The value's identity: case, blanks and punctuation do not matter."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")


def _evidence(claims: DataFrame) -> DataFrame:
    """One row per fact: ``said`` and ``silent``, the sources that assert it or leave it out."""
    said = claims.groupBy("object", "fact").agg(F.sort_array(F.collect_set("source")).alias("said"))
    present = claims.groupBy("object").agg(F.sort_array(F.collect_set("source")).alias("present"))
    facts = said.join(present, "object")
    return facts.select("object", "fact", "said", F.array_except("present", "said").alias("silent"))


def fit_truth(claims: DataFrame, audit: dict[str, tuple[float, float]]) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """(facts with ``probability``, source -> (sensitivity, specificity)) of claims (object, fact, source).

    ``audit`` gives (checked, correct) by source. The number of sources is that of
    feeds, not of rows; a set of them is all that one group collects.
    """
    spark = claims.sparkSession
    facts = cut(_evidence(claims.distinct()))
    patterns = cut(facts.groupBy("said", "silent").agg(F.count(F.lit(1)).alias("n")))
    names = sorted(r[0] for r in claims.select("source").distinct().collect())
    prior = {}
    for s in names:
        checked, correct = audit.get(s, (0.0, 0.0))
        prior[s] = (SENSE[0] + AUDIT_WEIGHT * correct, SENSE[1] + AUDIT_WEIGHT * (checked - correct), FALSE[0] + AUDIT_WEIGHT * (checked - correct), FALSE[1] + AUDIT_WEIGHT * correct)
    rate = {s: (a / (a + b), c / (c + d)) for s, (a, b, c, d) in prior.items()}

    def odds() -> Column:
        """Log odds of a fact from the rates as they stand."""
        weigh = lambda f: F.create_map(*(F.lit(x) for s in names for x in (s, f(*rate[s]))))
        yes, no = weigh(lambda p, q: math.log(p / q)), weigh(lambda p, q: math.log((1 - p) / (1 - q)))
        total = lambda arr, m: F.aggregate(arr, F.lit(0.0), lambda t, s: t + F.element_at(m, s))
        return F.lit(math.log(TRUE_PRIOR / (1 - TRUE_PRIOR))) + total(F.col("said"), yes) + total(F.col("silent"), no)

    for _ in range(ROUNDS if names else 0):
        t = patterns.withColumn("p", 1 / (1 + F.exp(-odds())))
        by = lambda c, v: t.select(F.explode(c).alias("source"), F.lit(v).alias("v"), (F.col("p") * F.col("n")).alias("yes"), ((1 - F.col("p")) * F.col("n")).alias("no"))  # noqa: E731, B023
        sums = by("said", 1).unionByName(by("silent", 0)).groupBy("source", "v").agg(F.sum("yes"), F.sum("no")).collect()
        count = {(r[0], r[1]): (r[2], r[3]) for r in sums}
        for s in names:
            (tp, fp), (fn, tn) = count.get((s, 1), (0.0, 0.0)), count.get((s, 0), (0.0, 0.0))
            a, b, c, d = prior[s]
            rate[s] = ((a + tp) / (a + b + tp + fn), (c + fp) / (c + d + fp + tn))
    facts = facts.withColumn("probability", 1 / (1 + F.exp(-odds()))) if names else facts.withColumn("probability", F.lit(0.0))
    return facts.select("object", "fact", "probability"), {s: (p, 1 - q) for s, (p, q) in rate.items()}


def audits(audit: DataFrame, field: str) -> dict[str, tuple[float, float]]:
    """(checked, correct) by source of one field; the audit has a row per source and field, so it is small."""
    rows = audit.where(F.col("field_name") == field).groupBy("source").agg(F.sum("checked_rows"), F.sum("correct_rows")).collect()
    return {r[0]: (float(r[1]), float(r[2])) for r in rows if r[0] is not None and r[1]}


def claims_of(rows: DataFrame, group: str, field: str, source: str) -> DataFrame:
    usable_rows = rows.where(F.col(group).isNotNull() & usable(F.col(field)))
    return usable_rows.select(F.col(group).alias("object"), _same(F.col(field)).alias("fact"), F.coalesce(F.col(source), F.lit("")).alias("source"))


def survivors(rows: DataFrame, audit: DataFrame, *, group: str, record: str, source: str, date: str, fields: list[str]) -> DataFrame:
    """One row per group of two or more distinct records, with the surviving value of each field.

    A field takes, unchanged, the value of its best row: usable values first, then
    the source of greater audited share (for a source without an audit the share that
    the model infers: its true among its asserted values), then the later date (null
    last), then the value of greater probability, then the least record id. ``''`` if
    no row has a usable value. Null groups are left out; repeated rows count once.
    """
    rows = rows.select(group, record, source, date, *fields).where(F.col(group).isNotNull() & F.col(record).isNotNull()).distinct()
    sizes = rows.groupBy(group).agg(F.count_distinct(record).alias("n")).where("n >= 2").select(group)
    rows = cut(rows.join(sizes, group, "left_semi"))
    out = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    for field in fields:
        known = audits(audit, field)
        facts, rate = fit_truth(claims_of(rows, group, field, source), known)
        facts = cut(facts)
        share = {s: correct / checked for s, (checked, correct) in known.items()}
        share |= {s: p * TRUE_PRIOR / (p * TRUE_PRIOR + (1 - q) * (1 - TRUE_PRIOR)) for s, (p, q) in rate.items() if s not in share}
        trust = F.create_map(*(F.lit(x) for s, v in sorted(share.items()) for x in (s, float(v)))) if share else F.create_map(F.lit(""), F.lit(0.0))
        r = rows.where(usable(F.col(field))).withColumn("_s", F.coalesce(F.try_element_at(trust, F.coalesce(F.col(source), F.lit(""))), F.lit(0.0)))
        r = r.withColumn("_f", _same(F.col(field))).join(facts.select(F.col("object").alias(group), F.col("fact").alias("_f"), "probability"), [group, "_f"], "left")
        rank = F.struct("_s", F.coalesce(F.col(date).cast("string"), F.lit("")).alias("d"), F.coalesce("probability", F.lit(0.0)).alias("p"), (-F.col(record)).alias("r"))
        out = out.join(r.groupBy(group).agg(F.max_by(field, rank).alias(field)), group, "left")
    return out.fillna("", fields)


def truths(rows: DataFrame, audit: DataFrame, *, group: str, source: str, field: str) -> DataFrame:
    """All values of a multi-valued field that are judged true: (group, value, probability)."""
    facts, _ = fit_truth(claims_of(rows, group, field, source), audits(audit, field))
    best = rows.where(usable(F.col(field))).groupBy(F.col(group).alias("object"), _same(F.col(field)).alias("fact")).agg(F.min(field).alias("value"))
    kept = facts.where(F.col("probability") >= JUDGED).join(best, ["object", "fact"])
    return kept.select(F.col("object").alias(group), F.lit(field).alias("field_name"), "value", F.round("probability", 6).alias("probability"))


def source_quality(rows: DataFrame, audit: DataFrame, *, group: str, source: str, fields: list[str]) -> DataFrame:
    """Inferred (field_name, source, sensitivity, specificity)."""
    table = []
    for field in fields:
        _, rate = fit_truth(claims_of(rows, group, field, source), audits(audit, field))
        table += [(field, s, round(p, 6), round(q, 6)) for s, (p, q) in rate.items()]
    return rows.sparkSession.createDataFrame(table, "field_name string, source string, sensitivity double, specificity double")
