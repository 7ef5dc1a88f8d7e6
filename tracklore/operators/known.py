"""Known accounts: flags and validation by substrings of normal names.

The list of known names is small by what it is; its size is checked, and it becomes
a literal of the expression. Distinct names are compared, never rows in a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.functions.text import norm_suffix, strip

#: Most names of a list that becomes a literal.
MOST_KNOWN = 20_000


def known_names(accounts: DataFrame, col: str, normal: bool = False) -> list[str]:
    """Distinct lower-case names without blanks and nulls, of a list of checked size."""
    name = norm_suffix(F.col(col)) if normal else strip(F.lower(F.col(col)))
    rows = accounts.select(name.alias("n")).where(F.col("n") != "").distinct().limit(MOST_KNOWN + 1).collect()
    if len(rows) > MOST_KNOWN:
        raise ValueError(f"more than {MOST_KNOWN} known names; join them by key instead")
    return sorted(r[0] for r in rows)


def _literal(names: list[str]) -> Column:
    return F.array(*(F.lit(n) for n in names)) if names else F.array().cast("array<string>")


def contained(name: Column, known: Column) -> Column:
    """Known names that contain the name or are contained in it."""
    return F.filter(known, lambda k: F.contains(name, k) | F.contains(k, name))


def flag_known(rows: DataFrame, name: str, known: list[str], flag: str = "in_existing_list") -> DataFrame:
    """Rows with a flag; the empty normal name matches any list that is not empty."""
    names = rows.select(F.col(name).alias("_n")).distinct().withColumn("_norm", norm_suffix(F.col("_n")))
    names = names.withColumn(flag, F.size(contained(F.col("_norm"), _literal(known))) > 0).drop("_norm")
    return rows.drop(flag).join(names, F.col(name).eqNullSafe(F.col("_n"))).drop("_n")


def fuzzy_pairs(names: DataFrame, known: list[str]) -> DataFrame:
    """(name, known) of different names of which one contains the other, from distinct normal names."""
    hits = F.filter(contained(F.col("name"), _literal(known)), lambda k: k != F.col("name"))
    return names.where(F.col("name") != "").select("name", F.explode(hits).alias("known"))


def validation(names: DataFrame, known: list[str]) -> DataFrame:
    """One row of counts: names, known, exact, matched, new."""
    n = names.select("name").where("name <> ''").distinct()
    k = _literal(known)
    marked = n.select(F.array_contains(k, F.col("name")).alias("exact"), (F.size(contained(F.col("name"), k)) > 0).alias("matched"))
    return marked.agg(
        F.count(F.lit(1)).alias("n_names"),
        F.lit(len(known)).cast("bigint").alias("n_known"),
        F.count_if("exact").alias("n_exact"),
        F.count_if("matched").alias("n_matched"),
        F.count_if(~F.col("matched")).alias("n_new"),
    )


def new_names(names: DataFrame, known: list[str]) -> DataFrame:
    """Discovered names that contain no known name and are contained in none."""
    n = names.select("name").where("name <> ''").distinct()
    return n.where(F.size(contained(F.col("name"), _literal(known))) == 0)


def missed_known(names: DataFrame, known: list[str]) -> DataFrame:
    """Known names that no discovered name contains or is contained in."""
    spark = names.sparkSession
    hit = fuzzy_pairs(names, known).select("known").union(names.where(F.col("name").isin(known)).select("name")).distinct()
    return spark.createDataFrame([(k,) for k in known], "known string").join(hit, "known", "left_anti")
