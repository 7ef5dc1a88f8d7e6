"""Vocabulary of the rail-served facility domain: what the reference tables themselves give.

Other names for an entry are learnt from the table (canonical.learn_phrases).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklore.llm.textnorm import STATE_FORMS

#: Words around a kind of facility that say nothing of it (fixed values).
FACILITY_STOP = "a an and the of for that or with by from to where our old new large small main no active inactive partly leased type building landuse man made industrial office former site yes kind is".split()
STATE_STOP = "state commonw commonwealth of estado the usa us".split()


def state_entries(regions: DataFrame) -> DataFrame:
    """(entry, phrase) of the states: code, name, both, and usual short forms."""
    spark: SparkSession = regions.sparkSession
    forms = [(k, f) for k, v in STATE_FORMS.items() for f in v.split()]
    own = regions.select(F.col("state_code").alias("entry"), F.explode(F.array("state_code", "state_name", F.concat_ws(" ", "state_code", "state_name"))).alias("phrase"))
    extra = spark.createDataFrame(forms, "entry string, phrase string").join(regions.select(F.col("state_code").alias("entry")), "entry", "left_semi")
    return own.unionByName(extra)


def facility_entries(types: DataFrame) -> DataFrame:
    """(entry, phrase) of the kinds of facility: name and parts of the description."""
    parts = F.flatten(F.transform(F.split("description", ";"), lambda p: F.concat(F.array(p), F.split(p, ","))))
    return types.select(F.col("facility_type").alias("entry"), F.explode(F.concat(F.array("facility_type"), F.coalesce(parts, F.array().cast("array<string>")))).alias("phrase"))
