"""Tables that cut the lineage, and the disk that they leave behind."""

import time

from pyspark.sql import functions as F

from tracklore import session


def on_disk(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if "shuffle" in files.apply(i).getName())


def test_cut_leaves_no_shuffle_files(spark):
    before = on_disk(spark)
    rows = spark.range(200_000).select((F.col("id") * 7 % 100_003).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    kept = session.cut(rows)
    for _ in range(50):  # the files go in the background
        if (left := on_disk(spark)) <= before:
            break
        time.sleep(0.1)
    assert left <= before and kept.count() == 100_003


def test_drop_removes_one_table(spark):
    a, b = session.cut(spark.range(10)), session.cut(spark.range(20))
    path = lambda df: df.inputFiles()[0].rpartition("/")[0].removeprefix("file://")
    of_a, held = path(a), len(session._tables)
    session.drop(a)
    assert len(session._tables) == held - 1 and of_a not in [t.removeprefix("file://") for t in session._tables] and b.count() == 20
    session.drop(spark.range(3))


def test_long_rows_are_cut_without_one_long_method(spark):
    keys = (session._CLEANUP, session._METHOD)
    before = [spark.conf.get(k) for k in keys]
    rows = spark.range(50).select(*(F.when(F.col("id") % k == 0, F.col("id") * k).otherwise(k).alias(f"c{k}") for k in range(1, 40)))
    assert sorted(map(tuple, session.cut(rows, long=True).collect())) == sorted(map(tuple, rows.collect()))
    assert [spark.conf.get(k) for k in keys] == before
