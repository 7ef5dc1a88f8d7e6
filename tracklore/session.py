"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folder of this driver's tables within the shared folder, the shared folders in use, and the tables written.
_RUN = f"tracklore-{uuid.uuid4().hex[:12]}"
_made: set[str] = set()
_tables: list[str] = []
#: Whether Spark removes the shuffle files of a statement at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of code beyond which a whole stage is not made one method; the JVM compiles none of more than 8,000.
_METHOD = "spark.sql.codegen.hugeMethodLimit"
#: Whether the driver writes and compiles code for whole stages.
_WHOLE = "spark.sql.codegen.wholeStage"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a session on this machine alone may go without one and gets a temporary
    folder; on a cluster each executor would write to a folder of its own, so the
    lack of a shared one is an error.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tracklore-ckpt-"))
        folder = sc.getCheckpointDir()
    return folder


def cut(df: DataFrame, long: bool = False, many: bool = False) -> DataFrame:
    """Cut the lineage of ``df``: write it to the shared folder and read it back.

    A columnar, compressed table takes a fraction of the disk of a checkpoint of rows
    and any executor can read it, so a lost executor costs nothing. The tables are
    removed by ``release``, at the latest when the driver ends. The shuffle files of
    the write are no longer needed once it is done and go at once. ``long`` is for rows
    of very many expressions: the code of a whole stage of them is a method too long
    for the JVM to compile, so they run operator by operator, in methods that are split.
    ``many`` is for few rows in very many stages: code of each stage, which the driver
    compiles and holds, would take more of its memory and time than it saves.
    """
    spark = df.sparkSession
    base = shared_folder(spark)
    if base not in _made:
        _made.add(base)
        atexit.register(_remove, spark, f"{base}/{_RUN}")
    path = f"{base}/{_RUN}/{uuid.uuid4().hex}"
    settings = {_CLEANUP: "true"} | ({_METHOD: "8000"} if long else {}) | ({_WHOLE: "false"} if many else {})
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    _tables.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, keep: int = 0) -> None:
    """Remove the tables written so far but for the first ``keep``.

    For a long session: call it when the result of a query is written. Results that
    are not yet written must not be read afterwards.
    """
    while len(_tables) > keep:
        _remove(spark, _tables.pop())


def drop(df: DataFrame) -> None:
    """Remove the tables of ``df``, which ``cut`` made, when nothing reads them any more."""
    for path in {f.rpartition("/")[0].removeprefix("file://") for f in df.inputFiles()}:
        for own in [t for t in _tables if t.removeprefix("file://") == path]:
            _tables.remove(own)
            _remove(df.sparkSession, own)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    except Exception:  # noqa: BLE001 - the session has ended, and with it the way to the folder
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A scan, with filters and projections, in partitions enough for costly work on each row.

    The splits of the scan stay as they are, without a shuffle, wherever they occupy
    all cores; so they do for any table of more than a few megabytes a core. Only a
    smaller table, or one that cannot be split, is dealt out anew.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(3 * cores)
