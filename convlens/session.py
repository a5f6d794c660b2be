"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that do not depend on the cluster. Shuffle partitions are left to
#: the cluster's own value: AQE merges small ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("convlens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.convlens.textTasks", "8" if cores == "*" else cores)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_folder: list[str] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the session names.

    A temporary folder is used only by a local session that names none; on a
    cluster a missing setting is an error, since executors cannot see the
    driver's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _local_folder:
        _local_folder.append(tempfile.mkdtemp(prefix="convlens-checkpoint-"))
    return _local_folder[0]


def stage(df: DataFrame) -> DataFrame:
    """Compute a table once, as a written table in the shared checkpoint folder.

    Used for narrow tables that several branches of one plan read. Unlike a
    cached table it survives lost executors, and its size is known to Spark.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/convlens-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _staged.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


_staged: list[str] = []


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession, since: int = 0) -> int:
    """Delete the tables staged so far, or since a mark, once the results that read them are written; gives their number."""
    n = len(_staged) - since
    while len(_staged) > since:
        _delete(spark, _staged.pop())
    return n


def staged_mark() -> int:
    """The number of tables staged so far, for `release`."""
    return len(_staged)


def discard(spark: SparkSession, *tables: DataFrame | None) -> None:
    """Delete staged tables that nothing reads any more, such as those of an iteration's earlier round."""
    for table in tables:
        path = getattr(table, "_staged_path", None)
        if path in _staged:
            _staged.remove(path)
            _delete(spark, path)
