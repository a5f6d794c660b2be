"""Corpus writers and the read-or-compute cache."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convlens import session
from convlens.sources import readers

__all__ = ["write_csv", "write_parquet", "write_json", "write_sample", "write_embeddings", "write_splits", "materialize", "exists"]


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; nested columns are stored as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields]
    df.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """A small report, one JSON object per row."""
    df.write.mode("overwrite").json(path)


def write_sample(df: DataFrame, path: str, n: int = 3) -> None:
    """The first n rows as JSON."""
    write_json(df.limit(n), path)


def write_embeddings(df: DataFrame, path: str) -> None:
    """(id, encoder, embedding), one folder per encoder."""
    df.write.mode("overwrite").partitionBy("encoder").parquet(path)


def write_splits(df: DataFrame, folder: str, splits=("train", "val", "test")) -> None:
    """Feature and label tables of each split. The rows are computed once, into a staged table that the six writes read."""
    spark = df.sparkSession
    held = session.stage(df.select("split", "conversation_id", "conversation", "conversation_proc", "harm"))
    for split in splits:
        part = held.filter(F.col("split") == split)
        write_parquet(part.select("conversation_id", "conversation", "conversation_proc"), f"{folder}/X_{split}")
        write_parquet(part.select("conversation_id", "harm"), f"{folder}/Y_{split}")
    session.discard(spark, held)


def exists(spark: SparkSession, path: str) -> bool:
    """True if the path holds a finished write, on whatever file system it names."""
    return readers.finished(spark, path)


def input_state(df: DataFrame) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of every file a table reads."""
    spark, out = df.sparkSession, []
    conf = spark._jsc.hadoopConfiguration()
    for name in sorted(df.inputFiles()):
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(name))
        status = path.getFileSystem(conf).getFileStatus(path)
        out.append((name, status.getLen(), status.getModificationTime()))
    return out


def plan_text(df: DataFrame) -> str:
    """The analysed plan without the numbers that every session gives anew."""
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().analyzed().toString())


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the stored result of a plan over unchanged files, or compute and store it first.

    A manifest names the result; its own name is a digest of the plan and of the
    input files' sizes and times, so a changed input or plan is computed anew. It
    is written last, under another name, and then renamed: a broken write is
    never seen, and of two builders the first one's result stays and is read by
    both. Code inside Python functions is not part of the plan. The path is a
    shared folder, so the table also cuts lineage and outlives executors.
    """
    df = build()
    key = hashlib.sha256(json.dumps([plan_text(df), input_state(df)]).encode()).hexdigest()[:32]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    final = jvm.org.apache.hadoop.fs.Path(f"{path}/manifest-{key}.json")
    fs = final.getFileSystem(conf)
    if not fs.exists(final):
        name = f"data-{key}-{uuid.uuid4().hex}"
        write_parquet(df, f"{path}/{name}")
        draft = jvm.org.apache.hadoop.fs.Path(f"{path}/draft-{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(bytearray(json.dumps({"data": name, "key": key}).encode()))
        out.close()
        if not _publish(spark, fs, draft, final):
            fs.delete(draft, False)
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    return spark.read.schema(df.schema).parquet(f"{path}/{_manifest(spark, fs, final)['data']}")


def _publish(spark: SparkSession, fs, draft, final) -> bool:
    """Rename without replacing: False where the name is taken."""
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(draft, final, never)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise


def _manifest(spark: SparkSession, fs, final) -> dict:
    stream = fs.open(final)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
